"""The seekable Zstandard container: independent frames, then a seek table in a skippable frame.

Any Zstandard reader can read the whole file; one that knows the table can
decompress a single frame.
"""

from __future__ import annotations

import struct

import zstandard

# Fixed values of the container format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, FOOTER_BYTES = 0x184D2A5E, 0x8F92EAB1, 9

LEVEL = 3


class Writer:
    """Writes frames to a file object and the seek table at the end."""

    def __init__(self, file, level: int = LEVEL):
        self.file, self.sizes = file, []
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)

    def add_frame(self, data: bytes) -> int:
        """Append one frame; returns its number."""
        packed = self.compressor.compress(data)
        self.file.write(packed)
        self.sizes.append((len(packed), len(data)))
        return len(self.sizes) - 1

    def finish(self) -> None:
        table = b"".join(struct.pack("<II", *pair) for pair in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.file.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)


class Reader:
    """Random access by frame number to a seekable file object."""

    def __init__(self, file, size: int):
        self.file = file
        file.seek(size - FOOTER_BYTES)
        frames, flags, magic = struct.unpack("<IBI", file.read(FOOTER_BYTES))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("the file has no seek table")
        entry = 12 if flags & 0x80 else 8
        file.seek(size - FOOTER_BYTES - frames * entry)
        table = file.read(frames * entry)
        self.starts, self.sizes, at = [], [], 0
        for k in range(frames):
            packed, whole = struct.unpack_from("<II", table, k * entry)
            self.starts.append(at)
            self.sizes.append((packed, whole))
            at += packed
        self.decompressor = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.sizes)

    def frame(self, number: int) -> bytes:
        packed, whole = self.sizes[number]
        self.file.seek(self.starts[number])
        return self.decompressor.decompress(self.file.read(packed), max_output_size=whole)
