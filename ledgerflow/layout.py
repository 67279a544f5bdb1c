"""Fixed-width record layouts: one object drives slicing, decoding and encoding."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FieldSpec:
    name: str
    pos: int          # 1-based byte position
    length: int       # bytes
    kind: str         # "text" (EBCDIC) or "comp3" (packed decimal)
    trim: bool = False
    digits: int = 0   # comp3 only: number of digit nibbles
    scale: int = 0    # comp3 only: implied decimal places

    def __post_init__(self):
        if self.kind not in ("text", "comp3"):
            raise ValueError(f"unknown field kind {self.kind!r}")
        if self.kind == "comp3" and self.length != (self.digits + 2) // 2:
            raise ValueError(f"{self.name}: {self.digits} digits need {(self.digits + 2) // 2} bytes")


@dataclass(frozen=True)
class RecordLayout:
    fields: tuple[FieldSpec, ...]
    codepage: str = "cp500"

    def __post_init__(self):
        pos = 1
        for f in self.fields:
            if f.pos != pos:
                raise ValueError(f"{f.name} starts at {f.pos}, expected {pos}")
            pos += f.length

    @property
    def record_length(self) -> int:
        return sum(f.length for f in self.fields)

    def field(self, name: str) -> FieldSpec:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


# The 35-byte core-banking ledger record. Positions, lengths,
# encodings and trimming must equal the producer's layout for parity.
#   tx_id        pos 1,  12 bytes, EBCDIC cp500 text, not trimmed
#   cust_id      pos 13, 10 bytes, EBCDIC cp500 text, not trimmed (blank = 10 spaces)
#   raw_balance  pos 23,  5 bytes, COMP-3: 9 digit nibbles + sign nibble, scale 2
#   tx_status    pos 28,  8 bytes, EBCDIC cp500 text, trimmed
LEDGER_LAYOUT = RecordLayout(
    fields=(
        FieldSpec("tx_id", 1, 12, "text"),
        FieldSpec("cust_id", 13, 10, "text"),
        FieldSpec("raw_balance", 23, 5, "comp3", digits=9, scale=2),
        FieldSpec("tx_status", 28, 8, "text", trim=True),
    ),
    codepage="cp500",
)
