"""Column builders for mainframe codecs: EBCDIC text and COMP-3 packed decimal.

Every function returns a ``Column``; nothing here runs Python per row. The
expressions stay inside whole-stage codegen.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col as _col


# ---------------------------------------------------------------- EBCDIC

@functools.lru_cache(maxsize=None)
def _code_page_pairs(codepage: str) -> tuple[str, str]:
    """(latin1_chars, codepage_chars) for every byte the two code pages map differently.

    Single-byte EBCDIC pages such as cp500 are permutations of Latin-1, so
    decoding a byte string as ISO-8859-1 and translating character by
    character gives the same text as a native EBCDIC decoder. The table is
    derived from Python's codec, not typed in. Identity pairs (NUL among
    them) are left out, so ``translate`` never sees a NUL.
    """
    raw = bytes(range(256))
    native = raw.decode(codepage)
    latin = raw.decode("latin-1")
    if sorted(native) != sorted(latin):
        raise ValueError(f"{codepage} is not a single-byte permutation of Latin-1")
    pairs = [(a, b) for a, b in zip(latin, native) if a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


@functools.lru_cache(maxsize=None)
def _decode_pairs(codepage: str) -> tuple[str, str]:
    """Decode table as the JVM's charset has it, so ``translate`` and ``decode``
    agree byte for byte. The JVM's IBM500 reads 0x15 (EBCDIC NL) as U+000A, the
    same as 0x25; Python's cp500 reads it as U+0085. Spark's own ``decode``
    follows the JVM, so the JVM table is read from the running gateway when
    there is one, and Python's codec is used otherwise."""
    from pyspark.sql import SparkSession

    raw = bytes(range(256))
    spark = SparkSession.getActiveSession()
    native = None
    if spark is not None:
        try:
            native = spark.sparkContext._jvm.java.lang.String(bytearray(raw), codepage)
        except Exception:  # noqa: BLE001 - no gateway (e.g. Spark Connect): use Python's table
            native = None
    if native is None or len(native) != 256:
        native = raw.decode(codepage)
    latin = raw.decode("latin-1")
    pairs = [(a, b) for a, b in zip(latin, native) if a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


JAVA_CHARSETS_CONF = "spark.sql.legacy.javaCharsets"


def java_charsets_enabled() -> bool:
    """True when the active session lets ``decode``/``encode`` use any JVM charset."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    if spark is None:
        return False
    try:
        return str(spark.conf.get(JAVA_CHARSETS_CONF, "false")).lower() == "true"
    except Exception:  # noqa: BLE001 - conf unknown on other versions
        return False


def ebcdic_decode(c, codepage: str = "cp500", method: str = "auto") -> Column:
    """Bytes in an EBCDIC code page -> string.

    ``method="charset"`` uses the JVM's decoder (fastest). Spark 4 only allows
    it when ``spark.sql.legacy.javaCharsets`` is true; ``build_session`` sets
    that. ``method="translate"`` works on any session: the bytes are read as
    Latin-1 and re-mapped character by character. ``auto`` picks the
    charset path when the active session allows it. Both give the same text.
    """
    if method == "charset" or (method == "auto" and java_charsets_enabled()):
        return F.decode(_col(c), codepage)
    latin, native = _decode_pairs(codepage)
    return F.translate(F.decode(_col(c), "ISO-8859-1"), latin, native)


def ebcdic_encode(c, codepage: str = "cp500", method: str = "auto") -> Column:
    """String -> bytes in an EBCDIC code page (E2), as a producer writes them.

    Follows Python's codec (the legacy producer's encoder), whose table is a
    permutation: LF becomes 0x25. ``method="charset"`` uses the JVM encoder
    instead, which writes LF as 0x15. Text without control characters is
    the same either way.
    """
    if method == "charset":
        return F.encode(_col(c), codepage)
    latin, native = _code_page_pairs(codepage)
    return F.encode(F.translate(_col(c), native, latin), "ISO-8859-1")


def encode_text_field(c, length: int, codepage: str = "cp500", name: str = "field") -> Column:
    """Space-pad a string to ``length`` characters and encode it; longer input fails the job
    instead of being cut silently."""
    c = _col(c)
    padded = F.when(F.length(c) <= length, F.rpad(c, length, " ")).otherwise(
        F.raise_error(F.concat(F.lit(f"{name} longer than {length} characters: "), c)))
    return ebcdic_encode(padded, codepage)


# --------------------------------------------------------------- COMP-3

def comp3_decode_lenient(c, digits: int = 9, scale: int = 2) -> Column:
    """COMP-3 -> double, parity mode.

    Digit nibbles are read as values 0-15 (an A-F "digit" is not rejected),
    weighted by powers of ten; the value is negative only when the sign
    nibble is ``D``; the result is divided by ``10**scale`` as a double. A
    field of the wrong width (or NULL) gives NULL.

    A digit d >= 10 contributes (d - 10) at its own place plus 1 at the next
    place up, so the sum is two plain decimal parses of the digit string:
    A-F mapped to 0-5, plus ten times the 0/1 "was A-F" string. This keeps
    the expression small enough to stay cheap when Catalyst inlines it into
    several filters.
    """
    c = _col(c)
    nbytes = (digits + 2) // 2
    if digits > 17:
        raise ValueError("lenient COMP-3 decode supports at most 17 digits")
    h = F.hex(c)
    body = F.substring(h, 1, digits)
    low = F.translate(body, "ABCDEF", "012345").cast("long")
    carry = F.translate(body, "0123456789ABCDEF", "0000000000111111").cast("long")
    value = (low + carry * F.lit(10)).cast("double")
    sign = F.when(F.substring(h, 2 * nbytes, 1) == F.lit("D"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(F.length(c) == nbytes, (value * sign) / F.lit(float(10 ** scale)))


def comp3_decode_strict(c, digits: int = 9, scale: int = 2) -> Column:
    """COMP-3 -> decimal(digits, scale), strict mode.

    Digits must be 0-9 and the sign nibble A-F (B and D negative); anything
    else, a wrong width or NULL gives NULL, which routes the record to the
    structural dead-letter queue.
    """
    c = _col(c)
    h = F.hex(c)
    ok = h.rlike(f"^[0-9]{{{digits}}}[A-F]$")
    magnitude = F.substring(h, 1, digits).cast(f"decimal({digits},0)")
    negative = F.substring(h, digits + 1, 1).isin("B", "D")
    signed = F.when(negative, -magnitude).otherwise(magnitude)
    value = (signed / F.lit(10 ** scale)).cast(f"decimal({digits},{scale})")
    return F.when(ok, value)


def comp3_decode(c, digits: int = 9, scale: int = 2, strict: bool = False) -> Column:
    return (comp3_decode_strict if strict else comp3_decode_lenient)(c, digits, scale)


def comp3_encode(units, digits: int = 9) -> Column:
    """Integer in the smallest unit (e.g. cents) -> COMP-3 bytes, sign C/D (E5).

    A magnitude that needs more than ``digits`` digits fails the job.
    """
    units = _col(units).cast("long")
    mag = F.abs(units)
    body = F.when(mag < F.lit(10 ** digits), F.lpad(mag.cast("string"), digits, "0")).otherwise(
        F.raise_error(F.concat(F.lit(f"value needs more than {digits} digits: "), units.cast("string"))))
    sign = F.when(units < 0, F.lit("D")).otherwise(F.lit("C"))
    return F.unhex(F.concat(body, sign))



# ------------------------------------------------------------------ ids

def make_id(prefix: str, n, width: int) -> Column:
    """``prefix`` followed by ``n`` zero-padded to ``width`` digits (no truncation)."""
    return F.format_string(f"{prefix}%0{width}d", _col(n).cast("long"))
