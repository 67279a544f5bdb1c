"""The legacy fixture's packing of balances, needed to rebuild its golden run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions._util import col as _col


def comp3_encode_hex_quirk(n, length: int = 5) -> Column:
    """The legacy generator's packing, kept for fixtures only.

    It packs the *hexadecimal* digits of ``abs(n)`` followed by sign ``C``,
    left-padded with zero nibbles and cut to the last ``length`` bytes.
    """
    n = _col(n).cast("long")
    hexdigits = F.concat(F.repeat(F.lit("0"), 2 * length), F.hex(F.abs(n)), F.lit("C"))
    return F.unhex(F.substring(hexdigits, -2 * length, 2 * length))
