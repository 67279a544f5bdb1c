"""General scalar helpers (X9-X18) written as Spark column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col as _col

# Binary scale used by the exact rounding below: a double in [0, 2) times
# 2**62 is an exact integer below 2**63 for every value that can sit near a
# rounding boundary at up to 6 decimal places.
_SCALE_BITS = 62


def clamp01(c) -> Column:
    """``min(max(c, 0), 1)`` of a number (X9); NULL and NaN give NULL, so that a contract rejects the row."""
    v = _col(c)
    return F.when(v.isNotNull() & ~F.isnan(v), F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)))


def _scaled_half_even(v: Column, places: int) -> Column:
    """round-half-even of the *exact binary value* of ``v`` at ``places`` decimals,
    returned as a long scaled by 10**places. Valid for 0 <= v < 2.

    Spark's ``round``/``format_string`` round half-up on the shortest decimal
    form (0.285 -> 0.29), while Python and DuckDB round the exact binary value
    (0.285 is 0.28499999... -> 0.28). Integer arithmetic on ``v * 2**62`` gives
    the exact answer without leaving the JVM.
    """
    den = F.lit(2 ** _SCALE_BITS).cast("decimal(38,0)")
    n = (v * F.lit(float(2 ** _SCALE_BITS))).cast("long").cast("decimal(38,0)")
    num = n * F.lit(10 ** places).cast("decimal(38,0)")
    rem = F.pmod(num, den)
    k = ((num - rem) / den).cast("long")
    up = (rem * 2 > den) | ((rem * 2 == den) & (k % 2 == 1))
    return k + F.when(up, F.lit(1)).otherwise(F.lit(0))


def in_score_domain(c) -> Column:
    """Whether a value is a score that the rounding below takes: 0 <= x < 2."""
    v = _col(c).cast("double")
    return (v >= 0.0) & (v < 2.0)


def _score_only(v: Column, name: str, result: Column) -> Column:
    """``result`` for scores, NULL for NULL, an error for any other number."""
    return F.when(v.isNull(), F.lit(None)).when(in_score_domain(v), result).otherwise(
        F.raise_error(F.lit(f"{name} takes scores in [0, 2) only")))


def round_score(c, places: int) -> Column:
    """Python's ``round(x, places)`` of a score in [0, 2) (X11); any other number is an error."""
    v = _col(c).cast("double")
    return _score_only(v, "round_score", _scaled_half_even(v, places).cast("double") / F.lit(float(10 ** places)))


def format_score(c, places: int = 2) -> Column:
    """Python's ``f"{x:.{places}f}"`` of a score in [0, 2) (X12); any other number is an error."""
    v = _col(c).cast("double")
    k = _scaled_half_even(v, places)
    unit = 10 ** places
    return _score_only(v, "format_score", F.format_string(f"%d.%0{places}d", (k / unit).cast("long"), k % unit))


def fmt_thousands(c) -> Column:
    """Python's ``f"{n:,}"`` for integers."""
    return F.format_number(_col(c).cast("long"), 0)


def context_id(run_id: str, key, prefix: str = "graph-ctx-", width: int = 12) -> Column:
    """Deterministic lineage id (X14): ``prefix`` + first ``width`` hex chars of
    sha256(run_id || key). Stable under task retries, unlike a random uuid."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat(F.lit(run_id), _col(key)), 256), 1, width))


def run_ts(ts: _dt.datetime | str | None = None) -> Column:
    """One snapshot timestamp per run (X15), as a naive (NTZ) timestamp."""
    if ts is None:
        ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if isinstance(ts, _dt.datetime):
        ts = ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(ts).cast("timestamp_ntz")


RATIONALE_JSON_SCHEMA = "semantic_confidence double, rationale string"


def parse_rationale(json_col, default_confidence: float = 0.90,
                    default_text: str = "No reasoning provided.") -> Column:
    """Parse a provider's JSON answer with defaults for missing keys."""
    parsed = F.from_json(_col(json_col), RATIONALE_JSON_SCHEMA)
    return F.struct(
        F.coalesce(parsed["semantic_confidence"], F.lit(default_confidence)).alias("semantic_confidence"),
        F.coalesce(parsed["rationale"], F.lit(default_text)).alias("rationale"),
    )
