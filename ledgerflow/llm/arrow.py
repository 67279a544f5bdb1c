"""Arrow-batch helper shared by the operators that compute columns in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Rows that one call of a compute function sees at most; bounds its memory beside the batch itself.
SLICE_ROWS = 1000


def with_columns(df: DataFrame, inputs: list[str], carry: list[str] | None, results: str,
                 compute: Callable[..., dict[str, object]], as_lists: bool = True) -> DataFrame:
    """Add ``results`` (a DDL string) computed from the columns ``inputs``.

    ``carry`` names the input columns to keep; ``None`` keeps all. A carried
    column whose name (ignoring case) is that of a result gives way to the
    result. Only carried and input columns are read. ``compute`` gets one
    Python list (or, unless ``as_lists``, an Arrow array) per input and returns
    one sequence or Arrow array per result. No shuffle; a lost task runs again
    from its input split.
    """
    added = T.StructType.fromDDL(results)
    new = {f.name.lower() for f in added}
    kept = [c for c in (df.columns if carry is None else carry) if c.lower() not in new]
    if len({c.lower() for c in kept}) < len(kept):
        raise ValueError(f"column names that differ only in case: {kept}")
    source = df.select(*[df[c] for c in kept], *[df[c].alias(f"__in{i}") for i, c in enumerate(inputs)])
    schema = T.StructType([f for f in source.schema if not f.name.startswith("__in")] + list(added))
    n_kept, names = len(kept), [f.name for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in added]
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                out = compute(*[c.to_pylist() if as_lists else c for c in batch.columns[n_kept:]])
                made = [out[name].cast(kind) if isinstance(out[name], pa.Array) else pa.array(out[name], type=kind)
                        for name, kind in zip(names, types)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n_kept], *made], names=[*kept, *names])
                del out, made
            pa.default_memory_pool().release_unused()  # reused workers would keep it

    return source.mapInArrow(run, schema)
