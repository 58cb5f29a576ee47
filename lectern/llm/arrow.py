"""Arrow batches in small parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batches: Iterator[pa.RecordBatch], sized: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of about ``limit`` bytes of column ``sized``, so that what is made of a part stays small; a row is never cut."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(sized)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def with_column(batch: pa.RecordBatch, name: str, values: list, kind: pa.DataType, *, drop: str | None = None) -> pa.RecordBatch:
    """``batch`` with one more column at its end, and without ``drop``."""
    kept = [n for n in batch.schema.names if n != drop]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(values, kind)], [*kept, name])
