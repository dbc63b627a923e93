"""Arrow batches cut by bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4_000_000


def by_bytes(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows of batch in slices whose ``column`` holds at most ``most`` bytes; a row over that is a slice of its own. Nothing is copied."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        end = max(int(np.searchsorted(ends, ends[at] - size[at] + most, side="right")), at + 1)
        yield batch.slice(at, end - at)
        at = end
