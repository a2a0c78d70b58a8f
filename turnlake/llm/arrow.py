"""Arrow batches inside Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Texts that a task holds decoded at once; a single longer text is handled alone.
BATCH_BYTES = 8 << 20


def text_slices(batches: Iterator[pa.RecordBatch], text_column: int) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in slices whose texts have about :data:`BATCH_BYTES` together."""
    for batch in batches:
        start = used = 0
        for i, n in enumerate(pa.compute.binary_length(batch.column(text_column)).to_pylist()):
            used += n or 0
            if used >= BATCH_BYTES:
                yield batch.slice(start, i + 1 - start)
                start, used = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: int) -> Iterator[str]:
    """The column's texts one at a time; null counts as empty."""
    for x in batch.column(column):
        yield x.as_py() or ""
