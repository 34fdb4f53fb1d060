"""Arrow batches in tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

#: Rows that a task turns into Python values at once.
ROWS = 512


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into short ones, so that what a task holds beside a batch does not grow with it."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    # what the batches took goes back to the machine, not to the worker's next task
    pa.default_memory_pool().release_unused()
