"""Cutting Arrow batches of texts so that what a task holds at once stays small."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of ``text``, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n) + 1
        if start < batch.num_rows:
            yield batch.slice(start)
