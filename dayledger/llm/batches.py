"""Helpers of the operators that run numpy code over Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task looks at together; a longer single text is taken alone.
SLICE_BYTES = 2_000_000


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[list[str]]:
    """The texts in order, in lists of at most `limit` bytes (one text at least); NULL as the empty text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield [t or "" for t in texts.slice(start, i - start).to_pylist()]
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield [t or "" for t in texts.slice(start).to_pylist()]
