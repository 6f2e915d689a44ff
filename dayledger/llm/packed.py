"""Numeric arrays as compressed binary values, and names for pieces of a table that a task writes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(blob: bytes, kind: type | str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def piece_name(number: int) -> str:
    """A name for the `number`-th piece of this task; it becomes fixed when the table that holds it is written."""
    return f"{TaskContext.get().partitionId():x}-{number:x}"


def free_name(columns: list[str], wanted: str) -> str:
    """`wanted`, lengthened until no column has that name (letter case aside)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def no_rows(names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table({n: pa.array([], k) for n, k in zip(names, kinds)})
