"""Removal of lines that several documents hold, all but those of the first document, by two Bloom filters.

1. One scan cuts the documents into pieces of `piece_lines` lines and writes a table of them: for each line key of a
   document its SHA-256 and the document's id, no text.
2. Eight bytes of each key, once a piece, go to one of many segments of the hash space. A segment fills two Bloom
   filters, of hashes seen once and of those seen again, and answers each piece with its hashes that the second filter
   holds. The number of segments follows the number of lines, so a filter has a bounded size whatever the input; the
   filters never leave their task. A line that a third of the documents hold is one hash a piece.
3. Only the suspected keys shuffle in full, one row a piece and key with the documents there: the smallest and largest
   id of a key settle exactly whether two documents hold it, and which is the first.
4. The keys that a document loses join it by its id, and its lines are looked at once more.

Defined cases: a NULL or empty text is one empty line; lines end at \\n alone; a key shorter than `least` code points is
never dropped; rows of one id are one document, and so are the rows with a NULL id, which comes after all others (as
2^63 - 1 does); lines that repeat in one document alone stay; a text that loses all its lines becomes empty. Further
columns go through; `n_lines` and `n_dropped` of the input are replaced.
"""

from __future__ import annotations

import hashlib
import io
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, remove_cut
from .packed import free_name, pack, piece_name, unpack

#: Lines whose digests make one row of the table of pieces (40 bytes each).
PIECE_LINES = 65_536
#: Hashes of one segment, and so of one pair of filters.
SEGMENT_LINES = 1 << 20
#: Places in a filter for each hash that comes to it, and places that a hash sets.
FILTER_PLACES, FILTER_MARKS = 10, 4
_LAST = 2**63 - 1
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def line_key(line: bytes, least: int) -> bytes | None:
    """The key of a line in UTF-8; None if it has fewer than `least` code points."""
    key = line.strip(b" \t\n\x0b\x0c\r").lower()  # of bytes: A-Z alone
    return key if len(key) >= 4 * least or len(key) >= least and len(key.decode()) >= least else None


class Bloom:
    """A filter of 64-bit hashes; a byte for each place, as numpy sets bytes at once."""

    def __init__(self, hashes: int):
        self.bits = max(10, (hashes * FILTER_PLACES).bit_length())
        self.set = np.zeros(1 << self.bits, dtype=bool)

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        for odd in _ODD[:FILTER_MARKS]:
            mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(odd)
            yield mixed >> np.uint64(64 - self.bits)

    def add(self, hashes: np.ndarray) -> None:
        for places in self._places(hashes):
            self.set[places] = True

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for places in self._places(hashes):
            found &= self.set[places]
        return found


def suspects_of(pieces: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Of each piece (its hashes, each once, and whether it holds them twice) those that some other document may hold."""
    total = sum(len(hashes) for hashes, _ in pieces)
    once, twice = Bloom(total), Bloom(total)
    for hashes, again in pieces:
        twice.add(hashes[again | once.holds(hashes)])
        once.add(hashes)
    return [hashes[twice.holds(hashes)] for hashes, _ in pieces]


def _hashes(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, "<u8")[::4]


def _pieces(rows: DataFrame, least: int, piece_lines: int) -> DataFrame:
    """(piece, n, ids, digests) of (id, body): each key once a document and piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[bytes, int]] = set()
        number = 0

        def full() -> pa.RecordBatch:
            rows = sorted(found)
            found.clear()
            digests = b"".join(d for d, _ in rows)
            return pa.RecordBatch.from_pydict(
                {"piece": [piece_name(number)], "n": pa.array([len(rows)], pa.int64()), "ids": pa.array([[i for _, i in rows]], pa.list_(pa.int64())), "digests": pa.array([digests], pa.binary())}
            )

        for batch in batches:
            for id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                for line in io.BytesIO((body.as_py() or "").encode()):
                    key = line_key(line, least)
                    if key is not None:
                        found.add((hashlib.sha256(key).digest(), id))
                        if len(found) >= piece_lines:
                            yield full()
                            number += 1
        if found:
            yield full()

    return rows.mapInArrow(run, "piece string, n long, ids array<long>, digests binary")


def _suspected(pieces: DataFrame, segments: int) -> DataFrame:
    """(piece, hashes): what the filters of the segments say of each piece."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, digests in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes, times = np.unique(_hashes(digests.as_py()), return_counts=True)
                segment = (hashes % np.uint64(segments)).astype(np.int64)
                order = np.argsort(segment, kind="stable")
                present, starts = np.unique(segment[order], return_index=True)
                parts = np.split(order, starts[1:])
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": pa.array(present, pa.int64()), "piece": [piece] * len(parts),
                        "hashes": pa.array([pack(hashes[p]) for p in parts], pa.binary()),
                        "again": pa.array([pack(times[p] > 1) for p in parts], pa.binary()),
                    }
                )

    def filters(group: pa.Table) -> pa.Table:
        group = group.sort_by("piece")
        rows = [(unpack(h, "<u8"), unpack(a, bool)) for h, a in zip(group["hashes"].to_pylist(), group["again"].to_pylist())]
        kept = [(p, pack(s)) for p, s in zip(group["piece"].to_pylist(), suspects_of(rows)) if len(s)]
        return pa.table({"piece": pa.array([p for p, _ in kept], pa.string()), "hashes": pa.array([s for _, s in kept], pa.binary())})

    rows = pieces.select("piece", "digests").mapInArrow(split, "segment long, piece string, hashes binary, again binary")
    return rows.groupBy("segment").applyInArrow(filters, "piece string, hashes binary")


def _suspect_lines(pieces: DataFrame, suspected: DataFrame) -> DataFrame:
    """(digest, least, most, ids): the suspected keys in full, one row a piece and key with its documents there."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[bytes, list[int]] = defaultdict(list)
        if len(right):
            asked = np.concatenate([unpack(h, "<u8") for h in right["hashes"].to_pylist()])
            for row in left.to_pylist():
                for at in np.flatnonzero(np.isin(_hashes(row["digests"]), asked)):
                    found[row["digests"][32 * at : 32 * at + 32]].append(row["ids"][at])
        ids = list(found.values())
        return pa.table(
            {
                "digest": pa.array(list(found), pa.binary()), "least": pa.array([min(i) for i in ids], pa.int64()),
                "most": pa.array([max(i) for i in ids], pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64())),
            }
        )

    left = pieces.select("piece", "ids", "digests").groupBy("piece")
    return left.cogroup(suspected.groupBy("piece")).applyInArrow(run, "digest binary, least long, most long, ids array<long>")


def repeated_keys(rows: DataFrame, least: int, piece_lines: int = PIECE_LINES, segment_lines: int = SEGMENT_LINES) -> DataFrame:
    """(id, digests) of (id, body): SHA-256 of the keys that a document loses; documents that lose none have no row."""
    pieces = cut_lineage(_pieces(rows, least, piece_lines), "line-pieces")
    lines = pieces.agg(F.sum("n")).first()[0] or 0  # one number
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    suspected = _suspected(pieces, max(spread, -(-lines // segment_lines)))
    lines = cut_lineage(_suspect_lines(pieces, suspected), "suspect-lines")
    remove_cut(pieces)
    first = lines.groupBy("digest").agg(F.min("least").alias("first"), F.max("most").alias("last")).where("first < last")
    lost = lines.join(first, "digest").select(F.explode("ids").alias("id"), "digest", "first").where("id <> first")
    # no more than the document has lines
    return lost.groupBy("id").agg(F.collect_set("digest").alias("digests"))


def keep_lines(text: str, gone: set[bytes], least: int) -> tuple[int, int, str]:
    """Number of lines, number of those dropped, and the text that stays."""
    lines = text.encode().split(b"\n")
    if not gone:
        return len(lines), 0, text
    kept = [x for x in lines if (key := line_key(x, least)) is None or hashlib.sha256(key).digest() not in gone]
    return len(lines), len(lines) - len(kept), b"\n".join(kept).decode()


def drop_repeated_lines(
    documents: DataFrame, id: str | Column = "doc_id", text: str = "text", least: int = 10,
    piece_lines: int = PIECE_LINES, segment_lines: int = SEGMENT_LINES,
) -> DataFrame:
    """`documents` with the lines of `text` that stay, and `n_lines` (before) and `n_dropped`."""
    kept = documents.drop("n_lines", "n_dropped")
    named = F.coalesce((F.col(id) if isinstance(id, str) else id).cast("bigint"), F.lit(_LAST))
    lost = repeated_keys(kept.select(named.alias("id"), F.col(text).alias("body")), least, piece_lines, segment_lines)
    names = kept.columns
    key, gone = free_name(names, "id"), free_name(names, "digests")
    joined = kept.withColumn(key, named).join(lost.select(F.col("id").alias(key), F.col("digests").alias(gone)), key, "left").drop(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [keep_lines(t.as_py() or "", set(g.as_py() or ()), least) for t, g in zip(batch.column(text), batch.column(gone))]
            columns = [batch.column(c) if c != text else pa.array([r[2] for r in rows], pa.string()) for c in names]
            counts = [pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, *counts], [*names, "n_lines", "n_dropped"])

    fields = [T.StructField(f.name, T.StringType() if f.name == text else f.dataType) for f in kept.schema.fields]
    return joined.select(*(F.col(f"`{c}`") for c in [*names, gone])).mapInArrow(
        run, T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    )
