"""Collocations by relational mining of occurrences (SETM): phrases of two words and more that stand together often.

The occurrence relation of length k holds (place, phrase) sorted by place, for all phrases that are frequent. Words
of one piece of text have successive places, and a place is left free between pieces. The relation is a written table;
one row packs the places of some megabytes of text of one group (language), so that it holds whole pieces of text.

From length k to k + 1:
1. merge-join: an occurrence at place p and the one at place p + 1 make an occurrence of k + 1 words. Both sides are the
   same sorted rows, so the match of a row is the row after it, and nothing shuffles;
2. group-count: each row's distinct candidates with their counts go to the bucket of the candidate, which adds them up.
   The number of buckets follows the number of occurrences, so a bucket has a bounded size; a phrase that a third of all
   rows hold comes to its bucket once a row of the relation;
3. semi-join: a bucket answers each row of the relation with its candidates that are frequent, and the row keeps these
   occurrences alone. They are written as the next relation.
A candidate's first and last part are frequent if it is, so no phrase is lost. All counts are of whole texts.

Scores compare a phrase with the counts of its two parts, at the cut where it holds together least. Sums and products
that may pass 64 bits are decimal.

Defined cases: text that is NULL or empty has no words; a NULL group is `und`, as a group of that name is; rows that repeat count
each; tables without a frequent phrase give no rows; further columns take no part.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, remove_cut
from .packed import pack, piece_name, unpack

#: Fixed: characters that end a piece of text; the byte that stands for them occurs in no text.
ENDS, END = b".,;:!?\n\x0b\x0c\r", b"\xff"
_TABLE = bytes(0xFF if b in ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes of text whose occurrences make one row of a relation, and those that are split into words at once.
ROW_BYTES, CHUNK_BYTES = 16_000_000, 1_000_000
#: Occurrences whose candidates make one bucket.
BUCKET_ROWS = 1 << 21

_RELATION = "row string, lang string, n long, places binary, at binary, ids binary"
_VOTES = "row string, at binary, ids binary, id long, lang string, word string, left long, right long, f long"


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, with `END` between pieces, some at a time; a list ends where a piece does."""
    data = text.encode().translate(_TABLE)
    start = 0
    while start < len(data):
        stop = data.find(END, start + CHUNK_BYTES)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].replace(END, b" \xff ").split()
        start = stop


class _Words:
    """Words of one group: numbers in order of first use, from 1; 0 ends a piece."""

    def __init__(self) -> None:
        self.index: defaultdict[bytes, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.index[END] = 0
        self.parts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.array([*map(self.index.__getitem__, words), 0], dtype=np.int32))
        self.bytes += sum(map(len, words))

    def row(self, name: str, lang: str) -> pa.RecordBatch:
        every = np.concatenate(self.parts)
        places = np.flatnonzero(every).astype(np.int64)
        words = pa.array(list(self.index)[1:], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_pydict(
            {
                "row": [name], "lang": [lang], "n": pa.array([len(places)], pa.int64()),
                "places": pa.array([_places(places)], pa.binary()), "at": pa.array([pack(every[places] - 1)], pa.binary()),
                "words": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
            }
        )


def _places(places: np.ndarray) -> bytes:
    return pack(np.diff(places, prepend=0).astype(np.int32))


def _read_places(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.int32), dtype=np.int64)


def _words(rows: DataFrame) -> DataFrame:
    """Rows of the relation of single words, before it is known which are frequent; of (lang, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: defaultdict[str, _Words] = defaultdict(_Words)
        number = held = 0
        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                for words in words_of(body.as_py() or ""):
                    own = open_rows[lang]
                    held -= own.bytes
                    own.add(words)
                    held += own.bytes
                    while held >= ROW_BYTES:  # of all groups together, the largest first
                        full = max(open_rows, key=lambda k: open_rows[k].bytes)
                        held -= open_rows[full].bytes
                        yield open_rows.pop(full).row(piece_name(number), full)
                        number += 1
        for lang, own in open_rows.items():
            yield own.row(piece_name(number), lang)
            number += 1

    return rows.mapInArrow(run, "row string, lang string, n long, places binary, at binary, words array<string>")


def neighbours(places: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of the sorted relation with itself on place + 1: places, and the left and right phrase of each match."""
    first = np.flatnonzero(np.diff(places) == 1)
    return places[first], at[first], at[first + 1]


def _candidates(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the candidates of a row, and left and right as one number of its own phrases."""
    ids = unpack(row["ids"], np.int64)
    places, left, right = neighbours(_read_places(row["places"]), unpack(row["at"], np.int32).astype(np.int64))
    return places, left * len(ids) + right, ids


def _parts(bucket: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The buckets that occur, and for each where."""
    order = np.argsort(bucket, kind="stable")
    present, starts = np.unique(bucket[order], return_index=True)
    return present, np.split(order, starts[1:])


def _count_words(words: DataFrame, buckets: int, least: int) -> DataFrame:
    """Group-count of single words."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = row["words"]
                seed = zlib.crc32(row["lang"].encode())
                bucket = np.fromiter((zlib.crc32(w.encode(), seed) for w in found), np.int64, len(found)) % buckets
                counts = np.bincount(unpack(row["at"], np.int32), minlength=len(found))
                present, parts = _parts(bucket)
                if len(found):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": pa.array(present, pa.int64()), "row": [row["row"]] * len(parts), "lang": [row["lang"]] * len(parts),
                            "at": pa.array([pack(p.astype(np.int32)) for p in parts], pa.binary()),
                            "words": pa.array([[found[i] for i in p] for p in parts], pa.list_(pa.string())),
                            "counts": pa.array([pack(counts[p]) for p in parts], pa.binary()),
                        }
                    )

    def count(group: pa.Table) -> pa.Table:
        rows = group.select(["row", "lang", "at", "counts"]).to_pylist()
        each = pc.list_value_length(group["words"]).to_numpy()
        lang = pa.array(np.repeat(group["lang"].to_numpy(), each), pa.string())
        keys = pc.binary_join_element_wise(lang, pc.list_flatten(group["words"]).combine_chunks(), "\0").dictionary_encode()
        total = np.bincount(keys.indices.to_numpy(), np.concatenate([unpack(r["counts"], np.int64) for r in rows])).astype(np.int64)
        names = [k.split("\0", 1) for k in keys.dictionary.to_pylist()]
        return _answer(group["bucket"][0].as_py(), buckets, rows, each, keys.indices.to_numpy(), total, least, names, None)

    rows = words.select("row", "lang", "at", "words").mapInArrow(
        split, "bucket long, row string, lang string, at binary, words array<string>, counts binary"
    )
    return rows.groupBy("bucket").applyInArrow(count, _VOTES)


def _count_phrases(relation: DataFrame, buckets: int, least: int) -> DataFrame:
    """Group-count of the candidates, each by the ids of its first and last part."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, pairs, ids = _candidates(row)
                pairs, counts = np.unique(pairs, return_counts=True)
                left, right = ids[pairs // len(ids)], ids[pairs % len(ids)]
                mixed = (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
                present, parts = _parts(((mixed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64))
                if len(pairs):
                    columns = {"at": np.arange(len(pairs), dtype=np.int32), "left": left, "right": right, "counts": counts}
                    yield pa.RecordBatch.from_pydict(
                        {"bucket": pa.array(present, pa.int64()), "row": [row["row"]] * len(parts), "lang": [row["lang"]] * len(parts)}
                        | {k: pa.array([pack(v[p]) for p in parts], pa.binary()) for k, v in columns.items()}
                    )

    def count(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        left, right, counts = (np.concatenate([unpack(r[k], np.int64) for r in rows]) for k in ("left", "right", "counts"))
        each = np.array([len(unpack(r["at"], np.int32)) for r in rows])
        order = np.lexsort((right, left))
        new = np.append(True, (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0))
        key = np.empty(len(order), dtype=np.int64)
        key[order] = np.cumsum(new) - 1
        total = np.add.reduceat(counts[order], np.flatnonzero(new))
        first = order[new]
        langs = np.repeat([r["lang"] for r in rows], each)[first].tolist()
        ends = np.stack([left[first], right[first]], axis=1)
        return _answer(rows[0]["bucket"], buckets, rows, each, key, total, least, [(x, None) for x in langs], ends)

    rows = relation.mapInArrow(split, "bucket long, row string, lang string, at binary, left binary, right binary, counts binary")
    return rows.groupBy("bucket").applyInArrow(count, _VOTES)


def _answer(bucket, buckets, rows, each, key, total, least, names, ends) -> pa.Table:
    """The frequent groups of a bucket, with ids no other bucket gives, and what each row of the relation keeps."""
    frequent = total >= least
    ids = np.where(frequent, bucket + buckets * (np.cumsum(frequent) - 1), -1)
    found = np.flatnonzero(frequent).tolist()
    kept = []
    for r, keys in zip(rows, np.split(key, np.cumsum(each)[:-1])):
        good = frequent[keys]
        if good.any():
            kept.append((r["row"], pack(unpack(r["at"], np.int32)[good]), pack(ids[keys[good]])))
    none, more = [None] * len(kept), [None] * len(found)
    return pa.table(
        {
            "row": pa.array([*(k[0] for k in kept), *more], pa.string()), "at": pa.array([*(k[1] for k in kept), *more], pa.binary()),
            "ids": pa.array([*(k[2] for k in kept), *more], pa.binary()), "id": pa.array([*none, *ids[found].tolist()], pa.int64()),
            "lang": pa.array([*none, *(names[i][0] for i in found)], pa.string()), "word": pa.array([*none, *(names[i][1] for i in found)], pa.string()),
            "left": pa.array([*none, *(more if ends is None else ends[found, 0].tolist())], pa.int64()),
            "right": pa.array([*none, *(more if ends is None else ends[found, 1].tolist())], pa.int64()),
            "f": pa.array([*none, *total[found].tolist()], pa.int64()),
        }
    )


def _semi_join(relation: DataFrame, votes: DataFrame) -> DataFrame:
    """The next relation: of the candidates of each row the occurrences of frequent ones."""
    single = "words" in relation.columns

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        answers = right.select(["at", "ids"]).to_pylist()
        for row in left.to_pylist() if answers else []:
            if single:
                places, each = _read_places(row["places"]), unpack(row["at"], np.int32)
                size = len(row["words"])
            else:
                places, pairs, _ = _candidates(row)
                found, each = np.unique(pairs, return_inverse=True)
                size = len(found)
            asked = np.concatenate([unpack(a["at"], np.int32) for a in answers])
            new = np.full(size, -1, dtype=np.int32)
            new[asked] = np.arange(len(asked))
            each = new[each]
            good = each >= 0
            ids = np.concatenate([unpack(a["ids"], np.int64) for a in answers])
            out.append((row["row"], row["lang"], int(good.sum()), _places(places[good]), pack(each[good]), pack(ids)))
        kinds = [pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        names = ["row", "lang", "n", "places", "at", "ids"]
        return pa.table({n: pa.array([r[i] for r in out], k) for i, (n, k) in enumerate(zip(names, kinds))})

    answers = votes.where("row is not null").select("row", "at", "ids")
    return relation.groupBy("row").cogroup(answers.groupBy("row")).applyInArrow(run, _RELATION)


def frequent_phrases(rows: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to `longest` words with f >= least, and (lang, n); of (lang, body)."""
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = lambda size: max(spread, -(-size // BUCKET_ROWS))
    relation = cut_lineage(_words(rows), "occurrences-0")
    every = cut_lineage(relation.groupBy("lang").agg(F.sum("n").alias("n")), "words")
    size = relation.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0  # one number
    votes = cut_lineage(_count_words(relation, buckets(size), least), "votes-1")
    level = votes.where("row is null").select("id", "lang", F.col("word").alias("phrase"), "f")
    levels = [level]
    for length in range(2, longest + 1):
        following = cut_lineage(_semi_join(relation, votes), f"occurrences-{length - 1}")
        remove_cut(relation)
        relation = following
        size = relation.agg(F.sum("n")).first()[0] or 0  # one number
        votes = cut_lineage(_count_phrases(relation, buckets(size), least), f"votes-{length}")
        first = level.select(F.col("id").alias("left"), F.col("phrase").alias("start"))
        last = level.select(F.col("id").alias("right"), F.substring_index("phrase", " ", -1).alias("end"))
        found = votes.where("row is null").select("id", "lang", "left", "right", "f").join(first, "left").join(last, "right")
        level = cut_lineage(found.select("id", "lang", F.concat_ws(" ", "start", "end").alias("phrase"), "f"), f"phrases-{length}")
        levels.append(level)
    remove_cut(relation)
    all_levels = [x.select("lang", "phrase", F.lit(k).alias("words"), "f") for k, x in enumerate(levels, 1)]
    out = all_levels[0]
    for x in all_levels[1:]:
        out = out.unionByName(x)
    return out, every


def collocations(
    documents: DataFrame, text: str = "text", group: str | Column = "lang", longest: int = 4, least: int = 30, share: int = 80, first: int = 2000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each group the `first` phrases by score.

    a: how often the phrase occurs; l, r: the same of its parts at the cut with the lowest score; n: all words of the
    group; score: 2,000,000 a / (l + r), rounded down. A phrase inside a longer one that occurs `share` percent as
    often at least is left out.
    """
    named = F.coalesce((F.col(group) if isinstance(group, str) else group).cast("string"), F.lit("und"))
    found, every = frequent_phrases(documents.select(named.alias("lang"), F.col(text).alias("body")), longest, least)
    found = cut_lineage(found, "phrases")
    words = F.split("phrase", " ", -1)
    part = lambda start, size: F.array_join(F.slice(words, start, size), " ")
    longer = found.where("words > 1")
    cuts = longer.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.withColumns({"begin": part(F.lit(1), F.col("cut")), "rest": part(F.col("cut") + 1, F.col("words") - F.col("cut"))})
    begin = found.select("lang", F.col("phrase").alias("begin"), F.col("f").alias("l"))
    rest = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(begin, ["lang", "begin"]).join(rest, ["lang", "rest"]).withColumn(
        "score", F.expr("cast(2000000 * cast(a as decimal(20, 0)) div (l + r) as bigint)")
    )
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    places = F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at")
    inside = longer.where("words > 2").select("lang", "phrase", "f", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    inside = inside.select("lang", "phrase", "f", "size", places).select("lang", part(F.col("at"), F.col("size")).alias("phrase"), "f")
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("whole"))
    often = F.expr(f"100 * cast(whole as decimal(20, 0)) >= {int(share)} * cast(a as decimal(20, 0))")
    left = best.join(inside, ["lang", "phrase"], "left").where(F.col("whole").isNull() | ~often)
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    # one row a group
    return ranked.join(every, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score")
    )
