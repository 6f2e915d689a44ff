"""Near-duplicate groups by SuperMinHash signatures, banding, exact verification and union of the links.

SuperMinHash: every shingle draws its own permutation of the signature slots, one slot at a step. Step k offers the
slot it meets a value in [k, k+1), and a slot keeps the smallest. As one shingle never offers two values of a step to
the same slot, slots are negatively correlated and the estimate has less variance than independent minima. A text stops
once all its slots are filled: later steps could only offer larger values. Here all texts of a slice take a step
together, so the early stop is per text.

The rest is joins. Texts with equal sets are one class with one member that stands for it, however many there are.
Bands of the signature are buckets; each bucket names its smallest member, all others are compared with that one, on
their full sets. Where a bucket then still holds several components, its members outside the largest one meet all
others in blocks of bounded size, on sketches first and on their full sets where those come near the threshold; only links leave
a block. So no link of a bucket is lost, and none is looked for between members that are already connected. Bands follow
the threshold, so that a pair at it shares no bucket with a chance of 2 in a million (28 bands of 6 slots at 0.85, 34 of
5 at 0.8).

Defined cases: text that is NULL, empty or all white space has no shingle and is linked with nothing; fewer words than
a shingle are one shingle; rows that repeat a doc_id count as one document; a row whose doc_id is NULL is its own
group, with component NULL, and kept. Sets are sets of 64-bit hashes of the shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, remove_cut
from .batches import slices
from .components import components
from .shingles import mix, shared_counts, shingle_sets

#: Chance that a pair at the threshold shares no bucket, and slots of a signature that are affordable for it.
MISSED, SLOTS = 2e-6, 175


def bands_for(percent: int) -> tuple[int, int]:
    """Bands and slots a band: the most slots a band, so the fewest chance buckets, with which no more are missed.

    A low threshold that cannot be had with `SLOTS` takes single slots, as many as it needs."""
    for rows in range(12, 0, -1):
        bands = bands_needed(percent, rows)
        if bands * rows <= SLOTS or rows == 1:
            return bands, rows
    raise AssertionError


def bands_needed(percent: int, rows: int) -> int:
    same = min(0.999999, percent / 100) ** rows
    return max(1, math.ceil(math.log(MISSED) / math.log1p(-same)))


_UNSET = np.uint64(2**64 - 1)
_FEATURES = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, sketch binary"


def superminhash(found: np.ndarray, counts: np.ndarray, slots: int) -> np.ndarray:
    """Signatures (texts x slots) of shingle sets given one after another; texts without shingles stay unset.

    A value holds the step in its upper 8 bits and the random part below, so order is the order of step + fraction.
    """
    signature = np.full((len(counts), slots), _UNSET, dtype=np.uint64)
    flat = signature.reshape(-1)
    row = np.repeat(np.arange(len(counts)), counts)
    seed = found
    order = np.tile(np.arange(slots, dtype=np.uint8), (len(found), 1))
    for k in range(slots):
        if not len(row):
            break
        drawn = mix(seed + np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64))
        swap = k + (mix(drawn ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(slots - k)).astype(np.int64)
        at = np.arange(len(row))
        slot = order[at, swap]
        order[at, swap] = order[:, k]
        value = (np.uint64(k) << np.uint64(56)) | (drawn >> np.uint64(8))
        np.minimum.at(flat, row * slots + slot, value)
        open_rows = (signature == _UNSET).any(axis=1)
        stay = open_rows[row]
        if not stay.all():
            row, seed, order = row[stay], seed[stay], order[stay]
    return signature


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    bands = signature.shape[1] // rows
    keys = np.empty((len(signature), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, dtype=np.uint64)
        for slot in range(band * rows, (band + 1) * rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, slot])
        keys[:, band] = key
    return keys


def text_features(texts: list[str], width: int, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Set sizes, two halves of a fingerprint of the set, band keys, and one byte of each signature slot."""
    found, counts = shingle_sets(texts, width)
    signature = superminhash(found, counts, bands * rows)
    ends = np.concatenate([[0], np.cumsum(counts)])
    halves = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(found ^ np.uint64(salt)))])
        halves.append(mix(sums[ends[1:]] - sums[ends[:-1]] + counts.astype(np.uint64)))
    return counts, halves[0], halves[1], band_keys(signature, rows), (mix(signature) & np.uint64(255)).astype(np.uint8)


def features(documents: DataFrame, id: str, text: str, width: int, bands: int, slots: int) -> DataFrame:
    """Per row: set size, set fingerprint, band keys and sketch; no text goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column("body"), 1_000_000):
                counts, a, b, keys, sketch = text_features(part, width, bands, slots)
                keys = pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1).view(np.int64)), bands)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(part)), pa.array(counts.astype(np.int64)),
                        pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), keys.cast(pa.list_(pa.int64())),
                        pa.array([s.tobytes() for s in sketch], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
                )
                at += len(part)

    rows = documents.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("body"))
    return rows.mapInArrow(run, _FEATURES)


def verified(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (u, v) whose full shingle sets hold 100 * shared >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column("body_u")):
                other = [t or "" for t in batch.column("body_v").slice(at, len(part)).to_pylist()]
                shared, left, right = shared_counts(part, other, width)
                good = (shared > 0) & (100 * shared >= percent * (left + right - shared))
                yield batch.slice(at, len(part)).filter(pa.array(good)).select(["u", "v"])
                at += len(part)

    body_u = texts.select(F.col("doc_id").alias("u"), F.col("body").alias("body_u"))
    body_v = texts.select(F.col("doc_id").alias("v"), F.col("body").alias("body_v"))
    return pairs.join(body_u, "u").join(body_v, "v").select("u", "v", "body_u", "body_v").mapInArrow(run, "u bigint, v bigint")


def _links_of_blocks(percent: int, width: int, slots: int):
    """Links between members of one bucket in different components; a pair counts in its first shared bucket only."""
    share = percent / 100
    least = share - 5 * (share * (1 - share) / slots) ** 0.5  # five standard errors below the threshold

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids, component, row, column = (group[c].to_numpy() for c in ("node", "component", "row", "column"))
        key, block = int(group["key"].iloc[0]), int(group["block"].iloc[0])
        sketch = np.frombuffer(b"".join(group["sketch"]), dtype=np.uint8).reshape(len(group), -1)
        bands = np.stack(group["bands"].to_list())
        found, counts = shingle_sets(group["body"].fillna("").to_list(), width)
        ends = np.concatenate([[0], np.cumsum(counts)])
        links = []
        for i in np.flatnonzero(row == block >> 20):
            near = (component != component[i]) & (column == block & (1 << 20) - 1) & ((row < 0) | (ids > ids[i]))
            near &= 100 * np.minimum(counts, counts[i]) >= percent * np.maximum(counts, counts[i])
            others = np.flatnonzero(near)
            others = others[(sketch[others] == sketch[i]).mean(axis=1) >= least]
            same = bands[others] == bands[i]
            others = others[bands[i][same.argmax(axis=1)] == key] if len(others) else others
            if not len(others):
                continue
            own = found[ends[i] : ends[i + 1]]
            sets = [found[ends[j] : ends[j + 1]] for j in others]
            theirs = np.concatenate(sets)
            at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
            shared = np.add.reduceat((own[at] == theirs).astype(np.int64), np.cumsum([0, *map(len, sets[:-1])]))
            good = 100 * shared >= percent * (counts[i] + counts[others] - shared)
            links += [(min(ids[i], ids[j]), max(ids[i], ids[j])) for j in others[good]]
        return pd.DataFrame(sorted(set(links)), columns=["u", "v"], dtype="int64")

    return run


def dealt_to_blocks(placed: DataFrame, block: int) -> DataFrame:
    """Members (key, node, component, size) of buckets with several components, once for each block they are needed in.

    Members of a bucket's largest component need not meet each other, so only those outside it (`row` from 0 on) go to
    every column of blocks, all members go to one column (in every row of blocks). Two members of different components
    meet as row and column, of two outside it the smaller node as row.
    """
    counts = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("n"), F.count("*").alias("components")
    )
    mixed = main.where("components > 1").select("key", "main", "n")
    members = placed.join(mixed, "key").where("size > 2")  # of two, both were compared
    outside, hashed = F.col("component") != F.col("main"), F.xxhash64("node")
    rows, columns = F.ceil((F.col("size") - F.col("n")) / block).cast("int"), F.ceil(F.col("size") / block).cast("int")
    at = members.withColumns(
        {
            "rows": rows, "columns": columns, "column": F.pmod(hashed, columns).cast("int"),
            "row": F.when(outside, F.pmod(hashed, rows)).otherwise(F.lit(-1)).cast("int"),
        }
    )
    name = lambda row, column: F.shiftleft(row.cast("bigint"), 20) + column
    down = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda r: name(r, F.col("column")))
    across = F.transform(F.sequence(F.lit(0), F.col("columns") - 1), lambda c: name(F.col("row"), c))
    blocks = F.when(F.col("row") < 0, down).otherwise(F.array_union(down, across))
    return at.select("key", "node", "component", "row", "column", F.explode(blocks).alias("block"))


def near_duplicates(
    documents: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 85, width: int = 5, block: int = 300,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id that links lead to), kept (doc_id is that one).

    `block` bounds the members of a bucket that one task compares with each other.
    """
    bands, slots = bands_for(percent)
    rows = cut_lineage(features(documents, id, text, width, bands, slots), "features")
    sets = rows.where("n_shingles > 0 and doc_id is not null")
    classes = cut_lineage(sets.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"), F.count("*").alias("size")), "classes")
    stand_for = classes.select(F.col("node").alias("doc_id")).distinct()
    nodes = cut_lineage(
        sets.join(stand_for, "doc_id").select(F.col("doc_id").alias("node"), "bands", "sketch", "n_shingles").dropDuplicates(["node", "bands"]),
        "nodes",
    )
    texts = documents.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("body"))
    entries = nodes.select("node", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last"), F.count("*").alias("size"))
    crowded = cut_lineage(buckets.where("lead != last"), "buckets")
    members = cut_lineage(entries.join(crowded, "key").select("key", "node", "lead", "size"), "members")
    stars = members.where("node != lead").select(F.col("lead").alias("u"), F.col("node").alias("v")).distinct()
    links = cut_lineage(verified(stars, texts, percent, width), "links")
    labels = components(links)
    placed = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    blocks = dealt_to_blocks(placed, block).join(nodes.select("node", "bands", "sketch"), "node").join(texts.withColumnRenamed("doc_id", "node"), "node")
    more = blocks.groupBy("key", "block").applyInPandas(_links_of_blocks(percent, width, bands * slots), "u bigint, v bigint")
    links = links.unionByName(cut_lineage(more, "more"))
    labels = components(links)
    grouped = classes.join(labels, "node", "left").select("set_a", "set_b", F.coalesce("component", "node").alias("component_id"))
    remove_cut(members)
    result = rows.select("doc_id", "n_shingles", "set_a", "set_b").join(grouped, ["set_a", "set_b"], "left")
    own = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component_id")), F.col("doc_id"))
    return result.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))
