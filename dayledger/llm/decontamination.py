"""Benchmark decontamination by SimHash windows, multi-index Hamming blocks and exact verification.

A passage is found if the weighted Jaccard similarity of its five-word shingles with a benchmark item (a shingle weighs
its letters times its occurrences) is 0.8 or more. It then holds at least that share of the item's weight. A cut through
the item (a word changed, left out or put in) costs the shingles across it, so `sure_run` can tell, exactly and for each
item, a number of words that stay together somewhere in the item whatever is cut within that loss. Windows of the largest
power of two up to that number lie along the item so closely that one of them is in each such run: an edit at any
place leaves a window with an equal fingerprint. (A passage that only repeats parts of the item, so that no shingle is lost
where it is cut, loses as many at the item's end.)

Windows of these sizes at every word of every document get a 64-bit SimHash. Fingerprints are cut into five
blocks: two that differ in at most three bits agree in two blocks at least, so the equality join on pairs of blocks,
followed by a count of the differing bits, finds all fingerprints within that radius. A document window goes into the join
only if one of its pairs occurs among the items'. That filter is a set of 4,194,304 bits per size and pair, whatever the
size of the benchmark.

A passage that holds the equal window starts at most the item's length before its end: all those starts are compared with
the item exactly, over as many words as the item has, and the best one is reported, of equal ones the first.

Defined cases: words are separated by ASCII white space, A-Z is lower-cased; text of fewer than five words is one
shingle; an item or document that is NULL or has no word matches nothing; items that repeat are reported each under
its id; document rows with the same id are judged on their own text, though a match of one is also tried on the
other; empty tables give no match; a NULL item_id is not reported.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batches import slices
from .shingles import word_hashes

RADIUS = 3
_WIDTH = 5
_CUTS = (0, 13, 26, 39, 52, 64)
_PAIRS = list(combinations(range(5), 2))
_SLOT_BITS, _SLOT_FACTOR = 22, 0x9E3779B1
#: Bits of one row of Spark's bitmap aggregate.
_BITMAP = 32768
_CHUNK = 8192
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def words(text: str) -> list[str]:
    return _WORD.findall(text.translate(_UPPER))


def size_of(n: int) -> int:
    """Window size for a run of n words: the largest power of two up to n."""
    return 1 << (n.bit_length() - 1) if n else 0


def sure_run(lengths: list[int], least: float) -> int:
    """Words that stay together in every passage which keeps `least` of the shingle weight of an item (letters of its words)."""
    n = len(lengths)
    if n <= _WIDTH:
        return n
    sums = [0]
    for i in range(n - _WIDTH + 1):
        sums.append(sums[-1] + sum(lengths[i : i + _WIDTH]))

    def kept(longest: int) -> int:
        """The most weight that an item cut into runs of at most `longest` words can keep."""
        best, starts = [0] * (n + 1), deque()
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            i = j - _WIDTH
            if i >= 0:
                while starts and best[starts[-1]] - sums[starts[-1]] <= best[i] - sums[i]:
                    starts.pop()
                starts.append(i)
                while starts[0] < j - longest:
                    starts.popleft()
                best[j] = max(best[j], best[starts[0]] - sums[starts[0]] + sums[i + 1])
        return best[n]

    low, high = _WIDTH, n
    while low < high:
        middle = (low + high + 1) // 2
        if kept(middle - 1) < least * sums[-1] * (1 - 1e-12):
            low = middle
        else:
            high = middle - 1
    return low


def window_fingerprints(hashes: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(size, first word, fingerprints of the windows from there on), chunk by chunk over a run of words."""
    for start in range(0, len(hashes), _CHUNK):
        stop = min(len(hashes), start + _CHUNK + max(sizes))
        own = np.ascontiguousarray(hashes[start:stop])
        signs = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1
        sums = np.zeros((len(own) + 1, 64), dtype=np.int32)
        np.cumsum(signs, axis=0, out=sums[1:])
        for size in sizes:
            n = min(_CHUNK, len(own) - size + 1)
            if n > 0:
                bits = sums[size : size + n] > sums[:n]
                yield size, start, np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]


def similarity(a: list[str], b: list[str], width: int = _WIDTH) -> float:
    """Weighted Jaccard similarity of the shingles of two word lists."""
    bags = []
    for w in (a, b):
        runs = [tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
        bags.append(Counter(runs))
    weight = lambda s: sum(map(len, s))
    both = sum(weight(s) * n for s, n in (bags[0] & bags[1]).items())
    either = sum(weight(s) * n for s, n in (bags[0] | bags[1]).items())
    return both / either if either else 0.0


def best_place(item: list[str], own: list[str], starts: list[int]) -> tuple[float, int]:
    """The highest similarity of `item` with as many words of `own` from one of `starts` (in order), and that start."""
    n, best = len(item), (0.0, 0)
    if n < _WIDTH:
        for p in starts:
            value = similarity(item, own[max(0, p) : p + n])
            best = (value, max(0, p)) if value > best[0] else best
        return best
    need = Counter(tuple(item[i : i + _WIDTH]) for i in range(n - _WIDTH + 1))
    weight = lambda s: sum(map(len, s))
    whole = sum(weight(s) * k for s, k in need.items())
    have: Counter = Counter()
    left = right = both = other = 0
    for p in starts:
        first, last = max(0, p), min(len(own), p + n) - _WIDTH + 1
        if first >= right:
            have.clear()
            left, right, both, other = first, first, 0, 0
        while right < last:
            s = tuple(own[right : right + _WIDTH])
            right, other = right + 1, other + weight(s)
            if s in need:
                have[s] += 1
                both += weight(s) if have[s] <= need[s] else 0
        while left < min(first, right):
            s = tuple(own[left : left + _WIDTH])
            left, other = left + 1, other - weight(s)
            if s in need:
                both -= weight(s) if have[s] <= need[s] else 0
                have[s] -= 1
        value = both / (whole + other - both)
        best = (value, first) if value > best[0] else best
    return best


def item_windows(items: DataFrame, least: float) -> DataFrame:
    """(item, n, size, offset, print) of (item, body): windows along each item, one in every run of `sure_run` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, body in zip(batch.column("item").to_pylist(), batch.column("body").to_pylist()):
                hashes, _ = word_hashes([body])
                n = len(hashes)
                sure = sure_run([len(w) for w in words(body)], least)
                size = size_of(sure)
                for offset in range(0, n - size + 1, sure - size + 1) if n else ():
                    _, _, prints = next(window_fingerprints(hashes[offset : offset + size], [size]))
                    rows.append((item, n, size, offset, int(prints[:1].view(np.int64)[0])))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["item", "n", "size", "offset", "print"])

    return items.mapInArrow(run, "item bigint, n bigint, size bigint, offset bigint, print bigint")


def _blocks(print_column: str) -> list[Column]:
    """The values of each pair of blocks of a fingerprint."""
    parts = [
        F.shiftrightunsigned(print_column, start).bitwiseAND(F.lit((1 << (stop - start)) - 1)) for start, stop in zip(_CUTS, _CUTS[1:])
    ]
    return [parts[a].bitwiseOR(F.shiftleft(parts[b], 13)).cast("int") for a, b in _PAIRS]


def block_values(prints: np.ndarray) -> Iterator[np.ndarray]:
    """The same for an array of fingerprints, pair by pair."""
    parts = [((prints >> np.uint64(start)) & np.uint64((1 << (stop - start)) - 1)).astype(np.int64) for start, stop in zip(_CUTS, _CUTS[1:])]
    for a, b in _PAIRS:
        yield parts[a] | (parts[b] << 13)


def _slot(value: Column | np.ndarray) -> Column | np.ndarray:
    """Bit of the filter that stands for a value."""
    if isinstance(value, np.ndarray):
        return ((value * _SLOT_FACTOR) & 0xFFFFFFFF) >> (32 - _SLOT_BITS)
    return F.shiftright((value.cast("bigint") * F.lit(_SLOT_FACTOR)).bitwiseAND(F.lit(0xFFFFFFFF)), 32 - _SLOT_BITS)


def document_windows(documents: DataFrame, occurring: dict[int, np.ndarray]) -> DataFrame:
    """(doc, at, size, print, block, value) of windows with a pair of blocks among `occurring` (size -> bits by pair)."""
    shared = documents.sparkSession.sparkContext.broadcast(occurring)
    kind = "doc bigint, at bigint, size bigint, print bigint, block int, value int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = shared.value
        for batch in batches:
            ids, row = batch.column("doc").to_pylist(), 0
            for part in slices(batch.column("body")):
                hashes, counts = word_hashes(part)
                ends = np.cumsum(counts)
                owner = np.repeat(np.arange(len(part)), counts)
                for size, start, prints in window_fingerprints(hashes, sorted(masks)):
                    for block, values in enumerate(block_values(prints)):
                        slots = _slot(values)
                        at = np.flatnonzero((masks[size][block][slots >> 3] >> (slots & 7).astype(np.uint8)) & 1)
                        first = at + start
                        inside = first + size <= ends[owner[first]]
                        at, first = at[inside], first[inside]
                        if not len(at):
                            continue
                        which = owner[first]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([ids[row + w] for w in which], pa.int64()),
                                pa.array(first - (ends - counts)[which], pa.int64()),
                                pa.array(np.full(len(at), size), pa.int64()),
                                pa.array(prints[at].view(np.int64)),
                                pa.array(np.full(len(at), block, dtype=np.int32)),
                                pa.array(values[at].astype(np.int32)),
                            ],
                            ["doc", "at", "size", "print", "block", "value"],
                        )
                row += len(part)

    return documents.mapInArrow(run, kind)


def matches(
    documents: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", least: float = 0.8,
) -> DataFrame:
    """`documents` with `matches`, an array of (item, start, words, similarity) by item, and `contaminated`."""
    items = benchmark.select(F.col(item).cast("bigint").alias("item"), F.col(item_text).alias("body")).where("item is not null and body is not null")
    prints = cut_lineage(item_windows(items, least), "items")
    indexed = prints.select("*", F.posexplode(F.array(*_blocks("print"))).alias("block", "value"))
    occurring: dict[int, np.ndarray] = {}
    # at most 4,194,304 bits for each size (a power of two) and pair of blocks
    bits = indexed.select("size", "block", _slot(F.col("value")).alias("slot")).groupBy("size", "block", F.expr(f"slot div {_BITMAP}").alias("part"))
    for r in bits.agg(F.bitmap_construct_agg(F.expr(f"slot % {_BITMAP}")).alias("bits")).toLocalIterator():
        mask = occurring.setdefault(r["size"], np.zeros((len(_PAIRS), (1 << _SLOT_BITS) // _BITMAP, _BITMAP // 8), dtype=np.uint8))
        mask[r["block"], r["part"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    occurring = {size: mask.reshape(len(_PAIRS), -1) for size, mask in occurring.items()}
    rows = documents.select(F.col(id).cast("bigint").alias("doc"), F.col(text).alias("body"))
    if not occurring:
        none = F.array().cast("array<struct<item:bigint,start:bigint,words:bigint,similarity:double>>")
        return documents.withColumns({"matches": none, "contaminated": F.lit(False)})
    windows = document_windows(rows.where("body is not null"), occurring)
    near = windows.join(indexed.withColumnRenamed("print", "other"), ["size", "block", "value"])
    near = near.where(F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= RADIUS)
    # an item has one size of windows, so places of one item and document differ in where they are only
    places = near.groupBy("doc", "item", "size").agg(F.collect_set("at").alias("at"))
    told = places.join(items, "item").select("doc", F.struct("item", "size", "at", "body").alias("place"))
    # the places in one document: no more than its length allows
    candidates = cut_lineage(told.groupBy("doc").agg(F.collect_list("place").alias("places")), "places")
    found = _verify(least)
    key = "_".join(documents.columns)  # a name that no column has
    named = candidates.select(F.col("doc").alias(key), F.col("places").alias(f"{key}_"))
    joined = documents.drop("matches", "contaminated").join(named, F.col(id).cast("bigint").eqNullSafe(F.col(f"`{key}`")), "left")
    hit = F.col(f"`{key}_`")
    checked = joined.withColumn("matches", F.when(hit.isNotNull(), found(F.when(hit.isNotNull(), F.col(text)), hit)).otherwise(F.array()))
    return checked.withColumn("contaminated", F.size("matches") > 0).drop(key, f"{key}_")


def _verify(least: float):
    @F.udf("array<struct<item:bigint,start:bigint,words:bigint,similarity:double>>")
    def run(text, places):
        if not places or text is None:
            return []
        own, best = words(text), {}
        for place in places:
            body = words(place["body"])
            # the passage holds the whole window
            starts = {p for at in place["at"] for p in range(at + place["size"] - len(body), at + 1)}
            value, start = best_place(body, own, sorted(starts))
            if value >= least and value > best.get(place["item"], (0.0,))[0]:
                best[place["item"]] = (value, start, len(body))
        return [(item, start, n, value) for item, (value, start, n) in sorted(best.items())]

    return run
