"""Alignment of two tokenizers over a corpus: which tokens share text, how often, and how typical a document's links are.

Both tokenizations of a text cover the same bytes. Every token of A and every token of B whose byte ranges overlap are
linked; offsets where both end cut the text into groups. A link's count is how often its pair of ids is linked in all
documents, and a link is best if no other A id has more links with its B id.

Counting is external, in runs, so that no task holds the pairs of the corpus:
1. One scan encodes, aligns and digests each document, and writes pieces of `RUN_RECORDS` pair-document records: the
   distinct pairs of the piece in order of (B id, A id) with their counts, and for each document which of them it has
   how often.
2. The pairs of a piece are dealt by the low bits of the B id (a radix; their number follows the number of pairs), each
   part a compressed run in order.
3. A partition merges its runs through a heap and adds up each pair. As the order is by B id first, the highest count of
   a B id is known when its last pair has passed; then totals and best marks are appended to the answers of the runs
   that had the pair, in their own order, so no key goes back.
4. The answers of a piece meet its pair-document records and become sums by document.
A pair is one record a piece however many documents have it, and a B id has at most as many pairs as A has tokens.

A long text is cut at a space between two letters where that cannot change either tokenization, so memory follows the
part. Vocabularies whose B pieces hold a space after other characters are not cut.

Defined cases: a text that is NULL or empty, or whose tokens do not give back its bytes (B may normalise), has no tokens
and counts zeros; the text of a special token is plain text; rows that repeat count each; further columns take no part.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, remove_cut
from .batches import slices
from .bpe import AGREED, codec
from .packed import pack, piece_name, unpack

#: Pair-document records of one piece, and pairs of the pieces that one partition merges.
RUN_RECORDS, MERGE_RECORDS = 4_000_000, 1_000_000
#: Characters of a text that are encoded at once, if it can be cut there.
PART = 200_000
#: Records of a run that are open at a time.
_BLOCK = 4096
_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


class Tokenizers:
    """A: a byte-level BPE vocabulary file; B: a piece model with byte fallback. Made once per Python worker."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = codec(byte_path)
        with open(byte_path, encoding="utf-8") as file:
            text = file.read()
        self.whole = Tokenizer.from_str(text)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.whole.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = self._a_bytes(json.loads(text))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.shift = len(self.a_bytes).bit_length()
        #: What a token adds to the spelling of the groups: of A inside and at the end of its side, then of B.
        self.spelled = [f"{i}{end}".encode() for n, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for i in range(n) for end in ends]

    def _a_bytes(self, description: dict) -> list[bytes]:
        from .bpe import _byte_of_letter

        byte_of = _byte_of_letter()
        known = {i: bytes(byte_of[c] for c in t) for t, i in description["model"]["vocab"].items()}
        known |= {t["id"]: t["content"].encode() for t in description["added_tokens"]}
        return [known.get(i, b"") for i in range(max(known) + 1)]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for a space and the text; None if they do not give back its bytes."""
        spaced = f" {text}"
        a = self.a.fast.encode_to_numpy(spaced, disallowed_special=()) if AGREED.fullmatch(text) else self.whole.encode(spaced, add_special_tokens=False).ids
        b, data = self.b.encode(text, num_threads=1), spaced.encode()
        a_list = a.tolist() if isinstance(a, np.ndarray) else a
        if b"".join(map(self.a_bytes.__getitem__, a_list)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        return np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)

    def parts(self, text: str) -> Iterator[str]:
        """The text without the spaces at which it is cut."""
        start = 0
        while self.cuts and len(text) - start > PART and (cut := _CUT.search(text, start + PART)):
            yield text[start : cut.start()]
            start = cut.end()
        yield text[start:]


@cache
def tokenizers(byte_path: str, piece_path: str) -> Tokenizers:
    return Tokenizers(byte_path, piece_path)


@dataclass(frozen=True)
class Aligned:
    """Tokens of both sides, the offsets where both end, and the links as positions in either."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    common: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align_tokens(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> Aligned:
    """Links of two tokenizations of the same bytes: one for each stretch between successive ends of either side."""
    a_ends, b_ends = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
    ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
    twice = ends[1:] == ends[:-1]
    stretches = ends[np.append(True, ~twice)]
    return Aligned(a, b, a_ends, b_ends, ends[1:][twice], np.searchsorted(a_ends, stretches), np.searchsorted(b_ends, stretches))


def spell(found: Aligned, spelled: list[bytes], a_tokens: int) -> bytes:
    """The groups as `a1,a2|b1;a3|b2,b3`."""
    a_stop, b_stop = np.searchsorted(found.a_ends, found.common) + 1, np.searchsorted(found.b_ends, found.common) + 1
    a_group, b_group = np.searchsorted(found.common, found.a_ends), np.searchsorted(found.common, found.b_ends)
    a_words, b_words = 2 * found.a, 2 * (a_tokens + found.b)
    a_words[a_stop - 1] += 1
    b_words[b_stop - 1] += 1
    order = np.empty(len(a_words) + len(b_words), dtype=np.int64)
    order[np.arange(len(a_words)) + np.append(0, b_stop)[a_group]] = a_words
    order[np.arange(len(b_words)) + a_stop[b_group]] = b_words
    return b"".join(map(spelled.__getitem__, order.tolist()))[:-1]


def align_text(text: str, own: Tokenizers) -> tuple[tuple[int, int, int, int, str], np.ndarray, np.ndarray]:
    """(n_a, n_b, n_groups, n_links, digest of the groups), and the distinct pairs with their numbers of links."""
    numbers, digest = np.zeros(4, dtype=np.int64), hashlib.sha256()
    pairs, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at, part in enumerate(own.parts(text) if text else ()):
        encoded = own.encode(part)
        if encoded is None:
            return align_text("", own)
        found = align_tokens(*encoded, own.a_sizes, own.b_sizes)
        numbers += [len(found.a), len(found.b), len(found.common), len(found.link_a)]
        digest.update(b";" * (at > 0) + spell(found, own.spelled, len(own.a_bytes)))
        some, times = np.unique((found.b[found.link_b] << own.shift) | found.a[found.link_a], return_counts=True)
        pairs.append(some)
        counts.append(times)
    if len(pairs) > 2:
        some, where = np.unique(np.concatenate(pairs), return_inverse=True)
        pairs, counts = [some], [np.bincount(where, np.concatenate(counts)).astype(np.int64)]
    return (*numbers.tolist(), digest.hexdigest() if numbers[0] else ""), pairs[-1], counts[-1]


_PIECES = (
    "piece string, n long, pairs binary, counts binary, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, digests array<string>, sizes array<int>, record_pairs binary, record_counts binary"
)


def _piece(name: str, rows: list[tuple], pairs: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    distinct, at = np.unique(np.concatenate(pairs), return_inverse=True)
    every = np.concatenate(counts)
    longs = pa.list_(pa.int64())
    columns = list(zip(*((id, *facts) for id, facts in rows)))
    return pa.RecordBatch.from_pydict(
        {
            "piece": [name], "n": pa.array([len(distinct)], pa.int64()), "pairs": pa.array([pack(distinct)], pa.binary()),
            "counts": pa.array([pack(np.bincount(at, every, len(distinct)).astype(np.int64))], pa.binary()), "ids": pa.array([columns[0]], longs),
            **{k: pa.array([columns[i]], longs) for i, k in enumerate(("n_a", "n_b", "n_groups", "n_links"), 1)},
            "digests": pa.array([columns[5]], pa.list_(pa.string())), "sizes": pa.array([[len(p) for p in pairs]], pa.list_(pa.int32())),
            "record_pairs": pa.array([pack(at.astype(np.int32))], pa.binary()), "record_counts": pa.array([pack(every.astype(np.int32))], pa.binary()),
        }
    )


def _pieces(rows: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Pieces of aligned documents; of (id, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(byte_path, piece_path)
        number = records = 0
        done: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            texts = chain.from_iterable(slices(batch.column(1)))
            for id, text in zip(batch.column(0).to_pylist(), texts):
                facts, pairs, counts = align_text(text, own)
                for part, x in zip(done, ((id, facts), pairs, counts)):
                    part.append(x)
                records += len(pairs) + 50  # what a row takes besides
                if records >= RUN_RECORDS:
                    yield _piece(piece_name(number), *done)
                    number, records, done = number + 1, 0, ([], [], [])
        if records:
            yield _piece(piece_name(number), *done)

    return rows.mapInArrow(run, _PIECES)


def _runs(pieces: DataFrame, bits: int, shift: int) -> DataFrame:
    """(radix, piece, at, pairs, counts): the pairs of each piece by the low bits of the B id, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, pairs, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                pairs, counts = unpack(pairs, np.int64), unpack(counts, np.int64)
                if not len(pairs):
                    continue
                radix = (pairs >> shift) & ((1 << bits) - 1)
                order = np.argsort(radix, kind="stable")
                present, starts = np.unique(radix[order], return_index=True)
                parts = np.split(order, starts[1:])
                yield pa.RecordBatch.from_pydict(
                    {"radix": pa.array(present, pa.int64()), "piece": [piece] * len(parts)}
                    | {k: pa.array([pack(f(p)) for p in parts], pa.binary()) for k, f in (("at", lambda p: p.astype(np.int32)), ("pairs", pairs.__getitem__), ("counts", counts.__getitem__))}
                )

    return pieces.select("piece", "pairs", "counts").mapInArrow(run, "radix long, piece string, at binary, pairs binary, counts binary")


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]], shift: int) -> Iterator[tuple[int, int, bool, list[int]]]:
    """(pair, total, best, the runs that have it) in order of the pairs; each run is in order and has a pair once."""

    def opened(number: int, pairs: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        for start in range(0, len(pairs), _BLOCK):
            yield from zip(pairs[start : start + _BLOCK].tolist(), repeat(number), counts[start : start + _BLOCK].tolist())

    side, open_pairs = None, []  # of one B id: [pair, total, runs]

    def closed() -> Iterator[tuple[int, int, bool, list[int]]]:
        most = max((total for _, total, _ in open_pairs), default=0)
        for pair, total, numbers in open_pairs:
            yield pair, total, total == most, numbers

    for pair, number, count in heapq.merge(*(opened(i, *run) for i, run in enumerate(runs))):
        if open_pairs and open_pairs[-1][0] == pair:
            open_pairs[-1][1] += count
            open_pairs[-1][2].append(number)
            continue
        if pair >> shift != side:
            yield from closed()
            side, open_pairs = pair >> shift, []
        open_pairs.append([pair, count, [number]])
    yield from closed()


def _answers(runs: DataFrame, shift: int) -> DataFrame:
    """(piece, at, totals, best) of each run, in its own order."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        totals, best = [[] for _ in rows], [[] for _ in rows]
        for _, total, highest, numbers in merge_runs([(unpack(r["pairs"], np.int64), unpack(r["counts"], np.int64)) for r in rows], shift):
            for i in numbers:
                totals[i].append(total)
                best[i].append(highest)
        return pa.table(
            {
                "piece": pa.array([r["piece"] for r in rows], pa.string()), "at": pa.array([r["at"] for r in rows], pa.binary()),
                "totals": pa.array([pack(np.array(t, dtype=np.int64)) for t in totals], pa.binary()),
                "best": pa.array([pack(np.array(x, dtype=bool)) for x in best], pa.binary()),
            }
        )

    return runs.groupBy("radix").applyInArrow(run, "piece string, at binary, totals binary, best binary")


def _contributions(pieces: DataFrame, answers: DataFrame) -> DataFrame:
    """One row a document: what its links get back from the counts of the corpus."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            totals, best = np.zeros(row["n"], dtype=np.int64), np.zeros(row["n"], dtype=bool)
            for answer in right.to_pylist():
                at = unpack(answer["at"], np.int32)
                totals[at], best[at] = unpack(answer["totals"], np.int64), unpack(answer["best"], bool)
            at, counts = unpack(row["record_pairs"], np.int32), unpack(row["record_counts"], np.int32).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(row["sizes"], dtype=np.int64)])
            sums = [np.concatenate([[0], np.cumsum(x)])[ends] for x in (counts * best[at], counts * totals[at])]
            facts = [row[k] for k in ("ids", "n_a", "n_b", "n_groups", "n_links")]
            out.append([*facts, *(np.diff(s).tolist() for s in sums), row["digests"]])
        kinds = [pa.int64()] * 7 + [pa.string()]
        return pa.table({n: pa.array(chain.from_iterable(r[i] for r in out), k) for i, (n, k) in enumerate(zip(names, kinds))})

    schema = ", ".join(f"{n} {'string' if n == names[-1] else 'long'}" for n in names)
    return pieces.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(run, schema)


def _spread(pieces: DataFrame) -> int:
    """Bits of the radix."""
    size = pieces.agg(F.sum("n")).first()[0] or 0  # one number
    least = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(24, max(least, size // MERGE_RECORDS).bit_length())


def align(documents: DataFrame, byte_path: str, piece_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each document."""
    rows = documents.select(F.col(id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    pieces, shift = cut_lineage(_pieces(rows, byte_path, piece_path), "aligned"), tokenizers(byte_path, piece_path).shift
    return _contributions(pieces, _answers(_runs(pieces, _spread(pieces), shift), shift))


def pair_counts(documents: DataFrame, byte_path: str, piece_path: str, text: str = "text") -> DataFrame:
    """(a_id, b_id, links, best) of all pairs of ids that are linked in the documents."""
    rows = documents.select(F.lit(None).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    pieces, shift = cut_lineage(_pieces(rows, byte_path, piece_path), "aligned"), tokenizers(byte_path, piece_path).shift

    def run(group: pa.Table) -> pa.Table:
        runs = [(unpack(r["pairs"], np.int64), unpack(r["counts"], np.int64)) for r in group.to_pylist()]
        found = [(pair & ((1 << shift) - 1), pair >> shift, total, best) for pair, total, best, _ in merge_runs(runs, shift)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.table({n: pa.array([x[i] for x in found], k) for i, (n, k) in enumerate(zip(("a_id", "b_id", "links", "best"), kinds))})

    counted = cut_lineage(_runs(pieces, _spread(pieces), shift).groupBy("radix").applyInArrow(run, "a_id long, b_id long, links long, best boolean"), "pairs")
    remove_cut(pieces)
    return counted
