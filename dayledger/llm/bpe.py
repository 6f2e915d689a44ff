"""Byte-level BPE encoding and decoding of whole texts, with tree concatenation of long unsplit text.

Most texts are encoded where they lie, in one narrow pass. A text over `leaf` characters long becomes rows, the halves
of halves of the text, cut wherever the middle falls. Spark deals the rows out, so no text keeps one task busy alone; each
is encoded on its own, and then neighbours are joined in rounds, as many as the tree is deep. A join re-encodes a window
around the seam and lets it grow until both sides agree exactly:

- The split pattern goes from left to right and looks three characters ahead at most, so what it finds up to three
  characters before the end of the left side holds for the whole. A window from such a place grows to the right until it
  ends a piece where the right side does; from there on both are split alike.
- If the seam lies inside one piece, the halves of that piece are joined by tokens: a window of some tokens on either side
  grows until its first token is the left side's and its last token the right side's. Then every two neighbouring tokens
  of the result stood together in some encoding, which for BPE means that the whole is the encoding of the joined piece.

Character classes of the libraries differ in rare scripts; texts within `AGREED` are split by the pattern and given to
the faster of the two libraries, all others are split and encoded by the library of the vocabulary file.

Defined cases: NULL counts as the empty text, which has no tokens; the text of a special token becomes that token, as
in the library; rows that repeat are encoded each, but long texts with equal content once; extra columns go through.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, remove_cut
from .batches import slices
from .packed import free_name

#: Fixed: the split pattern of the vocabulary's pre-tokenizer.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters whose classes (letter, number, space, other) all libraries agree on; the tests go through them.
AGREED = re.compile("[\0-ɏͰ-ͷΑ-ΡΣ-ϿЀ-ԯ‐-‧‰-⁞₠-₿ぁ-ゖァ-ヺ一-龥가-힣]*")

#: Characters of a text that are encoded in one go.
LEAF = 32_768
#: Characters from its start on that the split pattern looks at to settle a piece, besides the piece itself.
_AHEAD = 3
#: Characters on either side of a seam that are split into pieces to begin with.
_NEAR = 512
#: A space between two letters starts a piece, wherever the pattern comes from.
_START = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
#: Tokens that a task decodes together; a longer single text is taken alone.
_TOKENS = 300_000


class Codec:
    """The vocabulary in both libraries; made once per Python worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.whole = Tokenizer.from_str(text)
        self.whole.no_truncation()
        self.whole.no_padding()
        description = json.loads(text)
        byte_of = _byte_of_letter()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in description["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in description["added_tokens"]}
        self.special = list(special)
        self.fast = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        self.allowed = set(special)
        self.lengths = np.zeros(max([*ranks.values(), *special.values()]) + 1, dtype=np.int64)
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.lengths[i] = len(token)

    def encode(self, text: str) -> np.ndarray:
        if AGREED.fullmatch(text):
            return self.fast.encode_to_numpy(text, allowed_special=self.allowed)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def pieces(self, text: str) -> Iterator[tuple[int, int]]:
        """Start and end of the pieces that are encoded each on its own."""
        if AGREED.fullmatch(text):
            yield from (found.span() for found in _pattern().finditer(text))
        else:
            yield from (span for _, span in self.whole.pre_tokenizer.pre_tokenize_str(text))

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode_batch(ids, skip_special_tokens=False)


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as their character, the others as letters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in set(printable)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


@cache
def _pattern():
    import regex

    return regex.compile(SPLIT)


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def join_encodings(
    left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray, encode: Callable[[str], np.ndarray],
    lengths: np.ndarray, grow: int = 8,
) -> np.ndarray:
    """The encoding of left + right, where neither the parts nor the whole are split by the pattern."""
    a, b = left.encode(), right.encode()
    starts = np.concatenate([[0], np.cumsum(lengths[left_ids])])
    ends = np.concatenate([[0], np.cumsum(lengths[right_ids])])
    inner = lambda data, at: 0 < at < len(data) and data[at] & 0xC0 == 0x80  # noqa: E731  inside a character
    while True:
        i, j = max(0, len(left_ids) - grow), min(len(right_ids), grow)
        while inner(a, starts[i]):
            i -= 1
        while inner(b, ends[j]):
            j += 1
        window = encode((a[starts[i] :] + b[: ends[j]]).decode())
        same_left = i == 0 or window[0] == left_ids[i]
        same_right = j == len(right_ids) or window[-1] == right_ids[j - 1]
        if same_left and same_right:
            return np.concatenate([left_ids[:i], window, right_ids[j:]])
        grow *= 2


def join_texts(left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray, own: Codec, near: int = _NEAR) -> np.ndarray:
    """The encoding of left + right; `near`: characters on either side of the seam to begin with."""
    if not left or not right:
        return right_ids if not left else left_ids
    while True:
        # where the left side's pieces surely start: from the start of the text or a certain start of a piece on
        tail = 0 if near >= len(left) else max(0, len(left) - near)
        if tail:
            found = _START.search(left, tail)
            tail = found.start() if found else len(left)
        head = min(near, len(right))
        starts = [tail + x for x, _ in own.pieces(left[tail:])]
        sure = [x for x in starts if x <= len(left) - _AHEAD] or ([0] if tail == 0 else [])
        ends = [y for _, y in own.pieces(right[:head])]
        ends = ends if head == len(right) else [y for y in ends if y <= head - _AHEAD]
        if sure and ends:
            start = sure[max(0, len(sure) - 4)]
            window, seam = left[start:] + right[: ends[-1]], len(left) - start
            settled = len(window) if ends[-1] == len(right) else len(window) - _AHEAD
            spans, known = list(own.pieces(window)), {0, *ends}
            agreed = [k for k, (_, y) in enumerate(spans) if seam <= y <= settled and y - seam in known]
            if agreed:
                break
        near *= 2
    left_at, right_at = np.cumsum(own.lengths[left_ids]), np.cumsum(own.lengths[right_ids])
    total = int(left_at[-1])
    behind = lambda at: int(np.searchsorted(left_at, total - len(left[at:].encode()), side="right"))  # noqa: E731  tokens before a character
    out = [left_ids[: behind(start)]]
    for x, y in spans[: agreed[0] + 1]:
        alike = x < seam < y and start + x in starts[-1:] and y - seam == ends[0]
        if alike:  # both sides hold their part of the piece as a piece of its own
            a, b = left[start + x :], right[: y - seam]
            j = int(np.searchsorted(right_at, len(b.encode()), side="left")) + 1
            out.append(join_encodings(a, left_ids[behind(start + x) :], b, right_ids[:j], own.encode, own.lengths))
        else:
            out.append(own.encode(window[x:y]))
    end = len(right[: spans[agreed[0]][1] - seam].encode())
    out.append(right_ids[int(np.searchsorted(right_at, end, side="right")) :])
    return np.concatenate([np.asarray(x, dtype=np.int64) for x in out])


def cut_text(text: str, leaf: int, special: list[str]) -> Iterator[tuple[int, int, int, str]]:
    """(part, leaf number, leaves of the part, text): the halves of halves of the text between special tokens, in order."""
    marks = re.split("(" + "|".join(map(re.escape, special)) + ")", text) if special else [text]
    for at, part in enumerate(marks):
        if not part:
            continue
        leaves = 1
        while len(part) > leaf * leaves and at % 2 == 0:
            leaves *= 2
        for k in range(leaves):
            yield at, k, leaves, part[len(part) * k // leaves : len(part) * (k + 1) // leaves]


def _id_lists(lists: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    values = np.concatenate([np.zeros(0, np.uint32), *lists]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _encoded(rows: DataFrame, path: str, text: str, output: str) -> DataFrame:
    """`rows` with the ids of `text`, each encoded whole; results leave a task slice by slice."""
    names = [*rows.columns, output]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            at = 0
            for part in slices(batch.column(text)):
                own = batch.slice(at, len(part))
                yield pa.RecordBatch.from_arrays([*own.columns, _id_lists([encode(t) for t in part])], names)
                at += len(part)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(output, T.ArrayType(T.IntegerType()))]))


def encode_long(texts: DataFrame, path: str, leaf: int) -> DataFrame:
    """(key, ids) of (key, body) by tree concatenation."""

    columns = pa.schema([("key", pa.string()), ("piece", pa.int32()), ("leaf", pa.int32()), ("leaves", pa.int32()), ("body", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = codec(path).special
        for batch in batches:
            for key, body in zip(batch.column("key").to_pylist(), batch.column("body").to_pylist()):
                rows = list(cut_text(body, leaf, special))
                place, number, leaves, part = zip(*rows)
                yield pa.RecordBatch.from_pydict(
                    {"key": [key] * len(rows), "piece": place, "leaf": number, "leaves": leaves, "body": part}, columns
                )

    def join(group: pd.DataFrame) -> pd.DataFrame:
        own = codec(path)
        rows = group.sort_values("leaf").to_dict("records")
        first = rows[0] | {"leaf": rows[0]["leaf"] // 2, "leaves": rows[0]["leaves"] // 2}
        if len(rows) == 2:
            ids = [np.asarray(r["ids"], dtype=np.int64) for r in rows]
            joined = join_texts(rows[0]["body"], ids[0], rows[1]["body"], ids[1], own)
            first |= {"body": rows[0]["body"] + rows[1]["body"], "ids": joined.astype(np.int32)}
        return pd.DataFrame([first])[list(group.columns)]

    schema = "key string, piece int, leaf int, leaves int, body string"
    rows = texts.mapInArrow(cut, schema).repartition("key", "piece", "leaf")
    rows = cut_lineage(_encoded(rows, path, "body", "ids"), "leaves")
    depth = int(rows.agg(F.max("leaves")).first()[0] or 1).bit_length() - 1  # one number
    done, open_rows = rows.where("leaves = 1"), rows.where("leaves > 1")
    for _ in range(depth):
        joined = open_rows.groupBy("key", "piece", F.expr("leaf div 2").alias("pair")).applyInPandas(
            lambda group: join(group), f"{schema}, ids array<int>"
        )
        joined = cut_lineage(joined, "joined")
        done, open_rows = done.unionByName(joined.where("leaves = 1")), joined.where("leaves > 1")
    # the pieces of one text: no more than that text has
    parts = F.array_sort(F.collect_list(F.struct("piece", "ids")))
    return done.groupBy("key").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def encode(documents: DataFrame, path: str, text: str = "text", output: str = "ids", leaf: int = LEAF) -> DataFrame:
    """`documents` with the token ids of `text` in `output`; a column of that name is replaced."""
    kept = documents.drop(output)
    body = F.coalesce(F.col(text), F.lit(""))
    long = F.length(body) > leaf
    plain = _encoded(kept.where(~long), path, text, output)
    texts = cut_lineage(kept.where(long).select(F.sha2(body, 256).alias("key"), body.alias("body")).dropDuplicates(["key"]), "long")
    if texts.isEmpty():
        remove_cut(texts)
        return plain
    mark, listed = free_name(kept.columns, "key"), free_name(kept.columns, "ids")
    ids = encode_long(texts, path, leaf).select(F.col("key").alias(mark), F.col("ids").alias(listed))
    found = kept.where(long).withColumn(mark, F.sha2(body, 256)).join(ids, mark)
    return plain.union(found.select(*[F.col(f"`{c}`") for c in kept.columns], F.col(listed).alias(output)))


def decode(rows: DataFrame, path: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """`rows` with the text of the token ids; NULL ids give the empty text, tokens that are not UTF-8 U+FFFD."""
    kept = rows.drop(output)
    names = [*kept.columns, output]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False)
            run_of = np.cumsum(sizes) // _TOKENS
            edges = [0, *(np.flatnonzero(np.diff(run_of)) + 1), len(batch)]
            for start, stop in zip(edges[:-1], edges[1:]):
                part = batch.slice(start, stop - start)
                texts = own.decode([x or [] for x in part.column(ids).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names)

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(output, T.StringType())]))
