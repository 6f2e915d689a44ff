"""Language identification with hyperdimensional profiles.

Every letter (and the gap between words) owns a random vector of +1/-1 drawn from a seed. A letter n-gram is bound
by rotating each letter's vector by its place and multiplying them; a text bundles (adds up) the vectors of its
n-grams, a language those of its training texts. A text gets the language whose bundle has the largest cosine with
its own.

Bundling is linear, so a slice of texts is a count matrix (texts x distinct n-grams) times the n-gram vectors: the
work per text grows with its length only through the counting. Training texts are added up per task, then per
(language, dimension) in Spark; what reaches the driver is one vector a language.

Defined cases: text that is NULL or has no letter is `und` with score 0.0; equal cosines go to the language that sorts
first; a NULL language trains nothing; without training rows every text is `und`. Letters are those of Unicode, lower
case; all else is a gap. Letters beyond a-z share 36 vectors by code point. A negative cosine scores 0.0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices

UNKNOWN = "und"
_SYMBOLS = 64  # 0: outside the text, 1: gap, 2-27: a-z, 28-63: other letters
_BLOCK = 4096


@dataclass(frozen=True)
class Profiles:
    """One row of `vectors` per language, in the order of `languages` (sorted)."""

    languages: tuple[str, ...]
    vectors: np.ndarray
    dimensions: int
    seed: int


@cache
def _symbol_table() -> np.ndarray:
    table = np.ones(0x110000, dtype=np.uint8)
    letters = [c for c in range(0x110000) if chr(c).isalpha()]
    table[letters] = [c - 95 if 97 <= c <= 122 else 28 + c % 36 for c in letters]
    return table


@cache
def _letter_vectors(dimensions: int, seed: int) -> np.ndarray:
    vectors = np.random.default_rng(seed).integers(0, 2, (_SYMBOLS, dimensions), dtype=np.int8) * 2 - 1
    return vectors.astype(np.int8)


def ngram_vectors(codes: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """Bound vectors of trigrams; a code holds three symbols of six bits."""
    letters = _letter_vectors(dimensions, seed)
    first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    return (first[codes >> 12] * second[codes >> 6 & 63] * letters[codes & 63]).astype(np.float32)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram codes, the row of each, and which rows have a letter."""
    lowered = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    symbols = _symbol_table()[points].astype(np.int32)
    lettered = np.bincount(rows, symbols > 1, len(texts)) > 0
    same = np.ones(len(symbols), dtype=bool)
    same[1:] = rows[1:] == rows[:-1]
    keep = (symbols > 1) | ~same | np.concatenate([[True], symbols[:-1] > 1])  # a run of gaps counts once
    symbols, rows = symbols[keep], rows[keep]
    inside = rows[2:] == rows[:-2]
    codes = (symbols[:-2] << 12 | symbols[1:-1] << 6 | symbols[2:])[inside]
    return codes, rows[2:][inside], lettered


def _bundle(codes: np.ndarray, rows: np.ndarray, n: int, dimensions: int, seed: int) -> np.ndarray:
    """Sums of the vectors of each row's trigrams."""
    bundles = np.zeros((n, dimensions), dtype=np.float32)
    seen = np.flatnonzero(np.bincount(codes, minlength=1))
    slot = np.zeros(seen[-1] + 1 if len(seen) else 1, dtype=np.int64)
    slot[seen] = np.arange(len(seen))
    slots = slot[codes]
    height = max(1, 4_000_000 // max(1, min(len(seen), _BLOCK)))
    edges = np.searchsorted(rows, np.arange(0, n + height, height))
    for k, start in enumerate(range(0, n, height)):
        stop = min(n, start + height)
        own, at = slots[edges[k] : edges[k + 1]], rows[edges[k] : edges[k + 1]] - start
        for left in range(0, len(seen), _BLOCK):
            width = min(_BLOCK, len(seen) - left)
            here = (own >= left) & (own < left + width) if len(seen) > _BLOCK else slice(None)
            counts = np.bincount(at[here] * width + own[here] - left, minlength=(stop - start) * width)
            vectors = ngram_vectors(seen[left : left + width], dimensions, seed)
            bundles[start:stop] += counts.astype(np.float32).reshape(-1, width) @ vectors
    return bundles


def predict_texts(texts: list[str], profiles: Profiles) -> tuple[list[str], np.ndarray]:
    codes, rows, lettered = _codes(texts)
    if not profiles.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    bundles = _bundle(codes, rows, len(texts), profiles.dimensions, profiles.seed).astype(np.float64)
    lengths = np.linalg.norm(profiles.vectors, axis=1)
    norms = np.linalg.norm(bundles, axis=1)[:, None] * np.where(lengths > 0, lengths, 1.0)
    cosines = bundles @ profiles.vectors.T / np.where(norms > 0, norms, 1.0)
    best = cosines.argmax(axis=1)
    names = [profiles.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
    return names, np.where(lettered, np.clip(cosines.max(axis=1), 0.0, 1.0), 0.0)


def train(
    documents: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = 1024, seed: int = 11,
    max_languages: int = 10_000,
) -> Profiles:
    """Bundle the texts of each language. More than `max_languages` values of `lang` are refused, not cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, at = batch.column("lang").to_pylist(), 0
            for part in slices(batch.column("body")):
                codes, rows, _ = _codes(part)
                names, which = np.unique(np.array(langs[at : at + len(part)], dtype=object), return_inverse=True)
                order = np.argsort(which[rows], kind="stable")
                added = _bundle(codes[order], which[rows][order], len(names), dimensions, seed)
                for name, vector in zip(names, added):
                    sums[name] = sums.get(name, 0) + vector.astype(np.float64)
                at += len(part)
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"lang": list(sums), "sums": pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))}
            )

    known = documents.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    parts = known.select(F.col(lang).alias("lang"), F.col(text).alias("body")).mapInArrow(run, "lang string, sums array<double>")
    totals = (
        parts.select("lang", F.posexplode("sums").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("v"))
    )
    found = sorted(totals.limit(max_languages + 1).collect(), key=lambda r: r.lang)  # one vector a language
    if len(found) > max_languages:
        raise ValueError(f"over {max_languages} languages in {lang}")
    vectors = np.array([r.v for r in found]).reshape(len(found), dimensions)
    return Profiles(tuple(r.lang for r in found), vectors, dimensions, seed)


def predict(documents: DataFrame, profiles: Profiles, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """`documents` with the predicted language and the cosine (0 to 1); columns of these two names are replaced."""
    shared = documents.sparkSession.sparkContext.broadcast(profiles)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang string, score double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = [], [np.zeros(0)]
            for part in slices(batch):
                found, cosines = predict_texts(part, shared.value)
                names += found
                scores.append(cosines)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores))], fields=list(kind))

    kept = documents.drop(lang, score)
    at = "_".join([*kept.columns, text])  # a name that no column has
    found = kept.withColumn(at, run(text))
    return found.select(*kept.columns, F.col(f"`{at}`.lang").alias(lang), F.col(f"`{at}`.score").alias(score))
