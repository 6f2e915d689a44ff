"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: lower-cased words and, for inflected forms, the first letters of longer words,
hashed into a fixed number of buckets. The score is the logistic function of

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,

so that a pair of terms (an insult and a named group) can count for more than both alone, which additive linear
weights cannot say. Every text is scored whole, in one narrow pass.

Both kinds of rows weigh the same in the fit, in which an even score of 0.5 means no evidence either way.

Linear weights and pairs see a text on different scales. A pair may matter though neither of its terms tells anything
alone, so the factors know no such evidence: every term has the value 1/sqrt(number of terms). A linear weight can only
say what a term tells alone, so its value follows the term's own evidence, the standard errors by which its share of
toxic rows stands out, up to `evidence`; the values of a text have length one at most. Terms without evidence fade
out there gradually instead of adding the noise of thousands of weights.

The fit uses a bounded sample of the labelled rows (`FmSettings.sample_rows`, drawn by a hash of the id, so it does
not depend on partitions); all of them where there are fewer. The sample is chosen on the label table before any
text is read, and is small enough to be sent to the tasks that hold the texts, so no text is shuffled. Its term
lists, not its texts, meet in one task for the fit: one list an id, at most `sample_rows` lists. Every bucket that
`min_rows` of them have takes part.

Defined cases: a NULL or empty text has no terms and scores the intercept; a label that is NULL or belongs to no
document is not used; several labels of one id count as toxic if one does; repeated documents are scored each, and
the fit takes the last term list in order of those of one id. With no labelled row, labels of one kind only or no common term, every score is the share of toxic rows (0.0 without rows).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class FmSettings:
    """`sample_rows` bounds the labelled rows of the fit; a bucket takes part if `min_rows` of them have it. A linear
    value is (standard errors / `evidence`) to the power `sharpness`, at most one."""

    bits: int = 20
    factors: int = 4
    prefixes: tuple[int, ...] = (4, 5, 6)
    sample_rows: int = 20_000
    min_rows: int = 3
    evidence: float = 3.0
    sharpness: int = 4
    updates: int = 1_500
    batch_rows: int = 64
    step: float = 0.1
    decay: float = 1e-5
    spread: float = 0.1
    seed: int = 7


@dataclass(frozen=True)
class FmModel:
    """Weights of the buckets in `kept` (sorted), and the evidence of each alone; other buckets weigh nothing."""

    settings: FmSettings
    intercept: float
    kept: np.ndarray
    linear: np.ndarray
    factors: np.ndarray
    alone: np.ndarray


def term_buckets(text: str, settings: FmSettings, cache: dict[str, tuple[int, ...]]) -> set[int]:
    """The buckets of the terms of one text."""
    found: set[int] = set()
    mask = (1 << settings.bits) - 1
    for word in set(WORD.findall(text.lower())):
        buckets = cache.get(word)
        if buckets is None:
            terms = [word, *(f"{word[:n]}*" for n in settings.prefixes if len(word) > n)]
            buckets = tuple(zlib.crc32(t.encode("utf-8", "surrogatepass")) & mask for t in terms)
            if len(cache) < 200_000:
                cache[word] = buckets
        found.update(buckets)
    return found


def _ragged(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    values = np.concatenate(lists) if lists else np.zeros(0, dtype=np.int64)
    return values, np.concatenate([[0], np.cumsum(lengths)])


def _row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the rows of `values` between successive `ends`; empty runs give 0."""
    sums = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return sums[ends[1:]] - sums[ends[:-1]]


def _term_values(alone: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linear and pair values of the terms of each row, and the row of each term."""
    n = np.diff(ends)
    of = np.repeat(np.arange(len(n)), n)
    length = np.sqrt(np.maximum(_row_sums(alone * alone, ends), 1.0))
    return alone / length[of], (1.0 / np.sqrt(np.maximum(n, 1)))[of], of


def _raw_scores(intercept, linear, factors, alone, slots, ends):
    """Scores before the logistic function; also the scaled factors, their row sums, and the values of the terms."""
    own, paired, of = _term_values(alone[slots], ends)
    v = factors[slots] * paired[:, None]
    summed = _row_sums(v, ends)
    raw = intercept + _row_sums(linear[slots] * own, ends) + 0.5 * (summed**2 - _row_sums(v * v, ends)).sum(axis=1)
    return raw, v, summed, own, paired, of


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def _common_buckets(values: np.ndarray, ends: np.ndarray, labels: np.ndarray, settings: FmSettings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in `min_rows` rows, and what each tells alone, from 0 to 1."""
    size, share = 1 << settings.bits, labels.mean()
    rows = np.bincount(values, minlength=size)
    toxic = np.bincount(values, np.repeat(labels, np.diff(ends)), size)
    errors = np.abs(toxic - rows * share) / np.sqrt(np.maximum(rows, 1) * share * (1 - share))
    kept = np.flatnonzero(rows >= settings.min_rows)
    return kept, np.minimum(1.0, errors[kept] / settings.evidence) ** settings.sharpness


def _slots(values: np.ndarray, ends: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in `kept` of the values that are there, and the row ends over these."""
    at = np.searchsorted(kept, values)
    at[at == len(kept)] = 0
    inside = kept[at] == values
    return at[inside], np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])[ends]


def fit_sample(lists: list[np.ndarray], labels: np.ndarray, settings: FmSettings) -> FmModel:
    """Minimise the logistic loss by mini-batches, with steps that shrink per weight as its gradients add up."""
    share = float(labels.mean()) if len(labels) else 0.0
    none = FmModel(settings, share, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, settings.factors)), np.zeros(0))
    if share in (0.0, 1.0):
        return none
    values, ends = _ragged(lists)
    kept, alone = _common_buckets(values, ends, labels, settings)
    if not len(kept):
        return none
    slots, ends = _slots(values, ends, kept)
    rng = np.random.default_rng(settings.seed)
    linear = np.zeros(len(kept))
    factors = rng.normal(0, settings.spread, (len(kept), settings.factors))
    intercept = 0.0
    seen_linear, seen_factors = np.full(len(kept), 1e-2), np.full(factors.shape, 1e-2)
    # rare toxic rows weigh as much as the many clean ones together
    weights = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    for _ in range(-(-settings.updates * settings.batch_rows // len(labels))):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), settings.batch_rows):
            rows = order[start : start + settings.batch_rows]
            n = ends[rows + 1] - ends[rows]
            stop = np.concatenate([[0], np.cumsum(n)])
            part = slots[np.repeat(ends[rows] - stop[:-1], n) + np.arange(stop[-1])]
            raw, v, summed, own, paired, of = _raw_scores(intercept, linear, factors, alone, part, stop)
            off = (_logistic(raw) - labels[rows]) * weights[rows] / len(rows)
            intercept -= settings.step * float(off.sum())
            if not len(part):
                continue
            used, where = np.unique(part, return_inverse=True)
            g = np.bincount(where, off[of] * own, len(used)) + settings.decay * linear[used]
            seen_linear[used] += g * g
            linear[used] -= settings.step * 10 * g / np.sqrt(seen_linear[used])
            for f in range(settings.factors):
                gf = np.bincount(where, off[of] * paired * (summed[of, f] - v[:, f]), len(used)) + settings.decay * factors[used, f]
                seen_factors[used, f] += gf * gf
                factors[used, f] -= settings.step * gf / np.sqrt(seen_factors[used, f])
    return FmModel(settings, intercept, kept, linear, factors, alone)


def score_lists(lists: list[np.ndarray], model: FmModel) -> np.ndarray:
    """Scores of texts given as sorted buckets of their terms."""
    if not len(model.kept):
        return np.full(len(lists), model.intercept)
    slots, ends = _slots(*_ragged(lists), model.kept)
    return _logistic(_raw_scores(model.intercept, model.linear, model.factors, model.alone, slots, ends)[0])


def score_texts(texts: list[str], model: FmModel, cache: dict) -> np.ndarray:
    return score_lists([np.fromiter(s, np.int64, len(s)) for s in (term_buckets(t, model.settings, cache) for t in texts)], model)


def train(
    documents: DataFrame, labels: DataFrame, settings: FmSettings = FmSettings(), id: str = "doc_id",
    text: str = "text", label: str = "toxic",
) -> FmModel:
    """Fit on the labelled rows of `labels`; texts come from `documents`."""
    marked = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull())
    marked = marked.groupBy(F.col(id).alias("key")).agg(F.max(F.col(label).cast("int")).alias("y"))
    share = min(1.0, settings.sample_rows / max(1, marked.count()))
    drawn = marked.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(share * 1_000_000))
    # at most about `sample_rows` rows of two numbers
    rows = documents.select(F.col(id).alias("key"), F.col(text).alias("body")).join(F.broadcast(drawn), "key")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            lists = [sorted(term_buckets(t, settings, cache)) for part in slices(batch.column("body")) for t in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(lists, pa.list_(pa.int32())), batch.column("y")], ["key", "terms", "y"]
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, marks = [], []
        for batch in batches:
            column = batch.column(0)
            lists += np.split(column.flatten().to_numpy(), column.value_lengths().to_numpy().cumsum()[:-1])
            marks.append(batch.column(1).to_numpy())
        if not marks:
            return
        m = fit_sample(lists, np.concatenate(marks), settings)
        yield pa.RecordBatch.from_pydict(
            {"i": [m.intercept], "k": [m.kept.tobytes()], "w": [m.linear.tobytes()], "v": [m.factors.tobytes()], "t": [m.alone.tobytes()]}
        )

    terms = rows.select("key", "body", F.col("y").cast("double")).mapInArrow(features, "key long, terms array<int>, y double")
    # any number of documents may have one id
    terms = terms.groupBy("key").agg(F.max("terms").alias("terms"), F.max("y").alias("y"))
    fitted = (
        terms.repartition(1).sortWithinPartitions("key", "terms").select("terms", "y")
        .mapInArrow(fit, "i double, k binary, w binary, v binary, t binary").head()
    )
    if fitted is None:
        return fit_sample([], np.zeros(0), settings)
    return FmModel(
        settings, fitted.i, np.frombuffer(fitted.k, np.int64), np.frombuffer(fitted.w),
        np.frombuffer(fitted.v).reshape(-1, settings.factors), np.frombuffer(fitted.t),
    )


def score(documents: DataFrame, model: FmModel, text: str = "text", output: str = "score") -> DataFrame:
    """`documents` with a `output` column (0 to 1, higher: more likely toxic); one of that name is replaced."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache: dict = {}
        for batch in batches:
            yield pa.array(np.concatenate([np.zeros(0), *(score_texts(t, shared.value, cache) for t in slices(batch))]))

    return documents.withColumn(output, run(text))
