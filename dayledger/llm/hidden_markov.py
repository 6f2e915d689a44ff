"""A hidden Markov language model: Baum-Welch counts summed over partitions, exact scaled forward scores.

Words (64-bit hashes of them) are counted over the training texts in Spark; the table grows with the corpus and stays
distributed. A state emits one of a fixed number of symbols: each of the most frequent words has its own, the others
share the rest by hash; a symbol then gives one of its words by the counts, whatever the state:

    P(word | state) = B[state, symbol] * (c + 0.5) / (C + 0.5 * (V + 1))        (C, V: tokens and words of the symbol)

so that the chances of all words, with one more for all unseen ones, add up to one in every state. The hidden chain
starts in a state drawn from `start`, and moves once before every token, the end of the text being the last.

Each training round is one pass over the coded texts: every task adds up expected transitions and emissions of its
sequences by the forward-backward recursion, and Spark sums what the tasks found, a fixed number of values each. Long
texts are cut into stretches whose transfer matrices are computed side by side and then chained, which is the same
recursion with its sums reordered: scores are exact for texts of any length.

Word counts reach the texts in two ways. Words with at least 1/`heavy` of all tokens, of which there can only be `heavy`,
are sent to the tasks; all others are looked up in a join. Frequent words thus never meet in one task.

Defined cases: text that is NULL or empty is the end token alone; rows that repeat count as often as they are there and
get the same scores; a NULL id falls into the fold of the empty text; without training texts every token has a base
probability of one and symbols are equally likely.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batches import slices
from .shingles import mix, word_hashes

END = np.uint64(0x5851F42D4C957F2D)
_STRETCH = 64


@dataclass(frozen=True)
class HmmSettings:
    states: int = 4
    own_symbols: int = 2048
    shared_symbols: int = 2048
    heavy: int = 20_000
    rounds: int = 3
    seed: int = 5

    @property
    def symbols(self) -> int:
        return self.own_symbols + self.shared_symbols


@dataclass(frozen=True)
class Words:
    """What of the counts goes to every task: the heavy words (sorted), their counts, and which have a symbol."""

    tokens: int
    distinct: int
    heavy: np.ndarray
    counts: np.ndarray
    symbol: np.ndarray
    symbol_log: np.ndarray  # log10 of C + 0.5 * (V + 1) for each symbol


@dataclass(frozen=True)
class Hmm:
    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray


def _sequences(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes with an end after each text, and their number."""
    hashes, counts = word_hashes(texts)
    out = np.full(len(hashes) + len(texts), END, dtype=np.uint64)
    keep = np.ones(len(out), dtype=bool)
    keep[np.cumsum(counts + 1) - 1] = False
    out[keep] = hashes
    return out, counts + 1


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) over the column `body`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                words, n = np.unique(_sequences(part)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    return texts.select("body").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("c"))


def symbols_of(words: np.ndarray, known: Words, settings: HmmSettings) -> np.ndarray:
    at = np.minimum(np.searchsorted(known.heavy, words), max(0, len(known.heavy) - 1))
    shared = settings.own_symbols + (mix(words) % np.uint64(settings.shared_symbols)).astype(np.int64)
    if not len(known.heavy):
        return shared
    own = np.where(known.heavy[at] == words, known.symbol[at], -1)
    return np.where(own >= 0, own, shared)


def learn_words(counts: DataFrame, settings: HmmSettings) -> Words:
    """Totals, heavy words and symbol sizes from the counted words."""
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()  # two numbers
    tokens, distinct = totals.n or 0, totals.v
    # at most `heavy` words can have that share of all tokens
    found = counts.where(F.col("c") * settings.heavy >= max(tokens, 1)).collect()
    found.sort(key=lambda r: (-r.c, r.word))
    symbol = {r.word: i for i, r in enumerate(found[: settings.own_symbols])}
    words = np.array([r.word for r in found], dtype=np.int64).view(np.uint64)
    order = np.argsort(words)
    known = Words(
        tokens, distinct, words[order], np.array([r.c for r in found], dtype=np.int64)[order],
        np.array([symbol.get(r.word, -1) for r in found], dtype=np.int64)[order], np.zeros(0),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, settings.symbols))
        for batch in batches:
            at = symbols_of(batch.column(0).to_numpy().view(np.uint64), known, settings)
            sums += np.bincount(at, batch.column(1).to_numpy(), settings.symbols), np.bincount(at, minlength=settings.symbols)
        used = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[0][used]), pa.array(sums[1][used])], ["s", "c", "v"])

    sizes = np.full(settings.symbols, 0.5)
    per_symbol = counts.mapInArrow(run, "s bigint, c double, v double").groupBy("s").agg(F.sum("c").alias("c"), F.sum("v").alias("v"))
    for r in per_symbol.collect():  # one row a symbol
        sizes[r.s] = r.c + 0.5 * (r.v + 1)
    return replace(known, symbol_log=np.log10(sizes))


def coded(rows: DataFrame, known: Words, settings: HmmSettings) -> DataFrame:
    """(doc_id, mark, train, symbols, n_tokens, heavy_known, heavy_log) of (doc_id, mark, train, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column("body")):
                words, counts = _sequences(part)
                symbols = symbols_of(words, known, settings)
                row = np.repeat(np.arange(len(part)), counts)
                is_heavy, c = _heavy_counts(words, known)
                logs = np.bincount(row, np.where(is_heavy, np.log10(c + 0.5), 0.0) - known.symbol_log[symbols], len(part))
                plain = np.bincount(row, np.where(is_heavy, np.log10(c + 0.5), 0.0), len(part))
                ends = np.concatenate([[0], np.cumsum(counts)]) * 2
                data = symbols.astype(np.uint16).tobytes()
                here = batch.slice(at, len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        here.column("doc_id"), here.column("mark"), here.column("train"),
                        pa.array([data[a:b] for a, b in zip(ends[:-1], ends[1:])], pa.binary()), pa.array(counts.astype(np.int64)),
                        pa.array(np.bincount(row, is_heavy, len(part)).astype(np.int64)), pa.array(plain), pa.array(logs),
                    ],
                    ["doc_id", "mark", "train", "symbols", "n_tokens", "heavy_known", "heavy_log", "word_log"],
                )
                at += len(part)

    kind = "doc_id bigint, mark int, train boolean, symbols binary, n_tokens bigint, heavy_known bigint, heavy_log double, word_log double"
    return rows.select("doc_id", "mark", "train", "body").mapInArrow(run, kind)


def _heavy_counts(words: np.ndarray, known: Words) -> tuple[np.ndarray, np.ndarray]:
    if not len(known.heavy):
        return np.zeros(len(words), dtype=bool), np.zeros(len(words))
    at = np.minimum(np.searchsorted(known.heavy, words), len(known.heavy) - 1)
    found = known.heavy[at] == words
    return found, np.where(found, known.counts[at], 0)


def rare_words(rows: DataFrame, known: Words) -> DataFrame:
    """(doc_id, mark, word, n): the words of each row that are not sent to the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column("body")):
                words, counts = _sequences(part)
                row = np.repeat(np.arange(len(part)), counts)
                rare = ~_heavy_counts(words, known)[0]
                words, row = words[rare], row[rare]
                order = np.lexsort((words, row))
                words, row = words[order], row[order]
                new = np.ones(len(words), dtype=bool)
                new[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.concatenate([first, [len(words)]]))
                here = batch.slice(at, len(part))
                pick = pa.array(row[first])
                yield pa.RecordBatch.from_arrays(
                    [here.column("doc_id").take(pick), here.column("mark").take(pick), pa.array(words[first].view(np.int64)), pa.array(n)],
                    ["doc_id", "mark", "word", "n"],
                )
                at += len(part)

    return rows.select("doc_id", "mark", "body").mapInArrow(run, "doc_id bigint, mark int, word bigint, n bigint")


@dataclass(frozen=True)
class _Grid:
    """Stretches of all texts, longest first: `symbols` (steps x stretches), and how many are `live` at each step."""

    symbols: np.ndarray
    live: np.ndarray
    text: np.ndarray
    rounds: list[np.ndarray]  # the first stretch of each text, the second, ...


def _stretches(symbols: np.ndarray, counts: np.ndarray) -> _Grid:
    per_text = -(-counts // _STRETCH)
    text = np.repeat(np.arange(len(counts)), per_text)
    place = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    length = np.minimum(counts[text] - place * _STRETCH, _STRETCH)
    order = np.argsort(-length, kind="stable")
    text, place, length = text[order], place[order], length[order]
    first = (np.cumsum(counts) - counts)[text] + place * _STRETCH
    at = np.minimum(first[None, :] + np.arange(_STRETCH)[:, None], len(symbols) - 1)
    live = np.searchsorted(-length, -np.arange(_STRETCH), side="left")
    by_place = np.argsort(place, kind="stable")
    edges = np.searchsorted(place[by_place], np.arange(place.max() + 2))
    return _Grid(symbols[at], live, text, [by_place[i:j] for i, j in zip(edges[:-1], edges[1:])])


def _transfers(grid: _Grid, model: Hmm, emits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each stretch's product of move-and-emit matrices, scaled to a sum of 1, and the log10 of the scale."""
    s = len(model.start)
    out = np.tile(np.eye(s, dtype=np.float32), (len(grid.text), 1, 1))
    logs = np.zeros(len(grid.text))
    for t in range(_STRETCH):
        k = grid.live[t]
        moved = (out[:k].reshape(-1, s) @ model.moves).reshape(-1, s, s)
        moved *= emits[grid.symbols[t, :k]][:, None, :]
        if t % 4 == 3 or t == _STRETCH - 1 or k != grid.live[t + 1]:
            scale = moved.reshape(-1, s * s).sum(axis=1)
            moved /= scale[:, None, None]
            logs[:k] += np.log10(scale)
        out[:k] = moved
    return out, logs


def _by_symbol(model: Hmm) -> np.ndarray:
    """Emission chances by symbol, times the number of symbols, so that products stay near 1."""
    return np.ascontiguousarray(model.emits.T) * np.float32(model.emits.shape[1])


def forward(symbols: np.ndarray, counts: np.ndarray, model: Hmm) -> tuple:
    """log10 likelihood of each text's symbols, and what the backward part needs."""
    emits = _by_symbol(model)
    grid = _stretches(symbols, counts)
    transfer, logs = _transfers(grid, model, emits)
    enter = np.zeros((len(grid.text), len(model.start)))
    state = np.tile(model.start.astype(np.float64), (len(counts), 1))
    total = -counts * np.log10(float(model.emits.shape[1]))
    for rows in grid.rounds:
        own = grid.text[rows]
        enter[rows] = state[own]
        after = np.einsum("ni,nij->nj", state[own], transfer[rows])
        scale = after.sum(axis=1)
        state[own] = after / scale[:, None]
        total[own] += np.log10(scale) + logs[rows]
    return total, grid, transfer, enter, emits


def expected_counts(symbols: np.ndarray, counts: np.ndarray, model: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions of the texts, and their log10 likelihood."""
    total, grid, transfer, enter, emits = forward(symbols, counts, model)
    s, n = len(model.start), len(grid.text)
    leave = np.ones((n, s))
    behind = np.ones((len(counts), s))
    for rows in reversed(grid.rounds):
        own = grid.text[rows]
        leave[rows] = behind[own]
        before = np.einsum("nij,nj->ni", transfer[rows], behind[own])
        behind[own] = before / before.sum(axis=1, keepdims=True)
    starts = model.start * behind
    starts = (starts / starts.sum(axis=1, keepdims=True)).sum(axis=0)
    alpha = np.zeros((_STRETCH + 1, n, s), dtype=np.float32)
    alpha[0] = enter
    ones = np.ones((s, 1), dtype=np.float32)
    for t in range(_STRETCH):
        k = grid.live[t]
        moved = (alpha[t, :k] @ model.moves) * emits[grid.symbols[t, :k]]
        alpha[t + 1, :k] = moved / (moved @ ones)
    beta = leave.astype(np.float32)
    moves = np.zeros((s, s))
    gamma = np.zeros((_STRETCH, n, s), dtype=np.float32)
    for t in range(_STRETCH - 1, -1, -1):
        k = grid.live[t]
        both = alpha[t + 1, :k] * beta[:k]
        gamma[t, :k] = both / (both @ ones)
        ahead = emits[grid.symbols[t, :k]] * beta[:k]
        back = ahead @ model.moves.T
        weighted = alpha[t, :k] / ((alpha[t, :k] * back) @ ones)
        moves += (weighted.T @ ahead) * model.moves
        beta[:k] = back / (back @ ones)
    seen = grid.symbols.ravel()
    emitted = np.stack([np.bincount(seen, gamma[:, :, j].ravel(), model.emits.shape[1]) for j in range(s)])
    return starts, moves, emitted, float(total.sum())


def _grouped(batches: Iterator[pa.RecordBatch], limit: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Symbols and lengths of runs of rows with about `limit` tokens."""
    for batch in batches:
        lengths = np.array([len(x) // 2 for x in batch.column("symbols").to_pylist()])
        run = np.cumsum(lengths) // limit
        for k in np.unique(run):
            at = np.flatnonzero(run == k)
            part = batch.slice(at[0], len(at))
            symbols = np.frombuffer(b"".join(part.column("symbols").to_pylist()), dtype=np.uint16).astype(np.int64)
            yield symbols, lengths[at], part


def fit(texts: DataFrame, known: Words, settings: HmmSettings) -> tuple[Hmm, list[float]]:
    """Baum-Welch over (symbols); also the log10 likelihood before each round."""
    s, size = settings.states, settings.symbols
    rng = np.random.default_rng(settings.seed)
    frequency = np.full(size, 0.5)
    np.add.at(frequency, known.symbol[known.symbol >= 0], known.counts[known.symbol >= 0])
    frequency[settings.own_symbols :] += max(0, known.tokens - int(frequency.sum())) / settings.shared_symbols
    emits = frequency * np.exp(rng.normal(0, 0.7, (s, size)))
    model = Hmm(
        np.full(s, 1 / s, dtype=np.float32), (np.full((s, s), 0.2 / s) + 0.8 * np.eye(s)).astype(np.float32),
        (emits / emits.sum(axis=1, keepdims=True)).astype(np.float32),
    )
    likelihoods = []
    for _ in range(settings.rounds):
        shared = texts.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sums, likelihood = None, 0.0
            for symbols, lengths, _ in _grouped(batches):
                *found, value = expected_counts(symbols, lengths, shared.value)
                sums = found if sums is None else [a + b for a, b in zip(sums, found)]
                likelihood += value
            if sums is not None:
                flat = np.concatenate([[likelihood], sums[0], sums[1].ravel(), sums[2].ravel()])
                used = np.flatnonzero(flat)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], ["at", "value"])

        found = texts.select("symbols").mapInArrow(run, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("value"))
        flat = np.zeros(1 + s + s * s + s * size)
        rows = found.collect()  # as many numbers as the model has
        if not rows:
            break
        flat[[r["at"] for r in rows]] = [r["value"] for r in rows]
        likelihoods.append(float(flat[0]))
        starts, moves, emitted = flat[1 : 1 + s] + 1, flat[1 + s : 1 + s + s * s].reshape(s, s) + 1, flat[1 + s + s * s :].reshape(s, size)
        emitted = emitted + 2.0 * frequency / frequency.mean() * 0.5
        model = Hmm(
            (starts / starts.sum()).astype(np.float32), (moves / moves.sum(axis=1, keepdims=True)).astype(np.float32),
            (emitted / emitted.sum(axis=1, keepdims=True)).astype(np.float32),
        )
    return model, likelihoods


def score_symbols(texts: DataFrame, model: Hmm) -> DataFrame:
    """`texts` (coded) without its symbols, with `chain_log`: log10 likelihood of the symbol sequence."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            one = pa.RecordBatch.from_arrays([batch], ["symbols"])
            found = [forward(symbols, lengths, shared.value)[0] for symbols, lengths, _ in _grouped(iter([one]))]
            yield pa.array(np.concatenate([np.zeros(0), *found]))

    return texts.withColumn("chain_log", run("symbols")).drop("symbols")


def score_documents(documents: DataFrame, train: str, id: str = "doc_id", text: str = "text", settings: HmmSettings = HmmSettings()) -> DataFrame:
    """Train on the rows whose boolean column `train` holds, score all.

    Returns doc_id, train, n_tokens, n_known, train_tokens, base_score and score (log10).
    """
    rows = documents.select(
        F.col(id).cast("bigint").alias("doc_id"), F.hash(F.col(text)).alias("mark"), F.col(train).alias("train"), F.col(text).alias("body")
    )
    counts = cut_lineage(count_words(rows.where("train")), "words")
    known = learn_words(counts, settings)
    texts = cut_lineage(coded(rows, known, settings), "coded")
    model, _ = fit(texts.where("train"), known, settings)
    # rows with the same id and text share a key: their sums are divided by how many they are
    rare = rare_words(rows, known).join(counts, "word", "left").groupBy("doc_id", "mark").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
    )
    copies = texts.groupBy("doc_id", "mark").agg(F.count("*").alias("copies"))
    named = rare.join(copies, rare.doc_id.eqNullSafe(copies.doc_id) & (rare.mark == copies.mark)).select(
        rare.doc_id.alias("key"), rare.mark.alias("key_mark"), (F.col("rare_log") / F.col("copies")).alias("rare_log"),
        F.expr("rare_known div copies").alias("rare_known"),
    )
    scored = score_symbols(texts, model).join(named, F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("mark") == F.col("key_mark")), "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    all_log = float(np.log10(known.tokens + 0.5 * (known.distinct + 1)))
    return scored.select(
        "doc_id", "train", "n_tokens", (F.col("heavy_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"), (F.col("heavy_log") + rare_log - F.col("n_tokens") * all_log).alias("base_score"),
        (F.col("chain_log") + F.col("word_log") + rare_log).alias("score"),
    )
