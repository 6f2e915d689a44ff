"""Links of two tokenizers, their corpus counts and digests against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from dayledger.llm import alignment as A

public = pytest.importorskip("public_tokenizers")
PATHS = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


def spans(ids, tokens):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(tokens[i])))
        at += len(tokens[i])
    return out


def brute_text(text):
    """(A spans, B spans) by the libraries alone; None without tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    own = A.tokenizers(*PATHS)
    whole = Tokenizer.from_file(PATHS[0])
    whole.encode_special_tokens = True
    a = whole.encode(" " + (text or ""), add_special_tokens=False).ids
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1]).encode(text or "", num_threads=1)
    data = b" " + (text or "").encode()
    if not text or b"".join(own.a_bytes[i] for i in a) != data or b"".join(own.b_bytes[i] for i in b) != data:
        return None
    return spans(a, own.a_bytes), spans(b, own.b_bytes)


def brute(texts):
    all_spans = [brute_text(t) for t in texts]
    links = [[] if s is None else [(x[0], y[0]) for x in s[0] for y in s[1] if x[1] < y[2] and y[1] < x[2]] for s in all_spans]
    counts = Counter(p for one in links for p in one)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for s, one in zip(all_spans, links):
        if s is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        ends = sorted({x[2] for x in s[0]} & {y[2] for y in s[1]})
        starts = [0, *ends[:-1]]
        sides = ["|".join(",".join(str(x[0]) for x in side if lo <= x[1] and x[2] <= hi) for side in s) for lo, hi in zip(starts, ends)]
        best, total = sum(counts[p] == most[p[1]] for p in one), sum(counts[p] for p in one)
        out.append((len(s[0]), len(s[1]), len(ends), len(one), best, total, hashlib.sha256(";".join(sides).encode()).hexdigest()))
    return out, counts, most


def some_texts(count=60):
    rng = random.Random(4)
    stock = ["the ", "unbelievable", "Straße ", "日本語", "\U0001f600", "<s>", "<|endoftext|>", "don't ", "   ", "\n\n", "▁", "0123", "é", "\0", "x" * 40, " of", "привет ", "́", "．"]
    texts = ["".join(rng.choice(stock) for _ in range(rng.randint(1, 40))) for _ in range(count)]
    return [*texts, None, "", " ", "▁", "ﬁ", "a", "a", "  a  ", "the words of a plain text " * 400]


def test_equals_brute_force(spark):
    texts = some_texts()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "the text"), (3, "the text")]
    rows = [(*r, "x")[:3] for r in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string, piece string").repartition(5)
    want, counts, most = brute([r[1] for r in rows])
    got = A.align(frame, *PATHS).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in got) == sorted((-1 if r[0] is None else r[0], *w) for r, w in zip(rows, want))
    pairs = {(r.a_id, r.b_id): (r.links, r.best) for r in A.pair_counts(frame, *PATHS).collect()}
    assert pairs == {p: (n, n == most[p[1]]) for p, n in counts.items()}


def test_cut_texts_and_small_runs_change_nothing(spark, monkeypatch):
    texts = some_texts(30)
    own = A.tokenizers(*PATHS)
    whole = [A.align_text(t or "", own) for t in texts]
    monkeypatch.setattr(A, "PART", 20)
    assert len(list(own.parts(texts[-1]))) > 100
    for t, w in zip(texts, whole):
        cut = A.align_text(t or "", own)
        assert cut[0] == w[0] and (cut[1] == w[1]).all() and (cut[2] == w[2]).all()
    monkeypatch.setattr(A, "RUN_RECORDS", 100)
    monkeypatch.setattr(A, "MERGE_RECORDS", 50)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert [tuple(r)[1:] for r in sorted(A.align(frame, *PATHS).collect())] == brute(texts)[0]
    assert A.align(frame.where("false"), *PATHS).collect() == []


def test_merge_of_runs():
    shift, rng = 4, random.Random(1)
    runs = []
    for _ in range(9):
        pairs = sorted(rng.sample(range(200), rng.randint(0, 150)))
        runs.append((np.array(pairs, dtype=np.int64), np.array([rng.randint(1, 5) for _ in pairs], dtype=np.int64)))
    total, most = Counter(), Counter()
    for pairs, counts in runs:
        total.update(dict(zip(pairs.tolist(), counts.tolist())))
    for p, n in total.items():
        most[p >> shift] = max(most[p >> shift], n)
    merged = list(A.merge_runs(runs, shift))
    assert [(p, n, best) for p, n, best, _ in merged] == [(p, n, n == most[p >> shift]) for p, n in sorted(total.items())]
    assert all(sorted(numbers) == [i for i, r in enumerate(runs) if p in r[0]] for p, _, _, numbers in merged)
