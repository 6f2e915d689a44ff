"""Collocations against brute force: counts, cuts, containment, ranks and the packed relations."""

import random
import re
from collections import Counter

import numpy as np

from dayledger.llm import collocations as C


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least=30, longest=4, share=80, first=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {k: v for k, v in f.items() if v >= least}
    out = {}
    for (lang, p), a in found.items():
        if len(p) > 1:
            inside = [v for (g, q), v in found.items() if g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * v >= share * a for v in inside):
                score, _, l, r = min((2_000_000 * a // (found[lang, p[:k]] + found[lang, p[k:]]), k, found[lang, p[:k]], found[lang, p[k:]]) for k in range(1, len(p)))
                out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((g, i, p.decode(), -a, l, r, n[g], -s) for g, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:first], 1))


def some_rows(seed, count=300):
    rng = random.Random(seed)
    words = ["the", "of", "New", "York", "city", "é", "日本", "x\0y", "\x1c", "a", "b\x85c", "und"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!?", "\r\n"]
    rows = []
    for _ in range(count):
        text = "".join(rng.choice(["new york city", "NEW YORK", "of the", *words]) + rng.choice(ends) for _ in range(rng.randint(0, 30)))
        rows.append((rng.choice(["en", "de", None, "und", ""]), text))
    return rows + [("en", None), (None, ""), ("fr", " \t"), ("de", "a a a a a a " * 2000)]


def found(spark, rows, **settings):
    frame = spark.createDataFrame([(g, t, "x") for g, t in rows], "lang string, text string, phrase string").repartition(5)
    return sorted(map(tuple, C.collocations(frame, **settings).collect()))


def test_equals_brute_force(spark):
    rows = some_rows(1)
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, least=8, longest=3, share=60, first=7) == brute(rows, 8, 3, 60, 7)


def test_small_rows_chunks_and_buckets_change_nothing(spark, monkeypatch):
    rows = some_rows(2, 80)
    monkeypatch.setattr(C, "CHUNK_BYTES", 20)
    got = [w for words in C.words_of("a b. c\nD e f g h i j k l m n o p, q") for w in words]
    assert b" ".join(got) == b"a b \xff c \xff d e f g h i j k l m n o p \xff q"
    monkeypatch.setattr(C, "BUCKET_ROWS", 10)
    assert found(spark, rows, least=5) == brute(rows, 5)


def test_empty_and_rare(spark):
    assert found(spark, []) == []
    assert found(spark, [("en", "each word once"), (None, None)]) == []


def test_merge_join_of_neighbours():
    places, left, right = C.neighbours(np.array([1, 2, 3, 5, 6, 9]), np.array([7, 8, 9, 7, 8, 1]))
    assert (places.tolist(), left.tolist(), right.tolist()) == ([1, 2, 5], [7, 8, 7], [8, 9, 8])


def test_counts_beyond_64_bits(spark):
    row = spark.sql("select cast(2000000 * cast(9000000000000000 as decimal(20, 0)) div (9000000000000000 + 9000000000000001) as bigint) s").first()
    assert row.s == 2_000_000 * 9_000_000_000_000_000 // 18_000_000_000_000_001
