"""Lines held by several documents: the filters lose none, and the result is that of brute force."""

import random
import string
from collections import defaultdict

import numpy as np

from dayledger.llm import line_dedup


def brute_key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, least=10):
    holders = defaultdict(set)
    named = [(2**63 - 1 if i is None else i, t or "") for i, t in rows]
    for i, t in named:
        for line in t.split("\n"):
            holders[brute_key(line)].add(i)
    out = []
    for i, t in named:
        lines = t.split("\n")
        gone = [len(k := brute_key(x)) >= least and len(holders[k]) > 1 and min(holders[k]) != i for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out)


def found(frame, **settings):
    rows = line_dedup.drop_repeated_lines(frame, **settings).collect()
    return sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows)


def test_filters_hold_all_that_was_added_and_little_else():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 2**64, 50_000, dtype=np.uint64)
    own = line_dedup.Bloom(len(hashes))
    own.add(hashes)
    assert own.holds(hashes).all()
    assert own.holds(rng.integers(0, 2**64, 50_000, dtype=np.uint64)).mean() < 0.03


def test_suspects_hold_every_repeat():
    rng = np.random.default_rng(3)
    pieces = [np.unique(rng.integers(0, 3000, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(5)]
    again = [rng.random(len(p)) < 0.01 for p in pieces]
    times = defaultdict(int)
    for p, a in zip(pieces, again):
        for h, x in zip(p.tolist(), a.tolist()):
            times[h] += 1 + x
    for p, s in zip(pieces, line_dedup.suspects_of(list(zip(pieces, again)))):
        assert {h for h in p.tolist() if times[h] > 1} <= set(s.tolist())
    single = [p for p in pieces[0].tolist() if times[p] == 1]
    assert len(set(line_dedup.suspects_of(list(zip(pieces, again)))[0].tolist()) & set(single)) < 0.1 * len(single) + 2


def test_equals_brute_force(spark):
    rng = random.Random(5)
    stock = ["".join(rng.choice(string.ascii_letters + "é日 ") for _ in range(rng.randint(5, 14))) for _ in range(40)]
    rows = [(i, "\n".join(rng.choice([" ", "", "\t", "\r"]) + rng.choice(stock) + rng.choice(["", " ", "\r", "\x0b"]) for _ in range(rng.randint(0, 9)))) for i in range(120)]
    rows += [(i % 50, "the very same line in every document\nMIXED Case line\nmixed case LINE") for i in range(200)]
    rows += [(None, "the very same line in every document\nalone here, twice\nalone here, twice"), (None, None), (7, ""), (500, None)]
    rows += [(600, "\n".join(f"a line of a long text {i % 70_000}" for i in range(150_000))), (601, "a line of a long text 69999\n\n"), (602, "\n")]
    rows += [(603, " \x85 not an end of line \x1c"), (604, " \x85 not an end of line \x1c\nok"), (605, "日本語日本語日本語日"), (606, " 日本語日本語日本語日"), (607, "日本語日本語日本語"), (608, "日本語日本語日本語")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = brute(rows)
    assert found(frame) == want
    # many pieces and many small segments change nothing
    assert found(frame.where("doc_id is null or doc_id < 600"), piece_lines=50, segment_lines=20) == brute([r for r in rows if r[0] is None or r[0] < 600])


def test_further_columns_and_empty_tables(spark):
    rows = [(1, "one line of text", 5, "x", "d"), (2, "ONE line of text \nb", 6, "y", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, id string, digests string")
    kept = line_dedup.drop_repeated_lines(frame)
    assert kept.columns == ["doc_id", "text", "id", "digests", "n_lines", "n_dropped"]
    assert sorted(map(tuple, kept.collect())) == [(1, "one line of text", "x", "d", 1, 0), (2, "b", "y", None, 2, 1)]
    assert line_dedup.drop_repeated_lines(frame.where("false")).collect() == []
    short = line_dedup.drop_repeated_lines(frame, least=1).where("doc_id = 2").first()
    assert short.n_dropped == 1
