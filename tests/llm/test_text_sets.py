"""Shingles, SuperMinHash, near-duplicate groups and components against brute force."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np

from dayledger.llm import components, near_dup, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_set(text, width=5):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute_groups(rows, percent):
    sets = {i: brute_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(sorted(sets), 2):
        shared = len(sets[i] & sets[j])
        if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def some_texts():
    rng = random.Random(4)
    vocabulary = [f"w{i}é" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    texts = ["", "  \t\n", "One", "one", "a b", "A B", "a b c d e", "\0 x", None, "a b c"]
    for edits in (0, 0, 1, 1, 2, 2, 2, 3, 3, 4, 5, 6, 8):
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words).upper() if edits == 2 else "\n".join(words))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (3, 50, 900, 30_000)]
    return texts + ["same words in every copy of this text"] * 30


def test_shingle_sets_are_those_of_brute_force():
    texts = [t or "" for t in some_texts()]
    found, counts = shingles.shingle_sets(texts)
    assert counts.tolist() == [len(brute_set(t)) for t in texts]
    assert len(set(found.tolist())) == len(set().union(*map(brute_set, texts)))


def test_signature_estimates_similarity():
    rng = random.Random(1)
    errors = []
    for share in (0.2, 0.5, 0.85):
        for n in (5, 60, 600):
            a, b = [], []
            for i in range(n):
                same = rng.random() < share
                a.append(i)
                b.append(i if same else i + 10_000)
            truth = len(set(a) & set(b)) / len(set(a) | set(b))
            hashes = shingles.mix(np.array(a + b, dtype=np.uint64))
            one, two = near_dup.superminhash(hashes, np.array([n, n]), 168)
            errors.append(abs((one == two).mean() - truth))
    assert max(errors) < 0.15 and np.mean(errors) < 0.05
    assert (near_dup.superminhash(np.zeros(0, np.uint64), np.array([0]), 8) == near_dup._UNSET).all()


def test_groups_are_those_of_brute_force(spark):
    rows = list(enumerate(some_texts()))
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    for percent in (85, 80):
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(frame, percent=percent, block=4).collect()}
        assert found == brute_groups(rows, percent)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.component_id, r.kept) for r in near_dup.near_duplicates(frame).collect())
    assert found == [(0, None, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    assert near_dup.near_duplicates(frame.where("false")).collect() == []


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7), (None, 3)]
    neighbours = defaultdict(set)
    for u, v in pairs:
        if u is not None and u != v:
            neighbours[u].add(v)
            neighbours[v].add(u)
    expected = {}
    for start in sorted(neighbours):
        if start not in expected:
            todo = [start]
            while todo:
                node = todo.pop()
                if node not in expected:
                    expected[node] = start
                    todo += neighbours[node]
    frame = spark.createDataFrame(pairs, "u long, v long")
    assert {r.node: r.component for r in components.components(frame).collect()} == expected
    assert components.components(frame.where("false")).collect() == []


def test_blocks_hold_each_member_of_the_largest_component_once(spark):
    # one bucket: 400 nodes of one component, 12 of three others
    placed = spark.range(412).selectExpr("7L AS key", "id AS node", "IF(id < 400, 0L, 400 + id % 3) AS component", "412L AS size")
    dealt = near_dup.dealt_to_blocks(placed, 10).toPandas()
    assert len(dealt) <= 412 * 2 + 12 * 42
    met = []
    for block, cell in dealt.groupby("block"):
        assert not cell.node.duplicated().any()
        for i in cell[cell.row == block >> 20].itertuples():
            others = cell[(cell.component != i.component) & (cell.column == block & (1 << 20) - 1) & ((cell.row < 0) | (cell.node > i.node))]
            met += [(min(i.node, j), max(i.node, j)) for j in others.node]
    component = lambda n: 0 if n < 400 else 400 + n % 3
    assert sorted(met) == [(i, j) for i in range(412) for j in range(max(i + 1, 400), 412) if component(i) != component(j)]
    alone = spark.range(5).selectExpr("7L AS key", "id AS node", "0L AS component", "5L AS size")
    assert near_dup.dealt_to_blocks(alone, 10).isEmpty()
