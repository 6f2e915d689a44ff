"""Token ids and decoded texts equal to those of the tokenizers library, cut up in every way."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from dayledger.llm import bpe

tokenizers = pytest.importorskip("public_tokenizers")
PATH = tokenizers.path("byte_bpe_50k.json")


def test_classes_agree_on_the_characters_given_to_the_fast_library():
    own = bpe.codec(PATH)
    for c in map(chr, range(0x10000)):
        if not 0xD800 <= ord(c) < 0xE000 and bpe.AGREED.fullmatch(c):
            text = f"a{c}a{c}{c} {c}1{c}1!{c}! {c}\n {c}"
            pieces = [text[a:b] for _, (a, b) in own.whole.pre_tokenizer.pre_tokenize_str(text)]
            assert regex.findall(bpe.SPLIT, text) == pieces, hex(ord(c))
            assert own.fast.encode(text) == own.whole.encode(text, add_special_tokens=False).ids, hex(ord(c))


def test_joins_equal_the_whole():
    own, rng, joined = bpe.codec(PATH), random.Random(1), 0
    for _ in range(400):
        letters = rng.choice(["ab", "abc", "the", "é日本语", "!?.-", "   \n\t", "0123", "aàbß"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(2, 400)))
        if len(regex.findall(bpe.SPLIT, text)) == 1:
            at = rng.randint(1, len(text) - 1)
            left, right = text[:at], text[at:]
            got = bpe.join_encodings(left, own.encode(left), right, own.encode(right), own.encode, own.lengths, grow=1)
            assert got.tolist() == own.encode(text).tolist()
            joined += 1
    assert joined > 200


def test_round_trip_of_all_kinds_of_text(spark):
    rng = random.Random(3)
    noise = "".join(rng.choice("abcdefgh") for _ in range(9000))
    texts = [
        "a" * 5000 + " b", None, "", "x<|endoftext|>y" + "日本" * 3000 + " z", " " * 4000 + "x'll", "\0 \x85 ᠎",
        "word " * 3000 + noise + "!" * 3000, "hello world", "\U0001f600" * 10, noise, noise,
        "مرحبا بالعالم " * 900, "नमस्ते" * 300 + "\U0001f600" * 300 + " สวัสดี" * 800, "é́" * 100,
    ]
    frame = spark.createDataFrame([(i % 9, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    whole = bpe.codec(PATH).whole
    want = sorted((whole.encode(t or "", add_special_tokens=False).ids, t or "") for t in texts)
    for leaf in (64, 4096, 10**9):
        found = bpe.decode(bpe.encode(frame, PATH, leaf=leaf), PATH).collect()
        assert sorted((r.ids, r.decoded) for r in found) == want
    assert bpe.encode(frame.where("false"), PATH).collect() == []


def test_one_column_and_clashing_names(spark):
    texts = ["a" * 40_000, "short", "b" * 33_000]
    alone = spark.createDataFrame([(t,) for t in texts], "text string")
    assert sorted(r.text for r in bpe.encode(alone, PATH).collect()) == sorted(texts)
    named = alone.withColumn("key", F.lit("k")).withColumn("IDS_", F.lit("i"))
    found = bpe.encode(named, PATH, output="tokens")
    assert found.columns == ["text", "key", "IDS_", "tokens"]
    whole = bpe.codec(PATH).whole
    assert sorted((r.text, r.key, r.tokens) for r in found.collect()) == sorted((t, "k", whole.encode(t).ids) for t in texts)


def test_joins_of_texts_equal_the_whole():
    own, rng = bpe.codec(PATH), random.Random(2)
    stock = ["the ", " of", "don't", "I'll", "we've", "'", "'r", "e", "'s", "  ", "   \n", "\n", "\t", " ", "a", "Straße", "12 345", "!?", "...", "日本語", "\U0001f600", "نص ", "x" * 50, "é", "\x85", "\u200d", "\u0301"]
    for _ in range(3000):
        text = "".join(rng.choice(stock) for _ in range(rng.randint(1, 30)))
        at = rng.randint(0, len(text))
        left, right = text[:at], text[at:]
        for near in (1, 7, 1000):
            got = bpe.join_texts(left, own.encode(left), right, own.encode(right), own, near)
            assert got.tolist() == own.encode(text).tolist(), (left, right)


def test_texts_of_the_tables_take_the_tree(spark, sf):
    """Long texts of the given documents are cut, joined in rounds, and equal to the library's encoding."""
    documents = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/documents.parquet").select("doc_id", "text")
    texts = documents.where(f"length(text) > {bpe.LEAF}")
    own = bpe.codec(PATH)
    rows = {r.doc_id: r.text for r in texts.collect()}
    assert len(rows) > 3 and max(leaves for t in rows.values() for _, _, leaves, _ in bpe.cut_text(t, bpe.LEAF, own.special)) >= 4
    assert {r.doc_id: r.ids for r in bpe.encode(texts, PATH).collect()} == {i: own.whole.encode(t, add_special_tokens=False).ids for i, t in rows.items()}
