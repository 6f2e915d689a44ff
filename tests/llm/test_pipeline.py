"""The stages of the corpus pipeline: what goes, what stays, and columns."""

import corpus_pipeline
from dayledger.llm.queries import table

from .test_text_sets import brute_groups, brute_set


def test_stages_keep_columns_and_drop_what_they_should(spark, sf):
    docs = table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language", "near_duplicates", "decontamination", "tokens"]
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, sf)
    assert kept.columns == docs.columns
    groups = brute_groups(list(rows.items()), 80)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, first) in groups.items() if i == first)
    items = [brute_set(r.text) for r in table(spark, sf, "benchmark").collect()]
    clean = {r.doc_id for r in corpus_pipeline.drop_benchmark(spark, docs, sf).collect()}
    assert clean == {i for i, t in rows.items() if not any(len(s & brute_set(t)) >= 0.8 * len(s) for s in items if s)}
    spoken = corpus_pipeline.drop_unknown_language(spark, docs.unionByName(docs.limit(1).selectExpr("-1L doc_id", "'12 34 --' text", "lang", "source", "n_chars")), sf)
    assert spoken.columns == docs.columns and {r.doc_id for r in spoken.collect()} == set(rows)


def test_whole_run(spark, sf):
    found = corpus_pipeline.run(spark, sf).collect()
    assert found and all(r.round_trip for r in found) and len({r.doc_id for r in found}) == len(found)


def test_empty_and_odd_tables(spark, sf):
    docs = table(spark, sf, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (5, "the words of this text", "en", "s", 1)] * 2, docs.schema)
    for rows in (docs.where("false"), odd):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, sf)
            rows.collect()


def test_further_columns_of_any_name_go_through(spark, sf):
    docs = table(spark, sf, "documents").limit(40)
    named = docs.selectExpr("*", "doc_id AS score", "concat('l', doc_id) AS found", "1.5D AS cosine", "'d' AS decoded", "7 AS _lang", "'c' AS contaminated", "array(1) AS matches")
    want = {r.doc_id: r[5:] for r in named.collect()}
    for _, stage in corpus_pipeline.STAGES[:4]:
        named = stage(spark, named, sf)
        assert {r.doc_id: r[5:] for r in named.collect()}.items() <= want.items() and named.columns[5:10] == ["score", "found", "cosine", "decoded", "_lang"]
    tokens = corpus_pipeline.encode_tokens(spark, named, sf)
    assert all(r.decoded == "d" and r.round_trip for r in tokens.collect())


def test_of_repeated_ids_the_same_row_stays(spark, sf):
    schema = table(spark, sf, "documents").schema
    rows = [(1, f"text number {i} of one id with words enough", "en", "s", i) for i in range(6)] + [(2, None, None, None, None), (2, "", "en", "s", 0), (3, "alone", "en", "s", 5)]
    kept = [sorted(map(str, corpus_pipeline.keep_one_of_each_group(spark, spark.createDataFrame(x, schema).repartition(n), sf).collect())) for x, n in ((rows, 3), (rows[::-1], 1))]
    assert kept[0] == kept[1] and len(kept[0]) == 3


def test_lettered_junk_goes_and_short_text_stays(spark, sf):
    import random

    rng = random.Random(6)
    docs = table(spark, sf.replace("0.001", "0.01"), "documents")
    junk = [" ".join("".join(rng.choice("0123456789abcdef") for _ in range(8)) for _ in range(60)) for _ in range(40)]
    junk += [" ".join("".join(rng.choice("qxzjkvwpybgf") for _ in range(7)) for _ in range(60)) for _ in range(40)]
    odd = spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(junk)] + [(10**9, "A", None, "s", 1)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.drop_unknown_language(spark, docs.unionByName(odd), sf).collect()}
    assert {r.doc_id for r in docs.collect()} <= kept and 10**9 in kept
    assert sum(i < 0 for i in kept) <= 4


def test_bands_follow_the_threshold():
    from dayledger.llm import near_dup

    assert near_dup.bands_for(85) == (28, 6) and near_dup.bands_for(80) == (34, 5)
    for percent in (50, 70, 80, 85, 90, 95, 100):
        bands, rows = near_dup.bands_for(percent)
        assert (1 - min(0.999999, percent / 100) ** rows) ** bands <= 2e-6
