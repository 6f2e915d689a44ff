"""From raw documents to training documents, in stages.

Each stage takes the rows its predecessor kept (written as Parquet and read again) and returns them less the ones it
rejects, in the columns of `documents`; the last one adds the token ids (`ids`) and `round_trip`.

Defined cases: an empty table goes through as an empty table; a NULL doc_id is kept by every stage that has no other
reason to reject the row; of rows with one doc_id the near-duplicate stage keeps the one whose values come first in order;
further columns of the documents go through unchanged, whatever their names (the last stage replaces `ids` and
`round_trip`, and all stages need `doc_id`, `text` and `lang`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm import bpe, decontamination, language_id, near_dup, toxicity
from dayledger.llm.packed import free_name
from dayledger.llm.queries import table, vocabulary
from dayledger.session import cut_lineage, remove_cut

#: A document is toxic from this score on.
TOXIC_FROM = 0.7
#: (characters from, cosine): a text at least that long whose cosine with every language is lower is in none of them. Half
#: the documents, held out from profiles of the others, lie above 0.29 at these lengths in 99 of 100 cases, shuffled
#: letters, hex dumps and base64 below 0.12 and 0.17; shorter texts overlap, so they only need a letter.
LANGUAGE_FROM = ((300, 0.17), (100, 0.12))

ORACLE_SQL = None  # fitted models and sketches: held against brute force in the tests


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: fit on the labelled documents that are here, reject those that score as toxic."""
    model, score = toxicity.train(docs, table(spark, sf_dir, "labels")), free_name(docs.columns, "score")
    return toxicity.score(docs, model, output=score).where(F.col(score) < TOXIC_FROM).drop(score)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language: profiles of the languages named in the documents; reject text without one, such as numbers or codes."""
    lang = free_name(docs.columns, "found")
    cosine = free_name([*docs.columns, lang], "cosine")
    found = language_id.predict(docs, language_id.train(docs), lang=lang, score=cosine)
    limit = F.lit(0.0)
    for characters, least in reversed(LANGUAGE_FROM):
        limit = F.when(F.length("text") >= characters, F.lit(least)).otherwise(limit)
    return found.where((F.col(lang) != language_id.UNKNOWN) & (F.col(cosine) >= limit)).drop(lang, cosine)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates: of each group linked at 0.8 or more, the document with the smallest id stays, once."""
    groups = near_dup.near_duplicates(docs, percent=80)
    gone = groups.where(~F.col("kept")).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    twice = cut_lineage(groups.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    # only rows that share their id are compared with each other, by all of their values as text
    shared = kept.join(twice, "doc_id", "left_semi").select(*docs.columns)
    order = F.struct(*[F.col(c).cast("string") for c in docs.columns])
    first = shared.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), order).alias("row")).select("row.*")
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(first)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: a document that holds a benchmark item goes."""
    # columns of the documents that are named like the operator's own step aside meanwhile
    aside = {c: free_name(docs.columns, f"{c}_given") for c in docs.columns if c.lower() in ("contaminated", "matches")}
    found = decontamination.matches(docs.withColumnsRenamed(aside), table(spark, sf_dir, "benchmark"))
    clean = found.where(~F.col("contaminated")).drop("contaminated", "matches")
    return clean.withColumnsRenamed({new: old for old, new in aside.items()}).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: token ids of each text, and whether they decode to the text."""
    encoded, decoded = bpe.encode(docs, vocabulary()), free_name([*docs.columns, "ids", "round_trip"], "decoded")
    return bpe.decode(encoded, vocabulary(), output=decoded).withColumn(
        "round_trip", F.col(decoded) == F.coalesce("text", F.lit(""))
    ).drop(decoded)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_benchmark),
    ("tokens", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if at == len(STAGES) - 1:
            return done
        written = cut_lineage(done, name)
        if at:
            remove_cut(docs)
        docs = written
    raise ValueError("no stages")
