"""Registered queries of the operators: each applies one of them, with its defaults, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, fresh_path
from . import (
    alignment, bpe, collocations, decontamination, hidden_markov, language_id, line_dedup, near_dup, neighbours, quotes, toxicity, url_filter, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(id: str, folds: int) -> Column:
    """crc32 of the id as text, by its remainder; a NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file; the operators take any."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_columns() -> list[Column]:
    """Digests of the `ids` and `decoded` columns."""
    return [
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    ]


@query
def op1_quotation_linking(spark: SparkSession, sf: str) -> DataFrame:
    messages = quotes.reply_ordered(table(spark, sf, "conversations"))
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("text"))
    return messages.withColumn("formatted", line)


@query
def op2_tree_bpe(spark: SparkSession, sf: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf, "documents").select("doc_id", "text"), vocabulary())
    decoded = bpe.decode(encoded.select("doc_id", "ids"), vocabulary())
    return decoded.select("doc_id", *token_columns())


@query
def op3_simhash_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    found = decontamination.matches(documents, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "contaminated", F.transform("matches", lambda m: m["item"]).alias("item_ids"),
        F.transform("matches", lambda m: m["start"]).alias("first_words"),
        F.array_max(F.transform("matches", lambda m: m["similarity"])).alias("similarity"),
    )


@query
def op4_nn_descent_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_superminhash_near_dup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf, "documents"), percent=85)


@query
def op6_hidden_markov_lm(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "text", (fold("doc_id", 5) != 1).alias("learn"))
    scored = hidden_markov.score_documents(rows, "learn")
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op7_boundary_chain_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    warc.write_archives(table(spark, sf, "pages"), path)
    derive = {"payload_bytes": lambda p: F.octet_length(p).cast("bigint"), "payload_digest": warc.base32_sha1}
    records = warc.read_archives(spark, path, derive).select(
        warc.id_of("record_id").alias("page_id"), "record_type", warc.id_of("refers_to").alias("refers_to"), "payload_bytes",
        "payload_digest", F.regexp_extract("digest", "^sha1:(.*)$", 1).alias("told"),
    )
    records = cut_lineage(records, "records")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    first = records.where("record_type = 'response'")
    # a revisit has the payload of the record that it refers to
    origin = first.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("told"), F.col("payload_bytes").alias("b")).distinct()
    again = records.where("record_type = 'revisit'").join(origin, ["refers_to", "told"]).withColumns(
        {"payload_bytes": F.col("b"), "payload_digest": F.col("told")}
    )
    return first.select(columns).unionByName(again.select(columns))


#: Verdict, host and path of each rule.
URL_RULES = [
    (url_filter.ALLOW, "org", "/"),
    (url_filter.BLOCK, "example.org", "/es/"),
    (url_filter.BLOCK, "example.org", "/en/1"),
    (url_filter.ALLOW, "com", "/fr/"),
    (url_filter.BLOCK, "com", "/de/"),
]


@query
def op8_host_segmentation_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf, "pages").select("page_id", "url", "html"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "odds")


@query
def op9_hyperdimensional_language_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    profiles = language_id.train(rows.where(~F.col("held_out")))
    found = language_id.predict(rows.select("doc_id", "held_out", "text"), profiles)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query
def op10_factorization_machine_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.train(documents, labels.where(fold("doc_id", 3) != 1))
    scored = toxicity.score(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op11_spill_counted_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(table(spark, sf, "documents").select("doc_id", "text"), vocabulary(), vocabulary("piece_bpe_32k.model"))


@query
def op12_two_bloom_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op13_setm_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents").select("lang", "text"))


# Five hex digits are twenty bits: four letters of base32.
ORACLES["op7_boundary_chain_warc"] = """
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(sha1(body), (1 + 5 * (i // 4))::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM (SELECT page_id, body, max(page_id) OVER (PARTITION BY body) AS last FROM (SELECT page_id, coalesce(html, '') AS body FROM pages))"""


ORACLES["op12_two_bloom_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
), keyed AS (
    SELECT doc_id, line, place, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), firsts AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE first <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN firsts USING (key) GROUP BY doc_id"""

ORACLES["op13_setm_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
           string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS all_pieces
    FROM documents
), one AS (
    SELECT lang, list_filter(string_split_regex(unnest(all_pieces), '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM one GROUP BY lang),
grams AS (
    SELECT lang, size, array_to_string(w[start:start + size - 1], ' ') AS phrase
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS start FROM one, range(1, 5) AS sizes(size))
), f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
    SELECT lang, phrase, f AS a, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS head, array_to_string(string_split(phrase, ' ')[cut + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, size)) AS cut FROM f WHERE size > 1)
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, (2000000 * c.a::HUGEINT // (x.f + y.f))::BIGINT AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM f WHERE f.lang = b.lang AND f.size > len(string_split(b.phrase, ' ')) AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * f.f::HUGEINT >= 80 * b.a::HUGEINT)
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE C) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= 2000"""
