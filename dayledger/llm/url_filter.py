"""URL filtering by host rules, and by naive Bayes over segmented hosts and paths where no rule fits.

Hosts often join words without a mark. Their labels are split by a unigram model: the Viterbi split is the sequence of
words with the largest product of frequencies, words being counted over the text of all pages. All substrings of the
distinct labels meet the word counts in a join, so no vocabulary is held anywhere; the split itself is one small
recursion per label. A multinomial naive Bayes model over host words and path tokens then judges the URLs that no rule
decides; it learns from those that a rule does.

Counting and scoring go by distinct host and distinct path shape (numbers are one token), each with its number of
pages, so that a host or shape with a third of all pages is one row with a count. Pages meet those rows in joins whose
other side has one row a key, which Spark splits where a key is hot.

Defined cases: a URL that is NULL or has no `://` has an empty host and path, fits no rule and is judged on no token;
the longest fitting rule wins, of equally long ones the first in order; without a rule-decided page, or at even odds,
the verdict is allow; repeated pages are judged each. A label without letters has no words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

ALLOW, BLOCK = "allow", "block"
MAX_WORD = 24
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)://([^/?#]*)", 1))
    return F.translate(F.coalesce(after, F.lit("")), _CAPITALS, _SMALL)


def path_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1))
    return F.coalesce(after, F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, NULL where none fits; rules are (verdict, host, path)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in reversed(sorted(rules, key=lambda r: -len(r[1] + r[2]))):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def word_counts(texts: DataFrame, html: str) -> DataFrame:
    """(word, n) over the visible text of all pages."""
    plain = F.lower(F.regexp_replace(F.col(html), r"(?s)<(script|style)[^>]*>.*?</\1>|<[^>]*>", " "))
    words = texts.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word"))
    return words.where(F.length("word").between(1, MAX_WORD)).groupBy("word").agg(F.count("*").alias("n"))


def best_split(label: str, spans: list[tuple[int, str, int]], total: int) -> list[str]:
    """Words of the most probable split; a stretch of k characters that is no word has 1 / (total * 10^k)."""
    starts: dict[int, list[tuple[str, float]]] = {}
    for at, word, n in spans:
        starts.setdefault(at, []).append((word, math.log(n / total)))
    unknown = lambda k: -math.log(total) - k * math.log(10)
    best: list[tuple[float, list]] = [(0.0, [])] + [(-math.inf, [])] * len(label)
    for at in range(len(label)):
        score, before = best[at]
        options = dict(starts.get(at, []))
        for k in range(1, min(MAX_WORD, len(label) - at) + 1):
            options.setdefault(label[at : at + k], unknown(k))
        for word, value in options.items():
            if score + value > best[at + len(word)][0]:
                best[at + len(word)] = (score + value, [word, before])
    words, node = [], best[-1][1]
    while node:
        words.append(node[0])
        node = node[1]
    return words[::-1]


def segmented(labels: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(label, words) of distinct labels."""

    @F.arrow_udf("array<string>")
    def split(names: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for label, spans in names:
            found = [
                best_split(text, [(s["at"], s["word"], s["n"]) for s in own or []], total)
                for text, own in zip(label.to_pylist(), spans.to_pylist())
            ]
            yield pa.array(found, pa.list_(pa.string()))

    places = labels.select("label", F.explode(F.sequence(F.lit(0), F.length("label") - 1)).alias("at"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("label") - F.col("at")))
    pieces = places.select("label", "at", F.explode(lengths).alias("k"))
    pieces = pieces.select("label", "at", F.substring("label", F.col("at") + 1, F.col("k")).alias("word"))
    # the words inside one label: at most MAX_WORD for each of its characters
    spans = pieces.join(counts, "word").groupBy("label").agg(F.collect_list(F.struct("at", "word", "n")).alias("spans"))
    return labels.join(spans, "label", "left").select("label", split("label", "spans").alias("words"))


def _tokens(rows: DataFrame) -> DataFrame:
    """(token, allow, block) summed over rows of (tokens, allow, block)."""
    each = rows.select(F.explode("tokens").alias("token"), ALLOW, BLOCK)
    return each.groupBy("token").agg(F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK))


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url", html: str = "html",
) -> DataFrame:
    """`pages` with host, path, rule, verdict and odds (log odds of block; NULL where a rule decides)."""
    kept = pages.drop("host", "path", "rule", "verdict", "odds", "_shape", "_ruled")
    marked = kept.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parts = F.filter(F.split(F.lower("path"), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    shape = F.array_join(F.transform(parts, lambda t: F.when(t.rlike(r"^\p{N}+$"), "0").otherwise(t)), " ")
    marked = marked.withColumns({"rule": name, "_ruled": verdict, "_shape": shape})

    groups = cut_lineage(
        marked.groupBy("host", F.col("_shape").alias("shape")).agg(
            F.count(F.when(F.col("_ruled") == ALLOW, 1)).alias(ALLOW), F.count(F.when(F.col("_ruled") == BLOCK, 1)).alias(BLOCK)
        ),
        "urls",
    )
    counts = cut_lineage(word_counts(pages, html), "words")
    total = max(1, counts.agg(F.sum("n")).first()[0] or 1)  # one number
    by_host = groups.groupBy("host").agg(F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK))
    labels_of = F.filter(F.split("host", r"[^\p{L}]+"), lambda t: t != "")
    listed = by_host.select("host", F.posexplode(labels_of).alias("place", "label"))
    split = cut_lineage(segmented(listed.select("label").distinct(), counts, total), "labels")
    # the labels of one host, in order
    words = listed.join(split, "label").groupBy("host").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "words"))), lambda s: s["words"])).alias("words")
    )
    hosts = by_host.join(words, "host", "left").select(
        "host", ALLOW, BLOCK, F.transform(F.coalesce("words", F.array().cast("array<string>")), lambda w: F.concat(F.lit("host "), w)).alias("tokens")
    )
    hosts = cut_lineage(hosts, "hosts")
    shapes = groups.groupBy("shape").agg(F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK)).withColumn(
        "tokens", F.transform(F.filter(F.split("shape", " "), lambda t: t != ""), lambda t: F.concat(F.lit("path "), t))
    )
    shapes = cut_lineage(shapes, "shapes")

    tokens = cut_lineage(_tokens(hosts.select("tokens", ALLOW, BLOCK).unionByName(shapes.select("tokens", ALLOW, BLOCK))), "tokens")
    sums = tokens.agg(F.count("*").alias("v"), F.sum(ALLOW).alias("a"), F.sum(BLOCK).alias("b")).first()  # three numbers
    seen = groups.agg(F.sum(ALLOW).alias("a"), F.sum(BLOCK).alias("b")).first()
    a, b, v = sums.a or 0, sums.b or 0, sums.v
    odds = F.log((F.col(BLOCK) + 1) / F.lit(float(b + v + 1))) - F.log((F.col(ALLOW) + 1) / F.lit(float(a + v + 1)))
    weights = tokens.select("token", odds.alias("weight"))
    prior = math.log(((seen.b or 0) + 1) / ((seen.a or 0) + 1)) if (seen.a or 0) + (seen.b or 0) else 0.0

    def scored(rows: DataFrame, key: str) -> DataFrame:
        each = rows.select(key, F.explode("tokens").alias("token")).join(weights, "token")
        return each.groupBy(key).agg(F.sum("weight").alias(f"_{key}_odds"))

    host_odds = cut_lineage(scored(hosts, "host"), "host_odds")
    shape_odds = cut_lineage(scored(shapes, "shape"), "shape_odds").withColumnRenamed("shape", "_shape")
    judged = marked.join(host_odds, "host", "left").join(shape_odds, "_shape", "left")
    value = F.coalesce("_host_odds", F.lit(0.0)) + F.coalesce("_shape_odds", F.lit(0.0)) + prior
    value = F.when(F.col("_ruled").isNull(), F.when(F.coalesce("_host_odds", "_shape_odds").isNull(), 0.0).otherwise(value))
    own = F.coalesce(F.col("_ruled"), F.when(F.round("odds", 9) > 0, BLOCK).otherwise(ALLOW))
    return judged.withColumn("odds", value).withColumn("verdict", own).select(*kept.columns, "host", "path", "rule", "verdict", "odds")
