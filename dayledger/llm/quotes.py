"""Quotation linking: quoted passages find the messages they come from, and conversations lose their quotes.

Lines that start with `>` marks are quoted, one level a mark. A run of quoted lines of one level is a passage. Passages
and their lines are normalised (no marks, lower case, single spaces) and hashed, as are the own text, paragraphs and lines of
every message. A hash of a quote is linked with the last earlier message of the conversation that has it; the passage
belongs to the message that covers most of its letters, the later one of equals. A message replies to the one its first
passage of the lowest level comes from. Replies point back in time, so following them ends at the message that started
the thread; pointers are doubled in each round, whatever the length of the chain. A conversation in reply order lists
its threads by their first message, and the messages of a thread in turn, so that every reply follows what it answers.

"Last earlier" is a running maximum per (conversation, hash), first within spans of turns and then over the spans, so a
line that a long conversation repeats in every message is not one group. Positions come from one sort of all messages
over range partitions; no conversation has to fit into a task.

Defined cases: a NULL text is empty; a message with a NULL conversation or turn links to nothing and has position 1; quotes of unknown origin are removed and counted, and
link to nothing; a line such as "... wrote:" right before a quote goes with it; messages that repeat
(conversation, turn) share their links; a message never replies to one of the same turn or a later one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import running_totals
from ..session import cut_lineage, remove_cut

_MARKS = r"^[ \t]*((?:>[ \t]?)+)"
_WROTE = r"(?i)(wrote|writes|said|schrieb|a écrit|escribió)[ \t]*:[ \t]*$"
_SPAN = 512


def level_of(line: Column) -> Column:
    """How many quote marks a line starts with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), r"[^>]", ""))


def normal(text: Column) -> Column:
    """Without marks, lower case, words joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(text, rf"(?m){_MARKS}", "")), r"\s+", " "))


def own_lines(lines: Column) -> Column:
    """The lines that are neither quoted nor announce a quote."""
    following = lambda i: F.coalesce(level_of(F.get(lines, i + 1)), F.lit(0)) > 0
    return F.filter(lines, lambda line, i: (level_of(line) == 0) & ~(line.rlike(_WROTE) & following(i)))


def own_text(text: Column) -> Column:
    """A message without its quotes."""
    body = F.array_join(own_lines(F.split(F.coalesce(text, F.lit("")), r"\r?\n")), "\n")
    return F.regexp_replace(body, r"^\s+|\s+$", "")


def passages(messages: DataFrame) -> DataFrame:
    """(conv, turn, at, level, body): the quoted passages of (conv, turn, text), `at` being their first line."""
    lines = messages.select("conv", "turn", F.split("text", r"\r?\n").alias("lines")).select(
        "conv", "turn", F.transform("lines", lambda x, i: F.struct(i.alias("at"), level_of(x).alias("level"), x.alias("line"))).alias("lines")
    )
    # a passage starts where the level differs from that of the line before
    starts = F.filter("lines", lambda x: (x["level"] > 0) & (x["level"] != F.coalesce(F.get("lines", x["at"] - 1)["level"], F.lit(0))))
    each = lines.select("conv", "turn", "lines", F.explode(starts).alias("first"))
    after = F.filter("lines", lambda x: (x["at"] > F.col("first.at")) & (x["level"] != F.col("first.level")))
    end = F.coalesce(F.array_min(F.transform(after, lambda x: x["at"])), F.size("lines"))
    body = F.transform(F.slice("lines", F.col("first.at") + 1, end - F.col("first.at")), lambda x: x["line"])
    return each.select("conv", "turn", F.col("first.at").alias("at"), F.col("first.level").alias("level"), F.array_join(body, "\n").alias("body"))


def _hashes(rows: DataFrame, body: str, *keys: str) -> DataFrame:
    """(keys, hash, letters) of the whole body, its paragraphs and its lines, each hash once a row."""
    parts = F.concat(F.array(F.col(body)), F.split(body, r"\n[ \t]*\n"), F.split(body, r"\r?\n"))
    told = F.array_distinct(F.filter(F.transform(parts, normal), lambda p: p != ""))
    each = rows.select(*keys, F.explode(told).alias("part"))
    return each.select(*keys, F.xxhash64("part").alias("hash"), F.length("part").alias("letters"))


def earlier_origin(quoted: DataFrame, origins: DataFrame) -> DataFrame:
    """`quoted` (conv, hash, turn, ...) with `origin`: the last turn before with that hash in (conv, hash, turn)."""
    span = F.expr(f"turn div {_SPAN}").alias("span")
    per_span = origins.groupBy("conv", "hash", span).agg(F.max("turn").alias("last"))
    before = Window.partitionBy("conv", "hash").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    asked = quoted.select("conv", "hash", span).distinct().withColumn("last", F.lit(None).cast("bigint"))
    spans = per_span.unionByName(asked).groupBy("conv", "hash", "span").agg(F.max("last").alias("last"))
    carried = spans.select("conv", "hash", "span", F.max("last").over(before).alias("carry"))
    kinds = origins.select("conv", "hash", "turn", F.lit(True).alias("is_origin")).distinct()
    both = quoted.withColumn("is_origin", F.lit(False)).unionByName(kinds, allowMissingColumns=True).withColumn("span", F.expr(f"turn div {_SPAN}"))
    inside = Window.partitionBy("conv", "hash", "span").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max(F.when(F.col("is_origin"), F.col("turn"))).over(inside)).where("not is_origin")
    found = near.join(carried, ["conv", "hash", "span"]).withColumn("origin", F.coalesce("near", "carry"))
    return found.where("origin is not null").drop("near", "carry", "span", "is_origin")


def links(messages: DataFrame) -> DataFrame:
    """(conv, turn, at, level, origin) of the quoted passages of (conv, turn, text); origin NULL if unknown."""
    quoted = cut_lineage(passages(messages.where(F.col("text").contains(">"))), "passages")
    if quoted.isEmpty():
        return quoted.select("conv", "turn", "at", "level", F.lit(None).cast("bigint").alias("origin"))
    origins = _hashes(messages.withColumn("own", own_text(F.col("text"))), "own", "conv", "turn")
    asked = _hashes(quoted, "body", "conv", "turn", "at")
    wanted = asked.select("conv", "hash").distinct()
    found = earlier_origin(asked, origins.join(wanted, ["conv", "hash"], "left_semi"))
    votes = found.groupBy("conv", "turn", "at", "origin").agg(F.sum("letters").alias("letters"))
    best = votes.groupBy("conv", "turn", "at").agg(F.max_by("origin", F.struct("letters", "origin")).alias("origin"))
    return quoted.select("conv", "turn", "at", "level").join(best, ["conv", "turn", "at"], "left")


def thread_starts(replies: DataFrame) -> DataFrame:
    """(conv, turn, start) of (conv, turn, reply_to): where following the replies ends."""
    pointers = cut_lineage(replies.select("conv", "turn", F.col("reply_to").alias("start")), "threads")
    while True:
        up = pointers.select("conv", F.col("turn").alias("start"), F.col("start").alias("far"))
        doubled = cut_lineage(
            pointers.join(up, ["conv", "start"], "left").select(
                "conv", "turn", F.coalesce("far", "start").alias("start"), F.col("far").isNotNull().alias("moved")
            ),
            "threads",
        )
        remove_cut(pointers)
        pointers = doubled.select("conv", "turn", "start")
        if doubled.where("moved").isEmpty():
            return pointers


def reply_ordered(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row a message: conv_id, turn, role, position (in its conversation, from 1), thread (turn that started it),
    reply_to, n_quotes, n_linked, and text without quotes."""
    rows = conversations.select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.col(role).cast("string").alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    named = rows.where("conv is not null and turn is not null")
    linked = cut_lineage(links(named.select("conv", "turn", "text").distinct()), "links")
    # every message has few passages; the first one of the lowest level that was found tells what it answers
    told = cut_lineage(
        linked.groupBy("conv", "turn").agg(
            F.min_by("origin", F.when(F.col("origin").isNotNull(), F.struct("level", "at"))).alias("reply_to"),
            F.count("*").alias("n_quotes"), F.count("origin").alias("n_linked"),
        ),
        "replies",
    )
    starts = thread_starts(told.where("reply_to is not null"))
    whole = named.join(told, ["conv", "turn"], "left").join(starts, ["conv", "turn"], "left")
    whole = whole.select(
        "conv", "turn", "role", F.coalesce("start", "turn").alias("thread"), "reply_to", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"), own_text(F.col("text")).alias("text"), F.lit(1).alias("one"),
    )
    placed = running_totals(whole, ["conv"], ["thread", "turn", "role", "text"], ["one"])
    columns = ["conv_id", "turn", "role", "position", "thread", "reply_to", "n_quotes", "n_linked", "text"]
    found = placed.withColumns({"conv_id": F.col("conv"), "position": F.col("cum_one").cast("bigint")}).select(columns)
    alone = rows.where("conv is null or turn is null").select(
        F.col("conv").alias("conv_id"), "turn", "role", F.lit(1).cast("bigint").alias("position"), F.col("turn").alias("thread"),
        F.lit(None).cast("bigint").alias("reply_to"), F.lit(0).cast("bigint").alias("n_quotes"), F.lit(0).cast("bigint").alias("n_linked"),
        own_text(F.col("text")).alias("text"),
    )
    return found.unionByName(alone)
