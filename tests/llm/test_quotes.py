"""Quote parsing, linking and reply order on small conversations."""

import re

from dayledger.llm import quotes

ROWS = [
    (1, 0, "a", "Shall we meet on Monday?\nThe room is free."),
    (1, 1, "b", "On Friday a wrote:\n> Shall we meet on  MONDAY?\n\nMonday is fine."),
    (1, 2, "c", "Other topic: budget"),
    (1, 3, "a", "> > Shall we meet on Monday?\n> Monday is fine.\n\nGood."),
    (1, 4, "d", "> nobody ever said this\nHello\n>\n"),
    (1, 5, "b", "> Other topic: budget\nNo."),
    (2, 0, "a", "ok"),
    (2, 1, "b", "> ok\nok"),
    (2, 2, "a", "> ok\nok"),
    (2, 2, "a", "> ok\nok"),
    (2, 3, "b", None),
    (None, 4, "b", "> ok\nlost"),
    (3, None, None, ""),
]


def rows_of(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as thread", "2 as one")
    return quotes.reply_ordered(frame).collect()


def test_links_and_order(spark):
    found = {(r.conv_id, r.position): r for r in rows_of(spark, ROWS)}
    first = [(found[1, p].turn, found[1, p].thread, found[1, p].reply_to, found[1, p].text) for p in range(1, 7)]
    assert first == [
        (0, 0, None, "Shall we meet on Monday?\nThe room is free."),
        (1, 0, 0, "Monday is fine."),
        (3, 0, 1, "Good."),
        (2, 2, None, "Other topic: budget"),
        (5, 2, 2, "No."),
        (4, 4, None, "Hello"),
    ]
    assert (found[1, 6].n_quotes, found[1, 6].n_linked) == (2, 0)
    assert (found[1, 3].n_quotes, found[1, 3].n_linked) == (2, 2)
    assert [(found[2, p].turn, found[2, p].reply_to, found[2, p].text) for p in range(1, 6)] == [
        (0, None, "ok"), (1, 0, "ok"), (2, 1, "ok"), (2, 1, "ok"), (3, None, ""),
    ]
    assert found[None, 1].text == "lost" and found[None, 1].reply_to is None
    assert found[3, 1].turn is None


def test_long_chain_and_repeated_lines(spark):
    rows = [(7, t, "x", "same line\n" + (f"> line {t - 1}\n" if t else "") + f"line {t}") for t in range(1200)]
    found = sorted(rows_of(spark, rows), key=lambda r: r.position)
    assert [r.turn for r in found] == list(range(1200))
    assert all(r.thread == 0 and r.reply_to == (r.turn - 1 if r.turn else None) for r in found)
    assert all(not re.search("^>", r.text, re.M) for r in found)


def test_common_line_links_to_the_last_one_before(spark):
    rows = [(7, t, "x", "agreed" if t % 3 else "> agreed\nnoted") for t in range(1500)]
    by_turn = {r.turn: r.reply_to for r in rows_of(spark, rows)}
    assert by_turn == {t: (t - 1 if t % 3 == 0 and t else None) for t in range(1500)}


def test_no_messages(spark):
    assert rows_of(spark, []) == []
