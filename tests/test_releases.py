"""Readers see a whole release or the one before it, and no value is lost without a trace."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.session import fresh_path
from dayledger.sources import releases as R

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("day", T.DateType()), T.StructField("note", T.StringType()), T.StructField("pt", T.StringType())])
PT = "20240110"


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, score string, day string, extra int")


GOOD = [("1", "0.5", "2024-01-02", 7), ("2", None, None, 8)]
BAD = [("3", "n/a", "2024-01-02", 9), ("x", "1e3", "soon", 9)]


def fine(rows):
    assert rows.columns == SCHEMA.fieldNames()


def ids(spark, table, pts=None):
    return sorted(r.id for r in R.read_current(spark, table, SCHEMA, pts).collect())


def test_a_published_release_is_what_readers_see(spark):
    table = fresh_path(spark, "released")
    assert ids(spark, table) == [] and R.current(spark, table) == {}
    first = R.publish(frame(spark, GOOD), table, SCHEMA, PT, fine)
    assert (first.kept, first.rejected, first.lost) == (2, 0, {}) and ids(spark, table) == [1, 2]
    R.publish(frame(spark, GOOD[:1]), table, SCHEMA, PT, fine)
    R.publish(frame(spark, [("9", "1", None, 0)]), table, SCHEMA, "20240111", fine)
    assert ids(spark, table) == [1, 9] and ids(spark, table, [PT]) == [1]
    row = R.read_current(spark, table, SCHEMA, [PT]).first()
    assert (row.score, str(row.day), row.note, row.pt) == (0.5, "2024-01-02", None, PT)
    assert R.remove_unseen(spark, table, PT) == [first.name] and ids(spark, table, [PT]) == [1]


def test_failure_at_each_step_leaves_readers_on_the_old_rows(spark, monkeypatch):
    table = fresh_path(spark, "released")
    R.publish(frame(spark, GOOD), table, SCHEMA, PT, fine)

    def refuse(rows):
        assert rows.count() == 1
        raise ValueError("gate")

    with pytest.raises(ValueError, match="gate"):
        R.publish(frame(spark, GOOD[:1]), table, SCHEMA, PT, refuse)
    assert ids(spark, table) == [1, 2]
    failing = frame(spark, GOOD).withColumn("score", F.raise_error(F.lit("while it is written")).cast("string"))
    with pytest.raises(Exception, match="while it is written"):
        R.publish(failing, table, SCHEMA, PT, fine)
    assert ids(spark, table) == [1, 2]
    monkeypatch.setattr(R._files, "create", lambda *a: (_ for _ in ()).throw(OSError("at the switch")))
    with pytest.raises(OSError, match="at the switch"):
        R.publish(frame(spark, GOOD[:1]), table, SCHEMA, PT, fine)
    monkeypatch.undo()
    assert ids(spark, table) == [1, 2]
    # an entry that was broken off while it was written
    R._files(spark).create(f"{table}/manifest/{PT}/0000000002", '{"release": ')
    assert ids(spark, table) == [1, 2]
    R.publish(frame(spark, GOOD[1:]), table, SCHEMA, PT, fine)
    assert ids(spark, table) == [2]


def test_of_two_runs_the_later_switch_is_refused(spark):
    table = fresh_path(spark, "released")
    R.publish(frame(spark, GOOD), table, SCHEMA, PT, fine)
    seen = R.current(spark, table)[PT]
    slow = R.stage(frame(spark, GOOD[:1]), table, SCHEMA, PT)
    R.publish(frame(spark, GOOD[1:]), table, SCHEMA, PT, fine)
    with pytest.raises(RuntimeError, match="moved"):
        R.switch(spark, table, slow, seen)
    assert ids(spark, table) == [2]
    with pytest.raises(Exception, match="(?i)exist"):  # the number of an entry is taken once
        R._files(spark).create(f"{table}/manifest/{PT}/0000000001", "{}")


def test_lost_values(spark):
    table = fresh_path(spark, "released")
    with pytest.raises(ValueError, match="'score': 1.*|'id': 1.*"):
        R.publish(frame(spark, GOOD + BAD), table, SCHEMA, PT, fine)
    assert ids(spark, table) == [] and R._files(spark).names(f"{table}/staged/{PT}") == []
    aside = R.publish(frame(spark, GOOD + BAD), table, SCHEMA, PT, fine, on_lost="aside")
    assert (aside.kept, aside.rejected, aside.lost) == (2, 2, {"id": 1, "score": 1, "day": 1})
    assert ids(spark, table) == [1, 2]
    kept = {json.loads(r.row)["id"]: (json.loads(r.row), sorted(r.lost)) for r in R.rejected_rows(spark, aside).collect()}
    assert kept["x"] == ({"id": "x", "score": "1e3", "day": "soon", "extra": 9}, ["day", "id"]) and kept["3"][1] == ["score"]
    nulled = R.publish(frame(spark, GOOD + BAD), table, SCHEMA, PT, fine, on_lost="null")
    assert (nulled.kept, nulled.rejected, nulled.lost) == (4, 0, {"id": 1, "score": 1, "day": 1})
    assert R.read_current(spark, table, SCHEMA).where("id is null").count() == 1
    assert R.rejected_rows(spark, nulled).collect() == []
    with pytest.raises(ValueError, match="handled by"):
        R.stage(frame(spark, GOOD), table, SCHEMA, PT, on_lost="drop")


def test_empty_release(spark):
    table = fresh_path(spark, "released")
    R.publish(frame(spark, GOOD), table, SCHEMA, PT, fine)
    empty = R.publish(frame(spark, []), table, SCHEMA, PT, fine)
    assert (empty.kept, empty.rejected) == (0, 0) and ids(spark, table) == []


def test_scores_switch_only_behind_both_gates(spark, sf, monkeypatch):
    from dayledger.operators import contracts as V
    from dayledger.plans import scoring_run
    from dayledger.sources.schemas import RESPONSE_SCORES
    from dayledger.workload import inputs as I
    from dayledger.workload.model_queries import NON_NULL

    table, rows = fresh_path(spark, "staged_scores"), I.audience(spark, sf)
    seen, first = scoring_run.publish_staged(spark, rows, I.SCORING_PT, table, non_null=NON_NULL, **I.LINEAGE)
    assert seen.count() == first.kept == rows.count() > 0
    honest = V.postwrite_gate
    monkeypatch.setattr(V, "postwrite_gate", lambda staged, pt, n, *a, **k: honest(staged, pt, n + 1, *a, **k))
    with pytest.raises(ValueError, match="post-write gate"):
        scoring_run.publish_staged(spark, rows.limit(1), I.SCORING_PT, table, non_null=NON_NULL, **I.LINEAGE)
    assert R.current(spark, table) == {I.SCORING_PT: first.name}
    assert R.read_current(spark, table, RESPONSE_SCORES).count() == first.kept
