"""Lists of distinct values stay small, and rows without a player are spread."""

import pytest
from pyspark.sql import functions as F

from dayledger.operators import dataset as D
from dayledger.operators.lists import few_values, joined_values
from dayledger.operators.profiling import outcome_distribution, outcome_distribution_json


def test_joined_values(spark):
    rows = spark.createDataFrame([("b", None, 1), ("a", None, 1), ("b", None, None), (None, None, 1)], "x string, y string, z int")
    assert joined_values(rows, ["x", "y", "z"]).collect() == [("a,b", None, "1")]
    assert joined_values(rows.where("false"), ["x", "y"]).collect() == [(None, None)]


def test_too_many_values_are_refused_by_name(spark):
    rows = spark.range(50).selectExpr("CAST(id AS STRING) AS x", "CAST(id % 3 AS STRING) AS y")
    with pytest.raises(Exception, match="over 20 different values of value for x"):
        joined_values(rows, ["x", "y"], most=20).collect()
    assert joined_values(rows, ["x", "y"], most=50).first().y == "0,1,2"
    few = few_values(rows.select("y").distinct().withColumn("k", F.lit(1)), ["k"], "y", most=3)
    assert few.count() == 3
    amounts = outcome_distribution(spark.range(30).selectExpr("CAST(id AS DOUBLE) AS v"), ["v"])
    with pytest.raises(Exception, match="over 10 different values"):
        outcome_distribution_json(amounts, most=10).collect()


def test_rows_without_a_player_are_dealt_to_many_tasks(spark):
    left = spark.range(3000).selectExpr("CASE WHEN id < 10 THEN CAST(id AS STRING) END AS player_id", "DATE'2024-01-01' AS assignment_date", "id AS v")
    right = spark.createDataFrame([("3", "x"), (None, "never")], "player_id string, note string").withColumn("assignment_date", F.lit("2024-01-01").cast("date"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = D.left_join_by_player(left, right)
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        rows = joined.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert joined.columns == ["player_id", "assignment_date", "v", "note"]
    assert len(rows) == 3000 and {(r.player_id, r.note) for r in rows if r.note} == {("3", "x")}
    assert max(sizes) < 3 * 3000 / len(sizes) and len(sizes) == 4
