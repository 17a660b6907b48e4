from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators.ordered import _placed, exact_percentiles, percentiles_of, with_ranks


def frame(spark, seed, hot):
    """Values with heavy ties, NULLs, and one group that holds most of the rows."""
    rng = np.random.default_rng(seed)
    n = 4000
    groups = np.where(rng.random(n) < hot, "hot", rng.choice(["a", "b", "c"], n))
    values = np.where(rng.random(n) < 0.4, 7.0, rng.normal(0, 100, n).round(1))
    data = [
        (i, str(g), None if rng.random() < 0.02 else float(v)) for i, (g, v) in enumerate(zip(groups, values))
    ]
    return spark.createDataFrame(data, "id int, g string, v double")


@pytest.mark.parametrize("seed, hot, splitters", [(1, 0.4, 8), (2, 0.9, 64), (3, 0.0, 1)])
def test_ranks_equal_the_window(spark, rows, seed, hot, splitters):
    df = frame(spark, seed, hot)
    expected = df.selectExpr("id", "rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) AS r")
    got = with_ranks(df, ["g"], {"v": "r"}, splitters)
    assert rows(got, "id", "r") == rows(expected)


def test_ranks_with_null_group_and_two_values(spark, rows):
    df = frame(spark, 5, 0.5).withColumn("g", F.nullif("g", F.lit("a"))).withColumn("w", F.col("id") % 5)
    expected = df.selectExpr(
        "id", "rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) AS r",
        "rank() OVER (PARTITION BY g ORDER BY w DESC NULLS LAST) AS s",
    )
    got = with_ranks(df, ["g"], {"v": "r", "w": "s"}, 16)
    assert rows(got, "id", "r", "s") == rows(expected)


@pytest.mark.parametrize("seed, splitters", [(1, 4), (2, 256), (3, 1)])
def test_percentiles_equal_numpy(spark, seed, splitters):
    df = frame(spark, seed, 0.3)
    values = [r["v"] for r in df.where("v is not null").collect()]
    points = {"a": 0.0, "b": 0.05, "c": 0.25, "d": 0.5, "e": 0.999, "f": 1.0}
    got = exact_percentiles(df, "v", points, splitters).first()
    for name, p in points.items():
        assert got[name] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_percentile_of_one_value(spark):
    df = spark.createDataFrame([(3.0,)], "v double")
    assert exact_percentiles(df, "v", {"m": 0.5}).first()["m"] == 3.0


def test_percentiles_of_several_columns(spark):
    df = frame(spark, 4, 0.3).withColumn("w", F.col("id") % 7)
    got = percentiles_of(df, {"v": {"a": 0.25, "b": 0.75}, "w": {"c": 0.5}, "id": {"d": 0.999}}, 16).first()
    for column, name, p in (("v", "a", 0.25), ("v", "b", 0.75), ("w", "c", 0.5), ("id", "d", 0.999)):
        values = [r[column] for r in df.where(f"{column} is not null").collect()]
        assert got[name] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_percentiles_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "v double, w double")
    assert percentiles_of(df, {"v": {"a": 0.5}, "w": {"b": 0.5}}).first().asDict() == {"a": None, "b": 1.5}
    assert exact_percentiles(df.limit(0), "w", {"b": 0.5}).first().asDict() == {"b": None}


def test_a_large_group_and_a_common_value_are_spread(spark):
    """One value of one group holds half of all rows; it is dealt to many tasks, and ranked as one value."""
    df = spark.range(20_000).select("id", F.lit("hot").alias("g"), F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("v"))
    ranked = with_ranks(df, ["g"], {"v": "r"}, 16)
    assert ranked.where("v = 5").select("r").distinct().collect() == [(9_998,)]
    placed = _placed(df, [F.col("g"), F.col("v").desc_nulls_last(), F.xxhash64("id", "g", "v")], 16)
    tasks = placed.groupBy(F.shiftright("__place", 33)).count().collect()
    assert len(tasks) > 8 and max(t["count"] for t in tasks) < 4_000


def test_two_ranks_shuffle_little(spark):
    df = frame(spark, 6, 0.5).withColumn("w", F.col("id") % 5)
    plan = with_ranks(df, ["g"], {"v": "r", "w": "s"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4 and "CartesianProduct" not in plan
