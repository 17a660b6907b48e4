from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators.joins import (
    keep_matching, keep_unmatched, left_join_many, with_group_totals, with_scalars,
)


def hot(spark, n=9000):
    """A third of the rows share key 0, some have no key."""
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 100 != 1, F.col("id") % 50).alias("k"),
    )


def test_semi_and_anti(spark, rows):
    keys = spark.range(40).select(F.col("id").alias("k"))
    facts = hot(spark)
    assert rows(keep_matching(keys, facts, "k")) == rows(keys.join(facts, "k", "left_semi"))
    assert rows(keep_unmatched(spark.range(60).select(F.col("id").alias("k")), facts, "k")) == [(k,) for k in range(50, 60)]


def test_semi_join_reduces_copies_before_the_shuffle(spark):
    keys = spark.range(40).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keep_matching(keys, hot(spark), "k", unique=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    right = plan[plan.index("SortMergeJoin"):]
    assert right.count("HashAggregate") >= 2 and "CartesianProduct" not in plan


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def is_split(df):
    """Whether adaptive execution splits the hot key of a join."""
    spark = df.sparkSession
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    try:
        probe = df.agg(*[F.max(F.hash(c)) for c in df.columns], F.count(F.lit(1)))
        probe.collect()
        return "skew=true" in probe._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in SKEW:
            spark.conf.unset(key)


def test_hot_keys_are_split(spark):
    facts = hot(spark, 120_000).withColumn("pad", F.sha2(F.col("id").cast("string"), 256))
    keys = spark.range(50).select(F.col("id").alias("k")).union(spark.range(1).select(F.lit(7)))
    people = facts.select("k").where("k is not null").distinct().withColumnRenamed("k", "p")
    assert is_split(keep_matching(facts, keys, "k"))
    assert is_split(keep_unmatched(facts, keys, "k"))
    assert is_split(left_join_many(people, facts, "p", "k"))
    assert is_split(with_group_totals(facts, ["k"], [F.count(F.lit(1)).alias("n")]))


def test_left_join_many(spark, rows):
    people = spark.range(55).select(F.col("id").alias("p"))
    expected = people.join(hot(spark), F.col("p") == F.col("k"), "left")
    assert rows(left_join_many(people, hot(spark), "p", "k"), "p", "id") == rows(expected, "p", "id")


def test_group_totals_treat_null_as_a_group(spark, rows):
    facts = hot(spark, 900)
    expected = facts.selectExpr("id", "count(*) OVER (PARTITION BY k) AS n")
    assert rows(with_group_totals(facts, ["k"], [F.count(F.lit(1)).alias("n")]), "id", "n") == rows(expected)


def test_scalars_are_not_joined(spark):
    facts = hot(spark, 900)
    out = with_scalars(facts, facts.agg(F.max("id").alias("top"), F.count("k").alias("n")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert out.select("top").distinct().collect()[0]["top"] == 899


def test_left_join_many_computes_the_left_side_once(spark, rows):
    left = spark.range(1, 4).select(F.when(F.col("id") < 3, F.col("id")).alias("p"), F.md5(F.col("id").cast("string")).alias("text"))
    right = spark.createDataFrame([(1, 7), (1, 8), (3, 9), (None, 5)], "k long, id long")
    joined = left_join_many(left, right, "p", "k")
    assert rows(joined, "p", "k", "id") == rows(left.join(right, F.col("p") == F.col("k"), "left"), "p", "k", "id")
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    keys = spark.createDataFrame([(1,), (2,), (4,), (None,)], "p long")
    assert rows(left_join_many(left, right, "p", "k", keys, right)) == rows(joined)
