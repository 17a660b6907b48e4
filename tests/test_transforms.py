from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarry.operators import transforms as t
from quarry.operators.dedup import best_row, latest_version, mark_duplicates


def test_rename_puts_renamed_columns_first(people):
    assert people.transform(t.rename({"total": "monto", "id": "cliente_id"})).columns == [
        "monto", "cliente_id", "nombre", "email", "estado",
    ]


def test_rename_of_missing_column_is_an_error(people):
    with pytest.raises(ValueError, match="no such columns"):
        people.transform(t.rename({"nope": "x"}))


def test_cast_rounds_fractions_into_integers(spark, rows):
    df = spark.createDataFrame([(2.5, "2.5"), (3.5, "-2.7"), (None, None)], "a double, b string")
    cast = df.transform(t.cast({"a": "INTEGER", "b": "BIGINT"}))
    assert cast.dtypes == [("a", "int"), ("b", "bigint")]
    assert rows(cast) == [(None, None), (2, 3), (4, -3)]


def test_cast_is_strict(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.transform(t.cast({"a": "DATE"})).collect()


def test_filter_counts_both_copies(repeated):
    assert repeated.transform(t.where("total > 150")).count() == 3


def test_deduplicate_newest_first(spark, rows):
    df = spark.createDataFrame(
        [(1, "old", "2024-01-01"), (1, "new", "2024-01-02"), (2, "only", "2024-01-01"), (None, "n", "2024-01-01")],
        "id int, v string, _ingestion_timestamp string",
    )
    assert rows(df.transform(t.deduplicate(["id"])), "id", "v") == [(None, "n"), (1, "new"), (2, "only")]


def test_deduplicate_twice_leaves_no_helper(repeated):
    steps = [
        {"type": "deduplicate", "keys": ["id"], "order_by": ["total DESC"]},
        {"type": "deduplicate", "keys": ["estado"], "order_by": ["id"]},
    ]
    out = t.transform_chain(repeated, steps)
    assert out.columns == repeated.columns
    assert out.count() == 3


def test_latest_version_is_idempotent(spark, rows):
    df = spark.range(1000).select((F.col("id") % 50).alias("k"), (F.col("id") % 7).alias("version"), "id")
    once = latest_version(df, ["k"], "version")
    assert rows(latest_version(once, ["k"], "version")) == rows(once)
    assert once.count() == 50


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    plan = best_row(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
    top = best_row(df, ["k"], [F.col("id").desc()]).where("k = 0").collect()
    assert [r["id"] for r in top] == [9999]


def test_mark_duplicates_matches_row_number(spark, rows):
    df = spark.range(300).select(
        "id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 10).alias("email")
    )
    expected = df.selectExpr("id", "row_number() OVER (PARTITION BY email ORDER BY id) > 1 AS d")
    assert rows(mark_duplicates(df, ["email"], "id", "d"), "id", "d") == rows(expected)


def test_custom_sql_keeps_braces(people, rows):
    out = people.transform(t.custom_sql("SELECT id, '{x}' AS b FROM __INPUT__ WHERE estado = 'DELETED'"))
    assert rows(out) == [(5, "{x}")]


def test_aggregate(people, rows):
    out = people.transform(t.aggregate(["estado"], ["COUNT(*) AS n", "SUM(total) AS s"]))
    assert rows(out) == [("ACTIVO", 3, 600.0), ("DELETED", 1, 250.0), ("INACTIVO", 1, 150.0)]


def test_unknown_step_warns_or_fails(people):
    steps = [{"type": "explode_everything"}]
    assert t.transform_chain(people, steps).count() == 5
    with pytest.raises(ValueError, match="unknown step"):
        t.transform_chain(people, steps, unknown="error")


def test_step_without_columns_is_rejected():
    with pytest.raises(ValueError, match="columns"):
        t.build_steps([{"type": "rename"}])


def test_date_parts_and_hash_key(spark, rows):
    df = spark.sql("SELECT DATE '2024-03-10' AS f, 1 AS a, CAST(NULL AS STRING) AS b")  # a Sunday
    out = df.transform(t.date_parts("f")).transform(t.hash_key(["a", "b"], "k"))
    picked = rows(out, "f_year", "f_month", "f_day", "f_dow", F.col("k") == F.md5(F.lit("1|")))
    assert picked == [(2024, 3, 10, 0, True)]
