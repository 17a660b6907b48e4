from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from quarry.operators import quality as q
from quarry.plans.runlog import RunLog
from quarry.plans.runner import run_pipeline, store_row_failures
from quarry.sources.layers import Lake


def results(df, checks, references=None):
    return {r["position"]: r for r in q.run_checks(df, checks, references).collect()}


def test_checks_on_repeated_rows(repeated):
    found = results(
        repeated,
        [
            {"type": "not_null", "columns": ["id", "nombre"]},
            {"type": "unique", "columns": ["id"]},
            {"type": "valid_values", "column": "estado", "values": ["ACTIVO", "INACTIVO"]},
            {"type": "range", "column": "total", "min_value": 100, "max_value": 300},
            {"type": "made_up"},
        ],
    )
    assert found[0]["details"] == "nombre is missing in 1 rows" and not found[0]["passed"]
    assert found[1]["failing_rows"] == 1 and found[1]["details"] == "1 rows repeat a key of (id)"
    assert found[2]["details"] == "estado is not an allowed value in 1 rows"
    assert found[3]["passed"] and found[3]["details"] == "passed"
    assert not found[4]["passed"] and found[4]["details"] == "no check of this type"


def test_values_are_compared_as_the_column(spark):
    df = spark.sql("SELECT 1.0D AS d, CAST(1.50 AS DECIMAL(9, 2)) AS m, true AS b, DATE '2024-01-02' AS at, 'x' AS s")
    wanted = {"d": [1], "m": [1.5], "b": [True], "at": ["2024-01-02", "no date"], "s": ["x", 1]}
    found = results(df, [{"type": "valid_values", "column": c, "values": v} for c, v in wanted.items()])
    assert all(r["passed"] for r in found.values())
    others = {"d": [2], "m": [1.55], "b": [False], "at": ["2024-01-03"], "s": ["y"]}
    found = results(df, [{"type": "accepted_values", "column": c, "values": v} for c, v in others.items()])
    assert not any(r["passed"] for r in found.values())


def test_nulls_pass_value_and_range_checks(spark):
    df = spark.createDataFrame([(None, None), ("A", 5)], "s string, n int")
    found = results(
        df,
        [
            {"type": "valid_values", "column": "s", "values": ["A"]},
            {"type": "range", "column": "n", "min_value": 5, "max_value": 5},
        ],
    )
    assert found[0]["passed"] and found[1]["passed"]


@pytest.mark.parametrize("columns, duplicates", [(["a"], 3), (["a", "b"], 1)])
def test_unique_with_nulls(spark, columns, duplicates):
    # one column: NULL is no key; several: a tuple with NULL counts as a key
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, 1), (2, 1)], "a int, b int")
    found = results(df, [{"type": "unique", "columns": columns}])
    assert found[0]["failing_rows"] == duplicates


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "a int, b int")
    found = results(
        df, [{"type": "unique", "columns": ["a"]}, {"type": "not_null", "columns": ["b"]}]
    )
    assert found[0]["passed"] and found[1]["passed"]


def test_relationships(spark, rows):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,), (9,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "pk int")
    check = {"type": "relationships", "column": "fk", "to": "parent", "field": "pk"}
    assert results(child, [check], {"parent": parent})[0]["failing_rows"] == 2
    assert rows(q.failing_rows(child, check, {"parent": parent})) == [(9,), (9,)]


def test_failing_rows(repeated, rows):
    assert q.failing_rows(repeated, {"type": "unique", "columns": ["id"]}).count() == 2
    assert rows(q.failing_rows(repeated, {"type": "not_null", "columns": ["nombre"]}), "id") == [(3,)]
    assert q.failing_rows(repeated, {"type": "range", "column": "total", "max_value": 250}).count() == 1


def test_row_checks_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("v", F.col("id") % 3).write.parquet(path)
    checks = [
        {"type": "not_null", "columns": ["id", "v"]},
        {"type": "range", "column": "v", "min_value": 0, "max_value": 1},
        {"type": "valid_values", "column": "v", "values": [0, 1, 2]},
    ]
    plan = q.run_checks(spark.read.parquet(path), checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_severity_gate(repeated):
    checks = [
        {"type": "unique", "columns": ["id"], "severity": "warn"},
        {"type": "not_null", "columns": ["nombre"], "severity": "error"},
    ]
    warned = []
    with pytest.raises(q.QualityGateError, match="not_null: nombre is missing"):
        q.severity_gate(q.run_checks(repeated, checks), warned.append)
    assert warned == ["unique: 1 rows repeat a key of (id)"]
    assert len(q.severity_gate(q.run_checks(repeated, checks[:1]))) == 1


def test_column_stats(repeated):
    assert tuple(q.column_stats(repeated, "total").first()) == (100.0, 300.0, 5, 0, 4)
    assert q.null_counts(repeated, ["id", "nombre"]).first().asDict() == {"id": 0, "nombre": 1}


def test_subtotal_kinds(spark):
    lines = spark.createDataFrame(
        [(1, 2, 249999.0, 0.1, 449998.0), (2, 3, 10.0, 5.0, 25.0)],
        "detalle_id int, cantidad int, precio_unitario double, descuento double, subtotal double",
    )
    as_amount = q.subtotal_mismatch(lines)
    assert [r["detalle_id"] for r in as_amount.collect()] == [1]
    as_fraction = q.subtotal_mismatch(lines, discount_kind="fraction")
    assert [r["detalle_id"] for r in as_fraction.collect()] == [2]


def test_net_amount(spark):
    df = spark.createDataFrame([(1, 100.0, 10.0, 2.0, 88.0), (2, 100.0, 10.0, 2.0, 80.0)], "id int, g double, f double, t double, n double")
    bad = q.net_amount_mismatch(df, "g", "n", ["f", "t"]).collect()
    assert [(r["id"], r["neto_calculado"], r["diferencia"]) for r in bad] == [(2, 88.0, 8.0)]


def test_event_before_parent(spark):
    claims = spark.sql("SELECT 1 AS c, 7 AS pid, DATE '2024-01-01' AS cd UNION ALL SELECT 2, 7, DATE '2024-02-01'")
    orders = spark.sql("SELECT 7 AS oid, DATE '2024-01-05' AS od")
    bad = q.event_before_parent(claims, orders, "pid", "oid", "cd", "od").collect()
    assert [(r["c"], r["dias_de_diferencia"]) for r in bad] == [(1, 4)]


def test_values_that_a_type_cannot_hold(spark):
    df = spark.sql("SELECT explode(array(1, 2, 3)) AS n").withColumn("m", F.col("n").cast("decimal(5,1)"))
    checks = [
        {"type": "valid_values", "column": "n", "values": [1.5, 2]},
        {"type": "valid_values", "column": "n", "values": ["1", "two", 3.0]},
        {"type": "accepted_values", "column": "m", "values": [1.04, 2, Decimal("3.0")]},
        {"type": "valid_values", "column": "n", "values": [2.5]},
    ]
    found = q.run_checks(df, checks).orderBy("position").collect()
    assert [r["failing_rows"] for r in found] == [2, 1, 1, 3]


def test_failing_rows_of_many_checks_in_one_scan(spark, tmp_path, rows):
    path, lake = str(tmp_path / "t"), Lake(str(tmp_path / "lake"))
    spark.range(10).select("id", F.when(F.col("id") != 3, "v").alias("v")).write.parquet(path)
    checks = {
        0: {"type": "range", "column": "id", "max_value": 7}, 2: {"type": "not_null", "columns": ["id", "v"]},
        5: {"type": "expression", "condition": "id <> 9"},
    }
    scans = []
    plain = DataFrameWriter.parquet
    try:
        DataFrameWriter.parquet = lambda self, *a, **k: (
            scans.append(self._df._jdf.queryExecution().executedPlan().toString().count("FileScan")), plain(self, *a, **k)
        )[1]
        stored = store_row_failures(lake, "p", spark.read.parquet(path), checks)
    finally:
        DataFrameWriter.parquet = plain
    assert scans == [1]
    assert rows(spark.read.parquet(stored), "_check", "id") == [
        ("0_range", 8), ("0_range", 9), ("2_not_null", 3), ("5_expression", 9),
    ]
    assert store_row_failures(lake, "p", spark.read.parquet(path), {}) is None


def test_a_pipeline_quarantines_rows_by_check(spark, tmp_path, rows):
    lake, log = Lake(str(tmp_path)), RunLog(spark, str(tmp_path))
    lake.write_raw(spark.range(4).select("id", F.lit(None).cast("int").alias("v")), "s", "t")
    config = {
        "name": "p", "source": {"layer": "raw", "domain": "s", "table": "t"}, "destination": {"layer": "staging", "table": "t"},
        "quality_checks": [
            {"type": "not_null", "columns": ["v"]}, {"type": "range", "column": "id", "min_value": 1}, {"type": "unique", "columns": ["v"]},
        ],
    }
    assert run_pipeline(spark, lake, log, config, quarantine=True)["status"] == "success"
    kept = spark.read.parquet(str(tmp_path / "quarantine/p/rows"))
    assert rows(kept, "_check", "id") == [("0_not_null", i) for i in range(4)] + [("1_range", 0)]
