"""Data-quality checks, gates and business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import quality
from quarry.plans.runlog import RunLog
from quarry.plans.runner import run_pipeline, store_failures, store_row_failures
from quarry.session import scratch_path
from quarry.sources.layers import Lake
from quarry.workload.bindings import as_double, money
from quarry.workload.registry import query, table


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in which the state is missing for pending ones."""
    return table(spark, sf, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))



@query(
    "check_not_null",
    """SELECT n AS failing_rows, n = 0 AS passed, 'o_orderstatus is missing in ' || n || ' rows' AS details
    FROM (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'P') q""",
)
def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    check = {"type": "not_null", "columns": ["o_orderkey", "o_orderstatus"]}
    return quality.run_checks(_orders(spark, sf), [check]).select("failing_rows", "passed", "details")


@query(
    "check_unique",
    """SELECT n AS failing_rows, FALSE AS passed, n || ' rows repeat a key of (l_orderkey, l_linenumber)' AS details
    FROM (SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n FROM lineitem) q""",
)
def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    check = {"type": "unique", "columns": ["l_orderkey", "l_linenumber"]}
    results = quality.run_checks(table(spark, sf, "lineitem"), [check])
    return results.select("failing_rows", "passed", "details")


@query(
    "check_valid_values",
    """SELECT count(*) AS failing_rows, count(*) = 0 AS passed, 'o_orderstatus is not an allowed value in ' || count(*) || ' rows' AS details
    FROM orders WHERE nullif(o_orderstatus, 'P') NOT IN ('F')""",
)
def check_valid_values(spark: SparkSession, sf: str) -> DataFrame:
    check = {"type": "valid_values", "column": "o_orderstatus", "values": ["F"]}
    return quality.run_checks(_orders(spark, sf), [check]).select("failing_rows", "passed", "details")


@query(
    "check_valid_values_typed",
    """WITH o AS (SELECT l_discount AS d, CAST(l_quantity AS DECIMAL(9, 2)) AS m, l_quantity > 25 AS b, l_linenumber AS n FROM lineitem)
    SELECT 0 AS "position", count(*) FILTER (d NOT IN (0, 0.05, 0.1)) AS failing_rows FROM o
    UNION ALL SELECT 1, count(*) FILTER (m NOT IN (1, 2.00, 50)) FROM o
    UNION ALL SELECT 2, count(*) FILTER (NOT b) FROM o
    UNION ALL SELECT 3, count(*) FILTER (n NOT IN (1.5, 2)) FROM o UNION ALL SELECT 4, count(*) FILTER (m NOT IN (1.005, 3)) FROM o""",
)
def check_valid_values_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Double, decimal, boolean and whole-number columns; 1.5 and 1.005 are values that two of them cannot have."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_discount").alias("d"), F.col("l_quantity").cast("decimal(9,2)").alias("m"), (F.col("l_quantity") > 25).alias("b"),
        F.col("l_linenumber").alias("n"),
    )
    wanted = [("d", [0, 0.05, 0.1]), ("m", [1, 2.0, 50]), ("b", [True]), ("n", [1.5, 2]), ("m", [1.005, 3])]
    checks = [{"type": "valid_values", "column": c, "values": v} for c, v in wanted]
    return quality.run_checks(lines, checks).select("position", "failing_rows")


@query(
    "pipeline_relationships",
    """SELECT 'relationships' AS "check", count(*) AS failing_rows, count(*) AS quarantined FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'no_such_check', NULL, NULL""",
)
def pipeline_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """A pipeline names the parents of its checks; a check of an unknown type only warns."""
    lake, name = Lake(scratch_path(spark, "relationships")), "order_lines"
    log = RunLog(spark, lake.root)
    for source in ("orders", "lineitem"):
        lake.write_raw(table(spark, sf, source), "tpch", source)
    outcome = run_pipeline(
        spark, lake, log,
        {
            "name": name,
            "source": {"layer": "raw", "domain": "tpch", "table": "orders"},
            "destination": {"layer": "staging", "table": "orders"},
            "references": {"lines": {"layer": "raw", "domain": "tpch", "table": "lineitem"}},
            "quality_checks": [
                {"type": "relationships", "column": "o_orderkey", "to": "lines", "field": "l_orderkey"},
                {"type": "no_such_check"},
            ],
        },
        quarantine=True,
    )
    if outcome["status"] != "success":
        raise RuntimeError(outcome["error"])
    stored = spark.read.parquet(f"{lake.root}/quarantine/{name}/0_relationships")
    found = stored.agg(F.count(F.lit(1))).scalar()
    return log.read("quality").select(
        "check", "failing_rows", F.when(F.col("check") == "relationships", found).alias("quarantined")
    )


@query(
    "check_range",
    """SELECT count(*) AS failing_rows, count(*) = 0 AS passed, 'l_quantity is outside its limits in ' || count(*) || ' rows' AS details
    FROM lineitem WHERE l_quantity < 2 OR l_quantity > 49""",
)
def check_range(spark: SparkSession, sf: str) -> DataFrame:
    check = {"type": "range", "column": "l_quantity", "min_value": 2, "max_value": 49}
    results = quality.run_checks(table(spark, sf, "lineitem"), [check])
    return results.select("failing_rows", "passed", "details")


@query(
    "check_accepted_values",
    """SELECT count(*) AS failing_rows, count(*) = 0 AS passed, 'event_type is not an allowed value in ' || count(*) || ' rows' AS details
    FROM events WHERE event_type NOT IN ('signup', 'click', 'view')""",
)
def check_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    check = {"type": "accepted_values", "column": "event_type", "values": ["signup", "click", "view"]}
    results = quality.run_checks(table(spark, sf, "events"), [check])
    return results.select("failing_rows", "passed", "details")


@query(
    "check_relationships",
    """SELECT count(*) AS failing_rows, count(*) = 0 AS passed,
        count(*) || ' rows have a o_orderkey that lineitem lacks' AS details
    FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def check_relationships(spark: SparkSession, sf: str) -> DataFrame:
    check = {"type": "relationships", "column": "o_orderkey", "to": "lineitem", "field": "l_orderkey"}
    references = {"lineitem": table(spark, sf, "lineitem")}
    results = quality.run_checks(table(spark, sf, "orders"), [check], references)
    return results.select("failing_rows", "passed", "details")


CHECKS = [
    {"type": "not_null", "columns": ["o_orderkey", "o_custkey"], "severity": "error"},
    {"type": "not_null", "columns": ["o_orderstatus"]},
    {"type": "unique", "columns": ["o_orderkey"], "severity": "error"},
    {"type": "unique", "columns": ["o_custkey"]},
    {"type": "valid_values", "column": "o_orderstatus", "values": ["F", "O", "P"]},
    {"type": "range", "column": "o_totalprice", "min_value": 2000},
    {"type": "expression", "condition": "o_totalprice > 0"},
    {"type": "no_such_check"},
]


@query(
    "run_checks",
    """WITH o AS (SELECT *, nullif(o_orderstatus, 'P') AS state FROM orders), n AS (
        SELECT count(*) FILTER (state IS NULL) AS nulls, count(*) - count(DISTINCT o_custkey) AS dups,
            count(*) FILTER (o_totalprice < 2000) AS low FROM o)
    SELECT 0 AS "position", 'not_null' AS "check", 'o_orderkey, o_custkey' AS "columns", 0 AS failing_rows,
        TRUE AS passed, 'passed' AS details, 'error' AS severity FROM n
    UNION ALL SELECT 1, 'not_null', 'o_orderstatus', nulls, FALSE, 'o_orderstatus is missing in ' || nulls || ' rows', 'warn' FROM n
    UNION ALL SELECT 2, 'unique', 'o_orderkey', 0, TRUE, 'passed', 'error' FROM n
    UNION ALL SELECT 3, 'unique', 'o_custkey', dups, FALSE, dups || ' rows repeat a key of (o_custkey)', 'warn' FROM n
    UNION ALL SELECT 4, 'valid_values', 'o_orderstatus', 0, TRUE, 'passed', 'warn' FROM n
    UNION ALL SELECT 5, 'range', 'o_totalprice', low, low = 0, 'o_totalprice is outside its limits in ' || low || ' rows', 'warn' FROM n
    UNION ALL SELECT 6, 'expression', '', 0, TRUE, 'passed', 'warn' FROM n
    UNION ALL SELECT 7, 'no_such_check', '', NULL, FALSE, 'no check of this type', 'warn' FROM n""",
)
def run_checks(spark: SparkSession, sf: str) -> DataFrame:
    return quality.run_checks(_orders(spark, sf), CHECKS)


@query(
    "severity_gate",
    """SELECT 'lineas_estrictas' AS pipeline, 'error' AS status, 0 AS rows,
        'unique: ' || (count(*) - count(DISTINCT (l_orderkey, l_linenumber))) || ' rows repeat a key of (l_orderkey, l_linenumber)' AS error
    FROM lineitem
    UNION ALL SELECT 'lineas_tolerantes', 'success', count(*), NULL FROM lineitem""",
)
def severity_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The same failing check stops one pipeline and only warns in the other."""
    root = scratch_path(spark, "gate")
    lake, log = Lake(root), RunLog(spark, root)
    lake.write_raw(table(spark, sf, "lineitem"), "tpch", "lineitem")
    for name, severity in (("lineas_estrictas", "error"), ("lineas_tolerantes", "warn")):
        run_pipeline(
            spark, lake, log,
            {
                "name": name,
                "source": {"layer": "raw", "domain": "tpch", "table": "lineitem"},
                "destination": {"layer": "staging", "table": name},
                "quality_checks": [
                    {"type": "unique", "columns": ["l_orderkey", "l_linenumber"], "severity": severity}
                ],
            },
        )
    return log.read("pipelines").select("pipeline", "status", "rows", "error")


@query("store_failures", "SELECT * FROM orders WHERE o_totalprice < 2000")
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The rows behind a failed check, read back from the quarantine folder."""
    lake = Lake(scratch_path(spark, "quarantine"))
    check = {"type": "range", "column": "o_totalprice", "min_value": 2000}
    path = store_failures(lake, "pedidos", 0, table(spark, sf, "orders"), check)
    return spark.read.parquet(path)


@query(
    "store_row_failures",
    """SELECT '0_range' AS _check, o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 20000
    UNION ALL SELECT '1_not_null', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT '3_valid_values', o_orderkey, o_totalprice FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""",
)
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Three failing checks of a table, whose rows are written by one scan."""
    checks = {
        0: {"type": "range", "column": "o_totalprice", "min_value": 20000},
        1: {"type": "not_null", "columns": ["o_orderstatus"]},
        3: {"type": "valid_values", "column": "o_orderpriority", "values": ["1-URGENT", "2-HIGH"]},
    }
    path = store_row_failures(Lake(scratch_path(spark, "quarantine")), "pedidos", _orders(spark, sf), checks)
    return spark.read.parquet(path).select("_check", "o_orderkey", "o_totalprice")


@query(
    "store_failures_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def quarantine_unique(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.failing_rows(
        table(spark, sf, "lineitem"), {"type": "unique", "columns": ["l_orderkey", "l_linenumber"]}
    )
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies"))


# --- business rules ---------------------------------------------------------------------------


@query(
    "test_subtotal",
    """SELECT l_orderkey, l_partkey, l_quantity AS cantidad,
        l_extendedprice AS subtotal
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE abs(CAST(l_extendedprice AS DECIMAL(18, 2)) - CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(10, 0))
        * CAST(p_retailprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))) > 10000""",
)
def test_subtotal(spark: SparkSession, sf: str) -> DataFrame:
    """Lines whose amount is far from quantity * list price less the discount fraction."""
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).select(
        "l_orderkey", "l_partkey", F.col("l_quantity").alias("cantidad"),
        F.col("l_quantity").cast("decimal(10,0)").alias("units"),
        money("p_retailprice").alias("precio_unitario"),
        F.col("l_discount").cast("decimal(4,2)").alias("descuento"),
        money("l_extendedprice").alias("subtotal"),
    )
    bad = quality.subtotal_mismatch(lines, quantity="units", tolerance=10000, discount_kind="fraction")
    return as_double(bad.select("l_orderkey", "l_partkey", "cantidad", "subtotal"))


@query(
    "test_net_amount",
    """SELECT l_orderkey, l_partkey, CAST(bruto - off - impuesto AS DOUBLE) AS neto_calculado FROM (
        SELECT *, CAST(l_extendedprice AS DECIMAL(18, 2)) AS bruto, CAST(l_discount * 100 AS DECIMAL(18, 2)) AS off,
            CAST(l_tax * 100 AS DECIMAL(18, 2)) AS impuesto FROM lineitem) q
    WHERE abs(bruto - (bruto - off - impuesto)) > 10.10""",
)
def test_net_amount(spark: SparkSession, sf: str) -> DataFrame:
    """Gross taken as net: lines whose deductions exceed the tolerance."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", money("l_extendedprice").alias("bruto"),
        (F.col("l_discount") * 100).cast("decimal(18,2)").alias("off"),
        (F.col("l_tax") * 100).cast("decimal(18,2)").alias("impuesto"),
    ).withColumn("neto", F.col("bruto"))
    bad = quality.net_amount_mismatch(lines, "bruto", "neto", ["off", "impuesto"], tolerance=10.10)
    return as_double(bad.select("l_orderkey", "l_partkey", "neto_calculado"))


@query("test_order_without_items", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def test_order_without_items(spark: SparkSession, sf: str) -> DataFrame:
    return quality.orders_without_items(
        table(spark, sf, "orders"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey"
    )


@query(
    "test_price_below_cost",
    """SELECT p_partkey, p_retailprice, dearest FROM part JOIN
    (SELECT l_partkey, max(l_extendedprice / l_quantity) AS dearest FROM lineitem GROUP BY 1) q
    ON l_partkey = p_partkey WHERE p_retailprice < dearest""",
)
def test_price_below_cost(spark: SparkSession, sf: str) -> DataFrame:
    """List prices below the highest unit price ever paid."""
    paid = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("dearest")
    )
    parts = table(spark, sf, "part").join(paid, F.col("p_partkey") == F.col("l_partkey"))
    return quality.price_below_cost(parts, "p_retailprice", "dearest").select("p_partkey", "p_retailprice", "dearest")


@query(
    "test_claim_before_order",
    """SELECT l_orderkey, l_partkey, CAST(l_shipdate AS DATE) AS fecha_reclamo, CAST(o_orderdate AS DATE) AS fecha,
        CAST(date_diff('day', CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) AS INTEGER) AS dias_de_diferencia
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""",
)
def test_claim_before_order(spark: SparkSession, sf: str) -> DataFrame:
    claims = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_shipdate").cast("date").alias("fecha_reclamo")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("fecha"))
    return quality.event_before_parent(
        claims, orders, "l_orderkey", "o_orderkey", "fecha_reclamo", "fecha"
    ).drop("o_orderkey")
