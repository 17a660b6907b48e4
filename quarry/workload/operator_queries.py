"""Transform steps, joins, aggregates, windows, sorting, unions and JSON tables, one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import casts, geo, keys, kpi
from quarry.functions.documents import explode_documents, parse_object
from quarry.functions.text import accent_fold
from quarry.operators import transforms as steps
from quarry.operators.dedup import best_row, latest_version, mark_duplicates
from quarry.operators.joins import (
    keep_matching, keep_unmatched, left_join_many, with_group_totals, with_scalars,
)
from quarry.operators.ordered import exact_percentiles, percentiles_of, with_ranks
from quarry.operators.quality import column_stats as stats_of
from quarry.plans.consume import principal_location as principal_place
from quarry.session import materialise
from quarry.sources.inline import inline_relation as inline
from quarry.workload.bindings import PRIORITIES, Bound, as_double, money
from quarry.workload.raw_docs import line_documents
from quarry.workload.registry import query, table
from quarry.workload.sql import CATALOGUE, SALES, half_up

# --- steps ------------------------------------------------------------------------------------


@query(
    "rename",
    "SELECT o_orderkey AS pedido_id, o_custkey AS cliente_id, o_orderstatus, o_totalprice, o_orderdate,"
    " o_orderpriority FROM orders",
)
def rename(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").transform(
        steps.rename({"o_orderkey": "pedido_id", "o_custkey": "cliente_id"})
    )


@query(
    "cast",
    "SELECT CAST(o_totalprice AS BIGINT) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,"
    " CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderkey FROM orders",
)
def cast(spark: SparkSession, sf: str) -> DataFrame:
    wanted = {"o_totalprice": "BIGINT", "o_orderdate": "DATE", "o_custkey": "VARCHAR"}
    return table(spark, sf, "orders").drop("o_orderstatus", "o_orderpriority").transform(steps.cast(wanted))


@query("filter", "SELECT * FROM orders WHERE o_totalprice > 100000 AND o_orderstatus <> 'P'")
def filter_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").transform(
        steps.where("o_totalprice > 100000 AND o_orderstatus <> 'P'")
    )


def _two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Orders ingested on their date, and again a day earlier with another state."""
    orders = table(spark, sf, "orders")
    newer = orders.withColumn("_ingestion_timestamp", F.col("o_orderdate"))
    older = orders.withColumns(
        {
            "_ingestion_timestamp": F.col("o_orderdate") - F.expr("interval 1 day"),
            "o_orderstatus": F.lit("old"),
        }
    )
    return newer.unionByName(older)


@query("deduplicate", "SELECT *, o_orderdate AS _ingestion_timestamp FROM orders")
def deduplicate(spark: SparkSession, sf: str) -> DataFrame:
    return _two_batches(spark, sf).transform(steps.deduplicate(["o_orderkey"]))


@query(
    "custom_sql",
    "SELECT o_orderstatus, count(*) AS orders, max(o_orderdate) AS last_order FROM orders GROUP BY 1",
)
def custom_sql(spark: SparkSession, sf: str) -> DataFrame:
    sql = """SELECT o_orderstatus, count(*) AS orders, max(o_orderdate) AS last_order
             FROM __INPUT__ GROUP BY o_orderstatus"""
    return table(spark, sf, "orders").transform(steps.custom_sql(sql))


CHAIN = [
    {"type": "rename", "columns": {"o_orderkey": "pedido_id", "o_custkey": "cliente_id"}},
    {"type": "cast", "columns": {"o_orderdate": "DATE"}},
    {"type": "filter", "condition": "o_totalprice > 0"},
    {"type": "deduplicate", "keys": ["pedido_id"]},
    {"type": "not_a_step"},
    {
        "type": "custom_sql",
        "sql": "SELECT *, CASE WHEN o_totalprice >= 250000 THEN 'high' ELSE 'low' END AS band FROM __INPUT__",
    },
    {"type": "aggregate", "group_by": ["o_orderdate", "band"],
     "aggregations": ["COUNT(*) AS pedidos", "MAX(pedido_id) AS last_id"]},
]


@query(
    "transform_chain",
    """SELECT CAST(o_orderdate AS DATE) AS o_orderdate,
        CASE WHEN o_totalprice >= 250000 THEN 'high' ELSE 'low' END AS band,
        count(*) AS pedidos, max(o_orderkey) AS last_id
    FROM orders WHERE o_totalprice > 0 GROUP BY 1, 2""",
)
def transform_chain(spark: SparkSession, sf: str) -> DataFrame:
    return steps.transform_chain(_two_batches(spark, sf), CHAIN)


@query(
    "drop_internal",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_orderkey AS __x FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
)
def drop_internal(spark: SparkSession, sf: str) -> DataFrame:
    """Steps leave no helper behind; a column of the user's stays, whatever its name."""
    chained = steps.transform_chain(
        _two_batches(spark, sf),
        [
            {"type": "deduplicate", "keys": ["o_orderkey"]},
            {"type": "deduplicate", "keys": ["o_custkey"], "order_by": ["o_orderkey DESC"]},
            {"type": "custom_sql", "sql": "SELECT *, o_orderkey AS __x, 1 AS __helper FROM __INPUT__", "helpers": ["__helper"]},
        ],
    )
    return chained.drop("_ingestion_timestamp", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(
    "date_parts",
    """SELECT event_id, ts, CAST(year(ts) AS INTEGER) AS ts_year, CAST(month(ts) AS INTEGER) AS ts_month,
        CAST(day(ts) AS INTEGER) AS ts_day, CAST(dayofweek(ts) AS INTEGER) AS ts_dow FROM events""",
)
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts").transform(steps.date_parts("ts"))


@query(
    "hash_key",
    """SELECT o_orderkey, md5(o_orderkey || '|' || coalesce(nullif(o_orderstatus, 'P'), '') || '|'
        || o_orderpriority) AS order_hash FROM orders""",
)
def hash_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_orderpriority"
    )
    keyed = orders.transform(steps.hash_key(["o_orderkey", "status", "o_orderpriority"], "order_hash"))
    return keyed.select("o_orderkey", "order_hash")


@query(
    "surrogate_key",
    """SELECT c_custkey, md5('vtex|' || c_custkey) AS cliente_id,
        md5(n_name || '|' || n_nationkey || '|' || coalesce(CASE WHEN n_nationkey % 2 = 0 THEN 'UY' END, 'AR')) AS ubicacion_id
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    country = F.when(F.col("n_nationkey") % 2 == 0, "UY")
    return joined.select(
        "c_custkey",
        keys.surrogate_key("vtex", F.col("c_custkey")).alias("cliente_id"),
        keys.place_key(F.col("n_name"), F.col("n_nationkey"), country).alias("ubicacion_id"),
    )


@query(
    "safe_cast",
    """SELECT l_orderkey, TRY_CAST(CAST(l_quantity AS VARCHAR) AS INTEGER) AS quantity,
        TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS INTEGER) AS price,
        TRY_CAST(l_returnflag AS DOUBLE) AS flag,
        TRY_CAST(strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '-04:00' AS TIMESTAMP) AS shipped,
        TRY_CAST(l_linestatus AS TIMESTAMP) AS status_time FROM lineitem""",
)
def safe_cast(spark: SparkSession, sf: str) -> DataFrame:
    shipped = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-04:00"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        casts.try_int(F.col("l_quantity").cast("string")).alias("quantity"),
        casts.try_int(F.col("l_extendedprice").cast("string")).alias("price"),
        casts.try_double(F.col("l_returnflag")).alias("flag"),
        casts.try_timestamp(shipped).alias("shipped"),
        casts.try_timestamp(F.col("l_linestatus")).alias("status_time"),
    )


@query(
    "unit_normalise",
    """SELECT o_orderkey, CAST(floor(o_totalprice * 100) AS BIGINT) / 100.0e0 AS amount,
        nullif(CAST(o_custkey % 10 AS DOUBLE), 0) AS coordinate,
        CASE WHEN o_orderstatus = 'F' THEN 'AR' ELSE o_orderstatus END AS country FROM orders""",
)
def unit_normalise(spark: SparkSession, sf: str) -> DataFrame:
    iso3 = F.when(F.col("o_orderstatus") == "F", "ARG").otherwise(F.col("o_orderstatus"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        casts.from_cents(F.floor(F.col("o_totalprice") * 100)).alias("amount"),
        casts.coordinate(F.col("o_custkey") % 10).alias("coordinate"),
        casts.country_code(iso3).alias("country"),
    )


@query(
    "json_fields",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing"
    " FROM events",
)
def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_object(F.col("props"), "k string, missing string")
    return table(spark, sf, "events").withColumn("p", parsed).select("event_id", "p.k", "p.missing")


@query(
    "json_guard",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER)
        END AS k FROM events""",
)
def json_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Anonymised tokens in place of documents give NULL fields, not errors."""
    document = F.when(F.col("event_type") == "error", F.concat(F.lit("token_"), F.col("event_id"))).otherwise(
        F.col("props")
    )
    return table(spark, sf, "events").select(
        "event_id", casts.try_int(parse_object(document, "k string")["k"]).alias("k")
    )


@query(
    "accent_fold",
    """SELECT doc_id, md5(translate(text, 'ÁÉÍÓÚáéíóú', 'AEIOUaeiou')) AS folded,
        text <> translate(text, 'ÁÉÍÓÚáéíóú', 'AEIOUaeiou') AS changed FROM documents""",
)
def fold_accents(spark: SparkSession, sf: str) -> DataFrame:
    folded = accent_fold(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(folded).alias("folded"), (F.col("text") != folded).alias("changed")
    )


@query(
    "null_defaults",
    """SELECT o_orderkey, coalesce(l_returnflag, 'none') AS flag, coalesce(l_extendedprice, o_totalprice) AS amount
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
)
def null_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Some orders have no line."""
    joined = left_join_many(table(spark, sf, "orders"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")
    return joined.select(
        "o_orderkey",
        F.coalesce("l_returnflag", F.lit("none")).alias("flag"),
        F.coalesce("l_extendedprice", "o_totalprice").alias("amount"),
    )


@query(
    "case_bucket",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 'VIP' WHEN o_totalprice >= 100000 THEN 'Regular'
        ELSE 'New' END AS segment FROM orders""",
)
def case_bucket(spark: SparkSession, sf: str) -> DataFrame:
    segment = kpi.bucket(F.col("o_totalprice"), [(400000.0, "VIP"), (100000.0, "Regular")], "New")
    return table(spark, sf, "orders").select("o_orderkey", segment.alias("segment"))


@query(
    "bool_normalise",
    """SELECT doc_id, quality = 1 AS es_bueno, CASE WHEN toxic = 1 THEN TRUE WHEN quality = 1 THEN FALSE END AS es_toxico,
        CASE WHEN quality = 1 THEN 'ACTIVO' ELSE 'INACTIVO' END AS estado FROM labels""",
)
def bool_normalise(spark: SparkSession, sf: str) -> DataFrame:
    letter = F.when(F.col("toxic") == 1, " s ").when(F.col("quality") == 1, "N").otherwise("?")
    state = F.when(F.col("quality") == 1, " activo").otherwise("Inactivo ")
    return table(spark, sf, "labels").select(
        "doc_id",
        casts.bool_flag(F.col("quality")).alias("es_bueno"),
        casts.bool_flag(letter).alias("es_toxico"),
        casts.clean_status(state).alias("estado"),
    )


@query(
    "scalar_functions",
    f"""SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text, TRY_CAST(o_orderpriority AS INTEGER) AS as_int,
        coalesce(nullif(o_orderstatus, 'P'), 'pending') AS state,
        CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS simple_case,
        o_orderstatus IN ('F', 'O') AS listed, o_orderpriority LIKE '%URGENT%' AS urgent,
        o_orderstatus || '/' || o_orderpriority AS joined, md5(o_orderpriority) AS digest,
        lower(o_orderpriority) AS low, upper(trim('  ' || o_orderstatus || ' ')) AS clean,
        replace(o_orderpriority, '-', '_') AS replaced,
        date_trunc('month', o_orderdate) AS month_start, CAST(year(o_orderdate) AS INTEGER) AS y,
        CAST(dayofweek(o_orderdate) AS INTEGER) AS dow,
        date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS days,
        o_orderdate - INTERVAL 12 MONTH AS year_before,
        {half_up("o_totalprice / 1000", 1)} AS rounded, abs(o_totalprice - 250000) AS gap,
        sqrt(o_totalprice) AS root, o_totalprice / nullif(o_custkey, 0) AS per_key
    FROM orders""",
)
def scalar_functions(spark: SparkSession, sf: str) -> DataFrame:
    status, priority, when = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("as_text"),
        casts.try_int(priority).alias("as_int"),
        F.coalesce(F.nullif(status, F.lit("P")), F.lit("pending")).alias("state"),
        F.when(status == "F", 1).when(status == "O", 2).otherwise(3).alias("simple_case"),
        status.isin("F", "O").alias("listed"),
        priority.like("%URGENT%").alias("urgent"),
        F.concat(status, F.lit("/"), priority).alias("joined"),
        F.md5(priority).alias("digest"),
        F.lower(priority).alias("low"),
        F.upper(F.trim(F.concat(F.lit("  "), status, F.lit(" ")))).alias("clean"),
        F.replace(priority, F.lit("-"), F.lit("_")).alias("replaced"),
        F.date_trunc("month", when).cast("timestamp_ntz").alias("month_start"),
        F.year(when).alias("y"),
        (F.dayofweek(when) - 1).alias("dow"),
        F.datediff(when.cast("date"), F.lit("1995-01-01").cast("date")).cast("bigint").alias("days"),
        (when - F.expr("interval 12 months")).alias("year_before"),
        F.round(F.col("o_totalprice") / 1000, 1).alias("rounded"),
        F.abs(F.col("o_totalprice") - 250000).alias("gap"),
        F.sqrt("o_totalprice").alias("root"),
        (F.col("o_totalprice") / F.nullif("o_custkey", F.lit(0))).alias("per_key"),
    )


@query(
    "inline_relation",
    """SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS canal_id,
        o_totalprice * CASE o_orderpriority WHEN '1-URGENT' THEN 0.5e0 WHEN '2-HIGH' THEN 0.25e0 WHEN '3-MEDIUM' THEN 0.2e0
            WHEN '4-NOT SPECIFIED' THEN 0.125e0 ELSE 0.0011e0 END AS usd FROM orders""",
)
def inline_relation(spark: SparkSession, sf: str) -> DataFrame:
    rates = [0.5, 0.25, 0.2, 0.125, 0.0011]
    literal = inline(
        spark, ["canal_id", "canal", "rate"],
        [(i + 1, p, r) for i, (p, r) in enumerate(zip(PRIORITIES, rates))],
    )
    joined = table(spark, sf, "orders").join(literal, F.col("o_orderpriority") == F.col("canal"))
    return joined.select("o_orderkey", "canal_id", (F.col("o_totalprice") * F.col("rate")).alias("usd"))


# --- joins ------------------------------------------------------------------------------------


@query(
    "join_inner",
    "SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select("s_suppkey", "s_name", "n_name")


@query(
    "join_left",
    """SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    return documents.join(table(spark, sf, "labels"), "doc_id", "left")


@query(
    "join_multi_key",
    """SELECT c_custkey, s_suppkey, c_nationkey FROM customer JOIN supplier
    ON c_nationkey = s_nationkey AND c_custkey = s_suppkey""",
)
def join_multi_key(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "customer").join(
        table(spark, sf, "supplier"),
        [F.col("c_nationkey") == F.col("s_nationkey"), F.col("c_custkey") == F.col("s_suppkey")],
    )
    return joined.select("c_custkey", "s_suppkey", "c_nationkey")


@query(
    "join_left_residual",
    """SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_orderstatus = 'F' AND o_custkey = c_custkey""",
)
def join_left_residual(spark: SparkSession, sf: str) -> DataFrame:
    on = (F.col("o_orderstatus") == "F") & (F.col("o_custkey") == F.col("c_custkey"))
    return table(spark, sf, "orders").join(table(spark, sf, "customer"), on, "left").select("o_orderkey", "c_name")


@query(
    "join_cast_key",
    """SELECT o_orderkey, c_mktsegment FROM orders JOIN customer
    ON CAST(o_custkey AS VARCHAR) = CAST(c_custkey AS VARCHAR)""",
)
def join_cast_key(spark: SparkSession, sf: str) -> DataFrame:
    on = F.col("o_custkey").cast("string") == F.col("c_custkey").cast("string")
    return table(spark, sf, "orders").join(table(spark, sf, "customer"), on).select("o_orderkey", "c_mktsegment")


@query(
    "join_lower_key",
    """SELECT p_partkey, lower(p_type) AS kind, n FROM part JOIN
    (SELECT lower(p_type) AS k, count(*) AS n FROM part GROUP BY 1) q ON lower(p_type) = k""",
)
def join_lower_key(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    kinds = parts.groupBy(F.initcap(F.lower("p_type")).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    joined = parts.join(kinds, F.lower("p_type") == F.lower("k"))
    return joined.select("p_partkey", F.lower("p_type").alias("kind"), "n")


@query(
    "semi_exists",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def semi_exists(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return keep_matching(orders, table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey", unique=True)


@query(
    "semi_distinct",
    """SELECT p_partkey, p_name FROM part JOIN (SELECT DISTINCT l_partkey FROM lineitem) q ON l_partkey = p_partkey""",
)
def semi_distinct(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return keep_matching(parts, table(spark, sf, "lineitem"), "p_partkey", "l_partkey", unique=True)


@query(
    "join_left_exists",
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND EXISTS
    (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)""",
)
def join_left_exists(spark: SparkSession, sf: str) -> DataFrame:
    large = table(spark, sf, "lineitem").where("l_quantity > 45")
    orders = keep_matching(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), large, "o_orderkey", "l_orderkey", unique=True)
    people = table(spark, sf, "customer").select("c_custkey")
    return left_join_many(people, orders, "c_custkey", "o_custkey").select("c_custkey", "o_orderkey")


@query(
    "anti_join",
    "SELECT o_orderkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL",
)
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey")
    return keep_unmatched(orders, table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey", unique=True)


@query(
    "cross_scalar",
    """SELECT p_partkey, p_retailprice / (SELECT max(p_retailprice) FROM part) AS relative,
        (SELECT count(*) FROM part) AS parts FROM part""",
)
def cross_scalar(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    baseline = parts.agg(F.max("p_retailprice").alias("highest"), F.count(F.lit(1)).alias("parts"))
    return with_scalars(parts, baseline).select(
        "p_partkey", (F.col("p_retailprice") / F.col("highest")).alias("relative"), "parts"
    )


@query(
    "join_then_range",
    """SELECT l_orderkey, l_partkey, l_linenumber, o_orderdate, l_shipdate FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""",
)
def join_then_range(spark: SparkSession, sf: str) -> DataFrame:
    on = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") < F.col("o_orderdate"))
    return table(spark, sf, "lineitem").join(table(spark, sf, "orders"), on).select(
        "l_orderkey", "l_partkey", "l_linenumber", "o_orderdate", "l_shipdate"
    )


@query(
    "star_join",
    """SELECT r_name, n_name, c_mktsegment, p_brand, CAST(sum(l_quantity) AS BIGINT) AS units, count(*) AS lines
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    LEFT JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
)
def star_join(spark: SparkSession, sf: str) -> DataFrame:
    """Lines are reduced per order and part first, so hot keys shrink before the joins."""
    t = {n: table(spark, sf, n) for n in ("lineitem", "orders", "customer", "part", "nation", "region")}
    lines = t["lineitem"].groupBy("l_orderkey", "l_partkey").agg(
        F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n")
    )
    return (
        lines.join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name", "c_mktsegment", "p_brand")
        .agg(F.sum("q").cast("bigint").alias("units"), F.sum("n").alias("lines"))
    )


# --- aggregates ---------------------------------------------------------------------------------


@query(
    "aggregate",
    """SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS units, count(*) AS lines,
        max(l_extendedprice) AS highest FROM lineitem GROUP BY 1, 2""",
)
def aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").transform(
        steps.aggregate(
            ["l_returnflag", "l_linestatus"],
            ["CAST(SUM(l_quantity) AS BIGINT) AS units", "COUNT(*) AS lines", "MAX(l_extendedprice) AS highest"],
        )
    )


@query(
    "multi_distinct",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
        count(DISTINCT l_suppkey) AS suppliers, CAST(sum(l_quantity) AS BIGINT) AS units,
        min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1""",
)
def multi_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"),
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.sum("l_quantity").cast("bigint").alias("units"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query(
    "cond_distinct",
    """SELECT l_shipdate, count(DISTINCT l_partkey) AS parts,
        count(DISTINCT CASE WHEN l_quantity >= 25 THEN l_partkey END) AS large FROM lineitem GROUP BY 1""",
)
def cond_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """One row per part and day carries whether any line is large, so one distinct is enough."""
    per_part = table(spark, sf, "lineitem").groupBy("l_shipdate", "l_partkey").agg(
        F.max("l_quantity").alias("q")
    )
    return per_part.groupBy("l_shipdate").agg(
        F.count("l_partkey").alias("parts"), F.count_if(F.col("q") >= 25).alias("large")
    )


@query(
    "cond_aggs",
    """SELECT o_custkey, count(*) AS orders, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS completed,
        CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18, 2)) ELSE 0 END) AS DOUBLE) AS spent,
        CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18, 2)) END) AS DOUBLE)
            / count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS average
    FROM orders GROUP BY 1""",
)
def cond_aggs(spark: SparkSession, sf: str) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    amount = money("o_totalprice")
    return as_double(
        table(spark, sf, "orders").groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if(done).alias("completed"),
            F.sum(F.when(done, amount).otherwise(F.lit(0))).alias("spent"),
            kpi.ratio(F.sum(F.when(done, amount)), F.count_if(done)).alias("average"),
        )
    )


@query(
    "global_agg",
    """SELECT count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS units, min(l_shipdate) AS first_ship,
        max(l_extendedprice) AS highest, count(DISTINCT l_suppkey) AS suppliers FROM lineitem""",
)
def global_agg(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("l_quantity").cast("bigint").alias("units"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_extendedprice").alias("highest"),
        F.count_distinct("l_suppkey").alias("suppliers"),
    )


@query(
    "ratio_of_sums",
    """SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE)
        / nullif(sum(l_quantity - 1), 0) AS ratio FROM lineitem GROUP BY 1""",
)
def ratio_of_sums(spark: SparkSession, sf: str) -> DataFrame:
    ratio = kpi.ratio(F.sum(money("l_extendedprice")), F.sum(F.col("l_quantity") - 1))
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(ratio.alias("ratio"))


@query(
    "group_by_expr",
    """SELECT lower(o_orderpriority) AS canal, date_trunc('month', o_orderdate) AS mes, count(*) AS orders
    FROM orders GROUP BY 1, 2""",
)
def group_by_expr(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy(
        F.lower("o_orderpriority").alias("canal"),
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("mes"),
    ).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "percentiles",
    """SELECT quantile_cont(l_extendedprice, 0.05) AS p05, quantile_cont(l_extendedprice, 0.25) AS p25,
        median(l_extendedprice) AS middle, quantile_cont(l_extendedprice, 0.75) AS p75 FROM lineitem""",
)
def percentiles(spark: SparkSession, sf: str) -> DataFrame:
    points = {"p05": 0.05, "p25": 0.25, "middle": 0.5, "p75": 0.75}
    return exact_percentiles(table(spark, sf, "lineitem"), "l_extendedprice", points)


@query(
    "two_level",
    """SELECT c_nationkey, count(*) AS customers, max(n) AS most_orders, CAST(sum(n) AS BIGINT) AS orders
    FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) q JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def two_level(spark: SparkSession, sf: str) -> DataFrame:
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    joined = per_customer.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("customers"), F.max("n").alias("most_orders"), F.sum("n").alias("orders")
    )


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query(
    "column_stats",
    """SELECT min(x) AS "min", max(x) AS "max", count(*) AS total, count(*) - count(x) AS nulls,
        count(DISTINCT x) AS "distinct" FROM (SELECT nullif(l_quantity, 1) AS x FROM lineitem) q""",
)
def column_stats(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(F.nullif("l_quantity", F.lit(1.0)).alias("x"))
    return stats_of(lines, "x")


@query(
    "correlation",
    f"SELECT {half_up('corr(l_quantity, l_extendedprice)', 8)} AS correlation FROM lineitem",
)
def correlation(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").agg(
        F.round(F.corr("l_quantity", "l_extendedprice"), 8).alias("correlation")
    )


@query(
    "first_last_seen",
    """SELECT user_id, event_type, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS times
    FROM events GROUP BY 1, 2""",
)
def first_last_seen(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id", "event_type").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("times")
    )


# --- windows ------------------------------------------------------------------------------------


@query(
    "latest_version",
    """SELECT event_id, user_id, event_type, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def newest_event(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return latest_version(events, ["user_id", "event_type"], F.struct("ts", "event_id"))


@query(
    "best_row",
    """SELECT l_partkey, l_suppkey, l_extendedprice, discount FROM
    (SELECT *, nullif(l_discount, 0) AS discount FROM lineitem) q
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY discount NULLS LAST, l_extendedprice, l_suppkey) = 1""",
)
def cheapest_line(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_partkey", "l_suppkey", "l_extendedprice", F.nullif("l_discount", F.lit(0.0)).alias("discount")
    )
    return best_row(
        lines, ["l_partkey"],
        [F.col("discount").asc_nulls_last(), F.col("l_extendedprice").asc(), F.col("l_suppkey").asc()],
    )


@query("principal_location", SALES + "SELECT cust AS cliente_id, nk AS ubicacion_id FROM principal")
def principal_location(spark: SparkSession, sf: str) -> DataFrame:
    return principal_place(Bound(spark, sf).cliente_ubicacion_geo)


@query(
    "preferred_channel",
    """SELECT o_custkey AS cliente_id, o_orderpriority AS canal FROM (
        SELECT o_custkey, o_orderpriority, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS amt
        FROM orders GROUP BY 1, 2) q
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, amt DESC, o_orderpriority) = 1""",
)
def preferred_channel(spark: SparkSession, sf: str) -> DataFrame:
    order = [
        F.col("total_pedidos").desc_nulls_last(),
        F.col("monto_total_acumulado").desc_nulls_last(),
        F.col("canal").asc(),
    ]
    return best_row(Bound(spark, sf).cliente_canal, ["cliente_id"], order).select("cliente_id", "canal")


@query(
    "rank_partition",
    """WITH sales AS (SELECT l_returnflag, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS units,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1, 2)
    SELECT *, rank() OVER (PARTITION BY l_returnflag ORDER BY revenue DESC) AS rank_revenue,
        rank() OVER (PARTITION BY l_returnflag ORDER BY units DESC) AS rank_units FROM sales""",
)
def rank_partition(spark: SparkSession, sf: str) -> DataFrame:
    sales = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_partkey").agg(
        F.sum("l_quantity").cast("bigint").alias("units"),
        F.sum(money("l_extendedprice")).cast("double").alias("revenue"),
    )
    return with_ranks(sales, ["l_returnflag"], {"revenue": "rank_revenue", "units": "rank_units"})


@query(
    "rank_flag",
    """WITH n AS (SELECT o_custkey, o_orderpriority, count(*) AS orders FROM orders GROUP BY 1, 2)
    SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY orders DESC) = 1 AS dominant FROM n""",
)
def rank_flag(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders")
    )
    window = Window.partitionBy("o_custkey").orderBy(F.col("orders").desc())  # one row per priority
    return counts.withColumn("dominant", F.rank().over(window) == 1)


@query(
    "count_over",
    """SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS orders_of_customer,
        count(*) OVER (PARTITION BY o_custkey) = 1 AS only_order FROM orders""",
)
def count_over(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    counted = with_group_totals(orders, ["o_custkey"], [F.count(F.lit(1)).alias("orders_of_customer")])
    return counted.select(
        "o_orderkey", "orders_of_customer", (F.col("orders_of_customer") == 1).alias("only_order")
    )


MONTHS = """
WITH months AS (
    SELECT o_orderpriority AS canal, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes, count(*) AS n
    FROM orders GROUP BY 1, 2
)
"""


def _months(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("canal"), F.trunc("o_orderdate", "month").alias("mes")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("avg_over", MONTHS + "SELECT *, avg(n) OVER (PARTITION BY canal, year(mes)) AS year_mean FROM months")
def avg_over(spark: SparkSession, sf: str) -> DataFrame:
    window = Window.partitionBy("canal", F.year("mes"))
    return _months(spark, sf).withColumn("year_mean", F.avg("n").over(window))


@query("lag", MONTHS + "SELECT *, lag(n) OVER (PARTITION BY canal ORDER BY mes) AS before FROM months")
def lag(spark: SparkSession, sf: str) -> DataFrame:
    window = Window.partitionBy("canal").orderBy("mes")  # one row per month
    return _months(spark, sf).withColumn("before", F.lag("n").over(window))


@query(
    "corr_over_all",
    f"""WITH s AS (SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS units, count(*) AS lines FROM lineitem GROUP BY 1)
    SELECT *, {half_up("(SELECT corr(units, lines) FROM s)", 6)} AS correlation FROM s""",
)
def corr_over_all(spark: SparkSession, sf: str) -> DataFrame:
    sales = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum("l_quantity").cast("bigint").alias("units"), F.count(F.lit(1)).alias("lines")
    )
    return with_scalars(sales, sales.agg(F.round(F.corr("units", "lines"), 6).alias("correlation")))


@query(
    "duplicate_flag",
    """SELECT c_custkey, c_nationkey, c_mktsegment,
        row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) > 1 AS repeated FROM customer""",
)
def duplicate_flag(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return mark_duplicates(people, ["c_nationkey", "c_mktsegment"], "c_custkey", "repeated")


# --- sort and limit -----------------------------------------------------------------------------


@query(
    "order_nulls_last",
    """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders ORDER BY status DESC NULLS LAST, o_orderkey""",
)
def order_nulls_last(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return orders.orderBy(F.col("status").desc_nulls_last(), "o_orderkey")


@query(
    "order_multi",
    "SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders ORDER BY o_orderdate DESC, o_orderpriority, o_orderkey",
)
def order_multi(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority").orderBy(
        F.col("o_orderdate").desc_nulls_last(), F.col("o_orderpriority").asc_nulls_last(), "o_orderkey"
    )


@query(
    "top_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 14",
)
def top_n(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc_nulls_last(), "o_orderkey"
    ).limit(14)


# --- unions and arrays ----------------------------------------------------------------------------


@query(
    "union_sources",
    """SELECT o_orderkey AS pedido_id, CASE o_orderkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS canal,
        CASE o_orderkey % 3 WHEN 0 THEN floor(o_totalprice * 100) / 100e0 ELSE o_totalprice END AS monto FROM orders""",
)
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Three shapes of one fact: cents, text amounts and JSON totals."""
    orders = table(spark, sf, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    a = orders.where(key % 3 == 0).select(
        key.alias("pedido_id"), F.lit("a").alias("canal"), casts.from_cents(F.floor(price * 100)).alias("monto")
    )
    b = orders.where(key % 3 == 1).select(
        casts.try_double(price.cast("string")).alias("monto"), key.alias("pedido_id"), F.lit("b").alias("canal")
    )
    total = parse_object(F.to_json(F.struct(price.alias("total"))), "total string")["total"]
    c = orders.where(key % 3 == 2).select(
        F.lit("c").alias("canal"), key.alias("pedido_id"), casts.try_double(total).alias("monto")
    )
    return a.unionByName(b).unionByName(c)


@query(
    "union_distinct_branches",
    """SELECT DISTINCT l_partkey AS id, 'part' AS kind FROM lineitem
    UNION ALL SELECT DISTINCT l_suppkey, 'supplier' FROM lineitem""",
)
def union_distinct_branches(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    parts = lines.select(F.col("l_partkey").alias("id"), F.lit("part").alias("kind")).distinct()
    return parts.unionByName(lines.select(F.col("l_suppkey").alias("id"), F.lit("supplier").alias("kind")).distinct())


def _order_documents(spark: SparkSession, sf: str) -> DataFrame:
    element = F.struct(
        F.struct(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("flag")).alias("item"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
    )
    return line_documents(spark, sf, None, element)


@query("explode_json_array", "SELECT l_orderkey, count(*) AS elements FROM lineitem GROUP BY 1")
def explode_json_array(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays are counted back element by element; empty and missing arrays give no row."""
    documents = _order_documents(spark, sf)
    none = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.when(F.col("o_orderkey") % 2 == 0, "[]").alias("elements"),
    )
    exploded = explode_documents(documents.unionByName(none), "elements", "quantity string")
    return exploded.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("elements"))


@query(
    "element_fields",
    """SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS id, l_returnflag AS flag,
        CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS price FROM lineitem""",
)
def element_fields(spark: SparkSession, sf: str) -> DataFrame:
    ddl = "item struct<id:string, flag:string>, quantity string, price string"
    return explode_documents(_order_documents(spark, sf), "elements", ddl, "e").select(
        "l_orderkey", "e.item.id", "e.item.flag",
        casts.try_int(F.col("e.quantity")).alias("quantity"),
        casts.try_double(F.col("e.price")).alias("price"),
    )


# --- geography and statistics -------------------------------------------------------------------


def _customer_points(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with coordinates from their key; a quarter has none."""
    known = F.col("c_custkey") % 4 != 0
    return table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey",
        F.when(known, F.lit(-55.0) + F.col("c_custkey") % 30).alias("lat"),
        F.when(known, F.lit(-70.0) + F.col("c_custkey") % 17).alias("lon"),
    )


POINTS = """
WITH points AS (
    SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 4 <> 0 THEN -55e0 + c_custkey % 30 END AS lat,
        CASE WHEN c_custkey % 4 <> 0 THEN -70e0 + c_custkey % 17 END AS lon FROM customer
)
"""


@query(
    "haversine_km",
    POINTS
    + """SELECT c_custkey, round(2 * 6371 * asin(sqrt(power(sin(radians(lat + 34.6037e0) / 2), 2)
        + cos(radians(-34.6037e0)) * cos(radians(lat)) * power(sin(radians(lon + 58.3816e0) / 2), 2))), 1) AS km
    FROM points""",
)
def haversine(spark: SparkSession, sf: str) -> DataFrame:
    return _customer_points(spark, sf).select(
        "c_custkey", geo.haversine_km(F.col("lat"), F.col("lon")).alias("km")
    )


@query(
    "coord_fallback",
    POINTS
    + f"""SELECT c_custkey, {half_up("coalesce(p.lat, m.lat)", 6)} AS lat, {half_up("coalesce(p.lon, m.lon)", 6)} AS lon
    FROM points p LEFT JOIN (SELECT c_nationkey, avg(lat) AS lat, avg(lon) AS lon FROM points GROUP BY 1) m
    ON m.c_nationkey = p.c_nationkey""",
)
def coord_fallback(spark: SparkSession, sf: str) -> DataFrame:
    points = _customer_points(spark, sf)
    filled = with_group_totals(
        points, ["c_nationkey"], [F.avg("lat").alias("mean_lat"), F.avg("lon").alias("mean_lon")]
    )
    return filled.select(
        "c_custkey",
        F.round(F.coalesce("lat", "mean_lat"), 6).alias("lat"),
        F.round(F.coalesce("lon", "mean_lon"), 6).alias("lon"),
    )


@query(
    "geo_point",
    POINTS
    + """SELECT c_nationkey, CAST(CAST(avg(lat) AS DECIMAL(12, 4)) AS VARCHAR) || ','
        || CAST(CAST(avg(lon) AS DECIMAL(12, 4)) AS VARCHAR) AS point FROM points GROUP BY 1""",
)
def geo_point(spark: SparkSession, sf: str) -> DataFrame:
    return _customer_points(spark, sf).groupBy("c_nationkey").agg(
        geo.geo_point(F.avg("lat"), F.avg("lon"), 4).alias("point")
    )


RATED = """
WITH rated AS (
    SELECT p_partkey, p_retailprice AS population, units / p_retailprice AS rate
    FROM part JOIN (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS units FROM lineitem GROUP BY 1) u
    ON l_partkey = p_partkey
)
"""


def _rated_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Units per price unit: the shape of a penetration rate, over every part."""
    units = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("units"))
    joined = units.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        "p_partkey", F.col("p_retailprice").alias("population"),
        kpi.ratio(F.col("units"), F.col("p_retailprice")).alias("rate"),
    )


@query(
    "quadrant",
    RATED
    + """, cuts AS (SELECT median(population) AS m, quantile_cont(rate, 0.25) AS p25, quantile_cont(rate, 0.75) AS p75 FROM rated)
    SELECT p_partkey, CASE WHEN population >= m AND rate >= p75 THEN 'Vaca lechera'
        WHEN population >= m AND rate < p25 THEN 'Gigante dormido' WHEN population < m AND rate >= p75 THEN 'Nicho fiel'
        ELSE 'Sin foco' END AS quadrant FROM rated, cuts""",
)
def quadrant(spark: SparkSession, sf: str) -> DataFrame:
    parts = materialise(_rated_parts(spark, sf), "rated-parts")  # read for the percentiles and the rows
    cuts = {"rate": {"p25": 0.25, "p75": 0.75}, "population": {"middle": 0.5}}
    known = with_scalars(parts, percentiles_of(parts, cuts))
    return known.select(
        "p_partkey",
        kpi.market_quadrant(
            F.col("population"), F.col("rate"), F.col("middle"), F.col("p25"), F.col("p75")
        ).alias("quadrant"),
    )


@query(
    "seasonality_index",
    MONTHS
    + f"""SELECT canal, mes, {half_up("n / avg(n) OVER (PARTITION BY canal, year(mes))", 2)} AS seasonality FROM months""",
)
def seasonality_index(spark: SparkSession, sf: str) -> DataFrame:
    mean = F.avg("n").over(Window.partitionBy("canal", F.year("mes")))
    return _months(spark, sf).select(
        "canal", "mes", F.round(kpi.ratio(F.col("n"), mean), 2).alias("seasonality")
    )


@query(
    "drop_alert",
    MONTHS
    + f""", s AS (SELECT *, lag(n) OVER (PARTITION BY canal ORDER BY mes) AS before FROM months)
    SELECT canal, mes, CASE WHEN before > 0 THEN {half_up("(n - before) / CAST(before AS DOUBLE) * 100", 2)} END AS change_pct,
        coalesce(before > 0 AND (n - before) / CAST(before AS DOUBLE) <= -0.20e0, FALSE) AS alert FROM s""",
)
def drop_alert(spark: SparkSession, sf: str) -> DataFrame:
    before = F.lag("n").over(Window.partitionBy("canal").orderBy("mes"))
    series = _months(spark, sf).withColumns({"before": before.cast("double"), "now": F.col("n").cast("double")})
    return series.select(
        "canal", "mes",
        kpi.change_pct(F.col("now"), F.col("before")).alias("change_pct"),
        kpi.dropped(F.col("now"), F.col("before")).alias("alert"),
    )


@query(
    "incremental_potential",
    RATED
    + f""", nation_wide AS (SELECT max(rate) / 2 AS r FROM rated)
    SELECT p_partkey, CASE WHEN rate < r THEN {half_up("(r - rate) * population * 3e0", 2)} ELSE 0e0 END AS potential
    FROM rated, nation_wide""",
)
def incremental_potential(spark: SparkSession, sf: str) -> DataFrame:
    parts = _rated_parts(spark, sf)
    target = parts.agg((F.max("rate") / 2).alias("target"))
    return with_scalars(parts, target).select(
        "p_partkey",
        kpi.potential_revenue(F.col("rate"), F.col("target"), F.col("population"), F.lit(3.0)).alias("potential"),
    )


@query(
    "report_top_products",
    CATALOGUE
    + """SELECT canal, producto_id_origen, revenue_total FROM catalogue
    ORDER BY revenue_total DESC, canal, producto_id_origen LIMIT 10""",
)
def report_top_products(spark: SparkSession, sf: str) -> DataFrame:
    products = Bound(spark, sf).canal_producto.where("total_unidades > 0")
    ranked = products.orderBy(F.col("revenue_total").desc_nulls_last(), "canal", "producto_id_origen").limit(10)
    return as_double(ranked.select("canal", "producto_id_origen", "revenue_total"))
