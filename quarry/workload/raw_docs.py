"""Raw e-commerce tables derived from the TPC-H-like tables.

Orders are spread over the three channels by key; every tenth order also has an older version,
some addresses are anonymised tokens, some e-mails, countries and coordinates are missing, and
orders without lines have empty item arrays.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.keys import address_key
from quarry.operators.joins import left_join_many
from quarry.session import SCRATCH_CODEC, scratch_path, shuffles_released
from quarry.sources.folder import has_files
from quarry.workload.registry import table

STRETCH_BITS = 20  # an order's lines in so many (2 ** 20) neighbouring rows of a file make one document


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _stamp(c: Column, suffix: str) -> Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(suffix))


def people(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with place, address and e-mail."""
    return with_places(spark, sf, table(spark, sf, "customer"))


def with_places(spark: SparkSession, sf: str, customers: DataFrame) -> DataFrame:
    """Place, address and e-mail added to rows with customer columns; other columns stay."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    joined = customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return joined.select(
        *customers.columns, "n_nationkey", "n_name", "r_name",
        country().alias("country"),
        F.lpad(text("n_nationkey"), 4, "0").alias("cp"),
        F.when(F.col("c_custkey") % 11 != 0, F.concat(F.lit("c"), text("c_custkey"), F.lit("@example.com"))).alias(
            "email"
        ),
        F.concat(F.lit("Calle "), text("c_custkey")).alias("street"),
        text(F.col("c_custkey") % 100).alias("door"),
        latitude().alias("lat"),
        longitude().alias("lon"),
    )


def country() -> Column:
    return F.when(F.col("n_nationkey") % 3 == 0, "AR").when(F.col("n_nationkey") % 3 == 1, "ARG")


def latitude(c: str = "n_nationkey") -> Column:
    known = F.lit(-55.0) + F.lit(1.3) * F.col(c)
    return F.when(F.col(c) % 7 != 6, known).otherwise(F.lit(0.0))


def longitude(c: str = "n_nationkey") -> Column:
    known = F.lit(-70.0) + F.lit(0.7) * F.col(c)
    return F.when(F.col(c) % 7 != 6, known).otherwise(F.lit(0.0))


def _lines(spark: SparkSession, sf: str, channel: int | None) -> DataFrame:
    """The lines with the stretch of a file, ``document``, that they lie in."""
    lines = table(spark, sf, "lineitem")
    if channel is not None:
        lines = lines.where(F.col("l_orderkey") % 3 == channel)
    return lines.withColumn(
        "document", F.xxhash64("_metadata.file_path", F.shiftright("_metadata.row_index", STRETCH_BITS))
    )


def line_documents(
    spark: SparkSession, sf: str, channel: int | None, element: Column
) -> DataFrame:
    """(l_orderkey, elements) with the lines of an order as one JSON array.

    The lines that lie in one stretch of a file make one document, so that none has more lines than a stretch has
    rows, however many the order has.
    """
    return (
        _lines(spark, sf, channel)
        .groupBy("l_orderkey", "document")
        .agg(F.to_json(F.collect_list(element)).alias("elements"))
        .drop("document")
    )


def _orders(spark: SparkSession, sf: str, channel: int) -> DataFrame:
    return with_places(spark, sf, _bought(spark, sf, channel))


def _bought(spark: SparkSession, sf: str, channel: int) -> DataFrame:
    """Orders with the columns of their customers."""
    orders = table(spark, sf, "orders").where(F.col("o_orderkey") % 3 == channel)
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def _with_lines(spark: SparkSession, sf: str, channel: int, element: Callable[[Column], Column]) -> DataFrame:
    """The channel's orders with a row for each of their line documents.

    Lines and orders are shuffled in the columns of the tables; texts and places are made of them after the last join.
    """
    line = F.struct("l_partkey", "l_quantity", "l_extendedprice")
    lines = _lines(spark, sf, channel)
    documents = lines.groupBy("l_orderkey", "document").agg(F.collect_list(line).alias("lines")).drop("document")
    orders = _bought(spark, sf, channel)
    keys = table(spark, sf, "orders").where(F.col("o_orderkey") % 3 == channel)
    joined = left_join_many(orders, documents, "o_orderkey", "l_orderkey", keys, lines)
    return with_places(spark, sf, joined).withColumn(
        "elements", F.coalesce(F.to_json(F.transform("lines", element)), F.lit("[]"))
    )


def _token_or(c: Column) -> Column:
    token = F.concat(F.lit("direccion_"), F.lpad(text("o_orderkey"), 6, "0"))
    return F.when(F.col("o_orderkey") % 50 == 0, token).otherwise(c)


def vtex_pedido(spark: SparkSession, sf: str) -> DataFrame:
    element = lambda line: F.struct(
        text(line["l_partkey"]).alias("productId"),
        F.concat(F.lit("Part "), text(line["l_partkey"])).alias("name"),
        line["l_quantity"].cast("int").alias("quantity"),
        F.floor(line["l_extendedprice"] * 100).alias("sellingPrice"),
    )
    docs = _with_lines(spark, sf, 0, element)
    place = F.struct(
        F.col("street"), F.col("door").alias("number"), F.col("n_name").alias("city"),
        F.col("r_name").alias("state"), F.col("cp").alias("postalCode"), "country",
    )
    current = docs.select(
        text("o_orderkey").alias("orderId"),
        F.col("o_orderstatus").alias("status"),
        F.floor(F.col("o_totalprice") * 100).alias("value"),
        _stamp(F.col("o_orderdate"), ".0000000+00:00").alias("creationDate"),
        _stamp(F.col("o_orderdate") + F.expr("interval 2 days"), ".0000000+00:00").alias("lastChange"),
        F.to_json(
            F.struct(
                text("c_custkey").alias("userProfileId"), "email", F.col("c_name").alias("firstName"),
                F.col("c_mktsegment").alias("lastName"),
            )
        ).alias("clientProfileData"),
        _token_or(F.to_json(F.struct(place.alias("address")))).alias("shippingData"),
        F.col("elements").alias("items"),
        (F.col("o_orderkey") % 10 == 0).alias("revised"),
    )
    return _with_old_versions(
        current, {"status": F.lit("old"), "value": F.lit(1), "lastChange": F.col("creationDate"), "items": F.lit("[]")}
    )


def meli_pedido(spark: SparkSession, sf: str) -> DataFrame:
    element = lambda line: F.struct(
        F.struct(
            F.concat(F.lit("P"), text(line["l_partkey"])).alias("id"),
            F.concat(F.lit("Part "), text(line["l_partkey"])).alias("title"),
            F.concat(F.lit("CAT"), text(line["l_partkey"] % 10)).alias("category_id"),
        ).alias("item"),
        line["l_quantity"].alias("quantity"),
        line["l_extendedprice"].alias("unit_price"),
        F.lit("ARS").alias("currency_id"),
    )
    docs = _with_lines(spark, sf, 1, element)
    closed = F.when(
        F.col("o_orderstatus") == "F", _stamp(F.col("o_orderdate") + F.expr("interval 5 days"), ".000-04:00")
    )
    current = docs.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total_amount"),
        _stamp(F.col("o_orderdate"), ".000-04:00").alias("date_created"),
        _stamp(F.col("o_orderdate") + F.expr("interval 2 days"), ".000-04:00").alias("last_updated"),
        closed.alias("date_closed"),
        F.to_json(F.struct(F.col("c_custkey").alias("id"), "email", F.col("c_name").alias("nickname"))).alias("buyer"),
        F.col("elements").alias("order_items"),
        (F.col("o_orderkey") % 10 == 0).alias("revised"),
    )
    return _with_old_versions(
        current,
        {
            "status": F.lit("old"), "total_amount": F.lit(1.0),
            "last_updated": F.col("date_created"), "order_items": F.lit("[]"),
        },
    )


def garbarino_pedido(spark: SparkSession, sf: str) -> DataFrame:
    element = lambda line: F.struct(
        line["l_partkey"].alias("product_id"),
        F.concat(F.lit("Part "), text(line["l_partkey"])).alias("title"),
        line["l_quantity"].cast("int").alias("quantity"),
        line["l_extendedprice"].alias("price"),
    )
    docs = _with_lines(spark, sf, 2, element)
    place = F.struct(
        F.col("street"), F.col("door").alias("number"), F.col("n_name").alias("city"),
        F.col("r_name").alias("state"), F.col("cp").alias("zip"), "country",
    )
    created = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    earlier = F.date_format(F.col("o_orderdate") - F.expr("interval 1 day"), "yyyy-MM-dd HH:mm:ss")
    current = docs.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        created.alias("created"),
        F.to_json(F.struct(text("c_custkey").alias("id"), "email", F.col("c_name").alias("name"))).alias("customer"),
        F.to_json(F.struct(F.col("o_totalprice").alias("total"))).alias("totals_sale"),
        _token_or(F.to_json(place)).alias("billing_address"),
        F.col("elements").alias("sold_items"),
        (F.col("o_orderkey") % 10 == 0).alias("revised"),
        earlier.alias("earlier"),
    )
    return _with_old_versions(
        current, {"status": F.lit("old"), "created": F.col("earlier"), "sold_items": F.lit("[]")}
    ).drop("earlier")


def _with_old_versions(current: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Every revised document twice, the second time with the changes of its older version."""
    versions = F.when(F.col("revised"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    exploded = current.withColumn("old", F.explode(versions))

    def value(c: str) -> Column:
        if c not in changes:
            return F.col(c)
        kind = current.schema[c].dataType
        return F.when(F.col("old"), changes[c].cast(kind)).otherwise(F.col(c)).alias(c)

    return exploded.select(*[value(c) for c in current.columns if c != "revised"])


def type_6(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments of the second channel: buyer's city, and the city of the first supplier."""
    senders = (
        table(spark, sf, "lineitem")
        .where(F.col("l_orderkey") % 3 == 1)
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("suppkey"))
        .join(table(spark, sf, "supplier"), F.col("suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "nation").select(
            F.col("n_nationkey").alias("s_nation"), F.col("n_name").alias("s_city"), F.col("n_regionkey").alias("s_region")
        ), F.col("s_nationkey") == F.col("s_nation"))
        .join(table(spark, sf, "region").select(
            F.col("r_regionkey").alias("s_region"), F.col("r_name").alias("s_state")
        ), "s_region")
    )
    joined = _orders(spark, sf, 1).join(senders, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    receiver = F.struct(
        F.struct(F.col("n_name").alias("name")).alias("city"),
        F.struct(F.col("r_name").alias("name")).alias("state"),
        F.struct(F.col("country").alias("id")).alias("country"),
        F.col("cp").alias("zip_code"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.concat(F.lit("Av "), text("c_custkey")).alias("street_name"),
        F.col("door").alias("street_number"),
    )
    sender = F.struct(
        F.struct(F.col("s_city").alias("name")).alias("city"),
        F.struct(F.col("s_state").alias("name")).alias("state"),
        F.struct(F.lit("AR").alias("id")).alias("country"),
        F.lpad(text("s_nation"), 4, "0").alias("zip_code"),
        latitude("s_nation").alias("latitude"), longitude("s_nation").alias("longitude"),
        F.lit("Deposito").alias("street_name"), text("suppkey").alias("street_number"),
    )
    current = joined.select(
        F.col("o_orderkey").alias("id"),
        text("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.lit(None).cast("string").alias("substatus"),
        F.col("o_orderpriority").alias("logistic_type"),
        F.concat(F.lit("T"), text("o_orderkey")).alias("tracking_number"),
        F.lit("correo").alias("tracking_method"),
        _stamp(F.col("o_orderdate"), ".000-04:00").alias("date_created"),
        _stamp(F.col("o_orderdate") + F.expr("interval 2 days"), ".000-04:00").alias("last_updated"),
        F.when(F.col("suppkey").isNotNull(), F.to_json(sender)).alias("sender_address"),
        F.to_json(receiver).alias("receiver_address"),
        (F.col("o_orderkey") % 10 == 0).alias("revised"),
    )
    return _with_old_versions(current, {"status": F.lit("old"), "last_updated": F.col("date_created")})


def type_8(spark: SparkSession, sf: str) -> DataFrame:
    """Payments of the second channel."""
    o = _orders(spark, sf, 1)
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.lit("approved").alias("status"),
        F.lit("accredited").alias("status_detail"),
        _stamp(F.col("o_orderdate"), ".000-04:00").alias("date_created"),
        F.when(F.col("o_orderstatus") != "P", _stamp(F.col("o_orderdate"), ".000-04:00")).alias("date_approved"),
        text("o_totalprice").alias("transaction_amount"),
        F.col("o_totalprice").alias("total_paid_amount"),
        (F.col("o_totalprice") * 0.88).alias("net_received_amount"),
        (F.col("o_totalprice") * 0.1).alias("mercadopago_fee"),
        F.lit("n/a").alias("marketplace_fee"),
        F.lit("credit_card").alias("payment_type"),
        F.col("o_orderpriority").alias("payment_method_id"),
        F.concat(text(F.col("o_orderkey") % 12 + 1), F.lit(".0")).alias("installments"),
        F.lit("ARS").alias("currency_id"),
        F.to_json(F.struct(F.col("c_custkey").alias("id"), "email", F.col("c_name").alias("first_name"))).alias("payer"),
    )


def meli_pickup(spark: SparkSession, sf: str) -> DataFrame:
    """Pending orders of the second channel are collected in a store."""
    o = _orders(spark, sf, 1).where("o_orderstatus = 'P'")
    store = F.struct(
        F.col("n_nationkey").alias("id"),
        F.concat(F.lit("Tienda "), F.col("n_name")).alias("name"),
        F.struct(
            F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
            F.struct(
                F.col("n_name").alias("city"), F.col("r_name").alias("state"),
                F.lit("9999").alias("zip_code"), F.lit("Local 1").alias("address_line"),
            ).alias("address"),
        ).alias("location"),
    )
    person = F.struct(F.col("c_name").alias("name"), F.lit("DNI").alias("id_type"), F.col("c_custkey").alias("id_number"))
    return o.select(
        F.concat(F.lit("PK"), text("o_orderkey")).alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.lit("ready").alias("status"),
        _stamp(F.col("o_orderdate"), ".000-04:00").alias("date_created"),
        _stamp(F.col("o_orderdate") + F.expr("interval 3 days"), ".000-04:00").alias("date_ready"),
        F.col("c_custkey").alias("buyer_id"),
        F.to_json(store).alias("store_info"),
        F.to_json(person).alias("pickup_person"),
    )


def geo_coords(spark: SparkSession, sf: str) -> DataFrame:
    """Geocoding file, all text: one row per customer address, and an incomplete copy of some."""
    key = address_key(F.col("street"), F.col("door"), F.col("n_name"), F.col("cp"), F.col("country"))
    population = F.when(F.col("n_nationkey") % 10 != 9, text(F.lit(1000) + F.lit(137) * F.col("n_nationkey")))
    rows = people(spark, sf).select(
        key.alias("direccion_id"),
        text(F.lit(-55.0) + F.lit(1.3) * F.col("n_nationkey")).alias("latitud"),
        text(F.lit(-70.0) + F.lit(0.7) * F.col("n_nationkey")).alias("longitud"),
        F.col("n_name").alias("matched_city"),
        F.col("r_name").alias("matched_provincia"),
        F.concat(population, F.lit(".0")).alias("population"),
        F.lit("exact").alias("match_type"),
        (F.col("c_custkey") % 5 == 0).alias("copied"),
    )
    unknown = F.lit(None).cast("string")
    copies = rows.where("copied").withColumns({"latitud": unknown, "longitud": unknown})
    return rows.unionByName(copies).drop("copied")


BUILDERS = {
    "vtex_pedido": vtex_pedido,
    "meli_pedido": meli_pedido,
    "garbarino_pedido": garbarino_pedido,
    "type_6": type_6,
    "type_8": type_8,
    "meli_pickup": meli_pickup,
    "geo_coords": geo_coords,
}
_written: dict[tuple[str, str, str], str] = {}


def raw_tables(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    """The raw tables by name, written to the shared scratch folder on first use."""

    def path_of(name: str) -> str:
        key = (spark.sparkContext.applicationId, sf, name)
        if key not in _written or not has_files(spark, _written[key]):
            path = scratch_path(spark, f"raw-{name}")
            BUILDERS[name](spark, sf).write.option("compression", SCRATCH_CODEC).parquet(path)
            _written[key] = path
        return _written[key]

    wanted = list(names or BUILDERS)
    with shuffles_released(spark), ThreadPoolExecutor(4) as pool:
        paths = dict(zip(wanted, pool.map(path_of, wanted)))
    return {name: spark.read.parquet(path) for name, path in paths.items()}
