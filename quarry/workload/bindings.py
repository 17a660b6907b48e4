"""The staging tables of the consume models, bound to the TPC-H-like tables.

Channel = order priority, city = nation, province = region (with accents put in, so that
folding matters), place of a customer = nations of the suppliers of its lines. Amounts are
decimals, so that sums do not depend on the order of the rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.plans import consume, staging
from quarry.session import materialise
from quarry.sources.inline import inline_relation
from quarry.workload.registry import table

# The order priorities, used as channels.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
AS_OF = "2001-08-01"


def money(c: str):
    return F.col(c).cast("decimal(18,2)")


def as_double(df: DataFrame) -> DataFrame:
    """Decimals back to the DOUBLE of the published tables."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
            for f in df.schema
        ]
    )


class Bound:
    """Lazily built inputs for one data folder."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

        self._tables: dict[str, DataFrame] = {}

    def _t(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = table(self.spark, self.sf, name)
        return self._tables[name]

    @cached_property
    def canal(self) -> DataFrame:
        return inline_relation(
            self.spark, ["canal_id", "canal"], [(i + 1, p) for i, p in enumerate(PRIORITIES)]
        )

    @cached_property
    def pedido(self) -> DataFrame:
        return self._t("orders").select(
            F.col("o_orderkey").alias("pedido_id"), F.col("o_orderpriority").alias("canal"),
            F.col("o_orderstatus").alias("status"), money("o_totalprice").alias("monto_total"),
            F.col("o_orderdate").alias("fecha_creacion"),
        )

    @cached_property
    def cliente_pedido(self) -> DataFrame:
        return self._t("orders").select(
            F.col("o_custkey").alias("cliente_id"), F.col("o_orderkey").alias("pedido_id"),
            F.col("o_orderpriority").alias("canal"), money("o_totalprice").alias("monto_total"),
            F.col("o_orderdate").alias("fecha_pedido"), F.col("o_orderstatus").alias("status"),
        )

    @cached_property
    def item_pedido(self) -> DataFrame:
        return self._t("lineitem").select(
            F.col("l_orderkey").alias("pedido_id"), F.col("l_partkey").alias("producto_id_origen"),
            F.col("l_quantity").cast("int").alias("cantidad"),
            money("l_extendedprice").alias("precio_unitario"), money("l_extendedprice").alias("subtotal"),
        )

    @cached_property
    def cliente(self) -> DataFrame:
        return self._t("customer").select(
            F.col("c_custkey").alias("cliente_id"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.col("c_name").alias("nombre"), F.lit(None).cast("string").alias("apellido"),
            F.col("c_mktsegment").alias("canal"),
        )

    @cached_property
    def cliente_canal(self) -> DataFrame:
        return staging.cliente_canal(self.cliente_pedido, self.canal)

    @cached_property
    def cliente_ubicacion_geo(self) -> DataFrame:
        places = (
            self._t("lineitem").select("l_orderkey", "l_suppkey")
            .join(self._t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select("l_orderkey", F.col("s_nationkey").alias("ubicacion_id"))
            .distinct()
        )
        orders = self._t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return (
            places.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("cliente_id"), "ubicacion_id")
            .agg(F.max("o_orderdate").alias("fecha_ultimo_pedido"))
        )

    @cached_property
    def ubicacion_geo(self) -> DataFrame:
        known = F.col("n_nationkey") % 7 != 6
        return (
            self._t("nation").join(self._t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").alias("ubicacion_id"), F.col("n_name").alias("ciudad"),
                F.replace("r_name", F.lit("A"), F.lit("Á")).alias("provincia"),
                F.lit("AR").alias("pais_codigo"),
                F.when(known, F.lit(-55.0) + F.lit(1.3) * F.col("n_nationkey")).alias("latitud"),
                F.when(known, F.lit(-70.0) + F.lit(0.7) * F.col("n_nationkey")).alias("longitud"),
            )
        )

    @cached_property
    def direccion_geocodificada(self) -> DataFrame:
        population = (F.lit(1000) + F.lit(137) * F.col("n_nationkey")).cast("int")
        return self._t("nation").select(
            F.lower("n_name").alias("ciudad"),
            F.when(F.col("n_nationkey") % 10 != 9, population).alias("population"),
        )

    @cached_property
    def canal_producto(self) -> DataFrame:
        """Parts sold per channel; the product is the same in every channel."""
        channels = self.pedido.select("pedido_id", "canal")
        items = self.item_pedido.join(channels, "pedido_id")
        products = (
            items.select("canal", "producto_id_origen").distinct()
            .join(self._t("part"), F.col("producto_id_origen") == F.col("p_partkey"))
            .select(
                "canal", F.col("p_partkey").alias("producto_id"), "producto_id_origen",
                F.col("p_name").alias("nombre"), F.col("p_brand").alias("categoria_id"),
            )
        )
        return materialise(staging.canal_producto(products, self.canal, items), "canal-producto")

    @cached_property
    def published_bridge(self) -> DataFrame:
        """The written table of customers and places, for queries that need it more than once."""
        return materialise(self.cliente_ubicacion_geo, "customer-places")

    def sales_by_location(self, decimals: int | None = None, bridge: DataFrame | None = None) -> DataFrame:
        return consume.ventas_por_ubicacion(
            bridge or self.cliente_ubicacion_geo, self.ubicacion_geo, self.cliente_pedido, self.item_pedido,
            self.direccion_geocodificada, decimals,
        )

    @cached_property
    def published_locations(self) -> DataFrame:
        """The written sales-by-location table, as later models find it; one row per city."""
        return materialise(self.sales_by_location(bridge=self.__dict__.get("published_bridge")), "sales-by-location")

    def market(self) -> DataFrame:
        return consume.penetracion_mercado(self.published_locations)
