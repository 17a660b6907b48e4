"""The 10 consume models: business tables on top of staging.

Orders are reduced to one row per customer and output grain before they meet the customer's
location. That keeps a customer with very many orders (or the missing customer) small, and
turns distinct-customer counts into plain counts, because the location depends on the
customer alone. Amounts may be DOUBLE or DECIMAL; with DECIMAL the sums do not depend on the order of
the rows. Sorting is left to the reader of a table; ``sorted_by`` gives the usual order.

Several models need the same joins. Who builds them together joins once and gives the result in the place of its
parts: ``located_customers`` for the bridge with ``ubicacion_geo=None``, ``valid_orders``, or ``bought_orders`` of the
owned ones, for ``cliente_pedido`` with ``item_pedido=None``, ``owned_orders`` for ``pedido`` with ``item_pedido=None`` and ``cliente_pedido=None``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import kpi
from quarry.functions.geo import CENTRE_LATITUDE, CENTRE_LONGITUDE, geo_point, haversine_km
from quarry.functions.text import accent_fold, city_key
from quarry.operators.dedup import best_row
from quarry.operators.joins import keep_matching, with_scalars
from quarry.operators.ordered import percentiles_of, with_ranks

PLACE = ["ciudad", "provincia", "pais_codigo"]

# The usual order of each table, '-' for descending.
SORT_ORDERS = {
    "ventas_diarias": ["-fecha", "canal", "provincia"],
    "ventas_por_canal": ["-revenue_total", "canal", "provincia"],
    "top_productos": ["canal", "rank_revenue", "producto_id_origen"],
    "clientes_resumen": ["-ltv", "cliente_id"],
    "cobertura_catalogo": ["canal", "-revenue_total", "producto_id_origen"],
    "ventas_por_ubicacion": ["-revenue_total", "ciudad", "provincia"],
    "penetracion_mercado": ["-revenue_potencial_incremental", "ciudad", "provincia"],
    "penetracion_evolucion": ["ciudad", "mes", "provincia"],
    "dominancia_canal_geo": ["ciudad", "-total_pedidos", "canal"],
    "retencion_geografica": ["-tasa_retencion_pct", "ciudad", "provincia"],
}


def sorted_by(df: DataFrame, model: str) -> DataFrame:
    keys = [
        F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last()
        for k in SORT_ORDERS[model]
    ]
    return df.orderBy(*keys)


# --- shared pieces --------------------------------------------------------------------------


def principal_location(cliente_ubicacion_geo: DataFrame) -> DataFrame:
    """One place per customer: that of the latest order (RN-005, RN-010)."""
    return best_row(
        cliente_ubicacion_geo.select("cliente_id", "ubicacion_id", "fecha_ultimo_pedido"),
        ["cliente_id"],
        [F.col("fecha_ultimo_pedido").desc_nulls_last(), F.col("ubicacion_id").asc_nulls_last()],
    ).select("cliente_id", "ubicacion_id")


def located_customers(cliente_ubicacion_geo: DataFrame, ubicacion_geo: DataFrame) -> DataFrame:
    """Customers with their principal place, which may be unknown."""
    places = ubicacion_geo.select("ubicacion_id", *PLACE, "latitud", "longitud")
    return principal_location(cliente_ubicacion_geo).join(places, "ubicacion_id", "left").drop("ubicacion_id")


def valid_orders(orders: DataFrame, item_pedido: DataFrame | None) -> DataFrame:
    """Orders with at least one item (RN-002)."""
    return orders if item_pedido is None else keep_matching(orders, item_pedido, "pedido_id", unique=True)


def _units(item_pedido: DataFrame) -> DataFrame:
    return item_pedido.groupBy("pedido_id").agg(F.sum("cantidad").alias("units"))


def owned_orders(pedido: DataFrame, item_pedido: DataFrame, cliente_pedido: DataFrame, *extra: str) -> DataFrame:
    """Valid orders with their units; ``bought`` where a customer is recorded, with the amount (and more) recorded there."""
    orders = pedido.select("pedido_id", "canal", "monto_total", "fecha_creacion")
    buyers = cliente_pedido.select(
        "pedido_id", "cliente_id", F.col("monto_total").alias("paid"), F.lit(True).alias("bought"), *extra
    )
    return orders.join(_units(item_pedido), "pedido_id").join(buyers, "pedido_id", "left")


def bought_orders(owned: DataFrame) -> DataFrame:
    """The valid ones of the customers' orders, from ``owned_orders`` of all orders with ``fecha_pedido``."""
    return owned.where("bought").select("cliente_id", F.col("paid").alias("monto_total"), "fecha_pedido")


def _customer_province(cliente_ubicacion_geo: DataFrame, ubicacion_geo: DataFrame | None) -> DataFrame:
    province = accent_fold(F.col("provincia"), upper=True).alias("provincia")
    if ubicacion_geo is None:
        return cliente_ubicacion_geo.select(F.col("cliente_id").alias("located"), province)
    places = ubicacion_geo.select("ubicacion_id", province)
    return principal_location(cliente_ubicacion_geo).join(places, "ubicacion_id", "left").select(
        F.col("cliente_id").alias("located"), "provincia"
    )


def _customer_place(
    cliente_ubicacion_geo: DataFrame, ubicacion_geo: DataFrame | None, *extra: str
) -> DataFrame:
    if ubicacion_geo is None:
        return cliente_ubicacion_geo.where("ciudad is not null").select("cliente_id", *PLACE, *extra)
    places = ubicacion_geo.where("ciudad is not null").select("ubicacion_id", *PLACE, *extra)
    return principal_location(cliente_ubicacion_geo).join(places, "ubicacion_id").drop("ubicacion_id")


def _mean(total: str, number: str) -> Column:
    return kpi.ratio(F.sum(total), F.sum(number))


# --- sales ----------------------------------------------------------------------------------


def ventas_diarias(
    pedido: DataFrame,
    item_pedido: DataFrame | None,
    cliente_pedido: DataFrame | None,
    cliente_ubicacion_geo: DataFrame,
    ubicacion_geo: DataFrame | None,
) -> DataFrame:
    """Orders, customers, revenue and ticket per day, channel and province."""
    orders = pedido.where("fecha_creacion is not null and monto_total > 0").withColumn(
        "fecha", F.date_trunc("day", "fecha_creacion").cast("timestamp_ntz")
    )
    owned = orders
    if cliente_pedido is not None:
        owned = valid_orders(orders.select("pedido_id", "canal", "monto_total", "fecha"), item_pedido).join(
            cliente_pedido.select("pedido_id", "cliente_id"), "pedido_id", "left"
        )
    per_customer = owned.groupBy("cliente_id", "fecha", "canal").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("monto_total").alias("amount")
    )
    provinces = _customer_province(cliente_ubicacion_geo, ubicacion_geo)
    return (
        per_customer.join(provinces, F.col("cliente_id") == F.col("located"), "left")
        .groupBy("fecha", "canal", "provincia")
        .agg(
            F.sum("orders").alias("pedidos"),
            F.count("cliente_id").alias("clientes_unicos"),
            F.sum("amount").alias("revenue"),
            _mean("amount", "orders").alias("ticket_promedio"),
        )
    )


def ventas_por_canal(
    pedido: DataFrame,
    item_pedido: DataFrame | None,
    cliente_pedido: DataFrame | None,
    cliente_ubicacion_geo: DataFrame,
    ubicacion_geo: DataFrame | None,
) -> DataFrame:
    """Sales per channel and province, with units (KPI-004).

    Units per order serve both as the RN-002 filter and as the measure.
    """
    owned = pedido.where("monto_total > 0")
    if cliente_pedido is not None:
        owned = owned_orders(owned, item_pedido, cliente_pedido)
    per_customer = owned.groupBy("cliente_id", "canal").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("monto_total").alias("amount"),
        F.sum("units").alias("units"),
        F.min("fecha_creacion").alias("first"),
        F.max("fecha_creacion").alias("last"),
    )
    provinces = _customer_province(cliente_ubicacion_geo, ubicacion_geo)
    return (
        per_customer.join(provinces, F.col("cliente_id") == F.col("located"), "left")
        .groupBy("canal", "provincia")
        .agg(
            F.sum("orders").alias("total_pedidos"),
            F.count("cliente_id").alias("clientes_unicos"),
            F.sum("amount").alias("revenue_total"),
            _mean("amount", "orders").alias("ticket_promedio"),
            F.sum("units").alias("total_unidades"),
            F.min("first").alias("primer_pedido"),
            F.max("last").alias("ultimo_pedido"),
        )
    )


def top_productos(canal_producto: DataFrame) -> DataFrame:
    """Products ranked by revenue and by units within their channel.

    A channel holds a large part of the catalogue, so the ranks are not taken in a plain window.
    """
    sold = canal_producto.where("total_unidades > 0").select(
        "canal", "nombre", "producto_id_origen", "categoria_id", "total_pedidos",
        "total_unidades", "revenue_total", "precio_min", "precio_max", "precio_promedio",
    )
    return with_ranks(
        sold, ["canal"], {"revenue_total": "rank_revenue", "total_unidades": "rank_unidades"}
    )


def clientes_resumen(
    cliente: DataFrame,
    cliente_pedido: DataFrame,
    item_pedido: DataFrame | None,
    cliente_canal: DataFrame,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Lifetime value, frequency, recency and preferred channel per customer."""
    today = F.lit(as_of) if as_of else F.current_date()
    activity = (
        valid_orders(cliente_pedido, item_pedido)
        .groupBy("cliente_id")
        .agg(
            F.count(F.lit(1)).alias("total_pedidos"),
            F.sum("monto_total").alias("ltv"),
            kpi.ratio(F.sum("monto_total"), F.count("monto_total")).alias("ticket_promedio"),
            F.min("fecha_pedido").alias("primer_pedido"),
            F.max("fecha_pedido").alias("ultimo_pedido"),
        )
    )
    # RN-004: most orders, then the larger amount; at most one row per channel and customer
    by_preference = Window.partitionBy("cliente_id").orderBy(
        F.col("total_pedidos").desc_nulls_last(),
        F.col("monto_total_acumulado").desc_nulls_last(),
        F.col("canal").asc_nulls_last(),
    )
    channels = (
        cliente_canal.withColumn("place", F.row_number().over(by_preference))
        .groupBy("cliente_id")
        .agg(
            F.count("canal_id").alias("canales_usados"),
            F.max(F.when(F.col("place") == 1, F.col("canal"))).alias("preferred"),
        )
    )
    people = cliente.select("cliente_id", "email", "nombre", "apellido", F.col("canal").alias("canal_origen"))
    active = F.col("ultimo_pedido") >= F.add_months(today, -12).cast("timestamp_ntz")
    return (
        people.join(activity, "cliente_id")
        .join(channels, "cliente_id", "left")
        .select(
            "cliente_id", "email", "nombre", "apellido", "canal_origen", "total_pedidos", "ltv",
            "ticket_promedio", "primer_pedido", "ultimo_pedido",
            F.coalesce("canales_usados", F.lit(0)).alias("canales_usados"),
            F.when(active, F.lit("Activo")).otherwise(F.lit("Inactivo")).alias("estado_cliente"),
            F.coalesce("preferred", F.lit("Sin canal asignado")).alias("canal_preferido"),
        )
    )


def cobertura_catalogo(canal_producto: DataFrame) -> DataFrame:
    """Catalogue coverage per channel (KPI-008) and channels per product."""
    catalogue = canal_producto.where("total_unidades > 0")
    coverage = catalogue.groupBy("canal_id").agg(F.count_distinct("producto_id").alias("in_channel"))
    whole = catalogue.agg(F.count_distinct("producto_id").alias("whole"))
    # a product has at most one row per channel, so this window stays small
    channels = F.count(F.lit(1)).over(Window.partitionBy("producto_id"))
    spread = catalogue.withColumn("canales_con_presencia", channels)
    return with_scalars(spread.join(coverage, "canal_id"), whole).select(
        "canal", F.col("nombre").alias("nombre_producto"), "categoria_id", "producto_id_origen",
        "total_pedidos", "total_unidades", "revenue_total", "precio_min", "precio_max",
        "precio_promedio", "canales_con_presencia",
        (F.col("canales_con_presencia") == 1).alias("exclusivo_canal"),
        kpi.share_pct(F.col("in_channel"), F.col("whole")).alias("cobertura_canal_pct"),
    )


# --- geography --------------------------------------------------------------------------------


def city_population(direccion_geocodificada: DataFrame) -> DataFrame:
    return (
        direccion_geocodificada.where("population is not null and ciudad is not null")
        .groupBy(city_key(F.col("ciudad")).alias("city"))
        .agg(F.max("population").alias("population"))
    )


def ventas_por_ubicacion(
    cliente_ubicacion_geo: DataFrame,
    ubicacion_geo: DataFrame | None,
    cliente_pedido: DataFrame,
    item_pedido: DataFrame | None,
    direccion_geocodificada: DataFrame,
    point_decimals: int | None = None,
) -> DataFrame:
    """Customers and sales per city; all of a customer's orders count at the principal place.

    Mean coordinates weigh each customer by its orders (at least one), as a row-level join
    of customers to orders would.
    """
    activity = (
        valid_orders(cliente_pedido, item_pedido)
        .groupBy("cliente_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("monto_total").alias("amount"),
            F.count("monto_total").alias("priced"),
        )
    )
    customers = _customer_place(cliente_ubicacion_geo, ubicacion_geo, "latitud", "longitud")
    weight = F.greatest(F.coalesce("orders", F.lit(0)), F.lit(1))
    lat_weight = F.when(F.col("latitud").isNotNull(), F.col("weight"))
    lon_weight = F.when(F.col("longitud").isNotNull(), F.col("weight"))
    cities = (
        customers.join(activity, "cliente_id", "left")
        .withColumn("weight", weight)
        .groupBy(
            accent_fold(F.col("ciudad")).alias("ciudad"),
            accent_fold(F.col("provincia"), upper=True).alias("provincia"),
            "pais_codigo",
        )
        .agg(
            (F.sum(F.col("latitud") * F.col("weight")) / F.nullif(F.sum(lat_weight), F.lit(0))).alias("latitud"),
            (F.sum(F.col("longitud") * F.col("weight")) / F.nullif(F.sum(lon_weight), F.lit(0))).alias("longitud"),
            F.count("cliente_id").alias("clientes_unicos"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("total_pedidos"),
            F.sum("amount").alias("revenue_total"),
            _mean("amount", "priced").alias("ticket_promedio"),
        )
    )
    return cities.join(
        city_population(direccion_geocodificada), city_key(F.col("ciudad")) == F.col("city"), "left"
    ).select(
        "ciudad", "provincia",
        F.when(F.col("pais_codigo") == "AR", F.lit("Argentina")).otherwise(F.col("pais_codigo")).alias("pais"),
        "latitud", "longitud",
        geo_point(F.col("latitud"), F.col("longitud"), point_decimals).alias("geo_point"),
        "population", "clientes_unicos", "total_pedidos", "revenue_total", "ticket_promedio",
    )


def penetracion_mercado(ventas_por_ubicacion: DataFrame) -> DataFrame:
    """Penetration (KPI-009), revenue per head (KPI-010), potential (KPI-015), quadrant.

    Percentiles over cities are exact and sorted in ranges, so no task holds all cities.
    """
    rate = kpi.ratio(F.col("total_pedidos"), F.col("population"))
    cities = ventas_por_ubicacion.where("population > 0 and ciudad is not null").withColumn("rate", rate)
    baseline = cities.agg(
        kpi.ratio(F.sum("total_pedidos"), F.sum("population")).alias("national_rate"),
        kpi.ratio(F.sum("revenue_total"), F.sum("total_pedidos")).alias("national_ticket"),
    )
    known = with_scalars(cities, baseline)
    cuts = {"rate": {"p25": 0.25, "p75": 0.75}, "population": {"median_population": 0.5}}
    known = with_scalars(known, percentiles_of(cities, cuts))
    return known.select(
        "ciudad", "provincia", "pais", "latitud", "longitud", "population", "total_pedidos",
        "clientes_unicos", "revenue_total", "ticket_promedio",
        F.round("rate", 6).alias("tasa_penetracion"),
        F.round(kpi.ratio(F.col("revenue_total"), F.col("population")), 2).alias("revenue_per_capita"),
        kpi.potential_revenue(
            F.col("rate"), F.col("national_rate"), F.col("population"), F.col("national_ticket")
        ).alias("revenue_potencial_incremental"),
        F.round("national_rate", 6).alias("tasa_penetracion_nacional"),
        F.round("national_ticket", 2).alias("ticket_promedio_nacional"),
        kpi.market_quadrant(
            F.col("population"), F.col("rate"), F.col("median_population"), F.col("p25"), F.col("p75")
        ).alias("cuadrante_estrategico"),
    )


def _same_place() -> Column:
    """Match raw place names with the folded ones of the sales-by-location table."""
    country = F.when(F.col("pais_codigo") == "AR", F.lit("Argentina")).otherwise(F.col("pais_codigo"))
    return (
        (city_key(F.col("ciudad")) == F.col("p_city"))
        & accent_fold(F.col("provincia"), upper=True).eqNullSafe(F.col("p_provincia"))
        & country.eqNullSafe(F.col("p_pais"))
    )


def _places(df: DataFrame, *columns: str) -> DataFrame:
    """One row per folded place, for joining measures of the location tables."""
    keys = [
        city_key(F.col("ciudad")).alias("p_city"),
        F.col("provincia").alias("p_provincia"),
        F.col("pais").alias("p_pais"),
    ]
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def penetracion_evolucion(
    cliente_pedido: DataFrame,
    item_pedido: DataFrame | None,
    cliente_ubicacion_geo: DataFrame,
    ubicacion_geo: DataFrame | None,
    ventas_por_ubicacion: DataFrame,
    drop_threshold: float = -0.20,
) -> DataFrame:
    """Monthly penetration per place, change against the previous month, alert, seasonality."""
    orders = valid_orders(cliente_pedido, item_pedido).where("fecha_pedido is not null")
    per_customer = orders.groupBy(
        "cliente_id", F.trunc("fecha_pedido", "month").alias("mes")
    ).agg(F.count(F.lit(1)).alias("orders"), F.sum("monto_total").alias("amount"))
    located = per_customer.join(_customer_place(cliente_ubicacion_geo, ubicacion_geo), "cliente_id")
    monthly = located.groupBy(*PLACE, "mes").agg(
        F.sum("orders").alias("total_pedidos"),
        F.count("cliente_id").alias("clientes_unicos"),
        F.sum("amount").alias("revenue_total"),
    )
    population = _places(ventas_por_ubicacion.where("population > 0"), "population")
    # windows hold the months of one place
    history = Window.partitionBy(*PLACE).orderBy("mes")
    same_year = Window.partitionBy(*PLACE, "anio")
    series = (
        monthly.join(population, _same_place(), "left")
        .withColumns({"anio": F.year("mes"), "mes_num": F.month("mes")})
        .withColumn("tasa_penetracion", F.round(kpi.ratio(F.col("total_pedidos"), F.col("population")), 6))
        .withColumn("tasa_penetracion_mes_anterior", F.lag("tasa_penetracion").over(history))
        .withColumn("year_mean", F.avg("total_pedidos").over(same_year))
    )
    now, before = F.col("tasa_penetracion"), F.col("tasa_penetracion_mes_anterior")
    return series.select(
        *PLACE, "mes", "anio", "mes_num", "population", "total_pedidos", "clientes_unicos",
        "revenue_total", "tasa_penetracion", "tasa_penetracion_mes_anterior",
        F.round(now - before, 6).alias("variacion_abs"),
        kpi.change_pct(now, before).alias("variacion_pct"),
        kpi.dropped(now, before, drop_threshold).alias("alerta_caida"),
        F.round(kpi.ratio(F.col("total_pedidos"), F.col("year_mean")), 2).alias("indice_estacionalidad"),
    )


def dominancia_canal_geo(
    cliente_pedido: DataFrame | None,
    pedido: DataFrame,
    item_pedido: DataFrame | None,
    cliente_ubicacion_geo: DataFrame,
    ubicacion_geo: DataFrame | None,
) -> DataFrame:
    """Share of each channel in a place (KPI-011) and the dominant one."""
    sold = pedido.where("monto_total > 0 and canal is not null")
    if cliente_pedido is None:
        orders = sold.where("bought").select("cliente_id", "canal", F.col("paid").alias("monto_total"))
    else:
        bought = cliente_pedido.select("pedido_id", "cliente_id", "monto_total")
        orders = valid_orders(bought.join(sold.select("pedido_id", "canal"), "pedido_id"), item_pedido)
    per_customer = orders.groupBy("cliente_id", "canal").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("monto_total").alias("amount")
    )
    located = per_customer.join(_customer_place(cliente_ubicacion_geo, ubicacion_geo), "cliente_id")
    by_channel = located.groupBy(*PLACE, "canal").agg(
        F.sum("orders").alias("total_pedidos"),
        F.count("cliente_id").alias("clientes_unicos"),
        F.sum("amount").alias("revenue_total"),
    )
    # windows hold the channels of one place
    place = Window.partitionBy(*PLACE)
    ranking = place.orderBy(F.col("total_pedidos").desc())
    totals = by_channel.withColumns(
        {
            "total_pedidos_ciudad": F.sum("total_pedidos").over(place),
            "total_revenue_ciudad": F.sum("revenue_total").over(place),
            "canal_dominante": F.rank().over(ranking) == 1,
        }
    )
    return totals.select(
        *PLACE, "canal", "total_pedidos", "clientes_unicos", "revenue_total",
        "total_pedidos_ciudad", "total_revenue_ciudad",
        kpi.share_pct(F.col("total_pedidos"), F.col("total_pedidos_ciudad")).alias("share_pedidos_pct"),
        kpi.share_pct(F.col("revenue_total"), F.col("total_revenue_ciudad")).alias("share_revenue_pct"),
        "canal_dominante",
    )


def retencion_geografica(
    cliente_pedido: DataFrame,
    item_pedido: DataFrame | None,
    cliente_ubicacion_geo: DataFrame,
    ubicacion_geo: DataFrame | None,
    penetracion_mercado: DataFrame,
    centre: tuple[float, float] = (CENTRE_LATITUDE, CENTRE_LONGITUDE),
) -> DataFrame:
    """Retention (KPI-012), distance to the centre (KPI-013) and their relation (KPI-014)."""
    per_customer = (
        valid_orders(cliente_pedido, item_pedido)
        .groupBy("cliente_id")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    customers = per_customer.join(
        _customer_place(cliente_ubicacion_geo, ubicacion_geo, "latitud", "longitud"), "cliente_id"
    )
    cities = customers.groupBy(*PLACE).agg(
        F.avg("latitud").alias("latitud"),
        F.avg("longitud").alias("longitud"),
        F.count("cliente_id").alias("total_clientes"),
        F.count_if(F.col("orders") >= 2).alias("clientes_recurrentes"),
    )
    market = _places(
        penetracion_mercado.where("tasa_penetracion is not null"),
        "tasa_penetracion", "total_pedidos", "revenue_total", "population",
    )
    measured = (
        cities.where("latitud is not null and longitud is not null")
        .join(market, _same_place(), "left")
        .withColumns(
            {
                "tasa_retencion_pct": kpi.share_pct(F.col("clientes_recurrentes"), F.col("total_clientes")),
                "distancia_cd_km": haversine_km(F.col("latitud"), F.col("longitud"), *centre),
            }
        )
    )
    relation = measured.agg(
        F.round(F.corr("distancia_cd_km", "tasa_penetracion"), 4).alias("correlacion_distancia_penetracion")
    )
    return with_scalars(measured, relation).select(
        *PLACE, "latitud", "longitud", "population", "total_clientes", "clientes_recurrentes",
        "tasa_retencion_pct", "total_pedidos", "revenue_total", "tasa_penetracion",
        "distancia_cd_km", "correlacion_distancia_penetracion",
    )
