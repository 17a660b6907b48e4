"""Analyses on cleaned tables that sit beside the consume models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import kpi
from quarry.operators.dedup import mark_duplicates
from quarry.operators.joins import with_scalars
from quarry.operators.ordered import exact_percentiles

# What the published tables hold for a missing e-mail, and the limits of segments.
PLACEHOLDER_EMAIL = "sin_email@placeholder.com"
SEGMENT_LIMITS = [(400.0, "VIP"), (100.0, "Regular")]


def month_of(column: str) -> Column:
    """First day of the month as a date."""
    return F.trunc(column, "month")


def monthly_sales(orders: DataFrame, when: str, amount: str, customer: str) -> DataFrame:
    """Orders, amount, ticket and distinct customers per month."""
    per_customer = orders.groupBy(month_of(when).alias("mes"), customer).agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).alias("s"), F.count(amount).alias("c")
    )
    return per_customer.groupBy("mes").agg(
        F.sum("n").alias("total_pedidos"),
        F.sum("s").alias("monto_total"),
        kpi.ratio(F.sum("s"), F.sum("c")).alias("ticket_promedio"),
        F.count(customer).alias("clientes_unicos"),
    )


def customer_segments(
    orders: DataFrame, customer: str, status: str, amount: str, when: str, completed: str,
    limits: list[tuple[float, str]] | None = None,
) -> DataFrame:
    """Spend on completed orders, in segments."""
    limits = limits or SEGMENT_LIMITS
    done = F.when(F.col(status) == completed, F.col(amount))
    spent = orders.groupBy(customer).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum(done), F.lit(0)).alias("total_spent"),
        F.round(F.avg(done), 2).alias("avg_order"),
        F.max(when).alias("last_order"),
    )
    return spent.withColumn("segment", kpi.bucket(F.col("total_spent"), limits, "New"))


def monthly_completion(
    orders: DataFrame, when: str, status: str, amount: str, completed: str
) -> DataFrame:
    """Orders, completed orders, their revenue and the completion rate per month."""
    done = F.col(status) == completed
    return (
        orders.groupBy(month_of(when).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if(done).alias("completed"),
            F.round(F.coalesce(F.sum(F.when(done, F.col(amount))), F.lit(0)), 2).alias("revenue"),
        )
        .withColumn("completion_rate_pct", kpi.share_pct(F.col("completed"), F.col("orders"), 1))
    )


def product_summary(
    lines: DataFrame, product: str, quantity: Column, amount: Column, customer: str
) -> DataFrame:
    """Quantity, revenue and distinct customers per product."""
    per_customer = lines.groupBy(product, customer).agg(
        F.sum(quantity).alias("q"), F.sum(amount).alias("a")
    )
    return per_customer.groupBy(product).agg(
        F.sum("q").alias("total_cantidad"),
        F.sum("a").alias("total_revenue"),
        F.count(customer).alias("clientes_unicos"),
    )


def monthly_revenue(
    orders: DataFrame, when: str, amount: str, customer: str, status: str, excluded: list[str]
) -> DataFrame:
    """Monthly revenue without the excluded states."""
    kept = orders.where(~F.col(status).isin(excluded))
    sales = monthly_sales(kept, when, amount, customer)
    return sales.select(
        "mes",
        F.col("total_pedidos").alias("pedidos"),
        F.col("monto_total").alias("revenue"),
        F.round("ticket_promedio", 0).alias("ticket_promedio"),
        "clientes_unicos",
    )


def top_customers(
    orders: DataFrame, customers: DataFrame, key: str, names: list[str], when: str, amount: str,
    status: str, excluded: list[str], n: int = 20,
) -> DataFrame:
    """The n customers with the largest spend; orders are reduced before the name lookup."""
    spent = (
        orders.where(~F.col(status).isin(excluded))
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("compras"),
            F.sum(amount).alias("total_gastado"),
            F.round(F.avg(amount), 0).alias("ticket_promedio"),
            F.min(when).alias("primera_compra"),
            F.max(when).alias("ultima_compra"),
        )
    )
    return (
        spent.join(customers.select(key, *names), key)
        .orderBy(F.col("total_gastado").desc_nulls_last(), F.col(key))
        .limit(n)
    )


def customer_cleanup(
    customers: DataFrame, key: str, email: str, status: str, suspended: str = "suspendido"
) -> DataFrame:
    """Default e-mail, no suspended customers, later rows of one e-mail flagged.

    Rows without e-mail count as one e-mail for the flag, as in a window over it.
    """
    active = customers.where(F.col(status) != suspended)
    flagged = mark_duplicates(active, [email], key, "email_duplicado")
    return flagged.withColumn(email, F.coalesce(email, F.lit(PLACEHOLDER_EMAIL)))


def fx_consolidation(
    sales: list[DataFrame], products: DataFrame, rates: DataFrame
) -> DataFrame:
    """Country sales with product and local and USD totals, in decimals so ties round exactly.

    ``sales``: invoice_id, fecha, pais, producto_cod, cantidad, precio_unit, moneda;
    ``rates``: moneda, a_usd.
    """
    everything = reduce(DataFrame.unionByName, sales)
    price = F.col("precio_unit").cast("decimal(18,4)")
    quantity = F.col("cantidad").cast("decimal(12,0)")
    rate = F.col("a_usd").cast("decimal(12,6)")
    return (
        everything.join(products, "producto_cod", "left")
        .join(rates, "moneda", "left")
        .withColumns(
            {
                "precio_unit_usd": F.round(price * rate, 4).cast("decimal(18,4)"),
                "venta_total_local": F.round(quantity * price, 2).cast("decimal(18,2)"),
                "venta_total_usd": F.round(quantity * price * rate, 2).cast("decimal(18,2)"),
            }
        )
        .drop("a_usd")
    )


def channel_monthly_kpis(
    orders: DataFrame, when: str, status: str, amount: str, customer: str
) -> DataFrame:
    """Orders, revenue, customers and ticket per month and state."""
    per_customer = orders.groupBy(
        month_of(when).alias("mes"), F.upper(F.trim(status)).alias("estado"), customer
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("s"), F.count(amount).alias("c"))
    return per_customer.groupBy("mes", "estado").agg(
        F.sum("n").alias("total_pedidos"),
        F.sum("s").alias("revenue_total"),
        F.count(customer).alias("clientes_unicos"),
        kpi.ratio(F.sum("s"), F.sum("c")).alias("ticket_promedio"),
    )


def untapped_markets(
    cities: DataFrame, minimum_population: int, percentile: float = 0.05
) -> DataFrame:
    """Large cities without orders, or below the given percentile of orders.

    ``cities``: one row per city with ciudad, population, total_pedidos (NULL for none).
    """
    known = cities.withColumn("total_pedidos", F.coalesce("total_pedidos", F.lit(0)))
    cut = exact_percentiles(known, "total_pedidos", {"corte": percentile})
    large = with_scalars(known.where(F.col("population") > minimum_population), cut)
    return large.where((F.col("total_pedidos") == 0) | (F.col("total_pedidos") < F.col("corte"))).drop("corte")


def period_over_period(
    orders: DataFrame, when: str, amount: str, customer: str, start: str, days: int
) -> DataFrame:
    """KPIs of a period against the period of equal length before it, in one pass."""
    first = F.lit(start).cast("date")
    day = F.col(when).cast("date")
    current = (day >= first) & (day < F.date_add(first, days))
    span = orders.where((day >= F.date_sub(first, days)) & (day < F.date_add(first, days)))
    per_customer = span.groupBy(current.alias("current"), customer).agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).alias("s")
    )

    def side(flag: Column, prefix: str) -> list[Column]:
        return [
            F.coalesce(F.sum(F.when(flag, F.col("n"))), F.lit(0)).alias(f"pedidos_{prefix}"),
            F.sum(F.when(flag, F.col("s"))).alias(f"revenue_{prefix}"),
            F.count(F.when(flag, F.col(customer))).alias(f"clientes_{prefix}"),
        ]

    both = per_customer.agg(*side(F.col("current"), "actual"), *side(~F.col("current"), "anterior"))
    changes = {
        f"variacion_{m}_pct": F.round(
            (kpi.ratio(F.col(f"{m}_actual"), F.col(f"{m}_anterior")) - 1) * 100, 2
        )
        for m in ("pedidos", "revenue", "clientes")
    }
    return both.withColumns(changes)


def channel_share(orders: DataFrame, channel: str, amount: str) -> DataFrame:
    """Sales and share of the total per channel."""
    sales = orders.groupBy(channel).agg(
        F.sum(amount).alias("total_ventas"), F.count(F.lit(1)).alias("n_pedidos")
    )
    total = orders.agg(F.sum(amount).alias("everything"))
    return with_scalars(sales, total).select(
        channel, "total_ventas",
        kpi.share_pct(F.col("total_ventas"), F.col("everything")).alias("pct_participacion"),
        "n_pedidos",
    )


def geo_coverage(
    orders: DataFrame, province: str, latitude: str, longitude: str, weight: str | None = None
) -> DataFrame:
    """Orders with coordinates per province, and overall in the row 'TOTAL', in one pass.

    ``weight`` is a column with the number of orders of a row, for tables already reduced.
    """
    number = F.col(weight) if weight else F.lit(1)
    located = F.col(latitude).isNotNull() & F.col(longitude).isNotNull()
    levels = orders.select(
        F.col(province).alias("provincia"),
        number.alias("n"),
        F.when(located, number).otherwise(F.lit(0)).alias("g"),
    ).rollup("provincia").agg(
        F.grouping("provincia").alias("whole"),
        F.sum("n").alias("pedidos"),
        F.sum("g").alias("geolocalizados"),
    )
    return levels.select(
        F.when(F.col("whole") == 1, F.lit("TOTAL")).otherwise(F.col("provincia")).alias("provincia"),
        "pedidos", "geolocalizados",
        kpi.share_pct(F.col("geolocalizados"), F.col("pedidos")).alias("geo_pct"),
    )


def status_mix(
    events: DataFrame, when: str, channel: str, status: str, watched: str,
    alert_pct: float = 10.0, days: int = 7,
) -> DataFrame:
    """Daily states per channel, share of the watched state over the last days, alert.

    The windows run over one row per day and channel.
    """
    daily = (
        events.groupBy(F.col(when).cast("date").alias("fecha"), channel)
        .agg(
            F.count(F.lit(1)).alias("pedidos"),
            F.count_if(F.col(status) == watched).alias("observados"),
        )
        .withColumn("day_number", F.unix_date("fecha"))
    )
    window = Window.partitionBy(channel).orderBy("day_number").rangeBetween(1 - days, 0)
    share = kpi.share_pct(F.sum("observados").over(window), F.sum("pedidos").over(window))
    return daily.withColumn("pct_ventana", share).select(
        "fecha", channel, "pedidos", "observados", "pct_ventana",
        (F.col("pct_ventana") > alert_pct).alias("alerta"),
    )


def product_concentration(lines: DataFrame, product: str, amount: str, top: int = 3) -> DataFrame:
    """Revenue of each product against the first one, and the share of the top products."""
    revenue = lines.groupBy(product).agg(F.sum(amount).alias("revenue"))
    leaders = revenue.orderBy(F.col("revenue").desc_nulls_last(), F.col(product)).limit(top)
    head = leaders.agg(F.max("revenue").alias("first"), F.sum("revenue").alias("top_revenue"))
    total = revenue.agg(F.sum("revenue").alias("everything"))
    return with_scalars(with_scalars(revenue, head), total).select(
        product, "revenue",
        kpi.share_pct(F.col("revenue"), F.col("first")).alias("pct_del_primero"),
        kpi.share_pct(F.col("top_revenue"), F.col("everything")).alias("pct_top"),
    )


def delivery_density(points: DataFrame, kind: str = "destino_comprador") -> DataFrame:
    """Deliveries per province and point, for a heat map."""
    return (
        points.where(F.col("tipo") == kind)
        .groupBy("provincia", "ciudad", "latitud", "longitud")
        .agg(F.count(F.lit(1)).alias("entregas"))
    )
