"""The 17 staging models: raw documents to dimensions, facts and bridges.

Every model takes the raw tables by name and returns a DataFrame; models that build on
another staging model take that one as an argument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import kpi
from quarry.functions.casts import (
    coordinate, country_code, try_double, try_int, try_timestamp,
)
from quarry.functions.documents import computed, parse_object
from quarry.functions.keys import address_key, place_key
from quarry.operators.dedup import best_row, latest_version
from quarry.plans.channels import (
    CHANNELS, MELI, PARSED_RECEIVERS, VTEX, Raw, item_documents, order_documents, scoped_key,
)
from quarry.sources.inline import inline_relation

ADDRESS_DDL = (
    "city struct<name:string>, state struct<name:string>, country struct<id:string>,"
    " zip_code string, latitude string, longitude string, street_name string,"
    " street_number string, comment string"
)
STORE_DDL = (
    "id string, name string, location struct<latitude:string, longitude:string,"
    " address:struct<city:string, state:string, zip_code:string, address_line:string>>"
)


def _address(c: str) -> Column:
    return parse_object(F.col(c), ADDRESS_DDL)


def receiver_documents(raw: Raw) -> DataFrame:
    """Where shipments went: (order_id, last_updated, a) with the parsed address, all versions."""
    if PARSED_RECEIVERS in raw:
        return raw[PARSED_RECEIVERS]
    sent = raw["type_6"].where("receiver_address is not null")
    return sent.select("order_id", "last_updated", _address("receiver_address").alias("a"))


def _asc(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


# --- dimensions -------------------------------------------------------------------------


def canal(spark: SparkSession) -> DataFrame:
    return inline_relation(
        spark,
        ["canal_id", "canal", "tabla_fuente"],
        [(c.id, c.name, c.raw_table) for c in CHANNELS],
    )


def cliente(raw: Raw) -> DataFrame:
    """One row per channel customer; a known e-mail wins."""
    columns = ["canal", "cliente_id_origen", "email", "nombre", "apellido", "telefono"]
    people = computed(order_documents(raw).where("tiene_cliente").select(*columns)).where("cliente_id_origen is not null")
    chosen = best_row(
        people, ["cliente_id_origen", "canal"], _asc("email", "nombre", "apellido", "telefono")
    )
    key = scoped_key(F.col("canal"), F.col("cliente_id_origen"))
    return chosen.select(key.alias("cliente_id"), *people.columns)


def producto(raw: Raw) -> DataFrame:
    """One row per channel product; the lowest price wins."""
    offers = (
        item_documents(raw)
        .where("producto_id_origen is not null")
        .select(
            "canal", "producto_id_origen", F.col("nombre_producto").alias("nombre"),
            "categoria_id", (F.col("precio_unitario") + F.lit(0.0)).alias("precio_unitario"), "moneda",
        )
    )
    chosen = best_row(
        offers, ["producto_id_origen", "canal"],
        _asc("precio_unitario", "nombre", "categoria_id", "moneda"),
    )
    key = scoped_key(F.col("canal"), F.col("producto_id_origen"))
    return chosen.select(key.alias("producto_id"), *offers.columns)


def direccion(raw: Raw) -> DataFrame:
    """Delivery addresses, one row per address key; known coordinates win."""
    shipped = receiver_documents(raw).select(
        F.col("a.street_name").alias("calle"),
        F.col("a.street_number").alias("altura"),
        F.col("a.comment").alias("complemento"),
        F.col("a.city.name").alias("ciudad"),
        F.col("a.state.name").alias("provincia"),
        F.col("a.zip_code").alias("cp"),
        F.col("a.country.id").alias("pais"),
        coordinate(F.col("a.latitude")).alias("latitud"),
        coordinate(F.col("a.longitude")).alias("longitud"),
        F.lit(MELI).alias("fuente"),
    )
    unknown = F.lit(None).cast("double")
    ordered = (
        order_documents(raw)
        .where("tiene_direccion")
        .select(
            "calle", "altura", "complemento", "ciudad", "provincia", "cp", "pais",
            unknown.alias("latitud"), unknown.alias("longitud"), F.col("canal").alias("fuente"),
        )
    )
    places = computed(shipped.unionByName(ordered)).where("ciudad is not null or cp is not null")
    key = address_key(*[F.col(c) for c in ("calle", "altura", "ciudad", "cp", "pais")])
    return best_row(
        places.select(key.alias("direccion_id"), *places.columns),
        ["direccion_id"],
        _asc("latitud", "longitud", "fuente", "complemento", "provincia", "pais"),
    )


def geo_coords(raw: Raw) -> DataFrame:
    """Geocoding results, typed, one row per address."""
    typed = raw["geo_coords"].where("direccion_id is not null").select(
        F.col("direccion_id").cast("string").alias("direccion_id"),
        try_double(F.col("latitud")).alias("latitud"),
        try_double(F.col("longitud")).alias("longitud"),
        F.col("matched_city").cast("string").alias("matched_city"),
        F.col("matched_provincia").cast("string").alias("matched_provincia"),
        try_int(F.col("population")).alias("population"),
        F.col("match_type").cast("string").alias("match_type"),
    )
    return best_row(typed, ["direccion_id"], _asc(*typed.columns[1:]))


def direccion_geocodificada(direccion: DataFrame, geo_coords: DataFrame) -> DataFrame:
    """Addresses with coordinates from the geocoding file where they have none."""
    found = geo_coords.select(
        "direccion_id",
        F.col("latitud").alias("g_latitud"),
        F.col("longitud").alias("g_longitud"),
        "matched_city", "matched_provincia", "population", "match_type",
    )
    zero = F.lit(0.0)
    return direccion.join(found, "direccion_id", "left").select(
        "direccion_id", "calle", "altura", "complemento", "ciudad", "provincia", "cp", "pais",
        F.coalesce(F.nullif(F.col("latitud"), zero), F.col("g_latitud")).alias("latitud"),
        F.coalesce(F.nullif(F.col("longitud"), zero), F.col("g_longitud")).alias("longitud"),
        "fuente", "matched_city", "matched_provincia", "population", "match_type",
    )


def ubicacion_geo(raw: Raw, direccion_geocodificada: DataFrame) -> DataFrame:
    """Places (city, postcode, country), one row per place key.

    Coordinates come from the documents, else from the mean of the city's addresses.
    """
    senders = raw["type_6"].where("sender_address is not null").select(_address("sender_address").alias("a"))
    from_shipments = receiver_documents(raw).select("a").unionByName(senders).select(
        F.col("a.city.name").alias("ciudad"),
        F.col("a.state.name").alias("provincia"),
        F.col("a.country.id").alias("pais"),
        F.col("a.zip_code").alias("cp"),
        coordinate(F.col("a.latitude")).alias("latitud"),
        coordinate(F.col("a.longitude")).alias("longitud"),
    )
    unknown = F.lit(None).cast("double")
    from_orders = (
        order_documents(raw, VTEX)
        .where("tiene_direccion")
        .select(
            "ciudad", "provincia", "pais", "cp", unknown.alias("latitud"), unknown.alias("longitud")
        )
    )
    from_stores = (
        raw["meli_pickup"].where("store_info is not null")
        .select(parse_object(F.col("store_info"), STORE_DDL).alias("s"))
        .select(
            F.col("s.location.address.city").alias("ciudad"),
            F.col("s.location.address.state").alias("provincia"),
            F.lit("AR").alias("pais"),
            F.col("s.location.address.zip_code").alias("cp"),
            coordinate(F.col("s.location.latitude")).alias("latitud"),
            coordinate(F.col("s.location.longitude")).alias("longitud"),
        )
    )
    places = (
        computed(from_shipments.unionByName(from_orders).unionByName(from_stores))
        .where("ciudad is not null or cp is not null")
        .distinct()
    )
    key = place_key(F.col("ciudad"), F.col("cp"), F.col("pais"))
    chosen = best_row(
        places.select(key.alias("ubicacion_id"), *places.columns),
        ["ubicacion_id"],
        _asc("latitud", "longitud", "pais", "provincia"),
    )
    city_means = (
        direccion_geocodificada.where("ciudad is not null")
        .groupBy(F.lower("ciudad").alias("city"))
        .agg(F.avg("latitud").alias("mean_latitud"), F.avg("longitud").alias("mean_longitud"))
    )
    return chosen.join(city_means, F.lower("ciudad") == F.col("city"), "left").select(
        "ubicacion_id", "ciudad", "provincia",
        country_code(F.col("pais")).alias("pais_codigo"),
        F.col("cp").alias("codigo_postal"),
        F.coalesce("latitud", "mean_latitud").alias("latitud"),
        F.coalesce("longitud", "mean_longitud").alias("longitud"),
    )


# --- facts --------------------------------------------------------------------------------


def pedido(raw: Raw) -> DataFrame:
    """Orders of all channels, newest version, with the key of the delivery address."""
    own_address = F.when(
        F.col("direccion_legible"),
        address_key(*[F.col(c) for c in ("calle", "altura", "ciudad", "cp", "pais")]),
    )
    documents = order_documents(raw).select(
        "canal_id", "canal", "orden_id_origen", "version", "status", "monto_total",
        "fecha_creacion", "fecha_actualizacion", "fecha_cierre", own_address.alias("own_address"),
    )
    orders = latest_version(documents, ["orden_id_origen", "canal"], "version")
    shipped = receiver_documents(raw).select(
        F.col("order_id").cast("string").alias("orden_id_origen"),
        "last_updated",
        address_key(
            F.col("a.street_name"), F.col("a.street_number"), F.col("a.city.name"),
            F.col("a.zip_code"), F.col("a.country.id"),
        ).alias("shipped_to"),
    )
    addresses = latest_version(shipped, ["orden_id_origen"], "last_updated").select(
        F.lit(MELI).alias("canal"), "orden_id_origen", "shipped_to"
    )
    return orders.join(addresses, ["canal", "orden_id_origen"], "left").select(
        scoped_key(F.col("canal"), F.col("orden_id_origen")).alias("pedido_id"),
        "orden_id_origen", "canal_id", "canal", "status", "monto_total",
        "fecha_creacion", "fecha_actualizacion", "fecha_cierre",
        F.coalesce("own_address", "shipped_to").alias("direccion_id"),
    )


def item_pedido(raw: Raw, unique_lines: bool = False) -> DataFrame:
    """Order lines.

    By default every document contributes its lines and a product that appears twice in an
    order shares one key. ``unique_lines`` keeps the lines of the newest version only and
    adds the position to the key.
    """
    lines = item_documents(raw)
    order_key = scoped_key(F.col("canal"), F.col("orden_id_origen"))
    product = F.coalesce("producto_id_origen", "nombre_producto")
    parts = [order_key, product]
    if unique_lines:
        newest = order_documents(raw).groupBy(
            F.col("canal").alias("of_channel"), F.col("orden_id_origen").alias("of_order")
        ).agg(F.max("version").alias("newest"))
        # null-safe: versions may be missing, and a hot order can be split
        lines = lines.join(
            newest,
            F.col("canal").eqNullSafe(F.col("of_channel"))
            & F.col("orden_id_origen").eqNullSafe(F.col("of_order"))
            & F.col("version").eqNullSafe(F.col("newest")),
            "left_semi",
        )
        parts.append(F.col("posicion").cast("string"))
    key = parts[0]
    for part in parts[1:]:
        key = F.concat(key, F.lit("|"), part)
    return lines.select(
        F.md5(key).alias("item_pedido_id"), order_key.alias("pedido_id"), "orden_id_origen",
        "canal", "producto_id_origen", "nombre_producto", "cantidad", "precio_unitario",
        "subtotal", "moneda",
    )


def envio_detalle(raw: Raw) -> DataFrame:
    """Shipments, newest version, both addresses flattened."""
    shipments = raw["type_6"].select(
        "id", "order_id", "status", "substatus", "logistic_type", "tracking_number",
        "tracking_method", "date_created", "last_updated", "sender_address", "receiver_address",
    )
    newest = latest_version(shipments, ["id"], "last_updated").withColumns(
        {"s": _address("sender_address"), "r": _address("receiver_address")}
    )

    def side(prefix: str, a: str) -> list[Column]:
        return [
            F.col(f"{a}.city.name").alias(f"{prefix}_ciudad"),
            F.col(f"{a}.state.name").alias(f"{prefix}_provincia"),
            F.col(f"{a}.country.id").alias(f"{prefix}_pais"),
            F.col(f"{a}.zip_code").alias(f"{prefix}_codigo_postal"),
            try_double(F.col(f"{a}.latitude")).alias(f"{prefix}_latitud"),
            try_double(F.col(f"{a}.longitude")).alias(f"{prefix}_longitud"),
            F.col(f"{a}.street_name").alias(f"{prefix}_calle"),
            F.col(f"{a}.street_number").alias(f"{prefix}_numero"),
        ]

    return newest.select(
        F.col("id").cast("string").alias("envio_id"),
        F.col("order_id").cast("string").alias("orden_id_origen"),
        "status", "substatus", "logistic_type", "tracking_number", "tracking_method",
        try_timestamp(F.col("date_created")).alias("fecha_creacion"),
        try_timestamp(F.col("last_updated")).alias("fecha_actualizacion"),
        *side("origen", "s"),
        *side("destino", "r"),
        F.col("r.comment").alias("destino_complemento"),
    )


def geo_envio(raw: Raw) -> DataFrame:
    """Geographic points of orders: seller origin, buyer destination, pick-up store."""
    both_ends = raw["type_6"].select(
        F.col("id").cast("string").alias("record"),
        F.col("order_id").cast("string").alias("orden_id_origen"),
        F.col("last_updated").cast("string").alias("version"),
        F.inline(
            F.array(
                F.struct(
                    F.lit("origen").alias("scope"),
                    F.lit("origen_vendedor").alias("tipo"),
                    F.col("sender_address").alias("document"),
                ),
                F.struct(
                    F.lit("destino").alias("scope"),
                    F.lit("destino_comprador").alias("tipo"),
                    F.col("receiver_address").alias("document"),
                ),
            )
        ),
    ).where("document is not null")
    shipments = (
        latest_version(both_ends, ["record", "tipo"], "version")
        .withColumn("a", _address("document"))
        .select(
            "scope", "tipo", F.lit(MELI).alias("canal"), "orden_id_origen",
            F.col("a.city.name").alias("ciudad"),
            F.col("a.state.name").alias("provincia"),
            F.col("a.country.id").alias("pais_codigo"),
            F.col("a.zip_code").alias("codigo_postal"),
            try_double(F.col("a.latitude")).alias("latitud"),
            try_double(F.col("a.longitude")).alias("longitud"),
            F.col("a.street_name").alias("calle"),
            F.col("a.street_number").alias("numero"),
        )
    )
    unknown = F.lit(None).cast("double")
    delivered = order_documents(raw, VTEX).where("tiene_direccion").select(
        "orden_id_origen", "version", "ciudad", "provincia", "pais", "cp", "calle", "altura"
    )
    deliveries = latest_version(delivered, ["orden_id_origen"], "version").select(
        F.lit("destino").alias("scope"), F.lit("destino_comprador").alias("tipo"),
        F.lit(VTEX).alias("canal"), "orden_id_origen", "ciudad", "provincia",
        F.col("pais").alias("pais_codigo"), F.col("cp").alias("codigo_postal"),
        unknown.alias("latitud"), unknown.alias("longitud"), "calle", F.col("altura").alias("numero"),
    )
    pickups = (
        raw["meli_pickup"].where("store_info is not null")
        .select("order_id", parse_object(F.col("store_info"), STORE_DDL).alias("s"))
        .select(
            F.lit("retiro").alias("scope"), F.lit("retiro_sucursal").alias("tipo"),
            F.lit(MELI).alias("canal"), F.col("order_id").cast("string").alias("orden_id_origen"),
            F.col("s.location.address.city").alias("ciudad"),
            F.col("s.location.address.state").alias("provincia"),
            F.lit(None).cast("string").alias("pais_codigo"),
            F.col("s.location.address.zip_code").alias("codigo_postal"),
            try_double(F.col("s.location.latitude")).alias("latitud"),
            try_double(F.col("s.location.longitude")).alias("longitud"),
            F.col("s.location.address.address_line").alias("calle"),
            F.lit(None).cast("string").alias("numero"),
        )
    )
    points = shipments.unionByName(deliveries).unionByName(pickups)
    key = F.md5(F.concat("scope", F.lit("|"), "canal", F.lit("|"), "orden_id_origen"))
    return points.select(key.alias("geo_envio_id"), *[c for c in points.columns if c != "scope"])


def meli_pago_detalle(raw: Raw) -> DataFrame:
    """Payments with fees and payer, newest version."""
    payments = raw["type_8"].select(
        "id", "order_id", "status", "status_detail", "date_created", "date_approved",
        "transaction_amount", "total_paid_amount", "net_received_amount", "mercadopago_fee",
        "marketplace_fee", "payment_type", "payment_method_id", "installments", "currency_id", "payer",
    )
    newest = latest_version(payments, ["id"], "date_created").withColumn(
        "p", parse_object(F.col("payer"), "id string, email string, first_name string, last_name string")
    )
    empty = F.lit("")
    full_name = F.concat(
        F.coalesce("p.first_name", empty), F.lit(" "), F.coalesce("p.last_name", empty)
    )
    return newest.select(
        F.col("id").cast("string").alias("pago_id"),
        F.col("order_id").cast("string").alias("orden_id_origen"),
        "status", "status_detail",
        try_timestamp(F.col("date_created")).alias("fecha_creacion"),
        try_timestamp(F.col("date_approved")).alias("fecha_aprobacion"),
        try_double(F.col("transaction_amount")).alias("monto_transaccion"),
        try_double(F.col("total_paid_amount")).alias("monto_pagado_total"),
        try_double(F.col("net_received_amount")).alias("monto_neto_recibido"),
        try_double(F.col("mercadopago_fee")).alias("comision_mercadopago"),
        try_double(F.col("marketplace_fee")).alias("comision_marketplace"),
        F.col("payment_type").alias("tipo_pago"),
        F.col("payment_method_id").alias("metodo_pago_id"),
        try_int(F.col("installments")).alias("cuotas"),
        F.col("currency_id").alias("moneda"),
        F.col("p.id").alias("pagador_id"),
        F.col("p.email").alias("pagador_email"),
        F.trim(full_name).alias("pagador_nombre"),
    )


def meli_pickup_detalle(raw: Raw) -> DataFrame:
    """Store pick-ups: store with coordinates, and who collects."""
    parsed = raw["meli_pickup"].withColumns(
        {
            "s": parse_object(F.col("store_info"), STORE_DDL),
            "who": parse_object(F.col("pickup_person"), "name string, id_type string, id_number string"),
        }
    )
    return parsed.select(
        F.col("id").cast("string").alias("pickup_id"),
        F.col("order_id").cast("string").alias("orden_id_origen"),
        "status",
        try_timestamp(F.col("date_created")).alias("fecha_creacion"),
        try_timestamp(F.col("date_ready")).alias("fecha_lista"),
        F.col("buyer_id").cast("string").alias("comprador_id"),
        F.col("s.id").alias("tienda_id"),
        F.col("s.name").alias("tienda_nombre"),
        F.col("s.location.address.city").alias("tienda_ciudad"),
        F.col("s.location.address.state").alias("tienda_provincia"),
        F.col("s.location.address.zip_code").alias("tienda_codigo_postal"),
        F.col("s.location.address.address_line").alias("tienda_direccion"),
        try_double(F.col("s.location.latitude")).alias("tienda_latitud"),
        try_double(F.col("s.location.longitude")).alias("tienda_longitud"),
        F.col("who.name").alias("persona_nombre"),
        F.col("who.id_type").alias("persona_doc_tipo"),
        F.col("who.id_number").alias("persona_doc_numero"),
    )


# --- bridges ------------------------------------------------------------------------------


def cliente_pedido(raw: Raw) -> DataFrame:
    """(customer, order) with amount and time, newest version of each order."""
    documents = order_documents(raw).where("tiene_cliente").select(
        "canal", "orden_id_origen", "version", "cliente_id_origen", "monto_total",
        F.col("fecha_creacion").alias("fecha_pedido"), "status",
    )
    newest = latest_version(documents, ["orden_id_origen", "canal"], "version")
    return newest.select(
        scoped_key(F.col("canal"), F.col("cliente_id_origen")).alias("cliente_id"),
        scoped_key(F.col("canal"), F.col("orden_id_origen")).alias("pedido_id"),
        "canal", "monto_total", "fecha_pedido", "status",
    )


def cliente_canal(cliente_pedido: DataFrame, canal: DataFrame) -> DataFrame:
    """Activity of each customer in each channel."""
    activity = (
        cliente_pedido.where("cliente_id is not null")
        .groupBy("cliente_id", "canal")
        .agg(
            F.min("fecha_pedido").alias("primer_pedido"),
            F.max("fecha_pedido").alias("ultimo_pedido"),
            F.count(F.lit(1)).alias("total_pedidos"),
            F.sum("monto_total").alias("monto_total_acumulado"),
        )
    )
    return activity.join(canal.select("canal_id", "canal"), "canal").select(
        "cliente_id", "canal_id", "canal", "primer_pedido", "ultimo_pedido", "total_pedidos",
        "monto_total_acumulado",
    )


def cliente_ubicacion_geo(raw: Raw) -> DataFrame:
    """Customers and the places they bought to, with the date of the last order there.

    Both sides of the shipment-to-order match are reduced to distinct pairs first, so copies
    of one order cannot multiply.
    """
    documents = order_documents(raw).where("tiene_cliente")
    customer = scoped_key(F.col("canal"), F.col("cliente_id_origen"))
    bought = documents.where(F.col("canal") == MELI).select(
        "orden_id_origen", customer.alias("cliente_id"), "fecha_creacion"
    )
    buyers = (
        computed(bought).where("cliente_id is not null")
        .groupBy("orden_id_origen", "cliente_id")
        .agg(F.max("fecha_creacion").alias("fecha"))
    )
    shipped = (
        receiver_documents(raw)
        .select(
            F.col("order_id").cast("string").alias("orden_id_origen"),
            place_key(F.col("a.city.name"), F.col("a.zip_code"), F.col("a.country.id")).alias("ubicacion_id"),
        )
        .distinct()
    )
    delivered = shipped.join(buyers, "orden_id_origen").select("cliente_id", "ubicacion_id", "fecha")
    ordered = documents.where(F.col("tiene_direccion") & (F.col("canal") == VTEX)).select(
        customer.alias("cliente_id"),
        place_key(F.col("ciudad"), F.col("cp"), F.col("pais")).alias("ubicacion_id"),
        F.col("fecha_creacion").alias("fecha"),
    )
    return (
        delivered.unionByName(computed(ordered).where("cliente_id is not null"))
        .groupBy("cliente_id", "ubicacion_id")
        .agg(F.max("fecha").alias("fecha_ultimo_pedido"))
        .select("cliente_id", "ubicacion_id", F.lit("destino").alias("tipo"), "fecha_ultimo_pedido")
    )


def canal_producto(producto: DataFrame, canal: DataFrame, item_pedido: DataFrame) -> DataFrame:
    """Sales of each product in its channel.

    Lines are reduced per order, then per product, before they meet the product dimension.
    """
    per_order = item_pedido.groupBy("canal", "producto_id_origen", "pedido_id").agg(
        F.sum("cantidad").alias("units"),
        F.sum("subtotal").alias("amount"),
        F.min("precio_unitario").alias("low"),
        F.max("precio_unitario").alias("high"),
        F.sum("precio_unitario").alias("price_sum"),
        F.count("precio_unitario").alias("priced"),
    )
    sold = per_order.groupBy("canal", "producto_id_origen").agg(
        F.count("pedido_id").alias("total_pedidos"),
        F.sum("units").alias("total_unidades"),
        F.sum("amount").alias("revenue_total"),
        F.min("low").alias("precio_min"),
        F.max("high").alias("precio_max"),
        kpi.ratio(F.sum("price_sum"), F.sum("priced")).alias("precio_promedio"),
    )
    catalogue = producto.select("canal", "producto_id", "producto_id_origen", "nombre", "categoria_id")
    return (
        catalogue.join(canal.select("canal_id", "canal"), "canal")
        .join(sold, ["canal", "producto_id_origen"], "left")
        .select(
            "canal_id", "canal", "producto_id", "producto_id_origen", "nombre", "categoria_id",
            F.coalesce("total_pedidos", F.lit(0)).alias("total_pedidos"),
            "total_unidades", "revenue_total", "precio_min", "precio_max", "precio_promedio",
        )
    )
