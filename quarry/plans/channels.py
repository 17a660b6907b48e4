"""Sales channels: each raw order document becomes one row of a common shape.

The models are written once against that shape. A channel missing from the raw inputs simply
contributes no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.casts import from_cents, try_double, try_int, try_timestamp
from quarry.functions.documents import explode_documents, parse_object

Raw = dict[str, DataFrame]

# Names under which tables of parsed documents may stand beside the raw tables, for many models to read.
PARSED_ORDERS, PARSED_ITEMS, PARSED_RECEIVERS = "order_documents", "item_documents", "receiver_documents"

ORDER_COLUMNS = [
    "canal_id", "canal", "orden_id_origen", "version", "status", "monto_total",
    "fecha_creacion", "fecha_actualizacion", "fecha_cierre",
    "tiene_cliente", "cliente_id_origen", "email", "nombre", "apellido", "telefono",
    "tiene_direccion", "direccion_legible", "calle", "altura", "complemento", "ciudad",
    "provincia", "cp", "pais",
]
ITEM_COLUMNS = [
    "canal", "orden_id_origen", "version", "posicion", "producto_id_origen", "nombre_producto",
    "categoria_id", "cantidad", "precio_unitario", "subtotal", "moneda",
]

DEFAULT_CURRENCY = "ARS"


def no_text() -> Column:
    return F.lit(None).cast("string")


def no_time() -> Column:
    return F.lit(None).cast("timestamp_ntz")


@dataclass(frozen=True)
class Channel:
    id: int
    name: str
    raw_table: str
    orders: Callable[[DataFrame], DataFrame]
    items: Callable[[DataFrame], DataFrame]


def _orders(parsed: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return parsed.select(*[c.alias(name) for name, c in columns.items()])


def _vtex_orders(raw: DataFrame) -> DataFrame:
    parsed = raw.withColumns(
        {
            "who": parse_object(
                F.col("clientProfileData"),
                "userProfileId string, email string, firstName string, lastName string, phone string",
            ),
            "place": parse_object(
                F.col("shippingData"),
                "address struct<street:string, number:string, complement:string, city:string,"
                " state:string, postalCode:string, country:string>",
            )["address"],
        }
    )
    return _orders(
        parsed,
        {
            "orden_id_origen": F.col("orderId").cast("string"),
            "version": F.col("lastChange").cast("string"),
            "status": F.col("status"),
            "monto_total": from_cents(F.col("value")),
            "fecha_creacion": try_timestamp(F.col("creationDate")),
            "fecha_actualizacion": try_timestamp(F.col("lastChange")),
            "fecha_cierre": no_time(),
            "tiene_cliente": F.col("clientProfileData").isNotNull(),
            "cliente_id_origen": F.col("who.userProfileId"),
            "email": F.col("who.email"),
            "nombre": F.col("who.firstName"),
            "apellido": F.col("who.lastName"),
            "telefono": F.col("who.phone"),
            "tiene_direccion": F.col("shippingData").isNotNull(),
            "direccion_legible": F.col("shippingData").startswith("{"),
            "calle": F.col("place.street"),
            "altura": F.col("place.number"),
            "complemento": F.col("place.complement"),
            "ciudad": F.col("place.city"),
            "provincia": F.col("place.state"),
            "cp": F.col("place.postalCode"),
            "pais": F.col("place.country"),
        },
    )


def _meli_orders(raw: DataFrame) -> DataFrame:
    parsed = raw.withColumn(
        "who", parse_object(F.col("buyer"), "id string, email string, nickname string")
    )
    return _orders(
        parsed,
        {
            "orden_id_origen": F.col("id").cast("string"),
            "version": F.col("last_updated").cast("string"),
            "status": F.col("status"),
            "monto_total": try_double(F.col("total_amount")),
            "fecha_creacion": try_timestamp(F.col("date_created")),
            "fecha_actualizacion": try_timestamp(F.col("last_updated")),
            "fecha_cierre": try_timestamp(F.col("date_closed")),
            "tiene_cliente": F.col("buyer").isNotNull(),
            "cliente_id_origen": F.col("who.id"),
            "email": F.col("who.email"),
            "nombre": F.col("who.nickname"),
            "apellido": no_text(),
            "telefono": no_text(),
            "tiene_direccion": F.lit(False),
            "direccion_legible": F.lit(False),
            **{c: no_text() for c in ("calle", "altura", "complemento", "ciudad", "provincia", "cp", "pais")},
        },
    )


def _garbarino_orders(raw: DataFrame) -> DataFrame:
    parsed = raw.withColumns(
        {
            "who": parse_object(F.col("customer"), "id string, email string, name string"),
            "place": parse_object(
                F.col("billing_address"),
                "street string, number string, complement string, city string, state string,"
                " zip string, country string",
            ),
            "sale": parse_object(F.col("totals_sale"), "total string"),
        }
    )
    return _orders(
        parsed,
        {
            "orden_id_origen": F.col("id").cast("string"),
            "version": F.col("created").cast("string"),
            "status": F.col("status"),
            "monto_total": try_double(F.col("sale.total")),
            "fecha_creacion": try_timestamp(F.col("created")),
            "fecha_actualizacion": no_time(),
            "fecha_cierre": no_time(),
            "tiene_cliente": F.col("customer").isNotNull(),
            "cliente_id_origen": F.col("who.id"),
            "email": F.col("who.email"),
            "nombre": F.col("who.name"),
            "apellido": no_text(),
            "telefono": no_text(),
            "tiene_direccion": F.col("billing_address").isNotNull(),
            "direccion_legible": F.col("billing_address").startswith("{"),
            "calle": F.col("place.street"),
            "altura": F.col("place.number"),
            "complemento": F.col("place.complement"),
            "ciudad": F.col("place.city"),
            "provincia": F.col("place.state"),
            "cp": F.col("place.zip"),
            "pais": F.col("place.country"),
        },
    )


def _items(
    raw: DataFrame, order_id: str, version: str, array: str, ddl: str, fields: dict[str, Column],
    scale: float = 1.0,
) -> DataFrame:
    documents = raw.select(
        F.col(order_id).cast("string").alias("orden_id_origen"),
        F.col(version).cast("string").alias("version"),
        F.col(array).alias("elements"),
    )
    exploded = explode_documents(documents, "elements", ddl)
    amounts = exploded.select(
        "orden_id_origen", "version", "posicion", *[c.alias(n) for n, c in fields.items()]
    )
    return amounts.withColumn("subtotal", F.col("cantidad") * F.col("precio") / F.lit(scale)).withColumn(
        "precio_unitario", F.col("precio") / F.lit(scale)
    )


def _vtex_items(raw: DataFrame) -> DataFrame:
    return _items(
        raw, "orderId", "lastChange", "items",
        "productId string, name string, quantity string, sellingPrice string",
        {
            "producto_id_origen": F.col("item.productId"),
            "nombre_producto": F.col("item.name"),
            "categoria_id": no_text(),
            "cantidad": try_int(F.col("item.quantity")),
            "precio": try_double(F.col("item.sellingPrice")),
            "moneda": F.lit(DEFAULT_CURRENCY),
        },
        scale=100.0,
    )


def _meli_items(raw: DataFrame) -> DataFrame:
    return _items(
        raw, "id", "last_updated", "order_items",
        "item struct<id:string, title:string, category_id:string>, quantity string,"
        " unit_price string, currency_id string",
        {
            "producto_id_origen": F.col("item.item.id"),
            "nombre_producto": F.col("item.item.title"),
            "categoria_id": F.col("item.item.category_id"),
            "cantidad": try_int(F.col("item.quantity")),
            "precio": try_double(F.col("item.unit_price")),
            "moneda": F.col("item.currency_id"),
        },
    )


def _garbarino_items(raw: DataFrame) -> DataFrame:
    return _items(
        raw, "id", "created", "sold_items",
        "product_id string, title string, quantity string, price string",
        {
            "producto_id_origen": F.col("item.product_id"),
            "nombre_producto": F.col("item.title"),
            "categoria_id": no_text(),
            "cantidad": try_int(F.col("item.quantity")),
            "precio": try_double(F.col("item.price")),
            "moneda": F.lit(DEFAULT_CURRENCY),
        },
    )


# Channel ids, names and raw tables.
CHANNELS = (
    Channel(1, "vtex", "vtex_pedido", _vtex_orders, _vtex_items),
    Channel(2, "mercadolibre", "meli_pedido", _meli_orders, _meli_items),
    Channel(3, "garbarino", "garbarino_pedido", _garbarino_orders, _garbarino_items),
)
MELI = "mercadolibre"
VTEX = "vtex"


def order_documents(raw: Raw, channel: str | None = None) -> DataFrame:
    """All versions of all orders of all channels, or of one, one row per document."""
    if PARSED_ORDERS in raw:
        parsed = raw[PARSED_ORDERS]
        return parsed.where(F.col("canal") == channel) if channel else parsed
    parts = [
        c.orders(raw[c.raw_table])
        .withColumns({"canal_id": F.lit(c.id), "canal": F.lit(c.name)})
        .select(*ORDER_COLUMNS)
        for c in CHANNELS
        if c.raw_table in raw and channel in (None, c.name)
    ]
    return reduce(DataFrame.unionByName, parts)


def item_documents(raw: Raw) -> DataFrame:
    """All order lines of all documents."""
    if PARSED_ITEMS in raw:
        return raw[PARSED_ITEMS]
    parts = [
        c.items(raw[c.raw_table]).withColumn("canal", F.lit(c.name)).select(*ITEM_COLUMNS)
        for c in CHANNELS
        if c.raw_table in raw
    ]
    return reduce(DataFrame.unionByName, parts)


def scoped_key(scope: Column, source_id: Column) -> Column:
    """md5(channel|id) with the channel in a column; NULL id gives NULL key."""
    return F.md5(F.concat(scope, F.lit("|"), source_id))
