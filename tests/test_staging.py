from __future__ import annotations

import datetime as dt
import hashlib
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quarry.plans import channels, staging
from quarry.plans.runner import build_models
from quarry.session import SHUFFLE_CLEANUP
from quarry.sources.layers import Lake
from tests import raw_fixture


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def raw(spark):
    return raw_fixture.tables(spark)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_canal(spark, rows):
    assert rows(staging.canal(spark)) == [
        (1, "vtex", "vtex_pedido"), (2, "mercadolibre", "meli_pedido"), (3, "garbarino", "garbarino_pedido"),
    ]


def test_cliente_prefers_a_known_email(raw):
    people = by(staging.cliente(raw), "cliente_id_origen")
    assert set(people) == {"u1", "u2", "77", "g1"}
    assert people["u1"]["email"] == "ana@x.com"
    assert people["u1"]["cliente_id"] == md5("vtex|u1")
    assert people["77"]["nombre"] == "MELI77" and people["77"]["apellido"] is None


def test_pedido(raw):
    orders = by(staging.pedido(raw), "orden_id_origen")
    assert set(orders) == {"v1", "v2", "v3", "1", "2", "9"}
    v1 = orders["v1"]
    assert (v1["status"], v1["monto_total"], v1["canal_id"]) == ("invoiced", 100.5, 1)
    assert v1["pedido_id"] == md5("vtex|v1")
    assert v1["fecha_creacion"] == dt.datetime(2024, 1, 1, 10)
    assert v1["direccion_id"] == md5("San Martín|5|CÓRDOBA|5000|ARG")
    assert orders["v2"]["direccion_id"] is None and orders["v2"]["fecha_creacion"] is None
    assert orders["1"]["direccion_id"] == md5("Mitre|10|CÓRDOBA|5000|AR")
    assert orders["2"]["fecha_cierre"] == dt.datetime(2024, 3, 5, 10)
    assert orders["9"]["monto_total"] == 1234.5 and orders["9"]["fecha_actualizacion"] is None


def test_item_pedido(raw):
    lines = staging.item_pedido(raw).collect()
    assert len(lines) == 6
    v1 = [r for r in lines if r["orden_id_origen"] == "v1"]
    assert sorted((r["cantidad"], r["precio_unitario"], r["subtotal"]) for r in v1) == [(1, 50.5, 50.5), (2, 25.0, 50.0)]
    assert len({r["item_pedido_id"] for r in v1}) == 1
    cable = next(r for r in lines if r["orden_id_origen"] == "v3")
    assert cable["item_pedido_id"] == md5(md5("vtex|v3") + "|Cable") and cable["cantidad"] == 1
    unique = staging.item_pedido(raw, unique_lines=True)
    assert unique.select("item_pedido_id").distinct().count() == unique.count() == 6


def test_producto_takes_the_lowest_price(raw):
    products = by(staging.producto(raw), "producto_id_origen")
    assert products["MLA1"]["precio_unitario"] == 90.0
    assert products["p1"]["precio_unitario"] == 25.0
    assert products["4"]["canal"] == "garbarino" and None not in products


def test_cliente_pedido(raw):
    orders = by(staging.cliente_pedido(raw), "pedido_id")
    assert orders[md5("vtex|v1")]["cliente_id"] == md5("vtex|u1")
    assert orders[md5("vtex|v3")]["cliente_id"] is None
    assert md5("mercadolibre|2") not in orders  # no buyer
    assert len(orders) == 5


def test_cliente_canal(spark, raw):
    activity = by(staging.cliente_canal(staging.cliente_pedido(raw), staging.canal(spark)), "cliente_id")
    assert activity[md5("mercadolibre|77")]["total_pedidos"] == 1
    assert activity[md5("vtex|u1")]["monto_total_acumulado"] == 100.5
    assert None not in activity


def test_canal_producto(spark, raw):
    sold = by(
        staging.canal_producto(staging.producto(raw), staging.canal(spark), staging.item_pedido(raw)),
        "producto_id_origen",
    )
    radio = sold["MLA1"]
    assert (radio["total_pedidos"], radio["total_unidades"], radio["revenue_total"]) == (2, 4, 369.5)
    assert (radio["precio_min"], radio["precio_max"], radio["precio_promedio"]) == (90.0, 99.5, 94.75)
    assert (sold["p1"]["total_pedidos"], sold["p1"]["total_unidades"]) == (1, 3)


def test_direccion(raw, rows):
    places = staging.direccion(raw)
    assert rows(places, "calle", "ciudad", "pais", "fuente", "latitud") == [
        ("Alem", "Rosario", None, "garbarino", None),
        ("Mitre", "CÓRDOBA", None, "mercadolibre", None),  # coordinates 0 are unknown
        ("Mitre", "Salta", "AR", "mercadolibre", -24.8),
        ("San Martín", "CÓRDOBA", "ARG", "vtex", None),
    ]


def test_geo_coords_and_geocoded(spark, raw):
    coords = by(staging.geo_coords(raw), "direccion_id")
    assert set(coords) == {"k1"} and coords["k1"]["population"] == 1500000
    address = staging.direccion(raw)
    key = address.where("fuente = 'vtex'").first()["direccion_id"]
    matched = staging.geo_coords(raw).replace("k1", key)
    geocoded = by(staging.direccion_geocodificada(address, matched), "fuente")
    assert geocoded["vtex"]["latitud"] == -31.5 and geocoded["vtex"]["population"] == 1500000
    assert geocoded["garbarino"]["latitud"] is None


def test_ubicacion_geo(raw):
    address = staging.direccion(raw)
    key = address.where("fuente = 'vtex'").first()["direccion_id"]
    geocoded = staging.direccion_geocodificada(address, staging.geo_coords(raw).replace("k1", key))
    places = by(staging.ubicacion_geo(raw, geocoded), "ubicacion_id")
    assert places[md5("Rosario|2000|AR")]["latitud"] == -32.9
    assert places[md5("CÓRDOBA|5000|ARG")]["pais_codigo"] == "AR"
    assert places[md5("CÓRDOBA|5000|ARG")]["latitud"] == -31.5  # city mean
    assert places[md5("Córdoba|5001|AR")]["longitud"] == -64.2
    assert len(places) == 5


def test_envio_detalle(raw):
    (shipment,) = staging.envio_detalle(raw).collect()
    assert (shipment["envio_id"], shipment["status"], shipment["origen_ciudad"]) == ("50", "shipped", "Rosario")
    assert shipment["destino_latitud"] == 0.0 and shipment["destino_pais"] is None


def test_geo_envio(raw, rows):
    points = staging.geo_envio(raw)
    assert rows(points, "tipo", "canal", "orden_id_origen", "ciudad") == [
        ("destino_comprador", "mercadolibre", "1", "CÓRDOBA"),
        ("destino_comprador", "vtex", "v1", "CÓRDOBA"),
        ("destino_comprador", "vtex", "v2", None),
        ("origen_vendedor", "mercadolibre", "1", "Rosario"),
        ("retiro_sucursal", "mercadolibre", "2", "Córdoba"),
    ]
    assert md5("destino|vtex|v1") in by(points, "geo_envio_id")


def test_payments_and_pickups(raw):
    (payment,) = staging.meli_pago_detalle(raw).collect()
    assert (payment["status"], payment["cuotas"], payment["pagador_nombre"]) == ("approved", 3, "Mel")
    assert payment["comision_mercadopago"] is None and payment["monto_transaccion"] == 99.5
    (pickup,) = staging.meli_pickup_detalle(raw).collect()
    assert (pickup["tienda_id"], pickup["tienda_latitud"], pickup["persona_doc_numero"]) == ("5", -31.4, "123")


def test_cliente_ubicacion_geo(raw, rows):
    bridge = staging.cliente_ubicacion_geo(raw)
    assert rows(bridge, "cliente_id", "ubicacion_id", "tipo") == sorted(
        [
            (md5("mercadolibre|77"), md5("CÓRDOBA|5000|AR"), "destino"),
            (md5("mercadolibre|77"), md5("Salta|4400|AR"), "destino"),
            (md5("vtex|u1"), md5("CÓRDOBA|5000|ARG"), "destino"),
            (md5("vtex|u1"), md5("||AR"), "destino"),
            (md5("vtex|u2"), md5("||AR"), "destino"),
        ],
        key=lambda t: tuple((True, v) for v in t),
    )


def test_missing_channel_contributes_nothing(raw):
    some = {k: v for k, v in raw.items() if k != "garbarino_pedido"}
    assert staging.pedido(some).count() == 5


def test_build_models_twice_gives_the_same_tables(spark, raw, rows, tmp_path):
    lake = Lake(str(tmp_path))
    as_of = dt.date(2024, 6, 1)
    first = build_models(spark, lake, raw, as_of)
    assert len(first) == 27
    daily = rows(lake.read_consume(spark, "ventas_diarias"))
    summary = {r["cliente_id"]: r for r in lake.read_consume(spark, "clientes_resumen").collect()}
    assert build_models(spark, lake, raw, as_of) == first
    assert rows(lake.read_consume(spark, "ventas_diarias")) == daily
    # v2 has no items; the buyer of order 2 is unknown; v3 has no customer
    assert set(summary) == {md5("vtex|u1"), md5("mercadolibre|77"), md5("garbarino|g1")}
    assert summary[md5("vtex|u1")]["estado_cliente"] == "Activo"
    assert summary[md5("garbarino|g1")]["estado_cliente"] == "Inactivo"
    assert sum(r[3] for r in daily) == 5


def test_documents_are_parsed_once(raw):
    for model, documents in ((staging.direccion, 3), (staging.cliente, 3), (staging.producto, 6), (staging.cliente_ubicacion_geo, 4)):
        plan = model(raw)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == documents, model.__name__


def test_build_reads_raw_documents_once_per_shape(spark, raw, tmp_path):
    read = {n: spark.sparkContext.accumulator(0) for n in ("vtex_pedido", "meli_pedido", "garbarino_pedido")}

    def counted(name):
        def batches(some):
            for batch in some:
                read[name].add(batch.num_rows)
                yield batch

        return raw[name].mapInArrow(batches, raw[name].schema)

    build_models(spark, Lake(str(tmp_path)), raw | {n: counted(n) for n in read}, dt.date(2024, 6, 1))
    # orders and their lines; no model reads the documents again
    assert {n: a.value for n, a in read.items()} == {n: 2 * raw[n].count() for n in read}


def test_parsed_documents_give_the_same_models(raw, rows):
    parsed = raw | {
        channels.PARSED_ORDERS: channels.order_documents(raw), channels.PARSED_ITEMS: channels.item_documents(raw),
        channels.PARSED_RECEIVERS: staging.receiver_documents(raw),
    }
    addresses = staging.direccion_geocodificada(staging.direccion(raw), staging.geo_coords(raw))
    for model in (
        staging.cliente, staging.producto, staging.direccion, staging.pedido, staging.item_pedido, staging.geo_envio,
        staging.cliente_pedido, staging.cliente_ubicacion_geo, lambda given: staging.ubicacion_geo(given, addresses),
    ):
        assert rows(model(parsed)) == rows(model(raw)) != []


def test_build_keeps_no_scratch_tables_and_no_shuffle_files(spark, raw, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {p for folder in disk.localDirsString() for p in Path(folder).rglob("shuffle_*")}

    def scratch():
        kept = Path(spark.conf.get("spark.checkpoint.dir"))
        return {p for label in ("*_documents", "owned", "customers") for p in kept.glob(f"{label}-*")}

    before, parsed, setting = shuffled(), scratch(), spark.conf.get(SHUFFLE_CLEANUP, "false")
    build_models(spark, Lake(str(tmp_path)), raw, dt.date(2024, 6, 1))
    assert scratch() == parsed
    deadline = time.monotonic() + 20  # executors delete them in their own time
    while shuffled() - before and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == setting


def test_order_ids_stand_for_their_digests_within_a_channel(spark, raw, rows):
    lines = staging.item_pedido(raw)
    repeated = lines.unionByName(lines.where("canal = 'mercadolibre'")).unionByName(
        lines.where("orden_id_origen = 'v3'").withColumns(
            {"pedido_id": F.lit(None).cast("string"), "orden_id_origen": F.lit(None).cast("string")}
        )
    )
    of_digests = staging.canal_producto(staging.producto(raw), staging.canal(spark), repeated)
    ids = repeated.withColumn("pedido_id", F.col("orden_id_origen"))
    assert rows(staging.canal_producto(staging.producto(raw), staging.canal(spark), ids)) == rows(of_digests) != []
