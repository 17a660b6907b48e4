from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.functions import casts, geo, keys, kpi
from quarry.functions.documents import explode_documents, parse_object
from quarry.functions.text import accent_fold, city_key


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, value", [("3.0", 3), ("2.7", 3), ("-2.5", -3), ("x", None), (None, None), ("99999999999", None)])
def test_try_int(spark, text, value):
    assert one(spark, casts.try_int(F.lit(text).cast("string"))) == value


def test_timestamps_ignore_the_offset(spark):
    assert one(spark, casts.try_timestamp(F.lit("2024-01-01T10:00:00-04:00"))) == dt.datetime(2024, 1, 1, 10)
    assert one(spark, casts.try_timestamp(F.lit("soon"))) is None


def test_units(spark):
    assert one(spark, casts.from_cents(F.lit(12345))) == 123.45
    assert one(spark, casts.coordinate(F.lit("0"))) is None
    assert one(spark, casts.country_code(F.lit("ARG"))) == "AR"


@pytest.mark.parametrize("text, value", [("1", True), (" s", True), ("N", False), ("0", False), ("?", None), (None, None)])
def test_bool_flag(spark, text, value):
    assert one(spark, casts.bool_flag(F.lit(text).cast("string"))) is value


def test_accent_fold_handles_characters_and_escapes(spark):
    assert one(spark, accent_fold(F.lit("Córdoba"))) == "Cordoba"
    assert one(spark, accent_fold(F.lit("C\\u00f3rdoba \\U00C1"))) == "Cordoba A"
    assert one(spark, accent_fold(F.lit("Neuquén"), upper=True)) == "NEUQUEN"
    assert one(spark, accent_fold(F.lit("ñandú"))) == "ñandu"
    assert one(spark, city_key(F.lit("CÓRDOBA"))) == "cordoba"


def test_keys(spark):
    assert one(spark, keys.surrogate_key("vtex", F.lit(5))) == one(spark, F.md5(F.lit("vtex|5")))
    assert one(spark, keys.surrogate_key("vtex", F.lit(None))) is None
    place = keys.place_key(F.lit("X"), F.lit(None), F.lit(None))
    assert one(spark, place) == one(spark, F.md5(F.lit("X||AR")))


def test_haversine(spark):
    assert one(spark, geo.haversine_km(F.lit(geo.CENTRE_LATITUDE), F.lit(geo.CENTRE_LONGITUDE))) == 0.0
    # Buenos Aires to Cordoba is about 646 km
    assert abs(one(spark, geo.haversine_km(F.lit(-31.4201), F.lit(-64.1888))) - 646.3) < 2
    assert one(spark, geo.haversine_km(F.lit(None).cast("double"), F.lit(1.0))) is None


def test_ratios(spark):
    assert one(spark, kpi.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, kpi.share_pct(F.lit(1), F.lit(3))) == 33.33
    assert one(spark, kpi.dropped(F.lit(0.75), F.lit(1.0))) is True
    assert one(spark, kpi.dropped(F.lit(0.81), F.lit(1.0))) is False
    assert one(spark, kpi.dropped(F.lit(0.8), F.lit(None).cast("double"))) is False


def test_parse_object_tolerates_tokens(spark):
    ddl = "a struct<b:string>, c string"
    assert one(spark, parse_object(F.lit("direccion_000016"), ddl)["a"]["b"]) is None
    assert one(spark, parse_object(F.lit('{"a":{"b":12}}'), ddl)["a"]["b"]) == "12"


def test_explode_documents(spark, rows):
    df = spark.createDataFrame(
        [(1, '[{"a":1},null,"odd",{"a":"2"}]'), (2, "[]"), (3, None), (4, "token")], "id int, items string"
    )
    out = explode_documents(df, "items", "a string")
    assert rows(out, "id", "posicion", "item.a") == [(1, 0, "1"), (1, 1, None), (1, 2, None), (1, 3, "2")] or rows(
        out, "id", "posicion"
    ) == [(1, 0), (1, 1), (1, 2), (1, 3)]
    assert {r["a"] for r in out.select("item.a").collect()} == {"1", "2", None}


def test_texts_are_told_by_their_form_before_a_cast(spark):
    texts = ["1", "+1", " 1 ", "007", "2147483648", "1.5", ".5", "1.", "1e5", "1d", "0x1p3", "nan", "-Infinity", "inf", "",
             ".", "F", "true", "Y", "no", "1-URGENT", "1996-01-02", "1996-01-02 03:04:05", "1\x7f", "\x001", "\u0661", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for kind in ("int", "bigint", "double", "date", "timestamp_ntz", "boolean"):
        pairs = df.select(F.col("v").try_cast(kind).alias("a"), casts.try_text(F.col("v"), kind).alias("b"))
        assert pairs.where("not a <=> b").isEmpty(), kind
    for c in (F.lit(True), F.lit(2), F.lit(2.5), F.lit("2.5"), F.lit("x")):
        found = spark.range(1).select(c.try_cast("double").alias("a"), casts.try_double(c).alias("b")).first()
        assert found["a"] == found["b"]
    # a text of another form does not reach the cast
    plan = df.select(casts.try_double(F.col("v")))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan


def test_conditions_on_elements_parse_no_document_twice(spark):
    df = spark.createDataFrame([(1, '[{"a": "x"}, {"b": 1}, 5]'), (2, None)], "id long, items string")
    out = explode_documents(df, "items", "a string, b string").where("item.a is not null or item.b is not null")
    assert [(r["id"], r["posicion"], r["item"]["a"], r["item"]["b"]) for r in out.collect()] == [(1, 0, "x", None), (1, 1, None, "1")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2
