from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.plans import runner
from quarry.plans.runlog import RunLog
from quarry.plans.runner import run_extraction, run_pipeline
from quarry.session import materialise
from quarry.sources import files, footers, mirror
from quarry.sources.csv import csv_schema, read_csv
from quarry.sources.csv_records import csv_lines
from quarry.sources.files import compact_files
from quarry.sources.folder import common_type, csv_headers, list_files, nested_to_json, parquet_footers, read_folder
from quarry.sources.generations import schemas
from quarry.sources.jdbc import jdbc_options, newer_than
from quarry.sources.layers import Lake, ingest_folders
from quarry.sources.ranges import RangedFolder, tree
from quarry.sources.registry import read_source, register_source, table_names
from quarry.streaming import raw_ingest
from quarry.streaming.raw_ingest import ingest_new_files


@pytest.fixture
def sample_csv(tmp_path):
    path = tmp_path / "clientes.csv"
    path.write_text("id,nombre,email,total\n1,Alice,a@t.com,100.5\n2,Bob,b@t.com,200\n3,Charlie,,150\n")
    return str(path)


def test_csv_types_nulls_and_lineage(spark, sample_csv):
    df = read_source(spark, {"name": "src", "type": "csv", "path": sample_csv}, "clientes")
    assert df.columns == ["id", "nombre", "email", "total", "_ingestion_timestamp", "_source_name"]
    row = df.where("id = 3").first()
    assert row["email"] is None and row["total"] == 150.0 and row["_source_name"] == "src"


def test_csv_schema_and_missing_file(spark, sample_csv, tmp_path):
    config = {"name": "s", "type": "csv", "tables": [{"name": "c", "path": sample_csv}]}
    assert csv_schema(spark, config, "c") == {"id": "int", "nombre": "string", "email": "string", "total": "double"}
    with pytest.raises(FileNotFoundError, match="no CSV files"):
        read_csv(spark, str(tmp_path / "none*.csv"))
    with pytest.raises(FileNotFoundError, match="no path"):
        read_source(spark, config, "other")


def test_csv_skips_rows_of_every_file(spark, tmp_path, rows):
    for i in range(3):
        (tmp_path / f"f{i}.csv").write_text(f"title\nby me\nid;d;t\n{i};2024-01-0{i + 1};x;\n{i + 10};;'q'\n")
    df = read_csv(spark, f"{tmp_path}/*.csv", delimiter=";", skip_rows=2)
    assert df.dtypes == [("id", "int"), ("d", "date"), ("t", "string")]
    assert rows(df, "id", "d")[:3] == [(0, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 2)), (10, None)]


def test_csv_encoding(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("ciudad\nCórdoba\n".encode("latin-1"))
    assert read_csv(spark, str(path), encoding="iso-8859-1").first()["ciudad"] == "Córdoba"


def test_csv_folder_by_header(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("x,y\n1,a\n")
    (tmp_path / "b.csv").write_text("y,z\nb,2.5\n")
    df = read_folder(spark, str(tmp_path), "csv")
    assert df.columns == ["x", "y", "_source_file", "z"]
    assert rows(df, "x", "y", "z", "_source_file") == [(None, "b", 2.5, "b.csv"), (1, "a", None, "a.csv")]


def test_promotion():
    assert common_type({T.LongType()}) == T.LongType()
    assert common_type({T.NullType(), T.DateType()}) == T.DateType()
    assert common_type({T.NullType()}) == T.NullType()
    assert common_type({T.IntegerType(), T.LongType(), T.FloatType()}) == T.DoubleType()
    assert common_type({T.LongType(), T.DoubleType(), T.StringType()}) == T.StringType()
    assert common_type({T.DateType(), T.LongType()}) == T.StringType()


def test_csv_folder_types_come_from_all_values(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("code,n\n007,1\n")
    (tmp_path / "b.csv").write_text("n,code\n2.5,A1\n")
    assert rows(read_folder(spark, str(tmp_path), "csv"), "code", "n") == [("007", 1.0), ("A1", 2.5)]


def test_csv_columns_follow_each_header(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('a,b\n1,"two\nlines"\n')
    (tmp_path / "b.csv").write_text("b,a,c\nw,9,x\n")
    df = read_csv(spark, f"{tmp_path}/*.csv", multi_line=True)
    assert rows(df, "a", "b", "c") == [(1, "two\nlines", None), (9, "w", "x")]


@pytest.mark.parametrize("skip", [0, 2])
@pytest.mark.parametrize("schema", [None, "b string, a int, missing date"])
def test_csv_by_name_on_every_path(spark, tmp_path, rows, skip, schema):
    lead = "title\na 5\" disk\n" if skip else ""
    (tmp_path / "f 1.csv").write_text(lead + 'a,b\n1,"two\nlines"\n2,"say ""hi"", all"\n\n')
    (tmp_path / "f2.csv").write_text(lead + "b,a\nw,9\n,10\nodd\n")
    for multi_line in (None, True):
        df = read_csv(spark, f"{tmp_path}/*.csv", skip_rows=skip, schema=schema, multi_line=multi_line)
        assert rows(df, "a", "b") == [(None, "odd"), (1, "two\nlines"), (10, None), (2, 'say "hi", all'), (9, "w")]
        if schema:
            assert df.columns == ["b", "a", "missing"] and df.where("missing is not null").isEmpty()


def test_csv_schema_goes_by_the_header_of_one_file(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("n,when,word\n1,2024-01-01,x\nno,,y\n")
    df = read_csv(spark, str(tmp_path), schema="word string, n int, gone double")
    assert rows(df) == [("x", 1, None), ("y", None, None)] and df.columns == ["word", "n", "gone"]
    df = read_csv(spark, str(tmp_path), schema="x string, y string", header=False, skip_rows=1)
    assert rows(df) == [("1", "2024-01-01"), ("no", None)]


def test_csv_records_across_splits(spark, tmp_path, rows):
    """Splits of a few hundred bytes: records span lines, and lines of one record lie in many splits."""
    written = [(i, f"line {i}\n" * (i % 23) + f'"{i}"' + "," * (i % 3)) for i in range(400)]
    escaped = [(i, text.replace('"', '""')) for i, text in written]
    (tmp_path / "a.csv").write_text("preamble\nid,text\n" + "".join(f'{i},"{text}"\n' for i, text in escaped if i % 2))
    (tmp_path / "b.csv").write_text("\ntext,id\n" + "".join(f'"{text}",{i}\n' for i, text in escaped if i % 2 == 0))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        df = read_csv(spark, f"{tmp_path}/*.csv", skip_rows=1)
        assert df.columns == ["id", "text"]
        assert sorted((r["id"], r["text"]) for r in df.collect()) == written
        assert csv_lines(spark, f"{tmp_path}/*.csv", "utf-8").select("split").distinct().count() > 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_headers_in_other_encodings(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_bytes("año,b\n1,x\n".encode("utf-16"))
    found = csv_headers(list_files(spark, str(tmp_path), "*"), ",", "utf-16").first()
    assert found["fingerprint"] == "año\nb"
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("")
    assert read_csv(spark, str(tmp_path / "empty"), skip_rows=1).count() == 0


def test_columns_of_all_files_survive(spark, tmp_path, rows):
    lake = Lake(str(tmp_path / "lake"))
    lake.write_raw(spark.createDataFrame([(1,)], "id int"), "s", "t")
    lake.write_raw(spark.createDataFrame([(2, "more")], "id int, extra string"), "s", "t")
    assert rows(lake.read_raw(spark, "s", "t"), "id", "extra") == [(1, None), (2, "more")]
    compact_files(spark, [lake.raw_path("s", "t")], str(tmp_path / "compact"))
    assert rows(spark.read.parquet(str(tmp_path / "compact")), "id", "extra") == [(1, None), (2, "more")]


def test_lenient_merge_of_conflicting_files(spark, tmp_path, rows):
    pq.write_table(pa.table({"id": [1], "value": pa.array([5], pa.int64()), "doc": [{"a": 1, "b": None}]}), tmp_path / "1.parquet")
    pq.write_table(pa.table({"value": [2.5], "id": ["x"], "extra": [True]}), tmp_path / "2.parquet")
    pq.write_table(pa.table({"id": [3], "value": pa.array([7], pa.int64()), "doc": [None]}, schema=pa.schema(
        [("id", pa.int64()), ("value", pa.int64()), ("doc", pa.struct([("a", pa.int64()), ("b", pa.null())]))])), tmp_path / "3.parquet")
    df = read_folder(spark, str(tmp_path))
    assert df.columns == ["id", "value", "doc", "_source_file", "extra"]
    assert rows(df, "id", "value", "doc", "extra") == [
        ("1", 5.0, '{"a":1,"b":null}', None), ("3", 7.0, None, None), ("x", 2.5, None, True),
    ]


def test_nested_to_json(spark):
    df = spark.sql("SELECT array(1, 2) AS a, map('k', CAST(NULL AS INT)) AS m, CAST(NULL AS ARRAY<INT>) AS n, 'é' AS s")
    assert tuple(nested_to_json(df).first()) == ("[1,2]", '{"k":null}', None, "é")


def test_registry(spark):
    with pytest.raises(ValueError, match="available: .*csv.*jdbc"):
        read_source(spark, {"name": "x", "type": "ftp"}, "t")
    register_source("numbers", lambda s, c, t, last_value=None: s.range(c["n"]))
    assert read_source(spark, {"name": "x", "type": "numbers", "n": 4}, "t").count() == 4
    assert table_names({"name": "solo"}) == ["solo"]


def test_jdbc_options_and_incremental_filter(spark):
    config = {
        "connection": {"host": "h", "database": "d", "user": "u", "password": "p"},
        "partition": {"column": "id", "lower": 1, "upper": 100, "num": 4},
    }
    options = jdbc_options(config, "pedidos")
    assert options["url"] == "jdbc:mysql://h:3306/d" and options["dbtable"] == "pedidos"
    assert options["numPartitions"] == "4" and options["fetchsize"] == "10000"
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 2, 1))], "id int, at timestamp_ntz")
    assert newer_than(df, {"key_column": "at"}, "2024-01-01").count() == 1
    assert newer_than(df, {"key_column": "at"}, None).count() == 2
    assert newer_than(df, {"key_column": "id"}, None).count() == 2
    assert newer_than(df, {"key_column": "id"}, "1").count() == 1
    assert newer_than(df, None, "9").count() == 2
    early = spark.createDataFrame([(dt.date(1960, 1, 1),), (None,), (dt.date(2020, 1, 1),)], "at date")
    assert newer_than(early, {"key_column": "at"}, None).count() == 3
    assert newer_than(early, {"key_column": "at", "start": "1970-01-01"}, None).count() == 1


def test_raw_append_and_replace(spark, people, tmp_path):
    lake = Lake(str(tmp_path))
    written = lake.write_raw(people, "s", "t", measures={"top": F.max("id")})
    assert written.rows == 5 and written.measures == {"top": 5}
    lake.write_raw(people, "s", "t")
    assert lake.read_raw(spark, "s", "t").count() == 10
    lake.write_raw(people, "s", "t", "replace_day")
    assert lake.read_raw(spark, "s", "t").count() == 5
    with pytest.raises(ValueError):
        lake.write_raw(people, "s", "t", "upsert")


def test_raw_read_prunes_days(spark, tmp_path):
    lake = Lake(str(tmp_path))
    df = spark.sql("SELECT id, timestamp '2024-01-01 12:00:00' + make_dt_interval(int(id)) AS _ingestion_timestamp FROM range(10)")
    lake.write_raw(df, "s", "t")
    bounded = lake.read_raw(spark, "s", "t", "2024-01-03 12:00:00", "2024-01-05 12:00:00")
    assert sorted(r["id"] for r in bounded.collect()) == [2, 3, 4]
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "make_date" in plan.split("PartitionFilters")[1][:400]
    assert len(bounded.inputFiles()) <= 10


def test_raw_read_lenient_keeps_partitions(spark, tmp_path):
    lake = Lake(str(tmp_path))
    lake.write_raw(spark.sql("SELECT 1L AS a"), "s", "t")
    lake.write_raw(spark.sql("SELECT 2.5D AS a, 'x' AS b"), "s", "t")
    df = lake.read_raw(spark, "s", "t", "2020-01-01", lenient=True)
    assert sorted(r["a"] for r in df.collect()) == [1.0, 2.5]


def test_raw_read_opens_no_recorded_footer(spark, tmp_path, monkeypatch):
    lake, path = Lake(str(tmp_path)), str(tmp_path / "raw/s/t")
    lake.write_raw(spark.sql("SELECT 1L AS a"), "s", "t")
    lake.write_raw(spark.sql("SELECT 2.5D AS a, 'x' AS b, array(1) AS c"), "s", "t")
    opened = []
    monkeypatch.setattr(footers, "parquet_footers", lambda files: opened.append(files.count()) or parquet_footers(files))
    df = lake.read_raw(spark, "s", "t", lenient=True)
    assert sorted((r["a"], r["b"], r["c"]) for r in df.collect()) == [(1.0, None, None), (2.5, "x", "[1]")]
    assert opened == []
    with pytest.raises(ValueError, match="'a' is"):
        lake.read_raw(spark, "s", "t")
    # another writer's file: its footer alone is read, until it is recorded
    today = spark.sql("SELECT 7L AS a, current_timestamp() AS _ingestion_timestamp, '2031' AS year, '01' AS month, '02' AS day")
    today.write.mode("append").partitionBy("year", "month", "day").parquet(path)
    assert lake.read_raw(spark, "s", "t", lenient=True).count() == 3 and opened == [1]
    lake.record_raw(spark, "s", "t")
    assert lake.read_raw(spark, "s", "t", lenient=True).count() == 3 and opened == [1, 1]
    assert spark.read.parquet(path + "/_files").count() == spark.read.parquet(path + "/_files").dropDuplicates(["path"]).count()


def test_raw_read_of_some_days_plans_their_files_only(spark, tmp_path):
    lake = Lake(str(tmp_path))
    day = "SELECT {} AS a, timestamp '2024-01-0{} 10:00:00' AS _ingestion_timestamp"
    for value, number in (("1L", 1), ("'two'", 2), ("3L", 3)):
        lake.write_raw(spark.sql(day.format(value, number)), "s", "t")
    found = lake.read_raw(spark, "s", "t", "2024-01-03", lenient=True)
    # the type is that of all days
    assert [r["a"] for r in found.collect()] == ["3"] and len(found.inputFiles()) == 1


def test_raw_views(spark, people, tmp_path):
    lake = Lake(str(tmp_path))
    with pytest.raises(FileNotFoundError):
        lake.register_raw_views(spark, {"v": ("s", "t")})
    lake.write_raw(people, "s", "t")
    assert lake.register_raw_views(spark, {"v_people": ("s", "t"), "v_none": ("s", "none")}) == 1
    assert spark.table("v_people").count() == 5


def test_layer_paths_and_internal_columns(spark, people, tmp_path):
    lake = Lake(str(tmp_path))
    assert lake.write_staging(people, "clientes").path.endswith("staging/default/clientes")
    written = lake.write_consume(people.withColumn("_x", F.lit(1)), "clientes", "ml")
    assert written.path.endswith("consume/ml/clientes") and written.rows == 5
    assert "_x" not in lake.read_consume(spark, "clientes", "ml").columns


def test_a_table_is_replaced_when_its_successor_is_complete(spark, people, tmp_path):
    lake = Lake(str(tmp_path))
    lake.write_staging(people, "clientes")
    broken = people.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        lake.write_staging(broken, "clientes")
    assert lake.read_staging(spark, "clientes").count() == 5
    # from itself
    written = lake.write_staging(lake.read_staging(spark, "clientes").where("id > 1"), "clientes")
    assert written.path == lake.staging_path("clientes") and written.rows == 4
    assert lake.read_staging(spark, "clientes").count() == 4
    assert [p.name for p in (tmp_path / "staging/default").iterdir()] == ["clientes"]


def test_ingest_folders_skips_empty(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "in/people"))
    (tmp_path / "in/empty").mkdir(parents=True)
    lake = Lake(str(tmp_path / "lake"))
    folders = {"people": {"path": str(tmp_path / "in/people")}, "empty": {"path": str(tmp_path / "in/empty")}}
    assert ingest_folders(spark, lake, "s", folders) == {"people": 5}
    assert "_source_file" in lake.read_raw(spark, "s", "people").columns


def test_stream_reads_each_file_once(spark, tmp_path):
    source, lake, state = str(tmp_path / "in"), Lake(str(tmp_path / "lake")), str(tmp_path / "state")
    spark.range(10).write.mode("append").parquet(source)
    path = ingest_new_files(spark, source, lake, "s", "t", state)
    ingest_new_files(spark, source, lake, "s", "t", state)
    assert spark.read.parquet(path).count() == 10
    spark.range(10, 15).write.mode("append").parquet(source)
    ingest_new_files(spark, source, lake, "s", "t", state)
    assert spark.read.parquet(path).select("id").distinct().count() == spark.read.parquet(path).count() == 15


def test_stream_promotes_types_and_adds_columns(spark, rows, tmp_path):
    source, lake, state = str(tmp_path / "in"), Lake(str(tmp_path / "lake")), str(tmp_path / "state")
    for sql in (
        "SELECT 1L AS id, 10 AS v, NULL AS nothing",
        "SELECT 2L AS id, 'text' AS v",
        "SELECT 3L AS id, 2.5D AS v, named_struct('a', 1) AS more",
    ):
        spark.sql(sql).write.mode("append").option("compression", "none").parquet(source)
        ingest_new_files(spark, source, lake, "s", "t", state)
    df = lake.read_raw(spark, "s", "t")
    assert dict(df.dtypes)["v"] == "string" and "_schema" not in df.columns
    assert rows(df, "id", "v", "more") == [(1, "10", None), (2, "text", None), (3, "2.5", '{"a":1}')]
    assert len(schemas(spark, lake.raw_path("s", "t"))) == 3
    # an older reader's way, by the footers, still sees the same values
    assert rows(read_folder(spark, lake.raw_path("s", "t"), base_path=lake.raw_path("s", "t")), "id", "v") == [
        (1, "10"), (2, "text"), (3, "2.5"),
    ]
    with pytest.raises(ValueError, match="fed by a stream"):
        lake.write_raw(df, "s", "t")


def test_stream_types_in_one_batch_and_few_files_at_once(spark, rows, tmp_path):
    source, lake = str(tmp_path / "in"), Lake(str(tmp_path / "lake"))
    spark.sql("SELECT 1L AS id, 10 AS v").write.mode("append").parquet(source)
    spark.sql("SELECT 2L AS id, 0.5D AS v").write.mode("append").parquet(source)
    spark.sql("SELECT 3L AS id, 7L AS v, 'x' AS w").write.mode("append").parquet(source)
    ingest_new_files(spark, source, lake, "s", "all", str(tmp_path / "a"))
    ingest_new_files(spark, source, lake, "s", "each", str(tmp_path / "b"), max_files=1)
    for table in ("all", "each"):
        df = lake.read_raw(spark, "s", table)
        assert rows(df, "id", "v", "w") == [(1, 10.0, None), (2, 0.5, None), (3, 7.0, "x")]
    given = "w string, v int, other date"
    ingest_new_files(spark, source, lake, "s", "given", str(tmp_path / "c"), schema=given)
    df = lake.read_raw(spark, "s", "given")
    assert rows(df, "w", "v", "other") == [(None, 0, None), (None, 10, None), ("x", 7, None)]


def test_a_repeated_batch_adds_nothing(spark, rows, tmp_path, monkeypatch):
    """The job is lost after the batch was written, before the stream noted it."""
    source, lake, state = str(tmp_path / "in"), Lake(str(tmp_path / "lake")), str(tmp_path / "state")
    spark.range(5).write.parquet(source)
    write = raw_ingest.write_generation

    def lost(*args):
        write(*args)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(raw_ingest, "write_generation", lost)
    with pytest.raises(StreamingQueryException):
        ingest_new_files(spark, source, lake, "s", "t", state)
    before = rows(lake.read_raw(spark, "s", "t"))
    assert len(before) == 5
    monkeypatch.setattr(raw_ingest, "write_generation", write)
    spark.range(5, 7).write.mode("append").parquet(source)
    ingest_new_files(spark, source, lake, "s", "t", state)
    after = rows(lake.read_raw(spark, "s", "t"))
    assert set(before) < set(after) and len(after) == 7
    # another stream into the same table is another set of batches
    ingest_new_files(spark, source, lake, "s", "t", str(tmp_path / "second"))
    assert lake.read_raw(spark, "s", "t").count() == 14


def test_stream_over_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lake = Lake(str(tmp_path / "lake"))
    ingest_new_files(spark, str(tmp_path / "in"), lake, "s", "t", str(tmp_path / "state"))
    assert schemas(spark, lake.raw_path("s", "t")) == []


def test_files(spark, tmp_path):
    path = files.write_parquet(spark.range(100).repartition(5), str(tmp_path / "raw/s/t"), "zstd")
    profile = files.file_profile(spark, path).collect()
    assert sum(r["rows"] for r in profile) == 100 and {r["codec"] for r in profile} == {"ZSTD"}
    assert files.compact_files(spark, [path], str(tmp_path / "one")) == 1
    assert files.row_count(spark, str(tmp_path / "one")).first()["rows"] == 100
    assert files.query_parquet(spark, path, ["id * 2 AS d"], "id >= 90", 3).count() == 3
    assert files.parquet_schema(spark, path) == {"id": "bigint"}
    inventory = files.lake_inventory(spark, str(tmp_path / "raw")).collect()
    assert [(r["layer"], r["files"]) for r in inventory] == [("raw", len(profile))]
    assert files.lake_tables(spark, str(tmp_path / "raw")).collect() == [("raw", "s", "t")]


def test_compaction_packs_whole_files(spark, tmp_path):
    path = str(tmp_path / "small")
    spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).repartition(40).write.parquet(path)
    sizes = [r["length"] for r in list_files(spark, path).collect()]
    target = 8 * max(sizes)
    packed = files.packed_reads(spark, [path], target)
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
    order = [r["id"] for r in spark.read.parquet(path).where(F.col("_metadata.file_name") != "").collect()]
    count = files.compact_files(spark, [path], str(tmp_path / "few"), target_bytes=target)
    assert 5 <= count <= 6
    found = list_files(spark, str(tmp_path / "few")).collect()
    assert sum(r["length"] > 0.6 * target for r in found) >= count - 1
    # the rows of each small file stay together, in their order
    after = {r["id"]: i for i, r in enumerate(spark.read.parquet(str(tmp_path / "few")).collect())}
    breaks = sum(after[b] != after[a] + 1 for a, b in zip(order, order[1:], strict=False))
    assert len(after) == 40_000 and breaks <= 2 * len(sizes)


def test_mirror(spark, people, tmp_path):
    target = mirror.FolderTarget(spark, str(tmp_path))
    assert mirror.mirror_tables({"p": people}, target).summary() == {"exported": 1, "skipped": 0, "failed": 0}
    assert mirror.mirror_tables({"p": people}, target).actions == {"p": "skip"}
    changed = people.withColumn("total", F.col("total") + 1)
    assert mirror.change_action(changed, target.read("p"), compare="count") == "skip"
    assert mirror.change_action(changed, target.read("p")) == "update"
    assert mirror.change_action(people.drop("email"), target.read("p")) == "recreate"


def test_mirror_by_ranges(spark, rows, tmp_path):
    target = RangedFolder(spark, str(tmp_path), rows_per_range=10)
    df = spark.range(1000).select("id", F.concat(F.lit("n"), "id").alias("name"), F.struct("id").alias("s"))
    run = lambda new: mirror.mirror_tables({"t": new}, target, keys={"t": "id"})
    assert run(df).ranges == {"t": 100} and run(df).actions == {"t": "skip"}
    assert rows(target.read("t"), "id", "name")[:2] == [(0, "n0"), (1, "n1")]
    for new, count in (
        (df.withColumn("name", F.when(F.col("id").isin(5, 995), "x").otherwise(F.col("name"))), 2),
        (df.where("id < 987"), 3),  # two ranges are back, of one and a half the rows go
        (df.where("id < 987").union(spark.createDataFrame([(5000, "new", (5000,)), (-7, "old", (-7,)), (None, "none", None)], "id long, name string, s struct<id: long>")), 3),
        (df, 5),
    ):
        tally = run(new)
        assert tally.actions == {"t": "update"} and tally.ranges == {"t": count}
        assert rows(target.read("t"), "id", "name") == rows(new, "id", "name")
    assert run(df.withColumn("more", F.lit(1))).actions == {"t": "recreate"}
    assert target.read("t").count() == 1000


def test_a_lost_range_is_written_again(spark, rows, tmp_path):
    """The first attempt is lost after its data was written; the source changes back before the next one."""
    target = RangedFolder(spark, str(tmp_path), rows_per_range=10)
    df = spark.range(100).select("id", F.lit("a").alias("v"))
    target.mirror(df, "t", "id")
    changed = df.withColumn("v", F.when(F.col("id") == 3, "b").otherwise("a"))
    plan = target._plan("t")[0]
    # what a run leaves that was lost between its writes
    leaves = target._stored("t", "digests").where("level = 2").drop("level").withColumn("done", F.col("node") != 0)
    materialise(tree(leaves), "held").write.mode("overwrite").parquet(f"{tmp_path}/t/digests")
    numbered = changed.withColumn("_range", plan.number(df.schema["id"].dataType)).where("_range = 0")
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_range").parquet(f"{tmp_path}/t/data")
    assert target.mirror(df, "t", "id") == ("update", 1)
    assert rows(target.read("t")) == rows(df)


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "decimal(12,2)", "double"])
def test_ranges_of_other_keys(spark, rows, tmp_path, kind):
    days = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))
    key = days.cast(kind) if kind in ("date", "timestamp") else F.col("id").cast(kind)
    df = spark.range(100).select(key.alias("k"), "id")
    target = RangedFolder(spark, str(tmp_path), rows_per_range=10)
    assert target.mirror(df, "t", "k")[0] == "create"
    action, ranges = target.mirror(df.where("id <> 50"), "t", "k")
    assert (action, ranges) == ("update", 1) and rows(target.read("t"), "id") == rows(df.where("id <> 50"), "id")


def test_jdbc_tables_are_made_with_the_target_types(spark, monkeypatch):
    df = spark.range(1).select("id", F.lit("a").alias("name"))
    make = 'CREATE TABLE "s"."t" ("id" BIGINT, "name" TEXT)'
    assert mirror.JdbcTarget.statements(df, "s.t", "create") == [make]
    assert mirror.JdbcTarget.statements(df, "s.t", "recreate") == ['DROP TABLE "s"."t"', make]
    assert mirror.JdbcTarget.statements(df, "s.t", "update") == []


def test_mirror_compares_types_and_nested_columns(spark, tmp_path):
    target = mirror.FolderTarget(spark, str(tmp_path))
    df = spark.range(3).withColumn("s", F.struct("id"))
    tally = mirror.mirror_tables({"a.t": df, "b.t": df, "b.u": df}, target)
    assert tally.by_schema() == {"a": {"exported": 1, "skipped": 0, "failed": 0}, "b": {"exported": 2, "skipped": 0, "failed": 0}}
    assert mirror.change_action(df, target.read("a.t")) == "skip"
    assert mirror.change_action(df.withColumn("id", F.col("id").cast("string")), target.read("a.t")) == "recreate"


def test_mirror_collects_errors(spark, people, tmp_path):
    class Broken(mirror.FolderTarget):
        def write(self, df, table, action):
            if table == "bad":
                raise OSError("disk")
            super().write(df, table, action)

    with pytest.raises(mirror.MirrorError, match="bad: disk") as caught:
        mirror.mirror_tables({"bad": people, "good": people}, Broken(spark, str(tmp_path)))
    assert caught.value.tally.summary() == {"exported": 1, "skipped": 0, "failed": 1}


def test_jdbc_target_options(spark):
    target = mirror.JdbcTarget(spark, {"url": "jdbc:postgresql://h/d"})
    assert target.read("consume.t") is None
    assert target.write_options("consume.t", "update")["truncate"] == "true"
    assert target.write_options("consume.t", "recreate")["truncate"] == "false"
    assert "IN ('consume', 'o''k')" in target.listing(["consume", "o'k"])


def test_csv_timestamps_are_wall_clock(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("at,n\n2024-01-01 10:00:00,1\n")
    assert read_csv(spark, str(path)).dtypes[0] == ("at", "timestamp_ntz")


def test_mirror_ddl(spark):
    schema = spark.sql("SELECT 1 AS i, 1L AS b, 1D AS d, 1.50BD AS n, 's' AS s, array(1) AS a, DATE '2024-01-01' AS f").schema
    assert mirror.table_ddl("consume", "t", schema) == (
        'CREATE TABLE "consume"."t" ("i" INTEGER, "b" BIGINT, "d" DOUBLE PRECISION, "n" NUMERIC(3,2), "s" TEXT,'
        ' "a" TEXT, "f" DATE)'
    )


def test_extraction_continues_after_a_failure(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "in/a"))
    lake, log = Lake(str(tmp_path / "lake")), RunLog(spark, str(tmp_path / "lake"))
    config = {"name": "s", "type": "parquet", "path": str(tmp_path / "in"), "tables": ["missing", "a"]}
    outcome = run_extraction(spark, lake, log, config)
    assert outcome["missing"]["status"] == "error" and outcome["a"]["rows"] == 5
    assert log.last_extraction("s", "missing") is None
    assert log.last_extraction("s", "a")["high_water_mark"] is None
    assert log.read("extractions").where("bytes > 0").count() == 1
    with pytest.raises(ValueError, match="disabled"):
        run_extraction(spark, lake, log, config | {"enabled": False})


def test_incremental_extraction_keeps_its_mark(spark, tmp_path):
    lake, log = Lake(str(tmp_path / "lake")), RunLog(spark, str(tmp_path / "lake"))
    config = {
        "name": "s", "type": "parquet", "path": str(tmp_path / "in"), "tables": ["a"],
        "incremental": {"key_column": "id"},
    }
    spark.range(5).write.mode("overwrite").parquet(str(tmp_path / "in/a"))
    assert run_extraction(spark, lake, log, config)["a"]["rows"] == 5
    assert run_extraction(spark, lake, log, config)["a"]["rows"] == 0
    spark.range(8).write.mode("overwrite").parquet(str(tmp_path / "in/a"))
    assert run_extraction(spark, lake, log, config)["a"]["rows"] == 3
    assert log.last_extraction("s", "a")["high_water_mark"] == "7"
    assert lake.read_raw(spark, "s", "a").count() == 8


def test_pipeline_gate_does_not_publish(spark, repeated, tmp_path):
    lake, log = Lake(str(tmp_path)), RunLog(spark, str(tmp_path))
    lake.write_raw(repeated, "s", "t")
    config = {
        "name": "p", "source": {"layer": "raw", "domain": "s", "table": "t"},
        "destination": {"layer": "staging", "table": "t"},
        "quality_checks": [{"type": "unique", "columns": ["id"], "severity": "error"}],
    }
    outcome = run_pipeline(spark, lake, log, config, quarantine=True)
    assert outcome["status"] == "error" and "1 rows repeat a key of (id)" in outcome["error"]
    assert not (tmp_path / "staging").exists()
    assert spark.read.parquet(str(tmp_path / "quarantine/p/0_unique")).count() == 2
    fixed = config | {"transforms": [{"type": "deduplicate", "keys": ["id"]}]}
    outcome = run_pipeline(spark, lake, log, fixed)
    assert outcome["status"] == "success" and outcome["rows"] == 4 and outcome["quality"][0]["passed"]
    assert [r["status"] for r in log.recent("pipelines").collect()] == ["success", "error"]
    assert log.read("quality").count() == 2


def test_a_checked_staging_table_is_written_once(spark, repeated, tmp_path, monkeypatch):
    lake, log, labels = Lake(str(tmp_path)), RunLog(spark, str(tmp_path)), []
    scratch = runner.scratch_path
    monkeypatch.setattr(runner, "scratch_path", lambda session, label: labels.append(label) or scratch(session, label))
    lake.write_raw(repeated, "s", "t")
    config = {
        "name": "p", "source": {"layer": "raw", "domain": "s", "table": "t"},
        "destination": {"layer": "staging", "table": "t"},
        "quality_checks": [{"type": "not_null", "columns": ["id"], "severity": "error"}],
    }
    for _ in range(2):  # the second run replaces the table
        assert run_pipeline(spark, lake, log, config)["status"] == "success"
    failed = config | {"quality_checks": [{"type": "unique", "columns": ["id"], "severity": "error"}]}
    assert run_pipeline(spark, lake, log, failed)["status"] == "error"
    assert lake.read_staging(spark, "t").count() == repeated.count()
    assert not [label for label in labels if label.startswith("pending")]
    assert not list((tmp_path / "_pending").iterdir()) and len(list((tmp_path / "staging/default").iterdir())) == 1


def test_relationships_and_unknown_checks_in_pipelines(spark, people, repeated, tmp_path):
    lake, log = Lake(str(tmp_path)), RunLog(spark, str(tmp_path))
    lake.write_raw(people.where("id < 3"), "s", "t")
    lake.write_raw(repeated.where("id <> 2"), "s", "parents")
    config = {
        "name": "p", "source": {"layer": "raw", "domain": "s", "table": "t"},
        "destination": {"layer": "staging", "table": "t"},
        "references": {"parents": {"layer": "raw", "domain": "s", "table": "parents"}},
        "quality_checks": [
            {"type": "relationships", "column": "id", "to": "parents", "field": "id"}, {"type": "made_up"},
        ],
    }
    outcome = run_pipeline(spark, lake, log, config, quarantine=True)
    assert outcome["status"] == "success" and outcome["quality"][0]["failing_rows"] == 1
    assert [r["id"] for r in spark.read.parquet(str(tmp_path / "quarantine/p/0_relationships")).collect()] == [2]
    lost = run_pipeline(spark, lake, log, config | {"references": {}, "destination": {"layer": "staging", "table": "u"}})
    assert lost["status"] == "error" and not (tmp_path / "staging/default/u").exists()


def test_bytes_of_a_run_are_its_own(spark, people, tmp_path):
    lake, log = Lake(str(tmp_path / "lake")), RunLog(spark, str(tmp_path / "lake"))
    people.write.parquet(str(tmp_path / "in/a"))
    config = {"name": "s", "type": "parquet", "path": str(tmp_path / "in"), "tables": ["a"]}
    for _ in range(2):
        run_extraction(spark, lake, log, config)
    sizes = [r["bytes"] for r in log.read("extractions").collect()]
    assert len(sizes) == 2 and 0 < sizes[0] and abs(sizes[0] - sizes[1]) < 200


def test_empty_log(spark, tmp_path):
    assert RunLog(spark, str(tmp_path)).read("pipelines").count() == 0
