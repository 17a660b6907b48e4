"""CSV files: one file, a list or a glob, with delimiter, header, encoding and skipped lines."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.casts import try_text
from quarry.session import materialise
from quarry.sources.csv_records import QUOTE, file_headers, has_broken_lines, read_by_header

# Narrowest first; text is the fallback.
CANDIDATES = ("int", "bigint", "double", "date", "timestamp_ntz", "boolean")


def resolve_path(config: dict, table: str) -> str | list[str]:
    """The path configured for a table, else the path of the source."""
    for entry in config.get("tables", []):
        if isinstance(entry, dict) and entry.get("name") == table:
            return entry["path"]
    if not config.get("path"):
        raise FileNotFoundError(f"source {config.get('name')!r} has no path for {table!r}")
    return config["path"]


def read_csv_source(
    spark: SparkSession, config: dict, table: str, last_value: str | None = None
) -> DataFrame:
    options = config.get("connection", {})
    return read_csv(
        spark,
        resolve_path(config, table),
        delimiter=options.get("delimiter", ","),
        header=options.get("header", True),
        encoding=options.get("encoding", "utf-8"),
        skip_rows=options.get("skip_rows", 0),
        schema=options.get("schema"),
        multi_line=options.get("multi_line"),
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    header: bool = True,
    encoding: str = "utf-8",
    skip_rows: int = 0,
    schema: str | None = None,
    sampling_ratio: float = 1.0,
    multi_line: bool | None = None,
) -> DataFrame:
    """Read CSV with inferred types, or with a DDL schema, which saves the inference pass.

    With a header, columns are matched by each file's own header, with a schema too: its columns are taken by name,
    in its types, NULL where a file lacks one or a value has no such type. Without a header they go by position.
    A quote within a quoted value is doubled. Quoted values may span lines; whether any does is found out by a pass over the lines, which ``multi_line``
    (True or False) saves. Such files are read in splits like others. ``skip_rows`` leading lines of each file are dropped.
    """
    try:
        broken = has_broken_lines(spark, path, encoding) if multi_line is None else multi_line
        reader = spark.read.options(sep=delimiter, header=header, encoding=encoding, escape=QUOTE)
        kinds = []
        if header and not skip_rows and not broken:
            headers = file_headers(spark, path, delimiter, encoding)
            kinds = headers.select("names").distinct().limit(2).collect()
        if skip_rows or broken or len(kinds) > 1:
            text = read_by_header(spark, path, delimiter, header, encoding, skip_rows, broken)
            if schema:
                return with_types(text, schema, header)
            if not text.columns:
                return text
            # lines are brought together by shuffles, which the passes over types and values would both do
            return narrow_text(materialise(text, "csv-records") if broken else text, sampling_ratio)
        if schema and header and kinds:
            # the parser reads by position: types in the order of the header, then columns by name
            wanted = {f.name: f for f in T.StructType.fromDDL(schema)}
            stored = [wanted.get(n, T.StructField(n, T.StringType())) for n in kinds[0]["names"]]
            found = reader.schema(T.StructType(stored)).csv(path)
            return found.select(
                *[
                    F.col(f"`{n}`") if n in found.columns else F.lit(None).cast(f.dataType).alias(n)
                    for n, f in wanted.items()
                ]
            )
        if schema:
            return reader.schema(schema).csv(path)
        return wall_clock(reader.options(inferSchema=True, samplingRatio=sampling_ratio).csv(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no CSV files found: {path}") from error
        raise


def with_types(text: DataFrame, schema: str, by_name: bool) -> DataFrame:
    """Text columns in the types of a schema, by name or by position."""
    fields = T.StructType.fromDDL(schema)
    columns = []
    for i, f in enumerate(fields):
        source = f.name if by_name else f"_c{i}"
        value = F.col(f"`{source}`").try_cast(f.dataType) if source in text.columns else F.lit(None).cast(f.dataType)
        columns.append(value.alias(f.name))
    return text.select(*columns)


def wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps found in text carry no zone."""
    found = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in found})


def csv_schema(spark: SparkSession, config: dict, table: str) -> dict[str, str]:
    df = read_csv_source(spark, config, table)
    return {f.name: f.dataType.simpleString() for f in df.schema}


def narrow_text(df: DataFrame, sampling_ratio: float = 1.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """Give every text column the narrowest type that all its values fit, in one pass."""
    sample = df if sampling_ratio >= 1.0 else df.sample(sampling_ratio, seed=0)
    tests = []
    for c in (c for c in df.columns if c not in keep):
        tests.append(F.count(F.col(f"`{c}`")).alias(f"{c}|values"))
        for t in CANDIDATES:
            misfit = F.col(f"`{c}`").isNotNull() & try_text(F.col(f"`{c}`"), t).isNull()
            tests.append(F.count_if(misfit).alias(f"{c}|{t}"))
    found = sample.agg(*tests).first().asDict()
    selected = []
    for c in df.columns:
        if c in keep:
            selected.append(F.col(f"`{c}`"))
            continue
        fits = [t for t in CANDIDATES if found[f"{c}|{t}"] == 0]
        wanted = fits[0] if fits and found[f"{c}|values"] else "string"
        selected.append(F.col(f"`{c}`").cast(wanted).alias(c))
    return df.select(*selected)
