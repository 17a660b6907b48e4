"""Run metadata: three append-only Parquet tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.folder import has_files

EXTRACTIONS = (
    "source string, table_name string, logged_at timestamp_ntz, rows bigint, path string,"
    " bytes bigint, status string, error string, duration double, high_water_mark string"
)
PIPELINES = (
    "pipeline string, logged_at timestamp_ntz, rows bigint, path string, status string,"
    " error string, duration double"
)
QUALITY = (
    "pipeline string, logged_at timestamp_ntz, position int, check string, columns string,"
    " failing_rows bigint, passed boolean, details string, severity string"
)
_TABLES = {"extractions": EXTRACTIONS, "pipelines": PIPELINES, "quality": QUALITY}


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class RunLog:
    spark: SparkSession
    root: str

    def _path(self, table: str) -> str:
        return f"{self.root}/run_log/{table}"

    def _append(self, table: str, row: dict) -> None:
        frame = self.spark.createDataFrame([row], _TABLES[table])
        frame.coalesce(1).write.mode("append").parquet(self._path(table))

    def read(self, table: str) -> DataFrame:
        """extractions, pipelines or quality; empty when nothing was logged yet."""
        schema = _TABLES[table]
        if not has_files(self.spark, self._path(table)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(table))

    def log_extraction(
        self, source: str, table: str, rows: int, path: str, status: str, size: int = 0,
        duration: float = 0.0, error: str | None = None, high_water_mark: str | None = None,
    ) -> None:
        self._append(
            "extractions",
            {
                "source": source, "table_name": table, "logged_at": _now(), "rows": rows,
                "path": path, "bytes": size, "status": status, "error": error,
                "duration": duration, "high_water_mark": high_water_mark,
            },
        )

    def log_pipeline(
        self, pipeline: str, rows: int, path: str, status: str, duration: float = 0.0,
        error: str | None = None,
    ) -> None:
        self._append(
            "pipelines",
            {
                "pipeline": pipeline, "logged_at": _now(), "rows": rows, "path": path,
                "status": status, "error": error, "duration": duration,
            },
        )

    def log_quality(self, pipeline: str, results: DataFrame) -> None:
        """Append the result rows of ``run_checks``."""
        stamped = results.select(
            F.lit(pipeline).alias("pipeline"), F.lit(_now()).cast("timestamp_ntz").alias("logged_at"),
            "position", "check", "columns", "failing_rows", "passed", "details", "severity",
        )
        stamped.coalesce(1).write.mode("append").parquet(self._path("quality"))

    def latest_extractions(self) -> DataFrame:
        """Per table: time of the last success, and the largest key extracted so far."""
        done = self.read("extractions").where("status = 'success'")
        return done.groupBy("source", "table_name").agg(
            F.max("logged_at").alias("logged_at"),
            F.max_by("high_water_mark", F.when(F.col("high_water_mark").isNotNull(), F.col("logged_at"))).alias(
                "high_water_mark"
            ),
        )

    def last_extraction(self, source: str, table: str) -> dict | None:
        row = (
            self.latest_extractions()
            .where((F.col("source") == source) & (F.col("table_name") == table))
            .first()
        )
        return row.asDict() if row else None

    def recent(self, table: str, limit: int = 10) -> DataFrame:
        return self.read(table).orderBy(F.col("logged_at").desc()).limit(limit)
