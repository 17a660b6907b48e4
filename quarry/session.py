"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None
# The compression of large scratch tables (digests in hexadecimal, which snappy leaves as they are, take
# half), and Spark's setting for shuffle files that go with the action that wrote them.
SCRATCH_CODEC = "zstd"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "quarry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; cluster sizing stays with the submitter."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # rather one more shuffle than one task with a hot key
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # call sites are only used in error messages; recording them slows plan building
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session without that setting falls back to a temporary folder.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        _local_scratch = _local_scratch or tempfile.mkdtemp(prefix="quarry-")
        base = _local_scratch
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared scratch folder and read it back.

    For results that are read several times: computed once, and a lost executor costs nothing.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Scratch:
    """Results in the shared scratch folder for as long as a job reads them, by name; the end of the job drops the rest."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: dict[str, str] = {}

    def materialise(self, df: DataFrame, label: str) -> DataFrame:
        path = self._paths[label] = scratch_path(self._spark, label)
        df.write.option("compression", SCRATCH_CODEC).parquet(path)
        return self._spark.read.parquet(path)

    def drop(self, *labels: str) -> None:
        for label in labels:
            path = self._spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop(label))
            path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop(*list(self._paths))


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of an action are deleted when the action ends.

    Otherwise they lie on the executors' disks until the driver collects its garbage, which a job of many actions may
    not live to see. A frame that ran before and is run again shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
