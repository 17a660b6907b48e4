from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quarry.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))

    return collect


@pytest.fixture
def people(spark):
    """The five-row customer table of the layer tests."""
    return spark.createDataFrame(
        [
            (1, "Alice", "alice@test.com", 100.0, "ACTIVO"),
            (2, "Bob", "bob@test.com", 200.0, "ACTIVO"),
            (3, "Charlie", None, 150.0, "INACTIVO"),
            (4, "Diana", "diana@test.com", 300.0, "ACTIVO"),
            (5, "Eve", "eve@test.com", 250.0, "DELETED"),
        ],
        "id bigint, nombre string, email string, total double, estado string",
    )


@pytest.fixture
def repeated(spark):
    """Five rows with one duplicate id and one missing name."""
    return spark.createDataFrame(
        [
            (1, "Alice", 100.0, "ACTIVO"),
            (2, "Bob", 200.0, "ACTIVO"),
            (2, "Bob", 200.0, "ACTIVO"),
            (3, None, 150.0, "INACTIVO"),
            (4, "Diana", 300.0, "DELETED"),
        ],
        "id int, nombre string, total double, estado string",
    )
