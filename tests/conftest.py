import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from tripflow import get_spark  # noqa: E402
from tripflow.contracts import CANONICAL_SCHEMA  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = get_spark(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text):
    return datetime.fromisoformat(text) if text else None


# A trip that breaks no rule and is not suspicious.
GOOD = {
    "service_type": "yellow",
    "vendor_id": "1",
    "pickup_datetime": ts("2023-01-05 10:00:00"),
    "dropoff_datetime": ts("2023-01-05 10:30:00"),
    "passenger_count": 1.0,
    "trip_distance": 5.0,
    "pickup_location_id": 10,
    "dropoff_location_id": 20,
    "payment_type": 1,
    "fare_amount": 20.0,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "total_amount": 22.0,
    "year": 2023,
    "month": 1,
    "source_file": "yellow_tripdata_2023-01.parquet",
    "ingestion_timestamp": ts("2024-01-01 00:00:00"),
    "quality_status": "PENDING",
}


@pytest.fixture
def trips(spark):
    """Build canonical bronze trips from changes to a good one."""
    fields = [f for f in CANONICAL_SCHEMA if f.name != "trip_id"]
    schema = type(CANONICAL_SCHEMA)(fields)

    def build(*changes):
        rows = []
        for change in changes or ({},):
            row = {**GOOD, **change}
            if row["pickup_datetime"] is not None and "year" not in change:
                row["year"], row["month"] = row["pickup_datetime"].year, row["pickup_datetime"].month
            rows.append(tuple(row.get(f.name) for f in fields))
        return spark.createDataFrame(rows, schema)

    return build


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def rows(df, *columns):
    frame = df.select(*columns) if columns else df
    return [tuple(r) for r in frame.collect()]


def one(df, column):
    return df.select(F.col(column)).first()[0]
