"""Bronze to silver: normalisation, trip key, deduplication, derived metrics.

The derived metrics depend on one row only, so they need not exist before duplicates are removed;
computed after it, they keep six columns out of the deduplication shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Thresholds
from ..contracts import CANONICAL_SCHEMA, OPTIONAL_AMOUNTS, TRIP_KEY
from ..functions import trips
from ..functions.amounts import percentage


def _strings(df: DataFrame) -> dict[str, Column]:
    present = [c for c in ("store_and_fwd_flag", "quality_status") if c in df.columns]
    return {c: F.upper(F.trim(F.col(c))) for c in present}


def _amounts(df: DataFrame) -> dict[str, Column]:
    return {c: F.coalesce(F.col(c), F.lit(0.0)) for c in OPTIONAL_AMOUNTS if c in df.columns}


def _period() -> dict[str, Column]:
    return {"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")}


def normalize_strings(df: DataFrame) -> DataFrame:
    return df.withColumns(_strings(df))


def normalize_amounts(df: DataFrame) -> DataFrame:
    """Optional amounts: NULL becomes 0.0. Fares, totals and airport fees keep their NULLs."""
    return df.withColumns(_amounts(df))


def recompute_partitions(df: DataFrame) -> DataFrame:
    """Year and month from the pickup itself, whatever month the file was delivered for."""
    return df.withColumns(_period())


def with_trip_id(df: DataFrame) -> DataFrame:
    return df.withColumn("trip_id", trips.trip_id())


def normalize(df: DataFrame) -> DataFrame:
    """All row-local clean-up and the trip key, whose parts it leaves alone, in one projection."""
    return df.withColumns({**_strings(df), **_amounts(df), **_period(), "trip_id": trips.trip_id()})


def _keep_order(columns: list[str]) -> list[str]:
    """First ingested wins; the other columns make the choice a function of the data alone."""
    made_of_key = {"trip_id", "ingestion_timestamp", "year", "month", *TRIP_KEY}
    rest = [f.name for f in CANONICAL_SCHEMA if f.name in columns and f.name not in made_of_key]
    lead = [c for c in ("trip_distance", "tip_amount", "tolls_amount", "payment_type", "total_amount") if c in rest]
    return ["ingestion_timestamp", *lead, *[c for c in rest if c not in lead]]


def _in_keep_order(df: DataFrame) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in _keep_order(df.columns)]


def dedup_trips(df: DataFrame) -> DataFrame:
    """One row per trip_id.

    `row_number() = 1` lets Spark keep one row per key inside each map task before the shuffle
    (WindowGroupLimit), so a key with very many copies never reaches one task as a whole.
    """
    by_trip = Window.partitionBy("trip_id").orderBy(*_in_keep_order(df))
    return df.withColumn("_n", F.row_number().over(by_trip)).filter("_n = 1").drop("_n")


#: Rows of the input for which each period gets one more share, a part of its trips with a task and files of its own. A
#: period that holds all the input so has about this many rows a task; more shares are more files.
ROWS_PER_SHARE = 20_000_000


def dedup_by_period(bronze: DataFrame, records: int) -> DataFrame:
    """The rows of dedup_trips over normalize, each period in a few tasks, so that it is written without another shuffle.

    `records` is how many rows there are, more or less: only the layout depends on it. Copies of a trip share their place. Rows are shuffled once, without the trip id (its hex digits are a third of a row) and
    without what else the key gives; copies are dropped behind that shuffle.
    """
    place = trips.trip_place(1 + records // ROWS_PER_SHARE)
    cleaned = bronze.withColumns({**_strings(bronze), **_amounts(bronze), "_place": place})
    placed = cleaned.drop("trip_id", "year", "month").repartition("_place")
    rest = placed.withColumns({**_period(), "trip_id": trips.trip_id()})
    by_trip = Window.partitionBy("_place", "trip_id").orderBy(*_in_keep_order(rest))
    kept = rest.withColumn("_n", F.row_number().over(by_trip)).filter("_n = 1")
    return kept.select(*normalize(bronze).columns)


def survivors(df: DataFrame) -> DataFrame:
    """The rows of dedup_trips, each with `copies`, how many rows its trip_id arrived in.

    One keyed aggregate: the row is the least struct in the order of dedup_trips, and both it and the count are
    combined map-side, so what needs survivors and duplicates scans and shuffles the trips once.
    """
    order = _keep_order(df.columns)
    row = F.struct(*order, *[c for c in df.columns if c not in (*order, "trip_id")])
    kept = df.groupBy("trip_id").agg(F.min(row).alias("row"), F.count(F.lit(1)).alias("copies"))
    return kept.select(*[F.col("trip_id") if c == "trip_id" else F.col(f"row.{c}").alias(c) for c in df.columns], "copies")


def dedup_stats(df: DataFrame) -> DataFrame:
    """Rows before and after deduplication, from counts per key (combined map-side)."""
    per_trip = df.groupBy("trip_id").agg(F.count("*").alias("n"))
    return per_trip.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after")
    ).select(
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("duplicates_removed"),
        percentage(F.col("rows_before") - F.col("rows_after"), F.col("rows_before")).alias("duplicate_pct"),
    )


def with_trip_duration(df: DataFrame) -> DataFrame:
    return df.withColumn("trip_duration_minutes", trips.trip_duration_minutes())


def with_average_speed(df: DataFrame) -> DataFrame:
    return df.withColumn("average_speed_mph", trips.average_speed_mph())


def with_fare_per_mile(df: DataFrame) -> DataFrame:
    return df.withColumn("fare_per_mile", trips.fare_per_mile())


def with_tip_percentage(df: DataFrame) -> DataFrame:
    return df.withColumn("tip_percentage", trips.tip_percentage())


def with_airport_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_airport_trip", trips.is_airport_trip())


def with_suspicious_flag(df: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    return df.withColumn("is_suspicious_trip", trips.is_suspicious_trip(limits))


def with_metrics(df: DataFrame, limits: Thresholds = Thresholds(), **more: Column) -> DataFrame:
    """Derived metrics in three projections, each using only columns of the one before."""
    return (
        df.transform(with_trip_duration)
        .withColumns(
            {
                "average_speed_mph": trips.average_speed_mph(),
                "fare_per_mile": trips.fare_per_mile(),
                "tip_percentage": trips.tip_percentage(),
                "is_airport_trip": trips.is_airport_trip(),
                **more,
            }
        )
        .transform(lambda d: with_suspicious_flag(d, limits))
    )


def to_silver(
    bronze: DataFrame, limits: Thresholds = Thresholds(), processing_date: Column | None = None, records: int | None = None
) -> DataFrame:
    """The whole enrichment. `processing_date` defaults to today. Given the number of `records`, the rows come in the layout
    of the layer, by period."""
    day = F.current_date() if processing_date is None else processing_date
    kept = bronze.transform(normalize).transform(dedup_trips) if records is None else dedup_by_period(bronze, records)
    return with_metrics(kept, limits, processing_date=day)


def to_silver_with_copies(
    bronze: DataFrame, limits: Thresholds = Thresholds(), processing_date: Column | None = None
) -> DataFrame:
    """The rows of to_silver with `copies`, from one pass over bronze."""
    day = F.current_date() if processing_date is None else processing_date
    return with_metrics(bronze.transform(normalize).transform(survivors), limits, processing_date=day)
