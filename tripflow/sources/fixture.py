"""Trips derived from the driver's star-schema tables, one row per line item (see FIXTURES.md).

Test bridge only: it gives every query real table-sized input in the canonical trip model, with
NULLs, wrong orders, out-of-range values and exact copies in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C

# The columns used, declared so that no footer is read before the query runs.
LINE_DDL = (
    "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING"
)
ORDER_DDL = "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ"
INGESTED_AT = "2024-01-01 00:00:00"


def _null_every(n: int, value: Column) -> Column:
    return F.when(F.col("l_partkey") % n != 0, value)


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """How many line items there are, from the footers."""
    return spark.read.schema(LINE_DDL).parquet(f"{sf_dir}/lineitem.parquet").count()


def lines_with_orders(spark: SparkSession, sf_dir: str, by_delivery: bool = False) -> DataFrame:
    """The line items that trips are made of, with the feed and the delivery of their order; some arrive twice.

    No wider than what trips are derived from, so this is what to store; by_delivery lays it out by feed and month, for
    deliveries: without the lines of orders that no customer, so no feed, is known of.
    """
    lines = spark.read.schema(LINE_DDL).parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.schema(ORDER_DDL).parquet(f"{sf_dir}/orders.parquet")
    # two fact tables: a merge join at every scale, whose skewed keys adaptive execution splits
    joined = lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)
    if by_delivery:
        joined = joined.filter("o_custkey IS NOT NULL")
    used = [c for c in lines.columns if c != "l_orderkey"]
    found = joined.select(
        *used,
        F.element_at(F.array(*[F.lit(s) for s in C.SERVICES]), (F.col("o_custkey") % 3 + 1).cast("int")).alias(
            "service_type"
        ),
        F.expr("o_orderdate + INTERVAL 24 YEARS").alias("base_ts"),
        F.explode(
            F.when((F.col("l_orderkey") % 97 == 0) & (F.col("l_linenumber") == 1), F.array(F.lit(1), F.lit(2))).otherwise(
                F.array(F.lit(1))
            )
        ).alias("copy"),
    ).drop("copy")
    source_file = F.concat("service_type", F.lit("_tripdata_"), F.substring(F.col("base_ts").cast("string"), 1, 7), F.lit(".parquet"))
    found = found.withColumn("source_file", source_file)
    return found.hint("rebalance", "service_type", "source_file") if by_delivery else found


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical bronze trips (27 columns) over lineitem and orders."""
    return derive(lines_with_orders(spark, sf_dir))


def derive(lines: DataFrame) -> DataFrame:
    """The trips of lines_with_orders; map-only."""
    part, supp, number = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    fare = F.floor(F.col("l_extendedprice") / 10) / 100.0 - 1
    tip = F.floor(F.col("l_discount") * F.col("l_extendedprice") / 80 * 100) / 100.0
    tolls = F.floor(F.col("l_tax") * 1000) / 100.0
    based = lines.withColumn("start_ts", F.expr("timestampadd(MINUTE, l_partkey % 1440, base_ts)"))
    end_ts = F.expr("timestampadd(MINUTE, (l_suppkey * 7 + l_partkey) % 520 - 20, start_ts)")
    pickup = _null_every(211, F.col("start_ts").cast("timestamp"))
    pickup_zone = _null_every(227, part % 265 + 1)
    green = F.col("service_type") == "green"
    columns = {
        "service_type": F.col("service_type"),
        "vendor_id": supp.cast("string"),
        "pickup_datetime": pickup,
        "dropoff_datetime": _null_every(223, end_ts.cast("timestamp")),
        "passenger_count": (number + part % 4).cast("double"),
        "trip_distance": (F.col("l_quantity") - 2) * 0.5,
        "pickup_location_id": pickup_zone,
        "dropoff_location_id": _null_every(229, supp * 3 % 265 + 1),
        "rate_code_id": (number % 6 + 1).cast("double"),
        "store_and_fwd_flag": F.when(F.col("l_returnflag") == "N", " n ").when(F.col("l_returnflag") == "A", "y"),
        "payment_type": number.cast("long"),
        "fare_amount": _null_every(233, fare),
        "extra_amount": F.when(F.col("l_linestatus") != "O", 1.0),
        "mta_tax": F.lit(0.5),
        "tip_amount": tip,
        "tolls_amount": tolls,
        "improvement_surcharge": F.lit(0.3),
        "total_amount": _null_every(
            239, F.when(part % 241 == 0, F.lit(0.0)).otherwise(F.round(fare + tip + tolls, 2))
        ),
        "congestion_surcharge": _null_every(3, F.lit(2.5)),
        "airport_fee": F.when(pickup_zone.isin(*C.AIRPORT_LOCATION_IDS), 1.25),
        "ehail_fee": F.lit(None).cast("double"),
        "trip_type": F.when(green, 1.0),
        "year": F.year(pickup),
        "month": F.month(pickup),
        "source_file": F.col("source_file"),
        "ingestion_timestamp": F.lit(INGESTED_AT).cast("timestamp"),
        "quality_status": F.lit(" pending "),
    }
    return based.select(*[columns[f.name].alias(f.name) for f in C.CANONICAL_SCHEMA if f.name != "trip_id"])




def raw_feed(bronze: DataFrame, service: str) -> DataFrame:
    """The fixture's trips of one service under that feed's own column names and types."""
    rows = bronze.filter(F.col("service_type") == service)
    columns = []
    for spec in C.feed_contract(service):
        dtype = {"long": "bigint"}.get(spec["type"], spec["type"])
        if spec["canonical"]:
            value = F.col(spec["canonical"])
        elif spec["name"] == "bcf":
            value = F.lit(0.1)
        else:
            value = F.lit(None)
        columns.append(value.cast(dtype).alias(spec["name"]))
    return rows.select(*columns, "source_file", "ingestion_timestamp")
