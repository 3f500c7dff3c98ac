"""Derived trip metrics as Column builders (no UDF; all of it stays in generated code)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Thresholds
from ..contracts import AIRPORT_LOCATION_IDS, SUSPICIOUS_CONDITIONS, TRIP_KEY


def _key_text() -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TRIP_KEY])


def trip_id() -> Column:
    """SHA-256 of the '|'-joined business key; a NULL part counts as ''."""
    return F.sha2(_key_text(), 256)


def trip_place(shares: int) -> Column:
    """Number for service, month of pickup and one of `shares` shares, from the text that trip_id digests: equal ids, equal
    places. Places may share a number."""
    service_and_month = F.regexp_extract(_key_text(), r"(?s)^([^|]*\|[^|]{0,7})", 1)
    return F.xxhash64(service_and_month, F.pmod(F.xxhash64(_key_text()), F.lit(shares)))


def trip_duration_minutes() -> Column:
    """Minutes between whole-second pickup and dropoff; negative if they are swapped."""
    seconds = F.unix_seconds("dropoff_datetime") - F.unix_seconds("pickup_datetime")
    return F.round(seconds / 60.0, 2)


def average_speed_mph() -> Column:
    """Miles per hour from the rounded duration; NULL without a positive time and distance."""
    hours = F.col("trip_duration_minutes") / 60.0
    moving = (F.col("trip_duration_minutes") > 0) & (F.col("trip_distance") > 0)
    return F.round(F.when(moving, F.try_divide("trip_distance", hours)), 2)


def fare_per_mile() -> Column:
    """Fare per mile, four decimals; NULL without a positive distance."""
    ratio = F.when(F.col("trip_distance") > 0, F.try_divide("fare_amount", "trip_distance"))
    return F.round(ratio, 4)


def tip_percentage() -> Column:
    """Tip as a share of a positive fare, in percent; a NULL tip counts as zero."""
    tip = F.coalesce("tip_amount", F.lit(0.0))
    share = F.when(F.col("fare_amount") > 0, F.try_divide(tip, F.col("fare_amount")) * 100.0)
    return F.round(share, 2)


def is_airport_trip() -> Column:
    at_airport = [
        F.col(c).isin(*AIRPORT_LOCATION_IDS) for c in ("pickup_location_id", "dropoff_location_id")
    ]
    return at_airport[0] | at_airport[1]


def is_suspicious_trip(limits: Thresholds = Thresholds()) -> Column:
    """Three-valued: NULL when nothing is true and some operand is NULL."""
    tests = [F.expr(text.format(**limits.as_text())) for text in SUSPICIOUS_CONDITIONS]
    return reduce(Column.__or__, tests)
