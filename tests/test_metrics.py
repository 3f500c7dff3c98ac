"""Derived metrics on hand-made rows, boundaries included."""

import hashlib

import pytest
from conftest import one, rows, ts

from tripflow.config import Thresholds
from tripflow.operators import enrich


def measured(trips, **change):
    return enrich.with_metrics(enrich.normalize(trips(change)))


def test_trip_id_is_sha256_of_the_key(trips):
    key = "yellow|2023-01-05 10:00:00|2023-01-05 10:30:00|10|20|20.0|yellow_tripdata_2023-01.parquet"
    assert one(enrich.with_trip_id(trips()), "trip_id") == hashlib.sha256(key.encode()).hexdigest()


def test_trip_id_treats_null_as_empty(trips):
    key = "yellow||2023-01-05 10:30:00||20||yellow_tripdata_2023-01.parquet"
    frame = trips({"pickup_datetime": None, "pickup_location_id": None, "fare_amount": None})
    assert one(enrich.with_trip_id(frame), "trip_id") == hashlib.sha256(key.encode()).hexdigest()


@pytest.mark.parametrize(
    "dropoff, minutes",
    [
        ("2023-01-05 10:00:00", 0.0),
        ("2023-01-05 10:00:00.900", 0.0),
        ("2023-01-05 18:00:00", 480.0),
        ("2023-01-05 18:00:01", 480.02),
        ("2023-01-05 09:40:00", -20.0),
        (None, None),
    ],
)
def test_duration(trips, dropoff, minutes):
    assert one(measured(trips, dropoff_datetime=ts(dropoff)), "trip_duration_minutes") == minutes


@pytest.mark.parametrize(
    "distance, dropoff, speed",
    [
        (5.0, "2023-01-05 10:30:00", 10.0),
        (50.0, "2023-01-05 10:30:00", 100.0),
        (0.0, "2023-01-05 10:30:00", None),
        (-1.0, "2023-01-05 10:30:00", None),
        (None, "2023-01-05 10:30:00", None),
        (5.0, "2023-01-05 10:00:00", None),
        (5.0, None, None),
    ],
)
def test_speed(trips, distance, dropoff, speed):
    frame = measured(trips, trip_distance=distance, dropoff_datetime=ts(dropoff))
    assert one(frame, "average_speed_mph") == speed


@pytest.mark.parametrize(
    "fare, distance, value", [(20.0, 3.0, 6.6667), (0.0, 3.0, 0.0), (None, 3.0, None), (20.0, 0.0, None), (-6.0, 3.0, -2.0)]
)
def test_fare_per_mile(trips, fare, distance, value):
    assert one(measured(trips, fare_amount=fare, trip_distance=distance), "fare_per_mile") == value


@pytest.mark.parametrize(
    "tip, fare, value", [(2.0, 20.0, 10.0), (None, 20.0, 0.0), (20.0, 20.0, 100.0), (1.0, 0.0, None), (1.0, -5.0, None), (1.0, None, None)]
)
def test_tip_percentage(trips, tip, fare, value):
    assert one(measured(trips, tip_amount=tip, fare_amount=fare), "tip_percentage") == value


@pytest.mark.parametrize(
    "pickup, dropoff, flag", [(1, 5, True), (5, 132, True), (138, 138, True), (5, 6, False), (None, 132, True), (None, 5, None)]
)
def test_airport(trips, pickup, dropoff, flag):
    frame = measured(trips, pickup_location_id=pickup, dropoff_location_id=dropoff)
    assert one(frame, "is_airport_trip") is flag


@pytest.mark.parametrize(
    "change, flag",
    [
        ({}, False),
        ({"trip_distance": 0.0}, True),
        ({"total_amount": 0.0}, True),
        ({"fare_amount": -0.01}, True),
        ({"dropoff_datetime": ts("2023-01-05 10:00:00")}, True),
        ({"dropoff_datetime": ts("2023-01-05 18:00:00")}, False),
        ({"dropoff_datetime": ts("2023-01-05 18:00:01")}, True),
        ({"trip_distance": 50.0}, False),
        ({"trip_distance": 50.01}, True),
        ({"tip_amount": 20.0}, False),
        ({"tip_amount": 20.01}, True),
        ({"trip_distance": None}, None),
        ({"trip_distance": None, "total_amount": -1.0}, True),
        ({"fare_amount": None}, None),
    ],
)
def test_suspicious_is_three_valued(trips, change, flag):
    assert one(measured(trips, **change), "is_suspicious_trip") is flag


def test_suspicious_limits_come_from_settings(trips):
    frame = enrich.with_metrics(enrich.normalize(trips()), Thresholds(max_speed=9))
    assert one(frame, "is_suspicious_trip") is True


def test_normalisation(trips):
    frame = enrich.normalize(
        trips({"store_and_fwd_flag": " n ", "quality_status": " pending ", "airport_fee": None, "year": 1999, "month": 9})
    )
    row = frame.first()
    assert (row.store_and_fwd_flag, row.quality_status) == ("N", "PENDING")
    assert (row.extra_amount, row.mta_tax, row.improvement_surcharge, row.congestion_surcharge, row.ehail_fee) == (0.0,) * 5
    assert row.airport_fee is None
    assert (row.year, row.month) == (2023, 1)


def test_dedup_keeps_first_ingested_then_a_fixed_order(trips):
    late = {"tip_amount": 9.0, "ingestion_timestamp": ts("2024-01-02 00:00:00")}
    frame = trips(late, {"tip_amount": 5.0}, {"tip_amount": 3.0}, {"source_file": "other.parquet"})
    kept = enrich.dedup_trips(enrich.normalize(frame))
    assert sorted(rows(kept, "tip_amount")) == [(2.0,), (3.0,)]
    shuffled = enrich.dedup_trips(enrich.normalize(frame.orderBy("tip_amount").repartition(3)))
    assert sorted(rows(shuffled)) == sorted(rows(kept))
    assert rows(enrich.dedup_stats(enrich.normalize(frame))) == [(4, 2, 2, 50.0)]


def test_dedup_stats_of_nothing(trips):
    assert rows(enrich.dedup_stats(enrich.normalize(trips().filter("false")))) == [(0, 0, 0, 0.0)]


def test_steps_chain(trips):
    frame = (
        trips()
        .transform(enrich.with_trip_id)
        .transform(enrich.with_trip_duration)
        .transform(enrich.with_average_speed)
        .transform(enrich.with_fare_per_mile)
        .transform(enrich.with_tip_percentage)
        .transform(enrich.with_airport_flag)
        .transform(enrich.with_suspicious_flag)
    )
    assert rows(frame, "trip_duration_minutes", "average_speed_mph", "fare_per_mile", "tip_percentage") == [
        (30.0, 10.0, 4.0, 10.0)
    ]
