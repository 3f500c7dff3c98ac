"""Rules, evidence, metrics and the gate."""

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from tripflow.config import Thresholds
from tripflow.operators import enrich, marts, quality

RULES = quality.rejection_rules()

CASES = [
    ({}, []),
    ({"pickup_datetime": None, "year": None, "month": None}, ["BR-001"]),
    ({"dropoff_datetime": None}, ["BR-002"]),
    ({"pickup_location_id": None}, ["BR-003"]),
    ({"dropoff_location_id": None}, ["BR-004"]),
    ({"fare_amount": None}, ["BR-014"]),
    ({"total_amount": None}, ["BR-015"]),
    ({"dropoff_datetime": ts("2023-01-05 10:00:00")}, ["BR-005", "BR-010"]),
    ({"dropoff_datetime": ts("2023-01-05 10:00:00.500")}, ["BR-010"]),
    ({"dropoff_datetime": ts("2023-01-05 18:00:00")}, []),
    ({"dropoff_datetime": ts("2023-01-05 18:00:01")}, ["BR-010"]),
    ({"pickup_datetime": ts("2017-12-31 10:00:00"), "dropoff_datetime": ts("2017-12-31 10:10:00")}, ["BR-006"]),
    ({"pickup_datetime": ts("2018-01-01 10:00:00"), "dropoff_datetime": ts("2018-01-01 10:10:00")}, []),
    ({"pickup_datetime": ts("2024-12-31 10:00:00"), "dropoff_datetime": ts("2024-12-31 10:10:00")}, []),
    ({"pickup_datetime": ts("2025-01-01 10:00:00"), "dropoff_datetime": ts("2025-01-01 10:10:00")}, ["BR-006"]),
    ({"fare_amount": -0.01}, ["BR-007"]),
    ({"fare_amount": 0.0}, []),
    ({"total_amount": 0.0}, ["BR-008"]),
    ({"trip_distance": 0.0}, []),
    ({"trip_distance": 500.0}, []),
    ({"tip_amount": 500.0}, []),
    ({"fare_amount": -5.0, "total_amount": -5.0, "pickup_location_id": None}, ["BR-003", "BR-007", "BR-008"]),
]


@pytest.fixture
def silver(trips):
    return lambda *changes: enrich.to_silver(trips(*changes))


def test_each_rule_and_its_boundaries(silver):
    changes = [{**c, "source_file": str(i)} for i, (c, _) in enumerate(CASES)]
    frame = silver(*changes)
    valid, evidence = quality.split(frame, RULES, "P")
    broken = {}
    for source, rule in rows(evidence, "source_file", "rejection_rule_id"):
        broken.setdefault(int(source), []).append(rule)
    for i, (change, expected) in enumerate(CASES):
        assert sorted(broken.get(i, [])) == expected, change
    kept = {int(s) for (s,) in rows(valid, "source_file")}
    assert kept == {i for i, (_, expected) in enumerate(CASES) if not expected}


def test_evidence_content(silver):
    frame = silver({"fare_amount": None, "total_amount": -1.5})
    found = {r.rejection_rule_id: r for r in quality.rejected_records(frame, RULES, "P", F.lit(None).cast("timestamp")).collect()}
    assert found["BR-014"].original_value == "NULL"
    assert found["BR-014"].technical_reason == "IS NULL"
    assert found["BR-008"].original_value == "-1.5"
    assert found["BR-008"].process_id == "P"
    assert found["BR-008"].rejection_category == "INVALID_AMOUNT"


def test_limits_appear_in_rules_and_texts(silver):
    strict = quality.rejection_rules(Thresholds(max_duration=20, year_max=2022))
    found = {r.rejection_rule_id: r for r in quality.rejected_records(silver({}), strict, "P").collect()}
    assert set(found) == {"BR-006", "BR-010"}
    assert found["BR-010"].technical_reason == "trip_duration_minutes <= 0 OR > 20"
    assert found["BR-006"].technical_reason == "year < 2018 OR year > 2022"


def test_status_only_true_is_suspicious(silver):
    frame = silver({"source_file": "a"}, {"source_file": "b", "trip_distance": 0.0}, {"source_file": "c", "trip_distance": None})
    status = dict(rows(quality.valid_trips(frame, RULES), "source_file", "quality_status"))
    assert status == {"a": "VALID", "b": "SUSPICIOUS", "c": "VALID"}


def test_metrics_repeat_the_service_evidence(silver):
    frame = silver(
        {"source_file": "a"},
        {"source_file": "b", "pickup_datetime": ts("2023-02-01 00:00:00"), "dropoff_datetime": ts("2023-02-01 00:10:00")},
        {"source_file": "c", "fare_amount": -1.0, "total_amount": -1.0},
        {"source_file": "d", "service_type": "green", "trip_distance": 0.0},
    )
    columns = ("service_type", "month", "total_records", "valid_records", "rejected_records", "suspicious_records", "quality_percentage")
    expected = [("green", 1, 1, 1, 0, 1, 100.0), ("yellow", 1, 3, 1, 2, 0, 33.33), ("yellow", 2, 3, 1, 2, 0, 33.33)]
    assert sorted(rows(quality.quality_metrics(frame, RULES, "P"), *columns)) == expected
    valid, evidence = quality.split(frame, RULES, "P")
    assert sorted(rows(quality.quality_metrics_from(valid, evidence, "P"), *columns)) == expected


def test_corrected_metrics_count_trips_once(trips):
    keyed = enrich.normalize(
        trips({"source_file": "a"}, {"source_file": "a"}, {"source_file": "b", "fare_amount": -1.0, "total_amount": -1.0},
              {"source_file": "c", "pickup_datetime": None, "year": None, "month": None})
    )
    silver = enrich.with_metrics(enrich.survivors(keyed))
    found = {(r.year, r.month): r for r in quality.quality_metrics_by_period(silver, RULES).collect()}
    january, undated = found[2023, 1], found[None, None]
    assert (january.input_records, january.duplicate_records, january.valid_records, january.rejected_records) == (3, 1, 1, 1)
    assert (undated.total_records, undated.null_critical_records, undated.quality_percentage) == (1, 1, 0.0)


def test_gate(silver):
    frame = silver({"source_file": "a"}, {"source_file": "b", "fare_amount": -1.0})
    assert rows(quality.rejection_rate_gate(frame, RULES, Thresholds(max_rejection_pct=49.9)), "rejection_pct", "within_limit") == [(50.0, False)]
    assert rows(quality.rejection_rate_gate(frame, RULES), "within_limit") == [(True,)]


def test_opt_in_rules_are_off_by_default(silver):
    frame = silver({"payment_type": 9, "passenger_count": 12.0})
    assert quality.rejected_records(frame, RULES, "P").count() == 0
    chosen = quality.rejection_rules(opt_in=("CFG-PAYMENT", "CFG-PASSENGERS"))
    assert sorted(rows(quality.rejected_records(frame, chosen, "P"), "rejection_rule_id")) == [("CFG-PASSENGERS",), ("CFG-PAYMENT",)]


def test_declared_minima(silver):
    minima = tuple(f"CFG-MIN-{name}" for name in ("DURATION", "FARE", "TOTAL", "DISTANCE"))
    frame = silver({"fare_amount": 2.0, "trip_distance": 0.5}, {"fare_amount": None, "total_amount": 3.0})

    def found(limits):
        chosen = tuple(r for r in quality.rejection_rules(limits, minima) if r.rule_id in minima)
        return sorted(rows(quality.rejected_records(frame, chosen, "P"), "rejection_rule_id", "original_value"))

    assert found(Thresholds()) == []
    # at the minimum a trip stays, and a value that is missing breaks nothing
    assert found(Thresholds(min_fare=2.0, min_distance=1.0, min_total=10.0)) == [("CFG-MIN-DISTANCE", "0.5"), ("CFG-MIN-TOTAL", "3.0")]


def test_catalogue_lists_every_rule(spark):
    found = {r.rule_id: r.action for r in quality.rule_catalogue(spark).collect()}
    assert {k for k, v in found.items() if v == "REJECT"} == {r.rule_id for r in RULES}
    assert found["BR-013"] == "DEDUPLICATE" and found["BR-009"] == "MARK_SUSPICIOUS"
    assert len([k for k in found if k.startswith("BR-")]) == 15


def test_marts_by_hand(silver):
    frame = silver(
        {"source_file": "a", "fare_amount": 10.0, "total_amount": 12.35},
        {"source_file": "b", "fare_amount": 20.01, "total_amount": 22.0, "trip_distance": 0.0},
        {"source_file": "c", "pickup_location_id": 11},
    )
    gold = marts.gold_trips_clean(quality.valid_trips(frame, RULES))
    assert len(gold.columns) == 22
    (day,) = marts.gold_daily_revenue(gold).collect()
    assert (day.total_trips, day.total_revenue, day.average_fare, day.suspicious_trips, day.quality_percentage) == (3, 56.35, 16.67, 1, 66.67)
    pairs = {r.pickup_location_id: r for r in marts.gold_location_performance(gold).collect()}
    assert (pairs[10].total_trips, pairs[10].average_speed_mph, pairs[10].suspicious_trip_count) == (2, 10.0, 1)
    assert marts.gold_location_performance(gold, min_trips=2).count() == 1
