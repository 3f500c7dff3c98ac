"""Physical plans: what reaches the scan, what shuffles, and that hot keys stay small."""

import re

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tripflow.operators import enrich, marts, quality
from tripflow.plans import registry, reports
from tripflow.sources.layers import write_layer

RULES = quality.rejection_rules()


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    bronze = registry.Flow(spark, "/root/testdata/sf0.001").bronze()
    write_layer(bronze, root + "/bronze", ("service_type", "year", "month"), cluster=True)
    stored = spark.read.parquet(root + "/bronze")
    write_layer(enrich.to_silver(stored), root + "/silver", ("service_type", "year", "month"), cluster=True)
    return stored, spark.read.parquet(root + "/silver")


def nodes(df, name):
    return len(re.findall(rf"^\(\d+\) {name}", plan_of(df), re.M))


def test_dedup_limits_each_key_before_the_shuffle(layers):
    bronze, _ = layers
    plan = plan_of(enrich.dedup_trips(enrich.normalize(bronze)))
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan
    assert nodes(enrich.dedup_trips(enrich.normalize(bronze)), "Exchange") == 1


def test_survivors_and_copies_are_one_pass(spark, layers):
    bronze, _ = layers
    keyed = enrich.normalize(bronze)
    counted = enrich.survivors(keyed)
    assert nodes(counted, "Exchange") == nodes(counted, "Scan parquet") == 1 and "partial_min" in plan_of(counted)
    assert counted.drop("copies").exceptAll(enrich.dedup_trips(keyed)).count() == 0
    assert (counted.count(), counted.agg(F.sum("copies")).first()[0]) == (enrich.dedup_trips(keyed).count(), bronze.count())
    for name in ("quality_metrics_by_period", "phase_counters", "survivors"):
        plan = plan_of(registry.queries()[name](spark, "/root/testdata/sf0.001"))
        assert len(re.findall(r"^Location: .*lineitem", plan, re.M)) == 1


def test_a_trip_with_very_many_copies(layers, spark):
    bronze, _ = layers
    copies = bronze.filter(F.col("pickup_datetime").isNotNull()).limit(1).withColumn(
        "n", F.explode(F.sequence(F.lit(1), F.lit(200_000)))
    ).drop("n").repartition(8)
    assert enrich.dedup_trips(enrich.normalize(copies)).count() == 1
    assert [r.copies for r in enrich.survivors(enrich.normalize(copies)).collect()] == [200_000]


def test_evidence_is_one_scan_without_shuffle(layers):
    _, silver = layers
    evidence = quality.rejected_records(silver, RULES, "P")
    assert nodes(evidence, "Scan parquet") == 1
    assert nodes(evidence, "Exchange") == 0


def test_gold_trips_need_no_shuffle_and_push_null_checks(layers):
    _, silver = layers
    gold = marts.gold_trips_clean(quality.valid_trips(silver, RULES))
    plan = plan_of(gold)
    assert nodes(gold, "Exchange") == 0
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    for column in ("pickup_datetime", "dropoff_datetime", "pickup_location_id", "fare_amount", "total_amount"):
        assert f"IsNotNull({column})" in pushed
    assert "vendor_id" not in re.search(r"ReadSchema: (.*)", plan).group(1)


def test_marts_read_their_columns_and_shuffle_once(layers):
    _, silver = layers
    for mart in (marts.gold_daily_revenue, marts.gold_location_performance):
        frame = mart(marts.gold_trips_clean(quality.valid_trips(silver, RULES)))
        assert nodes(frame, "Exchange") == 1
        assert nodes(frame, "Scan parquet") == 1
        assert "trip_id" not in re.search(r"ReadSchema: (.*)", plan_of(frame)).group(1)


def test_partition_pruning(layers):
    _, silver = layers
    sample = silver.filter("service_type = 'yellow' AND year = 2023").select("pickup_datetime", "total_amount")
    plan = plan_of(sample)
    assert re.search(r"PartitionFilters: \[.*service_type.*= yellow.*year.*= 2023", plan)
    assert "ReadSchema: struct<pickup_datetime:timestamp,total_amount:double>" in plan


def test_metrics_are_one_pass(layers):
    _, silver = layers
    frame = quality.quality_metrics(silver, RULES, "P")
    assert nodes(frame, "Scan parquet") == 1
    assert "Join" not in plan_of(frame)


def test_ranking_keeps_only_the_top_rows(layers):
    _, silver = layers
    gold = marts.gold_trips_clean(quality.valid_trips(silver, RULES))
    assert nodes(reports.top_routes(gold), "TakeOrderedAndProject") == 1


def test_final_stats_read_stored_silver_only(spark):
    plan = plan_of(registry.queries()["final_stats"](spark, "/root/testdata/sf0.001"))
    assert "lineitem" not in plan and "Join" not in plan and "Cartesian" not in plan


def test_each_report_reads_the_tables_it_names(spark):
    for name, (table, build) in reports.REPORTS.items():
        empty = spark.createDataFrame([], reports.PUBLISHED_TABLES[table])
        assert reports.needs(name) == {table}
        assert reports.report(name, {table: empty}).count() == build(empty).count()


def test_no_python_and_no_unbounded_joins_in_the_flow(layers):
    bronze, _ = layers
    silver = enrich.to_silver(bronze)
    for frame in (
        quality.rejected_records(silver, RULES, "P"),
        marts.gold_daily_revenue(quality.valid_trips(silver, RULES)),
        quality.quality_metrics_by_period(enrich.to_silver_with_copies(bronze), RULES),
        reports.phase_counters(enrich.to_silver_with_copies(bronze), quality.is_rejected(RULES), quality.violations(RULES)),
    ):
        plan = plan_of(frame)
        for node in ("Python", "Cartesian", "NestedLoop", "BroadcastExchange"):
            assert node not in plan


def test_layout_writes_few_files(spark, layers, tmp_path):
    _, silver = layers
    write_layer(silver.repartition(32), str(tmp_path / "a"), ("service_type",), cluster=True)
    assert len(list((tmp_path / "a").glob("**/*.parquet"))) == 3


def test_input_order_and_partitioning_do_not_change_results(layers):
    bronze, _ = layers
    shuffled = bronze.orderBy(F.rand(7)).repartition(13)
    for build in (
        lambda b: marts.gold_daily_revenue(quality.valid_trips(enrich.to_silver(b), RULES)),
        lambda b: marts.gold_location_performance(quality.valid_trips(enrich.to_silver(b), RULES)),
    ):
        assert sorted(rows(build(bronze)), key=str) == sorted(rows(build(shuffled)), key=str)


def test_flags_that_survive_rejection_come_from_marking_rules(layers):
    _, silver = layers
    marked = quality.valid_trips(silver, RULES).filter("is_suspicious_trip")
    reasons = " OR ".join(f"({r.predicate})" for r in quality.marking_rules())
    assert marked.count() > 0
    assert marked.filter(f"NOT coalesce({reasons}, false)").count() == 0


def test_mart_totals_equal_gold(layers):
    _, silver = layers
    gold = marts.gold_trips_clean(quality.valid_trips(silver, RULES))
    cents = F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("double")
    expected = gold.agg(F.count("*"), cents).first()
    for mart in (marts.gold_daily_revenue(gold), marts.gold_location_performance(gold)):
        revenue = F.sum(F.col("total_revenue").cast("decimal(18,2)")).cast("double")
        assert tuple(mart.agg(F.sum("total_trips"), revenue).first()) == tuple(expected)


def test_tasks_stay_small_however_large_the_input(layers, spark):
    bronze, _ = layers
    registry.adopt(spark)
    plan = plan_of(enrich.dedup_trips(enrich.normalize(bronze)))
    assert int(re.search(r"hashpartitioning\(trip_id#\d+, (\d+)\)", plan).group(1)) >= 600
    for size in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        assert int(spark.conf.get(size).rstrip("mb")) <= 16 * (1 if spark.conf.get(size).endswith("m") else 2**20)


def test_raw_files_come_from_one_join(spark, monkeypatch):
    made, build = [], registry.fixture.lines_with_orders
    monkeypatch.setattr(registry.fixture, "lines_with_orders", lambda *a, **k: made.append(k) or build(*a, **k))
    monkeypatch.setattr(registry, "_raw_roots", {})
    registry.raw_files(spark, "/root/testdata/sf0.001")
    assert made == [{"by_delivery": True}]
    laid_out = registry.fixture.derive(build(spark, "/root/testdata/sf0.001", by_delivery=True))
    assert sorted(rows(laid_out), key=str) == sorted(rows(registry.fixture.trips(spark, "/root/testdata/sf0.001")), key=str)


def test_silver_is_deduplicated_and_laid_out_by_one_shuffle(layers, tmp_path):
    bronze, _ = layers
    odd = bronze.withColumn("service_type", F.expr("CASE WHEN payment_type = 2 THEN NULL WHEN payment_type = 3 THEN 'a|b' ELSE service_type END"))
    twice = odd.union(odd.where("payment_type < 5").withColumn("tip_amount", F.col("tip_amount") - 1)).withColumn("service_type", F.expr("if(tip_amount < 3, coalesce(service_type, ''), service_type)"))
    day = F.lit("2024-01-01").cast("date")
    for records in (1, 3 * enrich.ROWS_PER_SHARE):
        placed = enrich.to_silver(twice, processing_date=day, records=records)
        assert nodes(placed, "Exchange") == 1
        assert sorted(rows(placed), key=str) == sorted(rows(enrich.to_silver(twice, processing_date=day)), key=str)
    write_layer(placed, str(tmp_path / "silver"), ("service_type", "year", "month"))
    written = list((tmp_path / "silver").glob("**/*.parquet"))
    assert written and all(f.name.endswith(".zstd.parquet") for f in written)


def test_lines_of_no_known_customer_are_in_no_delivery(spark, tmp_path):
    tables = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{tables}/orders.parquet")
    orders.withColumn("o_custkey", F.expr("if(o_orderkey % 2 = 0, NULL, o_custkey)")).write.parquet(str(tmp_path / "orders.parquet"))
    spark.read.parquet(f"{tables}/lineitem.parquet").write.parquet(str(tmp_path / "lineitem.parquet"))
    known = registry.fixture.lines_with_orders(spark, tables).select("l_partkey").count()
    delivered = registry.fixture.lines_with_orders(spark, str(tmp_path), by_delivery=True).count()
    assert 0 < delivered < known
