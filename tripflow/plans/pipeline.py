"""The run: raw files -> bronze -> silver -> gold, quarantine and audit -> published tables.

Every phase ends in written layers and the next one starts from them, so a lost executor costs a
task, a failed run restarts at a phase, and no plan grows over several phases. A layer is committed
after it is written, so a run that fails leaves what was there. Counts come from the footers of what was
written (or from two columns of it), so retried tasks do not change them.
"""

from __future__ import annotations

import json
import logging
import time
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import diagnose, enrich, marts, quality
from ..session import adopt, new_process_id
from ..sources import feeds, files
from ..sources.layers import NULL_FOLDER, PERIOD, WHOLE, commit_layer, commit_run, current, partition_folder, read_layer
from . import publish, reports

log = logging.getLogger("tripflow")


@dataclass
class Run:
    process_id: str
    status: str = "RUNNING"
    error: str | None = None
    phases: dict[str, dict] = field(default_factory=dict)
    checks: list = field(default_factory=list)


@contextmanager
def _phase(run: Run, name: str):
    started = time.monotonic()
    facts: dict = {}
    yield facts
    facts["elapsed_sec"] = round(time.monotonic() - started, 2)
    run.phases[name] = facts
    log.info("%s %s: %s", run.process_id, name, facts)


def extract(spark: SparkSession, settings: Settings, process_id: str) -> DataFrame:
    """Phase 1: inventory of the raw files and evidence for the unreadable ones."""
    rows = files.inventory(spark, settings.raw, process_id, settings.expected_files)
    stored = commit_run(rows, settings.layer("audit", "inventory"), process_id, cluster=True)
    commit_run(files.file_quarantine(stored), settings.layer("quarantine", "files"), process_id, cluster=True)
    return stored


def latest_inventory(spark: SparkSession, settings: Settings) -> DataFrame | None:
    """The inventory of the most recent run that took one."""
    stored = read_layer(spark, settings.layer("audit", "inventory"))
    if stored is None:
        return None
    last = stored.agg(F.max("process_id")).first()[0]
    return stored.filter(F.col("process_id") == last)


def hashed(spark: SparkSession, settings: Settings, feed_files: DataFrame, process_id: str) -> DataFrame:
    """(file_path, length, modified, file_hash) of the given files. Bytes are read only where no run has hashed a file of this
    path, size and time."""
    path, facts = settings.layer("audit", "hashes"), ["file_path", "length", "modified"]
    before = read_layer(spark, path)
    known = feed_files.select(*facts)
    if before is None:
        found = known.join(files.file_hashes(known), "file_path")
    else:
        old = known.join(before.select(*facts, "file_hash").distinct(), facts)
        new = known.join(old.select(*facts), facts, "left_anti")
        found = old.union(new.join(files.file_hashes(new), "file_path").select(*old.columns))
    return commit_run(found, path, process_id, cluster=True)


def unseen(spark: SparkSession, settings: Settings, feed_files: DataFrame, process_id: str) -> DataFrame:
    """The files whose bytes bronze does not hold yet, each content once (at its first path), with file_hash.

    The ledger has a row per file that a run was to conform; it counts if bronze holds that run, so a run that ended before
    its commit is not in the way, and a load that replaced bronze starts anew.
    """
    hashes = hashed(spark, settings, feed_files, process_id).select("file_path", "file_hash")
    firsts = hashes.groupBy("file_hash").agg(F.min("file_path").alias("file_path"))
    ledger = read_layer(spark, settings.layer("audit", "ledger"))
    if ledger is not None:
        held = [r for r in (current(spark, settings.layer("bronze")) or {}) if r != partition_folder(process_id=process_id)]
        runs = spark.createDataFrame([(k,) for k in held], "run STRING")
        loaded = ledger.join(runs, F.concat(F.lit("process_id="), "process_id") == F.col("run"), "left_semi")
        firsts = firsts.join(loaded.select("file_hash"), "file_hash", "left_anti")
    return feed_files.join(firsts, "file_path")


LEDGER = ("file_hash", "file_path", "service_type", "partition_year", "partition_month", "record_count")


def to_bronze(spark: SparkSession, settings: Settings, inventory: DataFrame, process_id: str) -> dict | None:
    """Phases 2-3: diagnose each file, conform the recoverable ones, set the others aside.

    An incremental run adds the files whose bytes bronze does not hold to it; any other run replaces bronze. `periods` are the
    partitions that an incremental run has added to, None where all of them are new.
    """
    feed_files = inventory.filter("ingested")
    if settings.deep_validate:
        checked = files.deep_validate(feed_files)
        decoded = commit_run(checked, settings.layer("audit", "decoded"), process_id, cluster=True)
        damaged = decoded.filter(F.col("decode_status") != "OK")
        feed_files = feed_files.join(damaged.select("file_path"), "file_path", "left_anti")
    if settings.incremental:
        feed_files = unseen(spark, settings, feed_files, process_id)
    contracts = diagnose.contract_registry(spark, settings.contracts)
    diagnosis = diagnose.diagnose(feed_files, contracts)
    stored = commit_run(diagnosis, settings.layer("audit", "diagnostics"), process_id, cluster=True)
    usable = feed_files.join(stored.filter("is_recoverable").select("file_path"), "file_path", "left_semi")
    groups = feeds.feed_groups(spark, usable, inventory)
    bronze, failed = feeds.conform_groups(groups, names=diagnose.source_names(contracts))
    set_aside = files.schema_quarantine(stored)
    reasons = spark.createDataFrame(failed, "service_type STRING, schema_hash STRING, homologation_error STRING")
    if failed:
        broken = stored.filter("is_recoverable").join(reasons, ["service_type", "schema_hash"])
        set_aside = set_aside.unionByName(
            files.schema_quarantine(broken.withColumn("is_recoverable", F.lit(False))), allowMissingColumns=True
        )
    commit_run(set_aside, settings.layer("quarantine", "schemas"), process_id, cluster=True)
    lost = {(service, key) for service, key, _ in failed}
    conformed = [g for g in groups if (g.service_type, g.schema_hash) not in lost]
    facts = {"feed_scans": len(groups), "files_conformed": sum(g.files for g in conformed)}
    path, run = settings.layer("bronze"), partition_folder(process_id=process_id)
    held = current(spark, path) or {}
    if bronze is None:
        return {**facts, "bronze_records": 0, "periods": set()} if settings.incremental and held else None
    if settings.incremental:
        good = usable.join(reasons, ["service_type", "schema_hash"], "left_anti")
        commit_run(good.select(*LEDGER), settings.layer("audit", "ledger"), process_id, cluster=True)
    whole = not settings.incremental or not held or WHOLE in held
    audited = sum(g.records for g in conformed)

    def as_audited(written: DataFrame) -> None:
        facts["bronze_records"] = written.count()  # from the footers of what was written
        if facts["bronze_records"] != audited:
            raise RuntimeError(f"files changed since their audit: {audited} records then, {facts['bronze_records']} now")

    # raw files already hold one feed and month each, so the write needs no shuffle
    commit_layer(
        bronze, path, PERIOD, key=run if settings.incremental else WHOLE, whole=whole, verify=as_audited,
        cluster=settings.cluster_bronze, max_records_per_file=settings.max_records_per_file,
    )
    if whole:
        return {**facts, "periods": None}
    written = read_layer(spark, path, schema=bronze.schema, keys={run})
    return {**facts, "periods": {partition_folder(**r.asDict()) for r in written.select(*PERIOD).distinct().collect()}}


def to_silver(spark: SparkSession, settings: Settings, bronze: DataFrame, periods: set[str] | None = None) -> dict:
    """Phase 4: enrichment and deduplication, in one shuffle that brings the partition layout as well.

    Copies of a trip share its period, so an incremental run does this for the periods it has added to only.
    """
    if periods is not None:
        in_period = [F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_FOLDER))) for c in PERIOD])]
        bronze = bronze.where(in_period[0].isin(*sorted(periods)))
    # periods of silver come from the pickup, as those of bronze
    records_in = bronze.count()  # from the footers
    silver = enrich.to_silver(bronze, settings.thresholds, records=records_in)
    path = settings.layer("silver")
    commit_layer(
        silver, path, PERIOD, by_partition=True, only=periods, sort_by=("pickup_datetime",),
        max_records_per_file=settings.max_records_per_file,
    )
    written = read_layer(spark, path, schema=silver.schema, keys=periods)
    facts = {
        "records_in": records_in,
        **written.agg(  # two columns of what was written
            F.count(F.lit(1)).alias("records_out"),
            F.count_if("is_suspicious_trip").alias("suspicious_trips"),
            F.count_if("is_airport_trip").alias("airport_trips"),
        ).first().asDict(),
    }
    facts["duplicates_removed"] = facts["records_in"] - facts["records_out"]
    return facts


def to_gold(spark: SparkSession, settings: Settings, silver: DataFrame, process_id: str) -> dict:
    """Phases 5-6: valid trips, evidence, metrics and marts.

    The trips table keeps silver's layout and is written without a shuffle; the marts read only
    their few columns of it, with the rules already applied.
    """
    rules = quality.rejection_rules(settings.thresholds, settings.opt_in_rules)
    valid, evidence = quality.split(silver, rules, process_id)

    def write(table: str, df: DataFrame, **how) -> DataFrame:
        folder, partitions = publish.LAYOUT[table]
        path = settings.layer(folder)
        if "process_id" in partitions:
            return commit_run(df, path, process_id, partition_by=partitions, **how)
        return commit_layer(df, path, partitions, **how)

    size = {"max_records_per_file": settings.max_records_per_file}
    trips = write("gold_trips_clean", marts.gold_trips_clean(valid), sort_by=("pickup_datetime",), **size)
    # a task reads many small files or a part of a large one, so its evidence is no smaller a file than those of the trips
    stored_evidence = write("quality_rejected_records", evidence, **size)
    write("gold_daily_revenue", marts.gold_daily_revenue(trips), cluster=True)
    write("gold_location_performance", marts.gold_location_performance(trips), cluster=True)
    commit_run(reports.trip_sketches(trips), settings.layer("audit", "trip_sketches"), process_id, cluster=True)
    metrics = quality.quality_metrics_from(trips, stored_evidence, process_id)
    write("quality_metrics_summary", metrics, cluster=True)
    facts = {"valid_records": trips.count(), "rejected_records": stored_evidence.count()}  # from footers
    total = facts["valid_records"] + facts["rejected_records"]
    facts["quality_pct"] = round(facts["valid_records"] / max(total, 1) * 100, 2)
    return facts


def publish_and_verify(spark: SparkSession, settings: Settings, run: Run) -> dict:
    """Phase 7: tables over the layers, then the eight verification reports."""
    publish.publish_layers(spark, settings)
    run.checks = reports.verify(reports.catalog_tables(spark, settings.database))
    frame = reports.verification_frame(spark, run.checks).withColumn("process_id", F.lit(run.process_id))
    commit_run(frame, settings.layer("audit", "verification"), run.process_id, cluster=True)
    passed = sum(c.status == "OK" for c in run.checks)
    return {"queries_ok": passed, "queries_total": len(run.checks)}


def run(
    spark: SparkSession, settings: Settings, start: int = 1, end: int = 7, process_id: str | None = None
) -> Run:
    """Run the phases from `start` to `end`; a phase that is skipped is replaced by its layer."""
    adopt(spark)
    state = Run(process_id or new_process_id())
    periods = None  # what phase 4 has to do anew; None: all

    def wanted(phase: int) -> bool:
        return start <= phase <= end

    try:
        inventory = None
        if wanted(1):
            with _phase(state, "phase_1") as facts:
                inventory = extract(spark, settings, state.process_id)
                facts.update(
                    inventory.agg(
                        F.count("*").alias("inventory"),
                        F.count_if("ingested").alias("files_read"),
                        F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"),
                    ).first().asDict()
                )
        if wanted(2):
            with _phase(state, "phase_2_3") as facts:
                inventory = latest_inventory(spark, settings) if inventory is None else inventory
                if inventory is None:
                    raise RuntimeError("no inventory to start from")
                outcome = to_bronze(spark, settings, inventory, state.process_id)
                if outcome is None:
                    raise RuntimeError("no file could be conformed, bronze is empty")
                periods = outcome.pop("periods")
                facts.update(outcome)
        if wanted(4) and periods != set():
            with _phase(state, "phase_4") as facts:
                bronze = read_layer(spark, settings.layer("bronze"), merge_schema=True)
                if bronze is None:
                    raise RuntimeError("no bronze layer to start from")
                facts.update(to_silver(spark, settings, bronze, periods))
        if wanted(5):
            with _phase(state, "phase_5_6") as facts:
                silver = read_layer(spark, settings.layer("silver"))
                if silver is None:
                    raise RuntimeError("no silver layer to start from")
                facts.update(to_gold(spark, settings, silver, state.process_id))
        if wanted(7):
            with _phase(state, "phase_7") as facts:
                facts.update(publish_and_verify(spark, settings, state))
        state.status = "SUCCESS"
    except Exception as error:
        state.status, state.error = "FAILED", str(error)
        try:
            _save_metrics(spark, settings, state)
        except Exception as unsaved:  # must not hide what ended the run
            error.add_note(f"Run metrics were not saved: {unsaved}")
        raise
    _save_metrics(spark, settings, state)
    return state


def _save_metrics(spark: SparkSession, settings: Settings, state: Run) -> None:
    rows = [
        (state.process_id, state.status, state.error, phase, json.dumps(facts, default=str))
        for phase, facts in state.phases.items()
    ] or [(state.process_id, state.status, state.error, None, None)]
    frame = spark.createDataFrame(
        rows, "process_id STRING, status STRING, error STRING, phase STRING, facts STRING"
    )
    commit_run(frame, settings.layer("audit", "run_metrics"), state.process_id, cluster=True)
