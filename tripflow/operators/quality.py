"""Rejection rules, row-level evidence and quality metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import contracts as C
from ..config import Thresholds
from ..contracts import Rule
from ..functions.amounts import percentage


def _with_limits(rules: tuple[Rule, ...], limits: Thresholds) -> tuple[Rule, ...]:
    texts = limits.as_text()
    return tuple(r.with_limits(texts) for r in rules)


def rejection_rules(limits: Thresholds = Thresholds(), opt_in: tuple[str, ...] = ()) -> tuple[Rule, ...]:
    """The rules that reject a trip, plus any opt-in checks named."""
    extra = tuple(r for r in opt_in_rules(limits) if r.rule_id in opt_in)
    return _with_limits(C.REJECTION_RULES, limits) + extra


def marking_rules(limits: Thresholds = Thresholds()) -> tuple[Rule, ...]:
    """The rules that only make a trip suspicious."""
    return _with_limits(C.MARKING_RULES, limits)


def opt_in_rules(limits: Thresholds = Thresholds()) -> tuple[Rule, ...]:
    return _with_limits(C.OPT_IN_RULES, limits)


def rule_catalogue(spark: SparkSession, limits: Thresholds = Thresholds()) -> DataFrame:
    """Every rule with its action, generated from the rules that run."""
    duplicate = Rule(
        "BR-013", "technical_duplicate", "trip_id", "SILVER", "TECHNICAL_DUPLICATE", "HIGH",
        "row_number() over (partition by trip_id order by ingestion_timestamp) > 1",
    )
    actions = (
        ("REJECT", rejection_rules(limits)),
        ("MARK_SUSPICIOUS", marking_rules(limits)),
        ("DEDUPLICATE", (duplicate,)),
        ("OPT_IN", opt_in_rules(limits)),
    )
    rows = [
        (r.rule_id, r.name, r.column, r.predicate, r.stage, r.category, r.severity, action)
        for action, rules in actions
        for r in rules
    ]
    return spark.createDataFrame(
        rows,
        "rule_id STRING, name STRING, column STRING, condition STRING, rejection_stage STRING, "
        "rejection_category STRING, severity STRING, action STRING",
    ).orderBy("rule_id")


def is_rejected(rules: tuple[Rule, ...]) -> Column:
    """True if any rule is broken. A rule that evaluates to NULL is not broken."""
    return F.coalesce(reduce(Column.__or__, [r.broken() for r in rules]), F.lit(False))


def violations(rules: tuple[Rule, ...]) -> Column:
    """Number of rules a row breaks."""
    return reduce(Column.__add__, [F.when(r.broken(), 1).otherwise(0) for r in rules])


def quality_status() -> Column:
    return F.when(F.col("is_suspicious_trip"), "SUSPICIOUS").otherwise("VALID")


def valid_trips(silver: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows that break no rule, with their final status.

    One conjunct per rule: the NULL checks turn into plain IS NOT NULL, which reaches the scan.
    """
    kept = silver.filter(" AND ".join(f"({rule.predicate}) IS NOT TRUE" for rule in rules))
    return kept.withColumn("quality_status", quality_status())


def rejected_trips(silver: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    return silver.filter(is_rejected(rules))


def rejected_records(
    silver: DataFrame, rules: tuple[Rule, ...], process_id: str, rejected_at: Column | None = None
) -> DataFrame:
    """Evidence: one row per (trip, broken rule), from a single pass over the trips."""
    when = F.current_timestamp() if rejected_at is None else rejected_at

    def evidence(r: Rule) -> Column:
        return F.when(
            r.broken(),
            F.struct(
                F.lit(r.stage).alias("rejection_stage"),
                F.lit(r.rule_id).alias("rejection_rule_id"),
                F.lit(r.name).alias("rejection_rule"),
                F.lit(r.column).alias("rejection_column"),
                F.coalesce(F.col(r.column).cast("string"), F.lit("NULL")).alias("original_value"),
                F.lit(r.technical_reason).alias("technical_reason"),
                F.lit(r.business_reason).alias("business_reason"),
                F.lit(r.category).alias("rejection_category"),
            ),
        )

    found = F.array_compact(F.array(*[evidence(r) for r in rules]))
    return rejected_trips(silver, rules).select(
        F.lit(process_id).alias("process_id"),
        F.coalesce("trip_id", F.lit("UNKNOWN")).alias("trip_id"),
        "service_type",
        "source_file",
        F.inline(found),
        when.alias("rejected_at"),
    )


def split(
    silver: DataFrame, rules: tuple[Rule, ...], process_id: str, rejected_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid trips, rejection evidence)."""
    return valid_trips(silver, rules), rejected_records(silver, rules, process_id, rejected_at)


_PERIOD = ("service_type", "year", "month")


def _metrics_columns(process_id: str, processed_at: Column | None) -> list[Column]:
    when = F.current_timestamp() if processed_at is None else processed_at
    return [
        F.lit(process_id).alias("process_id"),
        *[F.col(c) for c in _PERIOD],
        F.col("total_records"),
        F.col("valid_records"),
        F.col("rejected_records"),
        F.lit(0).cast("long").alias("duplicate_records"),
        F.lit(0).cast("long").alias("null_critical_records"),
        F.col("suspicious_records"),
        percentage(F.col("valid_records"), F.col("total_records")).alias("quality_percentage"),
        when.alias("processed_at"),
    ]


def quality_metrics(
    silver: DataFrame, rules: tuple[Rule, ...], process_id: str, processed_at: Column | None = None
) -> DataFrame:
    """Metrics per (service, year, month) in one pass over silver.

    `rejected_records` is the evidence count of the whole service, repeated on each of its periods;
    the window that spreads it runs over the aggregated periods only.
    """
    rejected = is_rejected(rules)
    suspicious = F.coalesce(F.col("is_suspicious_trip"), F.lit(False))
    per_period = silver.groupBy(*_PERIOD).agg(
        F.count_if(~rejected).alias("valid_records"),
        F.count_if(~rejected & suspicious).alias("suspicious_records"),
        F.sum(violations(rules)).alias("evidence"),
    )
    of_service = Window.partitionBy("service_type")
    return (
        per_period.withColumn("rejected_records", F.sum("evidence").over(of_service))
        .filter("valid_records > 0")
        .withColumn("total_records", F.col("valid_records") + F.col("rejected_records"))
        .select(*_metrics_columns(process_id, processed_at))
    )


def quality_metrics_from(
    valid: DataFrame, evidence: DataFrame, process_id: str, processed_at: Column | None = None
) -> DataFrame:
    """The same metrics from persisted valid trips and evidence (left join on the service)."""
    per_period = valid.groupBy(*_PERIOD).agg(
        F.count("*").alias("valid_records"), F.count_if("is_suspicious_trip").alias("suspicious_records")
    )
    per_service = evidence.groupBy("service_type").agg(F.count("*").alias("evidence"))
    return (
        per_period.join(per_service, "service_type", "left")
        .withColumn("rejected_records", F.coalesce("evidence", F.lit(0)))
        .withColumn("total_records", F.col("valid_records") + F.col("rejected_records"))
        .select(*_metrics_columns(process_id, processed_at))
    )


def quality_metrics_by_period(silver: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Corrected metrics: trips counted once, in their own period, with real duplicate counts.

    `silver` has `copies` (see enrich.to_silver_with_copies): all copies of a trip share its period, so one aggregation
    over it counts what arrived as well.
    """
    rejected = is_rejected(rules)
    null_rules = tuple(r for r in rules if r.category == "NULL_CRITICAL_FIELD")
    return (
        silver.groupBy(*_PERIOD)
        .agg(
            F.sum("copies").alias("input_records"),
            (F.sum("copies") - F.count("*")).alias("duplicate_records"),
            F.count("*").alias("total_records"),
            F.count_if(~rejected).alias("valid_records"),
            F.count_if(rejected).alias("rejected_records"),
            F.count_if(is_rejected(null_rules)).alias("null_critical_records"),
            F.count_if(~rejected & F.coalesce("is_suspicious_trip", F.lit(False))).alias("suspicious_records"),
        )
        .withColumn("quality_percentage", percentage(F.col("valid_records"), F.col("total_records")))
    )


def rejection_rate_gate(silver: DataFrame, rules: tuple[Rule, ...], limits: Thresholds = Thresholds()) -> DataFrame:
    """Share of rejected trips per period, and whether it stays within the configured limit."""
    rate = percentage(F.col("rejected_trips"), F.col("trips"))
    return (
        silver.groupBy(*_PERIOD)
        .agg(F.count("*").alias("trips"), F.count_if(is_rejected(rules)).alias("rejected_trips"))
        .withColumn("rejection_pct", rate)
        .withColumn("within_limit", F.col("rejection_pct") <= F.lit(float(limits.max_rejection_pct)))
    )


def broken_by(silver: DataFrame, rule: Rule) -> DataFrame:
    """Trips that break one given rule."""
    return silver.filter(rule.broken())
