"""Session factory and the few settings the engine relies on."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import SparkSession

# Settings that results depend on; everything else is tuning.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # a task sorts some ten times what it reads, shuffles and files being compressed; at these sizes that fits in the
    # memory of a task however large the input is, since there are enough partitions to merge
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.parquet.filterPushdown": "true",
    # HotSpot never compiles a method over 8000 bytes of bytecode; beyond that Spark had better
    # generate one function per expression than one method per stage (3x on wide projections)
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(app_name: str = "tripflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC timestamps, ANSI casts and adaptive execution.

    The number of shuffle partitions is left to the cluster; adaptive execution merges small
    ones and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **TUNING_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def adopt(spark: SparkSession) -> SparkSession:
    """Apply the same runtime settings to a session made elsewhere."""
    for key, value in {**SEMANTIC_CONF, **TUNING_CONF}.items():
        spark.conf.set(key, value)
    return spark


def new_process_id(now: datetime | None = None) -> str:
    """Run identity: ETL-YYYYMMDD-HHMMSS-XXXXXXXX."""
    stamp = (now or datetime.now()).strftime("%Y%m%d-%H%M%S")
    return f"ETL-{stamp}-{uuid4().hex[:8].upper()}"
