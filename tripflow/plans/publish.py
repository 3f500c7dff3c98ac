"""Published catalog tables and idempotent loads."""

from __future__ import annotations

from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..contracts import PUBLISHED_TABLES, published_schema
from ..sources.layers import NULL_FOLDER, current, log_of, new_version, partition_folder, read_layer, write_layer

# table -> (folder of the layer that holds it, partition columns)
LAYOUT = {
    "gold_trips_clean": ("gold/trips", ("service_type", "year", "month")),
    "gold_daily_revenue": ("gold/daily", ("service_type",)),
    "gold_location_performance": ("gold/location", ("service_type",)),
    "quality_rejected_records": ("quarantine/records", ("process_id", "service_type")),
    "quality_metrics_summary": ("audit/quality_metrics", ("process_id",)),
    "audit_file_inventory": ("audit/inventory", ("process_id",)),
}


def _columns_ddl(table: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in published_schema(table))


def _literal(text: str) -> str:
    """SQL literal of a text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


PUBLISHED_COMMIT = "tripflow.commit"


def _spec(folder: str) -> str:
    """`a=b/c=d` as (a = 'b', c = 'd')."""
    parts = [part.split("=", 1) for part in folder.split("/")]
    return "(" + ", ".join(f"{n} = {'null' if v == NULL_FOLDER else _literal(unquote(v))}" for n, v in parts) + ")"


def point(spark: SparkSession, table: str, folders: dict[str, str], gone: set[str] = frozenset()) -> None:
    """Let partitions (`a=b/c=d`) of a table be read from other folders. Each one changes from all its old rows to all its new
    ones: only the catalog is written."""
    held = {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    added = [f"PARTITION {_spec(p)} LOCATION {_literal(f)}" for p, f in sorted(folders.items()) if p not in held]
    for partition in sorted(set(folders) & held):
        spark.sql(f"ALTER TABLE {table} PARTITION {_spec(partition)} SET LOCATION {_literal(folders[partition])}")
    if added:
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(added)}")
    for partition in sorted(gone & held):
        spark.sql(f"ALTER TABLE {table} DROP PARTITION {_spec(partition)}")
    spark.catalog.refreshTable(table)


def _partitions_below(spark: SparkSession, table: str, partitions: tuple[str, ...], folder: str) -> dict[str, str]:
    """Partition -> folder, as a passing table over the folder finds them."""
    passing = f"{table}_{uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {passing} ({_columns_ddl(table.rsplit('.', 1)[-1])}) USING parquet PARTITIONED BY ({', '.join(partitions)}) LOCATION {_literal(folder)}")
    try:
        spark.sql(f"MSCK REPAIR TABLE {passing}")
        found = [r.partition for r in spark.sql(f"SHOW PARTITIONS {passing}").collect()]
    finally:
        spark.sql(f"DROP TABLE {passing}")
    return {p: f"{folder}/{p}" for p in found}


def _sync(spark: SparkSession, table: str, path: str, partitions: tuple[str, ...]) -> None:
    """Bring a table to what its layer holds, from the commits that it has not seen."""
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    log = log_of(spark, path, int(properties.get(PUBLISHED_COMMIT, 0)))
    if not log:
        return
    held, whole = current(spark, path), any(c[1] for c in log)
    changed = set(held) if whole else {k for c in log for k in c[2]}
    folders: dict[str, str] = {}
    for version in sorted({held[k].split("/", 1)[0] for k in changed if k in held}):
        folders |= _partitions_below(spark, table, partitions, f"{path}/{version}")
    old = {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} - set(folders)
    gone = old if whole else {p for p in old if any(f"{p}/".startswith(f"{k}/") for k in changed)}
    point(spark, table, folders, gone)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PUBLISHED_COMMIT}' = '{log[-1][0]}')")


def publish_layers(spark: SparkSession, settings: Settings) -> list[str]:
    """Create the six tables, if absent, and point their partitions at what the layers hold.

    The layers are the tables: no row is copied. Runs accumulate under their `process_id`
    partition; gold tables hold the latest run.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {settings.database} LOCATION {_literal(settings.layer('catalog'))}")
    for table in PUBLISHED_TABLES:
        folder, partitions = LAYOUT[table]
        name = f"{settings.database}.{table}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_columns_ddl(table)}) USING parquet "
            f"PARTITIONED BY ({', '.join(partitions)}) LOCATION {_literal(settings.layer(folder))}"
        )
        _sync(spark, name, settings.layer(folder), partitions)
    return list(PUBLISHED_TABLES)


def create_table(spark: SparkSession, name: str, like: str, location: str | None = None) -> None:
    """A table with the columns of a published one; per-run tables are partitioned by run."""
    per_run = "PARTITIONED BY (process_id)" if "process_id" in published_schema(like).fieldNames() else ""
    where = f"LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns_ddl(like)}) USING parquet {per_run} {where}")


def idempotent_load(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    process_id: str,
    extra_columns: dict[str, str] | None = None,
) -> int:
    """Replace this run's rows of `table` by `source`, matched by column name; rows inserted.

    A table with a `process_id` column keeps the rows of other runs: only the partition of this
    run is replaced. Any other table is replaced as a whole. Table columns the source lacks
    become NULL; a source column the table lacks is an error. The rows are written to a folder of their own
    first, as those of a run are, and the table is then pointed at it: a load that fails changes nothing.
    """
    for name, value in (extra_columns or {}).items():
        source = source.withColumn(name, F.lit(value))
    target = spark.table(table).schema
    unknown = set(source.columns) - set(target.fieldNames())
    if unknown:
        raise ValueError(f"{table} has no column {', '.join(sorted(unknown))}")
    per_run = "process_id" in target.fieldNames()
    rows = source.select(
        *[
            (F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target
            if not (per_run and f.name == "process_id")
        ]
    )
    partition = partition_folder(process_id=process_id)
    version = new_version(_location(spark, table))
    folder = f"{version}/{partition}" if per_run else version
    write_layer(rows, folder)
    if per_run:
        point(spark, table, {partition: folder})
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(folder)}")
        spark.catalog.refreshTable(table)
    return spark.read.schema(rows.schema).parquet(folder).count()  # from the footers


def _location(spark: SparkSession, table: str) -> str:
    """Where the table's versions lie."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    return found.split("/version=", 1)[0]


def load_directory(
    spark: SparkSession,
    path: str,
    table: str,
    process_id: str,
    extra_columns: dict[str, str] | None = None,
) -> int:
    """Load a layer or Parquet folder (hive partitions, columns by name) into a table."""
    source = read_layer(spark, path, merge_schema=True)
    if source is None:
        raise ValueError(f"nothing to load below {path}")
    return idempotent_load(spark, source, table, process_id, extra_columns)


def load_inventory(spark: SparkSession, records: DataFrame, table: str, process_id: str) -> int:
    """Load inventory records that may come as text: unreadable numbers become 0, times NULL."""
    fields = published_schema("audit_file_inventory")
    zero_filled = {"record_count", "column_count", "file_size_mb"}
    columns = []
    for f in fields:
        if f.name not in records.columns:
            continue
        value = F.col(f.name).try_cast(f.dataType)
        if f.name in zero_filled:
            value = F.coalesce(value, F.lit(0).cast(f.dataType))
        columns.append(value.alias(f.name))
    loaded = records.select(*columns).drop("process_id")
    return idempotent_load(spark, loaded, table, process_id)
