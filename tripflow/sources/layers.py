"""Persisted layers: reading them back, and writing them by version.

A committed layer is a folder of versions, `version=v.../`, and a log, `_commits/`, of small JSON files. A write goes to a
version of its own and counts once its commit is in the log, so readers see what was there before or all that is there
now, and a write that fails leaves the old rows. A commit replaces a whole layer or some of its keys (a run, a
period); the newest commit of a key says where its rows are. Versions stay until they are cleaned away. One writer at a
time commits to a key.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PERIOD = ("service_type", "year", "month")
LOG_DDL = "number BIGINT, whole BOOLEAN, folders MAP<STRING, STRING>"
WHOLE = ""
NOTHING = ""  # the folder of a key that has no rows any more
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}


def partition_folder(**values) -> str:
    """`name=value/...` as Spark names the folders of a partition."""
    def text(value) -> str:
        return NULL_FOLDER if value is None else "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))

    return "/".join(f"{name}={text(value)}" for name, value in values.items())


def _absent(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def commits(spark: SparkSession, path: str) -> list:
    """The layer's log, oldest first; empty where nothing was committed."""
    try:
        log = spark.read.schema(LOG_DDL).json(f"{path.rstrip('/')}/_commits").collect()
    except AnalysisException as error:
        if _absent(error):
            return []
        raise
    return sorted((r for r in log if r.number is not None), key=lambda r: r.number)


def current(spark: SparkSession, path: str) -> dict[str, str] | None:
    """Key -> folder of what the layer holds now; None for a layer without commits."""
    log = commits(spark, path)
    if not log:
        return None
    held: dict[str, str] = {}
    for commit in log:
        held = {**({} if commit.whole else held), **commit.folders}
    return {k: f for k, f in held.items() if f != NOTHING}


def commit(spark: SparkSession, path: str, folders: dict[str, str], whole: bool) -> int:
    """Point keys of the layer (all of it, if whole) at folders below it, by one new file in the log."""
    number = max((c.number for c in commits(spark, path)), default=0) + 1
    entry = spark.createDataFrame([(number, whole, folders)], LOG_DDL)
    entry.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/_commits")
    return number


def read_layer(
    spark: SparkSession, path: str, merge_schema: bool = False, schema: StructType | None = None, keys: set[str] | None = None
) -> DataFrame | None:
    """What a Parquet layer holds now (of some keys only, if given), or None where nothing has been written yet.

    With a `schema`, a layer that was written without a single row reads as an empty frame. A folder without a log is
    read as it stands.
    """
    path = path.rstrip("/")
    held = current(spark, path)
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        if held is None:
            found = reader.parquet(path)
            return None if "version" in found.columns else found  # versions that were never committed
        folders = sorted({f for k, f in held.items() if keys is None or k in keys})
        if not folders:
            return None if schema is None else spark.createDataFrame([], schema)
        found = reader.option("basePath", path).parquet(*[f"{path}/{f}" for f in folders]).drop("version")
        return found if schema is None else found.select(*schema.names)
    except AnalysisException as error:
        if _absent(error):
            return None
        raise


def read_glob(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """All matching files below a folder, by column name, with the folders' partition values."""
    return spark.read.option("mergeSchema", True).option("pathGlobFilter", pattern).parquet(root)


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    cluster: bool = False,
    sort_by: tuple[str, ...] = (),
    max_records_per_file: int = 2_000_000,
) -> None:
    """Overwrite a folder as a whole.

    `cluster` adds one shuffle by the partition columns so that a partition is not scattered over a
    file per task. REBALANCE lets adaptive execution merge small partitions and split one that
    holds a large part of all rows. Leave it off when the input is already laid out this way.
    """
    columns = [c for c in partition_by if c in df.columns]
    if cluster:
        df = df.hint("rebalance", *columns) if columns else df.hint("rebalance")
    if sort_by:
        df = df.sortWithinPartitions(*columns, *sort_by)
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    writer = writer.option("compression", "zstd")  # trip ids are hex digits, which it halves
    writer = writer.option("partitionOverwriteMode", "static")
    if columns:
        writer = writer.partitionBy(*columns)
    writer.parquet(path)


def new_version(path: str) -> str:
    """The folder of a version that nothing points at yet."""
    return f"{path.rstrip('/')}/version=v{uuid4().hex[:12]}"


def commit_layer(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (), key: str = WHOLE, whole: bool = True, by_partition: bool = False,
    only: set[str] | None = None, verify: Callable[[DataFrame], None] | None = None, **how,
) -> DataFrame:
    """Write df as a new version, commit it under a key, and return what the layer holds. verify sees what was written, and
    keeps it from being committed by raising.

    The commit replaces all the layer, or only that key's rows if not whole. With by_partition, each partition folder is
    a key of its own; `only` then names those that are replaced, also by nothing, and the others stay.
    """
    spark, target = df.sparkSession, new_version(path)
    write_layer(df, target, partition_by, **how)
    version = target.rsplit("/", 1)[-1]
    folders, stored = {key: version}, spark.read.schema(df.schema).parquet(target)
    if verify is not None:
        verify(stored)
    if by_partition:
        periods = stored.select(*partition_by).distinct().collect()
        folders = {k: f"{version}/{k}" for k in (partition_folder(**r.asDict()) for r in periods)}
        folders |= {k: NOTHING for k in (only or set()) - set(folders)}
        folders = folders or {WHOLE: version}
    commit(spark, path, folders, whole=whole and only is None)
    return read_layer(spark, path, schema=df.schema)


def commit_run(df: DataFrame, path: str, process_id: str, **how) -> DataFrame:
    """Replace all that one run has in an audit layer; returns that part as stored.

    Reading it back cuts the plan: later steps start from files, whatever executor is lost.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if "process_id" not in df.columns:
        df = df.withColumn("process_id", F.lit(process_id))
    partition_by = tuple(c for c in how.pop("partition_by", ()) if c != "process_id")
    key, target = partition_folder(process_id=process_id), new_version(path)
    write_layer(df.drop("process_id"), f"{target}/{key}", partition_by, **how)
    commit(spark, path, {key: f"{target.rsplit('/', 1)[-1]}/{key}"}, whole=False)
    return read_layer(spark, path, schema=df.schema, keys={key})


def log_of(spark: SparkSession, path: str, after: int = 0) -> list[tuple[int, bool, dict[str, str]]]:
    """(number, whole, folders) of the commits behind a number."""
    return [(c.number, c.whole, dict(c.folders)) for c in commits(spark, path) if c.number > after]
