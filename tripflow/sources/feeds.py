"""Reading raw feeds whose files do not all share one schema."""

from __future__ import annotations

import json
from collections import defaultdict
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as C
from ..operators.conform import conform, union_feeds

FOLDER = r"^(.*)/[^/]*$"


@dataclass(frozen=True)
class FeedGroup:
    """Files of one feed with the same schema, read as one scan of whole folders, or of named files."""

    service_type: str
    schema_hash: str
    frame: DataFrame
    folders: tuple[str, ...]
    files: int
    records: int


def read_feed(spark: SparkSession, paths: list[str], schema: T.StructType, latest: datetime | None = None) -> DataFrame:
    """One scan of files or folders with the given schema, so no footer is read again to infer it. Files modified after
    `latest` are pruned when the scan lists its files."""
    found = (
        spark.read.schema(schema)
        .option("mergeSchema", "false")
        .option("pathGlobFilter", "*.parquet")
        .option("datetimeRebaseMode", "CORRECTED")
        .option("int96RebaseMode", "CORRECTED")
        .parquet(*paths)
    )
    return found if latest is None else found.where(F.col("_metadata.file_modification_time") <= F.lit(latest))


def feed_groups(spark: SparkSession, files: DataFrame, listed: DataFrame | None = None) -> list[FeedGroup]:
    """Scans of the given inventory rows: one per feed and schema version over the folders that hold nothing else, and one over
    named files for the rest.

    listed is the whole inventory (files, if not given). A folder is read as a whole where every listed file in it is
    among `files` with one feed and schema, and no listed folder lies below it; files that came later are left out by their
    modification time. What reaches the driver is a row per folder and version, and the names of files only from
    folders that mix versions or hold files that are set aside.
    """
    folder = F.regexp_extract("file_path", FOLDER, 1).alias("folder")
    used = files.select(folder, "service_type", "schema_hash", "record_count", F.lit(1).alias("used"))
    known = (files if listed is None else listed).where(F.col("read_status") != C.STATUS_NOT_FOUND)
    seen = known.select(folder, F.lit(1).alias("listed"), "modified")
    per_folder = used.unionByName(seen, allowMissingColumns=True).groupBy("folder").agg(
        F.sum("used").alias("used"), F.sum("listed").alias("listed"), F.max("modified").alias("modified"),
        F.count_distinct("service_type", "schema_hash").alias("versions"),
    )
    parts = used.groupBy("folder", "service_type", "schema_hash").agg(F.sum("used").alias("files"), F.sum("record_count").alias("records"))
    rows = parts.join(per_folder.drop("used"), "folder").where(F.col("service_type").isin(*C.SERVICES)).collect()
    nested = {up for r in per_folder.select("folder").collect() for up in _ancestors(r.folder)}
    schemas = {
        r.schema_hash: T.StructType.fromJson(json.loads(r.schema_json))
        for r in files.select("schema_hash", "schema_json").distinct().collect()
    }
    whole, mixed = defaultdict(list), defaultdict(list)
    for r in rows:
        pure = r.versions == 1 and r.files == r.listed and r.folder not in nested
        (whole if pure else mixed)[r.service_type, r.schema_hash].append(r)
    latest = max((r.modified for r in rows if r.modified), default=None)
    groups = [
        _group(key, found, read_feed(spark, sorted(r.folder for r in found), schemas[key[1]], latest)) for key, found in sorted(whole.items())
    ]
    if mixed:
        names = _named(spark, files, {r.folder for found in mixed.values() for r in found})
        groups += [_group(key, found, read_feed(spark, sorted(names[key]), schemas[key[1]])) for key, found in sorted(mixed.items())]
    return groups


def _ancestors(folder: str):
    while "/" in folder.rstrip("/"):
        folder = folder.rsplit("/", 1)[0]
        yield folder


def _group(key: tuple[str, str], rows: list, frame: DataFrame) -> FeedGroup:
    return FeedGroup(*key, frame, tuple(sorted(r.folder for r in rows)), sum(r.files for r in rows), sum(r.records for r in rows))


def _named(spark: SparkSession, files: DataFrame, folders: set[str]) -> dict[tuple[str, str], list[str]]:
    """Paths of the files in folders that cannot be read as a whole, by feed and schema."""
    wanted = spark.createDataFrame([(f,) for f in sorted(folders)], "folder STRING")
    names = defaultdict(list)
    placed = files.select("file_path", "service_type", "schema_hash", F.regexp_extract("file_path", FOLDER, 1).alias("folder"))
    for r in placed.join(wanted, "folder", "left_semi").collect():
        names[r.service_type, r.schema_hash].append(r.file_path)
    return names


def conform_groups(
    groups: list[FeedGroup], ingested_at: Column | None = None, names: dict[str, dict[str, tuple[str, ...]]] | None = None
) -> tuple[DataFrame | None, list[tuple[str, str, str]]]:
    """(bronze rows of all groups, (feed, schema hash, reason) of the versions that cannot be conformed). names: see
    diagnose.source_names."""
    conformed, failed = [], []
    for group in groups:
        try:
            conformed.append(conform(group.frame, group.service_type, ingested_at=ingested_at, names=(names or {}).get(group.service_type)))
        except AnalysisException as error:
            failed.append((group.service_type, group.schema_hash, str(error)))
    return (union_feeds(conformed) if conformed else None), sorted(set(failed))
