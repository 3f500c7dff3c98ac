"""File audit: listing, footers, inventory, content hashes and page decoding.

Footers, hashes and pages are read inside tasks; a file that cannot be read becomes a row with a
message, never an exception. Paths are rows of frames; the driver holds them in the scan's file index
only, as in any Spark file source.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote, urlparse

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..config import ExpectedFile
from ..functions import paths as P

# The task functions below travel with the job, so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOOTER_DDL = (
    "file_path STRING, length BIGINT, record_count BIGINT, column_count INT, row_groups INT, "
    "columns ARRAY<STRUCT<name: STRING, type: STRING>>, schema_json STRING, schema_hash STRING, "
    "error_message STRING, modified TIMESTAMP"
)
FOOTER_FIELDS = [
    "file_path", "length", "record_count", "column_count", "row_groups", "columns",
    "schema_json", "schema_hash", "error_message", "modified",
]
PATHS_PER_TASK = 64
FOLDERS_PER_TASK = 16


def plain_path(path: str) -> str:
    """A local path without its `file:` scheme; any other URI as it is."""
    return urlparse(path).path if path.startswith("file:") else path


# ---------------------------------------------------------------- inside tasks

def _locate(path: str):
    """(file system, path in it) for a local path or a URI."""
    from pyarrow import fs

    if urlparse(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), plain_path(path)
    return fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe=":/=@"))


def _as_read_by_spark(opened):
    """The schema Spark gives a Parquet file, from its footer."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_schema

    def plain(t):
        if pa.types.is_dictionary(t):
            return plain(t.value_type)
        if pa.types.is_large_string(t):
            return pa.string()
        if pa.types.is_large_binary(t):
            return pa.binary()
        if pa.types.is_unsigned_integer(t):
            widened = {8: pa.int16(), 16: pa.int32(), 32: pa.int64(), 64: pa.decimal128(20, 0)}
            return widened[t.bit_width]
        if pa.types.is_timestamp(t) and t.unit == "ns":
            raise TypeError("unsupported Parquet type TIMESTAMP(NANOS)")
        return t

    leaves = [opened.schema.column(i) for i in range(len(opened.schema.names))]
    instants = {leaf.path for leaf in leaves if leaf.physical_type == "INT96"}
    fields = [
        pa.field(f.name, pa.timestamp("us", "UTC") if f.name in instants else plain(f.type))
        for f in opened.schema_arrow
    ]
    return from_arrow_schema(pa.schema(fields), prefer_timestamp_ntz=True)


def _schema_hash(schema) -> str:
    import hashlib
    import json

    return hashlib.md5(json.dumps(schema.jsonValue(), sort_keys=True).encode()).hexdigest()


def _footer(path: str) -> dict:
    import pyarrow.parquet as pq

    row = dict.fromkeys(FOOTER_FIELDS)
    row["file_path"] = path
    try:
        file_system, inner = _locate(path)
        info = file_system.get_file_info(inner)
        if not info.is_file:
            return row
        row["length"], row["modified"] = info.size, info.mtime
        if info.size == 0:
            return row
        with file_system.open_input_file(inner) as source:
            opened = pq.ParquetFile(source)
            schema = _as_read_by_spark(opened)
            row.update(
                record_count=opened.metadata.num_rows,
                row_groups=opened.metadata.num_row_groups,
                column_count=len(schema.fields),
                columns=[{"name": f.name, "type": str(f.dataType).lower()} for f in schema.fields],
                schema_json=schema.json(),
                schema_hash=_schema_hash(schema),
            )
    except Exception as error:  # any failure is the finding itself
        row["error_message"] = f"{type(error).__name__}: {error}"
    return row


def _children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Folders and Parquet files in each folder, without hidden ones."""
    from pyarrow import fs

    kinds = {fs.FileType.Directory: True, fs.FileType.File: False}
    for batch in batches:
        found = []
        for folder in batch["file_path"]:
            file_system, inner = _locate(folder)
            found += [
                (f"{folder}/{i.base_name}", kinds[i.type])
                for i in file_system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
                if i.type in kinds and i.base_name[:1] not in "_." and (kinds[i.type] or i.base_name.endswith(".parquet"))
            ]
        yield pd.DataFrame(found, columns=["file_path", "folder"])


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    integers = {"length": "Int64", "record_count": "Int64", "column_count": "Int32", "row_groups": "Int32"}
    for batch in batches:
        found = pd.DataFrame([_footer(p) for p in batch["file_path"]], columns=FOOTER_FIELDS).astype(integers)
        yield found.assign(modified=pd.to_datetime(found["modified"], utc=True).astype("datetime64[us, UTC]"))


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    def digest(path: str) -> str:
        try:
            file_system, inner = _locate(path)
            md5 = hashlib.md5()
            with file_system.open_input_stream(inner) as stream:
                while block := stream.read(1 << 20):
                    md5.update(block)
            return md5.hexdigest()
        except Exception:
            return "UNREADABLE"

    for batch in batches:
        yield batch.assign(file_hash=[digest(p) for p in batch["file_path"]])


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Decode all pages of one row group per input row."""
    import pyarrow.parquet as pq

    def problem(path: str, group: int) -> tuple[int, str | None]:
        rows = 0
        try:
            file_system, inner = _locate(path)
            with file_system.open_input_file(inner) as source:
                for part in pq.ParquetFile(source).iter_batches(row_groups=[group]):
                    rows += part.num_rows
            return rows, None
        except Exception as error:
            return rows, f"{type(error).__name__}: {error}"

    for batch in batches:
        results = [problem(p, int(g)) for p, g in zip(batch["file_path"], batch["row_group"])]
        yield batch[["file_path"]].assign(
            decoded_rows=[r for r, _ in results], error_message=[e for _, e in results]
        )


# ---------------------------------------------------------------- on the driver side

LISTING_DDL = "file_path STRING, folder BOOLEAN"


def _spread(df: DataFrame, tasks: int) -> DataFrame:
    """Spread rows that each stand for much work; a given number is never coalesced away."""
    return df.repartition(max(tasks, df.sparkSession.sparkContext.defaultParallelism))


def _below(spark: SparkSession, folders: list[str]) -> DataFrame:
    """What lies in the folders, listed in tasks of a few folders each."""
    rows = spark.createDataFrame([(f,) for f in folders], "file_path STRING")
    return rows.repartition(max(1, -(-len(folders) // FOLDERS_PER_TASK))).mapInPandas(_children, LISTING_DDL)


def listing(spark: SparkSession, *roots: str) -> DataFrame:
    """file_path of all `*.parquet` files below folders, empty ones included; no rows if they are absent.

    Folders are listed in tasks, level by level; only the names of folders come to the driver. Below a file system that
    tasks cannot list, Spark's own listing is taken, which leaves empty files out.
    """
    level, folders, odd = [], [], []
    for root in roots:
        try:
            _locate(root)
            level.append(plain_path(root).rstrip("/"))
        except Exception:  # not known outside Spark
            odd.append(root)
    while level:
        folders += level
        level = [r.file_path for r in _below(spark, level).where("folder").collect()]
    found = [_below(spark, folders).where("NOT folder").select("file_path")]
    for root in odd:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        found.append(reader.load(root).select(F.regexp_replace("path", "^file:/+", "/").alias("file_path")))
    return reduce(DataFrame.union, found)


def _by_files(files: DataFrame) -> DataFrame:
    """A bounded number of files a task."""
    return _spread(files, -(-files.count() // PATHS_PER_TASK))


def scan_footers(files: DataFrame) -> DataFrame:
    """One row per file_path with size, counts and schema from the footer, or the error text."""
    return _by_files(files.select("file_path")).mapInPandas(_footers, FOOTER_DDL)


def manifest(spark: SparkSession, raw_dir: str, expected: tuple[ExpectedFile, ...]) -> DataFrame:
    """The expected files as rows, with the path at which each would lie."""
    rows = [(e.service_type, e.file_name, e.year, e.month) for e in expected]
    frame = spark.createDataFrame(rows, "service_type STRING, file_name STRING, year STRING, month STRING")
    folders = F.when(F.col("year").isNotNull(), F.concat(F.lit("/year="), "year", F.coalesce(F.concat(F.lit("/month="), "month"), F.lit(""))))
    root = F.lit(plain_path(raw_dir).rstrip("/") + "/")
    return frame.withColumn("file_path", F.concat(root, "service_type", F.coalesce(folders, F.lit("")), F.lit("/"), "file_name"))


def compare_manifest(expected: DataFrame, delivered: DataFrame) -> DataFrame:
    """Expected against delivered files, by name: file_name, expected, delivered (counts) and status.

    expected and delivered have file_name; both shrink to a row per name before they meet. EXPECTED: once each;
    MISSING: not delivered; UNEXPECTED: not on the list; REPEATED: delivered more often than expected.
    """
    sides = [
        side.groupBy("file_name").agg(F.count("*").alias(name)) for side, name in ((expected, "expected"), (delivered, "delivered"))
    ]
    count = {c: F.coalesce(c, F.lit(0)) for c in ("expected", "delivered")}
    status = (
        F.when(F.col("expected") == 0, "UNEXPECTED").when(F.col("delivered") == 0, "MISSING")
        .when(F.col("delivered") > F.col("expected"), "REPEATED").otherwise("EXPECTED")
    )
    return sides[0].join(sides[1], "file_name", "full").withColumns(count).withColumn("status", status)


def inventory(
    spark: SparkSession,
    raw_dir: str,
    process_id: str,
    expected: tuple[ExpectedFile, ...] = (),
    processed_at: Column | None = None,
) -> DataFrame:
    """File inventory: the 14 published fields, then what later phases need.

    Files on the expected list that are not below `raw_dir` appear as not found.
    """
    present = listing(spark, raw_dir)
    if not expected:
        return audit(scan_footers(present), process_id, processed_at)
    wanted = manifest(spark, raw_dir, expected)
    delivered = present.select(P.file_name(F.col("file_path")).alias("file_name"))
    absent = wanted.join(delivered, "file_name", "left_anti").select("file_path")
    return audit(scan_footers(present.union(absent)), process_id, processed_at)


def audit(footers: DataFrame, process_id: str, processed_at: Column | None = None) -> DataFrame:
    """Inventory rows for scanned footers."""
    path, length, error = F.col("file_path"), F.col("length"), F.col("error_message")
    names = F.transform("columns", lambda c: F.lower(c["name"]))
    twins = F.coalesce(F.size(F.array_distinct(names)) < F.size(names), F.lit(False))  # no scan can tell them apart
    status = (
        F.when(error.isNotNull(), P.classify_read_error(error))
        .when(twins, C.STATUS_MISSING_COLUMNS)
        .when(length.isNull(), C.STATUS_NOT_FOUND)
        .when(length == 0, C.STATUS_EMPTY)
        .otherwise(C.STATUS_SUCCESS)
    )
    message = (
        F.when(error.isNotNull(), error)
        .when(twins, F.concat(F.lit("column names repeat: "), F.array_join(F.array_sort(F.transform("columns", lambda c: c["name"])), ", ")))
        .when(length.isNull(), C.MESSAGE_NOT_FOUND)
        .when(length == 0, C.MESSAGE_EMPTY)
    )
    service = P.detect_service(path)
    return footers.select(
        F.lit(process_id).alias("process_id"),
        P.source_system(service).alias("source_system"),
        service.alias("service_type"),
        P.file_name(path).alias("file_name"),
        "file_path",
        F.coalesce(P.size_mb(length), F.lit(0.0)).alias("file_size_mb"),
        P.partition_value(path, "year").alias("partition_year"),
        P.partition_value(path, "month").alias("partition_month"),
        status.alias("read_status"),
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
        F.coalesce("column_count", F.lit(0)).alias("column_count"),
        "schema_hash",
        message.alias("error_message"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
        (P.is_success(status) & service.isin(*C.SERVICES)).alias("ingested"),
        "row_groups",
        "columns",
        "schema_json",
        "length",
        "modified",
    )


def write_bytes(path: str, content: bytes) -> None:
    """Put a small file at any path the audit can read."""
    file_system, inner = _locate(path)
    file_system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with file_system.open_output_stream(inner) as out:
        out.write(content)


def file_hashes(files: DataFrame) -> DataFrame:
    """MD5 of the bytes of each file_path, read in blocks; UNREADABLE when it cannot be read."""
    return _by_files(files.select("file_path")).mapInPandas(_hashes, "file_path STRING, file_hash STRING")


def deep_validate(inventory_rows: DataFrame) -> DataFrame:
    """Decode every page of every readable file; one task unit per row group, not per file."""
    spark = inventory_rows.sparkSession
    groups = inventory_rows.filter(P.is_success(F.col("read_status")) & (F.col("row_groups") > 0)).select(
        "file_path", F.explode(F.sequence(F.lit(0), F.col("row_groups") - 1)).alias("row_group")
    )
    shuffle_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    decoded = _spread(groups, shuffle_partitions).mapInPandas(
        _decode, "file_path STRING, decoded_rows BIGINT, error_message STRING"
    )
    return decoded.groupBy("file_path").agg(
        F.sum("decoded_rows").alias("decoded_rows"),
        F.when(F.count("error_message") > 0, "FAILED").otherwise("OK").alias("decode_status"),
        F.min("error_message").alias("decode_error"),
    )


def file_quarantine(inventory_rows: DataFrame, at: Column | None = None) -> DataFrame:
    """Evidence for files that could not be read: inventory row, stage, advice."""
    status = F.col("read_status")
    published = C.published_schema("audit_file_inventory").fieldNames()
    return inventory_rows.filter(~P.is_success(status)).select(
        *published,
        (F.current_timestamp() if at is None else at).alias("quarantine_timestamp"),
        F.lit("EXTRACTION").alias("quarantine_stage"),
        P.recommended_action(status).alias("recommended_action"),
        P.is_recoverable(status).alias("is_recoverable"),
    )


def schema_quarantine(diagnosis: DataFrame, at: Column | None = None) -> DataFrame:
    """Evidence for readable files whose schema lacks a critical column."""
    return diagnosis.filter(~F.col("is_recoverable")).select(
        "*",
        F.lit(C.SCHEMA_QUARANTINE_REASON).alias("quarantine_reason"),
        (F.current_timestamp() if at is None else at).alias("quarantine_timestamp"),
        F.lit("SCHEMA_RECOVERY").alias("stage"),
    )
