"""Conformance of a feed to the canonical trip model: one projection per feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as C

# Filled by the projection itself rather than taken from a source column.
_MADE_HERE = {
    "trip_id", "service_type", "year", "month", "source_file", "ingestion_timestamp", "quality_status",
}


def _safe(df: DataFrame, column: str, dtype: T.DataType) -> Column:
    """try_cast to the canonical type; sub-second and un-zoned timestamps go by the session zone."""
    return df[f"`{column}`"].try_cast(dtype)


def _find(df: DataFrame, *names: str) -> str | None:
    """First of `names` that the frame has, ignoring case."""
    by_lower = {c.lower(): c for c in df.columns}
    return next((by_lower[n.lower()] for n in names if n and n.lower() in by_lower), None)


Names = dict[str, tuple[str, ...]]


def source_column(df: DataFrame, service: str, canonical: str, names: Names | None = None) -> str | None:
    """Column of `df` that feeds `canonical`: the first mapped name it has (of `names`, else of the built-in contract),
    else one already so named."""
    mapped = (C.source_names(service).get(canonical),) if names is None else names.get(canonical, ())
    return _find(df, *mapped, canonical)


def derived_total(df: DataFrame, service: str, names: Names | None = None) -> Column:
    """Sum of the fare components, NULL as zero; a component the file lacks is left out."""
    found = [source_column(df, service, c, names) for c in C.DERIVED_TOTAL_COMPONENTS]
    parts = [F.coalesce(_safe(df, c, T.DoubleType()), F.lit(0.0)) for c in found if c]
    return reduce(Column.__add__, parts)


def conform(
    df: DataFrame,
    service: str,
    source_file: Column | None = None,
    ingested_at: Column | None = None,
    names: Names | None = None,
) -> DataFrame:
    """Project one feed to the 27 canonical columns (`trip_id` comes with the enrichment).

    Rename, safe cast, NULL fill, derived total and metadata are a single `select`, so the scan
    reads only mapped columns. `source_file` defaults to the name of the file a row was read from, `names` (canonical
    column -> source columns) to the built-in contract.
    """
    if source_file is None:
        source_file = F.col("_metadata.file_name")
    columns = {}
    for field in C.CANONICAL_SCHEMA:
        if field.name in _MADE_HERE:
            continue
        source = source_column(df, service, field.name, names)
        if field.name == "total_amount" and service == "fhvhv":
            value = derived_total(df, service, names)
        elif source:
            value = _safe(df, source, field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        columns[field.name] = value
    columns["service_type"] = F.lit(service)
    columns["year"] = F.year(columns["pickup_datetime"])
    columns["month"] = F.month(columns["pickup_datetime"])
    columns["source_file"] = source_file
    columns["ingestion_timestamp"] = F.current_timestamp() if ingested_at is None else ingested_at
    columns["quality_status"] = F.lit("PENDING")
    order = [f.name for f in C.CANONICAL_SCHEMA if f.name != "trip_id"]
    return df.select(*[columns[name].alias(name) for name in order])


def union_feeds(feeds: list[DataFrame]) -> DataFrame:
    """All conformed feeds as one frame, by name, absent columns as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
