"""Column expressions over file paths, read errors and file statuses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import contracts as C


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def size_mb(length: Column) -> Column:
    return F.round(length / F.lit(1024 * 1024), 2)


def detect_service(path: Column) -> Column:
    """Feed of a file, from its name or a folder of that name; first match in feed order."""
    name, route = F.lower(file_name(path)), F.lower(path)
    service = None
    for feed in C.SERVICES:
        found = name.contains(feed) | route.contains(f"/{feed}/")
        service = F.when(found, feed) if service is None else service.when(found, feed)
    return service.when(route.contains("bad"), "bad_parquet").otherwise("unknown")


def partition_value(path: Column, key: str) -> Column:
    """`key=value` folder of the path; else the trailing '-YYYY-MM' parts of the file name.

    The name only counts when the digits stand alone between dashes, so 'a-2023-01' has a year and
    'a_2023-01' has just a month.
    """
    segments = F.filter(F.split(path, "/"), lambda s: s.startswith(f"{key}="))
    from_folder = F.substring(F.get(segments, F.lit(0)), len(key) + 2, 2**31 - 1)
    tokens = F.split(file_stem(path), "-")
    position, digits = {"year": (2, 4), "month": (1, 2)}[key]
    token = F.get(tokens, F.size(tokens) - position)
    from_name = F.when(token.rlike(rf"^\d{{{digits}}}$"), token)
    return F.coalesce(from_folder, from_name)


def classify_read_error(message: Column) -> Column:
    """Status for the text of a read error: ordered keyword search, case-insensitive."""
    text = F.lower(message)
    status = None
    for name, words in C.READ_ERROR_KEYWORDS:
        hit = reduce(Column.__or__, [text.contains(w) for w in words])
        status = F.when(hit, name) if status is None else status.when(hit, name)
    return status.otherwise(C.STATUS_UNKNOWN)


def is_success(status: Column) -> Column:
    return status == C.STATUS_SUCCESS


def is_recoverable(status: Column) -> Column:
    return status.startswith("RECOVERABLE") | (status == "PARTIALLY_RECOVERABLE")


def recommended_action(status: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in C.RECOMMENDED_ACTIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, status), F.lit(C.DEFAULT_ACTION))


def source_system(service: Column) -> Column:
    return F.when(service == "bad_parquet", C.SOURCE_SYSTEM_BAD_FILES).otherwise(C.SOURCE_SYSTEM_TRIPS)


def canonical_type(dtype: Column) -> Column:
    """Fold the spellings of a type into one name; other types stay as they are."""
    text = F.lower(dtype)
    folded = None
    for name, spellings in C.TYPE_ALIASES.items():
        hit = text.isin(*spellings)
        folded = F.when(hit, name) if folded is None else folded.when(hit, name)
    return folded.otherwise(text)


def types_compatible(expected: Column, actual: Column) -> Column:
    return canonical_type(expected) == canonical_type(actual)
