"""Line deduplication: lines found in many documents stay in one of them. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_CHARS = 40
MIN_DOCUMENTS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(" \t\n\u000b\f\r"))
    plain = F.octet_length(bare) == F.char_length(bare)  # lower() touches more than A-Z elsewhere, and is faster
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def key_hash(line: Column) -> Column:
    """16 bytes that stand for the key."""
    return F.unhex(F.md5(key(line)))


def drop_common_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """docs with text without its common lines, and n_lines, n_dropped (long).

    A key of at least min_chars code points found in at least min_documents distinct documents loses all its lines
    but those of the largest doc_id that holds it. Null and empty texts are one empty line and become an empty text;
    rows that share a doc_id are one document; null ids are one document below all others. Extra columns stay;
    n_lines and n_dropped are replaced if docs has them.

    Keys travel as 16-byte hashes, once per document and key; a line of every document is counted in parts, and
    finding its documents is a join on plain keys that is split when skewed. Texts are shuffled once.
    """
    long_key = F.char_length(F.btrim(F.col("line"), F.lit(" \t\n\u000b\f\r"))) >= min_chars
    lines = docs.select(F.col(doc_id).alias("id"), F.explode(F.split(F.col(text), "\n")).alias("line")).where(long_key)
    pairs = stored(lines.select("id", key_hash(F.col("line")).alias("h")).distinct())
    counted = pairs.groupBy("h").agg(F.count("*").alias("n"), F.max("id").alias("owner"))
    common = stored(counted.where(F.col("n") >= min_documents).select("h", "owner"))
    lost = pairs.join(common, "h").where(~F.col("id").eqNullSafe(F.col("owner")))
    by_document = lost.groupBy(F.col("id").alias("__id")).agg(F.collect_list("h").alias("__lost"))

    bare = docs.drop("n_lines", "n_dropped").withColumn(text, F.coalesce(text, F.lit("")))
    found = bare.join(by_document, bare[doc_id].eqNullSafe(F.col("__id")), "left")
    parts = F.split(F.col(text), "\n")
    kept = F.filter(parts, lambda x: ~F.array_contains("__lost", key_hash(x)) | (F.char_length(x) < min_chars))
    found = found.withColumns({
        "n_lines": F.size(parts).cast("long"),
        "__kept": F.when(F.col("__lost").isNotNull(), kept),
    })
    return found.withColumns({
        "n_dropped": F.coalesce(F.col("n_lines") - F.size("__kept"), F.lit(0)).cast("long"),
        text: F.coalesce(F.array_join("__kept", "\n"), F.col(text)),
    }).drop("__id", "__lost", "__kept")
