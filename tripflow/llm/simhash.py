"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has 64 bits, cut into two halves of 32. Two fingerprints that differ in at most 4 bits differ in
at most 2 bits of the first half or in at most 1 bit of the second, so each half is searched on its own with
threshold 2 and 1. The anchors of a half are the words of the Hamming code of length 31, the last bit free:
a covering code of radius 1 with 2^27 words. Each fingerprint has one home anchor within the covering radius,
and is replicated to every anchor within covering radius plus threshold (171 and 17 at most); whatever lies
within the threshold of a home fingerprint is therefore found at its anchor. Only homes are compared with
replicas, and with 2^27 anchors a chance meeting takes hundreds of millions of pairs.

Exact: no link is lost and none beyond the distance is kept.
"""

from __future__ import annotations

import json
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, stored, with_columns_by_arrow

SHINGLE_WORDS = 4
SEED = 42
DISTANCE = 4
#: Bits per half and the threshold searched in it: their sum plus one exceeds DISTANCE.
HALVES = ((32, 2), (0, 1))
CODE_LENGTH = 31
COVERING_RADIUS = 1
#: Shingles hashed at once; bounds memory on very long texts.
STEP = 200_000


def fingerprint(text: str | None) -> int:
    """64 majority bits over the XXH64 of the text's word shingles; 0 for a text without words (or null)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        spans = [(0, len(joined))]
    else:
        starts = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum([len(w) + 1 for w in words], out=starts[1:])
        spans = list(zip(starts[:-SHINGLE_WORDS].tolist(), (starts[SHINGLE_WORDS:] - 1).tolist(), strict=True))
    set_bits = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), STEP):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans[at : at + STEP]], dtype=">u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(spans)).tobytes(), "big")


def _fingerprints(batches):
    for (texts,) in batches:
        made = np.array([fingerprint(t.as_py()) for t in texts], dtype=np.uint64)
        yield [pa.array(made.view(np.int64))]


def with_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs and a column fp: the fingerprint as a signed long. Words are cut at the six ASCII spaces; only A-Z are lower-cased."""
    return with_columns_by_arrow(docs, [text], "fp long", _fingerprints)


def _syndrome(word: int) -> int:
    """Of the Hamming code: the number of the bit to flip (0: none) to reach a code word."""
    s = 0
    for i in range(CODE_LENGTH):
        if word >> i & 1:
            s ^= i + 1
    return s


def error_patterns(radius: int) -> list[list[int]]:
    """For each syndrome, the bit patterns of at most `radius` bits of 32 that lead to a code word."""
    found: list[list[int]] = [[] for _ in range(CODE_LENGTH + 1)]
    for weight in range(radius + 1):
        for bits in combinations(range(CODE_LENGTH + 1), weight):
            pattern = sum(1 << b for b in bits)
            found[_syndrome(pattern)].append(pattern)
    return found


def _syndrome_column(half: Column) -> Column:
    masks = [sum(1 << i for i in range(CODE_LENGTH) if (i + 1) >> j & 1) for j in range(5)]
    parts = [F.bit_count(half.bitwiseAND(F.lit(m).cast("long"))) % 2 * (1 << j) for j, m in enumerate(masks)]
    return sum(parts[1:], parts[0]).cast("int")


def _halves(fps: DataFrame, radii: list[int]) -> DataFrame:
    """(anchor, fp): every anchor within the given radius of each half; anchors of different halves differ."""
    parts = []
    for number, ((shift, _), radius) in enumerate(zip(HALVES, radii, strict=True)):
        half = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(0xFFFFFFFF))
        table = F.from_json(F.lit(json.dumps(error_patterns(radius))), "array<array<bigint>>")  # folded to a constant
        base = fps.select("fp", half.alias("half"))
        near = base.select("fp", "half", F.explode(F.element_at(table, _syndrome_column(F.col("half")) + 1)).alias("e"))
        anchor = F.col("half").bitwiseXOR(F.col("e")).bitwiseOR(F.lit(number << 32))
        parts.append(near.select(anchor.alias("anchor"), "fp"))
    return parts[0].union(parts[1])


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) that differ in 1 to DISTANCE bits, as (a, b); a pair may come more than once.

    Homes are few, so they are the built side of a hash join and the replicas are streamed past them unsorted.
    """
    homes = _halves(fps, [COVERING_RADIUS] * 2).select("anchor", F.col("fp").alias("a"))
    replicas = _halves(fps, [COVERING_RADIUS + t for _, t in HALVES]).select("anchor", F.col("fp").alias("b"))
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
    return replicas.join(homes.hint("shuffle_hash"), "anchor").where(near).select("a", "b")


def clusters(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, text_hash, fp, component_id, group_fp.

    component_id is the smallest doc_id of the component (null ids count only where it has no other), group_fp
    the smallest fingerprint of it. Null and empty texts have fingerprint 0 and link like any other; repeated
    rows each keep their row; an empty table gives no rows. Other columns of docs are not read.
    Equal fingerprints are one row before any comparison, so copies cost nothing.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    fps = stored(with_fingerprint(base).drop("text"))
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    grouped = components(links(distinct.select("fp")))
    labelled = distinct.join(grouped, distinct["fp"] == grouped["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("group_fp")
    )
    firsts = labelled.groupBy("group_fp").agg(F.min("first_id").alias("component_id"))
    known = stored(labelled.select("fp", "group_fp").join(firsts, "group_fp"))
    return fps.join(known, "fp").select("doc_id", "text_hash", "fp", "component_id", "group_fp")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with one row of each near-duplicate group: its smallest doc_id (nulls last), then the smallest text_hash.

    All columns stay. Rows repeated with the same id and text are one row.
    """
    ident = F.struct("doc_id", "text_hash").alias("__winner")  # structs compare null fields as equal
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    best = clusters(docs, text, doc_id).groupBy("group_fp").agg(F.min(order).alias("w"))
    winners = best.select("w.doc_id", "w.text_hash").select(ident)
    marked = docs.withColumn("__key", F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash")))
    kept = marked.join(winners, F.col("__key") == F.col("__winner"), "left_semi")
    return kept.dropDuplicates(["__key"]).drop("__key")
