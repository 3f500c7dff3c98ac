"""Conversations as chunks of turns, so that one conversation, however long, is many rows, tasks and groups.

Rows of a conversation go by turn (nulls first), rows of one turn by the MD5 of role and text. A chunk holds the rows whose
turn lies in one range of TURNS numbers; rows without a turn are dealt by the first byte of their MD5. (block, part) orders the
chunks. Rows that share one turn number are never parted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

TURNS_BITS = 8
TURNS = 1 << TURNS_BITS
CHUNK = ("conv_id", "block", "part")
#: Chunks turned into Python objects at once.
ROWS = 64


def identity(role: Column, text: Column) -> Column:
    """16 bytes that stand for role and text."""
    return F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))


def chunk_of(turn: Column, h: Column) -> tuple[Column, Column]:
    """block and part of a row."""
    part = F.when(turn.isNull(), F.conv(F.hex(F.substring(h, 1, 1)), 16, 10).cast("int")).otherwise(0)
    return F.shiftright(turn, TURNS_BITS).alias("block"), part.alias("part")


def placed(rows: DataFrame) -> DataFrame:
    """conv_id, turn (long), role, text, h and the chunk of each row. role and text may not be null."""
    given = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", identity(F.col("role"), F.col("text")).alias("h"))
    return given.select("*", *chunk_of(F.col("turn"), F.col("h")))


def map_rows(df: DataFrame, work: Callable[[Iterator[dict]], Iterator[tuple]], ddl: str) -> DataFrame:
    """Rows of the DDL made by work from the rows of each partition, in their order, some at a time."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    yield from whole.slice(at, ROWS).to_pylist()

        made = []
        for row in work(rows()):
            made.append(row)
            if len(made) == ROWS:
                yield _batch(made, schema)
                made = []
        if made:
            yield _batch(made, schema)

    return df.mapInArrow(run, ddl)


def _batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def in_order(df: DataFrame, backwards: bool = False) -> DataFrame:
    """Chunks of a conversation in one partition, in their order. Only for rows that are small against the chunk."""
    order = [F.col(c).desc_nulls_last() if backwards else F.col(c).asc_nulls_first() for c in CHUNK[1:]]
    return df.repartition(F.col("conv_id")).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)


def joined_sha256(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """conv_id and the SHA-256 of each text column joined over the conversation's chunks: texts maps columns to separators.

    A digest follows its text in order, so a conversation passes through one task; it is read as a stream, chunk by
    chunk. Null pieces are left out.
    """

    def digest(rows):
        digests, first, current = {}, True, None
        for row in rows:
            if first or row["conv_id"] != current:
                if not first:
                    yield current, *[d.hexdigest() for d, _ in digests.values()]
                first, current, digests = False, row["conv_id"], {t: (sha256(), False) for t in texts}
            for t, separator in texts.items():
                if row[t] is not None:
                    d, begun = digests[t]
                    d.update(((separator if begun else "") + row[t]).encode())
                    digests[t] = d, True
        if not first:
            yield current, *[d.hexdigest() for d, _ in digests.values()]

    kind = df.schema["conv_id"].dataType.simpleString()
    return map_rows(in_order(df.select(*CHUNK, *texts)), digest, ", ".join([f"conv_id {kind}", *(f"{t}_sha256 string" for t in texts)]))
