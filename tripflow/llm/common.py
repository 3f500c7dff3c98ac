"""Helpers that the operators share: scratch tables, row-wise Arrow columns, components."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Rows given to Python functions, and back to Spark, at once.
ROWS = 1000


def scratch_dir(spark: SparkSession) -> str:
    """A new folder that every executor sees: below spark.checkpoint.dir, or the warehouse where that is unset."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows of df, written once and read again.

    Cuts lineage, survives lost executors, and gives the optimizer true sizes: what it then broadcasts is
    what it has measured to be below spark.sql.autoBroadcastJoinThreshold.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_memory(key: tuple, make: Callable):
    """What make() gave in this Python worker for this key, in this task or an earlier one.

    A worker keeps one value: asking with another key drops it, so operators that follow each other do not add up.
    """
    memory = sys.__dict__.setdefault("_worker_memory", {})
    if key not in memory:
        memory.clear()
        memory[key] = make()
    return memory[key]


def with_columns_by_arrow(df: DataFrame, inputs: Sequence[str | Column], added: str, work: Callable) -> DataFrame:
    """df and the columns of the DDL text `added`, made from `inputs` by work(iterator of lists of Arrow arrays).

    work yields a list of Arrow arrays per list of arrays it is given, of the same length. Columns of df that
    have an added name are replaced.
    """
    new = StructType.fromDDL(added)
    names = [f.name for f in new]
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in names}]
    n_in = len(kept)
    wide = df.select(  # numbered names keep odd column names of df apart from the added ones
        *[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(kept)],
        *[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(f"arg_{i}") for i, c in enumerate(inputs)],
    )
    out = StructType([*wide.schema[:n_in], *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def arguments():
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    held.append(batch := whole.slice(at, ROWS))
                    yield [batch.column(i) for i in range(n_in, batch.num_columns)]

        for made in work(arguments()):
            batch = held.pop(0)
            columns = [batch.column(i) for i in range(n_in)] + list(made)
            yield pa.RecordBatch.from_arrays(columns, names=[f"in_{i}" for i in range(n_in)] + names)

    made = wide.mapInArrow(run, out)
    return made.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(kept)], *[F.col(n) for n in names])


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, component) per linked node; component is the smallest node.

    Alternates the two star steps: each node's larger neighbours, then its smaller ones, are hung on the smallest
    node it knows. Every step is a partial minimum and a join on plain keys, so a node with very many links
    is split like any skewed join. Rounds are stored; their number grows with the logarithm of the nodes.
    Nulls and self-links are ignored. Ends when every node hangs on a root.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    )
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(both.where("v > u").join(smallest, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(lowest)
        edges = stored(small.distinct())
        roots = edges.select(F.col("lo").alias("node")).distinct()
        several = edges.groupBy("hi").agg(F.count("*").alias("n")).where("n > 1")
        unfinished = edges.join(roots, edges["hi"] == roots["node"], "left_semi").select("hi").union(several.select("hi"))
        if unfinished.isEmpty():
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        edges.select("lo", F.col("lo").alias("component")).distinct()
    )
