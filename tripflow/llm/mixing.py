"""Mixing sources to target weights by Poisson replication. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SEED = 17
#: Exponent on source sizes for the default targets: 1 keeps the given mixture, 0 makes all sources equal.
TEMPERATURE = 0.5


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of the parts joined by colons."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")
    return (bits + 0.5) / F.lit(float(1 << 52))


def poisson_steps(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... events, as far as 12 deviations beyond the rate; there the rest is below 2^-52."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct(
        F.array(F.exp(-rate)).alias("steps"), (-rate).alias("log_p"), F.exp(-rate).alias("total")
    )

    def step(state: Column, k: Column) -> Column:
        log_p = state["log_p"] + F.ln(rate) - F.ln(k.cast("double"))
        total = state["total"] + F.exp(log_p)
        return F.struct(F.concat(state["steps"], F.array(total)).alias("steps"), log_p.alias("log_p"), total.alias("total"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step)["steps"]


def rates(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None, source: str = "source") -> DataFrame:
    """(source, rate): the mean number of copies per document that gives each source its share of `total` documents.

    weights: the wanted share of each source, in any unit; a source without one gets rate 0. Without weights a
    source of n documents weighs n^TEMPERATURE. total: size of the mixture, by default that of docs. A null
    source is a source of its own ("" in weights).
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(TEMPERATURE))
    else:
        if not all(w >= 0 for w in weights.values()):
            raise ValueError("weights must not be negative")
        given = F.create_map(*[F.lit(x) for item in weights.items() for x in (item[0], float(item[1]))])
        weight = F.coalesce(F.try_element_at(given, F.coalesce("source", F.lit(""))), F.lit(0.0))
    sizes = stored(sizes.withColumn("weight", weight))
    weighed, documents = sizes.agg(F.sum("weight"), F.sum("n")).first()
    wanted = float(documents or 0) if total is None else float(total)
    share = F.col("weight") / F.lit(weighed) if weighed else F.lit(0.0)
    return sizes.select("source", (F.lit(wanted) * share / F.col("n")).alias("rate"))


def mix(
    docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None, seed: int = SEED,
    doc_id: str = "doc_id", source: str = "source",
) -> DataFrame:
    """Every document as many times as its Poisson number says, in a global random order; adds copy (from 1) and shuffle_key.

    The number of a document inverts the Poisson distribution of its source's rate at a uniform number hashed from
    the seed and doc_id: the same in every run and for every partitioning. Rows that share an id get the same number;
    a null id hashes as the empty text; a null source is a source. All columns stay; copy and shuffle_key are replaced.

    The rates are one row per source: joined by broadcast only if Spark has measured them as small, and as a split
    skewed join otherwise. Copies are dealt by the hash of their shuffle key, then sorted by it in each partition.
    """
    table = stored(rates(docs, weights, total, source).select(F.col("source").alias("__source"), poisson_steps(F.greatest("rate", F.lit(1e-300))).alias("__steps")))
    bare = docs.drop("copy", "shuffle_key")
    found = bare.join(table, bare[source].eqNullSafe(F.col("__source")))
    ident = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    u = uniform(F.lit(str(seed)), ident)
    copies = F.size(F.filter("__steps", lambda c: c < F.col("__u")))
    counted = found.withColumn("__u", u).withColumn("__n", copies).where("__n > 0")
    rows = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    rows = rows.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"{seed} order"), ident, F.col("copy").cast("string"))))
    return rows.drop("__source", "__steps", "__u", "__n").repartition("shuffle_key").sortWithinPartitions("shuffle_key")
