"""Embedding near-duplicates by a pivot-permutation index.

A bounded set of reference points (pivots) is drawn from the vectors and thinned, so that a dense group, however large,
keeps few pivots and its members describe themselves by the same ones. Each vector is described by its nearest pivots, in
order. An inverted list per pivot holds the vectors that have it among the first of their order. Of the vectors that meet in
a list, those that share enough of their pivots are candidates, and a candidate becomes a link if its cosine in double
precision reaches the threshold. Where no more pivots are left than describe a vector, all vectors are candidates.

Equal vectors are one class before anything is compared. Lists are cut into chunks of bounded size, and the chunks of a
list meet two by two, so a pivot near a third of all vectors is many tasks. A pair is counted in the list of the first
pivot, in number, in whose lists both are. A meeting gives each vector's number of links and a spanning forest of its
links, not the links, so that what goes on grows with the vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored
from .vectors import matrix, usable

COSINE = 0.9
#: Bound on the pivots, picked by hash; it bounds what the driver sends to tasks.
PIVOTS = 1024
#: Pivots that describe a vector, how many of them, from the nearest, it is listed under, and how many a candidate pair shares.
NEAREST, LISTED, SHARED = 16, 6, 3
CHUNK = 2048
SEED = 23


def describe(unit: np.ndarray, pivots: np.ndarray, nearest: int = NEAREST) -> np.ndarray:
    """Numbers of each vector's nearest pivots, nearest first, ties to the smaller number."""
    return np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :nearest].astype(np.int32)


def memberships(near: np.ndarray) -> np.ndarray:
    """A row per vector, a column per pivot: whether the vector has it."""
    member = np.zeros((len(near), int(near.max()) + 1), dtype=bool)
    np.put_along_axis(member, near.astype(np.int64), True, axis=1)
    return member


def units(v: np.ndarray) -> np.ndarray:
    scaled = v / np.abs(v).max(axis=1)[:, None]  # keeps squares in range
    return scaled / np.sqrt((scaled**2).sum(axis=1))[:, None]


def thinned(pivots: np.ndarray, closest: float) -> np.ndarray:
    """The pivots in order, without those at cosine closest or more to one that was kept."""
    left, kept = np.arange(len(pivots)), []
    while len(left):
        kept.append(left[0])
        left = left[1:][pivots[left[1:]] @ pivots[left[0]] < closest]
    return pivots[kept]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) of the graph of n nodes, for the nodes that have a link."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def clusters(
    vectors: DataFrame, cosine: float = COSINE, n_pivots: int = PIVOTS, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    n_links counts the other rows linked directly, component_id is the smallest vec_id reachable, kept says that it is
    the row's own. Vectors that are null, empty or zero, or hold null or non-finite components, and rows without an id
    link with nothing: n_links 0, component_id the own id. Vectors of different lengths are not linked. A row that
    repeats an id and a vector is linked with its like; rows of one id with different vectors are one component. An empty
    table gives no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    classes = stored(rows.groupBy("v", "dim").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    n = classes.count()
    share = F.lit(min(1.0, n_pivots / max(n, 1)) * (1 << 40))
    drawn = classes.where(F.pmod(F.xxhash64("rep", F.lit(SEED)), F.lit(1 << 40)) < share).orderBy(F.xxhash64("rep", F.lit(SEED))).limit(2 * n_pivots)
    by_dim: dict[int, list] = {}
    for r in drawn.select("dim", "v").collect():
        by_dim.setdefault(r["dim"], []).append(r["v"])
    # twice the squared distance of the farthest linked pair
    pivots = {d: thinned(units(np.array(v)), 2 * cosine - 1) for d, v in by_dim.items()}
    shared = spark.sparkContext.broadcast(pivots)

    def post(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                unit = units(matrix(part.column("v")))
                reference = shared.value.get(int(dim), unit[:0])
                order = describe(unit, reference) if len(reference) > NEAREST else np.zeros((len(unit), 1), dtype=np.int32)
                lists = pa.array(list(order), pa.list_(pa.int32()))
                made = pa.array(list(unit), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("rep"), part.column("copies"), part.column("dim"), made, lists], names=["rep", "copies", "dim", "u", "near"])

    described = stored(classes.select("rep", "copies", "dim", "v").mapInArrow(post, "rep long, copies long, dim int, u array<double>, near array<int>"))
    postings = described.withColumn("pivot", F.explode(F.slice("near", 1, LISTED)))
    sizes = postings.groupBy("dim", "pivot").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("n_chunks"))
    placed = postings.join(F.broadcast(sizes), ["dim", "pivot"])  # lengths times pivots: bounded
    chunk = F.pmod(F.xxhash64("rep"), "n_chunks").cast("int")
    placed = placed.withColumn("chunk", chunk)
    # chunks i <= j meet at (i, j): a row is on the left for all j >= its chunk and on the right for all i < it
    left = F.transform(F.sequence(F.col("chunk"), F.col("n_chunks") - 1), lambda j: F.struct(F.col("chunk").alias("i"), j.alias("j")))
    right = F.transform(F.sequence(F.lit(0), F.col("chunk")), lambda i: F.struct(i.alias("i"), F.col("chunk").alias("j")))
    meeting = F.explode(F.array_distinct(F.concat(left, right))).alias("at")
    dealt = placed.select("dim", "pivot", "chunk", "rep", "copies", "u", "near", meeting).select("*", "at.i", "at.j").drop("at")

    def meet(key, table):
        pivot, i, j = (key[x].as_py() for x in (1, 2, 3))
        rep, copies, at = table["rep"].to_numpy(), table["copies"].to_numpy(), table["chunk"].to_numpy()
        u, near = matrix(table["u"].combine_chunks()), matrix(table["near"].combine_chunks())
        first = np.packbits(memberships(near[:, :LISTED])[:, :pivot], axis=1)  # lists before this one: a pair that meets there is theirs
        described = memberships(np.unique(near, return_inverse=True)[1].reshape(near.shape)).astype(np.float32)
        enough = min(SHARED, near.shape[1])
        one, other = np.flatnonzero(at == i), np.flatnonzero(at == j)
        count = np.zeros(len(rep), dtype=np.int64)
        found_a, found_b = [], []
        for s in range(0, len(one), 512):
            some = one[s : s + 512]
            candidate = described[some] @ described[other].T >= enough
            candidate &= u[some] @ u[other].T >= cosine - 1e-9  # a product of matrices may round otherwise
            if i == j:
                candidate &= rep[some][:, None] < rep[other]
            a, b = np.nonzero(candidate)
            for t in range(0, len(a), 200_000):
                x, y = some[a[t : t + 200_000]], other[b[t : t + 200_000]]
                good = (np.einsum("ij,ij->i", u[x], u[y]) >= cosine) & ~(first[x] & first[y]).any(axis=1)
                x, y = x[good], y[good]
                np.add.at(count, x, copies[y])
                np.add.at(count, y, copies[x])
                # what is joined already need not be kept as links
                node, root = forest(len(rep), np.concatenate([x, *found_a]), np.concatenate([y, *found_b]))
                found_a, found_b = [node], [root]
        edge_a = rep[found_a[0]] if found_a else rep[:0]
        edge_b = rep[found_b[0]] if found_b else rep[:0]
        linked = np.flatnonzero(count)
        none = np.full(len(linked), -1, dtype=np.int64)
        return pa.table({
            "a": np.concatenate([rep[linked], edge_a]),
            "b": pa.array(np.concatenate([none, edge_b]), mask=np.r_[np.ones(len(linked), bool), np.zeros(len(edge_a), bool)]),
            "n": np.concatenate([count[linked], np.zeros(len(edge_a), dtype=np.int64)]),
        })

    met = stored(dealt.groupBy("dim", "pivot", "i", "j").applyInArrow(meet, "a long, b long, n long"))
    counts = met.where(F.col("b").isNull()).groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    labels = components(met.where(F.col("b").isNotNull()).select("a", "b"))
    by_class = stored(
        classes.join(counts, "rep", "left").join(labels, F.col("rep") == F.col("node"), "left")
        .select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    v = F.col(embedding).cast("array<double>")
    all_rows = vectors.select(F.col(vec_id).alias("vec_id"), F.when(F.col(vec_id).isNotNull(), v).alias("w"))
    found = all_rows.join(by_class, F.col("w") == F.col("v"), "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
