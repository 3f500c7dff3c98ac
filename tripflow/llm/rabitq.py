"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector is centred, normalised and rotated; the signs of its rotated components are its code, one bit each, kept
with two scalars: its length, and the inner product of code and vector. For a query, inner products with all vectors of
a block follow from the packed bits and these scalars, with an error bound that holds with high probability. A vector
whose lower bound on the distance exceeds the k-th smallest upper bound of its block is left out; the others are
reranked by their exact distance.

Index and queries are dealt into blocks of bounded size and meet block by block; of each meeting only k rows a query
go on. The queries are a stated set: the rows whose id is divisible by `every`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import matrix, rotation, usable

K = 10
EVERY = 100
SEED = 11
#: Width of the error bound in its standard deviations: a bound fails about once in 10^7 comparisons at 5.
EPSILON = 5.0
#: Bytes of the vectors of a block, of the index or of queries; they bound what meets in one step of a task. An index row is
#: copied once per block of queries: at 64 components once per 3.3 million rows.
BLOCK_BYTES = 16 * 2**20
#: Queries compared at once within a meeting.
STEP = 128


def encode(v: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distance to the centre, and inner product of the unit code with the unit vector."""
    r = (v - centre) @ turn
    norm = np.sqrt((r * r).sum(axis=1))  # components are scaled to 1 at most
    dim = v.shape[1]
    product = np.abs(r).sum(axis=1) / (np.where(norm > 0, norm, 1.0) * np.sqrt(dim))
    return np.packbits(r > 0, axis=1), norm, np.where(norm > 0, product, 1.0)


def distances(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of v to q; squares that would leave the range of doubles are taken of scaled components."""
    apart = v - q
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        plain = np.sqrt((apart**2).sum(axis=1))
    odd = np.flatnonzero(~((plain > 1e-150) & (plain < 1e150)))
    if len(odd):
        largest = np.abs(apart[odd]).max(axis=1)
        scale = np.where((largest > 0) & np.isfinite(largest), largest, 1.0)
        plain[odd] = scale * np.sqrt(((apart[odd] / scale[:, None]) ** 2).sum(axis=1))
    return plain


def bounds(bits: np.ndarray, norm: np.ndarray, product: np.ndarray, q: np.ndarray, centre: np.ndarray, turn: np.ndarray, epsilon: float = EPSILON):
    """Estimated squared distances (query, vector) and the half-width of their bounds."""
    dim = q.shape[1]
    r = (q - centre) @ turn
    q_norm = np.sqrt((r * r).sum(axis=1))
    unit = r / np.where(q_norm > 0, q_norm, 1.0)[:, None]
    signs = (np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
    cosine = (unit.astype(np.float32) @ signs.T).astype(np.float64) / product
    scale = 2 * q_norm[:, None] * norm
    width = scale * (epsilon * np.sqrt((1 - product**2).clip(0) / max(dim - 1, 1)) / product + 1e-5)
    return q_norm[:, None] ** 2 + norm**2 - scale * cosine, width


def _block(rows: DataFrame, name: str, block_bytes: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """rows with dim and block, and (dim, number of blocks). The latter are stored, so that joins go by their measured size."""
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") * F.col("dim") * 8 / block_bytes).cast("int").alias("n_blocks"))
    sizes = stored(sizes)
    dealt = rows.join(sizes, "dim")  # one row per length of vector
    return dealt.withColumn(name, F.pmod(F.xxhash64("vec_id", F.lit(seed)), "n_blocks").cast("int")).drop("n_blocks"), sizes


def search(vectors: DataFrame, k: int = K, every: int = EVERY, seed: int = SEED, vec_id: str = "vec_id", embedding: str = "embedding", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query, nearest first, ties to the smaller vec_id.

    score is the Euclidean distance of the original vectors in double precision. Candidates are all rows but those with
    the query's own id; if there are fewer than k, all are returned. Rows with a null id, or a vector that is null,
    empty, zero or holds null or non-finite components take no part. Repeated rows of an id are one row where their
    vectors are equal. Vectors are compared with vectors of their own length. An empty table gives no rows.
    """
    rows = stored(usable(vectors, vec_id, embedding).distinct())
    # the centre and the largest component of each length: one row of sums per component
    components = rows.select("dim", F.posexplode("v").alias("i", "x"))
    largest = components.groupBy("dim").agg(F.max(F.abs("x")).alias("largest"))
    parts = components.join(largest, "dim").groupBy("dim", "i").agg(F.avg(F.col("x") / F.col("largest")).alias("m"), F.first("largest").alias("largest"))
    centres = stored(parts.groupBy("dim").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("centre"), F.first("largest").alias("largest")
    ))
    index, sizes = _block(rows, "block", block_bytes, seed)
    coded = "vec_id long, v array<double>, dim int, block int, bits binary, norm double, product double"

    def code(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                centre = matrix(part.column("centre"))[0]
                largest = part.column("largest")[0].as_py()
                bits, norm, product = encode(matrix(part.column("v")) / largest, centre, rotation(int(dim), seed))
                columns = [part.column(c) for c in ("vec_id", "v", "dim", "block")]
                made = [pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(norm), pa.array(product)]
                yield pa.RecordBatch.from_arrays(columns + made, names=["vec_id", "v", "dim", "block", "bits", "norm", "product"])

    index = index.join(centres, "dim").select("vec_id", "v", "dim", "block", "centre", "largest").mapInArrow(code, coded)
    asked, q_sizes = _block(rows.where(F.col("vec_id") % every == 0), "q_block", block_bytes, seed + 1)
    # every block of the index meets every block of queries once
    other = lambda name: F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias(name)
    asked = asked.join(sizes, "dim").join(centres, "dim").select("vec_id", "v", "dim", "centre", "largest", "q_block", other("block"))
    index = index.join(q_sizes, "dim").select(*index.columns, other("q_block"))

    def meet(key, of_index: pa.Table, of_queries: pa.Table) -> pa.Table:
        out = []
        if len(of_index) and len(of_queries):
            dim = key[0].as_py()
            turn = rotation(dim, seed)
            ids, v = of_index["vec_id"].to_numpy(), matrix(of_index["v"].combine_chunks())
            order = np.argsort(ids, kind="stable")
            bits = np.frombuffer(b"".join(of_index["bits"].to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
            norm, product = of_index["norm"].to_numpy(), of_index["product"].to_numpy()
            ids, v, bits, norm, product = ids[order], v[order], bits[order], norm[order], product[order]
            centre, largest = np.array(of_queries["centre"][0].as_py()), of_queries["largest"][0].as_py()
            q_ids, q = of_queries["vec_id"].to_numpy(), matrix(of_queries["v"].combine_chunks())
            for at in range(0, len(q_ids), STEP):
                some, own = q[at : at + STEP], q_ids[at : at + STEP]
                near, width = bounds(bits, norm, product, some / largest, centre, turn)
                mine = own[:, None] == ids
                upper = np.where(mine, np.inf, near + width)
                kth = np.partition(upper, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
                keep = ~(near - width > kth[:, None]) & ~mine  # what cannot be told stays
                for i in range(len(some)):
                    chosen = np.flatnonzero(keep[i])
                    exact = distances(v[chosen], some[i])
                    best = np.lexsort((ids[chosen], exact))[:k]
                    out.append((np.full(len(best), own[i]), ids[chosen][best], exact[best]))
        columns = [np.concatenate([x[c] for x in out]) if out else np.array([], dtype=t) for c, t in enumerate((np.int64, np.int64, np.float64))]
        return pa.table({"query_id": columns[0], "vec_id": columns[1], "score": columns[2]})

    pair = ["dim", "block", "q_block"]
    met = index.groupBy(*pair).cogroup(asked.groupBy(*pair)).applyInArrow(meet, "query_id long, vec_id long, score double")
    # an id with several vectors is one candidate, at its nearest
    near = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
