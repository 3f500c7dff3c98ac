"""Alignment of two tokenizers: a byte-level vocabulary (A) and a vocabulary of pieces (B), over the same bytes.

Byte offsets where tokens of both end cut a text into groups; two tokens are linked where their bytes overlap. Most
groups are one token of each with the same bytes, so an identity map (A id to the B id of the same bytes) is made first:
links that it holds are counted in a vector as long as the vocabulary, one per task. Only the other links, of irregular
groups, become pairs, and these leave a task once per batch of documents, with the number of documents that hold them.

Batches are stored as one row each. Pairs are summed over the corpus, joined back once per batch, and every document
reads its counts by position. What is broadcast are the vocabularies and vectors of their length.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROWS, stored, worker_memory
from .pieces import BYTE, MARK, default_path, read_model

#: Bytes of text measured at once, and of a batch: both bound memory. A longer text is measured whole, on its own.
PART_BYTES, BATCH_BYTES = 1 << 19, 1 << 21
BATCH = (
    "batch long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
    "keys array<int>, key_docs array<int>, entries array<int>, entry_key array<int>, entry_times array<int>, "
    "same_entries array<int>, same_a array<int>, same_times array<int>, vector array<long>"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable bytes are themselves, the others follow
    from sign 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Vocabularies:
    """What tasks need of both: the bytes of A's tokens by id (None: special), the pattern that splits texts before A's
    merges, and B's model file with the bytes of its tokens by id."""

    a_bytes: tuple[bytes | None, ...]
    pattern: str
    b_bytes: tuple[bytes, ...]
    b_model: bytes

    @cached_property
    def identity(self) -> np.ndarray:
        """The B id with the same bytes as each A id, or -1. Of several, the last: pieces come after byte tokens."""
        by_bytes = {x: i for i, x in enumerate(self.b_bytes) if x}
        return np.array([by_bytes.get(x, -1) for x in self.a_bytes], dtype=np.int64)

    @property
    def span(self) -> int:
        """Pairs are numbered a * len(b) + b, below this."""
        return len(self.a_bytes) * len(self.b_bytes)


def vocabularies(a_path: str | None = None, b_path: str | None = None) -> Vocabularies:
    """Read on the driver only. A's merges must be in the order of their ids, so that ranks are ids."""
    import public_tokenizers

    spec = json.loads(Path(a_path or public_tokenizers.path("byte_bpe_50k.json")).read_text())
    vocabulary = spec["model"]["vocab"]
    special = {t["content"] for t in spec["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    if any(vocabulary[x + y] != 256 + i for i, (x, y) in enumerate(merges)) or spec["normalizer"]:
        raise ValueError("the byte-level vocabulary must have merges in the order of ids, and no normaliser")
    signs = byte_signs()
    a_bytes: list[bytes | None] = [None] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        if token not in special:
            a_bytes[i] = bytes(signs[c] for c in token)
    path = b_path or default_path()
    b_bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in read_model(path)[0]]
    return Vocabularies(tuple(a_bytes), public_tokenizers.PATTERN, tuple(b_bytes), Path(path).read_bytes())


class Aligner:
    """Both tokenizers, and what follows from their vocabularies."""

    def __init__(self, words: Vocabularies):
        import sentencepiece
        import tiktoken

        ranks = {x: i for i, x in enumerate(words.a_bytes) if x is not None}
        self.a = tiktoken.Encoding(f"a-{uuid.uuid4().hex}", pat_str=words.pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=words.b_model)
        self.a_bytes, self.b_bytes = [x or b"" for x in words.a_bytes], list(words.b_bytes)
        self.a_length, self.b_length = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        self.identity, self.span = words.identity, words.span
        numbers = np.array([b"%d" % i for i in range(max(len(self.a_bytes), len(self.b_bytes)))], dtype=object)
        self.written = {sign: numbers + sign for sign in (b",", b"|", b";")}

    def tokens(self, texts: Sequence[str | None]) -> tuple[list[Sequence[int]], list[Sequence[int]]]:
        """A and B ids of each text; none where the joined bytes of either differ from a space and the text."""
        given = [i for i, t in enumerate(texts) if t]
        a: list[Sequence[int]] = [()] * len(texts)
        b: list[Sequence[int]] = [()] * len(texts)
        for i, of_b in zip(given, self.b.encode([texts[i] for i in given], num_threads=1) if given else [], strict=True):
            spaced = " " + texts[i]
            of_a, raw = self.a.encode_ordinary(spaced), spaced.encode()
            if b"".join([self.a_bytes[x] for x in of_a]) == raw == b"".join([self.b_bytes[x] for x in of_b]):
                a[i], b[i] = of_a, of_b
        return a, b

    def measure(self, texts: Sequence[str | None]) -> Measured:
        """All texts as one run of bytes: every text's end is an end of both, so no group crosses it."""
        a_ids, b_ids = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=n.sum()) for ids, n in ((a_ids, n_a), (b_ids, n_b)))
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        size = int(a_end[-1]) + 1 if len(a) else 1
        full = np.flatnonzero(n_a)
        ends_a, ends_b, ends_text = (np.zeros(size, dtype=bool) for _ in range(3))
        ends_a[a_end], ends_b[b_end], ends_text[a_end[np.cumsum(n_a)[full] - 1]] = True, True, True
        common = np.flatnonzero(ends_a & ends_b)
        # how many end at an offset or before: the token, text or group that covers the byte after it
        a_upto, b_upto, text_upto = (np.cumsum(x, dtype=np.int32) for x in (ends_a, ends_b, ends_text))
        n_groups = np.zeros(len(texts), dtype=np.int64)
        n_groups[full] = np.bincount(text_upto[common - 1], minlength=len(full))
        # between neighbouring ends lies one token of each: a link
        before = np.flatnonzero(ends_a | ends_b) - 1
        pair = a[a_upto[before]] * len(self.b_bytes) + b[b_upto[before]]
        coded = np.sort(full[text_upto[before]] * self.span + pair)
        first = np.flatnonzero(np.r_[True, coded[1:] != coded[:-1]][: len(coded)])
        coded, times = coded[first], np.diff(np.r_[first, len(coded)])
        digests = self._digests(a, b, a_end, b_end, common, a_upto, b_upto, np.cumsum(ends_a & ends_b, dtype=np.int32), n_a + n_b)
        return Measured(n_a, n_b, n_groups, coded // self.span, coded % self.span, times, digests)

    def _digests(self, a, b, a_end, b_end, common, a_upto, b_upto, group_upto, sizes) -> list[str]:
        """SHA-256 of each text's groups, written as a1,a2|b1;a3|b2: tokens are written to their places in one array."""
        a_until, b_until = a_upto[common], b_upto[common]
        a_place = np.arange(len(a)) + np.r_[0, b_until][group_upto[a_end - 1]]
        b_place = np.arange(len(b)) + np.r_[a_until, 0][group_upto[b_end - 1]]
        text = np.empty(len(a) + len(b), dtype=object)
        text[a_place], text[b_place] = self.written[b","][a], self.written[b","][b]
        text[a_place[a_until - 1]] = self.written[b"|"][a[a_until - 1]]
        text[b_place[b_until - 1]] = self.written[b";"][b[b_until - 1]]
        cuts = np.r_[0, np.cumsum(sizes)]
        return [sha256(b"".join(text[s:e])[:-1]).hexdigest() if e > s else "" for s, e in zip(cuts[:-1], cuts[1:], strict=True)]


@dataclass
class Measured:
    """Per text: numbers of tokens and groups, and a digest. Per text and linked pair: the text's index, the pair's number
    and how often it is linked there, by text and pair."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    owner: np.ndarray
    pair: np.ndarray
    times: np.ndarray
    digests: list[str]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, int]]:
    """(ids, texts, bytes) of about PART_BYTES."""
    ids, texts, size = [], [], 0
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            some = whole.slice(at, ROWS)
            for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                ids.append(doc_id), texts.append(text)
                size += len(text or "")
                if size >= PART_BYTES or len(ids) >= ROWS:
                    yield ids, texts, size
                    ids, texts, size = [], [], 0
    if ids:
        yield ids, texts, size


def _batch_row(number: int, ids: list, parts: list[Measured], same: np.ndarray, n_b_ids: int, vector: np.ndarray) -> pa.RecordBatch:
    """A batch as one row; the documents that hold each identity link are added to the task's vector."""
    n_a, n_b, n_groups = (np.concatenate([getattr(p, c) for p in parts]) for c in ("n_a", "n_b", "n_groups"))
    base = np.cumsum([0, *(len(p.n_a) for p in parts)])
    owner = np.concatenate([p.owner + s for p, s in zip(parts, base, strict=False)])
    pair, times = (np.concatenate([getattr(p, c) for p in parts]) for c in ("pair", "times"))
    a = pair // n_b_ids
    regular = same[a] == pair % n_b_ids
    np.add.at(vector, a[regular], 1)  # a pair comes once per document
    keys, at, docs = np.unique(pair[~regular], return_inverse=True, return_counts=True)
    per_doc = lambda rows: np.bincount(owner[rows], minlength=len(ids))
    digests = [d for p in parts for d in p.digests]
    ints = (keys, docs, per_doc(~regular), at, times[~regular], per_doc(regular), a[regular], times[regular])
    longs = [pa.array(x, pa.int64()) for x in (ids, n_a, n_b, n_groups, n_a + n_b - n_groups)]
    columns = [*longs, pa.array(digests, pa.string()), *[pa.array(x.astype(np.int32)) for x in ints], pa.array([], pa.int64())]
    return _one_row(number, columns)


def _one_row(number: int | None, columns: Sequence[pa.Array]) -> pa.RecordBatch:
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in columns]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists], names=[x.split()[0] for x in BATCH.split(", ")])


def _vector_row(vector: np.ndarray) -> pa.RecordBatch:
    empty = [pa.array([], pa.string() if "string" in x else pa.int64() if "long" in x else pa.int32()) for x in BATCH.split(", ")[1:-1]]
    return _one_row(None, [*empty, pa.array(vector)])


def align(docs: DataFrame, words: Vocabularies, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_links counts pairs of token occurrences whose bytes overlap; a pair of ids counts as often as rows of docs hold it
    linked. count_sum adds these counts over the links of a row, n_best counts its links whose count is the highest of
    their A id, ties included. groups_sha256 digests the groups as a1,a2|b1;a3|b2.

    Texts that are null or empty, or not restored by the bytes of either's tokens, have no tokens: zeros and ''. Repeated
    rows each count as a document and keep their row, null ids stay, other columns are not read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(words)
    n_a_ids, n_b_ids, key = len(words.a_bytes), len(words.b_bytes), uuid.uuid4().hex

    def measure(batches):
        aligner = worker_memory(("aligner", key), lambda: Aligner(shared.value))
        vector = np.zeros(n_a_ids, dtype=np.int64)
        number = (TaskContext.get().partitionId() << 32) - 1
        ids, parts, size = [], [], 0
        for some_ids, texts, n in _parts(batches):
            if ids and size + n > BATCH_BYTES:
                yield _batch_row(number := number + 1, ids, parts, aligner.identity, n_b_ids, vector)
                ids, parts, size = [], [], 0
            ids += some_ids
            parts.append(aligner.measure(texts))
            size += n
        if ids:
            yield _batch_row(number := number + 1, ids, parts, aligner.identity, n_b_ids, vector)
        if vector.any():
            yield _vector_row(vector)

    batches = stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(measure, BATCH))
    pairs = batches.where("size(keys) > 0").select("batch", F.explode(F.arrays_zip("keys", "key_docs")).alias("p")).select("batch", "p.keys", "p.key_docs")
    counts = stored(pairs.groupBy("keys").agg(F.sum("key_docs").alias("n")))
    # vectors as long as the vocabulary: all that reaches the driver
    same, best = np.zeros(n_a_ids, dtype=np.int64), np.zeros(n_a_ids, dtype=np.int64)
    for r in batches.select(F.posexplode("vector").alias("a", "n")).where("n > 0").groupBy("a").agg(F.sum("n").alias("n")).toLocalIterator():
        same[r["a"]] = best[r["a"]] = r["n"]
    for r in counts.groupBy(F.expr(f"keys div {n_b_ids}").alias("a")).agg(F.max("n").alias("n")).toLocalIterator():
        best[r["a"]] = max(best[r["a"]], r["n"])
    vectors = spark.sparkContext.broadcast((same, best))

    found = pairs.select("batch", "keys").join(counts, "keys").groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("keys", "n"))).alias("found"))
    by_batch = batches.where("batch is not null").drop("vector", "key_docs").join(found.select("batch", F.col("found.n").alias("n")), "batch", "left")

    def finish(tables):
        same, best = vectors.value
        for whole in tables:
            for row in range(whole.num_rows):
                one = {n: c.slice(row, 1).flatten() if pa.types.is_list(c.type) else c[row] for n, c in zip(whole.schema.names, whole.columns, strict=True)}
                size = len(one["doc_id"])
                numbers = {n: x.to_numpy(zero_copy_only=False) for n, x in one.items() if n not in ("batch", "doc_id", "groups_sha256")}
                count_sum, n_best = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
                entry_a = numbers["keys"][numbers["entry_key"]] // n_b_ids
                entry_count = numbers["n"][numbers["entry_key"]] if len(entry_a) else entry_a
                for per_doc, a, count, times in (
                    ("entries", entry_a, entry_count, "entry_times"),
                    ("same_entries", numbers["same_a"], same[numbers["same_a"]], "same_times"),
                ):
                    owner = np.repeat(np.arange(size), numbers[per_doc])
                    times = numbers[times].astype(np.int64)
                    np.add.at(count_sum, owner, times * count)
                    np.add.at(n_best, owner, np.where(count == best[a], times, 0))
                made = [one["doc_id"], *[one[c] for c in ("n_a", "n_b", "n_groups", "n_links")], pa.array(n_best), pa.array(count_sum), one["groups_sha256"]]
                yield pa.RecordBatch.from_arrays(made, names=[x.split()[0] for x in RESULT.split(", ")])

    return by_batch.mapInArrow(finish, RESULT)
