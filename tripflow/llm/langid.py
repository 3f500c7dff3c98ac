"""Language identification by segmentation-marginalised unigrams.

A word is a run of letters in lower case behind the mark of a word start. Each language has a probability for every
piece of a fixed public vocabulary; the probability of a word is the sum over all its segmentations into pieces, by the
forward algorithm. A text's score is the product over its words. Probabilities are fitted by expectation maximisation
over labelled texts, with the forward-backward algorithm on distinct words.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, with_columns_by_arrow, worker_memory
from .pieces import MARK, NORMAL, Lattice, Trie, default_path, lattice, read_model

UNDETERMINED = "und"
#: Bound (about) on the labelled texts of each language used for fitting; they are picked by a hash of doc_id.
TRAIN_DOCS = 3_000
ROUNDS = 2
SMOOTHING = 0.01
#: Words scored together, and words a worker remembers: both bound memory.
CHUNK_CHARS = 1_000_000
REMEMBERED = 250_000
RUNS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """log_p: row per piece (the last row: a character outside the vocabulary), column per language."""

    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_p: np.ndarray
    pieces: tuple[str, ...]


def vocabulary(path: str | None = None) -> tuple[str, ...]:
    """Pieces that lower-case words can hold: letters, with or without the mark of a word start."""
    found = [p for p, _, kind in read_model(path or default_path())[0] if kind == NORMAL]
    return tuple(p for p in found if p == MARK or ((b := p.removeprefix(MARK)).isalpha() and b == b.lower()))


def _levels(lat: Lattice):
    """Arcs by end node, with the bounds of each word's arcs in them."""
    by_end = np.lexsort((lat.word, lat.end))
    ends = lat.end[by_end]
    cuts = np.flatnonzero(np.diff(ends)) + 1
    for arcs in np.split(by_end, cuts) if len(by_end) else []:
        words = lat.word[arcs]
        first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
        yield arcs, first, words[first], int(lat.end[arcs[0]])


def forward(lat: Lattice, log_p: np.ndarray) -> np.ndarray:
    """Log of the summed probability of all paths to every node: nodes of all words in a row, columns as in log_p."""
    base = np.r_[0, np.cumsum(lat.lengths + 1)]
    alpha = np.full((base[-1], log_p.shape[1]), -np.inf)
    alpha[base[:-1]] = 0.0
    for arcs, first, words, end in _levels(lat):
        into = alpha[base[lat.word[arcs]] + lat.start[arcs]] + log_p[lat.piece[arcs]]
        alpha[base[words] + end] = np.logaddexp.reduceat(into, first, axis=0)
    return alpha


def word_scores(words: Sequence[str], trie: Trie, log_p: np.ndarray) -> np.ndarray:
    """Log probability of each word (with its mark) per language."""
    lat = lattice(words, trie, len(log_p) - 1)
    alpha = forward(lat, log_p)
    return alpha[np.cumsum(lat.lengths + 1) - 1]


def expected_counts(words: Sequence[str], counts: np.ndarray, trie: Trie, log_p: np.ndarray) -> np.ndarray:
    """Expected number of times that each piece is used (log_p of one language, as a column), over all segmentations."""
    lat = lattice(words, trie, len(log_p) - 1)
    alpha = forward(lat, log_p)[:, 0]
    base = np.r_[0, np.cumsum(lat.lengths + 1)]
    beta = np.full(base[-1], -np.inf)
    beta[base[1:] - 1] = 0.0
    by_start = np.lexsort((lat.word, -lat.start))
    cuts = np.flatnonzero(np.diff(lat.start[by_start])) + 1
    for arcs in np.split(by_start, cuts) if len(by_start) else []:
        owner = lat.word[arcs]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out = beta[base[owner] + lat.end[arcs]] + log_p[lat.piece[arcs], 0]
        beta[base[owner[first]] + lat.start[arcs[0]]] = np.logaddexp.reduceat(out, first)
    node = base[lat.word]
    log_used = alpha[node + lat.start] + log_p[lat.piece, 0] + beta[node + lat.end] - alpha[base[lat.word + 1] - 1]
    return np.bincount(lat.piece, np.exp(log_used) * counts[lat.word], minlength=len(log_p))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS, path: str | None = None) -> Model:
    """Probabilities from the rows of docs with text, language and id: about train_docs of each language at most, picked by
    hash, so that a rare language is learned at every size; all rows count for the prior.

    What reaches the driver is bounded by vocabulary times languages. No usable row gives a model without languages.
    """
    spark, pieces = docs.sparkSession, vocabulary(path)
    usable = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(doc_id).isNotNull())
    prior = {r["lang"]: r["n"] for r in usable.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(prior))
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, int(min(1.0, train_docs / prior[name]) * (1 << 20)))]) if languages else F.create_map()
    picked = F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(1 << 20)) < (F.element_at(share, F.col(lang)) if languages else F.lit(0))
    sample = usable.where(picked).select(F.col(lang).alias("lang"), F.lower(F.col(text)).alias("text"))
    words = stored(
        sample.select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"))).alias("word"))
        .groupBy("lang", "word").agg(F.count("*").alias("n"))
    )
    log_p = np.full((len(pieces) + 1, max(len(languages), 1)), -np.log(len(pieces) + 1))
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast((pieces, languages, log_p))

        def expect(batches, shared=shared):
            worker_memory(("expect",), dict)  # drops what an earlier operator has left
            pieces, languages, log_p = shared.value
            trie = Trie(pieces)
            sums = np.zeros_like(log_p)
            for batch in batches:
                column = dict(zip(batch.schema.names, batch.columns, strict=True))
                owner, names = np.array(column["lang"].to_pylist(), dtype=object), column["word"].to_pylist()
                counts = column["n"].to_numpy(zero_copy_only=False).astype(float)
                for k, name in enumerate(languages):
                    rows = np.flatnonzero(owner == name)
                    if len(rows):
                        sums[:, k] += expected_counts([MARK + names[i] for i in rows], counts[rows], trie, log_p[:, [k]])
            piece, k = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(k), pa.array(sums[piece, k])], names=["piece", "k", "n"])

        parts = words.mapInArrow(expect, "piece long, k long, n double").groupBy("piece", "k").agg(F.sum("n").alias("n"))
        used = np.full_like(log_p, SMOOTHING)
        for r in parts.collect():
            used[r["piece"], r["k"]] += r["n"]
        log_p = np.log(used / used.sum(axis=0))
    total = sum(prior.values()) or 1
    return Model(languages, np.log(np.array([prior[x] / total for x in languages])), log_p, pieces)


class _Scorer:
    """Scores texts; remembers words it has scored in two generations of REMEMBERED // 2: a word that is met again moves to
    the younger one, and the elder one goes when the younger is full."""

    def __init__(self, model: Model):
        self.model, self.trie = model, Trie(model.pieces)
        self._begin()
        self.older, self.older_scores, self.older_letters = {}, self.scores[:0], self.letters[:0]

    def _begin(self) -> None:
        self.ids: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.languages)))
        self.letters = np.zeros(1024, dtype=bool)  # whether a word holds any letter

    def _rows(self, n: int) -> int:
        """Room for n more words; where they begin."""
        at = len(self.ids)
        while at + n > len(self.scores):
            self.scores, self.letters = np.vstack([self.scores, np.zeros_like(self.scores)]), np.r_[self.letters, np.zeros_like(self.letters)]
        return at

    def _keep(self, words: list[str], scores: np.ndarray, letters: np.ndarray) -> None:
        at = self._rows(len(words))
        self.scores[at : at + len(words)], self.letters[at : at + len(words)] = scores, letters
        self.ids.update(zip(words, range(at, at + len(words)), strict=True))

    def learn(self, words: list[str]) -> None:
        if len(self.ids) > REMEMBERED // 2:
            self.older, self.older_scores, self.older_letters = self.ids, self.scores, self.letters
            self._begin()
        missing = set(words).difference(self.ids)
        again = [w for w in missing if w in self.older]
        if again:
            rows = [self.older[w] for w in again]
            self._keep(again, self.older_scores[rows], self.older_letters[rows])
            missing.difference_update(again)
        new = sorted(missing)
        if not new:
            return
        # a run may hold number signs that are no letters: score its letters, run by run
        plain = [i for i, w in enumerate(new) if w.isalpha()]
        made, letters = np.zeros((len(new), len(self.model.languages))), np.zeros(len(new), dtype=bool)
        made[plain], letters[plain] = word_scores([MARK + new[i] for i in plain], self.trie, self.model.log_p), True
        for i in set(range(len(new))) - set(plain):
            runs = "".join(c if c.isalpha() else " " for c in new[i]).split()
            if runs:
                made[i], letters[i] = word_scores([MARK + r for r in runs], self.trie, self.model.log_p).sum(axis=0), True
        self._keep(new, made, letters)

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, values = [], []
        words = [RUNS.findall(t.lower()) if t else [] for t in texts]
        if self.model.languages:
            self.learn([w for ws in words for w in ws])
        ids = self.ids
        for ws in words:
            rows = [ids[w] for w in ws] if self.model.languages else []
            if not rows or not self.letters[rows].any():
                names.append(UNDETERMINED), values.append(0.0)
                continue
            total = self.model.log_prior + self.scores[rows].sum(axis=0)
            best = int(total.argmax())  # ties: the language that sorts first
            names.append(self.model.languages[best]), values.append(float(1 / np.exp(total - total[best]).sum()))
        return names, values


def _pieces_of(texts: list[str | None]):
    """Runs of texts of about CHUNK_CHARS characters together."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK_CHARS:
            yield texts[at : i + 1]
            at, size = i + 1, 0
    yield texts[at:]


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (the posterior of lang_pred, 0 to 1).

    Texts that are null or hold no letter get `und` and 0, as do all texts if the model has no language. Rows are
    independent: nothing is shuffled, repeated rows get equal results, extra columns stay, added names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prior, model.log_p, model.pieces))
    key = uuid.uuid4().hex

    def work(batches):
        scorer = worker_memory(("scorer", key), lambda: _Scorer(Model(*shared.value)))
        for (column,) in batches:
            names, values = [], []
            for some in _pieces_of(column.to_pylist()):
                a, b = scorer.texts(some)
                names += a
                values += b
            yield [pa.array(names, pa.string()), pa.array(values, pa.float64())]

    return with_columns_by_arrow(docs, [text], "lang_pred string, score double", work)
