"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Compiled from a model file: the normaliser (a machine over runs of spaces and runs of other characters, see Normaliser), the pieces (arcs that read a piece and
write its id, weighted with the negated score) and byte fallback (a character that is no piece is read whole and
written as the ids of its bytes, dearer than any piece). Composed with an input they form an acyclic graph over its
characters, whose shortest path in the tropical semiring (min, +) is the encoding.

That path is the encoding of a unigram model. A model of merges is composed with one more acceptor, over pairs of
neighbouring pieces: 0 for a pair that merging its own text leaves apart, infinite otherwise. A sequence of pieces
is the outcome of merging exactly if all its neighbouring pairs are, so one path of finite weight remains. Both kinds
of model go through the same shortest path, over states of a place and the last piece.

No piece holds a mark behind another character, or a line end, so every path passes through those places and the graph
is solved between them; equal stretches have equal shortest paths, and are solved once.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from functools import cached_property
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import with_columns_by_arrow, worker_memory
from .pieces import BYTE, MARK, NORMAL, default_path, read_model, read_normaliser

#: Added to the highest piece weight for a character outside the vocabulary, as in the published algorithm.
UNKNOWN_PENALTY = 10.0
#: Stretches, and pairs of pieces, that a worker remembers; bounds memory.
REMEMBERED = 500_000
RUNS = re.compile(" +|[^ ]+")
STRETCH = re.compile(f"{MARK}*[^{MARK}\\n]+|{MARK}+|\\n")


@dataclass(frozen=True)
class Normaliser:
    """The transducer in front of the pieces, with all weights 0. It reads runs of spaces and runs of other characters.

    States: FRONT (nothing written yet) and INSIDE. prefix: the first output is preceded by a mark. squeeze: a run of spaces
    writes one mark behind a word if another word follows, and nothing at the ends; otherwise it writes a mark a space.
    """

    prefix: bool = True
    squeeze: bool = False

    def __call__(self, text: str) -> str:
        if not self.squeeze:  # every space has one output whatever the state
            return (MARK if self.prefix and text else "") + text.replace(" ", MARK)
        inside, waiting, out = False, False, []
        for run in RUNS.findall(text):
            if run[0] == " ":
                waiting = inside
            else:
                out += [MARK if waiting or (self.prefix and not inside) else "", run]
                inside, waiting = True, False
        return "".join(out)


@dataclass(frozen=True)
class Transducer:
    """Compiled pieces: arcs are a trie; a node is (next nodes by character, piece or -1, weight).

    merging: whether the model is one of merges (BPE) and needs the acceptor of pairs.
    """

    pieces: tuple[tuple[str, float, int], ...]
    merging: bool = False
    normaliser: Normaliser = Normaliser()

    @cached_property
    def arcs(self) -> dict[str, tuple]:
        root: dict[str, tuple] = {}
        for i, (piece, score, kind) in enumerate(self.pieces):
            if kind == NORMAL:
                if MARK in piece.lstrip(MARK) or "\n" in piece:
                    raise ValueError(f"a piece crosses a word start or line end: {piece!r}")
                nodes = root
                for c in piece[:-1]:
                    nodes = nodes.setdefault(c, ({}, -1, 0.0))[0]
                nodes[piece[-1]] = (nodes.get(piece[-1], ({},))[0], i, -score)
        return root

    @cached_property
    def byte_ids(self) -> list[int]:
        by_name = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        return [by_name[f"<0x{b:02X}>"] for b in range(256)]

    @cached_property
    def unknown_weight(self) -> float:
        return max(-score for _, score, kind in self.pieces if kind == NORMAL) + UNKNOWN_PENALTY

    @cached_property
    def outputs(self) -> list[bytes]:
        """What decoding writes for each id: bytes of the piece, marks as spaces; nothing for control ids."""
        made = [p.replace(MARK, " ").encode() if kind == NORMAL else b"" for p, _, kind in self.pieces]
        for b, i in enumerate(self.byte_ids):
            made[i] = bytes([b])
        return made

    @cached_property
    def scores(self) -> dict[str, float]:
        return {p: score for p, score, kind in self.pieces if kind == NORMAL}

    @cached_property
    def _pairs(self) -> dict[int, bool]:
        return {}

    def merged(self, text: str) -> list[str]:
        """Outcome of merging the characters of a short text: best score first, leftmost first."""
        parts, score = list(text), self.scores.get
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                x = score(parts[i] + parts[i + 1])
                if x is not None and (best is None or x > best):
                    best, at = x, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stays(self, left: int, right: int) -> bool:
        """Acceptor of pairs. left -1: the start, or a character that is no piece."""
        texts = [self.pieces[i][0] for i in (left, right) if i >= 0]
        return self.merged("".join(texts)) == texts

    def _arcs_from(self, stretch: str, i: int) -> list[tuple[int, int, int, float]]:
        """(start, end, piece, weight) of the arcs at a place, shorter ones first; piece -1 for a character that is no piece."""
        found: list[tuple[int, int, int, float]] = []
        nodes = self.arcs
        for j in range(i, len(stretch)):
            node = nodes.get(stretch[j])
            if node is None:
                break
            nodes, piece, dear = node
            if piece >= 0:
                found.append((i, j + 1, piece, dear))
        if not found or found[0][1] > i + 1:
            found.insert(0, (i, i + 1, -1, self.unknown_weight))
        return found

    def shortest_path(self, stretch: str) -> list[int]:
        """Ids on the path of least weight."""
        ids: list[int] = []
        for start, end, piece in self._least_path(stretch):
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self.byte_ids[b] for b in stretch[start:end].encode())
        return ids

    def _least_path(self, stretch: str) -> list[tuple[int, int, int]]:
        """Tropical shortest path over the composed graph, which is made as it is followed: (start, end, piece) of its arcs.

        A place needs one state. Without the acceptor of pairs the last piece does not matter; arcs are relaxed in the order of
        places, and of paths that weigh the same into a place the one with the longest last arc stays. With it, the text
        before a place merges in one way, so one path of finite weight at most leads to it: arcs are relaxed latest and
        longest first, a place that is reached is final, and so is the end.
        """
        n, pairs, merging, inf = len(stretch), self._pairs, self.merging, float("inf")
        if len(pairs) > REMEMBERED:
            pairs.clear()
        weight = [0.0] + [inf] * n
        back = [(0, 0, -1)] * (n + 1)
        waiting = self._arcs_from(stretch, 0)
        while waiting:
            if merging:
                i, j, piece, dear = waiting.pop()
                if weight[j] < inf:
                    continue
                if piece >= 0:
                    last = back[i][2]
                    stays = pairs.get(pair := (last + 1) << 32 | piece)
                    if stays is None:
                        stays = pairs[pair] = self.stays(last, piece)
                    if not stays:
                        continue
            else:
                i, j, piece, dear = heappop(waiting)
                if weight[i] + dear >= weight[j]:
                    continue
            first = weight[j] == inf
            weight[j], back[j] = weight[i] + dear, (i, j, piece)
            if j == n:
                if merging:
                    break
            elif merging:
                waiting += self._arcs_from(stretch, j)
            elif first:
                for arc in self._arcs_from(stretch, j):
                    heappush(waiting, arc)
        path, at = [], n
        while at:
            path.append(back[at])
            at = back[at][0]
        return path[::-1]


def pack(ids: list[int]) -> bytes:
    return np.array(ids, dtype=np.int32).tobytes()


class Encoder:
    """Encodes texts; remembers stretches, the latest of them at least, with their ids as packed 32-bit numbers."""

    def __init__(self, transducer: Transducer):
        self.transducer = transducer
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.own_mark = pack([transducer.byte_ids[b] for b in MARK.encode()])

    def path(self, stretch: str) -> bytes:
        """Shortest path of a stretch that is not in `known`."""
        if len(self.known) >= REMEMBERED // 2:
            self.known, self.older = {}, self.known
        found = self.older.get(stretch) or pack(self.transducer.shortest_path(stretch))
        self.known[stretch] = found
        return found

    def packed(self, text: str) -> bytes:
        """Ids of a text; none for the empty text. A mark that the text itself holds goes through byte fallback, so that
        decoding gives it back."""
        if MARK not in text:
            return self._ids(self.transducer.normaliser(text))
        # own marks stand aside while the text is normalised, as a character that no text holds
        own = next(c for c in map(chr, range(0xE000, 0xF8FF)) if c not in text)
        return self.own_mark.join([self._ids(part) for part in self.transducer.normaliser(text.replace(MARK, own)).split(own)])

    def _ids(self, normal: str) -> bytes:
        return b"".join([self.known.get(stretch) or self.path(stretch) for stretch in STRETCH.findall(normal)])

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        return np.frombuffer(self.packed(text), dtype=np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        out = self.transducer.outputs
        text = b"".join(map(out.__getitem__, ids)).decode("utf-8", "replace")
        return text.removeprefix(" ") if self.transducer.normaliser.prefix else text


def compiled(path: str | None = None) -> Transducer:
    pieces, merging = read_model(path or default_path())
    return Transducer(pieces, merging, Normaliser(*read_normaliser(path or default_path())))


def _work(transducer: Transducer, docs: DataFrame, make):
    """A function for with_columns_by_arrow: make(encoder, column) gives the new columns."""
    shared = docs.sparkSession.sparkContext.broadcast((transducer.pieces, transducer.merging, transducer.normaliser))
    key = uuid.uuid4().hex

    def work(batches):
        encoder = worker_memory(("encoder", key), lambda: Encoder(Transducer(*shared.value)))
        for (column,) in batches:
            yield make(encoder, column)

    return work


def _packed(encoder: Encoder, column) -> tuple[list[bytes | None], pa.Array]:
    """Packed ids by row, and all of them as an Arrow column of lists."""
    rows = [None if (t := x.as_py()) is None else encoder.packed(t) for x in column]
    ends = np.cumsum([0, *[0 if x is None else len(x) // 4 for x in rows]])
    starts = pa.array(ends.astype(np.int32), mask=np.array([*[x is None for x in rows], False]))
    ids = pa.array(np.frombuffer(b"".join([x for x in rows if x is not None]), dtype=np.int32))
    return rows, pa.ListArray.from_arrays(starts, ids)


def _encoded(encoder: Encoder, column):
    return [_packed(encoder, column)[1]]


def _decoded(encoder: Encoder, column):
    return [pa.array([None if (ids := x.as_py()) is None else encoder.decode(ids) for x in column], pa.string())]


def _both(encoder: Encoder, column):
    rows, ids = _packed(encoder, column)
    decoded = [None if x is None else encoder.decode(np.frombuffer(x, dtype=np.int32).tolist()) for x in rows]
    return [ids, pa.array(decoded, pa.string())]


def encode(docs: DataFrame, transducer: Transducer, text: str = "text") -> DataFrame:
    """docs with pieces (array of ids). Null texts give null, empty ones no ids. Rows are independent: nothing is
    shuffled, repeated rows get equal results, extra columns stay, a column named pieces is replaced."""
    return with_columns_by_arrow(docs, [text], "pieces array<int>", _work(transducer, docs, _encoded))


def decode(docs: DataFrame, transducer: Transducer, pieces: str = "pieces") -> DataFrame:
    """docs with decoded (the text of the ids). Null gives null; control ids write nothing."""
    return with_columns_by_arrow(docs, [pieces], "decoded string", _work(transducer, docs, _decoded))


def encode_and_decode(docs: DataFrame, transducer: Transducer, text: str = "text") -> DataFrame:
    """docs with pieces as by `encode` and decoded as by `decode`, in one pass through Python."""
    return with_columns_by_arrow(docs, [text], "pieces array<int>, decoded string", _work(transducer, docs, _both))
