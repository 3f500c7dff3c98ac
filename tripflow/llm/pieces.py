"""The fixed public vocabulary of pieces, and words as lattices of pieces."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np

MARK = "▁"  # stands for a space, as in the vocabulary
NORMAL, BYTE = 1, 6  # kinds of pieces in the model file


def default_path() -> str:
    """The installed vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def _model(path: str):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(Path(path).read_bytes())
    return model


@lru_cache(maxsize=4)
def read_model(path: str) -> tuple[tuple[tuple[str, float, int], ...], bool]:
    """(piece, score, kind) by id, and whether the model merges pairs (BPE). Read on the driver only; tasks get what
    they need with the job."""
    model = _model(path)
    return tuple((p.piece, p.score, p.type) for p in model.pieces), model.trainer_spec.model_type == 2


@lru_cache(maxsize=4)
def read_normaliser(path: str) -> tuple[bool, bool]:
    """(whether a space goes in front, whether runs of spaces become one)."""
    spec = _model(path).normalizer_spec
    if spec.precompiled_charsmap or not spec.escape_whitespaces:
        raise ValueError("a model that maps characters, or does not mark spaces, is not compiled")
    return spec.add_dummy_prefix, spec.remove_extra_whitespaces


@dataclass(frozen=True)
class Lattice:
    """Arcs of many words, sorted by word, then end. Node i of a word lies before its character i."""

    n_words: int
    lengths: np.ndarray
    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray


class Trie:
    """The pieces, character by character, as sorted arrays, so that many places of many words take a step at once.

    A step is numbered node * letters + letter; node 0 is the root. piece_at has the id of the piece that ends in a node, or -1.
    """

    def __init__(self, pieces: Sequence[str]):
        self.alphabet = np.zeros(sys.maxunicode + 2, dtype=np.int32)  # 0: in no piece
        letters = sorted({c for p in pieces for c in p})
        self.alphabet[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.letters = len(letters) + 1
        steps: dict[tuple[int, str], int] = {}
        piece_at = {}
        for i, p in enumerate(pieces):
            node = 0
            for c in p:
                node = steps.setdefault((node, c), len(steps) + 1)
            piece_at[node] = i
        numbers = np.array([node * self.letters + int(self.alphabet[ord(c)]) for node, c in steps], dtype=np.int64)
        order = np.argsort(numbers)
        self.steps, self.target = numbers[order], np.arange(1, len(steps) + 1)[order]
        self.piece_at = np.full(len(steps) + 1, -1, dtype=np.int64)
        self.piece_at[list(piece_at)] = list(piece_at.values())

    def follow(self, node: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indices of the steps that exist, nodes that they lead to)."""
        number = node * self.letters + letter
        at = np.searchsorted(self.steps, number).clip(max=max(len(self.steps) - 1, 0))
        there = np.flatnonzero((letter > 0) & (self.steps[at] == number)) if len(self.steps) else at[:0]
        return there, self.target[at[there]]


def lattice(words: Sequence[str], trie: Trie, unknown: int) -> Lattice:
    """All pieces that stand anywhere in the words; a character that is no piece gets an arc `unknown`."""
    lengths = np.array([len(x) for x in words], dtype=np.int64)
    signs = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letters = np.r_[trie.alphabet[signs], [0]].astype(np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    last = np.repeat(np.cumsum(lengths), lengths)  # where the word of each place ends
    place = np.arange(len(signs))
    found = []
    at, node, n = place, np.zeros(len(signs), dtype=np.int64), 0
    while n == 0 or len(at):
        there, node = trie.follow(node, letters[at + n])
        if n == 0:  # every character has an arc of its own
            alone = np.full(len(signs), unknown, dtype=np.int64)
            one = trie.piece_at[node]
            alone[at[there[one >= 0]]] = one[one >= 0]
            found.append((place, 1, alone))
        at, n = at[there], n + 1
        if n > 1:
            piece = trie.piece_at[node]
            found.append((at[piece >= 0], n, piece[piece >= 0]))
        more = np.flatnonzero(at + n < last[at])
        at, node = at[more], node[more]
    start = np.concatenate([x for x, _, _ in found])
    size = np.concatenate([np.full(len(x), n, dtype=np.int64) for x, n, _ in found])
    piece = np.concatenate([x for _, _, x in found])
    order = np.argsort((start + size) * (len(found) + 1) - size)  # by end, then start: words lie behind each other
    start, size, piece = start[order], size[order], piece[order]
    base = np.r_[0, np.cumsum(lengths)][word[start]]
    return Lattice(len(words), lengths, word[start], start - base, start - base + size, piece)
