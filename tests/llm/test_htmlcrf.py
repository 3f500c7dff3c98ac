"""The chain against enumeration of all labellings, pages without landmarks, and hostile markup."""

import itertools
import re
import time

import numpy as np
import pyarrow.parquet as pq
import pytest
from tripflow.llm import htmlcrf

PAGES = pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()


def score(model, features, labels):
    total = model.first[labels[0]] + sum(model.weights.get(f, (0.0, 0.0))[y] for fs, y in zip(features, labels, strict=True) for f in fs)
    return total + sum(model.step[a][b] for a, b in itertools.pairwise(labels))


def test_viterbi_is_the_best_of_all_labellings():
    draw = np.random.default_rng(1)
    for _ in range(100):
        model = htmlcrf.Model({f: tuple(draw.normal(size=2)) for f in "abcd"}, tuple(map(tuple, draw.normal(size=(2, 2)))), tuple(draw.normal(size=2)))
        features = [list(draw.choice(list("abcde"), draw.integers(0, 4))) for _ in range(draw.integers(1, 7))]
        best = max(itertools.product((0, 1), repeat=len(features)), key=lambda y: score(model, features, y))
        assert htmlcrf.viterbi(model, features) == list(best)
    assert htmlcrf.viterbi(model, []) == []


def test_fitting_climbs_the_likelihood_of_all_labellings(monkeypatch):
    draw = np.random.default_rng(2)
    chains = [([list(draw.choice(list("abc"), 2)) for _ in range(n)], draw.integers(0, 2, n).tolist()) for n in (1, 3, 4, 5, 2)]

    def likelihood(model):
        total = 0.0
        for features, labels in chains:
            every = [score(model, features, y) for y in itertools.product((0, 1), repeat=len(features))]
            total += score(model, features, labels) - np.logaddexp.reduce(every)
        return total

    # at the optimum no small step of any weight helps
    monkeypatch.setattr(htmlcrf, "PENALTY", 1e-2)
    monkeypatch.setattr(htmlcrf, "RATE", 0.005)
    model = htmlcrf.fit_chains(chains, rounds=3000)
    blocks = sum(len(y) for _, y in chains)

    def penalised(model):
        weights = [w for pair in model.weights.values() for w in pair] + [s for r in model.step for s in r] + list(model.first)
        return likelihood(model) / blocks - 0.5 * 1e-2 * sum(w * w for w in weights)

    base = penalised(model)
    assert base > penalised(htmlcrf.fit_chains(chains, rounds=3))
    for f in model.weights:
        for y, step in itertools.product((0, 1), (-0.05, 0.05)):
            moved = list(model.weights[f])
            moved[y] += step
            assert penalised(htmlcrf.Model({**model.weights, f: tuple(moved)}, model.step, model.first)) <= base + 1e-6
    for a, b, step in itertools.product((0, 1), (0, 1), (-0.05, 0.05)):
        steps = [list(r) for r in model.step]
        steps[a][b] += step
        assert penalised(htmlcrf.Model(model.weights, tuple(map(tuple, steps)), model.first)) <= base + 1e-6


def test_no_feature_is_the_label():
    names = {f for page in PAGES for b in htmlcrf.blocks(page) for f in b.features}
    assert not any(f.startswith(("landmark", "plain")) for f in names)


def test_held_out_blocks_of_pages_without_landmarks():
    """Pages that were not learned from, their landmarks taken out: blocks are found by tags, roles, class words and text."""
    cut = [(f[at : at + htmlcrf.CHAIN], y[at : at + htmlcrf.CHAIN]) for f, y in htmlcrf.labelled(PAGES[::4]) for at in range(0, len(y), htmlcrf.CHAIN)]
    model = htmlcrf.fit_chains(cut)
    right = wrong = lost = 0
    for page in (p for i, p in enumerate(PAGES) if i % 4):
        bare = re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", page or "")
        found = htmlcrf.viterbi(model, [b.features for b in htmlcrf.blocks(bare)])
        for y, p in zip(htmlcrf.weak_labels(htmlcrf.blocks(page)), found, strict=True):
            right, wrong, lost = right + (y & p), wrong + (p & ~y & 1), lost + (y & ~p & 1)
    assert right > 100 and right / (right + wrong) > 0.98 and right / (right + lost) > 0.98


@pytest.mark.parametrize("unit", ["<a ", '<p class="', "<!--", "<script>", "<", "a > <b c='", "<svg ", "<![CDATA["])
def test_hostile_markup(unit):
    started = time.monotonic()
    htmlcrf.blocks(unit * (1_000_000 // len(unit)))
    assert time.monotonic() - started < 10


@pytest.mark.parametrize("page, text", [
    ("<p>a</p><!-- open <p>b</p>", ["a"]), ("<p>a</p><script>if (x > 1) {", ["a"]), ("<p>a</p> b <!-- open", ["a", "b"]), ("<p>a</p><script>x</script> b", ["a", "b"]),
    ("<p>a</p><![CDATA[ b ]]> c", ["a", "c"]), ("x > y", ["x > y"]), ("<p>a <b", ["a <b"]), ("", []), (None, []),
])
def test_ends_of_pages(page, text):
    assert [b.text for b in htmlcrf.blocks(page)] == text
