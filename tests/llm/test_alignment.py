"""Cross-tokenizer alignment against brute force over all pairs of tokens of a text."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tripflow.llm import alignment, queries

TEXTS = [
    (1, "The quick brown fox, the lazy dog's tail."), (2, "Überraschend schöne Größen — naïve café."), (3, "The the the  the\n\nfox"),
    (4, None), (5, ""), (6, "a mark ▁ in the text"), (7, "<|endoftext|> <s> and </s> are plain <unk> text"), (8, " "), (9, "漢字 😀😀 \x00\t x"),
    (10, "aaa aaaaaaa aaa"), (10, "aaa aaaaaaa aaa"), (None, "The quick fox"), (11, "long text of words, " * 20_000), (12, "x" * 50_000), (13, "The quick brown fox"),
]


@pytest.fixture(scope="module")
def words():
    return alignment.vocabularies()


def brute(rows, words):
    """Ids by the installed libraries; every pair of tokens of a text is tested for overlap where the text is short."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found, documents = [], Counter()
    for doc_id, text in rows:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        if text and not b"".join(words.a_bytes[i] for i in a) == (" " + text).encode() == b"".join(words.b_bytes[i] for i in b):
            a, b = [], []
        spans = []
        for ids, table in ((a, words.a_bytes), (b, words.b_bytes)):
            at, made = 0, []
            for i in ids:
                made.append((at, at := at + len(table[i]), i))
            spans.append(made)
        if len(a) * len(b) < 10_000:
            links = [(i, j) for s, e, i in spans[0] for t, u, j in spans[1] if max(s, t) < min(e, u)]
        else:
            by_byte = [[i for s, e, i in enumerate_spans for _ in range(s, e)] for enumerate_spans in ([(s, e, k) for k, (s, e, _) in enumerate(x)] for x in spans)]
            links = [(a[i], b[j]) for i, j in sorted(set(zip(*by_byte, strict=True)))]
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for high in common if len(a) * len(b) < 10_000 else []:
            groups.append("|".join(",".join(str(i) for s, e, i in x if low < e <= high) for x in spans))
            low = high
        digest = None if common and not groups else hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        documents.update(set(links))
        found.append((doc_id, len(a), len(b), len(common), links, digest))
    best = defaultdict(int)
    for (a, _), n in documents.items():
        best[a] = max(best[a], n)
    return [
        (i, n_a, n_b, n_groups, len(links), sum(documents[p] == best[p[0]] for p in links), sum(documents[p] for p in links), digest)
        for i, n_a, n_b, n_groups, links, digest in found
    ]


def test_align(spark, words, monkeypatch):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({"n_a": F.lit("old"), "keys": F.lit(1), "batch": F.lit(2)})
    want = brute(TEXTS, words)
    for size in (alignment.BATCH_BYTES, 50):  # one batch, and many
        monkeypatch.setattr(alignment, "BATCH_BYTES", size)
        monkeypatch.setattr(alignment, "PART_BYTES", size // 2)
        found = alignment.align(docs, words)
        assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        got = [tuple(r) for r in found.collect()]
        key = lambda r: (r[0] is None, r[:7])
        for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
            assert g[:7] == w[:7]
            assert w[7] is None or g[7] == w[7]
    assert {r[0]: r[1:] for r in want}[6] == (0, 0, 0, 0, 0, 0, "")  # a mark of its own is not restored
    assert {r[0] for r in want if r[1]} == {1, 2, 3, 7, 8, 9, 10, 11, 12, 13, None}
    assert alignment.align(docs.where("false"), words).count() == 0
    assert alignment.align(docs.where("text is null"), words).select("n_links", "groups_sha256").distinct().collect() == [(0, "")]


def test_identity_map(words):
    """Links of equal bytes outside one-to-one groups are counted with the others of their pair."""
    aligner = alignment.Aligner(words)
    same = [i for i, b in enumerate(aligner.identity) if b >= 0]
    assert len(same) > 10_000 and all(words.a_bytes[i] == words.b_bytes[aligner.identity[i]] for i in same)
    # the hand-made case: A cuts a run as (2, 1), B as (1, 2)
    two, one = words.a_bytes.index(b"aa"), words.a_bytes.index(b"a")
    aligner.tokens = lambda texts: ([[two, one]], [[aligner.identity[one], aligner.identity[two]]])
    got = aligner.measure(["aa"])
    pairs = {(int(p) // len(words.b_bytes), int(p) % len(words.b_bytes)): int(n) for p, n in zip(got.pair, got.times, strict=True)}
    assert pairs == {(two, aligner.identity[one]): 1, (two, aligner.identity[two]): 1, (one, aligner.identity[two]): 1}
    assert got.n_groups.tolist() == [1]


def test_query(spark, words):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    short = [(i, t) for i, t in rows if len(t or "") < 2000]
    got = {r.doc_id: r for r in queries.queries()["op13_token_alignment"](spark, sf).collect()}
    assert len(got) == len(rows)
    for w in brute(rows, words):
        assert tuple(got[w[0]])[:7] == w[:7]
    assert len(short) > 50
