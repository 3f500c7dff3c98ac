"""The pipeline against a brute-force version, on odd rows and on the smallest tables; its stages on an empty table."""

import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_operators import DOCS, fingerprint, roots
from tripflow.llm import langid, linedup, mixing, queries
from tripflow.llm.pieces import MARK, default_path

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def odd(spark, rows):
    frame = spark.createDataFrame([(i, t, lang, lang, 0) for i, t, lang in rows], COLUMNS)
    return frame.withColumns({name: F.lit("clash") for name in ("fp", "node", "copy", "pieces", "lang_pred", "n_lines", "__key")})


def language(model, text):
    """Most likely language and its posterior, one word at a time; segmentations are summed place by place."""
    ids = {p: i for i, p in enumerate(model.pieces)}
    longest, p = max(map(len, ids)), np.exp(model.log_p)
    total, words = model.log_prior.copy(), Counter(re.findall(r"[^\W\d_]+", (text or "").lower()))
    for word, n in words.items():
        w = MARK + word
        ways = [np.ones(len(model.languages))] + [np.zeros(len(model.languages)) for _ in w]
        for i in range(len(w)):
            for j in range(i + 1, min(len(w), i + longest) + 1):
                if w[i:j] in ids or j == i + 1:
                    ways[j] = ways[j] + ways[i] * p[ids.get(w[i:j], -1)]
        total = total + n * np.log(ways[-1])
    best = int(total.argmax())
    return (model.languages[best], 1 / np.exp(total - total[best]).sum()) if words else (None, 0)


def by_brute_force(rows, model):
    docs = [(i, t, found[0], source) for i, t, source in rows if (found := language(model, t))[1] >= 0.5]
    low = str.maketrans(linedup.UPPER, linedup.LOWER)
    key = lambda line: line.strip(" \t\n\v\f\r").translate(low)
    holders = defaultdict(set)
    for i, t, *_ in docs:
        for k in map(key, t.split("\n")):
            holders[k].add(i)
    owner = {k: max(x for x in v if x is not None) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    docs = [(i, "\n".join(x for x in t.split("\n") if owner.get(key(x), i) == i), *rest) for i, t, *rest in docs]
    prints = [fingerprint(t) for _, t, *_ in docs]
    near = [(a, b) for a in range(len(docs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    groups = defaultdict(list)
    for doc, root in zip(docs, roots(len(docs), near), strict=True):
        groups[root].append(doc)
    docs = [min(g, key=lambda d: (d[0] is None, d[0] or 0)) for g in groups.values()]
    sizes = Counter(source for *_, source in docs)
    whole = sum(n**0.5 for n in sizes.values())
    library, out = sentencepiece.SentencePieceProcessor(model_file=default_path()), Counter()
    for i, t, lang, source in docs:
        n = sizes[source]
        rate = len(docs) * n**0.5 / whole / n
        u = (int(hashlib.md5(f"{mixing.SEED}:{'' if i is None else i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        k, p, total = 0, np.exp(-rate), np.exp(-rate)
        while total < u:
            k += 1
            p *= rate / k
            total += p
        if k:
            out[i, lang, source, len(t), tuple(library.encode(t)), True] += k
    return out


@pytest.mark.parametrize("table", ["odd", "given"])
def test_pipeline_equals_brute_force(spark, tmp_path, table):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet") if table == "given" else odd(spark, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "lang", "source", "n_chars", "pieces", "round_trip", "n_pieces").collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert all(r.n_pieces == len(r.pieces) for r in got) and got
    assert Counter((*r[:4], tuple(r.pieces), r.round_trip) for r in got) == by_brute_force(rows, langid.fit(docs))


def test_stages_keep_the_columns_and_take_an_empty_table(spark):
    docs = odd(spark, DOCS).where("false")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, FOLDER)
        assert tuple(made.columns) == corpus_pipeline.COLUMNS and made.count() == 0, name
    assert corpus_pipeline.encode(spark, docs, FOLDER).count() == 0


def test_held_out_languages(spark):
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    found = queries.op2_language_id(spark, FOLDER).join(truth, "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right / n >= 0.9
