"""The operators over the driver's tables, by query name, and their DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chatformat, htmlcrf, langid, licenses, linedup, mixing, pivots, rabitq, repair, secrets, simhash, transducer


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "sentence_ids", "licenses")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out()))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.clusters(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    compiled = transducer.compiled()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = transducer.encode_and_decode(docs, compiled)
    ids = F.array_join(F.transform("pieces", lambda i: F.lpad(F.hex(i), 4, "0")), "")
    return both.select(
        "doc_id", F.when(F.col("pieces").isNotNull(), F.size("pieces")).alias("n_pieces"), _sha256(ids).alias("pieces_sha256"),
        _sha256(F.col("decoded")).alias("decoded_sha256"), F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"),
    )


def op5_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.search(_table(spark, sf_dir, "embeddings"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    # two runs: the second finds the first one's blobs in the ledger, and scans only what it lacks
    _, ledger = secrets.scan(versions.where("path % 2 = 0"))
    found, _ = secrets.scan(versions, ledger)
    spans = secrets.spans_text(F.col("findings"))

    def count(number: int) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind_no"] == number)).cast("long")

    counts = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(secrets.RULES)]
    # the ledger adds no spans of its own, so base spans are all spans
    return found.select(F.col("path").alias("doc_id"), *counts, _sha256(spans).alias("base_sha256"), spans.alias("spans"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linedup.drop_common_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", _sha256(F.col("text")).alias("kept_sha256"))


def op8_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "source", "copy", "shuffle_key", "text")


def op9_pivot_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.clusters(_table(spark, sf_dir, "embeddings"))


def op10_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = htmlcrf.extract(pages.select("page_id", "url", "html"), htmlcrf.fit(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = _table(spark, sf_dir, "conversations")
    report, repaired = repair.repair(repair.damage(chats))
    facts = report.join(repair.digests(repaired).withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")
    # conversations that lost all rows stay
    every = chats.groupBy(F.col("conv_id").alias("id")).agg(F.count("*").alias("n"))
    found = every.join(facts, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", _sha256(F.lit(""))).alias("repaired_sha256")]
    return found.select(F.col("id").alias("conv_id"), *counts, *texts)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a conversation whose texts look like the marks of templates
    said = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    return chatformat.digests(chatformat.format_chats(chats))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), alignment.vocabularies())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_license_scan, op2_language_id, op3_simhash, op4_sentencepiece, op5_rabitq, op6_secret_scan,
        op7_line_dedup, op8_poisson_mix, op9_pivot_dedup, op10_html_crf,
        op11_conversation_repair, op12_chat_format, op13_token_alignment,
    )
    return {f.__name__: f for f in own}


SPACE = r"[\x20\x09-\x0D]"
LINE_SQL = rf"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (SELECT *, translate(regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= {linedup.MIN_CHARS}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {linedup.MIN_DOCUMENTS}),
marked AS (SELECT k.*, c.key IS NOT NULL AND c.owner <> k.doc_id AS lost FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

MIX_SQL = f"""
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, (SELECT sum(n) FROM sizes) * (pow(n, {mixing.TEMPERATURE}) / (SELECT sum(pow(n, {mixing.TEMPERATURE})) FROM sizes)) / n AS rate FROM sizes),
terms AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
    FROM rates, LATERAL (SELECT unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 24) AS BIGINT) + 1)) AS k)),
steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS total FROM terms),
drawn AS (SELECT doc_id, source, text,
    (CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u FROM documents),
counted AS (SELECT d.doc_id, d.source, d.text, d.u, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND s.total < d.u) AS n FROM drawn d),
copies AS (SELECT doc_id, source, text, CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy FROM counted WHERE n > 0)
SELECT doc_id, source, copy, md5('{mixing.SEED} order:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || copy) AS shuffle_key, text FROM copies
"""


# The contract's kinds: name, pattern, the group that is measured, and its least length.
SECRET_KINDS = (
    ("assign", r'''(?i)(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)''', 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
)


def _spans_sql(number: int, kind: str, pattern: str, group: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, {number} AS kind_no, '{kind}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: struct_pack(
        s := CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT),
        n := length(m[i]), tested := length(g[i])))) AS f
    FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS m,
        regexp_extract_all(t, '{pattern}', {group}) AS g FROM docs)"""


SECRET_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
finds AS ({" UNION ALL ".join(_spans_sql(i, kind, pattern, group) for i, (kind, pattern, group, _) in enumerate(SECRET_KINDS))}),
good AS (SELECT doc_id, kind_no, kind, f.s AS s, f.s + f.n AS e FROM finds
    WHERE f.tested >= CASE kind_no {" ".join(f"WHEN {i} THEN {k[3]}" for i, k in enumerate(SECRET_KINDS))} END),
joined AS (SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind_no = {i}) AS n_{k[0]}" for i, k in enumerate(SECRET_KINDS))},
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) AS spans FROM good GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k[0]}, 0) AS n_{k[0]}" for k in SECRET_KINDS)},
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN joined USING (doc_id)
"""


#: Escaping lengthens a text by one for each backslash and twice for each control string; a role also by its line ends.
_CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _escaped_chars_sql(column: str) -> str:
    grown = " + ".join(f"2 * (length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in _CONTROLS)
    return f"(length({column}) + length({column}) - length(replace({column}, chr(92), '')) + {grown})"


CHAT_SQL = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
keyed AS (SELECT *, md5(length(role) || ':' || role || text) AS h,
    {len("<|im_start|>") + 1 + len("<|im_end|>")} + {_escaped_chars_sql("role")} + length(role) - length(replace(role, chr(10), '')) + {_escaped_chars_sql("text")} AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, h)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, h) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM keyed GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_chat_format": CHAT_SQL, "op6_secret_scan": SECRET_SQL, "op7_line_dedup": LINE_SQL, "op8_poisson_mix": MIX_SQL}
