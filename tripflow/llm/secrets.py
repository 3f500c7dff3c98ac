"""Secret scans over an incremental ledger of blobs. DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds one row per blob and rule
version that was scanned, with its findings. A scan reads only blobs that the ledger lacks under the rules' version,
each once however many paths and versions hold it, and joins the findings of old and new blobs back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored


@dataclass(frozen=True)
class Rule:
    """pattern: what is found, leftmost and without overlap. A find counts if its `group` has at least `least` characters.
    hint: a cheaper pattern without which there is no find that counts."""

    kind: str
    pattern: str
    group: int
    least: int
    hint: str


# Fixed values of the contract, in the order in which kinds are listed.
RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8,
        r"""(?i)(?:passw(?:or)?d|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, r"AKIA[A-Z0-9]{12}"),
    # a run of 32 or more is found whole from its start, so shorter runs need not be listed first
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, r"[0-9a-f]{32}"),
)
RULE_VERSION = "base-1"
FINDINGS = "array<struct<start:bigint,kind_no:int,end:bigint>>"
LEDGER = f"blob string, rule_version string, findings {FINDINGS}"


#: Finds whose positions are added up together.
BLOCK = 256


def _let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def _finds(text: Column, number: int, rule: Rule) -> Column:
    """Array of (start, kind_no, end) in code points. Positions follow from the lengths of gaps and matches, added up in blocks,
    so that no array grows with all finds of a text."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = found if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    zero = F.lit(0).cast("long")

    def spans_of(rows: Column) -> Column:
        n_blocks = F.ceil(F.size(rows) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: F.slice(rows, b * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(rows) > 0, _let(blocks, placed)).otherwise(F.array().cast(FINDINGS))

    def placed(blocks: Column) -> Column:
        length = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, x: s + x["gap"] + x["found"]))
        none = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts"))
        starts = F.aggregate(length, none, lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["starts"], F.array(s["at"])).alias("starts")))["starts"]
        return F.flatten(F.zip_with(blocks, starts, in_block))

    def in_block(block: Column, start: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            begin = state["at"] + x["gap"]
            end = begin + x["found"]
            span = F.struct(begin.alias("start"), F.lit(number).alias("kind_no"), end.alias("end"))
            spans = F.when(x["good"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        return F.aggregate(block, F.struct(start.alias("at"), F.array().cast(FINDINGS).alias("spans")), step)["spans"]

    # the last gap has no match behind it
    zipped = _let(found, lambda f: F.arrays_zip(F.slice(gaps, F.lit(1), F.size(f)).alias("gap"), f.alias("found"), (f if rule.group == 0 else tested).alias("tested")))
    size = lambda c: F.char_length(c).cast("long")
    rows = F.transform(zipped, lambda x: F.struct(size(x["gap"]).alias("gap"), size(x["found"]).alias("found"), (F.char_length(x["tested"]) >= rule.least).alias("good")))
    return F.when(text.rlike(rule.hint), _let(rows, spans_of)).otherwise(F.array().cast(FINDINGS))


def findings(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All finds in a text, by start, then kind as listed."""
    return F.array_sort(F.concat(*[_finds(text, i, r) for i, r in enumerate(rules)]))


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan(
    versions: DataFrame, ledger: DataFrame | None = None, text: str = "text", path: str = "path",
    rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION,
) -> tuple[DataFrame, DataFrame]:
    """(paths, entries). paths: one row per row of versions: its path, blob and findings. entries: the new rows for the ledger.

    versions holds one row per path and historical version; null content is the empty blob, null paths stay, repeated
    rows each keep their row, other columns are not read. ledger (see LEDGER) may be None or empty and may hold a row
    more than once. The entries are stored: append them to the ledger for the next run.

    Blobs are picked by id before any content moves: one row (the smallest path and row hash) of each unseen blob is
    read, so a blob with very many paths is scanned once. Findings go back by a join on the blob, split when skewed;
    only blobs with finds take part.
    """
    ids = versions.select(F.col(path).alias("path"), blob_id(F.col(text)).alias("blob"))
    blobs = ids.groupBy("blob").agg(F.min("path").alias("path"))
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == rule_version)
        blobs = blobs.join(seen.select("blob"), "blob", "left_anti")
    chosen = blobs.select(F.struct("path", "blob").alias("__chosen"))
    content = versions.select(F.col(path).alias("path"), F.coalesce(text, F.lit("")).alias("text"))
    content = content.withColumn("__key", F.struct("path", blob_id(F.col("text")).alias("blob")))
    unseen = content.join(chosen, F.col("__key") == F.col("__chosen"), "left_semi").select("text", F.col("__key.blob").alias("blob"))
    entries = stored(unseen.select("blob", F.lit(rule_version).alias("rule_version"), findings(F.col("text"), rules).alias("findings")))
    known = entries if ledger is None else seen.select("blob", "rule_version", "findings").union(entries)
    with_finds = known.where(F.size("findings") > 0).dropDuplicates(["blob"]).select("blob", "findings")
    paths = ids.join(stored(with_finds), "blob", "left")
    return paths.select("path", "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings")), entries.dropDuplicates(["blob"])


def spans_text(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of all finds, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    one = lambda x: F.concat_ws(":", F.element_at(kinds, x["kind_no"] + 1), x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(found, one), ",")
