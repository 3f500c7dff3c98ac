"""Conversation structure repair by a run-length dynamic programme.

A row is one symbol: the initial of its role and its first fault. Every symbol has a min-plus transition: the least cost from
each state of the target structure `(s?(ua)+)?` to each other one, with rows kept, given another role or deleted and turns
inserted. Equal neighbouring symbols are a run; costs pass a run through the powers of two of its transition, which are
kept. Costs to go run backwards, then the cheapest edits, least letters first, are unrolled forwards: a run's letters are
those of its powers, kept as well.

A long conversation is many chunks of turns (see turns.py). A chunk is measured as one transition; transitions are folded
from the end, chunks are unrolled in parallel from every state, and the states are threaded from the start. What
passes through one task per conversation is a chunk's symbols, never its texts.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .turns import CHUNK, chunk_of, in_order, joined_sha256, map_rows, placed

# Fixed values of the contract.
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
SPACE = "\t\n\u000b\f\r "

START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a role's initial leads from each state of s?(ua)+, and where a user or assistant turn that is made up leads.
BY_INITIAL = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
MADE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ACCEPTED = (START, ASSISTANT)
LOST = "x"  # a row that must go
NEVER = 1 << 50

Costs = tuple[int, int, int, int]


def _edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one row, least letter first. A capital is a truncated row."""
    found = [(DELETE, DELETE_COST, state)]
    if symbol != LOST:
        extra = TRUNCATED_COST if symbol.isupper() else 0
        kept = BY_INITIAL.get(symbol.lower(), {}).get(state)
        if kept is not None:
            found.append((KEEP, extra, kept))
        found.append((REROLE, REROLE_COST + extra, MADE[state]))
    return found


def _inserting(base: list[int]) -> Costs:
    """Costs from each state when turns may be inserted first. Two insertions come back to the state after a turn."""
    user, assistant = (min(base[x], INSERT_COST + base[MADE[x]]) for x in (USER, ASSISTANT))
    return tuple(min(base[x], INSERT_COST + user) for x in (START, SYSTEM)) + (user, assistant)


END: Costs = _inserting([0 if s in ACCEPTED else NEVER for s in range(4)])


def _level(costs: Costs) -> tuple[int, Costs]:
    """The least cost, and the costs above it: few such tuples exist, so what follows from them can be remembered."""
    low = min(costs)
    return low, tuple(NEVER if c >= NEVER // 2 else c - low for c in costs)


@lru_cache(maxsize=100_000)
def _power(symbol: str, k: int, after: Costs) -> tuple[int, Costs]:
    """Costs before 2**k rows of a symbol, from the (levelled) costs after them."""
    if k == 0:
        return _level(_inserting([min(cost + after[n] for _, cost, n in _edits(symbol, s)) for s in range(4)]))
    low, middle = _power(symbol, k - 1, after)
    more, before = _power(symbol, k - 1, middle)
    return low + more, before


def _powers(n: int) -> list[int]:
    return [k for k in range(n.bit_length()) if n >> k & 1]


def before_run(symbol: str, n: int, after: Costs) -> tuple[int, Costs]:
    total = 0
    for k in _powers(n):
        low, after = _power(symbol, k, after)
        total += low
    return total, after


@lru_cache(maxsize=20_000)
def _letters(symbol: str, k: int, after: Costs, state: int) -> tuple[str, int, int]:
    """Cheapest edits of 2**k rows from a state, least letters first; where they lead; their cost."""
    if k:
        first, state, cost = _letters(symbol, k - 1, _power(symbol, k - 1, after)[1], state)
        second, state, more = _letters(symbol, k - 1, after, state)
        return first + second, state, cost + more
    direct = [min(cost + after[n] for _, cost, n in _edits(symbol, s)) for s in range(4)]
    best, letters, spent = _inserting(direct), "", 0
    while True:
        options = [*_edits(symbol, state), (INSERT, INSERT_COST, -1)]
        for letter, cost, following in sorted(options):
            rest = best[MADE[state]] if letter == INSERT else after[following]
            if cost + rest == best[state]:
                break
        letters, spent = letters + letter, spent + cost
        if letter != INSERT:
            return letters, following, spent
        state = MADE[state]


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(s, sum(1 for _ in g)) for s, g in groupby(symbols)]


def before(symbols: list[tuple[str, int]], after: Costs) -> tuple[int, Costs]:
    """Costs before runs of symbols, as (least cost, costs above it)."""
    total, after = _level(after)
    for symbol, n in reversed(symbols):
        low, after = before_run(symbol, n, after)
        total += low
    return total, after


def unroll(symbols: list[tuple[str, int]], after: Costs, state: int, last: bool) -> tuple[str, int, int]:
    """Letters of the cheapest edits from a state, where they lead, and their cost; after the last row, what is still inserted."""
    afters, costs = [], _level(after)[1]
    for symbol, n in reversed(symbols):
        afters.append(costs)
        costs = before_run(symbol, n, costs)[1]
    letters, spent = [], 0
    for (symbol, n), costs in zip(symbols, reversed(afters), strict=True):
        blocks = []  # the powers of the run, and the costs after each
        for k in _powers(n):
            blocks.append((k, costs))
            costs = _power(symbol, k, costs)[1]
        for k, following in reversed(blocks):
            some, state, cost = _letters(symbol, k, following, state)
            letters.append(some)
            spent += cost
    while last and state not in ACCEPTED:
        letters.append(INSERT)
        state, spent = MADE[state], spent + INSERT_COST
    return "".join(letters), state, spent


def _transition(symbols: list[tuple[str, int]]) -> list[int]:
    """Least cost from each state (row) to each state (column) over a chunk."""
    columns = []
    for to in range(4):
        low, costs = before(symbols, tuple(0 if s == to else NEVER for s in range(4)))
        columns.append([min(low + c, NEVER) for c in costs])
    return [columns[to][s] for s in range(4) for to in range(4)]


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after a fixed damage by the CRC-32 of conv_id:turn; nulls in strings are one space."""
    sign = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(sign("conv_id"), F.lit(":"), sign("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(sign("text"), ".!?", "")).otherwise(sign("text"))
    role = F.when(kind == 4, "user").otherwise(sign("role"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _symbol(role: Column, text: Column) -> Column:
    """Initial (place in suao) times 3 plus fault: 0 none, 1 blank, 2 truncated."""
    bare = F.btrim(text, F.lit(SPACE))
    fault = F.when(bare == "", 1).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), 0).otherwise(2)
    first = F.left(role, F.lit(1))
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3) * 3 + fault


def _chunks(rows: DataFrame) -> DataFrame:
    """A row per chunk: symbols, initials, and counts of faults."""
    marked = rows.select(*CHUNK, "turn", "h", _symbol(F.col("role"), F.col("text")).alias("code"), F.lit(1).alias("n"), F.lit(0).alias("first"))
    # where each role and text is seen first; a hot text is one row per map task
    seen = marked.groupBy("conv_id", "h").agg(F.max(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("turn"))
    seen = seen.select("conv_id", F.when(~F.col("unnumbered"), F.col("turn")).alias("turn"), "h")
    firsts = seen.select("*", *chunk_of(F.col("turn"), F.col("h")), F.lit(-1).alias("code"), F.lit(0).alias("n"), F.lit(1).alias("first"))
    entries = marked.unionByName(firsts).groupBy(*CHUNK, "turn", "h").agg(F.sum("n").alias("n"), F.max("code").alias("code"), F.max("first").alias("first"))
    lists = entries.groupBy(*CHUNK).agg(F.array_sort(F.collect_list(F.struct("turn", "h", "n", "code", "first"))).alias("e"))
    fault = lambda x: x["code"] % 3
    initial = lambda x: F.substring(F.lit("suao"), (x["code"] / 3).cast("int") + 1, F.lit(1))
    sound = lambda x: (fault(x) != 1) & (x["first"] == 1)

    def written(x: Column) -> Column:
        symbol = F.when(sound(x), F.when(fault(x) == 2, F.upper(initial(x))).otherwise(initial(x))).otherwise(LOST)
        return F.concat(symbol, F.repeat(F.lit(LOST), (x["n"] - 1).cast("int")))

    def total(of) -> Column:
        return F.aggregate("e", F.lit(0).cast("long"), lambda s, x: s + of(x))

    return lists.select(
        *CHUNK, F.array_join(F.transform("e", written), "").alias("symbols"),
        F.array_join(F.transform("e", lambda x: F.repeat(initial(x), x["n"].cast("int"))), "").alias("initials"),
        total(lambda x: F.when(fault(x) == 1, x["n"]).otherwise(0)).alias("blank"),
        total(lambda x: F.when(fault(x) != 1, x["n"] - x["first"]).otherwise(0)).alias("duplicate"),
        total(lambda x: F.when(sound(x) & (fault(x) == 2), 1).otherwise(0)).alias("truncated"),
    )


FACTS = "symbols string, initials string, blank long, duplicate long, truncated long"


def _edited(chunks: DataFrame) -> DataFrame:
    """Chunks with the letters of their cheapest edits, the state they start from, and what they cost."""
    kind = chunks.schema["conv_id"].dataType.simpleString()
    base = f"conv_id {kind}, block long, part int, {FACTS}"
    names = [*CHUNK, "symbols", "initials", "blank", "duplicate", "truncated"]

    def measure(rows):
        for row in rows:
            yield *[row[c] for c in names], _transition(runs(row["symbols"]))

    def fold(rows):  # from the end of each conversation
        begun, current, costs = False, None, END
        for row in rows:
            last = not begun or row["conv_id"] != current
            if last:
                begun, current, costs = True, row["conv_id"], END
            yield *[row[c] for c in names], last, list(costs)
            m = row["transition"]
            costs = _level(tuple(min(m[4 * s + to] + costs[to] for to in range(4)) for s in range(4)))[1]

    def solve(rows):
        for row in rows:
            found = [unroll(runs(row["symbols"]), tuple(row["after"]), s, row["last"]) for s in range(4)]
            yield *[row[c] for c in names], row["last"], *[list(x) for x in zip(*found, strict=True)]

    def thread(rows):  # from the start of each conversation
        begun, current, state, initial = False, None, START, ""
        for row in rows:
            first = not begun or row["conv_id"] != current
            if first:
                begun, current, state, initial = True, row["conv_id"], START, ""
            together = initial + row["initials"]
            illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(together, together[1:], strict=False))
            yield *[row[c] for c in CHUNK], row["blank"], row["duplicate"], row["truncated"], illegal, state, row["letters"][state], row["costs"][state], not (first and row["last"])
            state, initial = row["states"][state], together[-1:]

    measured = map_rows(chunks.select(*names), measure, f"{base}, transition array<long>")
    folded = map_rows(in_order(measured, backwards=True), fold, f"{base}, last boolean, after array<long>")
    solved = map_rows(folded.repartition(*CHUNK), solve, f"{base}, last boolean, letters array<string>, states array<int>, costs array<long>")
    return map_rows(in_order(solved), thread, (
        f"conv_id {kind}, block long, part int, blank long, duplicate long, truncated long, illegal long, state int, letters string, cost long, several boolean"
    ))


REPAIRED = "several boolean, turns array<struct<edit:string,role:string,text:string>>"


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report, repaired) of conversations given as rows (conv_id, turn, role, text); other columns are not read.

    report: a row per conversation: gaps (turn numbers missing between the least and the greatest), blank, duplicate and
    truncated (rows by their first fault), illegal (neighbours whose role initials may not follow each other), cost and audit
    (the initials of the edits in order: Delete, Insert, Keep, Rerole; the least of the cheapest). repaired: a row per chunk
    of a conversation: several (whether it has other chunks) and turns (edit, role, text) that remain, in order.

    Null roles and texts are one space. Rows go by turn (nulls first), those of one turn by a hash of role and text. Null
    ids are one conversation; an empty table gives no rows. Texts are shuffled once.
    """
    sign = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    at = placed(rows.select("conv_id", "turn", *sign))
    edited = stored(_edited(_chunks(at)))
    number = lambda c: F.col(c).cast("decimal(20,0)")
    spans = at.groupBy("conv_id").agg(F.max("turn").alias("high"), F.min("turn").alias("low"), F.count_distinct("turn").alias("n"))
    gaps = spans.select(F.col("conv_id").alias("id"), F.coalesce((number("high") - number("low") + 1 - F.col("n")).cast("long"), F.lit(0)).alias("gaps"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "part", "letters")))
    sums = edited.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], F.array_join(F.transform(pieces, lambda x: x["letters"]), "").alias("audit")
    )
    report = sums.join(gaps, F.col("conv_id").eqNullSafe(F.col("id"))).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    # the edits of a chunk travel to its rows as one more row
    texts = at.select(*CHUNK, F.struct("turn", "h", "role", "text").alias("t"))
    marks = edited.select(*CHUNK, "state", "letters", "several")
    gathered = texts.unionByName(marks, allowMissingColumns=True).groupBy(*CHUNK).agg(
        F.array_sort(F.collect_list("t")).alias("t"), F.max("state").alias("state"), F.max("letters").alias("letters"), F.max("several").alias("several")
    )
    turns = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))

    def apply(chunks):
        for row in chunks:
            given, state, turns = ((x["role"], x["text"]) for x in row["turns"]), row["state"], []
            for letter in row["letters"]:
                role, text = ("", "") if letter == INSERT else next(given)
                if letter == DELETE:
                    continue
                if letter == KEEP:
                    state = BY_INITIAL[role[0]][state]
                else:
                    state = MADE[state]
                    role = "user" if state == USER else "assistant"
                turns.append({"edit": letter, "role": role, "text": text})
            yield *[row[c] for c in CHUNK], row["several"], turns

    kind = rows.schema["conv_id"].dataType.simpleString()
    repaired = map_rows(gathered.select(*CHUNK, "state", "letters", "several", turns.alias("turns")), apply, f"conv_id {kind}, block long, part int, {REPAIRED}")
    return report, repaired


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256, of role:text of all turns that remain, joined by line ends."""
    line = F.transform("turns", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    joined = F.when(F.size("turns") > 0, F.array_join(line, "\n"))
    lines = repaired.select(*CHUNK, "several", joined.alias("repaired"))
    # digests of whole conversations, and the texts of long ones only
    kept = stored(lines.select(
        *CHUNK, "several", F.when(~F.col("several"), F.sha2(F.coalesce("repaired", F.lit("")).cast("binary"), 256)).alias("repaired_sha256"),
        F.when(F.col("several"), F.col("repaired")).alias("repaired"),
    ))
    whole = kept.where("not several").select("conv_id", "repaired_sha256")
    return whole.unionByName(joined_sha256(kept.where("several"), {"repaired": "\n"}))
