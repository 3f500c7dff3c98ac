"""Conversation repair against a plain search over all edits, and against every repair of short conversations."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tripflow.llm import queries, repair

BLANK = "\t\n\x0b\x0c\r "


def damaged(rows):
    found = []
    for conv_id, turn, role, text in rows:
        s = lambda x: " " if x is None else str(x)
        kind, role, text = zlib.crc32(f"{s(conv_id)}:{s(turn)}".encode()) % 20, s(role), s(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found += [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return found


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        bare = text.strip(BLANK)
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


STEP = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def search(rows):
    """(cost, audit, repaired turns): the least (cost, letters) into each state, row by row. States are last initials."""
    def inserts(best):
        for _ in range(4):
            for state, (cost, audit, kept) in list(best.items()):
                for role in ("user", "assistant"):
                    if (to := STEP[state].get(role[0])) and (new := (cost + 2, audit + "I", [*kept, (role, "")]))[:2] < best.get(to, (1e9, ""))[:2]:
                        best[to] = new
        return best

    best = {"": (0, "", [])}
    for (role, text), fault in zip(rows, faults(rows), strict=True):
        new = {}
        for state, (cost, audit, kept) in inserts(best).items():
            options = [(cost + 3, audit + "D", kept, state)]
            if fault not in ("blank", "duplicate"):
                more = cost + (fault == "truncated")
                if to := STEP[state].get(role[:1]):
                    options.append((more, audit + "K", [*kept, (role, text)], to))
                options += [(more + 2, audit + "R", [*kept, (r, text)], to) for r in ("user", "assistant") if (to := STEP[state].get(r[0]))]
            for c, a, k, to in options:
                if (c, a) < new.get(to, (1e9, ""))[:2]:
                    new[to] = (c, a, k)
        best = new
    return min((x for s, x in inserts(best).items() if s in ("", "a")), key=lambda x: x[:2])


def expected(rows):
    chats = defaultdict(list)
    for conv_id, turn, role, text in damaged(rows):
        h = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        chats[conv_id].append(((turn is not None, turn or 0, h), role, text))
    found = {}
    for conv_id in {r[0] for r in rows}:
        turns = sorted(chats[conv_id])
        pairs = [(r, t) for _, r, t in turns]
        numbers = {k[1] for k, _, _ in turns if k[0]}
        fault = faults(pairs)
        illegal = sum((a[:1] or "?") + (b[:1] or "?") not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(pairs))
        cost, audit, kept = search(pairs)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        found[conv_id] = (gaps, *[fault.count(x) for x in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha)
    return found


def rows_of_chats(n, seed):
    draw = random.Random(seed)
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system", "tool", "", None, "úser", "sys"]
    texts = ["Yes.", "What?", "no end", " \t\n", "", None, "Stop! ", "…", "The same.", "x" * 50 + "!"]
    rows = []
    for conv_id in [*range(n), None]:
        turns = draw.sample(range(40), draw.randint(1, 12)) + draw.choice([[], [], [None], [None, None]])
        rows += [(conv_id, t, draw.choice(roles), draw.choice(texts) if draw.random() < 0.4 else f"text {draw.random()}" + draw.choice([".", ".", "!", ""])) for t in turns]
    return rows


def check(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"letters": F.lit(1), "block": F.lit("x"), "copy": F.lit(0)})
    frame.write.mode("overwrite").parquet(str(tmp_path / "conversations.parquet"))
    got = queries.queries()["op11_conversation_repair"](spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r[0]: tuple(r)[1:] for r in got.collect()}


def test_query(spark, tmp_path):
    rows = rows_of_chats(400, 1)
    want = expected(rows)
    assert check(spark, tmp_path, rows) == want
    assert any(w[6] == "" for w in want.values()) and {c for w in want.values() for c in w[6]} == set("DIKR")


def test_long_conversations(spark, tmp_path):
    draw = random.Random(2)
    # many chunks; a conversation without turn numbers; one text a thousand times; ties and repeated rows
    rows = [(1, t, draw.choice(["user", "assistant"]), f"text {t}" + draw.choice([".", ""])) for t in range(3000)]
    rows += [(2, None, "user", f"text {t}.") for t in range(200)] + [(2, 5, "assistant", "End.")]
    rows += [(3, t, "user" if t % 2 else "assistant", "Same.") for t in range(1000)]
    rows += [(4, 7, r, "Tie.") for r in ("user", "assistant", "user", "system")] + [(5, 2**60, "user", "Far."), (5, -(2**60), "assistant", "Far.")]
    rows += [(6, t, "assistant", f"Run {t}.") for t in range(2000)]
    assert check(spark, tmp_path, rows) == expected(rows)


def test_empty(spark, tmp_path):
    assert check(spark, tmp_path, [(None, None, None, None)]) == expected([(None, None, None, None)])
    lost = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    assert check(spark, tmp_path, [(1, lost, "user", "Gone.")])[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    report, repaired = repair.repair(none)
    assert report.count() == 0 and repaired.count() == 0 and repair.digests(repaired).count() == 0


def test_repaired_rows(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "Hi."), (1, 1, "user", ""), (1, 2, "user", "Go."), (1, 3, "tool", "Done")], "conv_id int, turn int, role string, text string")
    report, repaired = repair.repair(rows)
    assert report.first().audit == "IKDKR" and report.first().cost == 8
    assert [tuple(t) for t in repaired.first().turns] == [("I", "user", ""), ("K", "assistant", "Hi."), ("K", "user", "Go."), ("R", "assistant", "Done")]


def every_repair(symbols):
    """All edits of a few symbols with at most two insertions in a place, tried against the pattern itself."""
    places = [""] + ["u", "a", "ua", "au", "uu", "aa"]
    best = None
    options = [[("D", 3, "")] + ([] if s == "x" else [("K", s.isupper(), s.lower()), ("R", 2 + s.isupper(), "u"), ("R", 2 + s.isupper(), "a")]) for s in symbols]
    for edits in itertools.product(*options):
        for made in itertools.product(places, repeat=len(symbols) + 1):
            roles = made[0] + "".join(e[2] + m for e, m in zip(edits, made[1:], strict=True))
            if re.fullmatch("(s?(ua)+)?", roles):
                audit = "I" * len(made[0]) + "".join(e[0] + "I" * len(m) for e, m in zip(edits, made[1:], strict=True))
                found = (sum(e[1] for e in edits) + 2 * sum(map(len, made)), audit)
                best = min(best or found, found)
    return best


@pytest.mark.parametrize("n", [0, 1, 2])
def test_against_every_repair(n):
    for symbols in map("".join, itertools.product("suaoSUAOx", repeat=n)):
        runs = repair.runs(symbols)
        letters, state, cost = repair.unroll(runs, repair.END, repair.START, True)
        assert (cost, letters) == every_repair(symbols)
        low, costs = repair.before(runs, repair.END)
        assert low + costs[repair.START] == cost and state in repair.ACCEPTED


def test_powers_equal_steps():
    """Runs by powers of two equal the same rows one by one."""
    draw = random.Random(4)
    for _ in range(300):
        symbols = "".join(draw.choice("suaoSUAOx") * draw.choice([1, 2, 3, 7, 20]) for _ in range(draw.randint(1, 6)))
        single = [(s, 1) for s in symbols]
        for state in range(4):
            assert repair.unroll(repair.runs(symbols), repair.END, state, True) == repair.unroll(single, repair.END, state, True)
        assert repair.before(repair.runs(symbols), repair.END) == repair.before(single, repair.END)
