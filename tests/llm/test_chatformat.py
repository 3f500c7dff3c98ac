"""Chat formatting: what is read back equals the rows, whatever the texts hold."""

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tripflow.llm import chatformat, queries
from tripflow.llm.chatformat import Template

MARKS = ["<|im_start|>", "<|im_end|>", "<s>", "</s>[INST] ok [/INST]", "\\", "\\e", "\\b", "\\m", "\n", "é漢😀", "", "<|im_", "start|>", "plain text", "<", "\\\\e<s>"]


def rows_of_chats():
    draw = random.Random(5)
    rows = []
    for conv_id in [*range(30), None]:
        for turn in range(draw.randint(1, 9)):
            role = draw.choice(["system", "user", "assistant", "assistant", None, "to\nol<s>", "m\\", ""])
            rows.append((conv_id, turn, role, draw.choice([None, "".join(draw.choices(MARKS, k=6))])))
    rows += [(100, turn, "assistant" if turn % 2 else "user", f"turn {turn}") for turn in range(1500)]  # several chunks
    rows += [(101, None, "user", f"no turn {i}") for i in range(40)] + [(101, 3, "assistant", "end")]
    rows += [(102, 5, "assistant", "same"), (102, 5, "assistant", "same"), (103, -3, "user", "x" * 3_000_000), (103, 2**40, "assistant", "y" * 10)]
    return rows


def expected(rows):
    chats = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = role or "", text or ""
        h = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        chats[conv_id].append(((turn is not None, turn or 0, h), role, text))
    found = {}
    for conv_id, turns in chats.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        found[conv_id] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return found


@pytest.fixture(scope="module")
def chats(spark):
    frame = spark.createDataFrame(rows_of_chats(), "conv_id long, turn long, role string, text string")
    return frame.withColumns({"formatted": F.lit(1), "block": F.lit("old"), "several": F.lit(0)})


def test_round_trip(chats):
    formatted = chatformat.format_chats(chats)
    assert formatted.columns == ["conv_id", "block", "part", "several", "formatted", "loss"]
    got = {r.conv_id: r for r in chatformat.digests(formatted).collect()}
    want = expected(rows_of_chats())
    assert {i: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for i, r in got.items()} == want
    whole = defaultdict(int)
    for r in formatted.collect():
        whole[r.conv_id] += len(r.formatted)
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(Template().turns(r.formatted))
        assert all(c not in r.formatted for c in Template().controls[2:])
        assert len(Template().turns(r.formatted)) <= 256
    assert whole == {i: r.formatted_chars for i, r in got.items()}
    assert {r.conv_id for r in formatted.where("several").select("conv_id").collect()} == {100, 101, 103}


def test_empty(chats):
    formatted = chatformat.format_chats(chats.where("false"))
    assert formatted.count() == 0 and chatformat.digests(formatted).count() == 0


def test_gather(monkeypatch):
    monkeypatch.setattr(chatformat, "COPIED", 16)
    draw = np.random.default_rng(3)
    source = draw.integers(0, 255, 500).astype(np.uint8)
    starts, lengths = draw.integers(0, 400, 200), draw.choice([0, 1, 5, 15, 16, 17, 60], 200)
    want = np.concatenate([source[s : s + n] for s, n in zip(starts, lengths, strict=True)])
    assert (chatformat.gather(source, starts, lengths) == want).all()
    assert len(chatformat.gather(source, starts[:0], lengths[:0])) == 0


def test_assemble_slices():
    """Sliced lists and an empty one; spans are bytes from the start of each string."""
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    lists = pa.array([[("user", "no")], [("user", "é"), ("assistant", "ü!")], [], [("assistant", "")]], pa.list_(turn))
    formatted, loss = chatformat.assemble(pa.concat_arrays([lists.slice(1)]), Template())
    assert formatted.to_pylist() == ["<|im_start|>user\né<|im_end|><|im_start|>assistant\nü!<|im_end|>", "", "<|im_start|>assistant\n<|im_end|>"]
    cut = [[formatted[i].as_py().encode()[s["start"] : s["end"]].decode() for s in spans] for i, spans in enumerate(loss.to_pylist())]
    assert cut == [["ü!"], [], [""]]


def test_templates():
    with pytest.raises(ValueError):
        Template(start="<a>")
    with pytest.raises(ValueError):
        Template(controls=("<|im_start|>", "<|im_end|>", "\\x"))


def test_sql(spark, chats, tmp_path):
    chats.select("conv_id", "turn", "role", "text").write.parquet(str(tmp_path / "conversations.parquet"))
    duck = duckdb.connect()
    for folder in (str(tmp_path), "/root/testdata/sf0.001"):
        files = f"{folder}/conversations.parquet" + ("/*.parquet" if folder == str(tmp_path) else "")
        duck.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{files}'")
        want = duck.execute(queries.oracle_sql()["op12_chat_format"]).fetchall()
        got = [tuple(r) for r in queries.queries()["op12_chat_format"](spark, folder).collect()]
        key = lambda r: (r[0] is None, r[0] or 0)
        assert sorted(got, key=key) == sorted(want, key=key)
