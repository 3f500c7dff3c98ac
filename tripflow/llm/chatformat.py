"""Chat formatting by columnar byte assembly.

A conversation becomes one string: every turn between markers, and control strings inside roles and texts escaped, so that
the turns can be read back. For a batch of conversations, the lengths of all segments (marker, role, marker, text, marker), their
cumulative offsets and the index of every output byte are computed as arrays, and the bytes are copied into one
buffer, which is the Arrow column. The loss mask, byte spans of the texts that a model is trained on, follows from the
same offsets.

Long conversations are formatted in chunks of turns (see turns.py); the string of a conversation is that of its chunks in order.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .turns import CHUNK, joined_sha256, map_rows, placed

#: Conversations assembled at once, and bytes copied by one index; both bound memory.
BATCH, COPIED = 256, 1 << 20
FORMATTED = "block long, part int, several boolean, formatted string, loss array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Template:
    """start role middle text end. Control strings are escaped inside roles and texts; start and end must be among them,
    and middle is a character that is escaped inside roles. No control string holds a backslash."""

    start: str = "<|im_start|>"
    middle: str = "\n"
    end: str = "<|im_end|>"
    trained: str = "assistant"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

    def __post_init__(self):
        if not {self.start, self.end} <= set(self.controls) or len(self.middle) != 1 or any("\\" in c or len(c) < 2 for c in self.controls):
            raise ValueError("start and end must be control strings without backslashes, middle one character")

    def escaped(self, text: Column, role: bool = False) -> Column:
        """A backslash becomes \\b; \\e is put behind the first character of a control string; in a role, middle becomes \\m."""
        text = F.replace(text, F.lit("\\"), F.lit("\\b"))
        for c in self.controls:
            text = F.replace(text, F.lit(c), F.lit(c[0] + "\\e" + c[1:]))
        return F.replace(text, F.lit(self.middle), F.lit("\\m")) if role else text

    def unescaped(self, text: str) -> str:
        """Behind every backslash stands its letter, so the marks can be undone one after another."""
        return text.replace("\\m", self.middle).replace("\\e", "").replace("\\b", "\\") if "\\" in text else text

    def turns(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of all turns."""
        found = []
        for piece in formatted.split(self.start)[1:]:
            role, _, text = piece.removesuffix(self.end).partition(self.middle)
            found.append((self.unescaped(role), self.unescaped(text)))
        return found


def gather(source: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The segments of source (bytes) one behind the other, in one new buffer."""
    offsets = np.r_[0, np.cumsum(lengths)]
    out = np.empty(offsets[-1], dtype=np.uint8)
    at = 0
    while at < len(starts):
        if lengths[at] >= COPIED:  # a long segment is copied as it stands
            out[offsets[at] : offsets[at + 1]] = source[starts[at] : starts[at] + lengths[at]]
            at += 1
            continue
        until = max(at + 1, int(np.searchsorted(offsets, offsets[at] + COPIED, "right")) - 1)
        low, high = offsets[at], offsets[until]
        index = np.repeat(starts[at:until] - offsets[at:until], lengths[at:until]) + np.arange(low, high)
        np.take(source, index, out=out[low:high])
        at = until
    return out


def _bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Data, starts and lengths of a string column without nulls."""
    _, offsets, data = strings.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8), cuts[:-1], np.diff(cuts)


def assemble(turns: pa.ListArray, template: Template) -> tuple[pa.Array, pa.Array]:
    """Formatted strings and loss spans of conversations, given as lists of (role, text), both escaped."""
    role, text = (x.cast(pa.string()) for x in turns.flatten().flatten())
    sizes = np.diff(turns.offsets.to_numpy())
    fixed = [np.frombuffer(x.encode(), dtype=np.uint8) for x in (template.start, template.middle, template.end)]
    (role_data, role_at, role_n), (text_data, text_at, text_n) = _bytes(role), _bytes(text)
    source = np.concatenate([*fixed, role_data, text_data])
    begin = np.cumsum([0, *(len(x) for x in fixed), len(role_data)])
    n = len(role)
    starts, lengths = np.empty((n, 5), dtype=np.int64), np.empty((n, 5), dtype=np.int64)
    for column, (s, k) in enumerate((
        (begin[0], len(fixed[0])), (begin[3] + role_at, role_n), (begin[1], len(fixed[1])), (begin[4] + text_at, text_n), (begin[2], len(fixed[2])),
    )):
        starts[:, column], lengths[:, column] = s, k
    ends = np.cumsum(lengths.reshape(-1)).reshape(n, 5)
    out = gather(source, starts.reshape(-1), lengths.reshape(-1))
    last_turn = np.r_[0, np.cumsum(sizes)]
    cuts = np.r_[0, ends[:, 4]][last_turn]
    formatted = pa.StringArray.from_buffers(len(turns), pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(out))
    trained = np.flatnonzero(np.array(pa.compute.equal(role, template.trained)))
    owner = np.repeat(np.arange(len(turns)), sizes)[trained]
    span = [pa.array((ends[trained, c] - cuts[owner]).astype(np.int32)) for c in (2, 3)]
    in_list = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(turns)))].astype(np.int32)
    return formatted, pa.ListArray.from_arrays(pa.array(in_list), pa.StructArray.from_arrays(span, names=["start", "end"]))


def format_chats(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Rows (conv_id, block, part, several, formatted, loss): a conversation's string, in chunks of at most 256 turn numbers.

    conversations has conv_id, turn, role, text; other columns are not read. Null roles and texts are empty. Rows go by turn
    (nulls first), those of one turn by a hash of role and text; repeated rows are turns of their own; null ids are one
    conversation. loss has the byte spans, within formatted, of the texts of the trained role. several says that the
    conversation has other chunks. An empty table gives no rows. Texts are shuffled once.
    """
    rows = placed(conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]))
    chunks = rows.groupBy(*CHUNK).agg(F.count("*").alias("n"))
    several = chunks.groupBy(F.col("conv_id").alias("id")).agg(F.count("*").alias("n_chunks")).where("n_chunks > 1")
    marks = chunks.join(several, F.col("conv_id").eqNullSafe(F.col("id")), "left_semi").select(*CHUNK, F.lit(True).alias("several"))
    turn = F.struct("turn", "h", template.escaped(F.col("role"), True).alias("role"), template.escaped(F.col("text")).alias("text"))
    dealt = rows.select(*CHUNK, turn.alias("t"), F.lit(False).alias("several")).unionByName(marks, allowMissingColumns=True)
    gathered = dealt.groupBy(*CHUNK).agg(F.array_sort(F.collect_list("t")).alias("t"), F.max("several").alias("several"))
    turns = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))

    def work(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                formatted, loss = assemble(pa.concat_arrays([batch.column(4)]), template)
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], formatted, loss], names=[*CHUNK, "several", "formatted", "loss"])

    kind = conversations.schema["conv_id"].dataType.simpleString()
    return gathered.select(*CHUNK, "several", turns.alias("turns")).mapInArrow(work, f"conv_id {kind}, {FORMATTED}")


def digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """What is read back from format_chats' rows, per conversation: conv_id, n_turns, turns_sha256 (of role, line end, text and
    line end of each turn), loss_chars, loss_sha256 (of all text under the mask, unescaped), formatted_chars."""

    def read(rows):
        for row in rows:
            turns = template.turns(row["formatted"])
            raw = row["formatted"].encode()
            text = "".join(f"{role}\n{text}\n" for role, text in turns)
            loss = "".join(template.unescaped(raw[s["start"] : s["end"]].decode()) for s in row["loss"])
            head = [row[c] for c in CHUNK] + [len(turns), len(loss), len(row["formatted"])]
            alone = not row["several"]
            yield *head, *[sha256(x.encode()).hexdigest() if alone else None for x in (text, loss)], *[None if alone else x for x in (text, loss)]

    kind = formatted.schema["conv_id"].dataType.simpleString()
    found = stored(map_rows(formatted, read, (
        f"conv_id {kind}, block long, part int, n_turns long, loss_chars long, formatted_chars long, turns_sha256 string, loss_sha256 string, "
        "turns string, loss string"
    )))  # digests, and the texts of long conversations only
    totals = [F.sum(c).alias(c) for c in ("n_turns", "loss_chars", "formatted_chars")]
    whole = found.where("turns is null").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    parted = found.where("turns is not null")
    sums, hashes = parted.groupBy("conv_id").agg(*totals), joined_sha256(parted, {"turns": "", "loss": ""}).withColumnRenamed("conv_id", "id")
    return whole.unionByName(sums.join(hashes, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id"))
