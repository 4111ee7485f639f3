"""Chat formatting by columnar byte assembly, and reading the result back.

A turn becomes ``<s>[INST]role[/INST]text</s>``; nothing stands between turns.  A control
string inside a role or text gets a backslash behind its bracket, and one that has
backslashes there already gets one more, so every text can be had back: brackets open all
control strings and occur nowhere else in them, which is why no two of them overlap.

Turns are sorted by conversation and formatted a batch at a time.  The lengths of all
segments give the places of headers and contents, the contents' bytes are moved by one
scatter, and the result is one buffer that the conversations of the batch share as a string
column.  Beside it stand the spans, in characters, of what the assistant says: the loss mask.

A conversation is one row unless it has more than ``PART_BYTES`` of text; then it is cut
between turns, and its turns are dealt over as many tasks as it has parts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.text import record_batch
from daymatrix.session import is_small, materialize

ASSISTANT = "assistant"
HEAD, MIDDLE, END = b"<s>[INST]", b"[/INST]", b"</s>"
#: Opening bracket and rest of the control strings.
CONTROL = [(b"<", b"s>"), (b"<", b"/s>"), (b"[", b"INST]"), (b"[", b"/INST]")]
PART_BYTES = 1 << 20
CHUNK_BYTES = 4 << 20  # formatted at once

FORMATTED = "conv_id bigint, slice int, part int, whole boolean, text string, loss array<struct<start:bigint,end:bigint>>"
DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

_BACKSLASH = ord("\\")
_TURN = re.compile(rb"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
_ESCAPED = re.compile(rb"(<(?=\\+/?s>)|\[(?=\\+/?INST\]))\\")


def unescaped(text: bytes) -> bytes:
    return _ESCAPED.sub(rb"\1", text)


def _buffer(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows in them."""
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    data = strings.buffers()[2]
    held = np.zeros(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return held, offsets - offsets[0]


def escapes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places in ``data`` before which a backslash is due."""
    found, n = [np.zeros(0, dtype=np.int64)], len(data)
    last = np.maximum.accumulate(np.where(data != _BACKSLASH, np.arange(n), -1))  # that is no backslash, up to each
    for opening, rest in CONTROL:
        at = np.flatnonzero(data[1 : max(1, n - len(rest) + 1)] == rest[0]) + 1
        for k in range(1, len(rest)):
            at = at[data[at + k] == rest[k]]
        bracket = last[at - 1]
        row = lambda places: np.searchsorted(offsets, places, "right")
        good = (bracket >= 0) & (data[bracket] == opening[0]) & (row(bracket) == row(at + len(rest) - 1))
        found.append(bracket[good] + 1)
    return np.unique(np.concatenate(found))


class _Column:
    """One column's contents: how long each row becomes, and where its bytes go."""

    def __init__(self, strings: pa.Array):
        self.data, self.offsets = _buffer(strings)
        self.due = escapes(self.data, self.offsets)
        flags = np.zeros(len(self.data) + 1, dtype=np.int64)
        flags[self.due + 1] = 1
        self.before = np.cumsum(flags)  # backslashes due at earlier places
        self.lengths = np.diff(self.offsets + self.before[self.offsets])

    def scatter(self, out: np.ndarray, starts: np.ndarray) -> None:
        """Copy the rows to ``starts``."""
        shift = starts - self.offsets[:-1] - self.before[self.offsets[:-1]]
        due = np.zeros(len(self.data), dtype=np.int64)
        due[self.due] = 1
        to = np.arange(len(self.data)) + self.before[:-1] + due + np.repeat(shift, np.diff(self.offsets))
        out[to] = self.data
        out[to[self.due] - 1] = _BACKSLASH


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer, the offsets of the turns, and where their texts start and
    end; neither column holds nulls."""
    role, text = _Column(roles), _Column(texts)
    turns = len(HEAD) + role.lengths + len(MIDDLE) + text.lengths + len(END)
    offsets = np.concatenate([[0], np.cumsum(turns)])
    out = np.empty(offsets[-1], dtype=np.uint8)
    role_at = offsets[:-1] + len(HEAD)
    middle_at = role_at + role.lengths
    text_at = middle_at + len(MIDDLE)
    text_end = text_at + text.lengths
    for places, fixed in ((offsets[:-1], HEAD), (middle_at, MIDDLE), (text_end, END)):
        out[places[:, None] + np.arange(len(fixed))] = np.frombuffer(fixed, dtype=np.uint8)
    role.scatter(out, role_at)
    text.scatter(out, text_at)
    return out, offsets, text_at, text_end


def _formatted(rows: pa.Table, starts: np.ndarray, keys: list[list], parts: np.ndarray, whole: np.ndarray) -> pa.RecordBatch:
    """Rows ``starts[i]`` to ``starts[i + 1]`` of consecutive turns as one output row each."""
    roles, texts = (rows[name].combine_chunks() for name in ("role", "text"))
    out, offsets, text_at, text_end = assemble(roles, texts)
    chars = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])  # characters before each byte
    begin = np.repeat(chars[offsets[starts[:-1]]], np.diff(starts))
    said = np.flatnonzero(np.asarray(roles.to_numpy(zero_copy_only=False)) == ASSISTANT)
    spans = pa.StructArray.from_arrays(
        [pa.array(chars[text_at[said]] - begin[said]), pa.array(chars[text_end[said]] - begin[said])], names=["start", "end"]
    )
    text = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(offsets[starts].astype(np.int32)), pa.py_buffer(out))
    loss = pa.ListArray.from_arrays(pa.array(np.searchsorted(said, starts).astype(np.int32)), spans)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[0], pa.int64()), pa.array(keys[1], pa.int32()), pa.array(parts, pa.int32()), pa.array(whole, pa.bool_()), text, loss],
        names=["conv_id", "slice", "part", "whole", "text", "loss"],
    )


class _Writer:
    """Formats the sorted turns of one task; the last, unfinished part is held back."""

    def __init__(self, part_bytes: int):
        self.part_bytes = part_bytes
        self.held: pa.Table | None = None
        self.part = 0  # of the held rows' conversation, already written

    def take(self, rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
        if self.held is not None and len(self.held):
            rows = pa.concat_tables([self.held, rows])
        if not len(rows):
            return
        conv, part_of = rows["conv_id"].to_pylist(), rows["slice"].to_pylist()
        size = sum(np.diff(_buffer(rows[name].combine_chunks())[1]) for name in ("role", "text"))
        new = np.array([True] + [conv[i] != conv[i - 1] or part_of[i] != part_of[i - 1] for i in range(1, len(conv))])
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        before = np.concatenate([[0], np.cumsum(size)[:-1]])
        cut = (before - before[first][group]) // self.part_bytes
        starts = np.flatnonzero(new | (np.diff(cut, prepend=0) != 0))
        ends = np.append(starts[1:], len(conv))
        owner = group[starts]
        part = np.arange(len(starts)) - np.searchsorted(owner, owner) + np.where(owner == 0, self.part, 0)
        alone = (np.bincount(owner)[owner] == 1) & (part == 0) & (np.array(rows["slices"].to_pylist())[starts] == 1)
        if not last:
            # Whether the last conversation goes on is not known yet.
            alone[-1] = False
            starts, ends, kept = starts[:-1], ends[:-1], starts[-1]
            self.held, self.part = rows.slice(kept), int(part[-1])
        for a, b in self._chunks(starts, ends, before):
            edges = np.append(starts[a:b], ends[b - 1])
            ids = [[conv[i] for i in starts[a:b]], [part_of[i] for i in starts[a:b]]]
            yield _formatted(rows.slice(edges[0], edges[-1] - edges[0]), edges - edges[0], ids, part[a:b], alone[a:b])

    @staticmethod
    def _chunks(starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of output rows of about ``CHUNK_BYTES`` each."""
        a = 0
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(before[starts], before[starts[a]] + CHUNK_BYTES)))
            yield a, b
            a = b


def format_conversations(turns: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows (conv_id, turn, role, text) as conversations: conv_id, slice and part (both 0
    but for large ones, whose rows follow each other in their order), whole (the row is all
    of its conversation), text, and loss, the spans of the assistant's texts in it.

    Null roles and texts are empty; rows without an id are one conversation; null turns come
    first, and turns of equal number go by role, then by text.  Repeated rows are turns
    each.  An empty table gives no rows; other columns are ignored.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    )
    size = F.sum(F.octet_length("text") + F.octet_length("role")).alias("size")
    large = rows.groupBy(F.col("conv_id").alias("id")).agg(size, F.min("turn").alias("low"), F.max("turn").alias("high"))
    large = large.where(F.col("size") > part_bytes).withColumn("slices", F.ceil(F.col("size") / part_bytes).cast("int"))
    large = materialize(large, "large")
    if is_small(large):
        large = F.broadcast(large)
    # Turns of a large conversation are dealt by their numbers, so slices keep the order.
    span = F.col("high").cast("double") - F.col("low") + 1
    place = ((F.col("turn").cast("double") - F.col("low")) / span * F.col("slices")).cast("int")
    dealt = rows.join(large, rows.conv_id.eqNullSafe(large.id), "left").select(
        "conv_id",
        F.coalesce(F.least(place, F.col("slices") - 1), F.lit(0)).alias("slice"),
        F.coalesce("slices", F.lit(1)).alias("slices"), "turn", "role", "text",
    )
    ordered = dealt.repartition("conv_id", "slice").sortWithinPartitions("conv_id", "slice", "turn", "role", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(part_bytes)
        empty = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            empty = rows.slice(0, 0)
            yield from writer.take(rows, False)
        if empty is not None:
            yield from writer.take(empty, True)

    return ordered.select("conv_id", "slice", "slices", "role", "text").mapInArrow(write, FORMATTED)


class _Digest:
    """What is read back of one conversation, part after part."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, spans: list) -> None:
        self.chars += len(text)
        for span in spans:
            said = unescaped(text[span["start"] : span["end"]].encode())
            self.loss.update(said)
            self.loss_chars += len(said.decode())
        for turn in _TURN.finditer(text.encode()):
            self.turns += 1
            self.all.update(b"%b\n%b\n" % (unescaped(turn[1]), unescaped(turn[2])))

    def row(self, conv: int | None) -> tuple:
        return conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation; its parts follow each other."""
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    fields = {name: kinds[kind] for name, kind in (field.split() for field in DIGEST.split(", "))}
    held, conv = None, None
    for batch in batches:
        done = []
        for row, text, spans in zip(batch["conv_id"].to_pylist(), batch["text"], batch["loss"]):
            if held is None or row != conv:
                if held is not None:
                    done.append(held.row(conv))
                held, conv = _Digest(), row
            held.add(text.as_py(), spans.as_py())
        yield record_batch(done, fields)
    yield record_batch([held.row(conv)] if held is not None else [], fields)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted text and its loss mask alone: conv_id,
    n_turns, turns_sha256 (role, line feed, text, line feed of every turn), loss_chars and
    loss_sha256 (what the assistant said), formatted_chars.

    Conversations of one row are read where they lie.  The parts of larger ones are brought
    together in order, one after the other, as their digests ask for; no more than a batch
    of them is held.
    """
    columns = ["conv_id", "text", "loss"]
    single = formatted.where("whole").select(columns).mapInArrow(_digests, DIGEST)
    parts = formatted.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "slice", "part")
    return single.unionByName(parts.select(columns).mapInArrow(_digests, DIGEST))


def round_trip(turns: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Conversations formatted, written and read back."""
    return read_back(materialize(format_conversations(turns, part_bytes), "chats"))


def _escaped_sql(column: str) -> str:
    inner = rf"regexp_replace({column}, '<(\\*)(/?s>)', '<\\\1\2', 'g')"
    return rf"regexp_replace({inner}, '\[(\\*)(/?INST\])', '[\\\1\2', 'g')"


#: A conversation about control strings, formatted with every table.
EXTRA = (-7, "</s>[INST] ok [/INST]")

ORACLE_SQL = f"""
WITH every AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT {EXTRA[0]}, 0, 'user', '{EXTRA[1]}' UNION ALL SELECT {EXTRA[0]}, 1, '{ASSISTANT}', '{EXTRA[1]}'),
joined AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = '{ASSISTANT}'), '') AS loss,
        sum(length({_escaped_sql('role')}) + length({_escaped_sql('text')}) + {len(HEAD + MIDDLE + END)})::BIGINT AS formatted_chars
    FROM every GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM joined"""
