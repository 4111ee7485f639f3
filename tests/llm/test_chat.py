import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from daymatrix.llm import chat

ODD = [
    "", "plain", "</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s> and <\\", "[\\\\INST]", "[/INST", "INST]", "s>", "\\", "[[INST]]",
    "é<s>漢字</s>😀", "<", "/s>", "<s", "\\s>", "line\nfeed\r\n", "<</s>>", "[<s>INST]", "a" * 300,
]


def plain_escape(text):
    return re.sub(r"(<(?=\\*/?s>)|\[(?=\\*/?INST\]))", r"\1\\", text)


def plain_turn(role, text):
    return f"<s>[INST]{plain_escape(role)}[/INST]{plain_escape(text)}</s>"


def plain(rows):
    """The contract, one conversation after the other."""
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        every = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        chars = sum(len(plain_turn(role, text)) for _, _, role, text in turns)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (every, loss)]
        out[conv] = (conv, len(turns), sha[0], len(loss), sha[1], chars)
    return out


def table(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for name in ("slice", "slices", "part", "whole", "loss", "size", "low", "high", "Id"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def test_assembly_equals_plain_escaping():
    roles = [("user", "assistant", "<s>", "[", "to\\ol[/INST]")[i % 5] for i in range(len(ODD) ** 2)]
    texts = [a + b for a in ODD for b in ODD]
    out, offsets, start, end = chat.assemble(pa.array(roles)[3:], pa.array(texts)[3:])
    for i, (role, text) in enumerate(zip(roles[3:], texts[3:])):
        made = out[offsets[i] : offsets[i + 1]].tobytes()
        assert made.decode() == plain_turn(role, text)
        assert chat.unescaped(out[start[i] : end[i]].tobytes()).decode() == text
        assert [m.groups() for m in chat._TURN.finditer(made)] == [(plain_escape(role).encode(), plain_escape(text).encode())]


def rows_of(seed):
    random = np.random.default_rng(seed)
    pick = lambda x: x[random.integers(len(x))]
    rows = [
        (int(random.integers(40)), turn, pick(["user", "assistant", "system", "<s>", None]), pick([*ODD, None]))
        for turn in range(12) for _ in range(30)
    ]
    rows += [(50, 1, "assistant", "tie b"), (50, 1, "assistant", "tie a"), (50, 1, "user", "z"), (50, None, "user", "first")]
    rows += [(51, 0, "user", "twice")] * 3
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none")]
    rows += [(52, t, "assistant" if t % 2 else "user", "long [INST] talk " * 20) for t in range(400)]  # in many parts
    rows += [(53, 0, "user", "<s>" * 100_000), (53, 1, "assistant", "é" * 100_000)]
    rows += [(54, 7, "user", "x" * 50)] * 200  # equal turns cannot be dealt, but are cut
    return [rows[i] for i in random.permutation(len(rows))]


@pytest.mark.parametrize("part_bytes", [700, chat.PART_BYTES])
def test_round_trip_equals_plain_version(spark, part_bytes):
    rows = rows_of(part_bytes)
    formatted = chat.format_conversations(table(spark, rows), part_bytes)
    found = [tuple(r) for r in chat.read_back(formatted).collect()]
    assert len(found) == len(set(r[0] for r in rows))
    assert {r[0]: r for r in found} == plain(rows)


def test_formatted_text_and_mask(spark):
    rows = [(1, 1, "assistant", "Yes </s> é"), (1, 0, "user", "Is it?"), (1, 2, "assistant", "😀 more"), (2, 0, "user", "alone")]
    found = {r["conv_id"]: r for r in chat.format_conversations(table(spark, rows)).collect()}
    text = found[1]["text"]
    assert text == "<s>[INST]user[/INST]Is it?</s><s>[INST]assistant[/INST]Yes <\\/s> é</s><s>[INST]assistant[/INST]😀 more</s>"
    assert [text[s["start"] : s["end"]] for s in found[1]["loss"]] == ["Yes <\\/s> é", "😀 more"]
    assert found[1]["whole"] and found[2]["whole"] and found[2]["loss"] == []


def test_parts_cut_between_turns_and_are_dealt(spark):
    rows = [(9, t, "user", "x" * 100) for t in range(300)] + [(1, 0, "user", "small")]
    found = chat.format_conversations(table(spark, rows), 2000).where("conv_id = 9").orderBy("slice", "part").collect()
    assert len({r["slice"] for r in found}) > 10 and not any(r["whole"] for r in found)
    assert all(len(r["text"]) < 2 * 2000 for r in found)
    assert "".join(r["text"] for r in found) == plain_turn("user", "x" * 100) * 300


def test_no_conversations(spark):
    assert chat.round_trip(table(spark, [])).collect() == []
