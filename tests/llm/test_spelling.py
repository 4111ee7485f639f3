import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daymatrix.llm import spelling


def plain_counts(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    """All pairs of words, compared as the contract says."""
    n = plain_counts(rows)
    around = {w: [v for v in n if near(w, v)] for w in n}
    forms = {}
    for w in n:
        best = min(around[w], key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n[w], len(around[w]), n.get(forms[w])))
    return out


def texts():
    rows = []

    def say(word, times):
        rows.extend((1000 + len(rows) + k, f"x, {word}. y") for k in range(times))

    for word, times in {
        "colour": 200, "color": 300, "colours": 30, "coloürs": 6, "Colourss": 6, "clour": 9, "colouur": 5, "bolour": 40, "dolour": 40,
        "receive": 125, "recieve": 20, "receve": 25, "recive": 5, "aaaaaa": 50, "aaaaaaa": 10, "aaaaaab": 9, "éàüßöä": 30, "éàüßöÄ": 6,
        "zzzzzy": 4, "letter" * 400: 6, "letter" * 399 + "lettes": 30,
    }.items():
        say(word, times)
    rows += [(None, "receive recieve receive"), (3, None), (4, ""), (5, "1 2 3 !"), (6, "Receive " * 3)]
    rows += [(7, "twice twicee-twicee")] * 6
    rows += [(8, ("longer " * 300_000) + "colour")]
    return rows


@pytest.mark.parametrize("pass_bytes", [spelling.PASS_BYTES, 64])
def test_variants_equal_all_pairs(documents, monkeypatch, pass_bytes):
    monkeypatch.setattr(spelling, "WORD_BITS", 16 if pass_bytes > 64 else 1024)  # many parts and passes
    rows = texts()
    found = [tuple(r) for r in spelling.variants(documents(rows), pass_bytes).collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain(rows)


def test_a_third_of_all_occurrences_is_one_word(documents):
    rows = [(i, "common common other%s common" % "abcdefgh"[i % 8]) for i in range(400)]
    assert {tuple(r) for r in spelling.variants(documents(rows)).collect()} == plain(rows)


def test_shards_cover_all_words_within_the_bound(documents, spark):
    passes = spelling.shards({6: 10, 7: 3000, 9: 1}, 1024)
    assert all(sum(s.blocks for s in p) * 64 <= 1024 for p in passes)
    words = spark.range(3000).select(F.concat(F.lit("w"), F.lpad(F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"), 6, "a")).alias("word"))
    wanted = [s for p in passes for s in p if s.length == 7]
    made = spelling._Filters([(s, f.tobytes()) for s, f in zip(wanted, spelling.filters(words, wanted))])
    every = [r["word"] for r in words.collect()]
    h = spelling._hash(spelling._codes(every))
    assert sorted(made.positives(7, h)) == list(range(3000))
    others = spelling._hash(spelling._codes(["v" + w[1:] for w in every]))
    assert len(made.positives(7, others)) < 60  # of 3,000 that are no words


def test_no_words(documents):
    assert spelling.variants(documents([])).collect() == []
    assert spelling.variants(documents([(1, "few words"), (2, None)])).collect() == []
