"""Decontamination, quality rules, license scan."""

import random
import re

import duckdb
import pytest

from daymatrix.llm import decontam, license_scan, line_rules

WORDS = "alpha beta gamma delta omega sigma lambda kappa theta iota zeta rho".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s", "x"]) for _ in range(n))


def distance_within(pattern, text):
    """Smallest edit distance of pattern and any part of text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(text, edits, seed):
    r, out = random.Random(seed), list(text)
    for _ in range(edits):
        i = r.randrange(len(out))
        out[i : i + 1] = r.choice([[], ["q"], [out[i], "q"]])
    return "".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_leaks_equal_full_alignment(seed):
    items = [(1, prose(seed, 40)), (2, prose(seed + 50, 9)), (3, "tiny"), (4, "aaaa " * 40)]
    index = decontam.Index(items)
    for edits in (0, 5, 11, 14, 30):
        text = prose(seed + 7, 15) + " " + edited(items[seed % 2][1], edits, seed) + " " + prose(seed + 9, 15)
        codes, _ = decontam.normalise(text)
        expected = {
            int(index.owner[s]) for s, segment in enumerate(index.segments)
            if len(segment) >= decontam.Q and distance_within(list(segment), list(codes)) <= index.budget[s]
        }
        assert {x[0] for x in index.find(text)} == expected


def test_spans_windows_and_short_items():
    item = prose(3, 60)
    index = decontam.Index([(1, item), (2, "tiny"), (3, "")])
    before = prose(4, 40_000)  # over several windows
    text = f"{before} {item.upper()} {before} tiny, tinyer"
    assert [(i, text[s:e].lower(), k) for i, s, e, k in index.find(text)] == [(1, item, 0), (2, "tiny", 0)]
    assert index.find("") == index.find(None) == index.find("tin y tinies") == []


def test_leaks_as_tables(spark, documents):
    items = spark.createDataFrame(
        [(7, prose(1, 50)), (7, prose(1, 50)), (8, None), (None, "x"), (9, prose(2, 50))], "item_id bigint, text string"
    )
    docs = documents([(1, "see " + prose(1, 50)), (1, "see " + prose(1, 50)), (2, None), (3, ""), (None, prose(2, 50)), (5, prose(8, 90))])
    for block_chars in (10, 2_000_000):  # one block per item, one for all
        found = decontam.find_leaks(docs, items, block_chars=block_chars)
        assert sorted((r.doc_id or 0, r.item_id) for r in found.collect()) == [(0, 9), (1, 7), (1, 7)]
        kept = decontam.without_leaks(docs, items, block_chars=block_chars)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert decontam.find_leaks(docs, items.limit(0)).count() == 0
    assert decontam.find_leaks(docs.limit(0), items).count() == 0


TEXTS = [
    None, "", " \n\t ", "one", prose(1, 30) + ".", "x " * 9, " ".join("abcdefgh") + " " + " ".join("abcdefgh"),
    prose(2, 25) + "\n" + prose(2, 25) + "\nHome\nHome\n", prose(3, 40) + "\nhome | news | about | contact",
    "%%% ### &&& " * 20, prose(4, 25) + "\nAll rights reserved. " + prose(5, 200),
    "é" * 30 + " " + prose(6, 21), prose(7, 10) * 9, prose(9, 5000), "a\x0bb\x0cc\rd\n" * 12,
    "Ñandú — «" + prose(11, 30) + "»", "w " * 20_000,
]


def repeated(words, n=8):
    seen, covered = {}, set()
    for i in range(len(words) - n + 1):
        seen.setdefault(tuple(words[i : i + n]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(n))
    return len(covered)


def test_rules_equal_brute_force_and_sql(spark, documents, tmp_path):
    docs = documents(list(enumerate(TEXTS)) + [(4, TEXTS[4]), (None, TEXTS[4])])
    rows = line_rules.apply_rules(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        text = TEXTS[4 if row.doc_id is None else row.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == repeated(words)
        assert row.base_failed == (len(words) < 20 or 100 * row.n_repeat_words > 30 * len(words))
    docs.write.parquet(f"{tmp_path}/d")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    sql = db.execute(line_rules.ORACLE_SQL)
    columns = [c[0] for c in sql.description]
    order = lambda rows: sorted(rows, key=repr)
    assert order(sql.fetchall()) == order([tuple(r[c] for c in columns) for r in rows])
    assert line_rules.apply_rules(docs.limit(0)).count() == 0


def test_lines_go_first_then_documents(documents):
    good, bar = prose(1, 60), "home | news | about | contact"
    docs = documents([(1, f"{good}\n{bar}"), (2, f"{prose(2, 22)}\n" + "\n".join(f"{bar} {i}" for i in range(20)))])
    assert [r.text for r in line_rules.cleaned(docs).where("doc_id = 1").collect()] == [good]
    kept = line_rules.kept_documents(docs)
    assert kept.columns == docs.columns and [(r.doc_id, r.text) for r in kept.collect()] == [(1, f"{good}\n{bar}")]


def test_licenses(documents):
    grant = dict((b, a) for a, b in license_scan.TEMPLATES[11:12])
    grant = next(iter(grant))
    changed = grant.replace("hereby ", "").replace("person", "body")
    texts = [
        None, "", "MIT", "the MIT License; the mit-license", "gnu general gnu general public license", grant.title(),
        "x " + changed + " y", "Licensed under CC BY-NC 4.0.", "mit licenses", "cc cc by by", "MIT License " * 5000,
        "Ünder thé Apache License, apache\nlicense",
    ]
    rows = license_scan.scan(documents(list(enumerate(texts)) + [(3, texts[3]), (99, texts[3])])).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) + 2  # the repeated row twice
    assert sum(r.doc_id == 3 for r in rows) == 2
    for i, text in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [
            (k, label) for phrase, label in license_scan.PHRASES.items() for k in range(len(words))
            if words[k : k + len(phrase.split())] == phrase.split()
        ]
        starts = [k for k, _ in places]
        r = by_id[i]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert by_id[5].labels == by_id[6].labels == "mit-text" and by_id[5].score == 1 > by_id[6].score > 0.8
    assert by_id[7].labels == "cc-by,cc-by-nc"
    assert license_scan.scan(documents([]).limit(0)).count() == 0


def test_neighbouring_diagonals_are_one_span(documents):
    grant = license_scan.TEMPLATES[11][1]
    found = license_scan.spans(documents([(1, grant.replace("free", "entirely free"))]), license_scan.templates(documents([]).sparkSession))
    assert [r.label for r in found.where("label IS NOT NULL").collect()] == ["mit-text"]
    assert 0.8 <= found.where("label IS NOT NULL").first().similarity < 1
