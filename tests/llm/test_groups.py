"""Near-duplicates, archives, packing and the pipeline."""

import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from daymatrix.llm import packing, simhash_anchor, warc
from daymatrix.llm.components import components

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(values, near):
    roots = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if near(a, values[j]):
                old, new = sorted((roots[i], roots[j]), reverse=True)
                roots = [new if r == old else r for r in roots]
    return roots


def test_links_of_random_fingerprints(spark):
    r = random.Random(4)
    values = {r.getrandbits(64) for _ in range(40)} | {0}
    for v in list(values):
        for _ in range(6):
            w = v
            for b in r.sample(range(64), r.randint(1, 5)):
                w ^= 1 << b
            values.add(w)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for bits in (0, 2, 3):
        found = [tuple(sorted((x.a, x.b))) for x in simhash_anchor.links(prints, bits).collect()]
        expected = {
            tuple(sorted((a, b))) for i, a in enumerate(signed) for b in signed[:i]
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits
        }
        assert len(found) == len(expected) and set(found) == expected
    with pytest.raises(ValueError):
        simhash_anchor.links(prints, 4)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(5, 5), (2, 1), (None, 3), (200, 201)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_near_duplicates(documents):
    r = random.Random(2)
    base = [" ".join(r.choice("abcdefghij") * r.randint(1, 5) for _ in range(150)) for _ in range(8)]
    rows = [(10 * k + j, t + (f" tail{j}" if j % 3 else "")) for k, t in enumerate(base) for j in range(9, 0, -1)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "A b"), (504, "a B"), (504, "a B"), (None, "a b"), (600, "w " * 30_000)]
    found = simhash_anchor.near_duplicates(documents(rows)).collect()
    prints = [brute_print(t) for _, t in rows]
    roots = brute_roots(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, _), root in zip(rows, roots):
        least[root] = min(x for x in (least.get(root), i) if x is not None)
    expected = Counter((i, f"{p:016x}", least[root]) for (i, _), p, root in zip(rows, prints, roots))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == expected
    docs = documents(rows)
    kept = simhash_anchor.first_of_groups(docs)
    assert kept.columns == docs.columns
    order = lambda r: (r[0] is None, r[0] or 0)
    groups = {}
    for row, root in zip(rows, roots):
        groups.setdefault(root, []).append(row[0])
    assert Counter(r.doc_id for r in kept.collect()) == Counter(min(ids, key=lambda i: order([i])) for ids in groups.values())
    assert simhash_anchor.near_duplicates(documents([]).limit(0)).count() == 0


LONG = "<p>x</p>" * 200_000


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, digest string, refers_to int")


def test_archives_give_back_what_was_written(spark, tmp_path):
    same = "<html>" + "é same " * 30
    rows = [
        (5, "http://a/\r\n b", same), (3, "http://b/é", same), (9, None, same), (1, "u", None), (2, "u", ""), (4, "u", "short"),
        (6, "u", "short"), (7, "u", LONG), (8, "u", "WARC/1.1\r\n\r\n" * 20), (10, "u", "a\r\nb\x00" * 40),
    ] + [(100 + i, f"u{i}", f"<p>{i}</p>" * 40) for i in range(50)] + [(200 + i, "u", same) for i in range(30)]
    df = pages(spark, rows)
    index = warc.write_archives(df.repartition(3), f"file://{tmp_path}/w")
    found = {r.page_id: r for r in warc.read_records(index, f"file://{tmp_path}/w").collect()}
    assert len(found) == len(rows)
    for page, url, html in rows:
        assert found[page].url == url
        if found[page].record_type == "response":
            assert found[page].html == (html or "")
        else:
            assert (html, found[page].refers_to, found[page].html) == (same, 3, None)
    some = warc.read_records(index.where("page_id % 7 = 3"), f"file://{tmp_path}/w")
    assert {r.page_id for r in some.collect()} == {i for i in found if i % 7 == 3}
    df.write.parquet(f"{tmp_path}/p")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/p/*.parquet'")
    sql = db.execute(warc.ORACLE_SQL)
    names = [c[0] for c in sql.description]
    assert sorted(sql.fetchall()) == sorted(tuple(r[c] for c in names) for r in found.values())


def test_repeated_and_missing_pages(spark):
    text = "y" * 200
    found = warc.round_trip(pages(spark, [(1, "a", text), (1, "b", text), (None, "c", text), (2, "d", text), (1, "e", "z" * 200)])).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in found) == Counter(
        {(1, "response", None): 3, (None, "response", None): 1, (2, "revisit", 1): 1}
    )
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_close_ranges_are_read_together():
    ranges = [(0, 10), (10, 10), (40, 5), (200, 10)]
    assert warc.coalesced(ranges, gap=20, most=100) == [(0, 45, [0, 1, 2]), (200, 10, [3])]
    assert warc.coalesced(ranges, gap=0, most=100) == [(0, 20, [0, 1]), (40, 5, [2]), (200, 10, [3])]
    assert warc.coalesced([(0, 500), (500, 500)], gap=9, most=600) == [(0, 500, [0]), (500, 500, [1])]


ODD = [
    None, "", " \n", "Hello, WORLD... it's ÉCOLE's <|endoftext|> <|ENDOFTEXT|>", "a b\x1cc\x85d", "école Straße ΣΑΣ İi ǅ",
    "x.,.,y 12,345.67 ,,. don't,", "日本語 テキスト 𝒳", "ﬁne ½ ² ª º µ", "w " * 9000, "-" * 300, "́ ̸< ̀a",
]


def test_pieces_are_the_tokenizers(documents):
    tokenizer = Tokenizer.from_file(PATH)
    rows = list(enumerate(ODD)) + [(3, ODD[3]), (None, "null id")]
    found = packing.pack_documents(documents(rows), PATH).collect()
    expected = Counter()
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            expected[i, k, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    bins = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == bins.get(r.sequence_id, 0)
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values()) <= 4096
    assert packing.pack_documents(documents([]).limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_bins_hold_everything_tightly(seed):
    r = random.Random(seed)
    lengths = Counter(r.randint(1, 100) if r.random() < 0.8 else r.randint(1, 8) for _ in range(3000))
    bins = packing.best_two_fit(lengths, 100)
    assert Counter(n for b in bins for n in b) == lengths and all(sum(b) <= 100 for b in bins)
    assert len(bins) <= -(-sum(n * c for n, c in lengths.items()) // 100) * 1.03 + 1


def test_two_documents_replace_the_smallest():
    assert sorted(map(sorted, packing.best_two_fit(Counter([60, 35, 20, 19]), 100))) == [[19, 20, 60], [35]]


def test_groups_are_packed_apart(documents):
    rows = [(i, f"w{i} " * (i % 50 + 1)) for i in range(300)]
    found = packing.pack_documents(documents(rows), PATH, group=40).collect()
    assert len(found) == 300 and len({(r.sequence_id, r.offset) for r in found}) == 300


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_pipeline_stages(spark):
    """Every stage against a plain computation on its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    benchmark = [re.sub(r"[\W_]+", " ", r.text.lower()).strip() for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        after = stage(spark, docs, FOLDER)
        kept = after.collect()
        if name == "quality rules":
            for r in before:
                words = r.text.split()
                if r not in kept:
                    assert len(words) < 20 or len(set(words)) < 0.9 * len(words) or not r.text.isalpha()
        if name == "SimHash near-dedup":
            prints = [brute_print(r.text) for r in before]
            roots = brute_roots(prints, lambda a, b: (a ^ b).bit_count() <= 3)
            least = {}
            for r, root in zip(before, roots):
                least[root] = min(least.get(root, r.doc_id), r.doc_id)
            assert sorted(r.doc_id for r in kept) == sorted(least.values())
        if name == "benchmark decontamination":
            gone = {r.doc_id for r in before} - {r.doc_id for r in kept}
            whole = {r.doc_id for r in before if any(b in re.sub(r"[\W_]+", " ", r.text.lower()) for b in benchmark)}
            assert whole <= gone and len(gone) <= len(whole) + 5
        if name == "best-fit packing":
            assert {r.doc_id for r in kept} == {r.doc_id for r in before}
        else:
            assert after.columns == columns and {r.doc_id for r in kept} <= {r.doc_id for r in before}
            docs = after
    assert docs.count() > 0
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.select("doc_id").distinct().count() == docs.count()


def test_one_row_stays_of_repeated_null_and_clashing_ids(documents):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, a), (None, b), (None, b), (2, c), (3, c), (3, "quite another text of its own here"), (5, None), (4, " ")]
    kept = simhash_anchor.first_of_groups(documents(rows)).collect()
    expected = [(1, a), (None, b), (2, c), (3, rows[6][1]), (4, " ")]
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted((i or 0, t) for i, t in expected)
    assert simhash_anchor.first_of_groups(documents([]).limit(0)).count() == 0


def test_a_large_group_of_copies_costs_its_rows(documents):
    rows = [(i, "the same words again and again") for i in range(5_000)] + [(9_000, "others")]
    assert {r.doc_id for r in simhash_anchor.first_of_groups(documents(rows)).collect()} == {0, 9_000}
