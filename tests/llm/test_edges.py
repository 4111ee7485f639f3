"""Null, empty, long and repeated texts, ties and empty tables of models and stages."""

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daymatrix.llm import context_mixing, langid, quality_rff, queries, toxicity
from daymatrix.llm.text import held_out

FOLDER = "/root/testdata/sf0.001"
LONG = "w " * 50_000


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abdeilmnorstu") for _ in range(r.randint(2, 9))) for _ in range(n)) + "."


def marks(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int")


def test_empty_tables_give_models_and_no_rows(spark, documents):
    docs = documents([(i, prose(i), "xy"[i % 2]) for i in range(40)])
    known = marks(spark, [(i, i % 2) for i in range(40)])
    fold = ~held_out(4, 2)
    toxic = toxicity.fit(docs, known, "quality", fold)
    assert toxicity.scored(docs.limit(0), toxic).count() == 0
    for some, labels in ((docs.limit(0), known), (docs, known.limit(0))):
        assert {r.score for r in toxicity.scored(docs, toxicity.fit(some, labels, "quality", fold)).collect()} == {0.5}
        model = quality_rff.fit(some, labels, "quality", fold, held_out(4, 3))
        assert {r.score for r in quality_rff.scored(docs, model).collect()} == {0.5}
    assert langid.predicted(docs.limit(0), langid.fit(docs)).count() == 0
    assert langid.predicted(docs.limit(0), langid.fit(docs.limit(0))).count() == 0


def test_equally_close_languages_give_the_first_name(documents):
    both = [(2 * i + k, prose(i), lang) for i in range(20) for k, lang in enumerate(("zz", "aa"))]
    docs = documents(both + [(100, None), (101, "7 !"), (102, LONG), (103, prose(3)), (103, prose(3))])
    found = langid.predicted(docs, langid.fit(docs)).collect()
    assert len(found) == len(both) + 5
    assert {(r.lang_pred, r.score) for r in found if r.doc_id not in (100, 101)} == {("aa", 0.5)}
    assert {(r.lang_pred, r.score) for r in found if r.doc_id in (100, 101)} == {("und", 0.0)}


def test_equal_texts_have_equal_scores(spark, documents):
    rows = [(i, prose(i) if i % 2 else prose(i).replace(" ", " #$ ")) for i in range(120)]
    again = [(1000 + i, rows[i % 120][1]) for i in range(600)] + [(5000, LONG), (5001, LONG), (5002, None), (5003, "")]
    known = marks(spark, [(i, i % 2) for i in range(120)])
    docs = documents(rows + again)
    for module, model in (
        (quality_rff, quality_rff.fit(docs, known, "quality", ~held_out(4, 2), held_out(4, 3))),
        (toxicity, toxicity.fit(docs, known, "quality", ~held_out(4, 2))),
    ):
        texts = dict(rows + again)
        found = {}
        for r in module.scored(docs.repartition(7), model).collect():
            found.setdefault(texts[r.doc_id] or "", []).append(r.score)
        assert sum(map(len, found.values())) == len(texts)
        assert all(np.ptp(scores) < 1e-6 for scores in found.values())


def test_a_long_text_is_scored_to_its_end(documents):
    # What is added to a text that repeats itself costs the same each time.
    long = [(1000 + n, "ab cd " * n) for n in (20_000, 40_000, 60_000)]
    docs = documents([(i, prose(i)) for i in range(50)] + long)
    found = {r.doc_id: r for r in context_mixing.score(docs, F.col("doc_id") < 1000).collect()}
    a, b, c = (found[i] for i, _ in long)
    assert (a.n_tokens, b.n_tokens, c.n_tokens) == (40_001, 80_001, 120_001)
    assert b.score - a.score == pytest.approx(c.score - b.score, rel=1e-6) and a.score < 0
    assert b.base_score - a.base_score == pytest.approx(c.base_score - b.base_score, rel=1e-6)


@pytest.fixture
def odd(documents):
    text = prose(7, 90)
    rows = [(i, prose(i, 80)) for i in range(30)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, LONG), (None, text), (None, text), (904, prose(8, 90)), (904, prose(8, 90))]
    docs = documents(rows)
    for name in ("row", "fp", "key", "set", "sketch", "piece", "item_id"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, odd, name, stage):
    queries.ship(spark)
    before = Counter((r.doc_id, r.text) for r in odd.collect())
    after = stage(spark, odd, FOLDER)
    if name == "best-fit packing":
        pieces = after.collect()
        assert Counter(r.doc_id for r in pieces if r.piece == 0) == Counter(i for i, _ in before.elements())
        for part in (903, 900):
            mine = sorted((r.start, r.length) for r in pieces if r.doc_id == part)
            assert all(start + n == nxt for (start, n), (nxt, _) in zip(mine, mine[1:]))
            assert (len(mine) > 1) == (part == 903)
    else:
        assert after.columns == odd.columns
        kept = Counter((r.doc_id, r.text) for r in after.collect())
        if name == "SimHash near-dedup":
            assert set(kept.values()) == {1} and {t for _, t in kept if (t or "").strip()} == {t for _, t in before if (t or "").strip()}
            assert [i for i, t in kept if not (t or "").strip()] == [900]
        else:
            assert all(before[row] == n for row, n in kept.items())  # equal rows share a fate
        if name == "quality rules":
            assert not {900, 901, 902, 903} & {i for i, _ in kept} and {None, 904, *range(30)} <= {i for i, _ in kept}
        if name == "benchmark decontamination":
            assert kept == before
    assert stage(spark, odd.limit(0), FOLDER).count() == 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_pipeline_of_no_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        (table.limit(0) if name == "documents" else table).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() == 0 and {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(found.columns)
