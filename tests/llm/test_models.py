"""Quality, toxicity, language and language-model scores."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymatrix.llm import context_mixing, langid, quality_rff, toxicity
from daymatrix.llm.text import held_out

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
ODD = [(900, None), (901, ""), (902, " \n"), (903, "12 34"), (904, "w " * 50_000), (None, "a b"), (905, "a"), (905, "a")]


def prose(seed, n=60, syllables=SYLLABLES):
    r = random.Random(seed)
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))


def marks(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, quality int, label int")


def test_fold_is_the_checksum(spark):
    rows = spark.createDataFrame([(i,) for i in [*range(50), None]], "doc_id bigint").select("doc_id", held_out(4, 2).alias("h"))
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.collect())


def test_isotonic_is_the_best_non_decreasing_fit():
    r = np.random.default_rng(1)
    y, w = r.random(30), r.random(30) + 0.1
    fit = quality_rff.isotonic(y, w)
    assert (np.diff(fit) >= 0).all()
    expected = [
        max(min(np.average(y[a : b + 1], weights=w[a : b + 1]) for b in range(i, 30)) for a in range(i + 1)) for i in range(30)
    ]
    assert np.allclose(fit, expected)


def test_quality(spark, documents):
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        text = prose(i) + "." if good else " ".join(f"{w}{'%&#$'[k % 4] * 3}" for k, w in enumerate(prose(i).split()))
        rows.append((i, text))
        labels.append((i, int(good)))
    docs = documents(rows + ODD)
    known = marks(spark, labels + [(5000, 1), (None, 1), (7, None), (8, 1 - labels[8][1])])
    model = quality_rff.fit(docs, known, "quality", ~held_out(4, 2), held_out(4, 3))
    found = quality_rff.scored(docs, model).collect()
    assert len(found) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in found)
    test = [(r.score >= 0.7) == (r.doc_id % 3 > 0) for r in found if r.doc_id is not None and r.doc_id < 400]
    assert np.mean(test) > 0.98
    for none, score in ((known.limit(0), 0.5), (known.where("quality = 1"), 1.0)):
        model = quality_rff.fit(docs, none, "quality", ~held_out(4, 2), held_out(4, 3))
        assert {r.score for r in quality_rff.scored(docs, model).collect()} == {score}
    assert quality_rff.scored(docs.limit(0), model).count() == 0


def test_normal_equations_do_not_depend_on_partitions(spark):
    r = np.random.default_rng(2)
    stats, y = r.random((90, quality_rff.N_STATS)), r.integers(0, 2, 90)
    rows = spark.createDataFrame([(s.tolist(), int(v)) for s, v in zip(stats, y)], "stats array<float>, label int")
    model = quality_rff.Model(
        np.zeros(quality_rff.N_STATS), np.ones(quality_rff.N_STATS), r.normal(size=(quality_rff.N_STATS, 8)), np.ones(8), np.zeros(9), np.zeros(1), np.zeros(1)
    )
    z = model.features(stats.astype(np.float32).astype(float))
    for n in (1, 7):
        matrix, right = quality_rff._normal_rows(rows.repartition(n), model)
        assert np.allclose(matrix, z.T @ z) and np.allclose(right, z.T @ y)


def test_toxicity_finds_unseen_spellings(spark, documents):
    bad = ["blockhead", "dimwit", "nitwitted", "scoundrel"]
    rows, labels = [], []
    for i in range(900):
        words = prose(i, 80).split()
        if i % 3 == 0:
            for k in range(3):
                words.insert((i * 7 + k * 13) % 70, bad[(i // 3 + k) % 4])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    misspelt = prose(5001, 80).split()
    misspelt[40:40] = ["blockheadd", "scoundrell", "blockheads"]
    extra = [(5000, prose(5000, 80)), (5001, " ".join(misspelt))]
    docs = documents(rows + extra + ODD)
    model = toxicity.fit(docs, marks(spark, labels), "quality", ~held_out(4, 2))
    found = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    test = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(found[i] >= 0.3) == (i % 3 == 0) for i in test]) > 0.95
    assert found[5001] >= 0.3 > found[5000]
    assert all(0 <= s <= 1 for s in found.values())
    none = toxicity.fit(docs, marks(spark, labels).limit(0), "quality", ~held_out(4, 2))
    assert {r.score for r in toxicity.scored(docs, none).collect()} == {0.5}


def test_languages(documents):
    french = "le de la ou es ai re que eau ment tion é è".split()
    rows = [(i, prose(i, 30, french if i % 2 else SYLLABLES), "fr" if i % 2 else "en") for i in range(200)]
    docs = documents(rows + ODD + [(910, "Ωω 語"), (911, "𐐀𐐁")])
    model = langid.fit(docs.where(~held_out(5, 0)))
    found = {r.doc_id: r for r in langid.predicted(docs, model).collect()}
    assert all(found[i].lang_pred == ("fr" if i % 2 else "en") for i in range(200))
    assert {found[i].lang_pred for i in (900, 901, 902, 903)} == {"und"} and found[905].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in found.values())
    empty = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predicted(docs, empty).collect()} == {"und"}


def test_trigram_vectors_are_bound_and_bundled():
    space = langid.Space(64, 3)
    a, b, c = (space.letters[2][i] for i in (1, 2, 3))
    word = np.roll(a, 2) * np.roll(b, 1) * c
    assert np.array_equal(space.bundle([langid.trigrams("abc")[1:2]])[0], word)
    assert np.array_equal(*space.bundle([langid.trigrams("Abc, abc."), langid.trigrams("abc abc")]))


def test_mixed_probabilities_add_up(spark, documents):
    texts = [prose(i) for i in range(100)]
    model, _ = context_mixing.window_scores(documents(list(enumerate(texts))).withColumn("learn", F.lit(True)))
    windows, n = context_mixing._merged([[w, np.ones(len(w), dtype=np.int64)] for w, _ in context_mixing.blocks(texts)])
    known = dict(zip(windows.tolist(), n.tolist()))
    added = (windows[0] >> context_mixing.SYMBOL_BITS << context_mixing.SYMBOL_BITS) + np.arange(context_mixing.END + 1)
    others = ~np.isin(windows, added)
    counts = np.array([known.get(k, 0) for k in added.tolist()])
    log2 = context_mixing.group_log2(model, np.concatenate([added, windows[others]]), np.concatenate([counts, n[others]]).astype(float))
    assert math.isclose((2.0 ** log2[: len(added)]).sum(), 1, rel_tol=1e-3)


def test_known_prose_scores_above_noise(spark, documents):
    noise = "".join(random.Random(1).choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(len(prose(5000))))
    rows = [(i, prose(i)) for i in range(300)] + [(1000, prose(5000)), (1001, noise), (1002, ""), (1003, None), (1004, prose(5000))]
    found = {r.doc_id: r.score for r in context_mixing.score(documents(rows), F.col("doc_id") < 1000).collect()}
    assert found[1000] > 0.7 * found[1001] and found[1000] == found[1004] and found[1002] == found[1003] < 0


def plain_scores(rows, learn, model):
    """Scores from counts in a dict, one decision after the other."""
    tree, spaces = model.tree, b" \t\n\v\f\r"
    steps = lambda s: [(tree.node[i], tree.bit[i]) for i in range(tree.start[s], tree.start[s] + tree.length[s])]

    def contexts(symbols, i):
        before = symbols[i - context_mixing.ORDERS : i]
        place = next((k for k, x in enumerate(reversed(before)) if x == context_mixing.END or x in spaces), context_mixing.ORDERS)
        return [tuple(before[-k:]) for k in range(1, context_mixing.ORDERS + 1)], place, before[-1]

    def symbols(text):
        return [context_mixing.END] * context_mixing.ORDERS + list((text or "").encode()) + [context_mixing.END]

    counts = Counter()
    for i, text in rows:
        if learn(i):
            s = symbols(text)
            for at in range(context_mixing.ORDERS, len(s)):
                for c in contexts(s, at)[0]:
                    counts.update((c, node, bit) for node, bit in steps(s[at]))
    for i, text in rows:
        total, s = 0.0, symbols(text)
        for at in range(context_mixing.ORDERS, len(s)):
            found, place, last = contexts(s, at)
            for depth, (node, bit) in enumerate(steps(s[at])):
                n = [(counts[c, node, 0], counts[c, node, 1]) for c in found]
                known, depth = sum(a + b > 0 for a, b in n), min(depth, context_mixing.DEPTHS - 1)
                gates = [known * context_mixing.DEPTHS + depth, place * (context_mixing.ORDERS + 1) + known, last]
                weights = sum(w[g] for w, g in zip(model.weights, gates))
                x = sum(w * math.log((b + context_mixing.HALF) / (a + context_mixing.HALF)) for w, (a, b) in zip(weights, n))
                x = min(max(x, -16), 16)
                p = 1 / (1 + math.exp(-x))
                level = min(max((x + 8) * (context_mixing.LEVELS - 1) / 16, 0), context_mixing.LEVELS - 1.001)
                spot, share = int(level), level - int(level)
                ends = [(b + 4 * p) / (a + b + 4) for a, b in model.refine[gates[0], spot : spot + 2]]
                p = min(max((p + ends[0] * (1 - share) + ends[1] * share) / 2, 1e-7), 1 - 1e-7)
                total += math.log10(p if bit else 1 - p)
        yield i, total


def test_scores_equal_plain_counting(spark, documents, monkeypatch):
    rows = [(i, prose(i, 12)) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "The THE the\t\tÉ é 語"), (53, "x" * 60 + " " + "X" * 30 + " xx"), (54, "unterwegs Unterwegs unterwegt")]
    learn = lambda i: i % 3 > 0
    docs = documents(rows)
    model, _ = context_mixing.window_scores(docs.withColumn("learn", F.col("doc_id") % 3 > 0))
    expected = dict(plain_scores(rows, learn, model))
    for common in (0, 50, 1 << 21):  # looked up by the join, by both ways, in place
        monkeypatch.setattr(context_mixing, "COMMON_WINDOWS", common)
        for r in context_mixing.score(docs, F.col("doc_id") % 3 > 0).collect():
            assert math.isclose(r.score, expected[r.doc_id], rel_tol=1e-4)


def test_scores_do_not_depend_on_partitions(spark, documents, monkeypatch):
    monkeypatch.setattr(context_mixing, "GROUP", 200)
    docs = documents([(i, prose(i)) for i in range(60)])
    one, many = ({r.doc_id: r.score for r in context_mixing.score(d, F.col("doc_id") % 2 > 0).collect()} for d in (docs.coalesce(1), docs.repartition(11)))
    assert one.keys() == many.keys() and all(math.isclose(one[i], many[i], rel_tol=1e-9) for i in one)


def test_windows_do_not_depend_on_blocks(monkeypatch):
    texts = ["abc", None, "", prose(1, 300)]
    whole = np.concatenate([w for w, _ in context_mixing.blocks(texts)])
    monkeypatch.setattr(context_mixing, "BLOCK", 50)
    assert np.array_equal(np.concatenate([w for w, _ in context_mixing.blocks(texts)]), whole)


def test_base_score_is_exact(spark, documents, monkeypatch):
    monkeypatch.setattr(context_mixing, "COMMON", 20)  # so that most tokens are joined
    rows = [(i, prose(i, 20)) for i in range(60)] + [(61, None), (62, ""), (63, "The THE the É é"), (None, "on"), (64, "on on"), (64, "on on")]
    found = context_mixing.score(documents(rows), ~held_out(5, 1)).collect()
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    c = Counter(x for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1 for x in tokens(t))
    n, v = sum(c.values()), len(c)
    assert len(found) == len(rows)  # repeated rows each
    for r in found:
        mine = tokens(dict(rows)[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(mine), sum(c[x] > 0 for x in mine), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in mine), rel_tol=1e-9)
        assert r.score < 0
    assert context_mixing.score(documents([]).limit(0), F.lit(True)).count() == 0


def test_classifier_gives_back_what_packing_kept(spark):
    """Texts stay in Arrow, and a worker's token cache does not outlast the packing."""
    from daymatrix.llm import quality_rff, text

    kept = []
    text.kept("a", lambda: kept.append(1) or {})
    text.kept("a", lambda: kept.append(2) or {})
    assert kept == [1] and list(text._KEPT) == ["a"]
    column = quality_rff.statistics_column
    rows = spark.createDataFrame([(1, "Two words."), (2, None), (3, "é " * 9000)], "i int, text string")
    found = {r.i: r.s for r in rows.select("i", column(F.col("text")).alias("s")).collect()}
    for i, t in ((1, "Two words."), (2, None), (3, "é " * 9000)):
        assert found[i] == pytest.approx(quality_rff.statistics(t))
    quality_rff.keep_nothing()
    assert not text._KEPT


def test_marked_windows_are_counted_like_places():
    windows = np.array([5, 3, 5, 5, (1 << 54) - 1, 0, 3])
    learn = np.array([True, False, False, True, True, False, False])
    one = np.ones(len(windows), dtype=np.int64)
    plain = context_mixing._merged([[windows, one, learn.astype(np.int64)]])
    for a, b in zip(context_mixing._distinct(windows, learn), plain):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
