import hashlib
import zlib

import pytest

from daymatrix.llm import merkle


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def plain_leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_paths(leaves):
    """Top of a tree and, for every leaf, the runs of siblings on its way up."""
    paths, level = [[] for _ in leaves], list(leaves)
    owners = [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, held = [], []
        for i in range(0, len(level), 16):
            run = level[i : i + 16]
            for k in range(len(run)):
                for leaf in owners[i + k]:
                    paths[leaf].append((run[:k], run[k + 1 :]))
            above.append(digest(*run))
            held.append([x for o in owners[i : i + 16] for x in o])
        level, owners = above, held
    return level[0] if level else None, paths


def plain(rows):
    """The contract, one document after the other."""
    trees = {}
    for row in rows:
        trees.setdefault(row["source"], []).append((row, plain_leaf(row, row["text"])))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    tops = {}
    for name in names:
        trees[name].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        tops[name] = plain_paths([leaf for _, leaf in trees[name]])
    root, above = plain_paths([tops[name][0] for name in names])
    out = []
    for name, up in zip(names, above):
        for (row, leaf), low in zip(trees[name], tops[name][1]):
            cut = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
            text = row["text"]
            if cut and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = plain_leaf(row, text)
            for left, right in [*low, *up]:
                now = digest(*left, now, *right)
            proof = digest(*(x for left, right in [*low, *up] for x in [*left, *right]))
            out.append((row["doc_id"], leaf, tops[name][0], root, proof, now, now == root))
    return out


FIELDS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, rows):
    df = spark.createDataFrame([tuple(r[k] for k in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], FIELDS)
    for name in ("tree", "size", "index", "digest", "position", "Block", "row", "part"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def document(i, text, source, lang="en"):
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": None if text is None else len(text)}


def key(row):
    return tuple((x is not None, str(x)) for x in row)


def test_positions_are_postorder():
    for size in (1, 2, 15, 16, 17, 255, 256, 257, 300, 4096, 4097, 4400):
        order = []

        def visit(level, index):
            if level:
                below = -(-size // 16 ** (level - 1))
                for child in range(index * 16, min(index * 16 + 16, below)):
                    visit(level - 1, child)
            order.append((level, index))

        visit(merkle.height(size), 0)
        for level in range(merkle.height(size) + 1):
            nodes = [(at, i) for at, (lv, i) in enumerate(order) if lv == level]
            found = merkle.position(level, [i for _, i in nodes], size)
            assert found.tolist() == [at for at, _ in nodes]


def test_proofs_equal_plain_version(spark):
    rows = [document(i, f"Text {i} of A source", "a") for i in range(4500)]  # more than one block
    rows += [document(i, "Ünïcode" * (i % 3), "b", None) for i in range(5000, 5017)]
    rows += [document(7000, None, None), document(7001, "", None, "é")]
    rows += [document(None, "no id", "c"), document(None, None, "c"), document(2**60 + 1, "Large", "c")]
    rows += [document(8000, "Twice", "é")] * 3 + [document(8000, "other", "é")]  # ties and repeated rows
    rows += [document(9000 + k, f"own {k}", f"s{k:03}") for k in range(20)]  # more sources than one run
    rows += [document(9500, "Very long " * 50_000, "z")]
    found = [tuple(r) for r in merkle.build(table(spark, rows)).proofs().collect()]
    assert sorted(found, key=key) == sorted(plain(rows), key=key)
    assert {r[-1] for r in found} == {True, False}


def test_log_is_read_in_order_of_completion(spark):
    rows = [document(i, f"t{i}", "a") for i in range(300)] + [document(1000, "x", "b")]
    manifest = merkle.build(table(spark, rows))
    log = sorted(manifest.log().where("tree = '1a'").collect(), key=lambda r: r["position"])
    assert [r["position"] for r in log] == list(range(300 + 19 + 2 + 1))
    assert log[16]["level"] == 1 and log[16]["digest"] == digest(*(r["digest"] for r in log[:16]))
    assert log[-1]["digest"] == plain_paths([plain_leaf(r, r["text"]) for r in rows[:300]])[0]
    assert manifest.root().first()["root"] == plain(rows)[0][3]


@pytest.mark.parametrize("rows", [[], [document(5, "One", "a")], [document(None, None, None, None)]])
def test_smallest_tables(spark, rows):
    manifest = merkle.build(table(spark, rows))
    found = [tuple(r) for r in manifest.proofs().collect()]
    assert found == plain(rows)
    assert manifest.root().count() == min(1, len(rows))
