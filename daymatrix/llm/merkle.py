"""A Merkle manifest of a dataset, kept as a postorder append log.

Every document is a leaf.  The leaves of a source, in order of their ids, are the lowest
level of its tree; every ``ARITY`` consecutive nodes become one node of the next level
until one is left, the subroot.  The subroots, in order of the sources, are the leaves of
one more tree, whose top is the root.

A tree's nodes form a log in the order in which they are completed, reading leaves from
the left (postorder).  Where a node stands follows in closed form from the sizes of the
subtrees before it (:func:`position`), so aligned builders, each given the leaves of one
aligned subtree of ``DEPTH`` levels, write their part of the log without knowing the
others', and a proof addresses the siblings it needs by their positions.  Builders run in
rounds: the tops of one round's subtrees are the leaves of the next, 4,096 times fewer.
Proofs go the other way: each round hands the blocks below the part of the path that all
their leaves share.  No task holds more than one such block of a tree at once, and a
source that owns most documents is as many blocks as it needs.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.text import crc_sql
from daymatrix.session import materialize

ARITY = 16
DEPTH = 3  # levels that a builder adds to those it is given
BLOCK = ARITY**DEPTH  # nodes that a builder is given at most
#: What a leaf's digest covers, in this order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: A document is altered, for the check of its proof, where this divides its id's CRC-32.
TAMPER_MODULUS = 5

LOG = "tree string, size bigint, level int, index bigint, position bigint, digest string"
PATH = "tree string, block bigint, subroot string, root string, `left` array<string>, `right` array<string>"


def height(size: int) -> int:
    """Levels above the leaves of a tree of so many leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


def position(level: np.ndarray | int, index: np.ndarray | int, size: int) -> np.ndarray:
    """Place in the log of the nodes at ``index`` of a level in a tree of ``size`` leaves.

    A node is completed by its last leaf: before it stand all nodes of its own and lower
    levels that end there or earlier, and those of higher levels that end earlier.
    """
    level, index = np.asarray(level, dtype=np.int64), np.asarray(index, dtype=np.int64)
    end = np.minimum((index + 1) * ARITY**level, size)
    place = np.full(np.broadcast(level, end).shape, -1, dtype=np.int64)
    for j in range(height(size) + 1):
        width = ARITY**j
        place = place + np.where(j <= level, -(-end // width), (end - 1) // width)
    return place


def node(children: list[str]) -> str:
    """Digest of a node: of its children's, concatenated as hexadecimal text."""
    return hashlib.sha256("".join(children).encode()).hexdigest()


def leaf(text: Column) -> Column:
    """Digest of a document's fields, with ``text`` in place of the column of that name."""

    def piece(name: str) -> Column:
        value = text if name == "text" else F.col(name).cast("string")
        framed = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        return F.when(value.isNull(), F.lit("-")).otherwise(framed)

    return F.sha2(F.concat(*(piece(name) for name in FIELDS)), 256)


def tampered(text: Column) -> Column:
    """A text with A-Z lower-cased."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_tampered() -> Column:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_MODULUS
    return F.coalesce(fold == 0, F.lit(False))


def _ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``index``, the place of each among those of its ``tree`` (a non-null
    text), and ``size``, how many those are.

    Rows are dealt by ranges of (tree, order) and numbered within a range; how many of a
    tree lie in earlier ranges is added.  A tree's rows are thus never one task's.
    """
    sorted_ = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = materialize(sorted_.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    counts = placed.groupBy("tree", part.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # One row per tree and range here, however many leaves a tree has.
    starts = counts.selectExpr(
        "tree", "part", "first",
        "sum(n) OVER (PARTITION BY tree ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS start",
        "sum(n) OVER (PARTITION BY tree) AS size",
    )
    return (
        placed.withColumn("part", part)
        .join(starts, ["tree", "part"])
        .withColumn("index", F.col("start") + F.col("at") - F.col("first"))
        .drop("part", "first", "start", "at")
    )


def _build(first_level: int):
    """A builder: the aligned subtree above one block of nodes of ``first_level``, written
    in the order of completion."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("index")
        tree, size, begin = rows["tree"].iloc[0], int(rows["size"].iloc[0]), int(rows["index"].iloc[0])
        level, top, held = first_level, height(size), rows["digest"].tolist()
        out = [(level, begin + k, d) for k, d in enumerate(held)] if level == 0 else []
        while level < min(first_level + DEPTH, top):
            held = [node(held[i : i + ARITY]) for i in range(0, len(held), ARITY)]
            level, begin = level + 1, begin // ARITY
            out += [(level, begin + k, d) for k, d in enumerate(held)]
        log = pd.DataFrame(out, columns=["level", "index", "digest"])
        log["position"] = position(log["level"].to_numpy(), log["index"].to_numpy(), size)
        log["tree"], log["size"] = tree, size
        return log.sort_values("position")[["tree", "size", "level", "index", "position", "digest"]]

    return build


def append_log(leaves: DataFrame) -> list[DataFrame]:
    """The log of every tree, a table of its new nodes per round; ``leaves`` holds tree,
    size, index and digest.

    The tables together hold tree, size, level, index, position and digest of every node;
    read in the order of positions, a tree's rows are its append log.
    """
    rounds, nodes, level = [], leaves.select("tree", "size", "index", "digest"), 0
    while True:
        blocks = nodes.withColumn("block", F.floor(F.col("index") / BLOCK)).groupBy("tree", "block")
        log = materialize(blocks.applyInPandas(_build(level), LOG), "log")
        rounds.append(log)
        level += DEPTH
        nodes = log.where((F.col("level") == level) & (F.col("size") > ARITY**level)).select("tree", "size", "index", "digest")
        if nodes.isEmpty():
            return rounds


def _height(size: Column) -> Column:
    """Levels above the leaves of a tree of so many leaves."""
    return reduce(Column.__add__, [(size > ARITY**j).cast("int") for j in range(16)])


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """(tree, size, digest) of the last node of every log."""
    every = reduce(DataFrame.unionByName, rounds)
    return every.where(F.col("level") == _height(F.col("size"))).select("tree", "size", "digest")


@dataclass(frozen=True)
class _Siblings:
    """The log of one block of a round, addressed by positions."""

    level: int
    size: int
    places: np.ndarray
    digests: np.ndarray

    def around(self, index: int) -> tuple[list[str], list[str]]:
        """Of the path above a node of the round's lowest level: what stands left and
        right of it in each run, as concatenated digests."""
        left, right, count = [], [], -(-self.size // ARITY**self.level)
        for level in range(self.level, min(self.level + DEPTH, height(self.size))):
            begin = index // ARITY * ARITY
            run = np.arange(begin, min(begin + ARITY, count))
            found = self.digests[np.searchsorted(self.places, position(level, run, self.size))]
            left.append("".join(found[: index - begin]))
            right.append("".join(found[index - begin + 1 :]))
            index, count = index // ARITY, -(-count // ARITY)
        return left, right


def _siblings(level: int, log: pd.DataFrame) -> tuple[_Siblings, pd.Series]:
    """The block's log and its path: the rows of ``log`` with and without a position."""
    nodes = log[log["position"].notna()].sort_values("position")
    known = _Siblings(
        level, int(nodes["size"].iloc[0]), nodes["position"].to_numpy().astype(np.int64), nodes["digest"].to_numpy()
    )
    return known, log[log["position"].isna()].iloc[0]


def _extend(level: int):
    """Paths of the blocks below: a node's own siblings, then the path of its block."""

    def extend(nodes: pd.DataFrame, log: pd.DataFrame) -> pd.DataFrame:
        known, path = _siblings(level, log)
        rows = []
        for index in nodes["index"]:
            left, right = known.around(int(index))
            rows.append((path["tree"], index, path["subroot"], path["root"], [*left, *path["left"]], [*right, *path["right"]]))
        return pd.DataFrame(rows, columns=["tree", "block", "subroot", "root", "left", "right"])

    return extend


def fold(digest: str, left: list[str], right: list[str]) -> str:
    """The root that follows from a leaf and its siblings."""
    for before, after in zip(left, right):
        digest = hashlib.sha256(f"{before}{digest}{after}".encode()).hexdigest()
    return digest


PROOF = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(docs: pd.DataFrame, log: pd.DataFrame) -> pd.DataFrame:
    """Digest of every document's proof, and the root it leads to from what is found."""
    known, path = _siblings(0, log)
    rows = []
    for digest, found, index in zip(docs["digest"], docs["found"], docs["index"]):
        left, right = known.around(int(index))
        left, right = [*left, *path["left"]], [*right, *path["right"]]
        proof = hashlib.sha256("".join(x for pair in zip(left, right) for x in pair).encode()).hexdigest()
        folded = fold(found, left, right)
        rows.append((digest, path["subroot"], path["root"], proof, folded, folded == path["root"]))
    out = pd.DataFrame(rows, columns=["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    # Ids stay integers beside null ones.
    out.insert(0, "doc_id", docs["id"].astype("Int64").where(docs["has_id"]).reset_index(drop=True))
    return out


def _with_paths(log: DataFrame, paths: DataFrame, level: int) -> DataFrame:
    """Per block, the log rows that its proofs need and the path above it."""
    needed = log.where(F.col("level").between(level, level + DEPTH - 1))
    if level:  # lower trees end before this round
        needed = needed.where(_height(F.col("size")) > level)
    above = F.pow(F.lit(float(ARITY)), F.lit(level + DEPTH) - F.col("level"))
    needed = needed.select("tree", F.floor(F.col("index") / above).alias("block"), "size", "position", "digest")
    return needed.unionByName(paths, allowMissingColumns=True)


def _paths_down(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Rows of ``PATH`` for the blocks of leaves; ``tops`` holds, for every tree, its size
    and the path above it."""
    tops, paths = tops.withColumn("height", _height(F.col("size"))), None
    for r in reversed(range(len(rounds))):
        level = r * DEPTH
        # Trees whose top is built in this round start here.
        begin = tops.where(F.col("height").between(level + 1 if r else 0, level + DEPTH)).select(
            "tree", F.lit(0).cast("bigint").alias("block"), "subroot", "root", "left", "right"
        )
        paths = begin if paths is None else paths.unionByName(begin)
        if r:
            log = rounds[r - 1].unionByName(rounds[r])
            nodes = log.where((F.col("level") == level) & (_height(F.col("size")) > level))
            paths = materialize(_extended(nodes, _with_paths(log, paths, level), level), "paths")
    return paths


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("index") / BLOCK))


def _extended(nodes: DataFrame, known: DataFrame, level: int) -> DataFrame:
    """The paths above ``nodes`` (tree, index) of a round's lowest level."""
    blocks = _in_blocks(nodes.select("tree", "index")).groupBy("tree", "block")
    return blocks.cogroup(known.groupBy("tree", "block")).applyInPandas(_extend(level), PATH)


@dataclass(frozen=True)
class Manifest:
    """The logs of all sources' trees, by rounds, and of the tree above them.

    ``leaves``: doc_id, tree, size, index, digest, found, one row per document;
    ``subroots``: name (of the source's tree), leaves, digest, and tree, size, index in
    the tree above.
    """

    leaves: DataFrame
    subroots: DataFrame
    sources: list[DataFrame]
    above: list[DataFrame]

    def log(self) -> DataFrame:
        """All nodes: tree ('' for the one above the sources, '0' for the null source,
        '1' and the source for others), size, level, index, position, digest."""
        return reduce(DataFrame.unionByName, [*self.sources, *self.above])

    def root(self) -> DataFrame:
        """The root, one row of one column, or no row without documents."""
        return _tops(self.above).select(F.col("digest").alias("root"))

    def proofs(self) -> DataFrame:
        """One row per document: doc_id, leaf, subroot, root, proof_sha256 (of all siblings
        in order), folded_root (from the leaf as found, up the proof) and verified."""
        none = F.array().cast("array<string>")
        digest = F.col("digest")
        start = _tops(self.above).select(
            "tree", "size", digest.alias("subroot"), digest.alias("root"), none.alias("left"), none.alias("right")
        )
        known = _with_paths(self.above[0], _paths_down(self.above, start), 0)
        paths = _extended(self.subroots, known, 0).select(F.col("block").alias("index"), "root", "left", "right")
        named = self.subroots.select("name", "leaves", "digest", "index").join(paths, "index")
        tops = named.select(
            F.col("name").alias("tree"), F.col("leaves").alias("size"), digest.alias("subroot"), "root", "left", "right"
        )
        known = _with_paths(self.sources[0], _paths_down(self.sources, materialize(tops, "tops")), 0)
        docs = _in_blocks(self.leaves).select(
            "tree", "block", "index", "digest", "found",
            F.col("doc_id").isNotNull().alias("has_id"), F.coalesce("doc_id", F.lit(0)).alias("id"),
        )
        return docs.groupBy("tree", "block").cogroup(known.groupBy("tree", "block")).applyInPandas(_prove, PROOF)


def build(docs: DataFrame) -> Manifest:
    """The manifest of documents (doc_id, source, lang, n_chars, text).

    Any of them may be null; null ids come first, and the null source is a tree of its own,
    the first.  Rows that repeat an id are leaves each, in the order of their digests.
    Empty texts are not null ones.  An empty table gives an empty log and no root.  Other
    columns are ignored.
    """
    tree = F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("0"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), tree.alias("tree"), leaf(F.col("text")).alias("digest"),
        F.when(is_tampered(), leaf(tampered(F.col("text")))).alias("changed"),
        # Equal leaves are told apart only to spread them over ranges.
        F.monotonically_increasing_id().alias("row"),
    )
    ranked = materialize(_ranked(materialize(rows, "leaves"), ["doc_id", "digest", "row"], "ranges"), "ranked")
    leaves = ranked.select("doc_id", "tree", "size", "index", "digest", F.coalesce("changed", "digest").alias("found"))
    sources = append_log(leaves)
    tops = _tops(sources).select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("size").alias("leaves"), "digest"
    )
    subroots = materialize(_ranked(tops, ["name"], "tops"), "subroots")
    return Manifest(leaves, subroots, sources, append_log(subroots))


def _oracle(levels: int = 7, levels_above: int = 4) -> str:
    """The contract in SQL: both trees level by level, for up to 16**levels documents of a
    source and 16**levels_above sources."""
    piece = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR)) || ':' || {0} END"

    def digest(text: str) -> str:
        return f"sha256({' || '.join(piece.format(text if name == 'text' else name) for name in FIELDS)})"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"""rows AS (SELECT doc_id, coalesce('1' || source, '0') AS tree, {digest('text')} AS leaf,
            CASE WHEN {crc_sql('doc_id::VARCHAR')} % {TAMPER_MODULUS} = 0 THEN {digest(low)} END AS changed FROM documents)""",
        """doc_0 AS (SELECT doc_id, tree, leaf, coalesce(changed, leaf) AS folded, '' AS proof,
            row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM rows)""",
        "low_0 AS (SELECT tree, place, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM doc_0)",
    ]
    parts += _levels("low", "doc", levels)
    parts += [
        f"subroots AS (SELECT tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS place FROM low_{levels})",
        "top_0 AS (SELECT '' AS tree, place, digest, count(*) OVER () AS n FROM subroots)",
        f"""up_0 AS (SELECT d.doc_id, d.leaf, s.digest AS subroot, '' AS tree, d.folded, d.proof, s.place
            FROM doc_{levels} d JOIN subroots s ON s.name = d.tree)""",
    ]
    parts += _levels("top", "up", levels_above)
    return f"""WITH {', '.join(parts)}
SELECT u.doc_id, u.leaf, u.subroot, t.digest AS root, sha256(u.proof) AS proof_sha256, u.folded AS folded_root,
    u.folded = t.digest AS verified
FROM up_{levels_above} u CROSS JOIN top_{levels_above} t"""


def _levels(nodes: str, found: str, levels: int) -> list[str]:
    """Tables of the nodes of each level and of what is folded so far; a tree that has one
    node left stays as it is."""
    out = []
    for j in range(levels):
        out += [
            f"""{nodes}_run_{j} AS (SELECT tree, place // {ARITY} AS run, list(digest ORDER BY place) AS held
                FROM {nodes}_{j} WHERE n > 1 GROUP BY ALL)""",
            f"""{nodes}_{j + 1} AS (
                SELECT tree, run AS place, sha256(array_to_string(held, '')) AS digest, count(*) OVER (PARTITION BY tree) AS n
                FROM {nodes}_run_{j} UNION ALL SELECT tree, place, digest, n FROM {nodes}_{j} WHERE n = 1)""",
            f"""{found}_{j + 1} AS (
                SELECT f.* REPLACE (
                    CASE WHEN held IS NULL THEN folded ELSE sha256(array_to_string(held[1:f.place % {ARITY}], '') || folded
                        || array_to_string(held[f.place % {ARITY} + 2:], '')) END AS folded,
                    CASE WHEN held IS NULL THEN proof ELSE proof || array_to_string(held[1:f.place % {ARITY}], '')
                        || array_to_string(held[f.place % {ARITY} + 2:], '') END AS proof,
                    f.place // {ARITY} AS place)
                FROM {found}_{j} f LEFT JOIN {nodes}_run_{j} r ON r.tree = f.tree AND r.run = f.place // {ARITY})""",
        ]
    return out


ORACLE_SQL = _oracle()
