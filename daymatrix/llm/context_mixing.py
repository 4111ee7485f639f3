"""Language-model scores by logistic context mixing over bits.

A text is a sequence of bytes and one end.  Every byte is a path of yes/no decisions
in a code tree made from the corpus' byte counts.  For each decision, predictors look up
how often either way was taken after the same last 1 to 5 bytes, by a hash of context and
decision.  Their log odds are added with weights picked by gates (how many predictors
know the context and how deep the decision is; the place in the word; the last byte), and
a table that maps the mixed odds to what really happened refines the result.

What the predictors know comes from all training texts and grows with them.  A *window*
is a byte and the five before it; a prediction depends on its window only.  Spark counts
all windows into a written table.  They are dealt by the three bytes before the symbol, so that all windows of a context of
three or more bytes lie in one group and its counts are exact; counts of one and two bytes
have at most 2^26 entries and are sent to every task.

The weights follow online gradient steps through every group in a defined order, a
window being predicted without its own occurrence, as by a predictor that has not seen it
yet; groups start from the same weights and are averaged by what they saw.  Groups and
order follow from the windows alone, so scores do not depend on partitions.

A window's probability is computed once for the whole corpus.  Texts look up the
``COMMON_WINDOWS`` most frequent windows where they are read and all others by a join with
the written table.  The unigram base score is exact, in the same way: the counts of the
``COMMON`` most frequent tokens are looked up in place, those of all others by a join.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.text import words
from daymatrix.session import materialize

END = 256
ORDERS = 5
NEAR = 2  # orders whose counts every task has
SYMBOL_BITS = 9
SYMBOL = (1 << SYMBOL_BITS) - 1
NODE_BITS = 8
BLOCK = 1 << 20  # symbols handled at once
GROUP = 250_000  # windows dealt to one group, on average
STEP = 4096  # windows of one gradient step
DEPTHS = 8
KNOWN_GATES = (ORDERS + 1) * DEPTHS
PLACE_GATES = (ORDERS + 1) * (ORDERS + 1)
LEVELS = 33  # of the refining table
HALF = 0.4  # added to both counts of a context
RATE = 0.05
EPOCHS = 2
SUMS = 64  # rows that reach the driver of what the groups learnt
COMMON = 50_000
COMMON_WINDOWS = 1 << 21
NO_TOKEN = b""  # the end; no word is empty

_FACTOR = 0x9E3779B97F4A7C15
_SPACES = np.isin(np.arange(END + 1), [9, 10, 11, 12, 13, 32, END])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits, one to one."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Tree:
    """Code tree: the decisions of every symbol, one after the other."""

    start: np.ndarray
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray


def code_tree(counts: np.ndarray) -> Tree:
    """Huffman's tree of the symbols 0 to 256; unseen symbols count half."""
    heap: list[tuple[float, int, object]] = [(max(float(c), 0.5), i, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a[0] + b[0], number, (number - len(counts), a[2], b[2])))
        number += 1
    paths: dict[int, list[tuple[int, int]]] = {}
    todo = [(heap[0][2], [])]
    while todo:
        tree, path = todo.pop()
        if isinstance(tree, int):
            paths[tree] = path
        else:
            todo += [(tree[1], [*path, (tree[0], 0)]), (tree[2], [*path, (tree[0], 1)])]
    ordered = [paths[i] for i in range(len(counts))]
    length = np.array([len(p) for p in ordered])
    flat = [x for p in ordered for x in p]
    return Tree(np.cumsum(length) - length, length, np.array([x[0] for x in flat]), np.array([x[1] for x in flat]))


def blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of successive texts, in blocks, and the text of each window.

    A window's number holds a symbol (lowest bits) and the five before it; before a text
    there are ends.  Long texts are cut into blocks without losing a window.
    """
    parts, owners, size = [], [], 0
    for i, text in enumerate(texts):
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        whole = np.concatenate([np.full(ORDERS, END, dtype=np.int64), raw, [END]])
        for at in range(0, len(raw) + 1, BLOCK):
            part = whole[at : at + BLOCK + ORDERS]
            parts.append(_windows(part))
            owners.append(np.full(len(part) - ORDERS, i, dtype=np.int32))
            size += len(part)
            if size >= BLOCK:
                yield np.concatenate(parts), np.concatenate(owners)
                parts, owners, size = [], [], 0
    if parts:
        yield np.concatenate(parts), np.concatenate(owners)


def _windows(symbols: np.ndarray) -> np.ndarray:
    out = symbols[ORDERS:].copy()
    for j in range(1, ORDERS + 1):
        out |= symbols[ORDERS - j : len(symbols) - j] << (SYMBOL_BITS * j)
    return out


@dataclass(frozen=True)
class Events:
    """The decisions of some windows: window, node, its depth, bit, last byte, place."""

    row: np.ndarray
    node: np.ndarray
    depth: np.ndarray
    bit: np.ndarray
    last: np.ndarray
    place: np.ndarray


def events(windows: np.ndarray, tree: Tree) -> Events:
    symbol = windows & SYMBOL
    many = tree.length[symbol]
    row = np.repeat(np.arange(len(windows)), many)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    at = tree.start[symbol][row] + depth
    place = np.full(len(windows), ORDERS)
    for k in range(ORDERS, 0, -1):
        place[_SPACES[np.minimum(windows >> SYMBOL_BITS * k & SYMBOL, END)]] = k - 1
    last = (windows >> SYMBOL_BITS & SYMBOL)[row]
    return Events(row, tree.node[at], np.minimum(depth, DEPTHS - 1), tree.bit[at], last, place[row])


def _spots(windows: np.ndarray, e: Events, order: int) -> np.ndarray:
    """Number of a context of few bytes and a node."""
    context = windows >> SYMBOL_BITS & (1 << SYMBOL_BITS * order) - 1
    return (context[e.row] << NODE_BITS) | e.node


def _weights_of(spots: np.ndarray, bit: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct spots and how often either way was taken there; and each spot's place."""
    distinct, where = np.unique(spots, return_inverse=True)
    both = np.bincount(where * 2 + bit, weights=n, minlength=2 * len(distinct)).reshape(-1, 2)
    return distinct, both.astype(np.float32), where


@dataclass
class Model:
    """Code tree, counts after one and two bytes, and mixer."""

    tree: Tree
    near: list[tuple[np.ndarray, np.ndarray]]
    weights: list[np.ndarray] = field(default_factory=lambda: [
        np.full((KNOWN_GATES, ORDERS), 0.2), np.zeros((PLACE_GATES, ORDERS)), np.zeros((1 << SYMBOL_BITS, ORDERS))
    ])
    refine: np.ndarray = field(default_factory=lambda: np.zeros((KNOWN_GATES, LEVELS, 2)))

    def counts(self, windows: np.ndarray, n: np.ndarray, e: Events) -> np.ndarray:
        """How often either way was taken after every context; predictors x events x 2.

        The windows hold all those of their contexts of more than two bytes.
        """
        out = np.zeros((ORDERS, len(e.row), 2), dtype=np.float32)
        m = n[e.row]
        for order in range(1, ORDERS + 1):
            if order <= NEAR:
                spots, both = self.near[order - 1]
                if len(spots):
                    asked = _spots(windows, e, order)
                    at = np.minimum(np.searchsorted(spots, asked), len(spots) - 1)
                    out[order - 1] = np.where((spots[at] == asked)[:, None], both[at], 0)
            else:
                context = _mixed(windows >> SYMBOL_BITS & (1 << SYMBOL_BITS * order) - 1)
                out[order - 1] = self._around(context, e, m)
        return out

    @staticmethod
    def _around(context: np.ndarray, e: Events, m: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            spots = _mixed(context[e.row] + e.node.astype(np.uint64) * np.uint64(_FACTOR))
        _, both, where = _weights_of(spots, e.bit, m)
        return both[where]

    @staticmethod
    def inputs(counts: np.ndarray, e: Events, seen: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Log odds of every predictor, and the gates.  ``seen`` windows are predicted
        without one occurrence of theirs."""
        n0 = np.maximum(counts[:, :, 0] - (seen[e.row] & (e.bit == 0)), 0)
        n1 = np.maximum(counts[:, :, 1] - (seen[e.row] & (e.bit == 1)), 0)
        known = (n0 + n1 > 0).sum(axis=0)
        return np.log((n1 + HALF) / (n0 + HALF)), [known * DEPTHS + e.depth, e.place * (ORDERS + 1) + known, e.last]

    def mix(self, odds: np.ndarray, gates: list[np.ndarray]) -> np.ndarray:
        weights = sum(w[g] for w, g in zip(self.weights, gates))
        return np.clip((weights * odds.T).sum(axis=1), -16, 16)

    def log2(self, odds: np.ndarray, gates: list[np.ndarray], e: Events, many: int) -> np.ndarray:
        """log2 of the probability of each window's symbol."""
        x = self.mix(odds, gates)
        p = 1 / (1 + np.exp(-x))
        spot, share = _level(x)
        seen = self.refine[gates[0], spot], self.refine[gates[0], spot + 1]
        # Where little was seen the mixed value stands.
        ends = [(s[:, 1] + 4 * p) / (s.sum(axis=1) + 4) for s in seen]
        p = (p + ends[0] * (1 - share) + ends[1] * share) / 2
        p = np.clip(p, 1e-7, 1 - 1e-7)
        return np.bincount(e.row, weights=np.log2(np.where(e.bit == 1, p, 1 - p)), minlength=many)


def _level(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of log odds in the refining table and how far it is to the next."""
    at = np.clip((x + 8) * ((LEVELS - 1) / 16), 0, LEVELS - 1.001)
    spot = at.astype(np.int64)
    return spot, at - spot


def window_counts(docs: DataFrame) -> DataFrame:
    """(window, m, n): how often every window occurs in all texts and in those with
    ``learn``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            learn = batch["learn"].to_numpy(dtype=bool)
            for windows, owner in blocks(batch["text"].tolist()):
                held.append(_distinct(windows, learn[owner]))
                if sum(len(x[0]) for x in held[1:]) > max(BLOCK, len(held[0][0])):
                    held = [_merged(held)]
                if len(held[0][0]) > 2 * BLOCK:
                    yield _counted(held.pop(0))
        if held:
            yield _counted(_merged(held))

    found = docs.select("text", "learn").mapInPandas(count, "window bigint, m bigint, n bigint")
    return found.groupBy("window").agg(F.sum("m").alias("m"), F.sum("n").alias("n"))


def _distinct(windows: np.ndarray, learn: np.ndarray) -> list[np.ndarray]:
    """Distinct windows, how often each occurs, and how often with ``learn``.  Sorting numbers
    that hold the mark takes a quarter of the time of sorting places."""
    marked = np.sort(windows << 1 | learn)
    windows = marked >> 1
    cuts = np.flatnonzero(np.concatenate([[True], windows[1:] != windows[:-1]]))
    return [windows[cuts], np.diff(cuts, append=len(windows)), np.add.reduceat(marked & 1, cuts)]


def _merged(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Distinct windows of some columns (window, counts), their counts summed."""
    windows, *counts = [np.concatenate(column) for column in zip(*parts)]
    order = np.argsort(windows)
    windows = windows[order]
    cuts = np.flatnonzero(np.concatenate([[True], windows[1:] != windows[:-1]]))
    return [windows[cuts], *(np.add.reduceat(x[order], cuts) for x in counts)]


def _counted(columns: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(("window", "m", "n"), columns)))


def _near_counts(table: DataFrame) -> tuple[Tree, list[tuple[np.ndarray, np.ndarray]]]:
    """Code tree and counts after one and two bytes; at most 257^3 rows reach the driver."""
    short = F.col("window").bitwiseAND(F.lit((1 << SYMBOL_BITS * (NEAR + 1)) - 1)).alias("short")
    rows = table.where("n > 0").groupBy(short).agg(F.sum("n").alias("n")).toArrow()
    short, n = rows["short"].to_numpy(), rows["n"].to_numpy().astype(float)
    tree = code_tree(np.bincount(short & SYMBOL, weights=n, minlength=END + 1)[: END + 1])
    e = events(short, tree)
    return tree, [_weights_of(_spots(short, e, order), e.bit, n[e.row])[:2] for order in range(1, NEAR + 1)]


def _each_group(table: DataFrame, groups: int, schema: str, work: Callable[[int, pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """``work`` on all windows of a group, in an order of theirs."""

    def whole(key: tuple[int], some: pd.DataFrame) -> pd.DataFrame:
        return work(key[0], some.iloc[np.argsort(_mixed(some["window"].to_numpy()))])

    context = F.shiftright("window", SYMBOL_BITS).bitwiseAND(F.lit((1 << 3 * SYMBOL_BITS) - 1))
    dealt = table.withColumn("bucket", F.pmod(F.xxhash64(context), F.lit(groups)).cast("int"))
    return dealt.groupBy("bucket").applyInPandas(lambda key, some: whole(key, some), schema)


LEARNT = "bucket int, sums binary"


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """Sum of what the groups send, always in the same order."""

    def add(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("bucket")
        total = np.zeros(size)
        for sums in some["sums"]:
            total += np.frombuffer(sums)
        return pd.DataFrame({"bucket": some["bucket"][:1] % SUMS, "sums": [total.tobytes()]})

    found = rows.groupBy(F.col("bucket") % SUMS).applyInPandas(add, LEARNT).collect()
    return sum((np.frombuffer(r.sums) for r in sorted(found, key=lambda r: r.bucket)), np.zeros(size))


def _columns(some: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return some["window"].to_numpy(), some["n"].to_numpy(dtype=float)


def learn_weights(model: Model, windows: np.ndarray, n: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Weights after gradient steps through the windows in their order, and how many
    decisions each gate saw."""
    mine = Model(model.tree, model.near, [w.copy() for w in model.weights])
    e = events(windows, model.tree)
    odds, gates = mine.inputs(mine.counts(windows, n, e), e, n > 0)
    m = n[e.row]
    moved = [np.full_like(w, 1e-6) for w in mine.weights]
    cuts = np.searchsorted(e.row, [*range(0, len(windows), STEP), len(windows)])
    for _ in range(EPOCHS):
        for a, b in zip(cuts, cuts[1:]):
            x, here = odds[:, a:b], [g[a:b] for g in gates]
            error = (1 / (1 + np.exp(-mine.mix(x, here))) - e.bit[a:b]) * m[a:b]
            for w, g, index in zip(mine.weights, moved, here):
                seen = np.bincount(index, weights=m[a:b], minlength=len(w))
                slope = np.stack([np.bincount(index, weights=error * x[k], minlength=len(w)) for k in range(ORDERS)], axis=1)
                slope /= np.maximum(seen, 1)[:, None]
                g += slope**2
                w -= RATE * slope / np.sqrt(g)
    return mine.weights, [np.bincount(g, weights=m, minlength=len(w)) for g, w in zip(gates, mine.weights)]


def _fit_weights(table: DataFrame, groups: int, model: Model) -> list[np.ndarray]:
    sent = table.sparkSession.sparkContext.broadcast(model)

    def learn(bucket: int, some: pd.DataFrame) -> pd.DataFrame:
        weights, seen = learn_weights(sent.value, *_columns(some))
        flat = [np.column_stack([w * s[:, None], s]).ravel() for w, s in zip(weights, seen)]
        return pd.DataFrame({"bucket": [bucket], "sums": [np.concatenate(flat).tobytes()]})

    shapes = [(len(w), ORDERS + 1) for w in model.weights]
    flat = _summed(_each_group(table, groups, LEARNT, learn), sum(a * b for a, b in shapes))
    out, at = [], 0
    for w, (a, b) in zip(model.weights, shapes):
        part = flat[at : at + a * b].reshape(a, b)
        at += a * b
        out.append(np.where(part[:, -1:] > 0, part[:, :-1] / np.maximum(part[:, -1:], 1), w))
    sent.unpersist()
    return out


def _fit_refining(table: DataFrame, groups: int, model: Model) -> np.ndarray:
    """What happened where the mixed odds were at each level, by gate."""
    sent = table.sparkSession.sparkContext.broadcast(model)
    size = model.refine.size

    def look(bucket: int, some: pd.DataFrame) -> pd.DataFrame:
        m, total = sent.value, np.zeros(size)
        windows, n = _columns(some)
        e = events(windows, m.tree)
        odds, gates = m.inputs(m.counts(windows, n, e), e, n > 0)
        spot, share = _level(m.mix(odds, gates))
        for side, weight in ((0, 1 - share), (1, share)):
            total += np.bincount((gates[0] * LEVELS + spot + side) * 2 + e.bit, weights=n[e.row] * weight, minlength=size)
        return pd.DataFrame({"bucket": [bucket], "sums": [total.tobytes()]})

    found = _summed(_each_group(table, groups, LEARNT, look), size).reshape(model.refine.shape)
    sent.unpersist()
    return found


def group_log2(model: Model, windows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log2 of the probability of every window of a group."""
    e = events(windows, model.tree)
    odds, gates = model.inputs(model.counts(windows, n, e), e, np.zeros(len(windows), dtype=bool))
    return model.log2(odds, gates, e, len(windows))


def window_scores(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the texts with ``learn``, and (key, m, log2) of every window of all
    texts.  Null texts are empty ones.  Without rows to learn from every decision is even."""
    table = materialize(window_counts(docs), "windows")
    many = table.agg(F.count("*"), F.sum("n")).first()
    groups = max(8, many[0] // GROUP)
    model = Model(*_near_counts(table))
    if many[1]:
        seen = table.where("n > 0").select("window", "n")
        model.weights = _fit_weights(seen, groups, model)
        model.refine = _fit_refining(seen, groups, model)

    def score_group(bucket: int, some: pd.DataFrame) -> pd.DataFrame:
        windows, n = _columns(some)
        log2 = group_log2(sent.value, windows, n).astype(np.float32)
        return pd.DataFrame({"key": windows, "m": some["m"].to_numpy(), "log2": log2})

    sent = table.sparkSession.sparkContext.broadcast(model)
    scored = materialize(_each_group(table, groups, "key bigint, m bigint, log2 float", score_group), "window-scores")
    sent.unpersist()
    return model, scored


def common_windows(scored: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys, in order, and log2 of the most frequent windows, at most ``COMMON_WINDOWS``."""
    level = F.floor(F.log2("m") * 8).cast("int").alias("level")
    left, lowest = COMMON_WINDOWS, None
    for row in sorted(scored.groupBy(level).count().collect(), key=lambda r: -r.level):
        left -= row["count"]
        if left < 0:
            break
        lowest = row.level
    chosen = scored.where(level >= lowest if lowest is not None else F.lit(False)).select("key", "log2").toArrow()
    key = chosen["key"].to_numpy()
    order = np.argsort(key, kind="stable")
    return key[order], chosen["log2"].to_numpy()[order]


def _looked_up(texts: list[str | None], key: np.ndarray, log2: np.ndarray) -> tuple[np.ndarray, list, list]:
    """Of every text the sum of log2 of common windows, and key and number of the others."""
    total = np.zeros(len(texts))
    rest: list[list[np.ndarray]] = [[] for _ in texts]
    many: list[list[np.ndarray]] = [[] for _ in texts]
    for windows, owner in blocks(texts):
        distinct, where = np.unique(windows, return_inverse=True)
        value, known = np.zeros(len(distinct)), np.zeros(len(distinct), dtype=bool)
        if len(key):
            at = np.minimum(np.searchsorted(key, distinct), len(key) - 1)
            known = key[at] == distinct
            value = np.where(known, log2[at], 0.0)
        total += np.bincount(owner, weights=value[where], minlength=len(texts))
        others = np.flatnonzero(~known[where])
        pairs, n = np.unique(owner[others].astype(np.int64) * len(distinct) + where[others], return_counts=True)
        whose = pairs // max(len(distinct), 1)
        cuts = np.flatnonzero(np.diff(whose, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(pairs)]):
            rest[whose[a]].append(distinct[pairs[a:b] % len(distinct)])
            many[whose[a]].append(n[a:b].astype(np.int64))
    none = np.zeros(0, dtype=np.int64)
    return total, [np.concatenate(x) if x else none for x in rest], [np.concatenate(x) if x else none for x in many]


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c): hash and number of every token of the texts, an end each."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update(words(text))
                found[NO_TOKEN] += 1
            if len(found) > 250_000:
                yield _tokens(found)
                found.clear()
        yield _tokens(found)

    return docs.select("text").mapInPandas(count, "token bigint, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


def token_hash(token: bytes) -> int:
    """XXH64 as a signed number."""
    h = xxhash.xxh64_intdigest(token)
    return h - (1 << 64) if h >> 63 else h


def _tokens(found: Counter[bytes]) -> pd.DataFrame:
    return pd.DataFrame({
        "token": np.array([token_hash(t) for t in found], dtype=np.int64),
        "c": np.array(list(found.values()), dtype=np.int64),
    })


def score(docs: DataFrame, training: Column) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score
    (log10 probability of the text) and bits_per_byte.

    ``training`` is a condition on doc_id; null counts as no.  Null texts are empty: one
    token, the end.  Rows that repeat both id and text are learnt from each and reported
    each; other columns are ignored.  Tokens are told apart by a 64-bit hash.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("learn"))
    _, scored = window_scores(docs)
    key, log2 = common_windows(scored)
    counts = materialize(token_counts(docs.where("learn")), "tokens")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    common = {r.token: r.c for r in counts.orderBy(F.desc("c"), "token").limit(COMMON).collect()}
    low = float(np.log10(total.n + 0.5 * (total.v + 1)))
    sent = spark.sparkContext.broadcast((key, log2, common))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, log2, common = sent.value
        hashes: dict[bytes, int] = {}
        logs = {t: float(np.log10(c + 0.5)) - low for t, c in common.items()}
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                found = Counter(words(text))
                found[NO_TOKEN] += 1
                n, known, base, rest, many = 0, 0, 0.0, [], []
                for token, tf in found.items():
                    h = hashes.get(token)
                    if h is None:
                        if len(hashes) > 200_000:
                            hashes.clear()
                        h = hashes[token] = token_hash(token)
                    n += tf
                    if h in logs:
                        known += tf
                        base += tf * logs[h]
                    else:
                        rest.append(h)
                        many.append(tf)
                raw = (text or "").encode("utf-8", "surrogatepass")
                copy = xxhash.xxh64_intdigest(raw) >> 1
                rows.append((doc, copy, n, known, base, len(raw), rest, many))
            out = pd.DataFrame(rows, columns=["doc_id", "copy", "n_tokens", "n_known", "base", "n_bytes", "rest", "many"])
            out["bits"], out["keys"], out["times"] = _looked_up(batch["text"].tolist(), key, log2)
            out["doc_id"] = batch["doc_id"].astype("Int64").to_numpy() if len(batch) else out["doc_id"]
            yield out

    schema = (
        "doc_id bigint, copy bigint, n_tokens bigint, n_known bigint, base double, n_bytes bigint, "
        "rest array<bigint>, many array<bigint>, bits double, keys array<bigint>, times array<bigint>"
    )
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    whole = materialize(read.mapInPandas(look, schema), "scored")
    zero, nought = F.lit(0).cast("bigint"), F.lit(0.0)
    rare = whole.select("doc_id", "copy", F.explode(F.arrays_zip("rest", "many")).alias("t")).select(
        "doc_id", "copy", F.col("t.rest").alias("token"), F.col("t.many").alias("tf")
    )
    c = F.coalesce("c", F.lit(0))
    looked_up = rare.join(counts, "token", "left").select(
        "doc_id", "copy", zero.alias("n"), zero.alias("n_tokens"),
        F.when(c > 0, F.col("tf")).otherwise(0).alias("n_known"),
        (F.col("tf") * (F.log10(c + 0.5) - low)).alias("base"), zero.alias("n_bytes"), nought.alias("bits"),
    )
    others = whole.select("doc_id", "copy", F.explode(F.arrays_zip("keys", "times")).alias("t")).select(
        "doc_id", "copy", F.col("t.keys").alias("key"), F.col("t.times").alias("tf")
    )
    joined = others.join(scored.select("key", "log2"), "key").select(
        "doc_id", "copy", zero.alias("n"), zero.alias("n_tokens"), zero.alias("n_known"), nought.alias("base"),
        zero.alias("n_bytes"), (F.col("tf") * F.col("log2").cast("double")).alias("bits"),
    )
    each = whole.select("doc_id", "copy", F.lit(1).cast("bigint").alias("n"), "n_tokens", "n_known", "base", "n_bytes", "bits")
    summed = each.unionByName(looked_up).unionByName(joined).groupBy("doc_id", "copy").agg(
        *[F.sum(x).alias(x) for x in ("n", "n_tokens", "n_known", "base", "n_bytes", "bits")]
    )
    whole_number = lambda x: (F.col(x) / F.col("n")).cast("bigint").alias(x)
    # Rows that repeat id and text were summed as one; each is reported.
    summed = summed.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    return summed.select(
        "doc_id", whole_number("n_tokens"), whole_number("n_known"), F.lit(int(total.n)).cast("bigint").alias("train_tokens"),
        (F.col("base") / F.col("n")).alias("base_score"), (F.col("bits") / F.col("n") * float(np.log10(2))).alias("score"),
        (-F.col("bits") / F.greatest("n_bytes", F.col("n"))).alias("bits_per_byte"),
    )
