"""Toxicity classifier: averaged subword embeddings and a linear softmax.

A word's vector is the mean of the vectors of its character n-grams, hashed into a
table; a passage's vector is the mean of its words' vectors; a linear softmax turns
it into the probability of the label.  Embeddings and softmax are trained together,
so a misspelling no one has labelled still shares most of its n-grams with the word.

Texts are read as overlapping passages of ``PASSAGE`` words, for a few words would
vanish in the mean of a long text; a document is as toxic as its worst passage.
Training starts with every passage labelled as its document and goes on with those
passages of labelled documents that turned out innocent relabelled.

The model is fitted in one task on the whole texts of about ``MAX_DOCUMENTS`` documents
of each label at most (a documented bound; beyond it a hash of the id decides).  Scoring
is a map over all whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from daymatrix.llm.text import words
from daymatrix.session import materialize

PASSAGE = 24
BUCKETS = 1 << 17
SIZE = 8
GRAMS = (3, 4, 5)
MAX_DOCUMENTS = 2_000
EPOCHS = 3
RELABELLINGS = 1
BATCH = 256
MIN_STEPS = 500  # few passages are gone through more often
RATE = 1.0
DAMPING = 3e-4
SEED = 11
CACHE_WORDS = 600_000
_STRIP = b".,;:!?\"'()[]{}%$#*&|<>"


def subwords(word: bytes) -> list[int]:
    """Buckets of the n-grams of a word and of the word itself."""
    word = b"<" + (word.strip(_STRIP) or word) + b">"
    out = [zlib.crc32(word) % BUCKETS]
    for n in GRAMS:
        out += [zlib.crc32(word[i : i + n]) % BUCKETS for i in range(len(word) - n + 1)]
    return out


def _words(text: str | None) -> list[bytes]:
    """Words of a text; a word said several times in a row counts once."""
    w = words(text)
    return [b for a, b in zip([b"", *w], w) if a != b]


def passages(text: str | None) -> list[str]:
    """The text in passages of ``PASSAGE`` words, as they are learnt from."""
    w = _words(text)
    return [b" ".join(w[i : i + PASSAGE]).decode("utf-8", "replace") for i in range(0, len(w), PASSAGE)]


@dataclass(frozen=True)
class Model:
    """What a trained model says of a bucket, and of a passage as such."""

    table: np.ndarray  # the buckets' shares in the difference of both classes' scores
    bias: float

    @cached_property
    def _values(self) -> list[float]:
        return self.table.tolist()  # single look-ups are faster than in an array

    def word(self, word: bytes) -> float:
        ids = subwords(word)
        return sum(map(self._values.__getitem__, ids)) / len(ids)

    def score(self, text: str | None, cache: dict[bytes, float]) -> float:
        w = _words(text)
        if not w:
            return float(1 / (1 + np.exp(-self.bias)))
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for x in w:
            if x not in cache:
                cache[x] = self.word(x)
        sums = np.concatenate([[0.0], np.cumsum(np.fromiter(map(cache.__getitem__, w), dtype=float, count=len(w)))])
        half = PASSAGE // 2
        starts = np.arange(0, max(1, len(w) - half), half)
        ends = np.minimum(starts + PASSAGE, len(w))
        worst = ((sums[ends] - sums[starts]) / (ends - starts)).max() + self.bias
        return float(1 / (1 + np.exp(-np.clip(worst, -30, 30))))

    def score_column(self, text: Column) -> Column:
        model = self

        @pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            cache: dict[bytes, float] = {}
            for texts in batches:
                yield pd.Series([model.score(t, cache) for t in texts], dtype=float)

        return score(text)


class _Trainer:
    """Joint stochastic gradient descent over passages, in numpy."""

    def __init__(self, texts: list[str], seed: int = SEED):
        self.seed = seed
        self.reset()
        known: dict[bytes, int] = {}
        ids, sizes = [], []
        flat, counts = [], []
        for text in texts:
            w = text.encode().split()
            for x in w:
                if x not in known:
                    known[x] = len(known)
                    s = subwords(x)
                    ids += s
                    sizes.append(len(s))
            flat += [known[x] for x in w]
            counts.append(len(w))
        self.sub = np.array(ids, dtype=np.int64)
        self.sub_start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.word = np.array(flat, dtype=np.int64)
        self.word_start = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def reset(self) -> None:
        """Forget what was learnt."""
        self.random = random = np.random.default_rng(self.seed)
        self.embeddings = random.normal(scale=0.1, size=(BUCKETS, SIZE)).astype(np.float32)
        self.softmax = random.normal(scale=SIZE**-0.5, size=(SIZE, 2)).astype(np.float32)
        self.bias = np.zeros(2, dtype=np.float32)
        #: Squared gradients so far.  What is seen a few times only hardly moves.
        self.moved = np.full(BUCKETS, DAMPING**2, dtype=np.float32)
        self.moved_softmax = np.full((SIZE, 2), 1e-4, dtype=np.float32)

    def _ragged(self, start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the given rows of a ragged array, and the row of each."""
        many = start[rows + 1] - start[rows]
        owner = np.repeat(np.arange(len(rows)), many)
        return np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + start[rows][owner], owner

    def _batch(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, the passage each belongs to, and its weight in the mean."""
        at, passage = self._ragged(self.word_start, rows)
        w = self.word[at]
        spots, word = self._ragged(self.sub_start, w)
        in_word = 1.0 / (self.sub_start[w + 1] - self.sub_start[w])
        in_passage = 1.0 / (self.word_start[rows + 1] - self.word_start[rows])
        return self.sub[spots], passage[word], (in_word[word] * in_passage[passage[word]]).astype(np.float32)

    def _mean(self, buckets, passage, weight, n) -> np.ndarray:
        at = np.flatnonzero(np.diff(passage, prepend=-1))
        return np.add.reduceat(self.embeddings[buckets] * weight[:, None], at, axis=0)

    def _softmax(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.softmax + self.bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def train(self, chosen: np.ndarray, labels: np.ndarray, epochs: int, rate: float) -> None:
        """Learn from the chosen passages; both labels count the same."""
        n, weights = len(chosen), _even(labels[chosen])
        weights = np.bincount(chosen, weights=weights, minlength=len(labels))
        once = -(-n // BATCH)
        epochs = max(epochs, -(-MIN_STEPS // once))
        steps, done = epochs * once, 0
        for _ in range(epochs):
            order = chosen[self.random.permutation(n)]
            for i in range(0, n, BATCH):
                rows = order[i : i + BATCH]
                step = rate * max(0.05, 1 - done / steps)
                done += 1
                buckets, passage, weight = self._batch(rows)
                x = self._mean(buckets, passage, weight, len(rows))
                error = self._softmax(x)
                error[np.arange(len(rows)), labels[rows]] -= 1
                error *= weights[rows, None]
                back = error @ self.softmax.T
                # Adaptive steps: what is rare moves as far as what is in every passage.
                order_b = np.argsort(buckets, kind="stable")
                sorted_b = buckets[order_b]
                cut = np.flatnonzero(np.diff(sorted_b, prepend=-1))
                change = np.add.reduceat((back[passage] * weight[:, None])[order_b], cut, axis=0) / len(rows)
                touched = sorted_b[cut]
                self.moved[touched] += (change**2).mean(axis=1)
                self.embeddings[touched] -= step * change / np.sqrt(self.moved[touched])[:, None]
                change = x.T @ error / len(rows)
                self.moved_softmax += change**2
                self.softmax -= step * 0.5 * change / np.sqrt(self.moved_softmax)
                self.bias -= step * error.mean(axis=0)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of some passages."""
        out = np.zeros(len(rows))
        for i in range(0, len(rows), 1024):
            some = rows[i : i + 1024]
            out[i : i + 1024] = self._softmax(self._mean(*self._batch(some), len(some)))[:, 1]
        return out

    def model(self) -> Model:
        gap = self.softmax[:, 1] - self.softmax[:, 0]
        return Model((self.embeddings @ gap).astype(np.float32), float(self.bias[1] - self.bias[0]))


def _even(labels: np.ndarray) -> np.ndarray:
    """Weights that make both labels count the same."""
    return np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)


def _platt(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic fit of y on x, by Newton's method."""
    a, b, ridge = 1.0, 0.0, 1e-2
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = weights * p * (1 - p)
        g = np.array([(weights * (p - y) * x).sum() + ridge * a, (weights * (p - y)).sum() + ridge * b])
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + ridge]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    return max(a, 1e-3), b


def train(texts: list[str], labels: np.ndarray, owners: np.ndarray, seed: int = SEED) -> Model:
    """Model of passages, the labels of their documents and the documents (numbered).
    Every fourth document is set apart to calibrate the scores, where both labels count
    the same: missing a toxic document costs what a false alarm does."""
    if not len(texts) or labels.min() == labels.max():
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return Model(np.zeros(BUCKETS, dtype=np.float32), float(np.log(share / (1 - share))))
    apart = owners % 4 == 3
    if len(np.unique(labels[apart])) < 2 or len(np.unique(labels[~apart])) < 2:
        apart = np.zeros(len(labels), dtype=bool)  # too few labels to spare some
    chosen = np.flatnonzero(~apart)
    trainer = _Trainer(texts, seed)
    trainer.train(chosen, labels, EPOCHS, RATE)
    for _ in range(RELABELLINGS):
        p = np.zeros(len(labels))
        p[chosen] = trainer.probabilities(chosen)
        # Of a labelled document the worst passage stays labelled, and others only if
        # innocent documents hardly ever have one that looks as bad.
        limit = max(0.5, float(np.quantile(p[chosen][labels[chosen] == 0], 0.999)))
        better = ((labels == 1) & (p > limit)).astype(np.int64)
        better[_worst(p, owners)] |= labels[_worst(p, owners)]
        trainer.reset()
        trainer.train(chosen, better, EPOCHS, RATE)
    model = trainer.model()
    rows = np.flatnonzero(apart) if apart.any() else chosen
    p = np.clip(trainer.probabilities(rows), 1e-12, 1 - 1e-12)
    x = np.log(p / (1 - p))
    worst = _worst(x, owners[rows])
    y = labels[rows][worst]
    slope, offset = _platt(x[worst], y, _even(y) * len(y))
    return Model(model.table * np.float32(slope), model.bias * slope + offset)


def _worst(p: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """The row of every document with the greatest value."""
    order = np.lexsort((-p, owners))
    return order[np.flatnonzero(np.diff(owners[order], prepend=-1))]


def fit(docs: DataFrame, labels: DataFrame, label: str, fold: Column, max_documents: int = MAX_DOCUMENTS) -> Model:
    """Model of ``label`` (0/1) learnt from labelled rows in ``fold``, a condition on
    doc_id.  Null or other labels and ids labelled differently are ignored; without
    rows of both labels all scores are (nearly) the share of ones."""
    marks = (
        labels.where(fold & F.col(label).isin(0, 1))
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("__other"))
        .where(F.col("label") == F.col("__other")).select("doc_id", "label")
    )

    @pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([passages(t) for t in texts], dtype=object)

    sizes = {r.label: r["count"] for r in marks.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, F.lit(min(1.0, max_documents / sizes.get(1, 1)))).otherwise(
        F.lit(min(1.0, max_documents / sizes.get(0, 1)))
    )
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    # Of bounded size, so the texts stay where they are.
    chosen = F.broadcast(marks.where(spread < share * (1 << 20)))
    sample = docs.where(fold).select("doc_id", "text").join(chosen, "doc_id").select(
        "doc_id", "label", F.posexplode(cut("text")).alias("place", "passage")
    )

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        rows = pd.concat(parts).sort_values(["doc_id", "place"]) if parts else pd.DataFrame({"doc_id": [], "passage": [], "label": []})
        owners = pd.factorize(rows["doc_id"])[0]
        model = train(rows["passage"].tolist(), rows["label"].to_numpy(dtype=np.int64), owners)
        yield pd.DataFrame({"table": [model.table.tobytes()], "bias": [model.bias]})

    row = materialize(sample, "passages").coalesce(1).mapInPandas(learn, "table binary, bias double").first()
    return Model(np.frombuffer(row.table, dtype=np.float32), row.bias)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document, whole texts of any length.

    Null texts count as empty ones, which have the score of the bias.  Repeated rows are
    reported each, equal texts with equal scores; an empty table gives no rows.  Other
    columns are ignored.
    """
    return docs.select("doc_id", model.score_column(F.col("text")).alias("score"))
