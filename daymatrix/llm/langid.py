"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ones and minus ones.  The vectors of three
successive letters are shifted by their place and multiplied (bound) into the vector
of the trigram; a text's trigram vectors are added (bundled).  A language's prototype
bundles its training texts; a text has the language whose prototype it is closest to
by cosine, after what all prototypes share has been taken away.

Training sums vectors, so each partition sends one vector per language; scoring is a
map.  Letters outside a-z share 100 vectors by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

UNKNOWN = "und"
SIZE = 1024
SEED = 5
ALPHABET = 128  # 0 is what separates words, 1 to 26 are a to z
MAX_ROWS = 30_000  # trigram vectors a worker keeps
BATCH = 128


def _letter_table() -> np.ndarray:
    table = np.zeros(0x10000, dtype=np.int64)
    for code in range(0x10000):
        c = chr(code)
        if c.isalpha():
            low = ord(c.lower()[0])
            table[code] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 % (1 << 32) >> 16) % (ALPHABET - 28)
    return table


_TABLE: list[np.ndarray] = []


def trigrams(text: str | None) -> np.ndarray:
    """Trigram numbers of a text, words set apart; empty if it has no letter."""
    if not text:
        return np.zeros(0, dtype=np.int64)
    if not _TABLE:
        _TABLE.append(_letter_table())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = np.concatenate([[0], _TABLE[0][np.minimum(codes, 0xFFFF)], [0]])
    far = np.flatnonzero(codes > 0xFFFF)
    for i in far:
        letters[i + 1] = ALPHABET - 1 if chr(codes[i]).isalpha() else 0
    letters = letters[(letters > 0) | np.concatenate([[True], letters[:-1] > 0])]
    if len(letters) < 3:
        return np.zeros(0, dtype=np.int64)
    return (letters[:-2] * ALPHABET + letters[1:-1]) * ALPHABET + letters[2:]


class Space:
    """The trigram vectors, made when first met."""

    def __init__(self, size: int = SIZE, seed: int = SEED):
        letters = np.random.default_rng(seed).choice([-1, 1], size=(ALPHABET, size)).astype(np.float32)
        self.letters = [np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters]
        self.size = size
        self.clear()

    def clear(self) -> None:
        self.at = np.full(ALPHABET**3, -1, dtype=np.int32)
        self.vectors = np.zeros((1024, self.size), dtype=np.float32)
        self.known = 0

    def _rows(self, keys: np.ndarray) -> np.ndarray:
        if self.known + len(keys) > MAX_ROWS:
            self.clear()
        new = keys[self.at[keys] < 0]
        if len(new):
            a, b = self.letters[0][new // ALPHABET**2], self.letters[1][new // ALPHABET % ALPHABET]
            while self.known + len(new) > len(self.vectors):
                self.vectors = np.vstack([self.vectors, np.zeros_like(self.vectors)])
            self.vectors[self.known : self.known + len(new)] = a * b * self.letters[2][new % ALPHABET]
            self.at[new] = np.arange(self.known, self.known + len(new))
            self.known += len(new)
        return self.at[keys]

    def bundle(self, texts: list[np.ndarray]) -> np.ndarray:
        """One vector per text, from its trigrams."""
        out = np.zeros((len(texts), self.size), dtype=np.float32)
        some = np.concatenate([*texts, np.zeros(0, dtype=np.int64)])
        if not len(some):
            return out
        seen = np.zeros(ALPHABET**3, dtype=bool)
        seen[some] = True
        keys = np.flatnonzero(seen)
        column = np.zeros(ALPHABET**3, dtype=np.int64)
        column[keys] = np.arange(len(keys))
        for part in range(0, len(keys), MAX_ROWS // 2):  # never more vectors than are kept
            chosen = keys[part : part + MAX_ROWS // 2]
            counts = np.zeros((len(texts), len(chosen)), dtype=np.float32)
            for i, t in enumerate(texts):
                at = column[t] - part
                at = at[(at >= 0) & (at < len(chosen))]
                if len(at):
                    counts[i] = np.bincount(at, minlength=len(chosen))
            rows = self._rows(chosen)  # may replace the vectors
            out += counts @ self.vectors[rows]
        return out


_SPACES: dict[tuple[int, int], Space] = {}


def _space(size: int, seed: int) -> Space:
    if (size, seed) not in _SPACES:
        _SPACES[size, seed] = Space(size, seed)
    return _SPACES[size, seed]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prototypes: np.ndarray  # unit vectors, one row per language
    seed: int = SEED

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [trigrams(t) for t in texts]
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        vectors = _space(self.prototypes.shape[1], self.seed).bundle(found)
        common = self.prototypes.mean(axis=0) if len(self.languages) > 1 else 0
        cosine = _unit(_unit(vectors) - common) @ _unit(self.prototypes - common).T
        best = cosine.argmax(axis=1)
        return [
            (self.languages[b], float(np.clip((1 + c[b]) / 2, 0, 1))) if len(f) else (UNKNOWN, 0.0)
            for b, c, f in zip(best, cosine, found)
        ]

    def column(self, text: Column) -> Column:
        """Struct of lang_pred and score."""
        model = self

        @pandas_udf("lang_pred string, score double")
        def predict(texts: pd.Series) -> pd.DataFrame:
            rows, texts = [], texts.tolist()
            for i in range(0, len(texts), BATCH):
                rows += model.predict(texts[i : i + BATCH])
            return pd.DataFrame(rows, columns=["lang_pred", "score"])

        return predict(text)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def fit(docs: DataFrame, language: str = "lang", size: int = SIZE, seed: int = SEED) -> Model:
    """Prototypes of every non-null value of ``language``.

    Rows without text or letters add nothing; without any training row every text is
    ``und``.  What reaches the driver is one vector per language.
    """

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for i in range(0, len(batch), BATCH):
                some = batch.iloc[i : i + BATCH]
                vectors = _space(size, seed).bundle([trigrams(t) for t in some["text"]])
                for name, rows in some.reset_index(drop=True).groupby("lang").indices.items():
                    sums[name] = sums.get(name, np.zeros(size)) + vectors[rows].sum(axis=0, dtype=float)
        for name, total in sums.items():
            yield pd.DataFrame({"lang": name, "i": np.arange(size), "x": total})

    rows = docs.where(F.col(language).isNotNull() & F.col("text").isNotNull()).select(F.col(language).alias("lang"), "text")
    sums = rows.mapInPandas(part, "lang string, i int, x double").groupBy("lang", "i").agg(F.sum("x").alias("x"))
    whole = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    found = whole.select("lang", F.transform("v", lambda p: p["x"]).alias("v")).orderBy("lang").collect()
    found = [r for r in found if any(r.v)]
    vectors = np.array([r.v for r in found]) if found else np.zeros((0, size))
    return Model(tuple(r.lang for r in found), _unit(vectors).astype(np.float32), seed)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every document, whole texts of any length.

    Texts that are null, empty or without a letter are ``und`` with score 0, as is every
    text if no language was learnt.  Of equally close languages the first by name counts.
    Repeated rows are reported each; an empty table gives no rows.  Other columns are
    ignored.
    """
    return docs.select("doc_id", model.column(F.col("text")).alias("p")).select("doc_id", "p.*")
