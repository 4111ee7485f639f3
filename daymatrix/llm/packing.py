"""Packing of tokenised documents into sequences by best-two-fit.

Documents are tokenised where they are read; only piece lengths are shuffled.  Pieces
are dealt by a hash into groups of about ``GROUP`` pieces, each packed by one task:
longest first, always the longest piece that fits; then the smallest piece of a
sequence that still has a gap is exchanged for two unpacked pieces that together fill
the wider gap more tightly.  A group leaves at most one sequence badly filled, so the
loss against packing everything together is one sequence in thousands.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daymatrix.llm.text import kept
from daymatrix.session import materialize

MAX_TOKENS = 4096
END_ID = 1
GROUP = 50_000
CACHE_WORDS = 1_000_000  # some 250 MB a worker, which has that to itself in the operator's own query

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


#: Parts of Latin letters, digits and ASCII marks, which such a tokenizer takes apart into
#: runs of letters, runs of marks and single digits; an apostrophe may join letters.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\[-`{-~]+")
_RUNS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
_TOGETHER = 512  # runs encoded at once


class WordTokenizer:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    For tokenizers that treat white space as a mere separator, a text's ids are those
    of its space-separated parts one after the other; parts repeat, so most are looked
    up.  A new part of plain characters is the sequence of its lower-cased runs, which
    repeat more often still; new runs are encoded many at a time, as one text.  Up to
    ``cache_words`` parts and runs are remembered, and those of one more text.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.cache_words = cache_words
        self.tokenizer = Tokenizer.from_file(path)
        self.parts: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}
        #: Texts with an id of their own, which are not taken apart.
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.whole = [token.content.lower() for token in added]

    def _cut(self, text: str) -> list[str] | str:
        low = text.lower()
        plain = _PLAIN.fullmatch(text) and not any(token in low for token in self.whole)
        return _RUNS.findall(low) if plain else text

    def _encode(self, part: str) -> bytes:
        ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _learn_runs(self, new: list[str]) -> None:
        for i in range(0, len(new), _TOGETHER):
            some = new[i : i + _TOGETHER]
            encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            owner, ids = np.array(encoded.word_ids), np.array(encoded.ids, dtype="<u4")
            if len(owner) and owner[-1] == len(some) - 1:
                ends = np.searchsorted(owner, np.arange(len(some) + 1))
                self.runs.update((run, ids[a:b].tobytes()) for run, a, b in zip(some, ends, ends[1:]))
            else:  # not one word each after all
                self.runs.update((run, self._encode(run)) for run in some)

    def _learn(self, new: set[bytes]) -> None:
        if len(self.parts) > self.cache_words:
            self.parts.clear()
        if len(self.runs) > self.cache_words:
            self.runs.clear()
        cut = {part: self._cut(part.decode("utf-8", "replace")) for part in new}
        runs = {run for made in cut.values() if isinstance(made, list) for run in made}
        self._learn_runs(sorted(runs.difference(self.runs)))
        for part, made in cut.items():
            known = self.runs
            self.parts[part] = b"".join(map(known.__getitem__, made)) if isinstance(made, list) else self._encode(made)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        split = text.encode("utf-8", "replace").split()
        try:
            return b"".join(map(self.parts.__getitem__, split))
        except KeyError:
            self._learn(set(split).difference(self.parts))
        if all(part in self.parts for part in split):
            return b"".join(map(self.parts.__getitem__, split))
        self._learn(set(split))  # what was known has been forgotten meanwhile
        return b"".join(map(self.parts.__getitem__, split))


def _tokenizer(path: str, cache_words: int) -> WordTokenizer:
    return kept(f"{path} {cache_words}", lambda: WordTokenizer(path, cache_words))


def pieces(
    docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, cache_words: int = CACHE_WORDS
) -> DataFrame:
    """The pieces of every document: its ids and ``end_id``, cut only if longer than
    ``max_tokens``.  ``tokenizer`` is the path of a tokenizer file on every machine.
    Null texts are empty texts: one piece that is the end alone."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(tokenizer, cache_words)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.ids(text.as_py()) + end
                for k, i in enumerate(range(0, len(ids), 4 * max_tokens)):
                    part = ids[i : i + 4 * max_tokens]
                    rows.append((doc, k, i // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, PIECES)


class _Stock:
    """Unpacked pieces by length; ``bits`` marks the lengths in stock."""

    def __init__(self, lengths: Counter):
        self.count = dict(lengths)
        self.bits = sum(1 << n for n in lengths)

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            self.bits &= ~(1 << n)

    def put(self, n: int) -> None:
        self.count[n] = self.count.get(n, 0) + 1
        self.bits |= 1 << n

    def longest(self, limit: int) -> int:
        """The longest length in stock up to ``limit``, 0 if there is none."""
        return (self.bits & ((2 << limit) - 1)).bit_length() - 1 if limit > 0 and self.bits & ((2 << limit) - 1) else 0


def best_two_fit(lengths: Counter, size: int) -> list[list[int]]:
    """Bins as lists of lengths; every length is between 1 and ``size``."""
    stock, bins = _Stock(lengths), []
    while stock.bits:
        held, gap = [], size
        while n := stock.longest(gap):
            stock.take(n)
            held.append(n)
            gap -= n
        if gap and len(held) > 1 and stock.bits:
            small = held[-1]
            pair = _best_pair(stock, gap + small, small)
            if pair:
                held.pop()
                stock.put(small)
                for n in pair:
                    stock.take(n)
                    held.append(n)
        bins.append(held)
    return bins


def _best_pair(stock: _Stock, room: int, beat: int) -> tuple[int, int] | None:
    """Two lengths in stock that fill ``room`` best and more than ``beat`` does."""
    best, found = beat, None
    a = stock.longest(room - 1)
    while a and 2 * a > best:
        b = stock.longest(min(a, room - a))
        if b == a and stock.count[a] < 2:
            b = stock.longest(min(a - 1, room - a))
        if b and a + b > best:
            best, found = a + b, (a, b)
            if best == room:
                break
        a = stock.longest(a - 1)
    return found


def pack(
    found: DataFrame, n_groups: int, max_tokens: int = MAX_TOKENS, method: Callable[[Counter, int], list[list[int]]] = best_two_fit
) -> DataFrame:
    """The pieces with sequence_id and offset.

    ``found`` is a written table: pieces are dealt by their places in it, which a repeated
    task finds the same, so any number of equal pieces spreads over the groups.  Which of
    several pieces of equal length goes first follows from their ids.
    """

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        where = {n: list(x)[::-1] for n, x in rows.groupby("length").indices.items()}
        sequence, offset = [0] * len(rows), [0] * len(rows)
        for number, held in enumerate(method(Counter(rows["length"].tolist()), max_tokens)):
            at = 0
            for n in held:
                row = where[n].pop()
                sequence[row], offset[row] = number * n_groups + int(key[0]), at
                at += n
        rows["sequence_id"], rows["offset"] = sequence, offset
        return rows.drop(columns="group")

    dealt = found.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_groups)))
    return dealt.groupBy("group").applyInPandas(place, PIECES + ", sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
    group: int = GROUP,
    cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts are empty, repeated documents are packed each, an empty table gives no
    rows, other columns are ignored.  ``cache_words`` bounds a worker's memory only.
    """
    found = materialize(pieces(docs, tokenizer, max_tokens, end_id, cache_words), "pieces")
    return pack(found, max(1, -(-found.count() // group)), max_tokens)
