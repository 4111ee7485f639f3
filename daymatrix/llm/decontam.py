"""Benchmark decontamination by the q-gram lemma.

Texts are compared on their letters and digits, lower-cased, every other run being
one space.  Each benchmark item is cut into overlapping segments, long ones and, for
excerpts, short ones that start every few characters; a document holds a leak of an item
when some part of it is within the edit budget of one segment.  Of an item longer than a
short segment, every verbatim passage of ``EXCERPT + EXCERPT_STRIDE - 1`` characters (79)
is found, wherever it starts; a shorter one only if it covers a segment.  By
the q-gram lemma such a part shares at least ``(m - q + 1) - k * q`` q-grams with the
segment (length m, budget k), and all of them lie within k + 1 neighbouring
diagonals.  Shared q-grams are therefore counted in overlapping diagonal bands, bands
below the bound are dropped without loss, and the rest is verified by an alignment
limited to the band.  The result equals that of a full alignment of every segment with
every document.

Segments of one item overlap, so its q-grams are listed once by their places in the item
and counted in bands of item and diagonal first.  Such a band is wide enough to hold any
band of a segment; where not even the smallest bound is met, no segment can meet its own.
Only q-grams of the bands that are left are counted for each segment.

The documents are only mapped, never shuffled.  The benchmark travels in blocks of at
most ``BLOCK_CHARS`` characters, one after the other, so neither a task nor the driver
ever holds more than one block.  Long texts are searched in overlapping windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from daymatrix.session import materialize

Q = 8
SEGMENT = 120  # characters of a segment; successive ones overlap by half
EXCERPT = 64  # characters of a short segment
EXCERPT_STRIDE = 16  # characters from one short segment to the next
EDIT_SHARE = 0.1  # edits allowed per character of a segment
BLOCK_CHARS = 2_000_000
WINDOW = 1 << 17  # characters of a document searched at once
MASK_BITS = 22
ALIGNED = 1024  # segments aligned at once

LEAKS = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:int>>"


def _lower_table() -> np.ndarray:
    """Code point -> lower-cased code point, 32 for what separates words."""
    table = np.full(0x10000, 32, dtype=np.uint32)
    for code in range(0x10000):
        c = chr(code)
        if c.isalnum():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_LOWER: list[np.ndarray] = []


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Compared characters and the position of each in ``text``."""
    if not _LOWER:
        _LOWER.append(_lower_table())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = _LOWER[0][np.minimum(codes, 0xFFFF)]
    if len(codes) and codes.max() > 0xFFFF:
        low = np.where(codes > 0xFFFF, codes, low)
    keep = low != 32
    keep[1:] |= low[:-1] != 32
    if len(keep):
        keep[0] = low[0] != 32
    at = np.flatnonzero(keep)
    low = low[at]
    if len(low) and low[-1] == 32:
        low, at = low[:-1], at[:-1]
    return low, at


def _hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value of every Q successive characters."""
    if len(codes) < Q:
        return np.zeros(0, dtype=np.uint64)
    h, base, span = codes.astype(np.uint64), np.uint64(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while span < Q:
            h = h[:-span] * base + h[span:]
            base, span = base * base + np.uint64(2), span * 2
        return h * np.uint64(0xD6E8FEB86659FD93)


def budget(length: int, share: float = EDIT_SHARE) -> int:
    """Edits allowed in a segment: the share, but never so many that the lemma
    would demand no common q-gram."""
    return max(0, min(int(length * share), (length - Q) // Q))


def _cuts(length: int) -> Iterator[tuple[int, int]]:
    """Size and start of the segments of an item; the last of a size ends with the item."""
    for size, stride in ((SEGMENT, SEGMENT // 2), (EXCERPT, EXCERPT_STRIDE)):
        if size == SEGMENT or length > size:
            for start in range(0, max(1, length - size), stride):
                yield size, start
            if length > size:
                yield size, length - size


def _null_last(item: int | None) -> tuple[bool, int]:
    return item is None, item or 0


class _Parts:
    """Parts of texts (text, place in it, codes), laid out in one array ``apart`` codes
    from each other."""

    def __init__(self, parts: list[tuple[int, int, np.ndarray]], apart: int):
        self.parts, self.apart = parts, apart
        self.size = np.array([len(codes) for _, _, codes in parts])
        self.start = np.cumsum(self.size + apart) - self.size
        self.codes = np.zeros(int(self.start[-1] + self.size[-1]) + apart, dtype=np.uint32)
        for at, (_, _, codes) in zip(self.start, parts):
            self.codes[at : at + len(codes)] = codes

    def note(self, found: list[set], item: int, start: int, end: int, edits: int) -> None:
        """Add a leak, given by its places in the array, to those of its text."""
        n = int(np.searchsorted(self.start - self.apart // 2, (start + end) // 2, "right")) - 1
        text, begin, _ = self.parts[n]
        first, last = max(start - int(self.start[n]), 0), min(end - int(self.start[n]), int(self.size[n]))
        if last > first:
            found[text].add((item, begin + first, begin + last, edits))


@dataclass(frozen=True)
class _Candidates:
    """Segments that wait to be aligned, each with the text it may lie in."""

    parts: _Parts
    segment: np.ndarray
    begin: np.ndarray
    text: np.ndarray


class Index:
    """The q-grams of one benchmark block."""

    def __init__(self, items: list[tuple[int | None, str]], share: float = EDIT_SHARE):
        segments, owners, grams, inside = [], [], [np.zeros(0, dtype=np.uint64)], []
        first = 0  # number of an item's first q-gram
        for item, text in items:
            codes, _ = normalise(text)
            if not len(codes):
                continue
            grams.append(_hashes(codes))
            for size, begin in _cuts(len(codes)):
                segments.append(codes[begin : begin + size])
                owners.append(item)
                inside.append(first + begin)
            first += len(grams[-1])
        self.segments = segments
        #: Distinct ids, null last, and the place of each segment's id among them.
        self.ids = sorted(set(owners), key=_null_last)
        place = {item: n for n, item in enumerate(self.ids)}
        self.owner = np.array([-1 if item is None else item for item in owners], dtype=np.int64)
        self.item = np.array([place[item] for item in owners], dtype=np.int64)
        self.length = np.array([len(s) for s in segments], dtype=np.int64)
        self.budget = np.array([budget(len(s), share) for s in segments], dtype=np.int64)
        self.bound = np.maximum(1, self.length - Q + 1 - self.budget * Q)
        #: Shorter than one q-gram: such items are looked up as whole strings.
        self.short = [i for i, s in enumerate(segments) if len(s) < Q]
        self.step = int(self.budget.max(initial=0)) + 1
        #: More than any band of a segment extends in a text.
        self.reach = SEGMENT + 4 * self.step + 2 * int(self.budget.max(initial=0)) + 2
        self.least = int(self.bound[self.length >= Q].min(initial=np.iinfo(np.int64).max))
        values = np.concatenate(grams)
        order = np.argsort(values, kind="stable")
        #: Distinct q-grams, where each begins in the list of all, and how often it is there.
        self.values, self.begin, self.many = np.unique(values[order], return_index=True, return_counts=True)
        self.gram = order
        size = [len(g) for g in grams]
        self.text = np.repeat(np.arange(len(grams)), size)
        self.place = np.concatenate([np.arange(n) for n in size])
        # The segments that each q-gram lies in.
        held = np.maximum(self.length - Q + 1, 0)
        number = np.repeat(np.arange(len(segments)), held)
        at = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held) + np.repeat(np.array(inside, dtype=np.int64), held)
        by_gram = np.argsort(at, kind="stable")
        self.covering = number[by_gram]
        self.covering_place = (at - np.array([*inside, 0], dtype=np.int64)[number])[by_gram]
        self.covered = np.searchsorted(at[by_gram], np.arange(len(values) + 1))
        self.mask = np.zeros(1 << MASK_BITS, dtype=bool)
        self.mask[self.values >> np.uint64(64 - MASK_BITS)] = True

    def find(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item, start, end, edits) of the leaks in ``text``, ends exclusive."""
        return self.find_all([text])[0]

    def find_all(self, texts: Iterable[str | None]) -> list[list[tuple[int | None, int, int, int]]]:
        """The leaks of several texts, of which a few windows are held at a time.  Short
        ones are searched together, far enough apart that no band reaches from one into
        another."""
        out, some, size = [], [], 0
        for text in texts:
            some.append(text)
            size += len(text or "")
            if size >= 4 * WINDOW:
                out += self._together(some)
                some, size = [], 0
        return out + self._together(some)

    def _together(self, texts: list[str | None]) -> list[list[tuple[int | None, int, int, int]]]:
        found: list[set[tuple[int, int, int, int]]] = []
        places: list[np.ndarray] = []
        parts: list[tuple[int, int, np.ndarray]] = []
        todo: dict[int, list[_Candidates]] = {}
        waiting = 0
        for text in texts:
            found.append(set())
            places.append(np.zeros(0, dtype=np.int64))
            if not text or not self.segments:
                continue
            codes, places[-1] = normalise(text)
            for begin in range(0, max(1, len(codes)), WINDOW):
                parts.append((len(found) - 1, begin, codes[begin : begin + WINDOW + self.reach]))
                waiting += len(parts[-1][2]) + self.reach
                if waiting >= WINDOW:
                    self._search(_Parts(parts, self.reach), todo, found)
                    parts, waiting = [], 0
        if parts:
            self._search(_Parts(parts, self.reach), todo, found)
        for m, some in todo.items():
            self._align(some, m, found)
        return [
            [(self.ids[i], int(at[s]), int(at[e - 1]) + 1, k) for i, s, e, k in _merged(some)] for some, at in zip(found, places)
        ]

    def _search(self, parts: _Parts, todo: dict[int, list[_Candidates]], found: list[set]) -> None:
        """Note the verbatim leaks of some parts, and align candidates when there are many
        of a length; others wait in ``todo``."""
        sure, candidates = self._window(parts.codes)
        for item, start, end in sure:
            parts.note(found, item, start, end, 0)
        if candidates is None:
            return
        segment, band = candidates
        for m in np.unique(self.length[segment]).tolist():
            rows = np.flatnonzero(self.length[segment] == m)
            most = int(self.budget[segment[rows]].max())
            begin = band[rows] * self.step - most
            view = begin[:, None] + np.arange(2 * self.step + 2 * most + 1 + m)
            inside = (view >= 0) & (view < len(parts.codes))
            text = np.where(inside, parts.codes[np.clip(view, 0, len(parts.codes) - 1)], 0)
            waiting = todo.setdefault(m, [])
            waiting.append(_Candidates(parts, segment[rows], begin, text))
            if sum(len(c.segment) for c in waiting) >= ALIGNED:
                self._align(waiting, m, found)
                todo[m] = []

    def _window(self, codes: np.ndarray) -> tuple[list[tuple[int, int, int]], tuple[np.ndarray, np.ndarray] | None]:
        """(item, start, end) of verbatim segments, and the segments and bands to align."""
        sure = [x for s in self.short for x in self._exact(codes, s)]
        h = _hashes(codes)
        hits = np.flatnonzero(self.mask[h >> np.uint64(64 - MASK_BITS)])
        if not len(hits):
            return sure, None
        found = np.searchsorted(self.values, h[hits])
        found[found == len(self.values)] = 0
        same = self.values[found] == h[hits]
        hits, found = hits[same], found[same]
        if not len(hits):
            return sure, None
        hits, gram = _listed(hits, self.begin[found], self.many[found])
        gram = self.gram[gram]
        kept = self._dense(self.text[gram], hits - self.place[gram])
        hits, gram = hits[kept], gram[kept]
        if not len(hits):
            return sure, None
        begin = self.covered[gram]
        hits, entry = _listed(hits, begin, self.covered[gram + 1] - begin)
        segment = self.covering[entry]
        diagonal = hits - self.covering_place[entry]
        band = diagonal // self.step
        # Bands are two steps wide and start at every step.
        low = int(band.min()) - 1
        wide = int(band.max()) - low + 1
        key = np.concatenate([segment * wide + band - low, segment * wide + band - 1 - low])
        key, count = np.unique(key, return_counts=True)
        key = key[count >= self.bound[key // wide]]
        if not len(key):
            return sure, None
        # A diagonal that shares every q-gram of a segment holds it verbatim.
        first = int(diagonal.min())
        span = int(diagonal.max()) - first + 1
        line, count = np.unique(segment * span + diagonal - first, return_counts=True)
        line = line[count == self.length[line // span] - Q + 1]
        if len(line):
            s, d = line // span, line % span + first
            sure += [(int(self.item[i]), int(x), int(x) + int(self.length[i])) for i, x in zip(s, d)]
            done = s * wide + d // self.step - low
            key = np.setdiff1d(key, np.concatenate([done, done - 1]), assume_unique=False)
        return sure, (key // wide, key % wide + low) if len(key) else None

    def _dense(self, text: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Which shared q-grams lie in a band, three steps wide, of an item that holds as
        many as the smallest bound of a segment.  A segment's band is two steps wide and
        need not start at a step of its item."""
        step = diagonal // self.step
        low = int(step.min())
        wide = int(step.max()) - low + 4
        key, where, count = np.unique(text * wide + step - low, return_inverse=True, return_counts=True)
        # Sums of three neighbours, from each band that is not empty: among sorted keys the
        # next two steps are the next two entries, if they are there.
        end = np.searchsorted(key, key + 3)
        totals = np.concatenate([[0], np.cumsum(count)])
        dense = np.flatnonzero(totals[end] - totals[:-1] >= self.least)
        kept = np.zeros(len(key) + 1, dtype=np.int64)
        np.add.at(kept, dense, 1)
        np.add.at(kept, end[dense], -1)
        return np.cumsum(kept)[where] > 0

    def _exact(self, codes: np.ndarray, s: int) -> list[tuple[int, int, int]]:
        """Whole-word occurrences of an item shorter than a q-gram."""
        m = len(self.segments[s])
        if len(codes) < m:
            return []
        same = (np.lib.stride_tricks.sliding_window_view(codes, m) == self.segments[s]).all(axis=1)
        padded = np.concatenate([[32], codes, [32]])
        starts = np.flatnonzero(same)
        edge = (padded == 32) | (padded == 0)
        starts = starts[edge[starts] & edge[starts + m + 1]]
        return [(int(self.item[s]), int(x), int(x) + m) for x in starts]

    def _align(self, todo: list[_Candidates], m: int, found: list[set]) -> None:
        """Alignments of segments of length m within their bands.  A cell holds the
        cost in the high and the start in the low bits, so minima keep both."""
        if not todo:
            return
        segments, views = (np.concatenate([getattr(c, name) for c in todo]) for name in ("segment", "text"))
        begins = np.concatenate([c.begin for c in todo])
        owners = np.repeat(np.arange(len(todo)), [len(c.segment) for c in todo])
        width = views.shape[1] - m
        low_bits = width.bit_length()
        kind = np.int16 if (m + width + 2) << low_bits < 1 << 15 else np.int64
        one = kind(1 << low_bits)
        slope = np.arange(width, dtype=kind) * one
        for at in range(0, len(segments), ALIGNED):
            segment, text = segments[at : at + ALIGNED], views[at : at + ALIGNED]
            pattern = np.stack([self.segments[s] for s in segment])
            cost = np.tile(np.arange(width, dtype=kind), (len(segment), 1))
            for i in range(m):
                step = (pattern[:, i, None] != text[:, i : i + width]).astype(kind)
                step *= one
                step += cost
                cost += one
                np.minimum(step[:, :-1], cost[:, 1:], out=step[:, :-1])
                step -= slope
                np.minimum.accumulate(step, axis=1, out=step)
                step += slope
                cost = step
            best = cost.argmin(axis=1)
            value = cost[np.arange(len(segment)), best].astype(np.int64)
            edits, first = value >> low_bits, value & ((1 << low_bits) - 1)
            for r in np.flatnonzero(edits <= self.budget[segment]):
                begin = int(begins[at + r])
                parts = todo[owners[at + r]].parts
                parts.note(found, int(self.item[segment[r]]), begin + int(first[r]), begin + m + int(best[r]), int(edits[r]))


def _listed(owner: np.ndarray, begin: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every entry of the ranges that start at ``begin``, beside its owner."""
    spots = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
    return np.repeat(owner, many), spots


def _merged(found: set[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Overlapping spans of one item as one, with the smallest number of edits."""
    out: list[tuple[int, int, int, int]] = []
    for item, start, end, edits in sorted(found):
        if out and out[-1][0] == item and start <= out[-1][2]:
            _, s, e, k = out[-1]
            out[-1] = (item, s, max(e, end), min(k, edits))
        else:
            out.append((item, start, end, edits))
    return out


@dataclass(frozen=True)
class Block:
    """Benchmark items that one pass over the documents looks for."""

    items: tuple[tuple[int | None, str], ...]
    key: str
    share: float

    def leaks(self, text):
        """The leaks in a text column: array of (item_id, start, end, edits)."""
        block = self

        @pandas_udf(LEAKS)
        def find(texts: pd.Series) -> pd.Series:
            index = _index(block)
            leaks = index.find_all(texts)
            rows = [[{"item_id": i, "start": s, "end": e, "edits": k} for i, s, e, k in some] for some in leaks]
            return pd.Series(rows, dtype=object)

        return find(text)


_INDEX: dict[str, Index] = {}


def _index(block: Block) -> Index:
    """The index of the block, kept by a worker until another block comes."""
    if block.key not in _INDEX:
        _INDEX.clear()
        _INDEX[block.key] = Index(list(block.items), block.share)
    return _INDEX[block.key]


def blocks(benchmark: DataFrame, share: float = EDIT_SHARE, block_chars: int = BLOCK_CHARS) -> Iterator[Block]:
    """The benchmark's distinct items in blocks of at most ``block_chars``
    characters (one item may exceed it).  Items without text are left out, those
    without an id are not."""
    rows = (
        benchmark.select("item_id", "text")
        .where(F.col("text").isNotNull())
        .distinct()
    )
    items, size = [], 0
    for row in rows.toLocalIterator():
        if items and size + len(row.text) > block_chars:
            yield _block(items, share)
            items, size = [], 0
        items.append((row.item_id, row.text))
        size += len(row.text)
    if items:
        yield _block(items, share)


def _block(items: list[tuple[int | None, str]], share: float) -> Block:
    items = sorted(items, key=lambda x: (*_null_last(x[0]), x[1]))
    return Block(tuple(items), hashlib.sha256(repr((items, share)).encode()).hexdigest(), share)


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per leak: doc_id, item_id, start, end (characters of the text, end
    exclusive) and edits of the best segment.  Items without an id count as one item.

    Documents without text have no leaks; repeated documents are reported each;
    an empty benchmark or an empty table gives no rows.  Other columns are ignored.
    """
    parts = []
    for block in blocks(benchmark, share, block_chars):
        found = docs.select("doc_id", F.explode(block.leaks(F.col("text"))).alias("leak")).select("doc_id", "leak.*")
        if parts:
            parts[-1] = materialize(parts[-1], "leaks")
        parts.append(found)
    if not parts:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, start bigint, end bigint, edits int")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no leak, all columns unchanged."""
    first = True
    for block in blocks(benchmark, share, block_chars):
        if not first:
            docs = materialize(docs, "clean")
        docs = docs.where(F.size(block.leaks(F.col("text"))) == 0)
        first = False
    return docs
