"""Groups of spelling variants, by neighbourhoods that Bloom filters have looked over.

Words are counted over all texts.  Two words are near if one code point inserted, deleted
or replaced makes one the other.  Every word's edits are generated, one of each pair of
edits that undo each other: deletions, and replacements by a letter of higher code.  They
are probed where they are made against Bloom filters of the vocabulary, one filter for
each length of word, each blocked so that a probe looks at 64 bytes; only what a filter
holds to be a word is shuffled, to a join with the vocabulary that removes its errors.

Filters are sent to all tasks, so their size is bounded: shards are dealt over passes of at
most ``PASS_BYTES``, a shard that exceeds it alone is split by a hash into parts, and a pass
probes the edits that belong to its shards.  A larger vocabulary takes more passes.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.text import crc_sql, record_batch
from daymatrix.session import materialize

MIN_LENGTH = 6  # code points of a word
MIN_COUNT = 5  # occurrences of a word
RATIO = 5  # a form occurs so many times as often as its variant
DROP_MODULUS = 199  # a code point is left out of a run whose hash this divides

WORD_BITS = 16  # of a filter, per word
PROBES = 6  # bits that a word sets in its block
BLOCK_WORDS = 8  # 64-bit words of a block
PASS_BYTES = 32 << 20
HELD_WORDS = 200_000  # distinct words a task counts before it hands them on
SLICE = 1 << 20  # characters of a text searched at once
PROBED_AT_ONCE = 1 << 20
WORDS_A_TASK = 20_000

_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}")
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")


def _slices(text: str) -> Iterator[str]:
    """Parts of a text that no run of letters crosses."""
    begin = 0
    while len(text) - begin > SLICE:
        cut = _BREAK.search(text, begin + SLICE)
        end = cut.start() if cut else len(text)
        yield text[begin:end]
        begin = end
    yield text[begin:] if begin else text


def spelled(run: bytes, doc: int) -> bytes:
    """The word a run (Latin-1, lower-cased) stands for in a document; ``doc`` is the CRC-32
    of what precedes the run in the hashed text."""
    h = zlib.crc32(run.decode("latin-1").encode(), doc)
    if h % DROP_MODULUS:
        return run
    gone = h % len(run)
    return run[:gone] + run[gone + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that occur often enough, counted over whole texts."""

    fields = {"word": pa.string(), "n": pa.int64()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for doc, text in zip(batch["id"].to_pylist(), batch["text"]):
                before = zlib.crc32(f"{doc}:".encode())
                for part in _slices(text.as_py()):
                    # Runs hold no code point above U+00FF, of which bytes.lower() changes A-Z only.
                    for run, n in Counter(_RUN.findall(part)).items():
                        word = spelled(run.encode("latin-1").lower(), before)
                        if len(word) >= MIN_LENGTH:
                            held[word] += n
                if len(held) > HELD_WORDS:
                    yield record_batch(((w.decode("latin-1"), n) for w, n in held.items()), fields)
                    held.clear()
        yield record_batch(((w.decode("latin-1"), n) for w, n in held.items()), fields)

    texts = docs.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text"
    )
    found = texts.mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# Hashes of words: a polynomial in the codes, so that an edit changes it by a sum, then mixed.

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray, by: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(by)
        return h ^ (h >> np.uint64(29))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE, dtype=np.uint64)]), dtype=np.uint64)


def _codes(words: list[str]) -> np.ndarray:
    """Codes of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1).astype(np.uint64)


def _hash(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (codes * _powers(codes.shape[1] - 1)[::-1]).sum(axis=1, dtype=np.uint64)


@dataclass(frozen=True)
class Shard:
    """The filter of the words of one length, or of one part of them by hash."""

    length: int
    part: int
    parts: int
    blocks: int

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Which hashes belong to this part."""
        if self.parts == 1:
            return np.ones(h.shape, dtype=bool)
        return _mixed(h, 0xD6E8FEB86659FD93) % np.uint64(self.parts) == self.part

    def block(self, h: np.ndarray) -> np.ndarray:
        return ((_mixed(h, 0xBF58476D1CE4E5B9) >> np.uint64(32)) * np.uint64(self.blocks) >> np.uint64(32)).astype(np.int64)

    @staticmethod
    def bit(h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Word and mask of the k-th bit of each hash in its block."""
        bits = _mixed(h, 0x94D049BB133111EB) >> np.uint64(8 + 9 * k)
        return ((bits >> np.uint64(6)) & np.uint64(BLOCK_WORDS - 1)).astype(np.int64), np.uint64(1) << (bits & np.uint64(63))


def shards(lengths: dict[int, int], pass_bytes: int = PASS_BYTES) -> list[list[Shard]]:
    """The shards of each pass, from the number of words of each length."""
    passes, held, room = [], [], 0
    block = 8 * BLOCK_WORDS
    for length, n in sorted(lengths.items()):
        size = max(1, -(-n * WORD_BITS // (8 * block)))
        parts = -(-size * block // pass_bytes)
        for part in range(parts):
            shard = Shard(length, part, parts, -(-size // parts))
            if held and room + shard.blocks * block > pass_bytes:
                passes.append(held)
                held, room = [], 0
            held.append(shard)
            room += shard.blocks * block
    return [*passes, held] if held else passes


def _of_one_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places and codes of the words of each length."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(sizes):
        rows = np.flatnonzero(sizes == length)
        yield int(length), rows, _codes([words[i] for i in rows])


def filters(vocabulary: DataFrame, wanted: list[Shard]) -> list[np.ndarray]:
    """The filters of some shards, (blocks, words of a block) each.  Tasks set the bits of
    their words, blocks are combined by OR, and what reaches the driver is the filters."""
    lanes = [f"w{k}" for k in range(BLOCK_WORDS)]

    fields = {"shard": pa.int32(), "block": pa.int64(), **dict.fromkeys(lanes, pa.int64())}

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, codes in _of_one_length(batch["word"].to_pylist()):
                for number, shard in enumerate(wanted):
                    if shard.length != length:
                        continue
                    h = _hash(codes)
                    h = h[shard.holds(h)]
                    bits = np.zeros((len(h), BLOCK_WORDS), dtype=np.uint64)
                    for k in range(PROBES):
                        lane, mask = shard.bit(h, k)
                        bits[np.arange(len(h)), lane] |= mask
                    columns = [np.full(len(h), number), shard.block(h), *bits.view(np.int64).T]
                    arrays = [pa.array(x, kind) for x, kind in zip(columns, fields.values())]
                    yield pa.RecordBatch.from_arrays(arrays, names=list(fields))

    schema = "shard int, block bigint, " + ", ".join(f"{lane} bigint" for lane in lanes)
    lengths = sorted({s.length for s in wanted})
    some = vocabulary.where(F.length("word").isin(lengths)).select("word").mapInArrow(fill, schema)
    found = some.groupBy("shard", "block").agg(*(F.bit_or(lane).alias(lane) for lane in lanes)).toArrow()
    number, block = found["shard"].to_numpy(), found["block"].to_numpy()
    bits = np.stack([found[lane].to_numpy() for lane in lanes], axis=1).view(np.uint64).reshape(-1, BLOCK_WORDS)
    out = [np.zeros((s.blocks, BLOCK_WORDS), dtype=np.uint64) for s in wanted]
    for k, filled in enumerate(out):
        filled[block[number == k]] = bits[number == k]
    return out


class _Filters:
    """The shards of a pass, as a task probes them."""

    def __init__(self, known: list[tuple[Shard, bytes]]):
        self.of: dict[int, list[tuple[Shard, np.ndarray]]] = {}
        for shard, data in known:
            held = np.frombuffer(data, dtype=np.uint64).reshape(-1, BLOCK_WORDS)
            self.of.setdefault(shard.length, []).append((shard, held))

    def positives(self, length: int, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that a filter of words of this length holds to be words."""
        found = [np.zeros(0, dtype=np.int64)]
        for shard, held in self.of.get(length, ()):
            at = np.flatnonzero(shard.holds(h))
            for k in range(PROBES):  # what one bit rules out is not looked up again
                lane, mask = shard.bit(h[at], k)
                at = at[held[shard.block(h[at]), lane] & mask != 0]
            found.append(at)
        return np.concatenate(found)


def _deletions(codes: np.ndarray, known: _Filters) -> Iterator[tuple[int, int, int]]:
    """(word, place, -1) of the deletions that may be words."""
    n, length = codes.shape
    if length - 1 not in known.of:
        return
    power = _powers(length)
    with np.errstate(over="ignore"):
        after = codes * power[length - 1 :: -1][:length]
        after = after.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(after, axis=1, dtype=np.uint64)
        before = np.zeros((n, length), dtype=np.uint64)
        before[:, 1:] = np.cumsum(codes[:, :-1] * power[: length - 1][::-1], axis=1, dtype=np.uint64)
    # Of equal neighbours either may go; the first does.
    first = np.ones((n, length), dtype=bool)
    first[:, 1:] = codes[:, 1:] != codes[:, :-1]
    word, place = np.nonzero(first)
    with np.errstate(over="ignore"):
        h = before[word, place] + after[word, place]
    for k in known.positives(length - 1, h):
        yield int(word[k]), int(place[k]), -1


def _replacements(codes: np.ndarray, alphabet: np.ndarray, known: _Filters) -> Iterator[tuple[int, int, int]]:
    """(word, place, letter) of the replacements by later letters that may be words."""
    n, length = codes.shape
    if length not in known.of:
        return
    power, h = _powers(length), _hash(codes)
    step = max(1, PROBED_AT_ONCE // max(1, n * len(alphabet)))
    for begin in range(0, length, step):
        some = codes[:, begin : begin + step]
        word, place, letter = np.nonzero(alphabet[None, None, :] > some[:, :, None])
        with np.errstate(over="ignore"):
            changed = h[word] + (alphabet[letter] - some[word, place]) * power[length - 1 - begin - place]
        for k in known.positives(length, changed):
            yield int(word[k]), int(place[k]) + begin, int(alphabet[letter[k]])


def candidates(vocabulary: DataFrame, wanted: list[Shard], alphabet: list[int]) -> DataFrame:
    """(word, n, edit) of one pass: edits of words that its filters hold to be words."""
    spark = vocabulary.sparkSession
    made = [(s, f.tobytes()) for s, f in zip(wanted, filters(vocabulary, wanted))]
    sent = spark.sparkContext.broadcast(made)
    letters = np.array(alphabet, dtype=np.uint64)

    fields = {"word": pa.string(), "n": pa.int64(), "edit": pa.string()}

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Filters(sent.value)
        for batch in batches:
            words, counts = batch["word"].to_pylist(), batch["n"].to_pylist()
            for length, rows, codes in _of_one_length(words):
                most = max(1, PROBED_AT_ONCE // (length * max(1, len(letters))))
                for begin in range(0, len(rows), most):
                    some, out = codes[begin : begin + most], []
                    for k, i, letter in [*_deletions(some, known), *_replacements(some, letters, known)]:
                        row, new = rows[begin + k], "" if letter < 0 else chr(letter)
                        out.append((words[row], counts[row], words[row][:i] + new + words[row][i + 1 :]))
                    yield record_batch(out, fields)

    lengths = sorted({s.length for s in wanted} | {s.length + 1 for s in wanted})
    some = vocabulary.where(F.length("word").isin(lengths))
    return some.mapInArrow(probe, "word string, n bigint, edit string")


def near_words(vocabulary: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(word, n, other, other_n), both ways, of all near words of a table (word, n) of
    distinct words of code points up to U+00FF."""
    counted = vocabulary.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("words"))
    lengths = {r["length"]: r["words"] for r in counted.collect()}
    letters = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    alphabet = sorted(ord(r["c"]) for r in letters.collect())  # 90 at most
    found = []
    for wanted in shards(lengths, pass_bytes):
        found.append(materialize(candidates(vocabulary, wanted, alphabet), "edits"))
    if not found:
        return vocabulary.sparkSession.createDataFrame([], "word string, n bigint, other string, other_n bigint")
    known = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    edits = reduce(DataFrame.unionByName, found).withColumnRenamed("edit", "other")
    pairs = materialize(edits.join(known, "other").select("word", "n", "other", "other_n"), "near")
    swapped = pairs.selectExpr("other AS word", "other_n AS n", "word AS other", "n AS other_n")
    return pairs.unionByName(swapped)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last one reached.  Each round
    doubles the steps taken; forms grow by ``RATIO`` at each step, so a few rounds do."""
    known = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(known.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        known = moved.select("word", "root")
        if moved.where(F.col("next").isNotNull()).isEmpty():
            return known


def variants(docs: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Null and empty texts hold no words; a null id is an empty one where it is hashed;
    repeated documents count each.  Of near words that occur equally often the form is the
    first in order of code points.  Without words there are no rows; other columns are
    ignored.
    """
    counted = materialize(word_counts(docs), "words")
    vocabulary = counted.repartition(max(1, -(-counted.count() // WORDS_A_TASK)), "word")
    near = near_words(vocabulary, pass_bytes)
    # The smallest of equally frequent words: the order of UTF-8 is that of code points.
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("word"))).alias("best")
    found = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    often = -F.col("best.rank")
    is_form = often >= F.col("n") * RATIO
    found = materialize(
        found.select("word", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, often).alias("form_n")),
        "forms",
    )
    roots = _roots(found.where(F.col("form").isNotNull()))
    return (
        counted.join(found, "word", "left")
        .join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
    )


ORACLE_SQL = f"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT id || ':' || run AS hashed, run, count(*) AS n FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, n, {crc_sql('hashed')} AS h FROM counted),
spelled AS (
    SELECT CASE WHEN h % {DROP_MODULUS} = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n
    FROM hashed),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
cut AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM words, unnest(range(1, length(word) + 1)) r(i)),
pairs AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT c.word, c.n, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
    UNION SELECT w.word, w.n, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest),
best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n
    FROM pairs GROUP BY word),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {RATIO} * w.n THEN other END AS form,
        CASE WHEN other_n >= {RATIO} * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word),
steps AS (
    SELECT word, word AS last, form AS ahead FROM forms
    UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON f.word = s.ahead)
SELECT f.word, f.form, s.last AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN steps s ON s.word = f.word AND s.ahead IS NULL"""
