"""Line-first quality rules, as column expressions only.

A text is cut into lines.  Lines that fail a rule are removed: lines of mostly
punctuation, navigation lines, boilerplate lines.  A document is rejected when the
lines that remain hold too little of its text, or when the whole text already fails
one of the document rules.  No expression leaves the row, so nothing is shuffled.

A null text counts as a text without words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymatrix.llm.text import SPACE, let

MIN_WORDS = 20
WINDOW = 8  # words of a repeated passage
MAX_REPEAT_PERCENT = 30
MAX_PUNCTUATION_PERCENT = 25  # of the characters of a line that are not white space
MIN_KEPT_PERCENT = 60  # of the characters of a document that are not white space
MAX_BARS = 3
MIN_BARS_PERCENT = 25  # of the words of a line that bars make a navigation line
MAX_BOILERPLATE_WORDS = 15  # of a line that one phrase makes boilerplate
MAX_BOILERPLATE_PERCENT = 20  # of the characters of a longer line
MENU = "home|menu|login|log in|sign in|sign up|search|next|previous|back to top|read more|share|contact|about us|sitemap"
BOILERPLATE = (
    "all rights reserved|terms of use|terms of service|privacy policy|cookie policy|accept cookies|"
    "uses cookies|enable javascript|javascript is disabled|subscribe to our newsletter|"
    "click here|lorem ipsum|powered by wordpress"
)


def words(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^#*$%&|<>]+", "")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    )
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(found: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that the text holds twice or more.

    Windows are compared by a 64-bit hash of their words' hashes.  Most texts repeat
    no window; only those that do are sorted.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def starts(p: Column) -> Column:
            return F.array_sort(
                F.transform(
                    F.filter(
                        p,
                        lambda x, j: ((j > 0) & (F.get(p, j - 1)["h"] == x["h"]))
                        | (F.coalesce(F.get(p, j + 1)["h"] == x["h"], F.lit(False))),
                    ),
                    lambda x: x["i"],
                )
            )

        def total(s: Column) -> Column:
            return F.aggregate(
                F.transform(
                    s,
                    lambda x, j: F.least(
                        F.lit(window), F.coalesce(F.get(s, j + 1) - x, F.lit(window))
                    ),
                ),
                F.lit(0).cast("long"),
                lambda a, b: a + b,
            )

        return let(pairs, lambda p: let(starts(p), total))

    def windows(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - window),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]),
        )

    def count(w: Column) -> Column:
        return let(
            F.transform(w, lambda x: F.xxhash64(x)),
            lambda h: let(
                windows(h),
                lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), F.lit(0).cast("long")).otherwise(covered(x)),
            ),
        )

    return F.when(F.size(found) < window, F.lit(0).cast("long")).otherwise(count(found))


def line_is_text(line: Column) -> Column:
    """Whether a line survives the punctuation, navigation and boilerplate rules.

    Combining marks are letters, bars and boilerplate phrases are weighed against the
    length of the line, and guillemets that pair up are quotes.  Lines without a word
    pass; they hold no text.
    """
    low = F.lower(line)
    n_words = F.size(F.split(F.regexp_replace(line, r"[|»›«‹•]+", " "), r"[\p{L}\p{M}\p{N}][^\x20\x09-\x0D]*")) - 1
    chars = F.length(F.regexp_replace(line, SPACE, ""))
    marks = F.length(F.regexp_replace(line, r"[\p{L}\p{M}\p{N}\x20\x09-\x0D]+", ""))
    count = lambda c: F.length(F.regexp_replace(line, f"[^{c}]+", ""))
    unpaired = lambda close, open_: F.greatest(count(close) - count(open_), F.lit(0))
    bars = count("|•") + unpaired("»", "«") + unpaired("›", "‹")
    phrases = F.length(low) - F.length(F.regexp_replace(low, BOILERPLATE, ""))
    return ~(
        (marks * 100 > chars * MAX_PUNCTUATION_PERCENT)
        | ((bars >= MAX_BARS) & (bars * 100 >= n_words * MIN_BARS_PERCENT))
        | low.rlike(rf"^[\x20\x09-\x0D]*({MENU})[\x20\x09-\x0D]*$")
        | ((phrases > 0) & ((n_words <= MAX_BOILERPLATE_WORDS) | (phrases * 100 >= F.length(low) * MAX_BOILERPLATE_PERCENT)))
    )


def clean_text(text: Column, passes: Callable[[Column], Column] = line_is_text) -> Column:
    """The text with its failing lines removed; null stays null."""
    return F.array_join(F.filter(F.split(text, "\n"), passes), "\n")


def rules(text: Column, passes: Callable[[Column], Column] = line_is_text) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    kept_chars (of the cleaned text), base_failed and kept."""

    def numbers(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            word_chars(text).alias("word_chars"),
            n_symbols(text).alias("n_symbols"),
            n_dup_lines(text).alias("n_dup_lines"),
            n_repeat_words(w).alias("n_repeat_words"),
            word_chars(clean_text(text, passes)).alias("kept_chars"),
        )

    def verdict(n: Column) -> Column:
        failed = (n["n_words"] < MIN_WORDS) | (
            n["n_repeat_words"] * 100 > n["n_words"] * MAX_REPEAT_PERCENT
        )
        enough = n["kept_chars"] * 100 >= n["word_chars"] * MIN_KEPT_PERCENT
        return F.struct(
            n.alias("n"), failed.alias("base_failed"), (~failed & enough).alias("kept")
        )

    return let(let(words(text), numbers), verdict)


def apply_rules(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the numbers above, base_failed and kept.
    Null and empty texts have no words and fail.  A number that equals its limit passes.
    Repeated documents are reported each; an empty table gives no rows; other columns are
    ignored."""
    found = docs.select("doc_id", rules(F.col("text")).alias("r"))
    return found.select("doc_id", "r.n.*", "r.base_failed", "r.kept")


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents with their failing lines removed, all other columns unchanged."""
    return docs.withColumn("text", clean_text(F.col("text")))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, all columns and their text unchanged."""
    return docs.where(rules(F.col("text"))["kept"])


ORACLE_SQL = rf"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    string_split(coalesce(text, ''), chr(10)) AS lines,
    row_number() OVER () AS r
  FROM documents
), windows AS (
  SELECT r, i, list_slice(words, i, i + {WINDOW - 1}) AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM cut WHERE len(words) >= {WINDOW})
), twice AS (
  SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n FROM twice GROUP BY r
), lines AS (
  SELECT r, k, line, lower(line) AS low,
    length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    length(regexp_replace(line, '[\p{{L}}\p{{M}}\p{{N}}\x20\x09-\x0D]+', '', 'g')) AS marks,
    length(regexp_replace(line, '[^|\x{{2022}}]+', '', 'g'))
      + greatest(length(regexp_replace(line, '[^\x{{00BB}}]+', '', 'g')) - length(regexp_replace(line, '[^\x{{00AB}}]+', '', 'g')), 0)
      + greatest(length(regexp_replace(line, '[^\x{{203A}}]+', '', 'g')) - length(regexp_replace(line, '[^\x{{2039}}]+', '', 'g')), 0) AS bars,
    len(regexp_extract_all(regexp_replace(line, '[|\x{{00BB}}\x{{203A}}\x{{00AB}}\x{{2039}}\x{{2022}}]+', ' ', 'g'),
      '[\p{{L}}\p{{M}}\p{{N}}][^\x20\x09-\x0D]*')) AS n_words,
    row_number() OVER (PARTITION BY r, line ORDER BY k) AS nth
  FROM (SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS k FROM cut)
), weighed AS (
  SELECT *, length(low) - length(regexp_replace(low, '{BOILERPLATE}', '', 'g')) AS phrases FROM lines
), kept AS (
  SELECT r,
    sum(CASE WHEN marks * 100 > chars * {MAX_PUNCTUATION_PERCENT}
      OR bars >= {MAX_BARS} AND bars * 100 >= n_words * {MIN_BARS_PERCENT}
      OR regexp_matches(low, '^[\x20\x09-\x0D]*({MENU})[\x20\x09-\x0D]*$')
      OR phrases > 0 AND (n_words <= {MAX_BOILERPLATE_WORDS} OR phrases * 100 >= length(low) * {MAX_BOILERPLATE_PERCENT})
      THEN 0 ELSE chars END) AS kept_chars,
    sum(CASE WHEN chars > 0 AND nth > 1 THEN 1 ELSE 0 END) AS n_dup_lines
  FROM weighed GROUP BY r
), numbers AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
  FROM cut LEFT JOIN repeats USING (r) LEFT JOIN kept USING (r)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed FROM numbers
)
SELECT *, NOT base_failed AND kept_chars * 100 >= word_chars * {MIN_KEPT_PERCENT} AS kept FROM judged
"""
