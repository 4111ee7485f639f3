"""License scan by diagonal voting, with DataFrame operations only.

All rolling word pairs of every text are joined with the word pairs of the license
templates.  Every match votes for a diagonal, the place of the template's first word
in the text.  Votes are counted per diagonal, neighbouring diagonals (words put in or
left out) are merged, and the span that a well-voted diagonal points at is verified by
its edit distance from the template.  A phrase is a template that has to be met word
for word.

The templates are a few hundred rows of constants, so that side of the join is sent
to every executor; texts are exploded and matched in one stage, and only matches and
one row per document are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymatrix.llm.text import let

#: What separates words: every ASCII character but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NEAR = 3  # diagonals apart that still belong together
MIN_VOTES = 0.6  # share of a template's pairs that must vote; all of them in ...
SHORT = 12  # ... templates of fewer words, where each word matters
MAX_DISTANCE = 0.2  # edits per character of the template

# Phrases and the label of each.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Passages of public license texts and the label each gives besides those above.
TEMPLATES = [
    ("agpl", "gnu affero general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("mpl", "mozilla public license"),
    ("bsd", "bsd license"),
    ("cc0", "cc0 1 0 universal"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc-by-nd", "licensed under cc by nd"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit-text", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-text", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("apache-text", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("mpl-text", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense-text", "this is free and unencumbered software released into the public domain"),
]


def words(text: Column) -> Column:
    """Words as written; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def pairs(found: Column) -> Column:
    """A hash of every two successive words, letter case ignored."""

    def joined(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - 2),
            lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1)),
        )

    hashes = let(F.transform(found, lambda w: F.xxhash64(F.lower(w))), joined)
    return F.when(F.size(found) >= 2, hashes).otherwise(F.array().cast("array<bigint>"))


def templates(spark: SparkSession, phrases: dict[str, str] = PHRASES, texts: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per template and pair: template, label, exact, body, m (words), at, pair."""
    rows = [(label, True, body) for body, label in phrases.items()] + [(label, False, body) for label, body in texts]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "template int, label string, exact boolean, body string")
    table = table.withColumn("w", words(F.col("body")))
    return table.select(
        "template", "label", "exact", "body", F.size("w").alias("m"), F.posexplode(pairs(F.col("w"))).alias("at", "pair")
    )


def spans(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Verified spans and one row without label per document: doc_id, copy, n_words, rows,
    label, exact, first (word the span starts with) and similarity.

    ``copy`` tells texts apart that share a doc_id; ``rows``, in the row without label, is
    how many rows repeat both.
    """
    cut = docs.select("doc_id", F.xxhash64("text").alias("copy"), words(F.col("text")).alias("w"))
    # The first entry stands for the row itself and matches nothing.
    every = F.concat(F.array(F.lit(None).cast("bigint")), pairs(F.col("w")))
    pair = cut.select("doc_id", "copy", "w", F.size("w").alias("n_words"), F.posexplode(every).alias("pos", "pair"))
    pair = pair.withColumn("pos", F.col("pos") - 1)
    hits = (
        pair.join(F.broadcast(known), "pair", "left")
        .where("template IS NOT NULL OR pos < 0")
        .select(
            "doc_id", "copy", "n_words", "template", "label", "exact", "body", "m", "at",
            (F.col("pos") - F.col("at")).alias("diagonal"),
            F.when(
                F.col("exact") == F.lit(False),
                F.lower(F.array_join(F.slice("w", F.greatest(F.col("pos") - F.col("at"), F.lit(0)) + 1, F.col("m") + NEAR), " ")),
            ).alias("span"),
        )
    )
    voted = hits.groupBy("doc_id", "copy", "n_words", "template", "label", "exact", "body", "m", "diagonal").agg(
        F.collect_set("at").alias("at"), F.min("span").alias("span"), F.count("*").alias("rows")
    )
    place = Window.partitionBy("doc_id", "copy", "template").orderBy("diagonal")
    new = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(place) > NEAR)
    merged = (
        voted.withColumn("new", F.coalesce(new.cast("int"), F.lit(1)))
        .withColumn("place", F.sum("new").over(place))
        .groupBy("doc_id", "copy", "n_words", "template", "label", "exact", "body", "m", "place")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("votes"),
            F.max_by("diagonal", F.size("at")).alias("first"),
            F.max_by("span", F.size("at")).alias("span"),
            F.sum("rows").alias("rows"),
        )
    )
    # The span has a few words to spare behind the template; they do not count.
    extra = F.greatest(F.length("span") - F.length("body"), F.lit(0))
    distance = F.levenshtein("body", F.left("span", F.length("body") + F.least(extra, F.lit(NEAR))))
    similarity = F.when(F.col("exact"), F.lit(1.0)).otherwise(1 - distance / F.length("body"))
    good = F.when(F.col("exact"), F.col("votes") == F.col("m") - 1).otherwise(
        (F.col("votes") >= F.ceil((F.col("m") - 1) * F.when(F.col("m") < SHORT, F.lit(1.0)).otherwise(F.lit(MIN_VOTES))))
        & (similarity >= 1 - MAX_DISTANCE)
    )
    return merged.select(
        "doc_id", "copy", "n_words", F.when(F.col("template").isNull(), F.col("rows")).alias("rows"),
        *[F.when(good, F.col(c)).alias(c) for c in ("label", "exact", "first")],
        F.when(good, similarity).alias("similarity"),
    )


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels and score (best similarity, 0 without any).

    Null and empty texts have no words.  Rows that repeat id or text are reported each; an
    empty table gives no rows.  Of spans equally similar all labels count, and of phrases
    the smallest and the largest place.  Other columns are ignored.
    """
    known = templates(docs.sparkSession) if known is None else known
    base = F.col("exact")

    def names(c: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(c)), ",")

    return (
        spans(docs, known)
        .groupBy("doc_id", "copy")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
            names(F.when(base, F.col("label"))).alias("base_labels"),
            names(F.col("label")).alias("labels"),
            F.coalesce(F.max("similarity"), F.lit(0.0)).alias("score"),
            F.max("rows").alias("rows"),
        )
        .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
        .drop("copy", "rows", "nth")
    )
