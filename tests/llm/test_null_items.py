"""Benchmark items without an id."""

from daymatrix.llm import decontam

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards mix a boiling potion in the old tower"


def test_items_without_an_id_are_searched_for(spark, documents):
    items = spark.createDataFrame([(None, ITEM), (0, ITEM[::-1])], "item_id bigint, text string")
    docs = documents([(1, f"see {ITEM} there"), (2, "nothing of it"), (3, ITEM[::-1])])
    for block_chars in (10, 2_000_000):
        found = decontam.find_leaks(docs, items, block_chars=block_chars).collect()
        assert sorted((r.doc_id, r.item_id, r.edits) for r in found) == [(1, None, 0), (3, 0, 0)]
        assert [r.doc_id for r in decontam.without_leaks(docs, items, block_chars=block_chars).collect()] == [2]
