"""Equal pieces spread over the groups of packing."""

from daymatrix.llm import packing


def test_equal_pieces_spread_over_groups(spark):
    rows = [(None, 0, 0, 1, 7)] * 10_000 + [(i, 0, 0, 5, i) for i in range(100)]
    found = spark.createDataFrame(rows, packing.PIECES)
    packed = packing.pack(found, 4, 64).collect()
    assert len(packed) == len(rows)
    assert sorted((r.doc_id or -1, r.length) for r in packed) == sorted((r[0] or -1, r[3]) for r in rows)
    many = [sum(r.doc_id is None and r.sequence_id % 4 == g for r in packed) for g in range(4)]
    assert min(many) > 2_000
    places = sorted((r.sequence_id, r.offset, r.length) for r in packed)
    assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(places, places[1:]))
