"""Best-fit packing with several groups and merge rounds."""

import random

from panelspark.llm import packing


def test_merge_rounds(spark):
    rng = random.Random(3)
    rows = [(i, i, 0, 0, min(2048, int(rng.expovariate(1 / 400)) + 1), 7) for i in range(3000)]
    pieces = spark.createDataFrame(rows, packing.PIECES)
    out = packing.pack(pieces, group_items=64, fan_in=3).collect()
    assert sorted(r.doc_id for r in out) == list(range(3000))
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(bins) <= 1.02 * -(-sum(r[4] for r in rows) // 2048) + 1
