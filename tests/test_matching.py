"""Phrase search and topic search against plain Python, across shards, lanes and blocks."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from panelspark.operators import matching as mt
from panelspark.operators import news as nw


def test_automaton_finds_overlapping_and_nested_phrases():
    rng = random.Random(3)
    phrases = sorted({"".join(rng.choice("ab é") for _ in range(rng.randint(1, 6))) for _ in range(60)})
    texts = ["".join(rng.choice("ab é") for _ in range(rng.randint(0, 300))) for _ in range(40)] + ["", None, "xyz"]
    a = mt.Automaton([p.encode() for p in phrases])
    got = {(t, phrases[i]) for t, s in zip(*map(np.ndarray.tolist, a.search(pa.array(texts)))) for i in a.found_at(s)}
    assert got == {(i, p) for i, t in enumerate(texts) for p in phrases if t is not None and p in t}


def test_phrases_across_lanes():
    text = "x" * (mt.LANE - 3) + "needle" + "y" * (3 * mt.LANE) + "needle"
    a = mt.Automaton([b"needle", b"yyyy", b"dlen"])
    texts, states = a.search(pa.array(["short", text]))
    assert set(texts.tolist()) == {1} and {i for s in states.tolist() for i in a.found_at(s)} == {0, 1}


def test_substrings_with_many_shards(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeł") for _ in range(4)) for _ in range(500)]
    texts = [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(60)] + [(60, None), (61, "")]
    aliases = [(k % 97, w[rng.randint(0, 1):]) for k, w in enumerate(words)] + [(1, "  "), (2, None), (3, "zz top")]
    news = spark.createDataFrame(texts, "id int, text string")
    pats = spark.createDataFrame(aliases, "company_id int, alias string")
    want = {(i, c) for i, t in texts for c, a in aliases if t and a and a.strip() and a.lower() in t.lower()}
    for shard_bytes in (mt.SHARD_BYTES, 200):
        low = news.select("id", F.lower("text").alias("t"))
        found = mt.holding(low, "id", "t", pats.select("company_id", F.lower("alias").alias("a")).where("trim(a) <> ''"),
                           "a", "company_id", shard_bytes).collect()
        assert len(found) == len(want) and {tuple(r) for r in found} == want
    assert {tuple(r) for r in nw.alias_substrings(news, pats).collect()} == want
    assert nw.alias_substrings(news, pats.limit(0)).count() == 0 and nw.alias_substrings(news.limit(0), pats).count() == 0


def test_best_topic_over_blocks_and_ties(spark):
    rng = np.random.default_rng(2)
    tags = [(int(i), rng.normal(size=6).tolist()) for i in range(200)]
    tags += [(900, tags[7][1]), (3000, [0.0] * 6), (3001, None), (3002, [1.0] * 5)]
    arts = [(i, rng.normal(size=6).tolist()) for i in range(50)] + [(50, tags[7][1]), (51, None), (52, [0.0] * 6)]
    t, a = spark.createDataFrame(tags, "id int, vector array<double>"), spark.createDataFrame(arts, "id int, vector array<double>")
    for size in (1 << 24, 1000):
        got = {r.news_article_id: (r.context_tag_id, r.confidence_score) for r in nw.best_topic(a, t, block_bytes=size).collect()}
        assert got[50][0] == 7 and got[51] == (None, None) and got[52] == (None, None)
        for i, v in arts[:51]:
            v = np.array(v)
            s, best = max((float(v @ np.array(u) / np.linalg.norm(v) / np.linalg.norm(u)), -k) for k, u in tags
                          if u and len(u) == 6 and any(u))
            assert got[i][0] == -best or abs(got[i][1] - s) < 1e-12
            assert abs(got[i][1] - s) < 1e-12
    assert nw.best_topic(a, t.limit(0)).where("context_tag_id IS NOT NULL").count() == 0


def test_large_batches_are_searched_in_slices(monkeypatch):
    import pyarrow as pa

    from panelspark.operators import matching
    monkeypatch.setattr(matching, "SLICE_BYTES", 64)
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["x" * 60, None, "ab" * 20, "", "b" * 200, "ab"])], ["_id", "_t"])
    parts = list(matching._slices(batch))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1, 2], [3, 4], [5]]
    assert list(matching._slices(batch.slice(0, 0))) == []
    sent = type("Sent", (), {"value": (matching.Automaton([b"ab", b"b"]), [[1], [2]])})
    out = pa.Table.from_batches(matching._searcher(sent, pa.int64())(iter([batch])))
    assert out.to_pydict() == {"_id": [2, 2, 4, 5, 5], "_v": [1, 2, 2, 1, 2]}
    seen = []
    monkeypatch.setattr(matching.Automaton, "search", lambda self, c, old=matching.Automaton.search: seen.append(len(c)) or old(self, c))
    list(matching._searcher(sent, pa.int64())(iter([batch])))
    assert seen == [3, 2, 1]
