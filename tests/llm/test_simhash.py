"""SimHash components against brute force."""

import random

import xxhash
from pyspark.sql import functions as F

from panelspark.llm import simhash


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows):
    best = list(range(len(rows)))

    def root(i):
        while best[i] != i:
            i = best[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 2:
                best[root(i)] = root(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    return [min((d for d in groups[root(i)] if d is not None), default=None) for i in range(len(rows))]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    edge = spark.createDataFrame([(None, "a b c d"), (9001, None), (9002, " \n"), (9003, "One"), (9003, "one")],
                                 "doc_id long, text string").withColumns({"_fp": F.lit(1), "class": F.lit("x")})
    docs = docs.select("doc_id", "text").unionByName(edge, allowMissingColumns=True)
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in docs.collect()]
    want = sorted((str(d), f"{fp:016x}", str(c)) for (d, fp), c in zip(rows, slow_components(rows)))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(
        docs.drop("_fp")).collect())
    assert got == want
    kept = simhash.keep_one(docs.select("doc_id", "text"))
    assert kept.count() == len({w[2] for w in want if w[2] != "None"}) + sum(w[2] == "None" for w in want)


def test_links_cold_and_hot(spark, monkeypatch):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(20)] + [0, 2 ** 64 - 1]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 3))) for b in base for _ in range(30)}
    fps |= {(7 << 32) | rng.getrandbits(6) for _ in range(60)} | {(rng.getrandbits(6) << 40) | 5 for _ in range(60)}
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    want = sorted((min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i]
                  if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 2)
    prints = spark.createDataFrame([(s,) for s in signed], "fp long")
    for limit in (64, 3, 0):
        monkeypatch.setattr(simhash, "HOT_BUCKET", limit)
        assert sorted((r.a, r.b) for r in simhash.links(prints).collect()) == want


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0
