"""Clusters against plain Python: exact integers, ties, short tables, vectors that take no part."""

import hashlib
import math

import numpy as np

from panelspark.llm import clusters


def brute(rows, width=64, k=16, rounds=3):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == width and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [min(max(math.floor(64 * x), -clusters.REACH), clusters.REACH) for x in e]))
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    cent = [v for _, v in start[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(cent)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                cent[j] = [sum(c) // len(mine) for c in zip(*mine)]
    done = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in done)
    by = {j: sum(d for _, d, c in done if c == j) for j in range(len(cent))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted(((i, c, d, by[c], total, sha[c]) for i, d, c in done), key=str)


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], "vec_id long, embedding array<double>, cluster int, rid string")
    got = sorted((tuple(r) for r in clusters.cluster(df.repartition(5), **kw).collect()), key=str)
    assert got == brute(rows)


def test_clusters_against_plain_python(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), (rng.normal(size=64) * 0.2 + (i % 7)).tolist()) for i in range(300)]
    rows += rows[:5] + [(None, [0.5] * 64), (400, None), (401, [1.0] * 63), (402, [1.0] * 63 + [None]), (403, [float("nan")] * 64),
                        (404, [float("inf")] + [0.0] * 63), (405, []), (406, [-1e-9] * 64), (7, [3.0] * 64)]
    for bits in (2, 6):
        check(spark, rows, bits=bits)


def test_ties_small_tables_and_large_components(spark):
    check(spark, [(i, [float(i % 2)] * 64) for i in range(40)])
    check(spark, [(3, [1.0] * 64), (9, [2.0] * 64)])
    check(spark, [(i, [float(10 ** (i % 9))] * 32 + [-(10.0 ** (i % 30))] * 32) for i in range(60)])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert clusters.cluster(empty).count() == 0 and len(clusters.cluster(empty).columns) == 6
