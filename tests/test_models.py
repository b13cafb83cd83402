"""Grouped forests against plain Python, selections per key, the purged split and the classifier."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import forests as fs
from panelspark.operators import models as md

D = dt.date


def grouped(spark, n=400, groups=(3, 8, 9)):
    rng = np.random.default_rng(1)
    rows = []
    for g in groups:
        for i in range(n if g != 9 else 5):
            x = rng.normal(size=3)
            y = {3: 3 * x[0], 8: np.sign(x[1]) * 2 + x[0], 9: x[2]}[g] + 0.1 * rng.normal()
            rows.append((g, i, *map(float, x), float(y)))
    rows += [(3, -1, 1.0, 1.0, 1.0, None), (None, -2, 1.0, 1.0, 1.0, 1.0), (8, -3, None, 0.5, float("nan"), 0.5)]
    return spark.createDataFrame(rows, "g int, i int, a double, b double, c double, y double")


def test_best_splits_against_brute_force(spark):
    rows = fs.binned(grouped(spark), "g", ["a", "b", "c"], "y", ["g", "i"], bins=8)
    data = rows.collect()
    assert {r.grp for r in data} == {3, 8, 9} and all(0 <= x <= 8 for r in data for x in r.b)
    got = fs.splits(rows, [3, 8, 9], 3, 2, 3, seed=5, bins=8)
    for k, g in enumerate([3, 8, 9]):
        mine = [r for r in data if r.grp == g]
        rid, y, b = np.array([r.rid for r in mine]), np.array([r.y for r in mine]), np.array([r.b for r in mine])
        for tree in range(2):
            w = fs._weights(rid, tree, 5)
            node = np.zeros(len(mine), int)
            for level in range(3):
                for n in sorted(set(node[node >= 0].tolist())):
                    at = (node == n) & (w > 0)
                    best = None
                    for f in range(3):
                        for cut in range(9):
                            left, right = at & (b[:, f] <= cut), at & (b[:, f] > cut)
                            if w[left].sum() and w[right].sum():
                                part = lambda m: (w[m] * y[m]).sum() ** 2 / w[m].sum()
                                gain = round(part(left) + part(right) - part(at), 9)
                                if gain > 1e-9 and (best is None or gain > best[0] + 1e-7):
                                    best = (gain, f, cut)
                    mine_ = [s for s in got if s[:3] == (k, tree, n)]
                    if best is None:
                        assert not mine_
                        node[node == n] = -1
                        continue
                    (_, _, _, f, cut, gain), = mine_
                    assert abs(gain - best[0]) < 1e-6
                    on = node == n
                    node[on] = 2 * n + 1 + (b[on, f] > cut)


def test_weights_are_draws_with_replacement():
    w = fs._weights(np.arange(200_000), 3, 7)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and not np.array_equal(w, fs._weights(np.arange(200_000), 4, 7))


def test_shadows_stay_in_their_group(spark, monkeypatch):
    monkeypatch.setattr(fs, "SHADOW_ROWS", 50)
    rows = fs.binned(grouped(spark), "g", ["a", "b"], "y", ["g", "i"])
    out = fs.with_shadows(rows, 3).collect()
    for g in (3, 8, 9):
        mine = [r for r in out if r.grp == g]
        assert sorted(tuple(r.b[:2]) for r in mine) == sorted(tuple(r.b[2:]) for r in mine)
    assert sum(r.b[:2] != r.b[2:] for r in out) > 0.9 * len(out)


def test_selection_of_each_group(spark):
    found = fs.keyed_selection(grouped(spark), "g", ["a", "b", "c"], "y", ["g", "i"], rounds=9, trees=3, depth=3)
    chosen = {(r.g, r.feature) for r in found.where("selected").collect()}
    assert chosen >= {(3, "a"), (8, "b")} and not chosen & {(3, "b"), (3, "c"), (8, "c")}
    assert found.count() == 9
    records = fs.selection_records(found, "g", F.lit("2024-01-01").cast("date")).collect()
    assert {r.total_features for r in records} == {3} and all(r.sector_id is None for r in records)
    assert fs.keyed_selection(grouped(spark).limit(0), "g", ["a"], "y", ["g", "i"], rounds=2, trees=1, depth=1).count() == 0


def test_purged_split_and_classifier(spark):
    rng = np.random.default_rng(3)
    rows = [(c, D(2020, 1, 1) + dt.timedelta(days=i), float(x), int(x + 0.3 * rng.normal() > 0.4))
            for c in range(4) for i, x in enumerate(rng.normal(size=200))]
    df = spark.createDataFrame(rows + [(9, D(2020, 7, 18), None, 1)], "company_id int, date date, x double, y int")
    parts = md.class_weights(md.purged_parts(df, min_train=100, gap=20), "y")
    got = parts.collect()
    assert len(got) == 801
    ends = {p: (min(r.position for r in got if r.part == p), max(r.position for r in got if r.part == p)) for p in ("train", "stop", "gap", "valid")}
    cut = int(801 * 0.8)
    assert ends == {"train": (0, int((cut - 20) * 0.9) - 1), "stop": (int((cut - 20) * 0.9), cut - 21), "gap": (cut - 20, cut - 1), "valid": (cut, 800)}
    train = [r for r in got if r.part == "train"]
    pos = sum(r.y for r in train)
    scale = max(1, (len(train) - pos) / max(1, pos))
    n = {c: sum(r.company_id == c for r in train) for c in range(4)}
    assert all(abs(r.weight - (scale if r.y else 1) / n[r.company_id]) < 1e-12 for r in train)
    assert {r.weight for r in got if r.part != "train"} == {1.0}
    model = md.fit_gbt_classifier(parts, ["x"], "y", max_iter=8, depth=2, step=0.3)
    scored = md.predict_class(model, parts.where("part = 'valid'"))
    assert scored.where("company_id = 9").first().score is None and scored.columns == [*parts.columns, "score"]
    hit = scored.where("score IS NOT NULL").agg(F.avg(((F.col("score") > 0.5) == (F.col("y") == 1)).cast("int"))).first()[0]
    assert hit > 0.75 and scored.count() == 161


def test_predictions_keep_incomplete_rows(spark):
    rows = [(i, float(i % 7), float(i % 3), float(i % 7) * 2 - i % 3) for i in range(90)]
    df = spark.createDataFrame(rows + [(100, None, 1.0, 0.0), (101, 1.0, None, 0.0)], "i int, a double, b double, y double")
    for model in (md.fit_ridge(df, ["a", "b"], "y", 1e-6), md.fit_gbt(df, ["a", "b"], "y", max_iter=10, depth=3, step=0.5)):
        out = {r.i: r.pred for r in md.predict(model, df, ["a", "b"]).collect()}
        assert out[100] is None and out[101] is None and len(out) == 92
        assert np.mean([abs(out[i] - y) for i, _, _, y in rows]) < 0.5


def _noisy(spark, n=900):
    rng = np.random.default_rng(7)
    rows = [(i, *map(float, x), float(3 * x[0] + rng.normal())) for i, x in enumerate(rng.normal(size=(n, 6)))]
    return spark.createDataFrame(rows + [(-1, None, 1.0, 1.0, None, 1.0, 1.0, 2.0), (-2, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, None)],
                                 "i int, a double, b double, c double, d double, e double, f double, y double")


def test_a_selection_does_not_depend_on_the_layout(spark, monkeypatch):
    levels = []
    best = fs.best_splits
    monkeypatch.setattr(fs, "best_splits", lambda sums: levels.append(1) or best(sums))
    names = ["a", "b", "c", "d", "e", "f"]
    found = [md.shadow_selection(_noisy(spark).repartition(n), names, "y", ["i"], rounds=7, trees=4, depth=3).collect() for n in (1, 5)]
    assert found[0] == found[1] and len(levels) == 2 * 3  # all rounds share the pass of a level
    assert [r.hits for r in found[0] if r.feature == "a"] == [7] and all(r.hits < 7 for r in found[0] if r.feature != "a")


def test_blocks_hold_every_row_once(spark, monkeypatch):
    monkeypatch.setattr(fs, "BLOCK_ROWS", 64)
    df = _noisy(spark).withColumn("k", F.when(F.col("i") % 2 == 0, F.lit(None).cast("int")).otherwise(F.col("i")))  # half of the ids equal
    out = fs.random_blocks(df.where("y IS NOT NULL"), ["a", "d"], "y", ["k"], bins=8).collect()
    assert len({(r.block, r.chunk) for r in out}) == len(out) > 14 and max(len(r.y) // 8 for r in out) <= 128
    y = np.concatenate([np.frombuffer(r.y) for r in out])
    assert len(y) == 901 and abs(y.mean()) < 1e-9
    b = np.concatenate([np.frombuffer(r.b, np.uint8).reshape(-1, 2) for r in out])
    assert len(b) == 901 and (b == 8).sum(axis=0).tolist() == [1, 1] and np.bincount(b[:, 0], minlength=9)[:8].min() > 90


def test_forest_gains_against_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(fs, "BLOCK_ROWS", 300)
    df = _noisy(spark).where("y IS NOT NULL")
    blocks = fs.random_blocks(df, ["a", "b"], "y", ["i"], bins=8)
    got = fs.shadow_gains(blocks, 2, 3, 1, 2, 5, bins=8)
    lots, fs.DENSE_CELLS = fs.DENSE_CELLS, 0  # a round at a time
    try:
        alone = fs.shadow_gains(blocks, 2, 3, 1, 2, 5, bins=8)
    finally:
        fs.DENSE_CELLS = lots
    assert np.allclose(got, alone) and np.allclose(got.sum(axis=1), 1)
    for r in range(3):
        x, y, w = [], [], []
        for row in blocks.collect():
            n = len(row.y) // 8
            b = np.frombuffer(row.b, np.uint8).reshape(n, -1)
            x.append(np.concatenate([b, b[np.random.default_rng([5, r, row.block, row.chunk]).permutation(n)]], axis=1))
            y.append(np.frombuffer(row.y))
            w.append(fs._DRAWN[np.random.default_rng([5, r, row.block, row.chunk, 1]).integers(0, 1 << 16, n, np.uint16)])
        x, y, w = map(np.concatenate, (x, y, w))
        gain = np.zeros(4)

        def grow(on, level, gain=gain, x=x, y=y, w=w):
            part = lambda m: (w[m] * y[m]).sum() ** 2 / w[m].sum()
            best = max(((part(on & (x[:, f] <= c)) + part(on & (x[:, f] > c)) - part(on), -f, -c) for f in range(4) for c in range(9)
                        if w[on & (x[:, f] <= c)].sum() and w[on & (x[:, f] > c)].sum()), default=None)
            if best and best[0] > 1e-9:
                gain[-best[1]] += best[0]
                if level:
                    grow(on & (x[:, -best[1]] <= -best[2]), level - 1)
                    grow(on & (x[:, -best[1]] > -best[2]), level - 1)
        grow(np.ones(len(y), bool), 1)
        assert np.allclose(got[r], gain / gain.sum(), atol=1e-6)


def test_ridge_is_one_pass_and_solves_its_equations(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3)) * [1.0, 50.0, 1e-3] + [0.0, 1e4, 5.0]
    y = x @ [0.5, 0.02, 100.0] + rng.normal(size=500)
    rows = [(*map(float, a), 7.0, float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 7.0, 1.0), (1.0, 1.0, 1.0, 7.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double, y double").repartition(6)
    spark.sparkContext.setJobGroup("ridge", "ridge")
    model = md.fit_ridge(df, ["a", "b", "c", "k"], "y", 0.1)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("ridge")) == 2  # the shuffle asked for above, and one pass
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    want = np.linalg.solve(z.T @ z / 500 + 0.1 / y.std() * np.eye(3), z.T @ (y - y.mean()) / 500)
    assert np.allclose(model.coefficients, [*want, 0.0], rtol=1e-9)
    out = md.predict(model, df, ["a", "b", "c", "k"]).collect()
    assert sum(r.pred is None for r in out) == 1 and len(out) == 502
    at = {r.a: r.pred for r in out if r.y is not None}
    assert np.allclose([at[float(a[0])] for a in x], z @ want + y.mean(), rtol=1e-9)


def test_moments_from_lags_are_those_of_frames(spark):
    from panelspark.operators import windows as tw
    from panelspark.plans import frames
    rng = np.random.default_rng(2)
    rows = [(c, D(2024, 1, 1) + dt.timedelta(days=i), None if i == 20 else float(x)) for c in (1, 2) for i, x in enumerate(rng.uniform(50, 90, 45))]
    df, w = spark.createDataFrame(rows, "company_id int, date date, close double"), tw.series()
    out, names = frames._returns(df, 10, (5, 10, 21), w, {"later": F.lead("close").over(w)})
    assert out.columns == [*df.columns, "r", *names, "later"] and names[10:] == ["r_ma_5", "r_ma_10", "r_ma_21", "r_std_5", "r_std_10", "r_std_21"]
    assert out._jdf.queryExecution().executedPlan().toString().count("stddev_samp") < 10  # the frame of 21 rows alone
    for n in (5, 10, 21):
        both = out.select(f"r_ma_{n}", f"r_std_{n}", tw.rolling(F.avg, "r", n, w).alias("m"), tw.rolling(F.stddev_samp, "r", n, w).alias("s")).collect()
        assert sum(r.m is None for r in both) > 2 * n and any(r.m is not None for r in both)
        for m, s, want_m, want_s in both:
            assert (m is None) == (want_m is None) and (s is None) == (want_s is None)
            assert m is None or (abs(m - want_m) < 1e-12 and abs(s - want_s) < 1e-12)


def test_trees_read_stored_vectors(spark, monkeypatch):
    stored, keep = [], md.reliable_checkpoint
    monkeypatch.setattr(md, "reliable_checkpoint", lambda df, name="stage": stored.append((name, df.columns)) or keep(df, name))
    rows = [(i, float(i % 7), None if i == 9 else float(i % 3), float(i % 7 > 3), 1.0, i % 5 == 0) for i in range(90)]
    df = spark.createDataFrame(rows, "i int, a double, b double, y double, w double, v boolean")
    plain = md.fit_gbt(df, ["a", "b"], "y", max_iter=2, depth=2)
    md.fit_gbt(df, ["a", "b"], "y", max_iter=2, depth=2, weight="w", valid="v")
    sorted_out = md.fit_gbt_classifier(df.withColumn("part", F.when(F.col("v"), "stop").otherwise("train")), ["a", "b"], "y",
                                       max_iter=2, depth=2, weight="w")
    assert stored == [("vectors", ["features", "y"]), ("vectors", ["features", "y", "w", "v"]), ("vectors", ["features", "y", "w", "_stop"])]
    assert md.predict(plain, df, ["a", "b"]).count() == md.predict_class(sorted_out, df).count() == 90


def test_panel_weights_need_no_join(spark):
    from panelspark.catalog import models as cm
    from panelspark.operators import aggregates as ag
    rows = [(c, D(2024, 1, 1) + dt.timedelta(days=i), 50.0 + (i * 7 + (c or 0)) % 11) for c, n in ((1, 40), (2, 60), (None, 50)) for i in range(n)]

    class Bars:
        bars = spark.createDataFrame(rows, "company_id int, date date, close double")

    frame, _ = cm._frame(Bars, parts=True, weights=True)
    mean = frame.agg(F.avg("weight")).first()[0]
    got = {(r.company_id, r.date): r.weight / mean for r in frame.where("weight IS NOT NULL").collect()}
    want = {(r.company_id, r.date): r.weight for r in ag.sample_weights(frame.drop("weight"), balance=True).collect()}
    assert got.keys() == want.keys() and len(got) > 40 and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_boosting_goes_on_while_the_error_falls(spark, monkeypatch):
    from panelspark.catalog import models as cm
    rows = [(i, float(i % 40), float(i % 40) * 1e-3, i % 4 == 0) for i in range(400)]  # an error far below the tolerance of MLlib
    df = spark.createDataFrame(rows, "i int, a double, y double, v boolean")
    assert len(md.fit_gbt(df, ["a"], "y", max_iter=12, depth=2, valid="v").stages[-1].trees) == 12

    class Seen(Exception):
        pass

    def seen(df, features, label, **given):
        raise Seen(given)

    frame = spark.createDataFrame([(1, 0.5, 1.0, "train"), (1, 0.5, 1.0, "test")], "company_id int, r double, weight double, part string")
    monkeypatch.setattr(cm, "_frame", lambda *a, **b: (frame, ["r"]))
    monkeypatch.setattr(md, "fit_gbt", seen)
    with pytest.raises(Seen) as x:
        cm.gbt_panel(None)
    assert x.value.args[0].keys() == {"weight", "valid"}  # 600 trees of depth 6


def test_selection_query_does_the_whole_job(spark, monkeypatch):
    from panelspark.catalog import models as cm
    given = []
    monkeypatch.setattr(cm, "joined_panel", lambda t: None)
    monkeypatch.setattr(md, "shadow_selection", lambda df, features, target, ids, **other: given.append(other))
    cm.shadow_selection(None)
    assert given == [{}]  # rounds, trees and depth are the operator's


def test_groups_share_the_pass_of_a_level(spark, monkeypatch):
    levels, best = [], fs.best_splits
    monkeypatch.setattr(fs, "best_splits", lambda sums: levels.append(1) or best(sums))
    monkeypatch.setattr(fs, "BLOCK_ROWS", 64)
    found = [fs.keyed_selection(grouped(spark).repartition(n), "g", ["a", "b", "c"], "y", ["g", "i"], rounds=9, trees=3, depth=3).collect()
             for n in (1, 5)]
    assert len(levels) == 2 * 3 and sorted(found[0]) == sorted(found[1])
    blocks, names = fs.grouped_blocks(fs.binned(grouped(spark), "g", ["a", "b"], "y", ["g", "i"], bins=8))
    out = blocks.collect()
    assert names == [3, 8, 9] and len({(r.block, r.chunk) for r in out}) == len(out) and max(len(r.y) // 8 for r in out) <= 128
    assert {g: sum(len(r.y) // 8 for r in out if r.grp == g) for g in names} == {3: 400, 8: 401, 9: 5}
    assert all(len(r.b) == 2 * len(r.y) // 8 for r in out)
    assert all(abs(sum(np.frombuffer(r.y).sum() for r in out if r.grp == g)) < 1e-9 for g in names)


def test_tasks_that_share_the_trees_grow_the_same(spark, monkeypatch):
    monkeypatch.setattr(fs, "BLOCK_ROWS", 100)
    blocks, names = fs.grouped_blocks(fs.binned(grouped(spark), "g", ["a", "b"], "y", ["g", "i"], bins=8))
    one, many = (fs._forests(blocks, names, range(2), 5, 3, 11, 4, 2, 8, shares) for shares in (1, 4))
    assert np.allclose(one, many) and one.shape == (3, 10, 4) and (one[:2].sum(axis=2) > 0).all()


def test_a_group_in_one_block_grows_as_its_rows_do(spark, monkeypatch):
    monkeypatch.setattr(fs, "SHADOW_ROWS", 50)
    rows = fs.binned(grouped(spark), "g", ["a", "b"], "y", ["g", "i"], bins=8)
    blocks, names = fs.grouped_blocks(rows)
    got = fs._forests(blocks, names, range(2), 3, 3, 11, 4, 4, 8, 2)
    want = np.zeros_like(got)
    for r in range(2):
        for g, tree, _, f, _, x in fs.splits(fs.with_shadows(rows, 11 + r), names, 4, 3, 3, 11 + r, bins=8):
            want[g, r * 3 + tree, f] += x
    assert np.allclose(got, want, atol=1e-6) and (want[:2].sum(axis=2) > 0).all()
