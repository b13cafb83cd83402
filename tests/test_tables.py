"""Merges, parsing, news matching, sources, streams and plan checks on small inputs."""

import datetime as dt
import itertools
import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.catalog.tables import Tables
from panelspark.functions import text as tx
from panelspark.functions.config import check_keys, without_comments
from panelspark.operators import merge as mg
from panelspark.operators import models as md
from panelspark.operators import news as nw
from panelspark.operators import reads as rd
from panelspark.operators.joins import asof_series
from panelspark.plans import statements as st
from panelspark.session import scratch_path
from panelspark.sources import landed, readers, writers
from panelspark.streaming import jobs

D = dt.date


def pairs(df):
    return sorted((r.news_article_id, r.company_id) for r in df.collect())


def test_merges_with_duplicate_updates(spark):
    schema = "company_id int, date date, v double"
    base = spark.createDataFrame([(1, D(2020, 1, 1), 1.0), (1, D(2020, 1, 2), 2.0)], schema)
    upd = spark.createDataFrame([(1, D(2020, 1, 2), 5.0), (1, D(2020, 1, 3), 7.0), (1, D(2020, 1, 3), 6.0)], schema)
    keys = ["company_id", "date"]
    ignore = sorted(r.v for r in mg.insert_ignore(base, upd, keys, ["v"]).collect())
    replace = sorted(r.v for r in mg.upsert_replace(base, upd, keys, ["v"]).collect())
    assert ignore == [1.0, 2.0, 6.0] and replace == [1.0, 5.0, 7.0]


def test_merge_columns_last_value_wins(spark):
    base = spark.createDataFrame([(D(2020, 1, 1), 1.0, 2.0)], "date date, cpi double, gdp double")
    src = "date date, value double, seq int"
    cpi = spark.createDataFrame([(D(2020, 1, 1), 8.0, 1), (D(2020, 1, 1), 9.0, 2), (D(2020, 2, 1), 3.0, 1)], src)
    gdp = spark.createDataFrame([(D(2020, 3, 1), 4.0, 1)], src)
    got = {r.date: (r.cpi, r.gdp) for r in mg.merge_columns(base, {"cpi": cpi, "gdp": gdp}).collect()}
    assert got == {D(2020, 1, 1): (9.0, 2.0), D(2020, 2, 1): (3.0, None), D(2020, 3, 1): (None, 4.0)}


def test_high_water_of_empty_table_keeps_all(spark):
    new = spark.createDataFrame([(1, D(2020, 1, 1)), (2, D(2020, 1, 2))], "company_id int, date date")
    assert mg.after_high_water(new, new.limit(0)).count() == 2
    assert mg.latest_mark(new.limit(0), default=F.lit(D(2000, 1, 1))).first().mark == D(2000, 1, 1)


def test_sanitize(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (float("-inf"), 3), (1.5, 4), (None, 5)], "x double, i int")
    assert [r.x for r in mg.sanitize(df).orderBy("i").collect()] == [None, None, None, 1.5, None]


def test_columns_without_values_and_constants(spark):
    df = spark.createDataFrame([(1, 2.0, None, 3), (2, 2.0, None, None)], "k int, one double, none double, some int")
    assert rd.drop_all_null_columns(df).columns == ["k", "one", "some"]
    assert rd.drop_constant_columns(df).columns == ["k", "some"]


@pytest.mark.parametrize("label,want", [
    ("I Q 2020", D(2020, 3, 31)), ("IV Q 2019", D(2019, 12, 31)), ("Q 0000", None), ("IV Q", None), ("2020", None),
    ("III 0000", None), ("IIII 2020", None)])
def test_quarter_labels(spark, label, want):
    df = spark.createDataFrame([(label,)], "s string").select(tx.quarter_date("s").alias("d"))
    assert df.first().d == want


def test_headers_and_numbers(spark):
    heads = {"Zysk (strata) netto (tys.)*": "zyskstratanettotys", "Kapitał własny": "kapitawasny",
             "Przychody (tys..)* x": "przychodyx"}
    df = spark.createDataFrame(list(heads.items()), "h string, n string")
    assert all(r.g == r.n for r in df.select("n", tx.normalise_header("h").alias("g")).collect())
    nums = spark.createDataFrame([("1 234,5",), ("-2 000",), ("",), ("b/d",), (None,)], "s string")
    assert [r.v for r in nums.select(tx.parse_number("s").alias("v")).collect()] == [1234.5, -2000.0, None, None, None]


def test_candidates_prefer_exact_then_prefix(spark):
    rows = spark.createDataFrame([(1, D(2020, 3, 31), "aktywaobce", 1.0), (1, D(2020, 3, 31), "aktywa", None),
                                  (2, D(2020, 3, 31), "aktywaobce", 2.0)], "company_id int, date date, header string, value double")
    got = {r.company_id: r.assets for r in st.map_bank(rows).collect()}
    assert got == {1: None, 2: 2.0}


def test_sector_rules(spark):
    rows = [(c, D(2020, 3, 31), h, v) for c, h, v in [
        (1, "przychodyzlokattys", 5.0), (1, "skladkanaudzialewlasnymtys", None), (2, "przychodyztytuoodsetektys", 3.0),
        (2, "przychodyztytuloprowizjitys", 4.0), (3, "ebittys", 7.0), (3, "amortyzacja", 1.0), (3, "obrotytys", 9.0)]]
    df = spark.createDataFrame(rows, "company_id int, date date, header string, value double")
    comp = spark.createDataFrame([(1, 22), (2, 7), (3, 5)], "id int, sector_id int")
    got = {r.company_id: (r.revenue, r.operating_profit, r.ebitda) for r in st.map_sector(df, comp).collect()}
    assert got == {1: (5.0, None, None), 2: (7.0, None, None), 3: (9.0, 7.0, 8.0)}
    cells = spark.createDataFrame([(3, 1, "I Q 2020", "Raport zbadany przez audytora", "T"), (3, 1, "I Q 2020", "Obroty (tys.)", "1,5")],
                                  "company_id int, page int, kwartal string, header string, cell string")
    one = st.map_sector(landed.statement_rows(cells), comp).first()
    assert (one.audited, one.revenue) == ("T", 1.5)


def test_feature_names(spark):
    payloads = {'["a","b"]': ["a", "b"], '{"a":1,"b":3}': ["b", "a"], '[{"col":"x"},{"name":"y"},{"z":1}]': ["x", "y"], None: []}
    df = spark.createDataFrame([(p,) for p in payloads], "p string").select("p", tx.feature_names("p").alias("n"))
    assert {r.p: r.n for r in df.collect()} == payloads


def test_articles_without_date_or_body_are_dropped(spark):
    meta = '<meta property="article:published_time" content="2024-01-05T10:00:00">'
    body = "<title>T</title><article><p> a <b>b</b></p><p></p><p>c</p></article>"
    df = spark.createDataFrame([(1, "u", meta + body), (2, "u", body), (3, "u", meta), (4, "u", meta + "<article>x</article>")],
                               "page_id int, url string, html string")
    got = {r.page_id: (r.date, r.content) for r in landed.article_rows(df).collect()}
    assert got == {1: (D(2024, 1, 5), "a b\nc"), 4: (D(2024, 1, 5), "x")}


def test_substring_paths_agree_with_brute_force(spark):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcłé"), rng.integers(1, 6))) for _ in range(60)]
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 40)))) for i in range(80)]
    al = [(i % 7, a) for i, a in enumerate([*(" ".join(rng.choice(words, k)) for k in (1, 1, 2, 2, 3, 1)), "a", "b c", "ł", "ab", "  "])]
    want = sorted({(i, c) for (i, t), (c, a) in itertools.product(docs, al) if a.strip() and a in t})
    news = spark.createDataFrame(docs, "id int, text string")
    aliases = spark.createDataFrame(al, "company_id int, alias string")
    assert pairs(nw.alias_substrings(news, aliases)) == want
    tok = lambda s: re.findall(r"\w+", s)
    want = sorted({(i, c) for (i, t), (c, a) in itertools.product(docs, al)
                   if tok(a) and any(tok(t)[j:j + len(tok(a))] == tok(a) for j in range(len(tok(t))))})
    assert pairs(nw.alias_phrases(news, aliases)) == want


def test_topic_paths_agree(spark):
    rng = np.random.default_rng(4)
    v = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    tags = [(i, rng.normal(size=8).tolist()) for i in range(25)] + [(30, [0.0] * 8)]
    vec, tag = (spark.createDataFrame(x, "id int, vector array<double>") for x in (v, tags))
    one = {r.news_article_id: r.context_tag_id for r in nw.best_topic(vec, tag).collect()}
    two = {r.news_article_id: r.context_tag_id for r in nw.best_topic(vec, tag, block_bytes=300).collect()}
    cos = lambda a, b: np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b))
    want = {i: max(tags[:-1], key=lambda t: cos(x, t[1]))[0] for i, x in v}
    assert one == two == want


def test_plug_in_scorer(spark):
    def load():
        import pandas as pd
        return lambda s: pd.DataFrame({"label": ["POSITIVE"] * len(s), "score": s.str.len() / 10})
    got = nw.score_with_model(spark.createDataFrame([(1, "abc")], "id int, text string"), "text", load).first()
    assert (got.sentiment_label, got.sentiment_score) == ("positive", 0.3)


def test_config():
    cfg = {"a": 1, "a_comment": "x", "b": [{"c_comment": 1, "d": 2}]}
    assert without_comments(cfg) == {"a": 1, "b": [{"d": 2}]}
    with pytest.raises(KeyError, match="section train misses z"):
        check_keys({"a": 1}, ["a", "z"], "train")


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 2020, 1.5), (2, 2021, 2.5)], "id int, y int, v double")
    path = str(tmp_path / "t")
    writers.append(df, path, ["y"])
    writers.append(df, path, ["y"])
    assert readers.read_table(spark, path).count() == 4
    writers.overwrite_partitions(df.where("y = 2021"), path, ["y"])
    assert readers.read_table(spark, path).count() == 3
    writers.write_csv(df, str(tmp_path / "c"))
    assert sorted(tuple(r) for r in readers.read_csv(spark, str(tmp_path / "c"), df.schema).collect()) == [(1, 2020, 1.5), (2, 2021, 2.5)]
    target = writers.write_version(df, str(tmp_path / "v"), "1")
    assert readers.read_table(spark, target, df.schema).count() == 2
    (tmp_path / "j.json").write_text(json.dumps({"id": 3}))
    assert readers.read_json(spark, str(tmp_path / "j.json"), "id int").first().id == 3
    (tmp_path / "x.xml").write_text('<r><p id="7"><v>2</v></p><p id="8"/></r>')
    assert sorted(r._id for r in readers.read_xml(spark, str(tmp_path / "x.xml"), "p", "_id int, v int").collect()) == [7, 8]
    assert readers.read_text_files(spark, str(tmp_path / "*.xml")).first().payload.startswith("<r>")


def test_stream_in_two_steps_equals_one_batch(spark):
    base = scratch_path(spark, "two")
    ticks = [(c, dt.datetime(2024, 1, 1 + d, h), float(100 + c + d * h), 1, i)
             for i, (c, d, h) in enumerate(itertools.product(range(3), range(4), range(1, 9)))]
    df = spark.createDataFrame(ticks, "company_id int, ts timestamp, price double, qty int, event_id int")
    for part in (df.where("event_id % 2 = 0"), df.where("event_id % 2 = 1")):
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = jobs.file_stream(spark, f"{base}/in", df.schema)
        jobs.ohlcv_stream(stream, f"{base}/out", f"{base}/ckpt", "10 days").awaitTermination()
    got = sorted(tuple(r) for r in jobs.read_upserted(spark, f"{base}/out", ["company_id", "date"]).collect())
    assert got == sorted(tuple(r) for r in jobs.daily_bars(df).collect())


def test_stream_ema_keeps_state_and_flags_late_bars(spark):
    base = scratch_path(spark, "ema")
    schema = "company_id int, date date, close double"
    bars = [(1, D(2024, 1, i), float(i)) for i in range(1, 7)]
    for part in (bars[:3], bars[3:], [(1, D(2024, 1, 2), 99.0)]):
        df = spark.createDataFrame(part, schema)
        df.coalesce(1).write.mode("append").parquet(f"{base}/in")
        jobs.ema_stream(jobs.file_stream(spark, f"{base}/in", df.schema), f"{base}/out", f"{base}/ckpt", 0.5).awaitTermination()
    rows = jobs.read_ema(spark, f"{base}/out").collect()
    assert [r.close for r in rows if r.is_late] == [99.0]
    want, y = [], None
    for _, _, c in bars:
        y = c if y is None else y + 0.5 * (c - y)
        want.append(y)
    assert [r.ema for r in sorted((r for r in rows if not r.is_late), key=lambda r: r.date)] == want


def test_selection_finds_the_relevant_feature(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b), float(3 * a)) for i, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    df = spark.createDataFrame(rows, "id int, good double, noise double, y double")
    ranks = md.shadow_selection(df, ["good", "noise"], "y", ["id"], rounds=6, trees=5, depth=4)
    got = {r.feature: r.selected for r in ranks.collect()}
    assert got["good"] and not got["noise"]
    rec = md.selection_record(ranks, sector_id=3).first()
    assert rec.selected_features == ["good"] and rec.total_features == 2 and rec.feature_importances["good"] == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    scan = plan(rd.read_where(spark.read.parquet(f"{t.folder}/orders.parquet"), o_custkey=7).select("o_totalprice"))
    assert "EqualTo(o_custkey,7)" in scan and "o_orderpriority" not in scan
    joined = plan(asof_series(t.market_data.select("company_id", "date", "close"), t.macro_data))
    assert "BroadcastHashJoin" in joined and "NestedLoop" not in joined and "Cartesian" not in joined


def test_no_query_uses_a_cartesian_product(spark):
    import __spark_entry__ as entry
    for name in ("features_v2", "news_label_phrase", "topic_argmax", "ar1_forecast", "clf_metrics", "quantile", "bday_grid"):
        p = plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "Cartesian" not in p and "NestedLoop" not in p, name


def test_panel_frame_is_not_stored_wide(spark, monkeypatch):
    from panelspark.plans import frames
    stored, keep = [], frames.reliable_checkpoint
    monkeypatch.setattr(frames, "reliable_checkpoint", lambda df, name="stage": stored.append(df.columns) or keep(df, name))
    rows = [(c, D(2024, 1, 1) + dt.timedelta(days=i), 50.0 + (i * 7 + c * i) % 11, 1.0, 3.0 if c == 9 else 2.0, 5.0)
            for c in (1, 2, 9) for i in range(60)]
    df = spark.createDataFrame(rows, "company_id int, date date, close double, open double, gdp double, cpi double")
    monkeypatch.setattr(frames, "FEW_ROWS", 1)  # one company, in which gdp does not vary
    out, features = frames.model_frame_panel(df.repartition(1, "company_id").sortWithinPartitions("company_id", "date"))
    assert stored == [["company_id", "date", "close", "gdp", "cpi"]]
    whole, every = frames.model_frame_panel(df, remove_constant=False)
    rows = whole.collect()
    constant = {f for f in every if len({r[f] for r in rows}) == 1}
    assert "cpi_lag1" in constant and "gdp_lag1" not in constant
    assert features == [f for f in every if f not in constant] and out.columns == [c for c in whole.columns if c not in constant]
    assert sorted(out.collect()) == sorted(whole.drop(*constant).collect()) and len(rows) > 30
