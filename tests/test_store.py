"""Stored panels and selections, statement pages and ties, folding of headers, tags with attributes."""

import datetime as dt

from pyspark.sql import functions as F

from panelspark.functions.text import normalise_header
from panelspark.operators import merge as mg
from panelspark.operators import selections as sl
from panelspark.operators import windows as tw
from panelspark.operators.dedup import latest_per_key
from panelspark.plans import statements as st
from panelspark.session import scratch_path
from panelspark.sources import landed as ld
from panelspark.sources import panel_store as ps

D = dt.date


def bars(spark, years=(2001, 2002, 2003), companies=6):
    rows = [(c, D(y, m, 1), float(100 * c + m)) for y in years for c in range(companies) for m in range(1, 13)]
    return spark.createDataFrame(rows, "company_id int, date date, close double")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_stored_panel(spark):
    path = scratch_path(spark, "panel")
    ps.write_panel(bars(spark), path)
    df = ps.read_panel(spark, path, company_id=3, date_from=D(2002, 6, 1))
    assert "EqualTo(company_id,3)" in plan(df) and "PartitionFilters: [isnotnull(year" in plan(df)
    assert df.count() == 19 and "year" not in df.columns
    assert "In(company_id, [1,2])" in plan(ps.read_panel(spark, path, members=("company_id", [1, 2])))
    assert ps.read_panel(spark, path, members=("company_id", [1, 2]), date=D(2001, 2, 1)).count() == 2
    some = spark.createDataFrame([(4,), (4,), (9,)], "id int")
    assert ps.read_panel(spark, path, members=("company_id", some)).count() == 36


def test_merge_rewrites_touched_years_only(spark):
    path = scratch_path(spark, "panel")
    ps.write_panel(bars(spark), path)
    before = {r.f for r in spark.read.parquet(path).where("year <> 2002").select(F.input_file_name().alias("f")).distinct().collect()}
    updates = spark.createDataFrame([(1, D(2002, 1, 1), -1.0), (77, D(2002, 5, 5), 7.0), (1, D(2002, 1, 1), -1.0)], bars(spark).schema)
    years = ps.merge_into(path, updates, lambda base, new: mg.upsert_replace(base, new, ["company_id", "date"]))
    after = {r.f for r in spark.read.parquet(path).where("year <> 2002").select(F.input_file_name().alias("f")).distinct().collect()}
    assert years == [2002] and before == after
    got = {(r.company_id, r.date): r.close for r in ps.read_panel(spark, path).collect()}
    want = {(r.company_id, r.date): r.close for r in bars(spark).collect()} | {(1, D(2002, 1, 1)): -1.0, (77, D(2002, 5, 5)): 7.0}
    assert got == want
    ps.merge_into(path, updates, lambda base, new: mg.insert_ignore(base, new, ["company_id", "date"]))
    assert {(r.company_id, r.date): r.close for r in ps.read_panel(spark, path).collect()} == want


def test_selections_survive_storage(spark):
    path = scratch_path(spark, "selections")
    for day, names, rank in ((D(2024, 1, 1), ["a"], {"a": 1, "b": 2}), (D(2024, 2, 1), ["b"], {"b": 1, "a": 3})):
        for sector in (1, 2):
            sl.store_selection(spark.createDataFrame([(None, sector, day, "shadow", names if sector == 1 else [], 2, rank)], sl.RECORD), path)
    sl.store_selection(spark.createDataFrame([(5, None, D(2024, 3, 1), "shadow", ["c"], 1, {"c": 1})], sl.RECORD), path)
    back = sl.stored_selections(spark, path)
    newest = sl.latest_selections(back, "shadow")
    assert {(r.sector_id, r.run_date, tuple(r.selected_features)) for r in newest.collect()} == {(1, D(2024, 2, 1), ("b",)), (2, D(2024, 2, 1), ())}
    assert sl.latest_selections(back, "other").count() == 0
    assert [r.company_id for r in sl.latest_selections(back, "shadow", "company_id").collect()] == [5]
    assert {(r.feature, r["rank"], r.selected) for r in sl.ranks(newest.where("sector_id = 1")).collect()} == {("b", 1, True), ("a", 3, False)}
    panel = spark.createDataFrame([(1, D(2024, 1, 1), 1, 1.0, 2.0), (2, D(2024, 1, 1), 2, 3.0, 4.0)],
                                  "company_id int, date date, sector_id int, a double, b double")
    assert sl.selected_columns(panel, newest.where("sector_id = 1")).columns == ["company_id", "date", "sector_id", "b"]
    assert [tuple(r) for r in sl.selected_values(panel, newest, ["a", "b"]).collect()] == [(1, D(2024, 1, 1), 1, "b", 2.0)]
    assert latest_per_key(back, ["sector_id"], "run_date").count() == 3


def test_quarters_come_whole_from_their_first_page(spark):
    cells = [(1, 1, "I Q 2020", "Aktywa (tys.)", "1,0", 0), (1, 2, "I Q 2020", "Aktywa (tys.)", "9,0", 0),
             (1, 2, "I Q 2020", "Inne", "5,0", 1), (1, 2, "II Q 2020", "Inne", "6,0", 1), (2, 2, "I Q 2020", "Inne", "7,0", 1),
             (1, 1, "Q 0000", "Inne", "8,0", 1)]
    df = spark.createDataFrame(cells, "company_id int, page int, kwartal string, header string, cell string, nth int")
    want = {(1, D(2020, 3, 31), "aktywatys", 1.0), (1, D(2020, 6, 30), "inne", 6.0), (2, D(2020, 3, 31), "inne", 7.0)}
    for some in (df, df.drop("nth")):
        assert {(r.company_id, r.date, r.header, r.value) for r in ld.statement_rows(some).collect()} == want


def test_prefix_ties_follow_the_columns(spark):
    rows = [(1, D(2020, 3, 31), "kapitalzapasowy", 1.0, 0), (1, D(2020, 3, 31), "kapitalakcyjny", 2.0, 1)]
    df = spark.createDataFrame(rows, "company_id int, date date, header string, value double, nth int")
    assert st.map_bank(df).first().equity == 1.0 and st.map_bank(df.drop("nth")).first().equity == 2.0


def test_headers_fold_all_latin_letters(spark):
    cases = {"Zażółć (tys.)*": "zazocs".replace("s", "") + "tys", "Ünïcödé Ñ": "unicoden", "Łódź. 1": "odz1", "é Å ṩ": "eas", "中": ""}
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    assert {r.h: r.n for r in df.select("h", normalise_header("h").alias("n")).collect()} == cases


def test_sections_and_attributes(spark):
    html = ("<meta content='2024-01-05' property=\"article:published_time\"><meta property='og:title' content='A &amp; &quot;B&quot;'>"
            "<section class='other'><p>no</p></section><section id=1 class=\"x o-text y\"><p a='>'>caf&eacute;</p></section>"
            "<a title='href=x' href=\"/q?a=1&amp;b=2\">l</a><a>n</a><A HREF='http://z'>m</A>")
    df = spark.createDataFrame([(1, "u", html), (2, "u", html.replace("o-text", "o-text-x")), (3, None, None)], "page_id int, url string, html string")
    rows = ld.article_rows(df, body=ld.section_of_class("o-text")).collect()
    assert [(r.page_id, r.headline, r.content) for r in rows] == [(1, 'A & "B"', "café")]
    assert {r.link for r in ld.link_rows(df.limit(1), "https://h").collect()} == {"https://h/q?a=1&b=2", "http://z"}


def test_month_phase_of_many_companies(spark):
    df = spark.range(3000).select(F.col("id").cast("int").alias("company_id"), F.explode(F.array(
        F.lit("2024-01-03"), F.lit("2024-01-09"), F.lit("2024-02-01")).cast("array<date>")).alias("date")).repartition(5)
    got = {(r.company_id, r.date): r.month_phase for r in tw.panel_month_phase(df).collect()}
    assert all(abs(got[c, D(2024, 1, 9)] - (2 * c + 2) / 6000) < 1e-12 for c in range(3000))
    assert all(abs(got[c, D(2024, 2, 1)] - (c + 1) / 3000) < 1e-12 for c in range(3000))
