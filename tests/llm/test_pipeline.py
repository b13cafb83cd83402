"""Pipeline stages on their own inputs: whole rows, clashing column names, odd input, and what each stage must keep."""

import collections
import math
import re
import statistics

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelspark.llm import language, mixing, quality, simhash
from panelspark.llm.common import held_out

FOLDER = "/root/testdata/sf0.01"
CLASHES = ["_quality", "_lang", "_share", "_guess", "_rid", "_fp", "_copies", "_id", "_source", "_use", "row", "quality_score",
           "lang_pred", "lang_score", "size", "h", "copies", "source_size", "target", "whole", "fills", "threshold"]


def documents(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (90001, "", "en", "src1", 0), (90002, " \n", None, None, 2),
                                 (90003, "A.", "en", None, 2), (3, "again the same id", "en", "src2", 9)], df.schema)
    df = df.unionByName(odd)
    return df.select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce("doc_id", F.lit(0))).alias(c) for c in CLASHES])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES][:4])
def test_stages_keep_whole_rows_of_any_names(spark, name):
    docs = documents(spark)
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, FOLDER)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    before, after = (collections.Counter(map(tuple, d.collect())) for d in (docs, out))
    assert after and set(after) <= set(before)
    if name == "mixing":
        assert all(after[k] <= 2 * before[k] for k in after)
    else:
        assert all(after[k] <= before[k] for k in after)
    assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_each_stage_decides_as_its_operator(spark):
    docs = documents(spark)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    ids = lambda d: sorted((str(r.doc_id), r.text or "") for r in d.select("doc_id", "text").collect())
    stages = dict(corpus_pipeline.STAGES)
    plain = docs.select("doc_id", "text", "lang", "source")
    scored = quality.score(plain, quality.fit(plain, labels))
    assert ids(stages["quality"](spark, docs, FOLDER)) == ids(scored.filter("quality_score >= 0.3"))
    told = language.predict(plain, language.train(plain))
    assert ids(stages["language"](spark, docs, FOLDER)) == ids(told.filter("lang_pred <> 'und' AND lang_score >= 0.3"))
    one = simhash.near_duplicates(plain).select("component_id").distinct()
    kept = [i for i, _ in ids(stages["near_duplicates"](spark, docs, FOLDER))]
    assert set(kept) == {str(r.component_id) for r in one.collect()}
    mix = collections.Counter()
    for r in mixing.mix(plain).collect():
        mix[str(r.doc_id)] += r.copies
    got = collections.Counter(i for i, _ in ids(stages["mixing"](spark, docs, FOLDER)))
    assert got == +mix


def test_run_ends_in_whole_packed_documents(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert rows and {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
    fill = collections.Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048
    clean = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("quality = 1").count()
    assert len({r.doc_id for r in rows}) >= 0.5 * clean


def test_language_of_every_text_with_a_letter(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.train(docs.filter(~held_out("doc_id", 4, 2)))
    texts = [("A.", True), ("x 5", True), ("é", True), ("中", True), ("ßß", True), ("½", False), ("²", False), ("12 34", False),
             ("", False), (None, False), ("́", False), ("a" * 200_000, True)]
    df = spark.createDataFrame([(t, "keep") for t, _ in texts], "text string, _guess string")
    out = language.predict(df, model)
    assert out.columns == ["text", "_guess", "lang_pred", "lang_score"] and {r._guess for r in out.collect()} == {"keep"}
    for (text, letter), r in zip(texts, out.collect()):
        assert (r.lang_pred != "und") == letter and 0 <= r.lang_score <= 1, text
    told = language.predict(docs, model).filter(held_out("doc_id", 4, 2))
    assert told.filter("lang = lang_pred").count() >= 0.98 * told.count()


def test_many_languages(spark):
    words = ["".join(chr(97 + (i * 7 + k * 11) % 26) for k in range(5)) + chr(97 + i % 26) for i in range(300)]
    docs = spark.createDataFrame([(i, f"{w} " * 5, f"l{i:03d}") for i, w in enumerate(words)], "doc_id long, text string, lang string")
    out = language.predict(docs, language.train(docs))
    assert out.filter("lang_score > 0.9").count() == 300
    # the same rule in plain Python: a language keeps a window used at half the rate, or more, of the one that uses it most
    rate = {}
    for r in docs.collect():
        w = language.windows(r.text)
        for g, n in collections.Counter(w.tolist()).items():
            rate.setdefault(g, {})[r.lang] = n / len(w)
    hold = {g: {k for k, x in by.items() if x >= 0.5 * max(by.values())} for g, by in rate.items()}
    for r in out.collect():
        w = language.windows(r.text).tolist()
        share = collections.Counter(k for g in w for k in hold[g])
        assert share[r.lang_pred] == max(share.values())


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = mixing.mix(docs).collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    assert all(r.size == size[r.doc_id] and r.taken in (0, r.size, 2 * r.size) for r in rows)
    median = statistics.median(size.values())
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    for mine in by.values():
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= median
    assert math.isclose(sum(m[0].target for m in by.values()), 1.5 * sum(size.values()), rel_tol=1e-9)


def test_a_long_document_does_not_starve_its_source(spark):
    rows = [(i, "w " * n, "a") for i, n in enumerate([900, *range(1, 60)])] + [(None, "w " * 5, "a"), (None, "v " * 5, "a"), (70, None, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs).filter("source = 'a'").collect()
    assert abs(sum(r.taken for r in out) - out[0].target) <= 10
    again = mixing.mix(docs.repartition(5)).filter("source = 'a'").collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_quality_learns_from_training_rows_only(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.withColumn("quality", F.when(held_out("doc_id", 5, 0), 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    a, b = ({r.doc_id: r.quality_score for r in quality.score(docs, quality.fit(docs, some, ~held_out("id", 5, 0))).collect()}
            for some in (labels, turned))
    assert a == b
    voted = spark.createDataFrame(list(a.items()), "doc_id long, s double").join(labels, "doc_id").filter(held_out("doc_id", 5, 0))
    assert voted.filter((F.col("s") >= 0.3).cast("int") == F.col("quality")).count() >= 0.9 * voted.count()


def test_stages_hand_texts_over_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(1, "one two three", "a", "en")], "doc_id long, text string, source string, lang string")
    try:
        for chosen, then in ((10_000, 1024), (77, 77)):
            spark.conf.set(key, chosen)
            corpus_pipeline.drop_near_duplicates(spark, docs, "")
            assert int(spark.conf.get(key)) == then
    finally:
        spark.conf.set(key, before)
