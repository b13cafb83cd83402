"""Operators against brute force, round trips and held-out accuracy, with NULLs, repeats and empty tables."""

import collections
import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from panelspark.llm import chat, language, mixing, quality, rules, scoring, topk

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, fail_bits int"
ROWS = [(1, "One two three. " * 30, "a", 1), (1, "One two three. " * 30, "a", 1), (None, None, None, 2), (2, "", "b", 3),
        (3, " \n\t", "b", 4), (4, "é ß ü Wort " * 5, None, 5), (5, "A\n\nA\nB b", "c", 6)]


def test_topk_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.integers(-3, 4, 5).astype(float).tolist(), "x") for i in range(300)]
    rows += [(500, [1.0, None, 1.0, 1.0, 1.0], "x"), (501, None, "x"), (None, [1.0] * 5, "x"), (502, [float("inf")] * 5, "x"),
             (700, [1e9, 0.0, 1e9, 1.0, 2.0], "x"), (7, [3.0] * 5, "x")]
    v = topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string"))
    fine = [(i, [math.floor(1024 * x) for x in e]) for i, e, _ in rows
            if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    want = []
    for q, e in fine:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(e, f)), i) for i, f in fine if i != q)[:10]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    got = topk.search(v, v.filter("vec_id % 100 = 0"), block=4, fan_in=2)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.search(v.limit(0), v.limit(0)).count() == 0


def test_chat_round_trip(spark):
    rows = [(1, 1, "user", "a\\b <| <\\| \\n \\"), (1, 2, "assistant", "<|im_end|>\n<|im_start|>user\né"), (1, 2, "assistant", ""),
            (2, 0, "as\nk", None), (None, None, None, "x"), (2, 1, "assistant", "y" * 70_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(turns)).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in (1, 2, None):
        mine = sorted((r for r in rows if r[0] == conv), key=order)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        assert got[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (got[conv].n_turns, got[conv].loss_chars) == (len(mine), len(loss))
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.format_chats(turns.limit(0))).count() == 0


def test_scores_brute_force(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    got = scoring.score(docs, "doc_id < 5").collect()
    seen = collections.Counter(w for r in ROWS if r[0] is not None and r[0] < 5
                               for w in [*(r[1] or "").encode().lower().split(), b" "])
    n, v = sum(seen.values()), len(seen)
    want = sorted((str(r[0]), round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in
                   [*(r[1] or "").encode().lower().split(), b" "]), 6)) for r in ROWS)
    assert sorted((str(r.doc_id), round(r.base_score, 6)) for r in got) == want
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    assert scoring.score(docs.limit(0), "true").count() == 0


def test_rules_and_ablation(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    rows = rules.ledger(docs)
    by = {r.doc_id: r for r in rows.collect()}
    assert (by[1].n_words, by[1].n_repeat_words, by[None].n_words, by[3].n_words) == (90, 90, 0, 0)
    assert (by[5].n_dup_lines, by[5].word_chars) == (1, 4)
    out = {r.rule: r for r in rules.ablation(rows, "base-1").collect()}
    assert out["few_words"].n_failed == 4 and out["repeated_windows"].n_alone == 3
    assert {r.n_failed for r in rules.ablation(rows.limit(0), "web-1").collect()} == {0}


def test_mixing_is_near_its_targets(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = mixing.mix(docs)
    for r in out.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("m")).collect():
        assert r.g - 2 * r.m <= r.t <= r.g + 1e-6
    assert mixing.mix(spark.createDataFrame(ROWS, DOCS)).count() == len(ROWS)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_language_and_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    told = language.predict(docs, language.train(docs.filter("doc_id % 4 <> 2"))).filter("doc_id % 4 = 2")
    assert told.filter("lang = lang_pred").count() >= 0.98 * told.count()
    voted = quality.score(docs, quality.fit(docs, labels, F.col("id") % 5 != 0)).join(labels, "doc_id").filter("doc_id % 5 = 0")
    right = voted.filter("(quality_score >= 0.3) = (quality = 1)").count()
    assert right >= 0.95 * voted.count()


def test_edges_of_models(spark):
    docs = spark.createDataFrame(ROWS, DOCS).withColumn("lang", F.lit("x"))
    none = docs.limit(0)
    assert {r.lang_pred for r in language.predict(docs, language.train(none)).collect()} == {"und"}
    told = {r.doc_id: r.lang_pred for r in language.predict(docs, language.train(docs)).collect()}
    assert told[None] == told[3] == "und" and told[1] == "x"
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (9, None)], "doc_id long, quality int")
    assert {r.quality_score for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}
    assert all(0 <= r.quality_score <= 1 for r in quality.score(docs, quality.fit(docs, labels)).collect())
    assert quality.score(none, quality.fit(none, labels)).count() == 0
