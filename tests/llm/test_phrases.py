"""Phrases against plain Python, with NULLs, repeats, ties, collisions, long texts and empty tables."""

import collections
import re

import numpy as np
import pyarrow as pa

from panelspark.llm import phrases, shingles

SCHEMA = "lang string, text string, phrase string, a long"


def brute(rows, least, first):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for lang in {r[0] or "und" for r in rows}:
        f, n = collections.Counter(), 0
        for r in rows:
            if (r[0] or "und") != lang:
                continue
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate(low)):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                for k in range(1, 5):
                    for i in range(len(w) - k + 1):
                        f[tuple(w[i:i + k])] += 1
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in cand.items():
            score, k = min(((2_000_000 * a) // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = [b for q, b in cand.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= 80 * a for b in inside):
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def rows(seed=3):
    rng = np.random.default_rng(seed)
    words = ["a", "B", "ab", "é", "Ää", "x y", "the", "THE", "\0", "a-b", "日本"]
    out = []
    for i in range(120):
        text = "".join(str(rng.choice(words)) + str(rng.choice([" ", " ", "  ", "\t ", ". ", "\n", "\v", "!"])) for _ in range(40))
        out.append((str(rng.choice(["en", "de", "und"])) if i % 4 else None, text, "x", i))
    return out + [("en", None, "x", 1), ("en", "", "x", 1), ("fr", " ., ", "x", 2), ("en", "the ab " * 30_000, None, None)] + out[:20]


def test_collocations_against_plain_python(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    for least, first in ((5, 30), (30, 2000)):
        got = sorted(tuple(r) for r in phrases.collocations(df, least=least, first=first).collect())
        assert got == brute(data, least, first)
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(df.where("lang = 'fr'")).count() == 0


def test_collisions_are_told_apart_by_text(spark, monkeypatch):
    monkeypatch.setattr(shingles, "mix", lambda h: h)
    data = rows(5)[:60]
    w = shingles.words(pa.array([d[1] for d in data]), phrases.SPACE, phrases.STOP)
    w.prints[:] = w.prints % np.uint64(3)  # nearly all words collide
    rep = phrases._word_classes(w)
    text = [w.text(i, 1) for i in range(len(rep))]
    assert all(text[i] == text[r] for i, r in enumerate(rep.tolist()))
    assert len({(t, r) for t, r in zip(text, rep.tolist())}) == len(set(text))


def test_word_fingerprints_do_not_depend_on_the_cut(monkeypatch):
    texts = [d[1] for d in rows()]
    whole = shingles.words(pa.array(texts), phrases.SPACE, phrases.STOP)
    monkeypatch.setattr(shingles, "STEP", 7)
    cut = shingles.words(pa.array(["skip", *texts]).slice(1), phrases.SPACE, phrases.STOP)
    for name in ("starts", "ends", "prints", "rows"):
        assert np.array_equal(getattr(whole, name), getattr(cut, name))
    for n in (1, 2, 4):
        assert all(np.array_equal(a, b) for a, b in zip(whole.runs(n), cut.runs(n)))
    first = np.flatnonzero(whole.pieces[:-2] == whole.pieces[2:])[:50]
    assert whole.texts(first, 3).to_pylist() == [whole.text(int(i), 3) for i in first]
