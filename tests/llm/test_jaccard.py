"""Jaccard join against plain Python, prefixes that must share a signature, and every edge of the input."""

import collections
import random
import re

import numpy as np
import pytest

from panelspark.llm import jaccard


def brute(rows, size=4, percent=85):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append(frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size
                    else frozenset([tuple(w)] if w else []))
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for j, o in collections.Counter(j for t in s for j in holders[t]).items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                up[root(i)] = root(j)
        for t in s:
            holders[t].append(i)
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[root(i)].append(d)
    least = {r: min((d for d in x if d is not None), default=None) for r, x in ids.items()}
    return sorted(((d, len(s), least[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def documents(seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Ä", "ab", "AB"]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 8, 9, 10, 11, 30, 120, 400]))]
        if i % 3 == 0:
            base += passage
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.choice([0, 0, 1, 3, 12])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((len(rows), rng.choice([" ", "\n", " \t"]).join(w[rng.randint(0, 2):])))
    group = [rng.choice(words) for _ in range(80)]
    for _ in range(250):  # near copies of one text, many of them not similar enough to each other
        w = list(group)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((len(rows), " ".join(w)))
    rows += [(None, rows[0][1]), (None, "only here and nowhere else at all"), (5000, None), (5001, ""), (5002, " \n"), (5002, " \n"),
             (5003, "one two"), (5004, "ONE  two"), (7, rows[7][1]), (7, rows[7][1]), (6000, "long " * 70_000 + "end of it"),
             (6001, "long " * 70_000 + "end of it")]
    return rows


@pytest.mark.parametrize("frequent", [2, 8])
def test_components_against_plain_python(spark, frequent, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_WEIGHT", 1 << 15)  # blocks of 32 sets, so that groups meet across blocks
    monkeypatch.setattr(jaccard, "NEXT_CLASS", 8)
    rows = documents()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, k1 string, sig int").repartition(6)
    got = sorted((tuple(r) for r in jaccard.similar_documents(df, frequent=frequent).collect()), key=str)
    assert got == brute(rows)


def test_empty_tables_and_tables_without_links(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similar_documents(none).count() == 0
    one = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.similar_documents(one).collect())) == [(1, 9, 1), (2, 0, 2)]


def test_similar_sets_always_share_a_signature():
    p, rng = jaccard.Prefixes(85), np.random.default_rng(1)
    for n in [*range(6, 60), 100, 333, 700]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            gone = rng.integers(0, p.missing(len(a)) + 1)
            keep = np.sort(rng.permutation(a)[gone:])
            most = (100 * len(keep) // 85) - len(a)  # what may be added so that 100 * common >= 85 * union still holds
            b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, rng.integers(0, max(most, 0) + 1), dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            assert 100 * common >= 85 * (len(a) + len(b) - common)
            kinds = [(mixed := jaccard.mix(s) % np.uint64(3)).astype(np.int8) + 1 for s in (a, b)]
            for classes in (kinds, [np.full(len(s), 2, np.int8) for s in (a, b)], [np.full(len(s), 3, np.int8) for s in (a, b)]):
                x, y = (p.signatures(s, k) for s, k in zip((a, b), classes))
                assert len(np.intersect1d(x, y)), (n, mixed)


def test_thresholds_that_groups_cannot_serve():
    with pytest.raises(ValueError, match="too small"):
        jaccard.Prefixes(50)
