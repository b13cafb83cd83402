"""Token store and packed documents against the tokenizer itself: round trips, starts, checksums, odd input."""

import zlib
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelspark.llm import packing, token_store
from panelspark.session import scratch_path

SCHEMA = "doc_id long, text string, slot string, ids string"
ROWS = [(5, "Plain words, and some more."), (1, None), (2, ""), (2, ""), (3, "x" * 40_000 + " long " * 9000), (None, "no id"),
        (7, "é ß 日本 \n\n tabs\t and  spaces"), (7, "same id"), (4, " \n"), (9, "Plain words, and some more.")]


def ids_of(path):
    tok = Tokenizer.from_file(path)
    return lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


def docs(spark):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in ROWS], SCHEMA).repartition(4)


def test_store_round_trip(spark):
    name = public_tokenizers.path("byte_bpe_50k.json")
    path, ids = scratch_path(spark, "store"), ids_of(name)
    token_store.write(docs(spark), path, name)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in token_store.read(spark, path).collect()))
    start, want = 0, []
    for i, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        x = ids(t)
        want.append((i is not None, i or 0, start, len(x), crc(x)))
        start += len(x)
    assert [g[:3] + g[3:] for g in got] == sorted(want)
    found = {(r.doc_id, tuple(r.ids)) for r in token_store.lookup(spark, path, [5, 7, 1, 1234]).collect()}
    assert found == {(i, tuple(ids(t))) for i, t in ROWS if i in (5, 7, 1)}


def test_empty_store(spark):
    path = scratch_path(spark, "store")
    token_store.write(docs(spark).limit(0), path, public_tokenizers.path("byte_bpe_50k.json"))
    assert token_store.read(spark, path).count() == 0 and token_store.lookup(spark, path, [1]).count() == 0


@pytest.mark.parametrize("capacity", [2048, 7])
def test_packed_documents(spark, capacity):
    name = public_tokenizers.path("word_bpe_49k.json")
    ids, want = ids_of(name), []
    for i, t in ROWS:
        x = ids(t)
        want += [(str(i), k, at, len(x[at:at + capacity]), crc(x[at:at + capacity])) for k, at in enumerate(range(0, len(x), capacity))]
    out = packing.pack_documents(docs(spark), name, capacity).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(bins) <= 1.1 * -(-sum(w[3] for w in want) // capacity) + 1
    assert packing.pack_documents(docs(spark).limit(0), name, capacity).count() == 0
