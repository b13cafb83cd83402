"""Many phrases searched in many texts at once, by an automaton over bytes.

Phrases share a trie with failure links, turned into one flat table: state and byte class to next state. A batch of texts
is cut into lanes of equal length that overlap by the longest phrase, and all lanes take one step at a time in numpy, so
the cost depends on the bytes of the texts and not on the number of phrases. The phrases are cut into shards of bounded
size; each shard is one table, sent to the tasks, and a text meets every shard whole.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of the phrases of one shard, on average; its table has at most as many states plus one.
SHARD_BYTES = 1 << 17

#: Bytes of the texts that are searched together; what a search holds beside them follows these, not the batch.
SLICE_BYTES = 1 << 21

#: Bytes of a lane, and lanes that step together.
LANE, LANES = 4096, 4096


class Automaton:
    """Failure-link automaton of byte phrases; phrase i is reported as i."""

    def __init__(self, phrases: Sequence[bytes]):
        used = sorted({b for p in phrases for b in p})
        self.classes = np.zeros(256, np.uint8 if len(used) < 256 else np.int32)  # class 0: bytes of no phrase
        self.classes[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        self.longest = max(map(len, phrases), default=1)
        rows: list[dict[int, int]] = [{}]
        own: dict[int, list[int]] = {}
        code = self.classes.tolist()
        for i, p in enumerate(phrases):
            at = 0
            for b in p:
                nxt = rows[at].get(code[b])
                if nxt is None:
                    nxt = rows[at][code[b]] = len(rows)
                    rows.append({})
                at = nxt
            own.setdefault(at, []).append(i)
        table = np.zeros((len(rows), width), np.int32)
        fail = np.zeros(len(rows), np.int32)
        # ``chain`` leads from a state to the nearest shorter suffix that ends a phrase
        chain = np.zeros(len(rows), np.int32)
        order = deque()
        for c, s in rows[0].items():
            table[0, c] = s
            order.append(s)
        while order:
            at = order.popleft()
            table[at] = table[fail[at]]
            chain[at] = fail[at] if int(fail[at]) in own else chain[fail[at]]
            for c, s in rows[at].items():
                fail[s] = table[fail[at], c]
                table[at, c] = s
                order.append(s)
        self.width, self.table, self.own, self.chain = width, table.ravel(), own, chain
        self.ends = np.zeros(len(rows), bool)
        self.ends[list(own)] = True
        self.ends |= chain > 0

    def found_at(self, state: int) -> list[int]:
        """Phrases that end where this state is reached."""
        out: list[int] = []
        while state:
            out += self.own.get(state, [])
            state = int(self.chain[state])
        return out

    def search(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (text number, state) in which some phrase ends, each once; NULL texts have none."""
        column = column.cast(pa.large_binary())
        n = len(column)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        sizes = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
        lap = self.longest - 1
        lane = max(LANE, 4 * lap)
        # a lane starts ``lap`` bytes early, so that a phrase across a cut is found by the later lane
        count = -(-sizes // lane)
        text = np.repeat(np.arange(n), count)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        begin = offsets[text] + np.maximum(nth * lane - lap, 0)
        end = offsets[text] + np.minimum((nth + 1) * lane, sizes[text])
        order = np.argsort(begin - end, kind="stable")  # longest first: lanes drop off at the end of the block
        pairs = [np.zeros((0, 2), np.int64)]
        for at in range(0, len(order), LANES):
            some = order[at:at + LANES]
            pairs.append(self._steps(data, begin[some], end[some], text[some]))
        both = np.unique(np.concatenate(pairs), axis=0)
        return both[:, 0], both[:, 1]

    def _steps(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, text: np.ndarray) -> np.ndarray:
        size = end - begin
        state = np.zeros(len(begin), np.int64)
        seen: list[np.ndarray] = []
        for t in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -t, "left"))  # lanes longer than t come first
            state = state[:live]
            state = self.table[state * self.width + self.classes[data[begin[:live] + t]]].astype(np.int64)
            hit = np.flatnonzero(self.ends[state])
            if len(hit):
                seen.append(np.stack([text[hit], state[hit]], axis=1))
        return np.unique(np.concatenate(seen), axis=0) if seen else np.zeros((0, 2), np.int64)


def holding(texts: DataFrame, id_col: str, text_col: str, phrases: DataFrame, phrase_col: str, value_col: str,
            shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, value) for every text that holds a phrase of the value anywhere, each pair once per row of ``texts``.

    Only the phrases of one shard are on the driver at a time. NULL and empty phrases are found nowhere; a text longer
    than a lane is searched whole.
    """
    phrases = phrases.select(F.col(phrase_col).alias("_p"), F.col(value_col).alias("_v")).where("length(_p) > 0").distinct()
    kind = {f.name: f.dataType for f in phrases.schema}["_v"]
    ident = texts.schema[id_col].dataType
    total = phrases.agg(F.sum(F.octet_length("_p")).alias("b")).first()["b"] or 0
    shards = max(1, -(-total // shard_bytes))
    narrow = texts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    found = None
    for shard in range(shards):
        rows = phrases.where(F.pmod(F.xxhash64("_p"), F.lit(shards)) == shard).collect()
        by: dict[str, list] = {}
        for r in rows:
            by.setdefault(r["_p"], []).append(r["_v"])
        names = sorted(by)
        sent = texts.sparkSession.sparkContext.broadcast(
            (Automaton([p.encode() for p in names]), [sorted(by[p]) for p in names]))
        part = narrow.mapInArrow(_searcher(sent, to_arrow_type(kind)), f"_id {ident.simpleString()}, _v {kind.simpleString()}")
        found = part if found is None else found.unionByName(part)
    return found.distinct() if shards > 1 else found


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts begin within SLICE_BYTES of each other; no text is cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    starts = np.flatnonzero(np.r_[True, np.diff(block) > 0]) if len(block) else np.zeros(0, np.int64)
    for at, end in zip(starts.tolist(), [*starts[1:].tolist(), len(block)]):
        yield batch.slice(at, end - at)


def _searcher(sent: Broadcast, kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, values = sent.value
        known: dict[int, list] = {}
        for b in (part for whole in batches for part in _slices(whole)):
            texts, states = automaton.search(b.column(1))
            rows, out = [], []
            last, mine = -1, set()
            for t, s in zip(texts.tolist(), states.tolist()):
                if t != last:
                    last, mine = t, set()
                if s not in known:
                    known[s] = sorted({v for i in automaton.found_at(s) for v in values[i]})
                for v in known[s]:
                    if v not in mine:
                        mine.add(v)
                        rows.append(t)
                        out.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(out, kind)], ["_id", "_v"])
    return search
