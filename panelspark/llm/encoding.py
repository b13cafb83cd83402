"""Whole texts to token ids with a public tokenizer file, piece by piece and with memory of earlier pieces.

A pre-tokenizer never joins a character that is not white space with a space behind it. A text can therefore be cut
before every single space that follows such a character, and each piece has the ids it has inside the text. Pieces are
remembered, so that a word costs one dictionary access after it was seen once. A plain piece (ASCII and Latin letters,
no apostrophe, no double white space) is cut further where letters meet other characters, which are boundaries for the
supported pre-tokenizers too; what is left unseen goes through the tokenizer, words of letters many at a time.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, compress, islice
from operator import ne

from tokenizers import Tokenizer

# Characters beside which a piece is not cut further (a capital dotted I gains a mark when lower-cased), runs
_NOT_PLAIN = re.compile("\\s\\s|[ '<\x1c-\x1f\u0080-¿×÷İɐ-\U0010ffff]")
_RUNS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+|[^A-Za-zÀ-ÖØ-öø-ɏ]+")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
_SPACED = re.compile(r"\s ")
_SPACE_PAIRS = [c + " " for c in " \t\n\v\f\r\x1c\x1d\x1e\x1f"]
_MARKS = tuple(".,;:!?")
_CUT = re.compile(r"(?<=\S) ")

#: Characters of texts whose unseen words are learned together; a longer text is a step of its own.
STEP = 1_000_000
#: Unseen words that go through the tokenizer as one text, and such texts at a time: a token's record takes a hundred bytes.
JOINED, TEXTS = 256, 16


def _make_room(known: dict[str, bytes], used: set[str], most: int) -> None:
    """Forget what is not used now, if more than ``most`` is remembered."""
    if len(known) > most:
        kept = {p: known[p] for p in used.intersection(known)}
        known.clear()
        known.update(kept)


class PieceEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    ``max_entries`` bounds the remembered pieces of a worker, half as many of their parts; beyond it only those of the
    texts at hand stay. An empty text has no ids.
    """

    def __init__(self, path: str, max_entries: int = 300_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.max_entries = max_entries
        self.pieces: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [_pack(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str], lead: str) -> list[bytes]:
        """Ids of words of letters behind ``lead`` (a space or nothing), from texts of ``JOINED`` words.

        A word is one pre-token of the joined text. Words without a lead are joined by line ends, which are pre-tokens
        of their own or none. If the number of pre-tokens is another, the words are encoded one by one.
        """
        blocks = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        texts = [lead + (lead or "\n").join(b) for b in blocks]
        out: list[bytes] = []
        some = (self.tokenizer.encode_batch(texts[i:i + TEXTS], add_special_tokens=False) for i in range(0, len(texts), TEXTS))
        for block, e in zip(blocks, chain.from_iterable(some)):
            data, ids, of = _pack(e.ids), e.ids, e.word_ids
            starts = [0, *compress(range(1, len(ids)), map(ne, of[1:], of)), len(ids)]
            parts = len(starts) - 1
            step = 1 if parts == len(block) else 2 if not lead and parts == 2 * len(block) - 1 else 0
            if step:
                at = [4 * i for i in starts]
                out += [data[i:j] for i, j in zip(at[0:parts:step], at[1::step])]
            else:
                out += self._ids([lead + w for w in block])
        return out

    def _parts(self, piece: str, lead: str) -> list[str]:
        if piece[-1:] in _MARKS and piece.isascii() and piece[:-1].isalpha():
            return [lead + piece[:-1], piece[-1]]
        if not piece or piece[0].isspace() or _NOT_PLAIN.search(piece):
            return [lead + piece]
        parts = _RUNS.findall(piece)
        parts[0] = lead + parts[0]
        return parts

    def _learn_runs(self, missing: set[str]) -> None:
        bare, led, rest = [], [], []
        for r in missing:
            if r[0:1] != " ":
                (bare if _is_word(r) else rest).append(r)
            elif (w := r[1:]) in self.pieces:
                self.runs[r] = self.pieces[w]
            else:
                (led if _is_word(w) else rest).append(r)
        self.runs.update(zip(bare, self._words(bare, "")))
        self.runs.update(zip(led, self._words([r[1:] for r in led], " ")))
        self.runs.update(zip(rest, self._ids(rest)))

    def _block(self, texts: list[str]) -> list[bytes]:
        cuts = [_CUT.split(t) if _is_spaced(t) else t.split(" ") for t in texts]
        firsts = [self._parts(c[0], "") for c in cuts]
        used = set(chain.from_iterable(islice(c, 1, None) for c in cuts))
        _make_room(self.pieces, used, self.max_entries)
        new = used.difference(self.pieces)
        words = [p for p in new if _is_word(p)]
        parts = {p: self._parts(p, " ") for p in new.difference(words)}
        runs = set(chain(chain.from_iterable(firsts), chain.from_iterable(parts.values())))
        _make_room(self.runs, runs, self.max_entries // 2)
        self.pieces.update(zip(words, self._words(words, " ")))
        self._learn_runs(runs.difference(self.runs))
        for p, rs in parts.items():
            self.pieces[p] = b"".join([self.runs[r] for r in rs])
        return [b"".join([*[self.runs[r] for r in first], *map(self.pieces.__getitem__, islice(c, 1, None))])
                if text else b"" for text, first, c in zip(texts, firsts, cuts)]

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text in turn; NULL is empty. Texts are taken ``STEP`` characters at a time, a longer one alone."""
        block, size = [], 0
        for text in texts:
            text = text or ""
            if block and size + len(text) > STEP:
                yield from self._block(block)
                block, size = [], 0
            block.append(text)
            size += len(text)
        yield from self._block(block)

    def encode(self, text: str) -> bytes:
        """Ids of one text."""
        return next(self.encode_many([text]))


def _is_word(piece: str) -> bool:
    return (piece.isascii() and piece.isalpha()) or _LETTERS.fullmatch(piece) is not None


def _is_spaced(text: str) -> bool:
    """Whether white space stands before a single space."""
    if text.isascii():
        return any(pair in text for pair in _SPACE_PAIRS)
    return _SPACED.search(text) is not None


def _pack(ids: list[int]) -> bytes:
    data = array("I", ids)
    if sys.byteorder == "big":
        data.byteswap()
    return data.tobytes()


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The encoder of a tokenizer file, kept for the life of a worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
