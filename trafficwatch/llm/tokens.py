"""Whole-text encoding with a ``tokenizers`` vocabulary, each distinct pre-token once.

The vocabulary's pre-tokenizer splits at white space and, inside plain chunks
(ASCII and Latin-1 letters, digits, ASCII symbols), into runs of letters, single
digits and runs of symbols.  Numpy finds those units, a worker keeps the ids of
the units it has met, and the library encodes only new ones.  A chunk with any
other character (or an apostrophe, or ``<|`` of a special token) is one unit,
encoded by the unchanged tokenizer; ids never depend on what stands beyond white
space.
"""

from __future__ import annotations

import os

import numpy as np

from trafficwatch.llm import shared
from trafficwatch.llm.words import byte_set, ranges, span_keys, spans

_JOINED = 1000
_BLANK, _LETTER, _DIGIT, _SYMBOL, _OTHER = range(5)

_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[byte_set((0x09, 0x0D), (0x20, 0x20))] = _BLANK
_CLASS[byte_set((0x41, 0x5A), (0x61, 0x7A))] = _LETTER
_CLASS[byte_set((0x30, 0x39))] = _DIGIT
#: ASCII symbols without the apostrophe, which can begin a contraction.
_CLASS[byte_set((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))] = _SYMBOL
#: Second bytes of the Latin-1 letters U+00C0-U+00FF, without the signs at U+00D7 and U+00F7.
_LATIN = byte_set((0x80, 0xBF)) & ~byte_set((0x97, 0x97), (0xB7, 0xB7))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the units of concatenated texts, in order."""
    kind = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[_LATIN[data[lead + 1]]]
    kind[lead] = _LETTER
    kind[lead + 1] = _LETTER
    kind[np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))] = _OTHER
    starts, ends = spans(kind != _BLANK, offsets)
    new = np.zeros(len(data) + 1, bool)
    new[1:-1] = kind[1:] != kind[:-1]
    new[:-1] |= kind == _DIGIT
    odd = np.flatnonzero(kind == _OTHER)
    for k in np.unique(np.searchsorted(starts, odd, "right") - 1):
        new[starts[k] : ends[k]] = False
    new[starts] = True
    new[ends] = True
    edge = np.flatnonzero(new)
    inside = np.append(kind, _BLANK)[edge] != _BLANK
    inside[-1:] = False
    first = np.flatnonzero(inside)
    return edge[first], edge[first + 1]


class WordEncoder:
    """Ids of whole texts; ``max_words`` bounds the kept units (then it starts afresh)."""

    def __init__(self, path: str, max_words: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: For lower-case words of letters joined by blanks, on which the full normalizer and splitter change nothing.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.max_words = max_words
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.closes[i] = token.endswith("</w>")
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted keys
        self.slot = np.zeros(0, np.int64)  # their places in starts and lengths
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _add(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """``keys``: sorted, none known."""
        n, at = len(keys), len(self.known)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while at + n > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.lengths[at : at + n] = lengths
        self.starts[at : at + n] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        place = np.searchsorted(self.known, keys)
        self.known = np.insert(self.known, place, keys)
        self.slot = np.insert(self.slot, place, np.arange(at, at + n))

    def _each(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        return np.fromiter((i for x in got for i in x), np.uint32), np.array([len(x) for x in got], np.int64)

    def _letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters: each is one pre-token, whose last id alone closes a word."""
        joined = b" ".join(words).decode().lower()
        ids = np.array(self.plain.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) == len(words) and ends[-1] == len(ids):
            return ids, np.diff(ends, prepend=0)
        return self._each(words)

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        plain = np.fromiter((w.isalpha() or _latin_only(w) for w in words), bool, len(words))
        for mask, encode in ((plain, self._letters), (~plain, self._each)):
            rows = np.flatnonzero(mask)
            if len(rows):
                parts = [encode([words[k] for k in rows[i : i + _JOINED]]) for i in range(0, len(rows), _JOINED)]
                self._add(keys[rows], *(np.concatenate(x) for x in zip(*parts)))

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(self.known, keys)
        hit = place < len(self.known)
        hit[hit] = self.known[place[hit]] == keys[hit]
        return place, hit

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text) of concatenated UTF-8 texts."""
        starts, ends = units(data, offsets) if len(data) else (np.zeros(0, np.int64),) * 2
        keys, first, where = np.unique(span_keys(data, starts, ends - starts), return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > self.max_words:
            self._clear()
        place, hit = self._find(keys)
        if not hit.all():
            raw, rows = data.tobytes(), first[~hit]
            self._learn(keys[~hit], [raw[a:b] for a, b in zip(starts[rows].tolist(), ends[rows].tolist())])
            place, _ = self._find(keys)
        idx = self.slot[place][where]
        lengths = self.lengths[idx]
        bounds = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, offsets)]
        return self.flat[ranges(self.starts[idx], lengths)], np.diff(bounds)


def _latin_only(word: bytes) -> bool:
    """Letters of ASCII and Latin-1 only."""
    text = word.decode()
    return text.isalpha() and max(text) <= "\xff" and "\xaa" not in text and "\xb5" not in text and "\xba" not in text


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process and vocabulary file, until the worker runs another operator."""
    shared.keep_cache("tokens", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
