"""Words of UTF-8 text as numpy spans and 64-bit keys."""

from __future__ import annotations

import numpy as np

from trafficwatch.llm.shared import CHUNK_BYTES

#: Multipliers of the splitmix64 finaliser (fixed values).
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Keeps the first k bytes of a little-endian 64-bit word.
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)

#: ASCII bytes with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table of the 256 bytes in the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: After lower-casing: digits, a-z and every byte of a non-ASCII character.
LETTERS_DIGITS = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Everything but a blank and the controls 0x09-0x0D.
NOT_BLANK = ~byte_set((0x20, 0x20), (0x09, 0x0D))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def span_keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit key of each span: distinct for spans of up to 8 bytes, a hash beyond."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    keys = np.zeros(len(starts), np.uint64)
    todo, step = np.arange(len(starts)), 0
    while len(todo):
        at, left = starts[todo] + step, lengths[todo] - step
        block = windows[at].view(np.uint64).ravel() & _KEEP[np.minimum(left, 8)]
        keys[todo] = mix(keys[todo] * _GOLDEN + block + np.uint64(step))
        step += 8
        todo = todo[left > 8]
    return keys ^ mix(lengths.astype(np.uint64))


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross a text's bounds: (starts, ends)."""
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(inside)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    cuts = offsets[1:][(offsets[1:] > 0) & (offsets[1:] <= len(inside))] - 1
    after[cuts] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def word_keys(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys of all words, words per text) of lower-cased texts.

    ``data``/``offsets``: concatenated UTF-8; ``member``: bytes that belong to
    words.  Works through the bytes in bounded pieces cut between words, so a
    very long text needs no more than its words' keys.
    """
    keys: list[np.ndarray] = []
    counts = np.zeros(len(offsets) - 1, np.int64)
    at, end = 0, int(offsets[-1])
    while at < end:
        to = min(at + CHUNK_BYTES, end)
        while to < end and member[LOWER[data[to]]] and member[LOWER[data[to - 1]]] and not _is_bound(offsets, to):
            tail = member[LOWER[data[to : to + 65536]]]
            stop = int(np.argmin(tail)) if not tail.all() else len(tail)
            bound = int(offsets[np.searchsorted(offsets, to, "right")])
            to = min(to + stop, bound)
        low = LOWER[data[at:to]]
        local = np.clip(offsets[np.searchsorted(offsets, at, "right") - 1 : np.searchsorted(offsets, to, "left") + 1] - at, 0, to - at)
        starts, ends = spans(member[low], local)
        keys.append(span_keys(low, starts, ends - starts))
        texts = np.searchsorted(offsets, starts + at, "right") - 1
        counts += np.bincount(texts, minlength=len(counts))
        at = to
    return (np.concatenate(keys) if keys else np.zeros(0, np.uint64)), counts


def _is_bound(offsets: np.ndarray, at: int) -> bool:
    k = int(np.searchsorted(offsets, at))
    return k < len(offsets) and int(offsets[k]) == at


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + length) for every pair."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + lengths, lengths) + np.arange(total)
