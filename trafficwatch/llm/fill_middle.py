"""Fill-in-middle sequences, cut by descent in a Fenwick tree over text blocks.

A text is split into blocks of ``block_bytes``.  For every block the number of
units (code points, words or lines) that begin in it, and of code points, is
held in a Fenwick tree.  A cut after k units is found by binary lifting: the
descent ends at the block in which unit k begins and gives the units and code
points before it; only that block is then looked through for the boundary.
Trees of all texts of an Arrow slice are built and searched together.

Units: ``code_points``; ``words`` (a run without blanks and the blanks behind
it, leading blanks belong to the first word); ``lines`` (with their line feed).

The draws of a row are h1 to h4, the first four 8-digit groups of the hex
SHA-256 of ``<seed>:<doc_id>``.  With n units, the prefix ends after the smaller
and the middle after the larger of h1 % (n + 1) and h2 % (n + 1).

Defined results: null or empty text, and a text that contains a mark, is
``plain``, as are ``plain_percent`` of the rows; a null id is drawn as an empty
one; rows that repeat an id have the same draws, each on its own text; there
are no ties; a very long text is looked through in pieces of ``CHUNK_BYTES``, so
it needs a few copies of itself; an empty table gives no rows; columns other
than ``doc_id`` and ``text`` are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm import shared
from trafficwatch.llm.words import NOT_BLANK

MARKS = ("<P>", "<S>", "<M>")
_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _leads(piece: np.ndarray) -> np.ndarray:
    """Bytes that begin a code point."""
    return (piece & 0xC0) != 0x80


def unit_starts(data: np.ndarray, low: int, high: int, first: np.ndarray, unit: str) -> np.ndarray:
    """Which bytes of data[low:high] begin a unit; ``first``: positions where texts begin."""
    piece = data[low:high]
    if unit == "code_points":
        return _leads(piece)
    before = np.concatenate([data[low - 1 : low] if low else np.zeros(1, np.uint8), piece[:-1]])
    if unit == "words":
        out = NOT_BLANK[piece] & ~NOT_BLANK[before]
        ahead = first[(first >= low) & (first < high)] - low
        out[ahead] = True
        return out
    if unit == "lines":
        out = before == 10
        out[first[(first >= low) & (first < high)] - low] = True
        return out
    raise ValueError(f"unknown unit {unit!r}")


class BlockTrees:
    """Fenwick trees of unit and code-point counts over the blocks of several texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, unit: str = "code_points", block_bytes: int = 1024):
        self.data, self.offsets, self.unit, self.block_bytes = data, offsets, unit, block_bytes
        size = np.diff(offsets)
        self.blocks = -(-size // block_bytes)
        self.base = np.cumsum(self.blocks) - self.blocks
        text = np.repeat(np.arange(len(size)), self.blocks)
        self.place = np.arange(len(text)) - self.base[text] + 1  # from 1 inside its text
        self.starts = offsets[text] + (self.place - 1) * block_bytes
        self.ends = np.minimum(self.starts + block_bytes, offsets[text + 1])
        self.first = offsets[:-1][size > 0]
        self.units, self.chars = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
        step = max(1, shared.CHUNK_BYTES // block_bytes)
        for k in range(0, len(text), step):
            low, high = int(self.starts[k]), int(self.ends[min(k + step, len(text)) - 1])
            at = self.starts[k : k + step] - low
            self.units[k : k + step] = np.add.reduceat(self._unit_starts(low, high).astype(np.int64), at)
            self.chars[k : k + step] = np.add.reduceat(_leads(data[low:high]).astype(np.int64), at)
        self.total = np.zeros(len(size), np.int64)
        np.add.at(self.total, text, self.units)
        bit, last = 1, int(self.blocks.max(initial=0))
        while bit <= last:
            # places with this lowest bit add what they hold to the node above; no two share one
            own = np.flatnonzero((self.place & (2 * bit - 1) == bit) & (self.place + bit <= self.blocks[text]))
            self.units[own + bit] += self.units[own]
            self.chars[own + bit] += self.chars[own]
            bit *= 2

    def _unit_starts(self, low: int, high: int) -> np.ndarray:
        out = unit_starts(self.data, low, high, self.first, self.unit)
        if self.unit == "words":
            out &= ~self._after_leading_blanks(low, high)
        return out

    def _after_leading_blanks(self, low: int, high: int) -> np.ndarray:
        """The first word of a text that begins with blanks: no unit of its own."""
        out = np.zeros(high - low, bool)
        if not hasattr(self, "_inner"):
            inner = []
            for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
                if a < b and not NOT_BLANK[self.data[a]]:
                    at = a
                    while at < b:
                        found = np.flatnonzero(NOT_BLANK[self.data[at : min(at + 4096, b)]])
                        if len(found):
                            inner.append(at + int(found[0]))
                            break
                        at += 4096
            self._inner = np.array(inner, np.int64)
        out[self._inner[(self._inner >= low) & (self._inner < high)] - low] = True
        return out

    def cut(self, text: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte position in the data, code points before it in the text) of the cut after so many units."""
        at = np.zeros(len(text), np.int64)
        left, chars = after.astype(np.int64).copy(), np.zeros(len(text), np.int64)
        size = self.blocks[text]
        step = 1 << max(0, int(self.blocks.max(initial=0)).bit_length() - 1)
        while step:
            on = np.flatnonzero(at + step <= size)
            node = self.base[text[on]] + at[on] + step - 1
            down = self.units[node] <= left[on]
            on, node = on[down], node[down]
            at[on] += step
            left[on] -= self.units[node]
            chars[on] += self.chars[node]
            step //= 2
        where = self.offsets[text + 1].copy()
        for k in np.flatnonzero(at < size).tolist():
            block = int(self.base[text[k]] + at[k])
            low, high = int(self.starts[block]), int(self.ends[block])
            inside = int(np.flatnonzero(self._unit_starts(low, high))[left[k]])
            where[k] = low + inside
            chars[k] += int(np.count_nonzero(_leads(self.data[low : low + inside])))
        return where, chars


def _draw(seed: int, k: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, unit: str = "code_points", plain_percent: int = 10, suffix_first_percent: int = 20, seed: int = 1, marks: tuple[str, str, str] = MARKS, block_bytes: int = 1024) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars (null if plain), output of every row."""
    shared.with_python(docs.sparkSession)
    prefix_mark, suffix_mark, middle_mark = (m.encode() for m in marks)

    def run(batches):
        for batch in shared.by_bytes(batches, 1):
            data, offsets = shared.utf8_buffers(batch.column(1))
            trees = BlockTrees(data, offsets, unit, block_bytes)
            forms = batch.column(2).to_pylist()
            rows = np.flatnonzero(np.array([f != "plain" for f in forms], bool))
            h = [batch.column(c).to_numpy()[rows] % (trees.total[rows] + 1) for c in (3, 4)]
            ends, chars = trees.cut(np.tile(rows, 2), np.concatenate([np.minimum(*h), np.maximum(*h)]))
            n = len(rows)
            known = dict(zip(rows.tolist(), zip(ends[:n].tolist(), ends[n:].tolist(), chars[:n].tolist(), (chars[n:] - chars[:n]).tolist())))
            out, before, inside = [], [], []
            for k, form in enumerate(forms):
                low, high = int(offsets[k]), int(offsets[k + 1])
                if form == "plain":
                    out.append(data[low:high].tobytes())
                    before.append(None)
                    inside.append(None)
                    continue
                one, two, chars_before, chars_inside = known[k]
                prefix, middle, suffix = data[low:one].tobytes(), data[one:two].tobytes(), data[two:high].tobytes()
                first = (prefix_mark, prefix, suffix_mark, suffix) if form == "psm" else (suffix_mark, suffix, prefix_mark, prefix)
                out.append(b"".join((*first, middle_mark, middle)))
                before.append(chars_before)
                inside.append(chars_inside)
            columns = [batch.column(0), pa.array(trees.total), batch.column(2), pa.array(before, pa.int64()), pa.array(inside, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    text = F.coalesce(F.col("text"), F.lit(""))
    marked = F.contains(text, F.lit(marks[0])) | F.contains(text, F.lit(marks[1])) | F.contains(text, F.lit(marks[2]))
    plain = (text == "") | marked | (_draw(seed, 3) % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(_draw(seed, 4) % 100 < suffix_first_percent, "spm").otherwise("psm")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), form.alias("form"), _draw(seed, 1).alias("h1"), _draw(seed, 2).alias("h2"))
    return rows.mapInArrow(run, _SCHEMA)


def restored(form: Column, output: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from."""
    first_mark = F.when(form == "psm", F.lit(marks[1])).otherwise(F.lit(marks[0]))
    opening = F.when(form == "psm", F.lit(marks[0])).otherwise(F.lit(marks[1]))

    def behind(text: Column, taken: Column, mark: Column) -> Column:
        return F.substring(text, F.char_length(taken) + F.char_length(mark) + 1, F.char_length(text))

    body = F.substring(output, F.char_length(opening) + 1, F.char_length(output))
    one = F.split_part(body, first_mark, F.lit(1))
    rest = behind(body, one, first_mark)
    two = F.split_part(rest, F.lit(marks[2]), F.lit(1))
    middle = behind(rest, two, F.lit(marks[2]))
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))
