"""Glob rules over URLs as one bit-parallel Shift-And automaton.

All patterns lie side by side in one bit row of 64-bit words; a step shifts
the row, masks it by the character read, and lets wildcard positions hold
their bit.  Wildcards can be passed without a character: their positions are a
mask too, shifted once for each wildcard that touches the one before.  Numpy
runs the step for a whole batch of URLs, each on its own row, so its cost is
that of its words, whatever the rules in them.

A rule is ``host/path-prefix``: it fits its host and every subdomain if the
URL's path begins with the rule's path.  As a glob over the canonical URL
(a dot, the lower-cased host, the path) it reads ``*.host/path**``, where ``*``
takes any byte but a slash and ``**`` any byte.  Of the rules that fit, the
longest wins (among equal lengths the one listed first); none leaves the default.

Defined results: a null url or one without ``://`` has empty host and path
and gets the default; an empty path fits no rule; rows that repeat an id or url
are judged each; a very long url takes one step a byte, alone at the end of its
batch; an empty table gives no rows; columns other than ``page_id`` and ``url``
are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm import shared

#: (verdict, rule); fixed values of the registered query.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DEFAULT = "allow"
_SLASH = 0x2F
#: Results (url, rule) that one pass holds.
_CELLS = 1 << 22


def rule_glob(rule: str) -> str:
    """The canonical-URL glob of a ``host/path`` rule."""
    return f"*.{rule}**"


class ShiftAnd:
    """Multiword Shift-And over glob patterns with ``*`` (no slash) and ``**`` (anything)."""

    def __init__(self, globs: list[str]):
        symbols: list[list[bytes | int]] = []
        for glob in globs:
            raw, out, k = glob.encode(), [], 0
            while k < len(raw):
                if raw[k : k + 2] == b"**":
                    out.append(b"**")
                    k += 2
                elif raw[k : k + 1] == b"*":
                    out.append(b"*")
                    k += 1
                else:
                    out.append(raw[k])
                    k += 1
            symbols.append(out)
        # one state before each symbol and one at the end; bit p is "the symbols before p are read"
        total = sum(len(s) + 1 for s in symbols)
        self.words = -(-total // 64)
        self.step = np.zeros((256, self.words), np.uint64)  # states that a byte moves on from
        self.hold = np.zeros((256, self.words), np.uint64)  # states that a byte leaves as they are
        self.start = np.zeros(self.words, np.uint64)
        self.skip = np.zeros(self.words, np.uint64)  # wildcards: passed without a byte
        ends: list[int] = []
        at = run = self.passes = 0
        for out in symbols:
            self._set(self.start, at)
            for k, x in enumerate(out):
                if isinstance(x, int):
                    self._set(self.step[x], at + k)
                    run = 0
                else:
                    self._set(self.skip, at + k)
                    run += 1
                    self.passes = max(self.passes, run)
                    for byte in range(256):
                        if x == b"**" or byte != _SLASH:
                            self._set(self.hold[byte], at + k)
            ends.append(at + len(out))
            at, run = at + len(out) + 1, 0
        self.ends = np.array(ends, np.int64)
        self.start = self._closed(self.start[None, :].copy())[0]

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1 << (bit % 64))

    @staticmethod
    def _shifted(state: np.ndarray) -> np.ndarray:
        """Every bit one place on, over the words."""
        out = state << np.uint64(1)
        out[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return out

    def _closed(self, state: np.ndarray) -> np.ndarray:
        """Adds the states reached by passing wildcards."""
        for _ in range(self.passes):
            state |= self._shifted(state & self.skip)
        return state

    def match(self, texts: list[bytes]) -> np.ndarray:
        """Boolean (text, pattern): whole-text matches."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lengths = np.array([len(texts[k]) for k in order], np.int64)
        data = np.frombuffer(b"".join(texts[k] for k in order) + b"\0", np.uint8)
        starts = np.cumsum(lengths) - lengths
        state = np.repeat(self.start[None, :], len(texts), 0)
        for at in range(int(lengths[0]) if len(texts) else 0):
            live = int(np.searchsorted(-lengths, -at, "left"))  # the longer texts come first
            byte = data[starts[:live] + at]
            now = state[:live]
            state[:live] = self._closed(self._shifted(now & self.step[byte]) | (now & self.hold[byte]))
        found = np.zeros((len(texts), len(self.ends)), bool)
        found[order] = (state[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64)) & np.uint64(1) != 0
        return found


def canonical(pages: DataFrame) -> DataFrame:
    """(page_id, host, path) by built-in string functions."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate("_host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = pages.select(F.col("page_id"), rest.alias("_rest"))
    rows = rows.withColumn("_host", F.regexp_extract("_rest", r"^[^/?#]*", 0))
    tail = F.expr("substring(_rest, char_length(_host) + 1)")
    return rows.select("page_id", host.alias("host"), F.regexp_extract(tail, r"^[^?#]*", 0).alias("path"))


def judge(pages: DataFrame, rules=RULES, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict of every row of ``pages`` (page_id, url)."""
    spark = pages.sparkSession
    shared.with_python(spark)
    ranked = sorted(range(len(rules)), key=lambda k: -len(rules[k][1]))
    globs = [rule_glob(rules[k][1]) for k in ranked]

    def run(batches):
        automaton = ShiftAnd(globs) if globs else None
        for batch in shared.by_bytes(batches, 2):
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            rule, verdict = [None] * batch.num_rows, [default] * batch.num_rows
            if automaton:
                urls = [b"." + h.encode() + p.encode() for h, p in zip(hosts, paths)]
                some = max(1, _CELLS // len(globs))
                for at in range(0, len(urls), some):
                    found = automaton.match(urls[at : at + some])
                    first = found.argmax(1)
                    for row in np.flatnonzero(found.any(1)).tolist():
                        verdict[at + row], rule[at + row] = rules[ranked[first[row]]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    return canonical(pages.select(F.col("page_id").cast("long"), "url")).mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
