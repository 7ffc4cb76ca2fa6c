"""Keyed state of the alert job: claims with a TTL, and first-arrival digests with timers.

Both run under ``transformWithState``: their state is Spark's own (RocksDB with
a changelog), so a batch writes only the keys it changed, and state follows the
query's checkpoint.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from decimal import Decimal, localcontext
from typing import Any

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

#: Prefixes of the grouping key: rows that take part in claims, and rows that only pass.
CLAIMED, PASSED = "k", "p"
#: Parts that a digest's sources are kept in.
SOURCE_PARTS = 64
#: A digest as it is sent.
SENT = Row("k", "opened_us", "we_min", "we_max", "ips", "ip_count", "rc", "rp", "n")


def batch_number() -> int:
    """The micro-batch that the running task belongs to."""
    from pyspark import TaskContext

    return int(TaskContext.get().getLocalProperty("streaming.sql.batchId") or 0)


class Claims(StatefulProcessor):
    """Adds ``disposition`` to rows whose last columns are arrival_us, tie and outcome (null: to be judged).

    A row costs by its columns and a key by its calls to the store, so rows
    should come as they were sent, not decoded.

    The state is a key's last claim.  It leaves the store ``keep_seconds`` of
    processing time after it was written.
    """

    def __init__(self, ttl_seconds: float, keep_seconds: float):
        self.ttl, self.keep_ms = int(round(ttl_seconds * 1_000_000)), int(keep_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("claim", "claim_us long", ttlDurationMs=self.keep_ms)

    @staticmethod
    def _judged(row: Row, outcome: str) -> Row:
        return Row(*row.__fields__[1:-2], "disposition")(*row[1:-2], outcome)  # without the group

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        if not key[0].startswith(CLAIMED):
            for row in rows:
                yield self._judged(row, row[-1])
            return
        held = self.last.get()  # None without a claim; every call asks the JVM
        claim = before = held[0] if held else None
        timed, untimed = [], []
        for row in rows:
            (untimed if row[-3] is None else timed).append(row)
        for row in sorted(timed, key=lambda r: (r[-3], r[-2])):
            # a late record counts at the time its key has reached: inside the claim
            taken = claim is not None and row[-3] < claim + self.ttl
            if not taken:
                claim = row[-3]
            yield self._judged(row, "duplicate" if taken else "accepted")
        for row in untimed:
            yield self._judged(row, "accepted")
        if claim != before:
            self.last.update((claim,))

    def close(self) -> None:
        pass


class Digests(StatefulProcessor):
    """Closes a key's digest when an arrival lies beyond its window or, on the processing clock, when its timer fires.

    ``digest`` holds the sums and the first ``max_ips`` sources, ``sources`` all
    distinct sources in ``SOURCE_PARTS`` parts, of which a batch writes the
    ones that got a new source.  What a flush after batch ``flushed`` has sent
    is dropped when its key is next seen.
    """

    _SUMS = "opened_us long, n long, rc string, rp string, we_min long, we_max long, ip_count long, first array<struct<us: long, ip: string>>, batch long"

    def __init__(self, window_seconds: float, max_ips: int, timers: bool, flushed: int):
        self.window_us, self.max_ips, self.timers, self.flushed = int(round(window_seconds * 1_000_000)), max_ips, timers, flushed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.digest = handle.getValueState("digest", self._SUMS)
        self.sources = handle.getMapState("sources", "part int", "ips array<string>")

    def _current(self) -> dict | None:
        found = self.digest.get()
        if found is None:
            return None
        opened, n, rc, rp, low, high, ip_count, first, batch = found
        if batch <= self.flushed:
            self._forget()
            return None
        sums = {"n": n, "rc": Decimal(rc), "rp": Decimal(rp), "low": low, "high": high}
        return {"opened": opened, **sums, "ip_count": ip_count, "first": {f[1]: f[0] for f in first}, "seen": {}, "stored": True}

    def _forget(self) -> None:
        self.digest.clear()
        self.sources.clear()

    @staticmethod
    def _empty(opened: int | None) -> dict:
        """``seen``: sources of this batch with their first arrival; ``stored``: whether earlier ones are in the store."""
        return {"opened": opened, "n": 0, "rc": Decimal(0), "rp": Decimal(0), "low": None, "high": None, "ip_count": 0, "first": {}, "seen": {}, "stored": False}

    @staticmethod
    def _add(held: dict, rows: list[Row]) -> None:
        seen = held["seen"]
        with localcontext(prec=60):
            for ip, us, n, rc, rp, low, high in rows:
                held["n"] += n
                held["rc"] += rc
                held["rp"] += rp
                held["low"] = low if held["low"] is None else held["low"] if low is None else min(low, held["low"])
                held["high"] = high if held["high"] is None else held["high"] if high is None else max(high, held["high"])
                seen[ip] = us if ip not in seen else min(us, seen[ip])

    def _settle(self, held: dict, keep: bool) -> None:
        """Count the batch's sources into the digest; ``keep`` writes them to the store, for a digest that stays open.

        The store is asked once a batch and part, and not at all for a digest
        that opens and closes within a batch.
        """
        seen, first = held["seen"], held["first"]
        if held["stored"] or keep:
            parts: dict[int, set[str]] = {}
            for ip in seen:
                parts.setdefault(zlib.crc32(ip.encode()) % SOURCE_PARTS, set()).add(ip)
            for part, some in parts.items():
                old = set(self.sources.getValue((part,))[0]) if held["stored"] and self.sources.containsKey((part,)) else set()
                if some - old:
                    held["ip_count"] += len(some - old)
                    if keep:
                        self.sources.updateValue((part,), (sorted(old | some),))
        else:
            held["ip_count"] = len(seen)
        for ip, us in seen.items():
            first[ip] = us if ip not in first else min(us, first[ip])
        held["first"] = dict(sorted(first.items(), key=lambda f: (f[1] or 0, f[0]))[: self.max_ips])

    @staticmethod
    def _sent(key: Any, held: dict) -> Row:
        return SENT(key[0], held["opened"], held["low"], held["high"], list(held["first"]), held["ip_count"], str(held["rc"]), str(held["rp"]), held["n"])

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        held, opened = self._current(), False
        timed: dict[int, list[tuple]] = {}
        untimed: list[tuple] = []
        for row in rows:
            fields = tuple(row)[1:]  # behind the key
            (untimed if fields[1] is None else timed.setdefault(fields[1], [])).append(fields)
        if untimed:  # without a time: a digest of their own, sent with their batch
            alone = self._empty(None)
            self._add(alone, untimed)
            self._settle(alone, keep=False)
            yield self._sent(key, alone)
        for us in sorted(timed):
            if held is not None and us >= held["opened"] + self.window_us:
                self._settle(held, keep=False)
                yield self._sent(key, held)
                if held["stored"]:
                    self._forget()
                held = None
            if held is None:
                held, opened = self._empty(us), True
            self._add(held, timed[us])
        if not timed:
            return
        if opened and self.timers:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.window_us // 1000)
        self._settle(held, keep=True)
        first = [(us, ip) for ip, us in held["first"].items()]
        self.digest.update((held["opened"], held["n"], str(held["rc"]), str(held["rp"]), held["low"], held["high"], held["ip_count"], first, batch_number()))

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        held = self._current()
        if held is not None:
            yield self._sent(key, held)
            self._forget()

    def close(self) -> None:
        pass
