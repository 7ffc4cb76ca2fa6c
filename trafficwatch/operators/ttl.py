"""First-claim time-to-live over keyed event times.

Semantics (per key, in time order): the first event claims the key; later
events within ``ttl`` of that claim are suppressed; the first event at or
after ``claim + ttl`` claims it again.  Claims are therefore at least ``ttl``
apart and each event belongs to the most recent claim at or before it.

The chain is order-dependent, so it is not a window or aggregate function.
One plan serves keys of any size:

1. distinct (key, time) pairs (map-side partial aggregation), dealt out by key
   and *stretch* of time (``STRETCH`` TTLs), so that no key is one task's work;
2. every stretch tells, for each claim it could inherit, the last claim it
   would leave: a short sorted table, since only events less than one TTL after
   the stretch's first one can be the first to claim in it;
3. per key, the stretches' tables are followed in order of time, which gives the
   claim that each stretch inherits;
4. every stretch is folded from its inherited claim.

Each pair leaves with the time of the claim it belongs to (``claim_us``) and
whether it is itself a claim.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficwatch.session import ship_package

#: Length of a stretch in TTLs.
STRETCH = 16
_NONE = -(2**62)
_CLAIMS = "k string, t_us long, claim_us long, claimed boolean"
_EXITS = "k string, stretch long, first_us long, until array<long>, leaves array<long>"


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that end with a whole (k, stretch) group; rows arrive sorted by it."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < 2:
            continue
        begins = _starts(held)
        if len(begins) > 1:
            yield held.slice(0, int(begins[-1]))
            held = held.slice(int(begins[-1]))
    if held is not None and held.num_rows:
        yield held


def _starts(table: pa.Table) -> np.ndarray:
    """First row of each (k, stretch) group."""
    keys = table["k"].combine_chunks().dictionary_encode("encode").indices.to_numpy()
    stretch = table["stretch"].to_numpy()
    return np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (stretch[1:] != stretch[:-1])]))


def _next_claims(t: np.ndarray, begins: np.ndarray, ttl: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the first row at or after t + ttl in the row's group, or the group's end; axis; its shift by group).

    The groups lie end to end on one increasing axis, more than a TTL apart.
    """
    ends = np.append(begins[1:], len(t))
    least = t[begins]
    room = t[ends - 1] - least + 2 * ttl + 1
    shift = np.concatenate([[0], np.cumsum(room)[:-1]]) - least
    group = np.repeat(np.arange(len(begins)), ends - begins)
    axis = t + shift[group]
    return np.minimum(np.searchsorted(axis, axis + ttl), ends[group]), axis, shift


def _exits(ttl: int):
    """Per stretch: for a first claim at or before ``until[i]`` (and after ``until[i - 1]``), its last claim ``leaves[i]``."""

    def run(batches):
        for table in _whole_groups(batches):
            t, begins = table["t_us"].to_numpy(), _starts(table)
            ends = np.append(begins[1:], len(t))
            size = ends - begins
            then, _, _ = _next_claims(t, begins, ttl)
            here = np.arange(len(t))
            last = np.where(then < np.repeat(ends, size), then, here)
            while (last[last] != last).any():
                last = last[last]
            # rows that can be the first to claim: those in the first TTL, and the one after them
            can = here <= np.repeat(then[begins], size)
            final = np.ones(len(t), bool)  # the last row of each run with one exit
            final[:-1] = (last[1:] != last[:-1]) | ~can[1:]
            final[ends - 1] = True
            rows = np.flatnonzero(can & final)
            offsets = np.searchsorted(rows, np.append(begins, len(t))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (t[rows], t[last[rows]])]
            keys = table.take(pa.array(begins)).combine_chunks()
            yield from pa.table({"k": keys["k"], "stretch": keys["stretch"], "first_us": pa.array(t[begins]), "until": lists[0], "leaves": lists[1]}).to_batches()

    return run


def _entries(ttl: int):
    """Per key, in order of time: the claim each stretch inherits (null: none)."""

    def run(batches):
        key, claim = None, _NONE
        for batch in batches:
            out = []
            keys, first = batch.column(0).to_pylist(), batch.column(2).to_numpy()
            for row, k in enumerate(keys):
                if claim == _NONE or k != key:
                    key, claim = k, _NONE
                out.append(claim)
                until = batch.column(3)[row].values.to_numpy()
                at = 0 if claim + ttl <= first[row] else int(np.searchsorted(until, claim + ttl))
                if at < len(until):
                    claim = int(batch.column(4)[row].values[at].as_py())
            entry = pa.array(out, pa.int64(), mask=np.array(out) == _NONE) if out else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), entry], names=["k", "stretch", "entry_us"])

    return run


def _fold(ttl: int):
    """Claims of each stretch, from the claim it inherits (``entry_us``)."""

    def run(batches):
        for table in _whole_groups(batches):
            t, begins = table["t_us"].to_numpy(), _starts(table)
            ends = np.append(begins[1:], len(t))
            then, axis, shift = _next_claims(t, begins, ttl)
            entry = table["entry_us"].combine_chunks().fill_null(_NONE).to_numpy()
            own = entry[begins]
            free = np.maximum(np.where(own == _NONE, t[begins], own + ttl), t[begins])
            at = np.minimum(np.searchsorted(axis, free + shift), ends)
            claimed = np.zeros(len(t), bool)
            stop = ends
            while len(at):
                live = at < stop
                at, stop = at[live], stop[live]
                claimed[at] = True
                at = then[at]
            owner = np.maximum.accumulate(np.where(claimed, np.arange(len(t)), -1))
            inherited = owner < np.repeat(begins, ends - begins)
            claim = np.where(inherited, entry, t[np.maximum(owner, 0)])
            yield from pa.table({"k": table["k"], "t_us": pa.array(t), "claim_us": pa.array(claim), "claimed": pa.array(claimed)}).to_batches()

    return run


def ttl_claims(df: DataFrame, key: Column, time: Column, ttl_seconds: float) -> DataFrame:
    """Distinct (k, t_us) of ``df`` with ``claim_us`` and ``claimed``; rows without a time take no part."""
    ship_package(df.sparkSession)
    ttl = int(round(ttl_seconds * 1_000_000))
    if ttl <= 0:
        raise ValueError("ttl must be positive")
    rows = df.select(key.cast("string").alias("k"), F.unix_micros(time.cast("timestamp")).alias("t_us"))
    pairs = rows.filter(F.col("t_us").isNotNull()).distinct()
    pairs = pairs.withColumn("stretch", F.floor(F.col("t_us") / F.lit(STRETCH * ttl)).cast("long")).repartition("k", "stretch")
    exits = pairs.sortWithinPartitions("k", "stretch", "t_us").select("k", "t_us", "stretch").mapInArrow(_exits(ttl), _EXITS)
    entries = exits.repartition("k").sortWithinPartitions("k", "stretch").mapInArrow(_entries(ttl), "k string, stretch long, entry_us long")
    # an inner join: every stretch has exactly one entry
    same = F.col("p.k").eqNullSafe(F.col("e.k")) & (F.col("p.stretch") == F.col("e.stretch"))
    joined = pairs.alias("p").join(entries.alias("e"), same).select("p.k", "p.t_us", "p.stretch", "e.entry_us")
    return joined.repartition("k", "stretch").sortWithinPartitions("k", "stretch", "t_us").mapInArrow(_fold(ttl), _CLAIMS)


def dedupe_ttl(df: DataFrame, key: Column, time: Column, ttl_seconds: float, tie: Column, where: Column | None = None) -> DataFrame:
    """``df`` plus ``is_duplicate``: False only for the row that claims its key.

    ``tie`` orders rows that share key and time, by its own type (an offset as
    a number); of rows that repeat wholly one is taken.  Rows without a time
    can't be placed in the chain and are never suppressed.  Only rows matching
    ``where`` take part; the others get a null ``is_duplicate``.  ``df`` is
    read twice (claims, then the probe), so store an expensive input first.
    """
    rows = df.withColumn("_k", key.cast("string")).withColumn("_t", F.unix_micros(time.cast("timestamp"))).withColumn("_tie", tie)
    rows = rows.withColumn("_in", F.lit(True) if where is None else F.coalesce(where, F.lit(False)))
    claims = ttl_claims(df if where is None else df.filter(where), key, time, ttl_seconds).filter("claimed")
    won = claims.select(F.col("k").alias("_ck"), F.col("t_us").alias("_ct"))
    out = rows.join(won, F.col("_k").eqNullSafe(F.col("_ck")) & (F.col("_t") == F.col("_ct")), "left")
    # rows that can't win need no ranking: they stay spread
    can = F.col("_in") & F.col("_ct").isNotNull()
    out = out.withColumn("_spread", F.when(can, -1).otherwise(F.spark_partition_id()))
    rank = F.row_number().over(Window.partitionBy("_k", "_t", "_spread").orderBy(~F.col("_in"), "_tie"))
    out = out.withColumn("_won", can & (rank == 1))
    judged = F.when(F.col("_in"), F.col("_t").isNotNull() & ~F.col("_won"))
    return out.withColumn("is_duplicate", judged).drop("_k", "_t", "_tie", "_in", "_ck", "_ct", "_spread", "_won")


def assign_first_arrival(df: DataFrame, key: Column, time: Column, window_seconds: float) -> DataFrame:
    """``df`` plus ``opened_at``: start of the first-arrival window it falls in (null without a time).

    A window opens at a key's first arrival and takes every arrival before
    ``opened_at + window_seconds``; the next arrival opens the next window.
    """
    claims = ttl_claims(df, key, time, window_seconds)
    owner = claims.select(F.col("k").alias("_ck"), F.col("t_us").alias("_ct"), F.col("claim_us"))
    rows = df.withColumn("_k", key.cast("string")).withColumn("_t", F.unix_micros(time.cast("timestamp")))
    out = rows.join(owner, F.col("_k").eqNullSafe(F.col("_ck")) & (F.col("_t") == F.col("_ct")), "left")
    return out.withColumn("opened_at", F.timestamp_micros(F.col("claim_us"))).drop("_k", "_t", "_ck", "_ct", "claim_us")
