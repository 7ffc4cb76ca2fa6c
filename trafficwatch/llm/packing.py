"""First-fit-decreasing packing of documents into fixed-length token sequences.

A document's ids (plus the end id) are cut into full pieces of the sequence
length and one rest.  Full pieces are sequences by themselves.  The rests go
to random groups of bounded size, and in each group a tournament tree over
the bins' free room finds the first bin that fits the next largest rest.

Defined results: a null or empty text is its end id alone; every row is a
document of its own, also if it repeats another; pieces that tie in
length are placed in the order of the random group; a very long text is encoded
whole, its full-length pieces are sequences by themselves; an empty table gives
no pieces; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm import shared
from trafficwatch.llm.tokens import default_path, encoder

_PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def tokenize(docs: DataFrame, capacity: int, end_id: int, tokenizer_path: str) -> DataFrame:
    """Pieces of at most ``capacity`` ids; ``ids``: little-endian unsigned 32-bit."""

    def run(batches):
        for batch in shared.by_bytes(batches, 1):
            got, counts = encoder(tokenizer_path).encode(*shared.utf8_buffers(batch.column(1)))
            ids = np.insert(got, np.cumsum(counts), end_id).astype("<u4")
            totals = counts + 1
            n = -(-totals // capacity)
            row = np.repeat(np.arange(len(totals)), n)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * capacity
            length = np.minimum(capacity, totals[row] - start)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(totals[row]),
                    shared.pack_binary(ids, np.concatenate([[0], np.cumsum(length)])),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "ids"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(run, _PIECES)


class BinTree:
    """Tournament tree over bins in opening order; each node holds the most free room below it."""

    def __init__(self, n: int, capacity: int):
        self.size = 1 << max(0, (n - 1).bit_length())
        self.room = [capacity] * (2 * self.size)

    def place(self, need: int) -> tuple[int, int]:
        """Put ``need`` into the first bin with that room: (bin, room it had)."""
        room, at = self.room, 1
        while at < self.size:
            at *= 2
            if room[at] < need:
                at += 1
        had = room[at]
        room[at] = had - need
        bin_ = at - self.size
        while at > 1:
            at >>= 1
            left, right = room[2 * at], room[2 * at + 1]
            room[at] = left if left >= right else right
        return bin_, had


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in it) of every length; ties keep their order."""
    tree = BinTree(len(lengths), capacity)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k in np.argsort(-np.asarray(lengths), kind="stable").tolist():
        bins[k], had = tree.place(int(lengths[k]))
        offsets[k] = capacity - had
    return bins, offsets


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 1, tokenizer_path: str | None = None, group_rows: int = 2048, seed: int = 7) -> DataFrame:
    """Pieces with their place: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    The pieces are stored once; full pieces take even sequence ids from their
    place in that table, groups of rests odd ones.
    """
    spark = docs.sparkSession
    shared.with_python(spark)
    pieces = shared.materialize(tokenize(docs, capacity, end_id, tokenizer_path or default_path()), "pieces", batch_rows=1024)
    numbered = pieces.withColumn("_row", F.monotonically_increasing_id())
    full = numbered.filter(F.col("length") == capacity)
    full = full.select(*pieces.columns, (F.col("_row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rests = numbered.filter(F.col("length") < capacity)
    groups = max(1, math.ceil(pieces.filter(F.col("length") < capacity).count() / group_rows))
    rests = rests.withColumn("_group", F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("_row", "ascending")])
        bins, offsets = first_fit_decreasing(table["length"].to_numpy(), capacity)
        group = table["_group"][0].as_py()
        table = table.append_column("sequence_id", pa.array((group * (1 << 32) + bins) * 2 + 1))
        return table.append_column("offset", pa.array(offsets)).drop_columns(["_row", "_group"])

    packed = rests.groupBy("_group").applyInArrow(run, _PIECES + ", sequence_id long, offset long")
    return full.unionByName(packed)
