"""Hard negatives from Hilbert-ordered Parquet blocks with zone maps.

Candidates are sorted along a Hilbert curve through their most varied
dimensions and written as Parquet files whose row groups are blocks.  A file's
footer carries the zone map: the least and greatest value of every dimension,
and of the label, in each block.  Interval arithmetic on a zone map bounds the
score that an anchor can reach in a block, so a task reads only the blocks that
can hold a row of one of its anchors' windows.

A window is an anchor with a range of scores; its best ``k`` rows are wanted.

1. One open window an anchor finds its positives (rows of its label).
2. One window a positive, from ``low_percent`` to ``high_percent`` of its score,
   finds the negatives (rows of other labels).

Each step first searches the groups of files that the anchors themselves lie in;
the k-th best score found there raises the window's lower end, then the other
groups are searched.  A task takes one (group of anchors, group of files) and
holds one block at a time; groups are bounded in rows and found by descriptors
of files, never by pairs of rows.  The number of Spark jobs does not depend on
the data.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; of rows that share an id the one with the least label,
then components, counts; only vectors of one dimension meet; ties go to the
smaller vec_id; components are clamped to +-2^62 and scores to long; an anchor
without positives, and a window without rows, gives nothing; an empty table
gives no rows; there are no texts; columns other than ``vec_id``, ``label`` and
``embedding`` are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficwatch.llm import shared
from trafficwatch.llm.norm_topk import products
from trafficwatch.llm.words import ranges

CURVE_DIMS, CURVE_BITS = 8, 7
#: Scores (anchor, candidate) that one pass holds.
_CELLS = 1 << 18
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_FILES = "dim int, part long, seq long, uri string, n long, anchors array<struct<anchor_id: long, label: long, components: binary>>"
_HITS = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


# -- the curve ---------------------------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (non-negative, below 2^bits)."""
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        side, below = 1 << level, (1 << level) - 1
        for axis in x:
            flipped = (axis & side) != 0
            swap = np.where(flipped, 0, (x[0] ^ axis) & below)
            x[0] ^= np.where(flipped, below, swap)
            axis ^= swap
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | (axis >> level) & 1
    return key


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), dim)


def integer_rows(vectors: DataFrame, is_anchor: Column, scale: int) -> DataFrame:
    """(vec_id, label, dim, components, anchor), stored: floor(scale * x) as little-endian int64, one valid row an id."""

    def run(batches):
        for batch in batches:
            kept, out, dims = [], [], []
            column = batch.column(2)
            for k in range(batch.num_rows):
                x = column[k].values
                if x is None or x.null_count:
                    continue
                x = np.floor(scale * x.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(x).all():
                    kept.append(k)
                    out.append(np.clip(x, -(2.0**62), 2.0**62).astype("<i8").tobytes())
                    dims.append(len(x))
            rows = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(dims, pa.int32()), pa.array(out, pa.binary()), rows.column(3)], names=["vec_id", "label", "dim", "components", "anchor"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = rows.filter("vec_id is not null and label is not null and embedding is not null")
    rows = rows.mapInArrow(run, "vec_id long, label long, dim int, components binary, anchor boolean")
    once = rows.groupBy("vec_id").agg(F.min(F.struct("label", "components", "dim", "anchor")).alias("row"))
    return shared.materialize(once.select("vec_id", "row.label", "row.dim", "row.components", "row.anchor"), "integer-vectors")


def curve_axes(rows: DataFrame, most: int = CURVE_DIMS) -> dict[int, list[tuple[int, float, float]]]:
    """For each dimension count, the ``most`` positions of greatest variance with the range that is cut into cells."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for d in np.unique(dims).tolist():
                x = _vectors(batch.column(1).filter(pa.array(dims == d)), d).astype(np.float64)
                add = np.stack([np.full(d, float(len(x))), x.sum(0), (x * x).sum(0)])
                sums[d] = sums[d] + add if d in sums else add
        for d, (n, one, two) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(n), pa.array(one), pa.array(two)], names=["dim", "at", "n", "one", "two"])

    parts = rows.select("dim", "components").mapInArrow(run, "dim int, at int, n double, one double, two double")
    mean = F.sum("one") / F.sum("n")
    spread = F.sqrt(F.greatest(F.lit(0.0), F.sum("two") / F.sum("n") - mean * mean))
    of_dim = Window.partitionBy("dim").orderBy(F.col("spread").desc(), "at")
    axes = parts.groupBy("dim", "at").agg(mean.alias("mean"), spread.alias("spread")).withColumn("place", F.row_number().over(of_dim)).filter(F.col("place") <= most)
    out: dict[int, list[tuple[int, float, float]]] = {}
    # ``most`` rows for each dimension count
    for r in axes.orderBy("dim", "at").collect():
        out.setdefault(r["dim"], []).append((r["at"], r["mean"] - 3 * r["spread"], max(6 * r["spread"], 1e-9)))
    return out


def on_curve(rows: DataFrame, axes: dict[int, list[tuple[int, float, float]]]) -> DataFrame:
    """Adds ``curve``, the row's place on the curve."""

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            key = np.zeros(len(dims), np.int64)
            for d in np.unique(dims).tolist():
                own = np.flatnonzero(dims == d)
                if d not in axes:
                    continue
                x = _vectors(batch.column("components").take(pa.array(own)), d)
                cells = np.stack([np.clip((x[:, at] - low) / width * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1) for at, low, width in axes[d]], 1)
                key[own] = hilbert_keys(cells, CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=[*batch.schema.names, "curve"])

    return rows.mapInArrow(run, "vec_id long, label long, dim int, components binary, anchor boolean, curve long")


# -- blocks and zone maps ----------------------------------------------------------------------


def write_blocks(rows: DataFrame, folder: str, block_rows: int, file_rows: int) -> DataFrame:
    """Rows in curve order -> Parquet files of at most ``file_rows``, a row group a block; one row a file with its anchors, stored."""

    def write(part: pa.Table, dim: int, index: int, seq: int) -> pa.RecordBatch:
        x = _vectors(part["components"].combine_chunks(), dim)
        labels = part["label"].to_numpy()
        starts = np.arange(0, len(x), block_rows)
        zones = np.stack([np.concatenate([f.reduceat(labels, starts)[:, None], f.reduceat(x, starts, axis=0)], 1) for f in (np.minimum, np.maximum)])
        plain = pa.table({"vec_id": part["vec_id"], "label": part["label"], "components": part["components"].combine_chunks().cast(pa.binary(8 * dim))})
        sink = pa.BufferOutputStream()
        pq.write_table(plain.replace_schema_metadata({"zones": zones.astype("<i8").tobytes().hex()}), sink, row_group_size=block_rows, compression="zstd", use_dictionary=False)
        uri, _ = shared.write_file(folder, f"blocks-{index:05d}-{seq:05d}.parquet", [sink.getvalue()])
        chosen = part.filter(part["anchor"])
        anchors = pa.StructArray.from_arrays([chosen[c].combine_chunks() for c in ("vec_id", "label", "components")], names=["anchor_id", "label", "components"])
        held = pa.ListArray.from_arrays(pa.array([0, len(anchors)], pa.int32()), anchors)
        values = [pa.array([dim], pa.int32()), pa.array([index], pa.int64()), pa.array([seq], pa.int64()), pa.array([uri]), pa.array([len(x)], pa.int64()), held]
        return pa.RecordBatch.from_arrays(values, names=["dim", "part", "seq", "uri", "n", "anchors"])

    def run(batches):
        from pyspark import TaskContext

        index, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cuts = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts[:-1], cuts[1:]):
                while low < high:
                    if held and (size == file_rows or held[0].column("dim")[0].as_py() != dims[low]):
                        yield write(pa.Table.from_batches(held), held[0].column("dim")[0].as_py(), index, seq)
                        held, size, seq = [], 0, seq + 1
                    some = batch.slice(low, min(high - low, file_rows - size))
                    held.append(some)
                    size += some.num_rows
                    low += some.num_rows
        if size:
            yield write(pa.Table.from_batches(held), held[0].column("dim")[0].as_py(), index, seq)

    ordered = rows.repartitionByRange(F.col("dim"), F.col("curve"), F.xxhash64("vec_id")).sortWithinPartitions("dim", "curve", "vec_id")
    return shared.materialize(ordered.filter("dim > 0").mapInArrow(run, _FILES), "block-files")


class Blocks:
    """A file of blocks, read block by block."""

    def __init__(self, uri: str, dim: int):
        self.dim = dim
        self.file = pq.ParquetFile(shared.open_file(uri))
        raw = np.frombuffer(bytes.fromhex(self.file.schema_arrow.metadata[b"zones"].decode()), "<i8")
        self.low, self.high = raw.reshape(2, -1, dim + 1)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score (anchor, block) that the zone map allows."""
        low, high = self.low[:, 1:].astype(np.float64).T, self.high[:, 1:].astype(np.float64).T
        a = anchors.astype(np.float64)
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        slack = 1 + 1e-11 * (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)))
        return up @ low + down @ high - slack, up @ high + down @ low + slack

    def labels(self, own: np.ndarray, same: bool) -> np.ndarray:
        """Blocks (anchor, block) that may hold a row of the wanted labels."""
        low, high = self.low[None, :, 0], self.high[None, :, 0]
        mine = own[:, None]
        return (low <= mine) & (mine <= high) if same else ~((low == mine) & (high == mine))

    def read(self, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        part = self.file.read_row_group(block)
        return part["vec_id"].to_numpy(), part["label"].to_numpy(), _vectors(part["components"].combine_chunks(), self.dim)


class Windows:
    """Windows of a group of anchors and their best ``k`` rows so far."""

    def __init__(self, table: pa.Table, dim: int, k: int, same_label: bool):
        table = table.sort_by([("anchor_id", "ascending"), ("positive_id", "ascending")])
        self.table, self.k, self.same_label = table, k, same_label
        self.low, self.high = (table[c].to_numpy().copy() for c in ("low", "high"))
        self.anchors, self.first, self.many = np.unique(table["anchor_id"].to_numpy(), return_index=True, return_counts=True)
        self.labels = table["label"].to_numpy()[self.first]
        self.vectors = _vectors(table["components"].combine_chunks().take(pa.array(self.first)), dim)
        self.top = np.zeros((0, 3), np.int64)  # window, row id, score

    def search(self, blocks: Blocks) -> None:
        """Read the blocks that can still change a window, the most promising first."""
        least, most = blocks.bounds(self.vectors)
        fits = blocks.labels(self.labels, self.same_label)
        most = np.where(fits, most, -np.inf)
        for block in np.argsort(-most.max(0), kind="stable").tolist():
            low, high = np.minimum.reduceat(self.low, self.first), np.maximum.reduceat(self.high, self.first)
            wanted = np.flatnonzero((most[:, block] >= low) & (least[:, block] <= high) & fits[:, block])
            if len(wanted):
                ids, labels, x = blocks.read(block)
                step = max(1, _CELLS // len(ids))
                for at in range(0, len(wanted), step):
                    self._score(wanted[at : at + step], ids, labels, x)

    def _score(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        score = products(self.vectors[rows], x)
        low, high = (f.reduceat(v, self.first)[rows, None] for f, v in ((np.minimum, self.low), (np.maximum, self.high)))
        fits = (labels[None, :] == self.labels[rows, None]) == self.same_label
        fits &= (ids[None, :] != self.anchors[rows, None]) & (score >= low) & (score <= high)
        a, c = np.nonzero(fits)
        if not len(a):
            return
        many = self.many[rows[a]]
        window = ranges(self.first[rows[a]], many)
        a, c = np.repeat(a, many), np.repeat(c, many)
        value = score[a, c]
        inside = (value >= self.low[window]) & (value <= self.high[window])
        if inside.any():
            self._keep(window[inside], ids[c[inside]], value[inside])

    def _keep(self, window: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        both = np.concatenate([self.top, np.column_stack([window, ids, score])])
        # falling scores without negating the least long
        both = both[np.lexsort((both[:, 1], ~both[:, 2], both[:, 0]))]
        rank = np.arange(len(both)) - np.searchsorted(both[:, 0], both[:, 0])
        last = both[rank == self.k - 1]
        self.low[last[:, 0]] = np.maximum(self.low[last[:, 0]], last[:, 2])
        self.top = both[rank < self.k]

    def hits(self) -> pa.RecordBatch:
        own = self.table.take(pa.array(self.top[:, 0]))
        columns = [own[c].combine_chunks() for c in ("anchor_id", "positive_id", "positive_score")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(self.top[:, 1]), pa.array(self.top[:, 2])], names=["anchor_id", "positive_id", "positive_score", "vec_id", "score"])


# -- search ------------------------------------------------------------------------------------


def store_windows(windows: DataFrame, folder: str) -> DataFrame:
    """One file for each group of anchors: (dim, anchor_group, windows_uri), stored."""

    def write(key, part):
        sink = pa.BufferOutputStream()
        pq.write_table(part.select(["anchor_id", "positive_id", "positive_score", "label", "components", "low", "high"]), sink, compression="zstd")
        uri, _ = shared.write_file(folder, "windows", [sink.getvalue()])
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "anchor_group": pa.array([key[1].as_py()], pa.int64()), "windows_uri": [uri]})

    files = windows.groupBy("dim", "anchor_group").applyInArrow(write, "dim int, anchor_group long, windows_uri string")
    return shared.materialize(files, "window-files")


def search(pairs: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The best ``k`` rows of every window in each (windows_uri, file uris) of ``pairs``, stored."""

    def run(batches):
        for batch in batches:
            for item in batch.to_pylist():
                table = pq.read_table(shared.open_file(item["windows_uri"]))
                windows = Windows(table, item["dim"], k, same_label)
                for uri in item["uris"]:
                    windows.search(Blocks(uri, item["dim"]))
                yield windows.hits()

    pairs = shared.materialize(pairs.select("dim", "windows_uri", "uris"), "searches")
    return shared.materialize(shared.spread(pairs).mapInArrow(run, _HITS), "hits")


def _best(hits: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), "vec_id"))
    return hits.withColumn("rank", place).filter(F.col("rank") <= k)


def search_windows(windows: DataFrame, near: DataFrame, everywhere: DataFrame, folder: str, k: int, same_label: bool) -> DataFrame:
    """The best ``k`` rows of every window: first in the anchors' own files, then in all others."""
    windows = shared.materialize(windows, "windows")
    files = store_windows(windows, folder)
    own = near.select("dim", "anchor_group", "group").distinct()
    here = everywhere.join(own, ["dim", "anchor_group", "group"], "left_semi").join(files, ["dim", "anchor_group"])
    found = search(here, k, same_label)
    floor = found.groupBy("anchor_id", "positive_id").agg(F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_list("score"), asc=False).alias("_scores"))
    # a window is searched in few near groups, k rows each
    floor = floor.filter(F.col("_n") >= k).select("anchor_id", "positive_id", F.col("_scores")[k - 1].alias("_floor"))
    raised = windows.join(floor, ["anchor_id", "positive_id"], "left").withColumn("low", F.greatest("low", "_floor")).drop("_floor")
    files = store_windows(raised, folder)
    rest = everywhere.join(own, ["dim", "anchor_group", "group"], "left_anti").join(files, ["dim", "anchor_group"])
    return shared.materialize(_best(found.unionByName(search(rest, k, same_label)), k), "best")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    high_percent: int = 100,
    scale: int = 256,
    block_rows: int = 512,
    file_rows: int = 16_384,
    anchor_rows: int = 4096,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``vectors`` (vec_id, label, embedding)."""
    spark = vectors.sparkSession
    shared.with_python(spark)
    folder = shared.shared_dir(spark, "blocks")
    rows = integer_rows(vectors, is_anchor, scale)
    files = write_blocks(on_curve(rows, curve_axes(rows)), folder, block_rows, file_rows)
    # descriptors of files in curve order, put together to groups of about file_rows rows and anchor_rows anchors
    before = Window.partitionBy("dim").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    here = F.size("anchors")
    files = files.select(
        "dim", "part", "seq", "uri", "anchors",
        F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / file_rows).alias("group"),
        F.floor(F.coalesce(F.sum(here).over(before), F.lit(0)) / anchor_rows).alias("anchor_group"),
    )
    files = shared.materialize(files, "grouped-files", batch_rows=256)
    groups = files.groupBy("dim", "group").agg(F.sort_array(F.collect_list(F.struct("part", "seq", "uri"))).alias("_files")).select("dim", "group", F.col("_files.uri").alias("uris"))
    near = files.filter(here > 0).select("dim", "anchor_group", "group").distinct()
    everywhere = near.select("dim", "anchor_group").distinct().join(groups, "dim")
    anchors = files.select("dim", "anchor_group", F.inline("anchors"))

    open_ = anchors.select("*", F.col("anchor_id").alias("positive_id"), F.lit(None).cast("long").alias("positive_score"), F.lit(int(_LEAST)).alias("low"), F.lit(int(_MOST)).alias("high"))
    best = search_windows(open_, near, everywhere, folder, positives, True)
    best = best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))

    def share(percent: int) -> Column:
        return F.col("positive_score").cast("decimal(20,0)") * F.lit(percent).cast("decimal(5,0)") / F.lit(100).cast("decimal(3,0)")

    low, high = F.greatest(F.ceil(share(low_percent)), F.lit(int(_LEAST))), F.least(F.floor(share(high_percent)), F.lit(int(_MOST)))
    ranged = anchors.join(best, "anchor_id").withColumn("low", low.cast("long")).withColumn("high", high.cast("long")).filter("low <= high")
    found = search_windows(ranged, near, everywhere, folder, negatives, False)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
