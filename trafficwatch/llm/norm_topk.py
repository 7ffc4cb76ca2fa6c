"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are dealt out by falling length and stored in files of bounded size;
each ``bucket_rows`` rows of a file are a bucket of vectors of similar length.
For a bucket and a query the local cosine threshold is the query's k-th best
score so far over (query length x longest length in the bucket).  Above 1 the
bucket is skipped; a high threshold prunes by the feasible range of the query's
largest coordinates, a low one by length alone; the rest is verified by integer
products.

Queries are stored in blocks of bounded size, with the thresholds that the
longest ``seed_rows`` candidates give them.  Spark pairs the descriptors of
blocks and files, and the tasks of one job take runs of pairs: the files of a
block by falling length, so thresholds rise as they go and a file too short for
all queries of the block is not read.  The number of jobs does not depend on
the number of queries; of the vectors, only the seeds pass the driver.

Defined results: vectors that are null or hold a null or non-finite component
take no part; only vectors of one dimension meet; candidates with the query's
own id are its own row; rows that repeat an id count once, with their best
score; a query without candidates has no rows; ties go to the smaller vec_id;
components are clamped to 2^62 either way, scores to the range of long; null
ids take no part; other columns are not read; an empty table gives no rows; a
vector of any dimension is one row of a block or file, whatever its size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficwatch.llm import shared

_VECTORS = "vec_id long, dim int, norm double, components binary"
_FILES = "dim int, longest double, uri string"
_BLOCKS = "dim int, block string"
_HITS = "query_id long, vec_id long, score long"
#: Local cosine threshold from which coordinate pruning pays.
COORDINATE_FROM = 0.6
#: Bytes of components in a block of queries or a file of candidates.
FILE_BYTES = 8 << 20
#: Parts of the join of descriptors, as most vectors have one dimension.
JOIN_PARTS = 64


def to_integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, dim, norm, components): floor(scale * x) as little-endian int64, only valid vectors."""

    def run(batches):
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            valid = np.array(ids.is_valid()) & np.array(column.is_valid())
            rows, out, norms, dims = [], [], [], []
            for k in np.flatnonzero(valid).tolist():
                x = column[k].values
                if x.null_count:
                    continue
                x = np.floor(scale * x.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(x).all():
                    continue
                rows.append(ids[k].as_py())
                x = np.clip(x, -(2.0**62), 2.0**62)
                out.append(x.astype("<i8").tobytes())
                norms.append(float(np.sqrt(np.dot(x, x))))
                dims.append(len(x))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(out, pa.binary())], names=["vec_id", "dim", "norm", "components"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, _VECTORS)


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products, clamped to long."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, queries.shape[1])
    if most < 2.0**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    if most < 2.0**63:
        return queries @ candidates.T
    exact = queries.astype(object) @ candidates.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


class Block:
    """Queries of one dimension and their best candidates so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        self.top = np.zeros((0, 3), np.int64)  # query row, candidate id, score
        self.least = np.full(len(ids), -np.inf)  # a score below can't be among the k best

    def keep(self, rows: np.ndarray, cand: np.ndarray, score: np.ndarray) -> None:
        """Merge hits; raises the thresholds."""
        both = np.concatenate([self.top, np.column_stack([rows, cand, score])])
        both = both[np.lexsort((-both[:, 2], both[:, 1], both[:, 0]))]
        first = np.ones(len(both), bool)
        first[1:] = (both[1:, :2] != both[:-1, :2]).any(1)  # an id counts once, with its best score
        both = both[first]
        both = both[np.lexsort((both[:, 1], -both[:, 2], both[:, 0]))]
        begin = np.searchsorted(both[:, 0], both[:, 0])
        rank = np.arange(len(both)) - begin
        kth = both[rank == self.k - 1]
        self.least[kth[:, 0]] = np.maximum(self.least[kth[:, 0]], kth[:, 2])
        self.top = both[rank < self.k]

    def search(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> None:
        """One bucket, its vectors by falling length."""
        longest = float(norms[0])
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(np.isfinite(self.least), self.least / (self.norms * longest), -np.inf)
        cosine = np.where(np.isnan(cosine), 0.0, cosine)
        slack = 1e-9
        by_coordinate = (cosine >= COORDINATE_FROM) & (cosine <= 1 + slack)
        for q in np.flatnonzero(by_coordinate):
            reach = self._length(q, norms, slack)
            rows = self._coordinates(q, vectors[:reach], norms[:reach], slack)
            if len(rows):
                self._verify(np.array([q]), ids[rows], vectors[rows])
        rest = np.flatnonzero(cosine < COORDINATE_FROM)
        if len(rest):
            reach = max(self._length(q, norms, slack) for q in rest)
            self._verify(rest, ids[:reach], vectors[:reach])

    def _length(self, q: int, norms: np.ndarray, slack: float) -> int:
        """Candidates long enough to reach the threshold: a prefix of the bucket."""
        if not np.isfinite(self.least[q]) or self.least[q] <= 0:
            return len(norms)
        return int(np.searchsorted(-norms, -self.least[q] / max(self.norms[q], 1e-300) * (1 - slack), "right"))

    def _coordinates(self, q: int, vectors: np.ndarray, norms: np.ndarray, slack: float) -> np.ndarray:
        """Candidates inside the feasible range of the query's four largest coordinates."""
        rows = np.arange(len(norms))
        unit = self.vectors[q] / self.norms[q]
        for f in np.argsort(-np.abs(unit))[:4]:
            need = np.minimum(1.0, self.least[q] / (self.norms[q] * norms[rows]))
            spread = np.sqrt((1 - need**2) * max(0.0, 1 - unit[f] ** 2)) + slack
            own = vectors[rows, f] / norms[rows]
            middle = unit[f] * need
            low = np.where(unit[f] <= -need, -1.0, middle - spread)
            high = np.where(unit[f] >= need, 1.0, middle + spread)
            rows = rows[(own >= low - slack) & (own <= high + slack)]
            if not len(rows):
                break
        return rows

    def _verify(self, q: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        if not len(ids):
            return
        score = products(self.vectors[q], vectors)
        other = ids[None, :] != self.ids[q][:, None]
        floor = self.least[q].copy()
        if len(ids) > self.k + 1 and len(np.unique(ids)) == len(ids):
            part = np.where(other, score, np.iinfo(np.int64).min)
            floor = np.maximum(floor, np.partition(part, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        row, col = np.nonzero(other & (score >= floor[:, None]))
        if len(row):
            self.keep(q[row], ids[col], score[row, col])


def _stack(table: pa.Table | pa.RecordBatch, dim: int, rows: np.ndarray) -> np.ndarray:
    raw = b"".join(table.column("components")[k].as_py() for k in rows.tolist())
    return np.frombuffer(raw, "<i8").reshape(len(rows), dim)


def _slices(batches, rows: int):
    """(dim, table) of the vectors by dimension, in the order they come: ``rows`` rows or FILE_BYTES at most, one row at least."""
    held: dict[int, list[pa.Table]] = {}
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            most = max(1, min(rows, FILE_BYTES // max(1, 8 * dim)))
            own = pa.Table.from_batches([batch.filter(pa.array(dims == dim))])
            table = pa.concat_tables([*held.pop(dim, []), own])
            while len(table) >= most:
                yield dim, table.slice(0, most)
                table = table.slice(most)
            if len(table):
                held[dim] = [table]
    for dim, tables in held.items():
        yield dim, pa.concat_tables(tables)


def _write(folder: str, table: pa.Table) -> str:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, table.schema) as out:
        out.write_table(table)
    return shared.write_file(folder, "vectors", [sink.getvalue()])[0]


def _read(uri: str) -> pa.Table:
    with shared.open_file(uri) as file:
        return pa.ipc.open_file(file).read_all().combine_chunks()


def _feed(block: Block, dim: int, table: pa.Table, bucket_rows: int) -> None:
    """Search a table of candidates by falling length."""
    norms, ids = table["norm"].to_numpy(), table["vec_id"].to_numpy()
    order = np.argsort(-norms, kind="stable")
    for at in range(0, len(order), bucket_rows):
        rows = order[at : at + bucket_rows]
        block.search(ids[rows], _stack(table, dim, rows), norms[rows])


def _block(table: pa.Table, dim: int, k: int) -> Block:
    return Block(table["vec_id"].to_numpy(), _stack(table, dim, np.arange(len(table))), k)


def _parts(rows: DataFrame, size: int) -> int:
    """Partitions of about ``size`` rows: files and blocks are full whatever the session's number of partitions."""
    return max(1, -(-rows.count() // size))


def write_candidates(integers: DataFrame, folder: str, file_rows: int) -> DataFrame:
    """Candidates in files of similar length: (dim, longest, uri), stored."""

    def run(batches):
        for dim, table in _slices(batches, file_rows):
            yield pa.RecordBatch.from_pylist([{"dim": dim, "longest": float(table["norm"].to_numpy().max()), "uri": _write(folder, table)}], _schema(_FILES))

    dealt = integers.repartitionByRange(_parts(integers, file_rows), F.col("norm").desc(), F.xxhash64("vec_id")).sortWithinPartitions(F.col("norm").desc())
    return shared.materialize(dealt.mapInArrow(run, _FILES), "norm-buckets")


def write_queries(queries: DataFrame, folder: str, seeds: pa.Table, k: int, block_rows: int, bucket_rows: int) -> DataFrame:
    """Blocks of queries with the thresholds that ``seeds`` give them: (dim, block), stored."""

    def run(batches):
        for dim, table in _slices(batches, block_rows):
            block = _block(table, dim, k)
            _feed(block, dim, seeds.filter(pa.array(seeds["dim"].to_numpy() == dim)), bucket_rows)
            uri = _write(folder, table.append_column("least", pa.array(block.least)))
            yield pa.RecordBatch.from_pylist([{"dim": dim, "block": uri}], _schema(_BLOCKS))

    return shared.materialize(queries.mapInArrow(run, _BLOCKS), "query-blocks")


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def search(blocks: DataFrame, files: DataFrame, k: int, bucket_rows: int) -> DataFrame:
    """query_id, vec_id, score: each run of pairs' best k candidates of every query."""

    def run(batches):
        name, block = None, None

        def hits():
            ids = block.ids[block.top[:, 0]]
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(block.top[:, 1]), pa.array(block.top[:, 2])], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for pair in batch.to_pylist():
                if pair["block"] != name:
                    if block is not None:
                        yield hits()
                    table = _read(pair["block"])
                    name, block = pair["block"], _block(table, pair["dim"], k)
                    block.least = table["least"].to_numpy().copy()
                # a threshold of 0 or less can be met by any length
                if len(block.ids) and ((block.least <= 0) | (block.least <= block.norms * pair["longest"] * (1 + 1e-9))).any():
                    _feed(block, pair["dim"], _read(pair["uri"]), bucket_rows)
        if block is not None:
            yield hits()
        shared.release()

    parts = F.explode(F.sequence(F.lit(0), F.lit(JOIN_PARTS - 1)))
    dealt = files.withColumn("part", F.pmod(F.xxhash64("uri"), F.lit(JOIN_PARTS)).cast("int"))
    pairs = shared.materialize(blocks.withColumn("part", parts).join(dealt, ["dim", "part"]).drop("part"), "pairs")
    tasks = max(1, min(pairs.count(), 10_000))
    runs = pairs.repartitionByRange(tasks, "block", F.col("longest").desc(), "uri").sortWithinPartitions("block", F.col("longest").desc(), "uri")
    return shared.materialize(runs.mapInArrow(run, _HITS), "hits")


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    scale: int = 256,
    block_rows: int = 4096,
    bucket_rows: int = 1024,
    seed_rows: int = 1024,
    file_rows: int = 16_384,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every row where ``is_query`` (a condition on vec_id) holds."""
    spark = vectors.sparkSession
    shared.with_python(spark)
    folder = shared.shared_dir(spark, "vectors")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    integers = shared.materialize(to_integers(rows, scale), "integers")
    files = write_candidates(integers, folder, file_rows)
    seeds = integers.orderBy(F.col("norm").desc(), "vec_id").limit(seed_rows).toArrow()
    queries = integers.filter(is_query)
    queries = queries.dropDuplicates(["vec_id", "components"]).coalesce(_parts(queries, block_rows))
    found = search(write_queries(queries, folder, seeds, k, block_rows, bucket_rows), files, k, bucket_rows)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", ranked).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
