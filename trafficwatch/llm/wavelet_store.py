"""Token ids in one compressed wavelet-matrix file per shard.

``write_tokens`` sorts documents by id over range partitions, encodes whole
texts and cuts each partition into shards.  A shard's file holds one zstd
frame per bit-plane, popcount samples for rank and select, the document
table, and a footer with the places of all of them; ``TokenShard`` answers
``access``, ``rank``, ``select``, ``count`` and ``find`` from that file alone
and ``read_tokens`` decodes it whole.

Defined results: a null text is empty (its document holds the end id only);
null ids sort first; equal ids keep one entry per row; a very long
text's ids are held whole by the task of its shard; an empty table gives no file
and no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficwatch.llm import shared
from trafficwatch.llm.tokens import default_path, encoder

MAGIC = b"TWWM"
#: Bits between two popcount samples.
SAMPLE_BITS = 4096
_MANIFEST = "part int, seq int, uri string, n_docs long, n_tokens long, n_bytes long"
_DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long, part int, seq int"


class WaveletMatrix:
    """Bit-planes of a sequence, most significant first, each in the order its predecessors leave."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], samples: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.samples = n, planes, zeros, samples

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if depth <= 16 else np.uint32)
        planes, zeros, samples = [], [], []
        for level in range(depth - 1, -1, -1):
            bit = (now & now.dtype.type(1 << level)) != 0
            off, on = np.flatnonzero(~bit), np.flatnonzero(bit)
            packed = np.packbits(bit)
            planes.append(packed)
            zeros.append(len(off))
            samples.append(_sample(packed))
            if level:
                now = np.concatenate([now.take(off), now.take(on)])
        return cls(len(ids), planes, zeros, samples)

    def decode(self) -> np.ndarray:
        """The whole sequence, from the last plane up."""
        depth = len(self.planes)
        now = np.zeros(self.n, np.uint16 if depth <= 16 else np.uint32)
        for k in range(depth - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n).view(bool)
            before = np.empty_like(now)
            before[np.flatnonzero(~bit)] = now[: self.zeros[k]]
            before[np.flatnonzero(bit)] = now[self.zeros[k] :] | now.dtype.type(1 << (depth - 1 - k))
            now = before
        return now

    def _ones(self, k: int, at: int) -> int:
        """Set bits of plane k before position at."""
        block = at // SAMPLE_BITS
        total = int(self.samples[k][block])
        part = self.planes[k][block * SAMPLE_BITS // 8 : (at + 7) // 8]
        return total + int(np.unpackbits(part, count=at - block * SAMPLE_BITS).sum()) if at % SAMPLE_BITS else total

    def _bit(self, k: int, at: int) -> int:
        return int(self.planes[k][at >> 3]) >> (7 - (at & 7)) & 1

    def access(self, at: int) -> int:
        """The id at a position."""
        value = 0
        for k in range(len(self.planes)):
            bit, ones = self._bit(k, at), self._ones(k, at)
            value = value << 1 | bit
            at = self.zeros[k] + ones if bit else at - ones
        return value

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        if token >> len(self.planes):
            return 0, 0
        for k in range(len(self.planes)):
            a, b = self._ones(k, low), self._ones(k, high)
            one = token >> (len(self.planes) - 1 - k) & 1
            low, high = (self.zeros[k] + a, self.zeros[k] + b) if one else (low - a, high - b)
        return low, high

    def rank(self, token: int, at: int) -> int:
        """Occurrences of an id before a position."""
        low, high = self._range(token, 0, at)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of an id."""
        low, high = self._range(token, 0, self.n)
        if not 0 <= k < high - low:
            raise IndexError("fewer occurrences")
        at = low + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = token >> (len(self.planes) - 1 - level) & 1
            at = self._nth(level, at - self.zeros[level] if one else at, one)
        return at

    def _nth(self, k: int, nth: int, one: int) -> int:
        """Position in plane k of the nth set (or clear) bit."""
        sample = self.samples[k]
        before = sample if one else np.arange(len(sample)) * SAMPLE_BITS - sample
        block = int(np.searchsorted(before, nth, "right")) - 1
        bits = np.unpackbits(self.planes[k][block * SAMPLE_BITS // 8 : (block + 1) * SAMPLE_BITS // 8])
        return block * SAMPLE_BITS + int(np.flatnonzero(bits == one)[nth - int(before[block])])


def _sample(packed: np.ndarray) -> np.ndarray:
    """Set bits before each block of SAMPLE_BITS."""
    step = SAMPLE_BITS // 8
    whole = np.zeros(-(-max(len(packed), 1) // step) * step, np.uint8)
    whole[: len(packed)] = packed
    ones = np.bitwise_count(whole.view(np.uint64)).reshape(-1, step // 8).sum(1, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(ones)])


def shard_parts(ids: np.ndarray, doc_ids: list, lengths: np.ndarray) -> list[bytes]:
    """The bytes of one shard file."""
    matrix = WaveletMatrix.build(ids)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    parts, places, at = [MAGIC], [], len(MAGIC)
    blobs = [*[p.tobytes() for p in matrix.planes], np.concatenate(matrix.samples).tobytes(), np.asarray(lengths, np.int64).tobytes(), json.dumps(doc_ids).encode()]
    for blob in blobs:
        parts.append(squeeze(blob))
        places.append([at, len(parts[-1])])
        at += len(parts[-1])
    footer = squeeze(json.dumps({"n": matrix.n, "zeros": matrix.zeros, "places": places}).encode())
    return [*parts, footer, struct.pack("<I4s", len(footer), MAGIC)]


class TokenShard:
    """One shard file, opened by its footer; planes load when they are asked for."""

    def __init__(self, uri: str):
        self.file = shared.open_file(uri)
        size = self.file.size()
        length, magic = struct.unpack("<I4s", self._bytes(size - 8, 8))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.foot = json.loads(zstandard.ZstdDecompressor().decompress(self._bytes(size - 8 - length, length)))
        self.n, self._matrix = self.foot["n"], None
        self.lengths = np.frombuffer(self._blob(-2), np.int64)
        self.doc_ids = json.loads(self._blob(-1))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _bytes(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        return self.file.read(length)

    def _blob(self, k: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self._bytes(*self.foot["places"][k]))

    @property
    def matrix(self) -> WaveletMatrix:
        if self._matrix is None:
            depth = len(self.foot["zeros"])
            planes = [np.frombuffer(self._blob(k), np.uint8) for k in range(depth)]
            samples = np.frombuffer(self._blob(depth), np.int64).reshape(depth, -1)
            self._matrix = WaveletMatrix(self.n, planes, self.foot["zeros"], list(samples))
        return self._matrix

    def access(self, at: int) -> int:
        return self.matrix.access(at)

    def count(self, token: int) -> int:
        return self.matrix.count(token)

    def find(self, token: int) -> list[tuple]:
        """(doc_id, position in the document) of every occurrence."""
        at = [self.matrix.select(token, k) for k in range(self.count(token))]
        docs = np.searchsorted(self.starts, at, "right") - 1
        return [(self.doc_ids[d], int(p - self.starts[d])) for d, p in zip(docs, at)]

    def ids(self) -> np.ndarray:
        return self.matrix.decode()


def in_id_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text), range-partitioned and sorted; rows of one id may spread over partitions."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long"), text).withColumn("_tie", F.xxhash64("text"))
    return rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")


def write_tokens(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 2, shard_tokens: int = 2_000_000, folder: str | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the shard files; returns their manifest table."""
    spark = docs.sparkSession
    shared.with_python(spark)
    path, folder = tokenizer_path or default_path(), folder or shared.shared_dir(spark, "tokens")

    def write(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ids, docs_, lengths, held = [], [], [], 0

        def close():
            uri, size = shared.write_file(folder, f"part-{part:06d}-{seq:05d}.wm", shard_parts(np.concatenate(ids), docs_, np.concatenate(lengths)))
            row = {"part": part, "seq": seq, "uri": uri, "n_docs": len(docs_), "n_tokens": held, "n_bytes": size}
            return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]))

        for batch in shared.by_bytes(batches, 1):
            got, counts = encoder(path).encode(*shared.utf8_buffers(batch.column(1)))
            ends = np.cumsum(counts)
            ids.append(np.insert(got, ends, end_id))
            lengths.append(counts + 1)
            docs_ += batch.column(0).to_pylist()
            held += len(got) + len(counts)
            if held >= shard_tokens:
                yield close()
                ids, docs_, lengths, held, seq = [], [], [], 0, seq + 1
        if held:
            yield close()

    return shared.materialize(in_id_order(docs).mapInArrow(write, _MANIFEST), "token-manifest", batch_rows=1024)


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Decode the shard files: one row per document, with its first id's global position."""
    ahead = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(ahead.orderBy("part")), F.lit(0)).alias("_before"))
    within = F.coalesce(F.sum("n_tokens").over(ahead.partitionBy("part").orderBy("seq")), F.lit(0))
    files = manifest.withColumn("_within", within).join(parts, "part")
    files = files.select("part", "seq", "uri", (F.col("_before") + F.col("_within")).alias("first"))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = TokenShard(row["uri"])
                raw = shard.ids().astype("<u4")
                crc = [zlib.crc32(raw[a : a + n]) for a, n in zip(shard.starts.tolist(), shard.lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(shard.starts + row["first"]),
                        pa.array(shard.lengths),
                        pa.array(crc, pa.int64()),
                        pa.array([row["part"]] * len(crc), pa.int32()),
                        pa.array([row["seq"]] * len(crc), pa.int32()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "part", "seq"],
                )

    return shared.spread(files, "part", "seq").mapInArrow(read, _DOCS)
