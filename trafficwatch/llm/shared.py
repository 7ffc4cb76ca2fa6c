"""Helpers of the ``llm`` operators: the shared folder, binary files in it, Arrow text columns.

Everything an operator stores goes below the folder the cluster names in
``spark.checkpoint.dir``, so any executor (or a replacement for a lost one)
can read it.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from trafficwatch.session import checkpoint_dir, ship_package

#: Bytes of text that one numpy pass works on.
CHUNK_BYTES = 1 << 20
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


_TEMPORARY: list[list[str]] = []


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A new folder path below ``spark.checkpoint.dir``; local masters get their own when it is unset."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}-{tag}"
    if _TEMPORARY:
        _TEMPORARY[-1].append(path)
    return path


@contextmanager
def temporary(spark: SparkSession):
    """Removes the folders that operators make inside, once what they were for is stored elsewhere."""
    _TEMPORARY.append([])
    try:
        yield
    finally:
        for path in _TEMPORARY.pop():
            root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def materialize(df: DataFrame, tag: str, batch_rows: int | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors.

    ``batch_rows``: rows per Arrow batch while it is computed, for wide rows.
    ``path``: a folder from ``shared_dir``, by default a new one.
    """
    spark = df.sparkSession
    path = path or shared_dir(spark, tag)
    before = spark.conf.get(_BATCH_ROWS)
    if batch_rows:
        spark.conf.set(_BATCH_ROWS, str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def with_python(spark: SparkSession) -> None:
    """Executors import this package when they unpickle an operator's functions."""
    ship_package(spark)


# -- binary files in the shared folder ---------------------------------------------------------


def _filesystem(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, parts: list[bytes]) -> tuple[str, int]:
    """Write one file under a name no other attempt uses; returns (uri, bytes).

    A retried or speculative task leaves an orphan file; only the names a
    committed task returns in its manifest rows are ever read.
    """
    uri = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    filesystem, path = _filesystem(uri)
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    size = 0
    with filesystem.open_output_stream(path) as out:
        for p in parts:
            out.write(p)
            size += len(p)
    return uri, size


class FileWriter:
    """A file under a name no other attempt uses, written bit by bit; ``name`` is known from the start."""

    def __init__(self, folder: str):
        self.name, self.size, self.stream = uuid.uuid4().hex, 0, None
        self.folder = folder.rstrip("/")

    def write(self, data: bytes) -> int:
        """Append; returns where the data begins."""
        if self.stream is None:
            filesystem, path = _filesystem(f"{self.folder}/{self.name}")
            filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
            self.stream = filesystem.open_output_stream(path)
        at, self.size = self.size, self.size + len(data)
        self.stream.write(data)
        return at

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


class SliceReader:
    """Slices of files below a folder, fetched several at a time; keeps ``most_bytes`` of them and ``most_files`` open."""

    def __init__(self, folder: str, most_bytes: int = 32 << 20, most_files: int = 64, threads: int = 8):
        self.folder, self.most_bytes, self.most_files, self.threads = folder.rstrip("/"), most_bytes, most_files, threads
        self.kept: OrderedDict[tuple[str, int], bytes] = OrderedDict()
        self.files: OrderedDict[str, object] = OrderedDict()
        self.held = 0

    def _file(self, name: str):
        if name not in self.files:
            if len(self.files) == self.most_files:
                self.files.popitem(last=False)[1].close()
            self.files[name] = open_file(f"{self.folder}/{name}")
        self.files.move_to_end(name)
        return self.files[name]

    def get(self, name: str, at: int, size: int) -> bytes:
        key = (name, at)
        if key in self.kept:
            self.kept.move_to_end(key)
            return self.kept[key]
        return self._keep(key, self._file(name).read_at(size, at))

    def _keep(self, key: tuple[str, int], data: bytes) -> bytes:
        self.kept[key] = data
        self.held += len(data)
        while self.held > self.most_bytes and len(self.kept) > 1:
            self.held -= len(self.kept.popitem(last=False)[1])
        return data

    def fetch(self, wanted: list[tuple[str, int, int]]) -> None:
        """Read what is not kept yet, as long as it can be kept."""
        todo, size = [], 0
        for name, at, n in dict.fromkeys(wanted):
            if (name, at) not in self.kept and size + n <= self.most_bytes // 2:
                todo.append((name, at, n))
                size += n
        for k in range(0, len(todo), self.most_files):
            part = todo[k : k + self.most_files]
            files = [self._file(name) for name, _, _ in part]
            with ThreadPoolExecutor(self.threads) as pool:
                found = list(pool.map(lambda f, w: f.read_at(w[2], w[1]), files, part))
            for (name, at, _), data in zip(part, found):
                self._keep((name, at), data)

    def close(self) -> None:
        for f in self.files.values():
            f.close()
        self.files.clear()


def open_file(uri: str):
    """Seekable reader of a file written by ``write_file``."""
    filesystem, path = _filesystem(uri)
    return filesystem.open_input_file(path)


# -- Arrow columns -----------------------------------------------------------------------------


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as empty."""
    wide = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, wide.offset * 8)
    if wide.buffers()[2] is None or not wide.buffers()[2].size:
        return np.zeros(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    data = np.frombuffer(wide.buffers()[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def by_bytes(batches, column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of about ``limit`` bytes in ``column``, one row at least."""
    for batch in batches:
        _, offsets = utf8_buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    release()


def release() -> None:
    """Give freed memory back to the system: an idle worker's share is the executor's."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


_CACHES: dict[str, Callable[[], None]] = {}


def keep_cache(name: str, clear: Callable[[], None]) -> None:
    """A worker keeps one operator's cache: those of the operators it ran before are cleared."""
    for other in [n for n in _CACHES if n != name]:
        _CACHES.pop(other)()
    _CACHES[name] = clear


def pack_binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A large_binary column whose row i is data[offsets[i]:offsets[i + 1]] (in items of ``data``)."""
    raw = np.ascontiguousarray(data)
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64) * raw.itemsize), pa.py_buffer(raw.view(np.uint8) if raw.size else raw.tobytes())],
    ).cast(pa.binary())


def spread(files: DataFrame, *keys) -> DataFrame:
    """One partition for each row of a short table of files (10,000 at most)."""
    return files.repartition(max(1, min(files.count(), 10_000)), *keys)
