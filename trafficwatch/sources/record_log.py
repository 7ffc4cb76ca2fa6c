"""A log of (key, value) records in a shared folder: sink, bounded stream source, batch reader.

A Python data source for deployments without a message broker.  Tasks write
their records to Parquet files under names no other attempt uses; when all are
done, one manifest per micro-batch names them.  Readers follow the manifests,
so files of failed attempts are never read, and a micro-batch that is written
again finds its manifest and changes nothing.  The order of records is that of
(batch, task, row).  A log has one writing query, whose batch numbers follow
one another; an idle trigger that Spark skips takes no number.

The stream source admits at most ``maxRecords`` records per trigger, counted
in records and not in files: an offset is (batch, records of it already read).
Spark asks for the newest offset without saying where it stands, so the last
planned end is kept in the file ``position``, below the query's checkpoint.

Null keys and values stay null; an empty batch has a manifest without files;
repeated records are kept.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from trafficwatch.session import ship_package

FORMAT = "record_log"
#: Rows of a row group: what a reader of part of a file may have to skip.
GROUP_ROWS = 10_000


def _open_fs(uri: str):
    """(file system, path in it) of a folder or file URI; a plain path is local."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _put(uri: str, content: dict) -> None:
    """Write a small JSON file; it appears whole or not at all."""
    filesystem, path = _open_fs(uri)
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    with filesystem.open_output_stream(draft) as out:
        out.write(json.dumps(content).encode())
    filesystem.move(draft, path)


def _get(uri: str) -> dict | None:
    filesystem, path = _open_fs(uri)
    try:
        with filesystem.open_input_stream(path) as src:
            return json.loads(src.read())
    except FileNotFoundError:
        return None


def _manifest(path: str, batch: int) -> str:
    return f"{path}/manifests/{batch:012d}.json"


def _batches(path: str) -> list[int]:
    """Numbers of the written batches (one listing)."""
    from pyarrow import fs

    filesystem, folder = _open_fs(f"{path}/manifests")
    names = [f.base_name for f in filesystem.get_file_info(fs.FileSelector(folder, allow_not_found=True))]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


@dataclass
class Written(WriterCommitMessage):
    """One task's file and its number of records."""

    task: int
    file: str
    records: int


@dataclass
class Slice(InputPartition):
    """Records ``skip`` to ``skip + take`` of one file; all of it if ``take`` is None."""

    file: str
    skip: int = 0
    take: int | None = None


def _write_file(path: str, batches) -> Written:
    import pyarrow.parquet as pq
    from pyspark import TaskContext

    name = f"records/{uuid.uuid4().hex}.parquet"
    filesystem, file = _open_fs(f"{path}/{name}")
    task, records, out = TaskContext.get().partitionId(), 0, None
    try:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if out is None:
                filesystem.create_dir(file.rsplit("/", 1)[0], recursive=True)
                out = pq.ParquetWriter(file, batch.schema, filesystem=filesystem)
            out.write_batch(batch, row_group_size=GROUP_ROWS)
            records += batch.num_rows
    finally:
        if out is not None:
            out.close()
    return Written(task, name, records)


def _discard(path: str, messages) -> None:
    for m in messages:
        if m is not None and m.records:
            filesystem, file = _open_fs(f"{path}/{m.file}")
            filesystem.delete_file(file)


def _commit(path: str, messages, batch: int) -> None:
    """Name the files of a batch; a batch already named keeps its first files."""
    if _get(_manifest(path, batch)) is not None:
        _discard(path, messages)
        return
    done = sorted((m for m in messages if m is not None and m.records), key=lambda m: m.task)
    _put(_manifest(path, batch), {"files": [[m.file, m.records] for m in done]})


class LogWriter(DataSourceArrowWriter):
    """Writes one DataFrame as the batch that the option ``batch`` numbers."""

    def __init__(self, path: str, batch: int):
        self.path, self.batch = path, batch

    def write(self, iterator):
        return _write_file(self.path, iterator)

    def commit(self, messages):
        _commit(self.path, messages, self.batch)

    def abort(self, messages):
        _discard(self.path, messages)


class LogStreamWriter(DataSourceStreamArrowWriter):
    """Writes each micro-batch of a stream."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator):
        return _write_file(self.path, iterator)

    def commit(self, messages, batchId):
        _commit(self.path, messages, batchId)

    def abort(self, messages, batchId):
        _discard(self.path, messages)


def _read_slice(path: str, part: Slice):
    import pyarrow.parquet as pq

    filesystem, file = _open_fs(f"{path}/{part.file}")
    skip, left = part.skip, part.take
    with filesystem.open_input_file(file) as src:
        stored = pq.ParquetFile(src)
        groups = []
        for k in range(stored.num_row_groups):
            rows = stored.metadata.row_group(k).num_rows
            if skip >= rows and not groups:
                skip -= rows
            else:
                groups.append(k)
        for batch in stored.iter_batches(batch_size=GROUP_ROWS, row_groups=groups, columns=["key", "value"]):
            batch, skip = batch.slice(skip), max(0, skip - batch.num_rows)
            if left is not None:
                batch = batch.slice(0, left)
                left -= batch.num_rows
            if batch.num_rows:
                yield batch
            if left == 0:
                return


class LogReader(DataSourceReader):
    """Every record of the log as it is now."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [Slice(f) for b in _batches(self.path) for f, _ in _get(_manifest(self.path, b))["files"]] or [Slice("")]

    def read(self, partition):
        return _read_slice(self.path, partition) if partition.file else iter(())


class LogStreamReader(DataSourceStreamReader):
    """Records after an offset, at most ``most`` per trigger (None: all)."""

    def __init__(self, path: str, position: str, most: int | None, start: str):
        self.path, self.position, self.most, self.start = path, position, most, start
        self.at: dict | None = None

    def initialOffset(self) -> dict:
        written = _batches(self.path)
        first = 0 if not written else written[-1] + 1 if self.start == "latest" else written[0]
        self.at = {"batch": first, "record": 0}
        _put(self.position, self.at)
        return self.at

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = _get(self.position) or self.initialOffset()
        batch, record, left = self.at["batch"], self.at["record"], self.most
        while left is None or left > 0:
            named = _get(_manifest(self.path, batch))
            if named is None:
                break
            rest = sum(n for _, n in named["files"]) - record
            if left is not None and rest > left:
                record += left
                break
            batch, record, left = batch + 1, 0, None if left is None else left - rest
        return {"batch": batch, "record": record}

    def partitions(self, start: dict, end: dict):
        out = []
        for batch in range(start["batch"], end["batch"] + 1):
            low = start["record"] if batch == start["batch"] else 0
            high = end["record"] if batch == end["batch"] else None
            if high == 0:
                continue
            at = 0
            for file, n in _get(_manifest(self.path, batch))["files"]:
                a, b = max(low, at), at + n if high is None else min(high, at + n)
                if a < b:
                    out.append(Slice(file, a - at, b - a))
                at += n
        self.at = end
        _put(self.position, end)
        return out

    def read(self, partition):
        return _read_slice(self.path, partition)


class RecordLog(DataSource):
    """``record_log``: options ``path``; ``batch`` (batch writes); ``position``, ``maxRecords``, ``start`` (streams)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "key string, value string"

    def _path(self) -> str:
        return self.options["path"].rstrip("/")

    def reader(self, schema):
        return LogReader(self._path())

    def writer(self, schema, overwrite):
        return LogWriter(self._path(), int(self.options["batch"]))

    def streamReader(self, schema):
        most = self.options.get("maxRecords")
        return LogStreamReader(self._path(), self.options["position"], int(most) if most else None, self.options.get("start", "earliest"))

    def streamWriter(self, schema, overwrite):
        return LogStreamWriter(self._path())


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(RecordLog)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All records of a log: key, value."""
    register(spark)
    return spark.read.format(FORMAT).option("path", path).load()


def write_log_batch(records: DataFrame, path: str, batch: int) -> None:
    """(key, value) records as batch ``batch`` of a log; a second write of the same batch changes nothing."""
    register(records.sparkSession)
    records.select("key", "value").write.format(FORMAT).option("path", path).option("batch", batch).mode("append").save()


def log_source(spark: SparkSession, path: str, checkpoint: str, max_records: int | None = 1000, start: str = "earliest") -> DataFrame:
    """Streaming (key, value) records of a log, at most ``max_records`` per trigger, for the query with that checkpoint.

    Use processing-time triggers: with ``availableNow`` Spark asks for the end
    once, which then is one trigger's worth.
    """
    register(spark)
    reader = spark.readStream.format(FORMAT).option("path", path).option("start", start).option("position", f"{checkpoint}/log-position.json")
    return (reader.option("maxRecords", max_records) if max_records else reader).load()


def log_sink(records: DataFrame, path: str, checkpoint: str):
    """Stream writer (not started) of (key, value) records into a log."""
    register(records.sparkSession)
    return records.select("key", "value").writeStream.format(FORMAT).option("path", path).option("checkpointLocation", checkpoint)
