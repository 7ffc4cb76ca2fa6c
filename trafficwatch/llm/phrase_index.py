"""Positional inverted index over training text, searched for benchmark phrases.

``build_index`` cuts the documents into shards of bounded size and stores, per
shard, its sorted terms with the positions of every word (delta-coded) as one
table row: no shuffle, and a frequent term is spread over all shards.
The test items are tokenised by Spark into files of bounded blocks; a search
task holds a few shards and goes through the blocks, of which it keeps
``KEPT_BYTES`` (more are read again for the next shards), so items of any number
are one job and never come to the driver.  In
each shard a window's posting lists are shifted by their offsets and
intersected from the rarest term on; what is left are exact phrases.  Proximity
matches keep the anchors of the rarest term that have every other term of the
window near them.

Defined results: words of a null or empty text: none, so such documents are
clean and such items match nothing; an item shorter than the window is one
window; items without id take no part, items that share an id count once;
every document row gives a row, also if it repeats another; there are no ties;
a very long text is a shard of its own; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm import shared
from trafficwatch.llm.words import LETTERS_DIGITS, word_keys

#: Free positions between two documents of a shard, so that no window spans both.
GAP = 1024
#: Bytes of test-item blocks that a task keeps.
KEPT_BYTES = 32 << 20
_INDEX = "shard long, docs array<struct<doc_id: bigint, text_key: bigint, n_words: bigint>>, terms binary, counts binary, postings binary"
_DOC = pa.struct([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64())])
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
_HITS = "shard long, slot int, item_id long, spans array<struct<start: bigint, stop: bigint>>, exact boolean"


def shard_columns(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(sorted terms, postings per term, delta-coded positions) of a shard's words."""
    position = np.arange(len(keys)) + np.repeat(np.arange(len(counts)) * GAP, counts)
    order = np.argsort(keys, kind="stable")
    terms, first, per = np.unique(keys[order], return_index=True, return_counts=True)
    postings = position[order]
    delta = np.diff(postings, prepend=0)
    delta[first] = postings[first]
    return terms.astype("<u8").tobytes(), per.astype("<u4").tobytes(), delta.astype("<u4").tobytes()


def build_index(docs: DataFrame, shard_bytes: int = 1 << 20) -> DataFrame:
    """The stored index of ``docs`` (doc_id, text); one row per shard."""
    shared.with_python(docs.sparkSession)

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for batch in shared.by_bytes(batches, 2, shard_bytes):
            keys, counts = word_keys(*shared.utf8_buffers(batch.column(2)), LETTERS_DIGITS)
            entries = pa.StructArray.from_arrays([batch.column(0), batch.column(1), pa.array(counts)], fields=list(_DOC))
            terms, per, postings = shard_columns(keys, counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 32 | seq]),
                    pa.ListArray.from_arrays(pa.array([0, len(entries)], pa.int32()), entries),
                    *(pa.array([x], pa.binary()) for x in (terms, per, postings)),
                ],
                names=["shard", "docs", "terms", "counts", "postings"],
            )
            seq += 1

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return shared.materialize(rows.mapInArrow(run, _INDEX), "phrase-index", batch_rows=1024)


class Shard:
    """Posting lists of one index row."""

    def __init__(self, terms: pa.Buffer | bytes, counts: pa.Buffer | bytes, postings: pa.Buffer | bytes):
        self.terms = np.frombuffer(terms, "<u8")
        self.counts = np.frombuffer(counts, "<u4").astype(np.int64)
        self.ends = np.cumsum(self.counts)
        self.delta = np.frombuffer(postings, "<u4")

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Index of each term, -1 where the shard lacks it."""
        at = np.minimum(np.searchsorted(self.terms, keys), max(0, len(self.terms) - 1))
        return np.where(self.terms[at] == keys, at, -1) if len(self.terms) else np.full(len(keys), -1)

    def list(self, place: int) -> np.ndarray:
        end = int(self.ends[place])
        return np.cumsum(self.delta[end - int(self.counts[place]) : end], dtype=np.int64)


class Items:
    """Windows of a block of test items."""

    def __init__(self, ids: list[int], keys: np.ndarray, counts: np.ndarray, window: int):
        self.ids = ids
        self.keys, self.of = np.unique(keys, return_inverse=True)
        n = np.where(counts > 0, np.maximum(1, counts - window + 1), 0)
        item = np.repeat(np.arange(len(ids)), n)
        first = np.cumsum(counts) - counts
        self.item = item
        self.start = first[item] + np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
        self.length = np.minimum(window, counts)[item]


def _phrase(lists: list[np.ndarray]) -> np.ndarray:
    """Start positions of the phrase whose k-th word has the k-th list."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    at = lists[order[0]] - order[0]
    for k in order[1:]:
        if not len(at):
            break
        place = np.searchsorted(lists[k], at + k)
        place[place == len(lists[k])] = 0
        at = at[lists[k][place] == at + k]
    return at


def _near(lists: list[np.ndarray], reach: int) -> np.ndarray:
    """Positions of the rarest term that have each other term within ``reach``."""
    lists = sorted(lists, key=len)
    at = lists[0]
    for other in lists[1:]:
        if not len(at):
            break
        place = np.searchsorted(other, at - reach)
        last = place == len(other)
        place[last] = 0
        at = at[~last & (other[place] <= at + reach)]
    return at


def _merged(starts: np.ndarray, stops: np.ndarray) -> list[dict]:
    """Union of intervals, in order."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
    return [{"start": int(a), "stop": int(b)} for a, b in zip(starts[new], reach[np.append(new[1:], len(starts)) - 1])]


def search_shard(shard: Shard, items: Items, bounds: np.ndarray, slop: int) -> list[tuple]:
    """(slot, item, spans, exact) of one shard; ``bounds``: first position of each document."""
    places = shard.places(items.keys)[items.of]
    lacking = np.concatenate([[0], np.cumsum(places < 0)])
    possible = np.flatnonzero(lacking[items.start + items.length] == lacking[items.start])
    lists: dict[int, np.ndarray] = {}
    found: dict[tuple[int, int, bool], list] = {}
    for w in possible.tolist():
        own = places[items.start[w] : items.start[w] + items.length[w]].tolist()
        for p in own:
            if p not in lists:
                lists[p] = shard.list(p)
        for exact, at in ((True, _phrase([lists[p] for p in own])), (False, _near([lists[p] for p in set(own)], len(own) - 1 + slop))):
            if len(at):
                slots = np.searchsorted(bounds, at, "right") - 1
                stop = at + len(own) if exact else at + 1
                cut = np.flatnonzero(np.diff(slots, prepend=-1))
                for a, b in zip(cut, np.append(cut[1:], len(slots))):
                    base = bounds[slots[a]]
                    found.setdefault((int(slots[a]), int(items.item[w]), exact), []).append((at[a:b] - base, stop[a:b] - base))
    return [(slot, items.ids[i], _merged(*(np.concatenate(x) for x in zip(*parts))), exact) for (slot, i, exact), parts in found.items()]


_BLOCKS = "name string, n long, size long"


def store_items(items: DataFrame, folder: str, limit: int) -> list[tuple[str, int, int]]:
    """Test items in files of about ``limit`` bytes of text; (name, items, bytes) of each file, all that the driver learns."""

    def write(ids: list[int], texts: list[pa.Array]) -> pa.RecordBatch:
        keys, counts = word_keys(*shared.utf8_buffers(pa.concat_arrays(texts)), LETTERS_DIGITS)
        out = shared.FileWriter(folder)
        out.write(b"".join(x.tobytes() for x in (np.array(ids, "<i8"), counts.astype("<i8"), keys.astype("<u8"))))
        out.close()
        return pa.RecordBatch.from_arrays([pa.array([out.name]), pa.array([len(ids)], pa.int64()), pa.array([out.size], pa.int64())], names=["name", "n", "size"])

    def run(batches):
        ids, texts, held = [], [], 0
        for batch in shared.by_bytes(batches, 1, limit):
            ids += batch.column(0).to_pylist()
            texts.append(batch.column(1))
            held += batch.column(1).nbytes
            if held >= limit:
                yield write(ids, texts)
                ids, texts, held = [], [], 0
        if ids:
            yield write(ids, texts)

    rows = items.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return sorted(tuple(r) for r in shared.materialize(rows.mapInArrow(run, _BLOCKS), "item-blocks", batch_rows=1024).collect())


class _ItemBlocks:
    """The stored blocks, as many kept as fit into ``KEPT_BYTES``."""

    def __init__(self, folder: str, blocks: list[tuple[str, int, int]], window: int):
        self.folder, self.blocks, self.window = folder, blocks, window
        self.kept: dict[str, Items] = {}
        self.held = 0

    def __iter__(self):
        for name, n, size in self.blocks:
            items = self.kept.get(name)
            if items is None:
                with shared.open_file(f"{self.folder}/{name}") as f:
                    flat = np.frombuffer(f.read(), "<i8")
                items = Items(flat[:n].tolist(), flat[2 * n :].view("<u8"), flat[n : 2 * n], self.window)
                if self.held + size <= KEPT_BYTES:
                    self.kept[name] = items
                    self.held += size
            yield items


def matches(index: DataFrame, items: DataFrame, window: int = 10, slop: int = 10, block_bytes: int = 4 << 20, shards: int = 4) -> DataFrame:
    """Phrase (``exact``) and proximity matches, stored: shard, slot, item_id, spans of word positions in the document.

    ``shards``: how many a task holds at a time.
    """
    if not 0 < window + slop < GAP:
        raise ValueError("window and slop must stay below the gap between documents")
    folder = shared.shared_dir(index.sparkSession, "test-items")
    blocks = store_items(items, folder, block_bytes)

    def run(batches):
        stored = _ItemBlocks(folder, blocks, window)
        for batch in batches:
            held = []
            for k in range(batch.num_rows):
                n_words = batch.column(1)[k].values.field(2).to_numpy()
                bounds = np.cumsum(n_words) - n_words + np.arange(len(n_words)) * GAP
                held.append((batch.column(0)[k].as_py(), Shard(*(batch.column(c)[k].as_buffer() for c in (2, 3, 4))), bounds))
            for block in stored:
                for number, shard, bounds in held:
                    hits = search_shard(shard, block, bounds, slop)
                    if hits:
                        slots, ids, spans, exact = zip(*hits)
                        columns = [pa.array([number] * len(hits)), pa.array(slots, pa.int32()), pa.array(ids, pa.int64()), pa.array(spans, pa.list_(_SPAN)), pa.array(exact)]
                        yield pa.RecordBatch.from_arrays(columns, names=["shard", "slot", "item_id", "spans", "exact"])
        shared.release()

    return shared.materialize(index.select("shard", "docs", "terms", "counts", "postings").mapInArrow(run, _HITS), "phrase-hits", batch_rows=shards)


def contamination(index: DataFrame, found: DataFrame) -> DataFrame:
    """One row per indexed document: hit words and matching items."""
    docs = index.select("shard", F.posexplode("docs").alias("slot", "d"))
    nothing = F.array().cast("array<struct<start: bigint, stop: bigint>>")
    base = docs.select("shard", "slot", "d.doc_id", "d.text_key", "d.n_words", nothing.alias("spans"), F.lit(None).cast("long").alias("item_id"), F.lit(None).cast("long").alias("near_id"))
    none = F.lit(None).cast("long")
    hits = found.select(
        "shard", "slot", none.alias("doc_id"), none.alias("text_key"), none.alias("n_words"),
        F.when(F.col("exact"), F.col("spans")).otherwise(nothing).alias("spans"),
        F.when(F.col("exact"), F.col("item_id")).alias("item_id"), F.when(~F.col("exact"), F.col("item_id")).alias("near_id"),
    )
    rows = base.unionByName(hits).groupBy("shard", "slot").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("text_key").alias("text_key"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("_spans"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("_items"),
        F.size(F.collect_set("near_id")).cast("long").alias("n_near_items"),
    )
    covered = F.expr(
        "aggregate(_spans, named_struct('n', 0L, 'reach', 0L), (a, s) -> named_struct("
        "'n', a.n + greatest(0L, s.stop - greatest(s.start, a.reach)), 'reach', greatest(a.reach, s.stop)), a -> a.n)"
    )
    rows = rows.withColumn("n_hit", covered)
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("_items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "n_near_items", "text_key",
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 10) -> DataFrame:
    """``contamination`` of every row of ``docs`` (doc_id, text) by ``items`` (item_id, text)."""
    index = build_index(docs)
    return contamination(index, matches(index, items, window, slop))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``docs``, whole rows, without those that hold a window of ``items``; columns of any name are kept as they are."""
    spark = docs.sparkSession
    path = shared.shared_dir(spark, "contaminated")
    with shared.temporary(spark):
        found = decontaminate(docs, items, window).filter("contaminated").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
        found = shared.materialize(found.distinct(), "contaminated", path=path)
    names = [f"c{k}" for k in range(len(docs.columns))]
    whole = F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)]).alias("row")
    held = docs.select(F.col("doc_id").cast("long").alias("held_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("held_key"), whole)
    clean = held.join(found, F.col("held_id").eqNullSafe(F.col("id")) & (F.col("held_key") == F.col("key")), "left_anti")
    return clean.select(*[F.col(f"row.{n}").alias(c) for c, n in zip(docs.columns, names)])
