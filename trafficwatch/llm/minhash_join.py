"""Near-duplicate classes by an inverted join on MinHash signature coordinates.

A document's signature has ``coordinates`` values, each over ``rows`` min-wise
hashes of its distinct word shingles.  Documents with equal sets become one
node, numbered when the nodes are stored.  Nodes are posted under the (coordinate, value) pairs of a prefix long
enough that two nodes matching in ``least_matches`` coordinates meet in it.

1. Each list's least node is compared with all others (collisions counted,
   pairs below the match threshold dropped, the rest confirmed on full sets).
2. Lists whose nodes are now in one component are skipped.  In the others the
   nodes outside the leader's component are compared with all nodes of other
   components in blocks of bounded size: by signature, at a pair's first shared
   posted value only, then on the full sets.  A block skips pairs whose components
   it has already joined, and returns the links that join them.

Lists of any length are handled; nothing is capped.  With the defaults a pair
of similarity 0.8 meets with a probability above 1 - 1e-8.

Defined results: null or empty text has an empty set and links with nothing;
rows are linked by their sets alone, so rows that share an id, or have none,
are documents of their own where their texts differ; a class is named by its
least id, null if none of its rows has one, and its rows with that id (or all,
if none has one) are kept; equal sets tie and are one node; a very long text is
read in pieces and keeps 8 bytes for each distinct shingle; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm import shared
from trafficwatch.llm.components import components
from trafficwatch.llm.words import NOT_BLANK, mix, word_keys

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Nodes of a posting list that one comparison block holds.
BLOCK_NODES = 2000
#: Parts that a posting list's nodes are dealt out in when the list is looked up.
LIST_PARTS = 16


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; texts with fewer words are one shingle."""
    keys, counts = word_keys(data, offsets, NOT_BLANK)
    n = len(keys)
    rolled = np.zeros(n, np.uint64)
    for k in range(words):
        rolled[: max(0, n - k)] += mix(keys[k:] + np.uint64((k + 1) * int(_GOLDEN) % 2**64))
    rolled = mix(rolled)
    ends = np.cumsum(counts)
    out = []
    for end, count in zip(ends.tolist(), counts.tolist()):
        start = end - count
        if count >= words:
            own = np.sort(rolled[start : end - words + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif count:
            whole = (mix(keys[start:end] + np.arange(1, count + 1, dtype=np.uint64) * _GOLDEN)).sum(dtype=np.uint64) + np.uint64(count)
            out.append(mix(np.array([whole])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def min_hashes(sets: list[np.ndarray], multipliers: np.ndarray) -> np.ndarray:
    """(set, function) least hash of each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), len(multipliers)), np.uint64)
    for k, m in enumerate(multipliers):
        out[:, k] = np.minimum.reduceat(flat * m, starts)
    return out


def signatures(docs: DataFrame, folder: str, words: int, coordinates: int, rows: int, prefix: int, seed: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_a, set_b, posts, raw, file, at) of every document, stored.

    The sets themselves, sorted 64-bit hashes, go to files of ``folder``, one a
    task; (file, at) says where, so no set is ever shuffled.
    """
    rng = np.random.default_rng(seed)
    multipliers = rng.integers(0, 2**63, coordinates * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        out = shared.FileWriter(folder)
        for batch in shared.by_bytes(batches, 1):
            sets = shingle_sets(*shared.utf8_buffers(batch.column(1)), words)
            at = [out.write(s.astype("<u8").tobytes()) if len(s) else 0 for s in sets]
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            low = np.zeros((len(sets), coordinates * rows), np.uint64)
            sums = np.zeros((len(sets), 2), np.uint64)
            if len(full):
                chosen = [sets[k] for k in full]
                low[full] = min_hashes(chosen, multipliers)
                flat, starts = np.concatenate(chosen), np.cumsum(sizes[full]) - sizes[full]
                sums[full, 0] = np.add.reduceat(mix(flat + np.uint64(1)), starts)
                sums[full, 1] = np.add.reduceat(mix(flat ^ _GOLDEN), starts)
            value = np.zeros((len(sets), coordinates), np.uint64)
            for r in range(rows):
                value = mix(value + low[:, r::rows])
            value = mix(value + np.arange(coordinates, dtype=np.uint64) * _GOLDEN)[:, :prefix]
            posts = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * prefix), pa.array(np.ascontiguousarray(value).ravel().view(np.int64)))
            raw = np.ascontiguousarray((low >> np.uint64(48)).astype("<u2"))
            where = [pa.array([out.name] * len(sets), pa.string()), pa.array(at, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes), pa.array(sums[:, 0].view(np.int64)), pa.array(sums[:, 1].copy().view(np.int64)), posts, pa.array([r.tobytes() for r in raw], pa.binary()), *where],
                names=["doc_id", "text_key", "n_shingles", "set_a", "set_b", "posts", "raw", "file", "at"],
            )
        out.close()

    schema = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, posts array<long>, raw binary, file string, at long"
    return shared.materialize(_rows(docs).mapInArrow(run, schema), "signatures", batch_rows=1024)


def text_key() -> Column:
    """What tells the texts of rows with one id apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), text_key().alias("text_key"))


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.sort(np.concatenate([a, b]))
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(both) - common)


def confirmed(pairs: DataFrame, nodes: DataFrame, folder: str, percent: int) -> DataFrame:
    """The (u, v) of ``pairs`` whose full sets are similar enough; ``nodes`` says where the sets lie."""

    def run(batches):
        sets = shared.SliceReader(folder)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            one, two = (list(zip(columns[k], columns[k + 1], [8 * n for n in columns[k + 2]])) for k in (2, 5))
            keep = []
            for k in range(0, len(one), 64):
                sets.fetch(one[k : k + 64] + two[k : k + 64])
                keep += [alike(np.frombuffer(sets.get(*a), "<u8"), np.frombuffer(sets.get(*b), "<u8"), percent) for a, b in zip(one[k : k + 64], two[k : k + 64])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))
        sets.close()

    def named(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.struct("file", "at", "n_shingles").alias(f"_{name}"))

    rows = pairs.join(named("v"), "v").join(named("u"), "u").sortWithinPartitions("_u", "_v").select("u", "v", "_u.*", *[F.col(f"_v.{c}").alias(f"_{c}") for c in ("file", "at", "n_shingles")])
    return shared.materialize(rows.mapInArrow(run, "u long, v long"), "confirmed", batch_rows=1024)


def similar_enough(rows: int, least_matches: int, least_raw: int):
    """Filter of (u, v, raw of u, raw of v): enough matching coordinates and min-wise hashes."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1, rows) for c in (2, 3))
            same = a == b
            keep = (same.all(2).sum(1) >= least_matches) & (same.sum((1, 2)) >= least_raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep))

    return run


class _Union:
    """Components of one block, joined as links are found."""

    def __init__(self, component: np.ndarray):
        self.group = np.unique(component, return_inverse=True)[1]

    def join(self, a: int, b: int) -> None:
        self.group[self.group == self.group[a]] = self.group[b]


def compare_lists(folder: str, rows: int, least_matches: int, least_raw: int, percent: int):
    """Links (u, v) across components from rows sorted by (key, block).

    A block's links are a forest over its components: once two are joined, no
    more of their pairs are looked at.  Pairs are screened by signature; only
    the sets of those left are read.
    """

    def links(part: pa.Table, sets: shared.SliceReader):
        node = part["node"].to_numpy()
        home, outside = part["home"].to_numpy(zero_copy_only=False), part["outside"].to_numpy(zero_copy_only=False)
        at, joined = part["at"][0].as_py(), _Union(part["component"].to_numpy())
        raw = np.frombuffer(b"".join(part["raw"].to_pylist()), "<u2").reshape(len(node), -1)
        # the posted values themselves: hashes cut to 16 bits also agree by chance
        earlier = part["posts"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)[:, :at]
        where = list(zip(part["file"].to_pylist(), part["place"].to_pylist(), (8 * part["n_shingles"].to_numpy()).tolist()))
        own = np.flatnonzero(home)
        for k in np.flatnonzero(outside):
            rest = own[(joined.group[own] != joined.group[k]) & ~(outside[own] & (node[own] <= node[k]))]
            if not len(rest):
                continue
            same = raw[rest] == raw[k]
            total = same.sum(1)
            close = total >= least_raw
            rest, total, whole = rest[close], total[close], same[close].reshape(int(close.sum()), raw.shape[1] // rows, rows).all(2)
            meets = (whole.sum(1) >= least_matches) & ~(earlier[rest] == earlier[k]).any(1)
            chosen = rest[meets][np.argsort(-total[meets], kind="stable")].tolist()
            if chosen:
                sets.fetch([where[k], *(where[o] for o in chosen[:16])])
            for other in chosen:
                if joined.group[other] != joined.group[k] and alike(np.frombuffer(sets.get(*where[k]), "<u8"), np.frombuffer(sets.get(*where[other]), "<u8"), percent):
                    joined.join(k, other)
                    yield int(min(node[k], node[other])), int(max(node[k], node[other]))

    def found(part: pa.Table, sets: shared.SliceReader):
        if part.num_rows > 1:
            pairs = list(links(part, sets))
            if pairs:
                u, v = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        sets = shared.SliceReader(folder)
        for batch in batches:
            key, block = batch.column("key").to_numpy(), batch.column("block").to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            if held and batch.num_rows and (held[-1]["key"][-1].as_py(), held[-1]["block"][-1].as_py()) != (key[0], block[0]):
                yield from found(pa.Table.from_batches(held), sets)
                held = []
            begin = 0
            for c in cut.tolist():
                yield from found(pa.Table.from_batches([*held, batch.slice(begin, c - begin)]), sets)
                held, begin = [], c
            if batch.num_rows:
                held.append(batch.slice(begin))
        if held:
            yield from found(pa.Table.from_batches(held), sets)
        sets.close()

    return run


def near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links), kept (the least one); parameters of ``near_classes``."""
    return near_classes(docs, **parameters).select("doc_id", "n_shingles", "component_id", "kept")


def near_classes(docs: DataFrame, words: int = 5, percent: int = 80, coordinates: int = 32, rows: int = 3, least_matches: int = 2, seed: int = 11, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """The rows of ``near_duplicates`` with ``text_key`` and ``component``, a number of the class (null for an empty set)."""
    spark = docs.sparkSession
    shared.with_python(spark)
    prefix = coordinates - least_matches + 1
    # six standard deviations below the expected matches of a pair at the threshold
    functions, p = coordinates * rows, percent / 100
    least_raw = max(0, int(functions * p - 6 * (functions * p * (1 - p)) ** 0.5))
    folder = shared.shared_dir(spark, "shingles")
    all_rows = signatures(docs, folder, words, coordinates, rows, prefix, seed)
    same = ["set_a", "set_b", "n_shingles"]
    groups = all_rows.filter("n_shingles > 0").groupBy(*same)
    # a row that holds the set, the least id first
    groups = groups.agg(F.min("doc_id").alias("doc_id"), F.first("posts").alias("posts"), F.first("raw").alias("raw"), F.first(F.struct("file", "at")).alias("where"))
    groups = groups.select(*same, "doc_id", "posts", "raw", "where.file", "where.at", F.monotonically_increasing_id().alias("node"))
    nodes = shared.materialize(groups, "nodes")

    posted = nodes.select("node", F.posexplode("posts").alias("at", "key"))
    lists = shared.materialize(posted.groupBy("key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "lists")
    posts = shared.materialize(posted.join(lists, "key"), "posts")
    stars = posts.filter(F.col("leader") != F.col("node")).groupBy(F.col("leader").alias("u"), F.col("node").alias("v")).count()
    raws = nodes.select("node", "raw")

    def screened(pairs: DataFrame, tag: str) -> DataFrame:
        rows_ = pairs.select("u", "v").join(raws.select(F.col("node").alias("v"), F.col("raw").alias("b")), "v")
        rows_ = rows_.join(raws.select(F.col("node").alias("u"), F.col("raw").alias("a")), "u").select("u", "v", "a", "b")
        return shared.materialize(rows_.mapInArrow(similar_enough(rows, least_matches, least_raw), "u long, v long").distinct(), tag)

    candidates = screened(stars, "star-pairs")
    links = confirmed(candidates, nodes, folder, percent)
    found = components(links)

    named = posts.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    leading = F.coalesce(F.max(F.when(F.col("node") == F.col("leader"), F.col("component"))), F.lit(-1))
    mixed = named.filter("n > 2").groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), leading.alias("_own"), F.count(F.lit(1)).alias("_size"))
    # a long list's rows are dealt out by node too, so its description goes to each of the parts
    parts = F.explode(F.sequence(F.lit(0), F.lit(LIST_PARTS - 1))).alias("_part")
    mixed = shared.materialize(mixed.filter("_low != _high").select("key", "_own", "_size"), "mixed-lists").select("*", parts)
    blocks = F.ceil(F.col("_size") / block_nodes)
    rest = named.withColumn("_part", F.pmod(F.xxhash64("node"), F.lit(LIST_PARTS)).cast("int")).join(mixed, ["key", "_part"]).filter(F.col("node") != F.col("leader")).select(
        "key", "at", "node", "component", (F.col("component") != F.col("_own")).alias("outside"), F.pmod(F.xxhash64("node"), blocks).alias("_home"), blocks.alias("_blocks")
    )
    rest = rest.withColumn("block", F.explode(F.when(F.col("outside"), F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).otherwise(F.array("_home"))))
    rest = rest.withColumn("home", F.col("block") == F.col("_home")).join(nodes.select("node", "raw", "posts", "file", F.col("at").alias("place"), "n_shingles"), "node")
    rest = rest.select("key", "block", "at", "node", "component", "outside", "home", "raw", "posts", "file", "place", "n_shingles").repartition("key", "block").sortWithinPartitions("key", "block")
    more = rest.mapInArrow(compare_lists(folder, rows, least_matches, least_raw, percent), "u long, v long").distinct()
    found = components(links.unionByName(shared.materialize(more, "list-links", batch_rows=512)))

    # the least id of each class of several nodes
    linked = found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
    names = linked.join(nodes.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("_name"))
    linked = linked.join(names, "component").withColumn("_several", F.lit(True))
    named = nodes.select(*same, "node", F.col("doc_id").alias("_own")).join(linked, "node", "left")
    named = named.select(*same, F.coalesce("component", "node").alias("component"), F.when(F.col("_several"), F.col("_name")).otherwise(F.col("_own")).alias("component_id"))
    out = all_rows.select("doc_id", "text_key", *same).join(named, same, "left")
    component_id = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_key", "n_shingles", "component", component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"))


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """``docs``, whole rows, without near duplicates: one row of each class stays (parameters of ``near_classes``).

    Rows without an id stay.  Of the kept rows that share an id, those of one
    class, or of one empty set and text, leave as one: the least by the text's
    key, then by all columns.  Columns of any name are kept as they are.
    """
    spark = docs.sparkSession
    path, again = shared.shared_dir(spark, "near-dropped"), shared.shared_dir(spark, "near-repeated")
    with shared.temporary(spark):
        classes = near_classes(docs, **parameters).filter("doc_id is not null")
        classes = shared.materialize(classes.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), F.col("component").alias("class"), "kept"), "near-kept")
        dropped = shared.materialize(classes.filter("not kept").select("id", "key").distinct(), "near-dropped", path=path)
        several = classes.groupBy("id").count().filter("count > 1")
        repeated = classes.filter("kept").join(several, "id", "left_semi").select("id", "key", "class").distinct()
        repeated = shared.materialize(repeated, "near-repeated", path=again)
    names = [f"c{k}" for k in range(len(docs.columns))]
    whole = F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)]).alias("row")
    held = docs.select(F.col("doc_id").cast("long").alias("id"), text_key().alias("key"), whole)
    kept = held.join(dropped, ["id", "key"], "left_anti")
    if not repeated.isEmpty():
        empty = F.when(F.col("class").isNull(), F.col("key"))
        once = held.join(repeated, ["id", "key"]).groupBy("id", "class", empty).agg(F.min(F.struct("key", "row")).alias("least"))
        kept = kept.join(repeated, ["id", "key"], "left_anti").select("row").unionByName(once.select("least.row"))
    return kept.select(*[F.col(f"row.{n}").alias(c) for c, n in zip(docs.columns, names)])
