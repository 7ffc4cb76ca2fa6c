"""Text quality by a generalised additive model with pairwise interactions.

Every text becomes a row of shape features (``FEATURES``).  A feature is cut
into bins; the model holds one lookup table a feature, and one a chosen pair of
features.  Training is cyclic boosting: round after round, each feature in turn
gets one shallow tree over its bins, fitted to what the sum of all tables still
gets wrong, and the tree's leaves are added to its table.  When the single
features are learned, the pairs that explain most of the rest are found on
coarse grids and boosted the same way with trees that cut one axis, then the
other.  A score is the logistic of the intercept and the tables' entries, added
up over whole arrays.

Learned from at most ``per_class`` labelled rows of each label (a parameter),
drawn by a hash over all of them; features, edges of the scored rows and scores
cover every row.  The sample's features, not its texts, come to the driver:
per_class x 2 x len(FEATURES) doubles at most.

Defined results: null text is scored as empty text; rows with a null id, and
rows without a label of 0 or 1, are never learned from; of several labels for
one id the least counts; rows that repeat an id or a text are scored each by
its text, so equal texts agree; without labelled rows every score is 0.5, with
one label alone the share with one row of each added; a score of exactly 0.5
predicts 1; a very long text is read in pieces, 40 bytes a word are kept of it;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficwatch.llm import shared
from trafficwatch.llm.lang_crf import held_out
from trafficwatch.llm.words import LOWER, NOT_BLANK, byte_set, mix, span_keys, spans

FEATURES = (
    "log_words", "mean_word", "longest_word", "short_words", "upper_letters", "upper_words", "odd_symbols", "odd_words", "bare_symbols", "digits",
    "beyond_ascii", "stops", "distinct_words", "repeated_next", "repeated_pairs", "log_lines", "words_a_line", "repeated_lines", "upper_lines", "odd_lines",
    "repeating_lines", "capitals", "line_ends", "distinct_bytes",
)

_UPPER = byte_set((0x41, 0x5A))
_ASCII_LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A))
_DIGIT = byte_set((0x30, 0x39))
_STOP = byte_set((0x2E, 0x2E), (0x21, 0x21), (0x3F, 0x3F))
#: ASCII signs other than the stop, comma, colon, semicolon, apostrophe and hyphen of plain prose.
_ODD = byte_set((0x21, 0x26), (0x28, 0x2B), (0x2F, 0x2F), (0x3C, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


# -- features ----------------------------------------------------------------------------------


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """(low, high) of consecutive pieces of about CHUNK_BYTES, cut between words."""
    at, end = 0, int(offsets[-1])
    while at < end:
        to = min(at + shared.CHUNK_BYTES, end)
        while to < end and NOT_BLANK[data[to]] and NOT_BLANK[data[to - 1]]:
            tail = ~NOT_BLANK[data[to : to + 65536]]
            to = min(to + (int(np.argmax(tail)) if tail.any() else len(tail)), end)
        yield at, to
        at = to


def _words(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """One entry a word: text, line (counted over all texts), key, and counts of its bytes by kind."""
    found: dict[str, list[np.ndarray]] = {k: [] for k in ("text", "line", "key", "bytes", "letters", "upper", "odd", "digits", "beyond", "stop", "first_upper")}
    lines = 0
    for low, high in _pieces(data, offsets):
        piece = data[low:high]
        local = np.clip(offsets[np.searchsorted(offsets, low, "right") - 1 : np.searchsorted(offsets, high, "left") + 1] - low, 0, high - low)
        starts, ends = spans(NOT_BLANK[piece], local)
        # Latin-1 capitals: 0xC3 and a second byte of 0x80-0x9E, the sign at 0x97 left out
        lead = np.flatnonzero(piece[:-1] == 0xC3)
        second = piece[lead + 1]
        capital = np.zeros(len(piece), bool)
        capital[lead] = (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        upper = _UPPER[piece] | capital
        letter = _ASCII_LETTER[piece]
        letter[lead] = True

        def inside(mask: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
            return total[ends] - total[starts]

        breaks = np.concatenate([[0], np.cumsum(piece == 10, dtype=np.int64)])
        found["text"].append(np.searchsorted(offsets, starts + low, "right") - 1)
        found["line"].append(lines + breaks[starts])
        found["key"].append(span_keys(LOWER[piece], starts, ends - starts))
        found["bytes"].append(ends - starts)
        for name, mask in (("letters", letter), ("upper", upper), ("odd", _ODD[piece]), ("digits", _DIGIT[piece]), ("beyond", piece >= 0xC0)):
            found[name].append(inside(mask))
        found["stop"].append(_STOP[piece[ends - 1]])
        found["first_upper"].append(upper[starts])
        lines += int(breaks[-1])
    return {k: np.concatenate(v) if v else np.zeros(0, np.uint64 if k == "key" else np.int64) for k, v in found.items()}


def _distinct(group: np.ndarray, key: np.ndarray, groups: int) -> np.ndarray:
    """Distinct keys in each group; ``group`` does not fall."""
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
    return np.bincount(g[new], minlength=groups)


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(text, feature) of concatenated UTF-8 texts; all shares of an empty text are 0."""
    n = len(offsets) - 1
    w = _words(data, offsets)
    text = w["text"]

    def total(values, of=text) -> np.ndarray:
        return np.bincount(of, values, n)

    def share(part, whole) -> np.ndarray:
        return np.divide(part, whole, out=np.zeros(n), where=whole > 0)

    words = np.bincount(text, minlength=n).astype(float)
    size, letters = total(w["bytes"]), total(w["letters"])
    all_upper = (w["letters"] >= 2) & (w["upper"] == w["letters"])
    odd = w["odd"] > 0
    key = w["key"]
    same_text = text[1:] == text[:-1]
    again = np.zeros(len(text), bool)
    again[1:] = same_text & (key[1:] == key[:-1])
    pairs = mix(key[:-1] * _GOLDEN + key[1:])[same_text]
    pair_text = text[1:][same_text]
    longest = np.zeros(n)
    np.maximum.at(longest, text, w["bytes"])
    # lines that hold words
    first = np.ones(len(text), bool)
    first[1:] = ~same_text | (w["line"][1:] != w["line"][:-1])
    begin = np.flatnonzero(first)
    line_of = np.cumsum(first) - 1
    line_text = text[begin]
    lines = np.bincount(line_text, minlength=n).astype(float)
    line_words = np.bincount(line_of, minlength=len(begin))
    place = np.arange(len(text)) - begin[line_of] if len(begin) else np.zeros(0, np.int64)
    line_key = np.zeros(len(begin), np.uint64)
    if len(begin):
        line_key = np.add.reduceat(mix(key + (place.astype(np.uint64) + np.uint64(1)) * _GOLDEN), begin)

    def mostly(flag: np.ndarray) -> np.ndarray:
        return share(total((2 * np.bincount(line_of, flag, len(begin)) >= line_words).astype(float), line_text), lines)

    last = np.ones(len(text), bool)
    last[:-1] = first[1:]
    kinds = np.zeros(n)
    for low, high in zip(range(0, n, 256), range(256, n + 256, 256)):
        some = offsets[low : min(high, n) + 1]
        seen = np.zeros((len(some) - 1, 256), bool)
        seen[np.repeat(np.arange(len(some) - 1), np.diff(some)), data[some[0] : some[-1]]] = True
        kinds[low : low + len(seen)] = seen.sum(1)
    return np.column_stack([
        np.log1p(words), share(size, words), np.log1p(longest), share(total(w["bytes"] <= 2), words), share(total(w["upper"]), letters), share(total(all_upper), words),
        share(total(w["odd"]), size), share(total(odd), words), share(total(odd & (w["letters"] == 0)), words), share(total(w["digits"]), size),
        share(total(w["beyond"]), size), share(total(w["stop"]), words), share(_distinct(text, key, n), words), share(total(again), words),
        1 - share(_distinct(pair_text, pairs, n) + (words == words), np.maximum(words, 1)), np.log1p(lines), share(words, lines), share(lines - _distinct(line_text, line_key, n), lines),
        mostly(all_upper), mostly(odd), mostly(again), share(total(w["first_upper"]), words), share(total(last & (w["stop"] > 0)), lines), kinds,
    ]).astype(np.float64)


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, f0, f1, ...) of every row, stored: texts are read once for training and scoring."""
    shared.with_python(docs.sparkSession)
    names = [f"f{k}" for k in range(len(FEATURES))]

    def run(batches):
        for batch in shared.by_bytes(batches, 2):
            x = text_features(*shared.utf8_buffers(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(np.ascontiguousarray(c)) for c in x.T]], names=["doc_id", "held_out", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    schema = "doc_id long, held_out boolean, " + ", ".join(f"{c} double" for c in names)
    return shared.materialize(rows.mapInArrow(run, schema), "features", batch_rows=1024)


# -- the model ---------------------------------------------------------------------------------


def _leaves(grad: np.ndarray, hess: np.ndarray, count: np.ndarray, cuts: int, least: int, ridge: float) -> np.ndarray:
    """Values of a tree of ``cuts`` + 1 leaves over ordered bins, each cut where it gains most."""
    out = np.zeros(len(grad))
    parts = [(0, len(grad))]
    g, h, c = (np.concatenate([[0.0], np.cumsum(x)]) for x in (grad, hess, count))

    def best(low: int, high: int) -> tuple[float, int]:
        if high - low < 2:
            return 0.0, low
        at = np.arange(low + 1, high)
        left, right = (g[at] - g[low], h[at] - h[low]), (g[high] - g[at], h[high] - h[at])
        gain = left[0] ** 2 / (left[1] + ridge) + right[0] ** 2 / (right[1] + ridge) - (g[high] - g[low]) ** 2 / (h[high] - h[low] + ridge)
        gain[(c[at] - c[low] < least) | (c[high] - c[at] < least)] = 0
        k = int(gain.argmax())
        return float(gain[k]), int(at[k])

    for _ in range(cuts):
        choices = [(*best(low, high), k) for k, (low, high) in enumerate(parts)]
        gain, at, k = max(choices)
        if gain <= 0:
            break
        low, high = parts[k]
        parts[k : k + 1] = [(low, at), (at, high)]
    for low, high in parts:
        out[low:high] = (g[high] - g[low]) / (h[high] - h[low] + ridge)
    return out


def _side_gains(g: np.ndarray, h: np.ndarray, c: np.ndarray, least: int, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """(gain, place) of the best cut of each row of sums along its columns; place 0 leaves it whole."""
    left_g, left_h, left_c = (np.cumsum(x, 1)[:, :-1] for x in (g, h, c))
    all_g, all_h, all_c = (x.sum(1, keepdims=True) for x in (g, h, c))
    whole = (all_g**2 / (all_h + ridge))[:, 0]
    gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge)
    gain[(left_c < least) | (all_c - left_c < least)] = -1
    rows = np.arange(len(g))
    place = gain.argmax(1) if gain.shape[1] else np.zeros(len(g), np.int64)
    best = gain[rows, place] if gain.shape[1] else whole - 1
    return np.maximum(best, whole), np.where(best > whole, place + 1, 0)


def _grid_leaves(grad: np.ndarray, hess: np.ndarray, count: np.ndarray, least: int, ridge: float) -> tuple[np.ndarray, float]:
    """(values, gain) of the best tree that cuts one axis of the grid once, then each side once along the other."""
    found = (np.zeros(grad.shape), -1.0)
    for turned in (False, True):
        sums = [np.cumsum(x.T if turned else x, 0) for x in (grad, hess, count)]
        upper, lower = [x[:-1] for x in sums], [x[-1] - x[:-1] for x in sums]
        (one, first), (two, second) = (_side_gains(*side, least, ridge) for side in (upper, lower))
        k = int((one + two).argmax())
        if one[k] + two[k] > found[1]:
            out = np.zeros(sums[0].shape)
            for part, (g, h, _), at in ((out[: k + 1], upper, first[k]), (out[k + 1 :], lower, second[k])):
                for columns in (slice(0, at), slice(at, None)):
                    part[:, columns] = g[k, columns].sum() / (h[k, columns].sum() + ridge)
            found = (out.T if turned else out, float(one[k] + two[k]))
    return found


@dataclass
class Gam:
    """Lookup tables; ``score`` adds them up."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], 1) if self.edges else np.zeros((len(x), 0), np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        at = self.bins(x)
        total = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[at[:, k]]
        for a, b, grid in self.pairs:
            total += grid[at[:, a], at[:, b]]
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 120, pair_rounds: int = 60, most_pairs: int = 10, cuts: int = 3, rate: float = 0.08, least: int = 4, ridge: float = 2.0) -> Gam:
    """Boost tables for features ``x`` and labels ``y`` (0 or 1)."""
    ones = float(y.sum())
    if not len(y) or ones in (0.0, float(len(y))):
        return Gam(float(np.log((ones + 1) / (len(y) - ones + 1))))
    model = Gam(float(np.log(ones / (len(y) - ones))))
    for column in x.T:
        values = np.unique(np.quantile(column, np.arange(1, bins) / bins, method="higher"))
        model.edges.append(values[values > column.min()])
        model.tables.append(np.zeros(len(model.edges[-1]) + 1))
    at = model.bins(x)
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -50, 50)))
        return y - p, np.maximum(p * (1 - p), 1e-9)

    counts = [np.bincount(at[:, k], minlength=len(t)) for k, t in enumerate(model.tables)]
    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            if len(table) > 1:
                grad, hess = slopes()
                step = rate * _leaves(np.bincount(at[:, k], grad, len(table)), np.bincount(at[:, k], hess, len(table)), counts[k], cuts, least, ridge)
                table += step
                total += step[at[:, k]]
    # pairs by what one tree over their grid still gains
    useful = [k for k, t in enumerate(model.tables) if len(t) > 1]
    grad, hess = slopes()
    ranked = []
    for i, a in enumerate(useful):
        for b in useful[i + 1 :]:
            cell, shape = at[:, a] * len(model.tables[b]) + at[:, b], (len(model.tables[a]), len(model.tables[b]))
            g, h, c = (np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (grad, hess, None))
            ranked.append((-_grid_leaves(g, h, c, least, ridge)[1], a, b))
    chosen = [(a, b, np.zeros((len(model.tables[a]), len(model.tables[b])))) for _, a, b in sorted(ranked)[:most_pairs]]
    cells = [at[:, a] * grid.shape[1] + at[:, b] for a, b, grid in chosen]
    sizes = [np.bincount(cell, minlength=grid.size).reshape(grid.shape) for cell, (_, _, grid) in zip(cells, chosen)]
    for _ in range(pair_rounds):
        for cell, size, (_, _, grid) in zip(cells, sizes, chosen):
            grad, hess = slopes()
            g, h = (np.bincount(cell, v, grid.size).reshape(grid.shape) for v in (grad, hess))
            step = rate * _grid_leaves(g, h, size, least, ridge)[0]
            grid += step
            total += step.ravel()[cell]
    model.pairs = chosen
    return model


def training_rows(rows: DataFrame, labels: DataFrame, per_class: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of at most ``per_class`` rows of each label, the same ones on every run."""
    names = [f"f{k}" for k in range(len(FEATURES))]
    known = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label"))
    usable = rows.filter("not held_out and doc_id is not null").join(known, "doc_id")
    counts = {r[0]: r[1] for r in usable.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("training")), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, 3.0 * per_class / n))).otherwise(share)
    drawn = usable.withColumn("_draw", draw).filter(F.col("_draw") < share)
    rank = F.row_number().over(Window.partitionBy("label").orderBy("_draw", "doc_id", *names))
    table = drawn.withColumn("_rank", rank).filter(F.col("_rank") <= per_class).select("label", *names).toArrow()
    x = np.column_stack([table[c].to_numpy() for c in names]) if table.num_rows else np.zeros((0, len(names)))
    y = table["label"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))
    return x[order], y[order]


def train(rows: DataFrame, labels: DataFrame, per_class: int = 5000, **parameters) -> Gam:
    """The model learned from a bounded sample of the labelled rows of ``features``."""
    return fit(*training_rows(rows, labels, per_class), **parameters)


def score(rows: DataFrame, model: Gam) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``features``."""

    def run(batches):
        for batch in batches:
            x = np.column_stack([batch.column(k).to_numpy() for k in range(2, batch.num_columns)]) if batch.num_rows else np.zeros((0, len(FEATURES)))
            p = model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
