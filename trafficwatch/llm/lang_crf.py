"""Language of words and documents by a linear-chain conditional random field.

Words (runs of letters) carry hashed affix, n-gram and whole-word (lexicon)
features; label transitions are learned with them.  Training maximises the
chain likelihood by forward-backward gradients on a bounded sample of labelled
documents, half of its chains spliced from two languages so that switches are
learned.  Prediction labels every word of every text: forward-backward gives
each word's label probabilities, and a document gets the language with the
largest share of its words, that share being its score.

Every label that occurs on a row that may be learned from is learned.  Bounds
(parameters): ``per_language`` training documents of each label, of longer
texts the first ``longest_chars`` characters from the first letter on; chains
of ``chain`` words.  With more than ``many`` labels each has fewer documents
(20 at least).  Features have the same 18 bits for any number of labels; weights
are held for those that training saw, and updated some labels at a time.

Defined results: null text, or one without letters, is ``und`` with score 0;
documents without a label, or with a null id, are never learned from; without
any labelled row every text is ``und``; each row is judged by its own text, so
repeated rows agree; a very long text is read in pieces of whole chains; ties go to the label that sorts first; an empty table
gives no rows; other columns are ignored, and kept by ``keep_known``, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficwatch.llm import shared
from trafficwatch.llm.shared import CHUNK_BYTES
from trafficwatch.llm.words import byte_set, mix, ranges, span_keys, spans
from trafficwatch.session import materialize

#: Bytes of words: ASCII letters and all of non-ASCII characters.
_WORD = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
UNKNOWN = "und"
#: Chain cells (chain, step, label) that one pass holds.
_CELLS = 1 << 20
#: Labels whose weights are updated at a time.
_SOME_LABELS = 16
#: Labels whose counts may be broadcast (some 100 bytes each).
_FEW_LABELS = 100_000


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and two-byte Latin-1 letters in lower case."""
    low = _LOWER[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    low[second] += 0x20
    return low


def word_features(words: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashed feature ids, features per word): word, affixes of 1-3 bytes, 2- and 3-grams with edges."""
    flat = np.frombuffer(b"".join(b"\x01" + w + b"\x02" for w in words) + b"\0\0\0", np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    shift = np.uint64(64 - bits)
    pair = flat[:-1] | flat[1:] << np.uint64(8)
    triple = pair[:-1] | flat[2:] << np.uint64(16)
    quad = triple[:-1] | flat[3:] << np.uint64(24)
    one = starts[sizes == 3]  # a word of one byte ends there
    quad[one] = triple[one]
    last = starts + sizes
    parts = [span_keys(flat.astype(np.uint8), starts, sizes)[:, None], (pair[starts] + np.uint64(1 << 40))[:, None]]
    # affixes of two and three letters, with the word's edge; a shorter word uses what it has
    parts += [(triple[starts] + np.uint64(2 << 40))[:, None], (quad[starts] + np.uint64(3 << 40))[:, None]]
    parts += [(pair[last - 2] + np.uint64(4 << 40))[:, None], (triple[last - 3] + np.uint64(5 << 40))[:, None]]
    parts += [(quad[np.maximum(starts, last - 4)] + np.uint64(6 << 40))[:, None]]
    fixed = np.concatenate(parts, 1)
    two, three = sizes - 1, sizes - 2
    n = fixed.shape[1] + two + three
    out = np.empty(int(n.sum()), np.uint64)
    begin = np.cumsum(n) - n
    for k in range(fixed.shape[1]):
        out[begin + k] = fixed[:, k]
    out[ranges(begin + fixed.shape[1], two)] = pair[ranges(starts, two)] + np.uint64(7 << 40)
    out[ranges(begin + fixed.shape[1] + two, three)] = triple[ranges(starts, three)] + np.uint64(8 << 40)
    return (mix(out) >> shift).astype(np.int64), n


def forward_backward(emission: np.ndarray, alive: np.ndarray, transition: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label probabilities (chain, step, label), expected transitions, and log of the normaliser.

    ``alive`` marks the words of each chain, a prefix of its steps.
    """
    chains, steps, labels = emission.shape
    top = emission.max(2, keepdims=True)
    local = np.exp(emission - top)
    move = np.exp(transition)
    alpha, beta, scale = np.empty_like(local), np.empty_like(local), np.ones((chains, steps))
    for t in range(steps):
        now = (np.exp(start) if t == 0 else alpha[:, t - 1] @ move) * local[:, t]
        total = now.sum(1)
        dead = ~alive[:, t]
        total[dead] = 1
        alpha[:, t] = now / total[:, None]
        if t:
            alpha[dead, t] = alpha[dead, t - 1]
        scale[:, t] = total
    beta[:, -1] = 1
    for t in range(steps - 2, -1, -1):
        ahead = (local[:, t + 1] * beta[:, t + 1]) @ move.T / scale[:, t + 1][:, None]
        ahead[~alive[:, t + 1]] = 1
        beta[:, t] = ahead
    gamma = alpha * beta
    gamma /= gamma.sum(2, keepdims=True)
    into = local[:, 1:] * beta[:, 1:] / scale[:, 1:, None] * alive[:, 1:, None]
    both = move * (alpha[:, :-1].reshape(-1, labels).T @ into.reshape(-1, labels))
    log_z = ((np.log(scale) + top[:, :, 0]) * alive).sum(1)
    return gamma, both, log_z


def _runs(offsets: np.ndarray):
    """(first, last) of texts next to one another, a long text alone."""
    first = 0
    for k in [*np.flatnonzero(np.diff(offsets) > CHUNK_BYTES).tolist(), len(offsets) - 1]:
        if k > first:
            yield first, k
        if k < len(offsets) - 1:
            yield k, k + 1
        first = k + 1


class Crf:
    """Weights of the field; ``predict`` labels texts.

    ``seen`` are the feature ids that have weights, in order; the last row of
    ``weights`` is that of all others, and zero.
    """

    def __init__(self, labels: list[str], bits: int, seen: np.ndarray, weights: np.ndarray, transition: np.ndarray, start: np.ndarray, chain: int):
        self.labels, self.bits, self.weights, self.transition, self.start, self.chain = labels, bits, weights, transition, start, chain
        self.row = np.full(1 << bits, len(seen), np.int32)
        self.row[seen] = np.arange(len(seen))
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.table = np.zeros((0, len(self.labels)), np.float32)

    def __getstate__(self):
        state = dict(self.__dict__)
        for name in ("known", "slot", "table"):
            state.pop(name)
        return state

    def __setstate__(self, state):
        self.__dict__ |= state
        self._forget()

    def emissions(self, words: list[bytes]) -> np.ndarray:
        ids, n = word_features(words, self.bits)
        return np.add.reduceat(self.weights[self.row[ids]], np.cumsum(n) - n, axis=0) if len(words) else np.zeros((0, len(self.labels)), np.float32)

    def _lookup(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 200_000) -> np.ndarray:
        """Emission row of each word; distinct words are scored once per worker."""
        most = min(most, 16 * most // max(1, len(self.labels)))
        keys, first, where = np.unique(span_keys(low, starts, ends - starts), return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > most:
            self._forget()
        place = np.searchsorted(self.known, keys)
        hit = place < len(self.known)
        hit[hit] = self.known[place[hit]] == keys[hit]
        if not hit.all():
            raw, rows = low.tobytes(), first[~hit]
            words = [raw[a:b] for a, b in zip(starts[rows].tolist(), ends[rows].tolist())]
            some = max(1, min(20_000, 16 * 20_000 // max(1, len(self.labels))))
            score = [self.emissions(words[k : k + some]) for k in range(0, len(words), some)]
            at = len(self.known)
            self.known = np.insert(self.known, place[~hit], keys[~hit])
            self.slot = np.insert(self.slot, place[~hit], np.arange(at, at + len(words)))
            self.table = np.concatenate([self.table, *score]).astype(np.float32)
            place = np.searchsorted(self.known, keys)
        return self.table[self.slot[place][where]]

    def word_labels(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(label probabilities of each word, words per text) of concatenated UTF-8 texts."""
        low = lowered(data) if len(data) else data
        starts, ends = spans(_WORD[low], offsets) if len(data) else (np.zeros(0, np.int64),) * 2
        counts = np.diff(np.searchsorted(starts, offsets))
        if not len(starts) or not self.labels:
            return np.zeros((len(starts), len(self.labels))), counts
        score = self._lookup(low, starts, ends)
        n = -(-counts // self.chain)
        text = np.repeat(np.arange(len(counts)), n)
        part = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        size = np.minimum(self.chain, counts[text] - part * self.chain)
        first = np.cumsum(size) - size
        alive = np.arange(self.chain)[None, :] < size[:, None]
        out = np.empty(score.shape, np.float64)
        some = max(1, min(2048, _CELLS // (self.chain * len(self.labels))))
        for k in range(0, len(size), some):
            rows = slice(k, k + some)
            begin, stop = int(first[rows][0]), int(first[rows][-1] + size[rows][-1])
            block = np.zeros((len(size[rows]), self.chain, len(self.labels)))
            block[alive[rows]] = score[begin:stop]
            gamma, _, _ = forward_backward(block, alive[rows], self.transition, self.start)
            out[begin:stop] = gamma[alive[rows]]
        return out, counts

    def _pieces(self, data: np.ndarray, most: int = CHUNK_BYTES):
        """``word_labels`` of one long text, in pieces of whole chains."""
        at, size = 0, most
        while at < len(data):
            to = min(at + size, len(data))
            if to < len(data):
                starts, ends = spans(_WORD[data[at:to]], np.array([0, to - at]))
                whole = np.count_nonzero(ends < to - at) // self.chain * self.chain
                if not whole:  # few long words: look further
                    if not len(starts):
                        at, size = to, most
                    else:
                        size *= 2
                    continue
                to = at + int(ends[whole - 1])
            yield self.word_labels(data[at:to], np.array([0, to - at]))
            at, size = to, most

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(language, share of the words) of each text; texts without words are unknown."""
        counts = np.zeros(len(offsets) - 1, np.int64)
        share = np.zeros((len(counts), max(1, len(self.labels))))
        for first, last in _runs(offsets):
            if last - first == 1 and offsets[last] - offsets[first] > CHUNK_BYTES:
                pieces = self._pieces(data[offsets[first] : offsets[last]])
            else:
                pieces = [self.word_labels(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])]
            for gamma, n in pieces:
                full = np.flatnonzero(n)
                if len(full) and len(self.labels):
                    share[first + full] += np.add.reduceat(gamma, (np.cumsum(n) - n)[full], axis=0)
                counts[first:last] += n
        share /= np.maximum(1, counts)[:, None]
        best = share.argmax(1)
        names = [self.labels[b] if c and self.labels else UNKNOWN for b, c in zip(best, counts)]
        return names, np.where(counts > 0, share.max(1), 0.0).clip(0, 1)


def _adam(x: np.ndarray, slope: np.ndarray, m: np.ndarray, v: np.ndarray, rate: float, step: int) -> None:
    """One step of Adam on ``x`` and its moments, in place."""
    m += 0.1 * (slope - m)
    v += 0.001 * (slope * slope - v)
    x -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(x.dtype)


def fit(rows: list[tuple[str, str]], bits: int = 18, chain: int = 64, rounds: int = 40, rate: float = 0.3, decay: float = 1e-6, seed: int = 3) -> Crf:
    """Train on (text, language) rows by Adam on the regularised chain likelihood."""
    labels = sorted({lang for _, lang in rows})
    rng = np.random.default_rng(seed)
    vocabulary: dict[bytes, int] = {}
    chains: list[np.ndarray] = []
    golds: list[np.ndarray] = []
    half = chain // 2
    pieces: list[tuple[np.ndarray, int]] = []
    for text, lang in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        low = lowered(data) if len(data) else data
        starts, ends = spans(_WORD[low], np.array([0, len(low)])) if len(low) else (np.zeros(0, int),) * 2
        raw = low.tobytes()
        own = np.array([vocabulary.setdefault(raw[a:b], len(vocabulary)) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)
        pieces += [(own[k : k + half], labels.index(lang)) for k in range(0, len(own), half)]
    order = rng.permutation(len(pieces))
    for k in range(0, len(order) - 1, 2):  # two random pieces, mostly of different languages
        (a, x), (b, y) = pieces[order[k]], pieces[order[k + 1]]
        chains.append(np.concatenate([a, b]))
        golds.append(np.concatenate([np.full(len(a), x), np.full(len(b), y)]))
    chains += [p for p, _ in pieces]
    golds += [np.full(len(p), y) for p, y in pieces]
    n_labels = len(labels)
    hashed, n = word_features(list(vocabulary), bits) if vocabulary else (np.zeros(0, np.int64),) * 2
    seen_ids, ids = np.unique(hashed, return_inverse=True)
    weights = np.zeros((len(seen_ids) + 1, n_labels), np.float32)
    transition, start = np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    if not chains or n_labels < 2:
        return Crf(labels, bits, seen_ids, weights, transition, start, chain)
    begin = np.cumsum(n) - n
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, transition, start)]
    batch = max(1, len(chains) // 4)
    most = max(1, _CELLS // (chain * n_labels))
    some = max(1, min(len(vocabulary), _CELLS // (16 * n_labels)))
    parts = [(k, int(begin[k + some]) if k + some < len(begin) else len(ids)) for k in range(0, len(begin), some)]
    step = 0
    for _ in range(rounds):
        chosen = rng.choice(len(chains), batch, replace=False)
        table = np.concatenate([np.add.reduceat(weights[ids[begin[k] : stop]], begin[k : k + some] - begin[k], axis=0) for k, stop in parts])
        by_word = np.zeros((len(vocabulary), n_labels))
        both, seen = np.zeros_like(transition), np.zeros_like(transition)
        begun, words = np.zeros(n_labels), 0
        for at in range(0, batch, most):
            rows_ = chosen[at : at + most]
            size = np.array([len(chains[k]) for k in rows_])
            alive = np.arange(chain)[None, :] < size[:, None]
            word = np.concatenate([chains[k] for k in rows_])
            gold = np.concatenate([golds[k] for k in rows_])
            emission = np.zeros((len(rows_), chain, n_labels))
            emission[alive] = table[word]
            gamma, moved, _ = forward_backward(emission, alive, transition, start)
            error = gamma[alive]
            error[np.arange(len(gold)), gold] -= 1
            for y in range(n_labels):
                by_word[:, y] += np.bincount(word, error[:, y], len(vocabulary))
            follows = np.ones(len(gold), bool)
            follows[np.cumsum(size) - size] = False
            np.add.at(seen, (gold[:-1][follows[1:]], gold[1:][follows[1:]]), 1)
            first = np.cumsum(size) - size
            begun += gamma[:, 0].sum(0) - np.bincount(gold[first], minlength=n_labels)
            both += moved
            words += len(gold)
        step += 1
        for y in range(0, n_labels, _SOME_LABELS):
            cols = slice(y, y + _SOME_LABELS)
            slope = np.column_stack([np.bincount(ids, np.repeat(e, n), len(weights)) for e in by_word[:, cols].T]) / words
            _adam(weights[:, cols], slope + decay * weights[:, cols], *(m[:, cols] for m in moments[0]), rate, step)
        _adam(transition, (both - seen) / words + decay * transition, *moments[1], rate, step)
        _adam(start, begun / words, *moments[2], rate, step)
    return Crf(labels, bits, seen_ids, weights, transition, start, chain)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id's text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, per_language: int, longest_chars: int, many: int = 16) -> list[tuple[str, str]]:
    """At most ``per_language`` labelled documents of each language, the same ones on every run."""
    lang = F.col("lang")
    usable = docs.filter(lang.isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = materialize(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    labels = counts.count()
    most = per_language if labels <= many else min(per_language, max(20, per_language * many // labels))
    share = counts.select("lang", F.least(F.lit(1.0), F.lit(3.0 * most) / F.col("n")).alias("_share"))
    share = F.broadcast(share) if labels <= _FEW_LABELS else share
    draw = F.pmod(F.xxhash64("doc_id", F.lit("training")), F.lit(1 << 30)) / float(1 << 30)
    # a longer text gives the piece that starts at its first letter
    piece = F.when(F.char_length("text") <= longest_chars, F.col("text")).otherwise(F.substring(F.regexp_replace("text", r"^\P{L}+", ""), 1, longest_chars))
    drawn = usable.select("lang", "text", draw.alias("_draw"), "doc_id").join(share, "lang").filter("_draw < _share")
    drawn = drawn.withColumn("text", piece)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_draw", "doc_id", "text"))
    rows = drawn.withColumn("_rank", rank).filter(F.col("_rank") <= most).select("text", "lang").orderBy("lang", "text").toLocalIterator()
    return [(r[0], r[1]) for r in rows]


def train(docs: DataFrame, per_language: int = 150, longest_chars: int = 20_000) -> Crf:
    """The model learned from a bounded sample of the labelled rows of ``docs`` (doc_id, text, lang)."""
    model = fit(training_sample(docs, per_language, longest_chars))
    shared.release()
    return model


def _judged(model: Crf, column) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text of an Arrow column."""
    shared.keep_cache("languages", model._forget)
    data, offsets = shared.utf8_buffers(column)
    names, score = model.predict(data, offsets)
    for k in range(len(names)):
        # non-ASCII bytes alone may be signs: ask for a letter
        raw = data[offsets[k] : offsets[k + 1]]
        if names[k] != UNKNOWN and not (_WORD[raw] & (raw < 0x80)).any() and not any(c.isalpha() for c in raw.tobytes().decode()):
            names[k], score[k] = UNKNOWN, 0.0
    return names, score


def label_documents(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; ``text`` alone decides."""
    spark = docs.sparkSession
    shared.with_python(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in shared.by_bytes(batches, 2):
            names, score = _judged(sent.value, batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Crf, least_score: float) -> DataFrame:
    """The rows of ``docs``, whole, whose language is known with at least that score."""
    spark = docs.sparkSession
    shared.with_python(spark)
    sent = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in shared.by_bytes(batches, at):
            names, score = _judged(sent.value, batch.column(at))
            yield batch.filter(pa.array([n != UNKNOWN and s >= least_score for n, s in zip(names, score)], pa.bool_()))

    # under numbers: mapInArrow can't take names with a dot
    rows = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
