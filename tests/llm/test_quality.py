"""Quality model: features against plain Python, tables against plain sums, held-out accuracy, awkward rows."""

import re
import zlib

import numpy as np
import pytest

from trafficwatch.llm import quality_gam as gam
from trafficwatch.llm import queries, shared

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"


def arrow(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])


def plain(text):
    """The features by name, from a text alone; ASCII and Latin-1 texts."""
    words = re.findall(r"[^ \t\n\x0b\x0c\r]+", text)
    lines = [ws for ws in (re.findall(r"[^ \t\x0b\x0c\r]+", line) for line in text.split("\n")) if ws]
    low = lambda w: "".join(c.lower() if c.isascii() else c for c in w)
    letter = lambda c: ("a" <= c <= "z") or ("A" <= c <= "Z") or 0xC0 <= ord(c) <= 0xFF
    upper = lambda c: ("A" <= c <= "Z") or (0xC0 <= ord(c) <= 0xDE and ord(c) != 0xD7)
    odd = lambda c: c.isascii() and 0x20 < ord(c) < 0x7F and not c.isalnum() and c not in ",.:;'-"
    big = lambda w: sum(map(letter, w)) >= 2 and all(upper(c) for c in w if letter(c))
    n, size, letters = len(words), sum(len(w.encode()) for w in words), sum(letter(c) for w in words for c in w)
    share = lambda part, whole: part / whole if whole else 0.0
    keys = [low(w) for w in words]
    again = [k > 0 and keys[k] == keys[k - 1] for k in range(n)]
    mostly = lambda flags: share(sum(2 * sum(f) >= len(f) for f in flags), len(lines))
    marks, at = [], 0
    for ws in lines:
        marks.append(again[at : at + len(ws)])
        at += len(ws)
    seen = [tuple(map(low, ws)) for ws in lines]
    return {
        "log_words": np.log1p(n), "mean_word": share(size, n), "longest_word": np.log1p(max((len(w.encode()) for w in words), default=0)),
        "short_words": share(sum(len(w.encode()) <= 2 for w in words), n), "upper_letters": share(sum(upper(c) for w in words for c in w), letters), "upper_words": share(sum(map(big, words)), n),
        "odd_symbols": share(sum(odd(c) for w in words for c in w), size), "odd_words": share(sum(any(map(odd, w)) for w in words), n),
        "bare_symbols": share(sum(any(map(odd, w)) and not any(map(letter, w)) for w in words), n), "digits": share(sum(c in "0123456789" for w in words for c in w), size),
        "beyond_ascii": share(sum(ord(c) > 127 for w in words for c in w), size), "stops": share(sum(w[-1] in ".!?" for w in words), n), "distinct_words": share(len(set(keys)), n),
        "repeated_next": share(sum(again), n), "repeated_pairs": 1 - share(len(set(zip(keys, keys[1:]))) + 1, max(n, 1)), "log_lines": np.log1p(len(lines)), "words_a_line": share(n, len(lines)),
        "repeated_lines": share(len(seen) - len(set(seen)), len(lines)), "upper_lines": mostly([[big(w) for w in ws] for ws in lines]), "odd_lines": mostly([[any(map(odd, w)) for w in ws] for ws in lines]),
        "repeating_lines": mostly(marks), "capitals": share(sum(upper(w[0]) for w in words), n), "line_ends": share(sum(ws[-1][-1] in ".!?" for ws in lines), len(lines)), "distinct_bytes": len(set(text.encode())),
    }


TEXTS = ["", " \n\t", "a", "One two. TWO two!", "ÄÖ SCH!! geä ber\nÄÖ SCH!! geä ber\n\nx | y | z\n", "a a a b 12 a1 ***\r\n### $$$ --", "é" * 50 + " ×÷ Ñ ñ", "ends\n\n\n", "\nstarts", "w " * 4000 + "\n" + "Q!! " * 3000]


def test_features_equal_plain_python():
    got = gam.text_features(*arrow(TEXTS))
    for text, row in zip(TEXTS, got):
        for name, a in zip(gam.FEATURES, row):
            assert a == pytest.approx(plain(text)[name], abs=1e-9), (name, text[:40])


def test_pieces_change_nothing(monkeypatch):
    data, offsets = arrow(TEXTS * 2)
    whole = gam.text_features(data, offsets)
    for size in (1, 7, 64, 4096):
        monkeypatch.setattr(shared, "CHUNK_BYTES", size)
        assert np.array_equal(gam.text_features(data, offsets), whole)


def test_tables_add_up_and_learn_a_pair():
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(size=3000), rng.normal(size=3000), np.zeros(3000)])
    y = ((x[:, 0] > 0) != (x[:, 1] > 0)).astype(float)  # no single feature says anything
    model = gam.fit(x[:2000], y[:2000])
    p = model.score(x[2000:])
    assert ((p >= 0.5) == y[2000:]).mean() > 0.95
    assert ((gam.fit(x[:2000], y[:2000], most_pairs=0).score(x[2000:]) >= 0.5) == y[2000:]).mean() < 0.7
    for row, got in zip(x[2000:2050], p):
        total = model.intercept
        at = [sum(v >= e for e in edges) for v, edges in zip(row, model.edges)]
        total += sum(t[a] for t, a in zip(model.tables, at)) + sum(g[at[a], at[b]] for a, b, g in model.pairs)
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def test_leaves_take_the_best_cut():
    rng = np.random.default_rng(4)
    for _ in range(20):
        g, h, c = rng.normal(size=9), rng.uniform(0.1, 1, 9), rng.integers(0, 6, 9)
        got = gam._leaves(g, h, c, 1, 3, 1.0)
        score = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 1.0)
        options = [(score(0, k) + score(k, 9), k) for k in range(1, 9) if c[:k].sum() >= 3 and c[k:].sum() >= 3]
        value = lambda a, b: g[a:b].sum() / (h[a:b].sum() + 1.0)
        want = [value(0, 9)] * 9
        if options and max(options)[0] > score(0, 9):
            k = max(options)[1]
            want = [value(0, k)] * k + [value(k, 9)] * (9 - k)
        assert got == pytest.approx(np.array(want))


def test_held_out_accuracy_on_the_table(spark):
    rows = queries.op11_quality_gam(spark, SF).collect()
    labels = {r[0]: r[1] for r in queries.table(spark, SF, "labels").select("doc_id", "quality").collect()}
    assert len(rows) == queries.table(spark, SF, "documents").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(judged) > 50 and np.mean([a == b for a, b in judged]) >= 0.97


def learned(spark, docs, labels):
    rows = gam.features(docs)
    return gam.score(rows, gam.train(rows, labels))


def test_awkward_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (7, None, 0), (8, 7, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    assert learned(spark, spark.createDataFrame([], DOCS), labels).collect() == []
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, None), (7, ""), (8, "x" * 300_000)], DOCS).selectExpr("*", "1 as f0", "2 as score", "'a' as label", "3 as held_out")
    assert {r["score"] for r in learned(spark, docs, none).collect()} == {0.5}
    got = learned(spark, docs, labels).collect()
    assert len(got) == 5 and {round(r["score"], 9) for r in got} == {0.25}  # two rows of label 0, one added to each label
    assert {r["predicted"] for r in got} == {0}


def test_sample_is_bounded_and_repeatable(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * (i % 7 + 1)) for i in range(900)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(900)], "doc_id long, quality int, toxic int")
    rows = gam.features(docs)
    x, y = gam.training_rows(rows, labels, 40)
    again, _ = gam.training_rows(rows.repartition(5), labels, 40)
    assert len(y) == 80 and y.sum() == 40 and np.array_equal(x, again)
