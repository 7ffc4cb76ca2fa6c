"""Hard negatives: the curve, the zone maps and whole results against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficwatch.llm import hilbert_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (5, 2)])
def test_curve_visits_neighbours(dims, bits):
    cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
    keys = hn.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


def brute(rows, anchor_every=10, low=80, high=100):
    best = {}
    for i, label, x in rows:
        if i is None or label is None or x is None or any(v is None or not np.isfinite(v) for v in x) or not x:
            continue
        w = tuple(int(v) for v in np.floor(256 * np.array(x, np.float32).astype(np.float64)))
        key = (label, np.array(w, "<i8").tobytes())
        if i not in best or key < best[i][0]:
            best[i] = (key, label, w)
    rows = [(i, label, w) for i, (_, label, w) in best.items()]
    out = []
    for a, la, wa in rows:
        if a % anchor_every:
            continue
        scores = [(-sum(p * q for p, q in zip(wa, w)), i, label) for i, label, w in rows if i != a and len(w) == len(wa)]
        for ps, p, _ in sorted(s for s in scores if s[2] == la)[:5]:
            fit = sorted((s, i) for s, i, label in scores if label != la and low * -ps <= 100 * -s <= high * -ps)
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(fit[:5])]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hn.mine(df, F.col("vec_id") % 10 == 0, **kw).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def some_rows(n, dim, labels=3, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, dim))
    return [(i, int(rng.integers(labels)), [float(v) for v in (centre[i % 4] + 0.3 * rng.normal(size=dim)).astype(np.float32)]) for i in range(n)]


@pytest.mark.parametrize("kw", [{}, {"block_rows": 7, "file_rows": 40, "anchor_rows": 6}, {"low_percent": 50, "high_percent": 120}])
def test_equal_to_brute_force(spark, kw):
    rows = some_rows(260, 6)
    got = mined(spark, rows, **kw)
    assert got and got == brute(rows, low=kw.get("low_percent", 80), high=kw.get("high_percent", 100))


def test_awkward_rows(spark):
    rows = some_rows(90, 4) + [(i, 1, [0.5, 0.5, 0.5, 0.5]) for i in range(100, 160)]  # a third of the rows are one vector
    rows += [(200, None, [1.0] * 4), (201, 1, None), (202, 1, [1.0, None, 1.0, 1.0]), (203, 1, [float("nan")] * 4), (204, 2, [float("inf"), 0.0, 0.0, 0.0]), (None, 1, [1.0] * 4)]
    rows += [(210, 1, [1.0, 2.0]), (211, 1, [1.0, 1.5]), (212, 2, [1.0, 1.4]), (213, 1, []), (220, 0, [0.0] * 4), (221, 0, [1.0] * 4)]
    rows += [(30, 0, [0.1, 0.2, 0.3, 0.4]), (30, 0, [0.1, 0.2, 0.3, 0.4]), (41, 2, [3.0] * 4), (41, 0, [2.0] * 4)]
    assert mined(spark, rows, block_rows=8, file_rows=32) == brute(rows)


def test_empty_tables_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 1, [2.0])]) == []
    assert mined(spark, [(10, 1, [1.0])]) == []


def test_zone_maps_prune(spark, tmp_path):
    """Separate clusters: blocks of other clusters are not read."""
    rng = np.random.default_rng(5)
    rows = []
    for c in range(8):
        x = np.zeros((64, 8))
        x[:, c] = 4
        rows += [(c * 64 + i, i % 2, [float(v) for v in x[i] + 0.05 * rng.normal(size=8)]) for i in range(64)]
    stored = hn.integer_rows(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, 256)
    files = hn.write_blocks(hn.on_curve(stored, hn.curve_axes(stored)).coalesce(1), str(tmp_path), 16, 10_000).collect()
    read = total = 0
    for f in files:
        blocks = hn.Blocks(f["uri"], 8)
        for a in f["anchors"]:
            own = np.frombuffer(a["components"], "<i8")[None, :]
            least, most = blocks.bounds(own)
            scores = [own @ blocks.read(b)[2].T for b in range(len(blocks.low))]
            assert all((least[0, b] <= s).all() and (s <= most[0, b]).all() for b, s in enumerate(scores))
            floor = sorted(np.concatenate(scores, 1)[0])[-6]
            read += int((most[0] >= floor).sum())
            total += len(blocks.low)
    assert read < total / 2
