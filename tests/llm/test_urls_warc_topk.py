"""URL rules, WARC bundles and exact top-k against brute force on small and awkward tables."""

import hashlib
import json
import math
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trafficwatch.llm import norm_topk, queries, url_automaton, warc_bundles

SF = "/root/testdata/sf0.001"


def brute_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in url_automaton.RULES:
        h, p = rule.split("/", 1)
        if ("." + host).endswith("." + h) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best and best[1], best[0] if best else "allow"


def test_urls_equal_brute_force(spark):
    urls = [
        None, "", "://", "x", "http://net", "http://net/", "HTTP://A.NET/x", "http://example.net/en", "http://example.net/en/?q", "http://www.Example.net/en/a#b",
        "http://notnet/", "http://a.com/b.net/", "http://a.net.com/", "http://example.com/de/x", "http://myexample.com/de/x", "http://x.org/fr/", "http://x.org/frx", "http://é.net/en",
        "http://u@net:80/", "http://example.net?x=/en/", "a://b://c.net/", "http://a\nb.net/\n", "http://.net/", "http://" + "a." * 5000 + "net/" + "y" * 3000,
    ]
    rows = [(k, u, "other") for k, u in enumerate(urls)] + [(0, None, "again"), (None, "http://net/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = sorted(map(tuple, url_automaton.judge(df).collect()), key=str)
    assert got == sorted([(k, *brute_verdict(u)) for k, u, _ in rows], key=str)
    assert url_automaton.judge(df.filter("false")).collect() == []


def test_many_patterns_use_several_words():
    globs = [f"*.h{k}.net/a/**" for k in range(40)] + ["**x", "a*b", "*", "**"]
    automaton = url_automaton.ShiftAnd(globs)
    assert automaton.words > 4
    texts = [b"", b".h3.net/a/", b".q.h39.net/a/zz/x", b"ab", b"a/b", b"acb", b".h3.net/b"]
    regex = [re.compile(re.escape(g).replace(r"\*\*", "(?s:.*)").replace(r"\*", "[^/]*")) for g in globs]
    assert automaton.match(texts).tolist() == [[bool(r.fullmatch(t.decode())) for r in regex] for t in texts]


def brute_warc(rows):
    first = {}
    for page, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(first.get(data, page), page)
    out = []
    for page, html in rows:
        data = (html or "").encode()
        to = first.get(data) if len(data) >= 100 and first.get(data) != page else None
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    big = "é" * 60
    rows = [(5, big), (3, big), (9, big), (1, "x" * 99), (2, "x" * 99), (4, None), (6, ""), (7, "r\r\n\r\nWARC/1.1\r\n" * 20), (None, big), (None, "z" * 200), (3, big), (8, "long " * 400_000)]
    df = spark.createDataFrame([(p, f"http://a/{k}\r\nX: y" if k % 3 else None, h, "extra") for k, (p, h) in enumerate(rows)], "page_id long, url string, html string, payload_digest string")
    manifest = warc_bundles.write_archives(df, frame_bytes=500, bundle_bytes=2000)
    got = warc_bundles.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == brute_warc(rows)
    for m in manifest.collect():
        bundle = warc_bundles.Bundle(m["uri"])
        for name, frame, at, length in bundle.index:
            assert bundle.record(name).startswith(b"WARC/1.1\r\n")
            assert length <= bundle.table[frame][1]
    empty = warc_bundles.write_archives(df.filter("false"))
    assert warc_bundles.read_archives(empty).collect() == []


def test_warc_query(spark):
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    got = queries.op4_warc_bundles(spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == brute_warc([(p["page_id"], p["html"]) for p in pages])


def brute_top(rows, k=5):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [max(-(2**62), min(2**62, math.floor(256 * x))) for x in v]))
    out = set()
    for q, v in {(i, tuple(v)) for i, v in good if i % 50 == 0}:
        best = {}
        for i, w in good:
            if i != q and len(w) == len(v):
                s = max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w))))
                best[i] = max(best.get(i, s), s)
        for r, (s, i) in enumerate(sorted((-s, i) for i, s in best.items())[:k]):
            out.add((q, r + 1, i, -s))
    return sorted(out)


@pytest.mark.parametrize("seeds, bucket, block", [(0, 3, 2), (7, 16, 100)])
def test_top_k_equals_brute_force(spark, seeds, bucket, block):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * (1 + i % 7)).tolist()) for i in range(260)]
    rows += [(300, None), (350, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (400, [float("nan")] * 6), (401, [float("inf")] * 6), (450, []), (500, [0.0] * 6), (None, [1.0] * 6), (50, rows[50][1])]
    rows += [(600 + i, [3.0, 3.0, 0.0, 0.0, 0.0, 0.0]) for i in range(30)] + [(700, [1.0, 2.0]), (701, [2.0, 1.0]), (702, [1e18, 1e18])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = norm_topk.top_k(df, F.col("vec_id") % 50 == 0, seed_rows=seeds, bucket_rows=bucket, block_rows=block)
    assert sorted(map(tuple, got.collect())) == brute_top(rows)


def test_top_k_jobs_do_not_grow_with_queries(spark):
    """Few blocks of queries and files of candidates, or many: as many jobs, and the same rows."""
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(400)], "vec_id long, embedding array<float>")
    jobs, rows = [], []
    for name, block, file in (("few", 50, 200), ("many", 12, 50)):
        spark.sparkContext.setJobGroup(f"top-k-{name}", name)
        rows.append(sorted(map(tuple, norm_topk.top_k(df, F.col("vec_id") % 4 == 0, block_rows=block, file_rows=file).collect())))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"top-k-{name}")))
    spark.sparkContext._jsc.clearJobGroup()
    assert jobs[0] == jobs[1]
    assert rows[0] == rows[1] and len(rows[0]) == 500


def test_top_k_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert norm_topk.top_k(df, F.col("vec_id") % 50 == 0).collect() == []


def test_top_k_query(spark):
    rows = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    got = queries.op6_norm_topk(spark, SF)
    assert json.loads(json.dumps(got.columns)) == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_top([(r["vec_id"], r["embedding"]) for r in rows])


def test_url_query(spark):
    rows = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    got = queries.op8_url_automaton(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted((r["page_id"], *brute_verdict(r["url"])) for r in rows)


def test_automaton_with_many_rules_and_touching_wildcards():
    """Bits over many words, and wildcards that touch, against a regular expression."""
    import re

    rng = np.random.default_rng(3)
    globs = ["".join(rng.choice(list("ab/") + ["*", "**"], size=rng.integers(1, 9))) for _ in range(150)]

    def as_regex(glob):
        return "".join({"**": ".*", "*": "[^/]*"}.get(p, re.escape(p)) for p in re.findall(r"\*\*|\*|.", glob))

    texts = ["".join(rng.choice(list("ab/"), size=rng.integers(0, 12))) for _ in range(200)]
    found = url_automaton.ShiftAnd(globs).match([t.encode() for t in texts])
    for t, row in zip(texts, found):
        assert row.tolist() == [re.fullmatch(as_regex(g), t, re.S) is not None for g in globs]
