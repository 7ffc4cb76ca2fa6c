"""Whole-text encoding, packing and the wavelet store against plain library calls."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from trafficwatch.llm import packing, queries, shared, tokens, wavelet_store

SF = "/root/testdata/sf0.001"
AWKWARD = [
    "a<|endoftext|>b", "<|ENDOFTEXT|> <|endoftext|>,", "é ́a", " a b", "a\x1cb", "Σας ΑΣ", "İx İx i̇", "don't we'll DON'T", "\x85q", "a　b", "​", "  ", "a ̈b",
    "A\r\n\tB\x0bC\x0cD", "a.,b a'. a.' a,... ß,É. ×a. ÷", "漢字 のテスト。", "1,5 a1, 3.", "É́a É.́", "ªb º µm", "≮ ≠a", "", "x", "ÀÖØöøÿ", "a\x00b\x7f", "!" * 3000, "Wort" * 9000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library(library):
    texts = AWKWARD + pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()
    for limit in (2_000_000, 50):  # the second starts afresh again and again
        own = tokens.WordEncoder(tokens.default_path(), max_words=limit)
        for k in range(0, len(texts), 9):
            part = [*texts[k : k + 9], None]
            ids, counts = own.encode(*shared.utf8_buffers(pa.array(part)))
            expected = [ids_of(library, t) for t in part]
            assert ids.tolist() == sum(expected, []) and counts.tolist() == [len(x) for x in expected]


def rows_of(spark):
    texts = [None, "", *AWKWARD, "dup text", "dup text", "many words here " * 3000]
    rows = [(k, t, "en", k) for k, t in enumerate(texts)] + [(3, "another with id 3", None, 0), (None, "no id", None, 0), (3, "another with id 3", None, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, start int"), [(r[0], r[1]) for r in rows]


def brute_store(library, rows):
    out = []
    for i, t in rows:
        raw = np.array([*ids_of(library, t), 2], "<u4").tobytes()
        out.append((i, len(raw) // 4, zlib.crc32(raw)))
    return out


def test_store_round_trip(spark, library):
    df, rows = rows_of(spark)
    manifest = wavelet_store.write_tokens(df, shard_tokens=3000)
    got = wavelet_store.read_tokens(manifest).orderBy("start").collect()
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=str) == sorted(brute_store(library, rows), key=str)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda x: (x is not None, x))
    assert wavelet_store.read_tokens(wavelet_store.write_tokens(df.filter("false"))).collect() == []


def test_shard_access_count_find(tmp_path):
    rng = np.random.default_rng(5)
    for n, top in ((1, 1), (9000, 3), (20_000, 49_000), (4096, 2)):
        ids = np.minimum(rng.zipf(1.3, n), top - 1).astype(np.uint32)
        lengths = np.diff(np.unique([0, n, *rng.integers(0, n, 20)]))
        uri, _ = shared.write_file(str(tmp_path), "s", wavelet_store.shard_parts(ids, list(range(len(lengths))), lengths))
        shard = wavelet_store.TokenShard(uri)
        assert shard.ids().tolist() == ids.tolist()
        for at in random.Random(1).sample(range(n), min(n, 50)):
            assert shard.access(at) == ids[at]
            token = int(ids[at])
            assert shard.count(token) == (ids == token).sum()
            assert shard.matrix.rank(token, at) == (ids[:at] == token).sum()
        rare = int(ids[-1])
        where = np.flatnonzero(ids == rare)[:200]
        found = shard.find(rare)[:200]
        assert [int(shard.starts[d]) + p for d, p in found] == where.tolist()
        assert shard.count(60_000) == 0


def check_pieces(pieces, documents, capacity):
    """documents: {doc_id: ids}; ids unique."""
    by, seqs = {}, {}
    for r in pieces:
        by.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by) == set(documents)
    for i, ids in documents.items():
        at = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            cut = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(cut))
            at += r["length"]
        assert at == len(ids)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(len(x) for x in documents.values()) / capacity / len(seqs)


def test_packing_query(spark, library):
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    got = [r.asDict() for r in queries.op2_packing(spark, SF).collect()]
    assert check_pieces(got, {r["doc_id"]: [*ids_of(library, r["text"]), 1] for r in rows}, 2048) > 0.97


def test_store_query(spark, library):
    rows = sorted((r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist())
    got = queries.op9_wavelet_tokens(spark, SF).orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == brute_store(library, rows)
    assert got[0].start == 0 and all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))


def test_packing_awkward_rows(spark, library):
    df, rows = rows_of(spark)
    pieces = packing.pack(df, capacity=64, group_rows=5).collect()
    assert sum(r.length for r in pieces) == sum(len(ids_of(library, t)) + 1 for _, t in rows)
    assert len({r.sequence_id for r in pieces}) == len({(r.sequence_id, r.offset) for r in pieces if r.offset == 0})
    fill = {}
    for r in pieces:
        assert len(r.ids) == 4 * r.length
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 64
    assert packing.pack(df.filter("false")).collect() == []


def test_first_fit_decreasing_equals_scan():
    rng = random.Random(2)
    for n in (1, 2, 37, 300):
        lengths = np.array([rng.randint(1, 50) for _ in range(n)])
        room, expected = [], {}
        for k in sorted(range(n), key=lambda k: (-lengths[k], k)):
            b = next((b for b, r in enumerate(room) if r >= lengths[k]), len(room))
            if b == len(room):
                room.append(50)
            expected[k] = (b, 50 - room[b])
            room[b] -= lengths[k]
        bins, offsets = packing.first_fit_decreasing(lengths, 50)
        assert [(int(b), int(o)) for b, o in zip(bins, offsets)] == [expected[k] for k in range(n)]
