"""Phrase index, MinHash join, line windows, language field and pipeline against brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import brute
import corpus_pipeline
from trafficwatch.llm import components, lang_crf, line_windows, minhash_join, phrase_index, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def benchmark():
    return [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]


def key(row):
    return tuple((x is not None, x) for x in row)


def test_phrase_query(spark, documents, benchmark):
    found = brute.windows(benchmark)
    got = queries.op3_phrase_index(spark, SF).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got)) == sorted((d["doc_id"], *brute.contamination(d["text"], found)) for d in documents)


@pytest.mark.parametrize("shard, block", [(1 << 20, 1 << 20), (40, 30)])
def test_phrases_on_awkward_rows(spark, shard, block):
    rng = random.Random(6)
    words = ["a", "b", "Éa", "c", "9x", "漢"]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 9])))) for k in range(8)]
    items += [(8, None), (9, ""), (10, "..."), (3, "b b c a"), (11, "zz not there")]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 60])))) for k in range(25)]
    docs += [(100, None), (101, ""), (3, "a-b,c\nA b"), (3, "a-b,c\nA b"), (None, "a b c"), (102, "a " * 30_000)]
    df = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, n_hit string")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items] + [(None, "a", 0)], "item_id long, text string, doc_id int")
    index = phrase_index.build_index(df, shard_bytes=shard)
    hits = phrase_index.matches(index, bench, window=4, slop=3, block_bytes=block)
    got = phrase_index.contamination(index, hits).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    found = brute.windows(items, 4)
    assert sorted(map(tuple, got), key=key) == sorted(((i, *brute.contamination(t, found)) for i, t in docs), key=key)
    assert phrase_index.decontaminate(df.filter("false"), bench).collect() == []
    assert not any(r.contaminated for r in phrase_index.decontaminate(df, bench.filter("false")).collect())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x x gamma alpha y beta x"), (2, "alpha beta " + "x " * 50 + "gamma"), (3, "beta gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    got = {r.doc_id: (r.n_items, r.n_near_items) for r in phrase_index.decontaminate(docs, items, slop=4).collect()}
    assert got == {1: (0, 1), 2: (0, 0), 3: (0, 0)}


def near(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, kept string")
    got = minhash_join.near_duplicates(df, **more).collect()
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got)


def test_near_query(spark, documents):
    expected = brute.classes([(d["doc_id"], d["text"]) for d in documents], 4)
    got = queries.op5_minhash_join(spark, SF).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted((i, *x) for i, x in expected.items())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_groups_and_chains(spark):
    """A large group of near copies, chains that drift away from their start, and texts that share a passage."""
    rng = random.Random(8)
    base = [f"v{rng.randrange(500)}" for _ in range(120)]
    rows = [edited(rng, base, rng.choice([0, 1, 2])) for _ in range(150)] + [" ".join(base)] * 40
    drift = list(base)
    for _ in range(60):
        drift[rng.randrange(120)] = f"d{rng.randrange(10**6)}"
        rows.append(" ".join(drift))
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(30)) for _ in range(60)]
    rows += ["", "one", "One", "one two", "one two three", "a b c d", "a b c d e"]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    expected = sorted((i, *x) for i, x in brute.classes(rows, 4).items())
    assert near(spark, rows, words=4, block_nodes=2000) == expected
    assert near(spark, rows, words=4, block_nodes=16) == expected


def test_near_star_of_long_texts(spark):
    """Copies that resemble one long text, but not each other; that text has the greatest id."""
    rng = random.Random(5)
    rows = []
    for group in range(4):
        base = [f"v{rng.randrange(10**7)}" for _ in range(20_000)]
        for k in range(9):
            changed = [f"x{rng.randrange(10**7)}" for _ in range(2_000)]
            rows.append((100 * group + k, " ".join(base[: k * 2_000] + changed + base[(k + 1) * 2_000 :])))
        rows.append((100 * group + 50, " ".join(base)))
    expected = sorted((i, *x) for i, x in brute.classes(rows, 4).items())
    assert {x[2] for x in expected} == {0, 100, 200, 300}
    assert near(spark, rows, words=4) == expected


def test_near_awkward_rows(spark):
    text = "one two three four five six"
    got = {r for r in map(tuple, ([i, n, c, k] for i, n, c, k in near_rows(spark, [(5, text), (3, text.upper()), (3, "other words stand here today now"), (9, "other words stand here today now"), (7, None), (7, None), (8, ""), (None, text)])))}
    assert got == {(5, 2, 3, False), (3, 2, 3, True), (9, 2, 3, False), (7, 0, 7, True), (8, 0, 8, True), (None, 2, 3, False)}
    assert near_rows(spark, []) == []


@pytest.mark.parametrize("n", [4, 5])
@pytest.mark.parametrize("words", [1, 2, 3, 4, 5])
def test_shingles_of_one_short_text(words, n):
    data = np.frombuffer(" ".join("abcde"[:words]).encode(), np.uint8)
    (own,) = minhash_join.shingle_sets(data, np.array([0, len(data)]), n)
    assert len(own) == len(brute.shingles(" ".join("abcde"[:words]), n))


@pytest.mark.parametrize("n", [4, 5])
def test_near_table_of_one_short_text(spark, n):
    for words in range(1, 6):
        text = " ".join("abcde"[:words])
        assert near(spark, [(7, text)], words=n) == [(7, len(brute.shingles(text, n)), 7, True)]


def test_near_rows_without_or_with_shared_ids(spark):
    """Only like texts are linked: not rows that have no id, nor rows that share one."""
    rng = random.Random(4)
    a, b, c, d = ([f"{name}{k}" for k in range(60)] for name in "abcd")
    text = lambda words: " ".join(words)
    rows = [(5, text(a)), (9, text(b)), (None, text(a[1:])), (None, text(b[1:])), (None, text(b[1:])), (None, text(["e"] * 9)), (2**63 - 1, text(["f"] * 9))]
    rows += [(3, text(c)), (3, text(d)), (2, text(d[1:])), (3, text(c[1:])), (3, text(c)), (3, ""), (3, "")]
    rng.shuffle(rows)
    expected = [(5, 57, 5, True), (9, 57, 9, True), (None, 56, 5, False), (None, 56, 9, False), (None, 56, 9, False), (None, 1, None, True), (2**63 - 1, 1, 2**63 - 1, True)]
    expected += [(3, 57, 3, True), (3, 57, 2, False), (2, 56, 2, True), (3, 56, 3, True), (3, 57, 3, True), (3, 0, 3, True), (3, 0, 3, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash_join.near_duplicates(df, words=4).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    left = [tuple(r) for r in corpus_pipeline.near_stage(spark, df, SF).collect()]
    alike = [r for r in left if r in ((3, text(c)), (3, text(c[1:])))]
    assert len(alike) == 1
    always = [r for r in rows if r[0] != 3] + [(3, "")]
    assert sorted(left, key=key) == sorted(always + alike, key=key)


def near_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_join.near_duplicates(df).collect()]


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 30)] + [(100, k) for k in range(101, 140)] + [(139, 50), (7, 7), (1, 2), (2, 1)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert got == {k: 1 for k in range(2, 31)} | {k: 50 for k in range(100, 140)}


def test_line_query(spark, documents):
    expected = brute.cut_lines([(d["doc_id"], d["text"]) for d in documents])
    assert sum(x[2] for x in expected)
    assert sorted(map(tuple, queries.op7_line_windows(spark, SF).collect())) == sorted(expected)


def test_lines_on_awkward_rows(spark):
    rng = random.Random(1)
    rows = [(k, "\n".join(rng.choice("ab ") for _ in range(rng.choice([1, 2, 3, 4, 12])))) for k in range(40)]
    rows += [(50, None), (51, ""), (52, "\n\n\n\n"), (53, "\n\n\n\n"), (None, "x\ny\nz\nlast"), (54, "x\ny\nz"), (55, "q\nr\ns"), (55, "q\nr\ns"), (56, "\n".join(f"l{k}" for k in range(30_000)))]
    df = spark.createDataFrame([(i, t, "c", 1, "k") for i, t in rows], "doc_id long, text string, lines string, n_lines int, starts_ string")
    out = line_windows.remove_repeated_windows(df)
    assert out.columns == ["doc_id", "text", "lines", "starts_", "n_lines", "n_removed"]
    got = out.select("doc_id", "n_lines", "n_removed", "text").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute.cut_lines(rows), key=key)
    assert line_windows.remove_repeated_windows(df.filter("false")).collect() == []


def test_line_plan_is_native(spark):
    plan = queries.op7_line_windows(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_language_held_out_accuracy(spark, documents):
    got = {r.doc_id: r for r in queries.op10_lang_crf(spark, "/root/testdata/sf0.01").collect()}
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "lang"]).to_pylist()}
    assert set(got) == set(lang)
    held = [r for r in got.values() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


@pytest.fixture(scope="module")
def model(spark):
    return lang_crf.train(spark.read.parquet(f"{SF}/documents.parquet"), per_language=30)


def test_language_on_awkward_rows(spark, model, documents):
    texts = [None, "", "12 34 ...", "— … €", "漢字", "\n", documents[0]["text"] * 20, documents[0]["text"], "a"]
    df = spark.createDataFrame([(k, t, "xx", "und") for k, t in enumerate(texts)] + [(0, None, None, None), (None, "x", None, None)], "doc_id long, text string, lang string, lang_pred string")
    got = {(r.doc_id, r.lang_pred == "und", r.score > 0) for r in lang_crf.label_documents(df, model).collect()}
    assert got == {(k, k in (0, 1, 2, 3, 5), k not in (0, 1, 2, 3, 5)) for k in range(9)} | {(None, False, True)}
    kept = lang_crf.keep_known(df, model, 0.0)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {4, 6, 7, 8, None}
    nothing = lang_crf.train(df.filter("false"))
    assert {r.lang_pred for r in lang_crf.label_documents(df, nothing).collect()} == {"und"}
    assert lang_crf.label_documents(df.filter("false"), model).collect() == []


def test_every_label_is_learned(spark):
    """Forty languages, one of which has over-long texts only that begin without letters."""
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{k:02}": ["".join(rng.choice(letters) for _ in range(6)) for _ in range(30)] for k in range(40)}
    rows = []
    for k, (lang, own) in enumerate(words.items()):
        for d in range(9 if k else 40):
            text = " ".join(rng.choice(own) for _ in range(40))
            rows.append((1000 * k + d, "12 34 " * 40 + text * 6 if k == 7 else text, lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = lang_crf.train(df, longest_chars=600)
    assert learned.labels == sorted(words)
    assert learned.weights.size <= 16 << 18
    got = {r.doc_id: r.lang_pred for r in lang_crf.label_documents(df, learned).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) > 0.98 * len(rows)
    assert all(got[7000 + d] == "l07" for d in range(9))


def test_language_against_plain_python(spark, model, documents):
    """Features, weights, chains and shares as loops, on prose, short words, accents and other scripts."""
    texts = [d["text"][:1500] for d in documents[:40]] + ["a b c d", "é", "ÀÉ×Ü straße", "漢字 かな", "x", "I", "12", "", "word " * 200, "o" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in lang_crf.label_documents(df, model).collect()}
    for k, text in enumerate(texts):
        lang, score = brute.language(model, text)
        assert got[k].lang_pred == lang and np.isclose(got[k].score, score, atol=1e-4), text


def test_a_word_has_the_same_features_in_any_list():
    words = [b"a", b"i", b"of", b"the", "é".encode(), b"languages", b"x" * 40]
    for k in range(len(words)):
        order = words[k:] + words[:k]
        ids, n = lang_crf.word_features(order, 18)
        at = np.cumsum(n) - n
        for w, a, m in zip(order, at, n):
            assert sorted(ids[a : a + m]) == sorted(brute.crf_features(w, 18))


def test_a_long_text_in_pieces(model, documents):
    """Pieces of whole chains give what the whole text gives, also with words longer than a piece."""
    for text in ("".join(d["text"] + "\n" for d in documents[:30]), "w" * 5000 + " und das ist " * 300, " ." * 3000 + "das " * 100, "a" * 9000):
        data = np.frombuffer(text.encode(), np.uint8)
        whole, counts = model.word_labels(data, np.array([0, len(data)]))
        for most in (700, 2000):
            parts = list(model._pieces(data, most))
            assert sum(int(n.sum()) for _, n in parts) == counts[0]
            assert np.allclose(np.concatenate([g for g, _ in parts]), whole)


def test_word_labels_follow_switches(model, documents):
    """Code-switched text: the labels of the words change with the language."""
    pick = {}
    for d in documents:
        if d["lang"] in ("de", "es") and d["n_chars"] > 600 and zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1:
            pick.setdefault(d["lang"], d["text"][:500])
    text = (pick["de"] + " " + pick["es"]).encode()
    gamma, counts = model.word_labels(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    best = [model.labels[k] for k in gamma.argmax(1)]
    half = len(model.word_labels(np.frombuffer(pick["de"].encode(), np.uint8), np.array([0, len(pick["de"].encode())]))[0])
    assert counts[0] == len(best)
    assert best[:half].count("de") > 0.8 * half and best[half:].count("es") > 0.8 * (len(best) - half)


def test_forward_backward_equals_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    emission, move, start = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    alive = np.array([[True] * 4, [True, True, False, False]])
    gamma, both, log_z = lang_crf.forward_backward(emission, alive, move, start)
    pairs = np.zeros((3, 3))
    for c, n in ((0, 4), (1, 2)):
        weight, total, steps = {}, 0.0, np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=n):
            w = np.exp(start[path[0]] + sum(emission[c, t, y] for t, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            weight[path] = w
            total += w
            for a, b in zip(path, path[1:]):
                steps[a, b] += w
        pairs += steps / total
        assert np.isclose(log_z[c], np.log(total))
        for t in range(n):
            assert np.allclose(gamma[c, t], [sum(w for p, w in weight.items() if p[t] == y) / total for y in range(3)])
    assert np.allclose(both, pairs)


def test_pipeline_stages(spark, documents, benchmark):
    """Each stage on its own input against brute force; the whole run repeats them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(900_001, None, None, None, None), (900_002, "12 34", "en", "s", 5), (documents[3]["doc_id"], documents[3]["text"], "en", "again", 1)], docs.schema)
    docs = docs.unionByName(odd)
    stages = [f for _, f in corpus_pipeline.STAGES]
    known = stages[0](spark, docs, SF).cache()
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in known.collect()} == {900_001, 900_002}
    cut = stages[1](spark, known, SF).cache()
    expected = [x for x in brute.cut_lines([(r.doc_id, r.text) for r in known.collect()]) if not x[2] or x[2] < x[1]]
    assert cut.schema == docs.schema
    assert sorted((r.doc_id, r.text) for r in cut.collect()) == sorted((x[0], x[3]) for x in expected)
    assert all(r.n_chars == len(r.text) for r in cut.collect() if r.source != "again")
    near_ = stages[2](spark, cut, SF).cache()
    classes = brute.classes([(r.doc_id, r.text) for r in cut.collect()], 5)
    assert sorted(r.doc_id for r in near_.collect()) == sorted(i for i, x in classes.items() if x[2])
    clean = stages[3](spark, near_, SF).cache()
    found = brute.windows(benchmark)
    assert sorted(map(tuple, clean.collect())) == sorted(tuple(r) for r in near_.collect() if not brute.contamination(r.text, found)[4])
    packed = stages[4](spark, clean, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in clean.collect()}
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == packed.columns and {r.doc_id for r in whole.collect()} == {r.doc_id for r in packed.collect()}
    assert corpus_pipeline.ORACLE_SQL is None


CLASHING = ("starts", "__lines", "__text_key", "__line_doc", "__id", "__key", "n_lines", "n_removed", "id", "key", "row", "doc", "c0", "lines", "a.b", "class", "kept", "text_key", "held_id")


def test_clashing_column_names_pass_through(spark):
    """Every stage but the last returns such columns as they came."""
    shared_lines = "one two three\nfour five six\nseven eight nine"
    texts = [f"the house is old {i}\n{shared_lines}\nand so it was {i * 7} all along the way to the sea" for i in range(6)]
    texts += [texts[5], None, "", "und das haus ist sehr alt und gross"]
    rows = [(i, t, "en" if i < 9 else "de", *[f"{c}{i}" for c in CLASHING]) for i, t in enumerate(texts)] + [(None, "no id here but some text", "en", *CLASHING)]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    docs = spark.createDataFrame(rows, schema)
    before = {r[0]: tuple(r)[2:] for r in docs.collect()}
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for one in (stage(spark, docs.filter("text is not null"), SF), stage(spark, left, SF)):
            assert one.columns == docs.columns, name
            got = one.collect()
            assert got and all(tuple(r)[2:] == before[r[0]] for r in got), name
        left = one
        assert stage(spark, docs.limit(0), SF).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, left, SF).count() >= left.count()


def test_clashing_column_names_in_operators(spark):
    """Operators give the same rows with and without extra columns of their inner names."""
    texts = ["a b c\nd e f\ng h i", "x\na b c\nd e f\ng h i\ny", "", None, "a b c d e f g h i j k l m"]
    plain = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    extra = plain.selectExpr("*", *[f"'z' AS `{c}`" for c in CLASHING])
    bench = spark.createDataFrame([(1, "d e f g h i j k l m")], "item_id long, text string")
    runs = (
        lambda d: minhash_join.near_duplicates(d, words=2),
        lambda d: phrase_index.decontaminate(d, bench),
        lambda d: line_windows.remove_repeated_windows(d).select("doc_id", "n_lines", "n_removed", "text"),
    )
    for run in runs:
        assert sorted(map(str, run(plain).collect())) == sorted(map(str, run(extra).collect()))
    kept = line_windows.remove_repeated_windows(extra)
    assert [c for c in kept.columns if c in CLASHING] == [c for c in CLASHING if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    assert {tuple(r[c] for c in CLASHING if c not in ("n_lines", "n_removed")) for r in kept.select(*[f"`{c}`" for c in kept.columns]).collect()} == {("z",) * (len(CLASHING) - 2)}


def test_encoded_columns_with_nulls():
    from trafficwatch.llm import shared

    column = pa.array(["ab", None, "", "é"])
    data, offsets = shared.utf8_buffers(column.slice(1))
    assert offsets.tolist() == [0, 0, 0, 2] and data.tobytes() == "é".encode()
    batch = pa.RecordBatch.from_arrays([column], names=["t"])
    assert [b.num_rows for b in shared.by_bytes([batch], 0, 1)] == [1, 1, 1, 1] or sum(b.num_rows for b in shared.by_bytes([batch], 0, 1)) == 4
