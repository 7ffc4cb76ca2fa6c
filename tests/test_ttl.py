import random

from pyspark.sql import functions as F

from trafficwatch.operators.ttl import assign_first_arrival, dedupe_ttl, ttl_claims


def brute(rows, ttl):
    out, last = {}, {}
    for k, t in sorted(set(rows), key=lambda r: (r[0] is not None, r)):
        if k not in last or t >= last[k] + ttl:
            last[k] = t
            out[(k, t)] = (t, True)
        else:
            out[(k, t)] = (last[k], False)
    return out


def claims_of(spark, rows, ttl):
    df = spark.createDataFrame(rows, "k string, s long").withColumn("ts", F.timestamp_micros("s"))
    got = ttl_claims(df, F.col("k"), F.col("ts"), ttl / 1e6).collect()
    assert len(got) == len(set(rows))
    return {(r["k"], r["t_us"]): (r["claim_us"], r["claimed"]) for r in got}


def test_claims_match_brute_force(spark):
    """Keys of all sizes in one run: sparse and dense ones, borders of stretches, a null key, negative times."""
    rnd = random.Random(7)
    rows = []
    for k in range(60):
        span = rnd.choice([5, 100, 3000, 40_000])
        rows += [(f"k{k}", rnd.randint(-span, span)) for _ in range(rnd.choice([1, 3, 40, 400]))]
    rows += [(None, 7 * i) for i in range(300)] + [("step", 10 * i) for i in range(300)] + [("half", 5 * i + 1) for i in range(600)]
    for ttl in (1, 10, 37):
        assert claims_of(spark, rows, ttl) == brute(rows, ttl)


def test_one_key_with_a_third_of_all_rows(spark):
    """The hot key's work is spread over tasks by time."""
    rnd = random.Random(3)
    rows = [("hot", rnd.randint(0, 2_000_000)) for _ in range(20_000)] + [(f"k{rnd.randint(0, 5000)}", rnd.randint(0, 2_000_000)) for _ in range(40_000)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")  # stretches cross batches
    try:
        assert claims_of(spark, rows, 900) == brute(rows, 900)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_hand_sequence(spark):
    secs = [0, 3, 9, 10, 12, 19, 21, 35]
    df = spark.createDataFrame([("a", s) for s in secs], "k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    claims = ttl_claims(df, F.col("k"), F.col("ts"), 10).filter("claimed").orderBy("t_us").collect()
    assert [r["t_us"] // 1_000_000 for r in claims] == [0, 10, 21, 35]


def test_dedupe_ties_and_reclaim(spark):
    rows = [("a", 0, "x"), ("a", 0, "w"), ("a", 5, "z"), ("a", 10, "y"), ("b", 3, "q")]
    df = spark.createDataFrame(rows, "k string, s long, tie string").withColumn("ts", F.timestamp_seconds("s"))
    out = dedupe_ttl(df, F.col("k"), F.col("ts"), 10, F.col("tie"))
    got = {(r["k"], r["s"], r["tie"]): r["is_duplicate"] for r in out.collect()}
    assert got == {("a", 0, "x"): True, ("a", 0, "w"): False, ("a", 5, "z"): True, ("a", 10, "y"): False, ("b", 3, "q"): False}


def test_exact_repeats_keep_one_and_numbers_order_as_numbers(spark):
    rows = [("a", 0, 9), ("a", 0, 10), ("a", 0, 9), ("b", 1, 5), ("b", 1, 5), (None, 2, 1), (None, 2, 1), ("c", None, 1), ("c", None, 1)]
    df = spark.createDataFrame(rows, "k string, s long, tie long").withColumn("ts", F.timestamp_seconds("s"))
    got = [(r["k"], r["tie"]) for r in dedupe_ttl(df, F.col("k"), F.col("ts"), 10, F.col("tie")).filter("not is_duplicate").collect()]
    # rows without a time are never suppressed
    assert sorted(got, key=str) == sorted([("a", 9), ("b", 5), (None, 1), ("c", 1), ("c", 1)], key=str)


def test_where_leaves_the_rest_unjudged(spark):
    df = spark.createDataFrame([("a", 0, True), ("a", 1, True), ("a", 2, False), ("a", 3, None)], "k string, s long, use boolean").withColumn("ts", F.timestamp_seconds("s"))
    got = {r["s"]: r["is_duplicate"] for r in dedupe_ttl(df, F.col("k"), F.col("ts"), 10, F.col("s"), where=F.col("use")).collect()}
    assert got == {0: False, 1: True, 2: None, 3: None}


def test_first_arrival_windows(spark):
    df = spark.createDataFrame([("a", 0), ("a", 9), ("a", 10), ("a", None), (None, 4)], "k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {(r["k"], r["s"]): r["o"] for r in assign_first_arrival(df, F.col("k"), F.col("ts"), 10).select("k", "s", F.unix_seconds("opened_at").alias("o")).collect()}
    assert got == {("a", 0): 0, ("a", 9): 0, ("a", 10): 10, ("a", None): None, (None, 4): 4}
