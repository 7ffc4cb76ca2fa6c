"""Fill-in-middle: cuts by descent against plain slicing, forms, exact restoration, awkward rows."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trafficwatch.llm import fill_middle

SCHEMA = "doc_id long, text string"


def plain_units(text, unit):
    """Units of a text, by scanning it."""
    if unit == "code_points":
        return list(text)
    if unit == "lines":
        return re.findall(r"[^\n]*\n|[^\n]+", text)
    blank = r"[ \t\n\x0b\x0c\r]"
    found = re.findall(rf"(?:(?!{blank}).)+{blank}*", text, re.S)
    lead = re.match(rf"{blank}*", text).group(0)
    return [lead + found[0], *found[1:]] if found else ([lead] if lead else [])


def brute(doc_id, text, unit="code_points"):
    """One row of ``fill_in_middle`` with the default parameters."""
    text = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = plain_units(text, unit)
    n = len(units)
    if not text or any(m in text for m in fill_middle.MARKS) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    one, two = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, one), (one, two), (two, n)))
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\tÄ漢😀́", max_size=90), min_size=1, max_size=5), st.sampled_from(["code_points", "words", "lines"]), st.integers(1, 9))
def test_cuts_equal_slicing(texts, unit, block_bytes):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0] + [len(r) for r in raw])
    trees = fill_middle.BlockTrees(data, offsets, unit, block_bytes)
    for k, text in enumerate(texts):
        units = plain_units(text, unit)
        assert trees.total[k] == len(units)
        after = np.arange(len(units) + 1)
        where, chars = trees.cut(np.full(len(after), k), after)
        for a in after.tolist():
            head = "".join(units[:a])
            assert where[a] - offsets[k] == len(head.encode()) and chars[a] == len(head)


@pytest.mark.parametrize("unit", ["code_points", "words", "lines"])
def test_rows_equal_brute_force_and_restore(spark, unit):
    texts = ["", None, "a", "é", "one two", "x <P> y", "<S>", "<<M>", "a<", "ends in <", "漢字 仮名\r\n\n b", "  led by blanks", "\n\n", "tail \n", "word " * 40_000, "ß" * 70_001]
    rows = [(i, t) for i, t in enumerate(texts * 12)] + [(5, "one"), (5, "one"), (5, "two"), (None, "no id"), (None, None)]
    made = fill_middle.fill_in_middle(spark.createDataFrame(rows, SCHEMA).repartition(3), unit=unit)
    got = made.withColumn("again", fill_middle.restored(F.col("form"), F.col("output"))).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((brute(i, t, unit) for i, t in rows), key=key)
    assert sorted(r["again"] for r in got) == sorted(t or "" for _, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_other_columns(spark):
    assert fill_middle.fill_in_middle(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = spark.createDataFrame([(1, "some text", "kept out", 3, 4)], "doc_id long, text string, form string, h1 long, output int")
    assert [tuple(r) for r in fill_middle.fill_in_middle(rows).collect()] == [brute(1, "some text")]
