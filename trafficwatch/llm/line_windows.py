"""Removal of repeated three-line windows, with built-in functions only.

Every run of ``window`` consecutive lines is hashed (two 64-bit hashes).  The
first occurrence of a window, by (doc_id, text hash, line), stays; the lines
of every later occurrence go.  Overlapping later windows merge: a line goes if
any of them covers it.

Defined results: null text stays null and empty text empty (no window has
fewer lines than ``window``); a document with all lines covered gets an empty
text; rows that agree on id and text are one occurrence and get the same
result; null ids rank first, and of occurrences that tie in id and text hash
the earlier line stays; a very long text is one row here as it was in the
input, with one array entry a line and a window; an empty table gives no rows;
columns of any other name are kept as they are; an input column named n_lines
or n_removed is replaced by the one that is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_rows(docs: DataFrame, window: int) -> DataFrame:
    """One row per window of (doc_id, text): document, text hash, first line, two hashes."""
    lines = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("key"), F.split("text", "\n", -1).alias("lines"))

    def entry(p: Column) -> Column:
        own = [F.get("lines", p + k) for k in range(window)]
        return F.struct(p.alias("p"), F.xxhash64(*own).alias("a"), F.xxhash64(F.lit("second"), *reversed(own)).alias("b"))

    starts = F.sequence(F.lit(0), F.size("lines") - window)
    rows = lines.filter(F.size("lines") >= window).select("doc", "key", F.explode(F.transform(starts, entry)).alias("w"))
    return rows.select("doc", "key", "w.p", "w.a", "w.b")


def remove_repeated_windows(docs: DataFrame, window: int = 3) -> DataFrame:
    """``docs`` with the repeated lines cut out of ``text``, plus n_lines and n_removed."""
    occurrences = window_rows(docs, window)
    place = F.struct("doc", "key", "p")
    repeated = occurrences.groupBy("a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    later = occurrences.join(repeated, ["a", "b"]).filter(~place.eqNullSafe(F.col("first")))
    covered = later.groupBy("doc", "key").agg(F.sort_array(F.collect_set("p")).alias("starts"))

    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # the input's columns travel in one struct, under numbers, so no name can clash
    held = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)]).alias("row")
    keyed = docs.select(held, F.xxhash64("text").alias("text_key"))
    at_id, at_text = (F.col(f"row.c{keep.index(c)}") for c in ("doc_id", "text"))
    joined = keyed.join(covered, at_id.eqNullSafe(F.col("doc")) & (F.col("text_key") == F.col("key")), "left")
    joined = joined.select("row", "starts", F.split(at_text, "\n", -1).alias("lines")).withColumn("total", F.coalesce(F.size("lines"), F.lit(0)))
    # what stays lies between the end of one covered window and the start of the next
    gaps = F.zip_with(
        F.concat(F.array(F.lit(-window)), "starts"),
        F.concat(F.col("starts"), F.array("total")),
        lambda a, b: F.struct((a + window).alias("from"), (b - a - window).alias("n")),
    )
    joined = joined.withColumn("gaps", F.filter(gaps, lambda g: g["n"] > 0))
    stay = F.transform("gaps", lambda g: F.array_join(F.slice("lines", g["from"] + 1, g["n"]), "\n"))
    kept = F.aggregate("gaps", F.lit(0), lambda total, g: total + g["n"])
    text = F.when(F.col("starts").isNull(), at_text).otherwise(F.array_join(stay, "\n"))
    n_lines = F.when(at_text.isNull(), 0).otherwise(F.col("total")).cast("long")
    removed = F.when(F.col("starts").isNull(), 0).otherwise(F.col("total") - kept).cast("long")
    cells = [(text if c == "text" else F.col(f"row.c{k}")).alias(c) for k, c in enumerate(keep)]
    return joined.select(*cells, n_lines.alias("n_lines"), removed.alias("n_removed"))


ORACLE = """
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS a FROM documents
),
places AS (
  SELECT doc_id, a, unnest(range(len(a))) AS p FROM lines
),
windows AS (
  SELECT doc_id, p, a[p + 1] || chr(10) || a[p + 2] || chr(10) || a[p + 3] AS w FROM places WHERE p + 3 <= len(a)
),
ranked AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS r FROM windows
),
gone AS (
  SELECT DISTINCT doc_id, p + k AS p FROM ranked, (SELECT unnest(range(3)) AS k) WHERE r > 1
),
marked AS (
  SELECT l.doc_id, l.p, l.a[l.p + 1] AS line, g.p IS NOT NULL AS cut FROM places l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.p = l.p
)
SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN cut THEN 1 ELSE 0 END)::BIGINT AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT cut), '') AS text
FROM marked GROUP BY doc_id
"""
