"""Corpus cleaning pipeline over ``documents``: each stage's rows are stored and feed the next one.

Every stage judges all its predecessor kept and returns the columns of its
input; the last returns the packed pieces.  Null texts, and texts without
letters (empty ones too), go at the first stage.  Rows without an id are never
dropped as near duplicates; of the rows that share an id, those whose texts are
alike leave that stage as one.  Very long texts are read whole, in pieces.  An
empty table gives no rows.  Extra columns pass through every stage but the last
unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficwatch.llm import lang_crf, line_windows, minhash_join, packing, phrase_index, shared
from trafficwatch.llm.queries import table

#: Shares of a text's words below which its language is taken as undecided.
LEAST_LANGUAGE_SCORE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: texts without letters, and undecided ones, go."""
    return lang_crf.keep_known(docs, lang_crf.train(docs), LEAST_LANGUAGE_SCORE)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; those that lose every line go.

    ``n_chars``, where there is one, is counted anew for the changed texts.
    """
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)]).alias("row")
    cut = line_windows.remove_repeated_windows(docs.select("doc_id", "text", whole)).filter("n_removed = 0 or n_removed < n_lines")
    columns = []
    for k, c in enumerate(docs.columns):
        held = F.col(f"row.c{k}")
        if c == "text":
            held = F.col("text")
        elif c == "n_chars":
            held = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(held).cast(docs.schema[c].dataType)
        columns.append(held.alias(c))
    return cut.select(*columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (five-word shingles, similarity 0.8 or more)."""
    return minhash_join.keep_one(docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item."""
    return phrase_index.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 ids from every kept document."""
    packed = packing.pack(docs)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The learned language model and the tokenizer have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = shared.materialize(docs, f"stage-{k}", batch_rows=1024)
    return docs
