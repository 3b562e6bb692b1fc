"""A corpus pipeline over ``documents``: five stages, each one of the training-data operators.

``STAGES`` lists (name, function) in order; a function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents; each
works on everything its predecessor kept.

Nulls, empty texts, repeated rows and empty tables are handled as the operators
say. Rows are told apart by a number given when a stage stores them, so a
repeated or null doc_id cannot remove another row. Further columns come through as
they are, also those named like a column that a stage works with.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.llm.common import release, stored, table
from govlake.llm.decontamination import decontaminate
from govlake.llm.jaccard_join import jaccard_join
from govlake.llm.language_id import UNKNOWN, fit, held_out, identify
from govlake.llm.packing import pack
from govlake.llm.pii import replace_pii

#: A document whose language is less certain than this, or that has no letter, is rejected.
LEAST_SCORE = 0.3
#: Near duplicates share this percentage of their five-word shingles.
SHINGLE, SHARE = 5, 80
ROW = "__row"


def aside(docs: DataFrame, *taken: str) -> tuple[DataFrame, list[Column]]:
    """The rows without columns of the taken names, which get free ones, and the columns that bring all back."""
    held = {c.lower() for c in docs.columns} | set(taken)
    free = {c: next(n for k in count() if (n := f"{c}_{k}").lower() not in held) for c in docs.columns if c.lower() in taken}
    back = [F.col(f"`{free.get(c, c)}`").alias(c) for c in docs.columns]
    return docs.withColumnsRenamed(free), back


def numbered(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """The rows with a number that is stored with them, so it is the same at every later read; the columns without it."""
    rows, back = aside(docs, ROW)
    return stored(rows.withColumn(ROW, F.monotonically_increasing_id()), "numbered"), back


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known (op 6); the model learns from the labelled rows."""
    training = docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label")).where(~held_out(F.col("id")))
    rows, back = aside(docs, "lang_pred", "score")
    told = identify(rows, fit(training))
    return told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (op 9): the smallest doc_id, then the first row."""
    rows, back = numbered(docs)
    groups = stored(jaccard_join(rows, ROW, "text", SHINGLE, SHARE).select(F.col("doc_id").alias(ROW), "component_id"), "groups")
    release(spark)
    ids = rows.select(ROW, "doc_id").join(groups.hint("merge"), ROW)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
    stays = stored(ids.groupBy("component_id").agg(F.min_by(ROW, order).alias(ROW)).select(ROW), "stays")
    return rows.join(stays.hint("merge"), ROW, "left_semi").select(back)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item (op 1)."""
    rows, back = numbered(docs)
    scanned, matches = decontaminate(rows, table(spark, sf_dir, "benchmark"), id_col=ROW)
    hit = matches.select("row").distinct().join(scanned, "row").select(F.col("doc_id").alias(ROW))
    return rows.join(stored(hit, "contaminated").hint("merge"), ROW, "left_anti").select(back)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets (op 4)."""
    rows, back = aside(docs, "n_replaced")
    return replace_pii(rows).withColumn("n_chars", F.length("text").cast("long")).select(back)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in training sequences (op 3)."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", benchmark),
    ("pii", personal_data),
    ("packing", packing),
]

#: Language scores and surrogates have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
