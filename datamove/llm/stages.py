"""The stages of the corpus pipeline; each takes (spark, docs, sf_dir) and judges all of ``docs``.

All but the last return the columns of documents, less the rows they reject.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from datamove.llm import decontaminate, language, near_sets, quality, queries
from datamove.llm.arrow import fold, quoted

# Share of the text that its main language must have.
MAIN_LANGUAGE = 0.5

# Near copies share so much of their runs of so many words.
COPY_SHINGLE, COPY_THRESHOLD = 5, 0.8


def _kept(docs: DataFrame, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``judge`` keeps, with the columns of ``docs``, whatever names these have."""
    inside = {c: c if c in ("doc_id", "text") else f"__column{i}__" for i, c in enumerate(docs.columns)}
    kept = judge(docs.select(*[quoted(c).alias(name) for c, name in inside.items()]))
    return kept.select(*[quoted(name).alias(c) for c, name in inside.items()])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn for their likeness to good text."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _kept(docs, lambda rows: quality.resample(rows, labels, rows.columns).where("kept"))


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one main language; those without a letter, or of several without one, go."""
    model = language.learn_languages(docs.where(fold("doc_id") != 1))
    fits = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MAIN_LANGUAGE)
    return _kept(docs, lambda rows: language.tell_languages(rows, model, rows.columns).where(fits))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id; of repeated empty ones of an id, one.

    An id that repeats with texts of several groups stands in each.  Rows without an id stay.
    """
    return _kept(docs, _one_copy)


def _one_copy(docs: DataFrame) -> DataFrame:
    hashed = docs.withColumn("__textid__", F.xxhash64("text"))
    named = near_sets.near_copies(
        hashed.where("doc_id IS NOT NULL"), shingle=COPY_SHINGLE, threshold=COPY_THRESHOLD, keep=["__textid__"]
    )
    group = ["component", F.when(F.col("component").isNull(), F.col("doc_id"))]
    first = named.groupBy(*group).agg(F.min(F.struct("doc_id", "__textid__")).alias("first")).select("first.*").distinct()
    once = F.row_number().over(Window.partitionBy("doc_id", "__textid__").orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")]))
    kept = hashed.join(first, ["doc_id", "__textid__"]).withColumn("__rank__", once).where("__rank__ = 1").select(*docs.columns)
    return kept.unionByName(docs.where("doc_id IS NULL"))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents no word of which stands in a passage of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _kept(docs, lambda rows: decontaminate.find_passages(rows, benchmark, rows.columns).where(F.size("spans") == 0))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, counted and digested, and the digest of what they decode to."""
    return queries.tokenized(docs, ["doc_id", "lang", "source"])
