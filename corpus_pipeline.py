"""A training corpus from raw documents: five stages, each an operator of ``weftline.llm``.

Every stage reads what its predecessor kept, as a table written in between, and judges all of it.
All but the last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import best_fit, fm_index, line_crf, prefix_join, repeats
from weftline.plans.registry import query, table
from weftline.workspace import materialize

NEAR_PERCENT = 80
NEAR_WORDS = 5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are mostly content."""
    return line_crf.quality_rules(docs).where("kept").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows linked by 5-word shingles and a similarity of 0.8, the smallest id.

    Rows of one id are judged by their texts: different ones all stay, unless they are linked; of
    linked ones the smallest digest of the row stays.  Rows without an id are kept, of equal rows
    with one id one.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    digest = F.unhex(F.md5(F.to_json(F.struct(F.md5("text").alias("text"), *others))))
    rows = docs.where("doc_id IS NOT NULL").withColumn("__digest", digest)
    keyed = docs.withColumn("__row", F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", digest.alias("__digest"))))
    similar = prefix_join.similar_components(keyed, key="__row", percent=NEAR_PERCENT, width=NEAR_WORDS)
    first = similar.where("__row = component_id").select("__row.*").distinct()
    first = materialize(first, "kept-rows")
    kept = rows.join(first, ["doc_id", "__digest"], "left_semi").dropDuplicates(["doc_id", "__digest"])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings of earlier ones; those with nothing left but blanks go."""
    cut = repeats.remove_repeats(docs)
    cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate; all others are returned as they are."""
    judged = fm_index.contamination(docs, table(spark, sf_dir, "benchmark"))
    return judged.where("NOT contaminated").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of at most 4096 tokens."""
    return best_fit.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeats_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: Viterbi decoding, components and packing have no SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline", ORACLE_SQL)(run)
