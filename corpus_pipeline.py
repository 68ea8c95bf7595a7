"""From raw documents to token ids: five stages, each reading what the one before has written.

A stage gets ``(spark, docs, sf_dir)``; all but the last return the columns of ``docs``. Rows whose
text is null or empty pass through (a null text leaves the second and third stage empty), null ids
count as larger than all others, and an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import byte_bpe, classifier, decontamination, jaccard_join, suffix_dedup
from starloom.llm.tables import ship, stored, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Near duplicates: words in a shingle, and shingles in common of all that two documents have.
SHINGLE, PERCENT = 5, 80


def _renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its other columns under names that clash with nothing, and the way back."""
    names = {f"_column_{n}": c for n, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.withColumnsRenamed({c: n for n, c in names.items()}), names


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from rows that aren't held out."""
    labels = table(spark, sf_dir, "labels").where(~classifier.held_out())
    return classifier.keep(docs, classifier.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    ship(spark)
    renamed, names = _renamed(docs)
    found = jaccard_join.classes(renamed, SHINGLE, PERCENT, carry=list(names), with_text=True)
    return found.where("kept").select(*renamed.columns).withColumnsRenamed(names)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller id has."""
    ship(spark)
    renamed, names = _renamed(docs)
    found = suffix_dedup.cut(renamed, carry=list(names), whole_characters=True)
    found = found.withColumn("text", F.col("kept").cast("string"))
    found = found.select(*renamed.columns).withColumnsRenamed(names)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids``, with the digests of the ids and of the bytes that they decode to."""
    ship(spark)
    return byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, split_at_spaces=True, with_ids=True)


STAGES = [
    ("quality_classifier", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontaminated),
    ("byte_bpe", token_ids),
]

#: No SQL says what a classifier has learnt or how a text is encoded; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
