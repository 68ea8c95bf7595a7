"""One query per operator, each over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    byte_bpe,
    classifier,
    decontamination,
    filter_audit,
    jaccard_join,
    licenses,
    periodic_runs,
    personal_data,
    personal_data_examples,
    quotation,
    suffix_dedup,
    token_counts,
    topk,
    url_filter,
)
from starloom.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


URL_RULES = """SELECT * FROM VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
    AS rules(verdict, host, path)"""


@_query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"), spark.sql(URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@_query
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other rows for every row whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@_query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.cut(table(spark, sf_dir, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with at most eight edits per hundred characters."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECES)


@_query
def op6_quotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotations."""
    rows = quotation.formatted(quotation.reply_ordered(table(spark, sf_dir, "conversations")))
    return rows.orderBy("conv_id", "thread", "depth", "turn", "role", "text")


@_query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, nine tenths in common."""
    found = jaccard_join.classes(table(spark, sf_dir, "documents"), 3, 90)
    return found.select("doc_id", "n_shingles", "component_id")


@_query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files: the URL's host and path are the file's path, tags end lines."""
    pages = table(spark, sf_dir, "pages")
    pages = pages.select(licenses.url_path(F.col("url")).alias("path"), licenses.html_lines(F.col("html")).alias("text"))
    return licenses.scan(pages)


@_query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~classifier.held_out())
    scores = classifier.score(docs, classifier.fit(docs, labels))
    return scores.select("doc_id", classifier.held_out().alias("held_out"), "score", "predicted")


@_query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, split_at_spaces=True)


#: What a text fails by. The fifth filter, E, removes repeated texts.
FILTERS = {
    "A": lambda t: len(t.words) < 200,
    "B": lambda t: 100 * len(set(t.words)) < 50 * len(t.words),
    "C": lambda t: 100 * t.count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") > 3 * t.code_points(),
    "D": lambda t: t.count(b"#$%&*|") > 0,
}


@_query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, per language."""
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    weights = {"good_lost": ("quality", 1), "toxic_lost": ("toxic", 1)}
    return filter_audit.audit(docs, labels, FILTERS, "E", weights)


def _with_periodic_tails(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """In a tenth of the documents, what follows some word repeats the passage that begins there."""
    n = len(words)
    seed = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if not n or seed % 10:
        return words
    seed //= 10
    begin = seed % n
    period = 1 + (n - begin) // (3 + seed % 8)
    passage = words[begin : begin + period]
    return words[:begin] + (passage * (-(-(n - begin) // period)))[: n - begin]


@_query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of six words or more and of four periods or more, and the texts without repetitions."""
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), 6, 4, _with_periodic_tails)
    longest = F.array_min(F.transform("runs", lambda r: F.struct(-r.length, r.start, r.period)))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    length = -F.col("longest.col1")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        length.alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("(-1000 * longest.col1) div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest are the patterns'; ``spans`` has those that the field adds, too."""
    labelled = spark.createDataFrame([(line,) for line in personal_data_examples.LINES], "text string")
    found = personal_data.personal_data(table(spark, sf_dir, "documents"), personal_data.fit(labelled))
    base = F.filter("spans", lambda s: s.base)

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
