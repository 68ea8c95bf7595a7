"""The pipeline against brute-force versions of its stages, each on what the one before kept."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import test_jaccard_join
import test_suffix_dedup
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import byte_bpe, classifier, decontamination

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Rows of the documents and of every stage's result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SF)
        columns = docs.columns
        out.append(rows.collect())
        docs = spark.createDataFrame(out[-1], rows.schema)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == columns
    return out


def _ids(rows):
    return sorted(r.doc_id for r in rows)


def test_quality(spark, steps):
    docs = spark.createDataFrame(steps[0])
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~classifier.held_out())
    model = classifier.fit(docs, labels)
    kept = [r for r in steps[0] if model.score(r.text, classifier._Buckets()) >= 0.5]
    assert sorted(kept) == sorted(steps[1])
    assert 0 < len(kept) < len(steps[0])


def test_near_duplicates(steps):
    classes = test_jaccard_join.brute([(r.doc_id, r.text) for r in steps[1]], 5, 80)
    kept = {c for *_, c in classes}
    assert sorted(r for r in steps[1] if r.doc_id in kept) == sorted(steps[2])
    assert len(steps[2]) < len(steps[1])


def test_repeated_passages(steps):
    rows = [(r.doc_id, r.text) for r in steps[2]]
    gone = {i: n for i, _, n, _, _ in test_suffix_dedup.brute(rows)}
    after = {r.doc_id: r for r in steps[3]}
    assert sorted(gone) == _ids(steps[3])
    for r in steps[2]:
        left = after[r.doc_id]
        assert left.n_chars == len(left.text)
        assert (left.lang, left.source) == (r.lang, r.source)
        # Characters of which only some bytes would go stay.
        assert 0 <= len(left.text.encode()) - (len(r.text.encode()) - gone[r.doc_id]) <= 6 * (gone[r.doc_id] > 0)
    whole = [r for r in test_suffix_dedup.brute(rows) if rows and r[2]]
    assert whole


def test_decontamination(spark, steps):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    finder = decontamination.Finder([(r.item_id, r.text) for r in items], decontamination.PERCENT)
    assert sorted(r for r in steps[3] if not finder.find(r.text)) == sorted(steps[4])
    exact = {r.doc_id for r in steps[3] for k in items if decontamination.normalised(k.text) in decontamination.normalised(r.text)}
    assert exact and not exact & {r.doc_id for r in steps[4]}


def test_token_ids(steps):
    ranks = byte_bpe.read_ranks(corpus_pipeline.RANKS)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in steps[4]}
    assert _ids(steps[5]) == sorted(texts)
    for r in steps[5]:
        assert np.frombuffer(r.ids, "<u4").tolist() == theirs.encode_ordinary(texts[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_equals_its_stages(spark, steps):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(rows) == sorted(steps[5])


def test_odd_rows(spark):
    """Nulls, empty texts, copies, another column and an empty table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (None, "", "x", None, 3)], docs.schema)
    some = docs.limit(60).unionByName(docs.limit(20)).unionByName(odd).withColumn("kept", F.lit(5))
    for frame in (some, some.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, frame, SF)
            frame = spark.createDataFrame(rows.collect(), rows.schema)
            assert frame.isEmpty() == (not rows.count())
