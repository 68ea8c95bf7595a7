import numpy as np
from helpers import by_id, docs
from pyspark.sql import functions as F

from starloom.llm import classifier, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    scores = queries.op9_quality_classifier(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    assert scores.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = scores.join(labels, "doc_id").where("held_out").toPandas()
    assert len(rows) > 100
    assert ((rows.score >= 0) & (rows.score <= 1)).all()
    assert (rows.predicted == (rows.score >= 0.5)).all()
    assert (rows.predicted == rows.quality).mean() > 0.95


def test_pairs_by_the_sum_of_squares():
    rng = np.random.default_rng(1)
    model = classifier.Model(0.3, rng.normal(size=classifier.COLUMNS), rng.normal(size=(classifier.COLUMNS, 4)))
    columns, values = np.array([3, 8, 99, 2000]), np.array([0.5, -1.0, 2.0, 0.25])
    pairs = sum(
        model.vectors[columns[i]] @ model.vectors[columns[j]] * values[i] * values[j]
        for i in range(4) for j in range(i + 1, 4)
    )
    expected = 0.3 + model.weights[columns] @ values + pairs
    assert abs(model.raw(columns, values) - expected) < 1e-9


def test_held_out_rows_are_never_learnt_from(spark):
    frame = docs(spark, [(i, "good words" if i % 2 else "bad!! words!!") for i in range(60)])
    true = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    flipped = true.withColumn("quality", F.when(classifier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    models = [classifier.fit(frame, t.where(~classifier.held_out())) for t in (true, flipped)]
    assert models[0].bias == models[1].bias
    assert (models[0].weights == models[1].weights).all()


def test_fit_is_repeatable_and_bounded(spark):
    frame = docs(spark, [(i, "good words" if i % 2 else "bad!! words!!") for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    a, b = (classifier.fit(frame.repartition(n), labels, rows=20) for n in (2, 5))
    assert (a.weights == b.weights).all()
    assert a.score("good words", classifier._Buckets()) > 0.5 > a.score("bad!! words!!", classifier._Buckets())


def test_repeated_ids_are_fitted_once(spark, monkeypatch):
    rows = [(i, "good words" if i % 2 else "bad!! words!!") for i in range(20)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, quality int")
    fitted, fit_rows = [], classifier.fit_rows
    monkeypatch.setattr(classifier, "fit_rows", lambda data, labels: fitted.append(len(data)) or fit_rows(data, labels))
    hot = rows + [(3, f"copy {n % 7}") for n in range(200)] + [(3, None)] * 5
    models = [classifier.fit(docs(spark, hot, parts), labels, rows=20) for parts in (2, 5)]
    assert fitted == [20, 20]
    assert (models[0].weights == models[1].weights).all()


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (5, "long " * 100_000)]
    frame = docs(spark, rows)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (5, 2), (5, 1), (9, 0)], "doc_id bigint, quality int")
    for model in (classifier.fit(frame, labels), classifier.fit(frame, labels.limit(0)), classifier.fit(frame.limit(0), labels)):
        found = by_id(classifier.score(frame, model), "doc_id", "predicted")
        assert [r[0] for r in found] == [None, 1, 2, 3, 3, 5]
        assert set(classifier.keep(frame, model).columns) == set(frame.columns)
    assert classifier.score(frame.limit(0), model).count() == 0
