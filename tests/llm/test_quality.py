import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from caretrail.llm.quality import (
    NAMES, Model, estimate_prior, features, fit, keep_good, margins_above, quality_scores, spread_of, train, with_features,
)

FOLDER = "/root/testdata/sf0.01"


def test_prior_is_found():
    dice = np.random.default_rng(0)
    for prior in (0.3, 0.6, 0.9):
        good, bad = dice.normal(2, 1, 4000), dice.normal(-2, 1, 4000)
        mixed = np.where(dice.random(4000) < prior, dice.normal(2, 1, 4000), bad)
        assert estimate_prior(good, mixed) == pytest.approx(prior, abs=0.06)


def test_features_cover_the_whole_text():
    a, b = features("word " * 5000), features("word " * 5000 + "###")
    assert len(a) == len(NAMES) and (a != b).any()
    assert not features("").any() and not features(None).any()


def test_risk_is_never_driven_below_zero():
    """The risk of the unlabelled as bad stays above zero although many free weights could push it below."""
    dice = np.random.default_rng(1)
    good, bad = dice.normal(0.6, 0.1, (60, len(NAMES))), dice.normal(0.2, 0.1, (20, len(NAMES)))
    mixed = np.vstack([dice.normal(0.6, 0.1, (60, len(NAMES))), bad])
    model = fit(good.astype(np.float32), mixed.astype(np.float32), prior=0.75, steps=3000, l2=0.0)
    rest = np.logaddexp(0, model.margin(mixed)).mean() - 0.75 * np.logaddexp(0, model.margin(good)).mean()
    assert rest > -0.05
    assert model.score(good).mean() > 0.7 and model.score(bad).mean() < 0.1


def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    out = quality_scores(documents, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(out) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    test = [r for r in out if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in test) / len(test) > 0.9


def test_labels_of_held_out_rows_do_not_matter(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "labels"))
    other = labels.selectExpr("doc_id", "if(crc32(string(doc_id)) % 5 = 0, 1 - quality, quality) AS quality")
    a, b = (sorted(tuple(r) for r in quality_scores(documents, lab).collect()) for lab in (labels, other))
    assert a == b


def test_odd_rows(spark):
    rows = [(1, None, "a", 0.5), (2, "", "b", None), (2, "", "b", None), (None, "x" * 50_000, "c", 1.0), (5, "Some words here.", "d", 2.0)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, features string, score double")
    labels = spark.createDataFrame([(5, 1), (None, 1), (1, None), (5, 1)], "doc_id long, quality int")
    out = quality_scores(documents, labels).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert {r.predicted for r in quality_scores(documents, labels.limit(0)).collect()} == {1}
    assert quality_scores(documents.limit(0), labels).count() == 0
    assert keep_good(documents, labels.limit(0)).columns == documents.columns


def test_statistics_are_those_of_all_documents(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    x = np.stack([features(r.text) for r in documents.collect()]).astype(np.float64)
    mean, spread = spread_of(documents.repartition(7))
    assert np.allclose(mean, x.mean(axis=0), atol=1e-5) and np.allclose(spread, x.std(axis=0), atol=1e-4)
    model = Model(mean, spread + 0.02, np.linspace(-1, 1, len(NAMES)), 0.1, 0.5)
    margins = np.round(model.margin(x), 9)
    cuts = np.quantile(margins, [0.1, 0.5, 0.9]) + 1e-7
    counts, total = margins_above(documents, model)(cuts)
    assert total == len(x) and counts.tolist() == [(margins >= c).sum() for c in cuts]
    assert spread_of(documents.limit(0))[0].tolist() == [0.0] * len(NAMES)


def test_the_sample_bounds_the_weights_only(spark):
    """With a small sample the mean is still that of all documents, and an id of many rows gives one vector."""
    documents, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    model = train(documents, labels, most=60)
    assert np.allclose(model.mean, spread_of(documents)[0])
    many = documents.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, 4).otherwise(F.col("doc_id")))
    assert quality_scores(many, labels).count() == documents.count()


def test_no_column_name_is_reserved(spark):
    rows = [(5, "Some words here.", "a", 1.0, b"f"), (6, None, "b", None, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, __text string, __score double, features binary")
    labels = spark.createDataFrame([(5, 1)], "doc_id long, quality int")
    kept = keep_good(documents, labels.limit(0))
    assert kept.columns == documents.columns and sorted(r.doc_id for r in kept.collect()) == [5, 6]
    assert with_features(documents, "text", ("doc_id", "features")).columns == ["doc_id", "features_in", "features"]
