"""Quality classifier and language identification: accuracy on labels they never saw, and odd cases."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.llm import langid, q_models, quality
from tests.llm.test_tables import ROWS, docs_of

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@needs_tables
def test_quality_against_labels(spark):
    got = q_models.op4_quality(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = got.join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in rows}
    assert n.get((1, False), 0) <= 0.01 * n[1, True], n  # clean documents stay
    assert n.get((0, True), 0) <= 0.1 * n[0, False], n
    assert got.count() == 1000


@needs_tables
def test_keeping_rows_agrees_with_scores(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = quality.keep_quality(docs)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in quality.score_quality(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == want


def test_quality_odd_cases(spark):
    got = {r.doc_id: r for r in quality.score_quality(docs_of(spark, ROWS)).collect()}
    assert got[4].score == got[5].score == got[6].score == 0 and not got[4].kept and got[4].votes is None
    assert quality.score_quality(docs_of(spark, [])).count() == 0


def test_expectation_maximisation_finds_the_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    votes = []
    for right, speaks in ((0.95, 0.9), (0.9, 0.8), (0.8, 0.9), (0.75, 0.7), (0.97, 0.6)):
        vote = np.where(rng.random(len(good)) < right, good, ~good).astype(int)
        votes.append(np.where(rng.random(len(good)) < speaks, vote, quality.ABSTAIN))
    patterns, at, n = np.unique(np.array(votes).T, axis=0, return_inverse=True, return_counts=True)
    names = ["".join(map(str, p)) for p in patterns.tolist()]
    found = quality.combine(list(zip(names, n.tolist(), strict=True)))
    p = np.array([found[name] for name in names])[at.ravel()]
    assert ((p > 0.5) == good).mean() > 0.96


@needs_tables
def test_languages_held_out(spark):
    got = q_models.op9_language_id(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").select(F.col("lang") == F.col("lang_pred")).collect()
    assert len(rows) > 250 and np.mean([r[0] for r in rows]) > 0.98
    assert got.where("score < 0 OR score > 1").count() == 0


def test_language_odd_cases(spark):
    rows = [(1, "the house is here and there", "a"), (2, "das Haus ist hier und dort", "a"), (3, None, "a"), (4, "123 !!", "a"), (5, "", "a"), (6, "ßß" * 3_000_000, "a"), (7, "木", "a")]
    docs = docs_of(spark, rows * 3).withColumn("lang", F.when(F.col("doc_id") == 1, "en").when(F.col("doc_id") == 2, "de").when(F.col("doc_id") == 7, "xx"))
    got = {r.doc_id: r for r in langid.identify(docs, langid.fit_languages(docs, F.lit(True))).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5, 7)] == ["en", "de", "und", "und", "und", "xx"]
    untaught = langid.fit_languages(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.identify(docs, untaught).collect()} == {"und"}
    assert langid.identify(docs.limit(0), untaught).count() == 0
