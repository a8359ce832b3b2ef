"""Quality and language: held-out accuracy, and what happens at the edges."""

import numpy as np
import pytest
from edges import ROWS, edge_docs, empty_docs
from pyspark.sql import functions as F

from threadloom.llm import language, quality
from threadloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality IS NOT NULL")
    rows = QUERIES["op4_quality"](spark, SF).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 500 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    for value in (0, 1):
        own = [r for r in rows if r.quality == value]
        assert np.mean([r.predicted == value for r in own]) > 0.97


def test_language_of_held_out_documents(spark):
    known = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").filter("lang IS NOT NULL")
    rows = QUERIES["op9_language_id"](spark, SF).join(known, "doc_id").filter("held_out").collect()
    assert len(rows) > 2000 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


@pytest.mark.parametrize("labelled", [True, False])
def test_quality_edges(spark, labelled):
    docs = edge_docs(spark)
    train = docs.select("text", (F.col("n_chars") % 2 if labelled else F.lit(None)).alias("label"), F.lit(False).alias("calibration"))
    model = quality.fit(train)
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.ids == "old" for r in rows)
    assert labelled or {r.score for r in rows} == {0.5}
    same = {r.text: r.score for r in rows}
    assert same[None] == same[""] and all(same[r.text] == r.score for r in rows)
    assert quality.score(empty_docs(spark), quality.fit(train.limit(0))).count() == 0


def test_isotonic_means_never_fall():
    counts = np.array([0, 2, 1, 0, 4, 3, 0])
    sums = np.array([0, 1, 0, 0, 1, 3, 0.0])
    levels = quality.isotonic(counts, sums)
    assert np.allclose(levels, [2 / 7, 2 / 7, 2 / 7, 2 / 7, 2 / 7, 1, 1])
    assert np.all(np.diff(levels) >= 0) and quality.isotonic(counts * 0, sums * 0).tolist() == [0.5] * 7


def test_language_edges(spark):
    docs = edge_docs(spark)
    model = language.fit(docs)
    rows = language.identify(docs, model).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        blank = not any(c.isalpha() for c in r.text or "")
        assert r.lang_pred == "und" and r.score == 0 if blank else r.lang_pred in {"en", "de", "fr", "es"}
    assert language.fit(empty_docs(spark)) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(empty_docs(spark), model).count() == 0


def test_language_sample_is_bounded_by_rows_without_a_key(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_PER_LANGUAGE", 20)
    taken = []
    whole = language.presence
    monkeypatch.setattr(language, "presence", lambda grams, *a: taken.append(len(grams)) or whole(grams, *a))
    same = spark.range(3000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('word ', id % 1000) AS text", "'en' AS lang")
    assert language.fit(same) is not None
    # Key and text are hashed together: neither all rows without a key are taken, nor repeated ones twice.
    assert 0 < max(taken) < 60
