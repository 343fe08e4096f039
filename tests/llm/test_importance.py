import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tests.llm.fixtures import empty_documents, odd_documents
from tidemark.llm import importance
from tidemark.llm.common import kth_largest
from tidemark.llm.queries import LLM_QUERIES

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def selected(spark):
    return {r["doc_id"]: r for r in LLM_QUERIES["op8_importance_resampling"](spark, SF_ORACLE).collect()}


def test_held_out_labels(spark, selected):
    """Accuracy on the fold that the target model does not see."""
    labels = importance._labelled(spark.read.parquet(f"{SF_ORACLE}/labels.parquet")).where("fold = 0").collect()
    rows = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()
    junk = {r["doc_id"] for r in rows if r["quality"] == 0}
    good = [r["label_id"] for r in labels if r["good"]]
    assert len(good) > 40
    assert np.mean([selected[i]["selected"] for i in good]) > 0.9
    assert np.mean([selected[r["label_id"]]["selected"] for r in labels if r["label_id"] in junk]) < 0.1


def test_selection_is_the_top_k_by_gumbel_keys(spark, selected):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    known = importance._labelled(labels).collect()
    target = {r["label_id"] for r in known if r["good"] and r["fold"] > 0}
    raw, good = np.zeros(1 << importance.BITS), np.zeros(1 << importance.BITS)
    for i, t in docs.items():
        c = np.bincount(importance.grams(t), minlength=1 << importance.BITS)
        raw += c
        good += c if i in target else 0
    ratio = importance.log_ratio(raw, good)
    weights = {i: importance.worst_window(ratio[importance.grams(t)]) for i, t in docs.items()}
    assert all(abs(weights[i] - r["log_weight"]) < 1e-6 for i, r in selected.items())
    keys = sorted((r["gumbel_key"] for r in selected.values()), reverse=True)
    k = sum(r["selected"] for r in selected.values())
    assert all(r["selected"] == (r["gumbel_key"] >= keys[k - 1]) for r in selected.values())


def test_odd_rows_and_missing_labels(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], LABELS)
    got = importance.resample(docs, none).collect()
    assert len(got) == docs.count() and all(r["selected"] for r in got)
    some = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (5, 1, None), (7, None, 0), (11, 1, 0), (11, 0, 0)] +
                                 [(i, i % 2, 0) for i in range(12, 40)], LABELS)
    got = importance.resample(docs, some).collect()
    assert len(got) == docs.count()
    assert {r["log_weight"] for r in got if r["doc_id"] in (3, 4)} == {0.0}
    assert importance.select_documents(docs, some).columns == docs.columns
    assert importance.resample(empty_documents(spark), some).collect() == []
    assert importance.select_documents(empty_documents(spark), some).collect() == []


def test_kth_largest(spark):
    values = [float(v) for v in np.random.default_rng(3).normal(size=500).round(2)] + [7.5] * 200
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "key double")
    for k in (1, 100, 200, 201, 350, 700, 900):
        assert kth_largest(df, "key", k) == sorted(values, reverse=True)[min(k, 700) - 1]
    assert kth_largest(df.limit(0), "key", 3) is None


def test_gumbel_noise_has_the_right_shape(spark):
    x = [r[0] for r in spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).select(importance.gumbel()).collect()]
    assert abs(np.mean(x) - 0.5772) < 0.03 and abs(np.std(x) - 1.2825) < 0.03


def test_toxic_documents_are_rejected_in_each_language(spark):
    """Held-out toxic labels per language: words that are toxic though their letters are common in clean words."""
    sf = f"{os.path.dirname(SF_ORACLE)}/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("no sf0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    marks = labels.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    rows = importance.resample(docs, labels).join(importance._labelled(labels).join(marks, "label_id"), F.col("doc_id") == F.col("label_id"))
    rows = rows.join(docs.select("doc_id", "lang"), "doc_id").select("lang", "fold", "good", "toxic", "selected").collect()
    kept = lambda lang, **at: np.mean([r["selected"] for r in rows if r["lang"] == lang and all(r[k] == v for k, v in at.items())])
    for lang in ("en", "de", "fr", "es"):
        figures = kept(lang, toxic=1), kept(lang, toxic=1, fold=0), kept(lang, good=1, fold=0)
        print(lang, [round(float(x), 3) for x in figures])
        assert figures[0] < 0.3 and figures[1] < 0.35 and figures[2] > 0.9, (lang, figures)


def test_word_cells(spark):
    stems = len(importance.STEMS) + 1
    a, b = importance.words("Größe, größe! 語 été"), importance.words("größer \U0001F600")
    assert len(a) == 4 * stems and list(a[:stems]) == list(a[stems: 2 * stems])
    assert list(a[:2]) == list(b[:2]) and a[stems - 1] != b[stems - 1]  # stems of 3 and 5 letters agree, the words do not
    assert len(importance.words(" .,\n")) == 0 and importance.worst_window(np.zeros((0, 2), np.float32)) == 0.0
