"""Language identification: held-out accuracy, odd rows, and n-grams against a plain count."""

import numpy as np
from pyspark.sql import functions as F

from statement_lake.llm import language, queries

FOLDER = "/root/testdata/sf0.01"


def test_pieces_do_not_change_ngrams(monkeypatch):
    text = "Über den Wolken " * 40
    whole = sorted(np.concatenate(list(language.ngrams(text))).tolist())
    assert len(whole) == 3 * len(text) - 3
    monkeypatch.setattr(language, "PIECE", 7)
    assert sorted(np.concatenate(list(language.ngrams(text))).tolist()) == whole


def test_held_out_accuracy(spark):
    found = queries.op4_language_id(spark, FOLDER)
    truth = queries.table(spark, FOLDER, "documents").select("doc_id", "lang")
    right = found.where("held_out").join(truth, "doc_id").agg(
        F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))
    )
    assert right.first()[0] > 0.97
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog " * (i % 3 + 1), "en", "x") for i in range(20)]
    rows += [(i, "der hund und die katze " * (i % 3 + 1), "de", "x") for i in range(20, 40)]
    odd = [(100, None), (101, ""), (102, "123 --- ??"), (None, "the dog"), (103, "the dog"), (103, "der hund"),
           (104, "die katze " * 100_000), (105, "日本")]
    rows += [(i, t, None, "x") for i, t in odd]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    found = language.identify(frame, F.lit(True))
    assert found.count() == len(rows)
    told = sorted((r.doc_id or 0, r.lang_pred) for r in found.where("doc_id is null or doc_id >= 100").collect())
    assert told[:7] == [
        (0, "en"), (100, "und"), (101, "und"), (102, "und"), (103, "de"), (103, "en"), (104, "de")
    ]
    # nothing to learn from
    found = language.identify(frame, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}
    assert language.identify(frame.limit(0), F.lit(True)).count() == 0


def test_labels_and_sources_do_not_change_predictions(spark):
    frame = queries.table(spark, FOLDER, "documents")
    lessons = frame.where(~language.held_out())
    blind = frame.withColumn("lang", F.lit("en")).withColumn("source", F.lit(None))
    first = language.identify(frame, lessons).select("doc_id", "lang_pred")
    second = language.identify(blind, lessons).select("doc_id", "lang_pred")
    assert first.exceptAll(second).count() == 0


def test_rows_stay_in_the_jvm(spark):
    """Workers get each text once and nothing else; a condition does not have it predicted again."""
    frame = queries.table(spark, FOLDER, "documents")
    told = language.predict_rows(frame, ~language.held_out())
    kept = told.where("lang_pred <> 'und' and score >= 0.5")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan
    mine = told.select("row.doc_id", "lang_pred", "score")
    other = language.identify(frame, ~language.held_out())
    assert mine.exceptAll(other).count() == 0 and mine.count() == other.count()
