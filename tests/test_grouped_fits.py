"""Linear models are fitted on one row per combination of inputs and label, with the results of all rows."""

import numpy as np
from pyspark.ml import PipelineModel

from tallyloom.operators import features as ft, models as md


def rows_of(spark, n=400):
    rows = [(i, f"shop {'abc'[i % 3]} x{i % 7 if i % 50 else i}", "lo" if i % 2 else None, "dc"[i % 2], "xyz"[(i * i) % 3], 1.0 + i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, description string, amount_bucket string, transaction_type string, category string, weight double")


def test_equal_rows_are_one_row_of_their_weight(spark):
    train = rows_of(spark)
    learner = md.LogisticLearner(tol=1e-6)
    for weight in (None, "weight"):
        ready, alone = learner.prepare(train, weight), learner.prepare(train, weight, keep=["row_id"])
        few, many = ready.data.collect(), alone.data.collect()
        assert len(many) == 400 and len(few) < 100
        assert np.isclose(sum(r["w"] for r in few), sum(r["w"] for r in many)) and ready.size == alone.size
        assert np.allclose(learner.fit(ready)[0], learner.fit(alone)[0], atol=1e-3)


def test_terms_of_counted_texts_are_those_of_all_rows(spark):
    train = rows_of(spark)
    data = ft.fill_and_scale(train, ft.NARROW).transform(train)
    grouped = data.groupBy("text_in").count()
    plain, counted = ft.text_stages(data, ft.NARROW), ft.text_stages(grouped, ft.NARROW, times="count")
    weights = [dict(zip(ft.text_terms(PipelineModel(s)), np.asarray(s[-2].getScalingVec().toArray()))) for s in (plain, counted)]
    assert weights[0].keys() == weights[1].keys() and all(np.isclose(weights[0][t], weights[1][t]) for t in weights[0])
