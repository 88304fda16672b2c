"""Counts are read from one stored aggregate, and an interval of keys is counted once for all its ranks."""

import numpy as np
from pyspark.sql import functions as F

from tallyloom.operators import ranks
from tallyloom.operators.noise import CountingScorer
from tallyloom.operators.split import stratified_kfold


def shops(spark, n=600):
    rows = spark.range(n).select(F.col("id").alias("row_id"), F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("description"))
    return rows.withColumns({"amount_bucket": F.lit("a"), "transaction_type": F.lit("t"), "category": F.concat(F.lit("c"), (F.col("row_id") % 3).cast("string"))})


def test_scores_do_not_read_the_training_rows_again(spark, tmp_path):
    shops(spark).write.parquet(f"{tmp_path}/train-rows")
    train, asked = spark.read.parquet(f"{tmp_path}/train-rows"), shops(spark, 50)
    scored = CountingScorer().fit_score(train, asked)
    assert "train-rows" not in scored._jdf.queryExecution().toString() and scored.count() == 50
    folded = CountingScorer().out_of_fold(stratified_kfold(train))
    assert "train-rows" not in folded._jdf.queryExecution().toString() and folded.count() == 600


def test_an_interval_is_counted_once_for_all_its_ranks(spark, monkeypatch):
    sizes, table = [], ranks.literal_table
    monkeypatch.setattr(ranks, "literal_table", lambda s, rows, schema: sizes.append(len(rows)) or table(s, rows, schema))
    x = np.random.default_rng(5).normal(size=30_000).round(3)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    wanted = [0, 1, 2, 14_999, 15_000, 29_998, 29_999]
    found = ranks.locate_ranks(df, F.col("x"), [(None, r) for r in wanted])
    ordered = np.sort(x)
    assert [f.value for f in found] == [ordered[r] for r in wanted]
    assert [(f.less, f.equal) for f in found] == [(int((x < f.value).sum()), int((x == f.value).sum())) for f in found]
    assert sizes[0] == 1 and max(sizes) < len(wanted)
