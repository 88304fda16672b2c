"""Tree rounds work on groups of rows alike, and scans of a table of few bytes use the cores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import boosting, models as md


def test_a_round_works_on_groups_of_rows(monkeypatch):
    rng = np.random.default_rng(4)
    x, y, w = rng.integers(0, 6, (2000, 3)).astype(float), rng.integers(0, 3, 2000), rng.random(2000) + 0.5
    lengths, level = [], boosting._Level
    monkeypatch.setattr(boosting, "_Level", lambda codes, sizes: lengths.append(len(codes[0])) or level(codes, sizes))
    run = boosting.Run(0, 0.3, 3, 8)
    model, curve = boosting.grow(x, y, w, 3, run, (x[:300], y[:300]))
    assert lengths == [len(np.unique(x, axis=0))]
    for n in (1, 8):
        assert curve[n - 1] == pytest.approx(boosting.weighted_f1(y[:300], model.first(n).raw(x[:300]).argmax(axis=1), 3))


def test_rows_alike_have_equal_codes():
    rng = np.random.default_rng(6)
    codes = [rng.integers(0, 40, 500) for _ in range(2)] + [rng.integers(0, 2, 500) * 39 for _ in range(14)]  # the product passes 63 bits
    group, first = boosting.alike(codes, [40] * 16, 500)
    table = np.stack(codes, axis=1)
    assert (table[first][group] == table).all() and len(first) == len(np.unique(table, axis=0))


def test_scans_of_few_bytes_use_the_cores(spark):
    named = {"description": F.concat(F.lit("s"), (F.col("id") % 7).cast("string")), "category": F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))}
    train = spark.range(10_000).withColumns({**named, "transaction_type": F.lit("t"), "account_name": F.lit("x"), "amount": F.col("id").cast("double")}).withColumnRenamed("id", "row_id")
    ready = md.SvmLearner().prepare(train)
    assert ready.data.count() == 10_000 and ready.data.rdd.getNumPartitions() == 3
    assert md.SvmLearner().prepare(train.limit(500)).data.rdd.getNumPartitions() == 1
