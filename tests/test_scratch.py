"""What jobs leave behind in the shared folder."""

from pathlib import Path

import pytest
from conftest import SF_DIR

from tallyloom.operators import anomaly
from tallyloom.operators.noise import CountingScorer
from tallyloom.plans import workflows as wf
from tallyloom.registry.base import train_valid
from tallyloom.registry.evaluation import training_noise
from tallyloom.runtime import materialise, scratch_root, tidy


def stored(spark):
    return set(Path(scratch_root(spark).removeprefix("file:") + "/tallyloom").glob("*"))


def test_a_sweep_leaves_its_results_only(spark):
    train, valid = train_valid(spark, SF_DIR)
    noise = training_noise(spark, SF_DIR)
    before = stored(spark)
    results, best = wf.sweep_filters(train, valid, noise, CountingScorer(), caps=[0.1])
    left = stored(spark) - before
    assert len(left) == 1 and results.count() == len(wf.filter_signals(noise)) and best.count() > 1


def test_nothing_is_left_after_an_error(spark):
    @tidy
    def job(outer):
        materialise(spark.range(3), "inside")
        if outer:
            return tidy(lambda: job(False))()
        raise ValueError("broken")

    materialise(spark.range(1), "first")
    before = stored(spark)
    with pytest.raises(ValueError):
        job(True)
    assert stored(spark) == before


def test_parts_of_a_class_are_scored_as_the_whole(spark, monkeypatch):
    rows = [(i, [float(i % 17), float(i % 5), 40.0 if i % 50 == 0 else 0.0], "a" if i % 3 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, "row_id long, embedding array<double>, category string")
    once = {tuple(r) for r in anomaly.isolation_forest_by_class(df, 0.05, trees=20).collect()}
    monkeypatch.setattr(anomaly, "PART_ROWS", 50)
    assert {tuple(r) for r in anomaly.isolation_forest_by_class(df, 0.05, trees=20).collect()} == once and once
