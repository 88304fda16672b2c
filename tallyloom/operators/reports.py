"""Report tables over run results: pivots, deltas, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.operators.metrics import leaderboard


def metrics_to_long(record: DataFrame, metrics: list[str], keys: list[str] | None = None) -> DataFrame:
    return record.select(*(keys or []), *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(keys or [], metrics, "metric", "value")


def metrics_from_long(long: DataFrame, metrics: list[str], keys: list[str] | None = None) -> DataFrame:
    return long.groupBy(*(keys or [])).pivot("metric", metrics).agg(F.first("value"))


def cv_grid_matrix(trace: DataFrame, rates: list[float] | None = None) -> DataFrame:
    """depth by learning-rate matrix of the mean score."""
    listed = trace.withColumn("rate", F.concat(F.lit("rate_"), F.col("learning_rate").cast("string")))
    names = [f"rate_{r}" for r in (rates or fixed.TREE_RATES)]
    return listed.groupBy("depth").pivot("rate", names).agg(F.first("mean_weighted_f1")).orderBy("depth")


def metric_by_cell(comparison: DataFrame, metric: str, models: list[str], cells: list[str] | None = None) -> DataFrame:
    """cell by model table in the fixed order of the cells."""
    order = F.array_position(F.array(*[F.lit(c) for c in (cells or fixed.ABLATION_CELLS)]), F.col("cell"))
    wide = comparison.groupBy("cell").pivot("model", models).agg(F.first(metric))
    return wide.withColumn("cell_order", order.cast("int")).where("cell_order > 0").orderBy("cell_order")


def per_class_f1_by_model(reports: DataFrame, models: list[str]) -> DataFrame:
    """class by model F1; a class that a model's report lacks counts 0. Average rows are left out."""
    classes = reports.where(~F.col("label").isin("macro avg", "weighted avg"))
    wide = classes.groupBy("label").pivot("model", models).agg(F.first("f1"))
    return wide.select("label", *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in models])


def per_class_f1_delta(base: DataFrame, other: DataFrame) -> DataFrame:
    """F1 of ``other`` minus F1 of ``base`` per class, rare classes first."""
    a = base.select("label", F.col("f1").alias("f1_a"), F.col("support").alias("support_a"))
    b = other.select("label", F.col("f1").alias("f1_b"))
    joined = a.join(b, "label", "full").where(~F.col("label").isin("macro avg", "weighted avg"))
    delta = F.coalesce("f1_b", F.lit(0.0)) - F.coalesce("f1_a", F.lit(0.0))
    return joined.select("label", delta.alias("f1_delta"), F.coalesce("support_a", F.lit(0)).cast("long").alias("support")).orderBy("support", "label")


def ablation_summary(cells: DataFrame) -> DataFrame:
    """One line per cell from the nested means and deviations."""
    return cells.select(
        F.col("run_name").alias("run"),
        F.col("weighted_f1.mean").alias("weighted_f1_mean"),
        F.col("weighted_f1.std").alias("weighted_f1_std"),
        F.col("macro_f1.mean").alias("macro_f1_mean"),
        F.col("accuracy.mean").alias("accuracy_mean"),
        F.col("training_time_seconds.mean").alias("training_time_mean"),
    )


def comparison_summary(comparison: DataFrame) -> DataFrame:
    return comparison.select("model", "cell", "weighted_f1", "macro_f1", "accuracy", "training_time_seconds", "seeds_run")


def compiled_scorecard(runs: list[tuple[str, str, str, DataFrame]]) -> DataFrame:
    """The best line of every (run, source, note, results) set, ordered by weighted F1."""
    card = None
    for run, source, note, results in runs:
        best = leaderboard(results, limit=1)
        line = best.select(F.lit(run).alias("run"), F.lit(source).alias("source"), "accuracy", "weighted_f1", "macro_f1", F.lit(note).alias("notes"))
        card = line if card is None else card.unionByName(line)
    return leaderboard(card, ("weighted_f1",), ("run",))
