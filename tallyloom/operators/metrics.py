"""Confusion counts, class reports, scores per run, and tables over runs.

Every metric comes from (run, actual, predicted) counts, so one map-side aggregate over the
predictions is the only step that touches rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.runtime import literal_table


def prediction_counts(preds: DataFrame, label: str = "category", predicted: str = "prediction", by: tuple[str, ...] = (), times: str | None = None) -> DataFrame:
    """Rows per (actual, predicted); a row stands for ``times`` rows, if named."""
    n = F.count("*") if times is None else F.sum(times)
    return preds.groupBy(*by, F.col(label).alias("actual"), F.col(predicted).alias("predicted")).agg(n.alias("n"))


def confusion_matrix(preds: DataFrame, labels: list[str], label: str = "category", predicted: str = "prediction") -> DataFrame:
    """Count for every pair of the label list, zero where none occurs."""
    names = F.array(*[F.lit(x) for x in labels])
    grid = literal_table(preds.sparkSession, [{"actual": x} for x in labels], "actual string")
    grid = grid.select("actual", F.explode(names).alias("predicted"))
    counts = prediction_counts(preds, label, predicted)
    return grid.join(counts, ["actual", "predicted"], "left").select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def _per_label(counts: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """support, predicted count and hits per label that occurs as actual or predicted."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    views = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), zero.alias("predicted_n"), hit.cast("long").alias("hits")),
        F.struct(F.col("predicted").alias("label"), zero.alias("support"), F.col("n").alias("predicted_n"), zero.alias("hits")),
    )
    cells = counts.select(*by, F.explode(views).alias("v")).select(*by, "v.*")
    sums = cells.groupBy(*by, "label").agg(*[F.sum(c).cast("long").alias(c) for c in ("support", "predicted_n", "hits")])
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return sums.select(
        *by,
        "label",
        "support",
        "hits",
        ratio(F.col("hits"), F.col("predicted_n")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("support") + F.col("predicted_n")).alias("f1"),
    )


def classification_metrics(preds: DataFrame, label: str = "category", predicted: str = "prediction", by: tuple[str, ...] = (), times: str | None = None) -> DataFrame:
    """accuracy, weighted F1 and macro F1, one row per run."""
    return scores_from_counts(prediction_counts(preds, label, predicted, by, times), by)


def scores_from_counts(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    per = _per_label(counts, by)
    total = F.sum("support")
    return per.groupBy(*by).agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("weighted_f1"),
        F.avg("f1").alias("macro_f1"),
    )


def per_class_report(
    preds: DataFrame, labels: list[str], label: str = "category", predicted: str = "prediction", by: tuple[str, ...] = (), times: str | None = None
) -> DataFrame:
    """precision, recall, F1 and support for each listed label, then the macro and the weighted average."""
    per = _per_label(prediction_counts(preds, label, predicted, by, times), by)
    names = literal_table(preds.sparkSession, [{"label": x} for x in labels], "label string")
    if by:
        names = preds.select(*by).distinct().withColumn("label", F.explode(F.array(*[F.lit(x) for x in labels])))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    rows = names.join(per, [*by, "label"], "left").select(
        *by,
        "label",
        *[zero(F.col(c)).alias(c) for c in ("precision", "recall", "f1")],
        F.coalesce("support", F.lit(0)).cast("long").alias("support"),
    )
    parts = ("precision", "recall", "f1")
    total = F.sum("support")
    macro = rows.groupBy(*by).agg(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in parts], total.alias("support"))
    weighted = rows.groupBy(*by).agg(
        F.lit("weighted avg").alias("label"),
        *[F.coalesce(F.sum(F.col(c) * F.col("support")) / F.nullif(total, F.lit(0)), F.lit(0.0)).alias(c) for c in parts],
        total.alias("support"),
    )
    columns = [*by, "label", *parts, "support"]
    return rows.unionByName(macro.select(*columns)).unionByName(weighted.select(*columns))


def seed_aggregate(runs: DataFrame, metrics: list[str], by: tuple[str, ...] = (), seed: str = "seed") -> DataFrame:
    """mean, population deviation and the values in seed order for every metric."""
    out = []
    for m in metrics:
        values = F.transform(F.array_sort(F.collect_list(F.struct(F.col(seed).alias("s"), F.col(m).alias("v")))), lambda x: x["v"])
        out.append(F.struct(F.avg(m).alias("mean"), F.stddev_pop(m).alias("std"), values.alias("values")).alias(m))
    return runs.groupBy(*by).agg(*out)


def cv_trace(fold_runs: DataFrame, config: tuple[str, ...] = ("learning_rate", "depth")) -> DataFrame:
    """Per configuration: fold scores, their mean and deviation, and the truncated median best round."""
    listed = lambda c: F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("fold").alias("f"), F.col(c).alias("v")))), lambda x: x["v"]
    )
    return fold_runs.groupBy(*config).agg(
        F.avg("weighted_f1").alias("mean_weighted_f1"),
        F.stddev_pop("weighted_f1").alias("std_weighted_f1"),
        listed("weighted_f1").alias("fold_scores"),
        F.median("best_iteration").cast("int").alias("median_best_iteration"),
        listed("best_iteration").alias("fold_best_iterations"),
    )


def best_round(best_iteration: Column, cap: int = 1000) -> Column:
    """The stored best round, where a missing one or round 0 reads as the cap."""
    return F.coalesce(F.nullif(best_iteration, F.lit(0)), F.lit(cap))


def final_rounds(trace: DataFrame, least: int = 100) -> DataFrame:
    """The winning configuration and the number of rounds for the final fit."""
    best = trace.orderBy(F.round("mean_weighted_f1", 9).desc(), "learning_rate", "depth").limit(1)
    return best.withColumn("iterations", F.greatest(F.col("median_best_iteration"), F.lit(least)))


def minority_classes(train: DataFrame, label: str = "category", share: float = 0.3) -> DataFrame:
    """The rarest max(1, share * k) classes; the class-count table is all that is ranked."""
    counts = train.groupBy(label).agg(F.count("*").alias("n"))
    ranked = counts.withColumn("rn", F.row_number().over(Window.orderBy("n", label))).withColumn("k", F.count("*").over(Window.partitionBy()))
    return ranked.where(F.col("rn") <= F.greatest(F.lit(1), F.floor(F.col("k") * F.lit(share)))).select(label, "n")


RANKING = ("weighted_f1", "macro_f1", "accuracy")


def leaderboard(results: DataFrame, by: tuple[str, ...] = RANKING, ties: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """Best runs first. Scores are ranked to nine digits, so the order of additions cannot decide."""
    ordered = results.orderBy(*[F.round(F.col(c), 9).desc() for c in by], *ties)
    return ordered if limit is None else ordered.limit(limit)


def best_per_method(results: DataFrame, method: str = "method", ties: tuple[str, ...] = ()) -> DataFrame:
    """The best run of each method as one partial aggregate; ``ties`` break equal scores, smallest first."""
    rest = [c for c in results.columns if c not in (method, "weighted_f1", "macro_f1", *ties)]
    key = F.struct((-F.round("weighted_f1", 9)).alias("w"), (-F.round("macro_f1", 9)).alias("m"), *ties)
    best = results.groupBy(method).agg(F.min_by(F.struct("weighted_f1", "macro_f1", *ties, *rest), key).alias("b"))
    return best.select(method, "b.*").select(*results.columns)


def best_macro(results: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    return leaderboard(results, ("macro_f1", "weighted_f1", "accuracy"), ties, 1)


def union_results(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
