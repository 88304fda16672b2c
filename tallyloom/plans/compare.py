"""Comparisons of noise treatments and of model families, one result row per method."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions import columns as fx
from tallyloom.operators import anomaly, boosting, features as ft, metrics, removal, smoothing as sm
from tallyloom.operators.models import LOGREG_GRID, SVM_GRID, LinearLearner, LogisticLearner, SvmLearner, TreeLearner, fold_scores, side_by_side, timed
from tallyloom.operators.noise import CountingScorer, align_noise, candidate_pool
from tallyloom.operators.ranks import exact_quantiles
from tallyloom.operators.schema import label_list
from tallyloom.operators.split import class_counts, ordered_folds, stratified_kfold
from tallyloom.plans.workflows import evaluate
from tallyloom.runtime import join_rows, literal_table, materialise


class Results:
    """Collects one row per method: counts first, then the metrics, stored as they come."""

    def __init__(self, learner, valid: DataFrame):
        self.learner, self.valid, self.rows = learner, valid, []

    def add(self, method: str, train: DataFrame, removed=0, valid: DataFrame | None = None, weight: str | None = None, extra: tuple[str, ...] = ()):
        learner, valid = self.learner, self.valid if valid is None else valid
        if extra:
            learner, train, valid = with_numbers(learner, train, valid, extra)
        scores, _ = evaluate(learner, train, valid, weight)
        row = scores.select(F.lit(method).alias("method"), F.lit(removed).cast("long").alias("rows_removed"), *metrics.RANKING)
        self.rows.append(materialise(row, "result"))

    def table(self) -> DataFrame:
        return metrics.leaderboard(metrics.union_results(*self.rows), ties=("method",))


BUCKETS = 10


def with_numbers(learner, train: DataFrame, valid: DataFrame, columns: tuple[str, ...]):
    """The learner with further number columns, and the rows as it needs them.

    Linear models take them as they are. The counting scorer takes them as keys, in buckets between the training
    quantiles. Any other learner is an error, since it would silently fit without them.
    """
    if isinstance(learner, LinearLearner):
        return replace(learner, spec=learner.spec.plus(*columns)), train, valid
    if not isinstance(learner, CountingScorer):
        raise TypeError(f"{type(learner).__name__} takes no further number columns")
    buckets = {}
    for c in columns:
        cuts = sorted({v for v in exact_quantiles(train, F.col(c), [i / BUCKETS for i in range(1, BUCKETS)]) if v is not None})
        value = F.col(c)
        buckets[f"{c}_bucket"] = sum(((value > v).cast("int") for v in cuts), F.lit(0))
    return replace(learner, keys=(*learner.keys, *buckets)), train.withColumns(buckets), valid.withColumns(buckets)


def with_signals(train: DataFrame, valid: DataFrame, signal: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Training rows with their signal columns; validation rows get the training medians."""
    joined = materialise(join_rows(train, signal.select("row_id", *columns), "row_id"), "signal")
    return joined, sm.with_constants(valid, sm.signal_medians(joined, columns))


def compare_noise_methods(
    train: DataFrame, valid: DataFrame, noise: DataFrame, learner, mains: tuple[float, ...] = (0.85, 0.9, 0.95),
    contaminations: tuple[float, ...] = (0.03, 0.05, 0.08), trees: int = 200,
) -> DataFrame:
    """Plain refit, residual features, soft labels, and isolation forests per class."""
    out = Results(learner, valid)
    out.add("baseline_retrain", train)
    columns = ["noise_raw", "noise_smooth", "noise_resid"]
    with_sig, valid_sig = with_signals(train, valid, sm.residual_features(sm.scored_signal(noise)), columns)
    out.add("residual_features_raw_smooth_resid", with_sig, valid=valid_sig, extra=tuple(columns))
    aligned = materialise(align_noise(train, noise, ("cv_pred",)), "aligned")
    for s in mains:
        soft = removal.soft_label_duplicate(aligned, s)
        out.add(f"label_smoothing_softdup_{s}", soft.drop("cv_pred"), weight="weight")
    embedded = embed(train, valid, 5000)[0]
    for c, isolated in zip(contaminations, anomaly.isolation_forests_by_class(embedded, contaminations, trees=trees)):
        gone = materialise(isolated, "isolated")
        out.add(f"classaware_iforest_{c}", removal.remove_rows(train, gone), removed=gone.count())
    return out.table()


def embed(train: DataFrame, valid: DataFrame, vocab: int, rank: int = 40) -> tuple[DataFrame, DataFrame]:
    """Embeddings with the label of the training rows, stored."""
    a, b = ft.svd_embedding(train, valid, rank, vocab=vocab)
    return materialise(join_rows(a, train.select("row_id", "category"), "row_id"), "embedding"), materialise(b, "embedding")


def recon_errors(train: DataFrame, valid: DataFrame, kind: str = "network", **options) -> tuple[DataFrame, DataFrame]:
    a, b = embed(train, valid, 4000)
    fit = anomaly.linear_recon_error if kind == "linear" else anomaly.autoencoder_recon_error
    errors = fit(a, b, **options)
    return materialise(errors[0], "errors"), materialise(errors[1], "errors")


def compare_delta_ae_focal(train: DataFrame, valid: DataFrame, noise: DataFrame, learner, autoencoder: str = "network", **options) -> DataFrame:
    """Plain fit, delta features, reconstruction error as feature and as cut, focal weights."""
    out = Results(learner, valid)
    out.add("baseline", train)
    delta = ["noise_delta", "noise_delta_sq"]
    with_delta, valid_delta = with_signals(train, valid, sm.delta_sigma(sm.scored_signal(noise)), delta)
    out.add("delta_sigma_features", with_delta, valid=valid_delta, extra=tuple(delta))
    errors, valid_errors = recon_errors(train, valid, autoencoder, **options)
    with_err = materialise(join_rows(train, errors, "row_id"), "errors")
    out.add("autoencoder_recon_error_feature", with_err, valid=join_rows(valid, valid_errors, "row_id"), extra=("recon_error",))
    kept = materialise(removal.recon_error_threshold(with_err, "recon_error", 0.95), "kept")
    out.add("autoencoder_threshold_95", kept.drop("recon_error"), removed=with_err.count() - kept.count())
    scored = learner.out_of_fold(stratified_kfold(train)).withColumn("weight", fx.focal_weight(F.col("true_label_prob")))
    focal = materialise(scored.select(*train.columns, "weight"), "focal")
    out.add("focal_style_reweight_gamma2", focal, weight="weight")
    return out.table()


def second_stage(
    train: DataFrame, valid: DataFrame, noise: DataFrame, learner, share: float = 0.75, min_keep: int = 40, gates: tuple[float, ...] = (0.25, 0.4, 0.5),
    autoencoder: str = "network", **options,
) -> DataFrame:
    """Class-aware removal, then residual injection, error gates or minority focal weights on top."""
    out = Results(learner, valid)
    pool = candidate_pool(noise).withColumn("x", F.round(fx.base_score(F.col("true_label_prob"), F.col("flagged_suspicious")), 9))
    pool = materialise(pool, "pool")
    drop = removal.class_aware_removal(class_counts(train, "category"), pool, "x", [(share, min_keep)])[0]
    gone = materialise(pool.where(drop).select("row_id"), "gone")
    n_gone = gone.count()
    kept = materialise(removal.remove_rows(train, gone), "kept")
    out.add("winner_baseline_classaware", kept, n_gone)
    injected = sm.residual_injection(sm.scored_signal(noise))
    all_rows, valid_rows = with_signals(train, valid, injected, ["resid_injected"])
    out.add("residual_injection_low_weight", removal.remove_rows(all_rows, gone), n_gone, valid_rows, extra=("resid_injected",))
    errors, _ = recon_errors(train, valid, autoencoder, **options)
    marked = materialise(join_rows(gone, errors, "row_id"), "marked")
    for q in gates:
        gated = materialise(removal.error_gating(marked, "recon_error", q).select("row_id"), "gated")
        out.add(f"error_gating_ae_q{q}", removal.remove_rows(train, gated), gated.count())
    rare = [r["category"] for r in metrics.minority_classes(kept).collect()]
    scored = learner.out_of_fold(stratified_kfold(kept))
    focal = scored.withColumn("weight", fx.minority_focal_weight(F.col("true_label_prob"), F.col("category").isin(rare)))
    out.add("focal_minority_on_cleaned", materialise(focal.select(*train.columns, "weight"), "focal"), n_gone, weight="weight")
    return out.table()


CELLS: dict[str, tuple[bool, bool]] = {
    "baseline": (True, False),
    "class_weighted": (True, True),
    "no_description": (False, False),
    "no_description_weighted": (False, True),
}


def tune_trees(train: DataFrame, learner: TreeLearner, grid: list[dict], k: int = 5) -> DataFrame:
    """Tuning trace: fold scores and best rounds of every setting, best first.

    The folds are encoded in the same jobs, and every (setting, fold) is one run of one job, scored on its
    held-out fold after every round. All rows are in it, counted by what a fit sees of them.
    """
    labels = label_list(train, label=learner.label)
    narrow = train.select("row_id", *learner.columns, learner.number, learner.label)
    folds = materialise(stratified_kfold(narrow, learner.label, k=k), "folds")
    copies = folds.withColumn("outer", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    inside = F.col("fold") != F.col("outer")
    own, asked = learner.rounded(copies.where(inside).drop("fold"), copies.where(~inside).drop("fold"), "outer")
    own = learner.counted(stratified_kfold(own, learner.label, seed=learner.seed, by=("outer",)), ("outer", "fold"))
    own, asked = learner.encode(own, learner.counted(asked, ("outer",)), labels, by=("outer",), times="n")
    both = own.drop("fold").withColumn("held", F.lit(False)).unionByName(asked.withColumn("held", F.lit(True)))
    rows = learner.growable(both, labels, part=F.col("outer"), held=F.col("held"), times="n")
    cells = [(f, replace(learner, **setting)) for setting in grid for f in range(k)]
    runs = [model.run(labels, f) for f, model in cells]
    grown = boosting.grow_runs(rows, runs, len(labels), keep_trees=False)
    names = [{"run": i, "learning_rate": float(m.rate), "depth": int(m.depth), "fold": f} for i, (f, m) in enumerate(cells)]
    table = literal_table(train.sparkSession, names, "run int, learning_rate double, depth int, fold int")
    best = metrics.best_round(F.col("best"), learner.rounds).cast("int").alias("best_iteration")
    scores = grown.join(table, "run").select("learning_rate", "depth", "fold", F.array_max("curve").alias("weighted_f1"), best)
    return metrics.cv_trace(scores).orderBy(F.desc("mean_weighted_f1"), "learning_rate", "depth")


def ablation_2x2(
    train: DataFrame, valid: DataFrame, learner: TreeLearner, seeds: list[int] | None = None, cells: dict[str, tuple[bool, bool]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(nested metrics per cell over seeds, per-class report of the first seed per cell).

    A seed deals the folds of the label rates anew. All seeds are encoded in the same jobs, and all cells of all
    seeds are grown in one. The training time of a run is that of its own task and its share of the encoding. All rows are
    in it, counted by what a fit sees of them.
    """
    seeds, cells = seeds or fixed.ABLATION_SEEDS, cells or CELLS
    labels, own_labels = label_list(train, valid, label=learner.label), label_list(train, label=learner.label)
    per_seed = F.explode(F.array(*[F.lit(s) for s in seeds])).alias("seed")

    def encode() -> tuple[DataFrame, DataFrame]:
        own, asked = learner.rounded(*[df.select("row_id", *learner.columns, learner.number, learner.label) for df in (train, valid)])
        folded = stratified_kfold(own.select("*", per_seed), learner.label, seed=learner.seed, by=("seed",))
        return learner.encode(learner.counted(folded, ("seed", "fold")), learner.counted(asked).select("*", per_seed), own_labels, by=("seed",), times="n")

    (own, asked), encode_seconds = timed(encode)
    names, runs = [], []
    for seed in seeds:
        for cell, (text, weighted) in cells.items():
            places = learner.places(own_labels, None if text else tuple(c for c in learner.columns if c != "description"))
            names.append({"run": len(runs), "run_name": cell, "seed": seed, "model": f"{cell}:{seed}"})
            runs.append(replace(learner, balanced=weighted).run(own_labels, seed, places))
    grown = boosting.grow_runs(learner.growable(own, own_labels, part=F.col("seed"), times="n"), runs, len(own_labels))
    models = dict(zip([n["model"] for n in names], boosting.ensembles(grown, runs, len(own_labels))))
    table = literal_table(train.sparkSession, names, "run int, run_name string, seed int, model string")
    dealt = asked.join(table, "seed").repartition(train.sparkSession.sparkContext.defaultParallelism)  # few bytes, but a row costs rounds x depth
    scored = boosting.predict(dealt, models, own_labels, learner.label, ["run_name", "seed", learner.label, "n"])
    preds = materialise(scored.withColumnRenamed("cv_pred", "prediction"), "preds")
    spent = (F.col("seconds") + encode_seconds / len(runs)).alias("training_time_seconds")
    scores = metrics.classification_metrics(preds, learner.label, by=("run_name", "seed"), times="n")
    result = scores.join(grown.join(table, "run").select("run_name", "seed", spent), ["run_name", "seed"])
    nested = metrics.seed_aggregate(materialise(result, "ablation"), [*metrics.RANKING, "training_time_seconds"], ("run_name",))
    return nested, metrics.per_class_report(preds.where(F.col("seed") == seeds[0]), labels, learner.label, by=("run_name",))


def compare_models(
    train: DataFrame, valid: DataFrame, tree_cells: DataFrame | None = None, svm: SvmLearner | None = None, logreg: LogisticLearner | None = None,
    svm_grid: list[dict] | None = None, logreg_grid: list[dict] | None = None, cells: dict[str, tuple[bool, bool]] | None = None, parallelism: int = 4,
) -> DataFrame:
    """One row per (model, cell); linear models are tuned on three unshuffled folds inside the cell.

    Cells that see the same columns share their features, and all their settings, of both families, the scans of a
    fold; so do their final fits. A cell's training time is its share of that work.
    """
    folds = materialise(ordered_folds(train, k=3), "folds")
    families = {"SVM": (svm or SvmLearner(), svm_grid or SVM_GRID), "LogReg": (logreg or LogisticLearner(), logreg_grid or LOGREG_GRID)}
    by_text: dict[bool, list[tuple[str, bool]]] = {}
    for cell, (text, weighted) in (cells or CELLS).items():
        by_text.setdefault(text, []).append((cell, weighted))
    rows = []
    for text, own in by_text.items():
        spec = ft.ONE_HOT if text else ft.ONE_HOT_NO_TEXT
        groups = [(name, cell, [replace(base, spec=spec, balanced=weighted, **g) for g in grid]) for name, (base, grid) in families.items() for cell, weighted in own]
        scores, seconds = timed(lambda groups=groups: _tuned(train, valid, folds, groups, parallelism))
        for (name, cell, _), score in zip(groups, scores):
            spent = F.lit(seconds / len(groups)).alias("training_time_seconds")
            rows.append(score.select(F.lit(name).alias("model"), F.lit(cell).alias("cell"), *metrics.RANKING, spent, F.lit(1).alias("seeds_run")))
    if tree_cells is not None:
        means = [F.col(f"{m}.mean").alias(m) for m in (*metrics.RANKING, "training_time_seconds")]
        rows.append(tree_cells.select(F.lit("Trees").alias("model"), F.col("run_name").alias("cell"), *means, F.size("accuracy.values").alias("seeds_run")))
    return metrics.union_results(*rows)


def _tuned(train: DataFrame, valid: DataFrame, folds: DataFrame, groups: list[tuple[str, str, list[LinearLearner]]], parallelism: int):
    """One row of metrics on the validation rows for the best setting of every group; all see the same columns."""
    settings = [m for *_, models in groups for m in models]

    def one(f: int) -> DataFrame:
        return fold_scores(settings, folds.where(F.col("fold") != f).drop("fold"), folds.where(F.col("fold") == f).drop("fold"))

    parts = side_by_side([lambda f=f: one(f) for f in range(3)], parallelism)
    means = {r["run"]: r["m"] for r in metrics.union_results(*parts).groupBy("run").agg(F.round(F.avg("weighted_f1"), 12).alias("m")).collect()}
    best, at = [], 0
    for *_, models in groups:
        places = range(at, at + len(models))
        best.append(settings[max(places, key=lambda i: (means[i], -i))])
        at += len(models)
    scores = fold_scores(best, train, valid)
    return [scores.where(F.col("run") == i) for i in range(len(best))]
