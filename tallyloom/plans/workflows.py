"""The jobs a user calls: filter, relabel, sweep, clean in rounds, compare.

All take a learner; with the counting scorer many runs share one job, with a linear learner the scans of
its fits. Runs are described by rows of a result DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions import columns as fx
from tallyloom.operators import metrics, relabel, removal, scaling, smoothing as sm
from tallyloom.operators.models import LinearLearner
from tallyloom.operators.noise import NARROW_KEYS, CountingScorer, align_noise, combined_runs, dropped_per_run, nested_marks, repeated_scores
from tallyloom.operators.split import class_counts, folds_by_seed, stratified_kfold
from tallyloom.runtime import discard, join_rows, literal_table, materialise, tidy

METRICS = ("accuracy", "weighted_f1", "macro_f1")
KEYS = list(NARROW_KEYS)


def evaluate(learner, train: DataFrame, valid: DataFrame, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row of metrics, validation rows with ``prediction``)."""
    preds = learner.fit_score(train, valid, weight).withColumnRenamed("cv_pred", "prediction")
    return metrics.classification_metrics(preds), preds


def evaluate_runs(learner, train: DataFrame, valid: DataFrame, runs: list[tuple[dict, Column]], schema: str, chains: list[list[int]] | None = None) -> DataFrame:
    """Metrics of one fit per (parameters, rows to leave out); rows are left out by a condition on ``train``.

    ``chains`` groups runs whose conditions are nested, smallest first; without it every run stands alone.
    """
    drops, chains = [d for _, d in runs], chains or [[i] for i in range(len(runs))]
    marks = nested_marks(drops, chains).alias("marks")
    counting = isinstance(learner, CountingScorer)
    marked = materialise(train.select(*learner.keys, learner.label, marks), "marks") if counting else train.select(marks)
    n, removed = dropped_per_run(marked, chains)
    lines = [{**params, "run": i, "rows_removed": removed[i], "rows_kept": n - removed[i]} for i, (params, _) in enumerate(runs)]
    table = literal_table(train.sparkSession, lines, f"run int, rows_removed long, rows_kept long, {schema}")
    if counting:
        scores = metrics.scores_from_counts(learner.count_runs(marked, valid, chains), ("run",))
    elif isinstance(learner, LinearLearner):
        scores = metrics.scores_from_counts(learner.count_runs(train, valid, drops), ("run",))
    else:
        scores = None
        for i, drop in enumerate(drops):
            row = evaluate(learner, train.where(~drop), valid)[0].select(F.lit(i).alias("run"), *METRICS)
            row = materialise(row, "run")
            scores = row if scores is None else scores.unionByName(row)
    return scores.join(table, "run").drop("run")


def score_training_rows(train: DataFrame, learner, k: int = 5, seed: int = 42) -> DataFrame:
    """Out-of-fold scores with the wrong flag and the rank score."""
    scored = learner.out_of_fold(stratified_kfold(train, k=k, seed=seed), k)
    wrong = (F.col("cv_pred") != F.col("category")).cast("int")
    flagged = scored.drop("fold").withColumn("wrong_flag", wrong)
    return materialise(flagged.withColumn("rank_score", F.round(fx.rank_score(F.col("true_label_prob"), F.col("wrong_flag")), 9)), "scores")


def run_relabel(train: DataFrame, valid: DataFrame, learner, min_dominance: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Dominant relabel, one fit, metrics with the number of changed labels."""
    changed = materialise(relabel.relabel_dominant(train, KEYS, min_dominance), "relabel")
    scores, preds = evaluate(learner, changed.drop("category_original", "label_changed"), valid)
    count = changed.agg(F.count_if("label_changed")).scalar()
    return scores.withColumn("rows_relabelled", count), preds


def run_suspicious_filter(train: DataFrame, valid: DataFrame, learner, threshold: float = fixed.SUSPICIOUS_PROB, k: int = 5, seed: int = 42):
    """(metrics, noise scores, predictions) after leaving out suspicious rows."""
    noise = score_training_rows(train, learner, k, seed).drop("rank_score")
    noise = noise.withColumn("flagged_suspicious", fx.flag_suspicious(F.col("category"), F.col("cv_pred"), F.col("true_label_prob"), threshold))
    kept = noise.where(~F.col("flagged_suspicious")).select(*train.columns)
    scores, preds = evaluate(learner, kept, valid)
    return scores.withColumn("rows_removed", noise.agg(F.count_if("flagged_suspicious")).scalar()), noise, preds


def run_repeated_filter(train: DataFrame, valid: DataFrame, learner, seeds: list[int] | None = None, min_wrong: int = 2, threshold: float = fixed.SUSPICIOUS_PROB):
    """(metrics, combined scores, predictions) with scores of several fold seeds."""
    seeds = seeds or fixed.REPEAT_SEEDS
    if isinstance(learner, CountingScorer):
        scored = learner.out_of_folds(materialise(folds_by_seed(train, seeds), "folded"), seeds)
        combined = combined_runs(scored, min_wrong=min_wrong, threshold=threshold)
    else:
        runs = None
        for s in seeds:
            part = learner.out_of_fold(stratified_kfold(train, seed=s)).drop("fold").withColumn("seed", F.lit(s))
            runs = part if runs is None else runs.unionByName(part)
        features = [c for c in train.columns if c not in ("row_id", "category")]
        combined = repeated_scores(runs, features, min_wrong=min_wrong, threshold=threshold)
    combined = materialise(combined, "scores")
    kept = combined.where(~F.col("flagged_suspicious")).select(*train.columns)
    scores, preds = evaluate(learner, kept, valid)
    return scores.withColumn("rows_removed", combined.agg(F.count_if("flagged_suspicious")).scalar()), combined, preds


def run_capped_filter(train: DataFrame, valid: DataFrame, learner, caps: list[float] | None = None):
    """(result per cap, noise scores, report of the best cap)."""
    caps = caps or fixed.CAP_FRACTIONS
    noise = score_training_rows(train, learner)
    drops = removal.cap_removal(noise, "rank_score", caps)
    results = materialise(evaluate_runs(learner, noise, valid, [({"cap_fraction": c}, d) for c, d in zip(caps, drops)], "cap_fraction double", [_growing(0, caps)]), "caps")
    best = metrics.leaderboard(results, ("weighted_f1",), ("cap_fraction",)).first()["cap_fraction"]
    kept = noise.where(~drops[caps.index(best)]).select(*train.columns)
    labels = sorted(class_counts(valid, "category"))
    report = metrics.per_class_report(evaluate(learner, kept, valid)[1], labels)
    return metrics.leaderboard(results, ("weighted_f1",), ("cap_fraction",)), noise, report


def review_suspicious(noise: DataFrame, rules=None, n: int = 300, mode: str = "rank") -> tuple[DataFrame, DataFrame]:
    """(top rows with keyword corrections, likely mislabelled rows)."""
    from tallyloom.operators.noise import likely_mislabeled

    ranked = noise if "rank_score" in noise.columns else noise.withColumn("rank_score", fx.rank_score(F.col("true_label_prob"), F.col("wrong_flag")))
    top = relabel.top_suspicious(ranked, n, mode, rank="rank_score")
    return relabel.keyword_rule_relabel(top, rules), likely_mislabeled(ranked)


def apply_review(train: DataFrame, reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train with the reviewed labels, log); an unknown row id is an error."""
    changed = reviewed.where("label_changed").withColumn("seq", F.lit(0))
    return relabel.apply_corrections(train, changed, on_bad="error")


def iterative_clean(
    train: DataFrame,
    valid: DataFrame,
    learner,
    configs: list[tuple[int, float]] | None = None,
    max_rounds: int = 10,
    target_weighted: float = 0.20,
    target_macro: float = 0.12,
    min_count: int = 5,
    merchants: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(history, best training rows): merchant corrections, refit, keep what improves.

    A round tries every configuration and keeps the one with the best weighted F1 if that rises and
    macro F1 does not fall. Each round starts from written tables, so plans do not grow.
    """
    spark = train.sparkSession
    current = materialise(train, "round")
    result, noise, _ = run_suspicious_filter(current, valid, learner)
    best = result.first().asDict()
    reached = lambda m: m["weighted_f1"] >= target_weighted and m["macro_f1"] >= target_macro
    history = [{"round": 0, "applied_corrections": 0, **best, "accepted": True, "target_reached": reached(best)}]
    if reached(best):
        history[0]["stop_reason"] = "target_reached_at_round_0"
        max_rounds = 0
    for rnd in range(1, max_rounds + 1):
        trials = []
        for idx, (top_n, purity) in enumerate(configs or fixed.ROUND_CONFIGS, start=1):
            rules = relabel.whitelist_merchants(relabel.merchant_purity(noise, min_count, purity), merchants)
            top = relabel.top_suspicious(noise, top_n, wrong="flagged_suspicious")
            changed = relabel.merchant_rule_relabel(top, rules).where("label_changed").withColumn("seq", F.lit(0))
            changed = materialise(changed, "changed")
            updated, log = relabel.apply_corrections(current, changed)
            applied = log.count()
            if applied == 0:
                discard(changed)
                continue
            updated = materialise(updated, "round")
            scores, scored, _ = run_suspicious_filter(updated, valid, learner)
            trials.append({"idx": idx, "top_n": top_n, "purity": purity, "applied": applied, "m": scores.first().asDict(), "train": updated, "noise": scored, "changed": changed})
        if not trials:
            history.append({"round": rnd, "applied_corrections": 0, **best, "accepted": False, "target_reached": reached(best), "stop_reason": "no_new_obvious_corrections_any_config"})
            break
        for t in trials:
            discard(t.pop("changed"))
        pick = max(trials, key=lambda t: (round(t["m"]["weighted_f1"], 9), -t["idx"]))
        m = pick["m"]
        accepted = round(m["weighted_f1"] - best["weighted_f1"], 9) > 0 and round(m["macro_f1"] - best["macro_f1"], 9) >= 0
        history.append(
            {"round": rnd, "config_idx": pick["idx"], "top_n": pick["top_n"], "min_purity": pick["purity"], "applied_corrections": pick["applied"], **m, "accepted": accepted, "target_reached": reached(m)}
        )
        for t in trials:
            if t is not pick or not accepted:
                discard(t["train"], t["noise"])
        if not accepted:
            break
        discard(current)
        current, noise, best = pick["train"], pick["noise"], m
        if reached(best):
            break
    schema = (
        "round int, config_idx int, top_n int, min_purity double, applied_corrections long, accuracy double, weighted_f1 double, macro_f1 double, "
        "rows_removed long, accepted boolean, target_reached boolean, stop_reason string"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(h.get(c) for c in names) for h in history], schema), current


def _attach(df: DataFrame, *scores: DataFrame) -> DataFrame:
    """Add score columns by row id; both sides are written tables with unique ids."""
    for s in scores:
        df = join_rows(df, s, "row_id")
    return df


def filter_signals(noise: DataFrame, flag: str = "wrong_flag") -> list[tuple[str, str, DataFrame]]:
    """(method, parameters, row_id + score) for the raw score and the smoothers, in row order."""
    sig = sm.scored_signal(noise, flag, "file")
    out: list[tuple[str, str, DataFrame]] = [("raw", "none", sig.df.withColumnRenamed("x", "smooth"))]
    out += [("median", f"kernel={k}", sm.smooth_median(sig, k)) for k in fixed.MEDIAN_KERNELS]
    out += [("savgol", f"window={w},poly={p}", sm.smooth_savgol(sig, w, p)) for w, p in fixed.SAVGOL_SHAPES]
    out += [("kalman", f"q={q},r={r}", sm.smooth_kalman(sig, q, r)) for q, r in fixed.KALMAN_PAIRS]
    out += [("whittaker", f"lambda={lam}", sm.smooth_whittaker(sig, lam)) for lam in fixed.WHITTAKER_LAMBDAS]
    return [(m, p, df.select("row_id", F.round("smooth", 9).alias("score"))) for m, p, df in out]


def hybrid_signals(noise: DataFrame) -> list[tuple[str, DataFrame]]:
    """Smoothers over the score order, with the raw score beside them."""
    sig = sm.scored_signal(noise)
    ways: list[tuple[str, Callable]] = [
        ("raw", lambda: sig.df.withColumn("smooth", F.col("x"))),
        ("median", lambda: sm.smooth_median(sig, 7)),
        ("savgol", lambda: sm.smooth_savgol(sig, 15, 3)),
        ("kalman", lambda: sm.smooth_kalman(sig, 1e-4, 1e-2)),
        ("whittaker", lambda: sm.smooth_whittaker(sig, 50.0)),
    ]
    return [(name, make().select("row_id", "x", "smooth")) for name, make in ways]


def advanced_signals(noise: DataFrame, optional: bool = False, lowess_span: int | None = None) -> list[tuple[str, DataFrame]]:
    """The ``optional`` ones take longer: the local regression costs rows times ``lowess_span`` rows, which is
    the published twentieth of all rows unless given."""
    sig = sm.scored_signal(noise)
    span = lowess_span or sm.lowess_span(sig.n)
    ways: list[tuple[str, Callable]] = [
        ("savgol_w21_p6", lambda: sm.smooth_savgol(sig, 21, 6)),
        ("filtfilt_fir17_c015", lambda: sm.smooth_zero_phase_fir(sig)),
        ("trimmed_mean_k9_t02", lambda: sm.smooth_trimmed_mean(sig, 9, 0.2)),
        ("gauss_sigma2", lambda: sm.smooth_gaussian(sig, 2.0)),
        ("median_k7", lambda: sm.smooth_median(sig, 7)),
        ("zscore_raw", lambda: scaling.zscore(sig.df, "x", "smooth")),
    ]
    if optional:
        ways += [
            ("wavelet_db4_l3", lambda: sm.smooth_wavelet(sig, 3)),
            ("lowess_f005_it2", lambda: sm.smooth_lowess(sig, span)),
        ]
    return [(name, make().select("row_id", "smooth")) for name, make in ways]


def _growing(start: int, sizes) -> list[int]:
    """Runs from ``start`` on, one per size, ordered so that each leaves out what the one before it leaves out."""
    return [start + i for i in sorted(range(len(sizes)), key=lambda i: sizes[i])]


def _by_floor(start: int, wanted: list[tuple[float, int]]) -> list[list[int]]:
    """As ``_growing``, one chain per class floor: only cuts over the same floor are nested."""
    return [sorted((start + i for i, (_, k) in enumerate(wanted) if k == keep), key=lambda i: wanted[i - start][0]) for keep in sorted({k for _, k in wanted})]


def sweep_filters(train: DataFrame, valid: DataFrame, noise: DataFrame, learner, caps: list[float] | None = None):
    """(all results, best per method): every signal with every cap."""
    results = _filter_results(train, valid, noise, learner, caps or fixed.CAP_FRACTIONS)
    return metrics.leaderboard(results, ties=("method", "params", "cap_fraction")), metrics.best_per_method(results, ties=("params", "cap_fraction"))


@tidy
def _filter_results(train: DataFrame, valid: DataFrame, noise: DataFrame, learner, caps: list[float]) -> DataFrame:
    rows, names = train, []
    for i, (method, params, scores) in enumerate(filter_signals(noise)):
        stored = materialise(scores.withColumnRenamed("score", f"s{i}"), "signal")
        rows = _attach(rows, stored)
        names.append((method, params))
    rows = materialise(rows, "sweep")
    runs, chains = [], []
    for (method, params), drops in zip(names, removal.cap_removals(rows, [f"s{i}" for i in range(len(names))], caps)):
        chains.append(_growing(len(runs), caps))
        runs += [({"method": method, "params": params, "cap_fraction": c}, d) for c, d in zip(caps, drops)]
    return evaluate_runs(learner, rows, valid, runs, "method string, params string, cap_fraction double", chains)


def sweep_hybrid(
    train: DataFrame,
    valid: DataFrame,
    noise: DataFrame,
    learner,
    alphas: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75),
    shares: tuple[float, ...] = (0.6, 0.75, 0.9, 1.0),
    keeps: tuple[int, ...] = (20, 40, 60),
) -> DataFrame:
    """Every smoother x blend x share, plain and with class floors."""
    return metrics.leaderboard(_hybrid_results(train, valid, noise, learner, alphas, shares, keeps), ties=("family", "method", "alpha"))


@tidy
def _hybrid_results(train: DataFrame, valid: DataFrame, noise: DataFrame, learner, alphas: tuple[float, ...], shares: tuple[float, ...], keeps: tuple[int, ...]) -> DataFrame:
    runs, chains, rows = [], [], align_noise(train, noise)
    counts, in_pool = class_counts(train, "category"), F.col("flagged_suspicious") & (F.col("true_label_prob") < fixed.CANDIDATE_PROB)
    names = []
    for method, signal in hybrid_signals(noise):
        stored = materialise(signal, "signal")
        both = scaling.minmax_norm(scaling.minmax_norm(stored, "x", "b"), "smooth", "s")
        blends = {f"{method}_{i}": F.round(scaling.blend(F.col("b"), F.col("s"), a), 9) for i, a in enumerate(alphas)}
        rows = _attach(rows, both.select("row_id", *[v.alias(c) for c, v in blends.items()]))
        names += [(method, a, f"{method}_{i}") for i, a in enumerate(alphas)]
    rows = materialise(rows, "sweep")
    pool = materialise(rows.where(in_pool), "pool")
    wanted = [(share, keep) for share in shares for keep in keeps]
    scores = [score for *_, score in names]
    plains, floored = removal.candidate_removals(pool, scores, list(shares)), removal.class_aware_removals(counts, pool, scores, wanted)
    for (method, a, _), plain, floors in zip(names, plains, floored):
        base = {"method": method, "alpha": a}
        chains.append(_growing(len(runs), shares))
        runs += [({**base, "family": "hybrid", "frac_candidates_removed": f, "min_keep_per_class": None}, in_pool & d) for f, d in zip(shares, plain)]
        chains += _by_floor(len(runs), wanted)
        runs += [({**base, "family": "classaware", "frac_candidates_removed": f, "min_keep_per_class": k}, in_pool & d) for (f, k), d in zip(wanted, floors)]
    schema = "family string, method string, alpha double, frac_candidates_removed double, min_keep_per_class int"
    return evaluate_runs(learner, rows, valid, runs, schema, chains)


def sweep_advanced(
    train: DataFrame,
    valid: DataFrame,
    noise: DataFrame,
    learner,
    quantiles: tuple[float, ...] = (0.90, 0.95, 0.975),
    shares: tuple[float, ...] = (0.6, 0.75, 0.9),
    keeps: tuple[int, ...] = (30, 40, 60),
    optional: bool = False,
    lowess_span: int | None = None,
) -> DataFrame:
    """Every signal with quantile cuts and with class floors."""
    results = _advanced_results(train, valid, noise, learner, quantiles, [(share, keep) for share in shares for keep in keeps], optional, lowess_span)
    return metrics.leaderboard(results, ties=("method", "strategy"))


@tidy
def _advanced_results(
    train: DataFrame, valid: DataFrame, noise: DataFrame, learner, quantiles: tuple[float, ...], wanted: list[tuple[float, int]], optional: bool, lowess_span: int | None
) -> DataFrame:
    runs, chains, rows = [], [], align_noise(train, noise)
    counts, in_pool = class_counts(train, "category"), F.col("flagged_suspicious") & (F.col("true_label_prob") < fixed.CANDIDATE_PROB)
    names = []
    for name, signal in advanced_signals(noise, optional, lowess_span):
        stored = materialise(signal, "signal")
        rows = _attach(rows, scaling.minmax_norm(stored, "smooth", "s").select("row_id", F.round("s", 9).alias(name)))
        names.append(name)
    rows = materialise(rows, "sweep")
    pool = materialise(rows.where(in_pool), "pool")
    for name, floors in zip(names, removal.class_aware_removals(counts, pool, names, wanted)):
        cuts = removal.quantile_removals(pool, name, quantiles)
        chains.append(_growing(len(runs), [-q for q in quantiles]))
        runs += [({"method": name, "strategy": f"threshold_q{q}"}, in_pool & d) for q, d in zip(quantiles, cuts)]
        chains += _by_floor(len(runs), wanted)
        runs += [({"method": name, "strategy": f"classaware_f{f}_k{k}"}, in_pool & d) for (f, k), d in zip(wanted, floors)]
    return evaluate_runs(learner, rows, valid, runs, "method string, strategy string", chains)
