"""Evaluation, report and workflow queries; runs come from the counting scorer on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.operators import metrics, reports, split
from tallyloom.operators.models import timed
from tallyloom.operators.noise import CountingScorer
from tallyloom.operators.schema import label_list
from tallyloom.plans import workflows as wf
from tallyloom.registry import base, sql
from tallyloom.registry.base import prepared, query, r6, train_valid
from tallyloom.registry.labels import DOMINANT, KEYWORD_SQL, KEYWORDS, REPEATED, SEEDED, keyword_case
from tallyloom.registry.sql import build
from tallyloom.runtime import materialise, scratch_path
from tallyloom.sources import adapters, files

SCORES = ("accuracy", "weighted_f1", "macro_f1")
R6 = ", ".join(f"round({c}, 6) AS {c}" for c in SCORES)
# scorer name -> keys; the names stand for model families, the keys for settings
SCORERS = {
    "merchant": ("description",),
    "priced": ("description", "amount_bucket"),
    "full": ("description", "amount_bucket", "transaction_type"),
}
DEPTHS = {"merchant": 4, "priced": 6, "full": 8}
RATES = {42: 0.03, 52: 0.05, 62: 0.1}


def predictions(spark, sf):
    train, valid = train_valid(spark, sf)
    return CountingScorer().fit_score(train, valid).withColumnRenamed("cv_pred", "prediction")


def preds(spark, sf):
    return base._once(spark, sf, "preds", lambda: predictions(spark, sf))


def labels_of(spark, sf):
    return label_list(prepared(spark, sf))


@query(
    "confusion_matrix",
    build(
        "SELECT a.label AS actual, b.label AS predicted, (SELECT count(*) FROM preds p WHERE p.category = a.label AND p.prediction = b.label) AS n FROM labelset a CROSS JOIN labelset b",
        "preds",
        "labelset",
    ),
)
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(preds(spark, sf), labels_of(spark, sf))


@query("per_class_report", build("SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report", "preds", "labelset", report=sql.report_sql("preds", "labelset")))
def per_class_report(spark, sf):
    return metrics.per_class_report(preds(spark, sf), labels_of(spark, sf)).select("label", *r6("precision", "recall", "f1"), "support")


def seeded_folds(spark, sf):
    return base._once(spark, sf, "seeded", lambda: split.repeated_kfold(adapters.labelled(spark, sf), fixed.REPEAT_SEEDS))


SEED_PARTS = dict(seeded=SEEDED, rfold=sql.fold_sql("seeded", "CAST(seed AS VARCHAR)", "seed, category"))


def key_runs(spark, sf):
    """Out-of-fold predictions of every scorer and seed, with the seed's share of the measured time."""

    def make():
        folded, out = seeded_folds(spark, sf), None
        for name, keys in SCORERS.items():
            part = CountingScorer(keys=keys, by=("seed",)).out_of_fold(folded).select(F.lit(name).alias("scorer"), "seed", "fold", "category", "cv_pred")
            part, seconds = timed(lambda part=part: materialise(part, "key-run"))
            part = part.withColumn("training_time_seconds", F.lit(seconds / len(fixed.REPEAT_SEEDS)))
            out = part if out is None else out.unionByName(part)
        return out

    return base._once(spark, sf, "key_runs", make)


KEY_RUNS = " UNION ALL ".join(
    f"SELECT '{name}' AS scorer, seed, fold, category, cv_pred FROM ({sql.oof_sql('rfold', 'seed', ', '.join(keys))})" for name, keys in SCORERS.items()
)
KEY_PARTS = dict(SEED_PARTS, keyruns=KEY_RUNS)


@query("classification_metrics", build(f"SELECT scorer, seed, {R6} FROM ({sql.metrics_sql('keyruns', 'scorer, seed', pred='cv_pred')})", "lab", **KEY_PARTS))
def classification_metrics(spark, sf):
    return metrics.classification_metrics(key_runs(spark, sf), predicted="cv_pred", by=("scorer", "seed")).select("scorer", "seed", *r6(*SCORES))


def seed_scores(spark, sf):
    return metrics.classification_metrics(key_runs(spark, sf), predicted="cv_pred", by=("scorer", "seed"))


SEED_SCORES = dict(KEY_PARTS, ss=sql.metrics_sql("keyruns", "scorer, seed", pred="cv_pred"))


@query("read_metrics_long", build(f"SELECT scorer, seed, {R6} FROM ss", "lab", **SEED_SCORES))
def read_metrics_long(spark, sf):
    long = reports.metrics_to_long(seed_scores(spark, sf), list(SCORES), ["scorer", "seed"])
    path = files.through_file(long, "metrics", "json")
    stored = spark.read.schema(long.schema).json(path)
    return reports.metrics_from_long(stored, list(SCORES), ["scorer", "seed"]).select("scorer", "seed", *r6(*SCORES))


@query(
    "seed_aggregate",
    build(
        " UNION ALL ".join(
            f"SELECT scorer, '{m}' AS metric, round(avg({m}), 6) AS mean, round(stddev_pop({m}), 6) AS std, "
            f"round(min_by({m}, seed), 6) AS first_value, round(max_by({m}, seed), 6) AS last_value, CAST(count(*) AS INT) AS n_values FROM ss GROUP BY scorer"
            for m in SCORES
        ),
        "lab",
        **SEED_SCORES,
    ),
)
def seed_aggregate(spark, sf):
    nested = metrics.seed_aggregate(seed_scores(spark, sf), list(SCORES), ("scorer",))
    views = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("a")) for m in SCORES])
    flat = nested.select("scorer", F.explode(views).alias("v")).select("scorer", "v.metric", "v.a.*")
    return flat.select(
        "scorer", "metric", *r6("mean", "std"), F.round(F.element_at("values", 1), 6).alias("first_value"), F.round(F.element_at("values", -1), 6).alias("last_value"), F.size("values").alias("n_values")
    )


def fold_runs(spark, sf):
    """One run per (rate, depth, fold): seeds stand for rates, scorers for depths, wrong rows for rounds."""
    runs = key_runs(spark, sf)
    scored = metrics.classification_metrics(runs, predicted="cv_pred", by=("scorer", "seed", "fold"))
    wrong = runs.groupBy("scorer", "seed", "fold").agg(F.count_if(F.col("cv_pred") != F.col("category")).alias("wrong"))
    rate = F.create_map(*[F.lit(x) for kv in RATES.items() for x in kv])[F.col("seed")]
    depth = F.create_map(*[F.lit(x) for kv in DEPTHS.items() for x in kv])[F.col("scorer")]
    rounds = metrics.best_round(F.nullif(F.col("wrong"), F.lit(0)))
    return scored.join(wrong, ["scorer", "seed", "fold"]).select(
        rate.alias("learning_rate"), depth.alias("depth"), "fold", "weighted_f1", rounds.cast("int").alias("best_iteration")
    )


FOLD_RUNS = f"""
SELECT CASE seed WHEN 42 THEN 0.03::DOUBLE WHEN 52 THEN 0.05::DOUBLE ELSE 0.1::DOUBLE END AS learning_rate,
       CASE scorer WHEN 'merchant' THEN 4 WHEN 'priced' THEN 6 ELSE 8 END AS depth, fold, weighted_f1,
       CASE WHEN wrong = 0 THEN 1000 ELSE wrong END AS best_iteration
FROM ({sql.metrics_sql('keyruns', 'scorer, seed, fold', pred='cv_pred')}) JOIN
     (SELECT scorer, seed, fold, count_if(cv_pred <> category)::INT AS wrong FROM keyruns GROUP BY ALL) USING (scorer, seed, fold)"""
TRACE = """
SELECT learning_rate, depth, avg(weighted_f1) AS mean_weighted_f1, stddev_pop(weighted_f1) AS std_weighted_f1,
       CAST(trunc(median(best_iteration)) AS INT) AS median_best_iteration,
       min_by(weighted_f1, fold) AS f0, max_by(weighted_f1, fold) AS f4, CAST(max_by(best_iteration, fold) AS INT) AS i4 FROM foldruns GROUP BY learning_rate, depth"""
TRACE_PARTS = dict(KEY_PARTS, foldruns=FOLD_RUNS, trace=TRACE)


def trace(spark, sf):
    return metrics.cv_trace(fold_runs(spark, sf))


@query(
    "cv_trace",
    build(
        "SELECT learning_rate, depth, round(mean_weighted_f1, 6) AS mean_weighted_f1, round(std_weighted_f1, 6) AS std_weighted_f1, median_best_iteration, "
        "round(f0, 6) AS first_fold, round(f4, 6) AS last_fold, i4 AS last_rounds FROM trace",
        "lab",
        **TRACE_PARTS,
    ),
)
def cv_trace(spark, sf):
    return trace(spark, sf).select(
        "learning_rate", "depth", *r6("mean_weighted_f1", "std_weighted_f1"), "median_best_iteration",
        F.round(F.element_at("fold_scores", 1), 6).alias("first_fold"), F.round(F.element_at("fold_scores", -1), 6).alias("last_fold"),
        F.element_at("fold_best_iterations", -1).alias("last_rounds"),
    )


@query(
    "median_best_iteration",
    build(
        "SELECT learning_rate, depth, CAST(greatest(median_best_iteration, 100) AS INT) AS iterations FROM trace ORDER BY round(mean_weighted_f1, 9) DESC, learning_rate, depth LIMIT 1",
        "lab",
        **TRACE_PARTS,
    ),
)
def median_best_iteration(spark, sf):
    return metrics.final_rounds(trace(spark, sf)).select("learning_rate", "depth", "iterations")


@query(
    "cv_grid_matrix",
    build(
        "SELECT depth, "
        + ", ".join(f'round(max(CASE WHEN learning_rate = {r}::DOUBLE THEN mean_weighted_f1 END), 6) AS "rate_{r}"' for r in fixed.TREE_RATES)
        + " FROM trace GROUP BY depth",
        "lab",
        **TRACE_PARTS,
    ),
)
def cv_grid_matrix(spark, sf):
    wide = reports.cv_grid_matrix(trace(spark, sf))
    return wide.select("depth", *[F.round(F.col(f"`rate_{r}`"), 6).alias(f"rate_{r}") for r in fixed.TREE_RATES])


CELL_NAMES = ["all_rows", "unflagged_rows"]


def training_noise(spark, sf):
    """Scores of the training rows themselves, with flags."""

    def make():
        train = train_valid(spark, sf)[0]
        noise = wf.score_training_rows(train, CountingScorer())
        from tallyloom.functions.columns import flag_suspicious

        return noise.withColumn("flagged_suspicious", flag_suspicious(F.col("category"), F.col("cv_pred"), F.col("true_label_prob")))

    return base._once(spark, sf, "training_noise", make)


def cell_preds(spark, sf):
    """Validation predictions of every scorer, fitted on all and on unflagged training rows, with the measured time."""

    def make():
        noise, valid = training_noise(spark, sf), train_valid(spark, sf)[1]
        out = None
        for cell, rows in (("all_rows", noise), ("unflagged_rows", noise.where("NOT flagged_suspicious"))):
            for name, keys in SCORERS.items():
                part = CountingScorer(keys=keys).fit_score(rows, valid)
                part = part.select(F.lit(name).alias("model"), F.lit(cell).alias("cell"), "row_id", "category", F.col("cv_pred").alias("prediction"))
                part, seconds = timed(lambda part=part: materialise(part, "cell"))
                part = part.withColumn("training_time_seconds", F.lit(seconds))
                out = part if out is None else out.unionByName(part)
        return out

    return base._once(spark, sf, "cell_preds", make)


CELL_PREDS = " UNION ALL ".join(
    f"SELECT '{name}' AS model, '{cell}' AS cell, row_id, category, cv_pred AS prediction FROM ({sql.counting_sql(rel, 'valid', keys=', '.join(keys))})"
    for cell, rel in (("all_rows", "tnoise"), ("unflagged_rows", "unflagged"))
    for name, keys in SCORERS.items()
)
CELL_PARTS = dict(unflagged="SELECT * FROM tnoise WHERE NOT flagged_suspicious", cellpreds=CELL_PREDS)
COMPARISON = dict(
    CELL_PARTS,
    comp=f"SELECT *, 1 AS seeds_run FROM ({sql.metrics_sql('cellpreds', 'model, cell')})",
)


def comparison(spark, sf):
    """Scores and measured fit time per (model, cell)."""
    scored = cell_preds(spark, sf)
    spent = scored.groupBy("model", "cell").agg(F.max("training_time_seconds").alias("training_time_seconds"))
    scores = metrics.classification_metrics(scored, by=("model", "cell"))
    return scores.join(F.broadcast(spent), ["model", "cell"]).withColumn("seeds_run", F.lit(1))


@query("comparison_summary", build(f"SELECT model, cell, {R6}, true AS timed, seeds_run FROM comp", "tnoise", "valid", **COMPARISON))
def comparison_summary(spark, sf):
    return reports.comparison_summary(comparison(spark, sf)).select("model", "cell", *r6(*SCORES), (F.col("training_time_seconds") > 0).alias("timed"), "seeds_run")


@query(
    "metric_by_cell",
    build(
        "SELECT cell, CASE cell WHEN 'all_rows' THEN 1 ELSE 2 END AS cell_order, "
        + ", ".join(f"round(max(CASE WHEN model = '{m}' THEN weighted_f1 END), 6) AS {m}" for m in SCORERS)
        + " FROM comp GROUP BY cell",
        "tnoise",
        "valid",
        **COMPARISON,
    ),
)
def metric_by_cell(spark, sf):
    return reports.metric_by_cell(comparison(spark, sf), "weighted_f1", list(SCORERS), CELL_NAMES).select("cell", "cell_order", *r6(*SCORERS))


def class_reports(spark, sf, by=("model", "cell")):
    return metrics.per_class_report(cell_preds(spark, sf), labels_of(spark, sf), by=by)


REPORTS = {
    f"rep_{m}_{c}": sql.report_sql(f"(SELECT * FROM cellpreds WHERE model = '{m}' AND cell = '{c}')", "labelset") for m in SCORERS for c in CELL_NAMES
}


@query(
    "per_class_f1_by_model",
    build(
        "SELECT label, " + ", ".join(f"round({m}.f1, 6) AS {m}" for m in SCORERS) + " FROM rep_merchant_all_rows merchant JOIN rep_priced_all_rows priced USING (label) JOIN rep_full_all_rows \"full\" USING (label) WHERE label NOT IN ('macro avg', 'weighted avg')",
        "tnoise",
        "valid",
        "labelset",
        **CELL_PARTS,
        **REPORTS,
    ).replace("round(full.f1", 'round("full".f1'),
)
def per_class_f1_by_model(spark, sf):
    rows = class_reports(spark, sf).where("cell = 'all_rows'")
    return reports.per_class_f1_by_model(rows, list(SCORERS)).select("label", *r6(*SCORERS))


@query(
    "per_class_f1_delta",
    build(
        "SELECT label, round(b.f1 - a.f1, 6) AS f1_delta, a.support FROM rep_full_all_rows a JOIN rep_full_unflagged_rows b USING (label) WHERE label NOT IN ('macro avg', 'weighted avg')",
        "tnoise",
        "valid",
        "labelset",
        **CELL_PARTS,
        **REPORTS,
    ),
)
def per_class_f1_delta(spark, sf):
    rows = class_reports(spark, sf).where("model = 'full'")
    return reports.per_class_f1_delta(rows.where("cell = 'all_rows'"), rows.where("cell = 'unflagged_rows'")).select("label", *r6("f1_delta"), "support")


def nested_cells(spark, sf):
    spent = key_runs(spark, sf).groupBy("scorer").agg(F.max("training_time_seconds").alias("training_time_seconds"))
    runs = seed_scores(spark, sf).join(F.broadcast(spent), "scorer")
    return metrics.seed_aggregate(runs, [*SCORES, "training_time_seconds"], ("scorer",)).withColumnRenamed("scorer", "run_name")


@query(
    "ablation_summary",
    build(
        "SELECT scorer AS run, round(avg(weighted_f1), 6) AS weighted_f1_mean, round(stddev_pop(weighted_f1), 6) AS weighted_f1_std, round(avg(macro_f1), 6) AS macro_f1_mean, "
        "round(avg(accuracy), 6) AS accuracy_mean, true AS timed FROM ss GROUP BY scorer",
        "lab",
        **SEED_SCORES,
    ),
)
def ablation_summary(spark, sf):
    line = reports.ablation_summary(nested_cells(spark, sf))
    return line.select("run", *r6("weighted_f1_mean", "weighted_f1_std", "macro_f1_mean", "accuracy_mean"), (F.col("training_time_mean") > 0).alias("timed"))


@query(
    "read_model_metrics",
    build("SELECT scorer AS cell, round(avg(accuracy), 6) AS accuracy, round(avg(weighted_f1), 6) AS weighted_f1, round(avg(macro_f1), 6) AS macro_f1, CAST(count(*) AS INT) AS seeds_run FROM ss WHERE scorer = 'full' GROUP BY scorer", "lab", **SEED_SCORES),
)
def read_model_metrics(spark, sf):
    rows = class_reports(spark, sf).where("cell = 'all_rows'").groupBy(F.col("model").alias("run_name"))
    per_class = rows.agg(F.map_from_entries(F.collect_list(F.struct("label", F.struct("precision", "recall", "f1", "support")))).alias("per_class"))
    stored = nested_cells(spark, sf).join(per_class, "run_name")
    path = files.through_file(stored, "model_metrics", "json")
    row, _ = files.read_model_metrics(spark, path, "full", stored.schema)
    return row.select("cell", *r6(*SCORES), "seeds_run")


@query("leaderboard", build(f"SELECT model, cell, {R6} FROM comp ORDER BY round(weighted_f1, 9) DESC, round(macro_f1, 9) DESC, round(accuracy, 9) DESC, model, cell LIMIT 3", "tnoise", "valid", **COMPARISON))
def leaderboard(spark, sf):
    return metrics.leaderboard(comparison(spark, sf), ties=("model", "cell"), limit=3).select("model", "cell", *r6(*SCORES))


@query(
    "best_per_method",
    build(f"SELECT model, cell, {R6} FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY round(weighted_f1, 9) DESC, round(macro_f1, 9) DESC, cell) AS rk FROM comp) WHERE rk = 1", "tnoise", "valid", **COMPARISON),
)
def best_per_method(spark, sf):
    return metrics.best_per_method(comparison(spark, sf), "model", ("cell",)).select("model", "cell", *r6(*SCORES))


@query("best_macro", build(f"SELECT model, cell, {R6} FROM comp ORDER BY round(macro_f1, 9) DESC, round(weighted_f1, 9) DESC, round(accuracy, 9) DESC, model, cell LIMIT 1", "tnoise", "valid", **COMPARISON))
def best_macro(spark, sf):
    return metrics.best_macro(comparison(spark, sf), ("model", "cell")).select("model", "cell", *r6(*SCORES))


@query("write_results", build(f"SELECT model, cell, {R6} FROM comp", "tnoise", "valid", **COMPARISON))
def write_results(spark, sf):
    path = scratch_path(spark, "results")
    files.write_results(comparison(spark, sf), path)
    return spark.read.parquet(path).select("model", "cell", *r6(*SCORES))


@query(
    "union_results",
    build(f"SELECT model, cell, NULL::VARCHAR AS scorer, NULL::INT AS seed, {R6} FROM comp UNION ALL SELECT NULL, NULL, scorer, seed, {R6} FROM ss", "tnoise", "valid", "lab", **COMPARISON, **SEED_SCORES),
)
def union_results(spark, sf):
    both = metrics.union_results(comparison(spark, sf), seed_scores(spark, sf))
    return both.select("model", "cell", "scorer", "seed", *r6(*SCORES))


def flow_sql(source: str, extra: str = "", **more: str) -> tuple[str, dict]:
    parts = dict(more, flow=sql.metrics_sql(f"(SELECT category, cv_pred AS prediction FROM ({sql.counting_sql(source, 'valid')}))"))
    return f"SELECT {R6}{extra} FROM flow", parts


TRAIN_DOM = DOMINANT.replace("FROM lab", "FROM train")
RELABELLED = dict(
    dom=TRAIN_DOM,
    changed="SELECT t.* EXCLUDE (category), coalesce(d.dominant, t.category) AS category, coalesce(d.dominant <> t.category, false) AS label_changed "
    "FROM train t LEFT JOIN (SELECT * FROM dom WHERE dominance >= 0.9) d USING (description, amount_bucket, transaction_type)",
)
_body, _parts = flow_sql("changed", ", (SELECT count_if(label_changed)::BIGINT FROM changed) AS rows_relabelled", **RELABELLED)


@query("run_relabel", build(_body, "train", "valid", **_parts))
def run_relabel(spark, sf):
    return wf.run_relabel(*train_valid(spark, sf), CountingScorer())[0].select(*r6(*SCORES), "rows_relabelled")


FILTERED = dict(kept="SELECT * FROM tnoise WHERE NOT flagged_suspicious")
_body, _parts = flow_sql("kept", ", (SELECT count_if(flagged_suspicious)::BIGINT FROM tnoise) AS rows_removed", **FILTERED)
SUSPICIOUS_SQL = build(_body, "tnoise", "valid", **_parts)


@query("run_suspicious_filter", SUSPICIOUS_SQL)
def run_suspicious_filter(spark, sf):
    return wf.run_suspicious_filter(*train_valid(spark, sf), CountingScorer())[0].select(*r6(*SCORES), "rows_removed")


TRAIN_REPEATED = dict(
    tseeded=SEEDED.replace("FROM lab", "FROM train"),
    rfold=sql.fold_sql("tseeded", "CAST(seed AS VARCHAR)", "seed, category"),
    runs=sql.oof_sql("rfold", "seed"),
    merged=REPEATED,
    kept="SELECT * FROM train WHERE row_id IN (SELECT row_id FROM merged WHERE NOT flagged_suspicious)",
)
_body, _parts = flow_sql("kept", ", (SELECT count_if(flagged_suspicious)::BIGINT FROM merged) AS rows_removed", **TRAIN_REPEATED)


@query("run_repeated_filter", build(_body, "train", "valid", **_parts))
def run_repeated_filter(spark, sf):
    return wf.run_repeated_filter(*train_valid(spark, sf), CountingScorer())[0].select(*r6(*SCORES), "rows_removed")


CAP_RANK = (
    "SELECT *, row_number() OVER (ORDER BY round((1.0::DOUBLE - true_label_prob) + 0.25 * wrong_flag, 9) DESC, row_id DESC) AS rk, count(*) OVER () AS n FROM tnoise"
)
CAP_FLOW = dict(capped=CAP_RANK)
CAP_LINES = []
for _c in fixed.CAP_FRACTIONS:
    _name = f"cap{int(_c * 100)}"
    CAP_FLOW[_name] = f"SELECT * FROM capped WHERE rk > greatest(1, CAST(floor(n * {_c}::DOUBLE) AS BIGINT))"
    _scored = sql.counting_sql(_name, "valid")
    CAP_LINES.append(
        f"SELECT {_c}::DOUBLE AS cap_fraction, {R6}, CAST((SELECT count(*) FROM tnoise) - (SELECT count(*) FROM {_name}) AS BIGINT) AS rows_removed, (SELECT count(*) FROM {_name}) AS rows_kept "
        f"FROM ({sql.metrics_sql(f'(SELECT category, cv_pred AS prediction FROM ({_scored}))')})"
    )


@query("run_capped_filter", build(" UNION ALL ".join(CAP_LINES), "tnoise", "valid", **CAP_FLOW))
def run_capped_filter(spark, sf):
    results, _, _ = wf.run_capped_filter(*train_valid(spark, sf), CountingScorer())
    return results.select("cap_fraction", *r6(*SCORES), "rows_removed", "rows_kept")


TOP = "SELECT * FROM (SELECT *, round((1.0::DOUBLE - true_label_prob) + wrong_flag, 9) AS s FROM tnoise ORDER BY s DESC, row_id LIMIT 300)"
REVIEW = dict(top=TOP, reviewed=KEYWORD_SQL.format(keyword_case("target"), keyword_case("keyword"), "top"))


@query("review_suspicious", build("SELECT row_id, category, category_corrected, review_note, label_changed FROM reviewed", "tnoise", **REVIEW))
def review_suspicious(spark, sf):
    top, _ = wf.review_suspicious(training_noise(spark, sf), KEYWORDS)
    return top.select("row_id", "category", "category_corrected", "review_note", "label_changed")


@query("apply_review", build("SELECT t.row_id, coalesce(r.category_corrected, t.category) AS category FROM tnoise t LEFT JOIN (SELECT * FROM reviewed WHERE label_changed) r ON t.row_id = r.row_id", "tnoise", **REVIEW))
def apply_review(spark, sf):
    noise = training_noise(spark, sf)
    top, _ = wf.review_suspicious(noise, KEYWORDS)
    return wf.apply_review(noise, materialise(top, "review"))[0].select("row_id", "category")


SCORECARD = dict(
    RELABELLED,
    filtered="SELECT * FROM tnoise WHERE NOT flagged_suspicious",
    **{"one": sql.metrics_sql(f"(SELECT category, cv_pred AS prediction FROM ({sql.counting_sql('changed', 'valid')}))"), "two": sql.metrics_sql(f"(SELECT category, cv_pred AS prediction FROM ({sql.counting_sql('filtered', 'valid')}))")},
    **COMPARISON,
)


@query(
    "compiled_scorecard",
    build(
        f"SELECT 'relabel' AS run, 'relabel/metrics' AS source, {R6}, 'Dominant relabel' AS notes FROM one UNION ALL "
        f"SELECT 'filter', 'filter/metrics', {R6}, 'Suspicious-row filter' FROM two UNION ALL "
        f"SELECT 'scorers', 'comparison/summary', {R6}, 'Best scorer' FROM (SELECT * FROM comp ORDER BY round(weighted_f1, 9) DESC, round(macro_f1, 9) DESC, round(accuracy, 9) DESC LIMIT 1)",
        "train",
        "tnoise",
        "valid",
        **SCORECARD,
    ),
)
def compiled_scorecard(spark, sf):
    train, valid = train_valid(spark, sf)
    relabelled = wf.run_relabel(train, valid, CountingScorer())[0]
    kept = training_noise(spark, sf).where("NOT flagged_suspicious")
    filtered = wf.evaluate(CountingScorer(), kept, valid)[0]
    card = reports.compiled_scorecard(
        [
            ("relabel", "relabel/metrics", "Dominant relabel", relabelled),
            ("filter", "filter/metrics", "Suspicious-row filter", filtered),
            ("scorers", "comparison/summary", "Best scorer", comparison(spark, sf)),
        ]
    )
    return card.select("run", "source", *r6(*SCORES), "notes")


@query("iterative_clean")
def iterative_clean(spark, sf):
    from tallyloom.registry.labels import MERCHANTS

    history, _ = wf.iterative_clean(*train_valid(spark, sf), CountingScorer(), target_weighted=2.0, merchants=MERCHANTS)
    return history


@query("sweep_filters")
def sweep_filters(spark, sf):
    return wf.sweep_filters(*train_valid(spark, sf), training_noise(spark, sf), CountingScorer())[0]


@query("sweep_hybrid")
def sweep_hybrid(spark, sf):
    return wf.sweep_hybrid(*train_valid(spark, sf), training_noise(spark, sf), CountingScorer())


@query("sweep_advanced")
def sweep_advanced(spark, sf):
    return wf.sweep_advanced(*train_valid(spark, sf), training_noise(spark, sf), CountingScorer(), optional=True)
