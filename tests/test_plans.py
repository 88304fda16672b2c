"""Physical plans and models on the small tables."""

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tallyloom import fixed
from tallyloom.operators import features as ft, linear, models as md, removal, split
from tallyloom.operators.noise import CountingScorer
from tallyloom.plans import compare, workflows as wf
from tallyloom.registry.base import noise, train_valid

QUERIES = entry_module.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["stratified_split", "stratified_kfold", "oof_scores", "relabel_dominant", "remove_class_aware", "smooth_savgol", "smooth_median", "ordered_signal", "keyword_rule_relabel", "apply_corrections", "dedup_exact"],
)
def test_no_single_partition_for_rows_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text
    main = text.split("Subquery")[0]  # scalar subqueries are one row by construction
    assert "Exchange SinglePartition" not in main


@pytest.mark.parametrize("name", ["category_rollup", "merchant_rule_relabel", "label_encode"])
def test_small_sides_are_broadcast(spark, name):
    assert "BroadcastHashJoin" in plan(QUERIES[name](spark, SF_DIR))


def test_filters_and_columns_reach_the_scan(spark):
    text = noise(spark, SF_DIR).where("true_label_prob < 0.05 AND wrong_flag = 1").select("row_id")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(true_label_prob,0.05)" in text and "description" not in text.split("ReadSchema")[1]


def test_top_suspicious_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_suspicious"](spark, SF_DIR))


def dense(ready):
    """(rows, label numbers, weights) of prepared rows as numpy arrays."""
    rows = ready.data.collect()
    x = np.zeros((len(rows), ready.size))
    for i, r in enumerate(rows):
        x[i, r["at"]] = r["value"]
    return x, np.array([r["y"] for r in rows]), np.array([r["w"] * r["cw"] for r in rows])


def test_svm_meets_its_optimality_condition(spark):
    train, _ = train_valid(spark, SF_DIR)
    for balanced in (False, True):
        learner = md.SvmLearner(C=0.1, balanced=balanced, tol=1e-6)
        ready = learner.prepare(train)
        model = learner.fit(ready)[0]
        x, y, w = dense(ready)
        x = np.hstack([x, np.ones((len(x), 1))])
        s = np.where(np.eye(len(ready.labels))[y] > 0, 1.0, -1.0)
        v = np.where(s > 0, w[:, None] if balanced else 1.0, 1.0)
        gradient = -2 * learner.C * x.T @ (v * s * np.maximum(0, 1 - s * (x @ model))) + model
        assert np.abs(gradient).max() < 1e-4
        assert ready.size == x.shape[1] - 1


def test_runs_that_share_scans_equal_single_fits(spark):
    """Grids, both losses and row sets: each run gives what it gives alone on its rows."""
    train, _ = train_valid(spark, SF_DIR)
    ready = md.LogisticLearner(spec=ft.ONE_HOT).prepare(train, keep=["row_id"])
    data = ready.data.withColumn("keep", F.expr("array(shiftleft(1L, CAST(row_id % 3 AS INT)) | 8L)"))
    runs = [linear.Run("logistic", 1.0, True, 3), linear.Run("logistic", 10.0, False, 0), linear.Run("squared_hinge", 0.1, True, 2), linear.Run("squared_hinge", 1.0, False, 1)]
    many = linear.fit_runs(data, runs, ready.size, len(ready.labels), 2000, 1e-5)
    for run, model in zip(runs, many):
        rows = data if run.bit == 3 else data.where(f"row_id % 3 = {run.bit}")
        alone = linear.fit_runs(rows, [md.replace(run, bit=None)], ready.size, len(ready.labels), 2000, 1e-5)[0]
        x = dense(ready)[0]
        f, g = (x @ m[:-1] + m[-1] for m in (model, alone))
        assert np.abs((f - f.mean(1, keepdims=True)) - (g - g.mean(1, keepdims=True))).max() < 0.05


def test_gradients_are_added_up_on_the_cluster_where_they_are_large(spark, monkeypatch):
    train, _ = train_valid(spark, SF_DIR)
    ready = md.LogisticLearner().prepare(train)
    ready = ready._replace(data=ready.data.repartition(5))
    runs = [linear.Run("logistic", 1.0)]
    points = [np.random.default_rng(0).normal(size=(ready.size + 1, len(ready.labels)))]
    one = linear._scan(ready.data, runs, points, ready.size, len(ready.labels))
    monkeypatch.setattr(linear, "DIRECT_BYTES", 0)
    monkeypatch.setattr(linear, "CHUNK", 17)
    two = linear._scan(ready.data, runs, points, ready.size, len(ready.labels))
    assert np.allclose(one[0], two[0]) and np.allclose(one[1], two[1])


def test_logistic_regression_meets_its_optimality_condition(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), "xyz"[int(a + b > 0) + int(a > 1)]) for i, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    df = spark.createDataFrame(rows, "row_id long, amount double, category string")
    learner = md.LogisticLearner(spec=ft.FeatureSpec(text=None, categories=(), numbers=("amount",)), max_iter=500, tol=1e-8)
    ready = learner.prepare(df)
    model = learner.fit(ready)[0]
    x, y, w = dense(ready)
    coef, base = model[:-1].T, model[-1]
    p = np.exp(x @ coef.T + base)
    p /= p.sum(1, keepdims=True)
    gradient = learner.C * ((p - np.eye(len(ready.labels))[y]) * w[:, None]).T @ x + coef
    assert np.abs(gradient).max() < 1e-3


def test_grid_search_and_svm_beat_the_majority(spark):
    train, valid = train_valid(spark, SF_DIR)
    result = md.grid_search(train, md.LogisticLearner(max_iter=10), [{"C": 0.1}, {"C": 1.0}], split.ordered_folds(train), 3)
    assert result.runs.count() == 6 and result.best in ({"C": 0.1}, {"C": 1.0})
    svm = wf.evaluate(md.SvmLearner(max_iter=10), train, valid)[0].first()
    assert svm["accuracy"] > 0.5


def test_many_linear_fits_in_shared_scans_equal_single_fits(spark):
    """48 row sets at once; three of them against a fit of its own with the same features."""
    train, valid = train_valid(spark, SF_DIR)
    drops = [(F.col("row_id") % 49 == i) | (F.col("category") == "Haircut") if i % 2 else F.col("row_id") % (i + 2) == 0 for i in range(48)]
    learner = md.LogisticLearner(spec=ft.ONE_HOT, C=0.05, tol=1e-4)
    many = wf.evaluate_runs(learner, train, valid, [({"part": i}, d) for i, d in enumerate(drops)], "part int")
    found = {r["part"]: r for r in many.collect()}
    assert len(found) == 48
    for i in (0, 1, 46):
        kept = train.where(~drops[i])
        ready = learner.prepare(kept)
        assert found[i]["rows_kept"] == kept.count()
        alone = wf.evaluate(learner, kept, valid)[0].first()
        assert abs(found[i]["accuracy"] - alone["accuracy"]) < 0.03 and ready.size <= 80


def test_many_runs_in_one_job_equal_single_fits(spark):
    train, valid = train_valid(spark, SF_DIR)
    drops = [F.col("row_id") % 4 == i for i in range(3)]
    many = wf.evaluate_runs(CountingScorer(), train, valid, [({"part": i}, d) for i, d in enumerate(drops)], "part int")
    found = {r["part"]: (r["accuracy"], r["macro_f1"], r["rows_removed"]) for r in many.collect()}
    for i, d in enumerate(drops):
        one = wf.evaluate(CountingScorer(), train.where(~d), valid)[0].first()
        assert np.allclose(found[i], (one["accuracy"], one["macro_f1"], train.where(d).count()))


def test_nested_runs_equal_single_fits(spark):
    """Two chains of nested cuts and a run of its own, listed out of order; labels vanish and one run drops every row."""
    train, valid = train_valid(spark, SF_DIR)
    drops = [F.col("row_id") % 10 < 6, F.col("row_id") % 10 < 1, F.lit(True), F.col("category") == "Housing", (F.col("category") == "Housing") | (F.col("amount") > 20)]
    runs = [({"part": i}, F.coalesce(d, F.lit(False))) for i, d in enumerate(drops)]
    found = {r["part"]: r for r in wf.evaluate_runs(CountingScorer(), train, valid, runs, "part int", [[1, 0, 2], [3, 4]]).collect()}
    assert len(found) == 5 and found[2]["rows_kept"] == 0
    for i in (0, 1, 3, 4):
        kept = train.where(~runs[i][1])
        one = wf.evaluate(CountingScorer(), kept, valid)[0].first()
        assert np.allclose([found[i][m] for m in wf.METRICS], [one[m] for m in wf.METRICS])
        assert found[i]["rows_kept"] == kept.count()


def test_class_cuts_of_many_scores_equal_those_of_each(spark):
    rows = [(i, f"it's {i % 3}", float(i * 7 % 11), float(i * 5 % 13)) for i in range(60)]
    pool = spark.createDataFrame(rows, "row_id long, category string, a double, b double")
    counts, wanted = {f"it's {c}": 20 for c in range(3)}, [(0.3, 5), (0.9, 5), (1.0, 18), (0.5, 30)]
    both = removal.class_aware_removals(counts, pool, ["a", "b"], wanted)
    for score, drops in zip("ab", both):
        for (share, keep), drop in zip(wanted, drops):
            order = sorted(rows, key=lambda r: (-r[2 if score == "a" else 3], -r[0]))
            taken, allowed = {}, []
            for r in order:
                if taken.setdefault(r[1], 0) < max(0, 20 - keep):
                    taken[r[1]] += 1
                    allowed.append(r[0])
            want = set(allowed[: max(1, int(60 * share))])
            assert {r["row_id"] for r in pool.where(drop).collect()} == want


def test_learners_can_stand_in_for_the_counting_scorer(spark):
    train, valid = train_valid(spark, SF_DIR)
    scores, scored, _ = wf.run_suspicious_filter(train, valid, md.LogisticLearner(max_iter=5), k=3)
    assert scores.first()["rows_removed"] == scored.where("flagged_suspicious").count() and scored.count() == train.count()


def test_comparison_of_three_families(spark):
    """The real path with short limits: tuning, ablation over seeds, tuned linear models."""
    train, valid = train_valid(spark, SF_DIR)
    learner = md.TreeLearner(rounds=12, patience=3)
    trace = compare.tune_trees(train, learner, [{"rate": 0.05, "depth": 2}, {"rate": 0.5, "depth": 3}], k=3).collect()
    assert len(trace) == 2 and all(len(r["fold_scores"]) == 3 for r in trace)
    assert trace[0]["mean_weighted_f1"] >= trace[1]["mean_weighted_f1"]
    nested, reports = compare.ablation_2x2(train, valid, md.replace(learner, patience=None), seeds=[0, 1])
    assert {r["run_name"] for r in nested.collect()} == set(fixed.ABLATION_CELLS)
    assert {len(r["accuracy"]["values"]) for r in nested.collect()} == {2}
    assert all(r["training_time_seconds"]["mean"] > 0 for r in nested.collect())
    assert {r["run_name"] for r in reports.collect()} == set(fixed.ABLATION_CELLS)
    svm, logreg = md.SvmLearner(tol=1e-2), md.LogisticLearner(tol=1e-2)
    table = compare.compare_models(train, valid, nested, svm, logreg, [{"C": 0.01}, {"C": 0.1}], [{"C": 0.1}, {"C": 1.0}]).collect()
    assert {(r["model"], r["cell"]) for r in table} == {(m, c) for m in ("SVM", "LogReg", "Trees") for c in fixed.ABLATION_CELLS}
    assert {r["seeds_run"] for r in table if r["model"] == "Trees"} == {2}
    best = {m: max(r["accuracy"] for r in table if r["model"] == m) for m in ("SVM", "LogReg", "Trees")}
    assert min(best.values()) > 0.8


def test_a_tuned_cell_equals_its_own_grid_search(spark):
    train, valid = train_valid(spark, SF_DIR)
    grid, base = [{"C": 0.01}, {"C": 1.0}], md.SvmLearner(tol=1e-2)
    table = compare.compare_models(train, valid, None, base, md.LogisticLearner(tol=1e-2), grid, grid[:1], cells={"class_weighted": (True, True), "baseline": (True, False)})
    found = {(r["model"], r["cell"]): r["weighted_f1"] for r in table.collect()}
    for cell, weighted in (("class_weighted", True),):
        learner = md.replace(base, balanced=weighted)
        best = md.grid_search(train, learner, grid, split.ordered_folds(train), 3).best
        assert found["SVM", cell] == pytest.approx(wf.evaluate(md.replace(learner, **best), train, valid)[0].first()["weighted_f1"])


@pytest.mark.parametrize("name", ["compare_delta_ae_focal", "second_stage"])
def test_autoencoder_rows_hold_the_error_of_the_network(spark, monkeypatch, name):
    from conftest import SF_DIR

    from tallyloom.operators import anomaly
    from tallyloom.registry import load

    class Network(Exception):
        pass

    def network(*args, **options):
        assert not options
        raise Network

    monkeypatch.setattr(anomaly, "autoencoder_recon_error", network)
    with pytest.raises(Network):
        load().queries[name](spark, SF_DIR)


def test_lowess_takes_a_twentieth_of_all_rows(spark, monkeypatch):
    from tallyloom.operators import smoothing as sm
    from tallyloom.registry import load

    spans, smooth = [], sm.smooth_lowess

    def spy(sig, span, **options):
        spans.append((sig.n, span))
        return smooth(sig, span, **options)

    monkeypatch.setattr(sm, "smooth_lowess", spy)
    assert load().queries["smooth_lowess"](spark, SF_DIR).count() == spans[0][0]
    assert all(abs(span - 0.05 * n) <= 2 for n, span in spans)


def test_svm_modes_and_the_tree_search_are_queries(spark):
    from tallyloom.registry import load

    assert {r["mode"] for r in load().queries["svm_modes"](spark, SF_DIR).collect()} == set(md.SVM_MODES)
    trace = load().queries["tune_trees"](spark, SF_DIR).collect()  # 1000 rounds, patience 50
    assert {(r["learning_rate"], r["depth"]) for r in trace} == {(r, d) for r in fixed.TREE_RATES for d in fixed.TREE_DEPTHS}
