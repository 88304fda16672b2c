"""Tree fits see every row: cuts, cells and scores of counted rows are those of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import boosting, models as md, ranks
from tallyloom.operators.schema import label_list
from tallyloom.operators.split import stratified_kfold
from tallyloom.plans import compare

ROWS = 230_000


def bought(spark, n, first=0):
    i = F.col("id")
    odd = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)).cast("int")
    return spark.range(first, first + n).select(
        i.alias("row_id"),
        F.when(i % 50 == 0, None).otherwise(F.concat(F.lit("shop "), (odd(1) % 7).cast("string"))).alias("description"),
        F.when(odd(2) < 400, "debit").otherwise("credit").alias("transaction_type"),
        F.concat(F.lit("a"), (odd(3) % 3).cast("string")).alias("account_name"),
        F.when(i % 41 == 0, float("nan")).when(i % 43 == 0, None).otherwise(odd(4) / 8.0 - 40 * (odd(5) % 2)).alias("amount"),
        F.concat(F.lit("c"), F.when(odd(6) < 200, odd(6) % 3).otherwise((odd(1) % 7 + (odd(4) > 500).cast("int")) % 3).cast("string")).alias("category"),
    )


def test_a_fit_sees_every_row(spark):
    encoded = spark.range(ROWS).select(
        F.col("id").alias("row_id"), F.array(*[(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(997)) / 10.0) for k in range(3)]).alias("x"),
        F.when(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(10)) < 3, "b").otherwise("a").alias("category"),
    )
    learner = md.TreeLearner(rounds=3, depth=2, patience=None, columns=("description",))
    model = learner.grow(encoded, ["a", "b"])
    rows = encoded.toArrow()
    x, y = rows["x"].combine_chunks().flatten().to_numpy().reshape(ROWS, 3), (rows["category"].to_numpy(zero_copy_only=False) == "b").astype(int)
    wanted, _ = boosting.grow(x, y, np.ones(ROWS), 2, learner.run(["a", "b"]))
    assert (model.features == wanted.features).all() and (model.cuts == wanted.cuts).all()
    assert np.allclose(model.leaves, wanted.leaves, rtol=1e-9, atol=0) and np.allclose(model.gains, wanted.gains, rtol=1e-9)


def test_the_tree_search_on_counted_rows_is_that_of_rows(spark):
    train, k = bought(spark, 1500).cache(), 3
    learner, grid = md.TreeLearner(rounds=8, patience=3), [{"rate": 0.1, "depth": 2}, {"rate": 0.3, "depth": 3}]
    found = {(r["learning_rate"], r["depth"]): r for r in compare.tune_trees(train, learner, grid, k).collect()}
    labels = label_list(train, label=learner.label)
    folds = stratified_kfold(train, learner.label, k=k).cache()
    for f in range(k):
        own, asked = learner.encode(folds.where(F.col("fold") != f).drop("fold"), folds.where(F.col("fold") == f).drop("fold"), labels)
        parts = []
        for df in (own, asked):
            t = df.orderBy("row_id").toArrow()
            y = np.array([labels.index(c) for c in t["category"].to_pylist()])
            parts.append((t["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1), y))
        for setting in grid:
            _, curve = boosting.grow(*parts[0], np.ones(len(parts[0][1])), len(labels), md.replace(learner, **setting).run(labels), parts[1])
            row = found[setting["rate"], setting["depth"]]
            assert row["fold_scores"][f] == pytest.approx(max(curve)) and row["fold_best_iterations"][f] == (int(np.argmax(curve)) or 1000)


def test_the_ablation_on_counted_rows_is_that_of_rows(spark):
    train, valid = bought(spark, 1500).cache(), bought(spark, 400, 1500).cache()
    learner = md.TreeLearner(rounds=6, depth=3, patience=None)
    nested, _ = compare.ablation_2x2(train, valid, learner, seeds=[0], cells={"baseline": (True, False), "class_weighted": (True, True)})
    for r in nested.collect():
        scored = md.replace(learner, balanced=r["run_name"] == "class_weighted", seed=0).fit_score(train, valid)
        hits = scored.where("cv_pred = category").count()
        assert r["accuracy"]["mean"] == pytest.approx(hits / 400)


def test_rounded_amounts_keep_cuts_and_sides(spark):
    train, rows = bought(spark, 3000).cache(), bought(spark, 500, 3000).withColumn("amount", F.col("amount") * 3).cache()
    learner = md.TreeLearner()
    lifted = learner.rounded(train, rows)
    number = lambda df: np.nan_to_num(df.orderBy("row_id").select(learner._amount().alias("v")).toArrow()["v"].to_numpy())
    cuts = boosting.cut_points(number(train), md.NUMBER_BINS)
    assert (boosting.cut_points(number(lifted[0]), md.NUMBER_BINS) == cuts).all() and len(np.unique(number(lifted[1]))) <= md.NUMBER_BINS
    for before, after in zip((train, rows), lifted):
        assert after.columns == before.columns
        assert (np.searchsorted(cuts, number(before)) == np.searchsorted(cuts, number(after))).all()


def test_cuts_of_counted_values_are_those_of_rows(spark):
    groups, bins = {}, {}
    for n, k in ((1, 16), (2, 64), (37, 16), (500, 64), (4001, 7)):
        rng = np.random.default_rng(n)
        drawn = {"u": rng.normal(0, 10, n).round(1), "v": rng.integers(-3, 3, n) * 1.0, "w": np.append(rng.random(n - 1), np.inf)}
        groups.update({f"{g}{n}": x for g, x in drawn.items()})
        bins.update({f"{g}{n}": k for g in drawn})
    rows = [(g, float(v), int(c)) for g, x in groups.items() for v, c in zip(*np.unique(x, return_counts=True))]
    found = boosting.table_cuts(spark.createDataFrame(rows, "key string, value double, n long"), bins)
    for g, x in groups.items():
        assert found[g].tolist() == boosting.cut_points(x, bins[g]).tolist()


def test_ranks_of_rows_that_stand_for_many(spark):
    df = spark.createDataFrame([(i, 1 + i % 5) for i in range(9000)], "v long, times long")
    whole = np.repeat(np.arange(9000), 1 + np.arange(9000) % 5)
    places = [0, 17, 5000, len(whole) - 1]
    found = ranks.locate_ranks(df, F.col("v"), [(None, p) for p in places], times="times")
    assert [p.value for p in found] == whole[places].tolist()
    assert [p.less for p in found] == [int((whole < whole[p]).sum()) for p in places]
