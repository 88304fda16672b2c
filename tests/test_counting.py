"""The counting scorer works through the labels of a key once per key, and scores as a plain loop does."""

from collections import Counter

from pyspark.sql import functions as F

from tallyloom.operators.noise import CountingScorer


def rows_of(spark):
    """Rows with hot, rare and null keys; ``folds`` holds one fold per seed, the first of them is ``fold``."""
    rows = [(i, None if i % 17 == 0 else "ab"[i % 2] if i % 5 else f"rare{i}", "xyz"[(i * i) % 3], [i % 5, (i // 5) % 5]) for i in range(120)]
    return spark.createDataFrame(rows, "row_id long, k string, category string, folds array<int>").withColumn("fold", F.col("folds")[0])


def expected(rows, at):
    """row id -> (label, probability) from the rows of other folds."""
    out = {}
    for r in rows:
        others = [o for o in rows if o["folds"][at] != r["folds"][at]]
        shares = Counter(o["category"] for o in others)
        cells = Counter(o["category"] for o in others if r["k"] is not None and o["k"] == r["k"])
        prob = lambda y: round((cells[y] + shares[y] / len(others)) / (sum(cells.values()) + 1), 9)  # noqa: E731, B023
        best = min(cells, key=lambda y: (-prob(y), y)) if cells else min(shares, key=lambda y: (-shares[y], y))
        out[r["row_id"]] = (best, prob(r["category"]))
    return out


def above_the_join(df):
    """What the optimised plan does to rows once they have met the table of their keys."""
    return df._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]


def test_scores_are_worked_out_per_key(spark):
    folded = rows_of(spark)
    scorer = CountingScorer(keys=("k",))
    one, many = scorer.out_of_fold(folded), scorer.out_of_folds(folded, [7, 8])
    rates = scorer.out_of_fold_rates(folded, ["x", "y", "z"], "te")
    for df in (one, many, rates):
        assert "lambda" not in above_the_join(df)
    rows = folded.collect()
    found = {r["row_id"]: (r["cv_pred"], r["true_label_prob"]) for r in one.collect()}
    assert {i: (y, round(p, 8)) for i, (y, p) in found.items()} == {i: (y, round(p, 8)) for i, (y, p) in expected(rows, 0).items()}
    runs = {r["row_id"]: r["runs"] for r in many.collect()}
    for at, seed in enumerate([7, 8]):
        wanted = expected(rows, at)
        for i, (y, p) in wanted.items():
            run = runs[i][at]
            assert (run["seed"], run["cv_pred"], round(run["true_label_prob"], 8)) == (seed, y, round(p, 8))
    own = {r["row_id"]: dict(zip("xyz", r["te"])) for r in rates.collect()}
    for r in rows:
        assert abs(own[r["row_id"]][r["category"]] - found[r["row_id"]][1]) < 1e-8
