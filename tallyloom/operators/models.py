"""Learners: fit on training rows, score other rows with ``cv_pred`` and ``true_label_prob``.

Every learner has ``fit_score(train, rows, weight)``. Spark ML fits the features; the settings of a grid are
fitted in shared scans (``linear``) or in one job (``boosting``), and folds side by side.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from math import ceil
from typing import ClassVar, NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.operators import boosting, features as ft, linear
from tallyloom.operators.impute import sample_weights
from tallyloom.operators.metrics import scores_from_counts
from tallyloom.operators.noise import CountingScorer
from tallyloom.operators.schema import label_list
from tallyloom.operators.split import stratified_kfold
from tallyloom.runtime import discard, literal_table, materialise


def side_by_side(jobs: list, parallelism: int) -> list:
    """Results of the jobs in order, a few of them running at a time."""
    if parallelism <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    with ThreadPoolExecutor(parallelism) as pool:
        wrap = inheritable_thread_target(SparkSession.getActiveSession())
        return [f.result() for f in [pool.submit(wrap(job)) for job in jobs]]


def _kept(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in ("cv_pred", "true_label_prob")]


@dataclass(frozen=True)
class Learner:
    label: str = "category"
    spec: ft.FeatureSpec = ft.NARROW
    balanced: bool = True
    parallelism: int = 4

    def fit_score(self, train: DataFrame, rows: DataFrame, weight: str | None = None) -> DataFrame:
        raise NotImplementedError

    def out_of_fold(self, folded: DataFrame, k: int = 5, fold: str = "fold") -> DataFrame:
        """Every row scored by the model that did not see its fold; one fit per fold."""
        stored = materialise(folded, "folded")

        def one(f: int) -> DataFrame:
            scored = self.fit_score(stored.where(F.col(fold) != f), stored.where(F.col(fold) == f))
            return materialise(scored, "oof")

        parts = side_by_side([lambda f=f: one(f) for f in range(k)], self.parallelism)
        return reduce(DataFrame.unionByName, parts)


#: Rows of one task in a scan, at least: where there are tasks for all cores, and where there are not.
SCAN_ROWS, SPREAD_ROWS = 16_384, 4096


class Prepared(NamedTuple):
    """Fitted feature stages, labels, number of terms, and the stored training rows, which many fits share."""

    features: PipelineModel
    labels: list[str]
    size: int
    data: DataFrame

    def rows(self, rows: DataFrame, label: str, *keep: str) -> DataFrame:
        """Rows as the linear models take them; ``y`` is -1 for an unknown label."""
        place = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in self.labels]), F.col(label)) - 1, F.lit(-1))
        return self.features.transform(rows).select(*keep, *linear.sparse("features"), place.cast("int").alias("y"))


@dataclass(frozen=True)
class LinearLearner(Learner):
    """Shared part of the linear models: features are fitted once per training set, and all settings on it in the same scans."""

    C: float = 1.0
    max_iter: int = 5000
    tol: float = 1e-4
    loss: ClassVar[str]
    probabilities: ClassVar[bool]

    def prepare(self, train: DataFrame, weight: str | None = None, keep: list[str] = []) -> Prepared:  # noqa: B006
        """Features, and the training rows as ``linear.fit_runs`` takes them.

        The objectives are sums over rows, so rows of equal inputs and label are one row with their weights added up: one
        aggregate, after which features and scans cost by the combinations there are, of which there may be as many as rows.
        """
        labels = label_list(train, label=self.label)
        own = list(dict.fromkeys([*self.spec.inputs, self.label, *keep]))
        sums = [F.sum(F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("w"), F.count("*").alias("_n")]
        grouped = materialise(train.groupBy(*own).agg(*sums), "grouped")
        model = ft.fit_features(train, self.spec, grouped=grouped, times="_n")
        weighed = sample_weights(grouped, self.label, None, "cw", counted=train)
        ready = Prepared(model, labels, ft.vector_size(model), weighed)
        data = ready.rows(weighed.withColumns({c: F.col(c).cast("double") for c in ("w", "cw")}), self.label, "w", "cw", *keep).where("y >= 0")
        rows = grouped.count()
        tasks = min(ceil(rows / SPREAD_ROWS), train.sparkSession.sparkContext.defaultParallelism)
        if grouped.rdd.getNumPartitions() < tasks:  # few bytes, but a scan costs rows x runs x classes
            data = data.repartition(tasks)
        stored = materialise(data, "vectors")
        discard(grouped)
        few = stored.coalesce(max(1, tasks, ceil(rows / SCAN_ROWS)))  # a scan of a small table is mostly start of tasks
        few._stored_at = stored._stored_at
        return ready._replace(data=few)

    def run(self, bit: int | None = None) -> linear.Run:
        return linear.Run(self.loss, self.C, self.balanced, bit)

    def fit(self, ready: Prepared, runs: list[linear.Run] | None = None) -> list:
        """Coefficients of every run (of this setting alone, if none are given) in shared scans."""
        return linear.fit_runs(ready.data, runs or [self.run()], ready.size, len(ready.labels), self.max_iter, self.tol)

    def apply(self, ready: Prepared, model, rows: DataFrame) -> DataFrame:
        keep = _kept(rows)
        return linear.score(ready.rows(rows, self.label, *dict.fromkeys([*keep, self.label])), model, ready.size, ready.labels, self.label, keep, self.probabilities)

    def count_runs(self, train: DataFrame, rows: DataFrame, drops: list[Column], run: str = "run") -> DataFrame:
        """(run, actual, predicted, n) of one fit per condition of rows to leave out, all fits in the same scans.

        Features are fitted once, on all training rows. A row carries one bit per run that keeps it, and a balanced
        run has the class weights of its own rows.
        """
        kept = [~F.coalesce(d, F.lit(False)) for d in drops]
        bits = [F.when(k, F.lit(1 << (i % 63))).otherwise(F.lit(0)).cast("long") for i, k in enumerate(kept)]
        words = [reduce(Column.bitwiseOR, bits[at : at + 63]) for at in range(0, len(bits), 63)]
        ready = self.prepare(train.withColumn("keep", F.array(*words)), keep=["keep"])
        sizes = train.groupBy(self.label).agg(F.array(*[F.count_if(k) for k in kept]).alias("n")).collect()  # one row per label
        counts = {r[self.label]: r["n"] for r in sizes}
        runs = []
        for i in range(len(drops)):
            own = [counts[y][i] for y in ready.labels]
            used = sum(n > 0 for n in own)
            runs.append(replace(self.run(i), classes=tuple(sum(own) / (used * n) if n else 0.0 for n in own)))
        models = linear.fit_runs(ready.data, runs, ready.size, len(ready.labels), self.max_iter, self.tol)
        names = F.array(*[F.lit(y) for y in ready.labels])
        found = linear.count_predictions(ready.rows(rows, self.label), models, ready.size)
        named = found.select(F.col("run").alias(run), F.try_element_at(names, F.col("actual") + 1).alias("actual"), F.element_at(names, F.col("predicted") + 1).alias("predicted"), "n")
        counted = materialise(named, "counts")
        discard(ready.data)
        return counted

    def fit_score(self, train: DataFrame, rows: DataFrame, weight: str | None = None) -> DataFrame:
        ready = self.prepare(train, weight)
        scored = self.apply(ready, self.fit(ready)[0], rows)
        discard(ready.data)
        return scored


@dataclass(frozen=True)
class LogisticLearner(LinearLearner):
    """Multinomial logistic regression minimising C * sum(w * loss) + |coef|^2 / 2."""

    C: float = 2.0
    max_iter: int = 3000
    loss = linear.LOGISTIC
    probabilities = True


@dataclass(frozen=True)
class SvmLearner(LinearLearner):
    """One-vs-rest linear SVM with squared hinge loss; ``true_label_prob`` holds the margin of the row's own label.

    The class weight applies to a class's own rows, the others count 1.
    """

    spec: ft.FeatureSpec = ft.ONE_HOT
    loss = linear.SQUARED_HINGE
    probabilities = False


#: Quantile bins of the amount and of each label rate.
NUMBER_BINS, RATE_BINS = 64, 16


@dataclass(frozen=True)
class TreeLearner(Learner):
    """Multi-class boosted trees on amount and out-of-fold label rates of the categories.

    With ``patience`` one stratified fold is held out, scored after every round, and the ensemble is cut to its best
    round. Label rates, class weights, fits and scores cover all rows. Trees and label rates take rows by their categories and
    the bin of their amount, so fits whose rows are not asked for one by one work on rows counted by these (``counted``).
    """

    rate: float = 0.1
    depth: int = 4
    rounds: int = 1000
    patience: int | None = 50
    seed: int = 0
    balanced: bool = False
    columns: tuple[str, ...] = ("description", "transaction_type", "account_name")
    number: str = "amount"

    def _amount(self) -> Column:
        return F.coalesce(F.nanvl(F.col(self.number).cast("double"), F.lit(0.0)), F.lit(0.0))

    def rounded(self, train: DataFrame, rows: DataFrame, by: str | None = None) -> tuple[DataFrame, DataFrame]:
        """(train, rows) with the amount rounded up to the next of its cuts in ``train``, and beyond the last one to the largest.

        The cuts are the same after that, and every amount is on the same side of each, so trees and their scores are too.
        ``by`` separates parts that have their own cuts.
        """
        own = F.lit("*") if by is None else F.col(by).cast("string")
        values = materialise(train.groupBy(own.alias("key"), self._amount().alias("value")).agg(F.count("*").alias("n")), "values")
        most = {r["key"]: r["most"] for r in values.groupBy("key").agg(F.max("value").alias("most")).collect()}
        cuts = boosting.table_cuts(values, dict.fromkeys(most, NUMBER_BINS))
        discard(values)
        table = literal_table(train.sparkSession, [{"_key": k, "_cuts": [*cuts[k].tolist(), v]} for k, v in most.items()], "_key string, _cuts array<double>")
        not_above = F.get(F.filter("_cuts", lambda c: c >= F.col("_amount")), F.lit(0))

        def lift(df: DataFrame) -> DataFrame:
            joined = df.withColumns({"_amount": self._amount(), "_key": own}).join(table, "_key", "left")
            return joined.withColumn(self.number, F.coalesce(not_above, F.element_at("_cuts", -1), "_amount")).drop("_amount", "_key", "_cuts")

        return lift(train), lift(rows)

    def counted(self, rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
        """Rows alike in everything a fit asks of them as one row that stands for ``n``, stored, with a ``row_id`` of its own."""
        keys = [*by, *self.columns, self.number, self.label]
        same = rows.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in self.columns}).groupBy(*keys).agg(F.count("*").alias("n"))
        return materialise(same.withColumn("row_id", F.xxhash64(*keys)), "counted")

    def encode(self, train: DataFrame, rows: DataFrame, labels: list[str], by: tuple[str, ...] = (), times: str | None = None) -> tuple[DataFrame, DataFrame]:
        """(train, rows) with the vector ``x`` of the amount and the label rates of every categorical column, stored.

        ``by`` columns separate parts that are encoded for themselves, in the same jobs. With ``times`` training rows stand
        for that many, and have the ``fold`` of their label rates.
        """
        fill = {c: F.coalesce(F.col(c), F.lit("")) for c in self.columns}
        train, rows = train.withColumns(fill), rows.withColumns(fill)
        folded = train if times else materialise(stratified_kfold(train, self.label, seed=self.seed, by=by), "folded")
        own, asked = folded, rows
        for c in self.columns:
            scorer = CountingScorer(keys=(c,), label=self.label, by=by)
            own = scorer.out_of_fold_rates(folded, labels, f"te_{c}", onto=own, times=times)
            asked = scorer.fit_rates(folded, rows, labels, f"te_{c}", onto=asked, times=times)
        vector = F.concat(F.array(self._amount()), *[F.col(f"te_{c}") for c in self.columns])
        rates = [f"te_{c}" for c in self.columns]
        return materialise(own.withColumn("x", vector).drop(*rates), "encoded"), materialise(asked.withColumn("x", vector).drop(*rates), "encoded")

    def places(self, labels: list[str], columns: tuple[str, ...] | None = None) -> tuple[int, ...]:
        """Positions in ``x`` of the amount and of the label rates of some columns."""
        used = self.columns if columns is None else columns
        rates = [1 + i * len(labels) + j for i, c in enumerate(self.columns) if c in used for j in range(len(labels))]
        return (0, *rates)

    def run(self, labels: list[str], part: int = 0, features: tuple[int, ...] | None = None) -> boosting.Run:
        bins = (NUMBER_BINS, *[RATE_BINS] * (len(self.columns) * len(labels)))
        return boosting.Run(part, self.rate, self.depth, self.rounds, self.patience, self.balanced, features, bins)

    def growable(
        self, encoded: DataFrame, labels: list[str], weight: str | None = None, part: Column | None = None, held: Column | None = None, times: str | None = None
    ) -> DataFrame:
        """Encoded rows as ``boosting.grow_runs`` takes them; one stands for ``times`` rows, if named."""
        part, held = F.lit(0) if part is None else part, F.lit(False) if held is None else held
        place = F.array_position(F.array(*[F.lit(y) for y in labels]), F.col(self.label)) - 1
        n = F.lit(1).cast("long") if times is None else F.col(times)
        w = (F.lit(1.0) if weight is None else F.col(weight).cast("double")) * n
        rows = encoded.select(part.cast("int").alias("part"), held.alias("held"), "x", place.cast("int").alias("y"), w.alias("w"), n.alias("n"))
        sums = rows.where(~F.col("held")).groupBy("part", "y").agg(F.sum("n").alias("n")).groupBy("part").agg(
            F.sum("n").alias("all_n"), F.count("*").alias("k"), F.map_from_entries(F.collect_list(F.struct("y", "n"))).alias("per")
        )
        weight_of = (F.col("all_n") / (F.col("k") * F.col("per")[F.col("y")])).alias("cw")
        rows = rows.where("y >= 0").join(F.broadcast(sums), "part")  # one row per part
        return rows.select("part", "held", "x", "y", "w", "n", F.coalesce(weight_of, F.lit(0.0)).alias("cw"))

    def grow(self, encoded: DataFrame, labels: list[str], weight: str | None = None) -> boosting.Ensemble:
        """The ensemble of this setting; with patience, a fold other than those of the label rates is held out."""
        held = None
        if self.patience is not None:
            encoded = materialise(stratified_kfold(encoded.drop("fold"), self.label, seed=self.seed + 1), "held")
            held = F.col("fold") == 0
        runs = [self.run(labels)]
        return boosting.ensembles(boosting.grow_runs(self.growable(encoded, labels, weight, held=held), runs, len(labels)), runs, len(labels))[0]

    def fit_score(self, train: DataFrame, rows: DataFrame, weight: str | None = None) -> DataFrame:
        labels = label_list(train, label=self.label)
        own, others = self.encode(train, rows, labels)
        model = self.grow(own, labels, weight)
        return boosting.predict(others.withColumn("model", F.lit("one")), {"one": model}, labels, self.label, _kept(rows))

    def importance(self, model: boosting.Ensemble, labels: list[str]) -> list[tuple[str, float]]:
        """Share of the gains of all splits per source column in percent, descending."""
        names = [self.number] + [c for c in self.columns for _ in labels]
        totals = dict.fromkeys(names, 0.0)
        for name, gain in zip(names, model.gains):
            totals[name] += 100.0 * float(gain) / max(float(model.gains.sum()), 1e-300)
        return sorted(totals.items(), key=lambda kv: (-kv[1], kv[0]))


def feature_importance(train: DataFrame, learner: TreeLearner) -> DataFrame:
    labels = label_list(train, label=learner.label)
    own, _ = learner.encode(train, train.limit(0), labels)
    rows = learner.importance(learner.grow(own, labels), labels)
    return train.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


@dataclass
class GridResult:
    best: dict
    runs: DataFrame
    trace: DataFrame = field(repr=False)


def grid_search(train: DataFrame, learner: LinearLearner, grid: list[dict], folds: DataFrame, k: int, fold: str = "fold", parallelism: int = 4) -> GridResult:
    """Weighted F1 of every setting on every fold; features are fitted inside the fold, once for all settings.

    The best setting has the highest mean, the first listed one on equal means.
    """
    stored = materialise(folds, "folds")

    def one(f: int) -> DataFrame:
        own, other = stored.where(F.col(fold) != f), stored.where(F.col(fold) == f)
        return fold_scores([replace(learner, **setting) for setting in grid], own, other).withColumn("fold", F.lit(f))

    parts = side_by_side([lambda f=f: one(f) for f in range(k)], parallelism)
    runs = reduce(DataFrame.unionByName, parts).select(F.col("run").alias("config"), "fold", "weighted_f1")
    trace = runs.groupBy("config").agg(F.avg("weighted_f1").alias("mean_weighted_f1"), F.stddev_pop("weighted_f1").alias("std_weighted_f1"))
    trace = materialise(trace, "trace")
    best = trace.orderBy(F.desc(F.round("mean_weighted_f1", 12)), "config").first()["config"]
    return GridResult(grid[best], runs, trace)


def fold_scores(settings: list[LinearLearner], own: DataFrame, other: DataFrame) -> DataFrame:
    """Metrics per ``run`` on ``other`` of all settings fitted on ``own``, stored: features are fitted once, the fits
    share their scans, and one pass counts the predictions. The settings see the same columns."""
    base = settings[0]
    if any((m.spec, m.label) != (base.spec, base.label) for m in settings):
        raise ValueError("settings see different columns")
    ready = base.prepare(own)
    max_iter, tol = max(m.max_iter for m in settings), min(m.tol for m in settings)
    models = linear.fit_runs(ready.data, [m.run() for m in settings], ready.size, len(ready.labels), max_iter, tol)
    counts = linear.count_predictions(ready.rows(other, base.label), models, ready.size)
    scores = materialise(scores_from_counts(counts, ("run",)), "fold-scores")
    discard(ready.data)
    return scores


def timed(job):
    start = time.perf_counter()
    result = job()
    return result, time.perf_counter() - start


SVM_MODES = {
    "one_hot": SvmLearner(spec=ft.ONE_HOT, balanced=False),
    "one_hot_balanced": SvmLearner(spec=ft.ONE_HOT, balanced=True),
    "tfidf": SvmLearner(spec=ft.TFIDF_ALL, balanced=True),
    "no_desc": SvmLearner(spec=ft.ONE_HOT_NO_TEXT, balanced=True),
}
SVM_GRID = [{"C": c} for c in fixed.SVM_C_GRID]
LOGREG_GRID = [{"C": c} for c in fixed.LOGREG_C_GRID]
TREE_GRID = [{"rate": r, "depth": d} for r in fixed.TREE_RATES for d in fixed.TREE_DEPTHS]
