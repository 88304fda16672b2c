"""Out-of-fold label scores and the flags built on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.operators.skew import keyed_join, salted_join
from tallyloom.runtime import literal_table, materialise, small_table, stored

NARROW_KEYS = ("description", "amount_bucket", "transaction_type")


def nested_marks(drops: list[Column], chains: list[list[int]]) -> Column:
    """Per chain that drops the row, (chain, place) of the first condition to do so.

    A chain lists conditions in growing order: each holds wherever the one before it holds.
    """
    marks = []
    for c, chain in enumerate(chains):
        first = F.lit(None).cast("struct<chain:int,place:int>")
        for place, i in reversed(list(enumerate(chain))):
            first = F.when(drops[i], F.struct(F.lit(c).alias("chain"), F.lit(place).alias("place"))).otherwise(first)
        marks.append(first)
    return F.array_compact(F.array(*marks))


def _one_row_per_mark() -> Column:
    """The marks of a row, and one that stands for the row itself."""
    return F.explode(F.array_append("marks", F.struct(F.lit(-1).alias("chain"), F.lit(-1).alias("place")))).alias("m")


def dropped_per_run(marked: DataFrame, chains: list[list[int]]) -> tuple[int, dict[int, int]]:
    """(number of rows, rows dropped by each run) of rows with ``marks``, from one aggregate with a row per cut."""
    here = marked.select(_one_row_per_mark()).groupBy("m.chain", "m.place").agg(F.count("*").alias("n")).collect()
    first = {(r["chain"], r["place"]): r["n"] for r in here}
    return first.get((-1, -1), 0), {i: sum(first.get((c, p), 0) for p in range(at + 1)) for c, chain in enumerate(chains) for at, i in enumerate(chain)}


@dataclass(frozen=True)
class CountingScorer:
    """P(label | keys) from label counts, pulled towards the label shares by one pseudo-row.

    Fitting is one aggregate, which is stored: the key table and the label shares both read it. Rows meet the per-key counts in one join that splits hot keys.
    """

    keys: tuple[str, ...] = NARROW_KEYS
    label: str = "category"
    strength: float = 1.0
    by: tuple[str, ...] = ()

    def _prior(self, counts: DataFrame, groups: tuple[str, ...]) -> DataFrame:
        """Per group: label shares as a map and the most frequent label."""
        per = counts.groupBy(*groups, self.label).agg(F.sum("n").alias("n")).where("n > 0")
        best = F.min(F.struct((-F.col("n")).alias("n"), F.col(self.label).alias("y")))["y"]
        total = F.sum("n")
        shares = F.map_from_entries(F.collect_list(F.struct(F.col(self.label), F.col("n"))))
        return per.groupBy(*groups).agg(best.alias("prior_best"), shares.alias("prior_n"), total.alias("total_n"))

    def _key_table(self, counts: DataFrame, groups: tuple[str, ...]) -> DataFrame:
        """Per group and key: label counts as a map, their sum and the strongest label."""
        listed = F.collect_list(F.struct(F.col("n"), F.col(self.label).alias("y")))
        return counts.where("n > 0").groupBy(*groups, *self.keys).agg(listed.alias("cells"), F.sum("n").alias("key_n"))

    @staticmethod
    def _with_prior(rows: DataFrame, prior: DataFrame, groups: tuple[str, ...]) -> DataFrame:
        if groups:
            return rows.join(prior, list(groups), "left")
        one = prior.select(F.struct("prior_best", "prior_n", "total_n").alias("p")).scalar()
        return rows.withColumns({c: one[c] for c in ("prior_best", "prior_n", "total_n")})

    def _attach(
        self, rows: DataFrame, key_table: DataFrame, prior: DataFrame, groups: tuple[str, ...], spread: str | None, own: dict[str, Column], counted: DataFrame | None = None
    ) -> DataFrame:
        """Rows with ``key_n`` and the columns ``own`` of their key, and their group's shares.

        ``own`` goes through the labels of a key, so it is worked out once per key, not once per row.
        """
        on = [*groups, *self.keys]
        prior = small_table(prior) if groups else prior
        known = self._with_prior(key_table, prior, groups).select(*on, "key_n", *[v.alias(c) for c, v in own.items()])
        joined = keyed_join(rows, known, on, spread, "left", counted) if spread else rows.join(known, on, "left")
        return self._with_prior(joined, prior, groups)

    def _rate(self, n: Column, y: Column) -> Column:
        share = F.coalesce(F.col("prior_n")[y], F.lit(0)) / F.col("total_n")
        strength = F.lit(self.strength)
        return (n + strength * share) / (F.coalesce("key_n", F.lit(0)) + strength)

    def _prob(self, n: Column, y: Column) -> Column:
        """The rate to 9 digits, so that labels of equal counts tie."""
        return F.round(self._rate(n, y), 9)

    @staticmethod
    def _cell(y: Column) -> Column:
        """The count of label ``y`` under the row's key."""
        return F.coalesce(F.try_element_at(F.filter("cells", lambda c: c["y"] == y), F.lit(1))["n"], F.lit(0))

    def _best(self) -> Column:
        """The likeliest label of the row's key, or of its group."""
        ranked = F.array_min(F.transform("cells", lambda c: F.struct((-self._prob(c["n"], c["y"])).alias("p"), c["y"].alias("y"))))
        return F.coalesce(ranked["y"], F.col("prior_best"))

    def _score(self, rows: DataFrame, key_table: DataFrame, prior: DataFrame, groups: tuple[str, ...], spread: str | None) -> DataFrame:
        probs = F.map_from_arrays(F.transform("cells", lambda c: c["y"]), F.transform("cells", lambda c: self._prob(c["n"], c["y"])))
        joined = self._attach(rows, key_table, prior, groups, spread, {"_best": self._best(), "_probs": probs})
        columns = [c for c in rows.columns if c not in ("cv_pred", "true_label_prob")]
        label = F.col(self.label)
        return joined.select(
            *columns,
            F.coalesce("_best", "prior_best").alias("cv_pred"),
            F.coalesce(F.col("_probs")[label], self._prob(F.lit(0), label)).alias("true_label_prob"),
        )

    def _with_rates(
        self, onto: DataFrame, key_table: DataFrame, prior: DataFrame, groups: tuple[str, ...], spread: str, counted: DataFrame, labels: list[str], out: str
    ) -> DataFrame:
        known = F.array(*[self._rate(self._cell(F.lit(y)), F.lit(y)) for y in labels])
        joined = self._attach(onto, key_table, prior, groups, spread, {"_rates": known}, counted)
        return joined.select(*onto.columns, F.coalesce("_rates", F.array(*[self._rate(F.lit(0), F.lit(y)) for y in labels])).alias(out))

    def _other_folds(self, folded: DataFrame, k: int, fold: str, times: str | None = None) -> DataFrame:
        """Label counts per key and fold over all other folds, from one aggregate of the rows. A row stands for ``times`` rows, if named."""
        one = F.lit(1) if times is None else F.col(times)
        per_fold = [F.sum(F.when(F.col(fold) == f, one).otherwise(0)).alias(f"f{f}") for f in range(k)]
        cells = folded.groupBy(*self.by, *self.keys, self.label).agg(F.sum(one).alias("all_n"), *per_fold)
        others = F.array(*[F.struct(F.lit(f).alias(fold), (F.col("all_n") - F.col(f"f{f}")).alias("n")) for f in range(k)])
        return materialise(cells, "counts").select(*self.by, *self.keys, self.label, F.explode(others).alias("o")).select(
            *self.by, *self.keys, self.label, F.col(f"o.{fold}").alias(fold), F.col("o.n").alias("n")
        )

    def out_of_fold(self, folded: DataFrame, k: int = 5, fold: str = "fold", spread: str = "row_id") -> DataFrame:
        """Score every row with the counts of the other folds. ``by`` columns (a seed) separate runs."""
        folded = stored(folded, "folded")
        counts = self._other_folds(folded, k, fold)
        groups = (*self.by, fold)
        return self._score(folded, self._key_table(counts, groups), self._prior(counts, groups), groups, spread)

    def out_of_folds(self, folded: DataFrame, seeds: list[int], k: int = 5, folds: str = "folds", spread: str = "row_id") -> DataFrame:
        """``folded`` (one fold per seed in the array ``folds``) with ``runs``: (seed, cv_pred, true_label_prob) per seed.

        One aggregate counts all seeds and folds. Every key is scored once per seed and fold, and one join brings its
        scores to its rows.
        """
        places = [(i, f) for i in range(len(seeds)) for f in range(k)]
        per = F.array(*[F.array(*[F.count_if(F.col(folds)[i] == f) for f in range(k)]) for i in range(len(seeds))])
        cells = folded.groupBy(*self.keys, self.label).agg(F.count("*").alias("all_n"), per.alias("per"))
        grid = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("f")) for i, f in places]))
        left = F.col("all_n") - F.col("per")[F.col("g.i")][F.col("g.f")]
        counts = cells.select(self.label, "all_n", "per", grid.alias("g")).select(self.label, "g.i", "g.f", left.alias("n"))
        prior = self._prior(counts, ("i", "f")).select(F.struct("i", "f").alias("k"), F.struct("prior_best", "prior_n", "total_n").alias("v"))
        priors = prior.agg(F.map_from_entries(F.collect_list(F.struct("k", "v")))).scalar()
        per_key = cells.groupBy(*self.keys).agg(F.collect_list(F.struct(F.col(self.label).alias("y"), "all_n", "per")).alias("cells"))
        per_key = per_key.select(*self.keys, *[self._left(i, f).alias(f"_c{i}_{f}") for i, f in places])
        none = F.lit(0).cast("long")
        per_key = per_key.withColumns({f"_n{i}_{f}": F.aggregate(f"_c{i}_{f}", none, lambda a, c: a + c["n"]) for i, f in places}).withColumn("_priors", priors)
        at = lambda i, f: F.col("_priors")[F.struct(F.lit(i).alias("i"), f.alias("f"))]
        scored = [F.array(*[self._scored(F.col(f"_c{i}_{f}"), F.col(f"_n{i}_{f}"), at(i, F.lit(f))) for f in range(k)]) for i in range(len(seeds))]
        key_table = per_key.select(*self.keys, F.array(*scored).alias("_scored"))
        joined = salted_join(folded, key_table, list(self.keys), spread, "left").withColumn("_priors", priors)
        runs = []
        for i, s in enumerate(seeds):
            fold = F.col(folds)[i]
            own, prior, y = F.col("_scored")[i][fold], at(i, fold), F.col(self.label)
            rate = F.coalesce(own["probs"][y], self._smoothed(F.lit(0), y, F.coalesce(own["key_n"], F.lit(0)), prior))
            runs.append(F.struct(F.lit(s).alias("seed"), F.coalesce(own["best"], prior["prior_best"]).alias("cv_pred"), rate.alias("true_label_prob")))
        return joined.select(*folded.columns, F.array(*runs).alias("runs"))

    @staticmethod
    def _left(i: int, fold: int) -> Column:
        """Counts of a key over the other folds of seed ``i``."""
        others = F.transform("cells", lambda c: F.struct(c["y"].alias("y"), (c["all_n"] - c["per"][i][fold]).alias("n")))
        return F.filter(others, lambda c: c["n"] > 0)

    def _smoothed(self, n: Column, y: Column, key_n: Column, prior: Column) -> Column:
        strength = F.lit(self.strength)
        share = F.coalesce(prior["prior_n"][y], F.lit(0)) / prior["total_n"]
        return F.round((n + strength * share) / (key_n + strength), 9)

    def _scored(self, cells: Column, key_n: Column, prior: Column) -> Column:
        """The likeliest label of a key, its labels' probabilities, and its rows."""
        prob = lambda c: self._smoothed(c["n"], c["y"], key_n, prior)
        best = F.array_min(F.transform(cells, lambda c: F.struct((-prob(c)).alias("p"), c["y"].alias("y"))))["y"]
        probs = F.map_from_arrays(F.transform(cells, lambda c: c["y"]), F.transform(cells, prob))
        return F.struct(best.alias("best"), probs.alias("probs"), key_n.alias("key_n"))

    def fit_score(self, train: DataFrame, rows: DataFrame, weight: str | None = None, spread: str = "row_id") -> DataFrame:
        """Count on ``train`` (or add up its weights), score ``rows``. ``by`` columns separate runs in one job."""
        amount = F.count("*") if weight is None else F.sum(weight)
        counts = materialise(train.groupBy(*self.by, *self.keys, self.label).agg(amount.alias("n")), "counts")
        return self._score(rows, self._key_table(counts, self.by), self._prior(counts, self.by), self.by, spread)

    def count_runs(self, marked: DataFrame, rows: DataFrame, chains: list[list[int]], run: str = "run") -> DataFrame:
        """(run, actual, predicted, n) of one fit per run, on training rows with the ``marks`` of ``nested_marks``.

        A cell (key, label) holds its row count and, per cut, the rows that the cut is the first to drop, so untouched cells
        cost nothing per run. Keys meet the scored cells once; what differs between runs is worked out inside the row
        and added up before the last shuffle.
        """
        each = marked.select(*self.keys, self.label, _one_row_per_mark()).select(*self.keys, self.label, "m.chain", "m.place")
        whole, size = F.col("chain") < 0, F.col("n")
        cells = materialise(each.groupBy(*self.keys, self.label, "chain", "place").agg(F.count("*").alias("n")), "counts")
        dropped = F.collect_list(F.when(~whole, F.struct("chain", "place", "n"))).alias("dropped")
        per_label = cells.repartition(*self.keys).groupBy(*self.keys, self.label).agg(F.sum(F.when(whole, size)).alias("n"), dropped)
        key_table = per_label.groupBy(*self.keys).agg(F.collect_list(F.struct(F.col(self.label).alias("y"), "n", "dropped")).alias("all_cells"))

        steps = [{"run": i, "chain": c, "place": p, "sign": -1} for c, chain in enumerate(chains) for at, i in enumerate(chain) for p in range(at + 1)]
        steps += [{"run": i, "chain": -1, "place": -1, "sign": 1} for chain in chains for i in chain]
        step_table = literal_table(rows.sparkSession, steps, "run int, chain int, place int, sign int")
        by_label = cells.groupBy(self.label, "chain", "place").agg(F.sum("n").alias("n"))
        totals = by_label.join(step_table, ["chain", "place"]).groupBy("run", self.label).agg(F.sum(F.col("n") * F.col("sign")).alias("n"))

        asked = rows.groupBy(*self.keys, self.label).agg(F.count("*").alias("asked_n")).join(key_table, list(self.keys), "left")
        cuts = [F.struct(F.lit(i).alias("run"), F.lit(c).alias("chain"), F.lit(at).alias("place")) for c, chain in enumerate(chains) for at, i in enumerate(chain)]
        per_run = asked.select("*", F.explode(F.array(*cuts)).alias("c")).select("*", "c.*")
        gone = lambda d: (d["chain"] == F.col("chain")) & (d["place"] <= F.col("place"))
        add = lambda total, d: total + d["n"]
        none = F.lit(0).cast("long")
        left = F.transform("all_cells", lambda c: F.struct((c["n"] - F.aggregate(F.filter(c["dropped"], gone), none, add)).alias("n"), c["y"].alias("y")))
        kept = per_run.select("run", self.label, "asked_n", F.filter(left, lambda c: c["n"] > 0).alias("cells"))
        joined = kept.withColumn("key_n", F.aggregate("cells", none, add)).join(small_table(self._prior(totals, ("run",))), "run", "left")
        guess = joined.select(F.col("run").alias(run), F.col(self.label).alias("actual"), self._best().alias("predicted"), "asked_n")
        return guess.groupBy(run, "actual", "predicted").agg(F.sum("asked_n").alias("n"))

    def out_of_fold_rates(
        self, folded: DataFrame, labels: list[str], out: str, k: int = 5, fold: str = "fold", spread: str = "row_id", onto: DataFrame | None = None, times: str | None = None
    ) -> DataFrame:
        """Array of smoothed label rates of the row's key over the other folds, added to ``onto``. A row stands for ``times`` rows, if named."""
        onto = folded if onto is None else onto
        counts, groups = self._other_folds(folded, k, fold, times), (*self.by, fold)
        return self._with_rates(onto, self._key_table(counts, groups), self._prior(counts, groups), groups, spread, folded, labels, out)

    def fit_rates(
        self, train: DataFrame, rows: DataFrame, labels: list[str], out: str, spread: str = "row_id", onto: DataFrame | None = None, times: str | None = None
    ) -> DataFrame:
        onto = rows if onto is None else onto
        amount = F.count("*") if times is None else F.sum(times)
        counts = materialise(train.groupBy(*self.by, *self.keys, self.label).agg(amount.alias("n")), "counts")
        return self._with_rates(onto, self._key_table(counts, self.by), self._prior(counts, self.by), self.by, spread, rows, labels, out)


def categorical_target_stats(folded: DataFrame, columns: list[str], labels: list[str], label: str = "category", k: int = 5) -> DataFrame:
    """Per categorical column the out-of-fold label rates, as the array ``te_<column>``."""
    out = folded
    for c in columns:
        out = CountingScorer(keys=(c,), label=label).out_of_fold_rates(folded, labels, f"te_{c}", k, onto=out)
    return out


def repeated_scores(runs: DataFrame, features: list[str], label: str = "category", min_wrong: int = 2, threshold: float = fixed.SUSPICIOUS_PROB) -> DataFrame:
    """Combine the runs of several seeds: mean probability, count of wrong predictions, flag."""
    wrong = (F.col("cv_pred") != F.col(label)).cast("int")
    merged = runs.groupBy("row_id").agg(
        *[F.first(c).alias(c) for c in (*features, label)],
        F.avg("true_label_prob").alias("mean_true_label_prob"),
        F.sum(wrong).cast("int").alias("wrong_cv_count"),
    )
    flagged = (F.col("wrong_cv_count") >= min_wrong) & (F.col("mean_true_label_prob") < threshold)
    return merged.withColumn("flagged_suspicious", flagged)


def combined_runs(scored: DataFrame, label: str = "category", min_wrong: int = 2, threshold: float = fixed.SUSPICIOUS_PROB) -> DataFrame:
    """As ``repeated_scores``, for rows that carry the ``runs`` of all seeds."""
    total = F.aggregate("runs", F.lit(0.0), lambda a, r: a + r["true_label_prob"])
    wrong = F.size(F.filter("runs", lambda r: r["cv_pred"] != F.col(label)))
    merged = scored.withColumns({"mean_true_label_prob": total / F.size("runs"), "wrong_cv_count": wrong}).drop("runs", "folds")
    flagged = (F.col("wrong_cv_count") >= min_wrong) & (F.round("mean_true_label_prob", 9) < threshold)
    return merged.withColumn("flagged_suspicious", flagged)


def likely_mislabeled(noise: DataFrame, threshold: float = fixed.MISLABELED_PROB) -> DataFrame:
    return noise.where((F.col("true_label_prob") < threshold) & (F.col("wrong_flag") == 1))


def candidate_pool(noise: DataFrame, threshold: float = fixed.CANDIDATE_PROB) -> DataFrame:
    return noise.where(F.col("flagged_suspicious") & (F.col("true_label_prob") < threshold))


def align_noise(train: DataFrame, noise: DataFrame, columns: tuple[str, ...] = ("cv_pred", "true_label_prob", "flagged_suspicious")) -> DataFrame:
    """Attach noise scores by row id; rows without scores, or scores without a row, are an error."""
    joined = train.select("*", F.lit(1).alias("_t")).join(noise.select("row_id", *columns, F.lit(1).alias("_n")), "row_id", "full")
    gaps = joined.where(F.col("_t").isNull() | F.col("_n").isNull())
    if gaps.limit(1).count():
        raise ValueError("training rows and noise scores do not cover the same row ids")
    return joined.drop("_t", "_n")
