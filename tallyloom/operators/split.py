"""Deterministic hold-out splits and folds.

Rows are ordered by a hash of their id, so membership does not depend on partitioning. The hold-out
split and the unshuffled folds only look up the hash or id at which a class reaches its quota, so the
rows themselves are never shuffled; shuffled folds number the rows inside (class, hash prefix) cells.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import hash_order, hash_prefix
from tallyloom.operators.ranks import key_bounds, locate_ranks
from tallyloom.runtime import join_rows, literal_table, materialise

PREFIX_DIGITS = 13


def class_counts(df: DataFrame, label: str, limit: int = 10_000) -> dict[str, int]:
    rows = df.groupBy(label).agg(F.count("*").alias("n")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} classes")
    return {r[0]: r["n"] for r in rows}


def holdout_quotas(counts: dict[str, int], fraction: float) -> dict[str, int]:
    """Validation rows per class by largest remainder; equal remainders go to the smaller label."""
    total = sum(counts.values())
    wanted = math.ceil(fraction * total)
    quotas = {c: n * wanted // total for c, n in counts.items()}
    by_remainder = sorted(counts, key=lambda c: (-(counts[c] * wanted % total), c))
    for c in by_remainder[: wanted - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def _hash_cuts(narrow: DataFrame, counts: dict[str, int], quotas: dict[str, int], seed: int) -> list[dict]:
    """The (hash, row id) of the last row inside each class's quota; ``narrow`` has _g, _r and _x."""
    wanted = [(c, k) for c, k in sorted(quotas.items()) if k > 0]
    if not wanted:
        return []
    bounds = {c: (0, 16**PREFIX_DIGITS, n) for c, n in counts.items()}
    places = locate_ranks(narrow, F.col("_x"), [(c, k - 1) for c, k in wanted], F.col("_g"), bounds)
    at = literal_table(
        narrow.sparkSession, [{"_g": c, "_at": int(p.value)} for (c, _), p in zip(wanted, places)], "_g string, _at long"
    )
    tied_rows = narrow.join(at, "_g").where(F.col("_x") == F.col("_at"))
    ties = tied_rows.select("_g", hash_order(F.col("_r"), seed).alias("_h"), "_r").collect()
    cuts = []
    for (c, k), place in zip(wanted, places):
        tied = sorted((r["_h"], r["_r"]) for r in ties if r["_g"] == c)
        h, r = tied[k - 1 - place.less]
        cuts.append({"_g": c, "_h": h, "_r": r})
    return cuts


def stratified_split(df: DataFrame, label: str = "category", fraction: float = 0.2, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Add ``split`` = ``train`` / ``valid`` with class shares kept; one class only: a plain split.

    The search for the cuts reads a written table of (class, id, hash prefix), so ``df`` itself is
    computed once for that table and once for the result.
    """
    prefix = hash_prefix(hash_order(F.col(row_id), seed), PREFIX_DIGITS)
    narrow = materialise(df.select(F.col(label).alias("_g"), F.col(row_id).alias("_r"), prefix.alias("_x")), "hashed")
    counts = class_counts(narrow, "_g")
    cuts = literal_table(df.sparkSession, _hash_cuts(narrow, counts, holdout_quotas(counts, fraction), seed), "_g string, _h string, _r long")
    cuts = cuts.select(F.col("_g").alias(label), F.col("_h").alias("_cut_h"), F.col("_r").alias("_cut_r"))
    h = hash_order(F.col(row_id), seed)
    inside = (h < F.col("_cut_h")) | ((h == F.col("_cut_h")) & (F.col(row_id) <= F.col("_cut_r")))
    marked = df.join(cuts, label, "left")
    return marked.withColumn("split", F.when(inside, "valid").otherwise("train")).select(*df.columns, "split")


def stratified_kfold(
    df: DataFrame, label: str = "category", k: int = 5, seed: int = 42, row_id: str = "row_id", digits: int = 3, by: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``fold`` in 0..k-1: rows of a class dealt out in hash order.

    Cells of (class, hash prefix) are even by construction, so one large class is spread over
    16**digits groups; the count join and the numbering share one shuffle on the cell key.
    """
    seed_col = F.col("seed") if "seed" in by else F.lit(seed)
    hashed = df.withColumn("_h", hash_order(F.col(row_id), seed_col)).withColumn("_cell", hash_prefix(F.col("_h"), digits))
    keys = [*by, label]
    cells = hashed.groupBy(*keys, "_cell").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.withColumn("_start", F.coalesce(F.sum("_n").over(running), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, "_cell").orderBy("_h", row_id)
    place = F.col("_start") + F.row_number().over(inside) - 1
    return hashed.join(starts.hint("shuffle_hash"), [*keys, "_cell"]).withColumn("fold", F.pmod(place, F.lit(k)).cast("int")).select(*df.columns, "fold")


def repeated_kfold(df: DataFrame, seeds: list[int], label: str = "category", k: int = 5, row_id: str = "row_id") -> DataFrame:
    """One copy of the rows per seed, with its ``seed`` and ``fold``."""
    copies = df.withColumn("seed", F.explode(F.array(*[F.lit(s) for s in seeds])))
    return stratified_kfold(copies, label, k, row_id=row_id, by=("seed",))


def folds_by_seed(df: DataFrame, seeds: list[int], label: str = "category", k: int = 5, row_id: str = "row_id") -> DataFrame:
    """Add ``folds``: the row's fold for each seed, in the order of ``seeds``. Only (row id, label) is repeated per seed."""
    long = repeated_kfold(df.select(row_id, label), seeds, label, k, row_id)
    place = F.array_position(F.array(*[F.lit(s) for s in seeds]), F.col("seed"))
    rows = long.groupBy(row_id).agg(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("i"), "fold"))), lambda x: x["fold"]).alias("folds"))
    return join_rows(df, rows, row_id)


def ordered_folds(df: DataFrame, label: str = "category", k: int = 3, row_id: str = "row_id") -> DataFrame:
    """Unshuffled stratified folds: every class is cut into k runs in row order.

    The run lengths are those of dealing the class-sorted rows round-robin, classes taken in order of
    first appearance. Only the row ids at which a run ends are looked up.
    """
    narrow = materialise(df.select(label, row_id), "ids")
    bounds = key_bounds(narrow, F.col(row_id), F.col(label))
    stats = {c: (n, first) for c, (first, _, n) in bounds.items()}
    start, ends = 0, []
    for c in sorted(stats, key=lambda c: stats[c][1]):
        size = stats[c][0]
        lengths = [len(range(start + (f - start) % k, start + size, k)) for f in range(k)]
        total = 0
        for f in range(k - 1):
            total += lengths[f]
            ends.append((c, f, total))
        start += size
    targets = [(c, total - 1) for c, _, total in ends if total > 0]
    places = iter(locate_ranks(narrow, F.col(row_id), targets, F.col(label), bounds)) if targets else iter(())
    last: dict[str, list[int]] = {}
    for c, _, total in ends:
        last.setdefault(c, []).append(int(next(places).value) if total > 0 else -(2**63))
    table = literal_table(
        df.sparkSession, [{label: c, "_ends": e} for c, e in last.items()], f"{label} string, _ends array<long>"
    )
    fold = F.size(F.filter("_ends", lambda e: e < F.col(row_id))).cast("int")
    return df.join(table, label).withColumn("fold", fold).select(*df.columns, "fold")
