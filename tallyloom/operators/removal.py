"""Which training rows to take out: caps, candidate shares, class floors, quantiles, gates.

Each rule becomes a cut (score, row id) found by counting, so it is applied as a filter and the
training rows are neither sorted nor shuffled. Scores should be rounded before they are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ranks import exact_quantiles, in_top, top_cuts
from tallyloom.operators.split import class_counts
from tallyloom.runtime import join_rows




def remove_rows(train: DataFrame, ids: DataFrame) -> DataFrame:
    return join_rows(train, ids.select("row_id"), "row_id", "left_anti")


def _stacked_cuts(items: list[list[Column]], df: DataFrame, sizes: list[list[tuple[str, int]]]) -> list[list[tuple[float, int] | None]]:
    """Cuts of many scores in the passes of one.

    ``items`` holds, per score, structs (g, s) of group and score, null where the row takes no part; ``sizes`` the wanted
    (group, k) per score. Every row is repeated once per struct while it is counted, and nothing of it is shuffled.
    """
    tagged = [F.when(it.isNotNull(), F.struct(F.concat(F.lit(f"{i}:"), it["g"]).alias("g"), it["s"].cast("double").alias("s"))) for i, own in enumerate(items) for it in own]
    long = df.select("row_id", F.explode(F.array_compact(F.array(*tagged))).alias("v")).select("row_id", "v.g", "v.s")
    flat = top_cuts(long, F.col("s"), F.col("row_id"), [(f"{i}:{g}", k) for i, own in enumerate(sizes) for g, k in own], F.col("g"))
    cuts, at = [], 0
    for own in sizes:
        cuts.append(flat[at : at + len(own)])
        at += len(own)
    return cuts


def _item(group: Column, score: str) -> Column:
    return F.struct(group.alias("g"), F.col(score).alias("s"))


def top_rows_of(df: DataFrame, scores: list[str], sizes: list[int]) -> list[list[Column]]:
    """Per score, for each k, the condition that holds for the k rows with the highest (score, row id)."""
    cuts = _stacked_cuts([[_item(F.lit("*"), s)] for s in scores], df, [[("*", k) for k in sizes]] * len(scores))
    return [[in_top(F.col(s), F.col("row_id"), cut) for cut in own] for s, own in zip(scores, cuts)]


def cap_removals(train: DataFrame, scores: list[str], caps: list[float]) -> list[list[Column]]:
    """Per score, for each cap, the condition of the worst max(1, n * cap) rows."""
    n = train.count()
    return top_rows_of(train, scores, [max(1, int(n * cap)) for cap in caps])


def cap_removal(train: DataFrame, score: str, caps: list[float]) -> list[Column]:
    return cap_removals(train, [score], caps)[0]


def remove_cap_fraction(train: DataFrame, score: str, cap: float) -> DataFrame:
    return train.where(~cap_removal(train, score, [cap])[0])


def candidate_removals(pool: DataFrame, scores: list[str], shares: list[float]) -> list[list[Column]]:
    """Per score, for each share, the condition, within the pool, of its worst rows."""
    n = pool.count()
    return top_rows_of(pool, scores, [int(n * share) for share in shares])


def candidate_removal(pool: DataFrame, score: str, shares: list[float]) -> list[Column]:
    return candidate_removals(pool, [score], shares)[0]


def _in_class_top(score: str, label: str, cuts: dict[str, tuple[float, int] | None]) -> Column:
    """Whether a row is above the cut of its class: the class is looked up once, its cut by place."""
    if not cuts:
        return F.lit(False)
    quoted = ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in cuts)
    at = f"CAST(array_position(array({quoted}), `{label}`) AS INT) - 1"
    value = f"get(array({', '.join('CAST(NULL AS DOUBLE)' if cut is None else f'double({str(cut[0])!r})' for cut in cuts.values())}), {at})"
    rid = f"get(array({', '.join('CAST(NULL AS BIGINT)' if cut is None else f'bigint({str(cut[1])!r})' for cut in cuts.values())}), {at})"
    return F.expr(f"coalesce(`{score}` > {value} OR (`{score}` = {value} AND `row_id` >= {rid}), false)")


def class_aware_removals(
    train_counts: dict[str, int], pool: DataFrame, scores: list[str], wanted: list[tuple[float, int]], label: str = "category"
) -> list[list[Column]]:
    """Per score, for each (share, min_keep), the condition, within the pool, of the rows to drop.

    A class gives at most its surplus over ``min_keep``, highest scores first; of these rows the
    first max(1, share of the pool) are dropped. All scores, classes and floors are cut together.
    """
    in_pool = class_counts(pool, label)
    pool_n = sum(in_pool.values())
    floors, classes = sorted({keep for _, keep in wanted}), sorted(in_pool)
    slots = [(c, keep) for keep in floors for c in classes]
    surplus = [(c, max(0, train_counts.get(c, 0) - keep)) for c, keep in slots]
    found = _stacked_cuts([[_item(F.col(label), s)] for s in scores], pool, [surplus] * len(scores))
    allowed = []
    for s, own in zip(scores, found):
        cuts = dict(zip(slots, own))
        allowed.append({keep: _in_class_top(s, label, {c: cuts[c, keep] for c in classes}) for keep in floors})
    eligible = [[F.when(fits[keep], _item(F.lit(str(keep)), s)) for keep in floors] for s, fits in zip(scores, allowed)]
    targets = [(str(keep), max(1, int(pool_n * share))) for share, keep in wanted]
    ends = _stacked_cuts(eligible, pool, [targets] * len(scores))
    return [
        [fits[keep] & in_top(F.col(s), F.col("row_id"), end) for (_, keep), end in zip(wanted, own)] for s, fits, own in zip(scores, allowed, ends)
    ]


def class_aware_removal(
    train_counts: dict[str, int], pool: DataFrame, score: str, wanted: list[tuple[float, int]], label: str = "category"
) -> list[Column]:
    return class_aware_removals(train_counts, pool, [score], wanted, label)[0]


def remove_class_aware(train: DataFrame, pool: DataFrame, score: str, share: float, min_keep: int, label: str = "category") -> DataFrame:
    """Training rows without the chosen pool rows."""
    drop = class_aware_removal(class_counts(train, label), pool, score, [(share, min_keep)], label)[0]
    return remove_rows(train, pool.where(drop))


def quantile_removals(pool: DataFrame, score: str, shares: tuple[float, ...]) -> list[Column]:
    """Per share, pool rows at or above the pool's own quantile; all quantiles are searched together."""
    cuts = exact_quantiles(pool, F.col(score), list(shares))
    return [F.lit(False) if cut is None else F.col(score) >= F.lit(cut) for cut in cuts]


def error_gating(removed: DataFrame, error: str, share: float) -> DataFrame:
    """Of rows marked for removal, those whose reconstruction error is at or above their quantile."""
    return removed.where(quantile_removals(removed, error, (share,))[0])


def recon_error_threshold(train: DataFrame, error: str, share: float = 0.95) -> DataFrame:
    """Keep the rows whose reconstruction error does not exceed the quantile."""
    cut = exact_quantiles(train, F.col(error), [share])[0]
    return train if cut is None else train.where(F.col(error) <= F.lit(cut))


def soft_label_duplicate(train: DataFrame, main: float, label: str = "category") -> DataFrame:
    """All rows at weight ``main``, and those with another prediction again under it at the rest."""
    one = F.struct(F.col(label).alias("y"), F.lit(main).alias("w"))
    two = F.struct(F.col("cv_pred").alias("y"), F.lit(1.0 - main).alias("w"))
    versions = F.when(F.col("cv_pred") != F.col(label), F.array(one, two)).otherwise(F.array(one))
    rest = [c for c in train.columns if c != label]
    return train.withColumn("_v", F.explode(versions)).select(*rest, F.col("_v.y").alias(label), F.col("_v.w").alias("weight"))
