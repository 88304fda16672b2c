"""Dominant labels, merchant and keyword rules, and applying corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions.columns import keyword_correction, merchant_name, suspicion
from tallyloom.operators.skew import keyed_join
from tallyloom.runtime import join_rows


def dominant_label(df: DataFrame, keys: list[str], label: str = "category") -> DataFrame:
    """Per key: most frequent label (ties to the smallest), its count, the total, and their ratio."""
    cells = df.where(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(label).alias("y")))
    per_key = cells.groupBy(*keys).agg(best.alias("b"), F.sum("n").cast("long").alias("total_n"))
    n = -F.col("b.n")
    return per_key.select(*keys, F.col("b.y").alias("dominant"), n.alias("n"), "total_n", (n / F.col("total_n")).alias("dominance"))


def relabel_dominant(df: DataFrame, keys: list[str], min_dominance: float = 0.9, label: str = "category") -> DataFrame:
    """Give rows the dominant label of their key where it is clear; the old one stays in ``<label>_original``."""
    clear = dominant_label(df, keys, label).where(F.col("dominance") >= min_dominance).select(*keys, "dominant")
    joined = keyed_join(df, clear, keys, "row_id", "left")
    return joined.select(
        *[c for c in df.columns if c != label],
        F.coalesce("dominant", label).alias(label),
        F.col(label).alias(f"{label}_original"),
        F.coalesce(F.col("dominant") != F.col(label), F.lit(False)).alias("label_changed"),
    )


def merchant_purity(noise: DataFrame, min_count: int = 5, min_purity: float = 0.95, description: str = "description") -> DataFrame:
    """Per merchant: dominant model prediction, its share, for merchants seen and pure enough."""
    named = noise.select(merchant_name(F.col(description)).alias("merchant"), "cv_pred").where("merchant <> ''")
    table = dominant_label(named, ["merchant"], "cv_pred")
    kept = table.where((F.col("total_n") >= min_count) & (F.col("dominance") >= min_purity))
    return kept.select("merchant", F.col("dominant").alias("target"), "total_n", F.col("dominance").alias("purity"))


def whitelist_merchants(rules: DataFrame, names: list[str] | None = None) -> DataFrame:
    return rules.where(F.col("merchant").isin(names or fixed.MERCHANT_WHITELIST))


def merchant_rule_relabel(noise: DataFrame, rules: DataFrame, label: str = "category", description: str = "description") -> DataFrame:
    """Exact merchant rule; a label changes only where it differs and the model agrees with the rule.

    Rules are at most one per merchant. A table found to be small is broadcast; others take the hot-key join.
    """
    named = noise.withColumn("merchant", merchant_name(F.col(description)))
    table = rules.select("merchant", "target")
    joined = keyed_join(named, table, ["merchant"], "row_id", "left")
    change = F.coalesce((F.col("target") != F.col(label)) & (F.col("cv_pred") == F.col("target")), F.lit(False))
    return joined.select(
        *noise.columns,
        F.when(change, F.col("target")).otherwise(F.col(label)).alias(f"{label}_corrected"),
        F.when(change, "merchant_rule + model_agrees").otherwise("").alias("review_note"),
        change.alias("label_changed"),
    )


def keyword_rule_relabel(noise: DataFrame, rules=None, label: str = "category", description: str = "description", word: bool = False) -> DataFrame:
    corrected, note = keyword_correction(F.col(description), F.col(label), F.col("cv_pred"), rules or fixed.KEYWORD_RULES, word)
    return noise.withColumns({f"{label}_corrected": corrected, "review_note": note}).withColumn(
        "label_changed", F.col(f"{label}_corrected") != F.col(label)
    )


def top_suspicious(noise: DataFrame, n: int = 300, mode: str = "rank", wrong: str = "wrong_flag", rank: str | None = None) -> DataFrame:
    """The n rows with the highest review score; ``compat`` adds the published rank term."""
    rank_col = F.col(rank) if mode == "compat" and rank else None
    score = F.round(suspicion(F.col("true_label_prob"), F.col(wrong), rank_col), 9)
    return noise.withColumn("suspicion_score", score).orderBy(F.desc("suspicion_score"), "row_id").limit(n)


def first_corrections(corrections: DataFrame, label: str = "category", order: str = "seq") -> DataFrame:
    """Usable corrections, one per row id: the first in ``order``."""
    usable = corrections.where(F.col("row_id").isNotNull() & F.col(f"{label}_corrected").isNotNull())
    values = F.struct(f"{label}_corrected", "review_note")
    return usable.groupBy("row_id").agg(F.min_by(values, F.col(order)).alias("c")).select("row_id", "c.*")


def validate_row_ids(corrections: DataFrame, train: DataFrame, on_bad: str = "error") -> DataFrame:
    """Corrections whose row exists; an unknown id is an error or is skipped."""
    if on_bad == "error":
        if join_rows(corrections, train.select("row_id"), "row_id", "left_anti").limit(1).count():
            raise ValueError("corrections name row ids that are not in the training rows")
        return corrections
    return join_rows(corrections, train.select("row_id"), "row_id", "left_semi")


def apply_corrections(train: DataFrame, corrections: DataFrame, label: str = "category", order: str = "seq", on_bad: str = "skip") -> tuple[DataFrame, DataFrame]:
    """(updated rows, log of real changes). Row ids are unique on both sides of the join."""
    first = first_corrections(corrections, label, order)
    if on_bad == "error":
        first = validate_row_ids(first, train)
    joined = train.join(first, "row_id", "left")
    new = F.coalesce(f"{label}_corrected", label)
    updated = joined.select(*[new.alias(label) if c == label else F.col(c) for c in train.columns])
    changed = train.join(first, "row_id").where(F.col(f"{label}_corrected") != F.col(label))
    log = changed.select(
        "row_id", F.col(label).alias("category_before"), F.col(f"{label}_corrected").alias("category_after"), "description", "review_note"
    )
    return updated, log
