"""Raw rows to train and validation tables, and the one-record summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.operators import impute, schema, split
from tallyloom.runtime import materialise


def clean_rows(raw: DataFrame, category_map: DataFrame, include_description: bool = True) -> tuple[DataFrame, DataFrame]:
    """(de-duplicated rows, selected and rolled-up rows with unmapped targets still in)."""
    unique = schema.dedup_exact(schema.blank_strings_to_null(schema.normalize_columns(raw)))
    chosen = schema.select_features(schema.drop_shared_columns(unique), include_description)
    return unique, schema.category_rollup(chosen, category_map)


def prepare_baseline(
    raw: DataFrame, category_map: DataFrame, include_description: bool = True, fraction: float = 0.2, seed: int = 42, run_name: str = "shared_baseline",
    source: str = "transactions",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, valid, summary). Imputation values come from the training rows only."""
    unique, rolled = clean_rows(raw, category_map, include_description)
    stored = materialise(rolled, "clean")
    kept = schema.drop_unmapped_target(stored)
    marked = materialise(split.stratified_split(kept, "category", fraction, seed), "split")
    features = schema.feature_names(stored.columns, include_description)
    numeric, categorical = ["amount"], [c for c in features if c != "amount"]
    values = impute.imputation_values(marked.where("split = 'train'"), numeric, categorical)
    after = impute.impute(marked, values)
    given = set(schema.normalize_columns(raw).columns)
    notes = {
        "source_dataset": F.lit(source),
        "dropped_columns": F.array(*[F.lit(c) for c in sorted(given - set(stored.columns))]).cast("array<string>"),
        "description_requested": F.lit(include_description),
        "evaluation_setup": F.lit(f"one hold-out split, {fraction:g} of the rows, by class"),
    }
    summary = preparation_summary(raw, stored, marked, after, values, features, fraction, seed, run_name).withColumns(notes)
    train = after.where("split = 'train'").drop("split")
    valid = after.where("split = 'valid'").drop("split")
    return train, valid, summary


def preparation_summary(
    raw: DataFrame, rolled: DataFrame, before: DataFrame, after: DataFrame, values: dict, features: list[str], fraction: float, seed: int, run_name: str
) -> DataFrame:
    """One nested row put together from small aggregates, each a scalar subquery."""
    label = "category"
    nulls = lambda df: (
        impute.missing_counts(df, features)
        .groupBy("split")
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "n_missing"))).alias("m"))
        .agg(F.map_from_entries(F.collect_list(F.struct("split", "m"))).alias("m"))
    )
    cells = materialise(before.groupBy("split", label).agg(F.count("*").alias("n")), "cells")  # one row per split and label
    owners = F.explode(F.array(F.lit("full"), F.col("split")))
    spread = (
        cells.select(owners.alias("split"), label, "n").groupBy("split", label).agg(F.sum("n").alias("n"))
        .groupBy("split").agg(F.map_from_entries(F.collect_list(F.struct(label, "n"))).alias("m"))
        .agg(F.map_from_entries(F.collect_list(F.struct("split", "m"))).alias("m"))
    )
    own = cells.where("split = 'train' AND n > 0")
    totals = own.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    weights = own.agg(F.map_from_entries(F.collect_list(F.struct(F.col(label), (totals["n"] / (totals["k"] * F.col("n"))).alias("weight")))).alias("m"))
    in_split = lambda name: F.coalesce(F.sum(F.when(F.col("split") == name, F.col("n"))), F.lit(0)).cast("long").alias(name)
    rows = F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows")
    sizes = cells.agg(F.struct(rows, in_split("train"), in_split("valid"), (F.count_distinct(label) > 1).alias("stratified")).alias("s")).scalar()
    raw_rows = raw.agg(F.count("*")).scalar()
    unique_rows = rolled.agg(F.count("*")).scalar()
    text = lambda key: F.lit(fixed.SUMMARY_TEXTS[key])
    numbers = {c: v for c, v in values.items() if isinstance(v, float)}
    words = {c: v for c, v in values.items() if not isinstance(v, float)}
    as_map = lambda d, kind: F.create_map(*[F.lit(x) for kv in d.items() for x in kv]).cast(f"map<string,{kind}>")
    return raw.sparkSession.range(1).select(
        F.lit(run_name).alias("run_name"),
        raw_rows.alias("raw_rows"),
        unique_rows.alias("rows_after_deduplication"),
        (raw_rows - unique_rows).alias("duplicates_removed"),
        F.lit(0).cast("long").alias("rows_dropped_missing_target"),
        (unique_rows - sizes["rows"]).alias("rows_dropped_unmapped"),
        sizes["rows"].alias("final_rows_before_split"),
        F.array(*[F.lit(c) for c in features]).alias("selected_feature_columns"),
        F.lit(label).alias("target_column"),
        text("duplicate_handling").alias("duplicate_handling"),
        text("label_transformation").alias("label_transformation"),
        F.struct(
            text("target_handling").alias("target"), text("numeric_handling").alias("numeric"), text("categorical_handling").alias("categorical")
        ).alias("missing_value_handling"),
        F.lit("description" in features).alias("description_included"),
        F.struct(as_map(numbers, "double").alias("numeric"), as_map(words, "string").alias("categorical")).alias("imputation_values"),
        nulls(before).scalar().alias("missing_before"),
        nulls(after).scalar().alias("missing_after"),
        F.struct(
            sizes["train"].alias("train_rows"),
            sizes["valid"].alias("validation_rows"),
            F.lit(fraction).alias("validation_fraction"),
            F.lit(seed).alias("seed"),
            sizes["stratified"].alias("stratified"),
        ).alias("split"),
        spread.scalar().alias("class_distribution"),
        weights.scalar().alias("class_weights"),
    )
