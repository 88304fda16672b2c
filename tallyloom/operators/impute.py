"""Training-only imputation, missing counts, class tables and the preparation summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ranks import exact_quantiles
from tallyloom.runtime import small_table


def train_median(train: DataFrame, column: str) -> float:
    value = exact_quantiles(train, F.col(column).try_cast("double"), [0.5])[0]
    return 0.0 if value is None else value


def train_modes(train: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent non-null value of each column, ties to the smallest; one pass for all columns."""
    if not columns:
        return {}
    long = train.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "v").where("v IS NOT NULL")
    counts = long.groupBy("column", "v").agg(F.count("*").alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("b"))
    found = {r["column"]: r["b"]["v"] for r in best.collect()}
    return {c: found.get(c, "Missing") for c in columns}


def imputation_values(train: DataFrame, numeric: list[str], categorical: list[str]) -> dict[str, object]:
    return {c: train_median(train, c) for c in numeric} | train_modes(train, categorical)


def impute(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Fill nulls (and NaN numbers) with values learned from the training rows."""
    filled = {}
    for name, value in values.items():
        if isinstance(value, float):
            number = F.col(name).try_cast("double")
            filled[name] = F.coalesce(F.nanvl(number, F.lit(None).cast("double")), F.lit(value))
        else:
            filled[name] = F.coalesce(F.col(name), F.lit(value))
    return df.withColumns(filled)


def impute_numeric_median(train: DataFrame, valid: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    values = imputation_values(train, columns, [])
    return impute(train, values), impute(valid, values)


def impute_categorical_mode(train: DataFrame, valid: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    values = imputation_values(train, [], columns)
    return impute(train, values), impute(valid, values)


def missing_counts(df: DataFrame, columns: list[str], by: str = "split") -> DataFrame:
    """Long table (by, column, n_missing) from one pass over the rows."""
    counts = [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c) for c in columns]
    return df.groupBy(by).agg(*counts).unpivot([by], columns, "column", "n_missing")


def class_distribution(df: DataFrame, label: str = "category", split: str = "split") -> DataFrame:
    """Counts per label for the full data and for every split, from one aggregate of (split, label)."""
    cells = df.groupBy(split, label).agg(F.count("*").alias("n"))
    owners = F.explode(F.array(F.lit("full"), F.col(split)))
    return cells.select(owners.alias(split), label, "n").groupBy(split, label).agg(F.sum("n").alias("n"))


def balanced_class_weights(train: DataFrame, label: str = "category") -> DataFrame:
    """n / (k * n_c) per class, from one small class-count table."""
    counts = train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    return counts.select(label, "n", (totals["n"] / (totals["k"] * F.col("n"))).alias("weight"))


def sample_weights(train: DataFrame, label: str = "category", weight: str | None = None, out: str = "weight", counted: DataFrame | None = None) -> DataFrame:
    """Class weight per row, times the row's own weight if there is one; classes are counted in ``counted`` if it is given."""
    table = small_table(balanced_class_weights(train if counted is None else counted, label).select(label, F.col("weight").alias("_cw")))
    value = F.col("_cw") if weight is None else F.col("_cw") * F.col(weight)
    kept = [c for c in train.columns if c != out]
    return train.join(table, label, "left").select(*kept, value.alias(out))
