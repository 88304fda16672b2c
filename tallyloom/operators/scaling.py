"""Standardised, normalised and blended scores; the statistics are scalar subqueries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stats(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    return df.agg(
        F.struct(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("lo"), F.max(value).alias("hi")).alias("s")
    ).scalar()


def zscore(df: DataFrame, column: str, out: str) -> DataFrame:
    s = _stats(df, column)
    return df.withColumn(out, (F.col(column) - s["mean"]) / (s["std"] + F.lit(1e-12)))


def minmax_norm(df: DataFrame, column: str, out: str) -> DataFrame:
    s = _stats(df, column)
    return df.withColumn(out, (F.col(column) - s["lo"]) / (s["hi"] - s["lo"] + F.lit(1e-12)))


def standard_scale(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """Scale ``df`` by the training mean and population deviation; a constant column is only centred."""
    out = {}
    for c in columns:
        s = _stats(train, c)
        divisor = F.when(s["std"] == 0, F.lit(1.0)).otherwise(s["std"])
        out[f"{c}_scaled"] = (F.col(c) - s["mean"]) / divisor
    return df.withColumns(out)


def blend(base: Column, smooth: Column, alpha: float) -> Column:
    return F.lit(1.0 - alpha) * base + F.lit(alpha) * smooth
