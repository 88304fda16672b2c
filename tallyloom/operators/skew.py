"""Equi-join that spreads hot keys over many tasks."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.runtime import SMALL_ROWS, materialise

#: A key is hot if it holds more than this part of an even partition, and each of its salts holds about that much.
PART_OF_PARTITION = 0.25


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Keys that hold more than ``share`` of the rows, and their number of salts: fewer than 1/share
    keys and 2/share salts in all, whatever the data. Keys with a null are left out, as they join nothing."""
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    counts = known.groupBy(*keys).agg(F.count("*").alias("_n"))
    limit = counts.agg((F.coalesce(F.sum("_n"), F.lit(0)) * share).alias("_n")).scalar()
    return counts.where(F.col("_n") > limit).select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_salts"))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: str, how: str = "inner", counted: DataFrame | None = None) -> DataFrame:
    """Join ``left`` to the smaller ``right``; rows of hot keys are split by a hash of ``spread``.

    What is hot, and into how many parts it is split, follows from the number of shuffle partitions. Only
    the hot keys of ``right`` (a bounded set) are repeated, once per salt. Left rows with a null key join nothing and
    are spread as well. ``counted`` is a cheaper table with the same key distribution as ``left``, if there is one.
    """
    share = PART_OF_PARTITION / max(_partitions(left), 4)
    hot = F.broadcast(hot_keys(left if counted is None else counted, keys, share))
    unknown = F.lit(False)
    for k in keys:
        unknown = unknown | F.col(k).isNull()
    most = ceil(1 / share)
    parts = F.when(unknown, F.lit(most)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = left.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), parts).cast("long"))
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1)
    salted_right = right.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return salted_left.drop("_salts").join(salted_right, keys + ["_salt"], how).drop("_salt")


def keyed_join(left: DataFrame, table: DataFrame, keys: list[str], spread: str, how: str = "inner", counted: DataFrame | None = None) -> DataFrame:
    """Join ``left`` to a per-key ``table``, which is stored once: broadcast if it is found to be small, otherwise with hot keys split."""
    stored = materialise(table, "keys")
    if stored.count() <= SMALL_ROWS:
        return left.join(F.broadcast(stored), keys, how)
    return salted_join(left, stored, keys, spread, how, counted)
