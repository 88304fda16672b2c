"""Global row positions and neighbour windows without a single-partition window."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.runtime import literal_table, materialise

BLOCK_ROWS = 65_536


class Ordered(NamedTuple):
    df: DataFrame
    n: int


def with_position(df: DataFrame, *order: Column, partitions: int | None = None) -> Ordered:
    """Add ``pos``, the 0-based place of each row in ``order`` (which must be total).

    Rows are range-partitioned and sorted; the written table fixes the ranges, the running id fixes
    the place inside a range, and the ranges' start offsets are one number per partition.
    """
    spark = df.sparkSession
    sizes_fit = [partitions] if partitions else []  # otherwise the adaptive plan picks the number by size
    ranged = df.repartitionByRange(*sizes_fit, *order).sortWithinPartitions(*order)
    stored = materialise(ranged.withColumn("_mid", F.monotonically_increasing_id()), "ordered")
    stored = stored.withColumn("_part", F.shiftright("_mid", 33))
    sizes = {r["_part"]: r["n"] for r in stored.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    start, rows = 0, []
    for part in sorted(sizes):
        rows.append({"_part": part, "_start": start - (part << 33)})
        start += sizes[part]
    starts = literal_table(spark, rows, "_part long, _start long")
    placed = stored.join(starts, "_part").withColumn("pos", F.col("_mid") + F.col("_start"))
    return Ordered(placed.drop("_part", "_mid", "_start"), start)


def with_blocks(sig: Ordered, before: int, after: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Copy each row into every block that needs it as core or as context; ``core`` marks the owner."""
    first = F.floor(F.greatest(F.lit(0), F.col("pos") - after) / block_rows).cast("long")
    last = F.floor(F.least(F.lit(max(sig.n - 1, 0)), F.col("pos") + before) / block_rows).cast("long")
    return (
        sig.df.withColumn("block", F.explode(F.sequence(first, last)))
        .withColumn("core", F.col("block") == F.floor(F.col("pos") / block_rows).cast("long"))
    )


def neighbourhood(sig: Ordered, value: str, half: int, edge: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``near``, the values from ``half`` rows before to ``half`` rows after.

    ``edge``: ``nearest`` repeats the end value, ``zero`` pads with 0, ``shrink`` leaves it shorter.
    """
    frame = Window.partitionBy("block").orderBy("pos").rowsBetween(-half, half)
    near = with_blocks(sig, half, half, max(block_rows, 2 * half)).withColumn("near", F.collect_list(value).over(frame))
    near = near.where("core").drop("core", "block")
    if edge == "shrink":
        return near
    missing_left = F.greatest(F.lit(half) - F.col("pos"), F.lit(0)).cast("int")
    missing_right = F.greatest(F.col("pos") + half - (sig.n - 1), F.lit(0)).cast("int")
    zero = F.lit(0.0)
    left = zero if edge == "zero" else F.element_at("near", 1)
    right = zero if edge == "zero" else F.element_at("near", -1)
    padded = F.concat(F.array_repeat(left, missing_left), F.col("near"), F.array_repeat(right, missing_right))
    return near.withColumn("near", padded)
