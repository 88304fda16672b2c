"""Mix sources to target weights: repetition rates per source, a hash-seeded draw per document.

Only DataFrame expressions. Two aggregates have one row per source; a table of sources that is small
enough is broadcast to the documents, a larger one is joined with the documents of hot sources spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.skew import salted_join
from tallyloom.runtime import materialise

WEIGHTS = (1, 2, 3)
MAX_RATE = 3
SEED = 8
MAX_BROADCAST_SOURCES = 20_000
PLAN = ["size", "source_size", "target", "copies", "taken"]


def word_count(text: Column) -> Column:
    """Number of runs of anything but the six ASCII white-space characters; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null and differs between null and any text."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source.cast("string")))


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) fixed by the id and the seed: 48 bits of an MD5."""
    digits = F.substring(F.md5(F.concat_ws(":", doc_id.cast("string"), F.lit(str(seed)))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**48))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """One row per source of ``sizes(source, size)``: source_size, weight, target.

    Sources take the weights in turn, in code point order, null last. A target above ``max_rate`` times
    its source is cut there and the rest shared again by weight until none is above. That ends at
    min(max_rate * size, level * weight) for one level: with sources ordered by the level at which they
    are cut, it is the largest of (total - cuts so far) / (weights from here on).
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    table = sums.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")))
    cut = F.lit(max_rate) * F.col("source_size")
    table = table.withColumns({"_cut": cut, "_at": cut / F.col("weight")})
    everything = Window.partitionBy()
    ordered = Window.orderBy("_at", F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rest = ordered.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cut").over(before), F.lit(0))
    table = table.withColumn("_level", left / F.sum("weight").over(rest))
    level = F.max("_level").over(everything)
    target = F.least(F.col("_cut").cast("double"), F.col("weight") * level)
    return table.select("source", "source_size", "weight", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: str | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    max_rate: int = MAX_RATE,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with the plan of the mix: size, source_size, target, copies, taken (= copies * size).

    Sizes are word counts of ``text``, or the column ``size`` if a caller has counted already. A document
    of a source with rate r = target / source_size is taken floor(r) times, and once more if the draw of
    its id is below the fraction of r. Rows that share an id share the draw; null ids draw as the empty
    string. A null text has size 0; a null source is a source of its own, the last. A source without
    words has target 0 and its documents are not taken. Columns named like the plan are replaced.
    """
    counted = word_count(F.col(text)) if size is None else F.coalesce(F.col(size).cast("long"), F.lit(0))
    docs = docs.withColumn("size", counted).drop(*PLAN[1:], "_source_key")
    targets = materialise(source_targets(docs.select(F.col(source).alias("source"), "size"), weights, max_rate), "source-targets")
    keyed = targets.select(source_key(F.col("source")).alias("_source_key"), "source_size", "target")
    with_key = docs.withColumn("_source_key", source_key(F.col(source)))
    if targets.count() <= MAX_BROADCAST_SOURCES:
        planned = with_key.join(F.broadcast(keyed), "_source_key")
    else:
        planned = salted_join(with_key, keyed, ["_source_key"], doc_id)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    copies = (whole + (draw(F.col(doc_id), seed) < rate - whole).cast("long")).cast("long")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return planned.withColumn("copies", copies).select(*columns, "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit_copies(mixed: DataFrame) -> DataFrame:
    """Each document as often as its plan says; the plan's columns go."""
    times = F.explode(F.when(F.col("copies") > 0, F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return mixed.withColumn("_copy", times).drop("_copy", *PLAN)
