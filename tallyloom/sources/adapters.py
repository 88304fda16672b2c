"""Views that give the driver's tables the shape of transactions and noise scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions.columns import amount_bucket, clean_description, flag_suspicious
from tallyloom.operators.noise import CountingScorer
from tallyloom.operators.schema import blank_strings_to_null, category_map, category_rollup, drop_unmapped_target
from tallyloom.operators.split import stratified_kfold
from tallyloom.runtime import materialise


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. A file that gives fewer tasks than there are cores is spread over them;
    a table of many files or row groups is left as it is scanned."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions derived from ``events``, with blanks, nulls and unmapped categories."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("long")
    eid, kind = F.col("event_id"), F.col("event_type")
    names = F.array(*[F.lit(c) for c, _ in fixed.CATEGORY_GROUPS], F.lit("Unmapped"))
    sources = len(fixed.CATEGORY_GROUPS)
    ix = F.when(eid % 13 == 0, eid % (sources + 1)).otherwise((k % 10 + F.length(kind)) % sources)
    store = F.concat(F.upper(kind), F.lit(" Store  "), (k % 10).cast("string"), F.lit(" #"), k.cast("string"))
    return read_table(spark, sf_dir, "events").select(
        eid.alias("row_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("date").cast("string").alias("date"),
        F.when(eid % 83 == 0, "  ").otherwise(store).alias("description"),
        F.when(eid % 97 == 0, None).when(kind == "purchase", -F.col("value")).otherwise(F.col("value")).alias("amount"),
        F.when(eid % 89 == 0, " ").when(kind.isin("purchase", "click"), "debit").otherwise("credit").alias("transaction_type"),
        F.concat(F.lit("acct"), (F.col("user_id") % 6).cast("string")).alias("account_name"),
        F.element_at(names, (ix + 1).cast("int")).alias("category"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped rows with cleaned description, amount bucket and type; ``category`` holds the group."""
    tx = blank_strings_to_null(transactions(spark, sf_dir))
    grouped = drop_unmapped_target(category_rollup(tx, category_map(spark)))
    return grouped.select(
        "row_id",
        clean_description(F.col("description")).alias("description"),
        "amount",
        amount_bucket(F.col("amount")).alias("amount_bucket"),
        F.coalesce("transaction_type", F.lit("unknown")).alias("transaction_type"),
        "account_name",
        "category",
    )


def noise_scores(spark: SparkSession, sf_dir: str, seed: int = 42) -> DataFrame:
    """Out-of-fold scores of the counting scorer on all labelled rows."""
    folded = materialise(stratified_kfold(labelled(spark, sf_dir), seed=seed), "folded")
    scored = CountingScorer().out_of_fold(folded)
    wrong = (F.col("cv_pred") != F.col("category")).cast("int")
    flagged = flag_suspicious(F.col("category"), F.col("cv_pred"), F.col("true_label_prob"))
    return scored.withColumns({"wrong_flag": wrong, "flagged_suspicious": flagged})
