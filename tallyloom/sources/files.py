"""File sources and sinks: raw CSV, the split, the summary, metric records, predictions, results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.columns import csv_null
from tallyloom.operators.schema import assign_row_id, normalize_columns
from tallyloom.runtime import scratch_path

CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "multiLine": False,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_transactions(spark: SparkSession, path: str, order: tuple[str, ...] | None = None, multi_line: bool = False) -> DataFrame:
    """Raw header CSV as text, null tokens resolved, headers canonical, ``amount`` as a number.

    A file without ``row_id`` gets one from the row content (or ``order``), which repeats on a re-read.
    Rows with equal content share no order, so any of them may come first; they are interchangeable.
    Quoted line breaks need ``multi_line``, which reads each file in one task; without it, and for any row of another
    number of columns, reading fails.
    """
    raw = spark.read.options(**CSV_OPTIONS | {"multiLine": multi_line, "mode": "FAILFAST"}).csv(path)
    df = normalize_columns(raw.select(*[csv_null(F.col(f"`{c}`")).alias(c) for c in raw.columns]))
    if "amount" in df.columns:
        df = df.withColumn("amount", F.col("amount").try_cast("double"))
    if "row_id" in df.columns:
        return df.withColumn("row_id", F.col("row_id").cast("long"))
    return assign_row_id(df, *[F.col(c) for c in (order or df.columns)])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**CSV_OPTIONS, emptyValue="").csv(path)


def write_split(train: DataFrame, valid: DataFrame, path: str, label: str = "category") -> None:
    """Two Parquet tables with the target as the last column."""
    for name, part in (("train", train), ("valid", valid)):
        part.select(*[c for c in part.columns if c != label], label).write.parquet(f"{path}/{name}")


def read_split(spark: SparkSession, path: str, label: str = "category") -> tuple[DataFrame, DataFrame, list[str]]:
    """(train, valid, feature names); text features come back as strings."""
    text = ("description", "transaction_type", "account_name")
    parts = []
    for name in ("train", "valid"):
        part = spark.read.parquet(f"{path}/{name}")
        parts.append(part.withColumns({c: F.col(c).cast("string") for c in text if c in part.columns}))
    features = [c for c in parts[0].columns if c not in (label, "row_id")]
    return parts[0], parts[1], features


def write_summary(summary: DataFrame, path: str) -> None:
    """One nested record; a single small file is the point here."""
    summary.coalesce(1).write.json(path)


def read_summary(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def stored_class_weights(summary: DataFrame, label: str = "category") -> DataFrame:
    return summary.select(F.explode("class_weights").alias(label, "weight"))


def write_predictions(scored: DataFrame, path: str) -> None:
    scored.write.parquet(path)


def write_noise_scores(noise: DataFrame, path: str) -> None:
    noise.write.parquet(path)


def write_results(results: DataFrame, path: str, form: str = "parquet") -> None:
    results.write.format(form).save(path)


def read_model_metrics(spark: SparkSession, path: str, cell: str, schema=None) -> tuple[DataFrame, DataFrame]:
    """(one comparison row with the means over seeds, per-class F1 of the first seed)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    stored = reader.json(path).where(F.col("run_name") == cell)
    means = [F.col(f"{m}.mean").alias(m) for m in ("accuracy", "weighted_f1", "macro_f1", "training_time_seconds")]
    row = stored.select(F.col("run_name").alias("cell"), *means, F.size("accuracy.values").alias("seeds_run"))
    per_class = stored.select(F.explode("per_class").alias("label", "m")).select("label", "m.*")
    return row, per_class


def through_file(df: DataFrame, tag: str, form: str = "parquet") -> str:
    """Write under the shared folder and return the path."""
    path = scratch_path(df.sparkSession, tag)
    if form == "csv":
        write_csv(df, path)
    else:
        df.write.format(form).save(path)
    return path


def header_case(name: str) -> Column:
    """A header as raw files spell it."""
    return F.col(name).alias(name.replace("_", " ").title().replace("Id", "ID") if name != "row_id" else name)
