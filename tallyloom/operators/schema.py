"""Column naming, selection, blanks, duplicates, label roll-up and label codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions.columns import blank_to_null
from tallyloom.operators.ordering import with_position
from tallyloom.runtime import literal_table


def canonical_name(header: str) -> str:
    key = header.strip().lower().replace("_", " ").strip()
    return fixed.CANONICAL_HEADERS.get(key, header.strip())


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[canonical_name(c) for c in df.columns])


def blank_strings_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    text = columns or [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: blank_to_null(F.col(c)) for c in text})


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def drop_shared_columns(df: DataFrame, columns: tuple[str, ...] = ("user_id", "date")) -> DataFrame:
    return df.drop(*columns)


def feature_names(columns: list[str], include_description: bool = True) -> list[str]:
    text = ["description"] if include_description and "description" in columns else []
    return text + ["amount", "transaction_type", "account_name"]


def select_features(df: DataFrame, include_description: bool = True, label: str = "category") -> DataFrame:
    require_columns(df, ["amount", "transaction_type", "account_name", label])
    keep = ["row_id"] if "row_id" in df.columns else []
    return df.select(*keep, *feature_names(df.columns, include_description), label)


def ensure_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add missing columns, fill nulls and cast to the type of the default (``None``: leave nulls, double)."""
    out = {}
    for name, default in defaults.items():
        source = F.col(name) if name in df.columns else F.lit(None)
        if default is None:
            out[name] = source.cast("string").try_cast("double")
        elif isinstance(default, float):
            number = source.cast("string").try_cast("double")
            out[name] = F.coalesce(F.nanvl(number, F.lit(None).cast("double")), F.lit(default))
        else:
            out[name] = F.coalesce(source.cast("string"), F.lit(default))
    return df.withColumns(out)


def dedup_exact(df: DataFrame, row_id: str | None = "row_id") -> DataFrame:
    """One row per distinct content; of the copies the smallest row id stays. Aggregates before the shuffle."""
    content = [c for c in df.columns if c != row_id]
    if row_id is None or row_id not in df.columns:
        return df.dropDuplicates(content)
    return df.groupBy(*content).agg(F.min(row_id).alias(row_id)).select(*df.columns)


def category_map(spark: SparkSession, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    rows = [{"category": a, "grp": b} for a, b in (pairs or fixed.CATEGORY_GROUPS)]
    return literal_table(spark, rows, "category string, grp string")


def category_rollup(df: DataFrame, map_df: DataFrame, category: str = "category") -> DataFrame:
    """Replace the source category by its group; a category outside the map becomes null."""
    table = map_df.select(F.col("category").alias(category), F.col("grp").alias("_grp"))
    return df.join(table, category, "left").withColumn(category, F.col("_grp")).select(*df.columns)


def drop_unmapped_target(df: DataFrame, label: str = "category") -> DataFrame:
    return df.where(F.col(label).isNotNull())


def label_universe(*dfs: DataFrame, label: str = "category") -> DataFrame:
    found = dfs[0].select(label).distinct()
    for df in dfs[1:]:
        found = found.union(df.select(label).distinct())
    return found.where(F.col(label).isNotNull()).distinct()


def label_list(*dfs: DataFrame, label: str = "category", limit: int = 10_000) -> list[str]:
    """Sorted labels; more than ``limit`` of them is an error, not a truncation."""
    rows = label_universe(*dfs, label=label).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} labels")
    return sorted(r[0] for r in rows)


def label_codes(labels: list[str], spark: SparkSession, label: str = "category") -> DataFrame:
    rows = [{label: name, "label_code": code} for code, name in enumerate(labels)]
    return literal_table(spark, rows, f"{label} string, label_code int")


def label_encode(df: DataFrame, labels: list[str], label: str = "category") -> DataFrame:
    return df.join(label_codes(labels, df.sparkSession, label), label, "left")


def label_decode(df: DataFrame, labels: list[str], code: str, out: str) -> DataFrame:
    names = F.array(*[F.lit(name) for name in labels])
    return df.withColumn(out, F.try_element_at(names, F.col(code).cast("int") + 1))


def assign_row_id(df: DataFrame, *order: Column) -> DataFrame:
    """Number the rows from 0 in a total order."""
    return with_position(df, *order).df.withColumnRenamed("pos", "row_id")
