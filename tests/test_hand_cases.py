"""Small cases with known results."""

import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import columns as fx
from tallyloom.operators import impute, metrics, relabel, removal, schema, split
from tallyloom.operators.noise import align_noise
from tallyloom.plans.prepare import prepare_baseline
from tallyloom.runtime import scratch_path
from tallyloom.sources import files


def values(df, column):
    return [r[column] for r in df.collect()]


def test_amount_bucket(spark):
    numbers = [(None, "250_plus"), (math.nan, "250_plus"), (10.0, "10_25"), (25.0, "25_50"), (50.0, "50_100"), (100.0, "100_250"), (250.0, "250_plus"), (-9.99, "0_10")]
    df = spark.createDataFrame(numbers, "amount double, want string")
    assert values(df.where(fx.amount_bucket(F.col("amount")) != F.col("want")), "want") == []
    text = spark.createDataFrame([("abc",), ("12.5",)], "amount string")
    assert values(text.select(fx.amount_bucket(F.col("amount")).alias("b")), "b") == ["unknown", "10_25"]


def test_clean_description(spark):
    df = spark.createDataFrame([('  Shell  #12\tX ',), (None,), ("A B #٣",)], "d string")
    assert values(df.select(fx.clean_description(F.col("d")).alias("c")), "c") == ["shell x", "", "a b"]


def test_headers_and_required_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` user_ID` int, `ACCOUNT_name ` int, ` Extra ` int")
    assert schema.normalize_columns(df).columns == ["user_id", "account_name", "Extra"]
    with pytest.raises(ValueError, match="amount"):
        schema.require_columns(df, ["amount"])


def test_mode_and_median_defaults(spark):
    df = spark.createDataFrame([("b", None, None), ("a", None, None), (None, None, None)], "c string, n double, e string")
    assert impute.train_modes(df, ["c", "e"]) == {"c": "a", "e": "Missing"}
    assert impute.train_median(df, "n") == 0.0


def test_single_class_split_is_plain(spark):
    df = spark.range(10).select(F.col("id").alias("row_id"), F.lit("x").alias("category"))
    assert {r["split"]: r["count"] for r in split.stratified_split(df).groupBy("split").count().collect()} == {"train": 8, "valid": 2}


# published class counts of the full data, of the validation split, and balanced weights of the rest
PUBLISHED = {
    "Food & Drink": (3541, 709, 0.3391399874450722),
    "Credit Card Payment": (1781, 356, 0.6739961013645224),
    "Utilities & Services": (1420, 284, 0.8454616588419406),
    "Transportation": (1030, 206, 1.1655879180151025),
    "Shopping": (964, 193, 1.2457126387087476),
    "Housing": (687, 138, 1.7494434325035417),
    "Paycheck": (637, 127, 1.8832244008714596),
    "Entertainment": (524, 105, 2.2922301776717053),
    "Haircut": (222, 44, 5.395755305867666),
}


def test_published_split_counts_and_weights(spark):
    names = F.array(*[F.lit(c) for c in PUBLISHED])
    sizes = F.array(*[F.lit(n) for n, _, _ in PUBLISHED.values()])
    rows = spark.range(1).select(F.explode(F.arrays_zip(names.alias("c"), sizes.alias("n"))).alias("p")).select(F.col("p.c").alias("category"), F.explode(F.sequence(F.lit(1), F.col("p.n"))).alias("i"))
    df = rows.select("category", F.xxhash64("category", "i").alias("row_id"))
    marked = split.stratified_split(df)
    found = {r["category"]: r["n"] for r in marked.where("split = 'valid'").groupBy("category").agg(F.count("*").alias("n")).collect()}
    assert found == {c: v for c, (_, v, _) in PUBLISHED.items()}
    weights = {r["category"]: r["weight"] for r in impute.balanced_class_weights(marked.where("split = 'train'")).collect()}
    assert weights == {c: w for c, (_, _, w) in PUBLISHED.items()}


def test_folds_are_even_per_class(spark):
    df = spark.range(1003).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("category"))
    sizes = split.stratified_kfold(df).groupBy("category", "fold").count().collect()
    for c in ("a", "b"):
        counts = [r["count"] for r in sizes if r["category"] == c]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_keyword_rules_stop_at_the_first_match(spark):
    rules = [("shell", "Fuel"), ("store", "Shop")]
    rows = [(1, "Shell store", "Fuel", "Shop"), (2, "shell store", "Food", "Shop"), (3, "a store", "Food", "Shop"), (4, None, "Food", "Shop"), (5, "x shell", "Food", "Fuel")]
    noise = spark.createDataFrame(rows, "row_id long, description string, category string, cv_pred string")
    out = {r["row_id"]: (r["category_corrected"], r["label_changed"]) for r in relabel.keyword_rule_relabel(noise, rules).collect()}
    assert out == {1: ("Fuel", False), 2: ("Food", False), 3: ("Shop", True), 4: ("Food", False), 5: ("Fuel", True)}
    word = relabel.keyword_rule_relabel(noise.withColumn("description", F.lit("parent")), [("rent", "Shop")], word=True)
    assert word.where("label_changed").count() == 0


def test_corrections(spark):
    train = spark.createDataFrame([(0, "a", "d"), (1, "b", "d")], "row_id long, category string, description string")
    rows = [(0, "z", "second", 2), (0, "y", "first", 1), (1, "b", "same", 1), (-1, "q", "bad", 1)]
    fixes = spark.createDataFrame(rows, "row_id long, category_corrected string, review_note string, seq int")
    updated, log = relabel.apply_corrections(train, fixes)
    assert {r["row_id"]: r["category"] for r in updated.collect()} == {0: "y", 1: "b"}
    assert [tuple(r) for r in log.collect()] == [(0, "a", "y", "d", "first")]
    with pytest.raises(ValueError, match="row ids"):
        relabel.apply_corrections(train, fixes, on_bad="error")


def test_misaligned_noise_is_an_error(spark):
    train = spark.range(3).withColumnRenamed("id", "row_id")
    noise = spark.range(1, 4).select(F.col("id").alias("row_id"), F.lit("a").alias("cv_pred"), F.lit(0.1).alias("true_label_prob"), F.lit(False).alias("flagged_suspicious"))
    with pytest.raises(ValueError, match="row ids"):
        align_noise(train, noise)


def test_predicted_label_that_never_occurs_counts_in_macro(spark):
    preds = spark.createDataFrame([("a", "a"), ("a", "b")], "category string, prediction string")
    row = metrics.classification_metrics(preds).first()
    assert row["accuracy"] == 0.5 and abs(row["macro_f1"] - (2 / 3) / 2) < 1e-12 and abs(row["weighted_f1"] - 2 / 3) < 1e-12


def test_class_aware_target_zero_still_removes_one(spark):
    pool = spark.createDataFrame([(1, "a", 0.9), (2, "a", 0.8), (3, "b", 0.7)], "row_id long, category string, score double")
    drop = removal.class_aware_removal({"a": 10, "b": 2}, pool, "score", [(0.1, 2), (1.0, 2), (1.0, 9)])
    assert [values(pool.where(d).orderBy("row_id"), "row_id") for d in drop] == [[1], [1, 2], [1]]


def test_csv_round_trip_and_row_ids(spark):
    raw = spark.createDataFrame([("u", "A, \"q\"", "1.5", "NA"), ("v", "  ", "x", "n/a")], "`User ID` string, Description string, Amount string, Category string")
    path = scratch_path(spark, "csv")
    files.write_csv(raw, path)
    rows = {r["user_id"]: r for r in files.read_transactions(spark, path).collect()}
    assert rows["u"]["description"] == 'A, "q"' and rows["u"]["amount"] == 1.5 and rows["u"]["category"] is None
    assert rows["v"]["description"] == "  " and rows["v"]["amount"] is None and sorted(r["row_id"] for r in rows.values()) == [0, 1]


def test_summary_round_trip(spark):
    raw = spark.range(60).select(
        F.col("id").alias("row_id"), F.lit("u").alias("user_id"), F.col("id").cast("string").alias("description"), F.col("id").cast("double").alias("amount"),
        F.when(F.col("id") < 5, " ").otherwise("debit").alias("transaction_type"), F.lit("acct").alias("account_name"),
        F.when(F.col("id") % 10 == 0, "nowhere").when(F.col("id") % 3 == 0, "Music").otherwise("Haircut").alias("category"),
    )
    again = raw.unionByName(raw.where("row_id < 7").withColumn("row_id", F.col("row_id") + 1000))
    train, valid, summary = prepare_baseline(again, schema.category_map(spark))
    path = scratch_path(spark, "summary")
    files.write_summary(summary, path)
    row = files.read_summary(spark, path, summary.schema).first()
    assert (row["raw_rows"], row["duplicates_removed"], row["rows_dropped_unmapped"], row["final_rows_before_split"]) == (67, 7, 6, 54)
    assert row["split"]["validation_rows"] == valid.count() == 11 and row["split"]["train_rows"] == train.count()
    assert row["imputation_values"]["categorical"]["transaction_type"] == "debit"
    assert train.unionByName(valid).where("transaction_type IS NULL").count() == 0
