"""Preparation queries: sources, schema, filters, splits, imputation, class tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions import columns as fx
from tallyloom.operators import impute, schema, split
from tallyloom.plans import prepare
from tallyloom.registry import sql
from tallyloom.registry.base import noise, prepared, query, r6, train_valid
from tallyloom.registry.sql import build
from tallyloom.runtime import materialise, scratch_path
from tallyloom.sources import adapters, files

RAW_COLUMNS = "row_id, user_id, date, description, amount, transaction_type, account_name, category"


@query("read_transactions", build(f"SELECT {RAW_COLUMNS} FROM tx", "tx"))
def read_transactions(spark, sf):
    raw = adapters.transactions(spark, sf)
    path = files.through_file(raw.select(*[files.header_case(c) for c in raw.columns]), "csv", "csv")
    return files.read_transactions(spark, path).select(*raw.columns)


@query(
    "read_split",
    build(
        "SELECT split, category, count(*) AS n, round(sum(amount), 6) AS amount, count(description) AS n_text, "
        "'description,amount,amount_bucket,transaction_type,account_name' AS features FROM splitrows GROUP BY ALL",
        "splitrows",
    ),
)
def read_split(spark, sf):
    path = scratch_path(spark, "split")
    files.write_split(*train_valid(spark, sf), path)
    train, valid, features = files.read_split(spark, path)
    both = train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))
    return both.groupBy("split", "category").agg(
        F.count("*").alias("n"), F.round(F.sum("amount"), 6).alias("amount"), F.count("description").alias("n_text"), F.lit(",".join(features)).alias("features")
    )


@query("write_split", build("SELECT row_id, split, category FROM splitrows", "splitrows"))
def write_split(spark, sf):
    path = scratch_path(spark, "split")
    files.write_split(*train_valid(spark, sf), path)
    train, valid, _ = files.read_split(spark, path)
    part = lambda df, name: df.select("row_id", F.lit(name).alias("split"), df.columns[-1])
    return part(train, "train").unionByName(part(valid, "valid"))


WEIGHTS = "SELECT category, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM train GROUP BY category"


@query("read_summary", build(WEIGHTS, "train"))
def read_summary(spark, sf):
    return files.stored_class_weights(stored_summary(spark, sf)).select("category", *r6("weight"))


def stored_summary(spark, sf):
    rows = prepared(spark, sf)
    features = schema.feature_names(rows.columns)
    summary = prepare.preparation_summary(rows, rows, rows, rows, {"amount": 0.0}, features, 0.2, 42, "shared_baseline")
    path = scratch_path(spark, "summary")
    files.write_summary(summary, path)
    return files.read_summary(spark, path, summary.schema)


DISTRIBUTION = "SELECT split, category, count(*) AS n FROM splitrows GROUP BY ALL UNION ALL SELECT 'full', category, count(*) FROM splitrows GROUP BY ALL"


@query("write_summary", build(DISTRIBUTION, "splitrows"))
def write_summary(spark, sf):
    splits = stored_summary(spark, sf).select(F.explode("class_distribution").alias("split", "m"))
    return splits.select("split", F.explode("m").alias("category", "n"))


@query("require_columns", build("SELECT row_id, amount, category FROM tx", "tx"))
def require_columns(spark, sf):
    needed = ["amount", "transaction_type", "account_name", "category"]
    return schema.require_columns(adapters.transactions(spark, sf), needed).select("row_id", "amount", "category")


@query("write_predictions", build("SELECT row_id, category, prediction FROM preds", "preds"))
def write_predictions(spark, sf):
    from tallyloom.registry.evaluation import predictions

    path = scratch_path(spark, "predictions")
    files.write_predictions(predictions(spark, sf), path)
    return spark.read.parquet(path).select("row_id", "category", "prediction")


@query(
    "write_noise_scores",
    build("SELECT row_id, category, cv_pred, true_label_prob, wrong_flag, flagged_suspicious FROM noise", "noise"),
)
def write_noise_scores(spark, sf):
    path = scratch_path(spark, "scores")
    files.write_noise_scores(noise(spark, sf), path)
    return spark.read.parquet(path).select("row_id", "category", "cv_pred", "true_label_prob", "wrong_flag", "flagged_suspicious")


@query("normalize_columns", build(f"SELECT {RAW_COLUMNS} FROM tx", "tx"))
def normalize_columns(spark, sf):
    raw = adapters.transactions(spark, sf)
    odd = raw.toDF(*[f" {c.upper()} " if i % 2 else c.replace("_", " ").title() if c != "row_id" else c for i, c in enumerate(raw.columns)])
    return schema.normalize_columns(odd)


@query("blank_to_null", build(f"SELECT {RAW_COLUMNS} FROM txn", "txn"))
def blank_to_null(spark, sf):
    return schema.blank_strings_to_null(adapters.transactions(spark, sf))


@query("drop_shared_columns", build("SELECT * EXCLUDE (user_id, date) FROM tx", "tx"))
def drop_shared_columns(spark, sf):
    return schema.drop_shared_columns(adapters.transactions(spark, sf))


@query("select_features", build("SELECT row_id, description, amount, transaction_type, account_name, category FROM tx", "tx"))
def select_features(spark, sf):
    return schema.select_features(adapters.transactions(spark, sf))


@query(
    "ensure_columns",
    build(
        "SELECT row_id, coalesce(description, '') AS description, coalesce(amount, 0.0) AS amount, "
        "coalesce(transaction_type, 'unknown') AS transaction_type, 'unknown' AS account_name FROM txn",
        "txn",
    ),
)
def ensure_columns(spark, sf):
    partial = schema.blank_strings_to_null(adapters.transactions(spark, sf)).select("row_id", "description", "amount", "transaction_type")
    return schema.ensure_columns(partial, {"description": "", "amount": 0.0, "transaction_type": "unknown", "account_name": "unknown"})


NUMBER_TEXT = "CASE WHEN row_id % 5 = 0 THEN description WHEN row_id % 7 = 0 THEN ' ' || CAST(k AS VARCHAR) || '.5 ' ELSE CAST(k AS VARCHAR) END"


@query(
    "to_numeric",
    build(
        "SELECT row_id, TRY_CAST(t AS DOUBLE) AS number, coalesce(TRY_CAST(t AS DOUBLE), 0.0) AS filled FROM ("
        f"SELECT row_id, {NUMBER_TEXT} AS t FROM (SELECT row_id, description, CAST(user_id AS BIGINT) AS k FROM tx))",
        "tx",
    ),
)
def to_numeric(spark, sf):
    tx = adapters.transactions(spark, sf).select("row_id", "description", F.col("user_id").cast("long").alias("k"))
    text = tx.select("row_id", F.expr(NUMBER_TEXT.replace("VARCHAR", "STRING")).alias("t"))
    return text.select("row_id", fx.to_number(F.col("t")).alias("number"), fx.to_number(F.col("t"), 0.0).alias("filled"))


@query("clean_description", build(f"SELECT row_id, {sql.CLEAN.format('description')} AS description FROM txn", "txn"))
def clean_description(spark, sf):
    tx = schema.blank_strings_to_null(adapters.transactions(spark, sf), ["description"])
    return tx.select("row_id", fx.clean_description(F.col("description")).alias("description"))


@query("amount_bucket", build(f"SELECT row_id, {sql.BUCKET.format('amount')} AS amount_bucket FROM tx", "tx"))
def amount_bucket(spark, sf):
    return adapters.transactions(spark, sf).select("row_id", fx.amount_bucket(F.col("amount")).alias("amount_bucket"))


@query("normalize_merchant", build("SELECT row_id, lower(trim(description)) AS merchant FROM tx WHERE trim(description) <> ''", "tx"))
def normalize_merchant(spark, sf):
    return adapters.transactions(spark, sf).select("row_id", fx.merchant_name(F.col("description")).alias("merchant")).where("merchant <> ''")


@query("category_rollup", build("SELECT t.row_id, m.grp AS category FROM tx t LEFT JOIN cmap m ON t.category = m.category", "tx", "cmap"))
def category_rollup(spark, sf):
    return schema.category_rollup(adapters.transactions(spark, sf), schema.category_map(spark)).select("row_id", "category")


@query("label_encode", build("SELECT row_id, category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INT) AS label_code FROM lab", "lab"))
def label_encode(spark, sf):
    rows = prepared(spark, sf)
    labels = schema.label_list(rows.where("split = 'train'"), rows.where("split = 'valid'"))
    return schema.label_encode(rows, labels).select("row_id", "category", "label_code")


@query("label_decode", build("SELECT row_id, category AS decoded FROM lab", "lab"))
def label_decode(spark, sf):
    rows = prepared(spark, sf)
    labels = schema.label_list(rows)
    return schema.label_decode(schema.label_encode(rows, labels), labels, "label_code", "decoded").select("row_id", "decoded")


@query(
    "assign_row_id",
    build("SELECT row_id AS event_id, row_number() OVER (ORDER BY account_name, date, row_id) - 1 AS row_id FROM tx", "tx"),
)
def assign_row_id(spark, sf):
    tx = adapters.transactions(spark, sf).select(F.col("row_id").alias("event_id"), "account_name", "date")
    return schema.assign_row_id(tx, F.col("account_name"), F.col("date"), F.col("event_id")).select("event_id", "row_id")


@query("label_universe", build("SELECT DISTINCT category FROM lab", "lab"))
def label_universe(spark, sf):
    return schema.label_universe(*train_valid(spark, sf))


@query("dedup_exact", build(f"SELECT {RAW_COLUMNS.replace('row_id, ', '')}, min(row_id) AS row_id FROM txn GROUP BY ALL", "txn"))
def dedup_exact(spark, sf):
    tx = schema.blank_strings_to_null(adapters.transactions(spark, sf))
    again = tx.where("row_id % 50 = 0").withColumn("row_id", F.col("row_id") + 1_000_000_000_000)
    return schema.dedup_exact(tx.unionByName(again))


@query(
    "drop_unmapped_target",
    build("SELECT t.row_id, m.grp AS category, (SELECT count(*) FROM tx WHERE category = 'Unmapped') AS n_dropped FROM tx t JOIN cmap m ON t.category = m.category", "tx", "cmap"),
)
def drop_unmapped_target(spark, sf):
    rolled = schema.category_rollup(adapters.transactions(spark, sf), schema.category_map(spark))
    dropped = rolled.agg(F.count_if(F.col("category").isNull())).scalar()
    return schema.drop_unmapped_target(rolled).select("row_id", "category", dropped.alias("n_dropped"))


@query("stratified_split", build("SELECT row_id, category, split FROM splitrows", "splitrows"))
def stratified_split(spark, sf):
    return split.stratified_split(adapters.labelled(spark, sf)).select("row_id", "category", "split")


@query("stratified_kfold", build("SELECT row_id, category, fold FROM folded", "folded"))
def stratified_kfold(spark, sf):
    return split.stratified_kfold(adapters.labelled(spark, sf).select("row_id", "category"))


@query(
    "repeated_kfold",
    build(
        "SELECT row_id, category, seed, fold FROM rf",
        "lab",
        seeded="SELECT l.row_id, l.category, s.seed FROM lab l CROSS JOIN (VALUES (42), (52), (62)) AS s(seed)",
        rf=sql.fold_sql("seeded", "CAST(seed AS VARCHAR)", "seed, category"),
    ),
)
def repeated_kfold(spark, sf):
    return split.repeated_kfold(adapters.labelled(spark, sf).select("row_id", "category"), fixed.REPEAT_SEEDS)


CV3 = """
SELECT row_id, category, CAST((SELECT count(*) FROM runs r WHERE r.category = p.category AND r.reached <= p.rn) AS INT) AS fold FROM placed p
"""


@query(
    "cv3_split",
    build(
        CV3,
        "lab",
        placed="SELECT row_id, category, row_number() OVER (PARTITION BY category ORDER BY row_id) - 1 AS rn FROM lab",
        classes="SELECT category, n, sum(n) OVER (ORDER BY first_id) - n AS start FROM (SELECT category, count(*) AS n, min(row_id) AS first_id FROM lab GROUP BY category)",
        runs="""SELECT category, f, sum(len) OVER (PARTITION BY category ORDER BY f) AS reached FROM (
                  SELECT category, f, (SELECT count(*) FROM range(CAST(start AS BIGINT), CAST(start + n AS BIGINT)) t(i) WHERE i % 3 = f) AS len
                  FROM classes CROSS JOIN (VALUES (0), (1)) AS v(f))""",
    ),
)
def cv3_split(spark, sf):
    return split.ordered_folds(adapters.labelled(spark, sf).select("row_id", "category"), k=3)


@query(
    "impute_numeric_median",
    build(
        "SELECT row_id, split, round(coalesce(amount, (SELECT median(amount) FROM splitrows WHERE split = 'train')), 6) AS amount FROM splitrows",
        "splitrows",
    ),
)
def impute_numeric_median(spark, sf):
    train, valid = impute.impute_numeric_median(*train_valid(spark, sf), ["amount"])
    tagged = train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))
    return tagged.select("row_id", "split", *r6("amount"))


RAW_SPLIT = dict(
    rawlab="SELECT t.row_id, t.description, t.amount, t.transaction_type, t.account_name, m.grp AS category FROM txn t JOIN cmap m ON t.category = m.category",
    rawsplit=sql.split_sql("rawlab"),
)


def mode_sql(col: str) -> str:
    return f"(SELECT {col} FROM rawsplit WHERE split = 'train' AND {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"


IMPUTED = (
    "SELECT row_id, split, category, round(coalesce(amount, (SELECT median(amount) FROM rawsplit WHERE split = 'train')), 6) AS amount, "
    + ", ".join(f"coalesce({c}, {mode_sql(c)}) AS {c}" for c in ("description", "transaction_type", "account_name"))
    + " FROM rawsplit"
)


def raw_split(spark, sf):
    _, rolled = prepare.clean_rows(adapters.transactions(spark, sf), schema.category_map(spark))
    return split.stratified_split(materialise(schema.drop_unmapped_target(rolled), "clean"))


@query(
    "impute_categorical_mode",
    build(
        f"SELECT row_id, split, coalesce(description, {mode_sql('description')}) AS description, "
        f"coalesce(transaction_type, {mode_sql('transaction_type')}) AS transaction_type FROM rawsplit",
        "txn",
        "cmap",
        **RAW_SPLIT,
    ),
)
def impute_categorical_mode(spark, sf):
    rows = raw_split(spark, sf)
    train, valid = impute.impute_categorical_mode(rows.where("split = 'train'"), rows.where("split = 'valid'"), ["description", "transaction_type"])
    return train.unionByName(valid).select("row_id", "split", "description", "transaction_type")


MISSING = " UNION ALL ".join(
    f"SELECT '{stage}' AS stage, split, '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM {rel} GROUP BY split"
    for stage, rel in (("before", "rawsplit"), ("after", "filled"))
    for c in ("description", "amount", "transaction_type", "account_name")
)


@query("missing_counts", build(MISSING, "txn", "cmap", **RAW_SPLIT, filled=IMPUTED))
def missing_counts(spark, sf):
    rows = raw_split(spark, sf)
    features = ["description", "amount", "transaction_type", "account_name"]
    values = impute.imputation_values(rows.where("split = 'train'"), ["amount"], [c for c in features if c != "amount"])
    stage = lambda df, name: impute.missing_counts(df, features).withColumn("stage", F.lit(name))
    return stage(rows, "before").unionByName(stage(impute.impute(rows, values), "after"))


@query(
    "class_distribution",
    build(DISTRIBUTION, "splitrows"),
)
def class_distribution(spark, sf):
    return impute.class_distribution(prepared(spark, sf))


@query("balanced_class_weights", build(WEIGHTS.replace("SELECT category,", "SELECT category, count(*) AS n,"), "train"))
def balanced_class_weights(spark, sf):
    return impute.balanced_class_weights(train_valid(spark, sf)[0]).select("category", "n", *r6("weight"))


@query(
    "balanced_sample_weight",
    build(
        f"SELECT row_id, round(c.weight_full * (0.5 + user_part / 10), 6) AS weight FROM (SELECT *, length(description) % 7 AS user_part FROM train) t "
        "JOIN (SELECT category, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight_full FROM train GROUP BY category) c USING (category)",
        "train",
    ),
)
def balanced_sample_weight(spark, sf):
    train = train_valid(spark, sf)[0].withColumn("own", 0.5 + F.length("description") % 7 / 10)
    return impute.sample_weights(train, weight="own").select("row_id", *r6("weight"))


@query("impute_in_pipeline", build(IMPUTED.replace("row_id, split, category", "row_id, split"), "txn", "cmap", **RAW_SPLIT))
def impute_in_pipeline(spark, sf):
    rows = raw_split(spark, sf)
    values = impute.imputation_values(rows.where("split = 'train'"), ["amount"], ["description", "transaction_type", "account_name"])
    return impute.impute(rows, values).select("row_id", "split", *r6("amount"), "description", "transaction_type", "account_name")


@query("prepare_baseline", build(IMPUTED, "txn", "cmap", **RAW_SPLIT))
def prepare_baseline(spark, sf):
    train, valid, _ = prepare.prepare_baseline(adapters.transactions(spark, sf), schema.category_map(spark))
    both = train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))
    return both.select("row_id", "split", "category", *r6("amount"), "description", "transaction_type", "account_name")


SUMMARY = f"""
SELECT (SELECT count(*) FROM tx) AS raw_rows, (SELECT count(*) FROM tx) AS rows_after_deduplication, 0::BIGINT AS duplicates_removed,
       (SELECT count(*) FROM tx WHERE category = 'Unmapped') AS rows_dropped_unmapped,
       count(*) AS final_rows, count_if(split = 'train')::BIGINT AS train_rows, count_if(split = 'valid')::BIGINT AS valid_rows,
       round((SELECT median(amount) FROM rawsplit WHERE split = 'train'), 6) AS amount_fill,
       {mode_sql('description')} AS description_fill, {mode_sql('transaction_type')} AS type_fill, {mode_sql('account_name')} AS account_fill,
       count_if(split = 'train' AND amount IS NULL)::BIGINT AS train_amount_missing,
       count_if(split = 'valid' AND description IS NULL)::BIGINT AS valid_description_missing, 0::BIGINT AS missing_after,
       count_if(split = 'valid' AND category = 'Housing')::BIGINT AS housing_valid,
       round(count_if(split = 'train') / (count(DISTINCT category) * count_if(split = 'train' AND category = 'Housing')), 6) AS housing_weight
FROM rawsplit"""


@query("preprocessing_summary", build(SUMMARY, "tx", "txn", "cmap", **RAW_SPLIT))
def preprocessing_summary(spark, sf):
    _, _, summary = prepare.prepare_baseline(adapters.transactions(spark, sf), schema.category_map(spark))
    left = F.aggregate(
        F.flatten(F.transform(F.map_values("missing_after"), lambda m: F.map_values(m))), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return summary.select(
        "raw_rows",
        "rows_after_deduplication",
        "duplicates_removed",
        "rows_dropped_unmapped",
        F.col("final_rows_before_split").alias("final_rows"),
        F.col("split.train_rows").alias("train_rows"),
        F.col("split.validation_rows").alias("valid_rows"),
        F.round(F.col("imputation_values.numeric")["amount"], 6).alias("amount_fill"),
        F.col("imputation_values.categorical")["description"].alias("description_fill"),
        F.col("imputation_values.categorical")["transaction_type"].alias("type_fill"),
        F.col("imputation_values.categorical")["account_name"].alias("account_fill"),
        F.col("missing_before")["train"]["amount"].alias("train_amount_missing"),
        F.col("missing_before")["valid"]["description"].alias("valid_description_missing"),
        left.alias("missing_after"),
        F.col("class_distribution")["valid"]["Housing"].alias("housing_valid"),
        F.round(F.col("class_weights")["Housing"], 6).alias("housing_weight"),
    )
