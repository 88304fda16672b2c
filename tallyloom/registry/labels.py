"""Noise scores, flags, rules and corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions import columns as fx
from tallyloom.operators import metrics, noise as nz, relabel, split
from tallyloom.registry import sql
from tallyloom.registry.base import noise, query, r6
from tallyloom.registry.sql import build
from tallyloom.runtime import materialise
from tallyloom.sources import adapters

KEYS = ["description", "amount_bucket", "transaction_type"]
SCORES = "row_id, category, cv_pred, true_label_prob"


@query("oof_scores", build(f"SELECT {SCORES} FROM noise", "noise"))
def oof_scores(spark, sf):
    return adapters.noise_scores(spark, sf).select("row_id", "category", "cv_pred", "true_label_prob")


SEEDED = "SELECT l.*, s.seed FROM lab l CROSS JOIN (VALUES (42), (52), (62)) AS s(seed)"
REPEATED = f"""
SELECT row_id, category, round(avg(true_label_prob), 6) AS mean_true_label_prob, CAST(sum(CAST(cv_pred <> category AS INT)) AS INT) AS wrong_cv_count,
       sum(CAST(cv_pred <> category AS INT)) >= 2 AND round(avg(true_label_prob), 9) < 0.2 AS flagged_suspicious
FROM runs GROUP BY row_id, category"""
REPEATED_PARTS = dict(seeded=SEEDED, rfold=sql.fold_sql("seeded", "CAST(seed AS VARCHAR)", "seed, category"), runs=sql.oof_sql("rfold", "seed"))


def repeated(spark, sf):
    folded = materialise(split.folds_by_seed(adapters.labelled(spark, sf), fixed.REPEAT_SEEDS), "folded")
    return nz.CountingScorer().out_of_folds(folded, fixed.REPEAT_SEEDS)


@query("oof_repeated", build(REPEATED, "lab", **REPEATED_PARTS))
def oof_repeated(spark, sf):
    merged = nz.combined_runs(repeated(spark, sf))
    return merged.select("row_id", "category", *r6("mean_true_label_prob"), "wrong_cv_count", "flagged_suspicious")


@query("flag_repeated", build(f"SELECT row_id, wrong_cv_count FROM ({REPEATED}) WHERE flagged_suspicious", "lab", **REPEATED_PARTS))
def flag_repeated(spark, sf):
    return nz.combined_runs(repeated(spark, sf)).where("flagged_suspicious").select("row_id", "wrong_cv_count")


@query("flag_suspicious", build(f"SELECT {SCORES} FROM noise WHERE cv_pred <> category AND true_label_prob < 0.20", "noise"))
def flag_suspicious(spark, sf):
    rows = noise(spark, sf)
    return rows.where(fx.flag_suspicious(F.col("category"), F.col("cv_pred"), F.col("true_label_prob"))).select(
        "row_id", "category", "cv_pred", "true_label_prob"
    )


@query("likely_mislabeled", build(f"SELECT {SCORES} FROM noise WHERE true_label_prob < 0.05 AND wrong_flag = 1", "noise"))
def likely_mislabeled(spark, sf):
    return nz.likely_mislabeled(noise(spark, sf)).select("row_id", "category", "cv_pred", "true_label_prob")


@query("candidate_pool", build(f"SELECT {SCORES} FROM pool", "pool"))
def candidate_pool(spark, sf):
    return nz.candidate_pool(noise(spark, sf)).select("row_id", "category", "cv_pred", "true_label_prob")


@query("align_noise", build("SELECT row_id, description, category, cv_pred, true_label_prob, flagged_suspicious FROM noise", "noise"))
def align_noise(spark, sf):
    rows = nz.align_noise(adapters.labelled(spark, sf), noise(spark, sf))
    return rows.select("row_id", "description", "category", "cv_pred", "true_label_prob", "flagged_suspicious")


DOMINANT = """
SELECT description, amount_bucket, transaction_type, category AS dominant, n, total_n, n / total_n AS dominance FROM (
  SELECT *, CAST(sum(n) OVER (PARTITION BY description, amount_bucket, transaction_type) AS BIGINT) AS total_n,
         row_number() OVER (PARTITION BY description, amount_bucket, transaction_type ORDER BY n DESC, category) AS rk
  FROM (SELECT description, amount_bucket, transaction_type, category, count(*) AS n FROM lab GROUP BY ALL)) WHERE rk = 1"""


@query("dominant_label", build("SELECT * REPLACE (round(dominance, 6) AS dominance) FROM dom", "lab", dom=DOMINANT))
def dominant_label(spark, sf):
    return relabel.dominant_label(adapters.labelled(spark, sf), KEYS).select(*KEYS, "dominant", "n", "total_n", *r6("dominance"))


@query(
    "relabel_dominant",
    build(
        "SELECT l.row_id, coalesce(d.dominant, l.category) AS category, l.category AS category_original, coalesce(d.dominant <> l.category, false) AS label_changed "
        "FROM lab l LEFT JOIN (SELECT * FROM dom WHERE dominance >= 0.9) d USING (description, amount_bucket, transaction_type)",
        "lab",
        dom=DOMINANT,
    ),
)
def relabel_dominant(spark, sf):
    return relabel.relabel_dominant(adapters.labelled(spark, sf), KEYS).select("row_id", "category", "category_original", "label_changed")


PURITY = """
SELECT merchant, cv_pred AS target, total_n, n / total_n AS purity FROM (
  SELECT *, CAST(sum(n) OVER (PARTITION BY merchant) AS BIGINT) AS total_n, row_number() OVER (PARTITION BY merchant ORDER BY n DESC, cv_pred) AS rk
  FROM (SELECT lower(trim(description)) AS merchant, cv_pred, count(*) AS n FROM noise WHERE trim(description) <> '' GROUP BY ALL))
WHERE rk = 1 AND total_n >= 5 AND n / total_n >= {0}"""
MERCHANTS = ["click store 3", "purchase store 4", "view store 1", "error store 7", "signup store 2", "login store 5", "purchase store 0", "click store 8"]
MERCHANT_LIST = "(" + ", ".join(f"'{m}'" for m in MERCHANTS) + ")"


@query("merchant_purity", build("SELECT merchant, target, total_n, round(purity, 6) AS purity FROM p", "noise", p=PURITY.format("0.5")))
def merchant_purity(spark, sf):
    return relabel.merchant_purity(noise(spark, sf), 5, 0.5).select("merchant", "target", "total_n", *r6("purity"))


@query("whitelist_merchants", build(f"SELECT merchant, target, total_n FROM p WHERE merchant IN {MERCHANT_LIST}", "noise", p=PURITY.format("0.5")))
def whitelist_merchants(spark, sf):
    rules = relabel.merchant_purity(noise(spark, sf), 5, 0.5)
    return relabel.whitelist_merchants(rules, MERCHANTS).select("merchant", "target", "total_n")


CHANGE = "coalesce(r.target <> n.category AND n.cv_pred = r.target, false)"
MERCHANT_RULES = f"""
SELECT n.row_id, n.category, CASE WHEN {CHANGE} THEN r.target ELSE n.category END AS category_corrected,
       CASE WHEN {CHANGE} THEN 'merchant_rule + model_agrees' ELSE '' END AS review_note, {CHANGE} AS label_changed
FROM noise n LEFT JOIN r ON lower(trim(n.description)) = r.merchant"""


@query(
    "merchant_rule_relabel",
    build(MERCHANT_RULES, "noise", p=PURITY.format("0.5"), r=f"SELECT merchant, target FROM p WHERE merchant IN {MERCHANT_LIST}"),
)
def merchant_rule_relabel(spark, sf):
    scores = noise(spark, sf)
    rules = relabel.whitelist_merchants(relabel.merchant_purity(scores, 5, 0.5), MERCHANTS)
    done = relabel.merchant_rule_relabel(scores, rules)
    return done.select("row_id", "category", "category_corrected", "review_note", "label_changed")


KEYWORDS = [("store 3", "Housing"), ("purchase", "Shopping"), ("click", "Transportation"), ("store", "Utilities & Services"), ("error", "Housing")]


def keyword_case(what: str, rules=KEYWORDS) -> str:
    pick = {"target": 1, "keyword": 0}[what]
    return "CASE " + " ".join(f"WHEN contains(lower(trim(description)), '{r[0]}') THEN '{r[pick]}'" for r in rules) + " END"


KEYWORD_SQL = """
SELECT row_id, category, CASE WHEN hit THEN target ELSE category END AS category_corrected,
       CASE WHEN hit THEN 'keyword=''' || keyword || ''' + model_agrees' ELSE '' END AS review_note, hit AS label_changed
FROM (SELECT *, coalesce(target <> category AND cv_pred = target, false) AS hit FROM (SELECT *, {0} AS target, {1} AS keyword FROM {2}))"""


@query("keyword_rule_relabel", build(KEYWORD_SQL.format(keyword_case("target"), keyword_case("keyword"), "noise"), "noise"))
def keyword_rule_relabel(spark, sf):
    done = relabel.keyword_rule_relabel(noise(spark, sf), KEYWORDS)
    return done.select("row_id", "category", "category_corrected", "review_note", "label_changed")


SUSPICION = "round((1.0::DOUBLE - true_label_prob) + wrong_flag{0}, 9)"
COMPAT = SUSPICION.format(" + (1.0 - ((1.0::DOUBLE - true_label_prob) + 0.25 * wrong_flag))")


@query(
    "top_suspicious",
    build(
        f"SELECT 'rank' AS mode, row_id, round(s, 6) AS suspicion_score FROM (SELECT row_id, {SUSPICION.format('')} AS s FROM noise ORDER BY s DESC, row_id LIMIT 300) "
        f"UNION ALL SELECT 'compat', row_id, round(s, 6) FROM (SELECT row_id, {COMPAT} AS s FROM noise ORDER BY s DESC, row_id LIMIT 300)",
        "noise",
    ),
)
def top_suspicious(spark, sf):
    scores = noise(spark, sf).withColumn("rank_score", fx.rank_score(F.col("true_label_prob"), F.col("wrong_flag")))
    part = lambda mode: relabel.top_suspicious(scores, 300, mode, rank="rank_score").select(
        F.lit(mode).alias("mode"), "row_id", *r6("suspicion_score")
    )
    return part("rank").unionByName(part("compat"))


@query("rank_score", build("SELECT row_id, round((1.0::DOUBLE - true_label_prob) + 0.25 * wrong_flag, 6) AS rank_score FROM noise", "noise"))
def rank_score(spark, sf):
    return noise(spark, sf).select("row_id", F.round(fx.rank_score(F.col("true_label_prob"), F.col("wrong_flag")), 6).alias("rank_score"))


def corrections(spark, sf):
    """Two opinions per suspicious row, the model's own first for even ids, and ids that do not exist."""
    flagged = noise(spark, sf).where("flagged_suspicious")
    one = flagged.select(F.when(F.col("row_id") % 11 == 0, F.col("row_id") - 1_000_000).otherwise(F.col("row_id")).alias("row_id"),
                         F.col("cv_pred").alias("category_corrected"), F.lit("model").alias("review_note"), (F.col("row_id") % 2).alias("seq"))
    two = flagged.select("row_id", F.lit("Housing").alias("category_corrected"), F.lit("second").alias("review_note"), F.lit(0.5).alias("seq"))
    return one.withColumn("seq", F.col("seq").cast("double")).unionByName(two.withColumn("seq", F.col("seq").cast("double")))


CORRECTIONS = """
SELECT CASE WHEN row_id % 11 = 0 THEN row_id - 1000000 ELSE row_id END AS row_id, cv_pred AS category_corrected, 'model' AS review_note, CAST(row_id % 2 AS DOUBLE) AS seq
FROM noise WHERE flagged_suspicious UNION ALL SELECT row_id, 'Housing', 'second', 0.5 FROM noise WHERE flagged_suspicious"""
FIRSTS = "SELECT row_id, arg_min(category_corrected, seq) AS category_corrected, arg_min(review_note, seq) AS review_note FROM corr GROUP BY row_id"


@query("validate_row_ids", build("SELECT row_id, category_corrected, seq FROM corr WHERE row_id IN (SELECT row_id FROM noise)", "noise", corr=CORRECTIONS))
def validate_row_ids(spark, sf):
    return relabel.validate_row_ids(corrections(spark, sf), noise(spark, sf), "skip").select("row_id", "category_corrected", "seq")


@query(
    "apply_corrections",
    build(
        "SELECT n.row_id, coalesce(f.category_corrected, n.category) AS category, f.category_corrected <> n.category AND f.row_id IS NOT NULL AS logged, "
        "CASE WHEN f.category_corrected <> n.category THEN n.category END AS category_before, "
        "CASE WHEN f.category_corrected <> n.category THEN f.review_note END AS review_note FROM noise n LEFT JOIN f ON n.row_id = f.row_id",
        "noise",
        corr=CORRECTIONS,
        f=FIRSTS,
    ).replace("f.category_corrected <> n.category AND f.row_id IS NOT NULL AS logged", "coalesce(f.category_corrected <> n.category, false) AS logged"),
)
def apply_corrections(spark, sf):
    updated, log = relabel.apply_corrections(noise(spark, sf), corrections(spark, sf))
    joined = updated.select("row_id", "category").join(log.select("row_id", "category_before", "review_note"), "row_id", "left")
    return joined.select("row_id", "category", F.col("category_before").isNotNull().alias("logged"), "category_before", "review_note")


@query("focal_weights", build("SELECT row_id, round(greatest(0.05, least(2.5, 0.75 * power(1 - true_label_prob, 2))), 6) AS weight FROM noise", "noise"))
def focal_weights(spark, sf):
    return noise(spark, sf).select("row_id", F.round(fx.focal_weight(F.col("true_label_prob")), 6).alias("weight"))


MINORITY = """
SELECT category, n FROM (SELECT category, count(*) AS n, row_number() OVER (ORDER BY count(*), category) AS rk, count(*) OVER () AS k FROM noise GROUP BY category)
WHERE rk <= greatest(1, CAST(floor(0.3 * k) AS INT))"""


@query("minority_classes", build(MINORITY, "noise"))
def minority_classes(spark, sf):
    return metrics.minority_classes(noise(spark, sf))


@query(
    "minority_focal_weights",
    build(
        "SELECT row_id, round(CASE WHEN category IN (SELECT category FROM m) THEN greatest(0.5, least(3.0, 1 + 1.2 * power(1 - true_label_prob, 2))) ELSE 1.0 END, 6) AS weight FROM noise",
        "noise",
        m=MINORITY,
    ),
)
def minority_focal_weights(spark, sf):
    rows = noise(spark, sf)
    rare = [r["category"] for r in metrics.minority_classes(rows).collect()]
    return rows.select("row_id", F.round(fx.minority_focal_weight(F.col("true_label_prob"), F.col("category").isin(rare)), 6).alias("weight"))


@query(
    "soft_label_duplicate",
    build(
        "SELECT row_id, category, round(0.9, 6)::DOUBLE AS weight FROM noise UNION ALL SELECT row_id, cv_pred, round(1.0::DOUBLE - 0.9, 6) FROM noise WHERE cv_pred <> category",
        "noise",
    ),
)
def soft_label_duplicate(spark, sf):
    from tallyloom.operators.removal import soft_label_duplicate as doubled

    return doubled(noise(spark, sf), 0.9).select("row_id", "category", *r6("weight"))
