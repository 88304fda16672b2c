"""Feature, model and comparison queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyloom.operators import anomaly, features as ft, metrics, models as md, split
from tallyloom.operators.noise import CountingScorer, categorical_target_stats
from tallyloom.operators.schema import label_list
from tallyloom.plans import compare, workflows as wf
from tallyloom.registry import base
from tallyloom.registry.base import query, r6, train_valid
from tallyloom.registry.evaluation import training_noise
from tallyloom.registry.sql import build
from tallyloom.runtime import join_rows, materialise
from tallyloom.sources.adapters import labelled, read_table



def tfidf_sql(source: str, text: str, rid: str, vocab: int | None, min_df: int, max_df: float, stop: str = "") -> str:
    limit = f"ORDER BY corpus_n DESC, term LIMIT {vocab}" if vocab else ""
    return f"""
    WITH words AS (SELECT {rid}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {source}),
    counts AS (SELECT {rid}, term, count(*) AS tf FROM words {stop} GROUP BY ALL),
    terms AS (SELECT term, count(*) AS df, sum(tf) AS corpus_n FROM counts GROUP BY term),
    kept AS (SELECT term, ln((1 + (SELECT count(*) FROM {source})) / (1 + df)) + 1 AS idf FROM terms
             WHERE df >= {min_df} AND df <= {max_df}::DOUBLE * (SELECT count(*) FROM {source}) {limit}),
    raw AS (SELECT {rid}, term, tf * idf AS w FROM counts JOIN kept USING (term))
    SELECT {rid}, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY {rid})), 6) AS weight FROM raw"""


@query("tfidf", tfidf_sql("documents", "text", "doc_id", 10_000, 2, 0.95))
def tfidf(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return ft.tfidf(docs, "text", "doc_id").select("doc_id", "term", *r6("weight"))


#: Frequent words of the documents' languages.
STOP = ["the", "that", "and", "in", "die", "der", "und", "le", "la", "que", "el", "en"]


@query("tfidf_stop_words", tfidf_sql("documents", "text", "doc_id", 10_000, 1, 1.0, f"WHERE term NOT IN ({', '.join(map(repr, STOP))})"))
def tfidf_stop_words(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return ft.tfidf(docs, "text", "doc_id", min_df=1, max_df=1.0, stop=STOP).select("doc_id", "term", *r6("weight"))


@query("tfidf_open_vocabulary", tfidf_sql("documents", "text", "doc_id", None, 1, 1.0))
def tfidf_open_vocabulary(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return ft.tfidf(docs, "text", "doc_id", vocab=None, min_df=1, max_df=1.0).select("doc_id", "term", *r6("weight"))


@query("onehot", build("SELECT v.row_id, v.description AS value, 1.0::DOUBLE AS one FROM valid v WHERE v.description IN (SELECT description FROM train)", "train", "valid"))
def onehot(spark, sf):
    return ft.onehot(*train_valid(spark, sf), "description")


RATES = {
    c: f"""SELECT '{c}' AS "column", r.row_id, p.category AS label, round((coalesce(x.n, 0) + p.n / p.total) / (coalesce(k.n, 0) + 1), 6) AS rate
    FROM folded r
    JOIN (SELECT f.fold, b.category, count(*) AS n, sum(count(*)) OVER (PARTITION BY f.fold) AS total FROM folded b JOIN (SELECT unnest(range(5))::INT AS fold) f ON f.fold <> b.fold GROUP BY f.fold, b.category) p ON p.fold = r.fold
    LEFT JOIN (SELECT f.fold, b.{c}, count(*) AS n FROM folded b JOIN (SELECT unnest(range(5))::INT AS fold) f ON f.fold <> b.fold GROUP BY ALL) k ON k.fold = r.fold AND k.{c} = r.{c}
    LEFT JOIN (SELECT f.fold, b.{c}, b.category, count(*) AS n FROM folded b JOIN (SELECT unnest(range(5))::INT AS fold) f ON f.fold <> b.fold GROUP BY ALL) x
      ON x.fold = r.fold AND x.{c} = r.{c} AND x.category = p.category"""
    for c in ("description", "transaction_type", "account_name")
}


@query("categorical_target_stats", build(" UNION ALL ".join(RATES.values()), "folded"))
def categorical_target_stats_query(spark, sf):
    columns = list(RATES)
    folded = materialise(split.stratified_kfold(labelled(spark, sf)), "folded")
    labels = label_list(folded)
    coded = categorical_target_stats(folded, columns, labels)
    names = F.array(*[F.lit(y) for y in labels])

    def listed(c):
        return F.zip_with(names, f"te_{c}", lambda y, v: F.struct(F.lit(c).alias("column"), y.alias("label"), v.alias("rate")))

    pairs = F.flatten(F.array(*[listed(c) for c in columns]))
    return coded.select("row_id", F.explode(pairs).alias("p")).select("p.column", "row_id", "p.label", F.round("p.rate", 6).alias("rate"))


@query("feature_pipeline")
def feature_pipeline(spark, sf):
    train, valid = train_valid(spark, sf)
    model = ft.fit_features(train, ft.WIDE)
    out = model.transform(valid).select("row_id", vector_to_array("features").alias("v"))
    return out.select("row_id", F.size("v").alias("size"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


def embedding(spark, sf):
    return base._once(spark, sf, "embedding", lambda: compare.embed(*train_valid(spark, sf), 4000)[0])


@query("svd_embedding")
def svd_embedding(spark, sf):
    rows = compare.embed(*train_valid(spark, sf), 4000)[0]
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    return rows.select("row_id", F.size("embedding").alias("size"), F.round(square, 6).alias("square_norm"))


BASIS_RANK = 20


@query("svd_text_basis", f"SELECT a.i, b.i AS j, CASE WHEN a.i = b.i THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS dot FROM range({BASIS_RANK}) a(i) CROSS JOIN range({BASIS_RANK}) b(i)")
def svd_text_basis(spark, sf):
    """Products of the leading singular vectors of all documents' terms with each other, which must be orthonormal."""
    terms, _ = ft.text_basis(read_table(spark, sf, "documents").select("text"), "text", BASIS_RANK)
    one, two = terms.select("term", F.posexplode("weights").alias("i", "x"), "weights"), F.posexplode("weights").alias("j", "y")
    pairs = one.select("i", "x", two).groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    return pairs.select(F.col("i").cast("long"), F.col("j").cast("long"), (F.round("dot", 6) + 0.0).alias("dot"))


@query("fit_logreg")
def fit_logreg(spark, sf):
    return md.LogisticLearner().fit_score(*train_valid(spark, sf)).select("row_id", "category", "cv_pred", *r6("true_label_prob"))


@query("fit_linear_svm")
def fit_linear_svm(spark, sf):
    return md.SvmLearner().fit_score(*train_valid(spark, sf)).select("row_id", "category", "cv_pred")


@query("svm_modes")
def svm_modes(spark, sf):
    """The four text and category modes of the linear SVM, each fitted on the whole training split."""
    train, valid = train_valid(spark, sf)
    jobs = [lambda m=m: md.fold_scores([m], train, valid) for m in md.SVM_MODES.values()]
    scores = [s.select(F.lit(name).alias("mode"), *metrics.RANKING) for name, s in zip(md.SVM_MODES, md.side_by_side(jobs, 4))]
    return metrics.union_results(*scores)


@query("fit_boosted_trees")
def fit_boosted_trees(spark, sf):
    return md.TreeLearner().fit_score(*train_valid(spark, sf)).select("row_id", "category", "cv_pred", *r6("true_label_prob"))


@query("feature_importance")
def feature_importance(spark, sf):
    return md.feature_importance(train_valid(spark, sf)[0], md.TreeLearner())


@query("grid_search_cv")
def grid_search_cv(spark, sf):
    train = train_valid(spark, sf)[0]
    return md.grid_search(train, md.LogisticLearner(), md.LOGREG_GRID, split.ordered_folds(train), 3).trace


@query("oof_scores_logreg")
def oof_scores_logreg(spark, sf):
    noise = wf.score_training_rows(train_valid(spark, sf)[0], md.LogisticLearner())
    return noise.select("row_id", "category", "cv_pred", *r6("true_label_prob"), "wrong_flag")


@query("isolation_forest_by_class")
def isolation_forest_by_class(spark, sf):
    return anomaly.isolation_forest_by_class(embedding(spark, sf), 0.05).select("row_id", "category", *r6("isolation"))


@query(
    "isolation_share_by_class",
    build(
        "SELECT category, n AS class_rows, n - 1 - CAST(floor((n - 1) * (1 - 0.05::DOUBLE)) AS BIGINT) AS most, true AS within FROM (SELECT category, count(*) AS n FROM train GROUP BY category) WHERE n >= 30",
        "train",
    ),
)
def isolation_share_by_class(spark, sf):
    """Per class, how many rows lie above its interpolated quantile at most, and whether no more, and some, are isolated."""
    rows = embedding(spark, sf)
    gone = anomaly.isolation_forest_by_class(rows, 0.05).groupBy("category").agg(F.count("*").alias("gone"))
    n = F.col("class_rows")
    sizes = rows.groupBy("category").agg(F.count("*").alias("class_rows")).where(n >= 30)
    most = n - 1 - F.floor((n - 1) * (F.lit(1.0) - F.lit(0.05))).cast("long")
    return sizes.join(gone, "category", "left").select("category", "class_rows", most.alias("most"), F.coalesce(F.col("gone").between(1, most), F.lit(False)).alias("within"))


@query("autoencoder_recon_error")
def autoencoder_recon_error(spark, sf):
    rows = embedding(spark, sf)
    linear = anomaly.linear_recon_error(rows, rank=24)[0].withColumnRenamed("recon_error", "linear_error")
    deep = anomaly.autoencoder_recon_error(rows)[0]
    return join_rows(deep, linear, "row_id").select("row_id", *r6("recon_error", "linear_error"))


@query("compare_noise_methods")
def compare_noise_methods(spark, sf):
    return compare.compare_noise_methods(*train_valid(spark, sf), training_noise(spark, sf), CountingScorer())


@query("compare_delta_ae_focal")
def compare_delta_ae_focal(spark, sf):
    return compare.compare_delta_ae_focal(*train_valid(spark, sf), training_noise(spark, sf), CountingScorer())


@query("second_stage")
def second_stage(spark, sf):
    return compare.second_stage(*train_valid(spark, sf), training_noise(spark, sf), CountingScorer())


@query("run_suspicious_filter_logreg")
def run_suspicious_filter_logreg(spark, sf):
    return wf.run_suspicious_filter(*train_valid(spark, sf), md.LogisticLearner())[0]


def tree_trace(spark, sf):
    """Trace of the whole tree search: up to 1000 rounds, ended 50 rounds after the best held-out score."""
    return base._once(spark, sf, "tree-trace", lambda: compare.tune_trees(train_valid(spark, sf)[0], md.TreeLearner(), md.TREE_GRID))


@query("tune_trees")
def tune_trees(spark, sf):
    """The search over three rates and three depths on five folds of the whole training split."""
    return tree_trace(spark, sf)


def tree_cells(spark, sf):
    """The four cells over all seeds, with the best setting and number of rounds of the search."""

    def build():
        best = metrics.final_rounds(tree_trace(spark, sf)).first()
        learner = md.TreeLearner(rate=best["learning_rate"], depth=best["depth"], rounds=best["iterations"], patience=None)
        return compare.ablation_2x2(*train_valid(spark, sf), learner)[0]

    return base._once(spark, sf, "tree-cells", build)


@query("ablation_2x2")
def ablation_2x2(spark, sf):
    return tree_cells(spark, sf).select("run_name", *[F.col(f"{m}.mean").alias(m) for m in ("accuracy", "weighted_f1", "macro_f1")])


@query("compare_models")
def compare_models(spark, sf):
    table = compare.compare_models(*train_valid(spark, sf), tree_cells=tree_cells(spark, sf))
    return table.select("model", "cell", "accuracy", "weighted_f1", "macro_f1", "seeds_run")
