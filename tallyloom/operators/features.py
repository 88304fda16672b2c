"""Text, category and number features: long-form TF-IDF in SQL terms, and Spark ML stages for models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    OneHotEncoder,
    OneHotEncoderModel,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.decompose import project, right_vectors
from tallyloom.operators.impute import train_median, train_modes
from tallyloom.operators.linear import sparse
from tallyloom.operators.skew import salted_join
from tallyloom.runtime import bound_batches, materialise

WORD = r"[\p{L}\p{N}_]{2,}"


def stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def tokens(col: Column) -> Column:
    return F.regexp_extract_all(F.lower(col), F.lit(WORD), F.lit(0))


def tfidf(
    df: DataFrame,
    text: str,
    row_id: str = "row_id",
    vocab: int | None = 10_000,
    min_df: int = 2,
    max_df: float = 0.95,
    stop: list[str] | None = None,
) -> DataFrame:
    """Long table (row id, term, weight) with unit-length rows.

    Terms are counted inside the row, and the counts stored. Only document frequencies are shuffled; a bounded
    vocabulary goes to the rows, where weights and lengths are computed. An open one is joined with its frequent
    terms split. Repeated ids are texts of their own.
    """
    bound_batches(df.sparkSession)
    counts = materialise(_term_counts(df.select(row_id, tokens(F.col(text)).alias("words")), row_id, stop), "terms")
    n = df.agg(F.count("*")).scalar()
    long = counts.select(row_id, F.explode(F.arrays_zip("terms", "tfs")).alias("c")).select(row_id, F.col("c.terms").alias("term"), F.col("c.tfs").alias("tf"))
    terms = long.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("corpus_n"))
    terms = terms.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n))
    idf = (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf")
    if vocab is not None:
        kept = terms.select("term", "corpus_n", idf).orderBy(F.desc("corpus_n"), "term").limit(vocab).collect()
        return _weighed(counts, {r["term"]: r["idf"] for r in kept}, row_id)
    joined = salted_join(long, terms.select("term", idf), ["term"], row_id)
    raw = joined.select(row_id, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(row_id)))
    return raw.select(row_id, "term", (F.col("w") / norm).alias("weight"))


#: Words of the rows that a task counts or weighs at a time.
SLICE_WORDS = 1 << 17


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose lists in the second column hold at most ``SLICE_WORDS`` entries, or single rows that hold more."""
    for batch in batches:
        ends = np.cumsum(np.asarray(batch.column(1).value_lengths().fill_null(0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + SLICE_WORDS, side="right")), at + 1)
            yield batch.slice(at, to - at)
            at = to


def _term_counts(words: DataFrame, row_id: str, stop: list[str] | None) -> DataFrame:
    """(row id, terms, tfs): the distinct words of every row that has some, and how often each occurs."""
    left_out = pa.array(stop or [], pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            lists = batch.column(1)
            own = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths().fill_null(0)))
            flat = lists.flatten()
            if len(left_out):
                used = np.asarray(pc.invert(pc.is_in(flat, left_out)))
                own, flat = own[used], flat.filter(pa.array(used))
            coded = flat.dictionary_encode()
            size = max(len(coded.dictionary), 1)
            keys, tfs = np.unique(own * size + np.asarray(coded.indices), return_counts=True)
            rows, first = np.unique(keys // size, return_index=True)
            offsets = pa.array(np.append(first, len(keys)).astype(np.int32))
            terms = pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(keys % size)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), terms, pa.ListArray.from_arrays(offsets, pa.array(tfs))], [row_id, "terms", "tfs"])

    kind = words.schema[row_id].dataType.simpleString()
    return words.mapInArrow(count, f"`{row_id}` {kind}, terms array<string>, tfs array<bigint>")


def _weighed(counts: DataFrame, idf: dict[str, float], row_id: str) -> DataFrame:
    """Long rows (row id, term, weight) over the words of ``idf``, of length 1 per row."""
    words, weights = pa.array(list(idf), pa.string()), np.array(list(idf.values()), float)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            place = pc.index_in(batch.column(1).flatten(), words)
            own = np.repeat(np.arange(batch.num_rows), np.asarray(batch.column(1).value_lengths()))
            known = np.asarray(place.is_valid())
            own, place = own[known], np.asarray(place.drop_null())
            raw = np.asarray(batch.column(2).flatten())[known] * weights[place] if len(place) else np.zeros(0)
            norm = np.sqrt(np.bincount(own, raw * raw, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), words.take(pa.array(place)), pa.array(raw / norm[own])], [row_id, "term", "weight"])

    kind = counts.schema[row_id].dataType.simpleString()
    return counts.mapInArrow(weigh, f"`{row_id}` {kind}, term string, weight double")


def onehot(train: DataFrame, df: DataFrame, column: str, row_id: str = "row_id") -> DataFrame:
    """Long one-hot rows (row id, value, 1.0); a value unseen in training gives no row."""
    known = train.where(F.col(column).isNotNull()).select(column).distinct()
    return salted_join(df.select(row_id, column), known, [column], row_id).select(row_id, F.col(column).alias("value"), F.lit(1.0).alias("one"))


@dataclass(frozen=True)
class FeatureSpec:
    """Which blocks a model sees. ``text=None`` leaves out the text block.

    ``stop`` is a list of stop words, or true for Spark's English list, or false for none. With ``all_terms`` the vocabulary
    is not a choice of the most frequent terms: more than ``vocab`` of them are an error.
    """

    text: str | None = "description"
    categories: tuple[str, ...] = ("amount_bucket", "transaction_type")
    numbers: tuple[str, ...] = ()
    vocab: int = 10_000
    min_df: float = 2.0
    max_df: float = 0.95
    all_terms: bool = False
    stop: bool | tuple[str, ...] = True

    def plus(self, *numbers: str) -> FeatureSpec:
        return replace(self, numbers=(*self.numbers, *numbers))

    @property
    def inputs(self) -> list[str]:
        return ([self.text] if self.text else []) + [*self.categories, *self.numbers]


NARROW = FeatureSpec()
WIDE = FeatureSpec(categories=("amount_bucket", "transaction_type", "account_name"), numbers=("amount",))
# Feature blocks of the linear SVM modes and of the model comparison.
ONE_HOT = FeatureSpec(text=None, categories=("description", "transaction_type", "account_name"), numbers=("amount",))
ONE_HOT_NO_TEXT = FeatureSpec(text=None, categories=("transaction_type", "account_name"), numbers=("amount",))
TFIDF_ALL = FeatureSpec(categories=("transaction_type", "account_name"), numbers=("amount",), vocab=1 << 22, min_df=1.0, max_df=1.0, stop=False, all_terms=True)


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fill_and_scale(train: DataFrame, spec: FeatureSpec) -> SQLTransformer:
    """Stage that fills categories with the mode and numbers with the median, and standardises numbers."""
    parts = ["*"]
    modes = train_modes(train, list(spec.categories))
    for c in spec.categories:
        # a one-hot column needs a name, so an empty category is shown as one blank
        parts.append(f"coalesce(if(`{c}` = '', ' ', `{c}`), {_quoted(modes[c] or ' ')}) AS `{c}_in`")
    if spec.text:
        parts.append(f"coalesce(`{spec.text}`, '') AS `text_in`")
    fills = {c: train_median(train, c) for c in spec.numbers}
    if fills:
        filled = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(v)) for c, v in fills.items()}
        stats = train.agg(*[f(col).alias(f"{name}_{c}") for c, col in filled.items() for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        for c, v in fills.items():
            mean, std = stats[f"m_{c}"], stats[f"s_{c}"]
            parts.append(f"(coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {v!r}D) - {mean!r}D) / {(std if std else 1.0)!r}D AS `{c}_in`")
    return SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")


def text_stages(train: DataFrame, spec: FeatureSpec, column: str = "text_in", out: str = "text_vec", times: str | None = None) -> list:
    """Fitted tokenizer, stop words, counts, idf + 1 and unit length; a row stands for as many as its ``times``."""
    words = RegexTokenizer(inputCol=column, outputCol="words", pattern=WORD, gaps=False)
    stages, last = [words], "words"
    if spec.stop:
        stages.append(StopWordsRemover(inputCol="words", outputCol="kept", stopWords=stop_words() if spec.stop is True else list(spec.stop)))
        last = "kept"
    data = PipelineModel(stages).transform(train)
    most = spec.max_df if spec.max_df < 1 else float(1 << 62)  # to Spark, 1.0 is a count of documents, not the share of all
    if times is None:
        counter = CountVectorizer(inputCol=last, outputCol="counts", vocabSize=spec.vocab, minDF=spec.min_df, maxDF=most).fit(data)
        idf = IDF(inputCol="counts", outputCol="idf").fit(counter.transform(data)).idf.toArray() + 1.0
    else:
        vocabulary, idf = _counted_terms(data.select(F.col(last).alias("words"), F.col(times).alias("n")), spec.vocab, spec.min_df, most)
        counter = CountVectorizerModel.from_vocabulary(vocabulary, last, "counts")
    if spec.all_terms and len(counter.vocabulary) >= spec.vocab:
        raise ValueError(f"more than {spec.vocab - 1} terms")
    weigh = ElementwiseProduct(inputCol="counts", outputCol="weighted", scalingVec=Vectors.dense(idf))
    return [*stages, counter, weigh, Normalizer(inputCol="weighted", outputCol=out, p=2.0)]


def _counted_terms(rows: DataFrame, vocab: int, min_df: float, max_df: float) -> tuple[list[str], np.ndarray]:
    """(terms, their idf + 1) that CountVectorizer and IDF would find in ``rows(words, n)`` written out ``n`` times each; equal counts go by term."""
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    low, high = [share * total if share < 1 else share for share in (min_df, max_df)]
    texts = rows.groupBy("words").agg(F.sum("n").alias("n"))
    per_text = texts.select(F.explode("words").alias("term"), "n").groupBy("term").agg(F.sum("n").alias("corpus_n"))
    holding = texts.select(F.explode(F.array_distinct("words")).alias("term"), "n").groupBy("term").agg(F.sum("n").alias("df"))
    kept = per_text.join(holding.where(F.col("df").between(low, high)), "term").orderBy(F.desc("corpus_n"), "term").limit(vocab).collect()
    if not kept:
        raise ValueError("no terms are left for the text block")
    return [r["term"] for r in kept], np.log((total + 1.0) / (np.array([r["df"] for r in kept]) + 1.0)) + 1.0


def fit_features(train: DataFrame, spec: FeatureSpec, out: str = "features", grouped: DataFrame | None = None, times: str | None = None) -> PipelineModel:
    """All feature stages fitted on ``train``; values unseen there become all-zero one-hot blocks.

    ``grouped`` has one row per combination of the inputs of ``train``, with its number of rows in ``times``, if there is such a table.
    """
    stages: list = [fill_and_scale(train, spec)]
    data = stages[0].transform(train if grouped is None else grouped)
    blocks = []
    if spec.text:
        stages += text_stages(data, spec, times=times)
        blocks.append("text_vec")
    if spec.categories:
        index = StringIndexer(
            inputCols=[f"{c}_in" for c in spec.categories], outputCols=[f"{c}_ix" for c in spec.categories], handleInvalid="keep", stringOrderType="alphabetAsc"
        ).fit(data)
        hot = OneHotEncoder(inputCols=[f"{c}_ix" for c in spec.categories], outputCols=[f"{c}_hot" for c in spec.categories]).fit(index.transform(data))
        stages += [index, hot]
        blocks += [f"{c}_hot" for c in spec.categories]
    blocks += [f"{c}_in" for c in spec.numbers]
    stages.append(VectorAssembler(inputCols=blocks, outputCol=out))
    return PipelineModel(stages)


def vector_size(model: PipelineModel, out: str = "features") -> int:
    """Number of entries of the vectors that fitted feature stages give."""
    sizes = {}
    for stage in model.stages:
        if isinstance(stage, CountVectorizerModel):
            sizes["text_vec"] = len(stage.vocabulary)
        elif isinstance(stage, OneHotEncoderModel):  # the last category, of unseen values, has no entry
            sizes |= dict(zip(stage.getOutputCols(), [n - stage.getDropLast() for n in stage.categorySizes]))
    return sum(sizes.get(c, 1) for c in model.stages[-1].getInputCols())


def text_vectors(model: PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the text block of fitted features as lists of places and weights."""
    return model.transform(df).select(*keep, *sparse("text_vec"))


def text_terms(model: PipelineModel) -> list[str]:
    """Terms of the text block of fitted features, by place."""
    return next(stage.vocabulary for stage in model.stages if isinstance(stage, CountVectorizerModel))


def svd_embedding(train: DataFrame, valid: DataFrame, rank: int = 40, spec: FeatureSpec = WIDE, vocab: int = 4000) -> tuple[DataFrame, DataFrame]:
    """(train, valid) as (row_id, embedding): text TF-IDF on its leading right singular vectors (not
    centred), then one-hot and scaled number columns."""
    spec = replace(spec, vocab=vocab)
    model = fit_features(train, spec)
    others = [f"{c}_hot" for c in spec.categories] + [f"{c}_in" for c in spec.numbers]
    both = PipelineModel([model, VectorAssembler(inputCols=others, outputCol="rest_vec")])
    own, asked = [text_vectors(both, df, "row_id", vector_to_array("rest_vec").alias("rest")) for df in (train, valid)]
    own = materialise(own, "vectors")
    vectors, _ = right_vectors(own, len(text_terms(model)), rank)
    return project(own, vectors, rest="rest"), project(asked, vectors, rest="rest")


def text_basis(df: DataFrame, text: str, rank: int = 40, vocab: int = 4000) -> tuple[DataFrame, DataFrame]:
    """((term, weights of the term in each component), (component, singular value)) of the TF-IDF of a text column."""
    spec = FeatureSpec(text=text, categories=(), vocab=vocab, stop=False)
    model = fit_features(df, spec)
    vectors, values = right_vectors(materialise(text_vectors(model, df), "vectors"), len(text_terms(model)), rank)
    spark = df.sparkSession
    terms = spark.createDataFrame(pa.table({"term": text_terms(model), "weights": vectors.tolist()}), "term string, weights array<double>")
    return terms, spark.createDataFrame(pa.table({"component": list(range(len(values))), "value": values}), "component long, value double")
