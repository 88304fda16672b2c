"""Quality classifier: gradient-boosted trees over histograms of document statistics.

Statistics of whole texts are computed in Arrow batches; a model is fitted on the driver from a bounded
sample of labelled rows (``max_rows``, 25 numbers a row) and is one set of flat arrays, so scoring walks
all rows of a batch and all trees at once, one level per step. Both passes are scans without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.session import lean
from tallyloom.llm.textbytes import IS_SEPARATOR, IS_START, Rolling, Slice, mix, slices

MAX_TRAINING_ROWS = 40_000
STATISTICS = [
    "log_words", "log_lines", "mean_word", "mean_line_words", "upper", "digit", "symbol", "end_mark", "comma", "exclaim", "other_punctuation", "blank", "wide",
    "distinct_words", "distinct_pairs", "distinct_lines", "upper_words", "digit_words", "symbol_words", "one_char_words", "long_words", "log_longest_word",
    "bullet_lines", "short_lines", "lines_with_end",
]


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


UPPER = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGIT = _class(b"0123456789")
SYMBOL = _class(b"#*$%&|<>=~^_\\{}[]@+")
END = _class(b".?")
COMMA = _class(b",;:")
EXCLAIM = _class(b"!")
OTHER = _class(b"\"'()-/`")
BULLET = _class(b"-*|#>+")


def _distinct(row: np.ndarray, keys: np.ndarray, rows: int) -> np.ndarray:
    """Distinct keys per row."""
    joined = mix(keys + mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(joined)
    new = np.ones(len(order), bool)
    new[1:] = joined[order][1:] != joined[order][:-1]
    return np.bincount(row[order[new]], minlength=rows)


def statistics(part: Slice) -> np.ndarray:
    """One row of numbers per text; shares are 0 where there is nothing to count."""
    rows, data = part.rows, part.data
    starts, ends = part.words()
    owner = part.owner(starts)
    n_words = np.bincount(owner, minlength=rows)
    points = part.code_points()
    n_chars = points[part.begins[1:]] - points[part.begins[:-1]]
    lengths = points[ends] - points[starts]
    before = lambda table: np.concatenate([[0], np.cumsum(table[data])])
    share = lambda count, of: count / np.maximum(of, 1)
    by_row = lambda values: np.bincount(owner, weights=values, minlength=rows)

    def chars(table: np.ndarray) -> np.ndarray:
        return share(part.per_row(np.flatnonzero(table[data])), n_chars)

    upper, digit, symbol = before(UPPER), before(DIGIT), before(SYMBOL)
    ups = upper[ends] - upper[starts]
    hashes = part.rolling(fold=True).spans(starts, ends)
    pairs = np.flatnonzero(owner[1:] == owner[:-1])
    pair_keys = Rolling(hashes).spans(pairs, pairs + 2) if len(pairs) else np.zeros(0, np.uint64)
    longest = np.zeros(rows)
    np.maximum.at(longest, owner, lengths)

    line_from, line_to = part.lines()
    line_owner = part.line_owner(line_from)
    first = np.searchsorted(starts, line_from)
    after = np.searchsorted(starts, line_to)
    filled = after > first
    line_from, line_to, line_owner, first, after = (x[filled] for x in (line_from, line_to, line_owner, first, after))
    n_lines = np.bincount(line_owner, minlength=rows)
    lines = lambda mask: share(np.bincount(line_owner, weights=mask, minlength=rows), n_lines)
    line_keys = part.rolling(fold=True).spans(line_from, line_to)
    columns = {
        "log_words": np.log1p(n_words),
        "log_lines": np.log1p(n_lines),
        "mean_word": share(by_row(lengths), n_words),
        "mean_line_words": share(n_words, n_lines),
        "upper": chars(UPPER),
        "digit": chars(DIGIT),
        "symbol": chars(SYMBOL),
        "end_mark": share(part.per_row(np.flatnonzero(END[data])), n_words),
        "comma": share(part.per_row(np.flatnonzero(COMMA[data])), n_words),
        "exclaim": share(part.per_row(np.flatnonzero(EXCLAIM[data])), n_words),
        "other_punctuation": share(part.per_row(np.flatnonzero(OTHER[data])), n_words),
        "blank": chars(IS_SEPARATOR),
        "wide": share(part.per_row(np.flatnonzero(IS_START[data] & (data >= 0x80))), n_chars),
        "distinct_words": share(_distinct(owner, hashes, rows), n_words),
        "distinct_pairs": share(_distinct(owner[pairs], pair_keys, rows), n_words - 1),
        "distinct_lines": share(_distinct(line_owner, line_keys, rows), n_lines),
        "upper_words": share(by_row((ups > 1) & (2 * ups > lengths)), n_words),
        "digit_words": share(by_row(digit[ends] > digit[starts]), n_words),
        "symbol_words": share(by_row(symbol[ends] > symbol[starts]), n_words),
        "one_char_words": share(by_row(lengths == 1), n_words),
        "long_words": share(by_row(lengths > 14), n_words),
        "log_longest_word": np.log1p(longest),
        "bullet_lines": lines(BULLET[data[starts[first]]] if len(first) else np.zeros(0)),
        "short_lines": lines(after - first < 4),
        "lines_with_end": lines((END | EXCLAIM)[data[ends[after - 1] - 1]] if len(first) else np.zeros(0)),
    }
    return np.stack([np.asarray(columns[s], np.float32) for s in STATISTICS], axis=1)


@dataclass(frozen=True)
class BoostedTrees:
    """All trees in flat arrays: a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for lo in range(0, len(x), 2048):
            some = x[lo : lo + 2048]
            at = np.broadcast_to(self.roots, (len(some), len(self.roots))).copy()
            row = np.arange(len(some))[:, None]
            for _ in range(self.depth):
                at = np.where(some[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out[lo : lo + 2048] = self.base + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-out))


@dataclass(frozen=True)
class BoostingSettings:
    trees: int = 60
    depth: int = 4
    rate: float = 0.15
    bins: int = 64
    min_rows: int = 10
    l2: float = 1.0


def fit_trees(x: np.ndarray, y: np.ndarray, settings: BoostingSettings = BoostingSettings()) -> BoostedTrees:
    """Logistic boosting; a level of a tree is grown from one histogram per node and statistic."""
    n, features = x.shape
    s = settings
    if not n or y.min() == y.max():
        rate = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
        none = np.zeros(0, np.int64)
        return BoostedTrees(none, none, np.zeros(0, np.float32), none, none, np.zeros(0), 0, float(np.log(rate / (1 - rate))))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, s.bins + 1)[1:-1], method="lower")) for f in range(features)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(features)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    raw = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        feature.append(0)
        threshold.append(np.float32(0))
        left.append(len(left))
        right.append(len(right))
        value.append(0.0)
        return len(value) - 1

    offsets = np.arange(features) * s.bins
    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = y - p, p * (1 - p)
        roots.append(root := node())
        at = np.full(n, root)
        open_nodes = [root]
        for level in range(s.depth + 1):
            grown = []
            for k in open_nodes:
                rows = np.flatnonzero(at == k)
                g, h = grad[rows].sum(), hess[rows].sum()
                value[k] = s.rate * g / (h + s.l2)
                if level == s.depth or len(rows) < 2 * s.min_rows:
                    continue
                cell = (binned[rows] + offsets).ravel()
                size = features * s.bins
                sums = [np.bincount(cell, np.repeat(w, features), size).reshape(features, s.bins).cumsum(1) for w in (grad[rows], hess[rows])]
                counts = np.bincount(cell, minlength=size).reshape(features, s.bins).cumsum(1)
                gl, hl = sums
                gain = gl**2 / (hl + s.l2) + (g - gl) ** 2 / (h - hl + s.l2) - g**2 / (h + s.l2)
                gain[(counts < s.min_rows) | (len(rows) - counts < s.min_rows)] = 0
                f, b = divmod(int(gain.argmax()), s.bins)
                if gain[f, b] <= 1e-6 or b >= len(edges[f]):
                    continue
                feature[k], threshold[k], value[k] = f, np.float32(edges[f][b]), 0.0
                left[k], right[k] = node(), node()
                at[rows] = np.where(binned[rows, f] <= b, left[k], right[k])
                grown += [left[k], right[k]]
            open_nodes = grown
        raw += np.array(value)[at]
    arrays = [np.array(a) for a in (roots, feature, threshold, left, right, value)]
    return BoostedTrees(*arrays, s.depth, base)


def _with_statistics(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in slices(batch.column(1)):
                x = statistics(part)
                flat = pa.array(x.ravel(), pa.float32())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first_row, part.rows), lists], names=["doc_id", "x"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("x", T.ArrayType(T.FloatType()))])
    return docs.select(doc_id, text).mapInArrow(lean(batches), schema)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_TRAINING_ROWS) -> BoostedTrees:
    """A model from the labelled documents that are not held out, ``max_rows`` of them at most, by hash.

    Ids with differing labels are left out. The sample's ids are broadcast: there are ``max_rows`` at most.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
    agreed = known.groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(label).alias("y"), F.max(label).alias("y2")).where("y = y2").select("doc_id", "y")
    sample = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    near = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = _with_statistics(near, "doc_id", "text").dropDuplicates(["doc_id"]).join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).toArrow()
    y = np.asarray(rows.column("y")).astype(float)
    lists = rows.column("x").combine_chunks()
    return fit_trees(np.asarray(lists.flatten()).reshape(len(y), len(STATISTICS)), y)


def score_quality(docs: DataFrame, model: BoostedTrees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row, from its whole text; a null text scores as an empty one, and null or
    repeated ids are rows like any other. Other columns are not read."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in slices(batch.column(1)):
                scores = model.score(statistics(part))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first_row, part.rows), pa.array(scores)], names=["doc_id", "score"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("score", T.DoubleType())])
    return docs.select(doc_id, text).mapInArrow(lean(batches), schema).withColumnRenamed("doc_id", doc_id)
