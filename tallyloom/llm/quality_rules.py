"""Quality rules: repeated substrings of a text, found with a suffix array over its words.

``min_repeat`` is the shortest repeat that counts. Texts in which no run of so many words occurs twice
have none; for the others the array is built: suffixes are ranked by their first word, ranks are doubled
until no two suffixes share one, and common prefixes of neighbours are read off the ranks of each
level. Neighbours with a common prefix span a maximal repeat; the spans of all of them are united. Many
texts are sorted together, the text being part of the rank, and a text is never cut, so a task holds
one slice of texts (or one long text) at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.session import lean
from tallyloom.llm.textbytes import BASES, IS_SEPARATOR, Rolling, Slice, mix, slices

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
WINDOW = 3
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat"]


@dataclass(frozen=True)
class RepetitionRules:
    """Limits: words at least, share of repeated 3-word windows, then share of the words that repeats
    of ``min_repeat`` or more words cover, and the longest repeat in words."""

    min_words: int = 50
    repeat_words_percent: int = 50
    min_repeat: int = 10
    covered_percent: int = 30
    longest_repeat: int = 100


def _grams(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where ``n`` words begin within one text, and a hash of (text, words) for each."""
    last = len(hashes) - n + 1
    if last <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(owner[:last] == owner[n - 1 :])
    text = mix(owner[at].astype(np.uint64) + np.uint64(1)) * np.uint64(BASES[1])
    return at, mix(Rolling(hashes).spans(at, at + n) + text)


def _classes(keys: np.ndarray, more: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and the dense rank of each."""
    order = np.argsort(keys) if more is None else np.lexsort((more, keys))
    new = np.ones(len(order), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    if more is not None:
        new[1:] |= more[order][1:] != more[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return order, rank


def _shared(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[place] == keys


def _cover(n: int, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Words inside any of the spans."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + length, -1)
    return np.cumsum(steps[:-1]) > 0


def suffix_repeats(hashes: np.ndarray, owner: np.ndarray, min_repeat: int) -> tuple[np.ndarray, np.ndarray]:
    """Word places with a repeat of ``min_repeat`` words or more, and the longest one that begins there."""
    at, grams = _grams(hashes, owner, min_repeat)
    texts = np.zeros(int(owner[-1]) + 1 if len(owner) else 0, bool)
    texts[owner[at[_shared(grams)]]] = True
    places = np.flatnonzero(texts[owner])
    n = len(places)
    if not n:
        return places, places
    words, text = hashes[places], owner[places]

    order = np.lexsort((words, text))
    new = np.ones(n, bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (text[order][1:] != text[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(new) - 1
    levels, length = [rank], 1
    while rank.max() + 1 < n:
        following = np.full(n, -1)  # the end of a text comes before any word
        inside = np.flatnonzero(text[:-length] == text[length:])
        following[inside] = rank[inside + length]
        order, rank = _classes(rank, following)
        levels.append(rank)
        length *= 2

    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for level in reversed(range(len(levels))):  # suffixes of one text never end together, so equal ranks are whole words
        inside = np.flatnonzero(np.maximum(left, right) < n)
        same = inside[(levels[level][left[inside]] == levels[level][right[inside]])]
        common[same] += 1 << level
        left[same] += 1 << level
        right[same] += 1 << level
    common[common < min_repeat] = 0
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, order[:-1], common)
    np.maximum.at(longest, order[1:], common)
    return places, longest


def _dup_lines(part: Slice) -> np.ndarray:
    starts, ends = part.lines()
    owner = part.line_owner(starts)
    inside = np.zeros(len(part.data) + 1, np.int64)
    np.cumsum(~IS_SEPARATOR[part.data], out=inside[1:])
    worded = inside[ends] > inside[starts]
    starts, ends, owner = starts[worded], ends[worded], owner[worded]
    key = mix(part.rolling(fold=False).spans(starts, ends) + mix(owner.astype(np.uint64) + np.uint64(1)) * np.uint64(BASES[1]))
    distinct = np.zeros(part.rows, np.int64)
    order, rank = _classes(key)
    firsts = np.ones(len(order), bool)
    firsts[1:] = rank[order][1:] != rank[order][:-1]
    np.add.at(distinct, owner[order][firsts], 1)
    return np.bincount(owner, minlength=part.rows) - distinct


def measure(part: Slice, min_repeat: int) -> dict[str, np.ndarray]:
    """The measures of each text of a slice."""
    starts, ends = part.words()
    owner = part.owner(starts)
    points = part.code_points()
    hashes = part.rolling(fold=False).spans(starts, ends)
    total = lambda values, where=slice(None): np.bincount(owner[where], weights=values, minlength=part.rows).astype(np.int64)
    at, grams = _grams(hashes, owner, WINDOW)
    repeated = _cover(len(starts), at[_shared(grams)], WINDOW)
    places, longest = suffix_repeats(hashes, owner, min_repeat)
    covered = _cover(len(starts), places[longest > 0], longest[longest > 0])
    most = np.zeros(part.rows, np.int64)
    np.maximum.at(most, owner[places], longest)
    return {
        "n_words": np.bincount(owner, minlength=part.rows),
        "word_chars": total(points[ends] - points[starts]),
        "n_symbols": part.per_row(np.flatnonzero(np.isin(part.data, np.frombuffer(SYMBOLS, np.uint8)))),
        "n_dup_lines": _dup_lines(part),
        "n_repeat_words": total(repeated),
        "n_covered_words": total(covered),
        "longest_repeat": most,
    }


def judge_quality(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), text: str = "text", result: str = "quality") -> DataFrame:
    """``docs`` with a struct ``result``: the measures, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails. Every row is judged alone, so null ids, repeated
    rows and ties need no rule; other columns pass through, and one already named like ``result`` is
    replaced. An empty table gives an empty one. One scan, no shuffle.
    """
    docs = docs.drop(result)
    least = rules.min_repeat

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [measure(part, least) for part in slices(batch.column(text))]
            columns = [pa.array(np.concatenate([f[m] for f in found]) if found else [], pa.int64()) for m in MEASURES]
            struct = pa.StructArray.from_arrays(columns, MEASURES)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*batch.schema.names, result])

    struct = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
    measured = docs.mapInArrow(lean(batches), T.StructType([*docs.schema.fields, T.StructField(result, struct)]))
    q = lambda name: F.col(f"`{result}`.`{name}`")
    failed = (q("n_words") < rules.min_words) | (100 * q("n_repeat_words") > rules.repeat_words_percent * q("n_words"))
    clean = (100 * q("n_covered_words") <= rules.covered_percent * q("n_words")) & (q("longest_repeat") <= rules.longest_repeat)
    verdict = F.struct(*[q(m).alias(m) for m in MEASURES], failed.alias("base_failed"), (~failed & clean).alias("kept"))
    return measured.withColumn(result, verdict)
