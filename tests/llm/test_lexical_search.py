"""Ranked search against a plain loop over documents, the reads it saves, and edge cases."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(FOLD) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, n_words = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in held:
            m = 50 + (50 * c.total() * n_docs) // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        found.sort()
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(found[:k])]
    return out


def rows_of(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.fixture
def corpus():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)] + ["Été", "ÜBER", "naïve", "日本語"]
    share = 1 / np.arange(1, len(words) + 1)
    pick = lambda n: " ".join(rng.choice(words, n, p=share / share.sum()))
    docs = [(i, pick(int(rng.integers(0, 60)))) for i in range(600)]
    docs += [(1000 + i, docs[3][1] + " rare1 rare2") for i in range(120)]
    docs += [(None, "rare1 rare2"), (7, None), (8, ""), (9, "... \n\t--"), (10, "Rare1,RARE2;rare3"), (11, "w1 " * 50_000 + "rare3"), (1000, "rare1 rare2 again")]
    items = [(i, pick(12)) for i in range(30)] + [(100, "rare1 rare2"), (101, None), (102, "--"), (103, "RARE3 rare3 unknown"), (104, " ".join(words)), (None, "w5")]
    return docs, items


@pytest.mark.parametrize("k,segment", [(5, (1 << 20, 1 << 16)), (50, (700, 40)), (3, (50, 1000))])
def test_search_matches_a_plain_loop(spark, corpus, monkeypatch, k, segment):
    monkeypatch.setattr(ls, "BLOCK_ITEMS", 11)
    docs, items = corpus
    d = spark.createDataFrame([(x, t, "a", 1) for x, t in docs], "doc_id long, text string, item_id string, score int").repartition(3)
    i = spark.createDataFrame([(x, t, "b") for x, t in items], "item_id long, text string, doc_id string").repartition(2)
    blocks = list(ls.query_blocks(i, "item_id", "text"))
    assert len(blocks) > 2 and sum(len(b.ids) for b in blocks) == len(items)
    assert rows_of(ls.search(d, i, k)) == brute(docs, items, k)


def test_segments_hold_whole_rows_of_bounded_size(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ls, "SEGMENT_POSTINGS", 10)
    monkeypatch.setattr(ls, "SEGMENT_DOCS", 6)
    lists = [[0] * n for n in (3, 4, 0, 30, 5, 5, 1, 0, 0, 0, 0, 0, 0, 0, 0, 2, 9)]
    rows = pa.RecordBatch.from_pydict({"doc": list(range(len(lists))), "n": [1] * len(lists), "terms": lists, "tfs": lists})
    parts = [p["doc"].to_pylist() for p in ls._segments(iter([rows, rows.slice(0, 0), rows]))]
    assert [d for p in parts for d in p] == 2 * list(range(len(lists)))
    for p in parts:
        assert len(p) <= 6 and (len(p) == 1 or sum(len(lists[d]) for d in p) <= 10)


def random_segment(rng, n, n_terms):
    counts = rng.integers(0, n_terms, n)
    held = [np.sort(rng.choice(n_terms, c, replace=False)) for c in counts]
    flat = np.concatenate(held)
    weights = rng.integers(0, 8000, n_terms)
    return ls.Segment(counts * 3, counts, flat, rng.integers(1, 30, len(flat)), weights, n, int(counts.sum()) * 3)


@pytest.mark.parametrize("bar", [0, 1, 10**9, 10**12])
def test_segment_scores_are_final(bar):
    rng = np.random.default_rng(6)
    segment = random_segment(rng, 3000, 90)
    for size in (1, 3, 70):
        query = np.sort(rng.choice(90, size, replace=False))
        whole = np.zeros(3000, np.int64)
        for t in query:
            a, b = segment.begins[t], segment.begins[t + 1]
            whole[segment.docs[a:b]] += segment.impact[a:b]
        floor = max(bar, 1, int(np.sort(whole)[-10]))
        docs, scores = segment.best(query, 10, bar)
        assert set(docs) == set(np.flatnonzero(whole >= floor)) and (whole[docs] == scores).all()


def test_reading_stops_early():
    """A high-weight term decides: the long list of the other one is left after a few blocks."""
    n = 60_000
    terms = np.concatenate([[0, 1] if i < 60 else [1] for i in range(n)])
    counts = np.where(np.arange(n) < 60, 2, 1)
    tfs = np.ones(len(terms), np.int64)
    tfs[np.cumsum(counts)[:60] - 1] = 20
    segment = ls.Segment(np.full(n, 10), counts, terms, tfs, np.array([9000, 5]), n, 10 * n)
    docs, _ = segment.best(np.array([0, 1]), 50, 0)
    assert len(docs) == 60 and segment.read < n / 20


def test_nothing_to_find(spark, corpus):
    docs, items = corpus
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    for found in (ls.search(d.limit(0), i), ls.search(d, i.limit(0)), ls.search(d.where("NOT text RLIKE '[a-zA-Z]'"), i), ls.search(d, i.where("item_id = 101"))):
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


def test_ids_of_other_types(spark):
    d = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z")], "doc_id string, text string")
    i = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in ls.search(d, i).orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b")]
