"""All shares are cut from the scores of one forest."""

import numpy as np

from tallyloom.operators import anomaly


def test_all_shares_are_cut_from_one_forest(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, "ab"[i % 2], rng.normal(size=5).tolist()) for i in range(800)]
    df = spark.createDataFrame(rows, "row_id long, category string, embedding array<double>")
    alone = [{tuple(r) for r in anomaly.isolation_forest_by_class(df, c, trees=20).collect()} for c in (0.03, 0.1)]
    written, write = [], anomaly.materialise
    monkeypatch.setattr(anomaly, "materialise", lambda d, tag: written.append(tag) or write(d, tag))
    both = [{tuple(r) for r in part.collect()} for part in anomaly.isolation_forests_by_class(df, (0.03, 0.1), trees=20)]
    assert both == alone and len(both[0]) < len(both[1]) and written == ["isolation"]


def test_paths_of_a_tree_end_in_its_leaves():
    x = np.random.default_rng(2).normal(size=(200, 3))
    nodes: list = []
    anomaly._grow(x[:64], 0, 6, np.random.default_rng(3), nodes)
    found = anomaly._walk(tuple(np.array(v) for v in zip(*nodes)), x, 6)
    for row, length in zip(x, found):
        at = 0
        while nodes[at][0] >= 0:
            at = nodes[at][2] if row[nodes[at][0]] <= nodes[at][1] else nodes[at][3]
        assert length == nodes[at][4]
