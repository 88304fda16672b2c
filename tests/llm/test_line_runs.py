"""Runs of line hashes: plans of the joins, merges, files left behind, and ids of other types."""

import re

import pytest

from tallyloom.llm import line_dedup as ld


def entries(spark, docs):
    return ld.materialise(ld.line_entries(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text"), "entries")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_are_neither_shuffled_nor_sorted(spark):
    docs = [(i, "\n".join(f"line number {j} of some text" for j in range(i % 50, i % 50 + 20))) for i in range(200)]
    with ld.LineIndex(spark, buckets=8) as index:
        index.add(entries(spark, docs[:100]))
        index.add(entries(spark, [(1000, "one more line that is new\nline number 3 of some text")]))
        index.levels = [[n for level in index.levels for n in level]]
        fresh = ld.materialise(entries(spark, docs[100:]).groupBy(*ld.HASH).agg(ld.F.min("doc_id").alias("owner")), "fresh").repartition(8, *ld.HASH).sortWithinPartitions(*ld.HASH)
        run = index.run(index.levels[0][0])
        for how in ("inner", "left_anti"):
            text = plan(fresh.join(run.hint("merge"), ld.HASH, how))
            below = text[text.index("SortMergeJoin") :]
            assert "Bucketed: true" in below and below.count("Exchange") == 1 and below.count("Sort ") == 1, below
        name = index._write(run.withColumn("h1", -ld.F.col("h1") - 1).repartition(8, *ld.HASH))
        merge = plan(index.merged(index.levels[0][0], name))
        assert "SortMergeJoin" in merge and "Exchange" not in merge and not re.search(r"\bSort \[", merge)
    assert index.paths == {} and not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_levels_merge_and_keep_first_owners(spark):
    docs = [(i, f"shared by all of them\nof the group {i // 3}\nown line of document {i}") for i in range(60)]
    with ld.LineIndex(spark, buckets=4, fan_in=2) as index:
        for b in range(6):
            index.add(entries(spark, docs[b * 10 : b * 10 + 10]))
        assert index.merges == 4 and [len(level) for level in index.levels] == [0, 1, 1]
        rows = [r for level in index.levels for n in level for r in index.run(n).collect()]
        files = [p for p in index.paths]
        assert len(files) == 2
    assert len(rows) == len({(r["h1"], r["h2"]) for r in rows}) == 1 + 20 + 60
    assert sum(r["owner"] == 0 for r in rows) == 3


def test_run_files_go_after_an_error(spark, tmp_path):
    with pytest.raises(ZeroDivisionError):
        with ld.LineIndex(spark, buckets=4) as index:
            index.add(entries(spark, [(1, "a line that is long enough")]))
            paths = list(index.paths.values())
            raise ZeroDivisionError
    from pathlib import Path

    assert paths and not any(Path(p.removeprefix("file:")).exists() for p in paths)


@pytest.mark.parametrize("batches", [None, 1, 7])
def test_ids_of_any_type_and_name(spark, batches):
    rows = [(f"doc{i:03}", f"the very same line\nline of group {i // 3}\nline of document {i}", "x") for i in range(40)] + [(None, "the very same line", "x")]
    kept = ld.dedup_lines(spark.createDataFrame(rows, "name string, body string, doc_id string"), doc_id="name", text="body", batches=batches)
    for r in kept.collect():
        i = int(r["name"][3:]) if r["name"] else 0
        assert r["n_dropped"] == (i > 0) + (i % 3 > 0) and r["doc_id"] == "x"
