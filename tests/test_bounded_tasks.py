"""What one task, or the driver, holds or reads does not grow with the table."""

import numpy as np
import pyarrow as pa

from tallyloom.operators import features as ft, linear, removal, split


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_of_rows_are_not_sent_through_the_driver(spark):
    rows = spark.createDataFrame([(i, "a") for i in range(500)], "row_id long, category string")
    for df in (split.folds_by_seed(rows, [1, 2]), removal.remove_rows(rows, rows.where("row_id < 9"))):
        assert "SortMergeJoin [row_id" in plan(df) and "BroadcastHashJoin [row_id" not in plan(df)
    assert removal.remove_rows(rows, rows.where("row_id < 9")).count() == 491


def test_sums_of_many_tasks_are_added_up_in_levels(spark, monkeypatch):
    monkeypatch.setattr(linear, "DIRECT_BYTES", 0)
    tasks, length = 70, linear.CHUNK + 5
    read = spark.sparkContext.accumulator(0)

    def give(batches):
        for batch in batches:
            yield linear.chunked(np.full(length, float(batch.column(0)[0].as_py())))

    def counted(group, add):
        if group.num_rows > linear.FAN_IN:
            read.add(1)
        return add(group)

    partial = spark.range(0, tasks, 1, tasks).mapInArrow(give, linear.CHUNKED)
    kind = type(partial.groupBy("chunk"))
    plain = kind.applyInArrow
    monkeypatch.setattr(kind, "applyInArrow", lambda self, add, schema: plain(self, lambda group: counted(group, add), schema))
    assert (linear.total(partial, tasks, length) == tasks * (tasks - 1) / 2).all()
    assert read.value == 0


def test_words_are_counted_in_slices(spark, monkeypatch):
    lists = [["a"] * n for n in (3, 0, 5, 100, 1, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(lists, pa.list_(pa.string()))], ["id", "words"])
    monkeypatch.setattr(ft, "SLICE_WORDS", 8)
    sizes = [[len(x or []) for x in s.column(1).to_pylist()] for s in ft._slices(iter([batch]))]
    assert sizes == [[3, 0, 5], [100], [1, 1, 0]]
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(i, f"w{i % 3} w{i} the") for i in range(40)], "doc_id long, text string")
    found = {(r["doc_id"], r["term"]): r["weight"] for r in ft.tfidf(docs, "text", "doc_id", vocab=None, min_df=1, max_df=1.0, stop=["the"]).collect()}
    assert len(found) == 77 and spark.conf.get(key) == "8m"
