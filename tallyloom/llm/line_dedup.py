"""Line dedup against levelled sorted runs of line hashes.

A ``LineIndex`` holds which lines have been seen, as runs: tables of (hash, first owner) that are bucketed
and sorted by hash. A batch of documents is shuffled and sorted by hash once and merge-joined with each run,
which is read in order, neither shuffled nor sorted. Its unseen lines become a run of level 0. When a level
has ``fan_in`` runs, they are merged bucket by bucket into one of the next level, so a line is rewritten
once per level and a batch meets few runs. Runs share no hash.

Hashes have 128 bits. Hot lines cost nothing special: a line is reduced to one row per document, then
to one owner per batch by map-side aggregation, and the join that turns owners into drops reads two
stored tables, so Spark can split a hot line over tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.session import lean
from tallyloom.llm.textbytes import BASES, IS_SEPARATOR, Slice, mix, slices
from tallyloom.runtime import discard, materialise, scratch_path

MIN_KEY = 10
#: Lines (one per document and key) that a batch is made for, fewest batches, and runs of a level that are merged.
LINES_PER_BATCH = 50_000_000
LEAST_BATCHES = 4
FAN_IN = 2
#: Ids that are looked at to part the documents into batches.
CUT_IDS = 10_000
SCAN_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"
HASH = ["h1", "h2"]
DROPS = "_line_drops"
COUNTS = ["n_lines", "n_dropped"]


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class LineKeys:
    """Lines of a slice; the key of a line is the line stripped of white space, A-Z lower-cased."""

    def __init__(self, part: Slice, min_key: int):
        self.starts, self.ends = part.lines()
        self.owner = part.line_owner(self.starts)
        solid = np.flatnonzero(~IS_SEPARATOR[part.data])
        first = np.searchsorted(solid, self.starts)
        after = np.searchsorted(solid, self.ends)
        points = part.code_points()
        filled = np.flatnonzero(after > first)
        begin, end = solid[first[filled]], solid[after[filled] - 1] + 1
        long = points[end] - points[begin] >= min_key
        self.lines = filled[long]
        begin, end = begin[long], end[long]
        self.h1 = part.rolling(fold=True, base=BASES[0]).spans(begin, end)
        self.h2 = part.rolling(fold=True, base=BASES[1]).spans(begin, end)


def line_entries(docs: DataFrame, doc_id: str, text: str, min_key: int = MIN_KEY) -> DataFrame:
    """One row (doc_id, h1, h2) per distinct key of ``min_key`` code points or more in a row of ``docs``."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids = batch.column(0)
            for part in slices(batch.column(1)):
                keys = LineKeys(part, min_key)
                own = keys.owner[keys.lines]
                order = np.lexsort((keys.h2, keys.h1, own))
                h1, h2, own = keys.h1[order], keys.h2[order], own[order]
                new = np.ones(len(own), bool)
                new[1:] = (own[1:] != own[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                rows = ids.take(pa.array(own[new] + part.first_row))
                yield pa.RecordBatch.from_arrays([rows, pa.array(h1[new].view(np.int64)), pa.array(h2[new].view(np.int64))], names=["doc_id", *HASH])

    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(h, T.LongType()) for h in HASH]])
    return docs.where(F.col(doc_id).isNotNull()).select(doc_id, text).mapInArrow(lean(batches), schema)


class LineIndex:
    """Runs of seen lines. ``add`` takes batches in the order in which documents may claim lines; use it in ``with``."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}
        self.merges = 0

    def __enter__(self) -> LineIndex:
        self._ordering = self.spark.conf.get(SCAN_ORDER)
        self.spark.conf.set(SCAN_ORDER, "true")  # a bucket is one sorted file
        return self

    def __exit__(self, *error) -> None:
        self.spark.conf.set(SCAN_ORDER, self._ordering)
        for name in list(self.paths):
            self._drop(name)
        self.levels = []

    def run(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def _write(self, keys: DataFrame) -> str:
        """A run of rows that are dealt out to tasks by bucket: one sorted file per bucket."""
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = scratch_path(self.spark, name)
        writer = keys.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet")
        writer.option("path", self.paths[name]).saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(self.spark, self.paths.pop(name))

    def merged(self, left: str, right: str) -> DataFrame:
        """Both runs in one, by a full outer merge join of their buckets."""
        other = self.run(right).withColumnRenamed("owner", "_other").hint("merge")
        return self.run(left).join(other, HASH, "full").select(*HASH, F.coalesce("owner", "_other").alias("owner"))

    def _compact(self) -> None:
        for at, level in enumerate(self.levels):
            if len(level) < self.fan_in:
                continue
            if at + 1 == len(self.levels):
                self.levels.append([])
            while len(level) > 1:
                left, right = level.pop(0), level.pop(0)
                level.insert(0, self._write(self.merged(left, right)))
                self._drop(left)
                self._drop(right)
                self.merges += 1
            self.levels[at + 1].append(level.pop())

    def add(self, entries: DataFrame) -> DataFrame:
        """Owners (h1, h2, owner) of the batch's lines that are owned by another document already or are
        shared within the batch; lines that no run has are added, owned by their smallest document."""
        firsts = entries.groupBy(*HASH).agg(F.min("doc_id").alias("owner"), (F.min("doc_id") < F.max("doc_id")).alias("shared"))
        firsts = materialise(firsts, "line-firsts")
        fresh = firsts.repartition(self.buckets, *HASH).sortWithinPartitions(*HASH)
        seen = None
        for name in [n for level in self.levels for n in level]:
            first_owner = self.run(name).withColumnRenamed("owner", "first_owner")
            hit = fresh.join(first_owner.hint("merge"), HASH).select(*HASH, F.col("first_owner").alias("owner"))
            seen = hit if seen is None else seen.unionByName(hit)
            fresh = fresh.join(self.run(name).select(*HASH).hint("merge"), HASH, "left_anti")
        owners = fresh.where("shared").select(*HASH, "owner")
        owners = materialise(owners if seen is None else owners.unionByName(seen), "line-owners")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(fresh.select(*HASH, "owner")))
        discard(firsts)
        self._compact()
        return owners


def drop_lines(docs: DataFrame, text: str, drops: str, min_key: int) -> DataFrame:
    """Take the lines out of ``text`` whose hash is in the array ``drops``; adds the two counts."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            at_text, at_drops = batch.schema.get_field_index(text), batch.schema.get_field_index(drops)
            texts = batch.column(at_text)
            listed = batch.column(at_drops)
            sizes = np.asarray(listed.value_lengths().fill_null(0))
            held = listed.flatten()
            d1 = np.asarray(held.field("h1")).view(np.uint64)
            d2 = np.asarray(held.field("h2")).view(np.uint64)
            whose = np.repeat(np.arange(len(sizes)), sizes)
            wanted = np.unique(mix(mix(d1 + mix(whose.astype(np.uint64) + np.uint64(1))) ^ d2))
            changed: dict[int, bytes] = {}
            n_lines, n_dropped = [], []
            for part in slices(texts):
                keys = LineKeys(part, min_key)
                row = (keys.owner[keys.lines] + part.first_row).astype(np.uint64)
                key = mix(mix(keys.h1 + mix(row + np.uint64(1))) ^ keys.h2)
                gone = np.zeros(len(keys.starts), bool)
                gone[keys.lines] = np.isin(key, wanted) if len(wanted) else False
                n_lines.append(np.bincount(keys.owner, minlength=part.rows))
                n_dropped.append(np.bincount(keys.owner[gone], minlength=part.rows))
                data = part.data.tobytes() if gone.any() else b""
                first_line = np.concatenate([[0], np.cumsum(n_lines[-1])])
                for r in np.flatnonzero(n_dropped[-1]):
                    own = np.arange(first_line[r], first_line[r + 1])
                    own = own[~gone[own]]
                    changed[int(r) + part.first_row] = b"\n".join([data[a:b] for a, b in zip(keys.starts[own].tolist(), keys.ends[own].tolist())])
            if changed:
                values = texts.to_pylist()
                for r, value in changed.items():
                    values[r] = value.decode()
                texts = pa.array(values, texts.type)
            columns = [texts if i == at_text else c for i, c in enumerate(batch.columns) if i != at_drops]
            names = [n for n in batch.schema.names if n != drops]
            counts = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in (n_lines, n_dropped)]
            yield pa.RecordBatch.from_arrays([*columns, *counts], [*names, *COUNTS])

    fields = [f for f in docs.schema.fields if f.name != drops]
    return docs.mapInArrow(lean(batches), T.StructType([*fields, *[T.StructField(c, T.LongType()) for c in COUNTS]]))


def _cuts(docs: DataFrame, doc_id: str, batches: int) -> list:
    """Ids that part ``docs`` into about equal ranges, from a bounded number of ids in hash order. Any cuts are right."""
    some = docs.select(F.col(doc_id).alias("i")).where("i IS NOT NULL").orderBy(F.xxhash64("i")).limit(CUT_IDS).toArrow()
    ids = sorted(set(some.column(0).to_pylist()))
    return [ids[len(ids) * (b + 1) // batches - 1] for b in range(batches - 1)] if len(ids) >= batches else []


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_key: int = MIN_KEY, batches: int | None = None, fan_in: int = FAN_IN
) -> DataFrame:
    """``docs`` without the lines that a document of a smaller id holds, plus ``n_lines`` (before) and ``n_dropped``.

    Lines compare by their stripped, lower-cased key of ``min_key`` code points or more; the smallest id
    that holds a key keeps all its lines, every other document loses them. Documents are taken in
    ranges of ascending id, each against the runs of those before: one per ``LINES_PER_BATCH`` distinct lines
    of documents, four at least, unless ``batches`` says otherwise. A null or empty text is
    one empty line (a null text stays null). Rows of a null id keep their lines and own none. Rows that
    share an id count as one document. Ids are of any type that can be ordered. Columns named like the counts
    are replaced; others pass through.
    """
    spark = docs.sparkSession
    docs = docs.drop(*COUNTS, DROPS)
    entries = materialise(line_entries(docs, doc_id, text, min_key), "line-entries")
    n = batches or max(LEAST_BATCHES, -(-entries.count() // LINES_PER_BATCH))
    cuts = [F.lit(c) for c in _cuts(docs, doc_id, n)]
    ranges = [(a, b) for a, b in zip([None, *cuts], [*cuts, None])]
    drops = None
    with LineIndex(spark, fan_in=fan_in) as index:
        for above, upto in ranges:
            mine = entries if above is None else entries.where(F.col("doc_id") > above)
            mine = mine if upto is None else mine.where(F.col("doc_id") <= upto)
            owners = index.add(mine)
            lost = mine.join(owners, HASH).where(F.col("owner") < F.col("doc_id")).select("doc_id", *HASH)
            drops = lost if drops is None else drops.unionByName(lost)
    by_doc = drops.groupBy(F.col("doc_id").alias("_drop_id")).agg(F.collect_set(F.struct(*HASH)).alias(DROPS))
    joined = docs.join(by_doc, docs[doc_id] == by_doc["_drop_id"], "left").drop(by_doc["_drop_id"])
    return drop_lines(joined, text, DROPS, min_key)
