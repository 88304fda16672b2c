"""Ranked lexical search: the best documents of every query, read off impact-sorted lists without random access.

All documents are scanned once per block of queries, for counts over the whole corpus and for a narrow
table of the block's terms in each document. Scoring then works on segments, bounded runs of that table:
a segment sorts each term's postings by impact, and a query reads its lists in step, a block at a time.
A document's score lies between the sum of the impacts read for it and that sum plus the next impact of
every list it has not been seen in. A query stops reading once no unread document can reach its k-th best
lower end, and every document that may belong to the best has met all of its open lists, so that
membership, ties and scores are final. Impacts hold statistics of the whole corpus, so the best of all are
among the best of the segments; a task carries its best from segment to segment, where they are the bar.

What a worker holds is one segment and k rows per query of the block; what comes to the driver is a block
of queries and the document counts of its terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.session import lean
from tallyloom.llm.textbytes import Slice, slices
from tallyloom.runtime import discard, literal_table, materialise

K = 50
#: A block of queries ends at so many queries or bytes of their texts (or with one longer query).
BLOCK_ITEMS, BLOCK_BYTES = 1000, 4 << 20
#: A segment ends at so many postings or documents (or with one longer document).
SEGMENT_POSTINGS, SEGMENT_DOCS = 1 << 20, 1 << 16
#: Postings read from each list in the first round; every round reads twice as many.
FIRST_READ = 128

IS_TERM = np.arange(256) >= 0x80
for _first, _last in (b"09", b"AZ", b"az"):
    IS_TERM[_first : _last + 1] = True


def _terms(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths in bytes, hashes with A-Z lower-cased) of the terms."""
    starts, ends = part.runs(IS_TERM[part.data])
    return starts, ends - starts, part.rolling(fold=True).spans(starts, ends)


@dataclass(frozen=True)
class Block:
    """Some queries: their ids, the distinct terms of each, and all their terms by hash and length."""

    ids: list
    terms: list[np.ndarray]
    keys: np.ndarray
    lengths: np.ndarray

    def find(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of each term in the block, -1 for others (terms are told apart by 64 bits and length)."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where((self.keys[at] == hashes) & (self.lengths[at] == lengths), at, -1)


def _block(ids: list, texts: list) -> Block:
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for part in slices(pa.array(texts, pa.string())):
        starts, lengths, hashes = _terms(part)
        cuts = np.searchsorted(starts, part.begins)
        found += [(hashes[a:b], lengths[a:b]) for a, b in zip(cuts, cuts[1:])]
    keys, first = np.unique(np.concatenate([h for h, _ in found]), return_index=True)
    lengths = np.concatenate([n for _, n in found])[first]
    return Block(ids, [np.unique(np.searchsorted(keys, h)) for h, _ in found], keys, lengths)


def query_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Block]:
    """The queries in bounded blocks, one partition of ``items`` on the driver at a time."""
    ids, texts, size = [], [], 0
    for row in items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).toLocalIterator():
        ids.append(row["i"])
        texts.append(row["t"])
        size += len(row["t"] or "")
        if len(ids) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield _block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield _block(ids, texts)


def _forward(docs: DataFrame, doc_id: str, text: str, block: Block) -> DataFrame:
    """One row per document: doc, n (terms with repeats), and which of the block's terms it holds how often."""
    narrow = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    n_terms = max(len(block.keys), 1)

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                starts, lengths, hashes = _terms(part)
                number = block.find(hashes, lengths)
                known = number >= 0
                keys, tfs = np.unique(part.owner(starts[known]) * n_terms + number[known], return_counts=True)
                offsets = np.searchsorted(keys, np.arange(part.rows + 1) * n_terms).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.astype(np.int32))) for v in (keys % n_terms, tfs)]
                doc = batch.column(0).slice(part.first_row, part.rows)
                yield pa.RecordBatch.from_arrays([doc, pa.array(part.per_row(starts).astype(np.int64)), *lists], ["doc", "n", "terms", "tfs"])

    return narrow.mapInArrow(count, f"doc {narrow.schema['doc'].dataType.simpleString()}, n long, terms array<int>, tfs array<int>")


def _statistics(forward: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, terms of all documents, documents per term of the block)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = words = 0
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            n = batch.column(0).to_numpy()
            docs, words = docs + int((n > 0).sum()), words + int(n.sum())
            df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array([-2, -1, *held.tolist()], pa.int32()), "x": pa.array([docs, words, *df[held].tolist()], pa.int64())})

    rows = forward.select("n", "terms").mapInArrow(count, "term int, x long").groupBy("term").agg(F.sum("x").alias("x")).collect()
    sums = {r["term"]: r["x"] for r in rows}  # at most one row per term of the block, and two
    return sums.get(-2, 0), sums.get(-1, 0), np.array([sums.get(t, 0) for t in range(n_terms)], np.int64)


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Segment:
    """Impact-sorted lists of some documents: per term, documents by falling impact."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, n_docs: int, n_words: int):
        size = 50 + (50 * lengths * n_docs) // max(n_words, 1)
        owner = np.repeat(np.arange(len(lengths)), counts)
        tfs = tfs.astype(np.int64)
        impact = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * size[owner]))
        order = np.lexsort((-impact, terms))
        self.n = len(lengths)
        self.docs, self.impact = owner[order], impact[order]
        self.begins = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.read = 0

    def best(self, terms: np.ndarray, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, final scores) of all that score at least the k-th best, the ``bar`` and 1.

        ``bar`` is the k-th best score elsewhere, or 0. No list is looked into out of its order.
        """
        lists = [(self.docs[a:b], self.impact[a:b]) for a, b in ((self.begins[t], self.begins[t + 1]) for t in terms) if a < b and self.impact[a] > 0]
        lower = np.zeros(self.n, np.int64)
        seen = np.zeros((-(-len(lists) // 64), self.n), np.uint64)
        bar, at, step = max(bar, 1), 0, FIRST_READ
        while True:
            for i, (docs, impact) in enumerate(lists):
                docs = docs[at : at + step]
                if len(docs):
                    lower[docs] += impact[at : at + step]
                    seen[i // 64, docs] |= np.uint64(1 << (i % 64))
                    self.read += len(docs)
            at, step = at + step, 2 * step
            ahead = [(i, int(impact[at])) for i, (_, impact) in enumerate(lists) if len(impact) > at]
            unread = sum(x for _, x in ahead)
            touched = np.flatnonzero(lower)
            if len(touched) >= k:
                bar = max(bar, int(np.partition(lower[touched], len(touched) - k)[len(touched) - k]))
            if unread >= bar:
                continue
            able = touched[lower[touched] + unread >= bar]
            rest = np.zeros(len(able), np.int64)
            for i, x in ahead:
                rest += np.where(seen[i // 64, able] >> np.uint64(i % 64) & np.uint64(1), 0, x)
            within = lower[able] + rest >= bar
            if not rest[within].any():
                return able[within], lower[able[within]]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of whole rows, each of bounded size."""
    held, docs, postings = [], 0, 0
    for batch in batches:
        ends = batch.column(2).offsets.to_numpy().astype(np.int64)
        at = 0
        while at < batch.num_rows:
            room = np.searchsorted(ends, ends[at] + SEGMENT_POSTINGS - postings, side="right") - 1
            stop = min(max(room, at + (not held)), at + SEGMENT_DOCS - docs, batch.num_rows)
            if stop > at:
                held.append(batch.slice(at, stop - at))
                docs, postings, at = docs + stop - at, postings + int(ends[stop] - ends[at]), stop
            if at < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, docs, postings = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks])


def _ranked(forward: DataFrame, block: Block, k: int) -> DataFrame:
    """The k best of every query among a task's documents: item (place in the block), score, doc."""
    n_docs, n_words, df = _statistics(forward, len(block.keys))
    weights = term_weights(n_docs, df)
    queries = [t[weights[t] > 0] for t in block.terms]

    @lean
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, pa.Table] = {}
        for rows in _segments(batches):
            counts = pc.list_value_length(rows["terms"]).to_numpy().astype(np.int64)
            segment = Segment(rows["n"].to_numpy(), counts, _flat(rows["terms"]), _flat(rows["tfs"]), weights, n_docs, n_words)
            place = np.empty(segment.n, np.int64)
            place[pc.sort_indices(rows["doc"], null_placement="at_end").to_numpy()] = np.arange(segment.n)
            for item, terms in enumerate(queries):
                before = best.get(item)
                bar = before["score"][k - 1].as_py() if before is not None and before.num_rows == k else 0
                docs, scores = segment.best(terms, k, bar)
                if len(docs):
                    first = np.lexsort((place[docs], -scores))[:k]
                    found = pa.table({"score": pa.array(scores[first]), "doc": rows["doc"].take(pa.array(docs[first]))})
                    if before is not None:
                        found = pa.concat_tables([before, found])
                        order = pc.sort_indices(found, sort_keys=[("score", "descending"), ("doc", "ascending")], null_placement="at_end")
                        found = found.take(order[:k])
                    best[item] = found.combine_chunks()
        for item, found in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(found.num_rows, item, np.int32)), *[found[c].combine_chunks() for c in ("score", "doc")]], ["item", "score", "doc"]
            )

    return forward.mapInArrow(search, f"item int, score long, doc {forward.schema['doc'].dataType.simpleString()}")


def _search_block(docs: DataFrame, doc_id: str, text: str, block: Block, k: int, id_type: str) -> DataFrame:
    spark = docs.sparkSession
    forward = materialise(_forward(docs, doc_id, text, block), "terms")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    ranked = _ranked(forward, block, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = literal_table(spark, [{"item": i, "item_id": x} for i, x in enumerate(block.ids)], f"item int, item_id {id_type}")
    found = materialise(ranked.join(names, "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score"), "found")
    discard(forward)
    return found


def search(
    docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0, equal scores by doc_id.

    Terms are maximal runs of letters and digits of ASCII and of all characters beyond it, A-Z lower-cased.
    Repeated rows are documents, or items, of their own; a null id is an id, the last among equal scores. A
    null or empty text has no terms: such a document is never found and does not count as one, such an item
    finds nothing. Very long texts are taken whole. Other columns are ignored. Ids are of any type that can
    be ordered. Without documents or items the result is empty.
    """
    id_type = items.schema[item_id].dataType.simpleString()
    found = [_search_block(docs, doc_id, text, block, k, id_type) for block in query_blocks(items, item_id, item_text)]
    if found:
        return reduce(DataFrame.unionByName, found)
    nothing = items.limit(0).select(F.col(item_id).alias("item_id"), F.lit(0).alias("rank"))
    return nothing.crossJoin(docs.limit(0).select(F.col(doc_id).alias("doc_id"), F.lit(0).cast("long").alias("score")))
