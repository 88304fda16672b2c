"""N-gram Jaccard join by PartEnum signatures.

Two sets with 100 * intersection >= threshold * union differ in few elements: of a set of s elements, in
at most k = s * (100 - threshold) / threshold. Sets are kept in bands of size. Within a band the domain is
hashed into partitions, each into three parts; of the first k // 2 + 1 partitions at least one holds at
most one difference, so at least two of its three parts agree. A set emits one signature per partition
and pair of parts, and a pair of sets that link shares a signature. A set near the lower end of its band
also emits in the band below.

A signature of two empty parts would be shared by strangers. It is not emitted; a set that has one emits
the signatures of a second hashing too, and a set with an empty one there the first k + 1 elements in
hash order, which sets that link share as well. Both sets of a pair that agrees only in empty parts
take that step, so no link is lost.

Equal sets are one set. Signatures that occur once are dropped while they stream by, sorted. In each of
the others every member is first compared with one pivot. Members in different components after that
are compared in blocks of bounded size, by a parity sketch that bounds the difference from below. Of the
pairs that the sketch leaves open, each component's closest is compared exactly, which joins most; what is
still open in the third round is compared pair by pair. So no group of copies is expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.components import components
from tallyloom.llm.session import lean
from tallyloom.llm.textbytes import BASES, Rolling, Slice, mix, slices, whole
from tallyloom.runtime import materialise

N_GRAM = 4
THRESHOLD = 85
BAND = 1.5
PARTS = 3
#: The pairs of parts of a partition.
SUBSETS = ((0, 1), (0, 2), (1, 2))
HASHINGS = 2
SKETCH_BITS = 256
BLOCK = 1024
BLOOM_BITS = 1 << 23
SLICE_BYTES = 1 << 19

U = np.uint64


def shingles(part: Slice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct n-word shingles of each text, in row order. A text of fewer words has
    one shingle, all its words; one without words has none. Words are lower-cased in A-Z."""
    starts, ends = part.words()
    owner = part.owner(starts)
    hashes = part.rolling(fold=True).spans(starts, ends)
    counts = np.bincount(owner, minlength=part.rows)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    some = np.flatnonzero(counts)
    windows = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    at = np.repeat(first - np.concatenate([[0], np.cumsum(windows)])[:-1], windows) + np.arange(windows.sum())
    row = np.repeat(np.arange(part.rows), windows)
    keys = Rolling(hashes).spans(at, at + np.minimum(counts, n)[row]) if len(some) else np.zeros(0, U)
    mixed = mix(keys + mix(row.astype(U) + U(1)))
    order = np.argsort(mixed)
    new = np.ones(len(order), bool)
    new[1:] = mixed[order][1:] != mixed[order][:-1]
    kept = np.sort(order[new])
    return row[kept], keys[kept]


class Bands:
    """Size bands, and how many differences and partitions each size and band allows."""

    def __init__(self, threshold: int, largest: int):
        self.threshold = threshold
        self.smallest = -(-threshold // (100 - threshold))  # smaller sets only link if they are equal
        edges = [self.smallest]
        while edges[-1] <= largest:
            edges.append(int(np.ceil(edges[-1] * max(BAND, 100 / threshold))))
        self.edges = np.array(edges)
        self.partitions = self.differences(np.maximum(self.edges[1:] - 1, 0)) // 2 + 1

    def differences(self, size: np.ndarray) -> np.ndarray:
        """The most elements in which a set of this size and one as large or larger may differ."""
        return size * (100 - self.threshold) // self.threshold

    def emissions(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, band) of all sets that can link with a different one."""
        rows = np.flatnonzero(sizes >= self.smallest)
        band = np.searchsorted(self.edges, sizes[rows], side="right") - 1
        low = (band > 0) & (-(-sizes[rows] * self.threshold // 100) < self.edges[band])
        return np.concatenate([rows, rows[low]]), np.concatenate([band, band[low] - 1])


def signatures(row: np.ndarray, keys: np.ndarray, sizes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of all sets; ``row`` ascends."""
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    rows, band = bands.emissions(sizes)
    found_rows, found = [], []
    for hashing in range(HASHINGS):
        if not len(rows):
            break
        n = sizes[rows]
        element = np.repeat(first[rows] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
        emission = np.repeat(np.arange(len(rows)), n)
        total = bands.partitions[band]
        emitted = np.minimum(bands.differences(n) // 2 + 1, total)
        salt = mix((band * HASHINGS + hashing + 1).astype(U) * U(BASES[1]))
        u = mix(keys[element] ^ salt[emission])
        partition = ((u >> U(32)) * total[emission].astype(U) >> U(32)).astype(np.int64)
        inside = partition < emitted[emission]
        emission, partition, u = emission[inside], partition[inside], u[inside]
        part = ((u & U(0xFFFFFFFF)) * U(PARTS) >> U(32)).astype(np.int64)
        start = np.concatenate([[0], np.cumsum(emitted)])
        cells = np.zeros(start[-1] * PARTS, U)
        np.add.at(cells, (start[emission] + partition) * PARTS + part, mix(u + U(BASES[0])))
        cells = cells.reshape(-1, PARTS)
        whose = np.repeat(np.arange(len(rows)), emitted)
        place = np.arange(start[-1]) - start[whose]
        empty = np.zeros(len(rows), bool)
        for i, (p, q) in enumerate(SUBSETS):
            content = cells[:, p] + cells[:, q]
            empty[whose[content == 0]] = True
            full = content != 0
            code = mix(salt[whose[full]] + (place[full] * len(SUBSETS) + i).astype(U))
            found_rows.append(rows[whose[full]])
            found.append(mix(mix(content[full]) + code))
        rows, band = rows[empty], band[empty]
    for r, b in zip(rows.tolist(), band.tolist()):
        own = keys[first[r] : first[r] + sizes[r]]
        least = np.sort(mix(own ^ U(BASES[1])))[: int(bands.differences(sizes[r])) + 1]
        found.append(mix(least + mix(np.array([b + 1], U) * U(BASES[0]))))
        found_rows.append(np.full(len(least), r))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, U)
    return np.concatenate(found_rows), np.concatenate(found)


def parity_sketches(row: np.ndarray, keys: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """One bit per hash value, flipped by each element, so two sketches differ in no more bits than the sets
    differ in elements. A sketch has two to four bits per element; halves of one, joined by exclusive or,
    are the sketch of half the length."""
    bits = SKETCH_BITS << np.maximum(np.ceil(np.log2(np.maximum(2 * sizes / SKETCH_BITS, 1))), 0).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(bits)])
    bit = (mix(keys + U(BASES[1])) & (bits[row] - 1).astype(U)).astype(np.int64)
    flips = (np.bincount(starts[row] + bit, minlength=starts[-1]) & 1).astype(np.uint8)
    packed = np.packbits(flips).tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]


class Sketches:
    """The sketches of a column without nulls, by length."""

    def __init__(self, column: pa.Array):
        values = column.to_pylist()
        self.lengths = np.array([len(v) for v in values], np.int64)
        self.place = np.zeros(len(values), np.int64)
        self.tables: dict[int, np.ndarray] = {}
        for size in np.unique(self.lengths).tolist():
            mine = np.flatnonzero(self.lengths == size)
            self.place[mine] = np.arange(len(mine))
            self.tables[size] = np.frombuffer(b"".join([values[i] for i in mine.tolist()]), U).reshape(len(mine), size // 8)

    def at(self, which: np.ndarray, size: int) -> np.ndarray:
        """Sketches folded to ``size`` bytes."""
        out = np.empty((len(which), size // 8), U)
        for own in np.unique(self.lengths[which]).tolist():
            mine = np.flatnonzero(self.lengths[which] == own)
            found = self.tables[own][self.place[which[mine]]]
            out[mine] = np.bitwise_xor.reduce(found.reshape(len(mine), own // size, size // 8), axis=1)
        return out


def least_difference(left: Sketches, x: np.ndarray, right: Sketches, y: np.ndarray) -> np.ndarray:
    """For each pair the number of bits in which its sketches differ."""
    out = np.zeros(len(x), np.int64)
    common = np.minimum(left.lengths[x], right.lengths[y])
    for size in np.unique(common).tolist():
        mine = np.flatnonzero(common == size)
        step = max(1, (4 << 20) // size)
        for lo in range(0, len(mine), step):
            some = mine[lo : lo + step]
            out[some] = np.bitwise_count(left.at(x[some], size) ^ right.at(y[some], size)).sum(axis=1, dtype=np.int64)
    return out


def _sum_by(row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros(rows, U)
    np.add.at(out, row, values)
    return out


def _set_hash(row: np.ndarray, keys: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set."""
    return _sum_by(row, mix(keys + U(1)), rows).view(np.int64), _sum_by(row, mix(keys ^ U(BASES[0])), rows).view(np.int64)


def set_table(docs: DataFrame, n_gram: int, threshold: int) -> DataFrame:
    """(doc_id, n, h, g, sketch) of each (doc_id, text): size, hash of 128 bits and sketch of the shingle set. The
    sketch is null for sets too small to link with another, and where the task has given it for an equal set."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in source:
            for part in slices(batch.column(1), SLICE_BYTES):
                row, keys = shingles(part, n_gram)
                sizes = np.bincount(row, minlength=part.rows)
                h, g = _set_hash(row, keys, part.rows)
                new = seen.new(h, sizes >= Bands(threshold, 0).smallest)
                sketches: list[bytes | None] = [None] * part.rows
                for r, sketch in zip(np.flatnonzero(new).tolist(), parity_sketches(*_compact(row, keys, sizes, new))):
                    sketches[r] = sketch
                columns = [batch.column(0).slice(part.first_row, part.rows), pa.array(sizes), pa.array(h), pa.array(g), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=list(kinds))

    long = T.LongType()
    kinds = {"doc_id": docs.schema["doc_id"].dataType, "n": long, "h": long, "g": long, "sketch": T.BinaryType()}
    return docs.select("doc_id", "text").mapInArrow(lean(batches), T.StructType([T.StructField(c, t) for c, t in kinds.items()]))


def signature_rows(texts: DataFrame, n_gram: int, threshold: int) -> DataFrame:
    """(sig, h): the signatures of the shingle set of each text; a task gives those of equal sets once."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in source:
            for part in slices(batch.column(0), SLICE_BYTES):
                row, keys = shingles(part, n_gram)
                sizes = np.bincount(row, minlength=part.rows)
                h, _ = _set_hash(row, keys, part.rows)
                bands = Bands(threshold, int(sizes.max(initial=0)))
                new = seen.new(h, sizes >= bands.smallest)
                at, found = signatures(*_compact(row, keys, sizes, new), bands)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(h[new][at])], names=["sig", "h"])

    return texts.mapInArrow(lean(batches), "sig long, h long")


class _Seen:
    """Set hashes that a task has met."""

    def __init__(self):
        self.hashes: set[int] = set()

    def new(self, h: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Rows that are wanted and the first with their hash."""
        out = np.zeros(len(h), bool)
        for r in np.flatnonzero(wanted).tolist():
            if (key := int(h[r])) not in self.hashes:
                self.hashes.add(key)
                out[r] = True
        return out


def _compact(row: np.ndarray, keys: np.ndarray, sizes: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The elements and sizes of the kept rows, numbered from 0."""
    wanted = kept[row]
    return (np.cumsum(kept) - 1)[row[wanted]], keys[wanted], sizes[kept]


def _shared_signatures(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (sig, h) in order: those whose signature has another member, with the first member as pivot.

    A partition may begin or end inside a signature, so its first and last signature always pass."""
    held_sig = held_h = None
    pivot, linked, opening = 0, True, True
    for batch in source:
        sig, h = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        if not len(sig):
            continue
        if held_sig is not None:
            sig, h = np.concatenate([[held_sig], sig]), np.concatenate([[held_h], h])
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (h[1:] != h[:-1])
        sig, h = sig[new], h[new]
        head = np.ones(len(sig), bool)
        head[1:] = sig[1:] != sig[:-1]
        if held_sig is not None:
            head[0] = False
        heads = np.flatnonzero(head)
        pivots = np.empty(len(sig), np.int64)
        group = np.cumsum(head) - 1
        pivots[group < 0] = pivot
        pivots[group >= 0] = h[heads][group[group >= 0]]
        same = np.zeros(len(sig) + 1, bool)
        same[1:-1] = sig[1:] == sig[:-1]
        keep = same[:-1] | same[1:]
        if held_sig is None:
            opening = True
        keep[0] |= linked
        if opening:
            keep |= sig == sig[0]
            opening = sig[-1] == sig[0]
        held_sig, held_h, pivot, linked = sig[-1], h[-1], int(pivots[-1]), bool(keep[-1])
        out = np.flatnonzero(keep[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(sig[out]), pa.array(h[out]), pa.array(pivots[out])], names=["sig", "h", "pivot"])
    if held_sig is not None:
        yield pa.RecordBatch.from_arrays([pa.array([int(held_sig)]), pa.array([int(held_h)]), pa.array([pivot])], names=["sig", "h", "pivot"])


def _may_link(n1: np.ndarray, n2: np.ndarray, least: np.ndarray, threshold: int) -> np.ndarray:
    """Whether 100 * both >= threshold * either is open if the sets differ in ``least`` elements or more."""
    return (100 - threshold) * (n1 + n2) >= (100 + threshold) * np.maximum(least, np.abs(n1 - n2))


def sketch_filter(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of set hashes that may link."""
    left = sets.select(F.col("h").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sets.select(F.col("h").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    sized = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * threshold)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            a, b, na, nb, sa, sb = batch.columns
            row = np.arange(batch.num_rows)
            keep = _may_link(np.asarray(na), np.asarray(nb), least_difference(Sketches(sa), row, Sketches(sb), row), threshold)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep))

    return sized.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(lean(batches), "a long, b long")


def _bloom(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over an id column; only this bitmap comes to the driver."""
    place = [F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(BLOOM_BITS)) for i in range(2)]
    bits = ids.select(F.explode(F.array(*place)).alias("at"))
    words = bits.groupBy(F.shiftright("at", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 31 as int))")).alias("mask"))
    found = words.toArrow()
    table = np.zeros(BLOOM_BITS // 32, np.uint32)
    table[np.asarray(found.column("word")).astype(np.int64)] = np.asarray(found.column("mask")).astype(np.uint32)
    return table


def texts_of(docs: DataFrame, wanted: DataFrame, n_gram: int) -> DataFrame:
    """(h, rep, text) for ``wanted(h, rep)``: the text of the document ``rep`` whose set has the hash h.

    A Bloom filter keeps most other texts out of the shuffle; the join decides."""
    bitmap = docs.sparkSession.sparkContext.broadcast(_bloom(wanted.select(F.col("rep").alias("doc_id"))))

    @F.arrow_udf(T.BooleanType())
    def maybe(x: pa.Array, y: pa.Array) -> pa.Array:
        hit = [(bitmap.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 for at in (np.asarray(x), np.asarray(y))]
        return pa.array(hit[0] & hit[1] == 1)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            hashes = [_set_hash(*shingles(part, n_gram), part.rows)[0] for part in slices(batch.column(2))]
            own = np.concatenate(hashes) if hashes else np.zeros(0, np.int64)
            yield batch.filter(pa.array(own == np.asarray(batch.column(0))))

    place = [F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(BLOOM_BITS)) for i in range(2)]
    near = docs.where(F.col("doc_id").isNotNull()).where(maybe(*place)).select(F.col("doc_id").alias("rep"), "text")
    joined = wanted.join(near, "rep").select("h", "rep", "text")
    return joined.mapInArrow(lean(batches), joined.schema)


def exact_links(pairs: DataFrame, texts: DataFrame, n_gram: int, threshold: int) -> DataFrame:
    """Edges (a, b) between representatives: the pairs of sets that link by their whole texts."""
    left = texts.select(F.col("h").alias("a"), F.col("rep").alias("ra"), F.col("text").alias("ta"))
    right = texts.select(F.col("h").alias("b"), F.col("rep").alias("rb"), F.col("text").alias("tb"))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keep = []
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                for a, b in _text_pairs(some.column(2), some.column(3)):
                    keep.append(_linked(a, b, n_gram, threshold))
            kept = pa.array(np.concatenate(keep) if keep else [], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(kept)

    kind = texts.schema["rep"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return pairs.join(left, "a").join(right, "b").select("ra", "rb", "ta", "tb").mapInArrow(lean(batches), schema)


def _text_pairs(a: pa.Array, b: pa.Array) -> Iterator[tuple[Slice, Slice]]:
    """Both texts of each pair in slices that break at the same pairs."""
    lengths = np.asarray(pc.binary_length(a)).astype(np.int64) + np.asarray(pc.binary_length(b))
    at = 0
    while at < len(a):
        stop = at + max(1, int(np.searchsorted(np.cumsum(lengths[at:]), SLICE_BYTES, side="right")))
        yield whole(a.slice(at, stop - at)), whole(b.slice(at, stop - at))
        at = stop


def _linked(a: Slice, b: Slice, n_gram: int, threshold: int) -> np.ndarray:
    (ra, ka), (rb, kb) = shingles(a, n_gram), shingles(b, n_gram)
    na, nb = np.bincount(ra, minlength=a.rows), np.bincount(rb, minlength=b.rows)
    both = mix(np.concatenate([ka + mix(ra.astype(U) + U(1)), kb + mix(rb.astype(U) + U(1))]))
    row = np.concatenate([ra, rb])
    order = np.argsort(both)
    twice = both[order][1:] == both[order][:-1]
    shared = np.bincount(row[order[1:]][twice], minlength=a.rows)
    return 100 * shared >= threshold * (na + nb - shared)


OPEN_SCHEMA = "sig long, a long, b long, more boolean"


def _cross_pairs(threshold: int, every: bool):
    """Of rows (sig, i, j, own, h, comp, n, sketch) in order of (sig, i, j): pairs within a group that lie
    in different components and may link. A group holds two blocks at most. Unless ``every``, a component gives its
    closest pair in the group only, and ``more`` tells whether the group has others."""

    def group_pairs(t: pa.Table) -> pa.RecordBatch:
        key = [np.asarray(t.column(c).combine_chunks()) for c in ("sig", "i", "j", "own", "h", "comp", "n")]
        sig, i, j, own, h, comp, n = key
        sketch = Sketches(t.column("sketch"))
        left, right, gaps = [], [], []
        shift, at = 1, np.arange(len(sig))
        while len(at):
            at = at[at + shift < len(sig)]
            to = at + shift
            same = (sig[at] == sig[to]) & (i[at] == i[to]) & (j[at] == j[to])
            at, to = at[same], to[same]
            cross = (comp[at] != comp[to]) & ((i[at] == j[at]) | (own[at] != own[to]))
            a, b = at[cross], to[cross]
            fit = np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * threshold
            a, b = a[fit], b[fit]
            least = least_difference(sketch, a, sketch, b)
            ok = _may_link(n[a], n[b], least, threshold)
            left.append(a[ok])
            right.append(b[ok])
            gaps.append(least[ok] / (n[a[ok]] + n[b[ok]]))
            shift += 1
        a, b, gap = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right, gaps))
        more = np.zeros(len(a), bool)
        if not every:
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            group = (np.cumsum(new) - 1)[a]
            best = np.zeros(len(a), bool)
            for side in (a, b):
                order = np.lexsort((h[b], h[a], gap, comp[side], group))
                head = np.ones(len(order), bool)
                head[1:] = (group[order][1:] != group[order][:-1]) | (comp[side][order][1:] != comp[side][order][:-1])
                best[order[head]] = True
            dropped = np.bincount(group[~best], minlength=int(new.sum())) > 0
            more = dropped[group][best]
            a, b = a[best], b[best]
        ends = [pa.array(np.minimum(h[a], h[b])), pa.array(np.maximum(h[a], h[b]))]
        return pa.RecordBatch.from_arrays([pa.array(sig[a]), *ends, pa.array(more)], names=["sig", "a", "b", "more"])

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in source:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            last = [t.column(c)[-1].as_py() for c in ("sig", "i", "j")]
            tail = pc.and_(pc.and_(pc.equal(t.column("sig"), last[0]), pc.equal(t.column("i"), last[1])), pc.equal(t.column("j"), last[2]))
            cut = t.num_rows - int(pc.sum(tail).as_py())
            if cut:
                yield group_pairs(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None:
            yield group_pairs(held)

    return batches


def open_pairs(members: DataFrame, comps: DataFrame, sets: DataFrame, threshold: int, every: bool) -> DataFrame:
    """(sig, a, b, more): pairs of set hashes that share a signature, lie in different components and may link."""
    placed = members.select("sig", "h").join(comps, "h", "left").withColumn("comp", F.coalesce("comp", "h"))
    placed = materialise(placed, "signature-comps")
    marks = [F.bit_xor(F.xxhash64(F.lit(i), "h")).alias(f"x{i}") for i in range(2)]
    mixed = placed.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"), *marks).where("lo < hi")
    one = mixed.groupBy("x0", "x1", "size").agg(F.min("sig").alias("sig"))  # signatures of the same members give the same pairs
    mixed = materialise(one.select("sig", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "mixed-signatures")
    own = F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")
    rows = placed.join(mixed, "sig").withColumn("own", own)
    rows = rows.join(sets.select("h", "n", "sketch").hint("merge"), "h")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "h", "comp", "n", "sketch")
    dealt = rows.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return materialise(dealt.mapInArrow(lean(_cross_pairs(threshold, every)), OPEN_SCHEMA), "open-pairs")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_gram: int = N_GRAM, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` and ``component_id``, the smallest id that links reach.

    Two documents link if 100 * (shingles of both) >= threshold * (shingles of either). Ids may be
    null or repeated: a null id gives its row's shingles but neither links nor names a component, and its
    component is null; rows that share an id are one document as far as links go. A null, empty or blank
    text has no shingles and its id is its own component unless another row of that id links. Other
    columns are not read. Memory is bounded by a slice of texts, a batch, or one long text.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    table = materialise(set_table(docs, n_gram, threshold), "shingle-sets")
    named = table.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = materialise(named.groupBy("h", "g").agg(F.min("doc_id").alias("rep")), "classes")
    rows = signature_rows(docs.where(F.col("doc_id").isNotNull()).select("text"), n_gram, threshold)
    ranged = rows.repartitionByRange("sig", "h").sortWithinPartitions("sig", "h")
    members = materialise(ranged.mapInArrow(lean(_shared_signatures), "sig long, h long, pivot long"), "signature-members")
    sketched = table.where(F.col("sketch").isNotNull()).select("h", "n", "sketch")
    sets = materialise(sketched.join(members.select("h").distinct(), "h").dropDuplicates(["h"]), "sketches")

    def verified(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
        wanted = materialise(classes.join(ends, "h").select("h", "rep"), "wanted")
        texts = materialise(texts_of(docs, wanted, n_gram), "texts")
        return materialise(exact_links(pairs, texts, n_gram, threshold), "links")

    pivots = members.where("pivot != h").select(F.least("pivot", "h").alias("a"), F.greatest("pivot", "h").alias("b")).distinct()
    first = materialise(sketch_filter(pivots, sets, threshold), "pivot-pairs")
    rows = table.join(classes, ["h", "g"], "left").withColumn("rep", F.when(F.col("n") > 0, F.col("rep")))
    rows = materialise(rows.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")), "rows")
    apart = rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.collect_set("rep").alias("reps")).where(F.size("reps") > 1)
    links = verified(first).unionByName(apart.select(F.explode("reps").alias("a"), F.col("reps")[0].alias("b")))
    comps = components(links)

    # A component's closest open pair settles most; signatures with others are looked at again, then whole.
    tried = first
    for every in (False, False, True):
        by_hash = classes.join(comps, classes["rep"] == comps["id"]).groupBy("h").agg(F.min("component").alias("component"))
        names = by_hash.groupBy("component").agg(F.min("h").alias("comp"))
        found = open_pairs(members, by_hash.join(names, "component").select("h", "comp"), sets, threshold, every)
        rest = materialise(found.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "new-pairs")
        if not rest.isEmpty():
            tried = tried.unionByName(rest)
            new = verified(rest)
            if not new.isEmpty():
                links = links.unionByName(new)
                comps = components(links)
        members = members.join(found.where("more").select("sig").distinct(), "sig", "left_semi")
        if every or members.isEmpty():
            break
        members = materialise(members, "signature-members")
    found = rows.join(comps.withColumnRenamed("id", "rep"), "rep", "left")
    return found.select(F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
