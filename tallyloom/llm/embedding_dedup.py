"""Embedding near-dedup by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned into the eigenvectors of their second moments, largest
first, which keeps all products. Equal vectors of a label are one. The distinct ones are ordered by label
and leading coordinates and cut into tiles of bounded size; a tile knows the range of its leading
coordinates, and two tiles are compared only if their labels meet and their ranges come closer than two
vectors that link may be. Within a pair of tiles, products of the leading dimensions are summed block by
block; what the rest can add is at most the product of the lengths of the rest, so pairs that cannot reach
the threshold are dropped after each block. The few that remain are computed again from the given numbers
in double precision.

A pair of tiles yields, per vector, its number of links and enough links to keep its components, never all
pairs. Tiles and their pairs are rows of bounded size, dealt out by number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.components import components
from tallyloom.llm.session import lean
from tallyloom.llm.textbytes import BASES, mix
from tallyloom.runtime import materialise

THRESHOLD = 0.93
TILE = 1024
LEADING = 4
STEP = 8
DENSE = 0.02
SLACK = 1e-9

U = np.uint64


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that are usable vectors of one dimension, and their places.

    Null, empty, zero or not wholly finite vectors are no vectors."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0)).astype(np.int64)
    flat = np.asarray(pc.fill_null(column.flatten().cast(pa.float64()), np.nan))
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return np.zeros((0, 0)), filled
    sums = np.add.reduceat(np.abs(flat), starts[filled])
    good = filled[np.isfinite(sums) & (sums > 0)]
    if not len(good):
        return np.zeros((0, 0)), good
    width = sizes[good].max()
    out = np.zeros((len(good), width))
    for size in np.unique(sizes[good]):
        mine = np.flatnonzero(sizes[good] == size)
        out[mine, :size] = flat[starts[good[mine]][:, None] + np.arange(size)]
    return out, good


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows of length one, also for numbers whose squares overflow or vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _vector_hash(x: np.ndarray) -> np.ndarray:
    """Two hashes of the doubles of each row; the two zeros are one."""
    bits = (x + 0.0).view(np.uint64)
    out = []
    for base in BASES:
        h = np.zeros(len(x), U)
        for d in range(x.shape[1]):
            h = mix(h * U(base) + bits[:, d] + U(d + 1))
        out.append(h.view(np.int64))
    return out


CLASS = ["label", "dim", "h", "g"]


def vector_table(rows: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, dim, h, g, x) of every row: dimension, hash and doubles of its vector; dim is 0 and x
    null where the row can link with nothing."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for lo in range(0, batch.num_rows, 4096):
                some = batch.slice(lo, 4096)
                sizes = np.asarray(pc.fill_null(pc.list_value_length(some.column(2)), 0)).astype(np.int32)
                sizes[np.asarray(pc.or_(some.column(0).is_null(), some.column(1).is_null()))] = 0
                for size in np.unique(sizes).tolist():
                    same = some.filter(pa.array(sizes == size))
                    x, good = _matrix(same.column(2)) if size else (np.zeros((0, 0)), np.zeros(0, np.int64))
                    bad = np.setdiff1d(np.arange(same.num_rows), good)
                    zero = pa.array(np.zeros(len(bad), np.int64))
                    rest = same.take(pa.array(bad))
                    yield pa.RecordBatch.from_arrays([rest.column(0), rest.column(1), zero.cast(pa.int32()), zero, zero, pa.nulls(len(bad), pa.list_(pa.float64()))], names)
                    if len(good):
                        h, g = _vector_hash(x)
                        kept = same.take(pa.array(good))
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, size, dtype=np.int32)), pa.array(x.ravel()))
                        yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(np.full(len(x), size, np.int32)), pa.array(h), pa.array(g), lists], names)

    names = ["vec_id", *CLASS, "x"]
    source = rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("x"))
    kinds = [source.schema["vec_id"].dataType, source.schema["label"].dataType, T.IntegerType(), T.LongType(), T.LongType(), T.ArrayType(T.DoubleType())]
    return source.mapInArrow(lean(batches), T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Eigenvectors of the second moments of all vectors of each dimension, largest first.

    One matrix of dim * dim numbers per task and dimension comes to the driver."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in source:
            dims = np.asarray(batch.column(0))
            for dim in np.unique(dims).tolist():
                lists = batch.column(1).filter(pa.array(dims == dim))
                x = _scaled(np.asarray(lists.flatten()).reshape(-1, dim))
                sums[dim] = sums.get(dim, 0) + x.T @ x
        for dim, total in sums.items():
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, dim * dim + 1, dim, dtype=np.int32)), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)), rows], ["dim", "row", "sums"])

    parts = vectors.select("dim", "x").mapInArrow(lean(batches), "dim int, row int, sums array<double>")
    cells = parts.select("dim", "row", F.posexplode("sums")).groupBy("dim", "row", "pos").agg(F.sum("col").alias("total")).toArrow()
    dim, row, pos, total = (np.asarray(cells.column(c)) for c in ("dim", "row", "pos", "total"))
    axes = {}
    for d in np.unique(dim).tolist():
        mine = dim == d
        moments = np.zeros((d, d))
        moments[row[mine], pos[mine]] = total[mine]
        axes[d] = np.linalg.eigh((moments + moments.T) / 2)[1][:, ::-1].copy()
    return axes


def _near_one(x: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two, which changes no cosine, so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _linked(a: np.ndarray, b: np.ndarray, ta: np.ndarray, tb: np.ndarray, threshold: float, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) with cosine >= threshold where ``same``: leading blocks first, then exactly."""
    dim = ta.shape[1]
    rest_a = np.sqrt(np.maximum(np.cumsum((ta * ta)[:, ::-1], axis=1)[:, ::-1], 0))
    rest_b = np.sqrt(np.maximum(np.cumsum((tb * tb)[:, ::-1], axis=1)[:, ::-1], 0))
    done = min(STEP, dim)
    part = ta[:, :done] @ tb[:, :done].T
    bound = threshold - SLACK
    open_ = same.copy()
    if done < dim:
        open_ &= part + rest_a[:, done][:, None] * rest_b[:, done] >= bound
    else:
        open_ &= part >= bound
    while done < dim and np.count_nonzero(open_) > DENSE * open_.size:  # most are open: go on with whole blocks
        upto = min(done + STEP, dim)
        part += ta[:, done:upto] @ tb[:, done:upto].T
        rest = rest_a[:, upto][:, None] * rest_b[:, upto] if upto < dim else 0.0
        open_ &= part + rest >= bound
        done = upto
    i, j = np.nonzero(open_)
    value = part[i, j]
    while done < dim and len(i):
        upto = min(done + STEP, dim)
        step = np.empty(len(i))
        for lo in range(0, len(i), 1 << 16):
            some = slice(lo, lo + (1 << 16))
            step[some] = np.einsum("ij,ij->i", ta[i[some], done:upto], tb[j[some], done:upto])
        value = value + step
        rest = rest_a[i, upto] * rest_b[j, upto] if upto < dim else 0.0
        keep = value + rest >= bound
        i, j, value = i[keep], j[keep], value[keep]
        done = upto
    exact = np.ones(len(i), bool)
    close = np.flatnonzero(np.abs(value - threshold) <= 1e-6)  # beyond that rounding cannot matter
    exact[value < threshold] = False
    if len(close):
        x, y = _near_one(a[i[close]]), _near_one(b[j[close]])
        cosine = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
        exact[close] = cosine >= threshold
    return i[exact], j[exact]


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links enough to join what all links join: a chain through each component of the block."""
    part = np.arange(n)
    while True:
        low = np.minimum(part[i], part[j])
        new = part.copy()
        np.minimum.at(new, part[i], low)
        np.minimum.at(new, part[j], low)
        while not (new[new] == new).all():
            new = new[new]
        if (new == part).all():
            break
        part = new[part]
    order = np.argsort(part, kind="stable")
    same = part[order][1:] == part[order][:-1]
    return order[:-1][same], order[1:][same]


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of the leading coordinates, in turn, as one ordering key."""
    levels = ((np.clip(x, -1, 1) + 1) * (2**14 - 1)).astype(np.int64)
    key = np.zeros(len(x), np.int64)
    for bit in range(14, -1, -1):
        for c in range(x.shape[1]):
            key = (key << 1) | ((levels[:, c] >> bit) & 1)
    return key


def tiles(classes: DataFrame, axes: dict[int, np.ndarray], tile: int = TILE) -> DataFrame:
    """Rows of up to ``tile`` distinct vectors of one label and dimension, near each other in the leading coordinates.

    The first vector of tile t is number t << 20; x holds the given numbers, as floats where that loses nothing.
    """

    def keyed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            dims = np.asarray(batch.column(1))
            for dim in np.unique(dims).tolist():
                same = batch.filter(pa.array(dims == dim))
                x = np.asarray(same.column(6).flatten()).reshape(-1, dim)
                lead = np.zeros((len(x), LEADING))
                lead[:, : min(dim, LEADING)] = (_scaled(x) @ axes[dim])[:, :LEADING]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, lead.size + 1, LEADING, dtype=np.int32)), pa.array(lead.ravel()))
                yield pa.RecordBatch.from_arrays([*same.columns, lists, pa.array(_spread(lead))], [*same.schema.names, "lead", "spread"])

    def packed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        held: pa.Table | None = None
        for batch in source:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            label, dim = held.column("label").to_numpy(), held.column("dim").to_numpy()
            breaks = np.flatnonzero((label[1:] != label[:-1]) | (dim[1:] != dim[:-1])) + 1
            bounds = [0, *breaks.tolist(), held.num_rows]
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                last = hi == held.num_rows
                while hi - lo >= tile or (not last and hi > lo):
                    yield one(held.slice(lo, min(tile, hi - lo)), number)
                    lo, number = lo + min(tile, hi - lo), number + 1
            held = held.slice(lo)
        if held is not None and held.num_rows:
            yield one(held, number)

    def one(t: pa.Table, number: int) -> pa.RecordBatch:
        t = t.combine_chunks()
        dim = t.column("dim")[0].as_py()
        x = np.asarray(t.column("x").chunk(0).flatten()).reshape(-1, dim)
        lead = np.asarray(t.column("lead").chunk(0).flatten()).reshape(-1, LEADING)
        small = x.astype(np.float32)
        data = small if (small == x).all() else x
        whole = pa.array([0, len(x)], pa.int32())
        lists = [pa.ListArray.from_arrays(whole, t.column(c).chunk(0)) for c in ("h", "g", "n", "rep")]
        box = [pa.array([v.tolist()], pa.list_(pa.float64())) for v in (lead.min(axis=0), lead.max(axis=0))]
        head = [pa.array([number]), t.column("label").chunk(0).slice(0, 1), t.column("dim").chunk(0).slice(0, 1)]
        return pa.RecordBatch.from_arrays([*head, *lists, *box, pa.array([data.tobytes()], pa.binary())], TILE_COLUMNS)

    long, double = T.LongType(), T.DoubleType()
    rows = classes.select(*CLASS, "n", "rep", "x")
    placed = rows.mapInArrow(lean(keyed), T.StructType([*rows.schema.fields, T.StructField("lead", T.ArrayType(double)), T.StructField("spread", long)]))
    placed = materialise(placed, "vector-classes")
    ordered = placed.repartitionByRange("label", "dim", "spread").sortWithinPartitions("label", "dim", "spread", "h", "g")
    rep = T.ArrayType(rows.schema["rep"].dataType)
    kinds = [long, rows.schema["label"].dataType, T.IntegerType(), *[T.ArrayType(long)] * 3, rep, *[T.ArrayType(double)] * 2, T.BinaryType()]
    return ordered.mapInArrow(lean(packed), T.StructType([T.StructField(c, k) for c, k in zip(TILE_COLUMNS, kinds)]))


TILE_COLUMNS = ["tile", "label", "dim", "hs", "gs", "ns", "reps", "low", "high", "data"]


def tile_pairs(stored: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a <= b: tiles of one label and dimension that may hold a link, by the ranges of their leading coordinates."""
    reach = float(np.sqrt(max(2 - 2 * threshold, 0)) + 1e-9)
    bins = F.explode(F.sequence(F.floor(F.col("low")[0] / max(reach, 1e-3)), F.floor(F.col("high")[0] / max(reach, 1e-3)) + 1))
    boxes = stored.select("tile", "label", "dim", "low", "high").withColumn("bin", bins)
    left = boxes.select("label", "dim", "bin", F.col("tile").alias("a"), F.col("low").alias("la"), F.col("high").alias("ha"))
    right = boxes.select("label", "dim", "bin", F.col("tile").alias("b"), F.col("low").alias("lb"), F.col("high").alias("hb"))
    near = left.join(right, ["label", "dim", "bin"]).where("a <= b")
    gaps = F.zip_with(F.zip_with("la", "hb", lambda x, y: x - y), F.zip_with("lb", "ha", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    distance = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)
    return near.where(distance <= reach * reach).select("a", "b").distinct()


def compare_tiles(stored: DataFrame, pairs: DataFrame, axes: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """(a, b, links): with b null, a vector's number of links found in a pair of tiles; otherwise a link."""
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("tile")).distinct()
    dealt = sides.join(stored.select("tile", "dim", "ns", "data"), "tile").repartition("a", "b").sortWithinPartitions("a", "b", "tile")
    rows = dealt.select("a", "b", "tile", "dim", "ns", "data")

    def vectors(dim: int, ns: pa.Array, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        copies = np.asarray(ns)
        x = np.frombuffer(data, np.float32 if len(data) == 4 * dim * len(copies) else np.float64).reshape(-1, dim).astype(float)
        return copies, x, _scaled(x) @ axes[dim]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        for batch in source:
            for k in range(batch.num_rows):
                a, b, tile = (batch.column(c)[k].as_py() for c in range(3))
                own = (tile, *vectors(batch.column(3)[k].as_py(), batch.column(4)[k].values, batch.column(5)[k].as_py()))
                if a != b and first is None:
                    first = own
                    continue
                yield compared(first or own, own, a == b)
                first = None

    def compared(left, right, alone: bool) -> pa.RecordBatch:
        (ta, na, xa, ya), (tb, nb, xb, yb) = left, right
        same = np.ones((len(xa), len(xb)), bool)
        if alone:
            same = np.triu(same, 1)
        i, j = _linked(xa, xb, ya, yb, threshold, same)
        if alone:
            links = np.bincount(i, nb[j], len(xa)) + np.bincount(j, na[i], len(xa))
            numbers = (ta << 20) + np.arange(len(xa))
            at, to = _forest(i, j, len(xa))
        else:
            links = np.concatenate([np.bincount(i, nb[j], len(xa)), np.bincount(j, na[i], len(xb))])
            numbers = np.concatenate([(ta << 20) + np.arange(len(xa)), (tb << 20) + np.arange(len(xb))])
            at, to = _forest(i, j + len(xa), len(numbers))
        some = np.flatnonzero(links)
        a = np.concatenate([numbers[some], numbers[at]])
        b = pa.array(np.concatenate([np.zeros(len(some), np.int64), numbers[to]]), mask=np.arange(len(a)) < len(some))
        count = np.concatenate([links[some].astype(np.int64), np.zeros(len(at), np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(count)], ["a", "b", "links"])

    return rows.mapInArrow(lean(batches), "a long, b long, links long")


def dedup_embeddings(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per row: its id, ``n_links``, ``component_id`` (the smallest id that links reach) and ``kept``.

    Rows link if their labels are equal and their cosine is ``threshold`` or more, in double precision. A row
    links with nothing if its id, label or vector is null or its vector is empty, zero or not wholly finite; vectors of
    different length do not link. Rows that share id, label and vector are one vector; a null id has a null component
    and is kept. Other columns are not read.
    """
    table = materialise(vector_table(rows, vec_id, embedding, label), "vectors")
    usable = table.where("dim > 0")
    axes = principal_axes(usable)
    counts = usable.select(*CLASS, "vec_id").distinct().groupBy(*CLASS).agg(F.count("*").alias("n"), F.min("vec_id").alias("rep"))
    classes = usable.groupBy(*CLASS).agg(F.first("x").alias("x")).join(counts, CLASS)
    stored = materialise(tiles(classes, axes, tile), "vector-tiles")
    pairs = materialise(tile_pairs(stored, threshold), "tile-pairs")
    found = materialise(compare_tiles(stored, pairs, axes, threshold), "tile-links")

    zipped = F.posexplode(F.arrays_zip("hs", "gs", "ns", "reps"))
    numbered = stored.select("tile", "label", "dim", zipped).select("label", "dim", F.col("col.hs").alias("h"), F.col("col.gs").alias("g"), F.col("col.ns").alias("n"), F.col("col.reps").alias("rep"), (F.shiftleft("tile", 20) + F.col("pos")).alias("number"))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("number")).agg(F.sum("links").alias("links"))
    parts = components(found.where("b IS NOT NULL").select("a", "b")).withColumnsRenamed({"id": "number", "component": "root"})
    known = materialise(numbered.join(links, "number", "left").join(parts, "number", "left").withColumn("root", F.coalesce("root", "number")), "vector-links")
    names = known.groupBy("root").agg(F.min("rep").alias("component"))
    known = materialise(known.join(names, "root").select(*CLASS, (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component"), "vector-components")
    out = table.drop("x").join(known, CLASS, "left")
    component = F.coalesce("component", "vec_id")
    kept = F.coalesce(F.col("vec_id") == component, F.lit(True))
    return out.select(F.col("vec_id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), kept.alias("kept"))
