"""Compress vectors to codes: codebooks of parts, searched through memoised grid cells.

A vector's integer components are cut into equal parts, and each part is replaced by the index of its
codebook's nearest entry. A worker does not compare a part with all entries: it hashes the part's coarse
grid cell and looks the cell up. On the first visit the cell gets its list of entries, those that no other
entry beats everywhere in the box (smallest distance to the box above another's largest); only these are
evaluated exactly for the parts in the cell. All arithmetic is on 64-bit integers, so results do not depend
on the order of rows or the number of tasks.

Codebooks are learnt from all vectors: every pass is one scan whose tasks return a sum and a count per
entry. What comes to the driver is the codebook, parts x entries rows, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.session import lean, unused
from tallyloom.llm.textbytes import mix
from tallyloom.operators.skew import salted_join
from tallyloom.runtime import materialise

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Integer components are held within this, so that squared distances of whole vectors fit 64 bits.
LIMIT = 1 << 26
#: A codebook's spread in one direction is this many cells wide.
CELLS_ACROSS = 8
#: Cells that a worker remembers per part before it starts anew.
MAX_CELLS = 30_000
#: Parts in one numpy step, and labels that are broadcast with their sums.
STEP_ROWS = 8192
MAX_BROADCAST_LABELS = 50_000
OUT = ["code", "error", "label_error"]


class Codebooks(NamedTuple):
    """``entries[part, entry, position]`` as 64-bit integers."""

    entries: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components in order, decimal, joined by commas."""
        return sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Cells:
    """The grid over one part's codebook: entries that can be nearest, per cell seen so far."""

    def __init__(self, entries: np.ndarray, across: int = CELLS_ACROSS, most: int = MAX_CELLS):
        self.entries, self.most = entries, most
        spread = int((entries.max(axis=0) - entries.min(axis=0)).max())
        self.width = max(1, spread // across)
        self.evaluated = 0
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.boxes = np.zeros((0, self.entries.shape[1]), np.int64)
        self.begins, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.lists = np.zeros(0, np.int64)

    def hashed(self, cells: np.ndarray) -> np.ndarray:
        key = np.zeros(len(cells), np.uint64)
        for column in cells.T:
            key = mix(key ^ (column.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
        return key

    def learn(self, keys: np.ndarray, cells: np.ndarray) -> None:
        """Lists of the entries not dominated in each new cell: smallest distance at most the least largest one."""
        low = (cells * self.width)[:, None, :]
        high = low + (self.width - 1)
        below, above = low - self.entries, self.entries - high
        least = np.square(np.maximum(np.maximum(below, above), 0)).sum(axis=2)
        largest = np.square(np.maximum(np.abs(below), np.abs(above))).sum(axis=2)
        kept = least <= largest.min(axis=1, keepdims=True)
        at, entry = np.nonzero(kept)
        counts = np.bincount(at, minlength=len(cells))
        begins = len(self.lists) + np.cumsum(counts) - counts
        self.lists = np.concatenate([self.lists, entry])
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.boxes = np.insert(self.boxes, place, cells, axis=0)
        self.begins, self.counts = np.insert(self.begins, place, begins), np.insert(self.counts, place, counts)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row, the lowest index among equals."""
        cells = parts // self.width
        keys = self.hashed(cells)
        distinct, first = np.unique(keys, return_index=True)
        if len(self.keys) + len(distinct) > self.most:
            self.forget()
        known = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), bool)
        inside = known < len(self.keys)
        new[inside] = self.keys[known[inside]] != distinct[inside]
        for at in range(0, int(new.sum()), 2048):
            some = np.flatnonzero(new)[at : at + 2048]
            self.learn(distinct[some], cells[first[some]])
        place = np.searchsorted(self.keys, keys)
        same = (self.boxes[place] == cells).all(axis=1)  # another cell with the same hash: all entries
        counts = np.where(same, self.counts[place], len(self.entries))
        offsets = np.cumsum(counts) - counts
        step = np.arange(int(counts.sum())) - np.repeat(offsets, counts)
        entry = step.copy() if not same.all() else None
        listed = self.lists[np.minimum(np.repeat(self.begins[place], counts) + step, max(len(self.lists) - 1, 0))]
        entry = listed if entry is None else np.where(np.repeat(same, counts), listed, entry)
        distance = np.square(np.repeat(parts, counts, axis=0) - self.entries[entry]).sum(axis=1)
        self.evaluated += len(entry)
        least = np.minimum.reduceat(distance, offsets) if len(offsets) else distance
        chosen = np.where(distance == np.repeat(least, counts), entry, len(self.entries))
        return (np.minimum.reduceat(chosen, offsets) if len(offsets) else chosen), least


_cells: dict[str, list[Cells]] = {}


def _grids(books: Codebooks) -> list[Cells]:
    """The worker's grids of these codebooks; those of older ones go."""
    name = books.digest()
    if name not in _cells:
        _cells.clear()
        _cells[name] = [Cells(e) for e in books.entries]
    return _cells[name]


def assigned(books: Codebooks, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared distances), one column per part, of integer vectors."""
    parts, _, width = books.entries.shape
    found = [grid.nearest(vectors[:, i * width : (i + 1) * width]) for i, grid in enumerate(_grids(books))]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _steps(batch: pa.RecordBatch, column: str, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, rows with a vector of the right width, their vectors) of some rows at a time."""
    for at in range(0, batch.num_rows, STEP_ROWS):
        lists = batch.column(batch.schema.get_field_index(column)).slice(at, STEP_ROWS)
        lengths = np.diff(lists.offsets.to_numpy())
        rows = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False) & (lengths == width))
        values = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield at, rows, values.reshape(len(rows), width).astype(np.int64)


def integers(vector: Column, scale: int = SCALE, limit: int = LIMIT) -> Column:
    """floor(scale * x) of every component; null for a vector that is null or holds null or non-finite ones."""
    whole = F.transform(vector, lambda x: F.greatest(F.lit(-limit), F.least(F.lit(limit), F.floor(x.cast("double") * scale))).cast("long"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.when(F.forall(vector, number), whole)


def _first_entries(vectors: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """Parts of the smallest ids' vectors; a repeated id gives its smallest vector, a null id none."""
    fits = vectors.where(F.col("vec_id").isNotNull() & (F.size("_whole") > 0) & (F.size("_whole") % parts == 0))
    smallest: dict = {}
    while len(smallest) < entries:  # repeated ids ask for a further look, at most one per entry
        asked = entries - len(smallest)
        found = fits.orderBy("vec_id", "_whole").limit(asked).collect()
        for r in found:
            smallest.setdefault(r["vec_id"], r["_whole"])
        if len(found) < asked:
            break
        fits = fits.where((F.col("vec_id") > max(smallest)) & (F.size("_whole") == len(next(iter(smallest.values())))))
    if not smallest:
        return None
    width = len(next(iter(smallest.values())))
    rows = np.array([v for v in smallest.values() if len(v) == width], np.int64)
    return Codebooks(rows.reshape(len(rows), parts, width // parts).transpose(1, 0, 2).copy())


def _moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry at the floor of the mean of its parts; entries without parts stay."""
    parts, entries, width = books.entries.shape

    @lean
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width), np.int64)
        count = np.zeros(parts * entries, np.int64)
        for batch in batches:
            for _, _, vs in _steps(batch, "_whole", parts * width):
                codes, _ = assigned(books, vs)
                for i in range(parts):
                    order = np.argsort(codes[:, i], kind="stable")
                    used, first = np.unique(codes[order, i], return_index=True)
                    if len(used):
                        total[i * entries + used] += np.add.reduceat(vs[order, i * width : (i + 1) * width], first, axis=0)
                        count[i * entries + used] += np.diff(np.append(first, len(order)))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict(
            {"entry": pa.array(used, pa.int32()), "n": pa.array(count[used]), "total": pa.array(total[used].tolist(), pa.list_(pa.int64()))}
        )

    part_sums = vectors.select("_whole").mapInArrow(sums, "entry int, n long, total array<long>")
    columns = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)]
    rows = part_sums.groupBy("entry").agg(F.sum("n").alias("n"), *columns).collect()  # at most parts x entries
    moved = books.entries.reshape(parts * entries, width).copy()
    for r in rows:
        moved[r["entry"]] = [r[f"t{i}"] // r["n"] for i in range(width)]
    return Codebooks(moved.reshape(parts, entries, width))


def learn_codebooks(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codebooks | None:
    """Codebooks from all vectors of ``df``; None if no vector fits.

    The first entries are the vectors of the ``entries`` smallest ids. Fewer ids give fewer entries. The
    width is that of the smallest id with a vector that parts evenly; vectors of another one take no part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    vectors = df.select(F.col(vec_id).alias("vec_id"), integers(F.col(vector), scale).alias("_whole")).where("_whole IS NOT NULL")
    books = _first_entries(vectors, parts, entries)
    for _ in range(rounds if books else 0):
        books = _moved(vectors, books)
    return books


def encode_vectors(df: DataFrame, books: Codebooks | None, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``df`` without rows whose vector is null or holds null or non-finite components, with code and error.

    ``code`` has two hex digits per part; ``error`` is the sum of the parts' squared distances in integer
    components. Both are null for a vector of another width than the codebooks'. Components beyond
    +-2^26 after scaling count as that. Columns named like the new ones are replaced; others are kept.
    """
    df = df.drop("code", "error")
    names, whole = df.columns, unused(df, "_whole")
    df = df.withColumn(whole, integers(F.col(vector), scale)).where(F.col(whole).isNotNull())
    if books is None:
        return df.drop(whole).withColumns({"code": F.lit(None).cast("string"), "error": F.lit(None).cast("long")})
    width = books.entries.shape[0] * books.entries.shape[2]

    @lean
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array([f"{i:02x}" for i in range(256)], dtype="S2")
        for batch in batches:
            code, error = np.full(batch.num_rows, None, object), np.zeros(batch.num_rows, np.int64)
            for at, rows, vs in _steps(batch, whole, width):
                if len(rows):
                    codes, distance = assigned(books, vs)
                    code[at + rows] = [c.decode() for c in np.ascontiguousarray(digits[codes]).view(f"S{2 * codes.shape[1]}").ravel()]
                    error[at + rows] = distance.sum(axis=1)
            empty = np.equal(code, None)
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != whole]
            columns = [*kept, pa.array(code, pa.string()), pa.array(error, pa.int64(), mask=empty)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "code", "error"])

    schema = df.drop(whole).schema.add("code", "string").add("error", "long")
    return df.mapInArrow(encode, schema)


def compress_vectors(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks | None]:
    """(``df`` without unusable vectors, with code, error and label_error; the codebooks).

    ``label_error`` sums the errors of the rows with an equal label, null labels together; it is null only
    where no row of the label has an error. Repeated rows are coded each. An empty table stays empty.
    """
    books = learn_codebooks(df, vec_id, vector, parts, entries, rounds, scale)
    coded = materialise(encode_vectors(df.drop(*OUT), books, vector, scale).drop(vector), "vector-codes")
    key = unused(coded, "_label")
    sums = coded.groupBy(_label_key(label).alias(key)).agg(F.sum("error").alias("label_error"))
    sums = materialise(sums, "label-errors")
    keyed = coded.withColumn(key, _label_key(label))
    if sums.count() <= MAX_BROADCAST_LABELS:
        joined = keyed.join(F.broadcast(sums), key)
    else:
        joined = salted_join(keyed, sums, [key], vec_id)
    result = joined.select(*[F.col(f"`{c}`") for c in coded.columns], "label_error")
    return result, books


def _label_key(label: str) -> Column:
    return F.when(F.col(label).isNull(), "").otherwise(F.concat(F.lit("="), F.col(label).cast("string")))
