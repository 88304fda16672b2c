"""Token ids in Simple-8b files: encode, write in document order, read back.

A 64-bit word has a selector in its top 4 bits and 60 bits of ids: 60 of one bit, 30 of two, ... one of
60. Selector 0 is an escape: the next word is one id of up to 64 bits. Every block of 512 ids starts a new
word, and a payload lists the word at which each block starts, so all blocks are packed and unpacked at
once, one step or one selector for all of them.

Files are Parquet tables of payloads, written and committed by Spark, so they can be in any store that
Spark reaches and lost tasks leave nothing behind. A row holds the payload of consecutive documents, its
place, and the documents' ids and lengths.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.session import lean
from tallyloom.llm.spans import SpanIds
from tallyloom.llm.textbytes import Slice, slices

BLOCK = 512
#: Fixed values of Simple-8b: ids per word and bits per id, by selector; selector 0 escapes.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = b"S8B1"
SLICE_BYTES = 1 << 20
#: Bytes that are joined for one call of the tokenizer.
CALL_BYTES = 256 << 10
END_ID = 0

U = np.uint64


def bit_lengths(ids: np.ndarray) -> np.ndarray:
    out = np.zeros(ids.shape, np.uint8)
    rest = ids.copy()
    for step in (32, 16, 8, 4, 2, 1):
        high = rest >> U(step)
        big = high > 0
        out[big] += step
        rest = np.where(big, high, rest)
    return out + (rest > 0).astype(np.uint8)


def pack(ids: np.ndarray) -> bytes:
    """Payload of a run of unsigned ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.zeros((blocks, BLOCK + 60), U)
    flat = np.zeros(blocks * BLOCK, U)
    flat[:n] = ids
    padded[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    bits = np.zeros((blocks, BLOCK + 60), np.uint8)
    small = int(ids.max(initial=0)) < 1 << 24
    lengths = np.frexp(padded[:, :BLOCK].astype(np.float32))[1].astype(np.uint8) if small else bit_lengths(padded[:, :BLOCK])
    bits[:, :BLOCK] = lengths
    selector = np.zeros((blocks, BLOCK), np.uint8)
    width, window = 1, bits
    selector[window[:, :BLOCK] <= 60] = 14
    for s in range(13, 0, -1):
        count = int(COUNTS[s])
        window = np.maximum(window[:, : window.shape[1] - (count - width)], window[:, count - width :])
        width = count
        np.putmask(selector, window[:, :BLOCK] <= BITS[s], s)
    at = np.zeros(blocks, np.int64)
    row = np.arange(blocks)
    chosen, starts, owners = [], [], []
    while len(row):
        s = selector[row, at[row]]
        chosen.append(s)
        starts.append(at[row])
        owners.append(row)
        at[row] += np.maximum(COUNTS[s], 1)
        row = row[at[row] < BLOCK] if n % BLOCK == 0 else row[at[row] < np.where(row == blocks - 1, n - (blocks - 1) * BLOCK, BLOCK)]
    if chosen:
        s, start, owner = np.concatenate(chosen), np.concatenate(starts), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        s, start, owner = s[order], start[order], owner[order]
    else:
        s = start = owner = np.zeros(0, np.int64)
    words_of = 1 + (s == 0)
    place = np.concatenate([[0], np.cumsum(words_of)])
    words = np.zeros(int(place[-1]), U)
    for sel in np.unique(s):
        mine = np.flatnonzero(s == sel)
        if sel == 0:
            words[place[mine] + 1] = padded[owner[mine], start[mine]]
            continue
        word = np.full(len(mine), U(int(sel) << 60), U)
        base = owner[mine] * (BLOCK + 60) + start[mine]
        line = padded.ravel()
        for k in range(int(COUNTS[sel])):
            word |= line[base + k] << U(int(BITS[sel]) * k)
        words[place[mine]] = word
    offsets = np.zeros(blocks + 1, np.uint32)
    offsets[1:] = np.cumsum(np.bincount(owner, weights=words_of, minlength=blocks)) if blocks else 0
    return MAGIC + struct.pack("<II", n, blocks) + offsets.tobytes() + words.astype("<u8").tobytes()


def unpack(payload: bytes) -> np.ndarray:
    """The ids of a payload."""
    if payload[:4] != MAGIC:
        raise ValueError("not a Simple-8b payload")
    n, blocks = struct.unpack_from("<II", payload, 4)
    offsets = np.frombuffer(payload, "<u4", blocks + 1, 12).astype(np.int64)
    words = np.frombuffer(payload, "<u8", int(offsets[-1]), 12 + 4 * (blocks + 1))
    selector = (words >> U(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (selector == 0).any():  # an escape and its raw word, which may look like anything
        at = 0
        while at < len(words):
            later = np.flatnonzero(selector[at:] == 0)
            if not len(later):
                break
            at += int(later[0])
            raw[at + 1] = True
            at += 2
    counts = COUNTS[np.where(raw, 0, selector)]
    counts[raw] = 1
    before = np.concatenate([[0], np.cumsum(counts)])
    block = np.repeat(np.arange(blocks), np.diff(offsets))
    start = before[:-1] - before[offsets[:-1]][block] + block * BLOCK
    out = np.zeros(blocks * BLOCK + 64, U)
    limit = (block + 1) * BLOCK
    out[start[raw]] = words[raw]
    for sel in np.unique(selector[~raw]):
        if sel == 0:
            continue
        mine = np.flatnonzero((selector == sel) & ~raw)
        mask = U((1 << int(BITS[sel])) - 1)
        for k in range(int(COUNTS[sel])):
            to = start[mine] + k
            fits = to < limit[mine]
            value = (words[mine] >> U(int(BITS[sel]) * k)) & mask
            if fits.all():
                out[to] = value
            else:
                out[to[fits]] = value[fits]
    return out[:n]


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: First bytes of characters that are surely not white space: printable ASCII, two-byte characters from U+00C0 on.
_SOLID = _bytes((0x21, 0x7E), (0xC3, 0xDF))
_LETTER = _bytes((0x41, 0x5A), (0x61, 0x7A))
_MARKS = _bytes((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


def _break_places(part: Slice) -> np.ndarray:
    """Places where the byte-level pattern breaks whatever stands around them, within texts:
    before a single blank between two solid characters, around a single line feed between two, and between
    a letter and an ASCII mark."""
    data = np.concatenate([part.data, np.zeros(2, np.uint8)])
    n = len(part.data)
    lead = data[:n]
    two = np.zeros(n, bool)  # last byte of a two-byte character from U+00C0 on
    two[1:] = _SOLID[lead[:-1]] & (lead[:-1] >= 0x80)
    solid_end = (_SOLID[lead] & (lead < 0x80)) | two
    latin = np.zeros(n, bool)
    latin[1:] = (lead[:-1] == 0xC3) & (lead[1:] != 0x97) & (lead[1:] != 0xB7)
    letter_end = _LETTER[lead] | latin
    gap = np.flatnonzero((lead[1:] == 0x20) | (lead[1:] == 0x0A)) + 1
    gap = gap[solid_end[gap - 1] & _SOLID[data[gap + 1]]]
    marks = np.flatnonzero(_MARKS[lead[1:]] & letter_end[:-1]) + 1
    edge = np.zeros(n + 2, bool)
    edge[part.begins] = True
    gap = gap[~edge[gap] & ~edge[gap + 1]]
    marks = marks[~edge[marks]]
    return np.concatenate([gap, gap[lead[gap] == 0x0A] + 1, marks])


def _any_of(tokens: list[dict]) -> re.Pattern[bytes] | None:
    """The longest of the tokens at a place."""
    found = sorted((t["content"].encode() for t in tokens), key=len, reverse=True)
    return re.compile(b"|".join(map(re.escape, found))) if found else None


class ByteBpe:
    """Ids of whole texts by the tokenizers library, which is asked once per distinct piece of text.

    As in the library, texts are split at the added tokens of the tokenizer file first (``<|endoftext|>`` in a text is one
    id); between them, pieces lie between places where the byte-level pattern always breaks, so each is encoded by itself.
    A text with an added token that takes white space or word edges along goes to the library as it is.
    """

    def __init__(self, tokenizer_json: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(tokenizer_json)
        file = json.loads(tokenizer_json)
        added = [t for t in file.get("added_tokens") or [] if t["content"]]
        self.tokenizer = Tokenizer.from_str(json.dumps(file | {"added_tokens": []}))  # pieces that are joined for a call make up no added token
        wide = [t for t in added if t["single_word"] or t["lstrip"] or t["rstrip"]]
        self.added_ids = {t["content"].encode(): t["id"] for t in added}
        self.wide = _any_of(wide)
        #: The library splits at tokens of the text as it is first, then at those of the normalized text.
        self.added = [p for p in (_any_of([t for t in added if t not in wide and t["normalized"] == later]) for later in (False, True)) if p]
        vocab = self.tokenizer.get_vocab()
        self.id_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.id_bytes[i] = len(token)  # one character stands for one byte
        self.spans = SpanIds(self._encode)

    def _encode(self, part: Slice, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of a blank and a solid character at least, with a solid end, stay apart when they are
        joined; the others are encoded one by one."""
        data, size = part.data, ends - starts
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
        joins = (size > 1) & (data[starts] == 0x20) & _SOLID[data[np.minimum(starts + 1, len(data) - 1)]]
        joins &= (_SOLID[last] & (last < 0x80)) | (_SOLID[before] & (before >= 0x80))
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        n = size[order]
        raw = data[np.repeat(starts[order] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())].tobytes()
        upto = np.cumsum(n)
        single = int(joins.sum())
        cuts = [0]
        while cuts[-1] < single:
            done = upto[cuts[-1] - 1] if cuts[-1] else 0
            cuts.append(min(single, max(cuts[-1] + 1, int(np.searchsorted(upto, done + CALL_BYTES)))))
        cuts += range(single + 1, len(order) + 1)
        bounds = np.concatenate([[0], upto])[cuts].tolist()
        found = []
        for lo in range(0, len(cuts) - 1, 64):
            hi = min(lo + 64, len(cuts) - 1)
            texts = [raw[bounds[i] : bounds[i + 1]].decode() for i in range(lo, hi)]
            for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                found.append(np.array(e.ids, np.int32))
        ids = np.concatenate(found) if found else np.zeros(0, np.int32)
        tokens = np.searchsorted(np.cumsum(self.id_bytes[ids]), upto, side="left") + 1
        counts = np.zeros(len(order), np.int64)
        counts[order] = np.diff(np.concatenate([[0], tokens]))
        first = np.zeros(len(order), np.int64)
        first[order] = np.concatenate([[0], tokens])[:-1]
        return ids[np.repeat(first - np.concatenate([[0], np.cumsum(counts)])[:-1], counts) + np.arange(len(ids))], counts

    def _split(self, part: Slice) -> list[tuple[int, int, list[int]]]:
        """Spans of added tokens, and whole texts that the library must see whole, with their ids, in order."""
        raw, taken = part.data.tobytes(), []
        if self.wide and self.wide.search(raw):
            for a, b in zip(part.begins[:-1].tolist(), part.begins[1:].tolist()):
                if self.wide.search(raw, a, b):
                    taken.append((a, b, self.whole.encode(raw[a:b].decode(), add_special_tokens=False).ids))
        for pattern in self.added:
            if not pattern.search(raw):
                continue
            edges = np.unique([*part.begins.tolist(), *[e for a, b, _ in taken for e in (a, b)]])
            inside = {a for a, _, _ in taken}
            at, found = 0, []
            while m := pattern.search(raw, at):
                k = int(np.searchsorted(edges, m.start(), side="right"))
                lo, hi = int(edges[k - 1]), int(edges[k])
                if m.end() > hi:  # over the end of a text
                    m = pattern.search(raw, max(at, lo), hi)
                if m is None or lo in inside:
                    at = hi
                    continue
                found.append((m.start(), m.end(), [self.added_ids[m[0]]]))
                at = m.end()
            taken = sorted(taken + found)
        return taken

    def encode(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice in turn, and the number of ids of each text."""
        filled = np.flatnonzero(np.diff(part.begins))
        if not len(filled):
            return np.zeros(0, np.int32), np.zeros(part.rows, np.int64)
        cut = np.zeros(len(part.data) + 1, bool)
        cut[part.begins[:-1][filled]] = True
        cut[_break_places(part)] = True
        taken = self._split(part)
        if taken:
            first, after = np.array([(a, b) for a, b, _ in taken]).T
            cut &= np.cumsum(np.bincount(first, minlength=len(cut)) - np.bincount(after, minlength=len(cut))) == 0
            cut[first] = cut[after] = True
        starts = np.flatnonzero(cut[:-1])
        ends = np.append(starts[1:], len(part.data))
        if not taken:
            ids, counts = self.spans.lookup(part, starts, ends)
        else:
            known = np.isin(starts, first)
            counts = np.zeros(len(starts), np.int64)
            ids, counts[~known] = self.spans.lookup(part, starts[~known], ends[~known])
            before = np.cumsum(counts)[known]
            counts[known] = [len(own) for _, _, own in taken]
            ids = np.insert(ids, np.repeat(before, counts[known]), [i for _, _, own in taken for i in own])
        return ids, np.bincount(part.owner(starts), weights=counts, minlength=part.rows).astype(np.int64)


_coders: dict[int, ByteBpe] = {}


def byte_bpe(tokenizer_json: str) -> ByteBpe:
    """The coder of a tokenizer, kept by this worker for its next tasks."""
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _coders:
        _coders.clear()
        _coders[key] = ByteBpe(tokenizer_json)
    return _coders[key]


FILE_COLUMNS = ["part", "place", "doc_ids", "lengths", "payload"]


def write_token_files(docs: DataFrame, path: str, tokenizer_json: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode every whole text, add ``end_id``, and write ids in ascending order of ``doc_id`` (null first).

    A null or empty text has the end id only. Rows that share an id follow each other, ordered by a hash of
    their text. Other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(model.value)
        part_no, place = TaskContext.get().partitionId(), 0
        for batch in source:
            for part in slices(batch.column(1), SLICE_BYTES):
                ids, counts = coder.encode(part)
                ids = np.insert(ids, np.cumsum(counts), end_id)
                rows = batch.column(0).slice(part.first_row, part.rows)
                one = np.array([0, part.rows], np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(one), a) for a in (pa.concat_arrays([rows]), pa.array(counts + 1))]
                columns = [pa.array([part_no], pa.int32()), pa.array([place], pa.int64()), *lists, pa.array([pack(ids.astype(U))], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=FILE_COLUMNS)
                place += len(ids)

    kinds = [T.IntegerType(), T.LongType(), T.ArrayType(docs.schema[doc_id].dataType), T.ArrayType(T.LongType()), T.BinaryType()]
    schema = T.StructType([T.StructField(c, k) for c, k in zip(FILE_COLUMNS, kinds)])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered.mapInArrow(lean(batches), schema).write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ``start`` counts the ids of all documents
    before it. With ``digest``, ids_crc32 (of the ids as little-endian unsigned 32-bit integers) in place of ids.

    Only one count per file part comes to the driver.
    """
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.max(F.col("place") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).collect()
    sizes = dict(sorted((r["part"], r["n"]) for r in totals))
    bases, seen = {}, 0
    for p, n in sizes.items():
        bases[p] = seen
        seen += n

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                part_no, place = row.column(0)[0].as_py(), row.column(1)[0].as_py()
                lengths = np.asarray(row.column(3).flatten())
                ids = unpack(row.column(4)[0].as_py())
                ends = np.cumsum(lengths)
                starts = ends - lengths
                if digest:
                    raw = ids.astype("<u4").tobytes()
                    last = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int64)))
                columns = [row.column(2).flatten(), pa.array(bases[part_no] + place + starts), pa.array(lengths), last]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"]
    kinds = [files.schema["doc_ids"].dataType.elementType, T.LongType(), T.LongType(), T.LongType() if digest else T.ArrayType(T.LongType())]
    return files.select(*FILE_COLUMNS).mapInArrow(lean(batches), T.StructType([T.StructField(c, k) for c, k in zip(names, kinds)]))
