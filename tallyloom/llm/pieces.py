"""SentencePiece encoding and decoding with a shared-prefix Viterbi pass.

Text is marked (a blank becomes the mark, one mark goes in front) and cut before each run of marks: no
piece of a fitting vocabulary crosses such a place. It is also cut between characters that stand side by side in
no piece, as a letter and a comma mostly do. The distinct words of a slice are sorted, which walks their trie
depth-first, and the forward value of every prefix is computed once for all words that share it.

For a unigram model the forward value is the best total score and the last piece of that segmentation.
A BPE model has no such sum: its segmentation is the one in which every two neighbours, encoded
together, stay these two pieces. There is exactly one, for each prefix too, so the forward value is the
last piece of the prefix and a step is admitted by looking at two neighbours only.

Characters outside the vocabulary fall back to byte pieces. Words are remembered in a bounded
dictionary; texts are never cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.session import kept, lean
from tallyloom.llm.spans import SpanIds, span_bytes
from tallyloom.llm.textbytes import IS_START, Slice, slices

MARK = "▁"
SLICE_BYTES = 1 << 20
MAX_NEIGHBOURS = 1 << 18
IDS = "ids"
CODER = "piece coder"


def _model_type(proto: bytes) -> int:
    """``trainer_spec.model_type`` of a serialized model (fields 2 and 3): 1 unigram, 2 BPE; 1 if absent."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    def fields() -> Iterator[tuple[int, int | bytes]]:
        at = 0
        while at < len(data):
            key, at = varint(at)
            if key & 7 == 0:
                value, at = varint(at)
            else:
                size, at = varint(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
                value, at = data[at : at + size], at + size
            yield key >> 3, value

    data = proto
    for spec in [v for f, v in fields() if f == 2]:
        data = spec
        return next((v for f, v in fields() if f == 3), 1)
    return 1


class Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece model."""

    def __init__(self, model: bytes):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = processor.get_piece_size()
        special = [processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i) for i in range(n)]
        is_byte = [processor.is_byte(i) for i in range(n)]
        names = [processor.id_to_piece(i) for i in range(n)]
        self.unigram = _model_type(model) == 1
        self.unknown = processor.unk_id()
        self.ids = {names[i]: i for i in range(n) if not special[i] and not is_byte[i]}
        self.scores = {p: processor.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = {int(names[i][1:-1], 16): i for i in range(n) if is_byte[i]}
        self.begins = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece of this vocabulary crosses a word boundary")
        #: Bytes that each id stands for.
        self.content = [b"" if special[i] else bytes([int(names[i][1:-1], 16)]) if is_byte[i] else names[i].replace(MARK, " ").encode() for i in range(n)]
        self.content[self.unknown] = b" \xe2\x81\x87 "
        #: Bytes that follow each other in some piece: no piece crosses the place between two others.
        self.meet = np.zeros((256, 256), bool)
        for piece in self.ids:
            inside = np.frombuffer(piece.replace(MARK, " ").encode(), np.uint8)
            self.meet[inside[:-1], inside[1:]] = True

    def fallback(self, char: str) -> list[int]:
        if self.byte_ids:
            return [self.byte_ids[b] for b in char.encode()]
        return [self.unknown]


class PieceBytes:
    """The bytes that each id of a vocabulary stands for, all that decoding needs."""

    def __init__(self, content: list[bytes]):
        self.lengths, self.bytes = np.array([len(c) for c in content], np.int64), np.frombuffer(b"".join(content), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Bytes of the texts with ``counts`` ids each, without the mark in front."""
        n = self.lengths[ids]
        shift = self.offsets[ids] - np.concatenate([[0], np.cumsum(n)])[:-1]
        joined = self.bytes[np.repeat(shift, n) + np.arange(n.sum())].tobytes()
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(counts)]
        starts = np.concatenate([[0], ends])[:-1]
        return [joined[a + (joined[a : a + 1] == b" " and b > a) : b] for a, b in zip(starts.tolist(), ends.tolist())]


class PieceCoder:
    """Encodes words in sorted order, keeping the forward values of the current path in the trie."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        self.neighbours: dict[tuple[str, str], bool] = {}
        self.moves: dict[str, tuple[str, list[str]]] = {}
        self.spans = SpanIds(self._encode)
        self.decode = PieceBytes(self.vocabulary.content).decode

    def merged(self, text: str) -> list[str]:
        """Plain BPE: merge the neighbours whose union has the best score, the leftmost first."""
        parts, scores = list(text), self.vocabulary.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stay(self, left: str, right: str) -> bool:
        if len(self.neighbours) >= MAX_NEIGHBOURS:
            self.neighbours.clear()
        known = self.neighbours[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def _move(self, state: str, char: str) -> tuple[str, list[str]]:
        """(longest end of ``state`` and ``char`` that begins a piece, the pieces that end there, longest first)."""
        if len(self.moves) >= MAX_NEIGHBOURS:
            self.moves.clear()
        ids, begins = self.vocabulary.ids, self.vocabulary.begins
        to = state + char
        while len(to) > 1 and to not in begins:
            to = to[1:]
        ending = [to[i:] for i in range(len(to)) if to[i:] in ids or i == len(to) - 1]
        known = self.moves[state + char] = (to if to in begins else "", ending)
        return known

    def _forward_bpe(self, ending: list[str], end: int, last: list[str]) -> str:
        stays = self.neighbours.get
        for piece in ending:
            left = last[end - len(piece)]
            known = stays((left, piece))
            if known or known is None and self._stay(left, piece):
                return piece
        raise AssertionError("no segmentation")

    def _forward_unigram(self, ending: list[str], end: int, best: list[float]) -> tuple[float, str]:
        scores = self.vocabulary.scores
        found, piece = -np.inf, ending[-1]
        for one in ending:
            score = best[end - len(one)] + scores.get(one, self.floor)
            if score > found:
                found, piece = score, one
        return found, piece

    def words(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """Each word, in sorted order, with its pieces."""
        unigram = self.vocabulary.unigram
        if unigram:
            self.floor = min(self.vocabulary.scores.values(), default=0.0) - 10.0
        last, best, states, before = [""], [0.0], [""], ""
        moves, forward = self.moves.get, self._forward_bpe
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], best[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for end, char in enumerate(word[shared:], shared + 1):
                state, ending = moves(state + char) or self._move(state, char)
                states.append(state)
                if unigram:
                    score, piece = self._forward_unigram(ending, end, best)
                    best.append(score)
                else:
                    piece = forward(ending, end, last)
                last.append(piece)
            pieces, end = [], len(word)
            while end:
                pieces.append(last[end])
                end -= len(last[end])
            before = word
            yield word, pieces[::-1]

    def _encode(self, part: Slice, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        marked = [s.decode().replace(" ", MARK) for s in span_bytes(part, starts, ends)]
        found: dict[str, list[int]] = {}
        own = self.vocabulary.ids.get
        for word, pieces in self.words(marked):
            ids = [own(piece) for piece in pieces]
            if None in ids:
                ids = [i for piece in pieces for i in ([own(piece)] if own(piece) is not None else self.vocabulary.fallback(piece))]
            found[word] = ids
        runs = [found[m] for m in marked]
        return np.array([i for r in runs for i in r], np.int32), np.array([len(r) for r in runs], np.int64)

    def encode(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a slice, which begin with the blank of the mark, and their number by text."""
        data = part.data
        blank = data == 0x20
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = IS_START[data[1:]] & ~self.vocabulary.meet[data[:-1], data[1:]] & ~blank[1:]
        cut[1:-1] |= blank[1:] & ~blank[:-1]
        filled = np.flatnonzero(np.diff(part.begins))
        cut[part.begins[:-1][filled]] = True
        starts = np.flatnonzero(cut[: len(data)])
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        ids, counts = self.spans.lookup(part, starts, ends)
        return ids, np.bincount(part.owner(starts), weights=counts, minlength=part.rows).astype(np.int64)


def piece_coder(model: bytes) -> PieceCoder:
    """The coder of a model, kept by this worker until it gets a task that codes no pieces."""
    return kept(CODER, sha256(model).digest(), lambda: PieceCoder(model))


def marked_texts(column: pa.Array) -> pa.Array:
    """Texts as the model sees them: a mark in the text reads as a blank, and a blank goes in front."""
    texts = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), MARK, " ")
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))


def _encoded(coder: PieceCoder, column: pa.Array) -> Iterator[tuple[Slice, np.ndarray, np.ndarray]]:
    for part in slices(marked_texts(column), SLICE_BYTES):
        yield part, *coder.encode(part)


def encode_pieces(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` with the column ``ids``: the piece ids of the whole text.

    A null or empty text has no ids. Rows are encoded alone, so null ids and repeated rows need no rule;
    other columns pass through, one named ``ids`` is replaced. One scan, no shuffle.
    """
    docs = docs.drop(IDS)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(shared.value)
        for batch in source:
            for part, ids, counts in _encoded(coder, batch.column(batch.schema.get_field_index(text))):
                rows = batch.slice(part.first_row, part.rows)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], [*batch.schema.names, IDS])

    return docs.mapInArrow(lean(batches, CODER), T.StructType([*docs.schema.fields, T.StructField(IDS, T.ArrayType(T.IntegerType()))]))


def decode_pieces(encoded: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``encoded`` with ``text`` read from ``ids``; null or empty ids give an empty text, bytes that are no
    UTF-8 the replacement character."""
    encoded = encoded.drop(text)
    shared = encoded.sparkSession.sparkContext.broadcast(PieceBytes(Vocabulary(model).content))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for batch in source:
            for lo in range(0, batch.num_rows, 1024):
                rows = batch.slice(lo, 1024)
                lists = rows.column(batch.schema.get_field_index(IDS))
                counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
                texts = [t.decode(errors="replace") for t in coder.decode(np.asarray(lists.flatten()), counts)]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], [*batch.schema.names, text])

    return encoded.mapInArrow(lean(batches, CODER), T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())]))


def piece_digests(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_ids, ids_crc32, decoded_sha256): encode and decode every whole text, and digest both sides."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [doc_id, "n_ids", "ids_crc32", "decoded_sha256"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(shared.value)
        for batch in source:
            for part, ids, counts in _encoded(coder, batch.column(1)):
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                hashes = [sha256(t).hexdigest() for t in coder.decode(ids, counts)]
                rows = batch.column(0).slice(part.first_row, part.rows)
                yield pa.RecordBatch.from_arrays([rows, pa.array(counts), pa.array(crcs, pa.int64()), pa.array(hashes, pa.string())], names)

    kinds = [docs.schema[doc_id].dataType, T.LongType(), T.LongType(), T.StringType()]
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(lean(batches, CODER), T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))
