"""What the piece coders encode anew, and what they look up."""

import numpy as np
import pyarrow as pa

from tallyloom.llm.pieces import MARK, PieceCoder, marked_texts
from tallyloom.llm.queries import piece_model
from tallyloom.llm.spans import SpanIds
from tallyloom.llm.textbytes import whole


def test_a_word_is_encoded_once_whatever_marks_follow_it():
    """No piece holds a letter and a comma, so the word and the comma are looked up by themselves."""
    import sentencepiece

    coder, asked = PieceCoder(piece_model()), []
    encode = coder._encode

    def counting(part, starts, ends):
        asked.extend(part.data[a:b].tobytes().decode() for a, b in zip(starts.tolist(), ends.tolist()))
        return encode(part, starts, ends)

    coder.spans.encode = counting
    texts = ["so thonre, thonre. thonre! (thonre) thonre7", "thonre\nthonre?  thonreß Thonre", "▁x ▁▁  é日本 thonre日", "", "日,日 ,", "\x00a\x7fb"]
    ids, counts = coder.encode(whole(marked_texts(pa.array(texts))))
    assert len(asked) == len(set(asked))
    assert [w for w in asked if w.startswith(" thonre")] == [" thonre"]
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    expected = [library.encode(t.replace(MARK, " ")) for t in texts]
    assert [len(e) for e in expected] == counts.tolist()
    assert [i for e in expected for i in e] == ids.tolist()


def test_many_spans_are_encoded_once_and_keep_their_ids():
    """700,000 spans in turn over 14 slices, and all of them again: none is encoded twice."""
    seen = []

    def encode(part, starts, ends):
        sizes = np.full(len(starts), 2)
        seen.append(len(starts))
        first = np.array([int(part.data[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())], np.int32)
        return np.repeat(first, 2), sizes

    spans = SpanIds(encode)
    for _ in range(2):
        for at in range(0, 700_000, 50_000):
            numbers = np.arange(at, at + 50_000)
            part = whole(pa.array([str(n) for n in numbers]))
            ids, counts = spans.lookup(part, part.begins[:-1], part.begins[1:])
            assert (counts == 2).all()
            assert (ids == np.repeat(numbers, 2)).all()
    assert sum(seen) == 700_000
