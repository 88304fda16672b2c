"""What a Python worker, which Spark keeps from task to task, goes on holding."""

import pickle
import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa

from tallyloom.llm.textbytes import BASES, Powers, Rolling, inverse


def test_hashing_leaves_nothing_behind():
    values = np.arange(1 << 20, dtype=np.uint64)
    tracemalloc.start()
    try:
        for base in BASES:
            Rolling(values, base).spans(np.array([0, 5]), np.array([3, 1 << 20]))
        assert tracemalloc.get_traced_memory()[0] < 1 << 20
    finally:
        tracemalloc.stop()


def test_powers_across_the_short_tables():
    for n in (0, 1, 1023, 1024, 1025, 5000):
        for base in (*BASES, inverse(BASES[0])):
            powers = Powers(base, n + 1)
            expected = [pow(base, i, 2**64) for i in range(n + 1)]
            assert powers.all().tolist() == expected
            assert powers.at(np.arange(n + 1)).tolist() == expected


def test_spans_of_equal_content_hash_alike_wherever_they_are():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    values[3000:4500] = values[10:1510]
    hashes = Rolling(values)
    starts = np.array([10, 500, 1023])
    ends = np.array([1510, 501, 1100])
    assert (hashes.spans(starts, ends) == hashes.spans(starts + 2990, ends + 2990)).all()
    assert hashes.spans(np.array([0]), np.array([7]))[0] != hashes.spans(np.array([1]), np.array([8]))[0]


def test_the_join_does_not_load_pandas():
    code = "import sys, tallyloom.llm.jaccard_join; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code]).returncode == 0


def test_a_coder_goes_when_its_worker_does_something_else():
    from tallyloom.llm import session
    from tallyloom.llm.pieces import CODER, piece_coder
    from tallyloom.llm.queries import piece_model

    coder = piece_coder(piece_model())
    assert piece_coder(piece_model()) is coder
    none = iter([pa.RecordBatch.from_pydict({"a": [1]})])
    assert len(list(session.lean(lambda source: source, CODER)(none))) == 1
    assert piece_coder(piece_model()) is coder
    list(session.lean(lambda source: source)(none))
    assert CODER not in session._kept


def test_decoding_needs_only_the_bytes_of_the_ids():
    from tallyloom.llm.pieces import PieceBytes, PieceCoder, marked_texts
    from tallyloom.llm.queries import piece_model
    from tallyloom.llm.textbytes import whole

    coder = PieceCoder(piece_model())
    table = pickle.dumps(PieceBytes(coder.vocabulary.content))
    assert len(table) < 2 << 20
    texts = ["so thonre, thonre", "", "\x00 é日本", "a"]
    ids, counts = coder.encode(whole(marked_texts(pa.array(texts))))
    assert [t.decode() for t in pickle.loads(table).decode(ids, counts)] == texts
