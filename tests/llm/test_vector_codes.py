"""Vector codes against plain numpy, the grid's bounds, and edge cases."""

import numpy as np
import pytest

from tallyloom.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, code int, _label string"


def brute(books, vectors):
    parts, _, width = books.entries.shape
    d = [np.square(vectors[:, None, i * width : (i + 1) * width] - books.entries[i]).sum(axis=2) for i in range(parts)]
    return np.stack([x.argmin(axis=1) for x in d], axis=1), np.stack([x.min(axis=1) for x in d], axis=1)


@pytest.mark.parametrize("across,most,spread", [(8, 30_000, 40), (3, 200, 4), (40, 30_000, 3), (8, 30_000, 0)])
def test_cells_find_the_lowest_nearest_entry(across, most, spread):
    rng = np.random.default_rng(1)
    entries = rng.integers(-spread, spread + 1, (64, 4))
    rows = rng.integers(-3 * spread - 1, 3 * spread + 2, (5000, 4))
    cells = vc.Cells(entries, across, most)
    d = np.square(rows[:, None] - entries).sum(axis=2)
    for _ in range(2):
        index, least = cells.nearest(rows)
        assert (index == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
    assert len(cells.keys) <= max(most, 5000)


def test_cells_that_share_a_hash(monkeypatch):
    rng = np.random.default_rng(2)
    entries, rows = rng.integers(-40, 40, (16, 4)), rng.integers(-60, 60, (500, 4))
    cells = vc.Cells(entries)
    monkeypatch.setattr(cells, "hashed", lambda c: (c[:, 0] % 3).astype(np.uint64))
    d = np.square(rows[:, None] - entries).sum(axis=2)
    assert (cells.nearest(rows)[0] == d.argmin(axis=1)).all()


def test_a_known_cell_is_not_computed_again():
    entries = np.arange(64).reshape(16, 4)
    cells = vc.Cells(entries)
    cells.nearest(entries)
    cells.learn = None
    assert (cells.nearest(entries)[0] == np.arange(16)).all()


def test_codebooks_and_codes_match_numpy(spark):
    rng = np.random.default_rng(3)
    ids = rng.permutation(400)
    floats = rng.normal(0, 0.2, (400, 32))
    floats[7], floats[8] = floats[9], 0.0
    rows = [(int(i), v.tolist(), int(i) % 3, 5, "x") for i, v in zip(ids, floats)]
    coded, books = vc.compress_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5), parts=8, entries=20, rounds=3)
    whole = np.floor(floats * 256).astype(np.int64)[np.argsort(ids)]
    wanted = vc.Codebooks(whole[:20].reshape(20, 8, 4).transpose(1, 0, 2).copy())
    for _ in range(3):
        codes, _ = brute(wanted, whole)
        for p in range(8):
            for e in range(20):
                mine = whole[codes[:, p] == e, p * 4 : p * 4 + 4]
                if len(mine):
                    wanted.entries[p, e] = mine.sum(axis=0) // len(mine)
    assert (books.entries == wanted.entries).all()
    codes, d = brute(wanted, whole)
    found = {r["vec_id"]: r for r in coded.collect()}
    assert len(found) == 400
    for i in range(400):
        assert found[i]["code"] == "".join(f"{c:02x}" for c in codes[i]) and found[i]["error"] == d[i].sum()
        assert found[i]["label_error"] == d[np.arange(400) % 3 == i % 3].sum() and found[i]["_label"] == "x"


def test_unusable_and_repeated_vectors(spark):
    good, nan, inf = [0.5] * 16, float("nan"), float("inf")
    rows = [
        (1, good, 0), (1, good, 0), (None, [0.25] * 16, None), (2, None, 1), (3, [nan] + good[1:], 1), (4, [inf] + good[1:], 1),
        (5, [None] + good[1:], 1), (6, [], 2), (7, good[:8], None), (8, [1e300] + good[1:], None), (9, [0.5] * 32, 3),
    ]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)
    coded, books = vc.compress_vectors(df)
    found = sorted(coded.collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0))
    assert [r["vec_id"] for r in found] == [1, 1, 6, 7, 8, 9, None]
    assert books.entries.shape == (16, 2, 1)
    assert [r["code"] for r in found] == ["00" + "01" * 15] * 2 + [None, None, "01" * 16, None, "00" * 16]
    assert [r["label_error"] for r in found] == [2 * 22**2] * 2 + [None, 42**2, 42**2, None, 42**2]
    empty, none = vc.compress_vectors(df.limit(0))
    assert empty.collect() == [] and none is None
    assert vc.compress_vectors(df.where("vec_id = 6"))[0].first()["code"] is None
    with pytest.raises(ValueError):
        vc.learn_codebooks(df, entries=257)


def test_many_labels_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vc, "MAX_BROADCAST_LABELS", 1)
    rows = [(i, [i / 100] * 16, None if i % 4 == 0 else i % 4, 0, "x") for i in range(100)]
    coded, _ = vc.compress_vectors(spark.createDataFrame(rows, SCHEMA), entries=5)
    found = coded.collect()
    assert len(found) == 100
    for label in {r["label"] for r in found}:
        assert {r["label_error"] for r in found if r["label"] == label} == {sum(r["error"] for r in found if r["label"] == label)}
