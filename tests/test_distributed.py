"""Distributed operators against plain numpy on small data, with ties and hot keys."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import kernels
from tallyloom.operators import anomaly, ordering, ranks, removal, skew, smoothing as sm


@pytest.fixture(scope="module")
def signal():
    rng = np.random.default_rng(7)
    return np.round(rng.uniform(0, 2, 400), 3)


@pytest.fixture(scope="module")
def sig(spark, signal):
    rows = [(int(i), float(v)) for i, v in enumerate(signal)]
    return ordering.with_position(spark.createDataFrame(rows, "row_id long, x double"), F.col("row_id").asc(), partitions=5)


def smooth_values(df):
    return np.array([r["smooth"] for r in df.orderBy("pos").collect()])


def test_positions_match_a_full_sort_with_many_ties(spark):
    df = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 3).cast("double").alias("x"))
    placed = ordering.with_position(df, F.col("x").desc(), F.col("row_id").desc(), partitions=7)
    rows = placed.df.orderBy("pos").collect()
    assert placed.n == 5000 and [r["pos"] for r in rows] == list(range(5000))
    assert [r["row_id"] for r in rows] == sorted(range(5000), key=lambda i: (-(i % 3), -i))


def test_blocks_do_not_show(sig, signal):
    weights = kernels.savgol_weights(7, 2)
    padded = np.pad(signal, 3, mode="edge")
    want = np.array([padded[i : i + 7] @ weights for i in range(len(signal))])
    for block in (16, 65536):
        near = ordering.neighbourhood(sig, "x", 3, "nearest", block).withColumn("smooth", sm._weighted(F.col("near"), weights))
        assert np.allclose(smooth_values(near), want, atol=1e-12)


def test_savgol_reproduces_polynomials():
    for window, degree in [(7, 2), (11, 2), (11, 3), (15, 3), (21, 6)]:
        t = np.arange(window) - window // 2
        for power in range(degree + 1):
            assert abs(np.dot(kernels.savgol_weights(window, degree), (t / 10.0) ** power) - (1.0 if power == 0 else 0.0)) < 1e-9


def test_median_pads_with_zero_and_trimmed_mean_shrinks(sig, signal):
    padded = np.pad(signal, 1)
    want = [np.median(padded[i : i + 3]) for i in range(len(signal))]
    assert np.allclose(smooth_values(sm.smooth_median(sig, 3)), want)
    want = []
    for i in range(len(signal)):
        w = np.sort(signal[max(0, i - 4) : i + 5])
        t = int(len(w) * 0.2)
        want.append(w[t : len(w) - t].mean())
    assert np.allclose(smooth_values(sm.smooth_trimmed_mean(sig, 9, 0.2)), want)


def test_short_signal_is_rejected(spark):
    short = ordering.with_position(spark.createDataFrame([(0, 1.0)], "row_id long, x double"), F.col("row_id").asc())
    with pytest.raises(ValueError, match="shorter"):
        sm.smooth_savgol(short, 7, 2)


def test_kalman_across_blocks(spark):
    rng = np.random.default_rng(1)
    z = rng.uniform(0, 2, 6000)
    long = ordering.with_position(spark.createDataFrame([(i, float(v)) for i, v in enumerate(z)], "row_id long, x double"), F.col("row_id").asc())
    for q, r in [(1e-3, 1e-2), (1e-4, 1e-2)]:
        x, p, want = z[0], 1.0, [z[0]]
        for value in z[1:]:
            p += q
            k = p / (p + r)
            x += k * (value - x)
            p *= 1 - k
            want.append(x)
        assert np.allclose(smooth_values(sm.smooth_kalman(long, q, r, block_rows=1)), want, atol=1e-12)


def second_difference_system(size, lam):
    diff = np.diff(np.eye(size), 2, axis=0)
    return np.eye(size) + lam * diff.T @ diff


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 9, 200])
def test_whittaker_factors_solve_the_system(size):
    y = np.random.default_rng(size).normal(size=size)
    for lam in (0.5, 50.0, 1000.0):
        want = np.linalg.solve(second_difference_system(size, lam), y)
        assert np.allclose(kernels.whittaker_solve(y, kernels.whittaker_factors(size, lam)), want, atol=1e-10)


def test_whittaker_across_blocks(spark):
    rng = np.random.default_rng(2)
    y = rng.uniform(0, 2, 1500)
    long = ordering.with_position(spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "row_id long, x double"), F.col("row_id").asc())
    for lam in (10.0, 1000.0):
        want = np.linalg.solve(second_difference_system(len(y), lam), y)
        assert np.allclose(smooth_values(sm.smooth_whittaker(long, lam, block_rows=300)), want, atol=1e-9)


def test_constant_signal_stays_constant(spark):
    flat = ordering.with_position(spark.range(300).select(F.col("id").alias("row_id"), F.lit(0.7).alias("x")), F.col("row_id").asc())
    for df in (sm.smooth_savgol(flat, 21, 6), sm.smooth_gaussian(flat), sm.smooth_kalman(flat), sm.smooth_whittaker(flat), sm.smooth_zero_phase_fir(flat), sm.smooth_wavelet(flat), sm.smooth_lowess(flat, 31)):
        assert np.allclose(smooth_values(df), 0.7, atol=1e-9)


def test_zero_phase_ends_equal_the_whole_solve(sig, signal):
    b = kernels.lowpass_taps(17, 0.15)
    assert np.allclose(smooth_values(sm.smooth_zero_phase_fir(sig)), sm._matched_ends(signal, b), atol=1e-9)


def test_wavelet_without_threshold_rebuilds_the_series(spark, sig, signal):
    current, details = ordering.Ordered(sig.df.select("pos", "x"), sig.n), []
    for _ in range(3):
        average, detail = sm._decompose(current)
        details.append((detail, current.n))
        current = average
    average = current.df
    for detail, n in reversed(details):
        average = sm._recompose(average, detail, n)
    assert np.allclose([r["x"] for r in average.orderBy("pos").collect()], signal, atol=1e-8)


@pytest.mark.parametrize("width,block_rows", [(21, 64), (5, 64), (121, 16), (201, 7)])
def test_lowess_against_a_row_loop(sig, signal, width, block_rows):
    n = len(signal)
    assert sm.LowessGrid(n, width, block_rows).far == (block_rows < 64)
    weight = np.ones(n)
    for step in range(3):
        fit = np.empty(n)
        for i in range(n):
            low = min(max(i - width // 2, 0), n - width)
            j = np.arange(low, low + width)
            u = np.abs(j - i) / max(i - low, low + width - 1 - i)
            w = np.where(u >= 0.999, 0, np.where(u <= 0.001, 1, (1 - u**3) ** 3)) * weight[j]
            fit[i] = np.polynomial.polynomial.polyfit(j - i, signal[j], 1, w=np.sqrt(w))[0]
        if step < 2:
            r = np.abs(signal - fit) / (6 * np.median(np.abs(signal - fit)))
            weight = np.where(r >= 0.999, 0, np.where(r <= 0.001, 1, (1 - r**2) ** 2))
    assert np.allclose(smooth_values(sm.smooth_lowess(sig, width, block_rows=block_rows)), fit, atol=1e-8)


@pytest.mark.parametrize("n,span,block_rows", [(700, 35, 64), (1500, 401, 32), (3000, 1201, 32), (2777, 1001, 1000), (101, 101, 8)])
def test_lowess_windows_are_sums_of_leaves(n, span, block_rows):
    """Long and short windows, leaves inside blocks and blocks inside leaves, with robust weights of 0."""
    rng = np.random.default_rng(n)
    y, w = np.cumsum(rng.normal(size=n)), np.where(rng.random(n) < 0.2, 0, rng.random(n))
    grid, pos = sm.LowessGrid(n, span, block_rows), np.arange(n)
    t = kernels.powers_of(grid.centred(pos))
    both = np.concatenate([t * w[:, None], t * (w * y)[:, None]], axis=1)
    leaves = np.add.reduceat(both, np.arange(0, n, grid.leaf), axis=0) if grid.far else None
    blocks = range(-(-n // grid.block))
    starts = {b: both[b * grid.block // grid.leaf * grid.leaf : b * grid.block].sum(axis=0) for b in blocks} if grid.leaf > grid.block else {}
    for c in blocks:
        raw = np.concatenate([np.arange(b * grid.block, min(n, (b + 1) * grid.block)) for b in sorted(grid.needed(c))])
        assert not grid.far or len(raw) <= 5 * grid.block
        for i, found in zip(range(c * grid.block, n), grid.fit(np.arange(c * grid.block, min(n, (c + 1) * grid.block)), raw, w[raw], y[raw], starts, leaves)):
            low = min(max(i - span // 2, 0), n - span)
            j = np.arange(low, low + span)
            u = np.abs(j - i) / max(i - low, low + span - 1 - i)
            k = np.where(u >= 0.999, 0, np.where(u <= 0.001, 1, (1 - u**3) ** 3)) * w[j]
            assert found == pytest.approx(np.polynomial.polynomial.polyfit(j - i, y[j], 1, w=np.sqrt(k))[0], abs=1e-7)


def test_quantiles_with_a_hot_value(spark, monkeypatch):
    monkeypatch.setattr(ranks, "LEAF_ROWS", 8)
    monkeypatch.setattr(ranks, "BITS", 2)
    rng = np.random.default_rng(3)
    data = np.concatenate([np.full(400, 1.25), rng.normal(0, 1e3, 300), np.exp(rng.normal(0, 20, 300))])
    df = spark.createDataFrame([(float(v),) for v in data], "v double").union(spark.createDataFrame([(None,), (math.nan,)], "v double"))
    shares = [0.0, 0.1, 0.5, 0.77, 0.975, 1.0]
    assert np.allclose(ranks.exact_quantiles(df, F.col("v"), shares), np.quantile(data, shares), rtol=1e-12)
    assert ranks.exact_quantiles(df.limit(0), F.col("v"), [0.5]) == [None]


@pytest.mark.parametrize("extra", [[math.inf] * 40 + [-math.inf] * 30, [1.7e308, -1.7e308, math.inf], [5e-324, 0.0, -5e-324] * 9, [-math.inf] * 200])
def test_quantiles_with_infinite_huge_and_tiny_keys(spark, monkeypatch, extra):
    monkeypatch.setattr(ranks, "LEAF_ROWS", 4)
    rng = np.random.default_rng(8)
    data = np.concatenate([extra, rng.normal(size=60), [1.0] * 20])
    df = spark.createDataFrame([(float(v),) for v in data], "v double")
    places = list(range(0, len(data), 7)) + [len(data) - 1]
    found = ranks.locate_ranks(df, F.col("v"), [(None, p) for p in places])
    ordered = np.sort(data)
    for p, f in zip(places, found):
        assert (f.value, f.less, f.equal) == (ordered[p], (data < ordered[p]).sum(), (data == ordered[p]).sum())


def test_ranks_of_ids_beyond_doubles(spark, monkeypatch):
    monkeypatch.setattr(ranks, "LEAF_ROWS", 2)
    ids = [2**53 + i for i in range(9)] + [2**63 - 1, -(2**63), -(2**63) + 1, 0]
    df = spark.createDataFrame([(i, 1.0) for i in ids], "row_id long, score double")
    found = ranks.locate_ranks(df, F.col("row_id"), [(None, r) for r in range(len(ids))])
    assert [f.value for f in found] == sorted(ids)
    for k in range(1, len(ids)):
        cut = ranks.top_cuts(df, F.col("score"), F.col("row_id"), [(None, k)])[0]
        kept = {r["row_id"] for r in df.where(ranks.in_top(F.col("score"), F.col("row_id"), cut)).collect()}
        assert kept == set(sorted(ids)[-k:])


def test_many_targets_share_the_driver(spark, monkeypatch):
    monkeypatch.setattr(ranks, "MOST_ROWS", 4_000)
    df = spark.range(40_000).select((F.col("id") % 2_000).cast("string").alias("g"), F.col("id").cast("double").alias("v"))
    found = ranks.locate_ranks(df, F.col("v"), [(str(g), 7) for g in range(2_000)], F.col("g"))
    assert [f.value for f in found] == [float(7 * 2_000 + g) for g in range(2_000)]


def test_top_cuts_with_ties(spark, monkeypatch):
    monkeypatch.setattr(ranks, "LEAF_ROWS", 4)
    monkeypatch.setattr(ranks, "BITS", 1)
    rng = np.random.default_rng(4)
    rows = [(i, float(rng.integers(0, 4)), "ab"[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, score double, g string")
    sizes = [("a", 0), ("a", 1), ("a", 70), ("b", 149), ("b", 500), ("c", 3)]
    for (g, k), cut in zip(sizes, ranks.top_cuts(df, F.col("score"), F.col("row_id"), sizes, F.col("g"))):
        mine = sorted((r for r in rows if r[2] == g), key=lambda r: (-r[1], -r[0]))[:k]
        found = df.where((F.col("g") == g) & ranks.in_top(F.col("score"), F.col("row_id"), cut)).collect()
        assert {r["row_id"] for r in found} == {r[0] for r in mine}


def test_class_aware_removal_equals_the_walk(spark):
    rng = np.random.default_rng(5)
    for _ in range(3):
        train = [(i, str(rng.choice(["a", "b", "c"], p=[0.6, 0.3, 0.1])), float(rng.integers(0, 6))) for i in range(80)]
        pool = [r for r in train if rng.random() < 0.5]
        counts = {c: sum(r[1] == c for r in train) for c in "abc"}
        wanted = [(share, keep) for share in (0.1, 0.5, 1.0) for keep in (0, 5, 30)]
        df = spark.createDataFrame(pool, "row_id long, category string, score double")
        for (share, keep), drop in zip(wanted, removal.class_aware_removal(counts, df, "score", wanted)):
            left, gone = dict(counts), set()
            for r in sorted(pool, key=lambda r: (-r[2], -r[0])):
                if left[r[1]] - 1 >= keep:
                    left[r[1]] -= 1
                    gone.add(r[0])
                    if len(gone) >= int(len(pool) * share):
                        break
            assert {r["row_id"] for r in df.where(drop).collect()} == gone


def test_salted_join_equals_a_plain_join(spark):
    left = spark.range(3000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 500).cast("string")).alias("k"))
    right = spark.range(400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")).union(spark.createDataFrame([("hot", -1)], "k string, v long"))
    for how in ("inner", "left"):
        a = skew.salted_join(left, right, ["k"], "row_id", how).select("row_id", "k", "v")
        b = left.join(right, "k", how).select("row_id", "k", "v")
        assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_linear_error_matches_numpy_and_forest_finds_outliers(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 5)) * [5, 3, 1, 0.2, 0.1]
    x[:6] += 40
    df = spark.createDataFrame([(i, v.tolist(), "a") for i, v in enumerate(x)], "row_id long, embedding array<double>, category string")
    centred = x - x.mean(0)
    _, _, v = np.linalg.svd(centred, full_matrices=False)
    want = ((centred - centred @ v[:2].T @ v[:2]) ** 2).mean(1)
    found = {r["row_id"]: r["recon_error"] for r in anomaly.linear_recon_error(df, rank=2)[0].collect()}
    assert np.allclose([found[i] for i in range(300)], want)
    gone = {r["row_id"] for r in anomaly.isolation_forest_by_class(df, 0.02, trees=50).collect()}
    assert gone == set(range(6))
    errors = [r["recon_error"] for r in anomaly.autoencoder_recon_error(df, epochs=3, hidden=(8, 2, 8))[0].collect()]
    assert len(errors) == 300 and all(e > 0 for e in errors)


def test_network_learns_from_mini_batches(spark, monkeypatch):
    """As good as the same steps in plain numpy, better than as many steps on all rows, and close when tasks are averaged."""
    rng = np.random.default_rng(8)
    x = np.tanh(rng.normal(size=(1000, 2)) @ rng.normal(size=(2, 6)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "row_id long, embedding array<double>").repartition(4)
    options = {"hidden": (16, 3, 16), "epochs": 30, "rate": 3e-3, "tol": 0.0}

    def mean_error(**more):
        return np.mean([r["recon_error"] for r in anomaly.autoencoder_recon_error(df, **{**options, **more})[0].collect()])

    net = anomaly._Network((6, 16, 3, 16, 6), 3e-3, 1e-4)
    state, step = np.stack([net.start(42), np.zeros(net.size), np.zeros(net.size)]), 0
    for _ in range(30):
        for part in np.array_split(rng.permutation(1000), 5):
            step += 1
            state = net.learn(state, step, x[part])[1]
    want = ((x - anomaly._forward(x, net.layers(state[0]))[-1]) ** 2).mean()
    one = mean_error(batch=200)
    assert abs(one - want) < 0.25 * want and one < mean_error(batch=1000)
    monkeypatch.setattr(anomaly, "EPOCH_ROWS", 250)
    assert mean_error(batch=50) < mean_error(batch=1000)
    few = mean_error(epochs=120, tol=10.0, patience=2)
    assert few > one  # two epochs without progress end it


def test_network_gradient(spark):
    net, x = anomaly._Network((4, 5, 2, 4), 1e-3, 0.0), np.random.default_rng(9).normal(size=(7, 4))
    flat = net.start(1)
    _, g = net.gradient(flat, x)
    half = lambda v: ((anomaly._forward(x, net.layers(v))[-1] - x) ** 2).sum() / 2 / len(x)
    for i in range(0, net.size, 7):
        step = np.zeros(net.size)
        step[i] = 1e-6
        assert (half(flat + step) - half(flat - step)) / 2e-6 == pytest.approx(g[i], abs=1e-6)
