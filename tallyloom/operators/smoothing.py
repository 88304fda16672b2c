"""Smoothers over an ordered signal.

Fixed-window filters are expressions over the neighbour array of ``ordering.neighbourhood``. The
recursive and the penalised smoother run per block in numpy, with as many rows of context as it
takes for the cut to vanish in double precision; no block depends on another block's result.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import kernels
from tallyloom.functions.columns import base_score
from tallyloom.operators.ordering import BLOCK_ROWS, Ordered, neighbourhood, with_blocks, with_position
from tallyloom.operators.ranks import exact_quantiles, key_bounds, locate_ranks
from tallyloom.runtime import join_rows, literal_table, materialise


def scored_signal(noise: DataFrame, flag: str | None = "flagged_suspicious", order: str = "score", keep: tuple[str, ...] = ()) -> Ordered:
    """Base score per row, placed by descending score (ties: descending row id) or by row id."""
    score = base_score(F.col("true_label_prob"), F.col(flag) if flag and flag in noise.columns else None)
    sig = noise.select("row_id", *keep, F.round(score, 9).alias("x"))
    if order == "score":
        return with_position(sig, F.col("x").desc(), F.col("row_id").desc())
    return with_position(sig, F.col("row_id").asc())


def _weighted(values: Column, weights: list[float]) -> Column:
    products = F.zip_with(values, F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def weighted_window(sig: Ordered, weights: list[float], out: str, value: str = "x") -> DataFrame:
    half = len(weights) // 2
    if sig.n < len(weights):
        raise ValueError(f"signal of {sig.n} rows is shorter than the window of {len(weights)}")
    return neighbourhood(sig, value, half, "nearest").withColumn(out, _weighted(F.col("near"), weights)).drop("near")


def smooth_savgol(sig: Ordered, window: int, degree: int, out: str = "smooth", value: str = "x") -> DataFrame:
    return weighted_window(sig, kernels.savgol_weights(window, degree), out, value)


def smooth_gaussian(sig: Ordered, sigma: float = 2.0, out: str = "smooth", value: str = "x") -> DataFrame:
    return weighted_window(sig, kernels.gaussian_weights(sigma), out, value)


def smooth_median(sig: Ordered, kernel: int = 7, out: str = "smooth", value: str = "x") -> DataFrame:
    half = kernel // 2
    near = neighbourhood(sig, value, half, "zero")
    return near.withColumn(out, F.element_at(F.array_sort("near"), half + 1)).drop("near")


def smooth_trimmed_mean(sig: Ordered, kernel: int = 9, trim: float = 0.2, out: str = "smooth", value: str = "x") -> DataFrame:
    near = neighbourhood(sig, value, kernel // 2, "shrink")
    size = F.size("near")
    cut = F.floor(size * F.lit(trim)).cast("int")
    cut = F.when(cut * 2 >= size, 0).otherwise(cut)
    kept = F.slice(F.array_sort("near"), cut + 1, size - 2 * cut)
    mean = F.aggregate(kept, F.lit(0.0), lambda total, x: total + x) / F.size(kept)
    return near.withColumn(out, mean).drop("near")


def smooth_zero_phase_fir(sig: Ordered, taps: int = 17, cutoff: float = 0.15, out: str = "smooth", value: str = "x") -> DataFrame:
    """Low-pass run forward and backward.

    Inside it is one symmetric window. Within two filter lengths of an end the start states are chosen
    so that both running orders agree; that takes only the end values, a fixed small number of them.
    """
    b = kernels.lowpass_taps(taps, cutoff)
    reach = 4 * taps
    half = taps - 1
    near = neighbourhood(sig, value, half, "nearest").withColumn(out, _weighted(F.col("near"), kernels.zero_phase_weights(taps, cutoff)))
    ends = sig.df.where((F.col("pos") < reach) | (F.col("pos") >= sig.n - reach)).select("pos", value).collect()
    ends = sorted((r["pos"], r[value]) for r in ends)
    smooth = _matched_ends(np.array([v for _, v in ends]), b)
    edge = {}
    for (pos, _), v in zip(ends, smooth):
        if pos < 2 * taps or pos >= sig.n - 2 * taps or sig.n <= 2 * reach:
            edge[pos] = float(v)
    keys = F.array(*[F.lit(p).cast("long") for p in edge])
    fixed_ends = F.map_from_arrays(keys, F.array(*[F.lit(v) for v in edge.values()]))
    inside = (F.col("pos") >= 2 * taps) & (F.col("pos") < sig.n - 2 * taps) & F.lit(sig.n > 2 * reach)
    return near.withColumn(out, F.when(inside, F.col(out)).otherwise(fixed_ends[F.col("pos")])).drop("near")


def _matched_ends(x: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Forward-backward filtering with the start states that make it equal backward-forward filtering."""
    n, order = len(x), len(b) - 1
    run = lambda v: np.apply_along_axis(lambda c: np.convolve(c, b)[:n], 0, v)
    back = lambda v: run(v[::-1])[::-1]
    response = np.eye(n, order)  # output caused by each start state alone
    states = np.hstack([back(response) - response, response[::-1] - run(response[::-1])])
    effect = np.hstack([back(response), response[::-1]])
    first, second = back(run(x[:, None]))[:, 0], run(back(x[:, None]))[:, 0]
    start = np.linalg.lstsq(states, second - first, rcond=None)[0]
    return first + effect @ start


def smooth_kalman(sig: Ordered, q: float = 1e-4, r: float = 1e-2, out: str = "smooth", value: str = "x", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Random-walk filter. The gain depends on the position only, and old rows fade out geometrically."""
    gains = kernels.kalman_gains(q, r)
    memory = kernels.kalman_memory(gains)
    rows = max(block_rows, 4 * memory)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        z, first = block[value].to_numpy(), int(block["pos"].iloc[0])
        steps = np.minimum(np.arange(first, first + len(z)), len(gains)) - 1
        k = gains[np.maximum(steps, 0)]
        estimate = kernels.kalman_scan(z, k, memory)
        return block.assign(**{out: estimate})[block["core"]].drop(columns=["block", "core"])

    blocks = with_blocks(sig, memory, 0, rows)
    return _per_block(blocks, run, sig, out)


@lru_cache(maxsize=8)
def _whittaker_factors(size: int, lam: float) -> tuple[list[float], list[float], list[float]]:
    return kernels.whittaker_factors(size, lam)


def smooth_whittaker(sig: Ordered, lam: float = 50.0, out: str = "smooth", value: str = "x", block_rows: int | None = None) -> DataFrame:
    """Penalised least squares with second differences: a banded factorisation per block, with a halo on both sides."""
    halo = kernels.whittaker_halo(lam)
    rows = block_rows or max(BLOCK_ROWS, 4 * halo)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        smooth = kernels.whittaker_solve(block[value].to_numpy(), _whittaker_factors(len(block), lam))
        return block.assign(**{out: smooth})[block["core"]].drop(columns=["block", "core"])

    return _per_block(with_blocks(sig, halo, halo, rows), run, sig, out)


def _per_block(blocks: DataFrame, run, sig: Ordered, out: str) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sig.df.schema.fields)
    return blocks.groupBy("block").applyInPandas(run, f"{fields}, `{out}` double")


def delta_sigma(sig: Ordered, value: str = "x") -> DataFrame:
    """Difference to the previous row in the order (0 for the first) and its square."""
    near = neighbourhood(sig, value, 1, "nearest")
    step = F.element_at("near", 2) - F.element_at("near", 1)
    return near.withColumn("noise_delta", step).withColumn("noise_delta_sq", F.col("noise_delta") * F.col("noise_delta")).drop("near")


def residual_features(sig: Ordered, window: int = 21, degree: int = 6) -> DataFrame:
    """raw, smooth and raw minus smooth."""
    smooth = smooth_savgol(sig, window, degree, "noise_smooth")
    return smooth.withColumnRenamed("x", "noise_raw").withColumn("noise_resid", F.col("noise_raw") - F.col("noise_smooth"))


def signal_medians(train: DataFrame, columns: list[str]) -> dict[str, float]:
    """Training medians, used as constants on validation rows. All columns are searched together."""
    rows = materialise(train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("x")) for c in columns])).alias("v")).select("v.*"), "medians")
    bounds = key_bounds(rows, F.col("x"), F.col("name"))
    targets = [(c, r) for c in columns if c in bounds for r in sorted({(bounds[c][2] - 1) // 2, bounds[c][2] // 2})]
    places = locate_ranks(rows, F.col("x"), targets, F.col("name"), bounds)
    found: dict[str, list[float]] = {}
    for (c, _), place in zip(targets, places):
        found.setdefault(c, []).append(place.value)
    return {c: found[c][0] + (found[c][-1] - found[c][0]) / 2 if c in found else None for c in columns}


def with_constants(valid: DataFrame, values: dict[str, float]) -> DataFrame:
    return valid.withColumns({c: F.lit(v) for c, v in values.items()})


def residual_injection(sig: Ordered, factor: float = 0.2) -> DataFrame:
    return residual_features(sig).withColumn("resid_injected", F.lit(factor) * F.col("noise_resid")).drop("noise_raw", "noise_smooth", "noise_resid")


def lowess_span(n: int) -> int:
    """The published share of all rows, a twentieth, as an odd number of rows."""
    return 2 * int(0.025 * n) + 1


#: Rows of one block of the local regression, and leaves in half a window.
LOWESS_BLOCK = 16_384
LEAVES = 8


class LowessGrid:
    """Where windows begin and end, and how rows are cut into leaves (moments) and blocks (tasks).

    A leaf is about an eighth of half a window. Blocks are whole leaves, or leaves whole blocks. Windows longer than
    a block are summed from leaf moments, so a block needs raw rows only around its own, its windows' first and last places.
    """

    def __init__(self, n: int, span: int, block_rows: int):
        self.n, self.half = n, span // 2
        self.width = 2 * self.half + 1
        size = max(1, self.half // LEAVES)
        if size >= block_rows:
            self.block, self.leaf = block_rows, block_rows * (size // block_rows)
        else:
            self.block, self.leaf = size * max(1, block_rows // size), size
        self.far = self.half > self.block

    def windows(self, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first place, place after the last, bandwidth) of the rows with a positive tricube weight."""
        low = np.clip(pos - self.half, 0, self.n - self.width)
        h = np.maximum(pos - low, low + self.width - 1 - pos)
        reach = np.ceil(0.999 * h).astype(np.int64) - 1
        return np.maximum(low, pos - reach), np.minimum(low + self.width, pos + reach + 1), h.astype(float)

    def needed(self, block: int) -> set[int]:
        """Blocks whose raw rows the rows of ``block`` need."""
        ends = np.array([block * self.block, min((block + 1) * self.block, self.n) - 1])
        low, high, _ = self.windows(ends)
        last = (self.n - 1) // self.block
        at = lambda p: min(max(int(p) // self.block, 0), last)
        if not self.far:
            return set(range(at(low[0]), at(high[1]) + 1))
        return {block, *range(at(low[0]), at(low[1]) + 1), *range(at(high[0]), at(high[1]) + 1)}

    def centred(self, pos: np.ndarray) -> np.ndarray:
        """Places within their leaf, from -1 to 1."""
        return (pos % self.leaf - (self.leaf - 1) / 2) / (self.leaf / 2)

    def fit(self, pos: np.ndarray, raw: np.ndarray, w: np.ndarray, v: np.ndarray, starts: dict[int, np.ndarray], leaves: np.ndarray | None) -> np.ndarray:
        """Value of the local line at each of ``pos``.

        ``raw`` are the sorted places of the raw rows, in whole blocks, with weights and values; ``starts`` the moments of
        a leaf before each block inside it, ``leaves`` the moments of whole leaves, of weights and of weighted values.
        """
        t = kernels.powers_of(self.centred(raw))
        both = np.concatenate([t * w[:, None], t * (w * v)[:, None]], axis=1)
        ends = np.flatnonzero(np.append(raw[1:] // self.leaf != raw[:-1] // self.leaf, True))
        inner = np.cumsum(np.concatenate([np.zeros((1, both.shape[1])), both]), axis=0)
        # a prefix begins anew at every leaf and at every block that does not follow the one before
        begins = np.flatnonzero(np.concatenate([[True], (raw[1:] // self.leaf != raw[:-1] // self.leaf) | (raw[1:] != raw[:-1] + 1)]))
        piece = np.searchsorted(begins, np.arange(len(raw)), side="right") - 1
        base = np.stack([starts.get(int(raw[b]) // self.block, np.zeros(both.shape[1])) if raw[b] % self.leaf else np.zeros(both.shape[1]) for b in begins])
        if leaves is None:
            firsts = np.concatenate([[0], ends[:-1] + 1])
            leaf0 = int(raw[0]) // self.leaf
            leaves, offset = np.add.reduceat(both, firsts, axis=0), leaf0
        else:
            offset = 0

        def before(x: np.ndarray) -> np.ndarray:
            """Moments of the rows of x's leaf that come before place x."""
            at = np.searchsorted(raw, x)
            out = np.zeros((len(x), both.shape[1]))
            some = (x % self.leaf > 0) & (x < self.n)
            k = np.minimum(at, len(raw) - 1)
            there = some & (raw[k] == x)
            out[there] = inner[at[there]] - inner[begins[piece[k[there]]]] + base[piece[k[there]]]
            return out

        low, high, h = self.windows(pos)
        sums = np.zeros((len(pos), 2, 3))

        def add(moments: np.ndarray, leaf: np.ndarray, rows: np.ndarray, side: float, sign: float) -> None:
            shift = (leaf * self.leaf + (self.leaf - 1) / 2 - pos[rows]) / h[rows]
            scale = self.leaf / 2 / h[rows]
            own = moments.reshape(len(rows), 2, -1)
            sums[rows] += sign * kernels.moved_tricube_sums(own, shift, scale, side)

        everything = np.arange(len(pos))
        for side, first, last in ((-1.0, low, pos), (1.0, pos, high)):  # the row itself is at distance 0, on the right
            a, b = first // self.leaf, np.minimum(last, self.n - 1) // self.leaf
            b = np.where((last == self.n), -(-self.n // self.leaf), b)
            for step in range(int((b - a).max(initial=0))):
                rows = np.flatnonzero(a + step < b)
                add(leaves[a[rows] + step - offset], a[rows] + step, rows, side, 1.0)
            add(before(first), a, everything, side, -1.0)
            add(before(last), np.minimum(last, self.n - 1) // self.leaf, everything, side, 1.0)
        (s0, s1, s2), (v0, v1) = sums[:, 0].T, sums[:, 1, :2].T
        det = s0 * s2 - s1 * s1
        with np.errstate(divide="ignore", invalid="ignore"):
            fit = np.where(det <= 1e-12 * s0 * s2, v0 / s0, (s2 * v0 - s1 * v1) / det)
        own = v[np.searchsorted(raw, pos)]
        return np.where(s0 <= 1e-10, own, fit)


def _leaf_moments(df: DataFrame, grid: LowessGrid, value: str) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """(moments of every leaf, moments of the leaf before every block inside it), from one aggregate by block and leaf."""
    t = (F.col("pos") % grid.leaf - F.lit((grid.leaf - 1) / 2)) / F.lit(grid.leaf / 2)
    size = kernels.DEGREE + 1
    terms = [F.sum(F.col("_w") * f * F.pow(t, F.lit(float(p)))) for f in (F.lit(1.0), F.col(value)) for p in range(size)]
    keys = [F.floor(F.col("pos") / grid.block).cast("long").alias("b"), F.floor(F.col("pos") / grid.leaf).cast("long").alias("l")]
    rows = df.groupBy(*keys).agg(F.array(*terms).alias("m")).collect()  # 24 numbers per leaf or block, 16,384 rows or an eighth of more
    leaves, starts = np.zeros((-(-grid.n // grid.leaf), 2 * size)), {}
    for r in sorted(rows, key=lambda r: (r["l"], r["b"])):
        starts[r["b"]] = leaves[r["l"]].copy()
        leaves[r["l"]] += np.array(r["m"])
    return leaves, starts if grid.leaf > grid.block else {}


def _line_fitter(grid: LowessGrid, starts: dict[int, np.ndarray], leaves: np.ndarray | None, value: str, out: str):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        raw, w, v = (block[c].to_numpy() for c in ("pos", "_w", value))
        core = block[block["_from"] == block["block"]]
        fit = grid.fit(core["pos"].to_numpy(), raw, w, v.astype(float), starts, leaves)
        return core.assign(**{out: fit}).drop(columns=["block", "_from"])

    return run


def smooth_lowess(sig: Ordered, span: int, rounds: int = 2, out: str = "smooth", value: str = "x", block_rows: int = LOWESS_BLOCK) -> DataFrame:
    """Local linear fit with tricube weights over the ``span`` nearest rows, ``rounds`` robust repeats.

    Positions are evenly spaced, so the nearest rows are a window that is shifted inwards at the ends. A tricube
    weight is a polynomial in the distance, so a window's sums follow from the moments of some 18 leaves and of the
    beginnings of three, whatever its length. Between the repeats the leaves' moments and the median absolute residual are shared.
    """
    n, width = sig.n, 2 * (span // 2) + 1
    if n < width:
        raise ValueError(f"signal of {n} rows is shorter than the window of {width}")
    if span < 3:
        return sig.df.withColumn(out, F.col(value).cast("double"))
    grid = LowessGrid(n, span, block_rows)
    spark = sig.df.sparkSession
    users = [{"_from": b, "block": c} for c in range(-(-n // grid.block)) for b in sorted(grid.needed(c))]
    dealt = literal_table(spark, users, "_from long, block long")  # a handful per block
    current = sig.df.withColumn("_w", F.lit(1.0))
    for step in range(rounds + 1):
        leaves, starts = _leaf_moments(current, grid, value) if grid.far else (None, {})

        blocks = current.withColumn("_from", F.floor(F.col("pos") / grid.block).cast("long")).join(dealt, "_from")
        current = _per_block(blocks, _line_fitter(grid, starts, leaves, value, out), Ordered(current, n), out)
        if step == rounds:
            break
        current = materialise(current, "lowess")
        scale = exact_quantiles(current, F.abs(F.col(value) - F.col(out)), [0.5])[0]
        if not scale:
            break
        ratio = F.abs(F.col(value) - F.col(out)) / F.lit(6.0 * scale)
        robust = F.when(ratio >= 0.999, 0.0).when(ratio <= 0.001, 1.0).otherwise(F.pow(1.0 - ratio * ratio, F.lit(2.0)))
        current = current.withColumn("_w", robust).drop(out)
    return current.drop("_w")


# Analysis low-pass coefficients of the Daubechies wavelet with four vanishing moments.
DB4_LOW = [
    -0.010597401784997278,
    0.032883011666982945,
    0.030841381835986965,
    -0.18703481171888114,
    -0.02798376941698385,
    0.6308807679295904,
    0.7148465705525415,
    0.23037781330885523,
]


def _wavelet_high(low: list[float]) -> list[float]:
    size = len(low)
    return [(-1.0) ** (i + 1) * low[size - 1 - i] for i in range(size)]


def _decompose(sig: Ordered) -> tuple[Ordered, DataFrame]:
    """Half-rate averages and details; the series is mirrored at both ends."""
    size = len(DB4_LOW)
    n, half_n = sig.n, (sig.n + size - 1) // 2
    # row j of the mirrored series feeds coefficient i when 0 <= 2i + 1 - j < size
    mirrored = F.array(F.col("pos"), -1 - F.col("pos"), F.lit(2 * n - 1) - F.col("pos"))
    spread = sig.df.select("x", F.explode(mirrored).alias("j")).where((F.col("j") > -size) & (F.col("j") < n + size - 1))
    first = F.ceil((F.col("j") - 1) / 2).cast("long")
    last = F.floor((F.col("j") + size - 2) / 2).cast("long")
    cells = spread.withColumn("i", F.explode(F.sequence(first, last))).where((F.col("i") >= 0) & (F.col("i") < half_n))
    tap = (2 * F.col("i") + 1 - F.col("j")).cast("int") + 1
    low = F.element_at(F.array(*[F.lit(v) for v in DB4_LOW]), tap)
    high = F.element_at(F.array(*[F.lit(v) for v in _wavelet_high(DB4_LOW)]), tap)
    both = cells.groupBy(F.col("i").alias("pos")).agg(F.sum(low * F.col("x")).alias("x"), F.sum(high * F.col("x")).alias("d"))
    return Ordered(both.select("pos", "x"), half_n), both.select("pos", F.col("d"))


def _recompose(average: DataFrame, detail: DataFrame, n: int) -> DataFrame:
    size = len(DB4_LOW)
    low, high = DB4_LOW[::-1], _wavelet_high(DB4_LOW)[::-1]
    joined = join_rows(average, detail, "pos")
    offsets = F.sequence(F.lit(0), F.lit(size - 1))
    cells = joined.withColumn("t", F.explode(offsets)).withColumn("out", 2 * F.col("pos") + F.col("t") - (size - 2))
    cells = cells.where((F.col("out") >= 0) & (F.col("out") < n))
    term = F.element_at(F.array(*[F.lit(v) for v in low]), F.col("t") + 1) * F.col("x")
    term = term + F.element_at(F.array(*[F.lit(v) for v in high]), F.col("t") + 1) * F.col("d")
    return cells.groupBy(F.col("out").alias("pos")).agg(F.sum(term).alias("x"))


def smooth_wavelet(sig: Ordered, level: int = 3, out: str = "smooth", value: str = "x") -> DataFrame:
    """Soft-threshold the details of a db4 decomposition, level by level, and rebuild the series.

    Every step is a fixed fan-out of eight taps and an aggregate on the target position.
    """
    current = Ordered(sig.df.select("pos", F.col(value).alias("x")), sig.n)
    details, sizes = [], []
    for _ in range(level):
        sizes.append(current.n)
        average, detail = _decompose(current)
        both = materialise(join_rows(average.df, detail, "pos"), "wavelet")
        current = Ordered(both.select("pos", "x"), average.n)
        cut = exact_quantiles(both, F.abs("d"), [0.5])[0] / 0.6745 * math.sqrt(2.0 * math.log(sig.n))
        soft = F.signum("d") * F.greatest(F.abs("d") - F.lit(cut), F.lit(0.0))
        details.append(both.select("pos", soft.alias("d")))
    average = current.df
    for detail, n in zip(reversed(details), reversed(sizes)):
        average = _recompose(average, detail, n)
    return join_rows(sig.df, average.select("pos", F.col("x").alias(out)), "pos")
