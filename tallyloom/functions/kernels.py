"""Filter coefficients and gains: a few numbers computed once from the filter's parameters."""

from __future__ import annotations

import math

import numpy as np


def savgol_weights(window: int, degree: int) -> list[float]:
    """Weights of the centre value of a least-squares polynomial over ``window`` points."""
    half = window // 2
    design = np.vander(np.arange(-half, half + 1) / max(half, 1), degree + 1, increasing=True)
    return np.linalg.pinv(design)[0].tolist()


def gaussian_weights(sigma: float) -> list[float]:
    radius = int(4.0 * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return (weights / weights.sum()).tolist()


def lowpass_taps(count: int, cutoff: float) -> np.ndarray:
    """Hamming-windowed sinc with unit gain at frequency zero."""
    centred = np.arange(count) - (count - 1) / 2
    taps = cutoff * np.sinc(cutoff * centred) * np.hamming(count)
    return taps / taps.sum()


def zero_phase_weights(count: int, cutoff: float) -> list[float]:
    """One pass forward and one backward is one pass of the taps convolved with themselves."""
    taps = lowpass_taps(count, cutoff)
    return np.convolve(taps, taps[::-1]).tolist()


def kalman_gains(q: float, r: float, tolerance: float = 1e-16, limit: int = 1_000_000) -> np.ndarray:
    """Gains K_1, K_2, ... up to the step from which they no longer change."""
    gains, variance = [], 1.0
    for _ in range(limit):
        predicted = variance + q
        gain = predicted / (predicted + r)
        variance = (1.0 - gain) * predicted
        if gains and abs(gains[-1] - gain) <= tolerance * gain:
            gains.append(gain)
            break
        gains.append(gain)
    return np.array(gains)


def kalman_memory(gains: np.ndarray, precision: float = 1e-18) -> int:
    """Steps after which the start state no longer shows in double precision."""
    return int(math.ceil(math.log(precision) / math.log1p(-float(gains[-1])))) + 1


def whittaker_factors(size: int, lam: float) -> tuple[list[float], list[float], list[float]]:
    """(pivots, first, second) off-diagonals of L in L D L' = I + lam * D'D, row by row.

    Away from the ends the rows of the system are equal and the factors settle to constants, which are then repeated."""
    a, b, c = np.ones(size), np.zeros(size), np.zeros(size)
    rows = max(size - 2, 0)
    for offset, value in enumerate((1.0, 4.0, 1.0)):
        a[offset : offset + rows] += lam * value
    for offset in range(2):
        b[offset : offset + rows] -= 2 * lam
    c[:rows] += lam
    d, e, f = [0.0] * size, [0.0] * size, [0.0] * size
    i = 0
    while i < size:
        pull, turn = 0.0, 0.0
        if i > 0:
            pull += d[i - 1] * e[i - 1] * e[i - 1]
            turn = d[i - 1] * e[i - 1] * f[i - 1]
        if i > 1:
            pull += d[i - 2] * f[i - 2] * f[i - 2]
        d[i] = float(a[i]) - pull
        e[i], f[i] = (float(b[i]) - turn) / d[i], float(c[i]) / d[i]
        settled = 4 < i < size - 4 and d[i] == d[i - 1] == d[i - 2] and e[i] == e[i - 1] == e[i - 2]
        if settled:
            for part in (d, e, f):
                part[i : size - 3] = [part[i]] * (size - 3 - i)
            i = size - 3
        else:
            i += 1
    return d, e, f


def whittaker_solve(y: np.ndarray, factors: tuple[list[float], list[float], list[float]]) -> np.ndarray:
    """The smooth series: one scan forward and one back."""
    d, e, f = factors
    x = y.astype(float).tolist()
    n = len(x)
    for i in range(1, n):
        x[i] -= e[i - 1] * x[i - 1] + (f[i - 2] * x[i - 2] if i > 1 else 0.0)
    for i in range(n - 1, -1, -1):
        x[i] = x[i] / d[i] - (e[i] * x[i + 1] if i + 1 < n else 0.0) - (f[i] * x[i + 2] if i + 2 < n else 0.0)
    return np.array(x)


def whittaker_halo(lam: float) -> int:
    """Rows of context beyond which a value's weight is below double precision."""
    decay = 2.0 ** -0.5 * (1.0 / lam) ** 0.25
    return int(math.ceil(40.0 / decay / 16.0)) * 16


def kalman_scan(z: np.ndarray, gain: np.ndarray, memory: int) -> np.ndarray:
    """x[0] = z[0], x[i] = x[i - 1] + gain[i] * (z[i] - x[i - 1]), for many pieces of the signal at once.

    Each piece starts ``memory`` rows early, from the signal itself; by its first own row that start has faded out."""
    n = len(z)
    size = max(memory, 256)
    starts = np.arange(0, n, size)
    ends = np.minimum(starts + size, n)
    begins = np.maximum(starts - memory, 0)
    out, current = np.empty(n), z[begins].astype(float)
    for step in range(int((ends - begins).max(initial=0))):
        at = begins + step
        live = np.flatnonzero(at < ends)
        if step:
            p = at[live]
            current[live] += gain[p] * (z[p] - current[live])
        own = live[at[live] >= starts[live]]
        out[at[own]] = current[own]
    return out


#: Tricube weights are polynomials of degree 9 in the distance, and a line needs two degrees more.
DEGREE = 11


def _tricube_factors(side: float) -> np.ndarray:
    """(12, 36): for sums k = 0, 1, 2 and moments q, the polynomial in the shift that moment q is multiplied by.

    (1 - |x|^3)^3 x^k has the powers k, k + 3, k + 6 and k + 9 of x = shift + t, and x^p is a sum of binomials.
    """
    out = np.zeros((DEGREE + 1, 3, DEGREE + 1))
    for k in range(3):
        for step, factor in enumerate((1.0, -3.0 * side, 3.0, -side)):
            p = k + 3 * step
            for q in range(p + 1):
                out[p - q, k, q] += factor * math.comb(p, q)
    return out.reshape(DEGREE + 1, -1)


_TRICUBE = {side: _tricube_factors(side) for side in (-1.0, 1.0)}


def powers_of(t: np.ndarray) -> np.ndarray:
    """t ** 0 .. t ** DEGREE as columns."""
    out = np.ones((DEGREE + 1, len(t)))
    for p in range(DEGREE):
        np.multiply(out[p], t, out=out[p + 1])
    return out.T


def moved_tricube_sums(moments: np.ndarray, shift: np.ndarray, scale: np.ndarray, side: float) -> np.ndarray:
    """(row, set, k): sums of (1 - |x|^3)^3 x^k for k = 0, 1, 2 over x = shift + scale * t, all of one sign, from the
    moments (row, set, power) of t. The sets of a row share the polynomials in its shift."""
    factors = (powers_of(shift) @ _TRICUBE[side]).reshape(len(shift), 3, DEGREE + 1)
    return np.einsum("rpq,rkq->rpk", moments * powers_of(scale)[:, None, :], factors)
