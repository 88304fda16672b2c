"""Exact order statistics and top-k cuts without sorting or collecting the rows.

``locate_ranks`` narrows an interval around the wanted rank by counting values per bin. A pass is
one scan with a map-side aggregate. Passes and the last values bring at most ``MOST_ROWS`` rows to the
driver, shared by the targets, whatever the distribution or the ties look like.

Whole-number keys are compared as 64-bit integers throughout. Floating keys may hold infinities, which
have bins of their own, and any finite numbers: differences are taken of halves where they would overflow.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import inf, isinf

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.runtime import literal_table

BITS = 10
MOST_ROWS = 1 << 18
LEAF_ROWS = 4096
LARGE = 1e300
EVERYTHING = (-inf, -(2**63))


@dataclass
class Located:
    value: float | int
    less: int
    equal: int


def _whole(df: DataFrame, key: Column) -> bool:
    return isinstance(df.select(key).schema[0].dataType, T.IntegralType)


def _keyed(df: DataFrame, key: Column, group: Column | None, times: str | None = None) -> DataFrame:
    """(_x, _g): usable keys and their group; one group if there is none. ``_n`` is how often a key counts, if ``times`` says so."""
    whole = _whole(df, key)
    often = [] if times is None else [F.col(times).alias("_n")]
    data = df.select(key.cast("long" if whole else "double").alias("_x"), (F.lit("*") if group is None else group.cast("string")).alias("_g"), *often)
    usable = F.col("_x").isNotNull() if whole else F.col("_x").isNotNull() & ~F.isnan("_x")
    return data.where(usable)


def _matching(data: DataFrame, targets: list[dict], whole: bool) -> DataFrame:
    """Rows inside the open interval of each target of their group."""
    kind = "long" if whole else "double"
    fields = ["tid", "tg", "lo", "hi", "low", "high", "shift"]
    rows = [{f: t[f] for f in fields} for t in targets]
    table = literal_table(data.sparkSession, rows, f"tid long, tg string, lo {kind}, hi {kind}, low {kind}, high {kind}, shift int")
    return data.join(table, (data["_g"] == table["tg"]) & (data["_x"] >= table["lo"]) & (data["_x"] <= table["hi"]))


def _bin(whole: bool, bits: int) -> Column:
    """Ascending number of a key's bin in its interval; the two ends always lie in different bins."""
    if whole:  # the ends differ in the bits from ``shift`` on, and in no more than ``bits`` of them
        return F.expr("shiftright(_x, shift)")
    half = F.when((F.abs("low") > LARGE) | (F.abs("high") > LARGE), 0.5).otherwise(1.0)
    share = (F.col("_x") * half - F.col("low") * half) / (F.col("high") * half - F.col("low") * half)
    inside = F.when(F.col("low") < F.col("high"), F.least(F.lit((1 << bits) - 1), F.floor(share * (1 << bits)))).otherwise(0)
    return F.when(F.col("_x") == -inf, -1).when(F.col("_x") == inf, 1 << bits).otherwise(inside).cast("long")


def _measure(data: DataFrame, targets: list[dict], whole: bool, bits: int) -> None:
    """Set what bins are measured by: the lowest bit that counts, or the range of the finite keys."""
    for s in targets:
        s.update(low=s["lo"], high=s["hi"], shift=0)
        if whole:
            differ = 64 if (s["lo"] < 0) != (s["hi"] < 0) else (s["lo"] ^ s["hi"]).bit_length()
            s["shift"] = max(0, differ - bits)
    open_ended = [] if whole else [s for s in targets if isinf(s["lo"]) or isinf(s["hi"])]
    if open_ended:
        finite = F.when(F.abs("_x") < inf, F.col("_x"))
        ends = _matching(data, open_ended, whole).groupBy("tid").agg(F.min(finite).alias("low"), F.max(finite).alias("high")).collect()
        for r in ends:
            s = next(s for s in open_ended if s["tid"] == r["tid"])
            s.update(low=0.0 if r["low"] is None else r["low"], high=0.0 if r["high"] is None else r["high"])


Bounds = dict[str | None, tuple[float, float, int]]


def _count(times: str | None) -> Column:
    return (F.count("*") if times is None else F.sum("_n")).alias("n")


def key_bounds(df: DataFrame, key: Column, group: Column | None = None, groups: list[str] | None = None, times: str | None = None) -> Bounds:
    """(smallest, largest, count) of the usable keys per group, in one aggregate."""
    data = _keyed(df, key, group, times)
    if group is not None and groups is not None:
        data = data.where(F.col("_g").isin(groups))
    rows = data.groupBy("_g").agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), _count(times)).collect()
    return {(None if group is None else r["_g"]): (r["lo"], r["hi"], r["n"]) for r in rows}


def locate_ranks(
    df: DataFrame, key: Column, targets: list[tuple[str | None, int]], group: Column | None = None, bounds: Bounds | None = None, times: str | None = None
) -> list[Located]:
    """For each (group value, 0-based ascending rank) the value there and the counts below and at it.

    Null and NaN keys are ignored. ``targets`` is a list made by the caller. ``bounds`` may be wider than the keys, but
    its counts must be exact. A pass that does not narrow an interval is an error. A row counts as often as the column ``times``
    (a positive whole number) says, once without it.
    """
    whole = _whole(df, key)
    data = _keyed(df, key, group, times)
    if bounds is None:
        bounds = key_bounds(df, key, group, sorted({g for g, _ in targets}) if group is not None else None, times)
    def heads(open_: list[dict]) -> tuple[list[dict], list[int]]:
        """(a target for each interval, the number of the one that stands for each of ``open_``): an interval is counted once."""
        first: dict[tuple, dict] = {}
        own = [first.setdefault((s["tg"], s["lo"], s["hi"]), s)["tid"] for s in open_]
        return list(first.values()), own

    bits = max(1, min(BITS, (MOST_ROWS // max(len(targets), 1)).bit_length() - 1))
    leaf = max(1, min(LEAF_ROWS, MOST_ROWS // max(len(targets), 1)))
    kind = int if whole else float
    state = []
    for tid, (g, rank) in enumerate(targets):
        low, high, n = bounds.get(g, (0, 0, 0))
        if not 0 <= rank < n:
            raise ValueError(f"rank {rank} is outside group {g!r}")
        state.append({"tid": tid, "tg": "*" if group is None else g, "lo": kind(low), "hi": kind(high), "n": n, "rows": n, "below": 0, "rank": rank})

    while wide := [s for s in state if s["lo"] < s["hi"] and s["rows"] > leaf]:
        asked, own = heads(wide)
        _measure(data, asked, whole, bits)
        rows = (
            _matching(data, asked, whole)
            .groupBy("tid", _bin(whole, bits).alias("bin"))
            .agg(_count(times), F.count("*").alias("rows"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
            .collect()
        )
        bins: dict[int, list] = {}
        for r in rows:
            bins.setdefault(r["tid"], []).append(r)
        for s, head in zip(wide, own):
            before = (s["lo"], s["hi"], s["rows"])
            for r in sorted(bins[head], key=lambda r: r["bin"]):
                if s["rank"] < s["below"] + r["n"]:
                    s.update(lo=r["lo"], hi=r["hi"], n=r["n"], rows=r["rows"])
                    break
                s["below"] += r["n"]
            if before == (s["lo"], s["hi"], s["rows"]):
                raise RuntimeError(f"no progress between {s['lo']} and {s['hi']}")

    leaves = [s for s in state if s["lo"] < s["hi"]]
    values: dict[int, list[tuple]] = {}
    if leaves:
        asked, own = heads(leaves)
        for s in asked:
            s.update(low=s["lo"], high=s["hi"], shift=0)
        for r in _matching(data, asked, whole).groupBy("tid", "_x").agg(_count(times)).collect():
            values.setdefault(r["tid"], []).append((r["_x"], r["n"]))
    head_of = {s["tid"]: head for s, head in zip(leaves, own)} if leaves else {}
    found = []
    for s in state:
        if s["lo"] == s["hi"]:
            found.append(Located(s["lo"], s["below"], s["n"]))
            continue
        less = s["below"]
        for value, n in sorted(values[head_of[s["tid"]]]):
            if s["rank"] < less + n:
                found.append(Located(value, less, n))
                break
            less += n
    return found


def exact_quantiles(df: DataFrame, key: Column, shares: list[float]) -> list[float | None]:
    """Linearly interpolated quantiles, as ``percentile`` gives them, for any number of rows.

    Between a finite and an infinite value the infinite one counts as soon as the place leaves the finite one.
    """
    bounds = key_bounds(df, key)
    if not bounds:
        return [None] * len(shares)
    n = bounds[None][2]
    ranks = sorted({r for q in shares for r in (int((n - 1) * q), min(int((n - 1) * q) + 1, n - 1))})
    at = dict(zip(ranks, locate_ranks(df, key, [(None, r) for r in ranks], bounds=bounds)))
    result = []
    for q in shares:
        place = (n - 1) * q
        low, high = float(at[int(place)].value), float(at[min(int(place) + 1, n - 1)].value)
        part = place - int(place)
        result.append(low if low == high or not part else high * part + low * (1 - part) if isinf(low) or isinf(high) or abs(high - low) == inf else low + (high - low) * part)
    return result


def top_cuts(
    df: DataFrame, score: Column, row_id: Column, sizes: list[tuple[str | None, int]], group: Column | None = None
) -> list[tuple[float, int] | None]:
    """For each (group, k) the (score, row id) of the k-th row by score, then row id, both descending.

    A row belongs to the first k exactly if ``in_top`` holds for it and the cut. ``None`` stands for
    k = 0; a k beyond the group takes the whole group. All cuts are found together.
    """
    by_group = group is not None
    columns = [score.cast("double").alias("_s"), row_id.alias("_r")]
    narrow = df.select(*columns, (group.cast("string") if by_group else F.lit("*")).alias("_k"))
    wanted = [("*" if g is None else g, k) for g, k in sizes]
    groups = sorted({g for g, k in wanted if k > 0})
    bounds = key_bounds(narrow, F.col("_s"), F.col("_k"), groups) if groups else {}
    counts = {g: n for g, (_, _, n) in bounds.items()}
    cuts: list[tuple[float, int] | None] = [None] * len(wanted)
    open_cuts = []
    for i, (g, k) in enumerate(wanted):
        if k > 0 and counts.get(g, 0) <= k:
            cuts[i] = EVERYTHING
        elif k > 0:
            open_cuts.append(i)
    if not open_cuts:
        return cuts
    places = locate_ranks(narrow, F.col("_s"), [(wanted[i][0], counts[wanted[i][0]] - wanted[i][1]) for i in open_cuts], F.col("_k"), bounds)
    tied = []
    for i, place in zip(open_cuts, places):
        g, k = wanted[i]
        need = k - (counts[g] - place.less - place.equal)
        if need == place.equal:
            cuts[i] = (place.value, EVERYTHING[1])
        else:
            tied.append({"tid": f"{i}", "tg": g, "v": place.value, "rank": place.equal - need, "i": i})
    if tied:
        table = literal_table(df.sparkSession, tied, "tid string, tg string, v double")
        at_value = narrow.join(table, (narrow["_k"] == table["tg"]) & (narrow["_s"] == table["v"]))
        ids = locate_ranks(at_value, F.col("_r"), [(t["tid"], t["rank"]) for t in tied], F.col("tid"))
        for t, place in zip(tied, ids):
            cuts[t["i"]] = (t["v"], int(place.value))
    return cuts


def in_top(score: Column, row_id: Column, cut: tuple[float, int] | None) -> Column:
    if cut is None:
        return F.lit(False)
    value, rid = cut
    return (score > F.lit(value)) | ((score == F.lit(value)) & (row_id >= F.lit(rid)))
