"""Ordered-signal queries: positions, smoothers, derived features, normalised scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import columns as fx, kernels
from tallyloom.operators import ordering, removal, scaling, smoothing as sm
from tallyloom.operators.split import class_counts
from tallyloom.registry import sql
from tallyloom.registry.base import noise, query, r6, train_valid
from tallyloom.registry.sql import build


def signal(spark, sf):
    return sm.scored_signal(noise(spark, sf))


def smooth_only(df):
    return df.select("row_id", *r6("smooth"))


@query("base_score", build("SELECT row_id, round(x, 6) AS score FROM based", "based"))
def base_score(spark, sf):
    score = fx.base_score(F.col("true_label_prob"), F.col("flagged_suspicious"))
    return noise(spark, sf).select("row_id", F.round(score, 6).alias("score"))


@query("ordered_signal", build("SELECT row_id, round(x, 6) AS x, pos FROM sig", "sig"))
def ordered_signal(spark, sf):
    return signal(spark, sf).df.select("row_id", *r6("x"), "pos")


MEDIANS = " UNION ALL ".join(
    f"SELECT {k} AS kernel, a.row_id, round(list_sort(list(coalesce(b.x, 0.0)))[{k // 2 + 1}], 6) AS smooth FROM {{0}} a "
    f"CROSS JOIN range({-(k // 2)}, {k // 2 + 1}) o(off) LEFT JOIN {{0}} b ON b.pos = a.pos + o.off GROUP BY a.row_id"
    for k in (3, 5, 7)
)


@query("smooth_median", build(MEDIANS.format("filesig"), "filesig"))
def smooth_median(spark, sf):
    sig = sm.scored_signal(noise(spark, sf), order="file")
    parts = [sm.smooth_median(sig, k).select(F.lit(k).alias("kernel"), "row_id", *r6("smooth")) for k in (3, 5, 7)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SAVGOL = [(7, 2), (11, 2), (11, 3), (15, 3), (21, 6)]


@query(
    "smooth_savgol",
    build(
        " UNION ALL ".join(f"SELECT {w} AS win, {d} AS degree, row_id, round(smooth, 6) AS smooth FROM ({sql.window_sum_sql(kernels.savgol_weights(w, d))})" for w, d in SAVGOL),
        "sig",
    ),
)
def smooth_savgol(spark, sf):
    sig = signal(spark, sf)
    out = None
    for w, d in SAVGOL:
        part = sm.smooth_savgol(sig, w, d).select(F.lit(w).alias("win"), F.lit(d).alias("degree"), "row_id", *r6("smooth"))
        out = part if out is None else out.unionByName(part)
    return out


@query("smooth_gaussian", build(f"SELECT row_id, round(smooth, 6) AS smooth FROM ({sql.window_sum_sql(kernels.gaussian_weights(2.0))})", "sig"))
def smooth_gaussian(spark, sf):
    return smooth_only(sm.smooth_gaussian(signal(spark, sf), 2.0))


@query(
    "smooth_trimmed_mean",
    build(
        "SELECT row_id, round(list_avg(v[1 + t : len(v) - t]), 6) AS smooth FROM (SELECT row_id, list_sort(w) AS v, CAST(floor(len(w) * 0.2) AS INT) AS t FROM ("
        "SELECT row_id, list(x) OVER (ORDER BY pos ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS w FROM sig))",
        "sig",
    ),
)
def smooth_trimmed_mean(spark, sf):
    return smooth_only(sm.smooth_trimmed_mean(signal(spark, sf), 9, 0.2))


KALMAN = """
SELECT a.row_id, round(sum(b.k * exp(a.lp - b.lp) * b.x), 6) AS smooth FROM z a JOIN z b ON b.pos <= a.pos AND b.pos >= a.pos - 450 GROUP BY a.row_id"""
# gains by recursion until they settle, then the filter as a sum over the last 450 rows
KALMAN_GAINS = """
SELECT 1 AS t, (1.0::DOUBLE + 1e-4) / (1.0::DOUBLE + 1e-4 + 1e-2) AS k, (1 - (1.0::DOUBLE + 1e-4) / (1.0::DOUBLE + 1e-4 + 1e-2)) * (1.0::DOUBLE + 1e-4) AS p
UNION ALL SELECT t + 1, (p + 1e-4) / (p + 1e-4 + 1e-2), (1 - (p + 1e-4) / (p + 1e-4 + 1e-2)) * (p + 1e-4) FROM g WHERE t < 400"""


@query(
    "smooth_kalman",
    build(
        KALMAN,
        "sig",
        **{
            "g(t, k, p)": KALMAN_GAINS,
            "z": "SELECT s.row_id, s.pos, s.x, CASE WHEN s.pos = 0 THEN 1.0 ELSE g.k END AS k, "
            "sum(CASE WHEN s.pos = 0 THEN 0 ELSE ln(1 - g.k) END) OVER (ORDER BY s.pos) AS lp FROM sig s JOIN g ON g.t = greatest(1, least(400, s.pos))",
        },
    ),
)
def smooth_kalman(spark, sf):
    return smooth_only(sm.smooth_kalman(signal(spark, sf), 1e-4, 1e-2))


@query("smooth_whittaker", build("SELECT row_id, round(x, 6) AS rebuilt FROM sig", "sig"))
def smooth_whittaker(spark, sf):
    """The smoothed series put back into the linear system it solves, which must give the input."""
    lam, sig = 50.0, signal(spark, sf)
    smooth = sm.smooth_whittaker(sig, lam)
    near = ordering.neighbourhood(ordering.Ordered(smooth, sig.n), "smooth", 2, "zero")
    s = [F.element_at("near", i) for i in range(1, 6)]
    second = lambda i: s[i] - 2 * s[i + 1] + s[i + 2]
    inside = lambda i, d: F.when((F.col("pos") + d >= 0) & (F.col("pos") + d + 2 < sig.n), second(i)).otherwise(0.0)
    penalty = inside(0, -2) - 2 * inside(1, -1) + inside(2, 0)
    return near.select("row_id", F.round(F.col("smooth") + lam * penalty, 6).alias("rebuilt"))


@query("smooth_zero_phase_fir")
def smooth_zero_phase_fir(spark, sf):
    return smooth_only(sm.smooth_zero_phase_fir(signal(spark, sf)))


@query("smooth_wavelet")
def smooth_wavelet(spark, sf):
    return smooth_only(sm.smooth_wavelet(signal(spark, sf)))


def lowess_sql(rounds: int = 2) -> tuple[str, dict[str, str]]:
    """Every window row by row: local lines under tricube weights, then repeats under the weights of the residuals."""
    parts = {
        "span": "SELECT count(*) AS n, CAST(floor(0.025::DOUBLE * count(*)) AS BIGINT) AS half FROM sig",
        "win": "SELECT *, greatest(pos - low, low + 2 * half - pos)::DOUBLE AS h FROM ("
        "SELECT row_id, pos, x, half, greatest(0, least(pos - half, n - 2 * half - 1)) AS low FROM sig CROSS JOIN span)",
        "line0": "SELECT row_id, pos, x, 1.0::DOUBLE AS w FROM sig",
    }
    for step in range(rounds + 1):
        parts[f"sums{step}"] = f"""
            SELECT pos, any_value(x) AS x, sum(t) AS s0, sum(t * u) AS s1, sum(t * u * u) AS s2, sum(t * v) AS v0, sum(t * u * v) AS v1 FROM (
              SELECT a.pos, a.x, b.x AS v, (b.pos - a.pos) / a.h AS u, b.w * power(1 - power(abs(b.pos - a.pos) / a.h, 3), 3) AS t
              FROM win a JOIN line{step} b ON b.pos BETWEEN a.low AND a.low + 2 * a.half WHERE abs(b.pos - a.pos) < 0.999::DOUBLE * a.h) GROUP BY pos"""
        parts[f"fit{step}"] = f"""
            SELECT pos, CASE WHEN s0 <= 1e-10 THEN x WHEN s0 * s2 - s1 * s1 <= 1e-12 * s0 * s2 THEN v0 / s0
                             ELSE (s2 * v0 - s1 * v1) / (s0 * s2 - s1 * s1) END AS smooth FROM sums{step}"""
        if step < rounds:
            parts[f"scale{step}"] = f"SELECT 6 * median(abs(l.x - f.smooth)) AS s FROM line{step} l JOIN fit{step} f USING (pos)"
            parts[f"line{step + 1}"] = f"""
                SELECT row_id, pos, x, CASE WHEN s = 0 THEN w WHEN r >= 0.999::DOUBLE * s THEN 0 WHEN r <= 0.001::DOUBLE * s THEN 1 ELSE power(1 - (r / s) * (r / s), 2) END AS w
                FROM (SELECT l.*, abs(l.x - f.smooth) AS r, s FROM line{step} l JOIN fit{step} f USING (pos) CROSS JOIN scale{step})"""
    return f"SELECT row_id, round(smooth, 6) AS smooth FROM sig JOIN fit{rounds} USING (pos)", parts


_lowess, _lowess_parts = lowess_sql()


@query("smooth_lowess", build(_lowess, "sig", **_lowess_parts))
def smooth_lowess(spark, sf):
    sig = signal(spark, sf)
    return smooth_only(sm.smooth_lowess(sig, sm.lowess_span(sig.n)))


@query("zscore", build("SELECT row_id, round((x - avg(x) OVER ()) / (stddev_pop(x) OVER () + 1e-12), 6) AS z FROM based", "based"))
def zscore(spark, sf):
    return scaling.zscore(scored(spark, sf), "x", "z").select("row_id", *r6("z"))


def scored(spark, sf):
    score = fx.base_score(F.col("true_label_prob"), F.col("flagged_suspicious"))
    return noise(spark, sf).withColumn("x", F.round(score, 9))


@query("minmax_norm", build("SELECT row_id, round((x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER () + 1e-12), 6) AS x_norm FROM based", "based"))
def minmax_norm(spark, sf):
    return scaling.minmax_norm(scored(spark, sf), "x", "x_norm").select("row_id", *r6("x_norm"))


@query(
    "standard_scale",
    build(
        "SELECT v.row_id, round((v.amount - s.m) / CASE WHEN s.d = 0 THEN 1 ELSE s.d END, 6) AS amount_scaled, 0.0::DOUBLE AS one_scaled "
        "FROM valid v CROSS JOIN (SELECT avg(amount) AS m, stddev_pop(amount) AS d FROM train) s",
        "train",
        "valid",
    ),
)
def standard_scale(spark, sf):
    train, valid = [df.withColumn("one", F.lit(1.0)) for df in train_valid(spark, sf)]
    return scaling.standard_scale(train, valid, ["amount", "one"]).select("row_id", *r6("amount_scaled", "one_scaled"))


GAUSS = sql.window_sum_sql(kernels.gaussian_weights(2.0))


@query(
    "blend_scores",
    build(
        "SELECT alpha, row_id, round((1 - alpha) * b + alpha * s, 6) AS score FROM (SELECT b.row_id, "
        "(b.x - min(b.x) OVER ()) / (max(b.x) OVER () - min(b.x) OVER () + 1e-12) AS b, "
        "(g.smooth - min(g.smooth) OVER ()) / (max(g.smooth) OVER () - min(g.smooth) OVER () + 1e-12) AS s FROM sig b JOIN g ON b.row_id = g.row_id) "
        "CROSS JOIN (VALUES (0.0::DOUBLE), (0.25), (0.5), (0.75)) AS v(alpha)",
        "sig",
        g=GAUSS,
    ),
)
def blend_scores(spark, sf):
    smooth = sm.smooth_gaussian(signal(spark, sf), 2.0)
    both = scaling.minmax_norm(scaling.minmax_norm(smooth, "x", "b"), "smooth", "s")
    alphas = F.explode(F.array(*[F.lit(a) for a in (0.0, 0.25, 0.5, 0.75)]))
    score = (1.0 - F.col("alpha")) * F.col("b") + F.col("alpha") * F.col("s")
    return both.select("row_id", "b", "s", alphas.alias("alpha")).select("alpha", "row_id", F.round(score, 6).alias("score"))


@query(
    "delta_sigma",
    build(
        "SELECT row_id, round(d, 6) AS noise_delta, round(d * d, 6) AS noise_delta_sq FROM (SELECT row_id, coalesce(x - lag(x) OVER (ORDER BY pos), 0) AS d FROM sig)",
        "sig",
    ),
)
def delta_sigma(spark, sf):
    return sm.delta_sigma(signal(spark, sf)).select("row_id", *r6("noise_delta", "noise_delta_sq"))


SG21 = sql.window_sum_sql(kernels.savgol_weights(21, 6))
RESID = "SELECT s.row_id, s.x AS noise_raw, g.smooth AS noise_smooth, s.x - g.smooth AS noise_resid FROM sig s JOIN g ON s.row_id = g.row_id"


@query(
    "residual_features",
    build("SELECT row_id, round(noise_raw, 6) AS noise_raw, round(noise_smooth, 6) AS noise_smooth, round(noise_resid, 6) AS noise_resid FROM f", "sig", g=SG21, f=RESID),
)
def residual_features(spark, sf):
    return sm.residual_features(signal(spark, sf)).select("row_id", *r6("noise_raw", "noise_smooth", "noise_resid"))


@query(
    "residual_injection",
    build("SELECT row_id, round(0.2 * noise_resid, 6) AS resid_injected, round((SELECT median(0.2 * noise_resid) FROM f), 6) AS on_valid FROM f", "sig", g=SG21, f=RESID),
)
def residual_injection(spark, sf):
    injected = sm.residual_injection(signal(spark, sf)).withColumn("resid_injected", F.round("resid_injected", 12))
    constant = sm.signal_medians(injected, ["resid_injected"])["resid_injected"]
    return sm.with_constants(injected, {"on_valid": constant}).select("row_id", *r6("resid_injected", "on_valid"))


@query(
    "signal_medians",
    build("SELECT round(median(noise_raw), 6) AS noise_raw, round(median(noise_smooth), 6) AS noise_smooth, round(median(noise_resid), 6) AS noise_resid, v.row_id FROM f CROSS JOIN valid v GROUP BY v.row_id", "sig", "valid", g=SG21, f=RESID),
)
def signal_medians(spark, sf):
    values = sm.signal_medians(sm.residual_features(signal(spark, sf)), ["noise_raw", "noise_smooth", "noise_resid"])
    return sm.with_constants(train_valid(spark, sf)[1], values).select("row_id", *r6(*values))


@query(
    "quantile_threshold",
    build(
        " UNION ALL ".join(f"SELECT {q}::DOUBLE AS share, round(quantile_cont(true_label_prob, {q}), 6) AS value FROM pool" for q in (0.25, 0.4, 0.5, 0.9, 0.95, 0.975)),
        "pool",
    ),
)
def quantile_threshold(spark, sf):
    from tallyloom.operators.noise import candidate_pool
    from tallyloom.operators.ranks import exact_quantiles

    shares = [0.25, 0.4, 0.5, 0.9, 0.95, 0.975]
    values = exact_quantiles(candidate_pool(noise(spark, sf)), F.col("true_label_prob"), shares)
    return spark.createDataFrame([(s, round(v, 6)) for s, v in zip(shares, values)], "share double, value double")


CAPS = (0.05, 0.10, 0.15)
CAP_SQL = " UNION ALL ".join(
    f"SELECT {c}::DOUBLE AS cap, row_id FROM (SELECT row_id, row_number() OVER (ORDER BY round((1.0::DOUBLE - true_label_prob) + 0.25 * wrong_flag, 9) DESC, row_id DESC) AS rk, count(*) OVER () AS n FROM noise) "
    f"WHERE rk > greatest(1, CAST(floor(n * {c}::DOUBLE) AS BIGINT))"
    for c in CAPS
)


@query("remove_cap_fraction", build(CAP_SQL, "noise"))
def remove_cap_fraction(spark, sf):
    rows = noise(spark, sf).withColumn("score", F.round(fx.rank_score(F.col("true_label_prob"), F.col("wrong_flag")), 9))
    cuts = removal.cap_removal(rows, "score", list(CAPS))
    parts = [rows.where(~drop).select(F.lit(c).alias("cap"), "row_id") for c, drop in zip(CAPS, cuts)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


FRACS = (0.6, 0.75, 0.9, 1.0)
POOL_X = "SELECT * FROM based WHERE flagged_suspicious AND true_label_prob < 0.15"
FRAC_SQL = " UNION ALL ".join(
    f"SELECT {f}::DOUBLE AS share, row_id FROM (SELECT row_id, row_number() OVER (ORDER BY x DESC, row_id DESC) AS rk, count(*) OVER () AS n FROM p) WHERE rk <= CAST(floor(n * {f}::DOUBLE) AS BIGINT)"
    for f in FRACS
)


def pool(spark, sf):
    from tallyloom.operators.noise import candidate_pool

    return candidate_pool(scored(spark, sf))


@query("remove_candidate_fraction", build(FRAC_SQL, "based", p=POOL_X))
def remove_candidate_fraction(spark, sf):
    rows, out = pool(spark, sf), None
    for f, drop in zip(FRACS, removal.candidate_removal(rows, "x", list(FRACS))):
        part = rows.where(drop).select(F.lit(f).alias("share"), "row_id")
        out = part if out is None else out.unionByName(part)
    return out


CLASS_AWARE = [(0.75, 40), (0.75, 20), (0.9, 60), (0.6, 1500), (1.0, 33)]
CLASS_SQL = " UNION ALL ".join(
    f"""SELECT {f}::DOUBLE AS share, {k} AS min_keep, row_id FROM (
          SELECT *, row_number() OVER (ORDER BY x DESC, row_id DESC) AS grk FROM (
            SELECT p.*, row_number() OVER (PARTITION BY p.category ORDER BY p.x DESC, p.row_id DESC) AS rk, c.n AS class_n, count(*) OVER () AS pool_n
            FROM p JOIN (SELECT category, count(*) AS n FROM noise GROUP BY category) c ON p.category = c.category) WHERE rk <= class_n - {k})
        WHERE grk <= greatest(1, CAST(floor(pool_n * {f}::DOUBLE) AS BIGINT))"""
    for f, k in CLASS_AWARE
)


@query("remove_class_aware", build(CLASS_SQL, "based", "noise", p=POOL_X))
def remove_class_aware(spark, sf):
    rows, out = pool(spark, sf), None
    drops = removal.class_aware_removal(class_counts(noise(spark, sf), "category"), rows, "x", CLASS_AWARE)
    for (f, k), drop in zip(CLASS_AWARE, drops):
        part = rows.where(drop).select(F.lit(f).alias("share"), F.lit(k).alias("min_keep"), "row_id")
        out = part if out is None else out.unionByName(part)
    return out


@query("remove_rows", build("SELECT row_id, category FROM noise WHERE row_id NOT IN (SELECT row_id FROM pool)", "noise", "pool"))
def remove_rows(spark, sf):
    from tallyloom.operators.noise import candidate_pool

    rows = noise(spark, sf)
    return removal.remove_rows(rows, candidate_pool(rows)).select("row_id", "category")


@query(
    "remove_above_quantile",
    build(
        " UNION ALL ".join(f"SELECT {q}::DOUBLE AS share, row_id FROM p WHERE x >= (SELECT quantile_cont(x, {q}) FROM p)" for q in (0.9, 0.95, 0.975)),
        "based",
        p=POOL_X,
    ),
)
def remove_above_quantile(spark, sf):
    rows, shares = pool(spark, sf), (0.9, 0.95, 0.975)
    hits = [F.when(drop, F.lit(q)) for q, drop in zip(shares, removal.quantile_removals(rows, "x", shares))]
    return rows.select(F.explode(F.array_compact(F.array(*hits))).alias("share"), "row_id")


ERR = "round(power(coalesce(amount, 0) / 100, 2), 9)"


def with_error(df):
    return df.withColumn("err", F.expr(ERR))


@query(
    "error_gating",
    build(" UNION ALL ".join(f"SELECT {q}::DOUBLE AS share, row_id FROM e WHERE err >= (SELECT quantile_cont(err, {q}) FROM e)" for q in (0.25, 0.4, 0.5)), "pool", e=f"SELECT row_id, {ERR} AS err FROM pool"),
)
def error_gating(spark, sf):
    rows, out = with_error(pool(spark, sf)), None
    for q in (0.25, 0.4, 0.5):
        part = removal.error_gating(rows, "err", q).select(F.lit(q).alias("share"), "row_id")
        out = part if out is None else out.unionByName(part)
    return out


@query("recon_error_threshold", build("SELECT row_id FROM e WHERE err <= (SELECT quantile_cont(err, 0.95) FROM e)", "noise", e=f"SELECT row_id, {ERR} AS err FROM noise"))
def recon_error_threshold(spark, sf):
    return removal.recon_error_threshold(with_error(noise(spark, sf)), "err").select("row_id")
