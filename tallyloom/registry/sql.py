"""Common table expressions for the comparison SQL."""

from __future__ import annotations

from tallyloom import fixed


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(rows, names: str) -> str:
    body = ", ".join("(" + ", ".join(_text(v) if isinstance(v, str) else repr(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({names})"


CATEGORY_NAMES = "[" + ", ".join(_text(c) for c, _ in fixed.CATEGORY_GROUPS) + ", 'Unmapped']"

CLEAN = "trim(regexp_replace(regexp_replace(lower(coalesce({0}, '')), '#[0-9]+', ' ', 'g'), '\\s+', ' ', 'g'))"
BUCKET = (
    "CASE WHEN abs({0}) < 10 THEN '0_10' WHEN abs({0}) < 25 THEN '10_25' WHEN abs({0}) < 50 THEN '25_50' "
    "WHEN abs({0}) < 100 THEN '50_100' WHEN abs({0}) < 250 THEN '100_250' ELSE '250_plus' END"
)


def blank(col: str) -> str:
    return f"CASE WHEN regexp_full_match({col}, '\\s*') THEN NULL ELSE {col} END"


def fold_sql(source: str, seed: str = "'42'", part: str = "category") -> str:
    return (
        f"SELECT *, CAST((row_number() OVER (PARTITION BY {part} ORDER BY md5(CAST(row_id AS VARCHAR) || ':' || {seed}), row_id) - 1) % 5 AS INT) AS fold "
        f"FROM {source}"
    )


def split_sql(source: str, label: str = "category", seed: int = 42, fraction: str = "0.2") -> str:
    return f"""
    SELECT s.*, CASE WHEN rn <= quota THEN 'valid' ELSE 'train' END AS split FROM (
      SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5(CAST(row_id AS VARCHAR) || ':{seed}'), row_id) AS rn FROM {source}
    ) s JOIN (
      SELECT {label}, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, {label}) <= wanted - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM (
        SELECT {label}, wanted, (n * wanted) // total AS base, (n * wanted) % total AS rest FROM (
          SELECT {label}, count(*) AS n, sum(count(*)) OVER () AS total, CAST(ceil({fraction} * sum(count(*)) OVER ()) AS BIGINT) AS wanted
          FROM {source} GROUP BY {label}))
    ) q USING ({label})"""


def counting_sql(train: str, rows: str, by: str = "", keys: str = "description, amount_bucket, transaction_type", label: str = "category") -> str:
    """Score ``rows`` with label counts of ``train``; ``by`` lists run columns, each followed by a comma."""
    run = [c.strip() for c in by.split(",") if c.strip()]
    part = "".join(f"{c}, " for c in run)
    on_run = "".join(f" AND a.{c} = b.{c}" for c in run)
    key_list = [k.strip() for k in keys.split(",")]
    return f"""
    SELECT a.*, b.best AS cv_pred, b.own AS true_label_prob FROM {rows} a JOIN (
      SELECT {part}row_id, min_by(y, (-p, y)) AS best, max(CASE WHEN y = mine THEN p END) AS own FROM (
        SELECT {''.join(f'r.{c}, ' for c in run)}r.row_id, r.{label} AS mine, pr.{label} AS y,
               round((coalesce(c.n, 0) + pr.share) / (coalesce(k.n, 0) + 1), 9) AS p
        FROM {rows} r
        JOIN (SELECT {part}{label}, count(*) / sum(count(*)) OVER ({'PARTITION BY ' + ', '.join(run) if run else ''}) AS share
              FROM {train} GROUP BY {part}{label}) pr ON {' AND '.join(f'r.{c} = pr.{c}' for c in run) or 'true'}
        LEFT JOIN (SELECT {part}{keys}, count(*) AS n FROM {train} GROUP BY {part}{keys}) k
          ON {' AND '.join(f'r.{c} = k.{c}' for c in run + key_list)}
        LEFT JOIN (SELECT {part}{keys}, {label}, count(*) AS n FROM {train} GROUP BY {part}{keys}, {label}) c
          ON {' AND '.join(f'r.{c} = c.{c}' for c in run + key_list)} AND c.{label} = pr.{label}
      ) GROUP BY {part}row_id
    ) b ON a.row_id = b.row_id{on_run}"""


def oof_sql(folded: str, by: str = "", keys: str = "description, amount_bucket, transaction_type", label: str = "category") -> str:
    others = f"(SELECT b.* EXCLUDE (fold), f.fold FROM {folded} b JOIN (SELECT unnest(range(5))::INT AS fold) f ON f.fold <> b.fold)"
    return counting_sql(others, folded, by + ("," if by else "") + "fold", keys, label)


def metrics_sql(preds: str, by: str = "", label: str = "category", pred: str = "prediction") -> str:
    part = "".join(f"{c.strip()}, " for c in by.split(",") if c.strip())
    group = f"GROUP BY {part.rstrip(', ')}" if part else ""
    return f"""
    SELECT {part}sum(hits) / sum(support) AS accuracy, sum(f1 * support) / sum(support) AS weighted_f1, avg(f1) AS macro_f1 FROM (
      SELECT {part}label, sum(s) AS support, sum(h) AS hits, 2 * sum(h) / (sum(s) + sum(p)) AS f1 FROM (
        SELECT {part}{label} AS label, 1 AS s, 0 AS p, CASE WHEN {label} = {pred} THEN 1 ELSE 0 END AS h FROM {preds}
        UNION ALL SELECT {part}{pred}, 0, 1, 0 FROM {preds}) GROUP BY {part}label) {group}"""


def report_sql(preds: str, labels: str, label: str = "category", pred: str = "prediction") -> str:
    """Per-class rows and the two averages; ``labels`` is a relation with one column ``label``."""
    return f"""
    WITH per AS (
      SELECT label, coalesce(h / nullif(p, 0), 0) AS precision, coalesce(h / nullif(s, 0), 0) AS recall,
             coalesce(2 * h / nullif(s + p, 0), 0) AS f1, CAST(s AS BIGINT) AS support FROM (
        SELECT l.label, (SELECT count(*) FROM {preds} WHERE {label} = l.label) AS s,
               (SELECT count(*) FROM {preds} WHERE {pred} = l.label) AS p,
               (SELECT count(*) FROM {preds} WHERE {pred} = l.label AND {label} = l.label) AS h FROM {labels} l))
    SELECT * FROM per
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                     sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per"""


def window_sum_sql(weights: list[float], sig: str = "sig") -> str:
    """Weighted window sum with repeated end values."""
    half = len(weights) // 2
    taps = ", ".join(f"({i - half}, {w!r}::DOUBLE)" for i, w in enumerate(weights))
    return f"""
    SELECT a.row_id, sum(a.w * b.x) AS smooth FROM (
      SELECT s.row_id, c.w, greatest(0, least(s.last, s.pos + c.off)) AS spot
      FROM (SELECT row_id, pos, count(*) OVER () - 1 AS last FROM {sig}) s CROSS JOIN (VALUES {taps}) AS c(off, w)
    ) a JOIN {sig} b ON b.pos = a.spot GROUP BY a.row_id"""


# name -> (names it needs, SQL)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "cmap": ((), values(fixed.CATEGORY_GROUPS, "category, grp")),
    "tx": (
        (),
        f"""SELECT event_id AS row_id, CAST(user_id AS VARCHAR) AS user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
            CASE WHEN event_id % 83 = 0 THEN '  ' ELSE upper(event_type) || ' Store  ' || (k % 10) || ' #' || k END AS description,
            CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'purchase' THEN -value ELSE value END AS amount,
            CASE WHEN event_id % 89 = 0 THEN ' ' WHEN event_type IN ('purchase', 'click') THEN 'debit' ELSE 'credit' END AS transaction_type,
            'acct' || (user_id % 6) AS account_name,
            ({CATEGORY_NAMES})[1 + CASE WHEN event_id % 13 = 0 THEN event_id % 23 ELSE (k % 10 + length(event_type)) % 22 END] AS category
            FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)""",
    ),
    "txn": (
        ("tx",),
        f"""SELECT row_id, user_id, date, {blank('description')} AS description, amount,
            {blank('transaction_type')} AS transaction_type, account_name, category FROM tx""",
    ),
    "lab": (
        ("txn", "cmap"),
        f"""SELECT t.row_id, {CLEAN.format('t.description')} AS description, t.amount, {BUCKET.format('t.amount')} AS amount_bucket,
            coalesce(t.transaction_type, 'unknown') AS transaction_type, t.account_name, m.grp AS category
            FROM txn t JOIN cmap m ON t.category = m.category""",
    ),
    "folded": (("lab",), fold_sql("lab")),
    "scored": (("folded",), oof_sql("folded")),
    "noise": (
        ("scored",),
        """SELECT *, CAST(cv_pred <> category AS INT) AS wrong_flag, cv_pred <> category AND true_label_prob < 0.20 AS flagged_suspicious
           FROM scored""",
    ),
    "pool": (("noise",), "SELECT * FROM noise WHERE flagged_suspicious AND true_label_prob < 0.15"),
    "based": (
        ("noise",),
        "SELECT *, round((1.0::DOUBLE - true_label_prob) + CAST(flagged_suspicious AS INT), 9) AS x FROM noise",
    ),
    "sig": (
        ("based",),
        "SELECT row_id, category, flagged_suspicious, true_label_prob, x, row_number() OVER (ORDER BY x DESC, row_id DESC) - 1 AS pos FROM based",
    ),
    "filesig": (("based",), "SELECT row_id, x, row_number() OVER (ORDER BY row_id) - 1 AS pos FROM based"),
    "splitrows": (("lab",), split_sql("lab")),
    "train": (("splitrows",), "SELECT * EXCLUDE (rn, split) FROM splitrows WHERE split = 'train'"),
    "valid": (("splitrows",), "SELECT * EXCLUDE (rn, split) FROM splitrows WHERE split = 'valid'"),
    "preds": (("train", "valid"), "SELECT * RENAME (cv_pred AS prediction) FROM (" + counting_sql("train", "valid") + ")"),
    "labelset": (("splitrows",), "SELECT DISTINCT category AS label FROM splitrows"),
    "tfolded": (("train",), fold_sql("train")),
    "tnoise": (
        ("tfolded",),
        "SELECT *, CAST(cv_pred <> category AS INT) AS wrong_flag, cv_pred <> category AND true_label_prob < 0.20 AS flagged_suspicious FROM ("
        + oof_sql("tfolded")
        + ")",
    ),
}


def build(body: str, *needs: str, **extra: str) -> str:
    """``body`` with the parts it needs, and ``extra`` named relations after them, as one statement."""
    names: list[str] = []

    def add(name: str) -> None:
        if name not in names:
            for dep in PARTS[name][0]:
                add(dep)
            names.append(name)

    for name in needs:
        add(name)
    parts = [f"{n} AS MATERIALIZED ({PARTS[n][1]})" for n in names] + [f"{n} AS MATERIALIZED ({sql})" if "(" not in n else f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body
