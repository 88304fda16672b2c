"""Every query with comparison SQL against DuckDB, over the whole tables."""

import math
from decimal import Decimal

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_module

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = entry_module.oracle_sql()
QUERIES = entry_module.queries()
MOST_FLIPS = 12
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, v)
    return (2, round(float(v), 9) + 0.0) if isinstance(v, (int, float, Decimal)) else (3, str(v))


def ordered(rows, doubles):
    """Rows as cells, in the order of all columns but the floating ones, and then of these."""
    cells = [tuple(map(cell, r)) for r in rows]
    return sorted(cells, key=lambda r: ([c for c, d in zip(r, doubles) if not d], [c for c, d in zip(r, doubles) if d]))


def assert_same(found, wanted, doubles):
    """Equal to 9 digits. Both sides round to 6 digits, so a few values may fall on the other side of a half."""
    found, wanted = ordered(found, doubles), ordered(wanted, doubles)
    assert len(found) == len(wanted)
    flips = [(a, b) for a, b in zip(found, wanted) if a != b]
    for a, b in flips:
        assert all(x == y or (x[0] == y[0] == 2 and abs(x[1] - y[1]) < 1.1e-6) for x, y in zip(a, b)), (a, b)
    assert len(flips) <= MOST_FLIPS, flips[:3]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = df.select(*[f"`{c}`" for c in columns]).collect()
    relation = duck.execute(ORACLES[name])
    kinds = {d[0]: str(d[1]) for d in relation.description}
    names = [d[0] for d in relation.description]
    wanted = [[row[names.index(c)] for c in columns] for row in relation.fetchall()]
    assert sorted(kinds) == columns
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema.fields} == kinds
    assert_same(found, wanted, [kinds[c] == "DOUBLE" for c in columns])


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["smooth_zero_phase_fir", "smooth_wavelet", "smooth_lowess", "fit_logreg", "feature_pipeline", "sweep_filters"])
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).limit(1).count() == 1
