"""Queries of the training-data operators against their SQL in DuckDB, over the whole tables."""

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return (0, "")
    return (1, round(float(v), 6)) if isinstance(v, (int, float)) else (2, str(v))


def compare(duck, df, sql):
    columns = sorted(df.columns)
    relation = duck.execute(sql)
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    wanted = [[row[names.index(c)] for c in columns] for row in relation.fetchall()]
    found = df.select(*columns).collect()
    order = lambda rows: sorted(tuple(map(cell, r)) for r in rows)
    assert order(found) == order(wanted)


def names():
    from tallyloom.llm.queries import ORACLES

    return sorted(ORACLES)


@pytest.mark.parametrize("name", names())
def test_query_matches_sql(spark, duck, name):
    from tallyloom.llm.queries import ORACLES, QUERIES

    compare(duck, QUERIES[name](spark, SF_DIR), ORACLES[name])


BASE = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w, unnest(range(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')))) AS p FROM documents
), windows AS (
    SELECT doc_id, p, w || ' ' || lead(w) OVER d || ' ' || lead(w, 2) OVER d AS g FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY p)
), twice AS (
    SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows WHERE g IS NOT NULL) WHERE n > 1
), lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents
), line_counts AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
)
SELECT d.doc_id, count(w.p)::BIGINT AS n_words, coalesce(sum(length(w.w)), 0)::BIGINT AS word_chars, any_value(len(regexp_extract_all(d.text, '[#*$%&|<>]')))::BIGINT AS n_symbols,
    any_value(coalesce(l.n, 0))::BIGINT AS n_dup_lines, count(t.p)::BIGINT AS n_repeat_words, count(w.p) < 50 OR 100 * count(t.p) > 50 * count(w.p) AS base_failed
FROM documents d LEFT JOIN words w USING (doc_id) LEFT JOIN twice t ON t.doc_id = w.doc_id AND t.p = w.p LEFT JOIN line_counts l ON l.doc_id = d.doc_id GROUP BY d.doc_id
"""


def test_quality_base_columns_match_sql(spark, duck):
    from tallyloom.llm.queries import QUERIES

    found = QUERIES["op5_quality_rules"](spark, SF_DIR)
    compare(duck, found.drop("n_covered_words", "longest_repeat", "kept"), BASE)
