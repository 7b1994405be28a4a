"""Driver contract and a few oracle comparisons at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from marquee.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["query_id", "rank", "item_id", "title", "genres_str", "vote_average", "vote_count",
                          "similarity_score"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 70


@pytest.mark.parametrize("name", ["q_content_based", "q_knn_manhattan", "q_catalog_union", "q_correlation_matrix",
                                  "q_nearest_by_value", "q_first_by_role", "q_rating_histogram"])
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    idx = [dcols.index(c) for c in cols]
    want = sorted(tuple(r[i] for i in idx) for r in res.fetchall())
    assert got == want
