"""Every operator that has SQL, against it in DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from marquee.llm import oracle
from marquee.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[names.index(c)] for c in df.columns) for r in res.fetchall()), key=str)
    assert sorted((tuple(r) for r in df.collect()), key=str) == want


def test_crc_of_the_sql_is_that_of_zlib():
    import zlib

    text = "17:été-\x7f"
    sql = f"WITH {oracle.CRC_TABLE} SELECT {oracle.crc(oracle.utf8('?'))} FROM crc"
    assert duckdb.connect().execute(sql, [text]).fetchone()[0] == zlib.crc32(text.encode())
