"""The driver's contract, at the smallest scale."""

import re

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_names():
    known, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(known)
    assert all(re.fullmatch(r"[a-z0-9_]+", n) for n in known)
    for n in (4, 6, 7):
        assert f"p{n}_found" in known


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & {"p4_found", "p7_found", "content_fingerprint", "jsonl_locators", "canonical_url", "asset_coverage"}))
def test_against_sql(spark, name):
    import glob
    import os

    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = entry.queries()[name](spark, SMALL)
    got = con.execute(entry.oracle_sql()[name])
    at = [[d[0] for d in got.description].index(c) for c in df.columns]
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, (tuple(r[i] for i in at) for r in got.fetchall())))
