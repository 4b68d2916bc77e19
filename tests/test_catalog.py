"""Every registered query against its SQL, over the smallest tables."""

import glob
import os

import duckdb
import pytest

from sparkloom.plans import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return c


def plain(df):
    out = df[sorted(df.columns)].copy()
    for c in out.columns:
        if out[c].dtype.kind in "fiu" or out[c].map(lambda x: type(x).__name__ == "Decimal").any():
            out[c] = out[c].astype(float).round(9)
    out = out.astype(str).replace({"None": "nan", "<NA>": "nan", "NaT": "nan"})
    return out.sort_values(list(out.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query_matches_its_sql(spark, duck, name):
    got = plain(catalog.QUERIES[name](spark, DATA).toPandas())
    want = plain(duck.execute(catalog.ORACLE_SQL[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_entry_has_the_flagship_and_every_query():
    import __spark_entry__

    assert catalog.FLAGSHIP in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
