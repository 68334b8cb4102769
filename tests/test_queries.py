"""Every registered query of the engine against its SQL, and the checks that the entry points hold without extras."""

import math
import os

import duckdb
import pytest

from framelake.plans import catalog, catalog_more, catalog_streams  # noqa: F401  all register queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if v is not None and not isinstance(v, (str, int, bool, list)):
        return float(v)
    return v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    cursor = duck.execute(catalog.ORACLES[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    assert got == sorted(str([plain(r[found.index(c)]) for c in columns]) for r in cursor.fetchall())
