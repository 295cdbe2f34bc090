import pytest

import __spark_entry__ as entry
from corpusmill import catalog_queries
from tests.conftest import rows


@pytest.mark.parametrize("name", sorted(catalog_queries.ORACLE))
def test_same_as_sql(spark, data, name):
    """Every catalog query against its SQL, on the smallest tables."""
    import glob
    import os
    from collections import Counter

    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = entry.queries()[name](spark, data)
    r = c.sql(entry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(r.columns)
    at = [r.columns.index(x) for x in cols]
    plain = lambda v: round(v, 6) if isinstance(v, float) else float(v) if type(v).__name__ == "Decimal" else v
    mine = Counter(repr([plain(v) for v in x]) for x in df.select(*cols).collect())
    assert mine == Counter(repr([plain(x[i]) for i in at]) for x in r.fetchall())


def test_entry_runs(spark, data):
    assert 0 < len(rows(entry.entry(spark))) <= 10


@pytest.mark.parametrize("name", sorted(set(catalog_queries.QUERIES) - set(catalog_queries.ORACLE)))
def test_runs(spark, data, name):
    assert entry.queries()[name](spark, data).count() > 0
