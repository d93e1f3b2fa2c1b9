"""Every registered query against its SQL on the smallest tables, as rows in any order; queries without SQL run at least."""

import math
import os

import pytest

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def catalog():
    from corpusengine.plans import catalog as c

    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return str(v) if v is not None and not isinstance(v, (bool, int, str)) else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in data), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", list(catalog().QUERIES))
def test_query(spark, name):
    c = catalog()
    got = c.QUERIES[name](spark, SF)
    assert len(set(got.columns)) == len(got.columns)
    mine = rows(got.columns, [tuple(r) for r in got.collect()])
    if name not in c.SQL:
        assert mine
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(c.SQL[name])
    assert mine == rows([d[0] for d in want.description], want.fetchall())
