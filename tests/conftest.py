import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from taxoloom.session import session

    s = session("tests", "8", spark__sql__shuffle__partitions="4", spark__driver__memory="6g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(DATA)):
        con.execute(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    return con


def canon(v):
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return [canon(x) for x in v]
    return "~" if v is None else str(v)


def same(df, duck, sql):
    """Whether a frame and a query have the same columns and rows."""
    columns = sorted(df.columns)
    got = sorted([canon(v) for v in r] for r in df.select(*[f"`{c}`" for c in columns]).collect())
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted([canon(r[i]) for i in at] for r in cur.fetchall())
