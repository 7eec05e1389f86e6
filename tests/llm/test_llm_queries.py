import pytest
from tests.conftest import DATA, same

from taxoloom.llm.queries import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, DATA)
    if name in SQL:
        same(df, duck, SQL[name])
    else:
        df.collect()
