import pytest
from tests.conftest import DATA, same

from taxoloom.queries import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, DATA)
    if name in SQL:
        same(df, duck, SQL[name])
    else:
        df.collect()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_merge_components(spark, tmp_path):
    """Pairs flagged in any case, with stray blanks, semantic ones too, over both tables."""
    flags = [("SKL_b", "SKL_a", "Label"), ("SKL_c", " SKL_b", " SEMANTIC"), ("OCC_b", "OCC_a", "semantic"), ("OCC_c ", "OCC_b", "label "), ("SKL_d", "SKL_a", ""), ("SKL_e", "SKL_x", "label"), ("SKL_e", None, "label")]
    spark.createDataFrame(flags, "entity_id_a string, entity_id_b string, merge_flag string").write.parquet(f"{tmp_path}/concept_alignments.parquet")
    for name, prefix, ids in (("skills", "SKL", "abcde"), ("occupations", "OCC", "abc")):
        spark.createDataFrame([(f"{prefix}_{i}",) for i in ids], "entity_id string").write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r["node"]: r["component"] for r in QUERIES["merge_components"](spark, str(tmp_path)).collect()}
    assert got == {f"SKL_{i}": "SKL_a" for i in "abc"} | {f"OCC_{i}": "OCC_a" for i in "abc"} | {"SKL_d": "SKL_d", "SKL_e": "SKL_e"}
