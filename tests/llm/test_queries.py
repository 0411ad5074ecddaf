import duckdb
import pytest

from citylake.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs_over_its_whole_table(spark, name):
    df = queries.QUERIES[name](spark, SF)
    table = "pages" if name.startswith("op2_") else "documents"
    if name not in queries.ORACLE_SQL:
        assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
        return
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(str, df.select(*want.columns).toPandas().itertuples(index=False, name=None))) == sorted(
        map(str, want.df().itertuples(index=False, name=None))
    )
