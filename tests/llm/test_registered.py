import duckdb
import pytest

import __spark_entry__ as E
from tests.llm.cases import SF
from tidemark.llm import queries as Q


def test_one_query_for_each_operator():
    names = [n for n in Q.QUERIES if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(Q.QUERIES) | {"pipeline"} <= set(E.queries()) and set(Q.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cursor = con.execute(Q.ORACLE[name])
    columns = sorted(d[0] for d in cursor.description)
    want = sorted(map(tuple, cursor.df()[columns].astype(str).values))
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == columns
    assert sorted(map(tuple, df.toPandas()[columns].astype(str).values)) == want
