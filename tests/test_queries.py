import os

import duckdb
import pytest

from almanack.plans import registry

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    got, want = registry.QUERIES[name](spark, D).toPandas(), con.execute(registry.SQL[name]).df()
    assert set(got.columns) == set(want.columns)
    columns = sorted(got.columns)

    def rows(frame):
        return frame[columns].astype(str).sort_values(columns).reset_index(drop=True)

    assert rows(got).equals(rows(want))
