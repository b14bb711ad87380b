import math

import duckdb
import pytest

from tiffin.llm import queries

TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]


def plain(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, sf_dir)
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    order = [want.columns.index(c) for c in cols]
    assert (sorted(str(tuple(plain(r[c]) for c in cols)) for r in got.collect())
            == sorted(str(tuple(plain(r[i]) for i in order)) for r in want.fetchall()))
