"""Every registered query vs its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.oracle_harness import digest, duck, rows_of

SF = "/root/testdata/sf0.001"
TYPE_MAP = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
            "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "DATE": "date"}
SQL = E.oracle_sql()
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [r.asDict(recursive=True) for r in df.collect()]
    if name not in SQL:
        assert rows is not None
        return
    cur = con.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    assert sorted(dcols) == sorted(df.columns)
    duck_types = {c[0]: TYPE_MAP.get(str(c[1]), str(c[1])) for c in cur.description}
    for c, t in df.dtypes:
        assert duck_types[c] == ("timestamp" if t == "timestamp_ntz" else t), (c, t, duck_types[c])
    cols = sorted(df.columns)
    assert len(rows) == len(drows)
    assert digest(rows_of(rows, cols)) == digest(rows_of(drows, cols))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"category", "count", "avg_price", "never_worn"}
