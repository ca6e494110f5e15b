import duckdb
import pytest

import __spark_entry__ as entry_mod
from adsentry.catalog import ORACLE, QUERIES
from adsentry.sources.fixtures import TABLES

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["ip", "size", "flag", "coef"]
    assert len(df.collect()) > 0


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if v != v else f"{v:.9g}"
    return repr(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_small(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    got = sorted("|".join(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    res = duck.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted("|".join(_norm(r[i]) for i in order) for r in res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_in_plans(spark, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


SPARK_TO_DUCK = {
    "IntegerType()": "INTEGER",
    "LongType()": "BIGINT",
    "StringType()": "VARCHAR",
    "DoubleType()": "DOUBLE",
    "BooleanType()": "BOOLEAN",
    "DateType()": "DATE",
    "TimestampNTZType()": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle_types_match(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    spark_types = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    res = duck.execute(entry_mod.oracle_sql()[name])
    assert spark_types == {d[0]: str(d[1]) for d in res.description}
