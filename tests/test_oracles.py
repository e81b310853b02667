"""Every registered query against its DuckDB oracle on the small tables (the driver's check
at sf0.01, here at sf0.001 to keep the suite quick)."""

import pytest

import __spark_entry__ as E
from sqlweave.plans import registry
from tests.oracle_check import compare, duck

NAMES = sorted(registry.queries())  # the optional part has its own tests


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, con, name):
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no oracle (rows-only)")
    r = compare(spark, name, E.queries()[name], sql, sf_small, con)
    assert r["cols_match"] and r["hash_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["stmt_id", "kind", "inputs", "outputs", "ctes", "parse_ok"]


def test_every_query_has_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "array<string>": "VARCHAR[]"}


@pytest.mark.parametrize("name", NAMES)
def test_column_types_match_oracle(spark, sf_small, con, name):
    """Same column types on both sides (ints vs bigints would differ in a typed compare)."""
    st = {f.name: f.dataType.simpleString() for f in E.queries()[name](spark, sf_small).schema.fields}
    rel = con.sql(E.oracle_sql()[name])
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t.upper()) for c, t in st.items()} == dt


def test_first_order_measures(spark, sf_small):
    """The measures that depend on a customer's first order, against pandas."""
    o = spark.read.parquet(f"{sf_small}/orders.parquet").toPandas().sort_values(["o_orderdate", "o_orderkey"])
    o["first"] = ~o.duplicated("o_custkey")
    got = {r.o_orderpriority: r for r in registry.queries()["first_order_customers"](spark, sf_small).collect()}
    for priority, g in o.groupby("o_orderpriority"):
        assert got[priority].newcomers == g["first"].sum()
        assert got[priority].with_later_or_finished == g[~g["first"] | (g.o_orderstatus == "F")].o_custkey.nunique()
    cells = registry.queries()["two_level_union"](spark, sf_small).collect()
    assert sum(r.newcomers for r in cells) == o.o_custkey.nunique()
    opening = registry.queries()["opening_month_report"](spark, sf_small).toPandas()
    assert abs((opening.opening_revenue.fillna(0) + opening.returning_revenue.fillna(0) - opening.revenue).sum()) < 0.01
