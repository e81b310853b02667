"""The token walk: no token is shuffled or sorted by Spark, and slices of a batch give what the whole batch gives."""

import pyarrow as pa
import pytest

from sqlweave.operators import refs as R
from sqlweave.operators import tokens as K
from sqlweave.operators.lineage import lineage

SQLS = ["insert into a.t select * from b.u join c.v on (1=1)", "", None, "with w as (select * from d.x) select * from w, (e.y join q)",
        ") from a", "select a from (select b from f.g, h where k in (select k from i))", "select from, k from t"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("make", [
    lambda df: lineage(df), lambda df: R.ref_list(R.token_refs(df)), lambda df: R.ref_counts(R.token_refs(df)),
    lambda df: K.scope_tokens(K.tokenize(df)).groupBy("stmt_id").max("d")])
def test_tokens_stay_in_their_statement(spark, make):
    """Before, two or three sorts of the token rows fed the windows: they spilled 10 times the text at size."""
    plan = _plan(make(spark.createDataFrame(list(enumerate(SQLS)), "stmt_id long, sql string")))
    assert "Window" not in plan


def test_slices_give_the_whole(spark, monkeypatch):
    toks = [None if s is None else s.replace("(", " ( ").replace(")", " ) ").replace(",", " , ").split() for s in SQLS] * 3
    copies = [1, 2, 1, 3, 1, 1, 4] * 3
    args = pa.array(toks, pa.list_(pa.string())), pa.array(copies)
    whole = [f(*args).to_pylist() for f in (R._labelled, K._scoped)]
    assert [r["tok"] for r in whole[0][0]["refs"]] == ["a.t", "b.u", "c.v"]
    assert [whole[0][i]["balanced"] for i in (0, 1, 2, 4, 5)] == [True, True, True, False, True]
    for size in (1, 13, 40):
        monkeypatch.setattr(K, "SLICE_TOKENS", size)
        assert [f(*args).to_pylist() for f in (R._labelled, K._scoped)] == whole
        assert [f(*(a.slice(3) for a in args)).to_pylist() for f in (R._labelled, K._scoped)] == [w[3:] for w in whole]


def test_two_texts_of_an_id_stay_apart(spark):
    df = spark.createDataFrame([(1, "select a from x, y"), (1, "insert into z select b from v"), (2, "select 1")], "stmt_id long, sql string")
    got = {(r.stmt_id, r.role, r.table_name) for r in R.token_refs(df).collect()}
    assert got == {(1, "in", "x"), (1, "in", "y"), (1, "out", "z"), (1, "in", "v"), (2, None, None)}


def test_no_rows(spark):
    df = spark.createDataFrame([], "stmt_id long, sql string")
    assert lineage(df).collect() == [] and R.token_refs(df).collect() == []
