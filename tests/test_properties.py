"""Properties of the lineage job."""

from hypothesis import given, settings
from hypothesis import strategies as st

from sqlweave.operators.lineage import lineage
from sqlweave.operators.refs import ref_counts, token_refs
from sqlweave.operators import statements as S

BASE = ["insert into a.t select * from b.u join c.v on 1=1",
        "with w as (select * from d.x) select * from w, e.y where k in (select k from f.z)",
        "create table g.h as select k from i.j union all select k from k.l"]

NOISE = st.sampled_from(["/* from junk.a */ ", "-- from junk.b\n", " 'from junk.c' ", "\n\n   \n", " "])


def _sets(spark, sqls):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sqls)], "stmt_id long, sql string")
    return {r.stmt_id: (tuple(r.inputs), tuple(r.outputs), tuple(r.ctes)) for r in lineage(df).collect()}


@settings(max_examples=5, deadline=None)
@given(st.lists(NOISE, min_size=3, max_size=3))
def test_comments_blanks_literals_do_not_change_lineage(spark, noise):
    want = _sets(spark, BASE)
    noisy = [s.replace(" from ", f" {n}from ", 1).replace(" select ", f" select {n}", 1)
             for s, n in zip(BASE, noise)]
    noisy = [s.replace("'from junk.c'", "'from junk.c' as x") if "'from" in s and " as x" not in s else s
             for s in noisy]
    got = _sets(spark, noisy)
    for i in want:
        assert got[i][:2] == want[i][:2]


def test_concatenated_scripts_give_union(spark):
    a = spark.createDataFrame([("a", ";\n".join(BASE[:2]))], "sql_file string, content string")
    b = spark.createDataFrame([("a", ";\n".join(BASE))], "sql_file string, content string")
    ids = lambda df: S.with_stmt_id(S.clean_statements(S.split_statements(df)))
    ra = {tuple(r.inputs) for r in lineage(ids(a)).collect()}
    rb = {tuple(r.inputs) for r in lineage(ids(b)).collect()}
    assert ra < rb and len(rb - ra) == 1


def test_ref_counts_at_least_set_sizes(spark):
    sqls = BASE + ["select * from t join t on 1=1 join u on 1=1"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sqls)], "stmt_id long, sql string")
    counts = {}
    for r in ref_counts(token_refs(df)).collect():
        counts[r.stmt_id] = counts.get(r.stmt_id, 0) + r.n
    rec = {r.stmt_id: r for r in lineage(df).collect()}
    for i, r in rec.items():
        assert counts.get(i, 0) >= len(r.from_inputs)
    assert counts[3] == 3


def test_dedup_copies(spark):
    """A statement delivered many times under its id gives one, unchanged record."""
    rows = [(i, s) for i, s in enumerate(BASE)] + [(0, BASE[0])] * 500
    df = spark.createDataFrame(rows, "stmt_id long, sql string")
    want = _sets(spark, BASE)
    got = {r.stmt_id: (tuple(r.inputs), tuple(r.outputs), tuple(r.ctes)) for r in lineage(df, dedup=True).collect()}
    assert got == want
