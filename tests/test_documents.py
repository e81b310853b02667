"""Documents of the column graph: vertices are numbered within the statement's row."""

import json

from sqlweave.operators import export as X

MERGED = ("stmt_id long, edge_pos int, edge_type string, expr string, sources array<struct<label:string,type:string>>, targets array<string>, "
          "ord struct<sink:int,i:int>, made array<struct<label:string,ord:struct<sink:int,i:int>>>")


def _merged(spark):
    rows = [(1, 1, "PREDICATE", "k > 0", [("a.b", "TABLE"), ("t.x", "COLUMN")], ["t.x", "t.y"], (0, 5), [("t.x", (0, 5)), ("t.y", (0, 5))]),
            (1, 0, "PROJECTION", None, [("a.b.c", "COLUMN"), ("t.y", "TABLE")], ["t.x"], (0, 0), [("t.x", (0, 0))]),
            (3, 0, "PROJECTION", 'say "x"', [("ü.v", "TABLE")], [], (1, 0), []),
            (4, 0, "PROJECTION", None, [], [], (0, 0), [])]
    return spark.createDataFrame(rows, MERGED)


def test_documents(spark):
    st = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "stmt_id long")
    docs = X.lineage_json(st, _merged(spark))
    got = {r.stmt_id: json.loads(r.json) for r in docs.collect()}
    v = lambda i, t, n: {"id": i, "vertexType": t, "vertexId": n}
    empty = {"edges": [], "vertices": []}
    assert got == {
        1: {"edges": [{"sources": [2, 1], "targets": [0], "edgeType": "PROJECTION"},
                      {"sources": [3, 0], "targets": [0, 1], "expression": "k > 0", "edgeType": "PREDICATE"}],
            # t.y was created as the source of the first edge
            "vertices": [v(0, "COLUMN", "t.x"), v(1, "TABLE", "t.y"), v(2, "COLUMN", "a.b.c"), v(3, "TABLE", "a.b")]},
        2: empty, 4: empty,
        3: {"edges": [{"sources": [0], "targets": [], "expression": 'say "x"', "edgeType": "PROJECTION"}],
            "vertices": [v(0, "TABLE", "ü.v")]}}
    vertices = {r.stmt_id: json.loads(r.json) for r in X.vertices_json(_merged(spark)).collect()}
    assert vertices == {k: d["vertices"] for k, d in got.items() if d["vertices"]}


def test_no_row_per_occurrence(spark):
    """Before, two windows and two groupings ran over a row for each source and target of each edge."""
    plan = X.lineage_json(spark.createDataFrame([(1,)], "stmt_id long"), _merged(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan
