"""Column graph against a sequential brute-force twin of the edge/vertex algorithm, on the
small fixture (sf0.001)."""

import json

from sqlweave.operators import columns as G
from sqlweave.operators import export as X
from sqlweave.sources import column_fixture as CF


def _brute(deps, ents, schemas, results=None):
    """Sequential reference semantics, one statement at a time, sinks in order."""
    by_stmt = {}
    for d in deps:
        by_stmt.setdefault(d["stmt_id"], []).append(d)
    ent_of = {}
    for e in sorted(ents, key=lambda e: (e["stmt_id"], e["pos"])):
        if e["entity_type"] in ("TABLE", "PARTITION"):
            ent_of.setdefault(e["stmt_id"], e["name"])
    docs = {}
    for sid, rows in by_stmt.items():
        edges, failed, types = [], False, {}
        for sink in sorted({r["sink_pos"] for r in rows}):
            rs = [r for r in rows if r["sink_pos"] == sink]
            proj = sorted([r for r in rs if r["dep_kind"] == "PROJECTION"], key=lambda r: r["dep_pos"])
            preds = sorted([r for r in rs if r["dep_kind"] == "PREDICATE"], key=lambda r: r["dep_pos"])
            dest_table = max([r["dest_table"] for r in rs if r["dest_table"]], default=None)
            ent = ent_of.get(sid)
            dest = dest_table or ent
            cols, keys = schemas.get(dest, ([], []))
            fields = list(cols) if dest_table else (
                [r["target_field"] for r in proj] if results is None else list(results.get(sid, [])))
            col_names = list(cols) if (not dest_table and ent and cols) else None
            if dest and len(proj) > len(fields):
                dyn = len(proj) - len(fields)
                off = len(keys) - dyn
                if off >= 0:
                    fields += keys[off:off + dyn]
                    if col_names is not None:
                        col_names += keys[off:off + dyn]
            if len(proj) != len(fields):
                continue
            targets = []
            for i, f in enumerate(fields):
                parts = f.split(".")
                if dest:
                    c = parts[-1]
                    if col_names is not None and c not in col_names:
                        if i >= len(col_names):
                            failed = True
                            break
                        c = col_names[i]
                    targets.append(f"{dest}.{c}")
                elif len(parts) == 2 and parts[0].startswith("_u"):
                    targets.append(parts[1])
                else:
                    targets.append(f)
            if failed:
                break

            def srcs(r):
                out = []
                for s in r["sources"]:
                    if s["is_temporary"]:
                        continue
                    lab = ".".join(x for x in (s["db"], s["tbl"], s["col"]) if x is not None)
                    v = (lab, "TABLE" if s["col"] is None else "COLUMN")
                    if v not in out:
                        out.append(v)
                return out

            def add(sources, tgts, expr, typ):
                for e in edges:
                    if e["type"] == typ and e["expr"] == expr and set(e["sources"]) == set(sources):
                        for t in tgts:
                            if t not in e["targets"]:
                                e["targets"].append(t)
                        return
                edges.append({"sources": sources, "targets": list(dict.fromkeys(tgts)), "expr": expr, "type": typ})

            for i, r in enumerate(proj):
                types.setdefault(targets[i], "COLUMN")
                for lab, typ in srcs(r):
                    types.setdefault(lab, typ)
                add(srcs(r), [targets[i]], r["expr"], "PROJECTION")
            for r in preds:
                for lab, typ in srcs(r):
                    types.setdefault(lab, typ)
                add(srcs(r), list(dict.fromkeys(targets)), r["expr"], "PREDICATE")
        if failed:
            edges = []
        ids = {}
        for e in edges:
            for t in e["targets"]:
                ids.setdefault(t, len(ids))
        for e in edges:
            for lab, typ in e["sources"]:
                ids.setdefault(lab, len(ids))
        out_edges = []
        for e in edges:
            d = {"sources": [ids[s[0]] for s in e["sources"]], "targets": [ids[t] for t in e["targets"]]}
            if e["expr"] is not None:
                d["expression"] = e["expr"]
            d["edgeType"] = e["type"]
            out_edges.append(d)
        verts = [{"id": i, "vertexType": types[l], "vertexId": l} for l, i in sorted(ids.items(), key=lambda x: x[1])]
        docs[sid] = json.dumps({"edges": out_edges, "vertices": verts}, separators=(",", ":"))
    return docs


def test_graph_matches_sequential_twin(spark, sf_small):
    deps = G.by_statement(CF.column_deps(spark, sf_small))
    ents = CF.write_entities(spark, sf_small)
    sch = CF.table_schemas(spark, sf_small)
    merged, verts = G.column_graph(deps, ents, sch)
    got = {r.stmt_id: r.json for r in X.lineage_json(CF.fixture_statements(spark, sf_small), merged).collect()}
    rows = [r.asDict(recursive=True) for r in deps.collect()]
    schemas = {r.table_name: (r.cols, r.partition_keys) for r in sch.collect()}
    want = _brute(rows, [r.asDict() for r in ents.collect()], schemas)
    assert got == want
    # a label that is first a source table and then a target column stays a table
    assert any('"vertexType":"TABLE","vertexId":"tmp.s"' in d and '"id":2,"vertexType":"TABLE","vertexId":"tmp.s"' in d
               for d in got.values())


def test_result_schema_against_sequential_twin(spark, sf_small):
    """Sinks without a table of their own are checked against the result schema of the statement."""
    deps, ents, sch = G.by_statement(CF.column_deps(spark, sf_small)), CF.write_entities(spark, sf_small), CF.table_schemas(spark, sf_small)
    res = CF.result_fields(spark, sf_small)
    merged, _ = G.column_graph(deps, ents, sch, res)
    got = {r.stmt_id: r.json for r in X.lineage_json(CF.fixture_statements(spark, sf_small), merged).collect()}
    results = {}
    for r in sorted(res.collect()):
        results.setdefault(r.stmt_id, []).append(r.name)
    want = _brute([r.asDict(recursive=True) for r in deps.collect()], [r.asDict() for r in ents.collect()],
                  {r.table_name: (r.cols, r.partition_keys) for r in sch.collect()}, results)
    assert got == want
    sinks = G.sinks(deps, ents, sch, res)
    own = sinks.where("dest_table IS NULL").groupBy("ok").count().collect()
    assert len(own) == 2  # both outcomes occur where the sink has no table
    bad = G.count_mismatches(sinks).where("stmt_id % 4 = 0").collect()
    assert bad and all(r.n_deps != r.n_fields and str(r.n_fields) in r.message for r in bad)


def test_result_schema_cases(spark):
    """Equal, one lost, one too many, no rows at all, and a destination whose partition keys fill the gap."""
    dep = "stmt_id long, sink_pos int, dep_pos int, dep_kind string, dest_table string, target_field string, expr string, sources " + CF.SOURCES_TYPE
    src = [("o", "p", "a", False)]
    deps = spark.createDataFrame([(i, 0, k, "PROJECTION", None, f"c{k}", None, src) for i in range(1, 6) for k in (1, 2)], dep)
    ents = spark.createDataFrame([(5, 0, "TABLE", "d.t")], "stmt_id long, pos int, entity_type string, name string")
    sch = spark.createDataFrame([("d.t", ["c1"], ["dt"])], "table_name string, cols array<string>, partition_keys array<string>")
    names = {1: ["c1", "c2"], 2: ["c1"], 3: ["c1", "c2", "c3"], 5: ["c1"]}
    res = spark.createDataFrame([(i, k, n) for i, ns in names.items() for k, n in reversed(list(enumerate(ns)))], "stmt_id long, pos int, name string")
    got = {r.stmt_id: (r.ok, r.fields, r.targets) for r in G.sinks(deps, ents, sch, res).collect()}
    assert {i: x[0] for i, x in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: True}
    assert got[1][2] == ["c1", "c2"] and got[4][1] == [] and got[5][2] == ["d.t.c1", "d.t.dt"]
    assert {r.stmt_id for r in G.raw_edges(G.sinks(deps, ents, sch, res)).collect()} == {1, 5}
    assert sorted(r.stmt_id for r in G.count_mismatches(G.sinks(deps, ents, sch, res)).collect()) == [2, 3, 4]


def test_vertex_ids_dense_and_merge_idempotent(spark, sf_small):
    deps = CF.column_deps(spark, sf_small)
    ents = CF.write_entities(spark, sf_small)
    merged, verts = G.column_graph(deps, ents, CF.table_schemas(spark, sf_small))
    ids = {}
    for r in verts.collect():
        ids.setdefault(r.stmt_id, []).append(r.id)
    assert all(sorted(v) == list(range(len(v))) for v in ids.values())
    again = G.merge_edges(merged.withColumn("ord", merged.edge_pos).drop("edge_pos"))
    a = sorted((r.stmt_id, r.edge_pos, tuple(r.targets)) for r in merged.collect())
    b = sorted((r.stmt_id, r.edge_pos, tuple(r.targets)) for r in again.collect())
    assert a == b


def test_documents_sink_roundtrip(spark, sf_small):
    import json as _json
    from sqlweave.session import scratch_path
    deps = G.by_statement(CF.column_deps(spark, sf_small))
    merged, _ = G.column_graph(deps, CF.write_entities(spark, sf_small), CF.table_schemas(spark, sf_small))
    docs = X.lineage_json(CF.fixture_statements(spark, sf_small), merged)
    path = X.write_documents(docs, scratch_path(spark, "t-docs"))
    back = spark.read.json(path)
    assert back.count() == docs.count()
    first = _json.loads(docs.first().json)
    assert set(first) == {"edges", "vertices"}
