"""DuckDB oracles of the column-lineage queries. Source vertex labels come straight from the
keys ('label:TYPE' strings); the sink logic uses DuckDB lists; order-preserving distinct is
spelled out (DuckDB's list_distinct does not keep order)."""

from __future__ import annotations

from sqlweave.plans.lineage_oracle import CORPUS, EXPECTED

GRAPH = r"""
dd AS (
  SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                              ORDER BY l_partkey, l_suppkey, l_returnflag, l_linestatus) rn FROM lineitem)
  WHERE rn = 1),
deps AS (
  SELECT l_orderkey stmt_id,
         CASE WHEN l_orderkey % 5 = 0 AND l_linenumber > 2 THEN 1 ELSE 0 END sink_pos,
         l_linenumber dep_pos, 'PROJECTION' dep_kind,
         CASE WHEN l_orderkey % 4 = 0 THEN NULL
              WHEN l_orderkey % 5 = 0 AND l_linenumber > 2 THEN 'dw.u' || (l_orderkey % 50)::VARCHAR
              ELSE 'dw.t' || (l_orderkey % 50)::VARCHAR END dest_table,
         CASE WHEN l_orderkey % 8 = 0 AND l_linenumber = 3 THEN 'tmp.s'
              ELSE CASE WHEN l_linenumber % 2 = 0 THEN '_u1.c' ELSE 'c' END || l_linenumber::VARCHAR END target_field,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'sum(x)' END expr,
         CASE WHEN l_linestatus = 'F' THEN ['ods.p' || (l_partkey % 3)::VARCHAR || '.a:COLUMN']
              ELSE ['ods.p' || (l_partkey % 3)::VARCHAR || '.a:COLUMN', 'tmp.s:TABLE'] END srcs
  FROM dd
  UNION ALL
  SELECT DISTINCT l_orderkey, 0, 100, 'PREDICATE',
         CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE 'dw.t' || (l_orderkey % 50)::VARCHAR END,
         NULL, 'k > 0', ['ods.p0.k:COLUMN']
  FROM lineitem),
ents AS (
  SELECT o_orderkey stmt_id, CASE o_orderkey % 3 WHEN 0 THEN 'dw.o' || (o_orderkey % 7)::VARCHAR
                                                 WHEN 1 THEN 'dw.p' || (o_orderkey % 5)::VARCHAR END ent_table
  FROM orders),
res AS (
  SELECT stmt_id, CASE WHEN stmt_id % 16 = 0 THEN f[1:len(f) - 1] ELSE f END result_fields
  FROM (SELECT stmt_id, list(target_field ORDER BY dep_pos) f FROM deps WHERE dep_kind = 'PROJECTION' GROUP BY stmt_id)),
sk AS (
  SELECT d.stmt_id, sink_pos, max(dest_table) dest_table,
         count(*) FILTER (WHERE dep_kind = 'PROJECTION') n_deps,
         coalesce(any_value(res.result_fields), []::VARCHAR[]) result_fields
  FROM deps d LEFT JOIN res ON d.stmt_id = res.stmt_id GROUP BY d.stmt_id, sink_pos),
sk2 AS (
  SELECT sk.*, e.ent_table, coalesce(sk.dest_table, e.ent_table) dest,
         regexp_extract(coalesce(sk.dest_table, e.ent_table), '(\d+)$', 1)::INTEGER num
  FROM sk LEFT JOIN ents e USING (stmt_id)),
sk3 AS (
  SELECT *,
    CASE WHEN dest IS NULL THEN []::VARCHAR[]
         ELSE list_transform(range(1, (num % 5) + 2), lambda i: 'c' || i::VARCHAR) END t_cols,
    CASE WHEN dest IS NULL THEN []::VARCHAR[] ELSE (['dt', 'hr', 'mi'])[1:(num % 4)] END t_keys
  FROM sk2),
sk4 AS (
  SELECT *, CASE WHEN dest_table IS NOT NULL THEN t_cols ELSE result_fields END base,
         CASE WHEN dest_table IS NULL AND ent_table IS NOT NULL AND len(t_cols) > 0 THEN t_cols END col_names
  FROM sk3),
sk5 AS (SELECT *, n_deps - len(base) dyn, len(t_keys) - (n_deps - len(base)) off FROM sk4),
sk6 AS (SELECT *, (dest IS NOT NULL AND dyn > 0 AND off >= 0) ext FROM sk5),
sk7 AS (
  SELECT *,
    CASE WHEN ext THEN list_concat(base, t_keys[off + 1 : off + dyn]) ELSE base END fields,
    CASE WHEN ext AND col_names IS NOT NULL THEN list_concat(col_names, t_keys[off + 1 : off + dyn])
         ELSE col_names END cn
  FROM sk6),
sinks AS (
  SELECT *, n_deps = len(fields) ok,
    list_transform(fields, lambda f, i:
      CASE WHEN dest IS NOT NULL THEN dest || '.' ||
             CASE WHEN cn IS NOT NULL AND NOT list_contains(cn, string_split(f, '.')[-1]) THEN cn[i]
                  ELSE string_split(f, '.')[-1] END
           WHEN len(string_split(f, '.')) = 2 AND starts_with(string_split(f, '.')[1], '_u') THEN string_split(f, '.')[2]
           ELSE f END) targets
  FROM sk7),
failed AS (
  SELECT DISTINCT stmt_id FROM sinks WHERE ok AND len(list_filter(targets, lambda x: x IS NULL)) > 0),
pe AS (
  SELECT stmt_id, sink_pos, dep_kind, expr, srcs,
         row_number() OVER (PARTITION BY stmt_id, sink_pos, dep_kind ORDER BY dep_pos) k
  FROM deps),
raw AS (
  SELECT pe.stmt_id, pe.sink_pos, pe.sink_pos * 1000000 + pe.k - 1 ord, 'PROJECTION' edge_type, pe.expr,
         pe.srcs, [s.targets[pe.k]] tgts
  FROM pe JOIN sinks s USING (stmt_id, sink_pos)
  WHERE s.ok AND pe.dep_kind = 'PROJECTION' AND stmt_id NOT IN (SELECT stmt_id FROM failed)
  UNION ALL
  SELECT pe.stmt_id, pe.sink_pos, pe.sink_pos * 1000000 + len(s.fields) + pe.k - 1, 'PREDICATE', pe.expr,
         pe.srcs, list_filter(s.targets, lambda x, i: list_position(s.targets, x) = i)
  FROM pe JOIN sinks s USING (stmt_id, sink_pos)
  WHERE s.ok AND pe.dep_kind = 'PREDICATE' AND stmt_id NOT IN (SELECT stmt_id FROM failed)),
merged AS (
  SELECT stmt_id, row_number() OVER (PARTITION BY stmt_id ORDER BY ord) - 1 edge_pos, edge_type, expr, srcs,
         list_filter(t, lambda x, i: list_position(t, x) = i) tgts
  FROM (SELECT stmt_id, edge_type, expr, min(ord) ord, arg_min(srcs, ord) srcs, flatten(list(tgts ORDER BY ord)) t
        FROM raw GROUP BY stmt_id, edge_type, expr, list_sort(srcs))),
ut AS (SELECT stmt_id, edge_pos, unnest(tgts) label, generate_subscripts(tgts, 1) p FROM merged),
us AS (SELECT stmt_id, edge_pos, unnest(srcs) s, generate_subscripts(srcs, 1) p FROM merged),
vt AS (
  SELECT stmt_id, label, edge_pos * 1000 + p seen FROM ut
  UNION ALL
  SELECT stmt_id, split_part(s, ':', 1), 1000000000 + edge_pos * 1000 + p FROM us),
made AS (
  SELECT stmt_id, unnest(tgts) label, 'COLUMN' vtype, ord * 2000 created FROM raw
  UNION ALL
  SELECT stmt_id, split_part(s, ':', 1), split_part(s, ':', 2), ord * 2000 + p
  FROM (SELECT stmt_id, ord, unnest(srcs) s, generate_subscripts(srcs, 1) p FROM raw)),
types AS (SELECT stmt_id, label, arg_min(vtype, created) vtype FROM made GROUP BY stmt_id, label),
verts AS (
  SELECT stmt_id, row_number() OVER (PARTITION BY stmt_id ORDER BY seen) - 1 id, vtype vertex_type, label vertex_id
  FROM (SELECT stmt_id, label, min(seen) seen FROM vt GROUP BY stmt_id, label) JOIN types USING (stmt_id, label)),
src_ids AS (
  SELECT us.stmt_id, us.edge_pos, string_agg(v.id::VARCHAR, ',' ORDER BY us.p) ids
  FROM us JOIN verts v ON v.stmt_id = us.stmt_id AND v.vertex_id = split_part(us.s, ':', 1)
  GROUP BY us.stmt_id, us.edge_pos),
tgt_ids AS (
  SELECT ut.stmt_id, ut.edge_pos, string_agg(v.id::VARCHAR, ',' ORDER BY ut.p) ids
  FROM ut JOIN verts v ON v.stmt_id = ut.stmt_id AND v.vertex_id = ut.label
  GROUP BY ut.stmt_id, ut.edge_pos),
ejson AS (
  SELECT m.stmt_id, m.edge_pos,
         '{"sources":[' || coalesce(s.ids, '') || '],"targets":[' || coalesce(t.ids, '') || ']'
         || CASE WHEN m.expr IS NOT NULL THEN ',"expression":"' || m.expr || '"' ELSE '' END
         || ',"edgeType":"' || m.edge_type || '"}' json
  FROM merged m LEFT JOIN src_ids s USING (stmt_id, edge_pos) LEFT JOIN tgt_ids t USING (stmt_id, edge_pos)),
vjson AS (
  SELECT stmt_id, '[' || string_agg('{"id":' || id::VARCHAR || ',"vertexType":"' || vertex_type
                                    || '","vertexId":"' || vertex_id || '"}', ',' ORDER BY id) || ']' json
  FROM verts GROUP BY stmt_id)"""


def _w() -> str:
    return "WITH " + GRAPH.strip("\n") + "\n"


def oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    o["op_filter"] = ("WITH " + CORPUS.strip("\n") + "," + EXPECTED.strip("\n") + "\n"
                      "SELECT stmt_id, kind FROM all_exp WHERE parse_ok AND kind IN "
                      "('query','insert','ctas','create_view','alter_view_as')")
    o["dest_resolve"] = _w() + "SELECT stmt_id, sink_pos, dest FROM sinks"
    o["dynamic_partition_fields"] = _w() + "SELECT stmt_id, sink_pos, array_to_string(fields, ',') fields FROM sinks"
    o["field_count_check"] = _w() + "SELECT stmt_id, sink_pos, n_deps, len(fields)::BIGINT n_fields, ok FROM sinks"
    o["field_count_mismatches"] = _w() + (
        "SELECT stmt_id, sink_pos, n_deps, len(fields)::BIGINT n_fields, 'result schema: ' || len(fields)::VARCHAR "
        "|| ' fields, dependencies: ' || n_deps::VARCHAR message FROM sinks WHERE NOT ok")
    o["target_labels"] = _w() + "SELECT stmt_id, sink_pos, array_to_string(targets, ',') targets FROM sinks WHERE ok"
    o["source_vertices"] = _w() + ("SELECT stmt_id, sink_pos, dep_pos, dep_kind, array_to_string(srcs, ',') sources "
                                   "FROM deps")
    o["predicate_edges"] = _w() + ("SELECT stmt_id, sink_pos, expr, array_to_string(srcs, ',') sources, "
                                   "array_to_string(tgts, ',') targets FROM raw WHERE edge_type = 'PREDICATE'")
    o["projection_edges"] = _w() + ("SELECT stmt_id, sink_pos, (ord - sink_pos * 1000000)::BIGINT idx, expr, "
                                    "array_to_string(srcs, ',') sources, array_to_string(tgts, ',') targets "
                                    "FROM raw WHERE edge_type = 'PROJECTION'")
    o["edge_merge"] = _w() + ("SELECT stmt_id, edge_pos, edge_type, expr, array_to_string(srcs, ',') sources, "
                              "array_to_string(tgts, ',') targets FROM merged")
    o["vertex_ids"] = _w() + "SELECT stmt_id, id, vertex_type, vertex_id FROM verts"
    o["edges_json"] = _w() + "SELECT stmt_id, edge_pos, json FROM ejson"
    o["vertices_json"] = _w() + "SELECT stmt_id, json FROM vjson"
    o["lineage_json"] = _w() + """, docs AS (
  SELECT stmt_id, '{"edges":[' || coalesce(string_agg(e.json, ',' ORDER BY e.edge_pos), '') || ']' e
  FROM (SELECT DISTINCT stmt_id FROM deps) s LEFT JOIN ejson e USING (stmt_id) GROUP BY stmt_id)
SELECT stmt_id, e || ',"vertices":' || coalesce(v.json, '[]') || '}' json FROM docs LEFT JOIN vjson v USING (stmt_id)"""
    o["document_sink"] = f"SELECT json FROM ({o['lineage_json']})"
    o["job_ids"] = """
SELECT l_orderkey stmt_id,
       coalesce(string_agg(CASE WHEN l_linestatus = 'F' THEN NULL
                                ELSE 'job_' || l_linenumber::VARCHAR || '_' || l_partkey::VARCHAR END,
                           ',' ORDER BY l_linenumber, l_partkey), '') job_ids
FROM lineitem GROUP BY l_orderkey"""
    return o
