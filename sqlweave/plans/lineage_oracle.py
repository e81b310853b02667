"""DuckDB SQL oracles for the lineage queries.

The expected lineage comes from keys (orders, lineitem, customer), never from parsing SQL
text; only the text-cleaning oracles rebuild the corpus text with DuckDB string functions.
DuckDB's RE2 has no back-references and no possessive runs, so its patterns are the
plain forms of the ones in ``sqlweave.functions.text``.
"""

from __future__ import annotations

WS = "chr(32) || chr(10) || chr(13) || chr(9)"

CORPUS = """
corpus_src AS (
  SELECT l_orderkey id,
         list(struct_pack(n := l_linenumber, p := l_partkey, u := l_suppkey)
              ORDER BY l_linenumber, l_partkey, l_suppkey) x
  FROM lineitem GROUP BY l_orderkey),
corpus_b AS (
  SELECT o_orderkey id, o_custkey, o_orderkey % 6 f, 'dw.cust_' || o_custkey::VARCHAR tgt,
         list_transform(x, lambda y: 'ods.part_' || y.p::VARCHAR) ps,
         list_transform(x, lambda y: 'ods.supp_' || y.u::VARCHAR) us
  FROM orders JOIN corpus_src ON o_orderkey = id),
corpus AS (
  SELECT id stmt_id, o_custkey, CASE f
    WHEN 0 THEN 'insert overwrite table ' || tgt || ' partition (dt) select a.k, ''x from zz.trap'' as c from '
                || array_to_string(list_transform(ps, lambda p, i: p || ' t' || (i - 1)::VARCHAR), ' left join ')
    WHEN 1 THEN 'with w as (select * from ' || ps[1] || ') insert into ' || tgt || ' select * from w join '
                || array_to_string(us, ' join ')
    WHEN 2 THEN 'create table ' || tgt || ' as '
                || array_to_string(list_transform(ps, lambda p: 'select k, extract(year from ts) from ' || p), ' union all ')
    WHEN 3 THEN 'select a from (select a from ' || array_to_string(ps, ', ')
                || ' where a > 1 group by a) q where q.a in (select k from ' || us[1] || ')'
    WHEN 4 THEN 'from ' || ps[1] || ' insert into table ' || tgt || '_a select k insert into table ' || tgt || '_b select k'
    ELSE 'insert into `dw`.`' || substr(tgt, 4) || '` select * from ('
         || array_to_string(list_transform(ps, lambda p: 'select k from ' || p), ' union ')
         || ') z lateral view explode(z.k) e as v'
  END sql FROM corpus_b)"""

EXPECTED = """
exp_src AS (
  SELECT o_orderkey id, o_custkey, o_orderkey % 6 f, l_partkey p, l_suppkey u,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) rn
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
exp_in AS (
  SELECT id, 'ods.part_' || p::VARCHAR t FROM exp_src WHERE f IN (0,2,3,5) OR (rn = 1 AND f IN (1,4))
  UNION SELECT id, 'ods.supp_' || u::VARCHAR FROM exp_src WHERE f = 1 OR (f = 3 AND rn = 1)
  UNION SELECT id, 'w' FROM exp_src WHERE f = 1),
exp_from AS (SELECT * FROM exp_in WHERE NOT (t LIKE 'ods.supp_%' AND id % 6 = 3)),
exp_out AS (
  SELECT DISTINCT id, 'dw.cust_' || o_custkey::VARCHAR t FROM exp_src WHERE f IN (0,1,2,5)
  UNION SELECT id, 'dw.cust_' || o_custkey::VARCHAR || '_a' FROM exp_src WHERE f = 4
  UNION SELECT id, 'dw.cust_' || o_custkey::VARCHAR || '_b' FROM exp_src WHERE f = 4),
exp_cte AS (SELECT DISTINCT id, 'w' t FROM exp_src WHERE f = 1),
cmd AS (
  SELECT -1 - c_custkey stmt_id, c_custkey % 69 g, 'db_' || c_nationkey::VARCHAR db,
         'db_' || c_nationkey::VARCHAR || '.t_' || c_custkey::VARCHAR tb,
         'db_' || c_nationkey::VARCHAR || '.v_' || c_custkey::VARCHAR vw
  FROM customer),
forms(g, kind, ins, outs, ctes, ok) AS (VALUES
  (18, 'query', '', '', '', true),
  (19, 'load_data', '', '{t}', '', true),
  (20, 'analyze_table', '', '{t}', '', true),
  (21, 'truncate_table', '', '{t}', '', true),
  (22, 'merge', '{b}', '{t}', '', true),
  (23, 'update', '{b}', '{t}', '', true),
  (24, 'delete', '{b}', '{t}', '', true),
  (25, 'replace_table_as', '{b}', '{t}', '', true),
  (26, 'cache_table_as', '{b}', '{v}', '', true),
  (27, 'create_view', '{b}', '{v}', '', true),
  (28, 'unknown', '', '', '', false),
  (29, 'query', '{t}', '', '', true),
  (30, 'insert', '{b}', '{t}', '', true),
  (31, 'query', '{t}', '', '', true),
  (32, 'query', '{t}', '', '', true),
  (33, 'query', '{t}', '', '', true),
  (34, 'query', '{t}', '', '', true),
  (35, 'query', '{t}', '', '', true),
  (36, 'query', '{t}', '', '', true),
  (37, 'query', '{t}', '', '', true),
  (38, 'query', '{t}', '', '', true),
  (39, 'query', '{b},{t}', '', '', true),
  (40, 'query', '{b},{t}', '', '', true),
  (41, 'query', '{b},{t}', '', '', true),
  (42, 'query', '{t}', '', '', true),
  (43, 'query', '{b},{t}', '', '', true),
  (44, 'query', '{t}', '', '', true),
  (45, 'query', '{b},{t}', '', '', true),
  (46, 'query', '{b},{t},{v}', '', '', true),
  (47, 'query', '{t}', '', '', true),
  (48, 'query', '{t}', '', '', true),
  (49, 'insert', '{b},w', '{t}', 'w', true),
  (50, 'query', '{t}', '', '', true),
  (51, 'query', '{b},{t}', '', '', true),
  (52, 'query', '{b},{t}', '', '', true),
  (53, 'query', '{b},{t}', '', '', true),
  (54, 'insert', '{b}', '{t}', '', true),
  (55, 'insert', '{b}', '{t}', '', true),
  (56, 'ctas', '{b}', '{t}', '', true),
  (57, 'query', '{b},w', '', 'w', true),
  (58, 'query', '{b},{t}', '', '', true),
  (59, 'query', '{b},{t}', '', '', true),
  (60, 'query', '{t}', '', '', true),
  (61, 'rename_table', '{t}', '{v}', '', true),
  (62, 'set_properties', '', '{t}', '', true),
  (63, 'drop_view', '', '{v}', '', true),
  (64, 'describe_table', '{t}', '', '', true),
  (65, 'refresh_table', '{t}', '', '', true),
  (66, 'query', '{b},{t},{v}', '', '', true),
  (67, 'alter_table', '', '{t}', '', true),
  (68, 'uncache_table', '{v}', '', '', true)),
cmd_exp AS (
  SELECT stmt_id, kind, replace(replace(replace(ins, '{t}', tb), '{b}', db || '.base'), '{v}', vw) inputs,
         replace(replace(outs, '{t}', tb), '{v}', vw) outputs, ctes, ok parse_ok
  FROM cmd JOIN forms USING (g)
  UNION ALL
  SELECT stmt_id,
         ['create_database','drop_database','alter_database','create_table_like','add_partition',
          'drop_partition','add_columns','recover_partitions','drop_table','show_create_table','set',
          'add_jar','create_function','drop_function','create_view','alter_view_as','explain','query'][g + 1] kind,
         CASE WHEN g IN (0,1,2) THEN db WHEN g IN (3,15) THEN db || '.base'
              WHEN g IN (9,14,16) THEN tb ELSE '' END inputs,
         CASE WHEN g IN (3,4,5,6,7,8) THEN tb WHEN g IN (14,15) THEN vw ELSE '' END outputs,
         '' ctes, g <> 17 parse_ok
  FROM cmd WHERE g < 18),
ord_exp AS (
  SELECT s.stmt_id, CASE s.stmt_id % 6 WHEN 2 THEN 'ctas' WHEN 3 THEN 'query' ELSE 'insert' END kind,
         coalesce((SELECT string_agg(t, ',' ORDER BY t) FROM exp_in e WHERE e.id = s.stmt_id), '') inputs,
         coalesce((SELECT string_agg(t, ',' ORDER BY t) FROM exp_out e WHERE e.id = s.stmt_id), '') outputs,
         coalesce((SELECT string_agg(t, ',' ORDER BY t) FROM exp_cte e WHERE e.id = s.stmt_id), '') ctes,
         true parse_ok
  FROM (SELECT DISTINCT id stmt_id FROM exp_src) s),
all_exp AS (SELECT * FROM ord_exp UNION ALL SELECT * FROM cmd_exp)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


def _agg(rel: str, col: str) -> str:
    return f"SELECT id stmt_id, string_agg(t, ',' ORDER BY t) {col} FROM {rel} GROUP BY id"


SCRIPTS = f"""
scripts AS (
  SELECT 'cust_' || (o_custkey // 1000)::VARCHAR || '_' || (stmt_id // 262144)::VARCHAR || '.sql' sql_file,
         string_agg(CASE stmt_id % 5
             WHEN 1 THEN '-- note' || chr(10) || sql
             WHEN 2 THEN 'set a=b;' || chr(10) || sql
             WHEN 3 THEN 'ADD JAR x.jar;' || chr(10) || sql
             WHEN 4 THEN split_part(sql, ' ', 1) || chr(10) || chr(10) || '  ' || chr(10)
                         || substr(sql, length(split_part(sql, ' ', 1)) + 2)
             ELSE sql END, ';' || chr(10) ORDER BY stmt_id) content
  FROM corpus GROUP BY ALL),
pieces AS (
  SELECT sql_file, unnest(string_split(content, ';')) raw,
         (generate_subscripts(string_split(content, ';'), 1) - 1)::INTEGER stmt_pos
  FROM scripts),
stripped AS (
  SELECT sql_file, stmt_pos,
         trim(regexp_replace(trim(raw, {WS}), '--[^\\n]*', '', 'g'), {WS}) sql
  FROM pieces),
kept AS (
  SELECT * FROM stripped
  WHERE NOT (sql = '' OR upper(sql) LIKE 'SET %' OR upper(sql) LIKE 'ALTER %' OR upper(sql) LIKE 'USE %'
             OR upper(sql) LIKE 'MSCK %' OR upper(sql) LIKE 'ADD %' OR upper(sql) LIKE 'USING %'
             OR upper(sql) LIKE 'DROP %' OR upper(sql) LIKE '%.JAR''')),
collapsed AS (
  SELECT sql_file, stmt_pos, regexp_replace(sql, '\\n\\s*\\n', chr(10), 'g') sql FROM kept)"""

MASK_RE2 = r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|/\*(?s:.*?)\*/|--[^\r\n]*"""
_NAME_RE2 = r"(?:`[^`]+`|[\p{L}\p{N}_$]+)"
TOKEN_RE2 = _NAME_RE2 + r"(?:\." + _NAME_RE2 + r")*|[(),;?]|[-+*/%=<>!|&^~]+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    base = _with(CORPUS, EXPECTED)
    o["refs_inputs"] = base + _agg("exp_in", "inputs")
    o["refs_from_only"] = base + _agg("exp_from", "inputs")
    o["refs_outputs"] = base + _agg("exp_out", "outputs")
    o["refs_ctes"] = base + _agg("exp_cte", "ctes")
    o["lineage_source_inputs"] = base + _agg("(SELECT * FROM exp_in WHERE t <> 'w')", "source_inputs")
    o["lineage_records"] = base + "SELECT stmt_id, kind, inputs, outputs, ctes, parse_ok FROM all_exp"
    o["io_pairs"] = base + "SELECT stmt_id, inputs, outputs FROM all_exp"
    o["semicolon_cut"] = _with(CORPUS) + "SELECT stmt_id, sql FROM corpus"
    o["unread_script_report"] = "SELECT 'absent_' || n_nationkey::VARCHAR || '.sql' sql_file FROM nation"
    o["script_quote_aware_split"] = """
SELECT 'quoted_' || c_custkey::VARCHAR || '.sql' sql_file, p::INTEGER stmt_pos,
       CASE p WHEN 0 THEN 'select ''a;' || c_custkey::VARCHAR || ''' c from t_' || c_custkey::VARCHAR
              WHEN 1 THEN chr(10) || 'select "x;y" /* ; */ from u_' || c_custkey::VARCHAR || ' -- no; end' || chr(10)
              ELSE 'select 1' END sql
FROM customer, range(3) r(p)"""
    o["statement_kinds"] = base + "SELECT stmt_id, kind FROM all_exp"
    o["unparsable_quarantine"] = base + "SELECT stmt_id, kind FROM all_exp WHERE NOT parse_ok"
    o["case_fold"] = base + ("SELECT id stmt_id, string_agg(upper(t), ',' ORDER BY upper(t)) inputs "
                             "FROM exp_in GROUP BY id")
    o["ref_counts"] = base + """, from_refs AS (
  SELECT id, 'ods.part_' || p::VARCHAR t FROM exp_src WHERE f IN (0,2,3,5) OR (rn = 1 AND f IN (1,4))
  UNION ALL SELECT id, 'ods.supp_' || u::VARCHAR FROM exp_src WHERE f = 1
  UNION ALL SELECT id, 'w' FROM exp_src WHERE f = 1 AND rn = 1)
SELECT id stmt_id, t table_name, count(*) n FROM from_refs GROUP BY ALL"""
    o["ref_string"] = base + """, ordered AS (
  SELECT id, 'ods.part_' || p::VARCHAR t, rn o FROM exp_src WHERE f IN (0,2,3,5) OR (rn = 1 AND f = 4)
  UNION ALL SELECT id, 'ods.part_' || p::VARCHAR, -1 FROM exp_src WHERE f = 1 AND rn = 1
  UNION ALL SELECT id, 'w', 0 FROM exp_src WHERE f = 1 AND rn = 1
  UNION ALL SELECT id, 'ods.supp_' || u::VARCHAR, rn FROM exp_src WHERE f = 1)
SELECT id stmt_id, string_agg(t, ',' ORDER BY o) ref_string FROM ordered GROUP BY id"""
    o["ref_list"] = o["ref_string"].replace("string_agg(t, ',' ORDER BY o) ref_string",
                                            "to_json(list(t ORDER BY o))::VARCHAR refs")
    o["table_edges"] = base + """, outs AS (
  SELECT id stmt_id, t target FROM exp_out
  UNION ALL SELECT stmt_id, outputs FROM cmd_exp WHERE outputs <> ''),
srcs AS (
  SELECT id stmt_id, string_agg(t, ',' ORDER BY t) sources FROM exp_in WHERE t <> 'w' GROUP BY id
  UNION ALL SELECT stmt_id, regexp_replace(inputs, ',w$', '') FROM cmd_exp)
SELECT o.stmt_id, o.target, coalesce(s.sources, '') sources FROM outs o LEFT JOIN srcs s USING (stmt_id)"""
    o["query_hash"] = _with(CORPUS) + "SELECT stmt_id, md5(sql) query_hash FROM corpus"
    o["ctas_strip"] = _with(CORPUS) + r""", norm AS (
  SELECT stmt_id, trim(regexp_replace(replace(sql, ',', ' , '), '\s+', ' ', 'g')) s FROM corpus),
m AS (SELECT stmt_id, s, regexp_extract(lower(s), '^(create table ([\w.]+) as )([\s\S]+)$', 1) prefix,
             regexp_extract(lower(s), '^(create table ([\w.]+) as )([\s\S]+)$', 2) tgt FROM norm)
SELECT stmt_id, CASE WHEN tgt <> '' THEN tgt END ctas_target,
       CASE WHEN prefix <> '' THEN substr(s, length(prefix) + 1) ELSE s END sql
FROM m"""
    o["tokens_depth"] = _with(CORPUS) + f""", masked AS (
  SELECT stmt_id, regexp_extract_all(regexp_replace(sql, {_q(MASK_RE2)}, ' ? ', 'g'), {_q(TOKEN_RE2)}, 0) toks
  FROM corpus),
t AS (SELECT stmt_id, unnest(toks) tok, generate_subscripts(toks, 1) pos FROM masked),
d AS (SELECT stmt_id, sum(CASE tok WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END)
                      OVER (PARTITION BY stmt_id ORDER BY pos) depth FROM t)
SELECT stmt_id, count(*)::BIGINT n_tokens, max(depth)::BIGINT max_depth, sum(depth)::BIGINT depth_sum
FROM d GROUP BY stmt_id"""
    scripts = _with(CORPUS, SCRIPTS)
    o["script_split"] = scripts + "SELECT sql_file, stmt_pos, raw sql FROM pieces"
    # Spark's text writer ends each file with a line feed
    o["script_block_split"] = scripts + """SELECT sql_file, stmt_pos,
  raw || CASE WHEN stmt_pos = max(stmt_pos) OVER (PARTITION BY sql_file) THEN chr(10) ELSE '' END sql FROM pieces"""
    o["script_comment_strip"] = scripts + "SELECT sql_file, stmt_pos, sql FROM stripped"
    o["script_noise_filter"] = scripts + "SELECT sql_file, stmt_pos, sql FROM kept"
    o["script_blank_lines"] = scripts + "SELECT sql_file, stmt_pos, sql FROM collapsed"
    o["script_lineage"] = _with(CORPUS, EXPECTED) + """
SELECT 'cust_' || (o_custkey // 1000)::VARCHAR || '_' || (stmt_id // 262144)::VARCHAR || '.sql' sql_file,
       e.kind, e.inputs, e.outputs
FROM corpus c JOIN ord_exp e USING (stmt_id)"""
    o["stream_lineage"] = o["lineage_records"]
    return o
