"""Key-derived sample corpora, built by Spark from the test tables.

The names in every statement are made of keys, so the expected lineage is a join of keys
and the DuckDB oracles never have to parse SQL (recipe in FIXTURES.md section 2).

Group sizes: a statement is built from one order's lines; a script file holds the orders
of a block of ``SCRIPT_CUSTOMERS`` customers within one range of ``SCRIPT_CHUNK`` order
keys (keys are unique, so a file never holds more than SCRIPT_CHUNK statements, however
many orders a customer has).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlweave.sources.tables import read_table

SCRIPT_CHUNK = 1 << 18        # <= 262,144 statements (~80 MB) per script row
SCRIPT_CUSTOMERS = 1000


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def statement_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One statement per order that has lines: (stmt_id = o_orderkey, o_custkey, sql)."""
    line = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"),
                    F.col("l_suppkey").alias("u"))
    src = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
           .agg(F.array_sort(F.collect_list(line)).alias("x")))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    b = orders.join(src, orders.o_orderkey == src.l_orderkey).select(
        F.col("o_orderkey").alias("stmt_id"), "o_custkey",
        (F.col("o_orderkey") % 6).alias("f"),
        F.concat(F.lit("dw.cust_"), _s("o_custkey")).alias("tgt"),
        F.transform("x", lambda y: F.concat(F.lit("ods.part_"), _s(y["p"]))).alias("ps"),
        F.transform("x", lambda y: F.concat(F.lit("ods.supp_"), _s(y["u"]))).alias("us"))
    ps, us, tgt, f = F.col("ps"), F.col("us"), F.col("tgt"), F.col("f")
    sql = (F.when(f == 0, F.concat(
                F.lit("insert overwrite table "), tgt,
                F.lit(" partition (dt) select a.k, 'x from zz.trap' as c from "),
                F.array_join(F.transform(ps, lambda p, i: F.concat(p, F.lit(" t"), _s(i))), " left join ")))
           .when(f == 1, F.concat(
                F.lit("with w as (select * from "), ps[0], F.lit(") insert into "), tgt,
                F.lit(" select * from w join "), F.array_join(us, " join ")))
           .when(f == 2, F.concat(
                F.lit("create table "), tgt, F.lit(" as "),
                F.array_join(F.transform(ps, lambda p: F.concat(
                    F.lit("select k, extract(year from ts) from "), p)), " union all ")))
           .when(f == 3, F.concat(
                F.lit("select a from (select a from "), F.array_join(ps, ", "),
                F.lit(" where a > 1 group by a) q where q.a in (select k from "), us[0], F.lit(")")))
           .when(f == 4, F.concat(
                F.lit("from "), ps[0], F.lit(" insert into table "), tgt,
                F.lit("_a select k insert into table "), tgt, F.lit("_b select k")))
           .otherwise(F.concat(
                F.lit("insert into `dw`.`"), F.substring(tgt, 4, 1 << 30), F.lit("` select * from ("),
                F.array_join(F.transform(ps, lambda p: F.concat(F.lit("select k from "), p)), " union "),
                F.lit(") z lateral view explode(z.k) e as v"))))
    return b.select("stmt_id", "o_custkey", sql.alias("sql"))


# Statement forms of the command corpus after its first 18 (t, v: a table and a view of the customer,
# b: a table of the nation).
CONSTRUCTS = (
    "select 1",
    "load data inpath '/x' into table {t}",
    "analyze table {t} compute statistics",
    "truncate table {t}",
    "merge into {t} using {b} on {t}.k = {b}.k when matched then delete",
    "update {t} set a = (select max(k) from {b})",
    "delete from {t} where k in (select k from {b})",
    "replace table {t} as select * from {b}",
    "cache table {v} as select * from {b}",
    "create or replace temp view {v} as select * from {b}",
    "frobnicate {t}",
    "table {t}",
    "insert into {t} table {b}",
    "select a, b, sum(c) s from {t} group by a, b grouping sets ((a, b), (a))",
    "select distinct a from {t}",
    "select a from {t} sort by a",
    "select a from {t} order by a limit 3",
    "select a from {t} distribute by a sort by b",
    "select a from {t} cluster by a",
    "select sum(a) over w from {t} window w as (partition by b)",
    "select a as order, b as x from {t} as y",
    "select a from {t} group by a having a > (select max(k) from {b})",
    "select a from {t} intersect select a from {b}",
    "select a from {t} except select a from {b}",
    "select a from {t} tablesample (10 percent) s",
    "select /*+ broadcast(b) */ a from {t} join {b} b on {t}.k = b.k",
    "select x from values (1), (2) as w(x) join {t} on {t}.k = w.x",
    "select a from {t} lateral view explode(a) e as v join {b} on {t}.k = v",
    "select a from (({t} x join {b} on x.k = 1) join {v} on x.k = 2)",
    "select order, k from {t}",
    "select a, (b + c) d from {t} where (a, b) in ((c, d), (e, f))",
    "with w as (select * from {b}) insert into {t} select * from w",
    "select /* a /* b */ from hidden.h */ 1 from {t}",
    "select * from -- main\n {t} join {b} b on 1 = 1",
    "select * from {t}, -- old: z\n {b}",
    "select * from {t} join /* dim */ {b} b on 1 = 1",
    "insert into /* x */ {t} select * from {b}",
    "insert overwrite table -- x\n {t} select * from {b}",
    "create table /* x */ {t} as select * from {b}",
    "with /* c */ w as (select * from {b}) select * from w",
    "select * from {t} where x in (from {b} select y)",
    "select a from {t} where exists (from {b} select 1)",
    "select /* 1 /* 2 /* 3 /* 4 /* 5 /* don't */ */ */ */ */ from hidden.h */ a from {t} where c = 'it''s'",
    "alter table {t} rename to {v}",
    "alter table {t} set tblproperties ('a' = 'b')",
    "drop view if exists {v}",
    "describe table {t}",
    "refresh table {t}",
    "select a from ({t}, {b}) join {v} on a = 1",
    "alter table {t} set location '/x'",
    "uncache table if exists {v}",
)


def command_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DDL and command statements, one per customer: (stmt_id = -1 - c_custkey, sql).
    The form is c_custkey modulo their number: the commands below, then CONSTRUCTS; code 17 is cut
    short and code 28 is no SQL, on purpose."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n, k = _s("c_nationkey"), _s("c_custkey")
    db = F.concat(F.lit("db_"), n)
    t = F.concat(db, F.lit(".t_"), k)
    v = F.concat(db, F.lit(".v_"), k)
    base = F.concat(db, F.lit(".base"))
    texts = [
        F.concat(F.lit("create database if not exists "), db),
        F.concat(F.lit("drop database "), db),
        F.concat(F.lit("alter database "), db, F.lit(" set dbproperties ('owner'='u"), k, F.lit("')")),
        F.concat(F.lit("create table "), t, F.lit(" like "), db, F.lit(".base")),
        F.concat(F.lit("alter table "), t, F.lit(" add if not exists partition (dt='2024-01-01')")),
        F.concat(F.lit("alter table "), t, F.lit(" drop partition (dt='2024-01-01')")),
        F.concat(F.lit("alter table "), t, F.lit(" add columns (c1 string)")),
        F.concat(F.lit("msck repair table "), t),
        F.concat(F.lit("drop table if exists "), t),
        F.concat(F.lit("show create table "), t),
        F.concat(F.lit("set spark.sql.shuffle.partitions="), k),
        F.concat(F.lit("add jar /lib/u"), k, F.lit(".jar")),
        F.concat(F.lit("create function f"), k, F.lit(" as 'com.x.F"), k, F.lit("'")),
        F.concat(F.lit("drop function f"), k),
        F.concat(F.lit("create view "), v, F.lit(" as select * from "), t),
        F.concat(F.lit("alter view "), v, F.lit(" as select * from "), db, F.lit(".base")),
        F.concat(F.lit("explain select * from "), t),
        F.concat(F.lit("select * from (select c_custkey from "), t),
    ]
    names = {"t": t, "b": base, "v": v}
    texts += [F.concat(*[names[p[1]] if p in ("{t}", "{b}", "{v}") else F.lit(p)
                         for p in re.split(r"(\{[tbv]\})", form) if p]) for form in CONSTRUCTS]
    g = F.col("c_custkey") % len(texts)
    sql = texts[-1]
    for i in range(len(texts) - 2, -1, -1):
        sql = F.when(g == i, texts[i]).otherwise(sql)
    return c.select((F.lit(-1) - F.col("c_custkey")).alias("stmt_id"), sql.alias("sql"))


def quoted_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Script files (sql_file, content), one per customer, with semicolons in literals and comments."""
    k = _s(F.col("c_custkey"))
    return read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("quoted_"), k, F.lit(".sql")).alias("sql_file"),
        F.concat(F.lit("select 'a;"), k, F.lit("' c from t_"), k, F.lit(";\nselect \"x;y\" /* ; */ from u_"), k,
                 F.lit(" -- no; end\n;select 1")).alias("content"))


def sample_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both corpora: (stmt_id, sql)."""
    return (statement_corpus(spark, sf_dir).select("stmt_id", "sql")
            .unionByName(command_corpus(spark, sf_dir)))


def script_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Script files (sql_file, content): the statements of a customer block (in chunks of
    SCRIPT_CHUNK order keys), in key order, joined with ';\\n', with a comment line, a SET,
    an ADD JAR or blank lines put in, chosen by o_orderkey % 5."""
    st = statement_corpus(spark, sf_dir)
    sql, m = F.col("sql"), F.col("stmt_id") % 5
    first = F.substring_index(sql, " ", 1)
    piece = (F.when(m == 1, F.concat(F.lit("-- note\n"), sql))
             .when(m == 2, F.concat(F.lit("set a=b;\n"), sql))
             .when(m == 3, F.concat(F.lit("ADD JAR x.jar;\n"), sql))
             .when(m == 4, F.concat(first, F.lit("\n\n  \n"), F.substr(sql, F.length(first) + 2)))
             .otherwise(sql))
    sql_file = F.concat(F.lit("cust_"), _s(F.floor(F.col("o_custkey") / SCRIPT_CUSTOMERS)), F.lit("_"),
                        _s(F.floor(F.col("stmt_id") / SCRIPT_CHUNK)), F.lit(".sql"))
    return (st.select(sql_file.alias("sql_file"), F.struct("stmt_id", piece.alias("piece")).alias("p"))
            .groupBy("sql_file")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["piece"]),
                              ";\n").alias("content")))
