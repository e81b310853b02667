"""Key-derived inputs of the column graph (FIXTURES.md section 3), built by Spark:

* ``column_deps``  - one dependency per (order, line) after dedup, plus one predicate per
                     order; multi-insert: orders with key % 5 = 0 send lines > 2 to sink 1;
* ``write_entities`` - the statement's written entities (DFS_DIR / TABLE / PARTITION);
* ``table_schemas`` - columns and partition keys of every destination table (the
                     metastore lookup), derived from the table names that occur;
* ``result_fields`` - the result schema of every statement (one field per order line; statements
                     with key % 16 = 0 lack the last one, as after a plan that lost a column);
* ``task_log``     - job ids of the tasks of every statement (nulls for local tasks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sqlweave.sources.tables import read_table

SOURCES_TYPE = "array<struct<db:string,tbl:string,col:string,is_temporary:boolean>>"


def _s(c):
    return c.cast("string")


def _target_field(s, n):
    # without a destination "tmp.s" is also the label of a source table
    return (F.when((s % 8 == 0) & (n == 3), F.lit("tmp.s")).when(n % 2 == 0, F.concat(F.lit("_u1.c"), _s(n)))
            .otherwise(F.concat(F.lit("c"), _s(n))))


def result_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = F.col("l_orderkey"), F.col("l_linenumber")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    last = F.max("l_linenumber").over(Window.partitionBy("l_orderkey"))
    return (lines.withColumn("last", last).where((s % 16 != 0) | (n < F.col("last")))
            .select(s.alias("stmt_id"), n.alias("pos"), _target_field(s, n).alias("name")))


def column_deps(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    dd = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.min(F.struct("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")).alias("m"))
    s, n = F.col("l_orderkey"), F.col("l_linenumber")
    sink = F.when((s % 5 == 0) & (n > 2), 1).otherwise(0)
    dest = (F.when(s % 4 == 0, F.lit(None).cast("string"))
            .when(sink == 1, F.concat(F.lit("dw.u"), _s(s % 50)))
            .otherwise(F.concat(F.lit("dw.t"), _s(s % 50))))
    field = _target_field(s, n)
    expr = F.when(F.col("m.l_returnflag") == "N", F.lit(None).cast("string")).otherwise(F.lit("sum(x)"))
    sources = F.array(
        F.struct(F.lit("ods").alias("db"), F.concat(F.lit("p"), _s(F.col("m.l_partkey") % 3)).alias("tbl"),
                 F.lit("a").alias("col"), F.lit(False).alias("is_temporary")),
        F.struct(F.lit("tmp").alias("db"), F.lit("s").alias("tbl"), F.lit(None).cast("string").alias("col"),
                 (F.col("m.l_linestatus") == "F").alias("is_temporary")))
    proj = dd.select(s.alias("stmt_id"), sink.alias("sink_pos"), n.alias("dep_pos"),
                     F.lit("PROJECTION").alias("dep_kind"), dest.alias("dest_table"),
                     field.alias("target_field"), expr.alias("expr"), sources.cast(SOURCES_TYPE).alias("sources"))
    pred_src = F.array(F.struct(F.lit("ods").alias("db"), F.lit("p0").alias("tbl"), F.lit("k").alias("col"),
                                F.lit(False).alias("is_temporary")))
    pred = li.select("l_orderkey").distinct().select(
        s.alias("stmt_id"), F.lit(0).alias("sink_pos"), F.lit(100).alias("dep_pos"),
        F.lit("PREDICATE").alias("dep_kind"),
        F.when(s % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("dw.t"), _s(s % 50))).alias("dest_table"),
        F.lit(None).cast("string").alias("target_field"), F.lit("k > 0").alias("expr"),
        pred_src.cast(SOURCES_TYPE).alias("sources"))
    return proj.unionByName(pred)


def write_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")

    def ent(pos, typ, name):
        return F.struct(F.lit(pos).alias("pos"), F.lit(typ).alias("entity_type"), name.alias("name"))

    out_dir = F.concat(F.lit("/out/"), _s(k))
    ents = (F.when(k % 3 == 0, F.array(ent(0, "DFS_DIR", out_dir), ent(1, "TABLE", F.concat(F.lit("dw.o"), _s(k % 7)))))
            .when(k % 3 == 1, F.array(ent(0, "PARTITION", F.concat(F.lit("dw.p"), _s(k % 5)))))
            .otherwise(F.array(ent(0, "DFS_DIR", out_dir))))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    return o.select(k.alias("stmt_id"), F.explode(ents).alias("e")).select("stmt_id", "e.*")


def fixture_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statement ids of the fixture (one per order that has lines)."""
    return read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("stmt_id")).distinct()


def table_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_name, cols, partition_keys) of every table the fixture can write (the
    metastore lookup): table number N gives N % 5 + 1 columns c1.. and the first N % 4 of
    (dt, hr, mi) as partition keys."""
    k = F.col("o_orderkey")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    names = o.select(F.explode(F.array(
        F.concat(F.lit("dw.t"), _s(k % 50)), F.concat(F.lit("dw.u"), _s(k % 50)),
        F.concat(F.lit("dw.o"), _s(k % 7)), F.concat(F.lit("dw.p"), _s(k % 5)))).alias("table_name")).distinct()
    num = F.regexp_extract("table_name", "(\\d+)$", 1).cast("int")
    return names.select(
        "table_name",
        F.transform(F.sequence(F.lit(1), num % 5 + 1), lambda i: F.concat(F.lit("c"), _s(i))).alias("cols"),
        F.slice(F.array(F.lit("dt"), F.lit("hr"), F.lit("mi")), 1, num % 4).alias("partition_keys"))


def task_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stmt_id, task_pos, job_id): a job id per line, null for lines with status 'F'."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_partkey")
    return li.select(F.col("l_orderkey").alias("stmt_id"),
                     F.struct("l_linenumber", "l_partkey").alias("task_pos"),
                     F.when(F.col("l_linestatus") == "F", F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("job_"), _s(F.col("l_linenumber")), F.lit("_"),
                                         _s(F.col("l_partkey")))).alias("job_id"))
