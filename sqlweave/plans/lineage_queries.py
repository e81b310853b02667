"""Registered lineage queries. Each takes (spark, sf_dir) and
returns a DataFrame; arrays are shown as sorted comma strings so that the DuckDB oracle
hashes agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlweave.functions import text as T
from sqlweave.operators import lineage as L
from sqlweave.operators import refs as R
from sqlweave.operators import statements as S
from sqlweave.session import scratch_path
from sqlweave.sources import corpus as C
from sqlweave.sources.scripts import file_name, read_script_lines, read_scripts, unread_files, write_scripts
from sqlweave.sources.tables import read_table


def _csv(c: str) -> F.Column:
    return F.array_join(F.col(c), ",").alias(c)


def _labelled(spark: SparkSession, sf: str, case: str = "keep") -> DataFrame:
    return R.token_refs(C.statement_corpus(spark, sf).select("stmt_id", "sql"), case=case)


def _set_of(refs: DataFrame, name: str) -> DataFrame:
    return refs.groupBy("stmt_id").agg(
        F.array_join(F.sort_array(F.collect_set("table_name")), ",").alias(name))


def script_split(spark, sf):
    return S.split_statements(C.script_corpus(spark, sf)).select("sql_file", "stmt_pos", "sql")


def script_quote_aware_split(spark, sf):
    """L2 with semicolons inside literals and comments left alone."""
    return S.split_statements(C.quoted_scripts(spark, sf), quote_aware=True).select("sql_file", "stmt_pos", "sql")


def unread_script_report(spark, sf):
    """Listed script files that gave no content (here one a nation, which nobody wrote)."""
    made = C.script_corpus(spark, sf)
    path = write_scripts(made, scratch_path(spark, "scripts"))
    absent = read_table(spark, sf, "nation").select(
        F.concat(F.lit("absent_"), F.col("n_nationkey").cast("string"), F.lit(".sql")).alias("sql_file"))
    read = read_scripts(spark, path).select(file_name("sql_file").alias("sql_file"))
    return unread_files(made.select("sql_file").unionByName(absent), read)


def script_block_split(spark, sf):
    """L2 from files that many tasks read, a block each."""
    path = write_scripts(C.script_corpus(spark, sf), scratch_path(spark, "scripts"))
    return S.split_lines(read_script_lines(spark, path)).select(file_name("sql_file").alias("sql_file"), "stmt_pos", "sql")


def semicolon_cut(spark, sf):
    """L7 on statements as a log holds them: a semicolon at the end, some with blanks after it."""
    log = F.concat("sql", F.lit(";"), F.expr("repeat(' ', int(stmt_id % 3))"), F.expr("repeat('\\n', int(stmt_id % 2))"))
    return S.prepare(C.statement_corpus(spark, sf).select("stmt_id", log.alias("sql")))


def script_comment_strip(spark, sf):
    return script_split(spark, sf).withColumn("sql", T.strip_comments(F.col("sql")))


def script_noise_filter(spark, sf):
    return script_comment_strip(spark, sf).where(~T.is_noise(F.col("sql")))


def script_blank_lines(spark, sf):
    return S.clean_statements(script_split(spark, sf))


def ctas_strip(spark, sf):
    norm = T.normalise_sql(F.col("sql"))
    st = C.statement_corpus(spark, sf).select("stmt_id", norm.alias("sql"))
    return st.select("stmt_id", T.ctas_target(F.col("sql")).alias("ctas_target"),
                     T.strip_ctas(F.col("sql")).alias("sql"))


def tokens_depth(spark, sf):
    from sqlweave.operators.tokens import scope_tokens, tokenize
    t = scope_tokens(tokenize(C.statement_corpus(spark, sf).select("stmt_id", "sql")))
    return t.groupBy("stmt_id").agg(F.count("tok").alias("n_tokens"),
                                    F.max("d").cast("long").alias("max_depth"),
                                    F.sum("d").cast("long").alias("depth_sum"))


def refs_inputs(spark, sf):
    return _set_of(R.table_refs(_labelled(spark, sf), "in"), "inputs")


def refs_from_only(spark, sf):
    return _set_of(R.table_refs(_labelled(spark, sf), "in", include_expression_subqueries=False), "inputs")


def refs_outputs(spark, sf):
    return _set_of(R.table_refs(_labelled(spark, sf), "out"), "outputs")


def refs_ctes(spark, sf):
    return _set_of(R.table_refs(_labelled(spark, sf), "cte"), "ctes")


def _records(spark, sf, case="keep"):
    return L.lineage(C.sample_statements(spark, sf), case=case)


def lineage_records(spark, sf):
    return _records(spark, sf).select("stmt_id", "kind", _csv("inputs"), _csv("outputs"),
                                      _csv("ctes"), "parse_ok")


def io_pairs(spark, sf):
    return L.io_pair(_records(spark, sf)).select("stmt_id", _csv("inputs"), _csv("outputs"))


def lineage_source_inputs(spark, sf):
    rec = L.lineage(C.statement_corpus(spark, sf).select("stmt_id", "sql"))
    return rec.select("stmt_id", _csv("source_inputs"))


def ref_counts(spark, sf):
    return R.ref_counts(_labelled(spark, sf))


def ref_list(spark, sf):
    """The ordered multiset, shown as a JSON array string (order and duplicates kept)."""
    return R.ref_list(_labelled(spark, sf)).select("stmt_id", F.to_json("refs").alias("refs"))


def ref_string(spark, sf):
    return R.ref_string(_labelled(spark, sf))


def case_fold(spark, sf):
    rec = L.lineage(C.statement_corpus(spark, sf).select("stmt_id", "sql"), case="upper")
    return rec.select("stmt_id", _csv("inputs"))


def statement_kinds(spark, sf):
    return L.statement_kinds(C.sample_statements(spark, sf))


def unparsable_quarantine(spark, sf):
    _, bad = L.quarantine(_records(spark, sf))
    return bad.select("stmt_id", "kind")


def table_edges(spark, sf):
    e = L.table_edges(_records(spark, sf))
    return e.select("stmt_id", "target", F.array_join("sources", ",").alias("sources"))


def query_hash(spark, sf):
    return C.statement_corpus(spark, sf).select("stmt_id", T.query_hash(F.col("sql")).alias("query_hash"))


def script_lineage(spark, sf):
    """L18 end to end: script files written to the shared folder, read back whole, split,
    cleaned, and walked; task and file ride along with every statement."""
    path = write_scripts(C.script_corpus(spark, sf), scratch_path(spark, "scripts"))
    return script_lineage_of(spark, path).select(
        file_name("sql_file").alias("sql_file"), "kind", _csv("inputs"), _csv("outputs"))


def script_lineage_of(spark, path: str, task: str | None = None) -> DataFrame:
    st = S.clean_statements(S.split_statements(read_scripts(spark, path)))
    st = S.with_stmt_id(S.prepare(st)).withColumn("task", F.lit(task).cast("string"))
    return L.lineage(st, carry=("sql_file", "task"))


QUERIES = {f.__name__: f for f in (
    script_split, script_quote_aware_split, script_block_split, unread_script_report, semicolon_cut, io_pairs, script_comment_strip, script_noise_filter, script_blank_lines, ctas_strip,
    tokens_depth, refs_inputs, refs_from_only, refs_outputs, refs_ctes, lineage_records,
    lineage_source_inputs, ref_counts, ref_list, ref_string, case_fold, statement_kinds,
    unparsable_quarantine, table_edges, query_hash, script_lineage)}
