"""Script scan and cleaning."""

import os

from pyspark.sql import functions as F

from sqlweave.functions import text as T
from sqlweave.operators import statements as S
from sqlweave.operators.lineage import lineage
from sqlweave.session import scratch_path
from sqlweave.sources.scripts import read_report, read_script_lines, read_scripts, unread_files, write_scripts

SCRIPT = """-- nightly refresh
set spark.sql.shuffle.partitions=64;
use warehouse_nightly;
add jar /opt/lib/geo.jar;
msck repair table raw.scans;
drop table tmp.old_report;
-- select nothing from retired.table
;
insert overwrite table tmp.report partition (dt)


with latest as (select k, max(ts) ts from src.facts group by k)
select f.k, nvl(p.v, 0) as v, '%run_day' as dt from latest f left join dim.v p on f.k = p.k
union all
select k, -1, '%run_day' from src.other;
"""


def _script_df(spark, text=SCRIPT):
    return spark.createDataFrame([("f.sql", text)], "sql_file string, content string")


def test_split_and_clean(spark):
    st = S.clean_statements(S.split_statements(_script_df(spark))).collect()
    assert len(st) == 1
    sql = st[0].sql
    assert sql.startswith("insert overwrite table tmp.report")
    assert "\n\n" not in sql                       # blank lines collapsed (L5)
    assert st[0].stmt_pos == 6                      # position of the split kept (pieces 0-5 dropped)
    rec = lineage(S.prepare(spark.createDataFrame([(0, sql)], "stmt_id long, sql string"))).collect()[0]
    assert rec.source_inputs == ["dim.v", "src.facts", "src.other"] and rec.outputs == ["tmp.report"]


def test_noise_rules(spark):
    rows = ["set a=b", "ALTER table x", "use db", "msck repair table t", "add jar x", "USING JAR 'y.jar'",
            "drop table t", "select 1", "x from y.JAR'", "", "select 2 -- c"]
    df = spark.createDataFrame([(r,) for r in rows], "sql string")
    kept = [r.sql for r in df.where(~T.is_noise(T.strip_comments(F.col("sql")))).collect()]
    assert kept == ["select 1", "select 2 -- c"]


def test_java_trim_and_comment_strip(spark):
    df = spark.createDataFrame([("\t\n select 1 -- x\n from t \x01",)], "sql string")
    assert df.select(T.strip_comments(F.col("sql"))).first()[0] == "select 1 \n from t"


def test_quote_aware_split(spark):
    df = spark.createDataFrame([("f", "select ';' as a; -- c;d\nselect 2")], "sql_file string, content string")
    plain = [r.sql for r in S.split_statements(df).collect()]
    aware = [r.sql for r in S.split_statements(df, quote_aware=True).collect()]
    assert len(plain) == 4 and len(aware) == 2
    assert aware[0] == "select ';' as a"


def test_cut_semicolon_and_ctas(spark):
    df = spark.createDataFrame([("select 1; \n",), ("create table a.b as select x,y from t",)], "sql string")
    r = df.select(T.cut_semicolon(F.col("sql")).alias("c"), T.normalise_sql(F.col("sql")).alias("n")).collect()
    assert r[0].c == "select 1"
    n = r[1].n
    assert n == "create table a.b as select x , y from t"
    out = spark.createDataFrame([(n,)], "sql string").select(
        T.ctas_target(F.col("sql")), T.strip_ctas(F.col("sql"))).first()
    assert tuple(out) == ("a.b", "select x , y from t")


def test_read_scripts_roundtrip_and_missing(spark):
    path = write_scripts(_script_df(spark), scratch_path(spark, "t-scripts"))
    got = read_scripts(spark, path).collect()
    assert len(got) == 1 and got[0].content == SCRIPT + "\n"   # the text sink ends each row with a line break
    assert read_scripts(spark, path + "/*/*.txt").count() == 1
    assert read_scripts(spark, path + "/does-not-exist").count() == 0


def test_unread_files_report(spark):
    from sqlweave.sources.scripts import unread_files
    path = write_scripts(_script_df(spark), scratch_path(spark, "t-unread"))
    got = read_scripts(spark, path)
    listed = got.select("sql_file").union(spark.createDataFrame([("file:/gone/x.sql",)], "sql_file string"))
    assert [r.sql_file for r in unread_files(listed, got).collect()] == ["file:/gone/x.sql"]


TEXTS = ["", ";", "a", "a;\nb;\n", "a;b\nc;;\n\n;d", "\n\n;\n", "select ';' ;\r\nx\r\n;", "no mark\nat all\n", "ä;ö\nü", "x;\n" * 300 + "tail"]


def test_split_lines_gives_the_rows_of_the_whole_file_split(spark, tmp_path):
    """Files read in blocks of 64 bytes: statements run over many blocks and tasks."""
    for i, t in enumerate(TEXTS):
        (tmp_path / f"f{i}.sql").write_bytes(t.encode())
    saved = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in saved:
            spark.conf.set(k, "64")
        lines = read_script_lines(spark, str(tmp_path))
        assert lines.select("sql_file", "block").distinct().count() > 2 * len(TEXTS)
        got = sorted((r.sql_file.rsplit("/", 1)[1], r.stmt_pos, r.sql) for r in S.split_lines(lines).collect())
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = sorted((f"f{i}.sql", k, p) for i, t in enumerate(TEXTS) if t for k, p in enumerate(t.split(";")))  # an empty file has no line
    assert got == want


def test_split_lines_of_any_bytes_and_any_order_of_lines(spark, tmp_path):
    """Bytes that are no UTF-8 hide no semicolon; lines that lie in any order and partitions give the same rows."""
    texts = [t.encode() for t in TEXTS if t] + [b"a \xe4;b\n\xfc;;c\xe9\n;\xe4", b"\xe4\xf6;\xfc;\n", "ä".encode()[:1] + b";x"]
    for i, t in enumerate(texts):
        (tmp_path / f"f{i}.sql").write_bytes(t)
    want = sorted((r.sql_file, r.stmt_pos, r.sql) for r in S.split_statements(read_scripts(spark, str(tmp_path))).collect())
    lines = read_script_lines(spark, str(tmp_path))
    for some in (lines, lines.repartition(3, "line"), lines.orderBy(F.xxhash64("line", "seq"))):
        saved = some.persist()  # the place of a line is that of one reading
        assert sorted((r.sql_file, r.stmt_pos, r.sql) for r in S.split_lines(saved).collect()) == want
        saved.unpersist()


def test_split_lines_sorts_no_lines(spark, tmp_path):
    """Only rows of runs are sorted or put into windows."""
    (tmp_path / "f.sql").write_text("a;\nb;\n" * 50)
    plan = S.split_lines(read_script_lines(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "seq" not in "".join(x for x in plan.splitlines() if "Sort [" in x or "Window [" in x)


def test_read_report(spark, tmp_path):
    """One damaged and one missing file among good ones: the others are read."""
    import gzip
    good = gzip.compress(b"select * from a.b;\n" * 500)
    (tmp_path / "good.sql.gz").write_bytes(good)
    (tmp_path / "cut.sql.gz").write_bytes(good[:len(good) // 2])
    (tmp_path / "noise.sql.gz").write_bytes(b"this is no gzip file")
    (tmp_path / "plain.sql").write_text("select 1")
    (tmp_path / "empty.sql").write_text("")
    expected = spark.createDataFrame([(f"file:{tmp_path}/plain.sql",), (f"file:{tmp_path}/gone.sql",)], "sql_file string")
    expected = expected.selectExpr("replace(sql_file, 'file:/', 'file:///') sql_file")
    got = {r.sql_file.rsplit("/", 1)[1]: r.verdict for r in read_report(spark, str(tmp_path), expected).collect()}
    assert got == {"good.sql.gz": "read", "cut.sql.gz": "damaged", "noise.sql.gz": "damaged", "plain.sql": "read", "gone.sql": "missing"}
    texts = {r.sql_file.rsplit("/", 1)[1]: r.content for r in read_scripts(spark, str(tmp_path)).collect()}
    assert texts["good.sql.gz"].count("a.b") == 500 and texts["plain.sql"] == "select 1"
