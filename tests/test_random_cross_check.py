"""Randomised statements (seeded) checked against the relations Spark's own parser sees
(driver-side, tests only): every input we report is a relation of the parsed plan, and every
relation of the plan is among our inputs or outputs."""

import random
import re

from sqlweave.operators.lineage import lineage

TABLES = ["db.t1", "db.t2", "s.orders", "s.items", "t3", "t4", "x.y"]


class Gen:
    def __init__(self, seed):
        self.r = random.Random(seed)
        self.n = 0

    def alias(self):
        self.n += 1
        return f"a{self.n}"

    def source(self, d):
        c = self.r.random()
        if d > 0 and c < 0.3:
            return f"({self.query(d - 1)}) {self.alias()}"
        return f"{self.r.choice(TABLES)} {self.alias()}"

    def from_clause(self, d):
        s = self.source(d)
        for _ in range(self.r.randint(0, 2)):
            kind = self.r.choice(["join", "left join", ",", "cross join", "full outer join"])
            s += (", " if kind == "," else f" {kind} ") + self.source(d)
            if kind in ("join", "left join", "full outer join"):
                s += " on 1 = 1"
        return s

    def where(self, d):
        c = self.r.random()
        if d > 0 and c < 0.3:
            return f" where k in ({self.query(d - 1)})"
        if d > 0 and c < 0.45:
            return f" where exists (select 1 from {self.r.choice(TABLES)} z where z.k = 1)"
        if c < 0.6:
            return " where a = 'from fake.table' and b > 2"
        return ""

    def select_list(self, d):
        if d > 0 and self.r.random() < 0.2:
            return f"a, (select max(k) from {self.r.choice(TABLES)}) m"
        return self.r.choice(["*", "a, b", "count(*) c", "substring(a, 1, 2) s, extract(year from ts) y"])

    def query(self, d):
        q = f"select {self.select_list(d)} from {self.from_clause(d)}{self.where(d)}"
        if self.r.random() < 0.2:
            q += " group by a having count(*) > 1"
        if d > 0 and self.r.random() < 0.25:
            q += " union all " + f"select {self.select_list(d)} from {self.from_clause(d - 1)}"
        return q

    def statement(self):
        d = self.r.randint(0, 3)
        q = self.query(d)
        c = self.r.random()
        if c < 0.2:
            return f"with w as ({self.query(max(d - 1, 0))}) select * from w join {self.r.choice(TABLES)} q on 1 = 1"
        if c < 0.45:
            return f"insert into {self.r.choice(['out.o1', 'out.o2'])} {q}"
        if c < 0.55:
            return f"insert overwrite table out.o3 partition (dt) {q}"
        return q


class Gen2(Gen):
    def source(self, d):
        c = self.r.random()
        if d > 0 and c < 0.2:
            return f"({self.query(d - 1)}) {self.alias()}"
        if d > 0 and c < 0.3:
            return f"({self.r.choice(TABLES)} join {self.r.choice(TABLES)} on 1 = 1)"
        if c < 0.35:
            return f"range(10) {self.alias()}"
        if c < 0.4:
            return f"{self.r.choice(TABLES)} {self.alias()} lateral view explode(arr) e as v"
        if c < 0.45:
            return f"(values (1, 2), (3, 4)) {self.alias()}(p, q)"
        return f"{self.r.choice(TABLES)} {self.alias()}"

    def select_list(self, d):
        c = self.r.random()
        if c < 0.2:
            return "a, row_number() over (partition by a order by b desc) rn"
        if c < 0.3:
            return "/*+ broadcast(a1) */ a"
        if c < 0.4:
            return "case when a in (1, 2) then 'x' else 'y' end t, cast(b as decimal(20,2)) m"
        return super().select_list(d)

    def query(self, d):
        q = super().query(d)
        c = self.r.random()
        if d > 0 and c < 0.1:
            q = f"({q}) intersect (select a from {self.r.choice(TABLES)})"
        elif d > 0 and c < 0.2:
            q = f"{q} except select a from {self.r.choice(TABLES)}"
        elif c < 0.3:
            q += " order by a limit 10"
        return q

    def statement(self):
        c = self.r.random()
        d = self.r.randint(0, 2)
        if c < 0.1:
            return f"create table out.c{self.r.randint(1,9)} as {self.query(d)}"
        if c < 0.2:
            return f"create view out.v{self.r.randint(1,9)} as {self.query(d)}"
        if c < 0.3:
            t = self.r.choice(TABLES)
            return f"from {t} insert into out.o1 select a insert overwrite table out.o2 select b"
        if c < 0.4:
            return f"with w as ({self.query(d)}), w2 as (select * from w) insert into out.o4 select * from w2"
        return super().statement()


def _relations(parser, sql):
    plan = parser.parsePlan(sql).toString()
    return {n.replace(", ", ".") for n in re.findall(r"UnresolvedRelation \[([^\]]+)\]", plan)}


def _check(spark, g, n, min_checked):
    sqls = [g.statement() for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(sqls)), "stmt_id long, sql string")
    rec = {r.stmt_id: r for r in lineage(df).collect()}
    parser = spark._jsparkSession.sessionState().sqlParser()
    checked = 0
    for i, sql in enumerate(sqls):
        try:
            names = _relations(parser, sql)
        except Exception:
            continue
        checked += 1
        r = rec[i]
        assert r.parse_ok, sql
        assert set(r.inputs) <= names, (sql, r.inputs, names)
        assert names <= set(r.inputs) | set(r.outputs), (sql, r.inputs, r.outputs, names)
    assert checked >= min_checked


def test_random_statements_against_spark_parser(spark):
    _check(spark, Gen(20261203), 150, 120)


def test_random_statements_more_constructs(spark):
    """Parenthesised joins, table functions, lateral view, VALUES, window functions, hints,
    INTERSECT/EXCEPT, ORDER/LIMIT, CTAS, views, FROM-first multi-insert, WITH .. INSERT."""
    _check(spark, Gen2(4242), 150, 100)


def _with_comments(r, sql):
    """A comment in some of the gaps between words (literals and hints stay whole)."""
    marks = ["/* from c.c */", "/**/", "/* it's */", "/* a /* b */ \" from c.c */", "/* 1 /* 2 /* 3 /* 4 /* 5 /* 6 */ */ */ */ */ , c.c */",
             "-- from c.c, 'x\n", "-- */ /*\n", "/* -- */", "/* , */"]
    parts = re.split(r"('[^']*'|/\*.*?\*/)", sql)
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r" |(?<=[(),])", lambda m: f" {r.choice(marks)} " if r.random() < 0.5 else m[0], parts[i])
    return "".join(parts)


def test_comments_at_every_gap(spark):
    """Random statements with comments put between their words: same record, same relations for Spark's parser."""
    g, r = Gen2(99), random.Random(5)
    plain = [g.statement() for _ in range(150)]
    noisy = [_with_comments(r, s) for s in plain]
    df = spark.createDataFrame(list(enumerate(plain + noisy)), "stmt_id long, sql string")
    rec = {x.stmt_id: x for x in lineage(df).collect()}
    parser = spark._jsparkSession.sessionState().sqlParser()
    checked = 0
    for i, (a, b) in enumerate(zip(plain, noisy)):
        x, y = rec[i], rec[len(plain) + i]
        assert x[1:] == y[1:], b
        try:
            names = _relations(parser, b)
        except Exception:
            continue
        checked += 1
        assert set(y.inputs) <= names <= set(y.inputs) | set(y.outputs), b
    assert checked >= 100


def test_random_ansi_quoted_names(spark):
    """quotes='ansi' against Spark's parser with double-quoted identifiers switched on."""
    quoted = ['"db"."t1"', 'db."T2"', '"s"."my orders"', "s.items", '"t3"', "t4", 'x."y"']
    saved = TABLES[:]
    conf = {k: spark.conf.get(k, None) for k in ("spark.sql.ansi.enabled",
                                                 "spark.sql.ansi.doubleQuotedIdentifiers")}
    try:
        TABLES[:] = quoted
        spark.conf.set("spark.sql.ansi.enabled", "true")
        spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
        g = Gen2(777)
        sqls = [g.statement().replace("'from fake.table'", "'from \"fake\".\"t\"'") for _ in range(120)]
        df = spark.createDataFrame(list(enumerate(sqls)), "stmt_id long, sql string")
        rec = {r.stmt_id: r for r in lineage(df, quotes="ansi").collect()}
        parser = spark._jsparkSession.sessionState().sqlParser()
        checked = 0
        for i, sql in enumerate(sqls):
            try:
                names = _relations(parser, sql)
            except Exception:
                continue
            checked += 1
            r = rec[i]
            assert r.parse_ok and set(r.inputs) <= names <= set(r.inputs) | set(r.outputs), (sql, r.inputs, names)
        assert checked >= 80
    finally:
        TABLES[:] = saved
        for k, v in conf.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
