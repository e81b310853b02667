"""Token table -> table references."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlweave.functions import text as T
from sqlweave.operators.tokens import (NOT_NAMES, Runs, _is, by_slices, code, expression_nesting, from_brackets, key_cols,
                                       list_of, scope_facts, tokenize)

# ---------------------------------------------------------------------------------------
# Tokens that stand right before a written table, and before a read table.
OUT_AFTER = ("table", "into", "exists", "overwrite", "view")
IN_AFTER = ("from", "join", ",")
# What may stand before TABLE where "TABLE name" is a query; '' is the start of the statement.
TABLE_QUERY_AFTER = ("", "(", "as", "union", "all", "except", "intersect", "minus", "distinct")
# What a name's token holds; names may start with a digit, numbers hold no letter where a name can stand.
NAME_SIGN = r"[`\"\p{L}_]"
# Copies of one text under one id are walked together, each token as often as there are copies. More copies than this give
# the same references, as no rule looks more than two tokens back or ahead.
COPIES = 4
# ---------------------------------------------------------------------------------------


# Name folding and quoting per SQL front end.
DIALECTS = {"hive": ("keep", "hive"), "spark": ("keep", "hive"), "calcite": ("upper", "ansi")}


def dialect_options(dialect: str | None, case: str, quotes: str) -> tuple[str, str]:
    """(case, quotes) for a named front end, or the explicit values when none is named."""
    return DIALECTS[dialect] if dialect else (case, quotes)


def fold_case(name: Column, raw: Column, case: str) -> Column:
    """L22: 'keep' (Hive/Spark paths), 'upper' (Calcite default) or 'lower'. Folding is per
    name part: a back-ticked or double-quoted part keeps its case, the others fold."""
    if case == "keep":
        return name
    f = F.upper if case == "upper" else F.lower
    parts = F.regexp_extract_all(raw, F.lit('`[^`]+`|"[^"]+"|[^.`"]+'), 0)
    folded = F.transform(parts, lambda p: F.when(p.rlike('^[`"]'), F.regexp_replace(p, '[`"]', ""))
                         .otherwise(f(p)))
    return F.when(raw.contains("`") | raw.contains('"'), F.array_join(folded, ".")).otherwise(f(name))


ROLES = np.array(["", "cte", "in", "out", "bracket"])
LABELS = "struct<refs:array<struct<tok:string,pos:int,role:string,in_subquery:int>>,balanced:boolean>"


def _roles(tok: pa.Array, f: dict[str, np.ndarray]) -> np.ndarray:
    """Per token the place of its role in ROLES, 0 for none."""
    c, pv, pv2, nx, cl, q = f["c"], f["pv"], f["pv2"], f["nx"], f["cl"], f["q"]
    table_query = (pv == code("table")) & (_is(pv2, TABLE_QUERY_AFTER) | ((cl == code("insert")) & ~_is(pv2, ("into", "overwrite"))))
    no_call = nx != code("(")
    rules = (
        (1, (cl == code("with")) & _is(pv, ("with", ",")) & _is(nx, ("as", "("))),
        (2, no_call & table_query),
        (3, _is(cl, ("insert", "create")) & _is(pv, OUT_AFTER)),
        (2, no_call & (pv == code("join"))),
        (2, no_call & q & (cl == code("from")) & _is(pv, IN_AFTER)),
        # the comma after an inline table's last bracket: "from values (1), (2) as t(x), b"
        (2, no_call & q & (cl == code("values")) & (pv == code(",")) & (pv2 == code(")"))),
        # a name first in a bracket or behind a comma of it: a table if the bracket stands in a FROM list, see below
        (4, no_call & ~q & (f["sc"] >= 0) & _is(pv, ("(", ",")) & ((cl == 0) | (cl == code("from")))))
    role = np.zeros(len(c), np.int8)
    for r, holds in reversed(rules):
        role[holds] = r
    role[_is(c, NOT_NAMES)] = 0
    some = np.flatnonzero(role)
    named = pc.match_substring_regex(tok.take(pa.array(some)), NAME_SIGN).to_numpy(zero_copy_only=False).astype(bool)
    role[some[~named]] = 0
    return role


def _labels(tok: pa.Array, stmt: np.ndarray, pos: np.ndarray, n: int) -> pa.Array:
    """LABELS of n statements: their references, and whether brackets and keywords stand as in a statement that parses."""
    f = scope_facts(tok, stmt, pos)
    f["role"] = _roles(tok, f)
    kept = (f["role"] > 0) | _is(f["c"], ("(", ")")) | (pos == 0) | f["kw_as_name"]
    rows = f.pop("by_scope")
    rows = rows[kept[rows]]
    rows = rows[np.lexsort((pos[rows], stmt[rows]))]
    f = {k: v[rows] for k, v in f.items()}
    s, p = stmt[rows], pos[rows]
    w = Runs(s)
    role = np.where((f["role"] == 4) & from_brackets(f, w), 2, f["role"])
    nesting = expression_nesting(f, w)
    ref = np.flatnonzero((role > 0) & (role < 4))
    refs = pa.StructArray.from_arrays(
        [tok.take(pa.array(rows[ref])), pa.array(p[ref], pa.int32()), pa.array(ROLES[role[ref]].tolist(), pa.string()),
         pa.array(nesting[ref], pa.int32())], ["tok", "pos", "role", "in_subquery"])
    # depth only falls at ')' and only changes at brackets, all of which are kept rows: min / last depth over them equal
    # those over all tokens; keywords used as names are kept rows too.
    balanced = np.ones(n, bool)
    balanced[s[(f["d"] < 0) | f["kw_as_name"]]] = False
    last = np.append(s[1:] != s[:-1], True)[:len(s)]
    balanced[s[last & (f["d"] != 0)]] = False
    return pa.StructArray.from_arrays([list_of(refs, s[ref], n), pa.array(balanced)], ["refs", "balanced"])


def _labelled(toks: pa.Array, copies: pa.Array) -> pa.Array:
    return by_slices(toks, copies, _labels)


def statement_labels(tokens: DataFrame, id_col="stmt_id", case: str = "keep", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per statement: (stmt_id, *carry, refs, balanced); refs hold pos, ``role`` (in | out | cte), in_subquery (expression
    brackets around it) and ``table_name`` (back-ticks removed) of its references."""
    t = tokens.select(*key_cols(id_col), *carry, F.arrow_udf(_labelled, LABELS)("toks", F.least("copies", F.lit(COPIES))).alias("_l"))
    name = lambda r: fold_case(F.regexp_replace(r["tok"], "[`\"]", ""), r["tok"], case)
    refs = F.transform("_l.refs", lambda r: F.struct(r["pos"].alias("pos"), r["role"].alias("role"), r["in_subquery"].alias("in_subquery"),
                                                     name(r).alias("table_name")))
    return t.select(*key_cols(id_col), *carry, refs.alias("refs"), F.col("_l.balanced").alias("balanced"))


def label_tokens(tokens: DataFrame, case: str = "keep", id_col="stmt_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per reference: (stmt_id, *carry, pos, role, in_subquery, table_name); one row of nulls for a statement without
    references, which keeps it in the result."""
    st = statement_labels(tokens, id_col, case, carry)
    return st.select(*key_cols(id_col), *carry, F.explode_outer("refs").alias("_r")).select(*key_cols(id_col), *carry, "_r.*")


def token_refs(statements: DataFrame, id_col: str = "stmt_id", sql: str = "sql",
               case: str = "keep", carry: tuple[str, ...] = (), partitioned: bool = False,
               quotes: str = "hive", dialect: str | None = None) -> DataFrame:
    """Statements -> labelled reference rows (``role`` null for a statement without references). The statement text is
    hash-partitioned by ``stmt_id`` unless it already is; ``partitioned`` says so where Spark can't know."""
    case, quotes = dialect_options(dialect, case, quotes)
    st = statements.select(id_col, *carry, T.statement_head(F.col(sql), quotes).alias("_head"))
    toks = tokenize(st, id_col, "_head", carry, masked=True, quotes=quotes)
    return label_tokens(toks, case, id_col, carry)


def table_refs(labelled: DataFrame, role: str | None = None,
               include_expression_subqueries: bool = True) -> DataFrame:
    """One row per reference (stmt_id, pos, table_name, role). ``role`` filters
    to in/out/cte; ``include_expression_subqueries=False`` keeps the FROM chain only (L13)."""
    r = labelled.where(F.col("role").isNotNull())
    if role:
        r = r.where(F.col("role") == role)
    if not include_expression_subqueries:
        r = r.where(F.col("in_subquery") == 0)
    return r.select("stmt_id", "pos", "table_name", "role")


def _source_refs(labelled: DataFrame) -> DataFrame:
    # The dependency list follows the FROM chain and never collects the INSERT target.
    return table_refs(labelled, "in", include_expression_subqueries=False)


def ref_counts(labelled: DataFrame) -> DataFrame:
    """L20 multiset as counts: (stmt_id, table_name, n). Groups by a key that starts with
    stmt_id, so the token job's partitioning is reused (no new exchange)."""
    return (_source_refs(labelled).groupBy("stmt_id", "table_name")
            .agg(F.count(F.lit(1)).alias("n")))


def ref_list(labelled: DataFrame) -> DataFrame:
    """(stmt_id, refs array) in text order, duplicates kept."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "table_name")))
    return (_source_refs(labelled).groupBy("stmt_id")
            .agg(F.transform(ordered, lambda x: x["table_name"]).alias("refs")))


def ref_string(labelled: DataFrame) -> DataFrame:
    """The list joined with ','."""
    return ref_list(labelled).select("stmt_id", F.array_join("refs", ",").alias("ref_string"))
