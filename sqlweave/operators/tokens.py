"""Statement -> tokens with scope and clause.

Replaces the reference's tree walkers with array steps over the tokens of many statements at once: Spark masks and cuts
the text (narrow, per row), brings the copies of a statement together, and runs the steps below on its Arrow batches.
A statement's tokens never leave its task: nothing but the statement rows is shuffled or sorted by Spark.

Bracket depth, enclosing scope and current clause are running sums and running "last marked value" steps within a
statement. All scope facts are read from ONE ordering, (statement, outer depth, pos), where a '(' or ')' belongs to the
scope *around* it. In that ordering consecutive scopes at the same depth follow each other without a separator, so each
scope's first token (the token right after its '(') acts as the reset mark: clause, scope id, the token before the
scope's bracket, the query flag and bracket pairing are all the last marked value up to a row.

Skew: the unit of work is one statement, which is one input row; batches are worked on in slices of whole statements of
about ``SLICE_TOKENS`` tokens, so the arrays of a task don't grow with the table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlweave.functions import text as T

# ---------------------------------------------------------------------------------------
# Keywords that open a clause, and words that are never table names.
MAJOR = ("select", "from", "where", "group", "having", "order", "union", "intersect", "except",
         "lateral", "insert", "limit", "window", "sort", "cluster", "distribute", "create",
         "with", "values")
NOT_NAMES = MAJOR + ("table", "into", "overwrite", "on", "using", "if", "join", "local", "directory")
# Tokens that may stand right before a bracket that opens a query (not an expression);
# '' is the start of the statement.
QUERY_BRACKET_AFTER = ("", "from", "join", "as", "union", "all", "except", "intersect", "minus", "(")
# Clause words that are names in a select list when ',' or 'from' follows, or after 'as'.
SOFT = ("where", "group", "having", "order", "lateral", "limit", "window", "sort", "cluster",
        "distribute", "create", "insert", "with", "values")
# Every other token the rules look at.
OTHER_WORDS = ("distinct", "exists", "view", "trim", ",", ")")
# ---------------------------------------------------------------------------------------

# Small integer codes of the tokens the rules test (0 = any other token, NONE = no token:
# before the first or after the last one).
_VOCAB = tuple(dict.fromkeys(NOT_NAMES + tuple(w for w in QUERY_BRACKET_AFTER if w) + OTHER_WORDS))
CODE = {w: i + 1 for i, w in enumerate(_VOCAB)}
NONE = -1
RESET = -2


def code(word: str) -> int:
    return NONE if word == "" else CODE[word]


def codes(words) -> list[int]:
    return [code(w) for w in words]


# Tokens worked on at once (temporaries are some fifty arrays of eight bytes each).
SLICE_TOKENS = 1 << 17


def key_cols(id_col) -> list[str]:
    """A statement key is one column or a list of columns (e.g. two 64-bit hashes)."""
    return [id_col] if isinstance(id_col, str) else list(id_col)


def tokenize(statements: DataFrame, id_col="stmt_id", sql: str = "sql",
             carry: tuple[str, ...] = (), masked: bool = False, quotes: str = "hive") -> DataFrame:
    """L9+L10: (stmt_id, *carry, toks, copies), the tokens of a statement in order, with literals and comments masked first.

    One row per (id, text): copies of a text under one id are counted. The rows are grouped by keys that start with the
    id, so Spark shuffles them at most once, and not at all when they already are partitioned by it.
    ``masked=True`` takes text that went through ``mask_literals`` already (the statement
    head). ``quotes='ansi'`` keeps double-quoted identifiers as name tokens. Statements without any token are kept (L17).
    """
    key = key_cols(id_col)
    st = statements.select(*key, *carry, F.col(sql).alias("_sql"))
    if len(key) == 1:  # a key of two columns already tells the texts of an id apart
        st = st.withColumn("_t", F.xxhash64("_sql"))
    by = [*key, *(["_t"] if "_t" in st.columns else [])]
    rest = [c for c in st.columns if c not in by]
    st = st.groupBy(*by).agg(F.first(F.struct(*rest)).alias("_r"), F.count(F.lit(1)).alias("copies"))
    text = F.col("_r._sql") if masked else T.mask_literals(F.col("_r._sql"), quotes)
    toks = F.regexp_extract_all(text, F.lit(T.TOKEN_ANSI if quotes == "ansi" else T.TOKEN), 0)
    return st.select(*key, *[F.col(f"_r.{c}").alias(c) for c in carry], toks.alias("toks"), "copies")


class Runs:
    """Rows in runs (statements, or statements and depths) that lie one behind the other, given by a run number per row."""

    def __init__(self, run: np.ndarray):
        self.n = len(run)
        new = np.ones(self.n, bool)
        new[1:] = run[1:] != run[:-1]
        self.at = np.arange(self.n)
        self.start = np.maximum.accumulate(np.where(new, self.at, 0))
        self.new = new

    def shift(self, a: np.ndarray, k: int, fill) -> np.ndarray:
        """The value k rows before (after, if k is negative) in the run, else ``fill``."""
        out = np.full(self.n, fill, a.dtype)
        if 0 < k < self.n:
            out[k:] = np.where(self.start[k:] == self.start[:-k], a[:-k], fill)
        elif 0 < -k < self.n:
            out[:k] = np.where(self.start[:k] == self.start[-k:], a[-k:], fill)
        return out

    def total(self, a: np.ndarray) -> np.ndarray:
        """Running sum in the run."""
        s = np.cumsum(a)
        return s - (s - a)[self.start] if self.n else s

    def last(self, marked: np.ndarray, inclusive: bool = True) -> np.ndarray:
        """Row of the last marked row of the run up to (or before) a row, -1 for none."""
        m = np.maximum.accumulate(np.where(marked, self.at, -1)) if self.n else self.at
        if not inclusive:
            m = np.concatenate([[-1], m[:-1]])[:self.n]
        return np.where(m >= self.start, m, -1)


def taken(a: np.ndarray, rows: np.ndarray, none) -> np.ndarray:
    """a at rows, ``none`` where the row is -1."""
    return np.where(rows >= 0, a[rows], none) if len(a) else a


def _is(c: np.ndarray, words) -> np.ndarray:
    return np.isin(c, codes(words))


def scope_facts(tok: pa.Array, stmt: np.ndarray, pos: np.ndarray) -> dict[str, np.ndarray]:
    """L11 + L13 facts of tokens that lie in (stmt, pos) order (codes are ints, see ``CODE``):

    c (token code), pv/pv2/nx (codes of the previous two and the next token), d (depth; a '(' has the
    inner depth, a ')' the outer), kw_as_name (a major keyword used as a name), cl (clause: last major keyword before the
    token in its scope, 0 for none), sc (scope
    id, -1 at top level), opv (code of the token before the scope's bracket), q (the scope
    holds a query), ex (a '(' opens an expression, not a query), op (for a ')': ex of
    its '(') and by_scope (the rows in scope order).
    """
    # the vocabulary is ASCII and no letter outside of ASCII becomes one of its letters in lower case
    c = pc.fill_null(pc.index_in(pc.ascii_lower(tok), value_set=pa.array(list(CODE), pa.string())), -1)
    c = c.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    w1 = Runs(stmt)
    pv, pv2, nx, nx2 = (w1.shift(c, k, NONE) for k in (1, 2, -1, -2))
    opening, closing = c == code("("), c == code(")")
    d = w1.total(opening.astype(np.int64) - closing)

    # --- one ordering: (stmt, outer depth, pos) -------------------------------------------
    od = d - opening
    first = (pv == code("(")) & ~closing          # first token of a bracket scope
    soft_clause = ("order", "group", "having", "limit", "sort", "cluster", "distribute", "lateral", "window")
    as_name = ((_is(c, SOFT) & _is(nx, (",", "from")))
               | (_is(c, soft_clause) & (pv == code("as")))
               | ((c == code("window")) & (nx2 != code("as")))
               | ((c == code("lateral")) & (nx != code("view")))
               | ((c == code("from")) & (pv == code("distinct"))))
    major = _is(c, MAJOR) & ~as_name
    # "join" only occurs in a FROM list, so it opens one again after a lateral view or VALUES.
    kw = np.where(c == code("join"), code("from"), np.where(major, c, 0))
    # any other major keyword right before a comma: the statement is marked unparsable.
    kw_as_name = major & (nx == code(","))

    n = len(c)
    low = od.min() if n else 0
    run = (np.cumsum(w1.new) - 1) * ((od.max() if n else 0) - low + 1) + (od - low)
    order = np.argsort(run, kind="stable")
    w2 = Runs(run[order])

    def back(a):
        out = np.empty_like(a)
        out[order] = a
        return out

    first2, pos2 = first[order], pos[order]
    kw_or_reset = np.where(first2 & (kw[order] == 0), RESET, kw[order])
    cl0 = taken(kw_or_reset, w2.last(kw_or_reset != 0, inclusive=False), 0)
    scope = w2.last(first2)
    sc, opv = back(taken(pos2, scope, -1)), back(taken(pv2[order], scope, NONE))
    cl = back(np.where(first2 | (cl0 == RESET), 0, cl0))
    # Query scope: a select/insert, or a FROM that starts a query (first word of the
    # statement, first word of a bracket but that of trim(from ..), or right after a WITH list),
    # seen so far in this scope. Every FROM-clause name of a query follows such a word, so
    # the running flag equals the whole-scope flag where the rules read it.
    starts_query = ((c == code("from"))
                    & ((pos == 0) | (first & (opv != code("trim"))) | ((cl == code("with")) & (pv == code(")")))))
    qword = _is(c, ("select", "insert")) | starts_query
    q = back(taken(qword[order], w2.last((qword | first)[order]), False))
    query_bracket = (_is(pv, QUERY_BRACKET_AFTER) | (pv == code("lateral")) | ((pv == code(",")) & (cl == code("from")))
                     | _is(cl, ("insert", "create")))
    ex = opening & ~query_bracket
    op = back(taken(ex[order], w2.last(opening[order]), False))
    return {"c": c, "pv": pv, "pv2": pv2, "nx": nx, "d": d, "kw_as_name": kw_as_name, "cl": cl, "sc": sc, "opv": opv,
            "q": q, "ex": ex, "op": op, "by_scope": order}


def from_brackets(f: dict[str, np.ndarray], w: Runs) -> np.ndarray:
    """in_from: the last bracket opened before the row stands in a FROM list (after FROM, JOIN or
    a comma of the list); a bracket right inside another takes over its answer. Read for the
    first token of a bracket, whose last bracket opened is its own."""
    pv = f["pv"]
    opens = (pv == code("join")) | (_is(pv, ("from", ",")) & f["q"] & (f["cl"] == code("from")))
    return taken(opens, w.last((f["c"] == code("(")) & (pv != code("(")), inclusive=False), False)


def expression_nesting(f: dict[str, np.ndarray], w: Runs) -> np.ndarray:
    """in_subquery: number of expression brackets around each row (L13). Needs every
    bracket of the statement among the rows; other tokens may be left out beforehand."""
    return w.total(np.where(f["c"] == code("("), f["ex"], 0) - np.where(f["c"] == code(")"), f["op"], 0).astype(np.int64))


def by_slices(toks: pa.Array, copies: pa.Array, walk: Callable[[pa.Array, np.ndarray, np.ndarray, int], pa.Array]) -> pa.Array:
    """walk(tokens, statement numbers, positions, number of statements) over slices of whole statements; its values in order."""
    counts = pc.fill_null(pc.list_value_length(toks), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    copies = copies.to_numpy(zero_copy_only=False).astype(np.int64)
    ends, out, lo = np.cumsum(counts * copies), [], 0
    while lo < len(counts):
        hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE_TOKENS, "right")), lo + 1)
        n, times = counts[lo:hi], copies[lo:hi]
        tok = toks.slice(lo, hi - lo).flatten()
        stmt = np.repeat(np.arange(hi - lo), n)
        pos = np.arange(len(stmt)) - np.repeat(np.cumsum(n) - n, n)
        if (times > 1).any():
            rows = np.repeat(np.arange(len(stmt)), times[stmt])
            tok, stmt, pos = tok.take(pa.array(rows)), stmt[rows], pos[rows]
        out.append(walk(tok, stmt, pos, hi - lo))
        lo = hi
    return pa.chunked_array(out).combine_chunks() if out else walk(pa.array([], pa.string()), copies, copies, 0)


def list_of(values: pa.Array, stmt: np.ndarray, n: int) -> pa.Array:
    """The values of each of n statements as a list; ``stmt`` ascends."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(stmt, np.arange(n + 1)), pa.int32()), values)


def _depths(tok: pa.Array, stmt: np.ndarray, pos: np.ndarray, n: int) -> pa.Array:
    f = scope_facts(tok, stmt, pos)
    fields = {"pos": pa.int32(), "d": pa.int32(), "cl": pa.int32(), "q": pa.bool_()}
    cols = [pa.array(v, t) for v, t in zip((pos, f["d"], f["cl"], f["q"]), fields.values())]
    return list_of(pa.StructArray.from_arrays([tok, *cols], ["tok", *fields]), stmt, n)


SCOPED = "array<struct<tok:string,pos:int,d:int,cl:int,q:boolean>>"


def _scoped(toks: pa.Array, copies: pa.Array) -> pa.Array:
    return by_slices(toks, copies, _depths)


def scope_tokens(tokens: DataFrame, id_col="stmt_id") -> DataFrame:
    """A row per token, (stmt_id, pos, tok, d, cl, q) as in ``scope_facts``; a statement without tokens has one row, of
    nulls."""
    t = tokens.select(*key_cols(id_col), F.explode_outer(F.arrow_udf(_scoped, SCOPED)("toks", "copies")).alias("t"))
    return t.select(*key_cols(id_col), "t.pos", "t.tok", F.coalesce("t.d", F.lit(0)).alias("d"), "t.cl", "t.q")
