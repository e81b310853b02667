"""Lineage records per statement (L16-L19, L23-L25) and the table-edge view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from sqlweave.functions import text as T
from sqlweave.operators.refs import dialect_options, fold_case, statement_labels
from sqlweave.operators.tokens import tokenize


def _set(refs: str, holds) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.filter(refs, holds), lambda r: r["table_name"])))


def _one(c: Column) -> Column:
    return F.when(c.isNotNull() & (c != ""), F.array(c)).otherwise(F.array().cast("array<string>"))


def lineage(statements: DataFrame, id_col: str = "stmt_id", sql: str = "sql",
            case: str = "keep", on_error: str = "empty",
            carry: tuple[str, ...] = (), partitioned: bool = False,
            quotes: str = "hive", dedup: bool = False, dialect: str | None = None) -> DataFrame:
    """One row per statement:
    (stmt_id, *carry, kind, inputs, outputs, ctes, from_inputs, parse_ok, source_inputs).

    * ``inputs`` keeps WITH names, as the reference does; ``source_inputs`` drops them (L16,
      departure D3); ``from_inputs`` is the FROM-chain-only profile (L13).
    * all sets are sorted and unique (TreeSet semantics on UTF-8 order).
    * ``quotes``: 'hive' (double quotes delimit strings, as in Hive/Spark) or 'ansi'
      (double-quoted identifiers, as in Calcite; with ``case='upper'`` that is Calcite's
      default front end).
    * ``dialect``: 'hive' / 'spark' (case kept, double quotes are strings) or 'calcite'
      (unquoted parts upper-cased, double-quoted identifiers); overrides ``case``/``quotes``.
    * ``stmt_id`` should identify one statement; two texts under one id give a record each (copies
      of one text must be removed first). ``dedup=True`` first removes re-delivered
      copies (same id, same text) with a ``distinct`` that Spark combines on the map side, so
      a statement logged a million times costs one row per map task before any shuffle.
    * ``on_error``: 'empty' gives empty sets for unparsable statements (Hive), 'keep' keeps
      what was found, 'raise' fails the job (Spark/Calcite paths). ``quarantine`` splits.

    Physical shape: the statement rows are hash-partitioned by ``stmt_id`` once (the text
    is shuffled, not the several-times larger token rows; skipped with ``partitioned=True``
    when the input already is); kind, command names and ``carry`` columns stay in the statement's row, and its tokens are
    walked within that row, so the whole job is one linear pipeline on that partitioning.
    """
    case, quotes = dialect_options(dialect, case, quotes)
    if dedup:
        statements = statements.select(id_col, *carry, sql).distinct()
    st = statement_header(statements, id_col, sql, case, carry, quotes)
    # two texts under one id are two statements: the tokens of each stay apart
    key = [id_col, "_text"]
    if not partitioned and not isinstance(statements.schema[id_col].dataType, (IntegerType, LongType)):
        # Sort and partition the tokens by two 64-bit hashes of a string id (as much room
        # against collisions as an md5 id itself) instead of the 32-char string: narrower
        # rows, long comparisons. Deterministic, so a recomputed task after an executor
        # loss assigns the same keys. (With ``partitioned=True`` the caller's stmt_id
        # partitioning is reused as is.)
        key = ["_k1", "_k2"]
        st = st.select(F.xxhash64(id_col).alias("_k1"),
                       F.xxhash64(F.lit("k2"), id_col, "_text").alias("_k2"), "*").drop("_text")
    if not partitioned:
        st = st.repartition(key[0])
    head_cols = list(dict.fromkeys([c for c in (id_col, *carry) if c not in key] + ["kind", "cmd_in", "cmd_out"]))
    toks = tokenize(st, key, "_head", carry=tuple(head_cols), masked=True, quotes=quotes)
    labelled = statement_labels(toks, key, case, tuple(head_cols))
    out = lineage_from_labels(labelled, key, on_error, carry, id_col)
    return out.drop(*[k for k in key if k != id_col])


def statement_header(statements: DataFrame, id_col: str = "stmt_id", sql: str = "sql",
                     case: str = "keep", carry: tuple[str, ...] = (), quotes: str = "hive") -> DataFrame:
    """Per statement, narrow (no shuffle): (stmt_id, *carry, _text, _head, kind, cmd_in, cmd_out).
    ``_text`` is a hash of the text.
    ``_head`` is the masked, blank-squeezed text the tokens are cut from; kind (L25) and the
    object names of command kinds come from the leading words. Each step is its own
    projection so the masked text and the first word are computed once per statement."""
    st = statements.select(id_col, *carry, F.xxhash64(sql).alias("_text"),
                           T.statement_head(F.col(sql), quotes).alias("_head"))
    st = st.select("*", T.first_word(F.col("_head")).alias("_w"))
    st = st.select(id_col, *carry, "_text", "_head", T.classify_statement(F.col("_head"), F.col("_w")).alias("kind"))
    cmd_in, cmd_out = T.command_refs(F.col("_head"), F.col("kind"))
    return st.select(id_col, *carry, "_text", "_head", "kind", fold_case(cmd_in, cmd_in, case).alias("cmd_in"),
                     fold_case(cmd_out, cmd_out, case).alias("cmd_out"))


def statement_kinds(statements: DataFrame, id_col: str = "stmt_id", sql: str = "sql") -> DataFrame:
    """L25 alone: (stmt_id, kind), one narrow pass, no token walk."""
    return statement_header(statements, id_col, sql).select(id_col, "kind")


def lineage_from_labels(labelled: DataFrame, key="stmt_id", on_error: str = "empty",
                        carry: tuple[str, ...] = (), id_col: str = "stmt_id") -> DataFrame:
    key = [key] if isinstance(key, str) else list(key)
    agg = labelled.withColumns({
        "tok_in": _set("refs", lambda r: r["role"] == "in"),
        "tok_from": _set("refs", lambda r: (r["role"] == "in") & (r["in_subquery"] == 0)),
        "tok_out": _set("refs", lambda r: r["role"] == "out"),
        "ctes": _set("refs", lambda r: r["role"] == "cte")})
    command = F.col("kind").isin(*T.COMMAND_KINDS)
    def ins(found):
        return (F.when(command, _one(F.col("cmd_in")))
                .when(F.col("kind") == "merge", F.array_sort(F.array_union(F.col(found), _one(F.col("cmd_in")))))
                .otherwise(F.col(found)))

    inputs, from_inputs = ins("tok_in"), ins("tok_from")
    outputs = (F.when(command, _one(F.col("cmd_out")))
               .when(F.col("kind").isin(*T.TARGET_KINDS),
                     F.array_sort(F.array_union(F.col("tok_out"), _one(F.col("cmd_out")))))
               .otherwise(F.col("tok_out")))
    ctes = F.when(command, F.array().cast("array<string>")).otherwise(F.col("ctes"))
    found = (F.size("tok_in") > 0) | (F.size("tok_out") > 0)
    parse_ok = (F.col("balanced") & ((F.col("kind") != "unknown") | found)
                & (~F.col("kind").isin("insert", "ctas") | (F.size(outputs) > 0)))
    out = agg.select(*dict.fromkeys((id_col, *key)), *carry, "kind", inputs.alias("inputs"), outputs.alias("outputs"),
                     ctes.alias("ctes"), from_inputs.alias("from_inputs"), parse_ok.alias("parse_ok"))
    out = out.withColumn("source_inputs", F.array_except("inputs", "ctes"))
    if on_error == "empty":
        empty = F.array().cast("array<string>")
        for c in ("inputs", "outputs", "ctes", "source_inputs", "from_inputs"):
            out = out.withColumn(c, F.when(F.col("parse_ok"), F.col(c)).otherwise(empty))
    elif on_error == "raise":
        out = out.withColumn("parse_ok", F.when(F.col("parse_ok"), F.col("parse_ok")).otherwise(
            F.raise_error(F.concat(F.lit("unparsable statement "), F.col(id_col).cast("string")))
            .cast("boolean")))
    return out


def quarantine(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L23 'quarantine': (parsable, unparsable), split by filter; no extra pass."""
    return records.where(F.col("parse_ok")), records.where(~F.col("parse_ok"))


def table_edges(records: DataFrame, id_col: str = "stmt_id") -> DataFrame:
    """One row per (statement, written table) with the tables it is built from
    (hyper-edge form: no input x output pair list is materialised)."""
    return records.select(id_col, F.explode("outputs").alias("target"),
                          F.col("source_inputs").alias("sources"))


def io_pair(records: DataFrame, id_col: str = "stmt_id") -> DataFrame:
    """The (inputs, outputs) pair of the Spark front end."""
    return records.select(id_col, "inputs", "outputs")
