"""Column-level lineage graph (L26-L38, L42-L43) as DataFrame jobs over ``column_deps``.

Layout of the work: everything that belongs to one sink (destination, fields, labels,
edges) is computed from one row per (stmt_id, sink_pos) holding that sink's dependencies as
arrays - a group no larger than one statement's select list. Edge merge is a hash
aggregate keyed by (stmt_id, type, expression, source set); vertex numbering is a window
per statement. No step collects more than one statement, and no input x output pair list
is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# Operations whose lineage is written, and entity types that can be a sink.
ELIGIBLE_KINDS = ("query", "insert", "insert_directory", "ctas", "create_view", "alter_view_as")
SINK_ENTITY_TYPES = ("TABLE", "PARTITION")
# ---------------------------------------------------------------------------------------



def _empty_s():
    return F.array().cast("array<string>")


def eligible(records: DataFrame) -> DataFrame:
    """Statements whose column lineage is written: query, insert, CTAS, create view,
    alter view as; never EXPLAIN; and only when the statement could be analysed."""
    return records.where(F.col("kind").isin(*ELIGIBLE_KINDS) & F.col("parse_ok"))


def source_vertices(sources: Column) -> Column:
    """Temporary tables skipped; label db.table (TABLE) or db.table.col (COLUMN);
    a set, so a repeated vertex is kept once (first place)."""
    kept = F.filter(sources, lambda s: ~F.coalesce(s["is_temporary"], F.lit(False)))
    return F.array_distinct(F.transform(kept, lambda s: F.struct(
        F.concat_ws(".", s["db"], s["tbl"], s["col"]).alias("label"),
        F.when(s["col"].isNull(), F.lit("TABLE")).otherwise(F.lit("COLUMN")).alias("type"))))


def by_statement(df: DataFrame) -> DataFrame:
    """Hash-partition by stmt_id once; every later step of the graph is keyed by stmt_id
    first (per-sink group, edge merge, vertex window, id maps, JSON) and reuses it."""
    return df.repartition("stmt_id")


def result_schema(result_fields: DataFrame) -> DataFrame:
    """Rows (stmt_id, pos, name) of the statements' result schemas -> (stmt_id, names in order)."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "name")))
    return result_fields.groupBy("stmt_id").agg(F.transform(ordered, lambda x: x["name"]).alias("result_names"))


def sinks(deps: DataFrame, entities: DataFrame, schemas: DataFrame, result_fields: DataFrame | None = None) -> DataFrame:
    """L27-L30 per sink: dest (L27), fields with dynamic-partition keys appended (L28),
    ok = field count check (L29), targets = target labels (L30), plus the sorted
    projection and predicate dependencies. ``deps`` should come through ``by_statement``.

    ``result_fields`` (stmt_id, pos, name) is the statements' result schema: the fields of a sink
    that has no table of its own. The number of its dependencies is checked against them, so a
    statement whose plan lost or gained a column gives no edges there (a statement without rows
    has no fields). Without this input the dependencies' own field names stand in and such sinks
    always pass.

    The schema lookup (one row per table) is left to the planner's size-checked broadcast;
    the entity lookup is keyed by stmt_id like everything else."""
    proj = F.col("dep_kind") == "PROJECTION"
    s = deps.groupBy("stmt_id", "sink_pos").agg(
        F.max("dest_table").alias("dest_table"),
        F.count(F.when(proj, 1)).alias("n_deps"),
        F.array_sort(F.collect_list(F.when(proj, F.struct("dep_pos", "target_field", "expr", "sources"))))
        .alias("proj"),
        F.array_sort(F.collect_list(F.when(~proj, F.struct("dep_pos", "expr", "sources")))).alias("preds"))
    ent = (entities.where(F.col("entity_type").isin(*SINK_ENTITY_TYPES))
           .groupBy("stmt_id").agg(F.min_by("name", "pos").alias("ent_table")))
    s = s.join(ent, "stmt_id", "left")
    s = s.withColumn("dest", F.coalesce("dest_table", "ent_table"))
    s = s.join(schemas.withColumnRenamed("table_name", "dest"), "dest", "left")
    t_cols = F.coalesce(F.col("cols"), _empty_s())
    t_keys = F.coalesce(F.col("partition_keys"), _empty_s())
    if result_fields is None:
        result_names = F.transform("proj", lambda x: x["target_field"])
    else:
        s = s.join(result_schema(result_fields), "stmt_id", "left")
        result_names = F.coalesce(F.col("result_names"), _empty_s())
    from_deps = F.col("dest_table").isNotNull()
    base = F.when(from_deps, t_cols).otherwise(result_names)
    col_names = F.when(~from_deps & F.col("ent_table").isNotNull() & (F.size(t_cols) > 0), t_cols)
    dyn = F.col("n_deps") - F.size(base)
    off = F.size(t_keys) - dyn
    extend = F.col("dest").isNotNull() & (dyn > 0) & (off >= 0)
    added = F.slice(t_keys, F.greatest(off + 1, F.lit(1)), F.greatest(dyn, F.lit(0)))
    s = s.select("*", F.when(extend, F.concat(base, added)).otherwise(base).alias("fields"),
                 F.when(extend & col_names.isNotNull(), F.concat(col_names, added))
                 .otherwise(col_names).alias("col_names"))
    s = s.withColumn("ok", F.col("n_deps") == F.size("fields"))
    s = s.withColumn("targets", target_labels(F.col("fields"), F.col("dest"), F.col("col_names")))
    # A label that cannot be made (column index past the table's column list) throws in the
    # reference's hook, which swallows the error: that statement gets no lineage at all.
    bad_label = F.col("ok") & F.exists("targets", lambda x: x.isNull())
    return s.withColumn("failed", F.max(bad_label).over(Window.partitionBy("stmt_id")))


def count_mismatches(sink_rows: DataFrame) -> DataFrame:
    """L29 log: the sinks that fail the check, (stmt_id, sink_pos, n_deps, n_fields, message)."""
    n_fields = F.size("fields").cast("long")
    return sink_rows.where(~F.col("ok")).select(
        "stmt_id", "sink_pos", "n_deps", n_fields.alias("n_fields"),
        F.concat(F.lit("result schema: "), n_fields.cast("string"), F.lit(" fields, dependencies: "),
                 F.col("n_deps").cast("string")).alias("message"))


def target_labels(fields: Column, dest: Column, col_names: Column) -> Column:
    """Dest.lastpart(field), or dest.col_names[i] when the last part is not among the
    table's columns; without a destination '_uN.name' -> 'name', else the field."""
    def label(f, i):
        parts = F.split(f, "\\.")
        last = F.element_at(parts, -1)
        col = F.when(col_names.isNotNull() & ~F.array_contains(col_names, last),
                     F.try_element_at(col_names, i + 1)).otherwise(last)
        no_dest = F.when((F.size(parts) == 2) & parts[0].startswith("_u"), parts[1]).otherwise(f)
        return F.when(dest.isNotNull(), F.concat(dest, F.lit("."), col)).otherwise(no_dest)
    return F.transform(fields, label)


def raw_edges(sink_rows: DataFrame) -> DataFrame:
    """L34+L35: one projection edge per target column, one predicate edge per condition
    pointing at all target columns of its sink; sinks that fail the count check give none.
    ``ord`` = (sink_pos, index) is the order in which the reference creates the edges."""
    proj = F.transform("proj", lambda x, i: F.struct(
        F.struct(F.col("sink_pos").alias("sink"), i.alias("i")).alias("ord"),
        source_vertices(x["sources"]).alias("sources"),
        F.array(F.element_at("targets", i + 1)).alias("targets"),
        x["expr"].alias("expr"), F.lit("PROJECTION").alias("edge_type")))
    pred = F.transform("preds", lambda x, j: F.struct(
        F.struct(F.col("sink_pos").alias("sink"), (F.size("fields") + j).alias("i")).alias("ord"),
        source_vertices(x["sources"]).alias("sources"),
        F.array_distinct("targets").alias("targets"),
        x["expr"].alias("expr"), F.lit("PREDICATE").alias("edge_type")))
    e = sink_rows.where(F.col("ok") & ~F.col("failed")).select("stmt_id", F.explode(F.concat(proj, pred)).alias("e"))
    return e.select("stmt_id", "e.*")


def merge_edges(edges: DataFrame) -> DataFrame:
    """Edges of one statement with the same type, the same expression (null = null)
    and the same *set* of sources become one edge with the union of the targets, in
    first-seen order, at the place of the first edge. edge_pos is 0-based. ``ord`` is the first
    edge's; ``made`` holds each target of each merged edge with that edge's ``ord`` (L33)."""
    key = F.array_sort(F.transform("sources", lambda s: s["label"]))
    m = edges.groupBy("stmt_id", "edge_type", "expr", key.alias("_key")).agg(
        F.min("ord").alias("ord"),
        F.min_by("sources", "ord").alias("sources"),
        F.array_sort(F.collect_list(F.struct("ord", "targets"))).alias("_t"))
    m = m.withColumn("targets", F.array_distinct(F.flatten(F.transform("_t", lambda x: x["targets"]))))
    m = m.withColumn("made", F.flatten(F.transform("_t", lambda x: F.transform(
        x["targets"], lambda t: F.struct(t.alias("label"), x["ord"].alias("ord"))))))
    w = Window.partitionBy("stmt_id").orderBy("ord")
    return m.select("stmt_id", (F.row_number().over(w) - 1).alias("edge_pos"), "edge_type", "expr",
                    "sources", "targets", "ord", "made")


def vertices(merged: DataFrame) -> DataFrame:
    """L33+L38: one vertex per label; ids 0-based, targets of all edges first (edge order),
    then sources. The type is that of the vertex's creation: edges in the order before the
    merge, target before sources."""
    t = merged.select("stmt_id", "edge_pos", F.posexplode("made").alias("p", "v")).select(
        "stmt_id", F.col("v.label").alias("label"), F.lit("COLUMN").alias("vertex_type"),
        F.struct(F.lit(0).alias("phase"), "edge_pos", "p").alias("seen"),
        F.struct(F.col("v.ord").alias("ord"), F.lit(0).alias("phase"), "p").alias("created"))
    s = merged.select("stmt_id", "edge_pos", "ord", F.posexplode("sources").alias("p", "v")).select(
        "stmt_id", F.col("v.label").alias("label"), F.col("v.type").alias("vertex_type"),
        F.struct(F.lit(1).alias("phase"), "edge_pos", "p").alias("seen"),
        F.struct("ord", F.lit(1).alias("phase"), "p").alias("created"))
    v = t.unionByName(s).groupBy("stmt_id", "label").agg(
        F.min("seen").alias("seen"), F.min_by("vertex_type", "created").alias("vertex_type"))
    w = Window.partitionBy("stmt_id").orderBy("seen")
    return v.select("stmt_id", (F.row_number().over(w) - 1).alias("id"), "vertex_type",
                    F.col("label").alias("vertex_id"))


def column_graph(deps: DataFrame, entities: DataFrame, schemas: DataFrame,
                 result_fields: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(merged edges, vertices) of every statement over all its sinks. ``deps`` should
    come through ``by_statement`` (pass the same frame to ``export.lineage_json``)."""
    merged = merge_edges(raw_edges(sinks(deps, entities, schemas, result_fields)))
    return merged, vertices(merged)


def job_ids(task_log: DataFrame) -> DataFrame:
    """Job ids of a statement's tasks in task order, nulls skipped."""
    ordered = F.array_sort(F.collect_list(F.when(F.col("job_id").isNotNull(), F.struct("task_pos", "job_id"))))
    return task_log.groupBy("stmt_id").agg(F.transform(ordered, lambda x: x["job_id"]).alias("job_ids"))
