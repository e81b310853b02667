"""Registered column-lineage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sqlweave.operators import columns as G
from sqlweave.operators import export as X
from sqlweave.operators.lineage import lineage
from sqlweave.session import scratch_path
from sqlweave.sources import column_fixture as CF
from sqlweave.sources.corpus import sample_statements


def _inputs(spark, sf):
    deps = G.by_statement(CF.column_deps(spark, sf))
    return deps, CF.write_entities(spark, sf), CF.table_schemas(spark, sf), CF.result_fields(spark, sf)


def _sinks(spark, sf):
    return G.sinks(*_inputs(spark, sf))


def _graph(spark, sf):
    deps, *others = _inputs(spark, sf)
    merged, verts = G.column_graph(deps, *others)
    return deps, merged, verts


def _csv(c):
    return F.array_join(c, ",")


def _vlabels(c):
    return _csv(F.transform(c, lambda v: F.concat(v["label"], F.lit(":"), v["type"])))


def op_filter(spark, sf):
    return G.eligible(lineage(sample_statements(spark, sf))).select("stmt_id", "kind")


def dest_resolve(spark, sf):
    return _sinks(spark, sf).select("stmt_id", "sink_pos", "dest")


def dynamic_partition_fields(spark, sf):
    return _sinks(spark, sf).select("stmt_id", "sink_pos", _csv("fields").alias("fields"))


def field_count_check(spark, sf):
    return _sinks(spark, sf).select("stmt_id", "sink_pos", "n_deps",
                                    F.size("fields").cast("long").alias("n_fields"), "ok")


def field_count_mismatches(spark, sf):
    return G.count_mismatches(_sinks(spark, sf))


def target_labels(spark, sf):
    return _sinks(spark, sf).where("ok").select("stmt_id", "sink_pos", _csv("targets").alias("targets"))


def source_vertices(spark, sf):
    deps = CF.column_deps(spark, sf)
    return deps.select("stmt_id", "sink_pos", "dep_pos", "dep_kind",
                       _vlabels(G.source_vertices(F.col("sources"))).alias("sources"))


def predicate_edges(spark, sf):
    e = G.raw_edges(_sinks(spark, sf)).where(F.col("edge_type") == "PREDICATE")
    return e.select("stmt_id", F.col("ord.sink").alias("sink_pos"), "expr",
                    _vlabels(F.col("sources")).alias("sources"), _csv("targets").alias("targets"))


def projection_edges(spark, sf):
    e = G.raw_edges(_sinks(spark, sf)).where(F.col("edge_type") == "PROJECTION")
    return e.select("stmt_id", F.col("ord.sink").alias("sink_pos"), F.col("ord.i").cast("long").alias("idx"),
                    "expr", _vlabels(F.col("sources")).alias("sources"), _csv("targets").alias("targets"))


def edge_merge(spark, sf):
    _, merged, _ = _graph(spark, sf)
    return merged.select("stmt_id", F.col("edge_pos").cast("long").alias("edge_pos"), "edge_type", "expr",
                         _vlabels(F.col("sources")).alias("sources"), _csv("targets").alias("targets"))


def vertex_ids(spark, sf):
    _, merged, _ = _graph(spark, sf)
    v = X.occurrences(merged).where(F.col("seen") == F.col("first_seen"))
    return v.select("stmt_id", F.col("id").cast("long").alias("id"), F.col("vtype").alias("vertex_type"),
                    F.col("label").alias("vertex_id"))


def edges_json(spark, sf):
    _, merged, _ = _graph(spark, sf)
    return X.edges_json(merged).withColumn("edge_pos", F.col("edge_pos").cast("long"))


def vertices_json(spark, sf):
    _, merged, _ = _graph(spark, sf)
    return X.vertices_json(merged)


def lineage_json(spark, sf):
    _, merged, _ = _graph(spark, sf)
    return X.lineage_json(CF.fixture_statements(spark, sf), merged)


def document_sink(spark, sf):
    """L41 sink: the documents written as JSON Lines and read back."""
    path = X.write_documents(lineage_json(spark, sf), scratch_path(spark, "documents"))
    return spark.read.text(path).select(F.col("value").alias("json"))


def job_ids(spark, sf):
    return G.job_ids(CF.task_log(spark, sf)).select("stmt_id", _csv("job_ids").alias("job_ids"))


QUERIES = {f.__name__: f for f in (
    op_filter, dest_resolve, dynamic_partition_fields, field_count_check, field_count_mismatches, target_labels,
    source_vertices, projection_edges, predicate_edges, edge_merge, vertex_ids, edges_json, vertices_json,
    lineage_json, document_sink, job_ids)}
