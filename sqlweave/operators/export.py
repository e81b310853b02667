"""JSON export of the column graph (L39-L41): the reference's document shape,
{"edges":[{"sources":[ids],"targets":[ids],"expression":..,"edgeType":..}],
 "vertices":[{"id":..,"vertexType":..,"vertexId":..}]}; a null expression is left out.

Vertex ids are attached to every occurrence of a label by two windows keyed by stmt_id
(first occurrence per label, then a dense rank in first-occurrence order), and the edges are
regrouped from those rows. No map lookup (linear in Spark) and no join on a key other than
stmt_id, so the work per statement stays linear in its edges and the stmt_id partitioning
of the merged edges is reused throughout. The documents (L41) need no row per occurrence: the edges of a statement come
together in its row, and its vertices are numbered by array steps over many statements at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def occurrences(merged: DataFrame) -> DataFrame:
    """One row per (edge, target or source) with the vertex id: targets of all edges first
    (edge order), then sources (L38). A target that edges merged into one share has a row for
    each of them, as the type of a vertex is that of its creation (L33)."""
    occ = F.concat(
        F.transform("made", lambda t, i: F.struct(F.lit(0).alias("phase"), i.alias("p"), t["label"].alias("label"),
                                                  F.lit("COLUMN").alias("vtype"), t["ord"].alias("made_by"))),
        F.transform("sources", lambda s, i: F.struct(F.lit(1).alias("phase"), i.alias("p"), s["label"].alias("label"),
                                                     s["type"].alias("vtype"), F.col("ord").alias("made_by"))))
    o = merged.select("stmt_id", "edge_pos", "edge_type", "expr", F.explode(occ).alias("o")).select(
        "stmt_id", "edge_pos", "edge_type", "expr", "o.*")
    o = o.withColumn("seen", F.struct("phase", "edge_pos", "p"))
    by_label = Window.partitionBy("stmt_id", "label")
    created = F.struct("made_by", "phase", "p", "vtype")
    o = o.withColumns({"first_seen": F.min("seen").over(by_label), "vtype": F.min(created).over(by_label)["vtype"]})
    return o.withColumn("id", F.dense_rank().over(Window.partitionBy("stmt_id").orderBy("first_seen")) - 1)


def _edge_rows(occ: DataFrame) -> DataFrame:
    g = occ.groupBy("stmt_id", "edge_pos", "edge_type", "expr").agg(
        F.array_sort(F.collect_list(F.struct("phase", "p", "id"))).alias("_o"))
    ids = lambda ph: F.array_distinct(F.transform(F.filter("_o", lambda x: x["phase"] == ph), lambda x: x["id"]))
    edge = F.struct(ids(1).alias("sources"), ids(0).alias("targets"),
                    F.col("expr").alias("expression"), F.col("edge_type").alias("edgeType"))
    return g.select("stmt_id", "edge_pos", F.to_json(edge).alias("json"))


def _vertex_rows(occ: DataFrame) -> DataFrame:
    first = occ.where(F.col("seen") == F.col("first_seen"))
    v = F.struct("id", F.col("vtype").alias("vertexType"), F.col("label").alias("vertexId"))
    return first.select("stmt_id", "id", F.to_json(v).alias("json"))


def edges_json(merged: DataFrame) -> DataFrame:
    """(stmt_id, edge_pos, json) per edge."""
    return _edge_rows(occurrences(merged))


def vertices_json(merged: DataFrame) -> DataFrame:
    """(stmt_id, json array of vertices in id order)."""
    v = _vertex_rows(occurrences(merged))
    return v.groupBy("stmt_id").agg(_join_sorted("id").alias("json"))


def _join_sorted(order: str):
    s = F.array_sort(F.collect_list(F.struct(order, "json")))
    return F.concat(F.lit("["), F.array_join(F.transform(s, lambda x: x["json"]), ","), F.lit("]"))


NUMBERED = ("struct<edges:array<struct<sources:array<int>,targets:array<int>>>,"
            "vertices:array<struct<id:int,vertexType:string,vertexId:string>>>")


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def _numbers(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64)


def _numbered(made: pa.Array, sources: pa.Array, ords: pa.Array) -> pa.Array:
    """NUMBERED of statements, from a list of edges each: the made targets (label, ord), the sources (label, type) and the place
    (sink, i) of each edge. The order of ``occurrences``: targets of all edges first, then sources; a vertex has the type of its
    creation."""
    n_edges, made, sources, ords = _lengths(made), made.flatten(), sources.flatten(), ords.flatten()
    n_made, n_src, t, s = _lengths(made), _lengths(sources), made.flatten(), sources.flatten()
    stmt_of = np.repeat(np.arange(len(n_edges)), n_edges)
    edge = np.concatenate([np.repeat(np.arange(len(stmt_of)), k) for k in (n_made, n_src)])
    p = np.arange(len(edge)) - np.concatenate([np.repeat(np.cumsum(k) - k, k) for k in (n_made, n_src)])
    p[len(t):] -= len(t)
    stmt, phase = stmt_of[edge], np.repeat([0, 1], [len(t), len(s)])
    by = [np.concatenate([_numbers(t.field("ord").field(k)), _numbers(ords.field(k))[edge[len(t):]]]) for k in ("sink", "i")]
    label = pa.concat_arrays([t.field("label"), s.field("label")])
    kind = pa.concat_arrays([pa.array(["COLUMN"] * len(t), pa.string()), s.field("type")])
    code = pc.fill_null(label.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    key = stmt * (code.max(initial=0) + 1) + code
    # vertices in the order in which their labels are first seen; a statement's lie one behind the other
    seen = np.lexsort((phase, stmt))
    _, first, vertex = np.unique(key[seen], return_index=True, return_inverse=True)
    by_first = np.argsort(first)
    rank = np.empty(len(first), np.int64)
    rank[by_first] = np.arange(len(first))
    v = np.empty(len(key), np.int64)
    v[seen] = rank[vertex]
    v_row = seen[first[by_first]]
    n_vertices = np.bincount(stmt[v_row], minlength=len(n_edges))
    base = np.cumsum(n_vertices) - n_vertices
    made_at = np.lexsort((p, phase, by[1], by[0], v))
    v_kind = made_at[np.searchsorted(v[made_at], np.arange(len(v_row)))]
    ids = pa.array(v - base[stmt], pa.int32())
    edges = pa.StructArray.from_arrays([_lists(ids.slice(len(t)), n_src), _lists(ids.slice(0, len(t)), n_made)], ["sources", "targets"])
    vertices = pa.StructArray.from_arrays([pa.array(np.arange(len(v_row)) - base[stmt[v_row]], pa.int32()), kind.take(pa.array(v_kind)),
                                           label.take(pa.array(v_row))], ["id", "vertexType", "vertexId"])
    return pa.StructArray.from_arrays([_lists(edges, n_edges), _lists(vertices, n_vertices)], ["edges", "vertices"])


def lineage_json(statements: DataFrame, merged: DataFrame) -> DataFrame:
    """One document per statement of ``statements`` (those without edges get empty
    arrays). One linear pipeline: the edges of a statement are grouped once, with the partitioning they have, and
    its vertices are numbered within its row."""
    per_stmt = (merged.where((F.size("made") > 0) | (F.size("sources") > 0)).groupBy("stmt_id")
                .agg(F.array_sort(F.collect_list(F.struct("edge_pos", "edge_type", "expr", "ord", "made", "sources"))).alias("e")))
    per_stmt = per_stmt.select("stmt_id", "e", F.arrow_udf(_numbered, NUMBERED)("e.made", "e.sources", "e.ord").alias("n"))
    edges = F.transform("e", lambda x, i: F.struct(
        F.array_distinct(F.get("n.edges", i)["sources"]).alias("sources"), F.array_distinct(F.get("n.edges", i)["targets"]).alias("targets"),
        x["expr"].alias("expression"), x["edge_type"].alias("edgeType")))
    per_stmt = per_stmt.select("stmt_id", F.to_json(edges).alias("edges"), F.to_json("n.vertices").alias("vertices"))
    d = statements.select("stmt_id").join(per_stmt, "stmt_id", "left")
    doc = F.concat(F.lit('{"edges":'), F.coalesce("edges", F.lit("[]")),
                   F.lit(',"vertices":'), F.coalesce("vertices", F.lit("[]")), F.lit("}"))
    return d.select("stmt_id", doc.alias("json"))


def write_documents(docs: DataFrame, path: str) -> str:
    """L41 sink: one JSON document per line (JSON Lines), written by the executors."""
    docs.select("json").write.mode("overwrite").text(path)
    return path
