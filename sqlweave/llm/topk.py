"""Exact top-k by inner product: columnar branch and bound.

Vectors lie in blocks, dimension by dimension (a row per dimension, a column per vector), dimensions of the largest total mass first. For a query, scores are
added up ``step`` dimensions at a time; what the rest can add at most is the product of the rest's norms (Cauchy and Schwarz), so a vector whose sum plus
that bound is below the query's k-th best score so far leaves, and the survivors are compacted. The k-th best starts from the vectors of largest norm
and is raised after each block of dimensions, by the whole scores of the vectors that lead by then.

Queries are dealt in groups to blocks of candidates by a join on the block numbers, each task works on one group of queries and one of candidates and
returns k rows a query; a second step merges these. Components are whole numbers, so sums in double are exact as long as the product of two norms is below
2^52. Other pairs are scored in extended precision with an error bound, and those that may be among the k best exactly, in Python's whole numbers.

Defined results: vectors null, or with a null or non-finite component, take no part; missing dimensions are 0; equal scores go to the smaller id; fewer candidates than
k are all returned; rows that share an id are candidates each, but none for a query of that id; a null id takes no part; scores are ranked as whole numbers of any
size, and one that a long can't hold is returned as null; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

QUERY_GROUP = 2048
CANDIDATE_GROUP = 8192
STEP = 16
#: two vectors of smaller norms have a product that doubles hold exactly
NARROW = 2.0 ** 26


def _columns(vectors: list) -> np.ndarray:
    """Matrix with a row per dimension and a column per vector, padded with 0."""
    dims = max((len(v) for v in vectors), default=0)
    out = np.zeros((dims, len(vectors)), vectors[0].dtype if vectors else float)
    for k, v in enumerate(vectors):
        out[:len(v), k] = v
    return out


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id."""
    if len(score) > 4 * k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        few = np.flatnonzero(score >= edge)
        return few[np.lexsort((ids[few], -score[few]))[:k]]
    return np.lexsort((ids, -score))[:k]


def _kth(scores: np.ndarray, k: int) -> float:
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf


def branch_and_bound(query_ids, queries, ids, vectors, k: int, step: int = STEP):
    """For each query (a column of ``queries``) its k best of ``vectors``: (query place, vector place, score). Norms are below NARROW."""
    dims = max(queries.shape[0], vectors.shape[0])
    queries = np.pad(queries, ((0, dims - queries.shape[0]), (0, 0)))
    vectors = np.pad(vectors, ((0, dims - vectors.shape[0]), (0, 0)))
    order = np.argsort(-(vectors ** 2).sum(axis=1), kind="stable")
    queries, vectors = queries[order], vectors[order]
    cuts = list(range(0, dims, step)) + [dims]
    rest_v = [np.sqrt((vectors[c:] ** 2).sum(axis=0)) for c in cuts]
    rest_q = [np.sqrt((queries[c:] ** 2).sum(axis=0)) for c in cuts]
    by_norm = np.argsort(-rest_v[0], kind="stable")[:max(4 * k, 64)]
    seed = queries.T @ vectors[:, by_norm]
    # the first block of dimensions for all queries at once
    part = queries[:cuts[1]].T @ vectors[:cuts[1]] if dims else np.zeros((queries.shape[1], vectors.shape[1]))
    out = []
    for q in range(queries.shape[1]):
        least = _kth(seed[q][ids[by_norm] != query_ids[q]], k)
        alive = np.flatnonzero(ids != query_ids[q])
        score = part[q][alive]
        for b in range(1, len(cuts)):
            if b > 1:
                score = score + queries[cuts[b - 1]:cuts[b], q] @ vectors[cuts[b - 1]:cuts[b], alive]
            if b + 1 < len(cuts) and len(alive) > 4 * k:
                lead = alive[np.argpartition(score, len(score) - 2 * k)[len(score) - 2 * k:]]
                least = max(least, _kth(queries[:, q] @ vectors[:, lead], k))
                on = score + rest_q[b][q] * rest_v[b][alive] * (1 + 1e-12) >= least
                alive, score = alive[on], score[on]
        out += [(q, int(alive[i]), int(score[i])) for i in _best(score, ids[alive], k)]
    return out


def _exact_score(q: list[int], v: np.ndarray) -> int:
    return sum(a * int(b) for a, b in zip(q, v))


def wide_search(query_ids, queries, ids, vectors, k: int):
    """As ``branch_and_bound``, for components of any size, in extended precision."""
    dims = max(queries.shape[0], vectors.shape[0])
    queries = np.pad(queries, ((0, dims - queries.shape[0]), (0, 0)))
    vectors = np.pad(vectors, ((0, dims - vectors.shape[0]), (0, 0)))
    slack = 4 * (dims + 2) * np.finfo(np.longdouble).eps
    out = []
    for q in range(queries.shape[1]):
        alive = np.flatnonzero(ids != query_ids[q])
        with np.errstate(over="ignore", invalid="ignore"):
            terms = vectors[:, alive] * queries[:, q][:, None]
            score, error = terms.sum(axis=0), np.abs(terms).sum(axis=0) * slack
            least = _kth(np.nan_to_num(score - error, nan=-np.inf, posinf=np.inf, neginf=-np.inf), k)
            alive = alive[~(score + error < least)]
        whole, scores = [int(x) for x in queries[:, q]], {}
        for place in alive.tolist():  # equal vectors have one score
            v = vectors[:, place]
            name = v.tobytes()
            if name not in scores:
                scores[name] = _exact_score(whole, v)
            out.append((q, place, scores[name]))
    return out


def k_best(query_ids, queries: list, ids, vectors, k: int, scale: int):
    """(query place, vector place, score) of the k best of each query, for rows of components as they were given."""
    sides = []
    for rows in (queries, vectors):
        with np.errstate(over="ignore"):
            whole = [np.floor(r * scale) for r in rows]
            norm = np.array([np.sqrt((r ** 2).sum()) for r in whole])
        sides.append((np.flatnonzero(norm < NARROW), np.flatnonzero(~(norm < NARROW)), whole, rows))
    (q_narrow, q_wide, q_whole, q_raw), (v_narrow, v_wide, v_whole, v_raw) = sides

    def matrix(rows, places):
        return _columns([rows[i] for i in places])

    def large(whole, raw, places):  # beyond doubles, the product is taken in extended precision
        rows = [np.where(np.isfinite(whole[i]), whole[i], 0).astype(np.longdouble) for i in places]
        for r, i in zip(rows, places):
            over = ~np.isfinite(whole[i])
            r[over] = np.floor(raw[i][over].astype(np.longdouble) * scale)
        return _columns(rows)

    found = [(q_narrow[a], v_narrow[b], s) for a, b, s in branch_and_bound(
        query_ids[q_narrow], matrix(q_whole, q_narrow), ids[v_narrow], matrix(v_whole, v_narrow), k)]
    every = np.arange(len(v_whole))
    for qs, vs in ((q_narrow, v_wide), (q_wide, every)):
        if len(qs) and len(vs):
            found += [(qs[a], vs[b], s) for a, b, s in wide_search(query_ids[qs], large(q_whole, q_raw, qs), ids[vs], large(v_whole, v_raw, vs), k)]
    if not len(v_wide) and not len(q_wide):
        return found
    found.sort(key=lambda f: (f[0], -f[2], ids[f[1]]))
    first = {}
    return [f for n, f in enumerate(found) if n - first.setdefault(f[0], n) < k]


def _beyond(score: int) -> tuple[int, str | None]:
    """Whether a score is above (1) or below (-1) the long numbers, and a string that sorts like such scores."""
    if -(1 << 63) <= score < 1 << 63:
        return 0, None
    digits = str(abs(score))
    named = f"{len(digits):05d}{digits}"
    return (1, named) if score > 0 else (-1, named.translate(str.maketrans("0123456789", "9876543210")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products of floor(scale * component) of each query row with every other row."""
    spark = vectors.sparkSession
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = (vectors.withColumn("_q", F.coalesce(is_query, F.lit(False)))
             .select(F.col(id_col).cast("long").alias("vec_id"), F.col("_q").alias("q"), F.col(vector_col).cast("array<double>").alias("e"))
             .where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & finite)
             .select("vec_id", "q", "e"))
    whole = C.saved(whole, "vectors")
    n, n_q = whole.agg(F.count("*"), F.count_if("q")).first()
    if not n_q:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    groups, q_groups = -(-n // CANDIDATE_GROUP), -(-n_q // QUERY_GROUP)
    cell = F.xxhash64("vec_id", "e")
    candidates = whole.select(F.lit(False).alias("q"), "vec_id", "e", F.pmod(cell, F.lit(groups)).alias("g"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_groups - 1).cast("long"))).alias("h"))
    queries = whole.where("q").select(F.lit(True).alias("q"), "vec_id", "e", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"), F.pmod(cell, F.lit(q_groups)).alias("h"))

    def search(t: pa.Table) -> pa.Table:
        q = t["q"].to_numpy()
        ids = t["vec_id"].to_numpy()
        rows = t["e"].combine_chunks()
        off, flat = rows.offsets.to_numpy(), rows.values.to_numpy()
        vectors = [flat[off[i]:off[i + 1]] for i in range(len(rows))]
        own, others = np.flatnonzero(q), np.flatnonzero(~q)
        found = k_best(ids[own], [vectors[i] for i in own], ids[others], [vectors[i] for i in others], k, scale)
        beyond = [_beyond(s) for _, _, s in found]
        return pa.table({"query_id": pa.array([int(ids[own[a]]) for a, _, _ in found], pa.int64()),
                         "vec_id": pa.array([int(ids[others[b]]) for _, b, _ in found], pa.int64()),
                         "score": pa.array([None if far else s for (_, _, s), (far, _) in zip(found, beyond)], pa.int64()),
                         "beyond": pa.array([far for far, _ in beyond], pa.int32()), "named": pa.array([name for _, name in beyond], pa.string())})

    best = candidates.unionByName(queries).groupBy("g", "h").applyInArrow(search, "query_id long, vec_id long, score long, beyond int, named string")
    by = Window.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("named"), F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: every row of embeddings whose id is divisible by 20 against all others."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, 20, 64)


QUERIES = {"op7_exact_topk": op7_exact_topk}
ORACLE_SQL = {"op7_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                  CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
     r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""}
