"""Source divergence audit: how far the word use of each source of a language is from the other sources, and which words make it so.

Terms are runs of letters and of code points from U+0080, A-Z lower-cased. A language keeps the V terms that at least ``min_docs`` of its documents hold. Each group
(lang, source), and each language, gives a kept term with count occurrences, N over all kept terms, the share p = 1 + floor(10^9 (count + 5) / (N + 5 V)); f = abs(p - q).

Terms of a group are ranked by count cells: terms with the same (count in the group, count in the language) have the same f, so f is evaluated once a cell; cells of equal
values are merged; the values are ranked by the cumulative number of their terms; only values that begin within the wanted ranks are expanded to terms, in UTF-8 order.

Pairs of sources: a term is one row with the shares of the sources that hold it; all others have the share of count 0, which comes once a task as a header row. A task adds up,
for all pairs of a tile of ``TILE`` sources by ``TILE`` sources, by how much f is off that of a term that neither has; V times the latter is added at the end. No row is made for
a pair and a term. Tasks are dealt by hash of the term, so neither a hot
source nor a hot language meets in one. The sums of tasks are added afterwards.

All arithmetic is on whole numbers (decimals of 38 digits where a product may pass a long). Counts are partially aggregated before each shuffle.
The kept terms are sent to all tasks only if they are at most ``BROADCAST_BYTES``; beyond that, all terms are counted before they meet the kept ones in a join.

Defined results: null text, lang and source are ''; a group without terms has count 0 for each; a language with V = 0 has pair values 0 and no terms; repeated rows (equal
ids too) are documents of their own; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: fixed by the query's contract: what stands between terms
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 30
TOP_TERMS = 50
PRIOR = 5
SCALE = 1_000_000_000
#: of the kept terms' bytes, with their languages
BROADCAST_BYTES = 32 << 20
#: sources a side of the matrix of one task's sums
TILE = 256
#: numbers of one matrix of shares
BLOCK = 1 << 19


def terms_of(text: Column) -> Column:
    """All terms of a text, in order, and empty strings at its ends."""
    # lower() is the quicker one, but it changes more than A-Z where a text isn't plain ASCII
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.split(low, BETWEEN)  # about six times as quick as the extraction of all matches


def share(count: Column, total: Column, n_terms: Column) -> Column:
    """1 + floor(SCALE (count + PRIOR) / (total + PRIOR n_terms)), exact; null without terms."""
    whole = lambda c: c.cast("decimal(20,0)")
    of = F.nullif(whole(total) + whole(n_terms) * F.lit(PRIOR).cast("decimal(1,0)"), F.lit(0).cast("decimal(1,0)"))
    scaled = (whole(count) + F.lit(PRIOR).cast("decimal(1,0)")) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", scaled, of) + 1


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                min_docs: int = MIN_DOCS, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups: lang, source; kept: lang, term; counts: lang, source, term, n > 0 of kept terms)."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    given = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), terms_of(empty(text_col)).alias("terms"))
    groups = C.saved(given.select("lang", "source").distinct(), "groups")
    held = given.select("lang", F.explode(F.array_distinct("terms")).alias("term")).where("term != ''")
    kept = C.saved(held.groupBy("lang", "term").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term"), "kept-terms")
    size = kept.agg(F.sum(F.octet_length("lang") + F.octet_length("term") + 32)).first()[0] or 0
    seed = _key_seed(groups)
    of_lang, of_group = _key(seed, "lang").alias("l"), _key(seed, "lang", "source").alias("g")
    each = given.select(of_lang, of_group, F.explode("terms").alias("term")).where("term != ''")
    wanted = kept.select(of_lang, "term")
    if size <= broadcast_bytes:
        counts = each.join(F.broadcast(wanted), ["l", "term"], "left_semi").groupBy("g", "term").agg(F.count("*").alias("n"))
    else:
        counts = each.groupBy("l", "g", "term").agg(F.count("*").alias("n")).join(wanted, ["l", "term"], "left_semi")
    counts = counts.join(groups.withColumn("g", of_group), "g").select("lang", "source", "term", "n")
    return groups, kept, C.saved(counts, "term-counts")


def _key(seed: int, *names: str) -> Column:
    return F.xxhash64(F.lit(seed), *names)


def _key_seed(groups: DataFrame) -> int:
    """The first seed under which no two languages and no two groups share a key: numbers are quicker to count by than strings."""
    for seed in range(1 << 10):
        n = groups.agg(F.count("*"), F.count_distinct(_key(seed, "lang", "source")), F.count_distinct("lang"), F.count_distinct(_key(seed, "lang"))).first()
        if n[0] == n[1] and n[2] == n[3]:
            return seed
    raise ValueError("too many groups for keys of 64 bits")


def with_totals(groups: DataFrame, kept: DataFrame, counts: DataFrame, tile: int = TILE) -> DataFrame:
    """lang, source, total, lang_total, n_terms, idx (place of the source in its language, from 0), tiles."""
    total = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    lang_total = total.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    n_terms = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    w = Window.partitionBy("lang")
    out = groups.join(total, ["lang", "source"], "left").join(lang_total, "lang", "left").join(n_terms, "lang", "left").fillna(0, ["total", "lang_total", "n_terms"])
    out = out.withColumn("idx", F.row_number().over(w.orderBy("source")) - 1)
    return out.withColumn("tiles", F.floor(F.max("idx").over(w) / tile).cast("int") + 1)


def ranked_terms(counts: DataFrame, totals: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, item, value, rank: each group's kept terms with count > 0 and p > q, to rank ``top``."""
    group = ["lang", "source"]
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("l"))
    placed = counts.join(of_lang, ["lang", "term"])
    cells = placed.groupBy(*group, "n", "l").agg(F.count("*").alias("m")).join(totals, group)
    p, q = share(F.col("n"), F.col("total"), F.col("n_terms")), share(F.col("l"), F.col("lang_total"), F.col("n_terms"))
    cells = C.saved(cells.select(*group, "n", "l", "m", (p - q).alias("f")).where("f > 0"), "cells")
    down = Window.partitionBy(*group).orderBy(F.desc("f"))
    values = cells.groupBy(*group, "f").agg(F.sum("m").alias("m"))
    # each value has a term at least: no more than ``top`` values can begin within the ranks
    values = values.withColumn("place", F.row_number().over(down)).where(F.col("place") <= top)
    values = values.withColumn("before", F.coalesce(F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where(F.col("before") < top)
    chosen = cells.join(values.select(*group, "f", "before"), [*group, "f"]).select(*group, "n", "l", "f", "before")
    in_value = Window.partitionBy(*group, "f").orderBy("term")
    found = placed.join(chosen, [*group, "n", "l"]).withColumn("k", F.row_number().over(in_value)).where(F.col("k") <= top)
    rank = (F.col("before") + F.col("k")).cast("int")
    return found.select(*group, F.col("term").alias("item"), F.col("f").alias("value"), rank.alias("rank")).where(F.col("rank") <= top)


class _TileSums:
    """Sums over terms of f less that of a term that no source has, for the pairs of one tile."""

    def __init__(self, key: tuple, idx: np.ndarray, absent: np.ndarray, tile: int):
        order = np.argsort(idx)
        self.key, self.idx, self.absent = key, idx[order], absent[order]
        one_tile = key[1] == key[2]
        self.left = np.arange(len(idx)) if one_tile else np.flatnonzero(self.idx // tile == key[1])
        self.from_right = (lambda a: a + 1) if one_tile else (lambda a: len(self.left))
        self.sums = np.zeros((len(self.left), len(idx)), np.int64)
        self.none = np.abs(self.absent[None, :] - self.absent[self.left][:, None])

    def add(self, sizes: np.ndarray, idx: np.ndarray, p: np.ndarray) -> None:
        at = np.searchsorted(self.idx, idx)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        self.sums -= len(sizes) * self.none
        step = max(1, BLOCK // len(self.idx))
        for lo in range(0, len(sizes), step):
            hi = min(lo + step, len(sizes))
            m = np.tile(self.absent[:, None], hi - lo)
            m[at[begin[lo]:begin[hi]], np.repeat(np.arange(hi - lo), sizes[lo:hi])] = p[begin[lo]:begin[hi]]
            for a in self.left:
                b = self.from_right(a)
                self.sums[a, b:] += np.abs(m[b:] - m[a]).sum(axis=1)

    def batch(self) -> pa.RecordBatch:
        a = [np.full(len(self.idx) - self.from_right(i), i) for i in self.left]
        b = [np.arange(self.from_right(i), len(self.idx)) for i in self.left]
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        return pa.RecordBatch.from_arrays([pa.array([self.key[0]] * len(a), pa.string()), pa.array(self.idx[a], pa.int32()), pa.array(self.idx[b], pa.int32()),
                                           pa.array(self.sums[a, b], pa.int64())], names=["lang", "a", "b", "value"])


def _pair_sums(batches, tile: int):
    """Rows in the order of (lang, t1, t2, bucket, header first) to sums of each (lang, t1, t2)."""
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "t1", "t2"))))
        header = batch.column("header").to_numpy(zero_copy_only=False)
        lists = batch.column("entries")
        off = lists.offsets.to_numpy()
        flat = lists.flatten()
        idx, p = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64), flat.field(1).to_numpy(zero_copy_only=False).astype(np.int64)
        off = off - off[0]
        cuts = [0, *(i for i in range(1, len(keys)) if header[i] or header[i - 1]), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            part = slice(off[lo], off[hi])
            if not header[lo]:
                now.add(np.diff(off[lo:hi + 1]), idx[part], p[part])
            elif now is None or now.key != keys[lo]:
                if now is not None:
                    yield now.batch()
                now = _TileSums(keys[lo], idx[part], p[part], tile)
    if now is not None:
        yield now.batch()


def source_pairs(counts: DataFrame, totals: DataFrame, tile: int = TILE) -> DataFrame:
    """lang, source, item, value, rank: each other source of the language, f summed over all its kept terms."""
    spark = counts.sparkSession
    buckets = C.shuffle_partitions(spark)
    own_tile = F.floor(F.col("idx") / tile).cast("int")
    tiles = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: F.struct(F.least(own_tile, j).alias("t1"), F.greatest(own_tile, j).alias("t2"))))
    key = ["lang", "t1", "t2"]

    def entries(rows: DataFrame, p: Column, *more: str) -> DataFrame:
        dealt = rows.select("lang", "idx", p.alias("p"), tiles.alias("t"), *more).select("lang", "t.*", "idx", "p", *more)
        return dealt.groupBy(*key, *more).agg(F.collect_list(F.struct("idx", "p")).alias("entries"))  # at most two tiles

    absent = F.coalesce(share(F.lit(0), F.col("total"), F.col("n_terms")), F.lit(0))
    headers = entries(totals, absent).select(*key, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), F.lit(True).alias("header"), "entries")
    present = share(F.col("n"), F.col("total"), F.col("n_terms"))
    terms = entries(counts.join(totals, ["lang", "source"]), present, "term").select(
        *key, F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket"), F.lit(False).alias("header"), "entries")
    rows = headers.unionByName(terms).repartition(*key, "bucket").sortWithinPartitions(*key, "bucket", F.desc("header"))
    sums = (rows.select(*key, "header", "entries").mapInArrow(lambda b: _pair_sums(b, tile), "lang string, a int, b int, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = sums.select("lang", "value", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("lang", "value", "x.*")
    side = lambda at, name: totals.select("lang", F.col("idx").alias(at), F.col("source").alias(name), absent.alias(at + "0"),
                                          F.col("n_terms").alias(at + "_terms"))
    named = both.join(side("a", "source"), ["lang", "a"]).join(side("b", "item"), ["lang", "b"])
    named = named.withColumn("value", F.col("value") + F.col("a_terms") * F.abs(F.col("a0") - F.col("b0")))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.select("lang", "source", "item", "value", F.row_number().over(w).alias("rank"))


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
               tile: int = TILE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    groups, kept, counts = term_counts(docs, text_col, lang_col, source_col, min_docs, broadcast_bytes)
    totals = C.saved(with_totals(groups, kept, counts, tile), "group-totals")
    part = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(source_pairs(counts, totals, tile), "pair").unionByName(part(ranked_terms(counts, totals, top), "term"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all of documents."""
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op13_source_audit": op13_source_audit}
ORACLE_SQL = {"op13_source_audit": r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY lang, source, term),
c AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS c FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
p AS (SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang, source) + 5 * v) AS p,
  1 + (1000000000::HUGEINT * (sum(c) OVER (PARTITION BY lang, term) + 5)) // (sum(c) OVER (PARTITION BY lang) + 5 * v) AS q FROM c JOIN v USING (lang)),
pair AS (SELECT x.lang, x.source, y.source AS item, coalesce(sum(abs(a.p - b.p)), 0)::BIGINT AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN p a ON a.lang = x.lang AND a.source = x.source
  LEFT JOIN p b ON b.lang = y.lang AND b.source = y.source AND b.term = a.term GROUP BY ALL),
term AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM term)
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM pair
UNION ALL SELECT lang, source, 'term', item, value, rank::INTEGER FROM ranked WHERE rank <= 50"""}
