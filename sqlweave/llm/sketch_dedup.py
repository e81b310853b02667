"""Near-duplicate documents by SetSketch registers.

A document's set of word shingles gets 640 registers: each register holds how small the least of the
set's exponential variables is, on a scale of powers of 1.02, cut off at 0 and 65,535. Registers of unions are maxima,
and two sets agree in a register with about the probability of their Jaccard similarity. Runs of eight registers are the bands:
documents that agree in one of 80 bands are candidates (a pair at 0.8 agrees in none with probability
4e-7, one at 0.4 in any with 0.05). Candidates whose similarity, by the likelihood of how many registers
are equal, larger and smaller, is at least threshold - 0.1 (six standard deviations below it) are verified on their full sets.

No pairs within groups: documents with equal sets are one representative; each bucket links its members to its smallest, and only
members of buckets that still hold several components are compared further:

1. each representative with the smallest of all its buckets' smallest members,
2. then with the smallest member of each bucket, where components still differ,
3. last, in buckets that still hold several components, members of different components are compared in blocks of 2,048 by
   2,048, inside tasks: by registers first, then those with a likely partner on their full sets (counts of shared members by a
   product of 0/1 matrices); only links that connect two components come out, fewer than a block has members.

So every candidate pair is verified, unlikely or already connected, and no step makes a row for each pair.

Defined results: a null, empty or blank text has an empty set and is linked with nothing; fewer words
than a shingle are one shingle; a null id is linked with nothing; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .components import components

REGISTERS, PER_BAND, BASE, RATE = 640, 8, 1.02, 20.0
BLOCK = 2048  # members of a bucket compared at once in step 3
_BATCH = 1 << 20
_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_hi", pa.int64()), ("set_lo", pa.int64()),
                     ("bands", pa.list_(pa.int64())), ("judged", pa.binary())])
_SKETCH_SQL = "doc_id long, n_shingles long, set_hi long, set_lo long, bands array<long>, judged binary"


def registers(doc: np.ndarray, h: np.ndarray, n_docs: int) -> np.ndarray:
    """uint16 registers (n_docs, 128) of sets given as (text number, hash) pairs.

    Each element is a Poisson process of rate RATE in every register, drawn point by point in order
    of size; an element is done once its next point exceeds the largest minimum of its document."""
    least = np.full((n_docs, REGISTERS), np.inf)
    flat = least.ravel()
    t = np.zeros(len(h))
    k = 0
    while len(h):
        ahead = np.arange(k + 1, k + 1 + max(1, min(64, (1 << 16) // len(h))))  # few elements left: some points at once
        k = int(ahead[-1])
        x = C.mix((h[:, None] + (ahead.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))[None, :]))
        step = -np.log(((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52) / (RATE * REGISTERS)
        step[:, 0] += t
        at = np.cumsum(step, axis=1)
        place = ((x & np.uint64(0xFFFFFFF)) * np.uint64(REGISTERS) >> np.uint64(28)).astype(np.int64)
        np.minimum.at(flat, (doc[:, None] * REGISTERS + place).ravel(), at.ravel())
        t = at[:, -1]
        on = t < least.max(axis=1)[doc]
        if not on.all():
            doc, h, t = doc[on], h[on], t[on]
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, 65535).astype(np.uint16)


def _sketches(size: int):
    def rows(batches):
        held, n_held = [], 0

        def flush():
            ids = np.concatenate([p[0] for p in held])
            base = np.cumsum([0] + [len(p[0]) for p in held])
            doc = np.concatenate([p[1] + b for p, b in zip(held, base)])
            h = np.concatenate([p[2] for p in held])
            n = np.bincount(doc, minlength=len(ids))
            reg = registers(doc, h, len(ids))
            words = reg.view(np.uint64).reshape(len(ids), -1, PER_BAND // 4)
            bands = words[:, :, 0]
            for i in range(1, PER_BAND // 4):
                bands = C.mix_pair(bands, words[:, :, i])
            bands = np.ascontiguousarray(bands).view(np.int64)
            judged = reg
            # names of whole sets: sums of scrambled members, which don't depend on their order
            sums = []
            for seed in (3, 5):
                x = np.concatenate([[np.uint64(0)], np.cumsum(C.mix_pair(h, h, seed), dtype=np.uint64)])
                at = np.concatenate([[0], np.cumsum(n)])
                sums.append((x[at[1:]] - x[at[:-1]]).view(np.int64))
            null = ids == np.iinfo(np.int64).max
            return pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64(), mask=null), pa.array(n.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]),
                pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * bands.shape[1], pa.int32()), pa.array(bands.ravel())),
                pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer((np.arange(len(ids) + 1) * 2 * REGISTERS).astype(np.int32).tobytes()),
                                                              pa.py_buffer(judged.tobytes())])],
                schema=_SKETCH)

        for ids, buf, off in C.text_pieces(batches):
            w, doc, _, _ = C.words(buf, off)
            h, doc, _ = C.shingles(w, doc, len(ids), size)
            doc, h = C.distinct_in(doc, h)
            held.append((ids, doc, h))
            n_held += len(h) + REGISTERS * len(ids)
            if n_held >= _BATCH:
                yield flush()
                held, n_held = [], 0
        if held:
            yield flush()
    return rows


def _judged(col: pa.Array) -> np.ndarray:
    return C.binary_arrays(col)[0].view(np.uint16).reshape(-1, REGISTERS)


def likely_similarity(ka: np.ndarray, kb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity (in steps of 0.01) given both register rows and both set sizes."""
    more, less = (ka > kb).sum(1)[:, None], (ka < kb).sum(1)[:, None]
    same = ka.shape[1] - more - less
    u = (na / (na + nb))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)

    def level(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = level(u - v * j), level(v - u * j)
    tiny = 1e-300
    like = more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.clip(1 - up - down, 0, 1) + tiny)
    return np.take_along_axis(j, like.argmax(axis=1)[:, None], 1)[:, 0]


def _likely(least: float):
    def keep(batches):
        for b in batches:
            if b.num_rows:
                j = likely_similarity(_judged(b.column("ka")), _judged(b.column("kb")),
                                      b.column("na").to_numpy().astype(float), b.column("nb").to_numpy().astype(float))
                yield b.select(["a", "b"]).filter(pa.array(j >= least))
    return keep


def _comparable(x, n, comp, k, right, percent):
    """Members of ``right`` that member k may be linked with: another component, and sizes that allow it."""
    return right[(x[right] != x[k]) & (comp[right] != comp[k])
                 & (100 * np.minimum(n[right], n[k]) >= percent * np.maximum(n[right], n[k]))]


def _sides(t: pa.Table):
    own = t["own"].to_numpy()
    return np.flatnonzero(own == t["i"][0].as_py()), np.flatnonzero(own == t["j"][0].as_py())


def _promising(least: float, percent: int):
    """Members of two blocks of a bucket that have a likely partner of another component in them, by their registers."""
    def members(t: pa.Table) -> pa.Table:
        x, n, comp = (t[c].to_numpy() for c in ("x", "n", "comp"))
        reg = _judged(t["judged"])
        left, right = _sides(t)
        good = np.zeros(len(x), bool)
        for k in left.tolist():
            others = _comparable(x, n, comp, k, right, percent)
            if good[k]:  # a pair of two that have partners says nothing new
                others = others[~good[others]]
            if len(others):  # likelihood is worked out only where enough registers are equal for it
                others = others[(reg[others] == reg[k]).mean(axis=1) >= least - 0.05]
            if len(others):
                j = likely_similarity(np.broadcast_to(reg[k], (len(others), REGISTERS)), reg[others],
                                      np.full(len(others), float(n[k])), n[others].astype(float))
                if (j >= least).any():
                    good[k] = True
                    good[others[j >= least]] = True
        return t.select(["band", "value", "i", "j", "own", "x", "n", "comp"]).filter(pa.array(good))
    return members


def _spanning(size: int, percent: int):
    """Links between components among members of two blocks, on their full sets: as many as connect what is linked, no more."""
    def links(t: pa.Table) -> pa.Table:
        x, comp = t["x"].to_numpy(), t["comp"].to_numpy()
        buf, off = C.binary_arrays(t["text"])
        docs, tokens = [], []
        for lo, hi in C.pieces(off):
            w, doc, _, _ = C.words(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            h, doc, _ = C.shingles(w, doc, hi - lo, size)
            doc, h = C.distinct_in(doc, h)
            docs.append(doc + lo), tokens.append(h)
        doc, h = np.concatenate(docs), np.concatenate(tokens)
        n = np.bincount(doc, minlength=len(x))
        order = np.argsort(h, kind="stable")
        doc, h = doc[order], h[order]
        column = np.cumsum(np.concatenate([[False], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        shared = (np.bincount(column) > 1)[column] if len(h) else np.zeros(0, bool)
        doc, column = doc[shared], column[shared]
        left, right = _sides(t)
        both = np.zeros((len(left), len(right)), np.float32)
        for lo in range(0, int(column.max()) + 1 if len(column) else 0, 2048):  # incidence, some columns at a time
            i, j = np.searchsorted(column, [lo, lo + 2048])
            has = np.zeros((len(x), 2048), np.float32)
            has[doc[i:j], column[i:j] - lo] = 1
            both += has[left] @ has[right].T
        linked = (100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)) & (comp[left][:, None] != comp[right][None, :])
        parent: dict[int, int] = {}

        def root(c):
            while parent.setdefault(c, c) != c:
                parent[c] = c = parent[parent[c]]
            return c

        out = []
        for p, q in zip(*(k.tolist() for k in np.nonzero(linked))):
            a, b = root(int(comp[left[p]])), root(int(comp[right[q]]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append(sorted((int(x[left[p]]), int(x[right[q]]))))
        every = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": every[:, 0], "b": every[:, 1]})
    return links


def _verified(size: int, percent: int):
    def rows(batches):
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            sides = [C.binary_arrays(batch.column(c)) for c in ("text_a", "text_b")]
            both = sides[0][1] + sides[1][1]
            for lo, hi in C.pieces(both):
                members = []
                for buf, off in sides:
                    w, doc, _, _ = C.words(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                    h, doc, _ = C.shingles(w, doc, hi - lo, size)
                    members.append(C.distinct_in(doc, h))
                n = sum(np.bincount(d, minlength=hi - lo) for d, _ in members)
                doc, _ = C.distinct_in(np.concatenate([m[0] for m in members]), np.concatenate([m[1] for m in members]))
                union = np.bincount(doc, minlength=hi - lo)
                yield pa.RecordBatch.from_pydict({"a": a[lo:hi], "b": b[lo:hi],
                                                  "linked": 100 * (n - union) >= percent * union})
    return rows


def near_duplicates(docs: DataFrame, shingle: int = 2, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles (set size), component_id (smallest id reachable over pairs with Jaccard similarity
    of at least ``percent``), kept (doc_id is its component's)."""
    docs = C.docs_of(docs, id_col, text_col)
    spark = docs.sparkSession
    sketch = C.saved(docs.mapInArrow(_sketches(shingle), _SKETCH_SQL), "sketches")
    named = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    rep = C.saved(named.groupBy("set_hi", "set_lo", "n_shingles").agg(F.min("doc_id").alias("rep")), "sets")
    first = named.join(rep.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    member = first.select(F.col("doc_id").alias("x"), F.col("n_shingles").alias("n"),
                          F.posexplode("bands").alias("band", "value"))
    star = member.groupBy("band", "value").agg(F.min("x").alias("c"), F.count("*").alias("k")).where("k > 1")
    buckets = C.saved(member.join(star, ["band", "value"]).select("band", "value", "x", "n", "c"), "buckets")
    C.release(spark)

    sizes = buckets.groupBy("x").agg(F.first("n").alias("n"), F.min("c").alias("c"))
    texts = C.saved(docs.join(sizes.select(F.col("x").alias("doc_id")), "doc_id", "left_semi"), "candidate-texts")
    regs = C.saved(first.join(sizes.select(F.col("x").alias("doc_id")), "doc_id", "left_semi")
                   .select("doc_id", "n_shingles", "judged"), "candidate-registers")
    C.release(spark)

    def check(pairs: DataFrame, name: str) -> DataFrame:
        """Verdict of each pair (a, b): linked or not."""
        side = [regs.select(F.col("doc_id").alias(i), F.col("n_shingles").alias("n" + i), F.col("judged").alias("k" + i)) for i in "ab"]
        fit = F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb")
        likely = (pairs.join(side[0], "a").join(side[1], "b").where(fit)
                  .mapInArrow(_likely(percent / 100 - 0.1), "a long, b long"))
        text = [texts.select(F.col("doc_id").alias(i), F.col("text").alias("text_" + i)) for i in "ab"]
        out = C.saved(likely.join(text[0], "a").join(text[1], "b").mapInArrow(
            _verified(shingle, percent), "a long, b long, linked boolean"), name)
        C.release(spark)
        return out

    def labelled(links: DataFrame) -> DataFrame:
        comp = C.saved(components(links.where("linked").select("a", "b")), "components")
        return buckets.join(comp.withColumnRenamed("id", "x"), "x", "left").withColumn(
            "comp", F.coalesce("component_id", "x")).drop("component_id"), comp

    def open_buckets(placed: DataFrame) -> DataFrame:
        mixed = placed.groupBy("band", "value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                                    F.min(F.struct("x", "comp")).alias("head")).where("lo < hi")
        return C.saved(placed.join(mixed.select("band", "value", F.col("head.comp").alias("c_comp")), ["band", "value"]), "open-buckets")

    links = check(sizes.where("c < x").select(F.col("c").alias("a"), F.col("x").alias("b")).distinct(), "links")
    placed, comp = labelled(links)
    todo = open_buckets(placed)
    pairs = (todo.where("c < x AND comp != c_comp").select(F.col("c").alias("a"), F.col("x").alias("b")).distinct()
             .join(links.select("a", "b"), ["a", "b"], "left_anti"))
    links = links.unionByName(check(pairs, "links"))
    placed, comp = labelled(links)
    todo = open_buckets(placed)
    counted = todo.join(todo.groupBy("band", "value").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), ["band", "value"])
    own = F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int")
    dealt = (counted.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "x", "n", "comp")
             .join(regs.select(F.col("doc_id").alias("x"), "judged"), "x"))
    block = ["band", "value", "i", "j"]
    hopeful = C.saved(dealt.groupBy(*block).applyInArrow(
        _promising(percent / 100 - 0.1, percent), "band int, value long, i int, j int, own int, x long, n long, comp long"), "promising")
    across = C.saved(hopeful.join(texts.withColumnRenamed("doc_id", "x"), "x").groupBy(*block).applyInArrow(
        _spanning(shingle, percent), "a long, b long").distinct(), "links")
    comp = C.saved(components(links.where("linked").select("a", "b").unionByName(across)), "components")

    label = (rep.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
             .select("set_hi", "set_lo", "n_shingles", F.coalesce("component_id", "rep").alias("component_id")))
    linked = named.select("doc_id", "n_shingles", "set_hi", "set_lo").join(label, ["set_hi", "set_lo", "n_shingles"])
    alone = sketch.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return (linked.select("doc_id", "n_shingles", "component_id").unionByName(alone)
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def one_of_each_group(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Rows of docs, one of each group of near copies: that of the smallest doc_id (null is the largest).

    Rows are judged one by one: those with a null doc_id, or one that other rows have too, get a number of their own. Of rows that share doc_id and text one
    stays, whichever; texts without words are copies of nothing and all stay."""
    spark, columns = docs.sparkSession, docs.columns
    key, of = C.fresh_name(columns, "row_key"), C.fresh_name(columns, "shared_id")
    own_id = F.col("doc_id").cast("long")
    ids = docs.groupBy(own_id.alias("i")).agg(F.count("*").alias("n"))
    shared = C.saved(ids.where("n > 1 OR i IS NULL").select(F.col("i").alias(of)), "shared-ids")
    low, high = ids.where("n = 1").agg(F.min("i"), F.max("i")).first()
    single = docs.join(shared, own_id == F.col(of), "left_anti").where(own_id.isNotNull()).withColumn(key, own_id)
    among = docs.join(shared, own_id.eqNullSafe(F.col(of)), "left_semi")
    wordless = ~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    copies = among.where(~wordless).dropDuplicates(["doc_id", "text"])
    # numbered once, in a written table, so that a task run again can't number anew
    numbered = C.saved(copies.withColumn(key, F.monotonically_increasing_id()), "shared-rows")
    most = numbered.agg(F.max(key)).first()[0]
    if most is not None and low is not None:
        if low - 1 - most >= -(1 << 63):
            numbered = numbered.withColumn(key, F.lit(low - 1) - F.col(key))
        elif high + 1 + most < 1 << 63:
            numbered = numbered.withColumn(key, F.lit(high + 1) + F.col(key))
        else:
            raise ValueError("doc_id covers all long numbers: none is left for rows that share an id")
    keyed = single.unionByName(numbered)
    found = near_duplicates(keyed, shingle, percent, id_col=key).select(F.col("doc_id").alias("k"), F.col("component_id").alias("c"))
    found = C.saved(found, "groups").join(numbered.select(F.col(key).alias("k"), own_id.alias("i"), F.lit(True).alias("named")), "k", "left")
    real = F.when(F.col("named"), F.col("i")).otherwise(F.col("k"))
    stays = F.min(F.struct(real.isNull().alias("null_id"), real.alias("i"), F.col("k")))
    grouped = found.groupBy("c").agg(F.count("*").alias("n"), stays.alias("stays")).where("n > 1")
    gone = found.join(grouped, "c").where("k != stays.k").select(F.col("k").alias(key))
    return keyed.join(gone, key, "left_anti").select(*columns).unionByName(among.where(wordless).select(*columns))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies, by five-word shingles at 0.8; all columns as they were."""
    return one_of_each_group(docs, 5, 80)


def op5_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all of documents, two-word shingles, 0.8."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), 2, 80)


QUERIES = {"op5_setsketch_dedup": op5_setsketch_dedup}
