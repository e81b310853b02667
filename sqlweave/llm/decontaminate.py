"""Benchmark decontamination with an FM-index per training shard.

The benchmark's words are the alphabet. A shard is a piece of a task's documents: its stretches of alphabet words long enough to
hold a window are joined by separators, and the suffixes of this word string give its Burrows-Wheeler transform, whose ranks come from a wavelet
matrix. All windows are searched backwards at once; their occurrences are located by walking to suffixes whose places were kept (every eighth
and the first of each stretch), and the word spans of a document are merged.

A window is ``width`` consecutive words of an item; an item with fewer, but not none, is one window. The benchmark is broadcast, so its size
is checked: above ``MAX_BENCHMARK_WORDS`` words it is searched in groups of items, one pass each, and the word hits are merged.

Defined results: a null text, or one without words, has no words and no hits; an item without words has no windows; without
items, nothing is hit; null ids stay null; items with equal texts are all named, those with a null id are searched (their words
are hit) but not named or counted; other columns are ignored. The pipeline's stage judges each row by its own text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

MAX_BENCHMARK_WORDS = 1 << 20
SAMPLED = 8


class WaveletMatrix:
    """Ranks of symbols in an array, a bit plane at a time."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        at = symbols
        for bit in range(bits - 1, -1, -1):
            one = ((at >> bit) & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(one, dtype=np.int32)]))
            self.zeros.append(len(at) - int(self.ones[-1][-1]))
            at = np.concatenate([at[~one], at[one]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How many of the first ``place`` values are ``symbol``."""
        start = np.zeros_like(place)
        for k in range(self.bits):
            ones, zeros = self.ones[k], self.zeros[k]
            one = (symbol >> (self.bits - 1 - k)) & 1 == 1
            start = np.where(one, zeros + ones[start], start - ones[start])
            place = np.where(one, zeros + ones[place], place - ones[place])
        return place - start


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; separators (0) rank by place, so equal suffixes end there."""
    n = len(s)
    rank = s.astype(np.int64) + n
    ends = np.flatnonzero(s == 0)
    rank[ends] = np.arange(len(ends))
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        ordered = rank[order]
        new = np.ones(n, bool)
        second = np.full(n, -1)
        if step > 1:
            second[:n - step // 2] = rank[step // 2:]
        pair = second[order]
        new[1:] = (ordered[1:] != ordered[:-1]) | (pair[1:] != pair[:-1])
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(new) - 1
        rank = fresh
        if new.all():
            return order
        follow = np.full(n, -1)
        follow[:max(0, n - step)] = rank[step:]
        order = np.lexsort((follow, rank))
        step *= 2


class FMIndex:
    """Backward search over a word string whose stretches each end in a separator (0)."""

    def __init__(self, s: np.ndarray, sigma: int):
        sa = suffix_order(s)
        self.bwt = s[sa - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=sigma))])
        self.tree = WaveletMatrix(self.bwt, max(1, int(sigma - 1).bit_length()))
        # the first word of a stretch follows a separator: kept too, so no walk crosses one
        self.known = (sa % SAMPLED == 0) | (self.bwt == 0)
        self.place = sa[self.known]
        self.before = np.concatenate([[0], np.cumsum(self.known)])
        self.n = len(s)

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of windows given as rows, right-aligned words."""
        lo, hi = np.zeros(len(windows), np.int64), np.full(len(windows), self.n)
        for k in range(windows.shape[1] - 1, -1, -1):
            on = np.flatnonzero((lengths > windows.shape[1] - 1 - k) & (lo < hi))
            c = windows[on, k]
            lo[on] = self.first[c] + self.tree.rank(c, lo[on])
            hi[on] = self.first[c] + self.tree.rank(c, hi[on])
        return lo, hi

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text places of suffix ranks."""
        out = np.empty(len(at), np.int64)
        walk, steps = np.arange(len(at)), 0
        at = at.copy()
        while len(walk):
            hit = self.known[at]
            out[walk[hit]] = self.place[self.before[at[hit]]] + steps
            walk, at = walk[~hit], at[~hit]
            c = self.bwt[at]
            at = self.first[c] + self.tree.rank(c, at)
            steps += 1
        return out


class Windows:
    """The windows of a group of benchmark items, over an alphabet of the items' words (1 ..)."""

    def __init__(self, items: list[tuple], width: int):
        texts = [(t or "").encode() for _, t in items]
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        word, doc, _, _ = C.words(np.frombuffer(b"".join(texts), np.uint8), off, "alnum")
        self.names = [i for i, _ in items]
        self.alphabet, number = np.unique(word, return_inverse=True)
        rows, self.item, lengths = [], [], []
        for k in range(len(items)):
            own = number[doc == k] + 1
            m = min(width, len(own))
            for i in range(len(own) - m + 1 if m else 0):
                rows.append(np.concatenate([np.zeros(width - m, np.int64), own[i:i + m]]))
                self.item.append(k)
                lengths.append(m)
        self.rows = np.array(rows, np.int64).reshape(-1, width)
        self.item, self.length = np.array(self.item, np.int64), np.array(lengths, np.int64)
        if len(self.rows):  # equal windows are searched once
            self.rows, which = np.unique(self.rows, axis=0, return_inverse=True)
            which = which.ravel()
            pair = np.unique(np.stack([which, self.item], axis=1), axis=0)
            length = np.zeros(len(self.rows), np.int64)
            length[which] = self.length
            self.length, self.of, self.item = length, np.searchsorted(pair[:, 0], np.arange(len(length) + 1)), pair[:, 1]

    def hits(self, buf: np.ndarray, off: np.ndarray):
        """(words of each text, hit word's text numbers and places, (text, item) pairs) of texts."""
        n = len(off) - 1
        word, doc, _, _ = C.words(buf, off, "alnum")
        count = np.bincount(doc, minlength=n)
        nothing = np.zeros(0, np.int64)
        if not len(word) or not len(self.rows):
            return count, nothing, nothing, np.zeros((0, 2), np.int64)
        number = np.searchsorted(self.alphabet, word)
        number[number == len(self.alphabet)] = 0
        s = np.where(self.alphabet[number] == word, number + 1, 0)
        # stretches of alphabet words of one text that can hold a window
        edge = np.ones(len(s) + 1, bool)
        edge[1:-1] = (s[1:] == 0) | (s[:-1] == 0) | (doc[1:] != doc[:-1])
        start = np.flatnonzero(edge[:-1])
        size = np.diff(np.append(start, len(s)))
        use = (s[start] > 0) & (size >= self.length.min())
        start, size = start[use], size[use]
        if not len(start):
            return count, nothing, nothing, np.zeros((0, 2), np.int64)
        into = np.concatenate([[0], np.cumsum(size + 1)])
        string = np.zeros(into[-1], np.int64)
        source = np.full(into[-1], -1)
        place = np.repeat(start - into[:-1], size + 1) + np.arange(into[-1])
        inner = np.ones(into[-1], bool)
        inner[into[1:] - 1] = False
        string[inner] = s[place[inner]]
        source[inner] = place[inner]
        index = FMIndex(string, len(self.alphabet) + 1)
        lo, hi = index.search(self.rows, self.length)
        found = np.flatnonzero(hi > lo)
        if not len(found):
            return count, nothing, nothing, np.zeros((0, 2), np.int64)
        many = (hi - lo)[found]
        window = np.repeat(found, many)
        ranks = np.repeat(lo[found] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        at = source[index.locate(ranks)]
        flag = np.zeros(len(s) + 1, np.int64)
        np.add.at(flag, at, 1)
        np.add.at(flag, at + self.length[window], -1)
        hit = np.flatnonzero(np.cumsum(flag[:-1]) > 0)
        seen = np.unique(np.stack([doc[at], window], axis=1), axis=0)
        per = self.of[seen[:, 1] + 1] - self.of[seen[:, 1]]
        item = self.item[np.repeat(self.of[seen[:, 1]] - np.concatenate([[0], np.cumsum(per)[:-1]]), per) + np.arange(per.sum())]
        pairs = np.unique(np.stack([np.repeat(seen[:, 0], per), item], axis=1), axis=0)
        begin = np.concatenate([[0], np.cumsum(count)])
        return count, doc[hit], hit - begin[doc[hit]], pairs


def _groups(spark: SparkSession, benchmark: DataFrame, width: int, most_words: int) -> list[Windows]:
    """Items in groups of at most ``most_words`` words (an item has at least one group to itself)."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t"))
    out, held, n = [], [], 0
    for r in rows.orderBy("i", F.xxhash64("t")).toLocalIterator():
        size = len((r.t or "").split()) + 1
        if held and n + size > most_words:
            out.append(Windows(held, width))
            held, n = [], 0
        held.append((r.i, r.t))
        n += size
    return out + ([Windows(held, width)] if held else [])


def _spans(groups: list[Windows], buf: np.ndarray, off: np.ndarray):
    """Words of each text; text number, first word and end of each merged span; (text, item) pairs of each group."""
    n = len(off) - 1
    count = np.bincount(C.words(buf, off, "alnum")[1], minlength=n) if not groups else None
    doc, place, pairs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    for g in groups:
        count, d, p, found = g.hits(buf, off)
        doc.append(d), place.append(p), pairs.append(found)
    d, p = C.distinct_in(np.concatenate(doc), np.concatenate(place))
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(d))[:len(first)] - 1
    return count, d[first], p[first], p[last] + 1, pairs


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, width: int = 13, most_words: int = MAX_BENCHMARK_WORDS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, spans (word places [start, end) covered by benchmark windows, merged), items (ids of the items, as sorted strings)."""
    groups = _groups(docs.sparkSession, benchmark, width, most_words)

    def rows(batches):
        for ids, buf, off in C.text_pieces(batches):
            n = len(ids)
            count, doc, start, end, pairs = _spans(groups, buf, off)
            named = [set() for _ in range(n)]
            for g, found in zip(groups, pairs):
                for k, i in found.tolist():
                    if g.names[i] is not None:
                        named[k].add(g.names[i])
            bound = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))])
            spans = pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["start", "end"]))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).max), pa.array(count.astype(np.int64)), spans,
                pa.array([sorted(x) for x in named], pa.list_(pa.string()))], names=["doc_id", "n_words", "spans", "items"])

    return C.docs_of(docs, id_col, text_col).mapInArrow(
        rows, "doc_id long, n_words long, spans array<struct<start: long, end: long>>, items array<string>")


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hits with n_hit and contaminated: some word hit, and at least a twentieth of all words."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return (benchmark_hits(docs, benchmark).withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows that aren't contaminated, each judged by its own text; all columns as they were."""
    groups = _groups(spark, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 13, MAX_BENCHMARK_WORDS)

    def clean(batches):
        for b in batches:
            buf, off = C.binary_arrays(b.column("text"))
            bad = [np.zeros(0, bool)]
            for lo, hi in C.pieces(off):
                count, doc, start, end, _ = _spans(groups, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                hit = np.bincount(doc, weights=end - start, minlength=hi - lo).astype(np.int64)
                bad.append((hit > 0) & (20 * hit >= count))
            yield b.filter(pa.array(~np.concatenate(bad)))
    C.bounded_batches(spark)
    return docs.mapInArrow(clean, docs.schema)


def op6_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all of documents against all of benchmark."""
    out = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


QUERIES = {"op6_fm_decontamination": op6_fm_decontamination}
