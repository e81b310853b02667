"""Ordinal quality classifier: cumulative-link regression on graded ratings.

Grades: 0 toxic, 1 of low quality, 2 good. One weight per hashed feature gives a document's score s, and ordered
thresholds t0 < t1 give P(grade <= k) = 1 / (1 + exp(s - t_k)). The expected grade is the sum of the tails P(grade > k); a
document is kept where the last tail, P(grade = 2), is at least one half.

Features: words and runs of signs that occur, and binned shares: distinct words, repeats of the word before, capitals,
signs, bytes a word and words. A feature counts where at least ``MIN_DOCS`` sampled rows have it.

Fitted on a bounded sample: the ``sample_rows`` labelled rows whose ids hash lowest. Scoring reads every document.

Defined results: null texts are empty; rows without a grade (null quality) are left out of the fit, null toxic is 0; without
labelled rows, or with a single grade among them, every document is kept at grade 2; other columns pass through."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

DIMS = 1 << 18
SAMPLE_ROWS = 8192
MIN_DOCS = 10
GRADES = 3
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True


def features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) of texts."""
    n = len(off) - 1
    docs, ids = [], []
    word, doc, start, end = C.words(buf, off, "alnum")
    sign, sign_doc, s_start, s_end = C.words(buf, off, "symbol")
    docs += [doc, sign_doc]
    ids += [word, C.mix_pair(sign, sign, 11)]
    total = np.bincount(doc, minlength=n)
    size = np.maximum(np.diff(off), 1)
    one = np.maximum(total, 1)
    distinct = np.bincount(C.distinct_in(doc, word)[0], minlength=n)
    again = np.flatnonzero((doc[1:] == doc[:-1]) & (word[1:] == word[:-1])) if len(doc) else np.zeros(0, np.int64)
    capital = np.concatenate([[0], np.cumsum(_UPPER[buf])])
    shares = (
        20 * distinct / one, 20 * np.bincount(doc[again], minlength=n) / one,
        20 * (capital[off[1:]] - capital[off[:-1]]) / size,
        40 * np.bincount(sign_doc, weights=s_end - s_start, minlength=n) / size,
        np.bincount(doc, weights=end - start, minlength=n) / one, np.log2(1 + total))
    for k, share in enumerate(shares):
        docs.append(np.arange(n))
        ids.append(C.mix_pair(share.astype(np.uint64), np.full(n, k, np.uint64), 13))
    feature = np.concatenate(ids) & np.uint64(DIMS - 1)
    return C.distinct_in(np.concatenate(docs), feature.astype(np.int64))


def _feature_rows(batches):
    for ids, buf, off in C.text_pieces(batches):
        doc, f = features(buf, off)
        counts = np.bincount(doc, minlength=len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(f, pa.int64()))], names=["doc_id", "f"])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(row: np.ndarray, feature: np.ndarray, grade: np.ndarray, steps: int = 300, rate: float = 0.05,
                ridge: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the cumulative-link model, by Adam on the whole sample; (row, feature) pairs mark ones."""
    n = len(grade)
    used, col = np.unique(feature, return_inverse=True)
    w = np.zeros(len(used))
    theta = np.array([-2.0] + [1.0] * (GRADES - 2))  # first threshold, logs of the steps between
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(theta), np.zeros_like(theta)]
    lower = np.maximum(grade - 1, 0)
    upper = np.minimum(grade, GRADES - 2)
    for step in range(1, steps + 1):
        cuts = theta[0] + np.concatenate([[0], np.cumsum(np.exp(theta[1:]))])
        s = np.bincount(row, weights=w[col], minlength=n)
        hi = np.where(grade == GRADES - 1, 1.0, _sigmoid(cuts[upper] - s))
        lo = np.where(grade == 0, 0.0, _sigmoid(cuts[lower] - s))
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
        grad_s = (d_hi - d_lo) / n  # of the mean negative log likelihood
        grad_w = np.bincount(col, weights=grad_s[row], minlength=len(used)) + ridge * w
        by_cut = -np.bincount(upper, weights=np.where(grade < GRADES - 1, d_hi, 0), minlength=GRADES - 1) / n \
            + np.bincount(lower, weights=np.where(grade > 0, d_lo, 0), minlength=GRADES - 1) / n
        grad_t = np.array([by_cut.sum()] + [by_cut[k:].sum() * np.exp(theta[k]) for k in range(1, GRADES - 1)])
        for x, g, m, v in ((w, grad_w, *moments[:2]), (theta, grad_t, *moments[2:])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(DIMS, np.float32)
    weights[used] = w
    return weights, theta[0] + np.concatenate([[0], np.cumsum(np.exp(theta[1:]))])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray] | None:
    """Model of (doc_id, text) and (doc_id, quality, toxic); None where the labels don't tell grades apart."""
    grade = F.when(F.coalesce(F.col("toxic"), F.lit(0)) > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)
    rated = (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
             .select(F.col("doc_id").cast("long").alias("doc_id"), grade.cast("long").alias("grade"))
             .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample_rows))
    picked = C.saved(rated, "rated")
    # at most sample_rows ids: small enough to send to every task
    texts = C.docs_of(docs).join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi")
    got = texts.mapInArrow(_feature_rows, "doc_id long, f array<long>").join(F.broadcast(picked), "doc_id").toArrow()
    if not got.num_rows:
        return None
    got = got.sort_by([("doc_id", "ascending"), ("grade", "ascending")])
    y = got["grade"].to_numpy()
    lists = got["f"].combine_chunks()
    row = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    f = lists.flatten().to_numpy()
    common = np.bincount(f, minlength=DIMS)[f] >= min(MIN_DOCS, len(y))
    return fit_ordinal(row[common], f[common], y) if len(np.unique(y)) > 1 else None


def grades_of(model, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Tails P(grade > k) for k = 0 .. GRADES - 2 of each text."""
    n = len(off) - 1
    if model is None:
        return np.ones((n, GRADES - 1))
    weights, cuts = model
    doc, f = features(buf, off)
    s = np.bincount(doc, weights=weights[f], minlength=n)
    return _sigmoid(s[:, None] - cuts[None, :])


def tails_of(model, texts: pa.Array) -> np.ndarray:
    """grades_of a column of texts, some at a time."""
    buf, off = C.binary_arrays(texts)
    return np.concatenate([grades_of(model, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]) for lo, hi in C.pieces(off)])


def scored(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """All columns of docs, and expected_grade, p_good, keep (these replace columns of the same names)."""
    docs = docs.drop("expected_grade", "p_good", "keep")
    schema = T.StructType([*docs.schema.fields, T.StructField("expected_grade", T.DoubleType()),
                           T.StructField("p_good", T.DoubleType()), T.StructField("keep", T.BooleanType())])

    def rows(batches):
        for b in batches:
            if b.num_rows:
                tails = tails_of(model, b.column(text_col))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]),
                                                  pa.array(tails[:, -1] >= 0.5)],
                                                 names=[*b.schema.names, "expected_grade", "p_good", "keep"])
    return docs.mapInArrow(rows, schema)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents of grade 2, each row judged by its own text; all columns as they were."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))

    def kept(batches):
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(tails_of(model, b.column("text"))[:, -1] >= 0.5))
    C.bounded_batches(spark)
    return docs.mapInArrow(kept, docs.schema)


def op8_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: grade of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs.select("doc_id", "text"), model).select("doc_id", "expected_grade", "p_good", "keep")


QUERIES = {"op8_ordinal_quality": op8_ordinal_quality}
