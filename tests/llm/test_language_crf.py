"""Language identification: forward-backward against sums over all paths, held-out accuracy, code-switched texts, odd rows."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sqlweave.llm import language_crf as L

SCHEMA = "doc_id long, text string, lang string, source string, held_out string, score string, letters int"


@pytest.fixture(scope="module")
def model(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    return docs, L.train(docs)


def all_paths(score, trans, start):
    k = score.shape[1]
    out = np.zeros_like(score)
    for path in itertools.product(range(k), repeat=len(score)):
        w = np.exp(start[path[0]] + sum(trans[a, b] for a, b in zip(path, path[1:])) + sum(score[i, c] for i, c in enumerate(path)))
        for i, c in enumerate(path):
            out[i, c] += w
    return out / out.sum(axis=1, keepdims=True)


def test_marginals_are_sums_over_paths():
    rng = np.random.default_rng(5)
    lengths = [1, 2, 7, 3, 1]
    begin = np.concatenate([[0], np.cumsum(lengths)])
    score, trans, start = rng.normal(size=(begin[-1], 3)) * 2, rng.normal(size=(3, 3)), rng.normal(size=3)
    want = np.concatenate([all_paths(score[a:b], trans, start) for a, b in zip(begin, begin[1:])])
    assert np.allclose(L.marginals(score, begin, trans, start), want)


def test_marginals_of_long_sequences():
    """Chunk borders: lengths around multiples of the chunk, against the plain recursion in logs."""
    rng = np.random.default_rng(6)
    lengths = [31, 32, 33, 64, 65, 1000, 1, 97]
    begin = np.concatenate([[0], np.cumsum(lengths)])
    score, trans, start = rng.normal(size=(begin[-1], 4)) * 3, rng.normal(size=(4, 4)) * 2, rng.normal(size=4)
    got = L.marginals(score, begin, trans, start)
    for a, b in zip(begin, begin[1:]):
        e = score[a:b]
        f, r = np.empty_like(e), np.zeros_like(e)
        f[0] = start + e[0]
        for t in range(1, len(e)):
            f[t] = np.logaddexp.reduce(f[t - 1][:, None] + trans, axis=0) + e[t]
        for t in range(len(e) - 2, -1, -1):
            r[t] = np.logaddexp.reduce(trans + (e[t + 1] + r[t + 1])[None, :], axis=1)
        p = f + r
        assert np.allclose(got[a:b], np.exp(p - np.logaddexp.reduce(p, axis=1)[:, None]), atol=1e-8)


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    words = ["a", "über", "日本語", "x" * 100, "é"]
    raw, size = "".join(words).encode(), np.array([len(w.encode()) for w in words])
    row, f = L.features(raw, size)
    for i, w in enumerate(words):
        alone = L.features(w.encode(), np.array([len(w.encode())]))[1]
        assert sorted(f[row == i].tolist()) == sorted(alone.tolist())
    assert L.features(b"\xff\xfe", np.array([1, 1]))[0].max() == 1  # no UTF-8: by bytes


def test_held_out_accuracy(spark, model):
    docs, m = model
    got = L.predicted(docs, m).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert {r.doc_id for r in got if r.held_out} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    out = [r for r in got if r.held_out]
    assert len(got) == docs.count() and sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out) and all(0 <= r.score <= 1 for r in got)


def test_held_out_rows_and_other_columns_do_not_count(spark, model):
    docs, m = model
    false = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    again = L.train(false)
    assert again.labels == m.labels and np.array_equal(again.weights, m.weights) and np.array_equal(again.trans, m.trans)


def test_code_switched_text(spark, model):
    """Stretches of 30 words of held-out documents of two languages: the runs of labels follow them."""
    docs, m = model
    by = {}
    for r in docs.where(L.held_out(F.col("doc_id"))).orderBy("doc_id").collect():
        words = "".join(c if c.isalpha() else " " for c in r.text).split()
        if r.lang not in by and len(words) >= 100:
            by[r.lang] = words
    a, b = sorted(by)[:2]
    text = " ".join(by[a][:30] + by[b][:30] + by[a][30:60])
    r = L.predicted(spark.createDataFrame([(2, text)], "doc_id long, text string"), m, spans=True).first()
    label = [s.lang for s in r.spans for _ in range(s.words)]
    want = [a] * 30 + [b] * 30 + [a] * 30
    assert len(label) == 90 and sum(x == y for x, y in zip(label, want)) >= 80 and r.lang_pred == a


def test_odd_rows(spark, model):
    docs, m = model
    en = docs.where("lang = 'en'").orderBy("doc_id").first().text
    rows = [(1, None), (2, ""), (3, "123 !? —— \n"), (4, "€€ 12"), (5, en * 200), (5, en * 200), (None, en), (6, "日本"), (7, "A" * 200_000), (8, "\n".join("ñ" * 3000))]
    df = spark.createDataFrame([(i, t, None, None, "x", "y", 3) for i, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: r for r in L.predicted(df, m).collect()}
    assert len(got) == 9 and all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 4))
    assert got[5].lang_pred == "en" and got[None].lang_pred == "en" and not got[None].held_out
    assert all(got[i].lang_pred in m.labels and 0 <= got[i].score <= 1 for i in (5, 6, 7, 8))
    empty = spark.createDataFrame([], SCHEMA)
    assert L.train(empty) is None and L.train(df) is None and L.predicted(empty, m).count() == 0
    assert {r.lang_pred for r in L.predicted(df, None).collect()} == {"und"}
    one = L.train(df.withColumn("lang", F.lit("en")))
    assert {(r.lang_pred, r.score) for r in L.predicted(df, one).where("doc_id > 4").collect()} == {("en", 1.0)}
