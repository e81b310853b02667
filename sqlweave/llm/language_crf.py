"""Language identification: a linear-chain conditional random field over the words of a text.

Each word has a label, a language. Emission scores are sums of hashed feature weights: character n-grams with the word's ends marked, affixes of three and four
code points, and the word itself (the lexicon). Transition and start weights are learned with them. Forward-backward gives each word's probability of every
label, so runs of words in code-switched texts get labels of their own; the language of a text is the label with the largest sum over its words.

Words are runs of letters and of code points from U+0080, of the lower-cased text. Emissions are computed once for each different word of a piece of text. Forward-backward runs over
chunks of ``CHUNK`` words of all texts of a piece at once: the transfer matrix of each chunk, then the states between chunks, then the words inside each. So a text of
any length is taken whole, in steps that grow with CHUNK and with the number of chunks of the longest text.

Fitted on a bounded sample: of each language the ``label_rows`` labelled documents (by different id and text) that hash lowest, and of each of them ``row_words`` neighbouring words from
a place drawn by the hash. Two such stretches make a training sequence, whichever their languages, so that changes of language are learned too. Held-out documents are never read
for the fit. Scoring reads every document, and of it the text alone.

Defined results: a text that is null or has no letter is `und` with score 0, and so is every text if there is nothing to learn from; ties go to the label that is first in UTF-8 order; a
null id is neither held out nor learned from; repeated rows are judged alike; an empty table gives an empty one; other columns are ignored."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

DIMS = 1 << 18
LABEL_ROWS = 512
ROW_WORDS = 64
MAX_FIT_WORD = 64  # bytes of a word in the sample
CHUNK = 32
TEXT_BYTES = 1 << 21
UNKNOWN = "und"


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # DIMS x labels
    trans: np.ndarray  # from x to
    start: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Fixed by the query's contract: documents that are kept from the fit."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


# --------------------------------------------------------------------------- features


def _code_points(raw: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of joined words and their number in each; bytes where it isn't UTF-8."""
    buf = np.frombuffer(raw, np.uint8)
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    count = np.add.reduceat(((buf & 0xC0) != 0x80).astype(np.int64), begin)
    try:
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:
        return buf.astype(np.uint64), size
    return (points.astype(np.uint64), count) if (count > 0).all() else (buf.astype(np.uint64), size)


def features(raw: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature) pairs of joined words of ``size`` bytes each, in the order of the words."""
    points, count = _code_points(raw, size)
    n = len(count)
    end = np.cumsum(count + 2)  # with a mark at both ends
    x = np.empty(int(end[-1]), np.uint64)
    first, last = end - count - 2, end - 1
    inner = np.ones(len(x), bool)
    inner[first] = inner[last] = False
    x[inner], x[first], x[last] = points, np.uint64(1 << 32), np.uint64((1 << 32) + 1)
    word = np.repeat(np.arange(n), count + 2)
    rows, ids = [], []

    def add(of: np.ndarray, h: np.ndarray, kind: int) -> None:
        rows.append(of)
        ids.append((C.mix_pair(h, np.full(len(h), kind, np.uint64), 17) & np.uint64(DIMS - 1)).astype(np.int32))

    add(word[inner], x[inner], 1)
    gram = x
    for size_ in (2, 3):
        gram = C.mix_pair(gram[:-1], x[size_ - 1:], 19)
        whole = word[:len(gram)] == word[size_ - 1:]
        add(word[:len(gram)][whole], gram[whole], size_)
    for length in (3, 4):
        long = np.flatnonzero(count >= length)
        for kind, at in ((10, first[long] + 1), (20, last[long] - length)):
            h = x[at]
            for k in range(1, length):
                h = C.mix_pair(h, x[at + k], 23)
            add(long, h, kind + length)
    # the word itself: a sum over scrambled (place, code point) pairs
    place = np.arange(len(x), dtype=np.uint64) - np.repeat(first, count + 2).astype(np.uint64)
    add(np.arange(n), np.add.reduceat(C.mix_pair(x, place, 29), first), 30)
    row, f = np.concatenate(rows), np.concatenate(ids)
    order = np.argsort(row, kind="stable")
    return row[order], f[order]


def _joined(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bytes of the stretches [start, end), one behind the other, and their sizes."""
    size = end - start
    shift = start - (np.cumsum(size) - size)
    return buf[np.repeat(shift, size) + np.arange(int(size.sum()))].tobytes(), size


def emissions(weights: np.ndarray, raw: bytes, size: np.ndarray) -> np.ndarray:
    """Scores of each word by label."""
    row, f = features(raw, size)
    begin = np.searchsorted(row, np.arange(len(size)))
    return np.add.reduceat(weights[f], begin, axis=0).astype(np.float64)


# --------------------------------------------------------------------------- forward-backward


def _norm(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def _positive(score: np.ndarray) -> np.ndarray:
    """exp of scores, the largest of each word 1, none 0."""
    return np.exp(np.maximum(score - score.max(axis=-1, keepdims=True), -60))


def marginals(score: np.ndarray, begin: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """P(label) of each word; ``begin`` (n + 1 places) bounds the sequences, none of them empty."""
    k = score.shape[1]
    e, a, s = _positive(score), np.exp(trans - trans.max()), np.exp(start - start.max())
    length = np.diff(begin)
    chunks = -(-length // CHUNK)
    first = np.cumsum(chunks) - chunks  # first chunk of each sequence
    of = np.repeat(np.arange(len(length)), chunks)
    left = begin[of] + CHUNK * (np.arange(len(of)) - first[of])
    held = np.minimum(begin[of + 1] - left, CHUNK)
    opens = np.zeros(len(of), bool)
    opens[first] = True
    place = np.minimum(left[:, None] + np.arange(CHUNK), len(e) - 1)
    # 1: transfer matrix of every chunk
    m = np.broadcast_to(np.eye(k), (len(of), k, k)).copy()
    for b in range(CHUNK):
        now = np.flatnonzero(held > b)
        step = (m[now].reshape(-1, k) @ a).reshape(-1, k, k)
        if b == 0:
            step[opens[now]] = s
        step *= e[place[now, b]][:, None, :]
        m[now] = step / step.max(axis=(1, 2), keepdims=True)
    # 2: states before and behind every chunk
    before, behind = np.empty((len(of), k)), np.empty((len(of), k))
    f, r = np.full((len(length), k), 1 / k), np.full((len(length), k), 1 / k)
    for j in range(int(chunks.max())):
        live = np.flatnonzero(chunks > j)
        c = first[live] + j
        before[c] = f[live]
        f[live] = _norm(np.einsum("ij,ijk->ik", f[live], m[c]))
        c = first[live] + chunks[live] - 1 - j
        behind[c] = r[live]
        r[live] = _norm(np.einsum("ijk,ik->ij", m[c], r[live]))
    # 3: the words inside every chunk
    out = np.empty_like(e)
    f = before
    for b in range(CHUNK):
        now = np.flatnonzero(held > b)
        step = f[now] @ a
        if b == 0:
            step[opens[now]] = s
        f[now] = _norm(step * e[place[now, b]])
        out[place[now, b]] = f[now]
    r = behind
    for b in range(CHUNK - 1, -1, -1):
        now = np.flatnonzero(held > b)
        at = place[now, b]
        out[at] *= r[now]
        r[now] = _norm((e[at] * r[now]) @ a.T)
    return _norm(out)


# --------------------------------------------------------------------------- fit


def fit(words: list[bytes], sequences: list[tuple[np.ndarray, np.ndarray]], labels: list[str], steps: int = 60, rate: float = 0.1,
        ridge: float = 1e-5) -> Model:
    """Weights by Adam on the whole sample. A sequence is (word numbers, label numbers)."""
    k, n = len(labels), len(sequences)
    t = max(len(s[0]) for s in sequences)
    ids, y = np.zeros((n, t), np.int64), np.zeros((n, t), np.int64)
    held = np.zeros((n, t), bool)
    for i, (w, l) in enumerate(sequences):
        ids[i, :len(w)], y[i, :len(w)], held[i, :len(w)] = w, l, True
    row, feature = features(b"".join(words), np.array([len(w) for w in words]))
    used, col = np.unique(feature, return_inverse=True)
    begin = np.searchsorted(row, np.arange(len(words)))
    w, trans, start = np.zeros((len(used), k)), np.zeros((k, k)), np.zeros(k)
    params = [w, trans, start]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    total = held.sum()
    hot = np.eye(k)[y] * held[..., None]
    pair_y = np.zeros((k, k))
    np.add.at(pair_y, (y[:, :-1][held[:, 1:]], y[:, 1:][held[:, 1:]]), 1)
    for step in range(1, steps + 1):
        e = _positive(np.add.reduceat(w[col], begin, axis=0))[ids]
        a, s = np.exp(trans - trans.max()), np.exp(start - start.max())
        f, r = np.empty((n, t, k)), np.full((n, t, k), 1 / k)
        f[:, 0] = _norm(s * e[:, 0])
        for j in range(1, t):
            f[:, j] = np.where(held[:, j, None], _norm((f[:, j - 1] @ a) * e[:, j]), f[:, j - 1])
        for j in range(t - 1, 0, -1):
            r[:, j - 1] = np.where(held[:, j, None], _norm((e[:, j] * r[:, j]) @ a.T), r[:, j])
        p = _norm(f * r)
        both = f[:, :-1, :, None] * a * (e[:, 1:] * r[:, 1:])[:, :, None, :]
        both /= both.sum(axis=(2, 3), keepdims=True)
        gap = (p * held[..., None] - hot).reshape(-1, k)
        by_word = np.stack([np.bincount(ids.ravel(), weights=gap[:, c], minlength=len(words)) for c in range(k)], axis=1)
        grads = [np.stack([np.bincount(col, weights=by_word[row, c], minlength=len(used)) for c in range(k)], axis=1) / total + ridge * w,
                 ((both * held[:, 1:, None, None]).sum(axis=(0, 1)) - pair_y) / total + ridge * trans,
                 (p[:, 0] - hot[:, 0]).sum(axis=0) / total + ridge * start]
        for x, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros((DIMS, k), np.float32)
    weights[used] = w
    return Model(labels, weights, trans, start)


def _stretches(batches, row_words: int):
    """(h, lang, text) to (h, lang, words): the stretch of words that the hash draws."""
    for b in batches:
        buf, off = C.binary_arrays(b.column(2))
        words = []
        for i, h in enumerate(b.column(0).to_pylist()):
            text = np.ascontiguousarray(buf[off[i]:off[i + 1]])
            _, _, start, end = C.words(text, np.array([0, len(text)]), "letter")
            short = end - start <= MAX_FIT_WORD
            start, end = start[short], end[short]
            at = h % max(1, len(start) - row_words + 1)
            raw = C.lowered(text).tobytes()
            words.append([raw[s:e] for s, e in zip(start[at:at + row_words].tolist(), end[at:at + row_words].tolist())])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words, pa.list_(pa.binary()))], names=["h", "lang", "words"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_rows: int = LABEL_ROWS,
          row_words: int = ROW_WORDS, steps: int = 60) -> Model | None:
    """Model of the documents that aren't held out and have a language; None without any."""
    given = docs.select(F.col(lang_col).cast("string").alias("lang"), F.lower(F.col(text_col).cast("string")).alias("text"),
                        F.xxhash64(F.col(id_col), F.col(text_col).cast("string")).alias("h")).where(
        ~held_out(F.col(id_col)) & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    lowest = Window.partitionBy("lang").orderBy("h")
    picked = C.saved(given.select("lang", "h").distinct().withColumn("k", F.row_number().over(lowest)).where(F.col("k") <= label_rows).select("lang", "h"), "picked")
    # at most label_rows keys a language: small enough to send to every task; copies of a row under one id meet before the shuffle
    texts = given.join(F.broadcast(picked), ["lang", "h"], "left_semi").groupBy("h", "lang").agg(F.max("text").alias("text"))
    got = texts.mapInArrow(lambda b: _stretches(b, row_words), "h long, lang string, words array<binary>").toArrow()
    rows = sorted((h, lang, ws) for h, lang, ws in zip(*(got[c].to_pylist() for c in ("h", "lang", "words"))) if ws)
    if not rows:
        return None
    labels = sorted({lang for _, lang, _ in rows}, key=str.encode)
    if len(labels) == 1:
        return Model(labels, np.zeros((DIMS, 1), np.float32), np.zeros((1, 1)), np.zeros(1))
    number = {w: i for i, w in enumerate(sorted({w for _, _, ws in rows for w in ws}))}
    code = {lang: i for i, lang in enumerate(labels)}
    parts = [(np.array([number[w] for w in ws]), np.full(len(ws), code[lang])) for _, lang, ws in rows]
    sequences = [tuple(np.concatenate(x) for x in zip(parts[i], parts[(i + 1) % len(parts)])) for i in range(0, len(parts), 2)]
    return fit(list(number), sequences, labels, steps)


# --------------------------------------------------------------------------- scoring


def _judge(model: Model, buf: np.ndarray, off: np.ndarray):
    """(texts that have words, their words' begins, P(label) of each word) of lower-cased texts."""
    h, doc, start, end = C.words(buf, off, "letter")
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros((0, len(model.labels)))
    _, one, back = np.unique(h, return_index=True, return_inverse=True)
    score = emissions(model.weights, *_joined(C.lowered(buf), start[one], end[one]))[back]
    of, begin = np.unique(doc, return_index=True)
    begin = np.append(begin, len(h))
    return of, begin, marginals(score, begin, model.trans, model.start)


def _predictions(batches, model: Model | None, spans: bool):
    for b in batches:
        if not b.num_rows:
            continue
        buf, off = C.binary_arrays(b.column("text"))
        letters = b.column("letters").to_numpy(zero_copy_only=False)
        kept = [b.column(c) for c in ("doc_id", "held_out")]
        for lo, hi in C.pieces(off, TEXT_BYTES):
            lang, score = np.full(hi - lo, UNKNOWN, object), np.zeros(hi - lo)
            runs: list[list] = [[] for _ in range(hi - lo)]
            if model is not None:
                of, begin, p = _judge(model, np.ascontiguousarray(buf[off[lo]:off[hi]]), off[lo:hi + 1] - off[lo])
                known = letters[lo:hi][of]
                if len(of):
                    mean = np.add.reduceat(p, begin[:-1], axis=0) / np.diff(begin)[:, None]
                    best = mean.argmax(axis=1)
                    lang[of[known]] = np.array(model.labels, object)[best[known]]
                    score[of[known]] = np.clip(mean[np.arange(len(of)), best], 0, 1)[known]
                for i in np.flatnonzero(known) if spans else ():
                    label = p[begin[i]:begin[i + 1]].argmax(axis=1)
                    cut = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
                    for s, e in zip(cut, np.append(cut[1:], len(label))):
                        runs[of[i]].append({"first": int(s), "words": int(e - s), "lang": model.labels[label[s]]})
            cols = [*(c.slice(lo, hi - lo) for c in kept), pa.array(lang, pa.string()), pa.array(score)]
            if spans:
                cols.append(pa.array(runs, pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "lang_pred", "score", *(["spans"] if spans else [])])


def predicted(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", spans: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score (mean probability of that label over the words) and, if asked for, spans: the runs of words of one label."""
    text = F.coalesce(F.lower(F.col(text_col).cast("string")), F.lit(""))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), text.alias("text"), text.rlike(r"\p{L}").alias("letters"))
    schema = "doc_id long, held_out boolean, lang_pred string, score double" + (", spans array<struct<first:long,words:long,lang:string>>" if spans else "")
    return given.mapInArrow(lambda b: _predictions(b, model, spans), schema)


def op11_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predicted(docs, train(docs))


QUERIES = {"op11_language_crf": op11_language_crf}
