"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlweave.session import scratch_path

#: bytes of text worked on at once by the array code (temporaries are a few times eight of it)
PIECE_BYTES = 1 << 19

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of unsigned 64-bit numbers (a new array)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M2
    x ^= x >> np.uint64(27)
    x *= _M3
    x ^= x >> np.uint64(31)
    return x


def mix_pair(a: np.ndarray, b: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit name of the ordered pair (a, b)."""
    x = a * _M1
    x += np.uint64((0xD6E8FEB86659FD93 * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(32)
    x += b
    return mix(x)


def sliding(op, a: np.ndarray, width: int) -> np.ndarray:
    """op (np.minimum or np.maximum) over each ``width`` neighbours; len(a) - width + 1 values."""
    have = 1
    while have * 2 <= width:
        a = op(a[:-have], a[have:])
        have *= 2
    return op(a[:have - width], a[width - have:]) if have < width else a


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: bytes of an Arrow batch on its way to a Python worker (Spark's own bound is 64 MB or 10,000 rows; a row is never cut)
BATCH_BYTES = "4m"


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def fresh_name(columns: list[str], name: str) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def docs_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names: whatever else is there is left out. The session's Arrow batches
    are bounded by bytes: each is held by the executor, its worker and the worker's copy at once."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage, survives a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that have ended (it does so when the driver collects its
    garbage, which an idle driver may put off for long); what is read later has been written by then."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def binary_arrays(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values joined, offsets of n + 1) of a string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]] if len(col) else buf[:0], off - off[0] if len(col) else np.zeros(1, np.int64)


def id_array(col: pa.Array) -> np.ndarray:
    """int64 ids; a null id is the largest number, so it sorts last."""
    return pc.fill_null(col, np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes (one text alone may be longer)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def text_pieces(batches, limit: int = PIECE_BYTES):
    """(ids, bytes, offsets) of consecutive rows (doc_id, text) of Arrow batches, a piece at a time."""
    for batch in batches:
        if batch.num_rows:
            ids = id_array(batch.column(0))
            buf, off = binary_arrays(batch.column(1))
            for lo, hi in pieces(off, limit):
                yield ids[lo:hi], buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]


# --------------------------------------------------------------------------- words

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_NOT_ALNUM = np.ones(256, bool)
_NOT_ALNUM[0x30:0x3A] = _NOT_ALNUM[0x61:0x7B] = _NOT_ALNUM[0x80:] = False
_SYMBOL = ~_SPACE
_SYMBOL[~_NOT_ALNUM] = _SYMBOL[0x41:0x5B] = False
_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[0x61:0x7B] = _NOT_LETTER[0x80:] = False
#: which bytes part words: blanks; all but digits, letters and bytes from 0x80; all but the remaining signs; all but letters and bytes from 0x80
_PARTS = {"space": _SPACE, "alnum": _NOT_ALNUM, "symbol": ~_SYMBOL, "letter": _NOT_LETTER}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lowered(buf: np.ndarray) -> np.ndarray:
    """A-Z lower-cased bytes."""
    return _LOWER[buf]


_ODD = np.uint64(0x5851F42D4C957F2D)


def _powers(n: int) -> np.ndarray:
    p = np.full(max(n, 1), _ODD, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def words(buf: np.ndarray, offsets: np.ndarray, kind: str = "space"):
    """Words of A-Z-lower-cased texts: (64-bit hash, text number, start, end) per word, in order.

    Words are runs without the six ASCII blanks or, with kind "alnum", runs of digits, letters and bytes
    from 0x80 or, with kind "symbol", runs of what is neither or, with kind "letter", runs of letters and bytes from 0x80."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    low = _LOWER[buf]
    inside = ~_PARTS[kind][low]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = cuts[cuts > 0]
    last[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(start):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    place = np.arange(n, dtype=np.int64)
    place -= np.repeat(start, np.diff(np.append(start, n))) if start[0] == 0 else \
        np.concatenate([np.arange(start[0]), np.repeat(start, np.diff(np.append(start, n)))])
    power = _powers(int((end - start).max()) + 1)
    value = (low.astype(np.uint64) + np.uint64(1)) * power[np.minimum(place, len(power) - 1)]
    value[~inside] = 0
    h = np.add.reduceat(value, start)
    h = mix(h + (end - start).astype(np.uint64) * _M1)
    doc = np.searchsorted(offsets, start, side="right") - 1
    return h, doc, start, end


def shingles(word: np.ndarray, doc: np.ndarray, n_docs: int, size: int):
    """(hash, text number, first word's place) per run of ``size`` words of one text; a text with
    fewer words, but not none, has its whole sequence as one."""
    n = len(word)
    count = np.bincount(doc, minlength=n_docs)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.concatenate([[0], np.cumsum(count)])
    h = word.copy()
    full = n - size + 1
    if full > 0:
        h = mix_pair(word[:full], np.full(full, size, np.uint64), 1)
        for k in range(1, size):
            h = mix_pair(h, word[k:k + full], 1)
        at = np.flatnonzero(doc[:full] == doc[size - 1:])
        h = h[at]
    else:
        at, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for length in range(1, size):
            of = np.flatnonzero(count[short] == length)
            if len(of):
                p = begin[short[of]]
                x = mix_pair(word[p], np.full(len(p), length, np.uint64), 1)
                for k in range(1, length):
                    x = mix_pair(x, word[p + k], 1)
                whole[of] = x
        at = np.concatenate([at, begin[short]])
        h = np.concatenate([h, whole])
        order = np.argsort(at, kind="stable")
        at, h = at[order], h[order]
    return h, doc[at], at


def distinct_in(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, hash), sorted."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        doc, h = doc[new], h[new]
    return doc, h
