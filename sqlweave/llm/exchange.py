"""Blocks of documents, and questions about 64-bit names that Spark deals out by name.

A block is one row that holds some megabytes of consecutive documents, so that array code works on
whole blocks. A step asks, for each name its block holds, what other blocks hold under that name: it
sends one small binary per bucket of names, Spark shuffles these by bucket, and the answers
come back keyed by block. A name travels once per block, whatever the number of its copies."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BLOCK_SCHEMA = "block_id long, ids binary, lens binary, text binary, extra binary, extra_pos binary"


def pack(docs: DataFrame, block_bytes: int, extra: Callable | None = None) -> DataFrame:
    """Blocks of (doc_id, text): ids and byte lengths as int64 arrays, the joined UTF-8 texts under
    zstd. ``extra(buf, offsets)`` may add two byte strings a block. Written once below the shared
    folder, bucketed by block_id, so that later joins on block_id do not move the texts."""
    spark = docs.sparkSession
    n = C.shuffle_partitions(spark)

    def rows(batches):
        part, seq = TaskContext.get().partitionId(), 0
        zip_ = zstandard.ZstdCompressor(level=1)

        def row(ids, bufs, lens):
            nonlocal seq
            buf = np.concatenate(bufs)
            off = np.concatenate([[0], np.cumsum(np.concatenate(lens))])
            more = extra(buf, off) if extra else (b"", b"")
            key = (part << 33) + seq
            seq += 1
            return pa.RecordBatch.from_pydict({
                "block_id": pa.array([key], pa.int64()),
                "ids": [np.concatenate(ids).astype(np.int64).tobytes()],
                "lens": [np.diff(off).astype(np.int64).tobytes()],
                "text": [zip_.compress(buf.tobytes())], "extra": [more[0]], "extra_pos": [more[1]]})

        ids, bufs, lens, held = [], [], [], 0
        for i, buf, off in C.text_pieces(batches):
            ids.append(i), bufs.append(buf.copy()), lens.append(np.diff(off))
            held += len(buf) + 16 * len(i)
            if held >= block_bytes:
                yield row(ids, bufs, lens)
                ids, bufs, lens, held = [], [], [], 0
        if ids:
            yield row(ids, bufs, lens)

    name = C.table_name("blocks")
    (docs.mapInArrow(rows, BLOCK_SCHEMA).repartition(n, "block_id").write
     .option("path", C.scratch_path(spark, name)).option("compression", "none")
     .bucketBy(n, "block_id").saveAsTable(name))
    C.release(spark)
    return spark.table(name)


def unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc ids, joined bytes, offsets) of a block's row."""
    off = np.concatenate([[0], np.cumsum(np.frombuffer(row["lens"], np.int64))])
    raw = zstandard.ZstdDecompressor().decompress(row["text"]) if off[-1] else b""
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(raw, np.uint8), off


def steps(numbers: np.ndarray) -> bytes:
    """int64 numbers as differences, all first bytes before all second bytes and so on: what is mostly small
    or repeated then compresses well in a shuffle."""
    return np.diff(numbers, prepend=np.int64(0)).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_steps(raw) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


def bucket_of(name: np.ndarray, n: int) -> np.ndarray:
    return ((C.mix(name) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def by_bucket(name: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(order by bucket then name, n + 1 bounds of the buckets in it)."""
    b = bucket_of(name, n)
    order = np.lexsort((name, b))
    return order, np.searchsorted(b[order], np.arange(n + 1))


def answers_by_block(answers: DataFrame) -> DataFrame:
    """One row per block: its (kind, bucket, bits), bounded by the block's own names."""
    return answers.groupBy("block_id").agg(F.collect_list(F.struct("kind", "bucket", "bits")).alias("answers"))


def joined(answers: list | None, kind: int) -> np.ndarray:
    """The answer bits of one kind, in bucket order."""
    got = sorted((a["bucket"], a["bits"]) for a in answers or () if a["kind"] == kind)
    parts = [np.frombuffer(b, np.uint8) for _, b in got]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def shared_names(asked: DataFrame, kind: int) -> DataFrame:
    """``asked`` (block_id, bucket, payload of distinct uint64 names) to (block_id, kind, bucket,
    bits): one byte a name, 1 if another block asks for it too."""
    def answer(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(p.as_buffer(), np.uint64) for p in t["payload"]]
        sizes = [len(p) for p in parts]
        every = np.concatenate(parts)
        order = np.argsort(every)
        s = every[order]
        twice = np.zeros(len(s), bool)
        same = s[1:] == s[:-1]
        twice[1:] |= same
        twice[:-1] |= same
        bits = np.empty(len(s), np.uint8)
        bits[order] = twice
        cut = np.cumsum(sizes)[:-1]
        return pa.table({"block_id": t["block_id"], "kind": pa.array([kind] * len(t), pa.int32()),
                         "bucket": t["bucket"], "bits": pa.array([x.tobytes() for x in np.split(bits, cut)], pa.binary())})

    return asked.groupBy("bucket").applyInArrow(answer, "block_id long, kind int, bucket int, bits binary")
