"""Exact substring dedup by prefix doubling.

Every position gets a name for its first 8 bytes (the bytes themselves); a name for 2L bytes is made
from the pair of names (L bytes at p, L bytes at p + L), and the name for the full length from the two
overlapping halves. Equal names mean equal strings, so positions are ranked only as far as telling equal from
unequal, and a position leaves the game as soon as its name is unique:

1. long stretches: content-defined pieces of about 256 bytes, each with the next length - 1 bytes. A piece that
   also starts in a smaller doc_id settles all its positions at once (exact copies and most of near copies).
2. names of 32 bytes, of the smallest one in each window of the remaining text: a string that occurs
   twice shares the smallest 32-byte name in it. Windows whose smallest name is unique leave.
3. names of the full length (128 bits) of what remains: the smallest doc_id of each name decides.

Each step deals its names out by name (``exchange``), so a string shared by a third of all documents
costs one entry per block.

Defined results: null texts are empty; null doc_ids count as the largest; texts shorter than ``length`` lose
nothing; rows that share a doc_id never remove from one another; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import exchange as X

CHUNK, LOCAL, ANCHOR = 1, 2, 3
_CHUNK_REACH = 128
_EVEN = np.uint64(0xFFFFFFFFFFFFFFFE)


def _name8(buf: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buf, 8)).view(np.uint64).ravel()


def _doubled(buf: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Names of the ``length`` (a power of two from 8) bytes at each position."""
    h, have = _name8(buf), 8
    if have == length:
        return C.mix_pair(h, h, seed)
    while have < length:
        h = C.mix_pair(h[:-have], h[have:], seed)
        have *= 2
    return h


def _half(length: int) -> int:
    g = 8
    while g * 2 < length:
        g *= 2
    return g


def _chunk_starts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of texts, and positions whose 16-byte name is the smallest within 128 on either side."""
    starts = [offsets[:-1][np.diff(offsets) > 0]]
    if len(buf) > 16 + 2 * _CHUNK_REACH:
        for lo in range(0, len(buf), C.PIECE_BYTES):
            part = buf[max(0, lo - _CHUNK_REACH):lo + C.PIECE_BYTES + _CHUNK_REACH + 16]
            if len(part) <= 16 + 2 * _CHUNK_REACH:
                break
            h = _doubled(part, 16)
            low = C.sliding(np.minimum, h, _CHUNK_REACH)
            mid = h[_CHUNK_REACH:len(h) - _CHUNK_REACH]
            here = (mid < low[:len(mid)]) & (mid <= low[_CHUNK_REACH + 1:][:len(mid)])
            starts.append(np.flatnonzero(here) + _CHUNK_REACH + max(0, lo - _CHUNK_REACH))
    return np.unique(np.concatenate(starts))


def _chunk_ends(starts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, end without the overlap) of each chunk."""
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return doc, np.minimum(np.append(starts[1:], offsets[-1]), offsets[doc + 1])


def _chunk_names(length: int):
    def names(buf: np.ndarray, offsets: np.ndarray) -> tuple[bytes, bytes]:
        starts = _chunk_starts(buf, offsets)
        doc, ends = _chunk_ends(starts, offsets)
        ends = np.minimum(ends + length - 1, offsets[doc + 1])
        raw = memoryview(np.ascontiguousarray(buf))
        return b"".join([hashlib.blake2b(raw[a:b], digest_size=16).digest()
                         for a, b in zip(starts.tolist(), ends.tolist())]), starts.astype(np.int64).tobytes()
    return names


def _least(hi, lo, doc):
    """Order by (hi, lo, doc), where a new name starts in it, and the name's number of each place."""
    order = np.lexsort((doc, lo, hi))
    h, l = hi[order], lo[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
    return order, new, np.cumsum(new) - 1


def _chunk_table(row) -> tuple:
    """Distinct chunk names of a block with their smallest doc_id, in bucket order, and how each chunk maps to them."""
    ids = np.frombuffer(row["ids"], np.int64)
    off = np.concatenate([[0], np.cumsum(np.frombuffer(row["lens"], np.int64))])
    starts = np.frombuffer(row["extra_pos"], np.int64)
    names = np.frombuffer(row["extra"], np.uint64).reshape(-1, 2)
    doc, ends = _chunk_ends(starts, off)
    order, new, number = _least(names[:, 0], names[:, 1], ids[doc])
    which = np.empty(len(order), np.int64)
    which[order] = number
    first = order[new]
    return starts, ends, ids[doc], names[first, 0], names[first, 1], ids[doc][first], which


def _rows(out: list[dict], schema: pa.Schema):
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


_ASK = pa.schema([("block_id", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary())])


def _chunk_questions(n_buckets: int):
    def ask(batches):
        for b in batches:
            for row in b.to_pylist():
                _, _, _, hi, lo, least, _ = _chunk_table(row)
                order, bound = X.by_bucket(hi, n_buckets)
                cols = np.stack([hi[order], lo[order], least[order].view(np.uint64)], axis=1)
                yield from _rows([{"block_id": row["block_id"], "bucket": k, "payload": cols[bound[k]:bound[k + 1]].tobytes()}
                                  for k in np.flatnonzero(np.diff(bound)).tolist()], _ASK)
    return ask


def _smaller_elsewhere(hi, lo, doc) -> np.ndarray:
    """True where the same name has a smaller doc."""
    order, new, number = _least(hi, lo, doc)
    d = doc[order]
    least = d[np.flatnonzero(new)][number]
    out = np.empty(len(d), bool)
    out[order] = d > least
    return out


def _chunk_answers(t: pa.Table) -> pa.Table:
    parts = [np.frombuffer(p.as_buffer(), np.uint64).reshape(-1, 3) for p in t["payload"]]
    every = np.concatenate(parts)
    bits = _smaller_elsewhere(every[:, 0], every[:, 1], every[:, 2].view(np.int64)).astype(np.uint8)
    cut = np.cumsum([len(p) for p in parts])[:-1]
    return pa.table({"block_id": t["block_id"], "kind": pa.array([CHUNK] * len(t), pa.int32()), "bucket": t["bucket"],
                     "bits": pa.array([x.tobytes() for x in np.split(bits, cut)], pa.binary())})


def _settled(row, n_buckets: int) -> np.ndarray:
    """Runs (start, end) of positions whose strings all start in a smaller doc_id, from the chunks' answers."""
    starts, ends, doc, hi, _, least, which = _chunk_table(row)
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    order, _ = X.by_bucket(hi, n_buckets)
    yes = np.zeros(len(hi), bool)
    yes[order] = X.joined(row["answers"], CHUNK)
    done = yes[which] | (doc > least[which])
    return np.stack([starts[done], ends[done]], axis=1)


def _open_windows(row, length: int, runs: np.ndarray):
    """Per piece of the block: place, bytes, and which windows of ``length`` are whole and not settled."""
    _, buf, off = X.unpack(row)
    flag = np.zeros(len(buf) + 1, np.int32)
    np.add.at(flag, runs[:, 0], 1)
    np.add.at(flag, runs[:, 1], -1)
    settled = np.cumsum(flag[:-1], dtype=np.int32) > 0
    for lo, hi in C.pieces(off):
        a, b = off[lo], off[hi]
        if b - a >= length:
            whole = np.ones(b - a + length, bool)  # the last length - 1 places of a text start no whole string
            for end in (off[lo + 1:hi + 1] - a).tolist():
                whole[max(0, end - length + 1):end] = False
            yield a, buf[a:b], whole[:b - a - length + 1] & ~settled[a:b - length + 1]


def _ids_at(row, places: np.ndarray) -> np.ndarray:
    off = np.concatenate([[0], np.cumsum(np.frombuffer(row["lens"], np.int64))])
    return np.frombuffer(row["ids"], np.int64)[np.searchsorted(off, places, side="right") - 1]


def _anchors(h: np.ndarray, ok: np.ndarray, width: int) -> np.ndarray:
    """Places of names that are the smallest of some open window."""
    least = np.where(ok, C.sliding(np.minimum, h, width), np.uint64(0))
    pad = np.zeros(width - 1, np.uint64)
    most = C.sliding(np.maximum, np.concatenate([pad, least, pad]), width)
    return np.flatnonzero((most == h) & (most > 0))


def _block_anchors(row, length: int, runs: np.ndarray):
    """Distinct anchor names of a block, whether two of its doc_ids hold each, and the pieces they came from."""
    half = _half(length)
    width = length - half + 1
    parts, names, docs = [], [], []
    for a, buf, ok in _open_windows(row, length, runs):
        if ok.any():
            h = _doubled(buf, half)
            at = _anchors(h & _EVEN, ok, width)
            parts.append((a, h, ok, at))
            names.append(h[at] & _EVEN)
            docs.append(_ids_at(row, a + at))
    name = np.concatenate(names) if names else np.zeros(0, np.uint64)
    doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    order = np.lexsort((doc, name))
    s, d = name[order], doc[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1
    return s[first], d[last] > d[first] if len(s) else np.zeros(0, bool), parts


def _anchor_questions(length: int, n_buckets: int):
    def ask(batches):
        for b in batches:
            for row in b.to_pylist():
                name, _, _ = _block_anchors(row, length, _settled(row, n_buckets))
                order, bound = X.by_bucket(name, n_buckets)
                name = name[order]
                yield from _rows([{"block_id": row["block_id"], "bucket": k, "payload": name[bound[k]:bound[k + 1]].tobytes()}
                                  for k in np.flatnonzero(np.diff(bound)).tolist()], _ASK)
    return ask


#: 96 bits: at 10^13 asked positions the chance of any two different strings under one name is below 10^-3
_NAME = np.dtype([("hi", "<u8"), ("lo", "<u4")])


def _full_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = np.empty(len(left), _NAME)
    out["hi"] = C.mix_pair(left, right, 0)
    out["lo"] = C.mix_pair(left, right, 7) >> np.uint64(32)
    return out


_ASK_FULL = pa.schema([("block_id", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary()),
                       ("place", pa.binary()), ("runs", pa.binary())])


def _full_questions(length: int, n_buckets: int):
    """(bucket, names of full length with their doc_id and place) of the windows still open; the runs known
    already ride on a row of their own per block."""
    half = _half(length)
    width = length - half + 1

    def ask(batches):
        for b in batches:
            for row in b.to_pylist():
                runs = _settled(row, n_buckets)
                name, twice, parts = _block_anchors(row, length, runs)
                order, _ = X.by_bucket(name, n_buckets)
                twice = twice.copy()
                twice[order] |= X.joined(row["answers"], ANCHOR)
                names, docs, places = [], [], []
                for a, h, ok, at in parts:
                    flagged = h & _EVEN
                    flagged[at] |= twice[np.searchsorted(name, flagged[at])].astype(np.uint64)
                    live = np.flatnonzero(ok & ((C.sliding(np.minimum, flagged, width) & np.uint64(1)) > 0))
                    names.append(_full_names(h[live], h[live + length - half]))
                    docs.append(_ids_at(row, a + live))
                    places.append(a + live)
                out = [{"block_id": row["block_id"], "bucket": int(X.bucket_of(np.array([row["block_id"]], np.uint64), n_buckets)[0]), "payload": b"",
                        "place": b"", "runs": runs.astype(np.int64).tobytes()}]
                if names:
                    name, doc, place = map(np.concatenate, (names, docs, places))
                    # inside the block: later doc_ids of a name are known to repeat, the smallest one asks
                    later = _smaller_elsewhere(name["hi"], name["lo"], doc)
                    known = place[later]
                    out[0]["runs"] += np.stack([known, known + 1], axis=1).astype(np.int64).tobytes()
                    name, doc, place = name[~later], doc[~later], place[~later]
                    bucket = X.bucket_of(name["hi"], n_buckets)
                    order = np.argsort(bucket, kind="stable")  # in a bucket by place: small steps, which compress
                    bound = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
                    name, doc, place = name[order], doc[order], place[order]
                    out += [{"block_id": row["block_id"], "bucket": k, "payload": name[i:j].tobytes() + X.steps(doc[i:j]),
                             "place": X.steps(place[i:j]), "runs": None}
                            for k, i, j in zip(range(n_buckets), bound[:-1].tolist(), bound[1:].tolist()) if i < j]
                yield from _rows(out, _ASK_FULL)
    return ask


def _full_answers(t: pa.Table) -> pa.Table:
    names, docs = [], []
    for p in t["payload"]:
        n = len(p.as_buffer()) // (_NAME.itemsize + 8)
        names.append(np.frombuffer(p.as_buffer(), _NAME, n))
        docs.append(X.from_steps(p.as_buffer()[n * _NAME.itemsize:]))
    every = np.concatenate(names)
    hit = _smaller_elsewhere(every["hi"], every["lo"], np.concatenate(docs))
    out, at = [], 0
    for n, place, runs in zip(map(len, names), t["place"], t["runs"]):
        if runs.is_valid:
            out.append(runs.as_py())
        else:
            p = X.from_steps(place.as_buffer())[hit[at:at + n]]
            out.append(np.stack([p, p + 1], axis=1).tobytes())
        at += n
    return pa.table({"block_id": t["block_id"], "runs": pa.array(out, pa.binary())})


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()),
                   ("span_starts", pa.list_(pa.int64())), ("span_ends", pa.list_(pa.int64()))])


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.int64()))


def _cut(length: int):
    null_id = np.iinfo(np.int64).max

    def cut(batches):
        for b in batches:
            for row in b.to_pylist():
                ids, buf, off = X.unpack(row)
                runs = np.frombuffer(b"".join(row["runs"] or ()), np.int64).reshape(-1, 2)
                lens = np.diff(off)
                gone = _covered(runs, off, length)
                first = gone.copy()
                first[1:] &= ~gone[:-1]
                first[off[:-1][lens > 0]] = gone[off[:-1][lens > 0]]
                last = gone.copy()
                last[:-1] &= ~gone[1:]
                last[off[1:][lens > 0] - 1] = gone[off[1:][lens > 0] - 1]
                doc = np.repeat(np.arange(len(ids)), lens)
                s, e = np.flatnonzero(first), np.flatnonzero(last)
                per = np.bincount(doc[s], minlength=len(ids))
                kept = buf[~gone]
                bound = np.concatenate([[0], np.cumsum(np.bincount(doc[~gone], minlength=len(ids)))])
                kept_off = pa.py_buffer(bound.astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64(), mask=ids == null_id), pa.array(lens, pa.int64()),
                    pa.Array.from_buffers(pa.binary(), len(ids), [None, kept_off, pa.py_buffer(kept.tobytes())]),
                    _lists(s - off[doc[s]], per), _lists(e + 1 - off[doc[e]], per)], schema=_KEPT)
    return cut


def _covered(runs: np.ndarray, off: np.ndarray, length: int) -> np.ndarray:
    """Bytes covered by strings that start in ``runs``; starts too near their text's end for a whole
    string (settled chunks hold those too) don't count."""
    doc = np.searchsorted(off, runs[:, 0], side="right") - 1
    end = np.minimum(runs[:, 1], off[doc + 1] - length + 1)
    good = end > runs[:, 0]
    flag = np.zeros(off[-1] + 1, np.int32)
    np.add.at(flag, runs[good, 0], 1)
    np.add.at(flag, end[good] + length - 1, -1)
    return np.cumsum(flag[:-1], dtype=np.int32) > 0


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = 2 << 20) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts in a text with a smaller id.

    Returns doc_id, n_bytes, kept (the remaining bytes), span_starts, span_ends (maximal removed runs, byte
    places in the text). ``length`` is at least 16."""
    if length < 16:
        raise ValueError("length must be at least 16 bytes")
    spark: SparkSession = docs.sparkSession
    n_buckets = 4 * C.shuffle_partitions(spark)
    blocks = X.pack(C.docs_of(docs, id_col, text_col), block_bytes, _chunk_names(length))
    chunk = C.saved(blocks.select("block_id", "ids", "lens", "extra", "extra_pos")
                    .mapInArrow(_chunk_questions(n_buckets), "block_id long, bucket int, payload binary")
                    .groupBy("bucket").applyInArrow(_chunk_answers, "block_id long, kind int, bucket int, bits binary"),
                    "chunk-answers")
    C.release(spark)
    with_chunk = blocks.join(X.answers_by_block(chunk).hint("shuffle_hash"), "block_id", "left")
    asked = with_chunk.mapInArrow(_anchor_questions(length, n_buckets), "block_id long, bucket int, payload binary")
    anchor = C.saved(X.shared_names(asked, ANCHOR), "anchor-answers")
    C.release(spark)
    with_both = blocks.join(X.answers_by_block(chunk.unionByName(anchor)).hint("shuffle_hash"), "block_id", "left")
    full = (with_both.mapInArrow(_full_questions(length, n_buckets),
                                 "block_id long, bucket int, payload binary, place binary, runs binary")
            .groupBy("bucket").applyInArrow(_full_answers, "block_id long, runs binary")
            .groupBy("block_id").agg(F.collect_list("runs").alias("runs")))
    return (blocks.select("block_id", "ids", "lens", "text").join(full.hint("shuffle_hash"), "block_id", "left")
            .mapInArrow(_cut(length), "doc_id long, n_bytes long, kept binary, span_starts array<long>, span_ends array<long>"))


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all of documents, 50 bytes."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), 50)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                      F.size("span_starts").cast("long").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))


QUERIES = {"op1_suffix_array_dedup": op1_suffix_array_dedup}
