"""Token-id files: one zstandard frame a document, under a dictionary trained on serialised id arrays.

Layout below one folder, written and read by Spark:

* ``dictionary``  one row: sha256 of the dictionary, its bytes (empty where too little text was there to train on);
* ``shards``      one row a shard: part, shard, and ``content``, the bytes of the shard;
* ``parts``       one row a part: tokens of all parts before it (parts are in doc_id order).

A shard's content, little endian: magic ``TOKSHRD1``, sha256 of the dictionary (32 bytes), number of documents n (u64), tokens
of the part before this shard (u64), then the offset index: n doc ids (i64), n token counts (u64), n + 1 frame offsets (u64, from
the end of the index), then the frames. A frame holds a document's ids as unsigned 32-bit numbers. One document is read by
its offsets, without the others (``read_document``).

The dictionary is trained on the whole id arrays of the ``sample_docs`` documents whose ids hash lowest; everything else covers all rows.

Defined results: null texts are empty and hold the end id alone; a null doc_id sorts last and comes back null; rows that share
a doc_id are in order of a hash of their texts; an empty table writes files without shards."""

from __future__ import annotations

import codecs
import functools
import hashlib
import itertools
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlweave.session import scratch_path

from . import common as C

MAGIC = b"TOKSHRD1"
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
SAMPLE_DOCS = 512
DICT_BYTES = 64 << 10
SHARD_TOKENS = 1 << 18
_CACHE_ENTRIES = 300_000
# Text encoded at once: words that come again in it are looked up once.
_CALL_BYTES = 1 << 22
_SIGNS = '.,;:!?|*&%$#"()[]{}<>=+-_/\\@~^`'
_NULL_ID = np.iinfo(np.int64).max

# In byte-level BPE a white space character between others is a piece of its own or, if it is a blank before a word, leads that
# word's piece; so texts can be cut at blanks and line ends and the words looked up. Only runs of three, runs that end a text and
# other kinds of white space, and the special token, go to the tokenizer whole.
_WHOLE = r"[ \n][ \n][ \n]|[ \n][ \n]\z"
_OTHER_BLANKS = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
_SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, each with the end id. Arrow cuts the texts into units, finds the different
    ones and looks them up in those seen before; the others are encoded, and the ids put where a unit occurs.

    A unit is a word with the blank before it (held as the word), or a line's first word with the line end before it (held as both)."""

    def __init__(self, name: str = TOKENIZER):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenize = self.tokenizer.model.tokenize
        self.line = self.whole("\n")
        self.end = [END_ID]
        self.signs: dict[str, list[int]] = {}
        # how byte-level BPE shows bytes: the printable ones as they are, the others from U+0100 on, in order
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        others = iter(range(0x100, 0x200))
        self.shown = "".join(chr(b if b in printable else next(others)) for b in range(256))
        # units seen before: where their ids start in ids, how many they are (-1: not to be cut), and whether they came in a later call
        self.units, self.again = pa.array([], pa.large_string()), np.zeros(0, bool)
        self.start, self.n, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encoded(self, unit: str) -> list[int] | None:
        """Ids of a unit; None if it holds white space other than blanks and line ends."""
        if unit.isalpha() and unit.isascii():  # letters are one piece of byte-level BPE: they go straight to the model
            return [t.id for t in self.tokenize("\u0120" + unit)]
        first = unit.startswith("\n")
        word = unit[1:] if first else unit
        stem = word.rstrip(_SIGNS)
        if not stem.isalpha() or not (stem.isascii() or max(stem) < "\u0250"):
            if _OTHER_BLANKS.search(word):
                return None
            return self.line + self.whole(word) if first else self.whole(" " + word)
        seen = stem if stem.isascii() else codecs.charmap_decode(stem.encode(), "strict", self.shown)[0]
        ids = [t.id for t in self.tokenize(seen if first else "\u0120" + seen)]
        if len(stem) < len(word):  # letters, then signs, are two pieces
            signs = word[len(stem):]
            if signs not in self.signs:
                self.signs[signs] = self.whole(signs)
            ids += self.signs[signs]
        return self.line + ids if first else ids

    def __call__(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        texts = pc.fill_null(texts, "")
        whole = pc.or_(pc.match_substring(texts, _SPECIAL), pc.match_substring_regex(texts, _WHOLE))
        found = iter(self._by_units(texts.filter(pc.invert(whole))))
        out = [None if w else next(found) for w in whole.to_pylist()]
        raw = lambda ids: np.array(ids, "<u4").tobytes()
        end = raw(self.end)
        return [(raw(self.whole(texts[k].as_py())) if ids is None else ids) + end for k, ids in enumerate(out)]

    def _by_units(self, texts: pa.Array) -> list[bytes | None]:
        """Ids without the end id; None where a text has a unit that is not to be cut."""
        if not len(texts):
            return []
        # each line, the first too, starts with a unit that holds a line end; the first one's is left out again below
        none, line = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
        marked = pc.binary_join_element_wise(none, pc.replace_substring(texts, "\n", " \n"), line)
        cut = pc.split_pattern(marked, " ")
        found = cut.flatten().dictionary_encode()
        at, unit = cut.offsets.to_numpy(), self._numbers(found.dictionary)[found.indices.to_numpy()]
        odds = np.concatenate([[0], np.cumsum(self.n[unit] < 0)])[at]
        n = np.maximum(self.n[unit], 0)
        ends = np.concatenate([[0], np.cumsum(n)])
        raw = self.ids[np.repeat(self.start[unit] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        ends, skip = 4 * ends[at], 4 * len(self.line)
        if len(self.units) > _CACHE_ENTRIES:
            self._forget()
        return [None if o else raw[lo + skip:hi] for o, lo, hi in zip(np.diff(odds).tolist(), ends[:-1].tolist(), ends[1:].tolist())]

    def _numbers(self, units: pa.Array) -> np.ndarray:
        """The places of different units among those seen before, which new ones are added to."""
        number = pc.fill_null(pc.index_in(units, value_set=self.units), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.again[number[number >= 0]] = True
        new = np.flatnonzero(number < 0)
        number[new] = len(self.units) + np.arange(len(new))
        texts = units.take(pa.array(new))
        ids = list(map(self.encoded, texts.to_pylist()))
        n = np.array([-1 if i is None else len(i) for i in ids], np.int64)
        flat = np.fromiter(itertools.chain.from_iterable(i for i in ids if i), "<u4")
        held = np.maximum(n, 0)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(held) - held])
        self.units, self.n = pa.concat_arrays([self.units, texts]), np.concatenate([self.n, n])
        self.ids, self.again = np.concatenate([self.ids, flat]), np.concatenate([self.again, np.zeros(len(new), bool)])
        return number

    def _forget(self) -> None:
        """Keeps units that came again since the last time, at most half as many as there may be."""
        kept = np.flatnonzero(self.again)[:_CACHE_ENTRIES // 2]
        held = np.maximum(self.n[kept], 0)
        start = np.cumsum(held) - held
        self.ids = self.ids[np.repeat(self.start[kept] - start, held) + np.arange(held.sum())]
        self.units, self.start, self.n = self.units.take(pa.array(kept)), start, self.n[kept]
        self.again = np.zeros(len(kept), bool)


@functools.cache
def encoder(name: str) -> Encoder:
    """One a worker process: reading the tokenizer's file takes as long as encoding a megabyte of text."""
    return Encoder(name)


def _dictionary(docs: DataFrame, tokenizer: str, sample_docs: int) -> bytes:
    """Trained in one task on at most ``sample_docs`` documents; empty where training is impossible."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    sample = docs.join(F.broadcast(ids), "doc_id", "left_semi").orderBy("doc_id", F.xxhash64("text")).limit(sample_docs)

    def train(batches):
        encode = encoder(tokenizer)
        arrays = [a for b in batches for a in encode(b.column(0))]
        try:
            made = zstandard.train_dictionary(DICT_BYTES, arrays).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too few or too short arrays
            made = b""
        yield pa.RecordBatch.from_pydict({"d": pa.array([made], pa.binary())})

    got = sample.select("text").coalesce(1).mapInArrow(train, "d binary").collect()
    return bytes(got[0].d) if got else b""


def shard_content(ids, counts, frames, before: int, dict_hash: bytes) -> bytes:
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8")
    return b"".join([MAGIC, dict_hash, np.array([len(ids), before], "<u8").tobytes(), np.asarray(ids, "<i8").tobytes(),
                     np.asarray(counts, "<u8").tobytes(), offsets.tobytes(), *frames])


def shard_index(content: bytes, dict_hash: bytes):
    """(doc ids, token counts, tokens before, frame offsets from the start of the content); checks the header."""
    if content[:8] != MAGIC or content[8:40] != dict_hash:
        raise ValueError("not a shard written with this dictionary")
    n, before = np.frombuffer(content, "<u8", 2, 40).tolist()
    ids = np.frombuffer(content, "<i8", n, 56)
    counts = np.frombuffer(content, "<u8", n, 56 + 8 * n)
    offsets = np.frombuffer(content, "<u8", n + 1, 56 + 16 * n).astype(np.int64) + 56 + 24 * n + 8
    return ids, counts, before, offsets


def _decompressor(dictionary: bytes):
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def read_document(content: bytes, dictionary: bytes, doc_id: int) -> np.ndarray:
    """Ids of one document of a shard, from its own frame."""
    ids, _, _, offsets = shard_index(content, hashlib.sha256(dictionary).digest())
    k = int(np.flatnonzero(ids == doc_id)[0])
    return np.frombuffer(_decompressor(dictionary).decompress(content[offsets[k]:offsets[k + 1]]), "<u4")


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encode all of docs into token files below ``path``, in ascending doc_id order."""
    spark = docs.sparkSession
    docs = C.docs_of(docs, id_col, text_col)
    dictionary = _dictionary(docs, tokenizer, sample_docs)
    dict_hash = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(dict_hash.hex(), dictionary)], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def shards(batches):
        encode = encoder(tokenizer)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=1)  # else each frame would digest the dictionary anew
        packer = zstandard.ZstdCompressor(level=1, dict_data=shared)
        part, shard, before, held = TaskContext.get().partitionId(), 0, 0, 0
        ids, counts, frames = [], [], []

        def row():
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int64()),
                "tokens": pa.array([held], pa.int64()),
                "content": pa.array([shard_content(ids, counts, frames, before, dict_hash)], pa.binary())})

        for b in batches:
            off = C.binary_arrays(b.column(1))[1]
            for lo, hi in C.pieces(off, _CALL_BYTES):
                doc_ids = C.id_array(b.column(0).slice(lo, hi - lo)).tolist()
                for doc_id, raw in zip(doc_ids, encode(b.column(1).slice(lo, hi - lo))):
                    ids.append(doc_id)
                    counts.append(len(raw) // 4)
                    frames.append(packer.compress(raw))
                    held += counts[-1]
                    if held >= SHARD_TOKENS:
                        yield row()
                        shard, before, held, ids, counts, frames = shard + 1, before + held, 0, [], [], []
        if ids:
            yield row()

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    n = C.shuffle_partitions(spark)
    (docs.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .mapInArrow(shards, "part int, shard long, tokens long, content binary").write.parquet(f"{path}/shards"))
    # one row a part, not a document: a running sum over them is small at any input size
    sums = spark.read.parquet(f"{path}/shards").groupBy("part").agg(F.sum("tokens").alias("tokens"))
    rows = sorted((r.part, r.tokens) for r in sums.collect())
    starts = np.concatenate([[0], np.cumsum([t for _, t in rows])]).tolist()
    spark.createDataFrame([(p, s) for (p, _), s in zip(rows, starts)], "part int, start long").coalesce(1).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of the files; ``ids`` are unsigned 32-bit bytes. Checks dictionary hash and counts."""
    made = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, dict_hash = bytes(made.dictionary), hashlib.sha256(bytes(made.dictionary)).digest()
    if dict_hash.hex() != made.sha256:
        raise ValueError("the dictionary doesn't fit its hash")

    def documents(batches):
        unpack = _decompressor(dictionary)
        for b in batches:
            for base, value in zip(b.column(0).to_pylist(), b.column(1)):
                content = value.as_py()
                ids, counts, before, offsets = shard_index(content, dict_hash)
                raw = [unpack.decompress(content[i:j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                if any(len(r) != 4 * c for r, c in zip(raw, counts.tolist())):
                    raise ValueError("a frame doesn't hold as many ids as its index says")
                start = base + before + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=ids == _NULL_ID), pa.array(start, pa.int64()),
                                                  pa.array(counts.astype(np.int64)), pa.array(raw, pa.binary())],
                                                 names=["doc_id", "start", "n_tokens", "ids"])

    parts = spark.read.schema("part int, start long").parquet(f"{path}/parts")
    shards = spark.read.schema("part int, shard long, tokens long, content binary").parquet(f"{path}/shards")
    return (shards.join(F.broadcast(parts), "part").select("start", "content")  # one row a part: small
            .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary"))


def token_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write docs as token files and read them back: doc_id, start, n_tokens, ids_crc32."""
    path = scratch_path(spark, "token-files")
    write_tokens(docs, path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: token files of all that is left."""
    return token_rows(spark, docs)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all of documents."""
    return token_rows(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op4_token_files": op4_token_files}
