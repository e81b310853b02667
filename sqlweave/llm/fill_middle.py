"""Fill-in-middle transformation: texts cut at two line boundaries and put into prefix, suffix, middle order.

The boundaries of a text (0 and the byte each line ends at) are a Roaring-style set: positions are grouped by their upper bits; a group of up to 65,536 positions is
an array, a bitmap or a list of runs, whichever takes least; cumulative cardinalities stand beside the groups. The cut after k lines is ``select(k)``: a search of the
cumulative cardinalities finds the group, a local select the position in it. Both cuts of a text come from one call.

The draws are a pure function of the seed and the id, so a task that is run again makes the same cuts. Cuts are made inside tasks, text by text; nothing is shuffled.
``restored`` rebuilds the text from output and form by Spark expressions alone.

Defined results: a null text is empty; an empty text, and one that holds a sentinel, stays plain; a null id draws like an empty id; equal ids draw equal numbers;
repeated rows give equal rows; an empty table gives an empty one. The input's other columns are left out or, with ``carry``, come as one struct column ``row``,
so their names can't clash."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

#: fixed by the query's contract: sentinels before prefix, suffix and middle, and the seed
SENTINELS = ("<P>", "<S>", "<M>")
SEED = 7
SPAN_BITS = 16
_ARRAY, _BITMAP, _RUNS = "array", "bitmap", "runs"


class BoundarySet:
    """A set of ascending whole numbers in groups of 2 ** SPAN_BITS, with select by rank."""

    def __init__(self, positions: np.ndarray):
        high = positions >> SPAN_BITS
        first = np.flatnonzero(np.concatenate([[True], high[1:] != high[:-1]])) if len(high) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(high))
        self.base = high[first] << SPAN_BITS
        self.before = np.concatenate([[0], ends])  # cumulative cardinalities
        self.groups = [self._group((positions[a:b] & ((1 << SPAN_BITS) - 1)).astype(np.uint16)) for a, b in zip(first, ends)]

    @staticmethod
    def _group(low: np.ndarray):
        breaks = np.flatnonzero(np.diff(low.astype(np.int32)) != 1) + 1
        start = np.concatenate([[0], breaks])
        least = min(2 * len(low), (1 << SPAN_BITS) // 8)
        if 4 * len(start) < least:
            return _RUNS, (low[start], np.append(start, len(low)))  # first value of each run, values before it
        if 2 * len(low) <= least:
            return _ARRAY, low
        bits = np.zeros(1 << SPAN_BITS, np.uint8)
        bits[low] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        return _BITMAP, (words, np.concatenate([[0], np.cumsum(np.bitwise_count(words))]))

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, rank: int) -> int:
        """The member with ``rank`` smaller ones."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        g = int(np.searchsorted(self.before, rank, side="right")) - 1
        kind, held = self.groups[g]
        local = rank - int(self.before[g])
        if kind == _ARRAY:
            low = int(held[local])
        elif kind == _RUNS:
            run = int(np.searchsorted(held[1], local, side="right")) - 1
            low = int(held[0][run]) + local - int(held[1][run])
        else:
            words, below = held
            word = int(np.searchsorted(below, local, side="right")) - 1
            ones = np.flatnonzero(np.unpackbits(words[word:word + 1].view(np.uint8), bitorder="little"))
            low = 64 * word + int(ones[local - int(below[word])])
        return int(self.base[g]) + low


def line_boundaries(text: np.ndarray) -> BoundarySet:
    """0 and the end of every line of UTF-8 bytes: a line ends behind its line feed or with the text."""
    ends = np.flatnonzero(text == 10) + 1
    if len(text) and text[-1] != 10:
        ends = np.append(ends, len(text))
    return BoundarySet(np.concatenate([[0], ends]))


def _code_points(text: np.ndarray) -> int:
    return int(np.count_nonzero((text & 0xC0) != 0x80))


def _strings(values: list[bytes]) -> pa.Array:
    """Bytes as strings, unchecked: what came in as no UTF-8 goes out the same."""
    b = pa.array(values, pa.binary())
    return pa.StringArray.from_buffers(len(b), b.buffers()[1], b.buffers()[2])


def _rows(batches, marks: tuple[bytes, bytes, bytes]):
    p, s, m = marks
    for b in batches:
        if not b.num_rows:
            continue
        buf, off = C.binary_arrays(b.column("text"))
        h1, h2, forms = b.column("h1").to_numpy(), b.column("h2").to_numpy(), b.column("form").to_pylist()
        for lo, hi in C.pieces(off, 4 * C.PIECE_BYTES):
            n, chars, middles, out = [], [], [], []
            for i in range(lo, hi):
                text = buf[off[i]:off[i + 1]]
                cuts = line_boundaries(text)
                n.append(len(cuts) - 1)
                if forms[i] == "plain":
                    chars.append(None)
                    middles.append(None)
                    out.append(text.tobytes())
                    continue
                a, z = sorted((cuts.select(int(h1[i]) % len(cuts)), cuts.select(int(h2[i]) % len(cuts))))
                prefix, middle, suffix = text[:a], text[a:z], text[z:]
                chars.append(_code_points(prefix))
                middles.append(_code_points(middle))
                parts = (p, prefix, s, suffix, m, middle) if forms[i] == "psm" else (s, suffix, p, prefix, m, middle)
                out.append(b"".join(parts))
            made = [pa.array(n, pa.int64()), pa.array(forms[lo:hi], pa.string()), pa.array(chars, pa.int64()), pa.array(middles, pa.int64()),
                    _strings(out)]
            kept = [c for c in b.schema.names if c in ("doc_id", "row")]
            yield pa.RecordBatch.from_arrays([*(b.column(c).slice(lo, hi - lo) for c in kept), *made],
                                             names=[*kept, "n", "form", "prefix_chars", "middle_chars", "output"])


def _drawn(id_col: str, seed: int, k: int) -> Column:
    """The k-th group of eight hex digits of the hash of seed and id, as a number."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(h, 8 * k - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, fim_percent: int = 100,
                   spm_percent: int = 50, sentinels: tuple[str, str, str] = SENTINELS, carry: bool = False) -> DataFrame:
    """doc_id, n (lines), form (plain, psm or spm), prefix_chars and middle_chars (code points; null if plain), output; with ``carry``, also ``row``."""
    if len(sentinels) != 3 or len(set(sentinels)) != 3 or any(not s or s[0] in t[1:] for s in sentinels for t in sentinels):
        raise ValueError("three different sentinels, whose first signs stand nowhere else in them")
    held = F.lit(False)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    for s in sentinels:
        held = held | F.contains(text, F.lit(s))
    form = (F.when((text == "") | held | (_drawn(id_col, seed, 3) % 100 >= fim_percent), "plain")
            .when(_drawn(id_col, seed, 4) % 100 < spm_percent, "spm").otherwise("psm"))
    # cast to bytes: a text that isn't valid UTF-8 reaches the task as it is
    given = docs.select(F.col(id_col).alias("doc_id"), text.cast("binary").alias("text"), _drawn(id_col, seed, 1).alias("h1"),
                        _drawn(id_col, seed, 2).alias("h2"), form.alias("form"), *([F.struct("*").alias("row")] if carry else []))
    fields = [f for f in given.schema.fields if f.name in ("doc_id", "row")]
    schema = T.StructType([*fields, T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                           T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])
    marks = tuple(s.encode() for s in sentinels)
    return given.mapInArrow(lambda batches: _rows(batches, marks), schema)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``fill_in_middle`` cut. No sentinel stands in the parts, so the first of each kind is the operator's."""
    p, s, m = sentinels
    at = {x: F.locate(x, output) for x in sentinels}

    def between(left: str, right: str | None) -> Column:
        start = at[left] + len(left)
        return F.substr(output, start, at[right] - start) if right else F.substr(output, start)

    return (F.when(form == "psm", F.concat(between(p, s), between(m, None), between(s, m)))
            .when(form == "spm", F.concat(between(p, m), between(m, None), between(s, p))).otherwise(output))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: every document, with hashes of output and restored text."""
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {"op12_fill_in_middle": op12_fill_in_middle}
ORACLE_SQL = {"op12_fill_in_middle": """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS parts, sha256('7:' || doc_id::VARCHAR) AS x FROM documents),
g AS (SELECT *, len(parts) - CASE WHEN t = '' OR ends_with(t, chr(10)) THEN 1 ELSE 0 END AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
  ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM h),
k AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS k1, greatest(h1 % (n + 1), h2 % (n + 1)) AS k2,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
       WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM g),
c AS (SELECT *, least(length(t), coalesce(list_sum(list_transform(parts[1:k1], lambda p: length(p) + 1)), 0))::BIGINT AS a,
  least(length(t), coalesce(list_sum(list_transform(parts[1:k2], lambda p: length(p) + 1)), 0))::BIGINT AS z FROM k),
o AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, z - a) AS middle, substr(t, z + 1) AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM o"""}
