"""Near-duplicate passages by compact windows.

A passage is ``words`` (50) or more words. Under a hash function over five-word shingles, the passages whose smallest shingle is the same
one form a compact window: a node of the Cartesian tree over the hashes, from the last smaller hash before to the first one after. Cut at passages of exactly
``words`` words, a window is a run of starts; the runs of two functions are joined where they overlap, and a run keeps the pair of smallest
shingles as its signature. There are four such pairs, so a passage with Jaccard similarity 0.8 meets its copy in one of them with probability 0.98 at
each start, and an exact copy always.

Signatures that only one block of documents holds leave first (``exchange``); each remaining run is linked with the run of the smallest doc_id of its
signature, aligned at the smallest shingle. Runs of a pair of documents with one alignment are merged, and verified: a start counts where its
window's set of shingles and that of the other document's window at that alignment have a Jaccard similarity of 0.8 or more.

So a group of copies gives a link per member, not per pair. Runs with starts that no link has covered are then compared, inside tasks, with every run of their signature
of a smaller doc_id, until each start is covered or no run is left; only the passages found come out. Windows that share too few shingles with all of the others for
any similarity of 0.8 leave first, equal runs count as one, and signatures of more than ``BLOCK`` runs are dealt as pairs of blocks. What windows and runs have in common
is counted by products of matrices, runs of small doc_ids first; only where enough is in common are two runs compared. The products still grow with the square of a
signature's different runs that stay open; all else doesn't.

Defined results: null texts and texts of fewer words have no passages; rows with null ids take no part, rows that share an id are never compared with one another;
an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import exchange as X

SHINGLE, PAIRS, RUNS = 5, 4, 9
#: runs of a signature compared in one task
BLOCK = 4096
_NULL_ID = np.iinfo(np.int64).max


def _shingled(buf: np.ndarray, off: np.ndarray):
    word, doc, _, _ = C.words(buf, off)
    return C.shingles(word, doc, len(off) - 1, SHINGLE)[:2]


_ODD = C.mix(np.arange(1, 2 * PAIRS + 1, dtype=np.uint64)) | np.uint64(1)


def _ranked(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th order of scrambled 64-bit numbers, as the upper half of a product."""
    return ((h ^ (_ODD[k] << np.uint64(1))) * _ODD[k] >> np.uint64(32)).astype(np.uint32)


def runs_of(h: np.ndarray, doc: np.ndarray, n_docs: int, width: int):
    """Runs of starts with one signature: (signature, pair, text number, first start, last start, place of the smallest shingle)."""
    out = []
    if len(h) >= width:
        begin = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n_docs))])
        whole = doc[:len(h) - width + 1] == doc[width - 1:]
        starts = np.flatnonzero(whole)
        if len(starts):
            edge = np.ones(len(starts), bool)
            for pair in range(PAIRS):
                ha = _ranked(h, 2 * pair)
                a = C.sliding(np.minimum, ha, width)[starts].astype(np.uint64)
                b = C.sliding(np.minimum, _ranked(h, 2 * pair + 1), width)[starts].astype(np.uint64)
                edge[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (starts[1:] != starts[:-1] + 1) | (doc[starts[1:]] != doc[starts[:-1]])
                first = np.flatnonzero(edge)
                last = np.append(first[1:], len(starts)) - 1
                d = doc[starts[first]]
                out.append((C.mix_pair(a[first], b[first], pair), d, starts[first] - begin[d], starts[last] - begin[d], starts[first], ha))
    return out


def _smallest_at(ha: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Offset of the smallest hash in the windows that start at ``at``."""
    return np.concatenate([np.lib.stride_tricks.sliding_window_view(ha, width)[at[k:k + 4096]].argmin(axis=1)
                           for k in range(0, len(at), 4096)]) if len(at) else np.zeros(0, np.int64)


def _block_runs(row, width: int):
    ids, buf, off = X.unpack(row)
    for lo, hi in C.pieces(off):
        h, doc = _shingled(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        for run in runs_of(h, doc, hi - lo, width):
            yield ids[lo:hi], run


def _ask(width: int, n_buckets: int):
    def rows(batches):
        for b in batches:
            for row in b.to_pylist():
                names = [run[0] for _, run in _block_runs(row, width)]
                name = np.unique(np.concatenate(names)) if names else np.zeros(0, np.uint64)
                order, bound = X.by_bucket(name, n_buckets)
                name = name[order]
                for k in np.flatnonzero(np.diff(bound)).tolist():
                    yield pa.RecordBatch.from_pydict({"block_id": pa.array([row["block_id"]], pa.int64()), "bucket": pa.array([k], pa.int32()),
                                                      "payload": pa.array([name[bound[k]:bound[k + 1]].tobytes()], pa.binary())})
    return rows


def _shared_runs(width: int, n_buckets: int):
    """Runs whose signature another block, or another document of the block, holds."""
    def rows(batches):
        for b in batches:
            for row in b.to_pylist():
                runs = list(_block_runs(row, width))
                if not runs:
                    continue
                every = np.concatenate([r[0] for _, r in runs])
                docs = np.concatenate([ids[r[1]] for ids, r in runs])
                name, which = np.unique(every, return_inverse=True)
                order, _ = X.by_bucket(name, n_buckets)
                shared = np.zeros(len(name), bool)
                shared[order] = X.joined(row["answers"], RUNS)
                least, most = np.full(len(name), _NULL_ID), np.full(len(name), np.iinfo(np.int64).min)
                np.minimum.at(least, which, docs)
                np.maximum.at(most, which, docs)
                shared |= least < most
                at = 0
                for ids, (sig, d, s, t, place, ha) in runs:
                    on = np.flatnonzero(shared[which[at:at + len(sig)]] & (ids[d] != _NULL_ID))
                    at += len(sig)
                    if len(on):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(sig[on].view(np.int64)), pa.array(ids[d[on]], pa.int64()), pa.array([row["block_id"]] * len(on), pa.int64()),
                            pa.array(s[on].astype(np.int32)), pa.array(t[on].astype(np.int32)),
                            pa.array((s[on] + _smallest_at(ha, place[on], width)).astype(np.int32))],
                            names=["sig", "doc_id", "block_id", "s", "t", "c"])
    return rows


def _wanted_shingles(batches):
    """Shingles (32 bits each) of the wanted documents of a block."""
    for b in batches:
        for row in b.to_pylist():
            ids, buf, off = X.unpack(row)
            wanted = set(row["wanted"])
            for lo, hi in C.pieces(off):
                if wanted.isdisjoint(ids[lo:hi].tolist()):
                    continue
                h, doc = _shingled(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                bound = np.searchsorted(doc, np.arange(hi - lo + 1))
                small = (h >> np.uint64(32)).astype(np.uint32)
                own = [k for k in range(hi - lo) if int(ids[lo + k]) in wanted]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids[lo:hi][own], pa.int64()),
                                                  "h": pa.array([small[bound[k]:bound[k + 1]].tobytes() for k in own], pa.binary())})


def _by_value(x: np.ndarray) -> np.ndarray:
    """Places of x (numbers of 32 bits) in order of value and place."""
    return (np.sort(x.astype(np.uint64) << np.uint64(32) | np.arange(len(x), dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _places_before(x: np.ndarray) -> np.ndarray:
    """For each place the last one before it with the same value, or -1."""
    order = _by_value(x)
    before = np.full(len(x), -1)
    again = x[order[1:]] == x[order[:-1]]
    before[order[1:][again]] = order[:-1][again]
    return before


def _distinct(before: np.ndarray, width: int, step: int = 1, counted: np.ndarray | None = None) -> np.ndarray:
    """Distinct values (of those ``counted``, where given) of each window of ``width``, a window at every ``step``-th place."""
    at = np.arange(len(before))
    n = len(before) - width + 1  # a value counts in the windows that hold it, but not its last place before
    first, last = np.maximum(np.maximum(before, at - width) + 1, 0), np.minimum(at + 1, n)
    on = first < last if counted is None else (first < last) & counted
    return np.cumsum(np.bincount(first[on], minlength=n + 1) - np.bincount(last[on], minlength=n + 1))[:n:step]


def _alike(x: np.ndarray, y: np.ndarray, width: int, percent: int) -> np.ndarray:
    """For each window of x and that of y at the same place: whether their sets of shingles are similar."""
    if np.array_equal(x, y):
        return np.ones(len(x) - width + 1, bool)
    union = _distinct(_places_before(np.stack([x, y], axis=1).ravel()), 2 * width, 2)
    return 100 * (_distinct(_places_before(x), width) + _distinct(_places_before(y), width) - union) >= percent * union


def _alike_each(pairs: list, width: int, percent: int) -> list[np.ndarray]:
    """``_alike`` of many pairs: laid end to end, some 2^18 numbers at a time. Windows across two pairs are counted and left out."""
    out, k = [], 0
    while k < len(pairs):
        j, size = k, 0
        while j < len(pairs) and (j == k or size + len(pairs[j][0]) <= 1 << 18):
            size += len(pairs[j][0])
            j += 1
        good = _alike(*(np.concatenate([p[i] for p in pairs[k:j]]) for i in (0, 1)), width, percent)
        at = 0
        for x, _ in pairs[k:j]:
            out.append(good[at:at + len(x) - width + 1])
            at += len(x)
        k = j
    return out


def _stretches(good: np.ndarray) -> list[tuple[int, int]]:
    flips = np.flatnonzero(np.diff(np.concatenate([[0], good.astype(np.int8), [0]])))
    return list(zip(flips[::2].tolist(), flips[1::2].tolist()))


def _passages(x: np.ndarray, y: np.ndarray, good: np.ndarray, width: int, percent: int):
    """(first word, end) of the passages of x that the good starts make up."""
    words = width + SHINGLE - 1
    for i, j in _stretches(good):
        if _alike(x[i:j - 1 + width], y[i:j - 1 + width], j - i - 1 + width, percent)[0]:
            yield i, j - 1 + words
        else:  # repetitive text: each window is similar, their union isn't; windows side by side hold the same words
            yield from ((k, k + words) for k in [*range(i, j - 1, words), j - 1])


def _aligned(a: np.ndarray, b: np.ndarray, runs, width: int):
    """(first start, alignment, shingles of a, shingles of b) of the merged runs (first start, last start, alignment) that lie in both."""
    merged: list[list[int]] = []
    for shift, s, t in sorted((r[2], r[0], r[1]) for r in runs):
        if merged and merged[-1][0] == shift and s <= merged[-1][2] + 1:
            merged[-1][2] = max(merged[-1][2], t)
        else:
            merged.append([shift, s, t])
    for shift, s, t in merged:
        s, t = max(s, shift, 0), min(t, len(a) - width, len(b) - width + shift)
        if s <= t:
            yield s, shift, a[s:t + width], b[s - shift:t - shift + width]


def verified_spans(texts, width: int, percent: int):
    """(text number, first word, end, alignment) of the passages of a with a near copy in b; texts are (a, b, runs)."""
    found = [(k, *one) for k, (a, b, runs) in enumerate(texts) for one in _aligned(a, b, runs, width)]
    for (k, s, shift, x, y), good in zip(found, _alike_each([f[3:] for f in found], width, percent)):
        for i, j in _passages(x, y, good, width, percent):
            yield k, s + i, s + j, shift


def _verify(width: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("other_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("other_start", pa.int64())])

    def rows(batches):
        for b in batches:
            d, e = (b.column(k).to_pylist() for k in range(2))
            texts = [(np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32), [(r["s"], r["t"], r["shift"]) for r in runs.as_py()])
                     for runs, x, y in zip(*(b.column(k) for k in range(2, 5)))]
            out = [(d[k], e[k], s, t, s - shift) for k, s, t, shift in verified_spans(texts, width, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(5)], schema=schema)
    return rows


_RUN = "sig long, doc_id long, s int, t int, c int, k long, open binary"


def _open_starts(words: int):
    """Runs of a block, with a byte for each start: whether no passage found so far holds it (empty where all are held, and for runs of
    the smallest doc_id of their signature, which have nothing left to be compared with)."""
    def rows(batches):
        for b in batches:
            for block, runs, cover in zip(*(b.column(k) for k in ("block_id", "runs", "cover"))):
                runs = runs.values
                doc, s, t = (runs.field(k).to_numpy() for k in ("doc_id", "s", "t"))
                docs, which = np.unique(doc, return_inverse=True)
                size = np.zeros(len(docs), np.int64)
                np.maximum.at(size, which, t + 2)
                begin = np.concatenate([[0], np.cumsum(size)])
                step = np.zeros(begin[-1] + 1, np.int64)
                if cover.is_valid:
                    d, first, end = (cover.values.field(k).to_numpy() for k in ("doc_id", "start", "end"))
                    at = np.minimum(np.searchsorted(docs, d), len(docs) - 1)
                    on = docs[at] == d
                    at, first, end = at[on], first[on], end[on]
                    np.add.at(step, begin[at] + np.minimum(first, size[at] - 1), 1)
                    np.add.at(step, begin[at] + np.minimum(end - words + 1, size[at] - 1), -1)
                free = np.cumsum(step) <= 0
                count = np.concatenate([[0], np.cumsum(free)])
                lo, hi = begin[which] + s, begin[which] + t + 1
                some = (count[hi] > count[lo]) & runs.field("later").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()] * len(doc), pa.int64()), *(runs.field(k) for k in ("sig", "doc_id", "s", "t", "c", "k")),
                     pa.array([free[i:j].tobytes() if o else b"" for i, j, o in zip(lo.tolist(), hi.tolist(), some.tolist())], pa.binary())],
                    names=["block_id", "sig", "doc_id", "s", "t", "c", "k", "open"])
    return rows


def _with_shingles(width: int):
    """Runs of a block with the shingles of all of their windows."""
    def rows(batches):
        for b in batches:
            for row, runs in zip(b.drop_columns(["runs"]).to_pylist(), b.column("runs")):
                ids, buf, off = X.unpack(row)
                runs = runs.values
                doc, s, t = (runs.field(k).to_numpy() for k in ("doc_id", "s", "t"))
                order = np.argsort(doc, kind="stable")
                for lo, hi in C.pieces(off):
                    h, of = _shingled(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                    bound = np.searchsorted(of, np.arange(hi - lo + 1))
                    small = (h >> np.uint64(32)).astype(np.uint32)
                    left, right = (np.searchsorted(doc[order], ids[lo:hi], side) for side in ("left", "right"))
                    # texts that share an id: a run of one may be cut from another, which is then compared as it is
                    mine = [(r, bound[k] + s[r], bound[k] + t[r] + width) for k in np.flatnonzero(left < right).tolist()
                            for r in order[left[k]:right[k]].tolist() if bound[k] + t[r] + width <= bound[k + 1]]
                    if mine:
                        own = runs.take(pa.array([m[0] for m in mine], pa.int64()))
                        yield pa.RecordBatch.from_arrays(
                            [*(own.field(k) for k in ("sig", "doc_id", "s", "t", "c", "k", "open")),
                             pa.array([small[i:j].tobytes() for _, i, j in mine], pa.binary())],
                            names=["sig", "doc_id", "s", "t", "c", "k", "open", "h"])
    return rows


def _of_equal_runs(table: pa.Table) -> np.ndarray:
    """For each run (in order of doc_id) the first run of its signature with the same shingles at the same alignment, if it has a smaller doc_id; else -1."""
    doc = table["doc_id"].to_numpy()
    turn = table["c"].to_numpy() - table["s"].to_numpy()
    first, out = {}, np.full(len(doc), -1)
    for r, key in enumerate(zip(table["sig"].to_pylist(), turn.tolist(), table["h"].to_pylist())):
        q = first.setdefault(key, r)
        if doc[q] < doc[r]:
            out[r] = q
    return out


#: numbers in a matrix of the comparison; runs that a step of it looks at, the first and the last ones
CELLS, FIRST_RUNS, MOST_RUNS = 1 << 22, 128, 2048


class _Group:
    """Runs of some signatures, in order of signature and doc_id; for each window, what a similar one must share with it."""

    def __init__(self, table: pa.Table, width: int, percent: int):
        self.width, self.percent = width, percent
        self.sig, self.doc, self.s, self.c, self.own = (table[k].to_numpy() for k in ("sig", "doc_id", "s", "c", "own"))
        buf, off = C.binary_arrays(table["h"])
        self.tok, self.off = np.frombuffer(buf.tobytes(), np.uint32), off // 4
        run = self.run = np.repeat(np.arange(len(self.doc)), np.diff(self.off))
        self.of = np.unique(self.sig, return_inverse=True)[1]
        # a name for each shingle of a signature; signatures may share some, which only makes the filters below wider
        name = self.tok + C.mix(self.sig.view(np.uint64)).astype(np.uint32)[run]
        order = _by_value(name)
        new = np.concatenate([[True], name[order[1:]] != name[order[:-1]]])
        number = np.cumsum(new) - 1
        self.name = np.empty(len(name), np.int64)
        self.name[order] = number
        holder = self.doc[run[order]]
        least, most = (op.reduceat(holder, np.flatnonzero(new)) for op in (np.minimum, np.maximum))
        self.several = least < most
        before = _places_before(self.tok)  # one in another run counts as none
        n = _distinct(before, width)
        common = _distinct(before, width, counted=least[self.name] < self.doc[run])
        self.first = np.flatnonzero(run[:len(n)] == run[width - 1:])  # windows inside a run: one for each of its starts
        self.n, self.at, common = n[self.first], run[self.first], common[self.first]
        self.window = np.searchsorted(self.at, np.arange(len(self.doc) + 1))
        self.fewest = np.minimum.reduceat(self.n, self.window[:-1])  # of the windows of each run
        flags, flag_off = C.binary_arrays(table["open"])
        self.open = np.zeros(len(self.at), bool)
        for r in np.flatnonzero(np.diff(flag_off)).tolist():
            self.open[self.window[r]:self.window[r + 1]] = flags[flag_off[r]:flag_off[r + 1]]
        fewest = np.full(self.of.max() + 1, width)
        np.minimum.at(fewest, self.of, self.fewest)
        self.may = (100 * common >= percent * self.n) & ((100 + percent) * common >= percent * (self.n + fewest[self.of[self.at]]))

    def overlap(self, r: int, q: int) -> tuple[int, int, int]:
        """[first, end) of the starts of run r with a start of run q at their alignment; the alignment."""
        turn = int((self.c[r] - self.s[r]) - (self.c[q] - self.s[q]))
        return max(0, turn), int(min(self.window[r + 1] - self.window[r], self.window[q + 1] - self.window[q] + turn)), turn

    def settle(self, wanted: list):
        """Passages at open starts of runs; wanted are (run, its open windows, the runs to compare it with, which window fits which of these).
        Each run is compared with its next one, all at once, until its starts are closed or none is left."""
        while wanted:
            pairs, texts, later = [], [], []
            for r, own, others, fit in wanted:
                use = np.flatnonzero((fit & self.open[own][:, None]).any(axis=0))
                if not len(use):
                    continue
                q = int(others[use[0]])
                lo, hi, turn = self.overlap(r, q)
                if lo < hi:
                    pairs.append((r, q, lo, hi, turn))
                    texts.append(tuple(self.tok[self.off[k] + i:self.off[k] + j - 1 + self.width] for k, i, j in ((r, lo, hi), (q, lo - turn, hi - turn))))
                if len(use) > 1:
                    later.append((r, own, others[use[1:]], fit[:, use[1:]]))
            for (r, q, lo, hi, turn), (x, y), good in zip(pairs, texts, _alike_each(texts, self.width, self.percent)):
                left = self.open[self.window[r]:self.window[r + 1]]
                good = good & left[lo:hi]
                for i, j in _passages(x, y, good, self.width, self.percent):
                    start = int(self.s[r]) + lo + i
                    yield int(self.doc[r]), int(self.doc[q]), start, int(self.s[r]) + lo + j, start - int(self.s[r]) - turn + int(self.s[q])
                left[lo:hi] &= ~good
            wanted = later

    def _members(self, name: np.ndarray, row: np.ndarray, n_rows: int, names: np.ndarray) -> np.ndarray:
        """Which of the names each row holds, as a matrix of 0 and 1."""
        at = np.minimum(np.searchsorted(names, name), len(names) - 1)
        on = names[at] == name
        out = np.zeros((n_rows, len(names)), np.float32)
        out[row[on], at[on]] = 1
        return out

    def wanted(self, a: int, b: int, lo: int, step: int, apart: bool):
        """For the open windows of runs [a, b) of one signature, which runs from ``lo`` on have enough shingles in common with them
        (products of matrices), and the place up to which runs were looked at."""
        part = slice(self.off[a], self.off[b])
        names = np.unique(self.name[part][self.several[self.name[part]]])
        todo = self.window[a] + np.flatnonzero(self.open[self.window[a]:self.window[b]])
        todo = todo[self.doc[self.at[todo]] > self.doc[lo]]
        if not len(todo):
            return b, []
        hi = min(b, lo + max(1, min(step, CELLS // len(names))))
        part = slice(self.off[lo], self.off[hi])
        holds = self._members(self.name[part], self.run[part] - lo, hi - lo, names).T
        size, out = max(1, CELLS // max(len(names), hi - lo)), []
        for k in range(0, len(todo), size):
            own = todo[k:k + size]
            tokens = self.name[self.first[own][:, None] + np.arange(self.width)].ravel()
            common = self._members(tokens, np.repeat(np.arange(len(own)), self.width), len(own), names) @ holds
            r, n = self.at[own], self.n[own].astype(np.float32)
            fit = 100 * common >= self.percent * n[:, None]
            fit &= (100 + self.percent) * common >= self.percent * (n[:, None] + self.fewest[lo:hi].astype(np.float32))
            fit &= self.doc[r][:, None] > self.doc[lo:hi]
            if apart:
                fit &= self.own[r][:, None] != self.own[lo:hi]
            rows = np.flatnonzero(fit.any(axis=1))
            cuts = np.flatnonzero(np.diff(r[rows])) + 1
            for mine in np.split(rows, cuts) if len(rows) else ():
                use = np.flatnonzero(fit[mine].any(axis=0))
                out.append((int(r[mine[0]]), own[mine], lo + use, fit[np.ix_(mine, use)]))
        return hi, out

    def passages(self, apart: bool):
        """Passages at the open starts of all runs; runs of small doc_ids are looked at first, and a start that has found its copy leaves."""
        bounds = np.searchsorted(self.of, np.arange(self.of[-1] + 2))
        left = [(bounds[g], bounds[g + 1], bounds[g]) for g in np.unique(self.of[self.at[self.open]]).tolist()]
        step = FIRST_RUNS
        while left:
            later, found, held = [], [], 0
            for a, b, lo in left:
                hi, some = self.wanted(a, b, lo, step, apart)
                found += some
                held += sum(f[3].size for f in some)
                if hi < b:
                    later.append((a, b, hi))
                if held > 4 * CELLS:
                    yield from self.settle(found)
                    found, held = [], 0
            yield from self.settle(found)
            left, step = later, min(4 * step, MOST_RUNS)


def _compared(width: int, percent: int):
    """Passages at the open starts of runs that have a near copy in a run of the same signature and a smaller doc_id.

    Runs that equal one of a smaller doc_id are linked with that one and compared no further: what is like one of them is like the first."""
    def spans(table: pa.Table) -> pa.Table:
        apart = table["i"][0].as_py() != table["j"][0].as_py()  # pairs of one block have a group of their own
        table = table.take(np.lexsort([table[k].to_numpy() for k in ("s", "doc_id", "sig")]))
        out = []
        equal = _of_equal_runs(table)
        if not apart:
            s, doc = table["s"].to_numpy(), table["doc_id"].to_numpy()
            for r in np.flatnonzero(equal >= 0).tolist():
                left = np.frombuffer(table["open"][r].as_py(), bool)
                q = equal[r]
                out += [(int(doc[r]), int(doc[q]), int(s[r]) + i, int(s[r]) + j + width + SHINGLE - 2, int(s[q]) + i) for i, j in _stretches(left)]
        group = _Group(table.filter(pa.array(equal < 0)), width, percent)
        group.open &= group.may
        out += group.passages(apart)
        every = np.array(sorted(set(out)), np.int64).reshape(-1, 5)
        return pa.table({k: every[:, m] for m, k in enumerate(("doc_id", "other_id", "start", "end", "other_start"))})
    return spans


def _further(blocks: DataFrame, runs: DataFrame, pairs: DataFrame, shingles: DataFrame, spans: DataFrame, words: int, percent: int) -> DataFrame:
    """Passages that the links with the smallest documents have left."""
    spark = runs.sparkSession
    width = words - SHINGLE + 1
    alone = (pairs.groupBy("doc_id").agg(F.min("block_id").alias("block_id"), F.max("last_block").alias("last_block")).where("block_id = last_block")
             .join(shingles.groupBy("doc_id").count().where("count = 1"), "doc_id", "left_semi"))  # an id of several texts says nothing of each
    cover = (spans.join(alone.select("doc_id", "block_id"), "doc_id").groupBy("block_id")
             .agg(F.collect_list(F.struct("doc_id", "start", "end")).alias("cover")))  # passages of one block
    several = runs.groupBy("sig").agg(F.count("*").alias("k"), F.min("doc_id").alias("least")).where("k > 2")
    by_block = (runs.join(several, "sig").withColumn("later", F.col("doc_id") > F.col("least"))
                .groupBy("block_id").agg(F.collect_list(F.struct("sig", "doc_id", "s", "t", "c", "k", "later")).alias("runs")))
    placed = C.saved(by_block.join(cover, "block_id", "left").mapInArrow(_open_starts(words), "block_id long, " + _RUN), "open-runs")
    C.release(spark)
    # a run is compared with smaller doc_ids only: those of no open one's are done with
    last = placed.where("length(open) > 0").groupBy("sig").agg(F.max("doc_id").alias("last"))
    left = placed.join(last, "sig").where("length(open) > 0 OR doc_id < last")
    again = left.groupBy("block_id").agg(F.collect_list(F.struct("sig", "doc_id", "s", "t", "c", "k", "open")).alias("runs"))
    members = C.saved(blocks.join(again.hint("shuffle_hash"), "block_id").mapInArrow(_with_shingles(width), _RUN + ", h binary"), "open-members")
    C.release(spark)
    groups = members.count() // BLOCK + 1
    own = F.pmod(F.xxhash64("h", F.col("c") - F.col("s")), F.col("blocks")).cast("int")  # equal runs meet in one block
    dealt = (members.withColumn("blocks", F.ceil(F.col("k") / BLOCK).cast("int")).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.when(F.col("blocks") > 1, F.col("sig")).otherwise(F.pmod(F.xxhash64("sig"), F.lit(groups))).alias("g"), "blocks",
                     F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "sig", "doc_id", "s", "c", "open", "h"))
    return dealt.groupBy("g", "blocks", "i", "j").applyInArrow(
        _compared(width, percent), "doc_id long, other_id long, start long, end long, other_start long").distinct()


def near_duplicate_passages(docs: DataFrame, words: int = 50, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                            block_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, other_id, start, end, other_start: words [start, end) of doc_id have a near copy at other_start of other_id, a smaller id."""
    spark = docs.sparkSession
    width = words - SHINGLE + 1
    n_buckets = 4 * C.shuffle_partitions(spark)
    blocks = X.pack(C.docs_of(docs, id_col, text_col), block_bytes)
    asked = blocks.mapInArrow(_ask(width, n_buckets), "block_id long, bucket int, payload binary")
    answers = C.saved(X.shared_names(asked, RUNS), "run-answers")
    C.release(spark)
    runs = C.saved(blocks.join(X.answers_by_block(answers).hint("shuffle_hash"), "block_id", "left").mapInArrow(
        _shared_runs(width, n_buckets), "sig long, doc_id long, block_id long, s int, t int, c int"), "runs")
    C.release(spark)

    first = runs.groupBy("sig").agg(F.min(F.struct("doc_id", "s", "t", "c", "block_id")).alias("e"))
    shift = F.col("c") - F.col("e.c")
    linked = (runs.join(first, "sig").where(F.col("doc_id") > F.col("e.doc_id")).select(
        "doc_id", F.col("e.doc_id").alias("other_id"), "block_id", F.col("e.block_id").alias("other_block"), shift.alias("shift"),
        F.greatest(F.col("s"), F.col("e.s") + shift).alias("s"), F.least(F.col("t"), F.col("e.t") + shift).alias("t")).where("s <= t"))
    # the runs of a document with one other one: no more than its own
    pairs = C.saved(linked.groupBy("doc_id", "other_id").agg(F.collect_set(F.struct("s", "t", "shift")).alias("runs"),
                                                             F.min("block_id").alias("block_id"), F.max("block_id").alias("last_block"),
                                                             F.min("other_block").alias("other_block")), "pairs")
    wanted = (pairs.select("block_id", "doc_id").unionByName(pairs.select(F.col("other_block").alias("block_id"), F.col("other_id").alias("doc_id")))
              .groupBy("block_id").agg(F.collect_set("doc_id").alias("wanted")))  # ids of one block
    shingles = C.saved(blocks.join(wanted.hint("shuffle_hash"), "block_id").mapInArrow(_wanted_shingles, "doc_id long, h binary"), "shingles")
    C.release(spark)
    spans = C.saved(pairs.select("doc_id", "other_id", "runs").join(shingles.withColumnRenamed("h", "x"), "doc_id")
                    .join(shingles.select(F.col("doc_id").alias("other_id"), F.col("h").alias("y")), "other_id")
                    .select("doc_id", "other_id", "runs", "x", "y")
                    .mapInArrow(_verify(width, percent), "doc_id long, other_id long, start long, end long, other_start long"), "passages")
    C.release(spark)
    return spans.unionByName(_further(blocks, runs, pairs, shingles, spans, words, percent))


def op3_compact_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all of documents, passages of 50 words."""
    return near_duplicate_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"), 50, 80)


QUERIES = {"op3_compact_window_dedup": op3_compact_window_dedup}
