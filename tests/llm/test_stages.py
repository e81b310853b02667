"""Stages of the pipeline: rows are judged one by one, whatever ids and columns they have; the whole against a brute-force version."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from sqlweave.llm import common, decontaminate, mixing, quality, sketch_dedup, token_files

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, keep string, epoch string, place string, row_key string, shared_id string, "
          "_key string, _s string, _passes string, _until string, s string, key string, row string, i string, k string, c string, n string, "
          "stays string, named string, contaminated string")
OWN = [f.split()[0] for f in SCHEMA.split(", ")][5:]


def frame(spark, rows):
    """Rows (doc_id, text, source); the columns with names of their own say which row it is."""
    return spark.createDataFrame([(i, t, "en", s, None, *[f"{c}{k}" for c in OWN]) for k, (i, t, s) in enumerate(rows)], SCHEMA).repartition(4)


def shown(df):
    """(doc_id, text, number of the row) of each row; its own columns must all have that number."""
    out = []
    for r in df.collect():
        number = {r[c][len(c):] for c in OWN}
        assert len(number) == 1
        out.append((r.doc_id, r.text, int(number.pop())))
    return sorted(out, key=repr)


def words_of(seed, n=60):
    return " ".join(f"w{seed}x{k}" for k in range(n))


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def groups(rows, size=5):
    """Number of the group of each row: rows whose sets are alike, and rows alike to these."""
    sets = [shingles(t, size) for _, t, _ in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                group[max(x, y)] = min(x, y)
    return [root(x) for x in range(len(rows))]


X, Y, Z = words_of(1), words_of(2), words_of(3)
ROWS = [(1, X, "a"), (1, X, "a"), (2, X, "a"), (2, Y, "b"), (3, Y + " more", "b"), (None, Z, "c"), (None, Z, "c"), (None, words_of(4), None), (7, Z, "c"),
        (8, None, "a"), (8, None, "a"), (9, "", "b"), (9, " ", "b"), (10, None, None), (11, words_of(5), "a"), (11, words_of(5) + " tail", "a"),
        (12, "two words", "b"), (13, "two words", "b"), (-5, words_of(6), "a"), (14, words_of(6), "a"), (14, words_of(7), "a"), (14, words_of(8), "a")]


def test_near_duplicates_by_row(spark):
    kept = shown(sketch_dedup.one_of_each_group(frame(spark, ROWS)))
    group = groups(ROWS)
    by = collections.Counter(group[k] for _, _, k in kept)
    for k, (i, t, _) in enumerate(ROWS):
        if not shingles(t):
            assert (i, t, k) in kept
        else:
            assert by[group[k]] == 1, (i, t)
    best = {g: min((r[0] is None, r[0] or 0) for k, r in enumerate(ROWS) if group[k] == g) for g in group}
    assert all((i is None, i or 0) == best[group[k]] for i, t, k in kept if shingles(t))


@pytest.mark.parametrize("low,high", [(-(1 << 63), 5), (-(1 << 63), (1 << 63) - 1), (0, (1 << 63) - 1)])
def test_near_duplicates_at_the_ends_of_the_numbers(spark, low, high):
    df = frame(spark, [(low, X, "a"), (high, Y, "a"), (3, Z, "a"), (3, Z, "a"), (3, words_of(9), "a")])
    if high - low == (1 << 64) - 1:
        with pytest.raises(ValueError):
            sketch_dedup.one_of_each_group(df).collect()
    else:
        assert sorted(i for i, _, _ in shown(sketch_dedup.one_of_each_group(df))) == sorted([low, high, 3, 3])


def contaminated(text, items):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w, hit = word.findall((text or "").encode().lower()), set()
    for x in items:
        q = word.findall((x or "").encode().lower())
        m = min(13, len(q))
        windows = {tuple(q[k:k + m]) for k in range(len(q) - m + 1)} if m else set()
        for k in range(len(w) - m + 1):
            if tuple(w[k:k + m]) in windows:
                hit.update(range(k, k + m))
    return bool(hit) and 20 * len(hit) >= len(w)


def bench_dir(spark, sf_small, tmp_path, items):
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.read.parquet(f"{sf_small}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_decontamination_by_row(spark, sf_small, tmp_path):
    folder = bench_dir(spark, sf_small, tmp_path, [(1, X), (None, words_of(5)), (3, None)])
    kept = shown(decontaminate.decontaminate_stage(spark, frame(spark, ROWS), folder))
    assert kept == sorted([(i, t, k) for k, (i, t, _) in enumerate(ROWS) if not contaminated(t, [X, words_of(5)])], key=repr)
    assert any(i == 2 for i, _, _ in kept) and not any(t == X for _, t, _ in kept)


def test_quality_and_mixing_leave_columns_alone(spark, sf_small):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_small}/documents.parquet").orderBy("doc_id").limit(60).collect()] + ROWS
    df = frame(spark, rows)
    model = quality.train(df, spark.read.parquet(f"{sf_small}/labels.parquet"))
    bare = spark.createDataFrame([(k, t) for k, (_, t, _) in enumerate(rows)], "doc_id long, text string")
    good = {r.doc_id for r in quality.scored(bare, model).where("keep").collect()}
    assert shown(quality.quality_stage(spark, df, sf_small)) == sorted([(i, t, k) for k, (i, t, _) in enumerate(rows) if k in good], key=repr)
    mixed = mixing.mixing_stage(spark, df, sf_small)
    assert mixed.columns == df.columns
    times = collections.Counter(k for _, _, k in shown(mixed))
    assert set(times) == set(range(len(rows))) and set(times.values()) <= {1, 2}


def test_pipeline_by_brute_force(spark, sf_small, tmp_path):
    """Each stage on what the stages before it kept: groups, windows, budgets and ids worked out in Python."""
    from tokenizers import Tokenizer
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").orderBy("doc_id").limit(120).collect()
    rows = [(r.doc_id, r.text, r.source) for r in docs] + ROWS + [(20_000 + n, docs[n].text + " tail", "copy") for n in range(30)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()] + [(None, X)]
    folder = bench_dir(spark, sf_small, tmp_path, [(int(k), t) if i is not None else (None, t) for k, (i, t) in enumerate(items)])
    df = frame(spark, rows)
    kept = {}
    at = df
    for name, stage in P.STAGES:
        at = common.saved(stage(spark, at, folder), "stage")
        kept[name] = at
    names = [n for n, _ in P.STAGES]
    model = quality.train(df, spark.read.parquet(f"{folder}/labels.parquet"))
    bare = spark.createDataFrame([(k, t) for k, (_, t, _) in enumerate(rows)], "doc_id long, text string")
    good = {r.doc_id for r in quality.scored(bare, model).where("keep").collect()}
    first = [k for _, _, k in shown(kept[names[0]])]
    assert sorted(first) == sorted(good)

    own = [rows[k] for k in sorted(first)]
    group = dict(zip(sorted(first), groups(own)))
    second = [k for _, _, k in shown(kept[names[1]])]
    for k in first:
        alike = [j for j in second if group[j] == group[k]]
        assert len(alike) == 1
        assert (rows[alike[0]][0] is None, rows[alike[0]][0] or 0) == min((rows[j][0] is None, rows[j][0] or 0) for j in first if group[j] == group[k])
    third = [k for _, _, k in shown(kept[names[2]])]
    assert sorted(third) == sorted(k for k in second if not contaminated(rows[k][1], [t for _, t in items]))
    fourth = collections.Counter(k for _, _, k in shown(kept[names[3]]))
    assert set(fourth) == set(third) and set(fourth.values()) <= {1, 2}
    # every source at least once, none more than twice; the shares are a power of the sources' token shares
    tokens = collections.Counter()
    for k in third:
        tokens[rows[k][2] or ""] += len((rows[k][1] or "").split())
    taken = collections.Counter()
    for k, n in fourth.items():
        taken[rows[k][2] or ""] += n * len((rows[k][1] or "").split())
    most = max(tokens.values())
    exponent = max(0.0, 1 + np.log(2) / np.log(min(t for t in tokens.values() if t) / most)) if len(set(tokens.values())) > 1 else 0.0
    for s, t in tokens.items():
        largest = max(len((rows[k][1] or "").split()) for k in third if (rows[k][2] or "") == s)
        quota = most * (t / most) ** exponent if t else 0
        assert t <= taken[s] <= max(t, quota + 1) and taken[s] > min(2 * t, quota) - largest - 1, s
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    crc = collections.Counter()
    for k, n in fourth.items():
        ids = np.array(tok.encode(rows[k][1] or "", add_special_tokens=False).ids + [0], "<u4")
        crc[(rows[k][0], len(ids), zlib.crc32(ids.tobytes()))] += n
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in kept[names[4]].collect()) == crc
