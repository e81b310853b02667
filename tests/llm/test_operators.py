"""Operators of the llm subpackage against brute force, on the smallest tables with the awkward rows added."""

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sqlweave.llm import (common, decontaminate, mixing, passage_dedup, quality, registry, sketch_dedup, suffix_dedup, token_files, topk,
                          url_filter, warc)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block_id string, keep string"
LONG = " ".join(f"wort{i % 997}" for i in range(60_000))
AWKWARD = [(900_001, None), (900_002, ""), (900_003, " \n\t "), (900_004, "one"), (900_005, "one two"), (900_006, LONG), (900_007, LONG + " more"),
           (900_008, "a" * 300), (900_009, "a" * 400), (900_010, "tab\there  x   y z <|endoftext|>"), (None, "no id at all"), (900_011, "no id at all")]


@pytest.fixture(scope="module")
def docs(spark, sf_small):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = rows[:120] + [(i, t, None) for i, t in AWKWARD]
    df = spark.createDataFrame([(i, t, None, s, None, "x", "y") for i, t, s in rows], SCHEMA).repartition(3)
    return df, [(i, t or "") for i, t, _ in rows]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_suffix_dedup(spark, docs):
    df, rows = docs
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, 50, block_bytes=100_000).collect()}
    seen = set()
    for d, t in sorted((d if d is not None else 1 << 62, t) for d, t in rows):
        b = t.encode()
        own = [b[i:i + 50] for i in range(len(b) - 49)]
        gone = bytearray(len(b))
        for i, s in enumerate(own):
            if s in seen:
                gone[i:i + 50] = b"\1" * 50
        seen.update(own)
        r = got[d if d != 1 << 62 else None]
        assert bytes(r.kept) == bytes(x for x, g in zip(b, gone) if not g) and r.n_bytes == len(b)
        assert sum(e - s for s, e in zip(r.span_starts, r.span_ends)) == sum(gone)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, docs, size):
    df, rows = docs
    copies = [(910_000 + i, t + (" tail" if i % 2 else ""), None, None, None, None, None) for i, (_, t) in enumerate(rows[:40])]
    every = rows + [(c[0], c[1]) for c in copies]
    got = sketch_dedup.near_duplicates(df.unionByName(spark.createDataFrame(copies, SCHEMA)), size, 80).collect()
    sets = {}
    for d, t in every:
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        sets[d] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    label = {d: d for d in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a is not None and b is not None and a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {d: (len(s), label[d], label[d] == d) for d, s in sets.items()}
    assert sketch_dedup.near_duplicates(empty(spark)).count() == 0


def test_open_buckets_are_linked_inside_tasks(spark):
    """Families whose members are all alike but not all linked: the last step must still find every link."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.choice(120, 9, replace=False):
            words[k] = f"x{i}_{k}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in sketch_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()}
    sets = [set(zip(t.split(), t.split()[1:])) for _, t in rows]
    parent = list(range(150))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(150):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    assert got == {i: root(i) for i in range(150)}


def test_passages(spark, docs):
    df, rows = docs
    got = passage_dedup.near_duplicate_passages(df, 50, block_bytes=100_000).collect()
    found = collections.defaultdict(set)
    for r in got:
        assert r.other_id < r.doc_id
        found[r.doc_id].update(range(r.start, r.end))
    seen = set()
    for d, t in sorted((d, t) for d, t in rows if d is not None):
        w = t.lower().split()
        own = [tuple(w[i:i + 50]) for i in range(len(w) - 49)]
        missed = {p for i, s in enumerate(own) if s in seen for p in range(i, i + 50)} - found[d]
        assert not missed or d == 900_006, d  # one document may repeat in itself
        seen.update(own)
    assert passage_dedup.near_duplicate_passages(empty(spark)).count() == 0


def changed_passages():
    """Passages of 50, 60 and 80 words inside unlike text, and their copies with a word substituted, inserted or deleted in the middle."""
    n = 0
    for length in (50, 60, 80):
        for kind in ("substituted", "inserted", "deleted"):
            passage = [f"p{n}_{i}" for i in range(length)]
            copy = passage[:length // 2] + ([] if kind == "deleted" else ["other"]) + passage[length // 2 + (kind != "inserted"):]
            yield length, kind, *([f"{side}{n}_{i}" for i in range(30)] + body + [f"{side}{n}_{i}" for i in range(30, 60)]
                                  for side, body in (("x", passage), ("y", copy)))
            n += 1


def jaccard(a, b):
    x, y = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("shift", [-1, 0, 1])
def test_every_window_of_a_run_is_compared(shift):
    rng = np.random.default_rng(5)
    pairs = [(b, a) for _, _, a, b in changed_passages()]
    pairs += [([f"r{k}" for k in rng.integers(0, 3, 150)], [f"r{k}" for k in rng.integers(0, 3, 150)]), (["r"] * 100, ["r"] * 90)]
    for a, b in pairs:
        x, y = (np.array([hash(tuple(w[i:i + 5])) & 0xFFFFFFFF for i in range(len(w) - 4)], np.uint32) for w in (a, b))
        got = {w for _, s, e, k in passage_dedup.verified_spans([(x, y, [(0, len(x), shift)])], 46, 80) for w in range(s, e)}
        good = [i for i in range(max(0, shift), min(len(a), len(b) + shift) - 49) if jaccard(a[i:i + 50], b[i - shift:i - shift + 50]) >= 0.8]
        assert got == {w for i in good for w in range(i, i + 50)}


def test_passages_with_a_changed_word(spark):
    rows, want = [], {}
    for n, (length, kind, a, b) in enumerate(changed_passages()):
        rows += [(2 * n, " ".join(a)), (2 * n + 1, " ".join(b))]
        if any(jaccard(b[i:i + 50], a[j:j + 50]) >= 0.8 for i in range(len(b) - 49) for j in range(len(a) - 49)):
            want[2 * n + 1] = (length, kind)
    got = {r.doc_id for r in passage_dedup.near_duplicate_passages(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect()}
    assert len(want) >= 8 and got == set(want), [want[k] for k in set(want) - got]


@pytest.mark.parametrize("block", [4096, 5])
def test_passages_behind_unlike_variants(spark, monkeypatch, block):
    """Copies whose signatures smaller documents hold with unlike variants of the passage: found all the same."""
    monkeypatch.setattr(passage_dedup, "BLOCK", block)
    rng = np.random.default_rng(2)
    texts = []
    for n in range(12):
        passage = [f"p{n}_{i}" for i in range(50)]
        family = []
        for v in range(12):
            body = list(passage)
            for k in ([] if v >= 10 else rng.choice(np.arange(4, 46), 2, replace=False)):
                body[k] = f"v{n}_{v}_{k}"
            family.append([f"b{n}_{v}_{i}" for i in range(20)] + body + [f"a{n}_{v}_{i}" for i in range(20)])
        texts += family
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    found = collections.defaultdict(set)
    for r in passage_dedup.near_duplicate_passages(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect():
        assert r.other_id < r.doc_id and jaccard(texts[r.doc_id][r.start:r.end], texts[r.other_id][r.other_start:r.other_start + r.end - r.start]) >= 0.8
        found[r.doc_id].update(range(r.start, r.end))
    assert all(found[12 * n + 11] >= set(range(20, 70)) for n in range(12)), [n for n in range(12) if not found[12 * n + 11] >= set(range(20, 70))]


def test_token_files(spark, docs, tmp_path):
    from tokenizers import Tokenizer
    import public_tokenizers
    df, rows = docs
    path = str(tmp_path / "t")
    token_files.write_tokens(df, path)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at = 0
    for r, (d, t) in zip(got, sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    made = spark.read.parquet(f"{path}/dictionary").first()
    shard = spark.read.parquet(f"{path}/shards").orderBy("part").first()
    assert token_files.read_document(bytes(shard.content), bytes(made.dictionary), got[0].doc_id).tobytes() == bytes(got[0].ids)
    with pytest.raises(ValueError):
        token_files.shard_index(bytes(shard.content), b"0" * 32)
    assert token_files.token_rows(spark, empty(spark)).count() == 0


def test_encoder_on_odd_white_space():
    import random
    encode = token_files.Encoder()
    r = random.Random(3)
    parts = [" ", "  ", "   ", "\n", " \n ", "\n\n", "a", "Be", "'s", " 12", "é", "ü!", "<|endoftext|>", "\t", " ", "日本", "\x1f", "​"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 10))) for _ in range(3000)]
    for t, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == encode.tokenizer.encode(t, add_special_tokens=False).ids + [0], repr(t)


def test_encoder_keeps_and_forgets_units(monkeypatch):
    import random
    assert token_files.encoder(token_files.TOKENIZER) is token_files.encoder(token_files.TOKENIZER)
    monkeypatch.setattr(token_files, "_CACHE_ENTRIES", 60)
    encode = token_files.Encoder()
    r = random.Random(7)
    common, sizes, seen = ["the", "and,", "naïve", "x1", "a\tb", "\n", ""], [], []
    encoded = encode.encoded
    encode.encoded = lambda unit: seen.append(unit) or encoded(unit)
    for _ in range(30):
        texts = [" ".join(r.choice(common) if r.random() < 0.5 else "".join(r.choice("abcé.") for _ in range(4)) for _ in range(20)) for _ in range(4)]
        for t, ids in zip(texts + [None], encode(texts + [None])):
            assert np.frombuffer(ids, "<u4").tolist() == encode.tokenizer.encode(t or "", add_special_tokens=False).ids + [0], repr(t)
        sizes.append(len(encode.units))
    assert max(sizes) <= 60 and seen.count("the") < 5  # common units are kept, the number of units held is bounded


def test_decontamination(spark, docs):
    df, rows = docs
    item = " ".join(rows[0][1].split()[2:20])
    unnamed = " ".join(rows[1][1].split()[5:30])
    items = [(1, item), (2, "one two"), (10, None), (11, " ., "), (12, item), (13, "no id"), (None, unnamed)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").encode().lower())
    for most in (1 << 20, 5):
        got = {r.doc_id: r for r in decontaminate.benchmark_hits(df, bench, 13, most).collect()}
        for d, t in rows:
            w, hit, named = split(t), set(), set()
            for i, x in items:
                q = split(x)
                m = min(13, len(q))
                windows = {tuple(q[k:k + m]) for k in range(len(q) - m + 1)} if m else set()
                for k in range(len(w) - m + 1):
                    if tuple(w[k:k + m]) in windows:
                        hit.update(range(k, k + m))
                        named.update([str(i)] if i is not None else [])
            r = got[d]
            assert (r.n_words, {p for s in r.spans for p in range(s.start, s.end)}, r.items) == (len(w), hit, sorted(named))
    assert decontaminate.judged(empty(spark), bench).count() == 0
    assert decontaminate.judged(df, bench.limit(0)).where("contaminated").count() == 0


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(0)
    s = np.concatenate([np.concatenate([rng.integers(1, 4, rng.integers(1, 30)), [0]]) for _ in range(60)])
    index = decontaminate.FMIndex(s, 4)
    for m in (1, 2, 5):
        for _ in range(30):
            w = rng.integers(1, 4, m)
            lo, hi = index.search(np.concatenate([np.zeros(8 - m, np.int64), w])[None, :], np.array([m]))
            want = [i for i in range(len(s) - m + 1) if (s[i:i + m] == w).all()]
            assert sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) == want


def test_mixing(spark, docs):
    df, rows = docs
    for budget in ("tokens", "all", 500):
        plan = mixing.plan_mixture(df, budget, 2.0)
        plan = common.saved(plan, "test-plan")
        by = {r.s: r for r in plan.collect()}
        key = df.withColumn("s", mixing._source()).withColumn("k", mixing._doc_key()).join(plan.drop("tokens"), "s").withColumn("p", mixing.place(F.col("k"), F.col("passes"), mixing.SEED))
        taken = collections.Counter((r.doc_id, r.text) for r in mixing.mixture(df, plan).collect())
        total = sum(r.tokens for r in by.values())
        asked = {"tokens": total, "all": max(r.tokens / r.weight for r in by.values() if r.weight), 500: 500}[budget]
        groups = collections.defaultdict(list)
        for r in key.collect():
            groups[r.s].append(r)
        for s, members in groups.items():
            left = int(by[s].weight * asked + 1e-6) - by[s].passes * by[s].tokens
            assert asked == 500 or by[s].weight * asked <= 2.0001 * by[s].tokens
            used = 0
            for r in sorted(members, key=lambda r: r.p):
                n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
                used += n
                if n:
                    assert taken[(r.doc_id, r.text)] == by[s].passes + (used <= left), (budget, s)
    for target in (1.5, 0.5, 0.01, 99.0):  # the natural one lies between
        share = mixing.plan_mixture(df, "tokens", target_entropy=target).where("weight > 0").collect()
        entropy = -sum(r.weight * np.log(r.weight) for r in share)
        assert abs(entropy - min(target, np.log(len(share)))) < 1e-6 and abs(sum(r.weight for r in share) - 1) < 1e-9
    twins = spark.createDataFrame([(1, "a b", "x"), (2, "c d", "y"), (3, "e", "z")], "doc_id long, text string, source string")
    with pytest.raises(ValueError):  # two equal largest sources have log 2 however large the exponent
        mixing.plan_mixture(twins, "tokens", target_entropy=0.5)
    assert mixing.mixture(empty(spark), mixing.plan_mixture(empty(spark))).count() == 0


def test_quality(spark, sf_small):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 5 != 0"))
    held = quality.scored(docs.withColumn("keep", F.lit("z")), model).join(labels.where("doc_id % 5 = 0"), "doc_id")
    r = held.agg(F.avg(F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.col("keep").cast("int"))).alias("good"),
                 F.avg(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), F.col("keep").cast("int"))).alias("bad")).first()
    assert r.good > 0.97 and r.bad < 0.2
    assert quality.train(docs, labels.limit(0)) is None
    # features and score of some texts, counted in Python
    weights, cuts = model
    some = docs.orderBy("doc_id").limit(40).collect()
    judged = {r.doc_id: r for r in quality.scored(docs.where(F.col("doc_id") <= some[-1].doc_id).select("doc_id", "text"), model).collect()}
    for r in some:
        raw = r.text.encode()
        _, feature = quality.features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        s = float(sum(weights[f] for f in feature))
        tails = [1 / (1 + np.exp(t - s)) for t in cuts]
        assert abs(judged[r.doc_id].expected_grade - sum(tails)) < 1e-5 and judged[r.doc_id].keep == (judged[r.doc_id].p_good >= 0.5)
        assert abs(judged[r.doc_id].p_good - tails[-1]) < 1e-5
        word = re.findall(rb"[0-9a-z\x80-\xff]+", raw.lower())
        sign = re.findall(rb"[^0-9A-Za-z\x80-\xff\x20\x09-\x0D]+", raw)
        assert len(feature) <= len(set(word)) + len(set(sign)) + 6 and len(set(feature.tolist())) == len(feature)
    odd = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert quality.scored(odd, model).count() == 2 and quality.scored(odd, None).where("keep").count() == 2
    assert quality.scored(empty(spark), model).count() == 0


def test_topk(spark):
    from fractions import Fraction
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=20).round(2).tolist()) for i in range(150)] + [(200, None), (220, [1.0, None]), (240, [float("nan")] * 20), (241, [float("inf")]), (280, [])]
    rows += [(260, [1e30] * 3), (261, [-1e30, 1e30, 2.0 ** 60]), (262, [1e30] * 3), (263, [1e308, -1e308] + [1.7e308] * 3), (300, [-1.7e308] * 4), (320, [3e8, 1.0]), (321, [3e8, 2.0])]
    rows += [(400 + i, rows[3][1]) for i in range(30)]
    got = collections.defaultdict(list)
    for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 7).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    ok = {i: [(Fraction(x) * 64).__floor__() for x in v] for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    for q in [i for i in ok if i % 20 == 0]:
        scores = sorted(((-sum(a * b for a, b in zip(ok[q], ok[c])), c) for c in ok if c != q))[:7]
        assert sorted(got[q]) == [(k + 1, c, -s if -(1 << 63) <= -s < 1 << 63 else None) for k, (s, c) in enumerate(scores)], q
    assert any(s is None for r in got.values() for _, _, s in r)
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_branch_and_bound(seed):
    """All block lengths and dimensions against a full sort, with many ties."""
    rng = np.random.default_rng(seed)
    dims, n = (1, 5, 16, 33, 64, 70)[seed], 900
    v = np.floor(64 * rng.normal(size=(dims, n)) * rng.random(n) / (1 + np.arange(dims))[:, None])
    v[:, 300:400] = v[:, :1]
    ids = rng.permutation(n)
    got = collections.defaultdict(list)
    for q, place, score in topk.branch_and_bound(ids[:40], v[:, :40], ids, v, 9):
        got[q].append((-score, ids[place]))
    for q in range(40):
        want = sorted((-int(v[:, q] @ v[:, c]), ids[c]) for c in range(n) if c != q)[:9]
        assert sorted(got[q]) == want


def test_warc(spark, tmp_path):
    big = "x" * 1200
    rows = [(1, "http://a/1", big), (2, "http://a/\r\nX: y", big), (3, None, big), (4, "u", None), (5, "u", "short"), (6, "u", "short"), (None, "u", big), (7, "u", "é" * 600), (8, "u", "\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    got = {r.page_id: r for r in warc.read_archives(spark.read.parquet(path)).collect()}
    for i, _, h in rows:
        p = (h or "").encode()
        target = 3 if h == big and i != 3 else None
        r = got[i]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(p), hashlib.sha1(p).hexdigest(), "revisit" if target else "response", target)
        assert target or bytes(r.payload) == p
    content = bytes(spark.read.parquet(path).first().content)
    (tmp_path / "real").mkdir()
    (tmp_path / "real" / "a.warc.zst").write_bytes(content)
    real = spark.read.format("binaryFile").load(str(tmp_path / "real"))
    assert warc.read_archives(real).count() == len(list(warc.archive_records(content)))
    with pytest.raises(ValueError):
        list(warc.archive_records(content[:-6]))
    raw = warc.record_bytes(1, "u", b"payload", None, "2020-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"payload", b"paylaod"))
    assert base64.b32encode(hashlib.sha1(b"payload").digest()) in raw


def test_warc_of_other_writers(spark, tmp_path):
    """Skippable frames, frames without a content size, uuid ids, other record types, chunked and length-less responses."""
    import zstandard

    def record(kind, n, block, *more):
        head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{n:08d}-0000-4000-8000-000000000000>", "WARC-Date: 2024-01-01T00:00:00Z",
                f"Content-Length: {len(block)}", *more]
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    http = "Content-Type: application/http; msgtype=response"
    sha1 = "WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(b"hello world").digest()).decode()
    records = [record("warcinfo", 1, b"software: x\r\n", "Content-Type: application/warc-fields"),
               record("request", 2, b"GET / HTTP/1.1\r\nHost: a.example\r\n\r\n", "Content-Type: application/http; msgtype=request"),
               record("response", 3, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n6\r\nhello \r\n5\r\nworld\r\n0\r\n\r\n", http, sha1),
               record("response", 4, b"HTTP/1.1 200 OK\r\n\r\nno length", http),
               record("metadata", 5, b"k: v\r\n"),
               record("revisit", 6, b"HTTP/1.1 200 OK\r\n\r\n", http, sha1, "WARC-Refers-To: <urn:uuid:00000003-0000-4000-8000-000000000000>")]
    packer = zstandard.ZstdCompressor(write_content_size=False)
    skip = b"\x50\x2a\x4d\x18\x03\x00\x00\x00abc"
    frames = []
    for r in records:
        stream = packer.compressobj()
        frames += [stream.compress(r) + stream.flush(), skip]
    (tmp_path / "a.warc.zst").write_bytes(skip + b"".join(frames))
    got = {int(r.record_id[10:18]): r for r in warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path / "a.warc.zst"))).collect()}
    assert [got[n].record_type for n in range(1, 7)] == ["warcinfo", "request", "response", "response", "metadata", "revisit"]
    assert bytes(got[3].payload) == b"hello world" and bytes(got[4].payload) == b"no length" and bytes(got[5].payload) == b"k: v\r\n"
    assert got[3].payload_digest == got[6].payload_digest == hashlib.sha1(b"hello world").hexdigest()
    assert got[6].refers_to_id == got[3].record_id and got[6].payload is None and got[3].page_id is None
    with pytest.raises(ValueError):
        list(warc.archive_records(packer.compress(records[2].replace(b"world\r", b"wordl\r"))))


def test_url_filter(spark):
    urls = ["http://Ads.Spam.NET/x", "http://example.net/en/1", "https://a.example.net/en/", "http://example.net/de/", "http://x.example.com/de/1?q", "http://notnet/x",
            "http://b.org/fr/1#x", "http://b.net", None, "nothing", "http://spamads.example.com/en/3", "://", "http://goodnews.example.org/en/5"]
    html = "<p>" + " ".join(["spam ads good news example"] * 50)
    pages = spark.createDataFrame([(i, u, html) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.judged(pages).collect()}
    rules = ["net/", "example.net/en/", "example.net/en/", "net/", "example.com/de/", None, "org/fr/", None, None, None, None, None, None]
    assert [got[i].rule for i in range(len(urls))] == rules
    assert (got[0].host, got[0].path, got[0].verdict) == ("ads.spam.net", "/x", "block") and (got[8].host, got[8].path) == ("", "")
    assert all(r.verdict in ("allow", "block") for r in got.values())
    known = {(0, 4): 50, (4, 3): 50, (0, 5): 1}
    assert url_filter._cut("spamads", known, 300.0) == ["spam", "ads"]
    assert url_filter.judged(pages.limit(0)).count() == 0


def best_cut(label, count, total):
    """Highest log probability of all cuts of a label."""
    best = {0: 0.0}
    for end in range(1, len(label) + 1):
        best[end] = max(best[start] + (np.log(count[label[start:end]] / total) if label[start:end] in count else np.log(10 / total) - (end - start) * np.log(10))
                        for start in range(end))
    return best[len(label)]


def test_segments_are_the_most_probable_ones(spark):
    """Words and unknown stretches of any length, by brute force over all cuts."""
    long_word = "donaudampfschifffahrtsgesellschaft"
    text = ("spam " * 40 + "ads " * 30 + "ad " * 3 + "spa " * 9 + f"{long_word} " * 8 + "good news s pa " * 5).strip()
    count = collections.Counter(text.split())
    labels = ["spamads", "adsspam" + "q" * 45, long_word + "news", "goodnews" + long_word + "x", "zzz", "a", "spas", "q" * 70]
    got = {r.label: r.words for r in url_filter.segmented(spark.createDataFrame([(x,) for x in labels], "label string"),
                                                         spark.createDataFrame([(1, text)], "page_id long, html string")).collect()}
    total = sum(count.values())
    for x in labels:
        assert "".join(got[x]) == x
        value = sum(np.log(count[w] / total) if w in count else np.log(10 / total) - len(w) * np.log(10) for w in got[x])
        assert abs(value - best_cut(x, count, total)) < 1e-6, (x, got[x])
    assert got[long_word + "news"] == [long_word, "news"] and got["q" * 70] == ["q" * 70]


def test_url_verdicts_by_brute_force(spark, sf_small):
    """Naive Bayes over the segmented words, counted anew in Python."""
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    got = url_filter.judged(pages).collect()
    labels = spark.createDataFrame([(x,) for x in sorted({x for r in got for x in re.findall(r"[a-z]+", r.host)})], "label string")
    cut = {r.label: r.words for r in url_filter.segmented(labels, pages).collect()}

    def words(r):
        host = [w for x in re.findall(r"[a-z]+|[^a-z.\-]+", r.host) for w in cut.get(x, [x])]
        return host + ["/" + re.sub("[0-9]", "0", w) for w in re.split(r"[/.\-_]+", r.path.lower()) if w]

    seen = {a: collections.Counter() for a in ("block", "allow")}
    docs = collections.Counter()
    for r in got:
        if r.rule:
            docs[r.verdict] += 1
            seen[r.verdict].update(words(r))
    vocabulary = {w for r in got for w in words(r)} if not docs else set(seen["block"]) | set(seen["allow"])
    sums = {a: sum(seen[a].values()) for a in seen}
    judged = [r for r in got if not r.rule]
    assert judged and docs["block"] and docs["allow"]
    for r in judged:
        score = np.log(docs["block"] / docs["allow"])
        for w in words(r):
            score += np.log((seen["block"][w] + 1) / (sums["block"] + len(vocabulary))) - np.log((seen["allow"][w] + 1) / (sums["allow"] + len(vocabulary)))
        assert abs(score * 1e6 - r.score) < 100 and r.verdict == ("block" if r.score > 0 else "allow"), r


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, sf_small, name):
    from tests.oracle_check import compare, duck
    r = compare(spark, name, registry.queries()[name], registry.oracle_sql()[name], sf_small, duck(sf_small))
    assert r["cols_match"] and r["hash_match"], r


def test_pipeline(spark, sf_small, docs):
    import corpus_pipeline as P
    df, _ = docs
    columns = df.columns
    kept = df
    for name, stage in P.STAGES[:-1]:
        kept = common.saved(stage(spark, kept, sf_small), "stage")
        assert kept.columns == columns, name
    out = P.STAGES[-1][1](spark, kept, sf_small)
    assert out.count() == kept.count() and {r.doc_id for r in out.collect()} <= {r.doc_id for r in df.collect()}
    for _, stage in P.STAGES:
        assert stage(spark, empty(spark), sf_small).count() == 0
