"""Source divergence audit against brute force."""

import collections
import random
import re

import pytest

from sqlweave.llm import source_audit as A

SCHEMA = "doc_id long, text string, lang string, source string, term string, n string, idx string"


def brute(rows, min_docs, top):
    groups, docs, count = set(), collections.Counter(), collections.Counter()
    for _, text, lang, source, *_ in rows:
        text, lang, source = text or "", lang or "", source or ""
        groups.add((lang, source))
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        docs.update({(lang, t) for t in set(found)})
        count.update((lang, source, t) for t in found)
    out = []
    for lang, source in groups:
        kept = sorted({t for (l, t), n in docs.items() if l == lang and n >= min_docs}, key=str.encode)
        own = {s: {t: count[lang, s, t] for t in kept} for l, s in groups if l == lang}
        share = lambda c: {t: 1 + (10**9 * (c[t] + 5)) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p, q = share(own[source]), share({t: sum(c[t] for c in own.values()) for t in kept})
        pairs = [(sum(abs(p[t] - r) for t, r in share(c).items()), s) for s, c in own.items() if s != source]
        terms = [(p[t] - q[t], t) for t in kept if own[source][t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def rows_of(seed):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(150)] + ["Ünï", "ünï", "ABC", "日本", "é", "z" * 300, "\u0080", "😀x"]
    rows = []
    for i in range(260):
        lang = rng.choice(["en", "en", "en", "fr", "", None, "oddü"])
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", "", None, "ä", "Z", "e f"])
        weight = [1 / (1 + (k + len(source or "")) % 40) for k in range(len(words))]
        text = rng.choice([" ", ", ", "1", "\n"]).join(rng.choices(words, weight, k=rng.choice([0, 1, 5, 40, 200])))
        rows.append((i, rng.choice([text, text, text, None, ""]), lang, source, "x", "y", None))
    rows += [rows[7]] * 5 + [(None, "waa WAA wab", "en", "only here", None, None, None), (9_000, "12 34 !", "xx", "no terms", None, None, None),
                             (9_001, "", "xx", "none either", None, None, None), (9_002, "waa " * 50_000, "fr", "a", None, None, None)]
    return rows


@pytest.mark.parametrize("min_docs,top,tile,limit", [(30, 50, 256, 1 << 25), (3, 7, 2, 0), (1, 50, 3, 1 << 25), (10_000, 50, 2, 0)])
def test_against_brute_force(spark, min_docs, top, tile, limit):
    rows = rows_of(min_docs)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = A.divergence(df, min_docs=min_docs, top=top, tile=tile, broadcast_bytes=limit)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, min_docs, top)


def test_empty_table(spark):
    assert A.divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ties_at_the_last_rank_are_cut_in_utf8_order(spark):
    """60 terms of one cell: the first ranks go by their bytes."""
    terms = [f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(55)] + ["é", "ÿ", "tzzé", "～", "😀"]
    rows = [(i, " ".join(terms) if i < 30 else "common words", "en", "s" if i < 30 else "o", None, None, None) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [r.item for r in A.divergence(df).where("part = 'term' and source = 's'").orderBy("rank").collect()]
    assert got == sorted(terms, key=str.encode)[:50]


def test_counts_past_a_long(spark):
    from pyspark.sql import functions as F
    n, total, v = 9_000_000_000_000_000, 9_100_000_000_000_000, 1_000_000
    got = spark.range(1).select(A.share(F.lit(n), F.lit(total), F.lit(v)), A.share(F.lit(0), F.lit(0), F.lit(0))).first()
    assert tuple(got) == (1 + 10**9 * (n + 5) // (total + 5 * v), None)
