"""Fill-in-middle against brute force, and the boundary set against sorted lists."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sqlweave.llm import fill_middle as M

AWKWARD = [None, "", "\n", "\n\n\n", "one", "one\n", "a\nb", "a\nb\n", "ñ\r\n é\nß", "holds <P> a mark\nand more", "<S>", "x<M", "<\nS>\n<", "\x00\n\x00",
           "\n" * 70_000, "ab\n" * 60_000, "\n".join("w" * (i % 90) for i in range(4000)), "tail without feed " * 9000]


def brute(doc_id, text, seed=7, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    i, j = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(s in text for s in M.SENTINELS) or h3 % 100 >= fim:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    out, form = (f"<S>{s}<P>{p}<M>{m}", "spm") if h4 % 100 < spm else (f"<P>{p}<S>{s}<M>{m}", "psm")
    return len(units), form, len(p), len(m), out


@pytest.mark.parametrize("fim,spm", [(100, 50), (40, 0), (0, 50)])
def test_against_brute_force(spark, fim, spm):
    rows = [(i, AWKWARD[i % len(AWKWARD)], 1, "row's own") for i in range(4 * len(AWKWARD))]
    rows += [(None, "no\nid\nat all", 2, None), (3, rows[3][1], 1, "row's own"), (3, "same id\nother text", 0, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, output string").repartition(3)
    got = M.fill_in_middle(df, fim_percent=fim, spm_percent=spm, carry=True)
    made = got.withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    want = sorted(((r[0] is None, r[0], *brute(r[0], r[1], fim=fim, spm=spm)) for r in rows), key=repr)
    assert sorted(((r.doc_id is None, r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made), key=repr) == want
    assert all(r.back == (r.row.text or "") for r in made)
    assert sorted((r.row.n, r.row.output or "") for r in made) == sorted((r[2], r[3] or "") for r in rows)


def test_empty_table_and_sentinels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert M.fill_in_middle(empty).count() == 0
    with pytest.raises(ValueError):
        M.fill_in_middle(empty, sentinels=("<a>", "<a>", "<b>"))
    df = spark.createDataFrame([(1, "a\nb\nc\n")], "doc_id long, text string")
    r = M.fill_in_middle(df, sentinels=("[pre]", "[suf]", "[mid]"))
    assert r.select(M.restored(F.col("output"), F.col("form"), ("[pre]", "[suf]", "[mid]"))).first()[0] == "a\nb\nc\n"


def test_boundary_set_selects_every_member():
    rng = np.random.default_rng(3)
    sets = {
        "array": np.sort(rng.choice(65_536, 900, replace=False)),
        "bitmap": np.sort(rng.choice(65_536, 30_000, replace=False)),
        "runs": np.concatenate([np.arange(100, 9_000), np.arange(20_000, 65_536)]),
        "all of them": np.concatenate([np.arange(70_000), 131_072 + np.sort(rng.choice(65_536, 20_000, replace=False)), [1 << 40]]),
    }
    for name, values in sets.items():
        held = M.BoundarySet(values)
        kinds = {k for k, _ in held.groups}
        assert kinds == ({name} if name != "all of them" else {"array", "bitmap", "runs"})
        assert len(held) == len(values)
        for rank in {0, 1, len(values) // 2, len(values) - 1, *rng.choice(len(values), 300).tolist()}:
            assert held.select(rank) == values[rank]
        with pytest.raises(IndexError):
            held.select(len(values))
