"""Mixing sources by temperature, under a token budget.

Source weights are the sources' token shares to a power, normalised. The exponent is found by bisection (sixteen cuts a round, each round one
aggregate over the sources): the smallest one, so the flattest mixture, whose most repeated source is passed at most ``max_passes`` times, or the
smallest one whose weights have at most ``target_entropy`` (in nats). The latter may lie beyond 1, where large sources gain: its powers of two are tried
first. An entropy below that of the largest sources alone can't be met and is an error. Sums over sources are decimal, so their order doesn't matter.

The weights become whole passes and a partial one. Each pass of a source has its own order: documents lie in ``BLOCKS`` blocks by
a hash, the blocks are permuted by a hash of seed, pass and block, and documents within a block likewise; both hashes make one 63-bit
place. The partial pass takes documents in that order as long as their tokens fit into what the quota leaves. Where it ends is found digit by digit: sums by the next
11 bits of the place, among the documents that share the digits found so far. So no source is sorted or gathered, however large.

Tokens are words (runs without ASCII blanks).

Defined results: null and empty source are one source; a source without tokens is passed once; null texts have no tokens and go with the passes of their source; documents with equal place (repeated
rows) are taken together, or not at all; the budget is cut to max_passes times all tokens; an empty table gives no rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

BLOCKS = 1024
SEED = 42
_DIGIT, _LEVELS = 11, 6
_ALL = (1 << 63) - 1


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def _doc_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def place(key: Column, epoch: Column, seed: int) -> Column:
    """63-bit place in a pass: 21 bits of the block's hash, 42 of the document's."""
    block = F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch, F.pmod(key, F.lit(BLOCKS))), 43)
    return F.shiftleft(block, 42).bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), epoch, key), 22))


def _exact_sum(x: Column) -> Column:
    """Sum of numbers of moderate size that doesn't depend on their order."""
    return F.sum(x.cast("decimal(38,20)")).cast("double")


def _measured(totals: DataFrame, cuts: list[float], measure) -> list[float]:
    """``measure`` of each exponent and its sums over the sources; shares are relative to the largest one, so that no power overflows."""
    least, most = totals.agg(F.min("tokens"), F.max("tokens")).first()
    share = F.col("tokens") / F.lit(float(most))
    sums = totals.agg(*[c for k, a in enumerate(cuts) for c in (
        _exact_sum(F.pow(share, F.lit(a))).alias(f"z{k}"), _exact_sum(F.pow(share, F.lit(a)) * F.log(share)).alias(f"l{k}"))]).first()
    return [measure(a, sums[f"z{k}"], sums[f"l{k}"], least / most) for k, a in enumerate(cuts)]


def _bisected(totals: DataFrame, measure, wanted, lo: float = 0.0, hi: float = 1.0, rounds: int = 9) -> float:
    """The exponent in [lo, hi] where ``measure`` crosses; ``wanted(value)`` holds from it on."""
    for _ in range(rounds):
        cuts = [lo + (hi - lo) * k / 16 for k in range(17)]
        good = [wanted(m) for m in _measured(totals, cuts, measure)]
        first = good.index(True) if True in good else 16
        lo, hi = cuts[max(0, first - 1)], cuts[first]
    return hi


def _of_entropy(totals: DataFrame, target: float) -> float:
    """The smallest exponent whose weights have at most the target entropy; ValueError where none has."""
    def entropy(a, z, l, _):
        return math.log(z) - a * l / z

    def fits(h):
        return h <= target + 1e-12

    powers = [0.0] + [2.0 ** k for k in range(0, 56, 2)]
    good = [fits(h) for h in _measured(totals, powers, entropy)]
    if True not in good:
        raise ValueError(f"no exponent gives an entropy of {target}: the largest sources alone have more")
    first = good.index(True)
    return _bisected(totals, entropy, fits, powers[max(0, first - 1)], powers[first], 12)


def plan_mixture(docs: DataFrame, budget: int | str = "all", max_passes: float = 2.0, target_entropy: float | None = None,
                 seed: int = SEED) -> DataFrame:
    """One row a source: s (source), tokens, weight, passes (whole ones), until (place at which the partial pass ends).

    ``budget`` is a number of tokens, "tokens" (as many as there are) or "all" (the least that passes every source at least once)."""
    slim = C.saved(docs.select(_source().alias("s"), _doc_key().alias("key"), F.coalesce(
        F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n")), "tokens")
    sums = C.saved(slim.groupBy("s").agg(F.sum("n").alias("tokens")), "sources")
    totals = sums.where("tokens > 0")
    all_tokens = int(totals.agg(F.sum("tokens")).first()[0] or 0)
    whole_pass = sums.select("s", "tokens", F.lit(0.0).alias("weight"), F.lit(1).cast("long").alias("passes"), F.lit(0).cast("long").alias("until"))
    if not all_tokens:
        return whole_pass

    asked = float(all_tokens if budget in ("all", "tokens") else min(int(budget), int(max_passes * all_tokens)))
    largest = totals.agg(F.max("tokens")).first()[0]
    if target_entropy is not None:
        exponent = _of_entropy(totals, target_entropy)
    elif budget == "all":
        exponent = _bisected(totals, lambda a, z, l, least: least ** (a - 1), lambda p: p <= max_passes)
    else:
        exponent = _bisected(totals, lambda a, z, l, least: asked / largest * least ** (a - 1) / z, lambda p: p <= max_passes)
    share = F.col("tokens") / F.lit(float(largest))
    z = totals.agg(_exact_sum(F.pow(share, F.lit(exponent)))).first()[0]
    if budget == "all":
        asked = largest * z
    weight = F.pow(share, F.lit(exponent)) / F.lit(z)
    quota = F.floor(weight * F.lit(asked) + F.lit(1e-6)).cast("long")
    passes = totals.select("s", "tokens", weight.alias("weight"), F.floor(quota / F.col("tokens")).cast("long").alias("passes"), quota.alias("quota"))
    passes = C.saved(passes.withColumn("left", F.col("quota") - F.col("passes") * F.col("tokens")).drop("quota"), "passes")

    # the place at which the partial pass ends, digit by digit
    state = passes.select("s", "passes", F.lit(0).cast("long").alias("prefix"), "left", (F.col("left") == 0).alias("done"))
    for level in range(_LEVELS):
        below = 63 - _DIGIT * level
        at = F.shiftrightunsigned("p", below) if level else F.lit(0).cast("long")
        shift = max(0, 63 - _DIGIT * (level + 1))
        size = below - shift
        here = (slim.where("n > 0").join(state.where("NOT done"), "s").withColumn("p", place(F.col("key"), F.col("passes"), seed))
                .where(at == F.col("prefix")).groupBy("s", F.shiftrightunsigned("p", shift).bitwiseAND(F.lit((1 << size) - 1)).alias("digit"))
                .agg(F.sum("n").alias("n")))
        # at most 2,048 digits a source
        upto = here.withColumn("upto", F.sum("n").over(Window.partitionBy("s").orderBy("digit")))
        over = (upto.join(state.select("s", "left"), "s").where("upto > left").groupBy("s")
                .agg(F.min(F.struct("digit", (F.col("upto") - F.col("n")).alias("before"))).alias("first")))
        state = C.saved(state.join(over, "s", "left").select(
            "s", "passes",
            F.when(F.col("done"), F.col("prefix")).when(F.col("first").isNull(), F.lit(_ALL))
            .otherwise(F.shiftleft("prefix", size).bitwiseOR(F.col("first.digit"))).alias("prefix"),
            (F.col("left") - F.coalesce("first.before", F.lit(0))).alias("left"),
            (F.col("done") | F.col("first").isNull()).alias("done")), "mixture")
    until = state.select("s", F.when(F.col("left") < 0, F.lit(0)).otherwise(F.col("prefix")).cast("long").alias("until"))
    return passes.select("s", "tokens", "weight", "passes").join(until, "s").unionByName(whole_pass.where("tokens = 0"))


def _taken(docs: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """row (all columns of docs, so none can clash), epoch and place, once for each pass that takes the row."""
    plan = plan.select("s", "passes", "until")
    planned = docs.select(_source().alias("s"), _doc_key().alias("key"), F.struct("*").alias("row")).join(plan, "s")
    last = F.col("passes") - 1 + (place(F.col("key"), F.col("passes"), seed) < F.col("until")).cast("long")
    rows = planned.withColumn("last", last).where("last >= 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    return rows.select("row", "epoch", place(F.col("key"), F.col("epoch"), seed).alias("place"))


def mixture(docs: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """Rows of docs once for each pass that takes them, with epoch (from 0) and place (order within the epoch), which replace columns of these names."""
    taken = _taken(docs, plan, seed)
    return taken.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("epoch", "place")], "epoch", "place")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document at least once, documents of small sources up to twice; all columns as they were."""
    return _taken(docs, plan_mixture(docs, "all", 2.0), SEED).select("row.*")


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: as many tokens as documents hold, no source passed more than twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixture(docs.select("doc_id", "text", "source"), plan_mixture(docs, "tokens", 2.0)).select("doc_id", "source", "epoch", "place")


QUERIES = {"op2_temperature_mixing": op2_temperature_mixing}
