"""URL filter: rules, then word segmentation of hosts and multinomial naive Bayes.

A rule (action, host/path) fits its host and all subdomains where the url's path starts with the rule's; the longest wins. Urls without a rule are
judged by naive Bayes over the words of host and path, trained on the urls that rules decide.

Host labels are concatenated names: a unigram model cuts each into the most probable words (Viterbi). The model counts the words of all pages' html; a
label's substrings, of the lengths that counted words have, meet these counts in a join, so the vocabulary is never sent around, and only distinct labels are
cut. A stretch of m letters, of any length, that is no known word has probability 10 / (N * 10^m), N all words counted.

Hosts, paths and words are handled once each, with counts, so a host or word that a third of all urls share is one row. Weights are whole micro-nats, so sums
don't depend on order.

Defined results: a url that is null or without :// has empty host and path, no rule, and is judged by the prior; without urls of both actions among those that
rules decide, every url without a rule is allowed; null html has no words; repeated rows are judged alike; other columns are ignored."""

from __future__ import annotations

import math
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: fixed by the query's contract
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
_LETTERS = np.zeros(256, bool)
_LETTERS[0x61:0x7B] = True


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty without ://."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(action, rule) of the longest rule that fits; null where none does."""
    action, name = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        action, name = F.when(fits, F.lit(act)).otherwise(action), F.when(fits, F.lit(rule)).otherwise(name)
    return action, name


def _word_counts(batches):
    """Counts of the a-z words, a piece of text at a time."""
    for b in batches:
        buf, off = C.binary_arrays(b.column(0))
        for lo, hi in C.pieces(off):
            part = np.ascontiguousarray(buf[off[lo]:off[hi]])
            h, _, start, end = C.words(part, off[lo:hi + 1] - off[lo], "alnum")
            plain = np.concatenate([[0], np.cumsum(~_LETTERS[C.lowered(part)])])
            ok = plain[end] == plain[start]
            _, first, n = np.unique(h[ok], return_index=True, return_counts=True)
            raw = C.lowered(part).tobytes()
            s, e = start[ok][first].tolist(), end[ok][first].tolist()
            yield pa.RecordBatch.from_pydict({"word": pa.array([raw[i:j].decode() for i, j in zip(s, e)], pa.string()), "n": pa.array(n, pa.int64())})


def _cut(label: str, known: dict, total: float) -> list[str]:
    """Most probable words of a label; known is {(start, length): count}. Ties go to the longer last word."""
    ending: dict[int, list[tuple[int, int]]] = {}
    for (start, size), n in sorted(known.items()):
        ending.setdefault(start + size, []).append((start, n))
    ten = math.log(10)
    best, back = [0.0], [0]
    from_, unknown = 0, 0.0  # where the best unknown word that ends here starts, and best[start] + start * ten
    for end in range(1, len(label) + 1):
        start, value = from_, unknown + math.log(10 / total) - end * ten
        for s, n in ending.get(end, ()):
            p = best[s] + math.log(n / total)
            if p > value or p == value and s < start:
                start, value = s, p
        best.append(value)
        back.append(start)
        if value + end * ten > unknown:
            from_, unknown = end, value + end * ten
    out, end = [], len(label)
    while end:
        out.append(label[back[end]:end])
        end = back[end]
    return out[::-1]


def segmented(labels: DataFrame, pages: DataFrame) -> DataFrame:
    """labels (label: a-z strings) to (label, words), by the unigram counts of pages.html."""
    counts = C.saved(pages.select(F.col("html").cast("string")).mapInArrow(_word_counts, "word string, n long")
                     .groupBy("word").agg(F.sum("n").alias("n")), "unigrams")
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    labels = labels.where("label != ''")
    longest = labels.agg(F.max(F.length("label"))).first()[0] or 0
    # lengths of counted words: no more than the longest label has letters
    sizes = [r.size for r in counts.select(F.length("word").alias("size")).where(F.col("size") <= longest).distinct().orderBy("size").collect()]
    lengths = F.split(F.lit(",".join(map(str, sizes))), ",").cast("array<int>") if sizes else F.array().cast("array<int>")
    start = F.explode(F.sequence(F.lit(0), F.length("label") - 1)).alias("start")
    size = F.explode_outer(F.filter(lengths, lambda n: n <= F.length("label") - F.col("start"))).alias("size")
    parts = labels.select("label", start).select("label", "start", size).withColumn("word", F.substr("label", F.col("start") + 1, F.col("size")))
    known = (parts.join(counts, "word", "left").groupBy("label").agg(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("start", "size", "n"))).alias("known")))

    def rows(batches):
        for b in batches:
            words = [_cut(l, {(k["start"], k["size"]): k["n"] for k in ks}, total) for l, ks in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.list_(pa.string()))], names=["label", "words"])
    return known.mapInArrow(rows, "label string, words array<string>")


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score (micro-nats for block; null where a rule decides)."""
    host, path = host_and_path(F.col("url").cast("string"))
    action, rule = matched_rule(F.col("host"), F.col("path"), rules)
    urls = pages.select(F.col("page_id"), host.alias("host"), path.alias("path")).withColumn("action", action).withColumn("rule", rule)
    urls = C.saved(urls, "urls")

    runs = F.regexp_extract_all(F.col("host"), F.lit(r"([a-z]+|[^a-z.\-]+)"), 1)
    hosts = C.saved(urls.groupBy("host", "action").agg(F.count("*").alias("k")).withColumn("labels", runs), "hosts")
    labels = hosts.select(F.explode("labels").alias("label")).distinct()
    letters = labels.where(F.col("label").rlike("^[a-z]+$"))
    cut = C.saved(segmented(letters, pages), "segments")
    host_words = (hosts.select("host", "labels").distinct().select("host", F.explode("labels").alias("label")).join(cut, "label", "left")
                  .select("host", F.explode(F.coalesce("words", F.array("label"))).alias("word")))
    paths = C.saved(urls.groupBy("path", "action").agg(F.count("*").alias("k")), "paths")
    # numbers differ from url to url: their length is the word
    path_words = (paths.select("path").distinct().select("path", F.explode(F.split(F.lower("path"), r"[/.\-_]+")).alias("word"))
                  .where("word != ''").withColumn("word", F.concat(F.lit("/"), F.regexp_replace("word", "[0-9]", "0"))))
    host_words, path_words = C.saved(host_words, "host-words"), C.saved(path_words, "path-words")

    def by_action(words: DataFrame, of: DataFrame, key: str) -> DataFrame:
        return words.join(of.where("action IS NOT NULL").select(key, "action", "k"), key).groupBy("word").agg(
            F.sum(F.when(F.col("action") == "block", F.col("k")).otherwise(0)).alias("b"), F.sum(F.when(F.col("action") == "allow", F.col("k")).otherwise(0)).alias("a"))

    counted = C.saved(by_action(host_words, hosts, "host").unionByName(by_action(path_words, paths, "path")).groupBy("word")
                      .agg(F.sum("b").alias("b"), F.sum("a").alias("a")), "words")
    v, b, a = counted.agg(F.count("*"), F.sum("b"), F.sum("a")).first()
    docs = {r.action: r.k for r in hosts.groupBy("action").agg(F.sum("k").alias("k")).collect()}
    if not docs.get("block") or not docs.get("allow"):
        return urls.select("page_id", "host", "path", "rule", F.coalesce("action", F.lit("allow")).alias("verdict"), F.lit(None).cast("long").alias("score"))
    micro = lambda x: F.round(x * 1_000_000).cast("long")
    norm = math.log(a + v) - math.log(b + v)
    weights = counted.select("word", micro(F.log(F.col("b") + 1) - F.log(F.col("a") + 1) + F.lit(norm)).alias("w"))

    def scores(words: DataFrame, key: str) -> DataFrame:
        unseen = round(norm * 1_000_000)
        return words.join(weights, "word", "left").groupBy(key).agg(F.sum(F.coalesce("w", F.lit(unseen))).alias(key + "_score"))

    prior = round((math.log(docs["block"]) - math.log(docs["allow"])) * 1_000_000)
    scored = urls.join(scores(host_words, "host"), "host", "left").join(scores(path_words, "path"), "path", "left")
    score = F.coalesce("host_score", F.lit(0)) + F.coalesce("path_score", F.lit(0)) + F.lit(prior)
    return scored.select("page_id", "host", "path", "rule", F.coalesce("action", F.when(score > 0, "block").otherwise("allow")).alias("verdict"),
                         F.when(F.col("rule").isNull(), score.cast("long")).alias("score"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all of pages."""
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {"op10_url_filter": op10_url_filter}
