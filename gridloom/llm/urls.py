"""Rules on URLs: a blocked Bloom filter passes possible hits to an exact join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.bloom import build_bits, log_blocks, probe
from gridloom.llm.words import text_bytes, word_hashes
from gridloom.llm.workers import tidied


def split_url(url: str = "url") -> tuple:
    """(host, path) of a URL as SQL text: the host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or
    the end, A-Z in lower case; the path goes from there to ``?``, ``#`` or the end. Null or no ``://``: both empty."""
    rest = rf"regexp_extract({url}, '(?s)^.*?://(.*)$', 1)"
    host = rf"coalesce(translate(regexp_extract({rest}, '(?s)^([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}'), '')"
    path = rf"coalesce(regexp_extract({rest}, '(?s)^[^/?#]*([^?#]*)', 1), '')"
    return host, path


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def hashed(keys: list[str]) -> np.ndarray:
    data, bounds = text_bytes(pa.array(keys, pa.large_string()))
    return word_hashes(data, bounds[:-1], bounds[1:])


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """Every rule that could fit: each domain the host lies in, with each prefix of the path that has a rule's length."""
    if not host:
        return []
    cuts = [0, *(i + 1 for i, c in enumerate(host) if c == ".")]
    heads = [path[:n] for n in lengths if n <= len(path)]
    return [host[i:] + p for i in cuts for p in heads]


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All rows and columns of ``pages``, with host, path, rule and verdict.

    ``rules`` has host, path and verdict: canonical URLs listed. A rule fits its host and all subdomains when the URL's
    path starts with the rule's; of several the longest (host and path together) wins, of equally long ones the
    smallest in text order; a rule listed twice with two verdicts blocks. A URL without a fitting rule gets rule null
    and ``default``. Rules with a null host or path are left out, as are those with an empty host; null or malformed
    URLs have an empty host, which no rule fits. Columns of ``pages`` called host, path, rule or verdict are replaced.

    Distinct (host, path) pairs are judged once: the filter, of a size bounded by its parameter, passes those of their
    candidate rules that may be listed, and the join on the rule itself drops what it passed wrongly. All joins are
    plain equi-joins, left to Spark's size check and its splitting of skewed keys.
    """
    spark = pages.sparkSession
    listed = rules.where("host <> '' AND path IS NOT NULL").selectExpr(
        "concat(host, path) AS rule", "length(path) AS n", "coalesce(verdict, 'block') AS verdict"
    ).groupBy("rule", "n").agg(F.max(F.struct((F.col("verdict") == "block").alias("b"), "verdict")).alias("v")).selectExpr(
        "rule", "n", "v.verdict AS verdict").persist()
    lengths = sorted(r[0] for r in listed.select("n").distinct().collect())  # of paths: at most the longest's length
    power = log_blocks(listed.count())

    def hash_rules(batches):
        for batch in batches:
            yield pa.record_batch([pa.array(hashed(batch.column(0).to_pylist()).view(np.int64))], ["h"])

    bits = build_bits(listed.select("rule").mapInArrow(tidied(hash_rules), "h long"), power)

    def possible(batches):
        for batch in batches:
            hosts, paths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = [candidates(h, p, lengths) for h, p in zip(hosts, paths)]
            row = np.repeat(np.arange(len(found)), [len(x) for x in found])
            keys = pa.array([k for x in found for k in x], pa.string())
            hit = probe(bits, power, hashed(keys)) if len(keys) else np.zeros(0, bool)
            row = row[hit]
            yield pa.record_batch(
                [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), keys.filter(pa.array(hit))],
                ["host", "path", "rule"],
            )

    host, path = split_url(f"`{url}`")
    named = pages.drop("rule", "verdict", *({"host", "path"} - {url})).withColumns({"_h": F.expr(host), "_p": F.expr(path)})
    if url in ("host", "path"):
        named = named.drop(url)
    keys = named.select("_h", "_p").where("_h <> ''").distinct()
    hits = keys.mapInArrow(tidied(possible), "host string, path string, rule string").join(listed.select("rule", "verdict"), "rule")
    best = hits.groupBy("host", "path").agg(
        F.min(F.struct((-F.length("rule")).alias("n"), "rule", "verdict")).alias("best")
    ).selectExpr("host AS _h", "path AS _p", "best.rule AS rule", "best.verdict AS verdict")
    judged = named.join(best, ["_h", "_p"], "left")
    kept = [c for c in named.columns if c not in ("_h", "_p")]
    return judged.select(*(F.col(f"`{c}`") for c in kept), F.col("_h").alias("host"), F.col("_p").alias("path"), "rule",
                         F.coalesce("verdict", F.lit(default)).alias("verdict"))
