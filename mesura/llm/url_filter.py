"""URL filter: a rule list, and association rules mined from what it labels.

Listed rules judge the URLs they fit, the longest first. Their verdicts label
the mining set: FP-growth finds combinations of URL tokens (host labels, path
segments, query keys, file endings) that go with a verdict. Rules are pruned
by support and confidence and where a shorter rule is as sure; the rest match
by an inverted index from token to rules and judge the URLs that no listed
rule fits.

Scale. Host, path and listed rules are column expressions. Tokens are counted
over all labelled URLs; support alone bounds the vocabulary, the transactions
and the rules. Three kinds of tokens need no combinations, so they are settled
by their counts: one that goes with a single verdict (nothing longer is
surer), one that every labelled URL has (it adds nothing to another), and one
that occurs in the very same URLs as another (either stands for both).
FP-growth runs distributed over what is left, and redundant rules go before
anything is collected. The rules kept are the model; matching needs no
shuffle.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura.llm.common import read_table, register, shared_table

#: (verdict, host, path) of the query's rule list.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


@dataclass(frozen=True)
class Params:
    """``support`` (share of the labelled URLs, two URLs at least) and
    ``confidence`` prune mined rules. ``default`` judges URLs that nothing
    fits."""

    support: float = 0.002
    confidence: float = 0.6
    default: str = "allow"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none. A
    rule fits its host and all subdomains, if the path starts with its own;
    of equal lengths the first in order wins."""
    chain = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1:]), reverse=False):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        chain = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chain)
    return chain


_DIGITS = re.compile(r"\d+")


def url_tokens(url: str | None) -> list[str]:
    """Distinct tokens of a URL: scheme, host labels, top-level name, path
    segments, file ending, query keys and a fragment mark. Runs of digits are
    one sign. Null: none."""
    m = re.match(r"(.*?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(#.*)?", url or "", re.S)
    if not m:
        return []
    scheme, host, path, query, fragment = m.groups()
    labels = [x for x in host.translate(_LOWER).split(".") if x]
    out = ["scheme:" + scheme.translate(_LOWER), *("host:" + x for x in labels)]
    out += ["top:" + labels[-1], "site:" + ".".join(labels[-3:])] if labels else []
    segments = [x for x in path.split("/") if x]
    if segments:
        segments[-1], dot, ending = segments[-1].rpartition(".") if "." in segments[-1] else (segments[-1], "", "")
        out += ["ending:" + ending] if dot else []
    out += ["segment:" + _DIGITS.sub("0", x) for x in segments]
    out += ["slash"] if path.endswith("/") else []
    out += ["key:" + x.partition("=")[0] for x in (query or "").split("&") if x]
    out += ["fragment"] if fragment else []
    return list(dict.fromkeys(out))


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class RuleIndex:
    """Mined rules by their tokens; ``rules`` are (tokens, verdict, confidence,
    support). ``same`` names the token that stands in the rules for one that
    occurs in the same labelled URLs."""

    def __init__(self, rules: list[tuple[tuple[str, ...], str, float, float]], default: str, same: dict[str, str] | None = None):
        self.rules, self.default, self.same = sorted(rules, key=lambda r: (-r[2], -r[3], -len(r[0]), r[0], r[1])), default, same or {}
        self.by_token: dict[str, list[int]] = defaultdict(list)
        for k, r in enumerate(self.rules):
            for t in r[0]:
                self.by_token[t].append(k)

    def match(self, tokens: list[str]) -> tuple[str, str | None, float]:
        """Verdict, the tokens of the surest rule all of whose tokens are
        there, and its confidence."""
        said: dict[str, str] = {}
        for t in tokens:
            item = self.same.get(t, t)
            said[item] = min(t, said.get(item, t))
        seen: dict[int, int] = defaultdict(int)
        best = None
        for t in said:
            for k in self.by_token.get(t, ()):
                if best is not None and k >= best:
                    break
                seen[k] += 1
                if seen[k] == len(self.rules[k][0]):
                    best = k
        if best is None:
            return self.default, None, 0.0
        r = self.rules[best]
        return r[1], " + ".join(sorted(said[t] for t in r[0])), r[2]


def pruned(rules: DataFrame) -> DataFrame:
    """Rules (antecedent, v, c, s) that are surer than each with one token
    less; a row is compared with as many others as it has tokens."""
    own = rules.select("antecedent", "v", "c", F.explode("antecedent").alias("x"))
    own = own.select("antecedent", "v", "c", F.array_remove("antecedent", F.col("x")).alias("less"))
    as_sure = rules.select(F.col("antecedent").alias("less"), "v", F.col("c").alias("least"))
    redundant = own.join(as_sure, ["less", "v"]).filter("least >= c").select("antecedent", "v").distinct()
    return rules.join(redundant, ["antecedent", "v"], "left_anti").select("antecedent", "v", "c", "s")


def mine(labelled: DataFrame, p: Params = Params()) -> RuleIndex:
    """Rules from rows (tokens, verdict): every one within ``support`` and
    ``confidence`` that no shorter one with its verdict makes redundant."""
    spark = labelled.sparkSession
    labelled = shared_table(spark, labelled.select("tokens", "verdict", F.monotonically_increasing_id().alias("row")), "url-tokens")
    totals = {r[0]: r[1] for r in labelled.groupBy("verdict").count().collect()}  # two verdicts
    n = sum(totals.values())
    if len(totals) < 2:
        return RuleIndex([], p.default)
    least = max(2, math.ceil(round(p.support * n, 6)))
    # tokens in the same rows have the same two sums of row hashes
    h = lambda seed: F.sum(F.xxhash64(F.lit(seed), "row").cast("decimal(20,0)"))
    counts = (labelled.select(F.explode("tokens").alias("t"), "verdict", "row").groupBy("t")
              .agg(*(F.count_if(F.col("verdict") == v).alias(v) for v in ("allow", "block")), h(1).alias("h1"), h(2).alias("h2"))
              .filter(F.greatest("allow", "block") >= least))
    items = (counts.groupBy("allow", "block", "h1", "h2").agg(F.min("t").alias("item"), F.collect_set("t").alias("tokens")).collect())
    same = {t: r["item"] for r in items for t in r["tokens"] if t != r["item"]}
    rules, mixed = [], set()
    for r in items:
        a = r["allow"] + r["block"]
        if a == n or not r["allow"] or not r["block"]:
            rules += [((r["item"],), v, round(r[v] / a, 9), round(r[v] / n, 9)) for v in ("allow", "block") if r[v] >= least and r[v] / a >= p.confidence]
        else:
            mixed.add(r["item"])
    if not mixed:
        return RuleIndex(rules, p.default, same)
    shared = spark.sparkContext.broadcast(({t: same.get(t, t) for t in [*mixed, *same] if same.get(t, t) in mixed}))

    @F.pandas_udf("array<string>")
    def baskets(tokens: pd.Series, verdicts: pd.Series) -> pd.Series:
        item = shared.value
        return pd.Series([["verdict=" + v, *dict.fromkeys(item[x] for x in t if x in item)] for t, v in zip(tokens, verdicts)])

    model = FPGrowth(minSupport=(least - 0.5) / n, minConfidence=p.confidence).fit(labelled.select(baskets("tokens", "verdict").alias("items")))
    found = (model.associationRules.filter(F.element_at("consequent", 1).startswith("verdict=")).filter(~F.exists("antecedent", lambda x: x.startswith("verdict=")))
             .select(F.array_sort("antecedent").alias("antecedent"), F.substring(F.element_at("consequent", 1), 9, 100).alias("v"), F.round("confidence", 9).alias("c"), F.round("support", 9).alias("s")))
    found = pruned(shared_table(spark, found, "url-rules")).collect()
    for v in ("allow", "block"):
        own = [(tuple(r["antecedent"]), v, r["c"], r["s"]) for r in found if r["v"] == v]
        index = RuleIndex(own, p.default)
        # a rule whose own tokens lead to a surer one is redundant
        rules += [r for r in own if index.match(list(r[0]))[1] == " + ".join(r[0])]
    return RuleIndex(rules, p.default, same)


def filter_urls(pages: DataFrame, rules=RULES, p: Params = Params(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, mined, confidence), one for
    each row of ``pages``.

    A null url, or one without ``://``, has an empty host and path, no rule
    and no tokens, and takes the default verdict. Rows that repeat an id are
    judged each for itself. Equal confidence goes to the larger support, then
    the longer and the first rule in order. Of tokens that occur in the same
    labelled URLs a rule names the first that the URL has. Other columns are not read. An
    empty table gives an empty result.
    """
    @F.pandas_udf("array<string>")
    def tokens(urls: pd.Series) -> pd.Series:
        return urls.map(url_tokens, na_action=None)

    url = F.col("url")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), tokens(url).alias("tokens"))
    rows = shared_table(pages.sparkSession, rows.withColumn("listed", listed(F.col("host"), F.col("path"), rules)), "urls")
    index = mine(rows.filter("listed is not null").select("tokens", F.col("listed.verdict").alias("verdict")), p)
    shared = pages.sparkSession.sparkContext.broadcast(index)  # rules bounded by Params.support

    @F.pandas_udf("verdict string, mined string, confidence double")
    def judge(tokens: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.match(list(t)) for t in tokens], columns=["verdict", "mined", "confidence"])

    by = F.col("by")
    return (rows.withColumn("by", judge("tokens"))
            .select("page_id", "host", "path", F.col("listed.rule").alias("rule"), F.coalesce("listed.verdict", by["verdict"]).alias("verdict"),
                    F.when(F.col("listed").isNull(), by["mined"]).alias("mined"), F.when(F.col("listed").isNull(), by["confidence"]).alias("confidence")))


@register("op6_url_filter")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages"))
