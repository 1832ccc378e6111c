"""URL filtering by explicit rules and by mined association rules.

Explicit rules name a host and the beginning of a path; the longest that fits
decides. For the other urls, rules are mined: Spark's FP-growth finds the
token combinations that are frequent among labelled urls, and those whose
confidence for one verdict is high become rules. A rule that contains a rule
for the same verdict, at least as confident, is pruned.

Rules are matched by an inverted index: each is posted under the rarest of its
tokens, a url's tokens are joined to the postings, and a posting holds if the
url has all its tokens. Work is done once per different url. Only DataFrame
functions are used.

Host and path of a null url, or of one without ``://``, are empty; no rule
fits them and they are allowed, as is every url that no mined rule matches.
Repeated rows get equal verdicts. Without labelled urls nothing is mined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import fresh, materialize, sized

LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_LABEL = "verdict="


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class MiningRules:
    support: float = 0.005
    confidence: float = 0.8


MINING = MiningRules()


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower case."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), *LETTERS)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def explicit(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        inside = (host == rule.host) | host.endswith("." + rule.host)
        made = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(inside & path.startswith(rule.path), made).otherwise(found)
    return found


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Different tokens of a url: scheme, labels of the host with the ending's place, parts of the path, query keys."""
    labels = F.split(host, r"\.")
    hosts = F.transform(labels, lambda x, i: F.when(i == F.size(labels) - 1, F.concat(F.lit("top:"), x)).otherwise(F.concat(F.lit("host:"), x)))
    # numbers are one token, or every url would have a word of its own
    shaped = F.regexp_replace(F.translate(path, *LETTERS), r"\d+", "0")
    parts = F.transform(F.filter(F.split(shaped, r"[/.]"), lambda x: x != ""), lambda x: F.concat(F.lit("path:"), x))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "[&;]"), lambda x: x != ""), lambda x: F.concat(F.lit("key:"), F.substring_index(x, "=", 1)))
    mark = F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    scheme = F.array(F.concat(F.lit("scheme:"), F.translate(F.substring_index(url, "://", 1), *LETTERS)))
    return F.array_distinct(F.filter(F.concat(scheme, hosts, parts, keys, mark), lambda x: ~x.endswith(":")))


def _postings(sets: DataFrame, frequency: DataFrame) -> DataFrame:
    """``sets`` (items, ...) with ``token``, the rarest of the items."""
    names = sets.columns
    rarity = sets.select("*", F.explode("items").alias("token")).join(frequency, "token")
    first = rarity.groupBy("items", "verdict").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    return sets.join(first, ["items", "verdict"]).select(*names, "token")


def mine(labelled: DataFrame, rules: MiningRules = MINING) -> DataFrame:
    """Pruned rules (items, verdict, confidence, support, token) from (tokens, verdict); ``token`` is the rarest item.

    Every frequent combination is held by ``support`` of all labelled urls, so
    rules do not grow in number with the urls.
    """
    schema = "items array<string>, verdict string, confidence double, support double, token string"
    known = labelled.filter("verdict is not null and size(tokens) > 0")
    baskets = known.select(F.concat("tokens", F.array(F.concat(F.lit(_LABEL), F.col("verdict")))).alias("items"))
    if baskets.isEmpty():
        return labelled.sparkSession.createDataFrame([], schema)
    grown = FPGrowth(itemsCol="items", minSupport=rules.support, minConfidence=rules.confidence).fit(baskets)
    frequency = grown.freqItemsets.filter("size(items) = 1").select(F.col("items")[0].alias("token"), F.col("freq").alias("n"))
    found = grown.associationRules.filter(
        F.col("consequent")[0].startswith(_LABEL) & ~F.exists("antecedent", lambda x: x.startswith(_LABEL))
    ).select(
        F.array_sort("antecedent").alias("items"),
        F.substring_index(F.col("consequent")[0], "=", -1).alias("verdict"),
        "confidence",
        "support",
    )
    posted = materialize(_postings(found, frequency))
    # a rule is pruned by a smaller one that holds wherever it does: the smaller is posted under one of its tokens
    smaller = posted.select(F.col("items").alias("s_items"), F.col("verdict").alias("s_verdict"), F.col("confidence").alias("s_confidence"), "token")
    contained = (
        posted.select("items", "verdict", "confidence", F.explode("items").alias("token"))
        .join(sized(smaller), "token")
        .filter("s_verdict = verdict and s_confidence >= confidence and size(s_items) < size(items)")
        .filter(F.size(F.array_except("s_items", "items")) == 0)
    )
    pruned = contained.select("items", "verdict").distinct()
    return materialize(posted.join(pruned, ["items", "verdict"], "left_anti").select(*[x.split()[0] for x in schema.split(", ")]))


def matches(urls: DataFrame, mined: DataFrame) -> DataFrame:
    """(url, mined): the best rule (confidence, support, items, verdict) of every url (url, tokens) that has one."""
    exploded = urls.select("url", "tokens", F.explode("tokens").alias("token"))
    held = exploded.join(sized(mined), "token").filter(F.size(F.array_except("items", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", F.array_join("items", " ").alias("items"), "verdict"))
    return held.groupBy("url").agg(best.alias("mined"))


def judge(pages: DataFrame, rules: list[UrlRule], mining: MiningRules = MINING, default: str = "allow", url_column: str = "url", result: str = "judged") -> DataFrame:
    """``pages`` with ``result`` (host, path, rule, verdict, mined).

    The urls that an explicit rule decides are the labelled ones; what is mined
    from them decides the rest. ``mined`` names the tokens of the mined rule.
    """
    url = F.col("url")
    urls = pages.select(F.col(f"`{url_column}`").alias("url")).filter("url is not null").distinct()
    parsed = urls.select("url", host_of(url).alias("host"), path_of(url).alias("path")).filter("host <> ''")
    told = parsed.select("url", tokens_of(url, F.col("host"), F.col("path")).alias("tokens"), explicit(F.col("host"), F.col("path"), rules).alias("told"))
    told = materialize(told)
    mined = mine(told.select("tokens", "told.verdict"), mining)
    found = materialize(matches(told.filter("told is null"), mined))
    key, best = fresh(pages, "_sw_url"), fresh(pages, "_sw_mined")
    # a row per url that a mined rule matches: it grows with the pages
    judged = sized(found.select(F.col("url").alias(key), F.col("mined").alias(best)))
    joined = pages.join(judged, F.col(f"`{url_column}`") == F.col(key), "left")
    own = F.col(f"`{url_column}`")
    host, path = host_of(own), path_of(own)
    fixed = explicit(host, path, rules)
    verdict = F.coalesce(fixed["verdict"], F.col(f"{best}.verdict"), F.lit(default))
    made = F.struct(host.alias("host"), path.alias("path"), fixed["rule"].alias("rule"), verdict.alias("verdict"), F.col(f"{best}.items").alias("mined"))
    return joined.withColumn(result, made).drop(key, best)
