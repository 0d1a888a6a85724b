"""URL filter: pattern rules fetched by their rarest literal token.

Two lists judge a URL. *Site rules* are host/path pairs; one fits its host and
every subdomain when the path starts with the rule's, and the longest fitting
one decides. Where none fits, *pattern rules* (regular expressions over the
whole URL, each ``block`` or ``allow``) decide: an ``allow`` hit beats ``block``
hits, no hit means ``allow``.

Every rule of both lists names the literal tokens its pattern needs. It is
filed under the one that is rarest among the corpus' URLs, a URL fetches the
rules filed under its own tokens, and only those run their regular expression.
A rule without a literal is filed under the empty token, which every URL has.

DataFrame functions only. Defined cases: null URLs, and URLs without ``://``,
have empty host and path, no site rule and verdict ``allow`` (a null has no
pattern hit; a text without ``://`` is still matched by pattern rules);
repeated rows are judged alike, each keeping its row; an empty table gives an
empty result; other columns are ignored; a path that is empty starts with no
rule's path. Length of a rule is that of its text, host and path together.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"

#: The dealt site rules.
SITE_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

#: Default pattern rules: (verdict, regular expression, literal tokens it needs).
PATTERN_RULES = (
    ("block", r"(?i)://([^/?#]*[.-])?(cheap|buy|discount)-pills[.-]", ("pills",)),
    ("block", r"(?i)://([^/?#]*[.-])?(cheap|buy|discount)-meds[.-]", ("meds",)),
    ("block", r"(?i)://([^/?#]*[.-])?casino[.-]", ("casino",)),
    ("block", r"(?i)[/.]porn[./-]", ("porn",)),
    ("block", r"(?i)[?&]sessionid=[0-9a-f]{16,}", ("sessionid",)),
    ("block", r"(?i)/wp-(admin|login)(/|\.php)", ("wp",)),
    ("block", r"(?i)\.(exe|zip|iso|apk)([?#]|$)", ()),
    ("allow", r"(?i)://([^/?#]*\.)?(wikipedia|wikimedia)\.org/", ("org",)),
)


@dataclass(frozen=True)
class Rule:
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: str | None = None  # the site rule's text


def site_rule(verdict: str, text: str) -> Rule:
    """A host/path rule as a pattern over ``//host/path``."""
    host, slash, path = text.partition("/")
    pattern = f"^//([^/]*\\.)?{_literal(host.lower())}{_literal(slash + path)}"
    # the path's last token may go on in the URL, so only the host's are surely there whole
    return Rule(verdict, pattern, tuple(_split(host.lower())), text)


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", text)


def _split(text: str) -> list[str]:
    return [t for t in re.split(r"[^a-z0-9]+", text.lower()) if t]


def url_host(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct lower-case literal tokens of a URL, and the empty one."""
    return F.array_union(F.array(F.lit("")), F.split(F.lower(F.coalesce(url, F.lit(""))), "[^a-z0-9]+"))


def rule_index(spark: SparkSession, urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """(token, rule_id, pattern, verdict, site, size) with each rule under the rarest of
    its literal tokens over ``urls`` (one column ``url``). Tokens are counted over
    all URLs, but only those some rule names; as many rows as rules."""
    named = sorted({t for r in rules for t in r.tokens})
    seen: dict[str, int] = {}
    if named:
        seen = {
            r["token"]: r["n"]
            for r in urls.select(F.explode(url_tokens(F.col("url"))).alias("token"))
            .where(F.col("token").isin(named))
            .groupBy("token")
            .agg(F.count("*").alias("n"))
            .collect()
        }
    rows = [
        (min(r.tokens, key=lambda t: (seen.get(t, 0), t), default=""), i, r.pattern, r.verdict, r.site, len(r.site or ""))
        for i, r in enumerate(rules)
    ]
    return spark.createDataFrame(rows, "token string, rule_id int, pattern string, verdict string, site string, size int")


def filter_urls(
    spark: SparkSession,
    pages: DataFrame,
    site_rules=SITE_RULES,
    pattern_rules=PATTERN_RULES,
    broadcast_rules: int = 100_000,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and ``pattern_hits`` for every row of
    ``pages`` (page_id, url).

    A verdict depends on the URL alone, so distinct URLs are judged and joined
    back; a URL with a third of the rows collapses before the shuffle, and AQE
    splits its rows in the join. The rule table is broadcast up to
    ``broadcast_rules`` rules and shuffled beyond. The hits of a URL are reduced by
    partial aggregates and are at most one for each rule.
    """
    rules = [site_rule(v, t) for v, t in site_rules] + [Rule(v, p, tuple(t)) for v, p, t in pattern_rules]
    urls = pages.select("url").where("url is not null").distinct()
    index = rule_index(spark, urls, rules)
    if len(rules) <= broadcast_rules:
        index = F.broadcast(index)
    parts = urls.select("url", F.concat(F.lit("//"), url_host(F.col("url")), url_path(F.col("url"))).alias("place"))
    hits = (
        parts.select("url", "place", F.explode(url_tokens(F.col("url"))).alias("token"))
        .join(index, "token")
        .where(F.expr("case when site is null then url rlike pattern else place rlike pattern end"))
    )
    best = hits.groupBy("url").agg(
        F.max(F.when(F.col("site").isNotNull(), F.struct("size", "site", "verdict"))).alias("by_site"),
        F.max(F.col("site").isNull() & (F.col("verdict") == ALLOW)).alias("let"),
        F.max(F.col("site").isNull() & (F.col("verdict") == BLOCK)).alias("hit"),
        F.count_if(F.col("site").isNull()).alias("n_patterns"),
    )
    own = pages.select("page_id", "url")
    judged = own.join(best.withColumnRenamed("url", "judged_url"), F.col("url") == F.col("judged_url"), "left")
    by_pattern = F.when(F.col("hit") & ~F.col("let"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.select(
        "page_id",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
        F.col("by_site.site").alias("rule"),
        F.coalesce(F.col("by_site.verdict"), by_pattern).alias("verdict"),
        F.coalesce(F.col("n_patterns"), F.lit(0)).cast("long").alias("pattern_hits"),
    )
