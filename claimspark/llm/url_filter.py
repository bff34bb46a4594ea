"""Operator 10: URL filters by pattern rules, indexed by rare literal tokens.

A rule is a regular expression with the literal tokens that any URL it fits
must hold as whole tokens. The index files a rule under the one of its tokens
that the fewest URLs of the table hold. A URL's tokens fetch the rules filed
under them, and only those rules run their expression on it; rules without a
token are fetched by every URL. Of the rules that fit, host rules come before
patterns and the longest wins (ties: the smaller rule text).

Only DataFrame functions run. Equal URLs are judged once; the rules (a
parameter of the job, at most ``MAX_RULES``) are the only broadcast side.

Defined results
  null URL, or one without ``://``: host and path empty, no rule, ``allow``
  empty URL: as one without ``://``; very long URL: judged whole, its tokens are rows of one join
  empty table: no rows; empty rules: every URL allowed by the method
  repeated rows: one result each, all alike
  extra columns of the input are ignored
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the rule table (about 200 bytes a rule, so at most 20 MB broadcast).
MAX_RULES = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A token of a URL: a run of lower-cased letters and digits.
_TOKEN_GAP = "[^a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    text: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    is_host: bool = False


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``.

    The last part of a path can go on in the URL ('/en/1' fits '/en/12'), so
    only its closed parts are tokens."""
    closed = re.findall("[a-z0-9]+", host.lower()) + re.findall("[a-z0-9]+(?=[^a-z0-9])", path.lower())
    # matched against host?path, the host lower-cased; neither part holds a '?'
    return Rule(host + path, rf"^([^?]*\.)?{re.escape(host)}\?{re.escape(path)}", tuple(closed), verdict, True)


def pattern_rule(verdict: str, pattern: str, *tokens: str) -> Rule:
    """Fits a whole URL in which ``pattern`` is found; ``tokens``: whole tokens
    that each such URL holds."""
    return Rule(pattern, pattern, tokens, verdict)


#: The host rules of the query's contract.
HOST_RULES = (
    host_rule("allow", "org", "/"),
    host_rule("block", "example.org", "/es/"),
    host_rule("block", "example.org", "/en/1"),
    host_rule("allow", "com", "/fr/"),
    host_rule("block", "com", "/de/"),
)

#: What the method blocks where no host rule fits: second copies of a page.
PATTERN_RULES = (
    pattern_rule("block", r"[?&]utm_source=", "utm", "source"),
    pattern_rule("block", r"[?&]page=[0-9]+(&|#|$)", "page"),
    pattern_rule("block", r"[?&](sessionid|phpsessid)=", ),
    pattern_rule("block", r"/(login|signup|cart|checkout)(/|\?|#|$)"),
    pattern_rule("block", r"/print/[0-9]+", "print"),
)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_frame(spark, rules: tuple[Rule, ...]) -> DataFrame:
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the broadcast index is bounded to {MAX_RULES}")
    rows = [(r.text, r.pattern, list(r.tokens), r.verdict, r.is_host) for r in rules]
    return spark.createDataFrame(rows, "rule string, pattern string, tokens array<string>, rule_verdict string, is_host boolean")


def _tokens(url: Column) -> Column:
    """Distinct tokens of a URL, and '' for the rules that have none."""
    return F.array_union(F.array_distinct(F.split(ascii_lower(url), _TOKEN_GAP)), F.array(F.lit("")))


def index_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules with the one token each is filed under: its rarest in ``urls``
    (ties: the smaller token); '' without tokens."""
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    counts = urls.select(F.explode(_tokens(F.col("url"))).alias("token")) \
        .join(F.broadcast(wanted), "token").groupBy("token").count()
    rare = rules.select("rule", "pattern", F.explode("tokens").alias("token")).join(counts, "token", "left") \
        .groupBy("rule", "pattern").agg(F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token")).alias("token"))
    return rules.drop("tokens").join(rare, ["rule", "pattern"], "left").withColumn("token", F.coalesce("token", F.lit("")))


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...], id_column: str = "page_id", url_column: str = "url",
               default: str = "allow") -> DataFrame:
    """id_column, url, host, path, rule (the host rule or null), pattern_rule
    (the pattern that decided, or null), verdict."""
    rows = pages.select(F.col(id_column).alias(id_column), F.col(url_column).cast("string").alias("url"))
    urls = rows.select("url").where(F.col("url").contains("://")).distinct()
    index = index_rules(urls, rule_frame(pages.sparkSession, rules))
    parts = urls.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    candidates = parts.select("*", F.explode(_tokens(F.col("url"))).alias("token")) \
        .join(F.broadcast(index), "token")
    subject = F.when(F.col("is_host"), F.concat_ws("?", "host", "path")).otherwise(F.col("url"))
    fits = candidates.where(F.rlike(subject, F.col("pattern")))
    best = fits.groupBy("url").agg(F.min_by(F.struct("rule", "rule_verdict", "is_host"), F.struct(
        ~F.col("is_host"), -F.length("rule"), "rule")).alias("best"))
    return rows.join(best, "url", "left").select(
        id_column, "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
        F.when(F.col("best.is_host"), F.col("best.rule")).alias("rule"),
        F.when(~F.col("best.is_host"), F.col("best.rule")).alias("pattern_rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))
