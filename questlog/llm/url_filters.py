"""URL rules found through their rarest literal token."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A to Z and their lower case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules, and their tokens, up to this number are sent to every task (some 200 bytes each); more are joined by shuffle,
#: where adaptive execution splits a token of very many URLs.
BROADCAST_RULES = 20_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in ``field`` ("site": host and path, "url": whole, lower-cased).

    ``tokens`` are runs of a-z and 0-9 that every lower-cased URL it matches
    has between other characters. Of the rules that match, the highest
    (rank, length) decides; equal ones by name.
    """

    name: str
    verdict: str
    field: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int
    length: int


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """A host with its subdomains, and a prefix of the path."""
    parts = [*re.findall("[a-z0-9]+", host), *re.findall(r"(?<=[^a-z0-9])[a-z0-9]+(?=[^a-z0-9])", path.lower())]
    pattern = rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(host + path, verdict, "site", pattern, tuple(parts), 1, len(host + path))


def word_rule(verdict: str, word: str) -> Rule:
    """A word anywhere in the URL, between other characters than a-z and 0-9."""
    return Rule(word, verdict, "url", f"(^|[^a-z0-9]){word}([^a-z0-9]|$)", (word,), 0, len(word))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_verdicts(
    pages: DataFrame, rules: list[Rule], default: str, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(``id_col``, host, path, matched, field, verdict) per row of ``pages``.

    Each rule is indexed by the token of its own that fewest URLs have, counted
    over all pages. A URL's tokens fetch the rules indexed by them, and only
    those run their pattern. Without a matching rule, ``matched`` and ``field``
    are null and the verdict is ``default``. A null or empty URL has no host,
    no path and no tokens; rules without tokens are tried on every URL. Repeated
    rows and null ids stay.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    read = pages.select(F.col(id_col).alias("id"), url.alias("given")).select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        host_of(F.col("given")).alias("host"),
        path_of(F.col("given")).alias("path"),
        F.translate("given", UPPER, LOWER).alias("lowered"),
    )
    words = F.filter(F.array_distinct(F.split("lowered", "[^a-z0-9]+")), lambda w: w != "")

    wanted = sorted({t for r in rules for t in r.tokens})
    terms = spark.createDataFrame([(t,) for t in wanted], "token string")
    found = read.select(F.explode(words).alias("token"))
    if len(wanted) <= BROADCAST_RULES:
        counts = found.join(F.broadcast(terms), "token", "left_semi").groupBy("token").count()
    else:  # counted within tasks first, so a frequent token is a row a task
        counts = found.groupBy("token").count().join(terms, "token", "left_semi")
    seen = {r["token"]: r["count"] for r in counts.collect()}  # bounded by the rules' tokens

    def key(rule: Rule) -> str:
        return min(rule.tokens, key=lambda t: (seen.get(t, 0), t), default="")

    table = spark.createDataFrame(
        [(key(r), r.name, r.verdict, r.field, r.pattern, r.rank, r.length) for r in rules],
        "token string, matched string, verdict string, field string, pattern string, rank int, length int",
    )
    if len(rules) <= BROADCAST_RULES:
        table = F.broadcast(table)
    fetched = read.withColumn("token", F.explode(F.concat(F.array(F.lit("")), words))).join(table, "token", "left")
    subject = F.when(F.col("field") == "site", F.concat("host", "path")).otherwise(F.col("lowered"))
    fits = F.when(F.regexp_like(subject, "pattern"), F.struct("rank", "length", "matched", "field", "verdict"))
    best = fetched.groupBy("row").agg(
        F.first("id").alias(id_col), F.first("host").alias("host"), F.first("path").alias("path"), F.max(fits).alias("best")
    )
    return best.select(
        id_col, "host", "path", F.col("best.matched").alias("matched"), F.col("best.field").alias("field"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
