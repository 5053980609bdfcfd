"""URL rules by hash-prefix join.

Every distinct (host, path) is expanded into its host suffixes x path
prefixes; the expressions meet the rules by an equi-join on the first four
bytes of their SHA-256, the full digest confirms a match, and the longest rule
of an address decides.  Path prefixes are taken at the lengths that rule paths
have, so a rule path need not end at a slash.

The join is left to the planner: a small rule table is broadcast by its
measured size, a large one meets the expressions in a shuffle whose hot keys
(a host with a third of all rows) are split by adaptive execution.  Addresses
are made distinct before they are expanded, so a frequent address is judged
once.

Defined cases: a null url, or one without '://', has an empty host and path,
no rule and the default verdict; no rule fits an empty path.  Repeated rows
and null ids give a row each.  An empty rule table judges everything by the
default; an empty page table gives an empty result.  Of two rules for the same
host and path 'block' wins.  A rule with a null or empty host or a null path
fits nothing.  Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What the method says of an address that no rule lists.
DEFAULT_VERDICT = "allow"


def with_address(pages: DataFrame, url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, host, path): see the module's defined cases; only A-Z of the host
    are lower-cased."""
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)\z", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.select(F.col(key), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def expressions(addresses: DataFrame, lengths: DataFrame) -> DataFrame:
    """(host, path, rule_host, rule_path) for every host suffix and path prefix.

    ``lengths`` has one row with the array ``lengths`` of rule path lengths
    (at most one entry per length, so bounded by the longest rule)."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    prefixes = F.transform(F.filter(F.col("lengths"), lambda n: n <= F.length("path")), lambda n: F.substring("path", F.lit(1), n))
    return (addresses.withColumn("lengths", lengths.scalar())
            .select("host", "path", F.explode(suffixes).alias("rule_host"), prefixes.alias("prefixes"))
            .where("rule_host <> ''")
            .select("host", "path", "rule_host", F.explode("prefixes").alias("rule_path")))


def hashed(df: DataFrame) -> DataFrame:
    """Adds the full digest of host and path, and its first four bytes."""
    digest = F.sha2(F.concat_ws("\0", "rule_host", "rule_path"), 256)
    return df.withColumn("digest", digest).withColumn("prefix", F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict) for every page; ``rules`` has the columns
    host, path and verdict ('allow' or 'block')."""
    rules = (rules.where("host <> '' and path is not null")
             .select(F.lower("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")))
    lengths = rules.select(F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"))
    found = with_address(pages, url, key)
    listed = hashed(rules).select("prefix", F.col("digest").alias("rule_digest"), F.concat("rule_host", "rule_path").alias("rule"),
                                  (F.length("rule_host") + F.length("rule_path")).alias("rank"), "rule_verdict")
    matched = (hashed(expressions(found.select("host", "path").distinct(), lengths)).select("host", "path", "prefix", "digest")
               .join(listed, "prefix").where("digest = rule_digest"))
    # the longest rule; of equals 'block' comes after 'allow' and so is the maximum
    decided = (matched.groupBy("host", "path").agg(F.max(F.struct("rank", "rule_verdict", "rule")).alias("best"))
               .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict")))
    return (found.join(decided, ["host", "path"], "left")
            .select(key, "host", "path", "rule", F.coalesce("rule_verdict", F.lit(DEFAULT_VERDICT)).alias("verdict")))
