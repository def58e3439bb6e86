"""URL filters: host-suffix and path-prefix expressions against hashed rules, all in native expressions.

Each URL is expanded into (host suffix, path prefix) expressions: every suffix of the host at a label
border, and every prefix of the path whose length some rule has. Rules and expressions meet on a short
prefix of their digest, the full digest then confirms, and the longest rule wins.

The result is the same by three ways, chosen by the counted number of rules. Up to ``inline_rules``, the table of short
prefixes is part of the query: nothing is joined, grouped or shuffled. Up to ``max_broadcast_rules`` rules are
broadcast to the expanded URLs; a larger rule set joins by shuffle with each rule copied to ``salts`` salts, so that a
host with a third of all pages is dealt over as many tasks. These two put a URL's expressions together again by a
group-by, copies of a row merged before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import local_rows

# The rules of the query (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
SHORT = 8  # hex digits of the digest that the equi-join uses


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return local_rows(spark, list(rules), "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.", -1)
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")))


def _inline(pages: DataFrame, known: list, lengths: list[int], id_col: str, url_col: str, default: str) -> DataFrame:
    """Few rules: a URL's expressions are looked up where they are made."""
    by_short: dict[str, list] = {}
    for r in known:
        rule = r["r_host"] + r["r_path"]
        by_short.setdefault(r["short"], []).append(F.struct(
            F.lit(len(rule)).alias("a"), F.lit(len(r["r_host"])).alias("b"), F.lit(r["r_verdict"]).alias("c"), F.lit(rule).alias("d"),
            F.lit(r["r_full"]).alias("full"), F.lit(r["r_host"]).alias("host"), F.lit(r["r_path"]).alias("path"),
        ))
    rows = pages.select(F.col(id_col).alias("page"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if not by_short:
        return rows.select(F.col("page").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    table = F.create_map(*[x for short, found in by_short.items() for x in (F.lit(short), F.array(*found))])
    prefixes = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path")), lambda n: F.substr(F.col("path"), F.lit(1), n))

    def fitting(host: Column, path: Column) -> Column:
        full = _digest(host, path)
        return F.filter(F.try_element_at(table, F.substring(full, 1, SHORT)), lambda r: (r["full"] == full) & (r["host"] == host) & (r["path"] == path))

    found = F.flatten(F.transform(_suffixes(F.col("host")), lambda h: F.flatten(F.filter(F.transform(prefixes, lambda p: fitting(h, p)), lambda x: x.isNotNull()))))
    won = F.when(F.col("host") != "", F.array_max(found))
    judged = rows.withColumn("won", won)
    return judged.select(F.col("page").alias(id_col), "host", "path", F.col("won.d").alias("rule"), F.coalesce("won.c", F.lit(default)).alias("verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", inline_rules: int = 256, max_broadcast_rules: int = 200_000, salts: int = 16) -> DataFrame:
    """Judge every row of ``pages``: (``id_col``, host, path, rule, verdict).

    A rule fits its host and all subdomains if the path starts with the rule's path. The rule with the
    longest host+path wins, then the longer host, then ``block``. Without a fitting rule ``rule`` is null
    and ``verdict`` is ``default``. A null URL, or one without ``://``, has an empty host and path and
    fits no rule. Null ids, repeated rows and empty tables pass through: each input row gives one row.
    Other columns of ``pages`` are not read.
    """
    known = rules.select(
        F.col("verdict").alias("r_verdict"), F.lower("host").alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path")
    ).where("r_host is not null and r_host <> ''")
    known = known.withColumn("r_full", _digest(F.col("r_host"), F.col("r_path"))).groupBy("r_full", "r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
    known = known.withColumn("short", F.substring("r_full", 1, SHORT))
    facts = known.agg(F.count("*"), F.collect_set(F.length("r_path"))).first()  # a row: as many lengths as rule paths have
    n_rules, lengths = facts[0], sorted(facts[1] or [])
    if n_rules <= inline_rules:
        return _inline(pages, known.collect(), lengths, id_col, url_col, default)
    small = n_rules <= max_broadcast_rules

    # Copies of a row become one row with a count, per input partition: no key gathers what several tasks read.
    rows = (
        pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url")).withColumn("part", F.spark_partition_id())
        .groupBy("page", "url", "part").agg(F.count("*").alias("copies"))
        .withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    )
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    expanded = rows.withColumn("suffix", F.explode_outer(F.when(F.col("host") != "", _suffixes(F.col("host")))))
    expanded = expanded.withColumn("n", F.explode_outer(prefixes)).withColumn("prefix", F.expr("substring(path, 1, n)"))
    expanded = expanded.withColumn("full", _digest(F.col("suffix"), F.col("prefix"))).withColumn("short", F.substring("full", 1, SHORT))
    if small:
        met = expanded.join(F.broadcast(known), "short", "left")
    else:
        dealt = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = expanded.withColumn("salt", F.pmod(F.xxhash64("page", "url", "part"), F.lit(salts)).cast("int")).join(dealt, ["short", "salt"], "left")
    fits = (F.col("full") == F.col("r_full")) & (F.col("suffix") == F.col("r_host")) & (F.col("prefix") == F.col("r_path"))
    rule = F.concat("r_host", "r_path")
    weight = F.struct(F.length(rule).alias("a"), F.length("r_host").alias("b"), F.col("r_verdict").alias("c"), rule.alias("d"))
    judged = met.groupBy("page", "url", "part", "copies", "host", "path").agg(F.max(F.when(fits, weight)).alias("won"))
    return judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        F.col("page").alias(id_col), "host", "path", F.col("won.d").alias("rule"), F.coalesce("won.c", F.lit(default)).alias("verdict")
    )
