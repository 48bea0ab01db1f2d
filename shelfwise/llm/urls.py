"""URL filters: rules on hosts and paths, found by hashed expressions.

A rule is a host and the beginning of a path, written together (``example.org/es/``). It fits
its host and all subdomains where the URL's path begins with the rule's. Each URL is expanded
into expressions, host suffixes times path prefixes, of the shapes that rules have: so many host
labels, so many characters of path. Expressions meet the rules in an equi-join on a short hash
prefix; the full digest confirms a match. Of several fitting rules the longest wins, and among
equal ones a blocking rule. Where no rule fits, the verdict is ``allow``.

All of it is DataFrame functions. A rule table of up to ``BROADCAST_RULES`` rows is broadcast;
beyond that the join is shuffled, and salted, since many URLs share a short expression.

Defined results: a null URL, or one without ``://``, has an empty host and path and no rule.
Repeated rows are judged each. Null and empty rules are ignored; a rule given as both allow and
block blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_RULES = 500_000
SALTS = 32
#: Hex digits of the hash prefix that the join uses.
PREFIX_DIGITS = 8
DEFAULT_VERDICT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1)).otherwise(None)
    rest = F.when(rest.isNotNull(), F.substr(url, F.length(rest) + 4)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(verdict, rule) from pairs such as ("block", "example.org/es/")."""
    rows = F.array(*(
        F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule")) for v, r in rules
    ))
    return spark.range(1).select(F.inline(rows))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url)."""
    text = F.col("rule")
    given = rules.filter(text != "").groupBy("rule").agg(F.max("verdict").alias("verdict"))
    given = given.select("rule", "verdict", F.substring_index(text, "/", 1).alias("host")).select(
        "rule", "verdict", _digest(text).alias("digest"),
        F.substr(_digest(text), F.lit(1), F.lit(PREFIX_DIGITS)).alias("prefix"),
        F.size(F.split("host", r"\.")).alias("labels"),
        (F.length(text) - F.length("host")).alias("letters"),
    )
    shapes = given.select("labels", "letters").distinct().orderBy("labels", "letters").collect()
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(
        F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"),
        path.alias("path"),
    )
    if not shapes:
        return parsed.select(
            "page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
            F.lit(DEFAULT_VERDICT).alias("verdict"),
        )
    labels = F.split("host", r"\.")
    wanted = F.array(*(
        F.struct(F.lit(s["labels"]).alias("labels"), F.lit(s["letters"]).alias("letters"))
        for s in shapes
    ))
    fits = F.filter(
        wanted,
        lambda s: (s["labels"] <= F.size(labels)) & (s["letters"] <= F.length("path"))
        & (F.col("host") != ""),
    )
    expressions = F.transform(fits, lambda s: F.concat(
        F.array_join(F.slice(labels, F.size(labels) - s["labels"] + 1, s["labels"]), "."),
        F.substr(F.col("path"), F.lit(1), s["letters"]),
    ))
    expanded = parsed.select("*", F.explode_outer(expressions).alias("expression")).select(
        *parsed.columns, _digest(F.col("expression")).alias("digest"),
        F.substr(_digest(F.col("expression")), F.lit(1), F.lit(PREFIX_DIGITS)).alias("prefix"),
    )
    given = given.select("prefix", F.col("digest").alias("rule_digest"), "rule", "verdict")
    # The short prefix finds candidates; the whole digest decides.
    if given.count() <= BROADCAST_RULES:
        met = expanded.join(F.broadcast(given), "prefix", "left")
    else:
        salted = given.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = expanded.withColumn("salt", (F.col("row") % SALTS).cast("int")).join(
            salted, ["prefix", "salt"], "left"
        )
    best = F.when(
        F.col("digest") == F.col("rule_digest"),
        F.struct(F.length("rule").alias("size"), "verdict", "rule"),
    )
    # Rows come from one scan and carry their page along; of a row's expressions the best is taken
    # in the task before anything is shuffled.
    return met.groupBy("row").agg(
        F.max(best).alias("best"), F.max("page_id").alias("page_id"), F.max("host").alias("host"),
        F.max("path").alias("path"),
    ).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
    )
