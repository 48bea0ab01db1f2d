"""Quality rules: a ledger of failure bits, read by versioned policies.

Every rule is evaluated once a row: ``ledger`` stores the measurements and one integer whose bit k
says that rule k failed. A policy is a version with two masks: one failed rule of ``fatal`` rejects
a row, and so do ``allowed`` + 1 failed rules of ``counted``. Another policy reads the stored bits
and no text; the ablation of a policy (what each rule alone rejects) comes from the counts of the
distinct bit patterns, of which there are at most 2 to the number of rules.

DataFrame functions only. All work on a text stays in its row: the three-word windows of a row are
sorted by hash beside each other, so a row costs n log n of its words and nothing is shuffled.
Windows are told apart by 64-bit hashes of their words.

Defined results: a null text has no words. No words: all measurements 0, ``too_short`` fails. Rows
are judged each for itself, so repeated rows and repeated or null ids change nothing. Columns of
the input whose names clash with those of the ledger are not carried along. An empty table gives an
empty ledger and an ablation of zeros.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words, and the characters that count as symbols.
SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def _repeated(words: Column) -> Column:
    """How many words lie in windows that occur twice or more; windows may overlap."""
    last = F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))
    windows = F.transform(
        F.slice(words, F.lit(1), last),
        lambda word, i: F.struct(
            F.xxhash64(word, *(F.get(words, i + k) for k in range(1, WINDOW))).alias("h"),
            i.alias("at"),
        ),
    )

    def places(by_hash: Column) -> Column:
        twice = F.filter(by_hash, lambda x, i: (x["h"] == F.get(by_hash, i - 1)["h"]) | (
            x["h"] == F.get(by_hash, i + 1)["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    return _let(F.sort_array(windows), lambda by_hash: _let(places(by_hash), covered))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit("[^\\x20\\x09-\\x0D]")))


def measured(documents: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, the measurements) for every row, each computed once."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeated(words).cast("long").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    kept = F.translate(content, SYMBOLS, "")
    return documents.select(
        "doc_id",
        F.inline(F.array(F.struct(
            _let(words_of(content), of_words).alias("w"),
            _let(_lines(content), of_lines).alias("l"),
            (F.length(content) - F.length(kept)).cast("long").alias("n_symbols"),
        ))),
    ).select("doc_id", *(
        F.col({"n_lines": "l.n_lines", "n_dup_lines": "l.n_dup_lines", "n_symbols": "n_symbols"}
              .get(name, f"w.{name}")).alias(name)
        for name in MEASURES
    ))


@dataclass(frozen=True)
class Rule:
    """A name and the condition, over the measurements, under which a row fails."""

    name: str
    fails: str


#: The order gives the bits, so new rules go to the end. Ratios are compared in integers.
RULES: tuple[Rule, ...] = (
    Rule("too_short", "n_words < 50"),
    Rule("half_repeated", "100 * n_repeat_words > 50 * n_words"),
    Rule("too_long", "n_words > 1000000"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("some_repeated", "100 * n_repeat_words > 20 * n_words"),
    Rule("wordy_symbols", "100 * n_symbols > 5 * n_words"),
    Rule("some_repeated_lines", "100 * n_dup_lines > 15 * n_lines"),
)


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    """The integer with the bits of these rules."""
    place = {rule.name: k for k, rule in enumerate(rules)}
    return sum(1 << place[name] for name in set(names))


@dataclass(frozen=True)
class Policy:
    """Which failures reject a row: any of ``fatal``, or more than ``allowed`` of ``counted``."""

    version: str
    fatal: tuple[str, ...]
    counted: tuple[str, ...] = ()
    allowed: int = 1

    def rejects(self, bits: Column, rules: Sequence[Rule] = RULES) -> Column:
        counted = F.bit_count(bits.bitwiseAND(F.lit(mask(self.counted, rules)).cast("long")))
        return (bits.bitwiseAND(F.lit(mask(self.fatal, rules)).cast("long")) != 0) | (
            counted > self.allowed)


BASE = Policy("base", ("too_short", "half_repeated"))
POLICIES: dict[str, Policy] = {
    "base": BASE,
    "v1": Policy("v1", (*BASE.fatal, "too_long", "short_words", "long_words", "many_symbols",
                        "repeated_lines")),
    "v2": Policy("v2", (*BASE.fatal, "too_long", "short_words", "long_words", "many_symbols",
                        "repeated_lines"),
                 counted=("some_repeated", "wordy_symbols", "some_repeated_lines")),
}


def ledger(documents: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """(doc_id, measurements, failed): bit k of ``failed`` is set where rule k fails.

    A condition that is null, which the given rules never are, does not count as a failure. At
    most 63 rules fit.
    """
    if len(rules) > 63:
        raise ValueError("a ledger holds at most 63 rules")
    failed = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bit = F.when(F.expr(rule.fails), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
        failed = failed.bitwiseOR(bit)
    return measured(documents, text).withColumn("failed", failed)


def apply(entries: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` by one policy."""
    bits = F.col("failed")
    return entries.withColumns({
        "base_failed": BASE.rejects(bits, rules),
        "kept": ~policy.rejects(bits, rules) & ~BASE.rejects(bits, rules),
    })


def patterns(entries: DataFrame) -> DataFrame:
    """(failed, n_rows): how often each pattern of failures occurs; added up before the shuffle."""
    return entries.groupBy("failed").agg(F.count(F.lit(1)).alias("n_rows"))


def ablation(entries: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(policy, rule, n_failed, n_rejected, n_only): rows that fail each rule, those among them
    that the policy rejects, and those that it would keep without this rule.

    Works on the counts of patterns only; one row a rule, also for an empty ledger.
    """
    counts = patterns(entries)
    bits = F.col("failed")

    def without(bit: int) -> Column:
        return ~policy.rejects(bits.bitwiseAND(F.lit(~bit).cast("long")), rules)

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n_rows"))), F.lit(0).cast("long"))

    sums = []
    for k, rule in enumerate(rules):
        fails = bits.bitwiseAND(F.lit(1 << k).cast("long")) != 0
        sums.append(F.struct(
            F.lit(policy.version).alias("policy"), F.lit(rule.name).alias("rule"),
            rows(fails).alias("n_failed"),
            rows(fails & policy.rejects(bits, rules)).alias("n_rejected"),
            rows(fails & policy.rejects(bits, rules) & without(1 << k)).alias("n_only"),
        ))
    return counts.agg(F.array(*sums).alias("rules")).select(F.inline("rules"))


def common_failures(entries: DataFrame, by: str) -> DataFrame:
    """(by, n_rows, any_failed, all_failed): the rules that some and that all rows of a group fail."""
    return entries.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bit_or("failed").alias("any_failed"),
        F.bit_and("failed").alias("all_failed"),
    )


def judge(documents: DataFrame, policy: Policy = POLICIES["v2"]) -> DataFrame:
    """The measurements, failure bits, base verdict and verdict of every row."""
    return apply(ledger(documents), policy).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed",
    )
