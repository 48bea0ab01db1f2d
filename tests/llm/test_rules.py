"""The quality rule ledger against a plain version, and its policies and ablations."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.llm import rules

SCHEMA = "doc_id long, text string, failed string, w int, kept int, n_words int"
WORD = r"[^\x20\x09-\x0D]+"


def plain(text: str | None) -> dict:
    words = re.findall(WORD, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
        "base_failed": n < 50 or 100 * len(hit) > 50 * n,
    }


TEXTS = [
    None, "", " \n\t ", "one", "a b", "a b c", "a b c a b c", "a a a a", "a a a", "x\r\nx\r\ny\ny ",
    "a\x0bb\x0cc\x85d\xa0e", "Ünïcödé 日本語 😀 😀 😀 # * $ % & | < >", "\n".join(["same line"] * 60),
    " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i % 7}" for i in range(200)),
    " ".join(f"w{i}" for i in range(120_000)) + " w1 w2 w3", "w " * 30_000, "a\n\nb\n\na\n",
]


def table(spark, texts):
    return spark.createDataFrame([(i, t, "x", 0, 1, 2) for i, t in enumerate(texts)], SCHEMA)


def found(spark, texts) -> list[dict]:
    rows = rules.judge(table(spark, texts)).collect()
    return [r.asDict() for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_measurements_on_awkward_texts(spark):
    for text, row in zip(TEXTS, found(spark, TEXTS), strict=True):
        expected = plain(text)
        assert {k: row[k] for k in expected} == expected, text and text[:60]
        assert not (row["base_failed"] and row["kept"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n\t\r#é<", max_size=60), min_size=1, max_size=60))
def test_measurements_on_any_text(spark, texts):
    for text, row in zip(texts, found(spark, texts), strict=True):
        expected = plain(text)
        assert {k: row[k] for k in expected} == expected, repr(text)


def test_repeated_rows_null_ids_and_no_rows(spark):
    twice = table(spark, ["a b c"]).union(table(spark, ["a b c"])).withColumn(
        "doc_id", F.lit(None).cast("long"))
    assert rules.judge(twice).count() == 2
    none = table(spark, ["x"]).limit(0)
    assert rules.judge(none).count() == 0
    empty = rules.ablation(rules.ledger(none), rules.POLICIES["v2"]).collect()
    assert len(empty) == len(rules.RULES) and all(r["n_failed"] == 0 for r in empty)


def test_bits_policies_and_ablations_agree_with_the_conditions(spark):
    texts = TEXTS + [" ".join(f"w{i}" for i in range(60 + k)) + " #" * k for k in range(12)]
    entries = rules.ledger(table(spark, texts))
    conditions = entries.select(
        "doc_id", "failed", *(F.expr(r.fails).alias(r.name) for r in rules.RULES)).collect()
    for row in conditions:
        assert row["failed"] == rules.mask([r.name for r in rules.RULES if row[r.name]])
    for policy in rules.POLICIES.values():
        def rejected(names, policy=policy):
            return bool(names & set(policy.fatal)) or len(names & set(policy.counted)) > policy.allowed

        failing = [{r.name for r in rules.RULES if row[r.name]} for row in conditions]
        kept = {r["doc_id"]: r["kept"] for r in rules.apply(entries, policy).collect()}
        for row, names in zip(conditions, failing, strict=True):
            assert kept[row["doc_id"]] == (not rejected(names | set()) and not rejected(
                names & set(rules.BASE.fatal)))
        for row in rules.ablation(entries, policy).collect():
            with_rule = [names for names in failing if row["rule"] in names]
            assert row["n_failed"] == len(with_rule)
            assert row["n_rejected"] == sum(map(rejected, with_rule))
            assert row["n_only"] == sum(
                rejected(names) and not rejected(names - {row["rule"]}) for names in with_rule)


def test_common_failures_by_group(spark):
    entries = rules.ledger(table(spark, ["a", "b c", " ".join(f"word{i}" for i in range(60))]))
    row = entries.withColumn("g", F.lit(1)).transform(
        lambda df: rules.common_failures(df, "g")).first()
    assert row["n_rows"] == 3 and row["all_failed"] == 0
    assert row["any_failed"] & rules.mask(["too_short"])


def test_only_jvm_functions_and_one_scan(spark):
    text = rules.judge(table(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text


def test_too_many_rules_are_refused(spark):
    with pytest.raises(ValueError):
        rules.ledger(table(spark, ["a"]), [rules.Rule(str(k), "true") for k in range(64)])
