"""Awkward pages, labels, ids and rule tables that once went wrong."""

from __future__ import annotations

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import (
    caches, decontamination, html, jaccard, licenses, packing, queries, toxicity, urls,
)


@pytest.mark.parametrize("page", [
    '<a "' * 250_000, "<" * 1_000_000, "<a" * 500_000, '<a ">" ' * 150_000, "<!--" * 250_000,
    "<!x " * 250_000, "<p class=\"x>y'>t" * 60_000,
], ids=["open quotes", "signs", "names", "quoted ends", "comments", "declarations", "mixed quotes"])
def test_broken_pages_take_linear_time(page):
    start = time.process_time()
    assert len(list(html.tokens(page))) >= 0
    assert time.process_time() - start < 8


def test_tags_with_quotes():
    def names(page):
        return [(kind, name) for kind, name, *_ in html.tokens(page)]

    assert names('<p title="a > b">x</p>') == [("open", "p"), ("text", "x"), ("close", "p")]
    assert names('<p title="a>x</p>')[0] == ("open", "p")
    assert names("a < b <p>x") == [("text", "a < b "), ("open", "p"), ("text", "x")]
    assert names("<p>x<b") == [("open", "p"), ("text", "x<b")]


@pytest.mark.parametrize("page, text", [
    ('<article><header class="entry-header"><h1>Head</h1></header><p>Body</p></article>', "Head Body"),
    ('<div class="has-sidebar"><article><p>Body</p></article></div>', "Body"),
    ('<div class="layout sidebar-right"><article><p>Body</p></article>'
     '<div class="sidebar"><p>Side</p></div></div>', "Body"),
    ('<article><p>Main</p></article><article class="comment"><p>Said</p></article>', "Main"),
    ('<div class="related"><article><p>Other</p></article></div><article><p>Main</p></article>', "Main"),
    ('<article><p>Main</p><div class="social-share"><p>Share</p></div></article>', "Main"),
    ('<header class="site-header"><p>Site</p></header><main><p>Main</p></main>', "Main"),
])
def test_labels(page, text):
    assert html.text_of(page, {}) == text


def test_runs_of_an_alignment_are_equal_and_whole(monkeypatch):
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(40))] for _ in "ab")
        monkeypatch.setattr(html, "COMPARED", rng.choice([0, 20, 10**6]))
        runs = html.opcodes(a, b)
        assert [x for _, i, j, *_ in runs for x in a[i:j]] == a
        assert [x for *_, k, m in runs for x in b[k:m]] == b
        for what, i, j, k, m in runs:
            assert (a[i:j] == b[k:m]) == (what == "equal")


def test_alignment_of_large_pages_takes_little_time():
    rng = random.Random(2)
    a, b = ([rng.choice("pdq") for _ in range(50_000)] for _ in "ab")
    a[25_000], b[24_000] = "only", "only"
    start = time.process_time()
    assert any(what == "equal" and i <= 25_000 < j and 25_000 - i == 24_000 - k
               for what, i, j, k, _ in html.opcodes(a, b))
    assert time.process_time() - start < 5


def test_exception_phrases_excuse_the_hits_they_cover():
    phrases = [f"word{i} idiot" for i in range(3000)]
    lexicon = toxicity.Lexicon({" idiot": 2.0}, phrases)
    words = [w for i in range(3000) for w in (f"word{i}", "idiot")] + ["an", "idiot"]
    start = time.process_time()
    assert [w for _, w, _ in lexicon.hits(words)] == ["idiot"]
    assert time.process_time() - start < 3


@pytest.mark.parametrize("digits, rules", [(8, 500_000), (1, 500_000), (1, 0)])
def test_url_rules_do_not_depend_on_the_prefix_or_the_join(spark, monkeypatch, digits, rules):
    monkeypatch.setattr(urls, "PREFIX_DIGITS", digits)
    monkeypatch.setattr(urls, "BROADCAST_RULES", rules)
    given = [(i, f"http://h{i % 7}.x{i % 40}.org/p{i % 11}/q") for i in range(300)] + [(None, None), (1, "x")]
    pages = spark.createDataFrame(given, "page_id long, url string").repartition(5)
    table = [("block", f"x{i}.org/p{i % 5}") for i in range(40)] + [("allow", "org/"), ("block", "h1.x1.org/")]
    found = sorted(map(repr, map(tuple, urls.judge(pages, urls.rule_table(spark, table)).collect())))

    def plain(page_id, url):
        if url is None or "://" not in url:
            return (page_id, "", "", None, "allow")
        host, _, path = url.split("://", 1)[1].partition("/")
        fits = [(len(r), v, r) for v, r in table
                if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
                and ("/" + path).startswith("/" + r.partition("/")[2])]
        size, verdict, rule = max(fits, default=(0, "allow", None))
        return (page_id, host, "/" + path, rule, verdict)

    assert found == sorted(repr(plain(*row)) for row in given)


def test_urls_are_read_in_one_scan(spark):
    pages = queries.table(spark, "/root/testdata/sf0.001", "pages")
    text = urls.judge(pages, urls.rule_table(spark, queries.URL_RULES))._jdf.queryExecution(
    ).executedPlan().toString()
    assert text.count("FileScan parquet") == 1


def test_licenses_of_rows_under_one_id_or_none(spark):
    notice = "Licensed under the Apache License, Version 2.0 (the License)"
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy"
    known = licenses.templates(spark, [("Apache", notice), ("MIT", mit)])
    rows = [(7, f"one {notice} end"), (7, f"two {notice} and {mit}"), (None, f"a {mit}"), (None, f"b {mit}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r["doc_id"]), r["license"]) for r in licenses.scan(docs, known).collect())
    assert found == [("7", "Apache"), ("7", "Apache"), ("7", "MIT"), ("None", "MIT"), ("None", "MIT")]


def test_join_of_texts_that_share_nothing_in_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BUCKET", 3)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(40)] + [(40, "a b c d e f g")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {tuple(r) for r in jaccard.classes(docs).collect()} == {
        *((i, 26, i) for i in range(40)), (40, 3, 40)}


def test_no_document_query_has_a_cross_or_nested_loop_join(spark):
    for name in ("op2_url_filters", "op6_decontamination", "op11_quality_rules"):
        text = queries.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution(
        ).executedPlan().toString()
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_removal_agrees_with_the_report(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    items = queries.table(spark, "/root/testdata/sf0.01", "benchmark")
    bad = {r["doc_id"] for r in decontamination.report(docs, items).filter("contaminated").collect()}
    kept = decontamination.remove(docs, items)
    assert kept.columns == docs.columns and bad
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {
        r["doc_id"] for r in docs.select("doc_id").collect()} - bad


def test_a_worker_gives_back_what_other_operators_left():
    """Freed memory of one operator does not stay with the worker while the next one runs."""
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    caches.claim("first")
    held = [bytes(600) for _ in range(400_000)]
    kept = held[::1000]  # the last blocks stay in use, so that the heap does not shrink by itself
    kept.append(bytes(600))
    full = resident()
    del held
    caches.claim("second")
    assert len(kept) and full - resident() > 100_000_000


def test_packing_holds_few_rows_at_once(spark):
    rows = packing.TOGETHER_ROWS * 2 + 1
    batch = pa.RecordBatch.from_pydict({"n": pa.array(range(rows))})
    cut = [b.num_rows for b in packing._sliced([batch])]
    assert cut == [packing.TOGETHER_ROWS, packing.TOGETHER_ROWS, 1]
    texts = spark.range(rows).repartition(1).selectExpr("id AS doc_id", "'a word' AS text")
    got = packing.pack(texts, queries.tokenizer()).selectExpr("sum(length)", "count(distinct doc_id)").first()
    assert got[1] == rows and got[0] == rows * 3
