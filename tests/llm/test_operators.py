"""Each operator on awkward rows, against plain versions, the library, or held-out labels."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import (
    decontamination,
    fingerprints,
    html,
    jaccard,
    licenses,
    packing,
    quality,
    queries,
    tokens,
    toxicity,
    urls,
)
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefghij") + str(rng.randrange(60)) for _ in range(n))


def awkward_rows() -> list[tuple]:
    base = sentence(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    return [
        (1, base), (2, near), (3, base), (3, base), (4, None), (5, ""), (6, " \n\t"),
        (7, "two words"), (8, "Two  words"), (9, sentence(2, 40)), (10, sentence(3, 20_000)),
        (11, "Grüße, naïve café — 日本語 <|endoftext|> it's 'll   x\n \n y"), (12, None),
        (13, near + " and a little more"), (14, sentence(2, 39)),
    ]


@pytest.fixture(scope="module")
def documents(spark):
    schema = "doc_id long, text string, n long, row long, score double, kept string, class string"
    rows = [(*r, None, 1, 0.0, None, "x") for r in awkward_rows()]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def no_documents(documents):
    return documents.limit(0)


@pytest.fixture(scope="module")
def no_ids(spark):
    return spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f")],
                                 "doc_id long, text string")


def table(spark, name):
    return queries.table(spark, FOLDER, name)


def same(a, b) -> bool:
    return sorted(map(repr, a)) == sorted(map(repr, b))


def test_quality_on_held_out_labels(spark):
    labels = table(spark, "labels").select("doc_id", "quality")
    rows = quality.classify(table(spark, "documents"), table(spark, "labels")).join(
        labels, "doc_id").filter("held_out").collect()
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_on_held_out_labels(spark):
    labels = table(spark, "labels").select("doc_id", "toxic")
    rows = toxicity.classify(table(spark, "documents"), table(spark, "labels")).join(
        labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.93


def test_classifiers_on_awkward_rows(spark, documents, no_documents):
    none = table(spark, "labels").limit(0)
    for classify in (quality.classify, toxicity.classify):
        assert classify(documents, none).count() == len(awkward_rows())
        assert classify(no_documents, table(spark, "labels")).count() == 0
    learned = table(spark, "documents"), table(spark, "labels")
    for keep in (quality.keep_good, toxicity.keep_clean):
        assert keep(documents, *learned).columns == documents.columns


def test_lexicon_folds_letters_and_honours_exceptions():
    lexicon = toxicity.Lexicon({" idiot": 5.0}, ("idiot proof",))
    words = toxicity.folded_words
    assert [w for _, w, _ in lexicon.hits(words("An 1d10t and an ІDІОT, idiots!"))] == [
        "idiot", "idiot", "idiots"]
    assert lexicon.hits(words("an idiot proof lamp in 1010")) == []
    assert lexicon.hits([]) == []


def test_url_filters_on_awkward_rows(spark):
    given = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.ORG/es/x?y"),
        (5, "http://example.org/en/12"), (6, "http://badexample.org/es/"), (7, "http://x.com/de/"),
        (8, "http://x.com/fr/#a"), (9, "http://org"), (9, "http://org"), (10, "ftp://a://b/c"),
        (11, "http://" + "a." * 300 + "org/"),
    ]
    pages = spark.createDataFrame(given, "page_id long, url string").withColumn("rule", F.lit(1))
    rules = urls.rule_table(spark, queries.URL_RULES)
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
             for r in urls.judge(pages, rules).collect()}
    assert urls.judge(pages, rules).count() == len(given)
    assert found[1] == found[2] == found[3] == ("", "", None, "allow")
    assert found[4] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert found[5][2:] == ("example.org/en/1", "block")
    assert found[6][2:] == ("org/", "allow")
    assert found[7][2:] == ("com/de/", "block") and found[8][2:] == ("com/fr/", "allow")
    assert found[9] == ("org", "", None, "allow") and found[10][0] == "a:"
    assert found[11][2] == "org/"
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert urls.judge(pages, rules.limit(0)).filter("rule is not null").count() == 0


@pytest.mark.parametrize("bits, axes", [(3, 2), (2, 4)])
def test_hilbert_curve_visits_neighbours(bits, axes):
    cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * axes), -1).reshape(-1, axes)
    keys = packing.hilbert_key(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_packing(rows, texts) -> None:
    library = tokens.PreTokens(queries.tokenizer())
    wanted = sorted((d if d is not None else -1, [*library.encode(t or ""), 0]) for d, t in texts)
    ids = {}
    for d, x in wanted:
        ids.setdefault(d, []).append(x)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert any(
            zlib.crc32(np.array(x[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
            == r["ids_crc32"] and len(x) == r["doc_tokens"]
            for x in ids[r["doc_id"] if r["doc_id"] is not None else -1]
        )
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0
    assert sum(r["length"] for r in rows) == sum(len(x) for _, x in wanted)


def test_packing(documents, no_documents, no_ids):
    check_packing(packing.pack(documents, queries.tokenizer()).collect(), awkward_rows())
    check_packing(packing.pack(no_ids, queries.tokenizer()).collect(),
                  [(None, "a b c d e f")] * 2)
    assert packing.pack(no_documents, queries.tokenizer()).count() == 0


def test_ngram_join(spark, documents, no_documents, no_ids):
    found = [tuple(r) for r in jaccard.classes(documents).collect()]
    assert same(found, brute.components(awkward_rows()))
    assert jaccard.classes(no_documents).count() == 0
    assert [tuple(r) for r in jaccard.classes(no_ids).collect()] == [(None, 2, None)] * 2
    assert jaccard.keep_one(no_ids).count() == 1
    kept = jaccard.keep_one(documents)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(
        {c for _, _, c in brute.components(awkward_rows())})


def test_keep_one_keeps_a_document_of_each_group_where_ids_repeat(spark):
    a, b, c = sentence(21, 90), sentence(22, 90), sentence(23, 90)
    rows = [(3, a), (7, a + " z"), (7, b), (8, b + " z"), (9, c), (9, c), (9, c + " z"), (9, a + " y"),
            (None, c + " y"), (5, ""), (5, ""), (5, None), (5, " "), (4, sentence(24, 90))]
    rows += [(4, sentence(25, 90)), (None, sentence(26, 90))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = sorted(map(repr, map(tuple, jaccard.keep_one(frame).collect())))
    assert sum("(9, " in r for r in kept) == 1
    assert [r for r in kept if "(9, " not in r] == sorted(map(repr, [
        (3, a), (7, b), rows[-3], rows[-2], rows[-1], (5, ""), (5, None), (5, " ")]))
    assert all(f"(9, '{c}" in r for r in kept if "(9, " in r)


def test_keep_one_with_text_ids_null_ids_and_a_clashing_column(spark):
    a, b = sentence(31, 90), sentence(32, 90)
    rows = [("k1", a, 1), ("k0", a + " z", 2), (None, b, 3), (None, b, 4), (None, b + " z", 5),
            (None, a + " y", 6), (None, None, 7), (None, "", 8)]
    frame = spark.createDataFrame(rows, "doc_id string, text string, own_class int").repartition(3)
    kept = [tuple(r) for r in jaccard.keep_one(frame).collect()]
    assert ("k0", a + " z", 2) in kept and (None, None, 7) in kept and (None, "", 8) in kept
    assert len(kept) == 4 and sum(r[0] is None and bool(r[1]) for r in kept) == 1


def test_ngram_join_of_a_large_group_with_common_passages(spark, monkeypatch):
    """Many near copies, some too far from each other, and a passage that many texts share."""
    monkeypatch.setattr(jaccard, "PIECE", 7)
    rng, rows = random.Random(4), []
    base, passage = sentence(5, 60).split(), sentence(6, 30)
    for k in range(60):
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, passage + " " + sentence(100 + k, 12 + k % 9)) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert same([tuple(r) for r in jaccard.classes(frame).collect()], brute.components(rows))


def test_token_counts(documents, no_documents):
    library = tokens.PreTokens(queries.tokenizer())
    found = [tuple(r) for r in tokens.count_tokens(documents, queries.tokenizer()).collect()]
    wanted = []
    for doc_id, text in awkward_rows():
        n = len(library.encode(text or ""))
        wanted.append((doc_id, len((text or "").encode()), n, n > 1024))
    assert same(found, wanted)
    assert tokens.count_tokens(no_documents, queries.tokenizer()).count() == 0


def test_every_checked_character_is_cut_as_the_library_does():
    encoder = tokens.Ids(queries.tokenizer())
    rng = random.Random(1)
    letters = [chr(c) for c in (*range(0x250), *range(0x2010, 0x2028), 0x20AC)]
    for _ in range(3000):
        text = "".join(rng.choices([*letters, " ", " ", "'", "s", "\n", "1"], k=rng.randrange(12)))
        own = np.frombuffer(encoder.of(text), encoder.dtype).tolist()
        assert own == encoder.pre_tokens.encode(text), repr(text)


def test_decontamination(spark, documents, no_documents):
    first = awkward_rows()[0][1]
    items = [(1, " ".join(first.split()[20:50])), (2, "Two words"), (2, "Two words"), (3, None),
             (None, sentence(2, 40)), (4, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    wanted = [(d, *brute.contamination(t, items)) for d, t in awkward_rows()]
    found = [tuple(r) for r in decontamination.report(documents, benchmark).collect()]
    assert same(found, wanted)
    left = decontamination.remove(documents, benchmark)
    assert left.columns == documents.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(w[0] for w in wanted if not w[5])
    assert decontamination.report(no_documents, benchmark).count() == 0
    assert decontamination.remove(documents, benchmark.limit(0)).count() == len(wanted)


def test_decontamination_in_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 1)
    first = awkward_rows()[0][1].split()
    items = [(k, " ".join(first[10 * k : 10 * k + 20])) for k in range(4)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    wanted = [(d, *brute.contamination(t, items)) for d, t in awkward_rows()]
    assert same([tuple(r) for r in decontamination.report(documents, benchmark).collect()], wanted)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style>
<script>var t="</p><article>no</article>";</script></head><body><nav><ul><li><a>Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy {n}</div>
<article><h1>Title {n}</h1><p>A &amp; B&nbsp; <b>bo</b>ld<br>line {n}<p>Second</p><form>Mail?</form></article>
<aside>Side</aside><div id="comments"><p>Nice {n}!</p></div><footer>Foot</footer></body></html>"""


def test_html_extraction(spark):
    rows = [(k, f"http://h{k % 2}.org/{k}", PAGE.format(n=k)) for k in range(6)]
    rows += [(6, None, None), (7, "http://h0.org/", ""), (8, "http://x.org", "plain <b>text"),
             (9, "http://h0.org/", "<article><p>cut <script>x"), (0, "http://h0.org/0", PAGE.format(n=0))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = html.extract(pages).collect()
    assert len(found) == len(rows)
    texts = {r["page_id"]: r["text"] for r in found}
    assert all(texts[k] == f"Title {k} A & B bold line {k} Second" for k in range(6))
    assert texts[6] == texts[7] == "" and texts[8] == "plain text" and texts[9] == "cut"
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>T</title><body><article><p>whole text</p></article>", "whole text"),
    ("<head><title>T</title><meta x><template><p>no</p></template><p>yes", "yes"),
    ("<article><svg/><p>whole text</p></article>", "whole text"),
    ("<article><svg><title/><text>no</text></g><p>whole text</p></article>", "whole text"),
    ("<article><button>no<p>whole text</p></article>", "whole text"),
    ("<article><div><select><option>no</div><p>whole text</p></article>", "whole text"),
    ("<article><button><div>no</div></button><canvas><p>no</p></canvas><p>yes", "yes"),
    ("<article><p>a <math><mi>x</mi></math> <object data=q>c</object></article>", "a x c"),
    ("<article><p>a<svg><text>no</text></svg>b <textarea><p>no", "ab"),
])
def test_html_elements_without_an_end(page, text):
    assert html.text_of(page, {}) == text


PLAIN = "<body><div id=top>Shop</div><div class=content><h1>Title {n}</h1><p>Text {n}</p></div></body>"


def texts_of(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r["page_id"]: r["text"] for r in html.extract(pages).collect()}


def test_html_pages_of_one_host_are_judged_by_their_own_template(spark):
    rows = [(k, f"http://h.org/{k}", PAGE.format(n=k)) for k in range(4)]
    rows += [(k, f"http://h.org/{k}", PLAIN.format(n=k)) for k in range(4, 8)]
    rows += [(8, None, PAGE.format(n=8)), (9, "no scheme", PLAIN.format(n=9)), (10, None, PLAIN.format(n=9))]
    texts = texts_of(spark, rows)
    assert all(texts[k] == f"Title {k} A & B bold line {k} Second" for k in (0, 1, 2, 3, 8))
    assert all(texts[k] == f"Title {k} Text {k}" for k in range(4, 8))
    assert texts[9] == texts[10] == "Shop Title 9 Text 9"


def test_html_copies_of_a_page_are_no_template(spark):
    rows = [(k, "http://copies.org/", PLAIN.format(n=1)) for k in range(5)]
    rows += [(k, "http://varied.org/", PLAIN.format(n=k % 2)) for k in range(10, 16)]
    texts = texts_of(spark, rows)
    assert all(texts[k] == "Shop Title 1 Text 1" for k in range(5))
    assert all(texts[k] == f"Title {k % 2} Text {k % 2}" for k in range(10, 16))


def test_html_link_lists_and_template_text_in_articles(spark):
    menu = "<ul>" + "".join(f"<li><a href=/{{n}}{j}>Go {{n}}{j}</a></li>" for j in range(3)) + "</ul>"
    body = "<h2><a>Head {n}</a></h2><p><a>Link {n}</a><ul><li>Item {n} <a>x</a></ul>"
    same = "<div class=lead>Read daily</div>"
    rows = [(k, "http://a.org/", (f"<div>{menu}</div><div class=c>{body}</div>").format(n=k)) for k in range(4)]
    rows += [(10 + k, "http://b.org/", f"<article>{menu}{same}{body}</article>".format(n=k)) for k in range(4)]
    rows += [(20, None, f"<main>{menu}{same}{body}</main>".format(n=5))]
    texts = texts_of(spark, rows)
    for k in range(4):
        assert texts[k] == texts[10 + k] == f"Head {k} Link {k} Item {k} x"
    assert texts[20] == "Read daily Head 5 Link 5 Item 5 x"
    assert html.text_of("<ul><li><a>Go</li><li>plain and long text", {}) == "Go plain and long text"


def test_slots_beyond_a_bounded_wrapper_keep_their_evidence(spark, monkeypatch):
    """A host of many templates: the text of a place is not template where a lost slot varies."""
    monkeypatch.setattr(html, "MAX_PARTS", 4)
    pages = [
        f"<div><p>{'a' if k < 4 else k}</p></div>" + "".join(f"<h{j}>t{j}</h{j}>" for j in range(1, k % 6))
        + f"<div><p>b{k}</p></div><pre>same</pre>" for k in range(12)
    ]
    for order in (pages, pages[::-1], pages[5:] + pages[:5]):
        whole, beyond = html.parts_of(order[0]), {}
        for page in order[1:]:
            whole = html.align(whole, html.parts_of(page), beyond, 4)
        known = html.decisions([*whole, *beyond.values()])
        assert all(html.place_of(path)[0] in known for page in pages
                   for kind, (path, *_) in html.placed(page) if kind == "text")
        assert all(f"b{k}" in html.text_of(page, known).split() for k, page in enumerate(pages))
        assert beyond and len(whole) <= max(4, len(html.parts_of(order[0])))
    evidence = html.wrappers(spark.createDataFrame(
        [("h.org", page) for page in pages], "host string, html string").repartition(3))[1]
    assert evidence.count() > 0
    texts = texts_of(spark, [(k, "http://h.org/", page) for k, page in enumerate(pages)])
    assert all(f"b{k}" in texts[k].split() for k in texts)


def test_wrappers_are_union_free_expressions():
    pages = ["<ul><li>a</li></ul><p>x</p>", "<ul><li>b</li><li>c</li></ul><p>x</p><h2>z</h2>"]
    whole = html.align(html.parts_of(pages[0]), html.parts_of(pages[1]))
    assert html.expression(whole) == "<ul>(<li>#</li>)+</ul><p>x</p>(<h2>z</h2>)?"


def test_fingerprints(documents, no_documents, no_ids):
    rows = fingerprints.compare(documents).collect()
    order = sorted(awkward_rows(), key=lambda r: (-r[0], r[1] or ""))
    wanted = []
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        changed = fingerprints.edited(text, following)
        a, b, c = map(fingerprints.fingerprint, (text, changed, following))
        wanted.append((doc_id, len(text), a.hex(), b.hex(), fingerprints.likeness(a, b),
                       fingerprints.likeness(a, c)))
    found = [(r["doc_id"], r["n_chars"], r["fingerprint"], r["edited_fingerprint"],
              r["near_edited"], r["near_next"]) for r in rows]
    assert same(found, wanted)
    assert fingerprints.compare(no_documents).count() == 0
    assert [r["near_next"] for r in fingerprints.compare(no_ids).collect()] == [1.0, 1.0]


def test_fingerprints_estimate_similarity(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_PART", 50)
    rows = [r[:2] for r in table(spark, "documents").select("doc_id", "text").collect()]
    found = {r["doc_id"]: r for r in fingerprints.compare(table(spark, "documents")).collect()}
    order = sorted(rows, reverse=True)
    errors = []
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        changed = fingerprints.edited(text, following)
        a, b = brute.shingles(text), brute.shingles(changed)
        errors.append(found[doc_id]["near_edited"] - (len(a & b) / len(a | b) if a | b else 1))
    assert len(found) == len(rows) and np.abs(errors).mean() < 0.03 and abs(np.mean(errors)) < 0.01


def test_license_scans(spark, documents, no_documents):
    notice = dict(licenses.NOTICES)["GPL-3.0"]
    mit = next(t for n, t in licenses.NOTICES if n == "MIT")
    long_notice = licenses.NOTICES[1][1]
    rows = [(1, sentence(1, 50) + " " + notice + " " + sentence(2, 3)), (2, mit), (3, None),
            (4, "released under the"), (5, sentence(3, 5000) + " " + mit.upper()), (6, ""),
            (7, long_notice.replace("compliance", "conformity")), (7, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit(0))
    known = licenses.templates(spark)
    found = {(r["doc_id"], r["license"]) for r in licenses.scan(frame, known).collect()}
    assert found == {(1, "GPL-3.0"), (2, "MIT"), (5, "MIT"), (7, "Apache-2.0")}
    assert licenses.scan(documents, known).count() == licenses.scan(no_documents, known).count() == 0


def test_license_scans_know_common_licenses(spark):
    known = licenses.public_licenses()
    rows, wanted = [], set()
    for k, (name, text) in enumerate(known):
        rows.append((k, sentence(k, 30 + k) + " " + text + " " + sentence(k + 1, 20)))
        wanted.add((k, name))
    gpl = (licenses.TEXTS / "GPL-2.0.txt").read_text().split()
    rows += [(1000, " ".join(w for k, w in enumerate(gpl) if k % 60)), (1001, " ".join(gpl[: len(gpl) // 2]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {(r["doc_id"], r["license"])
             for r in licenses.scan(frame, licenses.templates(spark, known)).collect()}
    assert wanted <= found
    assert (1000, "GPL-2.0") in found and (1001, "GPL-2.0") not in found
    exact = {(k, n) for k, n in found if n.endswith("-or-later") and (k, n) not in wanted}
    assert not {(k, n) for k, n in exact if k < len(known) and known[k][0].endswith("-or-later")}


def test_license_anchors_are_enough_for_the_least_match():
    words = [f"w{k}" for k in range(25 + licenses.SIZE - 1)]  # 5 of 25 shingles may be missing
    assert len(licenses._anchors(words)) == 2


def test_license_scans_find_every_notice_in_the_documents(spark):
    docs = table(spark, "documents")
    notices = [n for n in licenses.NOTICES if len(n[1]) < 80]
    wanted = {(r["doc_id"], name) for name, text in notices
              for r in docs.filter(F.contains("text", F.lit(text))).collect()}
    found = licenses.scan(docs, licenses.templates(spark)).collect()
    assert {(r["doc_id"], r["license"]) for r in found} == wanted and wanted


def test_pipeline_stage_by_stage(spark):
    """Each stage against the plain version of its decision on its own input."""
    docs = table(spark, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert [*stages] == ["quality", "toxicity", "near_copies", "decontamination", "packing"]
    items = [tuple(r) for r in table(spark, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = corpus_pipeline.written(stage(spark, docs, FOLDER), "test_stage")
        assert after.columns == docs.columns
        kept = {r["doc_id"] for r in after.collect()}
        if name == "near_copies":
            assert kept == {c for _, _, c in brute.components([*before.items()])}
        elif name == "decontamination":
            assert kept == {d for d, t in before.items() if not brute.contamination(t, items)[4]}
        else:
            label = {"quality": "quality = 1", "toxicity": "toxic = 0"}[name]
            clean = {r["doc_id"] for r in table(spark, "labels").filter(label).collect()}
            wanted = clean & {*before}
            assert len(wanted & kept) >= 0.97 * len(wanted)
        docs = after
    check_packing(stages["packing"](spark, docs, FOLDER).collect(),
                  [(r["doc_id"], r["text"]) for r in docs.collect()])
