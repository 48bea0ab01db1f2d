"""Spelling variants against a comparison of all pairs."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import queries, variants

SCHEMA = "doc_id long, text string, word string, n int, form string"


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def near_of(words: dict[str, int]) -> dict[str, list[str]]:
    found = {w: [] for w in words}
    by_size: dict[int, list[str]] = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    for size, some in by_size.items():
        pairs = [*itertools.combinations(some, 2), *itertools.product(some, by_size.get(size + 1, []))]
        for a, b in pairs:
            if near(a, b):
                found[a].append(b)
                found[b].append(a)
    return found


def plain(rows) -> list[tuple]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    form, out = {}, []
    neighbours = near_of(words)
    for w, others in neighbours.items():
        if others:
            best = min(others, key=lambda v: (-words[v], v))
            if words[best] >= 2 * words[w]:
                form[w] = best
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(neighbours[w]), words.get(form.get(w))))
    return sorted(out, key=lambda r: r[0])


def found(df, **options) -> list[tuple]:
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    result = variants.group(df, **options)
    assert result.columns == columns
    return sorted((tuple(r) for r in result.collect()), key=lambda r: r[0])


def table(spark, rows):
    return spark.createDataFrame([(*r, "w", 1, "f") for r in rows], SCHEMA).repartition(4)


def typed(rng: random.Random, n: int, alphabet: str = "abcé") -> str:
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(3, 8))) for _ in range(40)]
    return " ".join(rng.choice(words[: 1 + rng.randrange(40)]) for _ in range(n))


@pytest.mark.parametrize("largest", [20_000, 30, 4])
def test_groups_agree_with_all_pairs(spark, largest):
    rng = random.Random(largest)
    long_word = "lang" * 5000
    rows = [(i, typed(rng, 300)) for i in range(60)] + [
        (None, "Tables tables TABLES table, tablÉ tablé tablés tablés tablés"), (3, None), (3, ""), (4, " \n"),
        (5, "letters letter letters letter letters letter l×tters l÷tters"), (5, "letters"), (5, "letters"),
        (6, f"{long_word} " * 3 + f"{long_word}x " * 7), (None, "aaaaa aaaaaa " * 9), (None, "aaaaa aaaaaa "),
    ]
    assert found(table(spark, rows), largest=largest) == plain(rows)


def test_the_given_documents(spark):
    df = queries.table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert found(df) == plain(rows)


def test_no_rows_and_no_words(spark):
    assert found(table(spark, [(1, "a b c")]).limit(0)) == []
    assert found(table(spark, [(1, "a b c"), (2, None)])) == []
    assert len(found(table(spark, [(1, "lonely lonely lonely")]))) == 1


def test_chains_of_forms_lead_to_the_last(spark):
    chain = ["aaaaaaaaa" + "b" * k for k in range(7)]
    rows = [(k, f"{word} " * 3 * 2**k) for k, word in enumerate(chain)]
    result = {r[0]: r for r in found(table(spark, rows))}
    assert result == {r[0]: r for r in plain(rows)}
    assert result[chain[0]][2] == chain[-1]


WORDS = st.dictionaries(st.text(alphabet="abé", min_size=5, max_size=8), st.integers(3, 9), max_size=40)


@settings(max_examples=80, deadline=None)
@given(WORDS)
def test_one_partition_finds_the_pairs_whose_shorter_word_has_its_size(words):
    """The window of all places: every pair of words of 5 and 6 code points."""
    members = {w: n for w, n in words.items() if len(w) in (5, 6)}
    got = variants.near_in(5, 6, "", "", sorted(members.items()))
    for word in members:
        others = [v for v in members if near(word, v) and min(len(word), len(v)) == 5]
        best = min(others, key=lambda v: (-members[v], v), default=None)
        assert got.get(word) == (best and (len(others), members[best], best))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text(alphabet="abc", min_size=4, max_size=4), min_size=1))
def test_acceptor_is_minimal_and_accepts_its_words(words):
    root = variants.acceptor(sorted(words))
    assert sorted(variants.Composition().rests(root, root)) == sorted(words)
    states: dict[int, dict] = {}

    def rests(state) -> frozenset:
        states[id(state)] = state
        if not state:
            return frozenset([""])
        return frozenset(c + r for c, to in state.items() for r in rests(to))

    rests(root)
    assert len({rests(s) for s in [*states.values()]}) == len(states)
