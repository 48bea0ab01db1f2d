"""Toxicity: a learned, weighted lexicon matched by Aho-Corasick.

Texts are folded first: lower case, letters of other alphabets that look like Latin ones, and
digits or signs that stand for letters inside a word. Words are then separated by single spaces,
so that a pattern `` idiot`` means "a word that starts so" and `` idiot `` the whole word. One
pass of the automaton finds every pattern; hits inside an exception phrase do not count. The
weights of the hits are summed and normalised by the number of words, and a small logistic curve
turns the sum and the density into a score.

The lexicon, the exception phrases and the curve are learned from labelled rows. At most
``MAX_FIT_ROWS`` of them are taken (by hash of the id), which bounds what the driver holds. Rows of
one label whose smallest three-word shingle is the same count once. A pattern needs ``MIN_TOXIC``
toxic texts and ``MIN_TOXIC_SHARE`` of them, so words that are rarer there are not learned; at most
``MAX_PATTERNS`` patterns and ``MAX_EXCEPTIONS`` phrases are. Scoring has no such bounds.

Defined results: null and empty texts have no hits and get the lowest score. Repeated rows are
scored each for itself; in the fit near copies with equal labels mostly count once. Null labels are ignored. With
no toxic row to learn from the lexicon is empty and all rows get the same low score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from shelfwise.llm import caches
from shelfwise.llm.quality import labelled
from shelfwise.session import written

#: At most so many labelled rows are used for learning.
MAX_FIT_ROWS = 20_000
#: At most so many patterns; the ones with the most toxic documents are kept.
MAX_PATTERNS = 20_000
MAX_EXCEPTIONS = 20_000
PREFIX_LENGTHS = range(3, 9)
#: A task counts so many keys before it passes them on.
HELD = 100_000
#: A pattern must be so much (log ratio) more frequent in toxic texts, in so many of them.
MIN_LOG_RATIO = 4.0
MIN_TOXIC = 6
MIN_TOXIC_SHARE = 0.003
#: A longer pattern replaces a shorter one when it keeps this share of its toxic documents.
SAME_SUPPORT = 0.9

# Letters that look like Latin ones, and signs that stand for letters.
_LOOKS_LIKE = dict(zip("авекмнорстухіјѕԁԛԝαβεικνορτυχ", "abekmhopctyxijsdqwabeikvoptux", strict=True))
_STANDS_FOR = dict(zip("0134578@$", "oieastbas", strict=True))
_FOLD = str.maketrans({k: v for k, v in _LOOKS_LIKE.items()} | {
    chr(wide): chr(wide - 0xFEE0) for wide in range(0xFF01, 0xFF5F)
} | dict.fromkeys("­​‌‍﻿"))
_UNMASK = str.maketrans(_STANDS_FOR)
_MASKED = re.compile(r"(?<![\w@$])(?=[\w@$]*[^\W\d_])[\w@$]*[0134578@$][\w@$]*")
_WORD = re.compile(r"[^\W_]+")


def folded_words(text: str | None) -> list[str]:
    """The words of a text after folding."""
    text = (text or "").lower().translate(_FOLD)
    return _WORD.findall(_MASKED.sub(lambda m: m[0].translate(_UNMASK), text))


def _patterns_of(word: str) -> Iterator[str]:
    for length in PREFIX_LENGTHS:
        if len(word) > length:
            yield f" {word[:length]}"
    if len(word) >= PREFIX_LENGTHS[0]:
        yield f" {word} "


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: Sequence[str] = ()
    curve: tuple[float, float, float] = (-4.0, 0.0, 2.0)
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            built = ahocorasick.Automaton()
            for pattern, weight in self.weights.items():
                built.add_word(pattern, (len(pattern), weight))
            for phrase in self.exceptions:
                built.add_word(f" {phrase} ", (len(phrase) + 2, None))
            if len(built):
                built.make_automaton()
            self._automaton = built
        return self._automaton

    def hits(self, words: list[str]) -> list[tuple[int, str, float]]:
        """(position, word, weight) of the matches outside exception phrases; one a word."""
        automaton = self.automaton()
        if not len(automaton) or not words:
            return []
        line = f" {' '.join(words)} "
        found: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (length, weight) in automaton.iter(line):
            start = end - length + 1
            if weight is None:
                excused.append((start, end))
            else:
                found[start] = max(weight, found.get(start, 0.0))
        out, reach, k = [], -1, 0
        excused.sort()
        for start, weight in sorted(found.items()):
            while k < len(excused) and excused[k][0] <= start:
                reach = max(reach, excused[k][1])
                k += 1
            if start >= reach:
                out.append((start, line[start + 1 : line.index(" ", start + 1)], weight))
        return out

    def measures(self, text: str | None) -> tuple[float, float]:
        """Log of the summed weight, and log of the weight for each hundred words."""
        words = folded_words(text)
        total = sum(weight for _, _, weight in self.hits(words))
        return float(np.log1p(total)), float(np.log1p(100 * total / (len(words) + 10)))

    def score(self, text: str | None) -> float:
        a, b, c = self.curve
        total, density = self.measures(text)
        return float(1 / (1 + np.exp(-np.clip(a + b * total + c * density, -35, 35))))

    def udf(self):
        @F.pandas_udf(DoubleType())
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            caches.claim("toxicity")
            for batch in batches:
                yield pd.Series([self.score(text) for text in batch], dtype="float64")

        return score


@F.pandas_udf(LongType())
def _likeness(texts: pd.Series) -> pd.Series:
    """One min-hash of three-word shingles: near copies mostly agree, so that they count once."""

    def least(text: str | None) -> int:
        words = folded_words(text)
        return min(
            xxhash.xxh3_64_intdigest(" ".join(words[i : i + 3])) >> 1
            for i in range(max(1, len(words) - 2))
        )

    return texts.map(least)


def sample(documents: DataFrame, labels: DataFrame, fold: int, held_out: int) -> DataFrame:
    """(text, label) of at most ``MAX_FIT_ROWS`` labelled documents, chosen by hash of the id.

    The chosen ids are broadcast, as their number is bounded; the texts do not move for the join.
    """
    chosen = (
        labelled(labels, "toxic", fold, held_out)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_FIT_ROWS)
    )
    return (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("text", "label", _likeness(F.col("text")).alias("likeness"))
        .groupBy("likeness", "label")
        .agg(F.min("text").alias("text"))
    )


def _counted(rows: DataFrame, keys_of) -> DataFrame:
    """(key, toxic, clean): in how many toxic and clean texts each key occurs."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        caches.claim("toxicity")
        clean, toxic = counts = (Counter(), Counter())

        def held() -> Iterator[pd.DataFrame]:
            keys = [*(clean.keys() | toxic.keys())]
            if keys:  # a frame without rows would have no string column
                yield pd.DataFrame({
                    "key": keys, "toxic": [toxic[k] for k in keys], "clean": [clean[k] for k in keys],
                })
            clean.clear()
            toxic.clear()

        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                counts[label].update(set(keys_of(folded_words(text))))
                if len(clean) + len(toxic) >= HELD:
                    yield from held()
        yield from held()

    return (
        rows.mapInPandas(partial, "key string, toxic long, clean long")
        .groupBy("key")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def choose(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Weights of the patterns worth keeping, from (pattern, toxic texts, clean texts).

    A pattern is the shortest one with a high ratio, made as long as its support allows.
    """
    ratio = {
        key: float(np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1)))
        for key, t, c in counts
    }
    support = {key: t for key, t, _ in counts}
    good = sorted((k for k, r in ratio.items() if r >= MIN_LOG_RATIO), key=lambda k: (len(k), k))
    longer: dict[str, list[str]] = {}
    for key in good:
        for cut in range(3, len(key)):
            longer.setdefault(key[:cut], []).append(key)
    kept: dict[str, float] = {}
    roots: set[str] = set()
    for key in good:
        if any(key[:cut] in roots for cut in range(3, len(key))):
            continue
        roots.add(key)
        same = [x for x in longer.get(key, ()) if support[x] >= SAME_SUPPORT * support[key]]
        best = max([key, *same], key=lambda x: (len(x), x))
        kept[best] = ratio[best]
    return kept


def fit(
    documents: DataFrame, labels: DataFrame, fold: int = 5, held_out: int = 0,
    exceptions: Sequence[str] = (),
) -> Lexicon:
    """Learn from the labelled rows; ``exceptions`` are further phrases that excuse a hit."""
    rows = written(sample(documents, labels, fold, held_out), "toxicity_sample")
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Lexicon({})
    least = max(2, min(MIN_TOXIC, toxic // 10), MIN_TOXIC_SHARE * toxic)
    patterns = _counted(rows, lambda words: (p for w in set(words) for p in _patterns_of(w)))
    log_ratio = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log(
        (F.col("clean") + 0.5) / (clean + 1)
    )
    strong = (
        patterns.filter((F.col("toxic") >= least) & (log_ratio >= MIN_LOG_RATIO))
        .orderBy(F.desc("toxic"), "key")
        .limit(MAX_PATTERNS)
        .collect()
    )
    lexicon = Lexicon(choose([(r["key"], r["toxic"], r["clean"]) for r in strong], toxic, clean))

    def phrases(words: list[str]) -> Iterator[str]:
        hit = {word for _, word, _ in lexicon.hits(words)}
        for before, word in zip(words, words[1:], strict=False):
            if before in hit or word in hit:
                yield f"{before} {word}"

    excused = (
        _counted(rows, phrases).filter((F.col("clean") >= 3) & (F.col("toxic") == 0))
        .orderBy(F.desc("clean"), "key").limit(MAX_EXCEPTIONS).collect()
    )
    lexicon = Lexicon(lexicon.weights, (*exceptions, *(r["key"] for r in excused)))
    return Lexicon(lexicon.weights, lexicon.exceptions, _curve(rows, lexicon))


def _curve(rows: DataFrame, lexicon: Lexicon) -> tuple[float, float, float]:
    """Logistic curve over the two measures, by Newton's method on the bounded sample."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = np.array([lexicon.measures(text) for text in batch["text"]]).reshape(-1, 2)
            yield pd.DataFrame({"a": both[:, 0], "b": both[:, 1], "y": batch["label"].to_numpy()})

    found = np.array([
        (1.0, r["a"], r["b"], r["y"])
        for r in rows.mapInPandas(measure, "a double, b double, y int").collect()
    ])
    x, y = found[:, :3], found[:, 3]
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.05 * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        w = w + np.linalg.solve(curvature, slope)
    return tuple(float(v) for v in w)


def classify(documents: DataFrame, labels: DataFrame, fold: int = 5, held_out: int = 0):
    """(doc_id, held_out, score, predicted) for every row of ``documents``."""
    score = fit(documents, labels, fold, held_out).udf()
    return documents.select("doc_id", score(F.col("text")).alias("score")).select(
        "doc_id",
        (F.coalesce(F.crc32(F.col("doc_id").cast("string")) % fold, F.lit(-1)) == held_out)
        .alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(documents: DataFrame, learn_from: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not toxic, all columns as they are."""
    score = fit(learn_from, labels).udf()
    return documents.filter(score(F.col("text")) < 0.5)
