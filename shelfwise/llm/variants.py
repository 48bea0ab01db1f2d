"""Spelling variants: near words of a vocabulary by composing finite-state machines.

Two words are near if one inserted, deleted or replaced code point turns one into the other. All
near pairs are the paths of ``A o E o A``: A accepts the vocabulary and is minimised, E copies its
input but for one edit. The composed machine is never built whole. Before the edit both copies of A
stand in one state, so a path starts with a shared prefix; after it only a shared rest is read. The
paths are therefore dealt by where they start: a partition has a length of the shorter word, a window
of places for the edit, and the code points before and after that window. A word is in two windows
of each of two lengths. A partition of more than ``LARGEST`` words is dealt again with its window
halved; a window of one place has at most |alphabet|**2 + |alphabet| = 8,190 words, so this ends.
Every pair has one first place of difference, hence comes out of exactly one partition. No partition
emits pairs: it emits, for each word, how many near words it saw and the best of them.

Within a partition the words of each length have a minimised acceptor, whose states are shared by
equal rests. Pairs of states are searched once: where they have no common rest, no path goes on.

Counting: runs of letters ``A-Za-z`` and U+00C0 to U+00FF, A-Z in lower case. Tasks count before the
shuffle and pass on what they hold at ``HELD`` words, so a word with a third of all occurrences is a
few rows.

Defined results: null and empty texts have no runs. Every row counts, repeated rows too. A null id
reads as an empty string where a run is damaged. Only ``doc_id`` and ``text`` are read, so further
columns and their names do not matter. No words: an empty table. Words of any length are whole. Ties
between forms go to the word that is smallest in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import written

#: Occurrences and code points that make a run a word of the vocabulary.
LEAST_OCCURRENCES = 3
SHORTEST = 5
#: A task counts so many different words before it passes them on.
HELD = 400_000
#: Partitions of more words are dealt again by narrower windows.
LARGEST = 20_000
#: One in so many runs is damaged, by the hash of its row and its letters.
DAMAGED = 97
_SLICE = 256

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
KEY = ("size", "first", "last", "before", "after")

State = dict  # code point -> State; a state without arcs accepts


# --- vocabulary -----------------------------------------------------------------------


def damaged_runs(doc_id: str, text: str | None) -> Counter:
    """The lower-cased runs of a text and how often they occur, one in ``DAMAGED`` damaged."""
    lowered: Counter = Counter()
    for run, n in Counter(_RUN.findall(text or "")).items():
        lowered[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    seed = zlib.crc32(f"{doc_id}:".encode())
    found: Counter = Counter()
    for run, n in lowered.items():
        h = zlib.crc32(run.encode(), seed)
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        found[run] += n
    return found


def vocabulary(documents: DataFrame, shortest: int = SHORTEST, least: int = LEAST_OCCURRENCES
               ) -> DataFrame:
    """(word, n) of the runs that are long and frequent enough."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                part = batch.slice(start, _SLICE)
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for word, n in damaged_runs(doc_id, text).items():
                        if len(word) >= shortest:
                            held[word] += n
                    if len(held) >= HELD:
                        yield pa.record_batch([[*held], [*held.values()]], schema=schema)
                        held = Counter()
        if held:
            yield pa.record_batch([[*held], [*held.values()]], schema=schema)

    return (
        documents.select(
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
            F.col("text").cast("string").alias("text"),
        )
        .mapInArrow(count, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
    )


# --- partitions of the composed machine -----------------------------------------------


def _window(size: Column, first: Column, last: Column) -> Column:
    return F.struct(
        size.cast("int").alias("size"), first.cast("int").alias("first"), last.cast("int").alias("last"))


def _dealt(words: DataFrame, windows: Column) -> DataFrame:
    """Each word in each of its windows, with the code points before and after the window.

    ``size`` is the length of a pair's shorter word; an edit has one of the places 0 to ``size``,
    of which a window takes ``first`` up to but without ``last``.
    """
    after = F.greatest(F.col("size") - F.col("last"), F.lit(0))
    return words.select("word", "n", F.inline(windows)).select(
        *KEY[:3],
        F.substring("word", F.lit(1), F.col("first")).alias("before"),
        F.when(after > 0, F.substring(F.col("word"), -after, after)).otherwise("").alias("after"),
        "word", "n",
    )


def partitions(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """The words dealt to two windows for pairs of their own length or one longer, and to two for
    pairs in which they are the longer word."""
    length = F.length("word")

    def both(size: Column) -> list[Column]:
        half = F.floor((size + 1) / 2)
        return [_window(size, F.lit(0), half), _window(size, half, size + 1)]

    windows = F.filter(
        F.array(*both(length), *both(length - 1)), lambda w: w["size"] >= shortest)
    return _dealt(words, windows)


def narrower(dealt: DataFrame) -> DataFrame:
    """The same with each window halved."""
    middle = F.floor((F.col("first") + F.col("last")) / 2)
    windows = F.array(
        _window(F.col("size"), F.col("first"), middle), _window(F.col("size"), middle, F.col("last")))
    return _dealt(dealt.select("word", "n", windows.alias("windows")), F.col("windows"))


# --- one partition ----------------------------------------------------------------------


def acceptor(words: list[str]) -> State | None:
    """The minimised acceptor of sorted, different words of one length."""
    if not words:
        return None
    register: dict[tuple, State] = {}

    def close(path: list[State], word: str, depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            key = tuple((c, id(to)) for c, to in state.items())
            path[-1][word[len(path) - 1]] = register.setdefault(key, state)

    path: list[State] = [{}]
    before = ""
    for word in words:
        shared = 0
        while shared < len(before) and before[shared] == word[shared]:
            shared += 1
        close(path, before, shared)
        path.extend({} for _ in range(len(word) - shared))
        before = word
    close(path, before, 0)
    return path[0]


class Composition:
    """Paths through two copies of acceptors with one edit between them."""

    def __init__(self):
        self._live: dict[tuple[int, int], bool] = {}

    def live(self, p: State, q: State) -> bool:
        """Whether two states have a common rest; each pair of states is searched once."""
        stack = [(p, q)]
        known = self._live
        while stack:
            p, q = stack[-1]
            key = (id(p), id(q))
            if key in known:
                stack.pop()
                continue
            if p is q or not p or not q:  # one length: both end together
                known[key] = True
                continue
            open_ = None
            for c in p.keys() & q.keys():
                found = known.get((id(p[c]), id(q[c])))
                if found:
                    known[key] = True
                    break
                if found is None:
                    open_ = (p[c], q[c])
            else:
                if open_ is None:
                    known[key] = False
                else:
                    stack.append(open_)
        return known[key]

    def rests(self, p: State, q: State) -> Iterator[str]:
        """The common rests of two states."""
        stack: list = [(p, q, None)]
        while stack:
            p, q, link = stack.pop()
            if not p:
                yield _spelled(link)
                continue
            for c in p.keys() & q.keys():
                if self.live(p[c], q[c]):
                    stack.append((p[c], q[c], (link, c)))

    def replaced(self, root: State) -> Iterator[tuple[str, str]]:
        """Pairs of accepted words that differ in one code point, each once."""
        stack: list = [(root, None)]
        while stack:
            state, link = stack.pop()
            arcs = [*state.items()]
            for i, (c, p) in enumerate(arcs):
                stack.append((p, (link, c)))
                for d, q in arcs[:i]:
                    if self.live(p, q):
                        shared = _spelled(link)
                        for rest in self.rests(p, q):
                            yield shared + c + rest, shared + d + rest

    def inserted(self, root: State, longer: State, at_end: bool) -> Iterator[tuple[str, str]]:
        """Pairs of a word and one with a code point more, by their first place of difference.

        ``at_end`` admits code points behind the whole word.
        """
        stack: list = [(root, longer, None)]
        while stack:
            p, q, link = stack.pop()
            for c, onward in q.items():
                if not p:
                    if at_end:
                        word = _spelled(link)
                        yield word, word + c
                    continue
                if c in p:
                    stack.append((p[c], onward, (link, c)))
                for d in p.keys() & onward.keys():
                    if d != c and self.live(p[d], onward[d]):
                        shared = _spelled(link)
                        for rest in self.rests(p[d], onward[d]):
                            yield shared + d + rest, shared + c + d + rest


def _spelled(link) -> str:
    letters = []
    while link is not None:
        link, c = link
        letters.append(c)
    return "".join(reversed(letters))


def near_in(size: int, last: int, before: str, after: str, members: list[tuple[str, int]]
            ) -> dict[str, tuple[int, int, str]]:
    """word -> (near words, the largest n of one, the smallest word of that n) in one partition."""
    shorter: dict[str, int] = {}
    longer: dict[str, int] = {}
    for word, n in members:
        middle = word[len(before) : len(word) - len(after)]
        (shorter if len(word) == size else longer)[middle] = n
    if not shorter or len(shorter) + len(longer) < 2:
        return {}
    one = acceptor(sorted(shorter))
    machine = Composition()
    best: dict[tuple[bool, str], tuple[int, int, str]] = {}

    def saw(key: tuple[bool, str], n: int, other: str) -> None:
        times, most, form = best.get(key, (0, 0, ""))
        other += after  # of two middles one may begin with the other
        if n > most or (n == most and other < form):
            most, form = n, other
        best[key] = (times + 1, most, form)

    for w, v in machine.replaced(one):
        saw((False, w), shorter[v], v)
        saw((False, v), shorter[w], w)
    if longer:
        for w, v in machine.inserted(one, acceptor(sorted(longer)), last == size + 1):
            saw((False, w), longer[v], v)
            saw((True, v), shorter[w], w)
    return {
        f"{before}{middle}{after}": (times, most, before + form)
        for (_, middle), (times, most, form) in best.items()
    }


# --- near words, forms and roots --------------------------------------------------------

_NEAR = pa.schema([
    ("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partitions arrive one after the other; one at a time is held."""
    key, members, out = None, [], []
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            columns = [c.to_pylist() for c in batch.slice(start, 4096).columns]
            for *now, word, n in zip(*columns, strict=True):
                if now != key:
                    if len(members) > 1:
                        out.extend(_rows(key, members))
                    key, members = now, []
                members.append((word, n))
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=_NEAR)
                out = []
    if len(members) > 1:
        out.extend(_rows(key, members))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_NEAR)


def _rows(key, members) -> Iterator[dict]:
    size, _, last, before, after = key
    for word, (times, most, form) in near_in(size, last, before, after, members).items():
        yield {"word": word, "n_near": times, "form_n": most, "form": form}


def near_words(words: DataFrame, largest: int = LARGEST, shortest: int = SHORTEST) -> DataFrame:
    """(word, n_near, form, form_n): for each word with near words how many, and the one of largest
    n; of (word, n). All words are different and have ``shortest`` code points or more."""
    dealt = partitions(words, shortest)
    fitting: list[DataFrame] = []
    while True:
        sizes = dealt.groupBy(*KEY).agg(F.count(F.lit(1)).alias("members"))
        # At most one key for each ``largest`` rows; one without partners takes no part.
        large = written(
            sizes.filter((F.col("members") > largest) & (F.col("last") - F.col("first") > 1))
            .drop("members"), "large_partitions")
        if large.isEmpty():
            fitting.append(dealt)
            break
        fitting.append(dealt.join(large, [*KEY], "left_anti").select(*dealt.columns))
        dealt = written(narrower(dealt.join(large, [*KEY], "left_semi")), "narrower_partitions")
    seen = None
    for part in fitting:
        found = (
            part.repartition(*KEY).sortWithinPartitions(*KEY, "word")
            .mapInArrow(_compose, "word string, n_near long, form_n long, form string")
        )
        seen = found if seen is None else seen.unionByName(found)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form")))
    return seen.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that the forms lead to.

    Each round lets a word's form be its form's form, so chains halve. The n of a form is at least
    twice that of its word: chains end, and are as long as the logarithm of the largest n.
    """
    now = written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(
            now.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots")
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def group(documents: DataFrame, shortest: int = SHORTEST, least: int = LEAST_OCCURRENCES,
          largest: int = LARGEST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary."""
    words = written(vocabulary(documents, shortest, least), "vocabulary")
    accepted = F.col("form_n") >= 2 * F.col("n")
    forms = written(
        words.join(near_words(words, largest, shortest), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(accepted, F.col("form")).alias("form"),
            F.when(accepted, F.col("form_n")).alias("form_n"),
        ), "forms")
    found = roots(forms.filter(F.col("form").isNotNull()))
    return forms.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
