"""Benchmark decontamination with suffix arrays of the training texts.

The documents are cut into shards (the batches that tasks read). For each shard the words of its
texts, as numbers of the benchmark's vocabulary, make one long sequence, and a suffix array of it
is built: the positions sorted by the words that follow. Positions from which no window of the
benchmark can start, because a word too near is not in the vocabulary or the text ends, are left
out of the array; no match is lost by that. Every suffix of the benchmark items is then searched
by bisection in every shard's array, all at once. A run of the array that agrees with a suffix in
a whole window gives the places of that window; windows that follow each other at following
places are one longer verbatim match.

Words are maximal runs of ASCII letters and digits and of non-ASCII characters, A-Z in lower
case. A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not none,
is one window. A document is contaminated when its words inside matches make up at least one in
``ONE_IN`` of its words.

The benchmark is sent to the tasks in blocks of at most ``BLOCK_WORDS`` words (at least one item
each); each block is searched in all shards, and the matches of all blocks are put together.

Defined results: null texts have no words; documents without words are never hit, items without
words have no windows. Rows of the benchmark with the same item_id and text count once, and an
item_id counts once in a document. A null item_id marks the words it hits but is not listed.
Repeated documents are judged each. An empty benchmark contaminates nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm import caches
from shelfwise.session import written

WINDOW = 13
ONE_IN = 20
BLOCK_WORDS = 1_000_000
#: Words of a shard's suffix array.
SHARD_WORDS = 1_000_000

_AS_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_AS_WORDS).split()


@dataclass
class Match:
    """A longest verbatim match: words ``start`` to ``end`` of a document (end excluded) are the
    words of item number ``item`` from its word ``item_start`` on."""

    start: int
    end: int
    item: int
    item_start: int


class Items:
    """A block of benchmark items as numbers: the vocabulary, and the windows to look for."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.names: list[str | None] = []
        self.vocabulary: dict[bytes, int] = {}
        numbers: list[int] = []
        #: By window size: for each window its first number, its item, its place in the item.
        windows: dict[int, list[tuple[int, int, int]]] = {}
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            item, size, base = len(self.names), min(window, len(words)), len(numbers)
            self.names.append(name)
            numbers += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            windows.setdefault(size, []).extend(
                (base + at, item, at) for at in range(len(words) - size + 1)
            )
        self.numbers = np.array(numbers, np.int32)
        self.windows = {size: np.array(w, np.int32) for size, w in sorted(windows.items())}


class SuffixArray:
    """Positions of a sequence sorted by what follows, to a depth of ``depth`` numbers.

    Only positions followed by at least ``least`` positive numbers are in it. 0 stands for what
    cannot match, between texts too.
    """

    def __init__(self, sequence: np.ndarray, least: int, depth: int):
        n = len(sequence)
        self.sequence = np.concatenate([sequence, np.zeros(depth + 1, np.int32)])
        zeros = np.flatnonzero(self.sequence == 0)
        run = zeros[np.searchsorted(zeros, np.arange(n))] - np.arange(n)
        positions = np.flatnonzero(run >= least)
        #: One column a step into the suffix; a suffix ends at its first 0.
        steps = positions[:, None] + np.arange(depth)
        ended = np.arange(depth) >= run[positions][:, None]
        follows = np.where(ended, 0, self.sequence[np.minimum(steps, n)])
        order = np.lexsort(follows.T[::-1]) if len(positions) else positions
        self.positions, self.follows = positions[order], follows[order]

    def find(
        self, numbers: np.ndarray, first: np.ndarray, size: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """For each window the run [low, high) of the array whose suffixes begin with it.

        All windows are bisected together, one step of the window after the other: within the
        run that agrees so far, the next number narrows the run.
        """
        low = np.zeros(len(first), np.int64)
        high = np.full(len(first), len(self.positions), np.int64)
        for step in range(size):
            wanted, column = numbers[first + step], self.follows[:, step]
            low, high = _bisect(column, low, high, wanted), _bisect(column, low, high, wanted + 1)
        return low, high


def _bisect(column: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray):
    """The first places in column[low:high] (sorted there) with at least the wanted value."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        less = open_ & (column[np.minimum(middle, len(column) - 1)] < wanted)
        low = np.where(less, middle + 1, low)
        high = np.where(open_ & ~less, middle, high)
    return low


def matches_of(texts: list[list[bytes]], items: Items) -> list[list[Match]]:
    """The longest verbatim matches in each of the texts (given as words) of one shard."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    found: list[list[Match]] = [[] for _ in texts]
    if not items.windows:
        return found
    sequence = np.zeros(int(starts[-1]), np.int32)
    number = items.vocabulary.get
    for k, words in enumerate(texts):
        if words:
            sequence[starts[k] : starts[k] + len(words)] = [number(w, 0) for w in words]
    array = SuffixArray(sequence, min(items.windows), max(items.windows))
    if not len(array.positions):
        return found
    for size, windows in items.windows.items():
        low, high = array.find(items.numbers, windows[:, 0], size)
        hit = np.flatnonzero(high > low)
        if not len(hit):
            continue
        count = high[hit] - low[hit]
        each = np.repeat(hit, count)
        within = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        place = array.positions[low[each] + within]
        text = np.searchsorted(starts, place, side="right") - 1
        item, item_at = windows[each, 1], windows[each, 2]
        # Following windows of an item at following places lie on one diagonal.
        order = np.lexsort((place, place - item_at, item, text))
        text, item, place, item_at = text[order], item[order], place[order], item_at[order]
        fresh = np.ones(len(place), bool)
        fresh[1:] = (
            (text[1:] != text[:-1]) | (item[1:] != item[:-1])
            | (place[1:] - item_at[1:] != place[:-1] - item_at[:-1]) | (place[1:] != place[:-1] + 1)
        )
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(place)) - 1
        for a, b in zip(first, last, strict=True):
            k = int(text[a])
            found[k].append(Match(
                int(place[a] - starts[k]), int(place[b] - starts[k]) + size, int(item[a]),
                int(item_at[a]),
            ))
    return found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in blocks of at most ``BLOCK_WORDS`` words, read one block at a time."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    block, words = [], 0
    for row in rows.toLocalIterator():
        size = len(words_of(row["text"]))
        if block and words + size > BLOCK_WORDS:
            yield block
            block, words = [], 0
        block.append((row["item_id"], row["text"]))
        words += size
    yield block


_ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), *(
        T.StructField(name, T.ArrayType(kind)) for name, kind in (
            ("starts", T.LongType()), ("ends", T.LongType()), ("item_starts", T.LongType()),
            ("items", T.StringType()))
    ),
])
_ADDED_ARROW = [pa.int64(), *[pa.list_(pa.int64())] * 3, pa.list_(pa.string())]


def matches(
    documents: DataFrame, benchmark: DataFrame, prefix: str = "", keep_text: bool = True,
    window: int = WINDOW,
) -> DataFrame:
    """``documents`` with n_words and the longest verbatim matches of each row: starts, ends,
    item_starts, items. ``prefix`` begins the names of the added columns."""
    names = [prefix + f.name for f in _ADDED]
    at, width = documents.columns.index("text"), len(documents.columns)
    schema = T.StructType([
        *documents.schema.fields, *(T.StructField(prefix + f.name, f.dataType) for f in _ADDED)
    ])
    context = documents.sparkSession.sparkContext

    def search(shared, again: bool, drop_text: bool):
        def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            caches.claim("decontamination")
            items = shared.value
            for batch in batches:
                begin = 0
                while begin < batch.num_rows:
                    shard, words = [], 0
                    while begin + len(shard) < batch.num_rows and words < SHARD_WORDS:
                        shard.append(words_of(batch.column(at)[begin + len(shard)].as_py()))
                        words += len(shard[-1])
                    rows = batch.slice(begin, len(shard))
                    begin += len(shard)
                    found = matches_of(shard, items)
                    added = [
                        [len(w) for w in shard],
                        *([[pick(m) for m in ms] for ms in found] for pick in (
                            lambda m: m.start, lambda m: m.end, lambda m: m.item_start,
                            lambda m: items.names[m.item])),
                    ]
                    if again:
                        added[1:] = [
                            [before + more for before, more in zip(
                                rows.column(width + 1 + i).to_pylist(), added[1 + i], strict=True)]
                            for i in range(4)
                        ]
                    columns = rows.columns[:width]
                    if drop_text:
                        columns[at] = pa.nulls(len(shard), columns[at].type)
                    yield pa.RecordBatch.from_arrays(
                        [*columns, *map(pa.array, added, _ADDED_ARROW)], schema.names
                    )

        return searched

    blocks = [context.broadcast(Items(block, window)) for block in _blocks(benchmark)]
    out = documents
    for k, shared in enumerate(blocks):
        last = k == len(blocks) - 1
        out = out.mapInArrow(search(shared, k > 0, last and not keep_text), schema)
        if not last:
            out = written(out, "decontamination")
    return out if keep_text else out.select(*(c for c in documents.columns if c != "text"), *names)


def _judge(n_words: int, starts, ends, items) -> tuple[int, int, str, bool]:
    """n_hit, n_items, items_sha256, contaminated."""
    hit = reach = 0
    for start, end in sorted(zip(starts, ends, strict=True)):
        hit += max(0, end - max(start, reach))
        reach = max(reach, end)
    names = sorted({i for i in items if i is not None})
    digest = hashlib.sha256(",".join(names).encode()).hexdigest()
    return hit, len(names), digest, hit > 0 and ONE_IN * hit >= n_words


def report(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row."""
    doc_id = documents.schema["doc_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (1, 2, 3, 5)]
            out = [_judge(*row) for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *(pa.array([r[i] for r in out], kind) for i, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.string(), pa.bool_())))],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    found = matches(documents.select("doc_id", "text"), benchmark, "", False, window)
    return found.mapInArrow(
        judge, f"doc_id {doc_id}, n_words long, n_hit long, n_items long, items_sha256 string, "
        "contaminated boolean",
    )


def remove(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, all columns as they are."""
    prefix = "_"
    while any(c.startswith(prefix) for c in documents.columns):
        prefix += "_"
    found = matches(documents, benchmark, prefix, True, window)

    # The words hit, in the JVM: a second Python worker a task would double what a stage holds.
    spans = F.sort_array(F.zip_with(
        F.col(prefix + "starts"), F.col(prefix + "ends"),
        lambda start, end: F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"))))
    nothing = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("reach"))
    n_hit = F.aggregate(
        spans, nothing,
        lambda seen, span: F.struct(
            (seen["hit"] + F.greatest(
                F.lit(0).cast("long"), span["end"] - F.greatest(span["start"], seen["reach"])))
            .alias("hit"),
            F.greatest(seen["reach"], span["end"]).alias("reach")),
        lambda seen: seen["hit"])
    clean = ~((n_hit > 0) & (ONE_IN * n_hit >= F.col(prefix + "n_words")))
    return found.filter(clean).select(*documents.columns)
