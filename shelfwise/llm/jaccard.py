"""N-gram Jaccard join: T-occurrence search with DivideSkip over blocks of documents.

Two texts are linked when the Jaccard similarity of their sets of five-word shingles is at least
``PERCENT`` / 100. All links between different sets are found, as far as they decide which texts
are connected; equal sets are one class from the start and are never paired.

1. Every text becomes a set of 64-bit shingle hashes, a class (128-bit digest of the set) and a
   size. Tasks also propose shingles that are frequent among their classes.
2. Blocks. In any fixed order of shingles, two sets that are similar enough share one among the
   first ``size - least overlap + 1`` of each. The order puts the frequent shingles last, so
   that blocks (classes that share such a shingle) stay small. The order decides the cost only.
3. Each block's least class is searched against the others. The links found join classes to
   components.
   A sketch of each set (counts by hash range) bounds overlaps from above; pairs and members that
   it rules out are left out before whole sets are moved.
4. Blocks that still hold several components are searched in full, each class against all others
   of another component, in pieces of at most ``PIECE`` classes: one piece against another, so
   that a block of any size is divided among tasks. Nothing is capped.

A search takes the inverted lists of the query's shingles. DivideSkip sets the longest lists
aside, merges the short ones with a heap, keeps what occurs often enough to reach the overlap
with the help of the long lists, and probes these by bisection.

Defined results: null and empty texts, and texts of white space, have no shingles, are linked
with nothing and are a component of their own. Texts of fewer than five words have one shingle.
Repeated rows and repeated ids are linked when their texts are. A component is named by its
smallest doc_id, null only where all its ids are null.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from shelfwise.llm import caches
from shelfwise.llm.graph import components
from shelfwise.llm.shingles import shingle_set
from shelfwise.session import written

PERCENT = 80
#: Entries of the table of frequent shingles, and how many each task proposes.
FREQUENT = 200_000
PROPOSED = 20_000
#: Shingles that a task looks at together for its proposals.
_TOGETHER = 500_000
#: Texts whose prefix entries a task packs together.
TOGETHER_ROWS = 2_000
#: Prefix entries of one bucket, and classes of one piece of a block.
BUCKET = 100_000
PIECE = 1_000
#: Tables of names (ids, classes, pairs; under 100 bytes a row) of at most so many rows are broadcast.
BROADCAST_ROWS = 500_000
#: The weight of probing against merging in DivideSkip's choice of long lists.
_MU = 0.01
#: Short lists of more items in sum are merged in arrays instead of a heap.
_HEAP_ITEMS = 256


def least_overlap(size: int) -> int:
    """How many shingles a set of ``size`` must share with any set it is linked to."""
    return -(-PERCENT * size // 100)


def linked(overlap: int, a: int, b: int) -> bool:
    return 100 * overlap >= PERCENT * (a + b - overlap)


def class_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _order(shingles: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The shingles in the fixed order: rare ones by hash, then frequent ones by count."""
    known, counts = frequent
    if not len(known):
        return shingles
    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
    count = np.where(known[at] == shingles, counts[at], 0)
    return shingles[np.lexsort((shingles, count))]


class Index:
    """Inverted lists over the sets of some classes."""

    def __init__(self, sets: list[np.ndarray], only: np.ndarray | None = None):
        """``only``: the one set that will be searched for; other shingles get no list."""
        self.sizes = [len(s) for s in sets]
        every = np.concatenate(sets) if sets else np.array([], np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        if only is not None:
            at = np.minimum(np.searchsorted(only, every), len(only) - 1)
            every, owner = every[only[at] == every], owner[only[at] == every]
        order = np.lexsort((owner, every))
        every, self.owner = every[order], owner[order]
        self.shingles, self.starts = np.unique(every, return_index=True)
        self.ends = np.append(self.starts[1:], len(every))
        number = np.repeat(np.arange(len(self.shingles)), self.ends - self.starts)
        self.keys = number * max(1, len(sets)) + self.owner  # sorted; a list's members in a row

    def search(self, query: np.ndarray) -> list[int]:
        """The classes linked to the set ``query``, by DivideSkip.

        The longest lists are set aside; what occurs in the short ones often enough to reach the
        overlap with all of the long ones is then looked for in these by bisection, or counted
        there where that touches fewer entries.
        """
        needed, members = least_overlap(len(query)), len(self.sizes)
        if not len(self.shingles):
            return []
        at = np.minimum(np.searchsorted(self.shingles, query), len(self.shingles) - 1)
        lists = at[self.shingles[at] == query]
        if len(lists) < needed:
            return []
        lengths = self.ends[lists] - self.starts[lists]
        lists = lists[np.argsort(lengths, kind="stable")]
        aside = min(needed - 1, int(needed / (_MU * np.log2(lengths.max() + 1) + 1)))
        short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
        counts = self._merged(short)
        often = np.flatnonzero(counts >= needed - aside)
        if not len(often):
            return []
        rest = int((self.ends[long] - self.starts[long]).sum())
        if len(often) * len(long) * 4 < rest:
            wanted = (long[:, None] * members + often).ravel()
            places = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            held = (self.keys[places] == wanted).reshape(len(long), len(often))
            counts[often] += held.sum(axis=0)
        else:
            counts += self._counted(long)
        return [
            int(m) for m in often
            if counts[m] >= needed and linked(int(counts[m]), len(query), self.sizes[m])
        ]

    def _entries(self, lists: np.ndarray) -> np.ndarray:
        """The members in some lists, one list after the other."""
        lengths = self.ends[lists] - self.starts[lists]
        before = np.cumsum(lengths) - lengths
        return self.owner[np.arange(lengths.sum()) + np.repeat(self.starts[lists] - before, lengths)]

    def _counted(self, lists: np.ndarray) -> np.ndarray:
        return np.bincount(self._entries(lists), minlength=len(self.sizes))

    def _merged(self, lists: np.ndarray) -> np.ndarray:
        """How often each member is in the lists: a heap merges them while they are short in
        sum; longer ones are counted in arrays, without a Python step for each entry."""
        if int((self.ends[lists] - self.starts[lists]).sum()) > _HEAP_ITEMS:
            return self._counted(lists)
        counts = np.zeros(len(self.sizes), np.int64)
        merged = heapq.merge(*(self.owner[self.starts[k] : self.ends[k]].tolist() for k in lists))
        for member, same in groupby(merged):
            counts[member] = sum(1 for _ in same)
        return counts


def sketch_of(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each of equal hash ranges, about four in each; empty where a
    count needs more than a byte."""
    bits = max(4, int(np.ceil(np.log2(max(len(shingles), 1) / 4))))
    counts = np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return b"" if counts.max() > 255 else counts.astype(np.uint8).tobytes()


def _folded(sketches: np.ndarray, ranges: int) -> np.ndarray:
    """Sketches (one a row) over fewer ranges."""
    if sketches.shape[1] == ranges:
        return sketches.astype(np.int32)
    return sketches.reshape(len(sketches), ranges, -1).sum(axis=2, dtype=np.int32)


class Sketches:
    """An upper bound of the overlaps with many sets: the shingles two sets share lie in the same
    ranges, so no more than the smaller count of each."""

    def __init__(self, sketches: list[bytes], sizes: list[int]):
        self.sizes = np.array(sizes, dtype=np.int64)
        widths = np.array([len(s) for s in sketches])
        self.groups = [
            (np.flatnonzero(widths == w), np.frombuffer(
                b"".join(s for s in sketches if len(s) == w), np.uint8).reshape(-1, w) if w else None)
            for w in np.unique(widths)
        ]
        self._memory: dict[tuple[int, int], np.ndarray] = {}

    def may_link(self, sketch: bytes, size: int) -> np.ndarray:
        """For each set whether it can be linked to the one with this sketch."""
        out = 100 * np.minimum(self.sizes, size) >= PERCENT * np.maximum(self.sizes, size)
        own = np.frombuffer(sketch, np.uint8).reshape(1, -1)
        for k, (members, counts) in enumerate(self.groups):
            if counts is None or not sketch or not out[members].any():
                continue
            ranges = min(counts.shape[1], own.shape[1])
            if (k, ranges) not in self._memory:
                self._memory[k, ranges] = _folded(counts, ranges)
            most = np.minimum(self._memory[k, ranges], _folded(own, ranges)).sum(axis=1)
            needed = -(-PERCENT * (self.sizes[members] + size) // (100 + PERCENT))
            out[members] &= most >= needed
        return out


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, TOGETHER_ROWS):
            yield batch.slice(start, TOGETHER_ROWS)


def _described(documents: DataFrame) -> DataFrame:
    """Rows of two kinds: (row, doc_id, n, class) of each text, and frequent shingles."""
    doc_id = documents.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n", "class", "shingles", "counts"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.claim("shingles")
        row = TaskContext.get().partitionId() << 33
        seen: dict[bytes, np.ndarray] = {}
        held = 0
        id_type = pa.null()
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def count() -> None:
            every, times = np.unique(np.concatenate([*seen.values()]), return_counts=True)
            often = times > 1
            kept.append((every[often], times[often]))
            seen.clear()

        for batch in batches:
            id_type = batch.column(0).type
            sizes, classes = [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py())
                sizes.append(len(shingles))
                classes.append(class_of(shingles) if len(shingles) else None)
                if len(shingles) and classes[-1] not in seen:
                    seen[classes[-1]] = shingles
                    held += len(shingles)
                    if held >= _TOGETHER:
                        count()
                        held = 0
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array(classes, pa.binary()), pa.nulls(n, pa.list_(pa.int64())),
                 pa.nulls(n, pa.list_(pa.int64()))], names,
            )
            row += n
        if seen:
            count()
        if kept:
            every = np.concatenate([k for k, _ in kept])
            times = np.concatenate([t for _, t in kept])
            values, inverse = np.unique(every, return_inverse=True)
            total = np.bincount(inverse, weights=times, minlength=len(values)).astype(np.int64)
            best = np.argsort(-total, kind="stable")[:PROPOSED]
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int64()), pa.nulls(1, id_type), pa.nulls(1, pa.int64()),
                 pa.nulls(1, pa.binary()),
                 pa.array([values[best].astype(np.int64)], pa.list_(pa.int64())),
                 pa.array([total[best]], pa.list_(pa.int64()))], names,
            )

    return written(
        documents.select("doc_id", "text").mapInArrow(
            describe, f"row long, doc_id {doc_id}, n long, class binary, shingles array<long>, "
            "counts array<long>",
        ), "jaccard_described",
    )


def _frequent(described: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent of the proposed shingles and their counts; a table of bounded size."""
    pairs = described.filter("row < 0").select(F.explode(F.arrays_zip("shingles", "counts")).alias("p"))
    top = (
        pairs.groupBy(F.col("p.shingles").alias("shingle"))
        .agg(F.sum("p.counts").alias("n")).orderBy(F.desc("n"), "shingle").limit(FREQUENT)
    ).toPandas()
    known = top["shingle"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(known)
    return known[order], top["n"].to_numpy(dtype=np.int64)[order]


def _prefixes(documents: DataFrame, frequent, buckets: int) -> DataFrame:
    """(bucket, shingles, classes, sizes, places): prefix entries, packed by shingle range."""
    shared = documents.sparkSession.sparkContext.broadcast(frequent)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.claim("shingles")
        for batch in _sliced(batches):
            seen: set[bytes] = set()
            parts, sizes, counts = [], [], []
            for text in batch.column(0):
                shingles = shingle_set(text.as_py())
                n = len(shingles)
                if not n or (own := class_of(shingles)) in seen:
                    continue
                seen.add(own)
                prefix = _order(shingles, shared.value)[: n - least_overlap(n) + 1]
                parts.append((prefix, own))
                sizes.append(n)
                counts.append(len(prefix))
            if not parts:
                continue
            every = np.concatenate([p for p, _ in parts])
            classes = np.frombuffer(b"".join(own for _, own in parts), dtype=">u8").reshape(-1, 2)
            owner = np.repeat(np.arange(len(parts)), counts)
            size = np.array(sizes, dtype=np.int32)
            place = np.concatenate([np.arange(c, dtype=np.int32) for c in counts])
            bucket = ((every >> np.uint64(33)) * np.uint64(buckets)) >> np.uint64(31)
            order = np.argsort(bucket, kind="stable")
            borders = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            rows = []
            for b in np.flatnonzero(np.diff(borders)):
                mine = order[borders[b] : borders[b + 1]]
                rows.append((int(b), every[mine].tobytes(), classes[owner[mine]].tobytes(),
                             size[owner[mine]].tobytes(), place[mine].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    pa.int32(), *[pa.binary()] * 4), strict=True)],
                ["bucket", "shingles", "classes", "sizes", "places"],
            )

    return documents.select("text").mapInArrow(
        emit, "bucket int, shingles binary, classes binary, sizes binary, places binary"
    )


def _may_link(sizes: np.ndarray, places: np.ndarray, others: np.ndarray, at: np.ndarray):
    """Whether sets of such sizes can be linked when the shingle at these places of their orders
    is the first they share: what follows must suffice for the overlap."""
    needed = -(-PERCENT * (sizes + others) // (100 + PERCENT))
    return (sizes - places >= needed) & (others - at >= needed) & (
        100 * np.minimum(sizes, others) >= PERCENT * np.maximum(sizes, others)
    )


def _blocks(prefixes: DataFrame) -> DataFrame:
    """(members, sizes): the classes that share a shingle of their prefixes, by size.

    Two linked sets meet in the block of the first shingle they share. A class that cannot be
    linked to any other of a block by way of that block's shingle is left out of it.
    """

    def gather(table: pa.Table) -> pa.Table:
        def joined(name: str, dtype) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=dtype)

        shingle, size = joined("shingles", np.uint64), joined("sizes", np.int32).astype(np.int64)
        place = joined("places", np.int32).astype(np.int64)
        halves = joined("classes", ">u8").reshape(-1, 2).astype(np.uint64)

        def pick(rows) -> None:
            nonlocal shingle, size, place, halves
            shingle, size, place, halves = shingle[rows], size[rows], place[rows], halves[rows]

        def shared() -> np.ndarray:
            """Whether an entry's neighbour has the same shingle."""
            if not len(shingle):
                return np.zeros(0, bool)
            same = np.append(False, shingle[1:] == shingle[:-1])
            return same | np.append(same[1:], False)

        pick(np.argsort(shingle, kind="stable"))
        pick(shared())
        pick(np.lexsort((halves[:, 1], halves[:, 0], size, shingle)))
        if len(shingle):
            pick(np.append(True, (shingle[1:] != shingle[:-1]) | (halves[1:] != halves[:-1]).any(axis=1)))
        pick(shared())
        if len(shingle):
            starts = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1]))
            ends = np.append(starts[1:], len(shingle))
            keep = np.ones(len(shingle), bool)
            two = starts[ends - starts == 2]
            keep[two] = keep[two + 1] = _may_link(
                size[two], place[two], size[two + 1], place[two + 1]
            )
            for a, b in zip(starts, ends, strict=True):
                if 2 < b - a <= PIECE:
                    fits = _may_link(size[a:b, None], place[a:b, None], size[a:b], place[a:b])
                    np.fill_diagonal(fits, False)
                    keep[a:b] = fits.any(axis=1)
            pick(keep)
        names = halves.astype(">u8").tobytes()
        packed = size.astype(np.int32)
        blocks: dict[bytes, bytes] = {}
        if len(shingle):
            starts = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1]))
            for a, b in zip(starts, np.append(starts[1:], len(shingle)), strict=True):
                blocks[names[16 * a : 16 * b]] = packed[a:b].tobytes()
        return pa.table({
            "members": pa.array([*blocks], pa.binary()),
            "sizes": pa.array([*blocks.values()], pa.binary()),
        })

    return written(
        prefixes.groupBy("bucket").applyInArrow(gather, "members binary, sizes binary")
        .groupBy("members").agg(F.first("sizes").alias("sizes")),
        "jaccard_blocks",
    )


def _stars(blocks: DataFrame) -> DataFrame:
    """(x, y): each block's first class with the others near enough in size; further ones get a
    first class of their own."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[bytes, bytes]] = set()
            for members, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hub = None
                for k, size in enumerate(np.frombuffer(sizes, np.int32).tolist()):
                    name = members[16 * k : 16 * k + 16]
                    if hub is None or 100 * hub[1] < PERCENT * size:
                        hub = (name, size)
                    else:
                        found.add((hub[0], name))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in found], pa.binary()) for i in (0, 1)], ["x", "y"]
            )

    return blocks.select("members", "sizes").mapInArrow(pair, "x binary, y binary").distinct()


def _sets(documents: DataFrame, described: DataFrame, blocks: DataFrame) -> DataFrame:
    """(class, n, sketch, shingles packed) of every class that is in a block, once.

    A class is taken from the text of its least id; where the text of a row with that id is of
    another class it is passed over. Sets are moved only where ids with their texts repeat.
    """
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = {m[i : i + 16] for m in batch.column(0).to_pylist() for i in range(0, len(m), 16)}
            yield pa.RecordBatch.from_arrays([pa.array([*every], pa.binary())], ["class"])

    wanted = blocks.select("members").mapInArrow(split, "class binary").distinct()
    first = written(
        described.filter("row >= 0 and n > 0").join(wanted, "class", "left_semi")
        .groupBy("class").agg(F.min("doc_id").alias("doc_id")), "jaccard_wanted",
    )
    named = first.filter("doc_id is not null")
    total = first.count()
    rows = documents.select("doc_id", "text")
    picked = rows.join(F.broadcast(named) if total <= BROADCAST_ROWS else named, "doc_id")
    nameless = first.filter("doc_id is null").select("class")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.claim("shingles")
        for batch in _sliced(batches):
            found = {}
            for text, own in zip(batch.column(0), batch.column(1), strict=True):
                shingles, own = shingle_set(text.as_py()), own.as_py()
                if len(shingles) and own in (None, class_of(shingles)):
                    found[class_of(shingles)] = shingles
            yield pa.RecordBatch.from_arrays(
                [pa.array([*found], pa.binary()),
                 pa.array([len(s) for s in found.values()], pa.int64()),
                 pa.array([sketch_of(s) for s in found.values()], pa.binary()),
                 pa.array([s.tobytes() for s in found.values()], pa.binary())],
                ["class", "n", "sketch", "shingles"],
            )

    schema = "class binary, n long, sketch binary, shingles binary"
    packed = picked.select("text", "class").mapInArrow(pack, schema)
    if not nameless.isEmpty():
        without = rows.filter("doc_id is null").select("text", F.lit(None).cast("binary").alias("class"))
        packed = packed.union(without.mapInArrow(pack, schema).join(nameless, "class", "left_semi"))
    packed = written(packed, "jaccard_packed")
    if packed.count() == total:
        return packed
    return written(packed.dropDuplicates(["class"]), "jaccard_sets")


def _few(table: DataFrame) -> DataFrame:
    """A stored table of names, sent to the sets where its size allows; else the sets move too."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _possible(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) that sketches do not rule out; no whole set is moved."""
    def rule_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, n, b, m = (batch.column(c).to_pylist() for c in (2, 3, 4, 5))
            keep = [
                bool(Sketches([first], [size]).may_link(second, other)[0])
                for first, size, second, other in zip(a, n, b, m, strict=True)
            ]
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    narrow = sets.select("class", "sketch", "n")
    stars = written(stars, "jaccard_candidates")
    return written(
        _few(stars).join(narrow.toDF("x", "x_sketch", "x_n"), "x")
        .join(narrow.toDF("y", "y_sketch", "y_n"), "y")
        .select("x", "y", "x_sketch", "x_n", "y_sketch", "y_n")
        .mapInArrow(rule_out, "x binary, y binary"), "jaccard_stars")


def _still_apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose classes are not in one component yet."""
    own = joined.select(F.col("node").alias("x"), F.col("component").alias("x_component"))
    other = joined.select(F.col("node").alias("y"), F.col("component").alias("y_component"))
    apart = F.coalesce("x_component", "x") != F.coalesce("y_component", "y")
    return pairs.join(own, "x", "left").join(other, "y", "left").filter(apart).select("x", "y")


def _star_links(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs ``stars`` that are linked, as far as they connect classes.

    First every class meets one of its first classes, the one that most classes have. That connects
    most of what can be connected; what is then still apart, meets in the second round. So a set
    is moved about once, however many blocks its class is in.
    """
    possible = _possible(stars, sets)
    popular = possible.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    one = (
        possible.join(popular, "x").groupBy("y")
        .agg(F.max(F.struct("n", "x")).alias("best")).select(F.col("best.x").alias("x"), "y")
    )
    one = written(one, "jaccard_first_stars")
    links = _met(one, sets)
    if links.isEmpty():
        joined_rest = possible
    else:
        joined_rest = _still_apart(possible, components(links))
    # A pair that has met without a link is not tried again.
    rest = written(joined_rest.join(one, ["x", "y"], "left_anti"), "jaccard_more_stars")
    return links if rest.isEmpty() else links.union(_met(rest, sets))


def _met(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The linked ones of some pairs (x, y).

    The sets of all y stream past their x, which comes first; an x with more than ``PIECE`` partners
    is sent to several tasks.
    """
    parts = pairs.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("parts"))
    salted = pairs.join(parts, "x").withColumn(
        "salt", F.pmod(F.xxhash64("y"), F.col("parts")).cast("int"))
    salted = written(salted.select("x", "y", "salt"), "jaccard_pairs")
    members = _few(salted).join(
        sets.select(F.col("class").alias("y"), "shingles"), "y"
    ).select("x", "salt", "y", "shingles")
    heads = _few(written(salted.select("x", "salt").distinct(), "jaccard_heads")).join(
        sets.select(F.col("class").alias("x"), "shingles"), "x"
    ).select("x", "salt", F.lit(None).cast("binary").alias("y"), "shingles")
    ordered = heads.union(members).repartition("x", "salt").sortWithinPartitions(
        "x", "salt", F.col("y").asc_nulls_first()
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = query = None
        for batch in batches:
            found, names, sets_ = [], [], []

            def flush() -> None:
                if names:
                    found.extend((head, names[m]) for m in Index(sets_, query).search(query))
                names.clear()
                sets_.clear()

            for x, y, packed in zip(*batch.columns, strict=True):
                own, y = np.frombuffer(packed.as_py(), np.uint64), y.as_py()
                if y is None:
                    flush()
                    head, query = x.as_py(), own
                else:
                    names.append(y)
                    sets_.append(own)
                    if len(names) >= PIECE:
                        flush()
            flush()
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in found], pa.binary()) for i in (0, 1)], ["x", "y"]
            )

    return written(
        ordered.select("x", "y", "shingles").mapInArrow(search, "x binary, y binary"),
        "jaccard_star_links",
    )


def _open_pieces(blocks: DataFrame, joined: DataFrame) -> DataFrame:
    """(block, i, j, class, component): pieces, two by two, of blocks of several components."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for members, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(members) > 32:  # two classes were searched already
                    block = xxhash.xxh3_128_digest(members)
                    out += [
                        (block, k // PIECE, members[16 * k : 16 * k + 16], size)
                        for k, size in enumerate(np.frombuffer(sizes, np.int32).tolist())
                    ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.binary(), pa.int32(), pa.binary(), pa.int64()))],
                ["block", "piece", "class", "n"],
            )

    entries = blocks.select("members", "sizes").mapInArrow(
        split, "block binary, piece int, class binary, n long"
    ).join(joined.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    entries = written(entries, "jaccard_entries")
    several = entries.groupBy("block").agg(
        F.min("component").alias("a"), F.max("component").alias("b")
    ).filter("a <> b").select("block")
    pieces = written(
        entries.join(several, "block", "left_semi").groupBy("block", "piece").agg(
            F.min("n").alias("least"), F.max("n").alias("most")
        ), "jaccard_pieces",
    )
    other = pieces.select(
        "block", F.col("piece").alias("j"), F.col("least").alias("j_least")
    )
    pairs = pieces.withColumnRenamed("piece", "i").join(other, "block").filter(
        (F.col("i") <= F.col("j")) & (100 * F.col("most") >= PERCENT * F.col("j_least"))
    ).select("block", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("piece"))
    return entries.join(pairs, ["block", "piece"]).select(
        "block", "i", "j", "piece", "class", "component"
    )


def _piece_links(pieces: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that connect classes of different components, within pairs of pieces."""

    def search(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        rows = [*zip(*(table.column(c).to_pylist() for c in (
            "piece", "class", "component", "shingles")), strict=True)]
        first = [r for r in rows if r[0] == i]
        second = [r for r in rows if r[0] == j]
        index = Index([np.frombuffer(r[3], np.uint64) for r in first])
        found = []
        known: dict[bytes, bytes] = {}

        def root(component: bytes) -> bytes:
            while component in known:
                component = known[component]
            return component

        for r in second:  # of the links, those that connect what was not connected here before
            for m in index.search(np.frombuffer(r[3], np.uint64)):
                a, b = root(first[m][2]), root(r[2])
                if a != b:
                    known[max(a, b)] = min(a, b)
                    found.append((first[m][1], r[1]))
        return pa.table({k: pa.array([p[n] for p in found], pa.binary()) for n, k in enumerate("xy")})

    def rule_out(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        piece = np.array(table.column("piece").to_pylist())
        names, sketches, sizes, components_ = (
            table.column(c).to_pylist() for c in ("class", "sketch", "n", "component"))
        own = np.array([hash(c) for c in components_])
        first, second = np.flatnonzero(piece == i), np.flatnonzero(piece == j)
        bound = Sketches([sketches[k] for k in first], [sizes[k] for k in first])
        keep = np.zeros(len(names), bool)
        for k in second:
            near = bound.may_link(sketches[k], sizes[k]) & (own[first] != own[k])
            if near.any():
                keep[k] = True
                keep[first[near]] = True
        return table.select(["block", "i", "j", "piece", "class", "component"]).filter(
            pa.array(keep)
        )

    pieces = written(
        pieces.join(sets.select("class", "sketch", "n"), "class").groupBy("block", "i", "j")
        .applyInArrow(rule_out, "block binary, i int, j int, piece int, class binary, component binary"),
        "jaccard_open",
    )
    met = _few(pieces).join(sets.select("class", "shingles"), "class")
    return met.groupBy("block", "i", "j").applyInArrow(search, "x binary, y binary")


def join(documents: DataFrame) -> DataFrame:
    """(row, doc_id, class, n_shingles, component_id, kept) for every row of ``documents``.

    ``kept`` is true for one row of each component: its smallest id, then its first row.
    """
    described = _described(documents)
    rows = described.filter("row >= 0").select("row", "doc_id", "n", "class")
    total = rows.agg(F.sum("n")).first()[0] or 0
    parallel = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(parallel if total > BUCKET else 1, 2**20), total // (4 * BUCKET))
    blocks = _blocks(_prefixes(documents, _frequent(described), buckets))
    sets = _sets(documents, described, blocks)
    links = _star_links(_stars(blocks), sets)
    more = written(
        _piece_links(_open_pieces(blocks, components(links)), sets).distinct(), "jaccard_links"
    )
    joined = components(links.union(more))
    named = rows.join(joined.withColumnRenamed("node", "class"), "class", "left").select(
        "row", "doc_id", "class", F.col("n").alias("n_shingles"),
        F.coalesce("component", "class").alias("component"),
    )
    named = written(named, "jaccard_named")
    least = named.filter("component is not null").groupBy("component").agg(
        F.min("doc_id").alias("component_id"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"),
    ).select("component", "component_id", F.col("first.row").alias("first_row"))
    alone = named.filter("component is null").select(
        "row", "doc_id", "class", "n_shingles", F.col("doc_id").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    return named.join(least, "component").select(
        "row", "doc_id", "class", "n_shingles", "component_id",
        (F.col("row") == F.col("first_row")).alias("kept"),
    ).union(alone)


def classes(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    return join(documents).select("doc_id", "n_shingles", "component_id")


def _with_class(documents: DataFrame, name: str) -> DataFrame:
    """The rows with their class under ``name``: a digest of the text where it has no shingles."""
    names = [*documents.columns, name]
    at = documents.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = []
            for text in batch.column(at):
                text = text.as_py()
                shingles = shingle_set(text)
                if len(shingles):
                    classes.append(class_of(shingles))
                else:
                    classes.append(None if text is None else b"text:" + text.encode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(classes, pa.binary())], names)

    return documents.mapInArrow(add, StructType([*documents.schema, StructField(name, BinaryType())]))


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each component, all columns as they are.

    The document with the smallest id stays; in a component without any id, one row of it. Rows are
    told apart by id, and where an id repeats or is null by their texts' classes; of rows that
    repeat both, one stays. Texts without shingles are linked with nothing: under one id, or without
    an id, those with one and the same text count as repeated rows only where the id repeats.
    """
    own = "own_class"
    while own in documents.columns:
        own += "_"
    decided = written(
        join(documents).select("doc_id", "class", "component_id", "kept"), "jaccard_decided"
    )
    ids = decided.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max("kept").alias("kept"), F.count("*").alias("n")
    )
    special = written(ids.filter("not kept or n > 1"), "jaccard_special")
    listed = special.select("doc_id")
    repeated = special.filter("kept and n > 1").select("doc_id")
    small = special.count() <= BROADCAST_ROWS

    def few(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if small else table

    kept = documents.join(few(listed), "doc_id", "left_anti").select(*documents.columns)
    nameless = decided.filter("doc_id is null and class is not null")
    if not nameless.isEmpty():
        stays = nameless.filter("kept and component_id is null").select(
            F.col("class").alias(own)).distinct()
        classed = _with_class(documents.filter("doc_id is null"), own)
        bare = F.col(own).isNull() | F.startswith(F.col(own), F.lit(b"text:"))
        one = classed.filter(~bare).join(stays, own, "left_semi").dropDuplicates([own])
        kept = (
            kept.filter("doc_id is not null")
            .union(classed.filter(bare).select(*documents.columns))
            .union(one.select(*documents.columns))
        )
    if repeated.isEmpty():
        return kept
    # Texts without shingles have no class; each is a component of its own.
    chosen = decided.join(few(repeated), "doc_id", "left_semi").filter("kept and class is not null")
    chosen = chosen.select("doc_id", F.col("class").alias(own)).distinct()
    again = _with_class(
        documents.join(few(repeated), "doc_id", "left_semi").select(*documents.columns), own)
    again = again.dropDuplicates(["doc_id", own])
    bare = F.col(own).isNull() | F.startswith(F.col(own), F.lit(b"text:"))
    return kept.union(again.filter(bare).select(*documents.columns)).union(
        again.join(chosen, ["doc_id", own], "left_semi").select(*documents.columns)
    )
