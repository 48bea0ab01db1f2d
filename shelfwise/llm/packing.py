"""Packing: documents in the order of a space-filling curve, laid end to end into sequences.

Each text is encoded once. Its token counts, hashed into a fixed number of buckets, form a
vector that a fixed random matrix projects to ``DIMENSIONS`` coordinates. These are standardised
by their mean and deviation over all documents, cut into a grid, and the grid cell's place on a
Hilbert curve is the document's key: neighbours on the curve have similar tokens. Documents are
range-sorted by the key and laid one after another; a sequence is ``length`` tokens of that line,
so every sequence is full. What is left at the end goes into sequences of decreasing powers of
two, which need no padding either.

Only (row, key, token count) is sorted and summed; the ids move once, to meet their positions.

Defined results: a null text counts as an empty one and packs the final id alone. Rows with the
same key are ordered by doc_id, then by their place in the table; repeated rows are packed each.
No documents give no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from shelfwise.llm.tokens import worker_ids
from shelfwise.session import small_batches, written

LENGTH = 1024
FINAL_ID = 0
DIMENSIONS = 4
GRID_BITS = 8
#: Rows whose texts and ids a worker holds at once.
TOGETHER_ROWS = 512
BUCKETS = 1024
PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def projection() -> np.ndarray:
    """A fixed random matrix from hash buckets to coordinates."""
    return np.random.default_rng(20).standard_normal((BUCKETS, DIMENSIONS))


def coordinates(documents: list[np.ndarray], matrix: np.ndarray) -> np.ndarray:
    """The projected, length-normalised vectors of documents' hashed token counts."""
    out = np.zeros((len(documents), matrix.shape[1]))
    for begin in range(0, len(documents), 256):
        some = documents[begin : begin + 256]
        owner = np.repeat(np.arange(len(some)) * BUCKETS, [len(ids) for ids in some])
        ids = np.concatenate(some).astype(np.uint32)
        buckets = (ids * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        counts = np.bincount(owner + buckets, minlength=len(some) * BUCKETS)
        vectors = np.sqrt(counts.reshape(len(some), BUCKETS))
        size = np.linalg.norm(vectors, axis=1, keepdims=True)
        out[begin : begin + 256] = vectors @ matrix / np.maximum(size, 1)
    return out


def hilbert_key(cells: np.ndarray, bits: int = GRID_BITS) -> np.ndarray:
    """Places on the Hilbert curve of the rows of ``cells`` (integers below 2**bits).

    The curve is followed from the coarsest bit down: at each level the cell's bits are read in
    the orientation the curve has there, and tell how the next level is turned.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for i in range(n):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(high, x[0] ^ below, x[0] ^ swap)
            if i:
                x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where((x[n - 1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, TOGETHER_ROWS):
            yield batch.slice(start, TOGETHER_ROWS)


def _encoded(documents: DataFrame, file: str) -> DataFrame:
    """(row, doc_id, n, ids, c0..): every text encoded, with its coordinates; stored once."""
    doc_id = documents.schema["doc_id"].dataType.simpleString()
    axes = [f"c{i}" for i in range(DIMENSIONS)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, matrix = worker_ids(file), projection()
        row = TaskContext.get().partitionId() << 33
        final = np.array([FINAL_ID], dtype=encoder.dtype).tobytes()
        for batch in _sliced(batches):
            ids = [encoder.of(text or "") + final for text in batch.column(1).to_pylist()]
            at = coordinates([np.frombuffer(x, encoder.dtype) for x in ids], matrix)
            size = encoder.dtype.itemsize
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(ids))), batch.column(0),
                    pa.array([len(x) // size for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()), pa.array([size] * len(ids), pa.int32()),
                    *(pa.array(at[:, i]) for i in range(DIMENSIONS)),
                ],
                ["row", "doc_id", "n", "ids", "width", *axes],
            )
            row += len(ids)

    schema = f"row long, doc_id {doc_id}, n long, ids binary, width int, " + ", ".join(
        f"{a} double" for a in axes
    )
    with small_batches(documents.sparkSession, TOGETHER_ROWS):
        return written(documents.select("doc_id", "text").mapInArrow(encode, schema), "packing_ids")


def _keyed(encoded: DataFrame) -> DataFrame:
    """(row, doc_id, n, key): the place of each document on the curve."""
    axes = [f"c{i}" for i in range(DIMENSIONS)]
    spread = encoded.agg(
        *(F.avg(a).alias(f"m_{a}") for a in axes), *(F.stddev_pop(a).alias(f"s_{a}") for a in axes)
    ).first()
    mean = np.array([spread[f"m_{a}"] or 0.0 for a in axes])
    deviation = np.array([spread[f"s_{a}"] or 1.0 for a in axes])
    edges = [NormalDist().inv_cdf(i / 2**GRID_BITS) for i in range(1, 2**GRID_BITS)]

    @F.pandas_udf(LongType())
    def key(*columns: pd.Series) -> pd.Series:
        at = (np.stack([c.to_numpy() for c in columns], axis=1) - mean) / deviation
        return pd.Series(hilbert_key(np.searchsorted(edges, at)))

    return encoded.select("row", "doc_id", "n", key(*axes).alias("key"))


def _placed(keyed: DataFrame) -> DataFrame:
    """(row, place): how many tokens lie before each document on the line."""
    order = ["key", "doc_id", "row"]
    shares = max(1, int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_rows = written(
        keyed.repartitionByRange(shares, *order).withColumn("share", F.spark_partition_id()),
        "packing_order",
    )
    before = sorted_rows.groupBy("share").agg(F.sum("n").alias("n")).select(
        "share",  # one row a share: as many as there are partitions
        (F.sum("n").over(Window.orderBy("share")) - F.col("n")).alias("before"),
    )
    within = F.sum("n").over(
        Window.partitionBy("share").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return sorted_rows.select("row", "share", F.coalesce(within, F.lit(0)).alias("within")).join(
        F.broadcast(before), "share"
    ).select("row", (F.col("before") + F.col("within")).alias("place"))


def last_cuts(total: int, length: int) -> list[int]:
    """Where sequences end after the last full one: at decreasing powers of two."""
    at, cuts = total // length * length, []
    for bit in range(length.bit_length() - 1, -1, -1):
        if total % length & (1 << bit):
            at += 1 << bit
            cuts.append(at)
    return cuts


def cut_document(place: int, n: int, total: int, length: int) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of a document of ``n`` tokens."""
    full = total // length
    ends = last_cuts(total, length)
    pieces, start = [], 0
    while start < n:
        at = place + start
        if at < full * length:
            sequence, begin = at // length, at // length * length
            end = begin + length
        else:
            k = next(i for i, e in enumerate(ends) if at < e)
            sequence, begin, end = full + k, ends[k - 1] if k else full * length, ends[k]
        size = min(n - start, end - at)
        pieces.append((start, size, sequence, at - begin))
        start += size
    return pieces


def pack(documents: DataFrame, file: str, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    encoded = _encoded(documents, file)
    placed = written(_placed(_keyed(encoded)), "packing_places")
    total = encoded.agg(F.sum("n")).first()[0] or 0
    doc_id = documents.schema["doc_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            owner, rows = [], []
            places, widths = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for k, ids in enumerate(batch.column(1).to_pylist()):
                ids = np.frombuffer(ids, f"<u{widths[k]}").astype("<u4")
                for start, size, sequence, offset in cut_document(
                    places[k], len(ids), total, length
                ):
                    owner.append(k)
                    digest = zlib.crc32(ids[start : start + size].tobytes())
                    rows.append((start, size, digest, len(ids), sequence, offset))
            columns = np.array(rows, dtype=np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())),
                 *(pa.array(columns[:, i]) for i in range(6))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    met = encoded.select("row", "doc_id", "ids", "width").join(
        placed.hint("shuffle_hash"), "row"
    )
    return met.select("doc_id", "ids", "place", "width").mapInArrow(
        pieces, f"doc_id {doc_id}, {PIECES}"
    )
