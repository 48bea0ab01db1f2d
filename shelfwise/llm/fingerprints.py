"""Document fingerprints: one-permutation MinHash of five-word shingles.

One hash per shingle: its top bits choose a bin, the rest compete for the bin's minimum. An
empty bin borrows from another bin, tried in a fixed random order of its own until one that is
not empty comes (optimal densification), so that equal sets agree in every bin and the chance
that two bins agree is the sets' Jaccard similarity. Of each minimum the lowest ``BITS`` bits are
kept, packed. Low bits of different minima agree by chance; the likeness corrects that bias.

Defined results: a null text counts as an empty one. A text without words has a fingerprint of
its own (the empty string); it is like itself (1) and unlike all others (0). Equal texts have
equal fingerprints. Documents are ordered by descending doc_id; null ids come last; rows with
the same id follow by text. The last one's next is the first; a single document's next is itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from shelfwise.llm.shingles import shingle_hashes

BINS = 256
BITS = 8
#: Rows of a part of the ordered texts, and how many parts there are at most.
ROWS_PER_PART = 2_000
MOST_PARTS = 50_000
_BIN_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_NONE = np.uint64(2**64 - 1)
_ONE = np.uint64(1)


def _detours() -> np.ndarray:
    """Row i: the order in which bin i, when empty, looks at the other bins."""
    rng = np.random.default_rng(8)
    return np.argsort(rng.random((BINS, BINS)), axis=1).astype(np.int64)


_DETOURS = _detours()


def fingerprint(text: str | None) -> bytes:
    """``BINS`` times ``BITS`` packed bits; empty for a text without words."""
    hashes = shingle_hashes(text)
    if not len(hashes):
        return b""
    least = np.full(BINS, _NONE)
    np.minimum.at(least, (hashes >> _BIN_SHIFT).astype(np.int64), hashes & ((_ONE << _BIN_SHIFT) - _ONE))
    full = least != _NONE
    empty = np.flatnonzero(~full)
    if len(empty):
        order = _DETOURS[empty]
        least[empty] = least[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return (least & np.uint64(2**BITS - 1)).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard similarity, 0 to 1, corrected for chance agreement of low bits."""
    if not a or not b:
        return float(a == b)
    agree = float(np.mean(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)))
    chance = 2.0**-BITS
    return max(0.0, (agree - chance) / (1 - chance))


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as much of the beginning of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _in_order(documents: DataFrame) -> DataFrame:
    """(part, ghost, doc_id, text): parts of the table in descending order of ids.

    A part's ids lie between two borders, which are ids of the table at about even ranks; only
    the ids are read to find them. The rows at a border begin a part and follow the part before
    it as ghosts; the rows of the largest id follow the last part. So every row meets its
    successor, and every text moves once.
    """
    ids = documents.select("doc_id").where(F.col("doc_id").isNotNull())
    shape = ids.agg(F.count("*").alias("n"), F.max("doc_id").alias("first")).first()
    parts = max(1, min(shape["n"] // ROWS_PER_PART, MOST_PARTS))
    shares = [i / parts for i in range(1, parts)]
    borders = np.array(sorted(set(
        ids.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * parts))).first()[0]
        if shares else ()
    ) - {shape["first"]}), dtype=np.int64)

    @F.pandas_udf(ArrayType(IntegerType()))
    def places(column: pd.Series) -> pd.Series:
        """The part, then (negative, from -1) the parts that the row follows as a ghost."""
        given = column.notna().to_numpy()
        known = column.where(given, 0).astype("int64").to_numpy()
        part = len(borders) - np.searchsorted(borders, known)
        begins = np.isin(known, borders) & given
        out = []
        for row_part, row_given, row_begins, value in zip(part, given, begins, known, strict=True):
            if not row_given:
                out.append([len(borders)])
            elif value == shape["first"]:
                out.append([int(row_part), -1 - len(borders)])
            else:
                out.append([int(row_part), -int(row_part)] if row_begins else [int(row_part)])
        return pd.Series(out)

    placed = documents.select(
        "doc_id", "text", F.explode(places(F.col("doc_id"))).alias("place")
    )
    ghost = F.col("place") < 0
    return placed.select(
        F.when(ghost, -1 - F.col("place")).otherwise(F.col("place")).alias("part"),
        ghost.alias("ghost"), "doc_id", "text",
    )


def compare(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next."""
    doc_id = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def described(row, following) -> tuple:
        doc, text, own = row
        _, next_text, next_own = following
        changed = edited(text, next_text)
        changed_own = own if changed == text else fingerprint(changed)
        digest = hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest()
        return (doc, len(text), digest, own.hex(), changed_own.hex(),
                likeness(own, changed_own), likeness(own, next_own))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = first = before = None
        for batch in batches:
            out = []
            for at, ghost, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != part:
                    if before is not None:
                        out.append(described(before, first))
                    part, first, before = at, None, None
                elif ghost and before is None:
                    continue
                text = text or ""
                row = (doc, text, fingerprint(text))
                if before is not None:
                    out.append(described(before, row))
                first, before = first or row, None if ghost else row
            yield _batch(out, doc_id_type, names)
        if before is not None:
            yield _batch([described(before, first)], doc_id_type, names)

    doc_id_type = pa.from_numpy_dtype(np.dtype(
        {"bigint": "int64", "int": "int32", "smallint": "int16"}[doc_id]
    ))
    ordered = _in_order(documents).repartition("part").sortWithinPartitions(
        "part", "ghost", F.col("doc_id").desc_nulls_last(), "text"
    )
    return ordered.select("part", "ghost", "doc_id", "text").mapInArrow(
        rows,
        f"doc_id {doc_id}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def _batch(out: list[tuple], doc_id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [doc_id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
             pa.float64()]
    columns = list(zip(*out, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )
