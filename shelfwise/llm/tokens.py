"""Token counts and ids by a public tokenizer, through tables of pre-token encodings.

A byte-level tokenizer first cuts a text into pre-tokens and encodes each by itself, so that the
ids of a text are the ids of its pre-tokens one after another. Pre-tokens repeat; their encodings
are looked up. Texts with characters outside a checked alphabet, with a special token's string,
or for a tokenizer of another kind, are given to the library whole: results are the library's in
every case.

``count_tokens`` looks up lengths in two tiers: a compact table of the pre-tokens that are
frequent in the corpus, broadcast once, then a cache in each worker for the rest, filled by the
library. The texts' pre-tokens are never shuffled; for the frequent table every task adds up its
own counts and hands on the most frequent of them.

Defined results: a null text counts as an empty one, with no tokens. Repeated rows and ids stay
as they are.
"""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import caches


#: Entries of the broadcast table, and how many each task proposes for it.
FREQUENT = 32_768
PROPOSED = 4_096
#: Entries of a worker's cache; pre-tokens beyond it are encoded each time.
CACHED = 1_000_000
#: Entries of its cache of units from space to space.
CACHED_UNITS = 250_000
#: Longer pre-tokens are not kept.
CACHED_LENGTH = 64
MAX_TOKENS = 1024


def _ranges(kind: str) -> str:
    """Regular-expression ranges of the characters of a general category below U+0250."""
    return "".join(
        re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c)).startswith(kind)
    )


_LETTERS, _NUMBERS, _SPACES = _ranges("L"), _ranges("N"), "\\t-\\r \\x85\\xa0"
# Fixed value: the public pre-token pattern of byte-level BPE, written for that alphabet.
PRE_TOKEN = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+"
    f"| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
#: Anything else may be classified differently by the library's version of Unicode.
_UNCHECKED = re.compile("[^\\x00-\\u024f\\u2010-\\u2027\\u2030-\\u205e\\u20ac]")


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: its own character where
    that is printable, else the next one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in printable)
    return {b: 256 + k for k, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class PreTokens:
    """Cuts texts as the tokenizer in ``file`` does; None where the library must see all."""

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        self.model = self.library.model
        added = self.library.get_added_tokens_decoder().values()
        self.special = [t.content for t in added]
        self.cuts = (
            self.library.normalizer is None
            and "ByteLevel(add_prefix_space=False" in repr(self.library.pre_tokenizer)
            and "use_regex=True" in repr(self.library.pre_tokenizer)
        )

    def cuttable(self, text: str) -> bool:
        if not self.cuts or any(s in text for s in self.special):
            return False
        try:
            text.encode("latin-1")  # the quick test; every character of it is in the alphabet
            return True
        except UnicodeEncodeError:
            return not _UNCHECKED.search(text)

    def of(self, text: str) -> list[str] | None:
        return PRE_TOKEN.findall(text) if self.cuttable(text) else None

    def encode_one(self, pre_token: str) -> list[int]:
        """The ids of one pre-token, from the library's model alone."""
        if not self.cuts:
            return self.encode(pre_token)
        seen = pre_token.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return [token.id for token in self.model.tokenize(seen)]

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids


class Cache(dict):
    """Encodings by pre-token; a miss asks the library and is kept while there is room."""

    def __init__(self, pre_tokens: PreTokens, value, known: dict | None = None, room: int = CACHED):
        super().__init__(known or {})
        self.pre_tokens, self.value, self.room = pre_tokens, value, room

    def __missing__(self, pre_token: str):
        found = self.value(self.pre_tokens.encode_one(pre_token))
        if self.room > 0 and len(pre_token) <= CACHED_LENGTH:
            self[pre_token] = found
            self.room -= 1
        return found

    def passing(self, pre_token: str):
        """The same, but what is not known yet is not kept."""
        return self[pre_token] if pre_token in self else self.value(self.pre_tokens.encode_one(pre_token))


class _Units(dict):
    """Encodings of what stands between spaces, each with the space before it."""

    def __init__(self, pre_tokens: Cache):
        super().__init__()
        self.pre_tokens = pre_tokens

    def __missing__(self, unit: str) -> bytes:
        parts = PRE_TOKEN.findall(" " + unit)
        if len(self) < CACHED_UNITS and len(unit) <= CACHED_LENGTH:
            # A unit that is one pre-token is kept here only.
            known = self.pre_tokens.passing if len(parts) == 1 else self.pre_tokens.__getitem__
            self[unit] = found = b"".join(map(known, parts))
            return found
        return b"".join(map(self.pre_tokens.__getitem__, parts))


class Ids:
    """Token ids of texts as little-endian unsigned numbers, 2 bytes where the vocabulary fits.

    A pre-token begins at every single space, so a text is looked up in units from space to
    space; a unit that is not known is put together from its pre-tokens. Where white space
    stands on both sides of a space this does not hold, and the text is cut in pre-tokens.
    """

    _SPACED = re.compile(f"[{_SPACES}] [{_SPACES}]")

    def __init__(self, file: str):
        self.pre_tokens = PreTokens(file)
        self.dtype = np.dtype("<u2" if self.pre_tokens.library.get_vocab_size() <= 65536 else "<u4")
        self.cache = Cache(self.pre_tokens, self._bytes, room=CACHED - CACHED_UNITS)
        self.units = _Units(self.cache)

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def of(self, text: str) -> bytes:
        if not self.pre_tokens.cuttable(text):
            return self._bytes(self.pre_tokens.encode(text))
        if self._SPACED.search(text):
            return b"".join(map(self.cache.__getitem__, PRE_TOKEN.findall(text)))
        first, *rest = text.split(" ")
        return b"".join((
            *map(self.cache.__getitem__, PRE_TOKEN.findall(first)),
            *map(self.units.__getitem__, rest),
        ))


_WORKER: dict = {}
caches.register("tokens", _WORKER.clear)


def worker_ids(file: str) -> Ids:
    """The encoder of this Python worker, which outlives a task."""
    caches.claim("tokens")
    if ("ids", file) not in _WORKER:
        _WORKER["ids", file] = Ids(file)
    return _WORKER["ids", file]


def _worker_lengths(file: str, table, run: str) -> Cache:
    """The two tiers of this Python worker: the broadcast table, and room for misses."""
    caches.claim("tokens")
    if _WORKER.get("run") != run:
        _WORKER["run"], _WORKER["lengths"] = run, Cache(PreTokens(file), len, table.value)
    return _WORKER["lengths"]


def frequent_lengths(documents: DataFrame, file: str) -> dict[str, int]:
    """Token counts of the ``FREQUENT`` most frequent pre-tokens of the whole corpus.

    Every task counts all its texts and proposes its ``PROPOSED`` most frequent pre-tokens; the
    proposals are added up. The table's size is bounded; it affects speed, never results.
    """

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre_tokens, counts = PreTokens(file), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(pre_tokens.of(text or "") or ())
            if len(counts) > CACHED:
                counts = Counter(dict(counts.most_common(CACHED // 4)))
        best = [(p, n) for p, n in counts.most_common(PROPOSED) if len(p) <= CACHED_LENGTH]
        yield pa.RecordBatch.from_pydict(
            {"pre_token": pa.array([p for p, _ in best], pa.string()),
             "n": pa.array([n for _, n in best], pa.int64())}
        )

    proposals = documents.select("text").mapInArrow(propose, "pre_token string, n long")
    top = (
        proposals.groupBy("pre_token").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "pre_token").limit(FREQUENT).collect()
    )
    pre_tokens = PreTokens(file)
    return {row["pre_token"]: len(pre_tokens.encode_one(row["pre_token"])) for row in top}


def count_tokens(documents: DataFrame, file: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row."""
    shared = documents.sparkSession.sparkContext.broadcast(frequent_lengths(documents, file))
    run = uuid.uuid4().hex
    doc_id = documents.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _worker_lengths(file, shared, run)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                n_bytes.append(len(text.encode()))
                cut = lengths.pre_tokens.of(text)
                n_tokens.append(
                    len(lengths.pre_tokens.encode(text)) if cut is None
                    else sum(map(lengths.__getitem__, cut))
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    counted = documents.select("doc_id", "text").mapInArrow(
        count, f"doc_id {doc_id}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > max_tokens)
