"""Byte-level BPE encoding and decoding with a two-tier lookup.

Text is cut by the tokenizer's pattern. Tier one: a minimal perfect hash over the vocabulary resolves a whole pre-token
that is an entry itself. Tier two: any other pre-token starts as linked bytes, and a heap of neighbouring pairs by rank
merges them, the lowest rank first and the leftmost of equals. The tables hold one entry per vocabulary entry, a size
that is fixed by the vocabulary file, and are broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polysift.llm.common import Shared, map_texts

#: Distinct pre-tokens a task remembers before it starts anew; bounds memory, changes no result.
REMEMBERED = 400_000
_SLOT = (1 << 32) - 1


class PerfectHash:
    """Minimal perfect hash: as many slots as keys. Buckets are displaced largest first; single keys take what is left."""

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.n_buckets = max(1, n // 3)
        hashes = [xxhash.xxh3_128_intdigest(k) for k in keys]
        buckets: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            buckets.setdefault((h >> 64) % self.n_buckets, []).append(i)
        self.shift = np.zeros(self.n_buckets, np.int64)
        self.key_at = np.zeros(n, np.int64)
        free = np.ones(n, bool)
        singles = []
        for bucket, members in sorted(buckets.items(), key=lambda b: (-len(b[1]), b[0])):
            if len(members) == 1:
                singles.append((bucket, members[0]))
                continue
            parts = [(hashes[i] & _SLOT, (hashes[i] >> 32 & _SLOT) | 1) for i in members]
            shift = 0
            while True:
                slots = {self._at(a, b, shift) for a, b in parts}
                if len(slots) == len(parts) and all(free[s] for s in slots):
                    break
                shift += 1
            self.shift[bucket] = shift
            for i, (a, b) in zip(members, parts, strict=True):
                self.key_at[self._at(a, b, shift)] = i
                free[self._at(a, b, shift)] = False
        for (bucket, i), slot in zip(singles, np.flatnonzero(free).tolist(), strict=True):
            self.shift[bucket] = -slot - 1
            self.key_at[slot] = i

    def slot(self, key: bytes) -> int:
        """Slot of the key if it is one of the keys; any slot otherwise."""
        h = xxhash.xxh3_128_intdigest(key)
        shift = int(self.shift[(h >> 64) % self.n_buckets])
        return -shift - 1 if shift < 0 else self._at(h & _SLOT, (h >> 32 & _SLOT) | 1, shift)

    def _at(self, a: int, b: int, shift: int) -> int:
        """Displaced slot; after ``n`` steps of ``b`` the start moves on by one, so every slot is reached."""
        return (a + shift % self.n * b + shift // self.n) % self.n


class Vocabulary:
    """Tables of one tokenizer: pattern, token bytes by id, perfect hash of the tokens, ranks of the merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        keys = list(ranks)
        self.hash = PerfectHash(keys)
        self.token_at = [keys[i] for i in self.hash.key_at.tolist()]
        self.id_at = [ranks[t] for t in self.token_at]

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """A file with a base64 token and its rank on each line."""
        with open(path, "rb") as file:
            return cls({base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}, pattern)

    def whole(self, piece: bytes) -> int | None:
        """Tier one: the id of a piece that is an entry."""
        slot = self.hash.slot(piece)
        return self.id_at[slot] if self.token_at[slot] == piece else None

    def merged(self, piece: bytes) -> list[int]:
        """Tier two: linked bytes, merged by a heap of (rank, place, end) of neighbouring pairs."""
        n, ranks = len(piece), self.ranks
        end = list(range(1, n + 1))  # of the part that starts here
        before = list(range(-1, n - 1))  # start of the part to the left
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not alive[i] or mid >= n or end[mid] != stop:
                continue  # one of the two parts has been merged since
            alive[mid] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (left := before[i]) >= 0 and (r := ranks.get(piece[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def piece_ids(self, piece: bytes) -> list[int]:
        return [found] if (found := self.whole(piece)) is not None else self.merged(piece)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Encoder:
    """Encodes texts and remembers distinct pre-tokens, up to ``REMEMBERED`` of them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        pieces = self.find(text) if text else []
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for p in set(pieces).difference(known):
            known[p] = self.vocabulary.piece_ids(p.encode())
        return list(chain.from_iterable(map(known.__getitem__, pieces)))


def encode(docs: DataFrame, vocabulary: Vocabulary, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The documents with their token ids as ``array<int>``; a column of that name is replaced. Null text: no ids."""
    shared = Shared(docs.sparkSession, vocabulary)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.get())
        for texts in batches:
            yield pd.Series([encoder.encode(t) for t in texts])

    return docs.withColumn(ids_col, ids(F.col(text_col)))


def decode(tokens: DataFrame, vocabulary: Vocabulary, *, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Rows with the bytes of their ids; null ids are no bytes, an id outside the vocabulary is an error."""
    shared = Shared(tokens.sparkSession, vocabulary)

    @F.pandas_udf("binary")
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = shared.get()
        for column in batches:
            yield pd.Series([tables.decode([] if x is None else [int(i) for i in x]) for x in column])

    return tokens.withColumn(bytes_col, back(F.col(ids_col)))


def round_trip(
    docs: DataFrame, vocabulary: Vocabulary, *, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per document: number of ids, digest of the ids in decimal, digest of the decoded bytes, and on request the ``ids``.

    A null or empty text has no ids and decodes to no bytes. Ids are encoded and decoded in one task, so no token array
    leaves it. Repeated rows give repeated rows; other columns are ignored.
    """
    shared = Shared(docs.sparkSession, vocabulary)
    shown = "bigint" if docs.schema[id_col].dataType.simpleString() == "bigint" else "string"
    fields = {"id_": pa.int64() if shown == "bigint" else pa.string(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    schema = f"id_ {shown}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields["ids"], schema = pa.list_(pa.int32()), schema + ", ids array<int>"

    def start():
        tables = shared.get()
        encoder = Encoder(tables)
        decimal = [str(i) for i in range(max(tables.bytes_of, default=0) + 1)]

        def step(ids, texts):
            out = {"id_": ids, "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for text in texts:
                tokens = encoder.encode(text)
                out["n_tokens"].append(len(tokens))
                if with_ids:
                    out["ids"].append(np.array(tokens, np.int32))
                out["ids_sha256"].append(hashlib.sha256(" ".join(map(decimal.__getitem__, tokens)).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(tables.decode(tokens)).hexdigest())
            return out

        return step

    picked = docs.select(F.col(id_col).cast(shown).alias("id_"), F.col(text_col).alias("text_"))
    out = map_texts(picked, ["id_", "text_"], schema, fields, start)
    return out.withColumnRenamed("id_", id_col)
