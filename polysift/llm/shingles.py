"""Sets of word shingles as sorted 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

#: Bytes hashed at once.
CHUNK_BYTES = 1 << 17
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_TABLES: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads 64-bit numbers evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _TABLES[name] = np.cumprod(steps, dtype=np.uint64)
    return _TABLES["up"], _TABLES["down"]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of every white-space separated word."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = _powers(max(len(raw), 1 << 16))
    edge = np.diff(np.concatenate(([True], _SPACE[raw], [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sorted_unique(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    kept = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=kept[1:])
    return x[kept]


def _combined(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words."""
    n = len(words) - k + 1
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total += words[i : i + n] * np.uint64(pow(_BASE, 2 * i + 3, 1 << 64))
    return mix(total)


def text_sets(texts: list[bytes | str | None], k: int) -> Iterator[np.ndarray]:
    """For each text its distinct ``k``-word shingles, or its whole words if fewer, as a sorted array; empty without words."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b"").lower()
        if size + len(data) > CHUNK_BYTES and held:
            yield from _chunk_sets(held, k)
            held, size = [], 0
        if len(data) > CHUNK_BYTES:
            yield _long_set(data, k)
            continue
        held.append(data)
        size += len(data) + 1
    yield from _chunk_sets(held, k)


def _long_set(data: bytes, k: int) -> np.ndarray:
    words = data.split()
    parts = [word_hashes(b" ".join(words[i : i + 200_000]))[1] for i in range(0, len(words), 200_000)]
    hashes = np.concatenate([*parts, np.zeros(0, np.uint64)])
    return sorted_unique(_combined(hashes, min(k, len(hashes)))) if len(hashes) else hashes


def _chunk_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    if not texts:
        return
    starts, words = word_hashes(b"\n".join(texts))
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    cut = np.searchsorted(starts, begins)
    runs = _combined(words, k) if len(words) >= k else np.zeros(0, np.uint64)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if b - a >= k:
            yield sorted_unique(runs[a : b - k + 1])
        else:
            yield _combined(words[a:b], b - a) if b > a else words[:0]


def set_key(tokens: np.ndarray) -> int:
    """Signed 64-bit key of a set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)
