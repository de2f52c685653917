"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors stay in their partitions. Each block of them gets an index: per dimension a posting list ordered by quantised value.
For a query, the postings of a dimension gain ``q * value`` over the least the dimension can give, so gains are never
negative, and postings are processed in tiers of descending gain over all dimensions. Accumulators hold a lower bound of every
score; what the unprocessed tiers and the quantisation can add bounds it from above. Processing stops once few vectors can
still be among the best (or nothing is left), and exactly these are scored again with their full values.

Queries and vectors are cut into blocks that meet inside tasks (``tiles``), so neither side passes through the driver and the plan is the
same for any number of queries; the best of each task are merged at the end.

Components may be any finite number. Where sums could leave the range in which doubles count exactly, products in double precision
with a proven error bound leave the vectors that can be among the best, and these are scored with integers of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polysift.operators import tiles
from polysift.scratch import materialise

SCALE = 256
LEVELS = 128
TIERS = 4
BLOCK_ROWS = 16_384
QUERY_ROWS = 512
#: Blocks of vectors that a block of queries meets in a task.
GROUP_BLOCKS = 2
#: Vectors left, as a share of the block, that are cheaper to score than to narrow down further.
FEW = 1 / 16
#: Sums of integers below this are exact in double precision, with room for what tiers and quantisation add.
EXACT = 2.0**50
LONG = (1 << 63) - 1


def whole(data: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` in units of ``1 / scale``, a power of two: exact, and finite wherever x is."""
    large = np.abs(data) >= 2.0**52 / scale
    return np.where(large, data, np.floor(np.where(large, 0, data) * scale) / scale)


class Index:
    """Impact-ordered postings of one block of integer vectors of equal length."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, levels: int = LEVELS, unit: int = 1):
        order = np.argsort(ids, kind="stable")
        self.ids, self.unit = ids[order], unit
        self.real = values[order].astype(np.float64)  # integers once multiplied by the unit
        self.most = np.abs(self.real).max(0) if len(ids) else np.zeros(values.shape[1])
        self.values = None
        if values.dtype == np.int64:
            self.raw = values[order]
        else:
            self.raw = None
            if self.most.max(initial=0) < EXACT / unit:
                self.values = np.rint(self.real * unit).astype(np.int64)
        if self.raw is not None and self.most.max(initial=0) < EXACT:
            self.values = self.raw
        if self.values is not None:
            self._post(levels)

    def _post(self, levels: int) -> None:
        n, d = self.values.shape
        low, high = self.values.min(0), self.values.max(0)
        self.step = np.maximum(1, -(-(high - low + 1) // levels))
        level = (self.values - low) // self.step  # quantised impact
        self.low = low
        self.postings = np.argsort(level, axis=0, kind="stable").T.copy()  # by dimension, lowest level first
        self.levels = np.take_along_axis(level.T, self.postings, 1).astype(np.int16)
        self.cuts = np.stack([np.searchsorted(self.levels[j], np.arange(levels + 1)) for j in range(d)]) if d else np.zeros((0, levels + 1), int)
        self.n_levels = levels

    def best(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, list[int]]:
        """(rows, scores) of the ``k`` best, highest score first, then smallest id, without rows of the id ``own``."""
        n, d = self.real.shape
        keep = np.ones(n, bool)
        if own is not None:
            at = np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, "right")
            keep[at[0] : at[1]] = False
        real = query.astype(np.float64)
        # Levels reach at most one step beyond a value, a step at most the spread of the values.
        with np.errstate(over="ignore", invalid="ignore"):
            reach = float((3 * self.most + 1) @ np.abs(real)) * self.unit**2 if d else 0.0
        if self.values is None or not reach < EXACT:
            return self._best_wide(query, real, k, np.flatnonzero(keep))
        query = query if query.dtype == np.int64 else np.rint(real * self.unit).astype(np.int64)
        open_rows = self._possible(query, k, keep) if n > max(64, k) and d else np.flatnonzero(keep)
        scores = self.values[open_rows] @ query
        top = np.lexsort((self.ids[open_rows], -scores))[:k]
        return open_rows[top], scores[top].tolist()

    def _best_wide(self, query: np.ndarray, real: np.ndarray, k: int, rows: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The same for numbers of any size: bounds in double precision, then integers of any length."""
        if len(rows) > k:
            # Scaled by powers of two to at most one: nothing overflows, and underflow costs less than the last term.
            down = lambda x: np.ldexp(x, -np.frexp(np.abs(x).max(initial=0))[1])
            x, q = down(self.real[rows]), down(real)
            about, off = x @ q, (len(q) + 4) * 2.0**-51 * (np.abs(x) @ np.abs(q)) + len(q) * 2.0**-1000
            rows = rows[about + off >= np.partition(about - off, -k)[-k]]
        asked = _integers(query, self.unit)
        source = self.raw if self.raw is not None else self.real
        scored = sorted((-sum(map(int.__mul__, asked, _integers(source[r], self.unit))), int(self.ids[r]), int(r)) for r in rows)[:k]
        return np.array([r for *_, r in scored], np.int64), [-s for s, *_ in scored]

    def _possible(self, query: np.ndarray, k: int, keep: np.ndarray) -> np.ndarray:
        """Rows that can be among the best ``k``; all that can be are in."""
        grid = np.arange(self.n_levels)
        # Least and most a level gives, over the least of its dimension.
        first, last = query[:, None] * (grid * self.step[:, None]), query[:, None] * ((grid + 1) * self.step[:, None] - 1)
        floor = np.minimum(first, last)
        ceil = np.maximum(first, last)
        base = floor.min(1)
        floor, ceil = floor - base[:, None], ceil - base[:, None]
        loose = int((ceil - floor).max(1).sum())  # what quantisation hides
        gains = floor.astype(np.float64)  # sums stay exact below 2**53
        acc = np.zeros(len(keep), np.int64)
        top = ceil.max()
        limits = [top * (TIERS - t) // TIERS for t in range(TIERS + 1)]
        up = query >= 0
        for t in range(TIERS):
            rows, added = [], []
            for j in np.flatnonzero(ceil.max(1) > limits[t + 1]).tolist():
                # Levels of this tier are neighbours, as gains rise or fall along them.
                inside = np.flatnonzero((ceil[j] > limits[t + 1]) & ((ceil[j] <= limits[t]) | (t == 0)))
                if len(inside):
                    a, b = self.cuts[j, inside[0]], self.cuts[j, inside[-1] + 1]
                    rows.append(self.postings[j, a:b])
                    added.append(gains[j].take(self.levels[j, a:b]))
            if rows:
                acc += np.bincount(np.concatenate(rows), np.concatenate(added), len(keep)).astype(np.int64)
            rest = int(np.minimum(np.where(up, ceil[:, -1], ceil[:, 0]), limits[t + 1]).sum()) if t < TIERS - 1 else 0
            sure = np.where(keep, acc, -1)
            if keep.sum() <= k:
                break
            threshold = np.partition(sure, -k)[-k]
            left = np.flatnonzero(keep & (acc + rest + loose >= threshold))
            if len(left) <= max(k, FEW * len(keep)):
                return left
        else:
            # Level 0 gains that no tier reached add at most the quantisation.
            return left
        return np.flatnonzero(keep)


def _integers(values: np.ndarray, unit: int) -> list[int]:
    """Exact integers of whole numbers in units of ``1 / unit``."""
    if values.dtype == np.int64:
        return values.tolist()
    return [int(v * unit) if abs(v) < 2.0**52 else int(v) * unit for v in values.tolist()]


def sortable(score: int) -> str:
    """A text that sorts as the integer does."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):05d}{digits}"
    return f"0{99_999 - len(digits):05d}" + "".join(str(9 - int(c)) for c in digits)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id_, v_, asks_) of rows with an id and a vector of finite components only."""
    v = F.col(vector_col)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull()).filter(~odd)
    kept = v if "array<float>" in vectors.schema[vector_col].dataType.simpleString() else F.transform(v, lambda x: x.cast("double"))
    return rows.select(F.col(id_col).cast("bigint").alias("id_"), kept.alias("v_"), F.col("asks_"))


def _task(kinds: tuple[str, str], k: int, scale: int):
    """Best of some blocks of vectors for each query of a block."""

    def run(one: dict, many: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        keys, queries = tiles.arrays(one, kinds[0], 1)
        queries, asked = whole(queries.astype(np.float64), scale), keys[:, 0].tolist()
        best: dict[int, list[tuple[int, int]]] = {}
        for block in many:
            ids, data = tiles.arrays(block, kinds[1], 1)
            index = Index(ids[:, 0], whole(data.astype(np.float64), scale), unit=scale)
            for q, vector in zip(asked, queries, strict=True):
                found, scores = index.best(vector, k, q)
                both = best.get(q, []) + list(zip((-s for s in scores), index.ids[found].tolist(), strict=True))
                best[q] = sorted(both)[:k]
        flat = [(q, i, max(-LONG - 1, min(LONG, -s)), sortable(-s)) for q, found in best.items() for s, i in found]
        kinds_out = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array([f[c] for f in flat], kind) for c, kind in enumerate(kinds_out)]
        yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score", "order"])

    return run


def top_k(
    vectors: DataFrame, queries: Column, *, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best inner products of every row that ``queries`` selects.

    Components become ``floor(scale * x)`` (``scale`` a power of two) and scores are their exact integer products, whatever their size; a score
    beyond the range of a long is ranked by its true value and shown as the end of that range. Candidates are all rows of the
    query's length whose id is not its own; equal scores go to the smaller id; fewer candidates give fewer rows. Rows
    with a null id, a null vector or a null or non-finite component take no part. A repeated query id is asked once, with the
    first of its vectors in order; repeated candidates count each. Other columns are ignored.
    """
    rows = materialise(usable(vectors.withColumn("asks_", F.coalesce(queries, F.lit(False))), id_col, vector_col), "vectors")
    asked = materialise(rows.filter("asks_").groupBy("id_").agg(F.min("v_").alias("v_")), "queries")
    a = tiles.pack(asked, ["id_"], "v_", block_rows=query_rows, name="query-blocks")
    b = tiles.pack(rows, ["id_"], "v_", block_rows=block_rows, name="vector-blocks")
    found = tiles.meet(a, b, _task((a.kind, b.kind), k, scale), "query_id long, vec_id long, score long, order string", group_blocks=GROUP_BLOCKS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("order"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
