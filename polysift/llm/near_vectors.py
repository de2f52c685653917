"""Embedding near-duplicates by quantised tile products with proven error bounds.

Equal vectors become one class with a count. Classes are cut into blocks; every vector is scaled to length one and quantised to
int8 with a scale of its own, and the length of what quantisation left out is kept. For two vectors u = u' + e and v = v' + f the
product u'v' of the quantised ones is off by at most |u'||f| + |e||v'| + |e||f|. A pair of blocks is one tile: its int8
product (exact, as sums of integers below 2^24 in single precision) and the bounds decide most pairs either way; only those
whose bounds straddle the threshold are computed again from the full vectors.

A tile reports, per vector, how many it is linked with, and a star per group of linked vectors, never the pairs, so a dense
cluster costs rows and not squares of them. Components join the stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polysift.llm.components import components
from polysift.operators import tiles
from polysift.scratch import materialise

THRESHOLD = 0.9
#: Rows of a tile that are compared at a time, and pairs recomputed at a time.
SLAB = 512
PAIRS = 1 << 16
#: Dimensions whose products of int8 values stay exact in single precision: 127 * 127 * 1024 < 2 ** 24.
EXACT = 1024
#: Covers rounding in the bounds themselves and, while scanning, in single precision.
SLACK, SCAN_SLACK = 1e-9, 1e-5


def scaled(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in double precision times a power of two that brings their largest component near one, and their lengths."""
    x = data.astype(np.float64)
    _, power = np.frexp(np.abs(x).max(1))
    x = np.ldexp(x, -power[:, None])
    return x, np.sqrt(np.einsum("ij,ij->i", x, x))


def quantised(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 matrix, scales, lengths of the quantised unit vectors, lengths of what is left out)."""
    x, size = scaled(data)
    unit = x / size[:, None]
    scale = np.abs(unit).max(1) / 127
    q = np.rint(unit / scale[:, None])
    kept = q * scale[:, None]
    rest = unit - kept
    return q.astype(np.int8), scale, np.sqrt((kept * kept).sum(1)), np.sqrt((rest * rest).sum(1))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows."""
    parts = [slice(s, s + EXACT) for s in range(0, a.shape[1], EXACT)]
    if len(parts) == 1:
        return a.astype(np.float32) @ b.astype(np.float32).T
    return sum((a[:, p].astype(np.float32) @ b[:, p].astype(np.float32).T).astype(np.float64) for p in parts)


class Side:
    """One block, ready for tiles."""

    def __init__(self, row: dict, kind: str):
        self.block = row["block"]
        keys, self.data = tiles.arrays(row, kind, 2)
        self.nodes, self.weights = keys[:, 0], keys[:, 1].astype(np.float64)
        n = len(self.nodes)
        self.q = np.frombuffer(row["q"], np.int8).reshape(n, -1)
        self.scale, self.length, self.error = np.frombuffer(row["bounds"], np.float64).reshape(3, n)
        self._exact = None

    def exact(self) -> tuple[np.ndarray, np.ndarray]:
        if self._exact is None:
            self._exact = scaled(self.data)
        return self._exact


def _recomputed(a: Side, b: Side, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Whether pairs reach the threshold, from their full vectors."""
    (x, m), (y, n) = a.exact(), b.exact()
    out = np.empty(len(i), bool)
    for s in range(0, len(i), PAIRS):
        p, q = i[s : s + PAIRS], j[s : s + PAIRS]
        out[s : s + PAIRS] = np.einsum("ij,ij->i", x[p], y[q]) / (m[p] * n[q]) >= threshold
    return out


def links(a: Side, b: Side, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(rows of a, rows of b, pairs recomputed) of linked pairs, slab by slab; a block with itself gives both directions."""
    q_b = b.q.astype(np.float32) if b.q.shape[1] <= EXACT else b.q
    for start in range(0, len(a.nodes), SLAB):
        rows = slice(start, start + SLAB)
        product = a.q[rows].astype(np.float32) @ q_b.T if a.q.shape[1] <= EXACT else _product(a.q[rows], b.q)
        # Scan with the slab's largest bounds, in place; what passes is judged with its own.
        widest = a.length[rows].max() * b.error + a.error[rows].max() * (b.length + b.error)
        least = ((threshold - widest - SCAN_SLACK) / b.scale).astype(product.dtype)
        seen = product * a.scale[rows, None].astype(product.dtype)
        i, j = np.divmod(np.flatnonzero(seen >= least), len(b.nodes))
        about = product[i, j].astype(np.float64)
        i = i + start
        if a.block == b.block:
            other = i != j
            i, j, about = i[other], j[other], about[other]
        about *= a.scale[i] * b.scale[j]
        off = a.length[i] * b.error[j] + a.error[i] * (b.length[j] + b.error[j]) + SLACK
        sure, open_ = about - off >= threshold, about + off >= threshold
        unsure = np.flatnonzero(open_ & ~sure)
        sure[unsure] = _recomputed(a, b, i[unsure], j[unsure], threshold)
        yield i[sure], j[sure], len(unsure)


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of ``n`` places under links a - b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        if (label[a] == label[b]).all():
            return label


def _tile_rows(kind: str, threshold: float):
    names = ["node", "links", "root"]

    def run(one: dict, many: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        a = Side(one, kind)
        nodes, counts = [a.nodes], [np.zeros(len(a.nodes))]
        stars: list[tuple[np.ndarray, np.ndarray]] = []
        at = len(a.nodes)
        for row in many:
            b = a if row["block"] == a.block else Side(row, kind)
            offset = 0 if b is a else at
            theirs = np.zeros(len(b.nodes))
            for i, j, _ in links(a, b, threshold):
                if not len(i):
                    continue
                counts[0] += np.bincount(i, b.weights[j], len(a.nodes))
                theirs += np.bincount(j, a.weights[i], len(b.nodes))
                # One link per place that the slab reaches: a star of each of its components.
                reached, local = np.unique(np.concatenate([i, j + offset]), return_inverse=True)
                root = joined(len(reached), local[: len(i)], local[len(i) :])
                stars.append((reached, reached[root]))
            if b is not a:
                nodes.append(b.nodes)
                counts.append(theirs)
                at += len(b.nodes)
        if stars:
            every, total = np.concatenate(nodes), np.concatenate(counts).astype(np.int64)
            root = joined(len(every), *(np.concatenate(x) for x in zip(*stars, strict=True)))
            linked = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (every[linked], total[linked], every[root[linked]])], names=names)

    return run


def _quantise(blocks: tiles.Blocks) -> tiles.Blocks:
    kind = blocks.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                _, data = tiles.arrays(row.to_pylist()[0], kind, 2)
                q, *bounds = quantised(data)
                added = [pa.array([q.tobytes()], pa.binary()), pa.array([np.stack(bounds).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays([*row.columns, *added], names=[*row.schema.names, "q", "bounds"])

    table = blocks.table.mapInArrow(run, f"{tiles.BLOCK}, q binary, bounds binary")
    return blocks.extended(materialise(table, "quantised"))


def near_vectors(
    vectors: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = tiles.BLOCK_ROWS,
    group_blocks: int = tiles.GROUP_BLOCKS,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors of equal width link at a cosine of at least ``threshold`` (above zero) in double precision. ``component_id`` is the smallest id
    reachable by links, the own included; ``kept`` says whether it is the own. Null, empty or zero vectors and those with a
    null or non-finite component link with nothing. Rows of one id are vectors each; a null id is linked like any other, but is
    never a component's id (null where there is no other). An empty table gives no rows; other columns are ignored.
    """
    v = F.col("vec_")
    usable = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    # -0.0 becomes 0.0, so that equal vectors have one text.
    clean = F.transform(F.col(vector_col), lambda x: F.when(x == 0, F.abs(x)).otherwise(x))
    rows = vectors.select(F.col(id_col).alias("id_"), clean.alias("vec_")).withColumn("vec_", F.when(usable, v))
    classes = rows.filter("vec_ is not null").groupBy("vec_").agg(F.count(F.lit(1)).alias("n_"), F.min("id_").alias("least_"))
    classes = materialise(classes.withColumn("node_", F.monotonically_increasing_id()), "classes")
    blocks = _quantise(tiles.pack(classes, ["node_", "n_"], "vec_", block_rows=block_rows, name="vectors"))
    run = _tile_rows(blocks.kind, threshold)
    found = materialise(tiles.meet(blocks, blocks, run, "node long, links long, root long", upper=True, group_blocks=group_blocks), "stars")
    counts = found.groupBy("node").agg(F.sum("links").alias("links_"))
    placed = components(found, "node", "root").select("node", F.col("component").alias("component_"))
    members = classes.select("node_", "least_").join(placed, F.col("node_") == F.col("node"))
    least = members.groupBy("component_").agg(F.min("least_").alias("reach_"))
    reach = placed.join(least, "component_").select(F.col("node").alias("in_"), "reach_")
    text = F.md5(F.col("vec_").cast("string"))
    known = classes.select(text.alias("of_"), "node_", "n_", "least_").join(counts, F.col("node_") == F.col("node"), "left").join(reach, F.col("node_") == F.col("in_"), "left")
    told = known.select("of_", (F.coalesce("links_", F.lit(0)) + F.col("n_") - 1).alias("linked_"), F.coalesce("reach_", "least_").alias("reach_"))
    out = rows.filter("vec_ is not null").select("id_", text.alias("text_")).join(told, F.col("text_") == F.col("of_"))
    out = out.select("id_", "linked_", "reach_").unionByName(
        rows.filter("vec_ is null").select("id_", F.lit(0).cast("bigint").alias("linked_"), F.col("id_").alias("reach_"))
    )
    return out.select(
        F.col("id_").alias(id_col), F.col("linked_").alias("n_links"), F.col("reach_").alias("component_id"), F.col("id_").eqNullSafe(F.col("reach_")).alias("kept")
    )
