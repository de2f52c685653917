"""Vector operators on embedding tables: best matches, codebooks, k-means, alignment loss.

Matching runs as matrix products on Arrow batches. Candidates of at most ``BLOCK_VALUES`` numbers, such as a codebook, are sent to
the rows, which stay where they are. Larger ones are cut into blocks, as the rows are, and blocks meet inside tasks (``tiles``): nothing
of either table passes through the driver, and the rows are written once. Rows and candidates with a null key or
vector take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import l2_normalize
from ..scratch import discard, materialise
from . import tiles
from .position import hash_pick

#: Numbers of the candidates that are sent to every task, and of a score matrix; they size steps and change no result.
BLOCK_VALUES = 4_000_000
SCORE_VALUES = 2_000_000


def _row_steps(rows: int, candidates: int) -> Iterator[slice]:
    """Slices of rows whose score matrix stays near ``SCORE_VALUES`` numbers."""
    step = max(min(SCORE_VALUES // max(candidates, 1), 4_096), 1)
    return (slice(begin, begin + step) for begin in range(0, rows, step))


def _best(scores, keys, k: int):
    """Column positions of the k largest scores per row, ties to the smallest key; keys ascend."""
    import numpy as np

    k = min(k, scores.shape[1])
    if k == 1:
        return np.argmax(scores, axis=1)[:, None]
    if k == scores.shape[1]:
        return np.lexsort((np.broadcast_to(keys, scores.shape), -scores), axis=1)
    top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    values = np.take_along_axis(scores, top, axis=1)
    out = np.take_along_axis(top, np.lexsort((keys[top], -values), axis=1), axis=1)
    # Where more than k columns reach the k-th score, the partition chose among equals: choose by key.
    cut = values.min(axis=1, keepdims=True)
    for i in np.flatnonzero((scores >= cut).sum(axis=1) > k):
        at = np.flatnonzero(scores[i] >= cut[i])
        out[i] = at[np.lexsort((keys[at], -scores[i, at]))[:k]]
    return out


def _scores(rows, candidates, metric: str, scale: float):
    """Larger is better: scaled cosine, dot product, or negative squared distance."""
    import numpy as np

    if metric == "cosine":
        rows = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
        candidates = candidates / np.maximum(np.linalg.norm(candidates, axis=1, keepdims=True), 1e-12)
        return rows @ candidates.T * scale
    if metric == "dot":
        return rows @ candidates.T
    gaps = (rows**2).sum(1)[:, None] + (candidates**2).sum(1)[None, :] - 2 * rows @ candidates.T
    return -np.maximum(gaps, 0.0)


def best_matches(
    a: DataFrame,
    b: DataFrame,
    k: int,
    *,
    metric: str = "cosine",
    scale: float = 1.0,
    a_key: str = "a_id",
    a_vec: str = "a_vec",
    b_key: str = "b_id",
    b_vec: str = "b_vec",
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """Exact best ``k`` rows of ``b`` for each row of ``a``: a_key, rank (from 1), b_key, score.

    Keys are integers and those of ``b`` unique. Rows of ``a`` do not move; no pair beyond the best ``k`` is ever written.
    """
    rows = a.select(F.col(a_key).cast("bigint").alias("key"), F.col(a_vec).alias("vec")).filter("key is not null and vec is not null")
    hits = _matched(rows, b.select(F.col(b_key).alias("key"), F.col(b_vec).alias("vec")), k, metric, scale, block_values)
    if k == 1:
        hits = hits.select("key", F.lit(1).alias("rank"), "hit.match", "hit.score")
    else:
        flat = hits.select("key", F.posexplode(F.arrays_zip("hit.match", "hit.score")).alias("place", "hit"))
        hits = flat.select("key", (F.col("place") + 1).alias("rank"), F.col("hit")["match"].alias("match"), F.col("hit")["score"].alias("score"))
    return hits.select(F.col("key").alias(a_key), "rank", F.col("match").alias(b_key), "score")


def _matched(rows: DataFrame, candidates: DataFrame, k: int, metric: str, scale: float, block_values: int) -> DataFrame:
    """``rows`` (with a ``vec`` that is never null) and ``hit``, their best candidates; rows without any are left out."""
    side = candidates.select(F.col("key").cast("bigint").alias("key"), F.transform("vec", lambda x: x.cast("double")).alias("vec"))
    side = materialise(side.filter("key is not null and vec is not null"), "candidates")
    size = side.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("vec")).alias("width")).first()
    width, single = size["width"] or 1, k == 1
    if not size["rows"]:
        kind = "struct<match:bigint,score:double>" if single else "struct<match:array<bigint>,score:array<double>>"
        return rows.limit(0).withColumn("hit", F.lit(None).cast(kind))
    if size["rows"] * width > block_values:
        return _matched_in_tiles(rows, side, k, metric, scale, max(1, min(tiles.BLOCK_ROWS, block_values // width)))
    match = _match_udf(rows.sparkSession.sparkContext.broadcast(_matrix(side)), k, metric, scale)
    # Naming the vector twice keeps Spark from folding a long vector expression into the Python call.
    out = rows.withColumn("hit", F.when(F.col("vec").isNotNull(), match("vec")))
    return out.filter(F.col("hit.match").isNotNull() if single else F.size("hit.match") > 0)


def _matrix(side: DataFrame):
    """Keys, ascending, and matrix of candidates whose size has been checked."""
    import numpy as np

    got = side.toPandas().sort_values("key", ignore_index=True)
    return got["key"].to_numpy().astype("int64"), np.stack(got["vec"].to_numpy()).astype("float64")


def _match_udf(carried, k: int, metric: str, scale: float):
    """Best matches among the carried candidates."""
    scores_of, best_of, steps_of, single = _scores, _best, _row_steps, k == 1

    @F.pandas_udf("struct<match:bigint,score:double>" if single else "struct<match:array<bigint>,score:array<double>>")
    def match(vectors: pd.Series) -> pd.DataFrame:
        import numpy as np

        if not len(vectors):
            return pd.DataFrame({"match": [], "score": []})
        rows = np.stack(vectors.to_numpy()).astype("float64")
        keys, candidates = carried.value
        found, values = [], []
        for step in steps_of(len(rows), len(keys)):
            scores = scores_of(rows[step], candidates, metric, scale)
            best = best_of(scores, keys, k)
            found.append(keys[best])
            values.append(np.take_along_axis(scores, best, axis=1))
        found, values = np.concatenate(found), np.concatenate(values)
        if single:
            return pd.DataFrame({"match": found[:, 0], "score": values[:, 0]})
        return pd.DataFrame({"match": list(found), "score": list(values)})

    return match


_HITS = "row long, lows array<double>, keys array<long>"


def _tile_matches(kind: str, own_kind: str, k: int, metric: str, scale: float):
    """For a block and some blocks of candidates: per row its best ``k`` as ascending (-score, key)."""
    scores_of, best_of, steps_of, unpacked = _scores, _best, _row_steps, tiles.arrays

    def run(one: dict, many: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        ids, rows = unpacked(one, own_kind, 1)
        rows, best = rows.astype("float64"), None
        for block in many:
            keys, candidates = unpacked(block, kind, 1)
            order = np.argsort(keys[:, 0], kind="stable")
            keys, candidates = keys[order, 0], candidates[order].astype("float64")
            parts = []
            for step in steps_of(len(rows), len(keys)):
                scores = scores_of(rows[step], candidates, metric, scale)
                at = best_of(scores, keys, k)
                parts.append((-np.take_along_axis(scores, at, axis=1), keys[at]))
            now = [np.concatenate(x) for x in zip(*parts, strict=True)]
            if best is not None:
                now = [np.concatenate(x, axis=1) for x in zip(best, now, strict=True)]
                order = np.lexsort((now[1], now[0]), axis=1)[:, :k]
                now = [np.take_along_axis(x, order, axis=1) for x in now]
            best = now
        lows, keys = best
        width = lows.shape[1]
        ends = pa.array(np.arange(0, lows.size + 1, width, dtype="int32"))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1))) for x in (lows, keys)]
        yield pa.RecordBatch.from_arrays([pa.array(ids[:, 0]), *lists], names=["row", "lows", "keys"])

    return run


def _merged(hits: DataFrame, k: int) -> DataFrame:
    """(row, lows, keys): the best ``k`` of what several groups of blocks found."""
    pairs = F.arrays_zip("lows", "keys")
    best = F.slice(F.array_sort(F.flatten(F.collect_list(pairs))), 1, k)
    return hits.groupBy("row").agg(best.alias("best")).select("row", F.col("best.lows").alias("lows"), F.col("best.keys").alias("keys"))


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows, written once, with ``_row``, a number of their own."""
    return materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")


def _with_hits(stored: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    score = F.transform("lows", lambda x: -x + F.lit(0.0))
    if k == 1:
        hit = F.struct(F.get("keys", F.lit(0)).alias("match"), F.get(score, F.lit(0)).alias("score"))
    else:
        hit = F.struct(F.col("keys").alias("match"), score.alias("score"))
    return stored.join(hits.select(F.col("row").alias("_of"), hit.alias("hit")), F.col("_row") == F.col("_of")).drop("_row", "_of")


def _matched_in_tiles(rows: DataFrame, side: DataFrame, k: int, metric: str, scale: float, block_rows: int) -> DataFrame:
    """The same as a product of blocks inside tasks; rows meet candidates of their own width."""
    stored = _numbered(rows)
    a = tiles.pack(stored, ["_row"], "vec", block_rows=block_rows, name="row-blocks")
    b = tiles.pack(side, ["key"], "vec", block_rows=block_rows, name="candidate-blocks")
    hits = tiles.meet_grouped(a.table, b.table, ["width"], _tile_matches(b.kind, a.kind, k, metric, scale), _HITS)
    if b.count > 1:
        hits = _merged(hits, k)
    return _with_hits(stored, hits, k)


#: Coarse cells of a pruned search; their centres and the gaps between them are what the driver and every task hold.
CELLS = 256


def pruned_matches(
    a: DataFrame, b: DataFrame, k: int, *, metric: str = "cosine", scale: float = 1.0, cells: int = CELLS, seed: int = 0,
    a_key: str = "a_id", a_vec: str = "a_vec", b_key: str = "b_id", b_vec: str = "b_vec", block_rows: int = tiles.BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """:func:`best_matches` and a report (pairs, skipped), leaving out blocks that the triangle inequality proves too far.

    Both tables are dealt to the nearest of ``cells`` centres, a seeded choice of candidates. Every block of rows first meets the candidates
    of its own cell; the worst distance among its rows' best ``k`` then bounds what it still needs, and a cell is skipped where the
    gap of the centres less both radii exceeds it. For cosine, vectors are scaled to length one, where the order of distances
    is that of the cosines; two further places set zero vectors at right angles to all others. ``dot`` has no such bound.
    """
    if metric not in ("cosine", "distance"):
        raise ValueError(f"no triangle inequality for {metric}")

    def told(df: DataFrame, key: str, vec: str, place: int) -> DataFrame:
        v = F.transform(vec, lambda x: x.cast("double"))
        if metric == "cosine":
            zero = F.when(F.exists(v, lambda x: x != 0), 0.0).otherwise(1.0)
            v = F.concat(l2_normalize(v), F.array(*[zero if i == place else F.lit(0.0) for i in (0, 1)]))
        return df.select(F.col(key).cast("bigint").alias("key"), v.alias("vec")).filter("key is not null and vec is not null")

    side = materialise(told(b, b_key, b_vec, 1), "candidates")
    drawn = side.withColumn("_hash", F.xxhash64(F.lit(seed), "key")).orderBy("_hash", "key").limit(cells).drop("_hash").toPandas()
    if not len(drawn):
        none = told(a, a_key, a_vec, 0).limit(0).select(F.col("key").alias(a_key), F.lit(1).alias("rank"), F.col("key").alias(b_key), F.lit(0.0).alias("score"))
        return none, a.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("pairs"), F.lit(0).cast("bigint").alias("skipped"))
    _, centres = _matrix_of(drawn)
    stored = _numbered(_celled(told(a, a_key, a_vec, 0), centres))
    side = materialise(_celled(side, centres), "candidate-cells")
    rows, rows_cells = _cell_blocks(stored, ["_row"], len(centres), block_rows, "row-blocks")
    candidates, candidate_cells = _cell_blocks(side, ["key"], len(centres), block_rows, "candidate-blocks")
    spark, run = a.sparkSession, _tile_matches(candidates.kind, rows.kind, k, "distance", 1.0)
    gaps = spark.createDataFrame(_gaps(centres, rows_cells, candidate_cells), "of int, to int, gap double")
    from_cells, to_cells = (spark.createDataFrame([(c, *v[:3]) for c, v in x.items()], "cell int, first int, blocks int, rows long") for x in (rows_cells, candidate_cells))

    def opened(pairs: DataFrame) -> DataFrame:
        """(a_block, b_block) of (a_block, to)."""
        blocks = F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1)
        return pairs.join(F.broadcast(to_cells), F.col("to") == F.col("cell")).select("a_block", F.explode(blocks).alias("b_block"))

    blocks = from_cells.select(F.col("cell").alias("of"), F.explode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1)).alias("a_block"))
    own = materialise(tiles.meet(rows, candidates, run, _HITS, pairs=opened(blocks.withColumn("to", F.col("of")))), "own-cell")
    near = _merged(own, k)
    # A row with fewer than k candidates so far bounds nothing. Distances are squared in the scores.
    reach = F.when(F.size("lows") == k, F.sqrt(F.greatest(F.element_at("lows", -1), F.lit(0.0)))).otherwise(float("inf"))
    placed = stored.select("_row", _block_number(rows_cells).alias("a_block"))
    bounds = placed.join(near.select("row", reach.alias("reach")), F.col("_row") == F.col("row"), "left")
    bounds = bounds.groupBy("a_block").agg(F.max(F.coalesce("reach", F.lit(float("inf")))).alias("reach"))
    wanted = blocks.join(bounds, "a_block").join(F.broadcast(gaps), "of").filter((F.col("of") != F.col("to")) & (F.col("gap") <= F.col("reach")))
    wanted = materialise(wanted.select("a_block", "of", "to"), "wanted-cells")
    far = tiles.meet(rows, candidates, run, _HITS, pairs=opened(wanted))
    best = _merged(own.unionByName(far), k)
    hits = stored.select("key", "_row").join(best, F.col("_row") == F.col("row"))
    flat = hits.select("key", F.posexplode(F.arrays_zip("lows", "keys")).alias("place", "hit"))
    gap = F.greatest(F.col("hit.lows"), F.lit(0.0))
    score = (F.lit(1.0) - gap / 2) * F.lit(scale) if metric == "cosine" else -gap
    out = flat.select(F.col("key").alias(a_key), (F.col("place") + 1).alias("rank"), F.col("hit.keys").alias(b_key), score.alias("score"))
    whole = sum(r[2] for r in rows_cells.values()) * sum(c[2] for c in candidate_cells.values())
    first = sum(r[2] * candidate_cells[c][2] for c, r in rows_cells.items() if c in candidate_cells)
    met = wanted.join(rows.table.select("block", "n"), F.col("a_block") == F.col("block")).join(F.broadcast(to_cells), F.col("to") == F.col("cell"))
    skipped = F.lit(whole - first) - F.coalesce(F.sum(F.col("n") * F.col("rows")), F.lit(0))
    return out, met.agg(F.lit(whole).cast("bigint").alias("pairs"), skipped.cast("bigint").alias("skipped"))


def _matrix_of(got: pd.DataFrame):
    import numpy as np

    return got["key"].to_numpy().astype("int64"), np.stack(got["vec"].to_numpy()).astype("float64")


def _celled(rows: DataFrame, centres) -> DataFrame:
    """Adds ``cell``, the nearest centre, and ``off``, the distance to it."""
    shared, steps_of = rows.sparkSession.sparkContext.broadcast(centres), _row_steps

    @F.pandas_udf("struct<cell:int,off:double>")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        import numpy as np

        if not len(vectors):
            return pd.DataFrame({"cell": [], "off": []})
        x, c = np.stack(vectors.to_numpy()), shared.value
        cell = np.concatenate([((c * c).sum(1)[None, :] - 2 * x[s] @ c.T).argmin(1) for s in steps_of(len(x), len(c))])
        return pd.DataFrame({"cell": cell.astype("int32"), "off": np.sqrt(((x - c[cell]) ** 2).sum(1))})

    return rows.withColumn("_near", nearest("vec")).select("*", "_near.cell", "_near.off").drop("_near")


def _block_number(cells: dict[int, tuple]) -> Column:
    """Block of a row in its cell: the cell's first number and a hash of the row's place."""
    first = F.create_map(*[F.lit(x) for c, v in cells.items() for x in (c, v[0])]) if cells else None
    count = F.create_map(*[F.lit(x) for c, v in cells.items() for x in (c, v[1])]) if cells else None
    if first is None:
        return F.lit(0)
    place = F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    return (F.element_at(first, F.col("cell")) + F.pmod(place, F.element_at(count, F.col("cell")))).cast("int")


def _cell_blocks(rows: DataFrame, keys: list[str], n: int, block_rows: int, name: str) -> tuple[tiles.Blocks, dict[int, tuple]]:
    """Blocks that lie in one cell each, and by cell (first block, blocks, rows, radius); at most one entry per centre."""
    cells, at = {}, 0
    found = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("off").alias("radius"), F.max(F.size("vec")).alias("width"))
    for r in found.orderBy("cell").collect():
        blocks = -(-r["n"] // tiles.fitting(block_rows, r["width"]))
        cells[r["cell"]] = (at, blocks, r["n"], r["radius"])
        at += blocks
    return tiles.pack(rows, keys, "vec", block=_block_number(cells), count=max(at, 1), name=name), cells


def _gaps(centres, of: dict[int, tuple], to: dict[int, tuple]) -> list[tuple[int, int, float]]:
    """Least distance between rows of two cells, rounded down."""
    import numpy as np

    return [(i, j, float(np.sqrt(((centres[i] - centres[j]) ** 2).sum()) - a[3] - b[3] - 1e-9)) for i, a in of.items() for j, b in to.items()]


def topk_similar(a: DataFrame, b: DataFrame, k: int, *, scale: float = 1.0, **names) -> DataFrame:
    """Best ``k`` by cosine logits ``exp(scale) * cos``."""
    import math

    return best_matches(a, b, k, metric="cosine", scale=math.exp(scale), **names)


def nearest_code(
    df: DataFrame, codebook: DataFrame, *, key: str, vec: str, code: str = "code", code_vec: str = "vec",
    cosine: bool = False, block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """Key, closest code (ties to the lowest) and squared distance; with ``cosine`` the largest dot product."""
    hits = best_matches(
        df, codebook, 1, metric="dot" if cosine else "distance", a_key=key, a_vec=vec, b_key=code, b_vec=code_vec,
        block_values=block_values,
    )
    value = F.col("score") if cosine else -F.col("score")
    return hits.select(key, code, value.alias("similarity" if cosine else "distance"))


def group_vector_sum(df: DataFrame, key: str, vec: str) -> DataFrame:
    """Key, rows, and element-wise sum and mean per key; partial sums are formed before the shuffle."""
    v = array_to_vector(F.transform(vec, lambda x: x.cast("double")))
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        vector_to_array(Summarizer.sum(v)).alias("vec_sum"),
        vector_to_array(Summarizer.mean(v)).alias("vec_mean"),
    )


def cluster_sums(df: DataFrame, codebook: DataFrame, *, vec: str, cosine: bool, block_values: int = BLOCK_VALUES) -> DataFrame:
    """Code, rows and vector sum of the rows assigned to it; codes without rows are absent.

    Each task sums its own rows per code, so the shuffle carries at most one row per code and task.
    """
    rows = df.select(F.col(vec).alias("vec")).filter("vec is not null")
    codes = codebook.select(F.col("code").alias("key"), "vec")
    assigned = _matched(rows, codes, 1, "dot" if cosine else "distance", 1.0, block_values)
    sums = group_vector_sum(assigned.select(F.col("hit.match").alias("code"), "vec"), "code", "vec")
    return sums.select("code", "n", "vec_sum")


def kmeans_step(df: DataFrame, codebook: DataFrame, *, vec: str, cosine: bool = False, block_values: int = BLOCK_VALUES) -> DataFrame:
    """One round: code, vec, size. An empty cluster keeps its centre; cosine centres are normalised."""
    sums = cluster_sums(df, codebook, vec=vec, cosine=cosine, block_values=block_values)
    mean = F.transform("vec_sum", lambda x: x / F.col("n"))
    moved = l2_normalize(mean) if cosine else mean
    fresh = sums.select(F.col("code").alias("_code"), moved.alias("_vec"), "n")
    kept = F.transform("vec", lambda x: x.cast("double"))
    return codebook.join(fresh, F.col("code") == F.col("_code"), "left").select(
        "code", F.coalesce("_vec", kept).alias("vec"), F.coalesce("n", F.lit(0)).cast("bigint").alias("size")
    )


def kmeans(
    df: DataFrame, start: DataFrame, *, vec: str, iters: int = 10, cosine: bool = False, block_values: int = BLOCK_VALUES
) -> DataFrame:
    """``iters`` rounds from the ``start`` centres (code, vec).

    The vectors are written once and read by every round; so is each round's codebook, and the plan does not grow.
    """
    rows = materialise(df.select(F.transform(vec, lambda x: x.cast("double")).alias("vec")).filter("vec is not null"), "vectors")
    codebook = start.select("code", "vec")
    out = start.select(F.col("code").cast("bigint").alias("code"), F.transform("vec", lambda x: x.cast("double")).alias("vec"), F.lit(0).cast("bigint").alias("size"))
    for _ in range(iters):
        out = materialise(kmeans_step(rows, codebook, vec="vec", cosine=cosine, block_values=block_values), "codebook")
        codebook = out.select("code", "vec")
    return out


def kmeans_bounded(
    df: DataFrame, start: DataFrame, *, vec: str, iters: int = 10, block_values: int = BLOCK_VALUES
) -> tuple[DataFrame, list[dict[str, int]]]:
    """The codebook of :func:`kmeans` (Euclidean) and, per round, the rows, those that moved and the distances computed.

    Every row carries its centre, an upper bound of the distance to it and a lower bound of the distance to all others. Centres
    that move widen the bounds by as much; a row whose upper bound stays below its lower one, or below half the gap from its centre to the
    next, computes nothing. Only rows that moved change the sums, and the rounds end once none does. The rows are rewritten each round, so
    this pays where codes times width outweigh that. The codebook must have at most ``block_values`` numbers; it is checked.
    """
    import numpy as np

    spark = df.sparkSession
    book = start.select(F.col("code").cast("bigint").alias("key"), F.transform("vec", lambda x: x.cast("double")).alias("vec")).filter("vec is not null")
    size = book.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not size[0] or size[0] * size[1] > block_values:
        raise ValueError(f"a codebook of {size[0]} rows is empty or beyond {block_values} numbers; use kmeans")
    codes, centres = _matrix(book)
    sums, counts = np.zeros_like(centres), np.zeros(len(codes), np.int64)
    rows = df.select(F.transform(vec, lambda x: x.cast("double")).alias("vec")).filter("vec is not null")
    state = rows.select("vec", F.lit(-1).alias("at"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"))
    shift, report, written = np.zeros(len(codes)), [], None
    for _ in range(iters):
        told = state.withColumn("new", _bounded_udf(spark.sparkContext.broadcast((centres, shift)))("vec", "at", "upper", "lower"))
        done = materialise(told.select("vec", F.col("at").alias("before"), "new.*"), "bounded")
        if written is not None:
            discard(written)
        written = done
        total = done.agg(F.count(F.lit(1)), F.count_if(F.col("at") != F.col("before")), F.coalesce(F.sum("computed"), F.lit(0))).first()
        report.append({"rows": total[0], "moved": total[1], "distances": total[2]})
        if not total[1]:
            break
        moved = done.filter("at != before")
        for column, sign in (("at", 1), ("before", -1)):
            for r in group_vector_sum(moved.filter(F.col(column) >= 0), column, "vec").collect():  # at most a row per code
                sums[r[column]] += sign * np.array(r["vec_sum"])
                counts[r[column]] += sign * r["n"]
        fresh = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        shift, centres = np.sqrt(((fresh - centres) ** 2).sum(1)), fresh
        state = done.select("vec", "at", "upper", "lower")
    out = [(int(c), v.tolist(), int(n)) for c, v, n in zip(codes, centres, counts, strict=True)]
    return spark.createDataFrame(out, "code bigint, vec array<double>, size bigint"), report


def _bounded_udf(carried):
    """New centre, bounds and distances computed of rows (vector, centre, upper, lower); a centre of -1 has no bounds yet."""
    steps_of = _row_steps

    @F.pandas_udf("struct<at:int,upper:double,lower:double,computed:int>")
    def bounded(vectors: pd.Series, at: pd.Series, upper: pd.Series, lower: pd.Series) -> pd.DataFrame:
        import numpy as np

        if not len(vectors):
            return pd.DataFrame({"at": [], "upper": [], "lower": [], "computed": []})
        centres, shift = carried.value
        x, own = np.stack(vectors.to_numpy()), at.to_numpy().astype("int64").copy()
        half = np.full(len(centres), np.inf)
        squares = (centres**2).sum(1)
        for step in steps_of(len(centres), len(centres)):
            gaps = squares[step, None] + squares[None] - 2 * centres[step] @ centres.T
            gaps[np.arange(len(gaps)), np.arange(len(centres))[step]] = np.inf
            half[step] = np.sqrt(np.maximum(gaps.min(1), 0.0)) / 2
        known, places = own >= 0, np.maximum(own, 0)
        high = np.where(known, upper.to_numpy() + shift[places], np.inf)
        low = np.where(known, lower.to_numpy() - shift.max(), 0.0)
        # Strictly below, with room for rounding: equal distances go to the lowest code.
        safe = np.maximum(low, half[places]) * (1 - 1e-9) - 1e-12
        computed = np.zeros(len(x), "int32")
        tight = np.flatnonzero(known & (high >= safe))
        high[tight] = np.sqrt(((x[tight] - centres[own[tight]]) ** 2).sum(1))
        computed[tight] = 1
        left = np.flatnonzero(~known | (high >= safe))
        for step in steps_of(len(left), len(centres)):
            rows = left[step]
            d = np.maximum((x[rows] ** 2).sum(1)[:, None] + squares[None] - 2 * x[rows] @ centres.T, 0.0)
            own[rows] = d.argmin(1)
            high[rows] = np.sqrt(d[np.arange(len(rows)), own[rows]])
            d[np.arange(len(rows)), own[rows]] = np.inf
            low[rows] = np.sqrt(d.min(1))
            computed[rows] += len(centres)
        return pd.DataFrame({"at": own.astype("int32"), "upper": high, "lower": low, "computed": computed})

    return bounded


def quantization_error(nearest: DataFrame, dim: int, *, beta: float = 1.0) -> DataFrame:
    """beta * mean squared difference per vector element, from :func:`nearest_code` distances."""
    return nearest.agg((F.lit(beta) * F.avg("distance") / F.lit(dim)).alias("error"))


def code_lookup(codes: DataFrame, codebook: DataFrame, *, column: str = "code") -> DataFrame:
    side = codebook.select(F.col("code").alias("_code"), "vec")
    return codes.join(side, F.col(column) == F.col("_code"), "left").drop("_code")


def code_usage(codes: DataFrame, k: int, *, column: str = "code") -> DataFrame:
    """Count of every code 0..k-1, unused ones with 0."""
    counts = codes.groupBy(F.col(column).cast("bigint").alias("_code")).agg(F.count(F.lit(1)).alias("n"))
    every = codes.sparkSession.range(k).select(F.col("id").alias("code"))
    return every.join(counts, F.col("code") == F.col("_code"), "left").select(
        "code", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.col("n").isNull().alias("dead")
    )


def ema_codebook(prev: DataFrame, batch: DataFrame, *, vec: str, decay: float = 0.99, block_values: int = BLOCK_VALUES) -> DataFrame:
    """Move sizes and codes (code, vec, size) toward a batch; codes without rows move toward themselves.

    Vectors of the batch are expected normalised; the result is normalised again.
    """
    sums = cluster_sums(batch, prev, vec=vec, cosine=False, block_values=block_values).select(
        F.col("code").alias("_code"), "n", "vec_sum"
    )
    joined = prev.join(sums, F.col("code") == F.col("_code"), "left")
    joined = joined.withColumn("_old", F.transform("vec", lambda x: x.cast("double")))
    joined = joined.withColumn(
        "_target", F.coalesce(l2_normalize(F.transform("vec_sum", lambda x: x / F.col("n"))), F.col("_old"))
    )
    mixed = F.zip_with("_old", "_target", lambda o, t: o * F.lit(decay) + t * F.lit(1 - decay))
    size = F.col("size").cast("double") * F.lit(decay) + F.coalesce("n", F.lit(0)) * F.lit(1 - decay)
    return joined.withColumn("_mixed", mixed).select("code", l2_normalize("_mixed").alias("vec"), size.alias("size"))


def smoothed_sizes(codebook: DataFrame, *, eps: float = 1e-5) -> DataFrame:
    """Laplace-smoothed cluster sizes that keep their total. The codebook is written once, as its totals read it again."""
    codebook = materialise(codebook, "sizes")
    totals = codebook.agg(F.sum("size").cast("double").alias("t"), F.count(F.lit(1)).cast("double").alias("k"))
    total, count = totals.select("t").scalar(), totals.select("k").scalar()
    return codebook.withColumn("smoothed", (F.col("size") + F.lit(eps)) / (total + count * F.lit(eps)) * total)


def remap_codes(codes: DataFrame, used: DataFrame, *, column: str = "code", policy: str | int = "random", seed: int = 0) -> DataFrame:
    """Add ``index``: place of the code in ``used`` (code, index). Unknown codes follow ``policy``.

    ``random`` picks an index by md5 of the seed and the row's columns, ``extra`` uses one index behind the last, and
    an integer is used as it is.
    """
    side = used.select(F.col("code").alias("_code"), F.col("index").cast("bigint").alias("_index"))
    size = used.agg(F.count(F.lit(1))).scalar()
    if policy == "random":
        unknown: Column = hash_pick(seed, size, *codes.columns)
    elif policy == "extra":
        unknown = size
    else:
        unknown = F.lit(int(policy)).cast("bigint")
    return (
        codes.join(side, F.col(column) == F.col("_code"), "left")
        .withColumn("index", F.coalesce("_index", unknown))
        .drop("_code", "_index")
    )


def unmap_codes(indices: DataFrame, used: DataFrame, *, column: str = "index") -> DataFrame:
    """Add ``code`` by place in ``used``; places behind the last one read the first."""
    side = used.select(F.col("index").cast("bigint").alias("_index"), "code")
    size = used.agg(F.count(F.lit(1))).scalar()
    place = F.when(F.col(column) >= size, F.lit(0)).otherwise(F.col(column)).cast("bigint")
    return indices.withColumn("_place", place).join(side, F.col("_place") == F.col("_index"), "left").drop("_place", "_index")


def alignment_loss(
    pairs: DataFrame, *, batch: str = "batch_id", a: str = "a_vec", b: str = "b_vec", scale: float = 1.0, block_rows: int = 2_048
) -> DataFrame:
    """Per batch: rows and symmetric cross-entropy of the cosine logits, the row's own partner being the target.

    Batches may have any size: one of up to ``block_rows`` pairs is one group; of a larger one, blocks of both sides meet inside tasks,
    and what a row's and a column's logits add up to is merged from their blocks. Pairs with a null vector or batch are left out.
    """
    import math

    factor = math.exp(scale)
    unit = lambda c: l2_normalize(F.transform(c, lambda x: x.cast("double")))
    rows = pairs.select(F.col(batch).cast("bigint").alias("batch_id"), unit(a).alias("a"), unit(b).alias("b"))
    stored = materialise(rows.filter("batch_id is not null and a is not null and b is not null").withColumn("row", F.monotonically_increasing_id()), "pairs")
    fit = F.greatest(F.least(F.lit(block_rows), F.floor(tiles.BLOCK_NUMBERS / F.greatest(F.max(F.size("a")), F.lit(1)))), F.lit(1))
    sizes = materialise(stored.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / fit).alias("parts")), "batch-sizes")
    small = _small_losses(stored.join(sizes.filter("parts = 1").select("batch_id"), "batch_id"), factor)
    if (sizes.agg(F.max("parts")).first()[0] or 1) == 1:
        return small
    place = F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    placed = stored.select("*", place.alias("place")).join(sizes.filter("parts > 1"), "batch_id")
    return small.unionByName(_large_losses(placed, factor))


def _small_losses(rows: DataFrame, factor: float) -> DataFrame:
    """(batch_id, n, loss) of batches whose logits fit a task."""

    def loss(part: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        logits = np.stack(part["a"].to_numpy()) @ np.stack(part["b"].to_numpy()).T * factor
        own = np.diag(logits)

        def entropy(m, axis):
            top = m.max(axis=axis, keepdims=True)
            return (np.log(np.exp(m - top).sum(axis=axis)) + top.squeeze(axis) - own).mean()

        value = (entropy(logits, 1) + entropy(logits, 0)) / 2
        return pd.DataFrame({"batch_id": [part["batch_id"].iloc[0]], "n": [len(part)], "loss": [float(value)]})

    return rows.select("batch_id", "a", "b").groupBy("batch_id").applyInPandas(loss, "batch_id bigint, n bigint, loss double")


def _large_losses(rows: DataFrame, factor: float) -> DataFrame:
    """(batch_id, n, loss) of rows (batch_id, row, a, b, n, parts, place) by running maxima and sums over blocks."""
    steps_of, unpacked = _row_steps, tiles.arrays

    def run(one: dict, many: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def batch(side: int, ids, top, total) -> pa.RecordBatch:
            n = len(ids)
            columns = [pa.array([one["batch_id"]] * n, pa.int64()), pa.array(ids), pa.array([side] * n, pa.int32()), pa.array(top), pa.array(total)]
            return pa.RecordBatch.from_arrays(columns, names=["batch_id", "row", "side", "top", "total"])

        def grown(top, total, more, axis: int):
            """Maximum and sum of exponentials below it, with another block's logits."""
            high = np.maximum(top, more.max(axis))
            return high, total * np.exp(top - high) + np.exp(more - np.expand_dims(high, axis)).sum(axis)

        ids, left = unpacked(one, "<f8", 1)
        top, total = np.full(len(ids), -np.inf), np.zeros(len(ids))
        for block in many:
            others, right = unpacked(block, "<f8", 1)
            high, sums = np.full(len(others), -np.inf), np.zeros(len(others))
            for s in steps_of(len(ids), len(others)):
                logits = left[s] @ right.T * factor
                top[s], total[s] = grown(top[s], total[s], logits, 1)
                high, sums = grown(high, sums, logits, 0)
            yield batch(1, others[:, 0], high, sums)
        yield batch(0, ids[:, 0], top, total)

    def blocks(side: str) -> DataFrame:
        told = rows.select("batch_id", F.pmod("place", "parts").cast("int").alias("block"), F.size(side).alias("width"), F.array("row").alias("keys"), F.col(side).alias("vec"))
        return materialise(tiles.packed(told, "<f8", ["batch_id", "width", "block"]), f"{side}-blocks")

    met = tiles.meet_grouped(blocks("a"), blocks("b"), ["batch_id", "width"], run, "batch_id long, row long, side int, top double, total double")
    parts = met.groupBy("batch_id", "row", "side").agg(F.max("top").alias("high"), F.collect_list(F.struct("top", "total")).alias("parts"))
    spread = F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + p["total"] * F.exp(p["top"] - F.col("high")))
    entropies = parts.groupBy("batch_id").agg(F.sum(F.col("high") + F.log(spread)).alias("spread"))
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    owns = rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum(dot * factor).alias("own"))
    return owns.join(entropies, "batch_id").select("batch_id", "n", ((F.col("spread") - 2 * F.col("own")) / (2 * F.col("n"))).alias("loss"))
