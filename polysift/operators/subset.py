"""Subset building, duplicates and fetch bookkeeping. ``position`` columns are dense and 0-based."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .position import HASH_DIGITS, hash_bucket, hash_pick, int_bucket, seeded_hash, with_position


def head_n(df: DataFrame, n: int, *, position: str = "position") -> DataFrame:
    """First ``n`` rows by position; 0 means none. A filter, so any ``n`` stays distributed."""
    return df.filter(F.col(position) < n)


def first_read(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows of a scan by file name and place in the file; counted per file split, then cut.

    Rows read by ranges carry their place (``_file``, ``_record``), which goes.
    """
    if "_record" in df.columns:
        bucket = F.struct("_file", int_bucket("_record"))
        return with_position(df, ["_file", "_record"], bucket=bucket, name="_place", first=n).drop("_file", "_record", "_place")
    placed = df.withColumns({"_file": F.input_file_name(), "_block": F.input_file_block_start(), "_read": F.monotonically_increasing_id()})
    order, bucket = ["_file", "_block", "_read"], F.struct("_file", "_block")
    return with_position(placed, order, bucket=bucket, name="_place", first=n).drop(*order, "_place")


def cap_per_task(
    df: DataFrame, n: int, *, position: str, bucket: Column, task: str = "task", carry_over: int = 0
) -> DataFrame:
    """First ``n`` rows of each task by ``position``, a unique order key with its integer ``bucket``.

    ``carry_over=1`` also admits the one extra row that a counter checked after the append lets through.
    """
    return with_position(df, position, by=[task], bucket=bucket, name="_place", first=n + carry_over).drop("_place")


def sample_n(df: DataFrame, n: int, *, key: str, seed: int, digits: int = HASH_DIGITS) -> DataFrame:
    """``n`` random rows without replacement, or with replacement when there are fewer than ``n`` rows.

    Adds ``draw`` (0..n-1). Row ``key`` must be unique. Rows are cut into 16**``digits`` hash buckets, and only those of the
    buckets with the first ``n`` are moved.
    """
    hashed = df.withColumn("_hash", seeded_hash(seed, key))
    first = with_position(hashed, ["_hash", key], bucket=hash_bucket("_hash", digits), name="_place", first=n).drop("_hash")
    rows = df.agg(F.count(F.lit(1))).scalar()
    # Slots beyond the rows draw a row by hash; when the table is large enough each slot is its own row.
    draws = df.sparkSession.range(n).select(
        F.col("id").alias("draw"),
        F.when(rows >= n, F.col("id")).otherwise(hash_pick(seed, rows, "id")).alias("_pick"),
    )
    return draws.join(first, F.col("_pick") == F.col("_place")).drop("_pick", "_place")


def distinct_keep_first(df: DataFrame, key: str, *, position: str = "position", payload: tuple[str, ...] = ()) -> DataFrame:
    """Non-empty distinct keys with the position of their first row, and optionally that row's columns.

    Aggregated on the map side, so a key that holds a third of the rows costs one row per task.
    """
    kept = df.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    carried = [F.min_by(c, position).alias(c) for c in payload]
    return kept.groupBy(key).agg(F.min(position).alias(position), *carried)


def first_seen_order(df: DataFrame, key: str, *, position: str = "position", name: str = "group_order") -> DataFrame:
    """Groups in order of first appearance: key, first position and dense ``group_order``."""
    firsts = df.groupBy(key).agg(F.min(position).alias("first_position"))
    return with_position(firsts, "first_position", bucket=int_bucket("first_position"), name=name, levels=1)


def concat_splits(first: DataFrame, second: DataFrame, *, names: tuple[str, str] = ("train", "val")) -> DataFrame:
    """Both splits with a ``split`` column; order is (split order, position)."""
    a = first.withColumns({"split": F.lit(names[0]), "split_order": F.lit(0)})
    b = second.withColumns({"split": F.lit(names[1]), "split_order": F.lit(1)})
    return a.unionByName(b, allowMissingColumns=True)


def tagged_union(parts: dict[str, DataFrame], *, name: str = "kind") -> DataFrame:
    """Union of several tables with a column that says where a row comes from."""
    out = None
    for tag, part in parts.items():
        tagged = part.withColumn(name, F.lit(tag))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def missing(manifest: DataFrame, done: DataFrame, *, key: str) -> DataFrame:
    """Distinct keys of the manifest that are not done."""
    return manifest.select(key).distinct().join(done.select(F.col(key).alias("_done")), F.col(key) == F.col("_done"), "left_anti")


def fetch_report(manifest: DataFrame, before: DataFrame, after: DataFrame, *, key: str) -> DataFrame:
    """One row: distinct ids, and of them skipped (there before), ok (there after only) and failed."""
    ids = manifest.select(key).distinct()
    old = before.select(F.col(key).alias("_old")).distinct()
    new = after.select(F.col(key).alias("_new")).distinct()
    seen = ids.join(old, F.col(key) == F.col("_old"), "left").join(new, F.col(key) == F.col("_new"), "left")
    skipped, got = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    return seen.agg(
        F.count(F.lit(1)).alias("total_unique"),
        F.count_if(~skipped & got).alias("ok"),
        F.count_if(~skipped & ~got).alias("fail"),
        F.count_if(skipped).alias("skip"),
    )


def merged_position(rank: str = "rank", index: str = "index", *, world: int) -> Column:
    """Place of a record in the whole run: strided shards interleave."""
    return (F.col(index).cast("bigint") * world + F.col(rank)).cast("bigint")


#: What a run adds to a record; the other columns come from the data set.
RUN_COLUMNS = ("rank", "index", "position", "output", "arrived")


def padded_rows(placed: DataFrame, *, world: int, key: tuple[str, ...] | None = None, identity: str = "image_path", output: str = "output") -> Column:
    """Number of rows that padding has put at the end of a run, as a value of one row.

    Equal shards repeat fewer than ``world`` rows from the head at the tail, in order. The largest such number whose rows
    agree with the head in all columns of the data set (or ``key``), nulls being equal, is what padding may have added; only the ends of the run
    are compared. It is taken as padding where the rows also name their media (``identity``) and agree in their output. Where
    not, they may as well be genuine rows that ask the same question, and the query fails: the run's true length has to be given.
    """
    key = key or tuple(c for c in placed.columns if c not in RUN_COLUMNS)
    known = [c for c in (identity, output) if c in placed.columns]
    end = placed.agg(F.max("position") + 1).scalar()
    carried = list(dict.fromkeys([*key, *known]))
    head = placed.filter(F.col("position") < world - 1).select(F.col("position").alias("_i"), *[F.col(k).alias(f"_{k}") for k in carried])
    tail = placed.filter(F.col("position") > end - world).select(F.col("position").alias("_j"), *carried)
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    sure = F.col(identity).isNotNull() if identity in known else F.lit(False)
    if output in known:
        sure = sure & F.col(output).eqNullSafe(F.col(f"_{output}"))
    pairs = tail.join(head, same).select((end - F.col("_j") + F.col("_i")).alias("n"), "_i", sure.alias("sure"))
    met = pairs.filter((F.col("n") < world) & (F.col("_i") < F.col("n"))).groupBy("n", "_i").agg(F.max("sure").alias("sure"))
    whole = met.groupBy("n").agg(F.count(F.lit(1)).alias("found"), F.min("sure").alias("sure")).filter("found = n")
    top = whole.agg(F.max(F.struct("n", "sure"))).scalar()
    unclear = F.raise_error("rows at the end of the run repeat its head but need not be padding: give n_total").cast("bigint")
    return F.when(top.isNull(), F.lit(0).cast("bigint")).when(top["sure"], top["n"]).otherwise(unclear)


def dedup_padded(preds: DataFrame, *, world: int, n_total: int | None = None, key: tuple[str, ...] | None = None) -> DataFrame:
    """Remove the rows that equal-sized shards repeat; adds ``position``.

    The repeats are the positions from the run's true length on. It is ``n_total``, or follows from the rows at the tail
    that repeat the head (:func:`padded_rows`), which fails where these could be genuine. Rows with equal questions elsewhere always stay.
    """
    placed = preds.withColumn("position", merged_position(world=world))
    if n_total is not None:
        return placed.filter(F.col("position") < n_total)
    end = placed.agg(F.max("position") + 1).scalar()
    return placed.filter(F.col("position") < end - padded_rows(placed, world=world, key=key))


def normalize_row(df: DataFrame) -> DataFrame:
    """The four columns of an audio-caption row, id as text and start as double."""
    return df.select(
        F.col("audiocap_id").cast("string").alias("audiocap_id"),
        "youtube_id",
        F.col("start_time").cast("double").alias("start_time"),
        "caption",
    )
