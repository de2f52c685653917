"""Dense positions over whole tables or inside groups, without ever sorting a whole group in one task.

Rows are cut into order-preserving buckets. A first pass counts rows per (group, bucket), a running sum
over those counts gives each bucket its offset, and rows are numbered inside their bucket only. A group
that holds a third of all rows is therefore spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegralType, NumericType, StringType, StructType

from ..scratch import discard, materialise

BUCKET_ROWS = 65_536
HASH_DIGITS = 4


def int_bucket(order: str | Column, width: int = BUCKET_ROWS) -> Column:
    """Bucket of a unique integer order key: at most ``width`` rows each, twice that around zero."""
    c = F.col(order) if isinstance(order, str) else order
    return F.call_function("div", c.cast("bigint"), F.lit(width))


def hash_bucket(order: str | Column, digits: int = HASH_DIGITS) -> Column:
    """Bucket of a hexadecimal hash: 16**digits evenly filled ones."""
    c = F.col(order) if isinstance(order, str) else order
    return F.substring(c, 1, digits)


def seeded_hash(seed: int, *keys: str | Column) -> Column:
    """Reproducible random order key: md5 of ``seed:key:..``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str) else k for k in keys]))


def hash_pick(seed: int, n: Column, *keys: str | Column) -> Column:
    """Reproducible random index below ``n``: the first 15 digits of :func:`seeded_hash`, modulo ``n``."""
    return F.conv(F.substring(seeded_hash(seed, *keys), 1, 15), 16, 10).cast("bigint") % n


def with_position(
    df: DataFrame,
    order: str | Sequence[str],
    *,
    bucket: Column | None = None,
    by: Sequence[str] = (),
    name: str = "position",
    following: dict[str, str] | None = None,
    total: str | None = None,
    first: int | Column | None = None,
    levels: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row by ``order`` inside its ``by`` group.

    ``bucket`` must not decrease along ``order``. Without one, borders come from the keys themselves (:func:`_by_ranges`), whatever their
    type and however they are spread or repeated; this moves all rows, whatever ``first`` says, and has no ``following``.

    ``following`` maps new columns to the columns of the
    next row they take their value from; it needs a single order key that is unique in the group.

    ``total`` names a column for the rows of the group. ``first`` keeps that many rows of each group: the
    bucket counts tell which buckets hold them, and only rows of these buckets are moved. For ``total``, ``first`` and
    ``following`` the buckets are counted when the plan is built.

    The running sum over bucket counts runs in one task per group. Hash buckets keep that at 16**digits
    rows; for integer buckets, each of ``levels`` (1 unless given) cuts it by another factor of 65 536.
    ``following`` is meant for dense keys: it looks up successors per group and bucket.
    """
    order = [order] if isinstance(order, str) else list(order)
    by, following = list(by), following or {}
    if following and (len(order) != 1 or bucket is None):
        raise ValueError("following needs a single order key and a bucket")
    if bucket is None:
        return _by_ranges(df, order, by, name, total, first)
    group, rows, restored = _null_free(df, by, bucket)
    keys = [*group, "_bucket"]
    if levels is None:
        levels = 1 if isinstance(rows.schema["_bucket"].dataType, IntegralType) else 0

    aggs = [F.count(F.lit(1)).alias("_n")]
    if following:
        aggs.append(F.min(order[0]).alias("_first"))
    spans = rows.groupBy(*keys).agg(*aggs)
    if following or total or first is not None:
        spans = materialise(spans, "spans")  # read several times below; a row per bucket
    offsets = _offsets(spans, group, levels)
    if first is not None:
        held = offsets.filter(F.col("_offset") < first)
        if group:
            cuts = held.groupBy(*group).agg(F.max("_bucket").alias("_cut"))
            rows = rows.join(_renamed(cuts, group), _same(group)).filter("_bucket <= _cut").drop("_cut", *_others(group))
        else:
            cut = held.agg(F.max("_bucket")).scalar()
            rows = rows.filter(F.col("_bucket") <= cut)
            if isinstance(rows.schema["_bucket"].dataType, StructType):
                # The same of the first field alone, which Spark can apply where the rows are read.
                head = rows.schema["_bucket"].dataType.names[0]
                rows = rows.filter(F.coalesce(F.col("_bucket")[head] <= cut[head], F.lit(True)))

    local = Window.partitionBy(*keys).orderBy(*order)
    out = rows.withColumn("_row", F.row_number().over(local))
    for new, old in following.items():
        out = out.withColumn(new, F.lead(old).over(local))
    if following:
        out = out.withColumn("_last", F.lead(order[0]).over(local).isNull())

    # Groups that fit one bucket need no offset, so this side stays small. The join keys are the window's
    # partitioning, so the rows are not shuffled again whichever join Spark picks.
    if total:
        counts = _renamed(spans.groupBy(*group).agg(F.sum("_n").alias("_total")), group)
        starts = offsets.join(counts, _same(group)).drop(*_others(group)) if group else offsets.withColumn("_total", counts.scalar())
    else:
        starts = offsets.filter("_offset > 0")
    out = out.join(_renamed(starts, keys), _same(keys), "left")
    out = out.withColumn(name, (F.col("_row") - 1 + F.coalesce("_offset", F.lit(0))).cast("bigint")).drop(*_others(keys))
    if total:
        out = out.withColumn(total, F.col("_total"))
    if following:
        # The last row of a bucket finds its successor at the start of the group's next bucket.
        along = Window.partitionBy(*group).orderBy("_bucket")
        edges = _renamed(spans.select(*keys, F.lead("_first").over(along).alias("_next")).filter("_next is not null"), keys)
        firsts = rows.select(*group, *dict.fromkeys([order[0], *following.values()]))
        at_start = [F.col(k) == F.col(o) for k, o in zip(group, _others(keys))] + [F.col("_next") == F.col(order[0])]
        heads = edges.join(firsts, _all(at_start)).select(
            *_others(keys), *[F.col(old).alias(f"_{new}") for new, old in following.items()]
        )
        out = out.join(heads, _same(keys) & F.col("_last"), "left")
        for new in following:
            out = out.withColumn(new, F.when(F.col("_last"), F.col(f"_{new}")).otherwise(F.col(new)))
    if first is not None:
        out = out.filter(F.col(name) < first)
    added = [*following, name, *([total] if total else [])]
    return out.select(*[c for k, c in restored.items() if k not in added], *added)


#: Bits of a generated row number that count within a partition.
_ROW_BITS = 33


def _by_ranges(df: DataFrame, order: list[str], by: list[str], name: str, total: str | None, first: int | Column | None) -> DataFrame:
    """Positions from Spark's range partitioning, whose borders are quantiles of a sample of (by, order).

    Rows with equal keys are told apart by where they were read, so a key that holds a third of all rows covers a third of the partitions.
    Each partition is sorted and written; what earlier ones hold of a group is added to the place inside.
    """
    group, rows, restored = _null_free(df, by, F.lit(0))
    stored = materialise(rows.drop("_bucket").withColumn("_tie", F.monotonically_increasing_id()), "unordered")
    along = [*group, *order, "_tie"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored.repartitionByRange(parts, *along).sortWithinPartitions(*along).drop("_tie")
    dealt = materialise(dealt.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    discard(stored)
    dealt = dealt.withColumns({"_bucket": F.shiftright("_at", _ROW_BITS), "_row": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))})
    keys = [*group, "_bucket"]
    spans = materialise(dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")), "spans")
    whole = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = spans.select(*keys, (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("_total"))
    out = dealt.join(_renamed(starts, keys), _same(keys)).withColumn(name, (F.col("_row") + F.col("_shift")).cast("bigint"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    if first is not None:
        out = out.filter(F.col(name) < first)
    added = [name, *([total] if total else [])]
    return out.select(*[c for k, c in restored.items() if k not in added], *added)


def _null_free(df: DataFrame, by: list[str], bucket: Column) -> tuple[list[str], DataFrame, dict[str, Column]]:
    """Group columns without nulls, the rows that carry them, and expressions for the original columns.

    Plain equality on such columns is exact, so joins can use the partitioning the windows need; a null
    key stays a group of its own through the ``_nulls`` bit mask.
    """
    blank = {StringType: "", BooleanType: False}
    derived, restored, mask = {}, {}, F.lit(0)
    for i, c in enumerate(by):
        kind = df.schema[c].dataType
        if isinstance(kind, NumericType) or type(kind) in blank:
            derived[f"_g{i}"] = F.coalesce(F.col(c), F.lit(blank.get(type(kind), 0)).cast(kind))
            mask = mask + F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
            restored[c] = F.when(F.col("_nulls").bitwiseAND(F.lit(1 << i)) == 0, F.col(f"_g{i}"))
        else:
            derived[f"_g{i}"] = F.struct(F.col(c).alias("v"))
            restored[c] = F.col(f"_g{i}.v")
    if by:
        derived["_nulls"] = mask
    kept = [c for c in df.columns if c not in by]
    rows = df.select(*kept, *[v.alias(k) for k, v in derived.items()], bucket.alias("_bucket"))
    return list(derived), rows, {c: restored[c].alias(c) if c in restored else F.col(c) for c in df.columns}


def _offsets(spans: DataFrame, group: list[str], levels: int) -> DataFrame:
    """Rows of the group in front of each bucket, from its ``_n``; columns group, _bucket, _offset."""
    before = Window.unboundedPreceding, -1
    if levels == 0:
        along = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(*before)
        return spans.select(*group, "_bucket", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_offset"))
    cut = spans.select(*group, "_bucket", "_n", F.shiftright("_bucket", 16).alias("_upper"))
    along = Window.partitionBy(*group, "_upper").orderBy("_bucket").rowsBetween(*before)
    inner = cut.withColumn("_inner", F.coalesce(F.sum("_n").over(along), F.lit(0)))
    sums = cut.groupBy(*group, "_upper").agg(F.sum("_n").alias("_n")).withColumnRenamed("_upper", "_bucket")
    keys = [*group, "_bucket"]
    outer = _renamed(_offsets(sums, group, levels - 1), keys).withColumnRenamed("_offset", "_outer")
    joined = inner.join(outer, _same([*group, "_upper"]))
    return joined.select(*keys, (F.col("_inner") + F.col("_outer")).alias("_offset"))


def _others(keys: list[str]) -> list[str]:
    return [f"_other{i}" for i in range(len(keys))]


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(keys, _others(keys))))


def _same(keys: list[str]) -> Column:
    return _all([F.col(k) == F.col(o) for k, o in zip(keys, _others(keys))])


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
