"""Vectors in blocks, and blocks of two tables brought together inside tasks.

A block is one row: its keys and its matrix as bytes. ``meet`` deals pairs of blocks to tasks through a shuffle, a block of the
left side with at most ``GROUP_BLOCKS`` of the right side at a time, so a task holds a fixed number of vectors whatever the
tables' sizes, and neither table passes through the driver. Only the numbers of blocks are known there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, FloatType, StructType

from ..scratch import materialise

#: Rows of a block, and blocks of the right side that meet one of the left side in a task; they size tasks and change no result.
BLOCK_ROWS = 4_096
GROUP_BLOCKS = 8
#: Numbers of a block: wide vectors come in blocks of fewer rows.
BLOCK_NUMBERS = 1 << 20

#: Numbers that a side brings to a task of :func:`meet_grouped`, and groups that it is cut into at least (of a block or more).
SIDE_NUMBERS = 1 << 22
SIDE_GROUPS = 8

BLOCK = "width int, block int, n int, keys binary, data binary"


@dataclass(frozen=True)
class Blocks:
    """A written table of blocks (``BLOCK``), numbered below ``count`` within each width of vectors."""

    table: DataFrame
    count: int
    kind: str  # of the matrix, as numpy writes it
    n_keys: int

    def extended(self, table: DataFrame) -> Blocks:
        return Blocks(table, self.count, self.kind, self.n_keys)


def pack(rows: DataFrame, keys: list[str], vec: str, *, block: Column | None = None, count: int | None = None, block_rows: int = BLOCK_ROWS, name: str = "blocks") -> Blocks:
    """Rows of a written table as blocks; ``keys`` are integer columns without nulls, ``vec`` an array of finite numbers.

    Blocks are filled by a hash of a row's place in the written files, about ``block_rows`` each and at most as many as make
    ``BLOCK_NUMBERS`` numbers, whatever the keys. ``block`` and ``count`` number the blocks otherwise.
    """
    single = isinstance(rows.schema[vec].dataType, ArrayType) and isinstance(rows.schema[vec].dataType.elementType, FloatType)
    kind = "<f4" if single else "<f8"
    if block is None:
        size = rows.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size(vec)).alias("width")).first()
        count = max(1, -(-size["rows"] // fitting(block_rows, size["width"])))
        block = F.pmod(F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index")), F.lit(count))
    numbers = F.col(vec) if single else F.transform(vec, lambda x: x.cast("double"))
    told = rows.select(
        block.cast("int").alias("block"), F.size(vec).alias("width"), F.array(*[F.col(k).cast("bigint") for k in keys]).alias("keys"), numbers.alias("vec")
    )
    return Blocks(materialise(packed(told, kind, ["width", "block"]), name), count, kind, len(keys))


def fitting(block_rows: int, width: int | None) -> int:
    """Rows of a block of vectors so wide."""
    return max(1, min(block_rows, BLOCK_NUMBERS // max(width or 1, 1)))


def packed(rows: DataFrame, kind: str, by: list[str]) -> DataFrame:
    """One row per ``by`` (integer columns): these, n, and the rows' keys and matrix as bytes; a group is a block's rows."""

    def one(table: pa.Table) -> pa.Table:
        lists = lambda name: table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        first = {c: pa.array([table.column(c)[0].as_py()], table.schema.field(c).type) for c in by}
        added = {"keys": lists("keys").astype("<i8"), "data": lists("vec").astype(kind)}
        return pa.table(first | {"n": pa.array([table.num_rows], pa.int32())} | {k: pa.array([v.tobytes()], pa.binary()) for k, v in added.items()})

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in by)
    return rows.groupBy(*by).applyInArrow(one, f"{kinds}, n int, keys binary, data binary")


def arrays(row: dict, kind: str, n_keys: int):
    """Keys, one row of them per vector, and the matrix of a block."""
    import numpy as np

    keys = np.frombuffer(row["keys"], "<i8").reshape(row["n"], n_keys)
    return keys, np.frombuffer(row["data"], kind).reshape(row["n"], row["width"])


def meet(
    a: Blocks, b: Blocks, run: Callable[[dict, Iterator[dict]], Iterator[pa.RecordBatch]], schema: str, *,
    upper: bool = False, pairs: DataFrame | None = None, group_blocks: int = GROUP_BLOCKS,
) -> DataFrame:
    """``run(block of a, blocks of b)`` for all pairs of blocks of equal width, in groups of at most ``group_blocks`` blocks of ``b``.

    ``upper`` leaves out blocks of ``b`` with a smaller number than that of ``a`` (for a table and itself). ``pairs`` (a_block,
    b_block) names the pairs that meet instead.
    """
    group = F.call_function("div", F.col("block"), F.lit(group_blocks)).cast("int")
    left_columns = [F.col(c) for c in a.table.columns]
    if pairs is not None:
        right = b.table.join(pairs, F.col("block") == F.col("b_block")).withColumnRenamed("a_block", "meets").withColumn("group", group).drop("b_block")
        called = pairs.select("a_block", F.call_function("div", F.col("b_block"), F.lit(group_blocks)).cast("int").alias("group")).distinct()
        left = a.table.join(called, F.col("block") == F.col("a_block")).select(*left_columns, "group")
    else:
        last = -(-b.count // group_blocks) - 1
        first = group if upper else F.lit(0)
        left = a.table.select(*left_columns, F.explode(F.sequence(first, F.lit(last))).alias("group"))
        until = F.col("block") if upper else F.lit(a.count - 1)
        right = b.table.select("*", F.explode(F.sequence(F.lit(0), until)).alias("meets"), group.alias("group"))

    return cogrouped(left, right, ["width", "block", "group"], ["width", "meets", "group"], run, schema)


def cogrouped(
    left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], run: Callable[[dict, Iterator[dict]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``run(row of left, rows of right)`` per key: one block on the left, some on the right in order of their number."""
    fields = list(to_arrow_schema(StructType.fromDDL(schema)))

    def step(one: pa.Table, many: pa.Table) -> pa.Table:
        none = pa.table({f.name: pa.array([], f.type) for f in fields})
        if not one.num_rows or not many.num_rows:
            return none
        row = lambda t, i: {c: t.column(c)[i].as_py() for c in t.column_names}
        numbers = many.column("block").to_pylist()
        batches = list(run(row(one, 0), (row(many, i) for i in sorted(range(len(numbers)), key=numbers.__getitem__))))
        return pa.Table.from_batches(batches) if batches else none

    return left.groupBy(*left_keys).cogroup(right.groupBy(*right_keys)).applyInArrow(step, schema)


def meet_grouped(left: DataFrame, right: DataFrame, by: list[str], run: Callable[[dict, Iterator[dict]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``run(left blocks as one, right blocks as a few)`` for all pairs of groups of blocks with equal ``by`` columns, ``width`` among them.

    Both sides come in groups of many blocks, so a block is copied once per group of the other side, however small the blocks are: both are cut
    into ``SIDE_GROUPS`` groups, or as many as hold ``SIDE_NUMBERS`` numbers each, which is what a task has of a side.
    """

    def groups(table: DataFrame, name: str) -> DataFrame:
        needed = F.ceil(F.sum(F.col("n").cast("bigint")) * F.col("width") / F.lit(SIDE_NUMBERS))
        return table.groupBy(*by).agg(F.least(F.count(F.lit(1)), F.greatest(needed, F.lit(SIDE_GROUPS))).cast("int").alias(name))

    sizes = materialise(groups(left, "lefts").join(groups(right, "rights"), by), "block-groups")

    def dealt(table: DataFrame, own: str, others: str, names: tuple[str, str]) -> DataFrame:
        told = table.join(sizes, by).withColumn(names[0], F.pmod("block", own))
        return told.withColumn(names[1], F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop("lefts", "rights")

    fields, numbers = list(to_arrow_schema(StructType.fromDDL(schema))), BLOCK_NUMBERS

    def glued(table: pa.Table, most: int | None) -> Iterator[dict]:
        """Blocks in order of their number as larger ones, of ``most`` numbers or a block more."""
        first, n, keys, data = {c: table.column(c)[0].as_py() for c in by}, 0, [], []
        order = sorted(range(table.num_rows), key=table.column("block").to_pylist().__getitem__)
        for at, i in enumerate(order, start=1):
            n += table.column("n")[i].as_py()
            keys.append(table.column("keys")[i].as_py())
            data.append(table.column("data")[i].as_py())
            if at == len(order) or most is not None and n * first["width"] >= most:
                yield first | {"n": n, "keys": b"".join(keys), "data": b"".join(data)}
                n, keys, data = 0, [], []

    def step(one: pa.Table, many: pa.Table) -> pa.Table:
        if not one.num_rows or not many.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in fields})
        [whole] = glued(one, None)
        return pa.Table.from_batches(list(run(whole, glued(many, numbers))))

    keys = [*by, "left_group", "right_group"]
    a, b = dealt(left, "lefts", "rights", ("left_group", "right_group")), dealt(right, "rights", "lefts", ("right_group", "left_group"))
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(step, schema)
