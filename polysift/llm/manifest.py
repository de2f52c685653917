"""Merkle manifest of a table: one leaf per row, a tree per group, a tree over the groups, and a proof for every row.

A row's place within its group comes from one range shuffle of digests: partitions are sorted, and what earlier partitions
hold is added to the place inside one. A group with a third of all rows covers many partitions, and so do rows of one
id, as equal rows are told apart by where they were read.

A pass then spreads the ``fanout ** LEVELS`` descendants of a node into slot columns by conditional aggregates. Concatenating the
columns of a run hashes it, level by level inside the row; leaving out the own column yields the siblings. The next pass
has that many times fewer rows. Proofs come down the same rows: each pass joins its rows with the proof of their node and
opens the slots, so leaves never move with their proofs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polysift.scratch import materialise

FANOUT = 2
#: Levels of the tree that one pass hashes inside a row; it sizes rows and changes no result.
LEVELS = 4
_ROW_BITS = 33
_GROUP = ["none_", "group_"]


def part(value: Column) -> Column:
    """A field of a leaf: ``-`` for null, else its UTF-8 byte count, a colon and the value (integers in decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Hex digest of the concatenated fields."""
    return F.sha2(F.concat(*map(part, values)), 256)


def _placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows with ``pos``, their place by ``order`` inside their group, and ``total``, the rows of the group."""
    spark = rows.sparkSession
    stored = materialise(rows, name).withColumn("tie_", F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index")))
    along = [F.col(c).asc_nulls_first() for c in [*_GROUP, *order, "tie_"]]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored.repartitionByRange(parts, *along).sortWithinPartitions(*along).withColumn("at_", F.monotonically_increasing_id())
    dealt = materialise(dealt.drop("tie_"), f"{name}-sorted")
    dealt = dealt.withColumns({"part_": F.shiftright("at_", _ROW_BITS), "row_": F.col("at_").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))})
    spans = materialise(dealt.groupBy(*_GROUP, "part_").agg(F.count(F.lit(1)).alias("n"), F.min("row_").alias("first")), f"{name}-spans")
    # A group has one span per partition it reaches.
    whole = Window.partitionBy(*_GROUP)
    starts = spans.select(
        *_GROUP, "part_", "first", F.sum("n").over(whole).alias("total"),
        F.coalesce(F.sum("n").over(whole.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
    )
    joined = dealt.join(starts, [*_GROUP, "part_"])
    return joined.withColumn("pos", F.col("row_") - F.col("first") + F.col("offset")).drop("at_", "part_", "row_", "first", "offset")


def _spread(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(group, total, node, slots): nodes (group, total, pos, payload) spread into the slots of the node that the pass makes of them."""
    width = fanout**levels
    slots = [F.max(F.when(F.col("pos") % width == i, F.col("payload"))).alias(f"slot{i}") for i in range(width)]
    rows = nodes.groupBy(*_GROUP, "total", F.call_function("div", F.col("pos"), F.lit(width)).alias("node")).agg(*slots)
    return rows.select(*_GROUP, "total", "node", F.array(*[f"slot{i}" for i in range(width)]).alias("slots"))


def _left(total: Column, over: int) -> Column:
    """Nodes that are left of ``total`` after runs of ``over`` have become one."""
    return F.call_function("div", total + F.lit(over - 1), F.lit(over))


def _hashed(rows: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Adds ``level0`` to ``level<levels>``: digests inside a row, run by run. A single node of a group is not hashed again."""
    out = rows.withColumn("level0", F.transform("slots", lambda s: s["digest"]))
    for j in range(levels):
        size = fanout ** (levels - j - 1)
        runs = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), _run_digest(F.col(f"level{j}"), fanout))
        several = _left(F.col("total"), fanout**j) > 1
        out = out.withColumn(f"level{j + 1}", F.when(several, runs).otherwise(F.slice(f"level{j}", 1, size)))
    return out


def _run_digest(level: Column, fanout: int) -> Callable[[Column], Column]:
    """Digest of the i-th run of a level; null behind its end."""
    return lambda i: F.when(F.get(level, i * fanout).isNotNull(), F.sha2(F.array_join(F.slice(level, i * fanout + 1, fanout), ""), 256))


def _steps(i: Column, fanout: int, levels: int) -> Column:
    """What stands left and right of a slot's node in its run, level by level, as far as there are several nodes."""

    def step(j: int) -> Column:
        own = F.call_function("div", i, F.lit(fanout**j)).cast("int")
        place, level = own % fanout, F.col(f"level{j}")
        sides = F.struct(
            F.array_join(F.slice(level, own - place + 1, place), "").alias("left"),
            F.array_join(F.slice(level, own + 2, F.lit(fanout - 1) - place), "").alias("right"),
        )
        return F.when(_left(F.col("total"), fanout**j) > 1, sides)

    return F.filter(F.array(*[step(j) for j in range(levels)]), lambda s: s.isNotNull())


def _climb(nodes: DataFrame, fanout: int, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Passes from the bottom, and each group's last node as (group, digest)."""
    most = nodes.agg(F.max("total")).first()[0] or 1
    passes = []
    while True:
        passes.append(materialise(_spread(nodes, fanout, levels), name))
        top = _hashed(passes[-1], fanout, levels)
        width = fanout**levels
        payload = F.struct(F.get(f"level{levels}", F.lit(0)).alias("digest"))
        nodes = top.select(*_GROUP, _left(F.col("total"), width).alias("total"), F.col("node").alias("pos"), payload.alias("payload"))
        most = -(-most // width)
        if most <= 1:
            return passes, nodes.select(*_GROUP, "payload.digest")


def _descend(passes: list[DataFrame], above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Payloads of the lowest pass with ``steps`` from there up; ``above`` has (group, steps, ...) of the groups' last nodes."""
    others = [c for c in above.columns if c not in (*_GROUP, "steps")]
    proofs = above.withColumns({"pos": F.lit(0).cast("bigint")})
    for rows in reversed(passes):
        up = proofs.withColumnsRenamed({"pos": "node", "steps": "steps_above"})
        joined = _hashed(rows, fanout, levels).join(up.select(*_GROUP, "node", "steps_above", *others), [*_GROUP, "node"])
        opened = F.transform(
            "slots", lambda s, i: F.when(s.isNotNull(), F.struct(i.alias("i"), s.alias("payload"), _steps(i, fanout, levels).alias("steps")))
        )
        each = joined.select(*_GROUP, "node", *others, "steps_above", F.explode(F.filter(opened, lambda s: s.isNotNull())).alias("s"))
        proofs = each.select(
            *_GROUP, (F.col("node") * fanout**levels + F.col("s.i")).alias("pos"), "s.payload", F.concat("s.steps", "steps_above").alias("steps"), *others
        )
    return proofs


def fold(digest: Column, steps: Column) -> Column:
    """The root that a leaf's digest leads to along its proof."""
    return F.aggregate(steps, digest, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof_text(steps: Column) -> Column:
    """Siblings of all levels, left to right, from the leaf up."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(
    rows: DataFrame, fields: list[str], *, id_col: str = "doc_id", group_col: str = "lang", changed: dict[str, Column] | None = None,
    fanout: int = FANOUT, levels: int = LEVELS,
) -> DataFrame:
    """One row per row: id, leaf, subroot, root, ``steps`` (its proof) and ``seen``, the leaf of a replica.

    Leaves are the digests of ``fields``. Those of a group, in order of the id (null first, equal ids by their leaf), and
    then the groups' subroots, in order of the group (null first, bytewise), are hashed in runs of ``fanout`` until one is
    left; a single leaf is its own subroot, a single subroot the root. ``changed`` gives fields other values in the replica. Null
    fields are part of a leaf, empty texts differ from them; repeated rows are leaves each; an empty table gives no rows. Other
    columns are ignored.
    """
    ours = leaf(*[F.col(f) for f in fields])
    theirs = leaf(*[(changed or {}).get(f, F.col(f)) for f in fields]) if changed else ours
    group = F.col(group_col).cast("string")
    told = rows.select(
        group.isNotNull().alias("none_"), F.coalesce(group, F.lit("")).alias("group_"), F.col(id_col).alias("id_"), ours.alias("digest"), theirs.alias("seen")
    )
    placed = _placed(told, ["id_", "digest"], "leaves")
    nodes = placed.select(*_GROUP, "total", "pos", F.struct("digest", F.col("id_").alias("id"), "seen").alias("payload"))
    passes, subroots = _climb(nodes, fanout, levels, "pass")
    # The groups form a tree of their own, in one group.
    listed = subroots.select(
        F.lit(True).alias("none_"), F.lit("").alias("group_"), F.col("none_").alias("known"), F.col("group_").alias("name"), "digest"
    )
    ranked = _placed(listed, ["known", "name"], "subroots")
    tops = ranked.select(*_GROUP, "total", "pos", F.struct("digest", "known", "name").alias("payload"))
    higher, root = _climb(tops, fanout, levels, "subroots-pass")
    none = F.array().cast("array<struct<left:string,right:string>>")
    roots = _descend(higher, root.select(*_GROUP, F.col("digest").alias("root"), none.alias("steps")), fanout, levels)
    above = roots.select(
        F.col("payload.known").alias("none_"), F.col("payload.name").alias("group_"), "steps", F.col("payload.digest").alias("subroot"), "root"
    )
    proofs = _descend(passes, materialise(above, "roots"), fanout, levels)
    return proofs.select(F.col("payload.id").alias(id_col), F.col("payload.digest").alias("leaf"), "subroot", "root", "steps", F.col("payload.seen").alias("seen"))


def verified(proofs: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Rows of :func:`manifest` with the digest of their proof, the root that the replica's leaf leads to, and whether it is the root."""
    told = proofs.select(
        id_col, "leaf", "subroot", "root", F.sha2(proof_text(F.col("steps")), 256).alias("proof_sha256"), fold(F.col("seen"), F.col("steps")).alias("folded_root")
    )
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
