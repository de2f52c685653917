"""Positions must be exact when a group spans many buckets."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from polysift.operators.position import hash_bucket, int_bucket, seeded_hash, with_position


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    keys = rnd.sample(range(5_000), 900)
    # One group holds a third of the rows, another has a null key.
    return [(("hot" if i % 3 == 0 else None if i % 7 == 0 else f"g{i % 40}"), k, f"v{k}") for i, k in enumerate(keys)]


def expected(rows):
    out, groups = {}, {}
    for g, k, v in rows:
        groups.setdefault(g, []).append((k, v))
    for g, members in groups.items():
        members.sort()
        for i, (k, v) in enumerate(members):
            out[(g, k)] = (i, members[i + 1][1] if i + 1 < len(members) else None)
    return out


@pytest.mark.parametrize("width,levels", [(1, 0), (7, 0), (7, 1), (64, 2), (100_000, 1)])
def test_grouped_positions_and_followers(spark, rows, width, levels):
    df = spark.createDataFrame(rows, "g string, k bigint, v string").repartition(5)
    got = with_position(df, "k", by=["g"], bucket=int_bucket("k", width), name="p", following={"nv": "v"}, levels=levels)
    assert {(r.g, r.k): (r.p, r.nv) for r in got.collect()} == expected(rows)
    assert sorted(got.columns) == ["g", "k", "nv", "p", "v"]


def test_global_positions(spark, rows):
    df = spark.createDataFrame(rows, "g string, k bigint, v string").repartition(5)
    got = with_position(df, "k", bucket=int_bucket("k", 13), levels=1).collect()
    assert [r.k for r in sorted(got, key=lambda r: r.position)] == sorted(k for _, k, _ in rows)
    assert sorted(r.position for r in got) == list(range(len(rows)))


def test_hash_order_is_reproducible(spark, rows):
    df = spark.createDataFrame(rows, "g string, k bigint, v string")
    keyed = df.withColumn("h", seeded_hash(4, "k"))
    got = with_position(keyed, ["h", "k"], bucket=hash_bucket("h", 1)).collect()
    want = sorted((k for _, k, _ in rows), key=lambda k: hashlib.md5(f"4:{k}".encode()).hexdigest())
    assert [r.k for r in sorted(got, key=lambda r: r.position)] == want


def test_sparse_and_negative_keys(spark):
    keys = [-(2**62), -5, 0, 3, 2**40, 2**62, 2**62 + 1]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = with_position(df, "k", bucket=int_bucket("k"), levels=2)
    assert [r.k for r in got.orderBy("position").collect()] == keys


def test_no_task_holds_a_whole_hot_group(spark):
    df = spark.range(20_000).select(F.concat(F.lit("hot"), F.col("id") % 1).alias("g"), F.col("id").alias("k"))
    placed = with_position(df, "k", by=["g"], bucket=int_bucket("k", 500), name="p")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[row_number.*?\n.*?\n.*?hashpartitioning\((.*?), \d+\)", plan, re.S)
    assert windows and all("_bucket" in w for w in windows)
    assert placed.filter("p != k").count() == 0


def test_other_key_types(spark):
    df = spark.range(40).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("g"), F.col("id").alias("k"))
    got = with_position(df.withColumn("g", F.when(F.col("k") > 4, F.col("g"))), "k", by=["g"], bucket=int_bucket("k", 4)).collect()
    seen = {}
    for r in sorted(got, key=lambda r: r.k):
        assert r.position == seen.setdefault(r.g, 0)
        seen[r.g] += 1
    assert len(seen) == 4


def test_rows_are_shuffled_once(spark, tmp_path):
    df = spark.range(5_000).select((F.col("id") % 7).alias("g"), F.col("id").alias("k"), F.lit("text").alias("t"))
    df.write.parquet(str(tmp_path / "p"))
    placed = with_position(spark.read.parquet(str(tmp_path / "p")), "k", by=["g"], bucket=int_bucket("k", 100), following={"n": "t"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = placed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    full = [line for line in plan.splitlines() if "FileScan" in line and ",t#" in line]
    assert len(full) <= 2 and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def _spread(written, spark, name="ordered"):
    """Rows per written partition of the last ranged positions."""
    from pyspark.sql.functions import col, shiftright

    paths = [p for n, p in written if n == name]
    return [r["count"] for r in spark.read.parquet(paths[-1]).groupBy(shiftright(col("_at"), 33)).count().collect()]


@pytest.mark.parametrize("kind", ["sparse", "skewed", "text", "one key", "all equal"])
def test_ranges_are_balanced_whatever_the_key(spark, monkeypatch, kind):
    from polysift.operators import position

    written = []

    def noted(df, name, keep=position.materialise):
        out = keep(df, name)
        written.append((name, out._scratch_path))
        return out

    monkeypatch.setattr(position, "materialise", noted)
    i = F.col("id")
    key = {
        "sparse": (i * i * 1_000_003).cast("long"), "skewed": F.when(i % 3 == 0, 7).otherwise(F.floor(F.exp(i / 1500)).cast("long")),
        "text": F.concat(F.lit("common/prefix/"), F.md5(i.cast("string"))), "one key": F.when(i % 3 == 0, F.lit("hot")).otherwise(F.md5(i.cast("string"))), "all equal": F.lit(1),
    }[kind]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = with_position(spark.range(12_000).select("id", key.alias("k")).repartition(5), "k", name="p").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(r.p for r in got) == list(range(12_000))
    assert [r.k for r in sorted(got, key=lambda r: r.p)] == sorted(r.k for r in got)
    sizes = _spread(written, spark)
    assert len(sizes) >= 14 and max(sizes) < 3 * 12_000 / 16


def test_ranged_positions_in_groups(spark, rows):
    r = random.Random(3)
    data = [(r.choice(["a", "b", None, "c"]), r.choice([None, 1.5, -2.0, 7.0]), f"t{i}") for i in range(300)] + [("a", 0.0, "same")] * 20
    df = spark.createDataFrame(data, "g string, x double, t string").repartition(3)
    got = with_position(df, ["x", "t"], by=["g"], name="p", total="n").collect()
    for g in ("a", "b", None, "c"):
        mine = sorted((x for x in got if x.g == g), key=lambda x: x.p)
        want = sorted(((x, t) for h, x, t in data if h == g), key=lambda v: (v[0] is not None, v[0] or 0, v[1]))
        assert [(x.x, x.t) for x in mine] == want and [x.p for x in mine] == list(range(len(want))) and {x.n for x in mine} == {len(want)}
    cut = with_position(df, ["x", "t"], by=["g"], name="p", first=2)
    assert cut.count() == 8 and cut.columns == ["g", "x", "t", "p"]
    with pytest.raises(ValueError, match="following"):
        with_position(df, "t", following={"next": "x"})
    assert with_position(df.limit(0), "t").count() == 0
