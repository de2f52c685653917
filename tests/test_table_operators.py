"""Conversations, batching, segments, vectors, caller's Python and streams against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from polysift.functions import models
from polysift.operators import batching, conversations, segments, subset, vectors
from polysift.plans import jobs
from polysift.scratch import materialise, shared_dir
from polysift.streaming import streams


# -- conversations


@pytest.mark.parametrize("width", [1, 3, 65_536])
def test_pairs_of_hot_conversations(spark, width):
    rnd = random.Random(4)
    turns = []
    for conv in range(30):
        length = 90 if conv == 0 else rnd.randrange(0, 9)
        for t in range(length):
            turns.append((conv, t, rnd.choice(["user", "assistant", "system"]) if rnd.random() < 0.4 else ("user", "assistant")[t % 2], f"{conv}.{t}"))
    want = set()
    for conv in range(30):
        said = [(r, x) for c, _, r, x in turns if c == conv and r != "system"]
        for i in range(0, len(said) - 1, 2):
            if said[i][0] == "user" and said[i + 1][0] == "assistant":
                want.add((conv, i // 2, said[i][1], said[i + 1][1]))
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(7)
    got = conversations.single_turn_pairs(df, bucket_rows=width)
    assert {tuple(r) for r in got.select("conv_id", "pair", "question", "answer").collect()} == want
    bad = conversations.check_alternation(df, bucket_rows=width).collect()
    assert all((r.role == "user") != (r.place % 2 == 0) for r in bad)


def test_chat_template(spark):
    turn = "array<struct<from:string,value:string>>"
    rows = [
        (0, [("human", " hi <image> "), ("gpt", " yes ")]), (1, [("gpt", "first")]), (2, []), (3, [("human", "a"), ("gpt", "b"), ("human", "c")]),
    ]
    df = spark.createDataFrame(rows, f"k int, conversation {turn}")
    got = {r.k: r for r in conversations.render_image_chat(df, slots=2, system="S").collect()}
    assert got[0].prompt == "<s>[INST] <<SYS>>\nS\n<</SYS>>\n\n hi <image><image> [/INST] yes </s>" and got[0].reject is None
    assert got[1].prompt is None and got[1].reject == "roles do not alternate" and got[2].prompt == ""
    assert got[3].prompt.endswith("a [/INST] b </s><s>[INST] c [/INST]")


def test_training_records(spark):
    df = spark.createDataFrame([("s", "I", "O", "t")], "sample_id string, instruction string, output string, task string")
    row = conversations.sft_records(df).first()
    assert tuple(row) == ("s", "t", "### System: You are a helpful assistant.\n### User: I\n### Assistant: ", "O </s>", "t")
    with pytest.raises(ValueError):
        conversations.sft_records(df, template="other")


# -- batching


def dealt_by_hand(lengths, chunks):
    if len(lengths) % chunks:
        return [(i % chunks, i // chunks) for i in range(len(lengths))]
    room, load, count, out = len(lengths) // chunks, [0.0] * chunks, [0] * chunks, []
    for x in lengths:
        open_chunks = [c for c in range(chunks) if count[c] < room]
        c = min(open_chunks, key=lambda c: (load[c], c))
        out.append((c, count[c]))
        load[c] += x
        count[c] += 1
    return out


def test_length_groups(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.randrange(1, 50)) for i in range(107)]
    got = batching.length_grouped(
        spark.createDataFrame(rows, "k bigint, n bigint"), key="k", length="n", batch_size=4, world=3, seed=6
    ).collect()
    assert sorted(r.k for r in got) == list(range(107))
    for mega in range(9):
        members = [r for r in got if r.mega == mega]
        assert len(members) == (12 if mega < 8 else 11)
        lengths = sorted((r.n for r in members), reverse=True)
        assert sorted((r.n, r.chunk, r.place) for r in members) == sorted((n, c, p) for n, (c, p) in zip(lengths, dealt_by_hand(lengths, 3)))


def test_modality_groups(spark):
    rnd = random.Random(10)
    rows = [(i, rnd.randrange(1, 50) * (1 if i % 3 else -1)) for i in range(100)]
    df = spark.createDataFrame(rows, "k bigint, n bigint")
    got = sorted(batching.modality_grouped(df, key="k", signed_length="n", batch_size=2, world=3, seed=1).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(100)) and sorted(r.k for r in got) == list(range(100))
    media, words = 66, 34
    full = (media - 1) // 6 + (words - 1) // 6
    for mega in range(full):
        assert len({r.n > 0 for r in got[mega * 6 : mega * 6 + 6]}) == 1
    tail = [r.k for r in got[full * 6 :]]
    assert tail == sorted(tail)
    alone = batching.modality_grouped(df.filter("n > 0"), key="k", signed_length="n", batch_size=2, world=3, seed=1)
    assert sorted(r.position for r in alone.collect()) == list(range(66))


def test_shards(spark):
    df = spark.range(23).select(F.col("id").alias("position"))
    got = batching.shard_strided(df, 5).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [4, 4, 5, 5, 5]
    assert batching.batch_ids(df, 10).groupBy("batch_id").count().orderBy("batch_id").collect()[-1]["count"] == 3


# -- segments


def test_segments_against_numpy(spark):
    rnd = np.random.default_rng(1)
    signals = {n: rnd.random(n).astype("float32") for n in (3, 10, 61, 103, 240)}
    df = spark.createDataFrame([(n, [float(x) for x in s]) for n, s in signals.items()], "k int, signal array<float>")

    def cut(frame):
        out = {}
        for r in frame.orderBy("segment").collect():
            out.setdefault(r.k, []).append(r.samples)
        return out

    fixed, equal, hop = cut(segments.segments_fixed(df, rate=10)), cut(segments.segments_equal(df, n=10)), cut(
        segments.segments_hop(df, total=12, hop=3)
    )
    for n, s in signals.items():
        padded = np.pad(s, (0, max(-(-n // 10), 1) * 10 - n))
        assert np.allclose(fixed[n], padded.reshape(-1, 10))
        width = n // 10
        assert np.allclose(equal[n], s[: width * 10].reshape(10, width))
        rate = n // 12
        for i, part in enumerate(hop[n]):
            begin, end = int(max(3 * i - 0.5, 0) * rate), int((3 * i + 1.5) * rate)
            want = np.pad(s[begin:end], (2 * rate - (end - begin), 0))
            assert np.allclose(part, want)
    assert len(fixed[3]) == 1 and len(hop[240]) == 4
    back = cut(segments.segments_hop(df, total=4, hop=3))
    assert np.allclose(back[240][1], np.pad(signals[240][150:240], (0, 30)))
    assert jobs.segment_manifest(df, jobs.SegmentConfig(mode="equal", options={"n": 2})).count() == 10
    assert "Exchange" not in jobs.segment_manifest(df, jobs.SegmentConfig(rate=10))._jdf.queryExecution().executedPlan().toString()


def test_event_windows(spark):
    times = [0.0, 1.49, 1.5, 5.49, 5.5, 7.4, 59.9, -0.5, -0.6]
    df = spark.createDataFrame([(t,) for t in times], "t double").select("t", F.timestamp_micros((F.col("t") * 1_000_000).cast("bigint")).alias("ts"))
    got = {r.t: r.mark for r in segments.event_windows(df).collect()}
    assert got == {0.0: 0, 1.49: 0, 5.5: 6, 7.4: 6, 59.9: 60, -0.5: 0}


# -- vectors


@pytest.fixture(scope="module")
def cloud(spark):
    rnd = np.random.default_rng(0)
    a, b = rnd.normal(size=(90, 6)), rnd.normal(size=(70, 6))
    b[5] = b[60]  # a tie
    frame = lambda m, p: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], f"{p}_id bigint, {p}_vec array<double>")
    return a, b, frame(a, "a"), frame(b, "b")


@pytest.mark.parametrize("metric", ["cosine", "dot", "distance"])
@pytest.mark.parametrize("k", [1, 4, 100])
def test_best_matches_small_and_blocked(cloud, metric, k):
    a, b, da, db = cloud
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = {"cosine": unit(a) @ unit(b).T, "dot": a @ b.T, "distance": -((a[:, None] - b[None]) ** 2).sum(-1)}[metric]
    order = [sorted(range(70), key=lambda j, i=i: (-round(scores[i, j], 9), j))[:k] for i in range(90)]
    # Rows and candidates without a vector take no part, in one block or in many.
    da = da.unionByName(da.limit(1).selectExpr("cast(900 as bigint) as a_id", "cast(null as array<double>) as a_vec"))
    db = db.limit(1).selectExpr("cast(901 as bigint) as b_id", "cast(null as array<double>) as b_vec").unionByName(db)
    for options in ({}, {"block_values": 100}):
        got = vectors.best_matches(da, db, k, metric=metric, **options).collect()
        found = {(r.a_id, r["rank"]): (r.b_id, r.score) for r in got}
        assert len(found) == 90 * min(k, 70)
        for i, js in enumerate(order):
            for r, j in enumerate(js, start=1):
                assert found[(i, r)][1] == pytest.approx(scores[i, j], abs=1e-9)
                if j not in (5, 60):
                    assert found[(i, r)][0] == j


def test_tables_match_without_the_driver(cloud, monkeypatch):
    """Large candidates never reach the driver, and rows are written once."""
    a, b, da, db = cloud
    monkeypatch.setattr(vectors, "_matrix", None)
    written = []
    monkeypatch.setattr(vectors, "materialise", lambda df, name, keep=vectors.materialise: written.append(name) or keep(df, name))
    got = {(r.a_id, r["rank"]): r.b_id for r in vectors.best_matches(da, db, 3, metric="distance", block_values=60).collect()}
    gaps = ((a[:, None] - b[None]) ** 2).sum(-1)
    assert len(got) == 270 and all(gaps[i, got[i, 3]] == pytest.approx(np.sort(gaps[i])[2]) for i in range(90))
    assert written.count("rows") == 1 and len(written) == 2


def test_blocks_of_wide_vectors_hold_fewer_rows(spark, monkeypatch):
    from polysift.operators import tiles

    assert [tiles.fitting(4096, w) for w in (None, 64, 1024, 1 << 21)] == [4096, 4096, 1024, 1]
    monkeypatch.setattr(tiles, "BLOCK_NUMBERS", 60)
    rows = materialise(spark.range(40).select("id", F.array_repeat(F.col("id").cast("float"), 6).alias("v")), "wide")
    blocks = tiles.pack(rows, ["id"], "v")
    assert blocks.count == 4 and blocks.kind == "<f4" and blocks.table.agg(F.sum("n")).first()[0] == 40


def test_small_blocks_are_copied_once_per_group(spark):
    """However small the blocks, few copies of them reach the tasks, and every pair of rows meets once."""
    import pyarrow as pa

    from polysift.operators import tiles

    rows = materialise(spark.range(1_000).select("id", F.array_repeat(F.col("id").cast("double"), 2).alias("v")), "points")
    blocks, others = (tiles.pack(rows, ["id"], "v", block_rows=5) for _ in range(2))
    assert blocks.count == 200

    def run(one, many):
        for block in many:
            yield pa.record_batch({"left": pa.array([one["n"]]), "right": pa.array([block["n"]])})

    met = tiles.meet_grouped(blocks.table, others.table, ["width"], run, "left long, right long").collect()
    assert sum(r.left * r.right for r in met) == 1_000_000
    copies = sum(r.left + r.right for r in met)
    assert copies <= 2 * tiles.SIDE_GROUPS * 1_000, copies


@pytest.mark.parametrize("metric", ["cosine", "distance"])
def test_pruned_matches_are_the_same(spark, metric):
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(12, 8)) * 10
    a, b = (centres[rnd.integers(0, 12, n)] + rnd.normal(size=(n, 8)) * 0.2 for n in (400, 500))
    a[3], b[7] = 0, 0
    b[20:40] = b[20]
    frame = lambda m, p: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{p}_id bigint, {p}_vec array<double>").repartition(3)
    da, db = frame(a, "a"), frame(b, "b")
    da = da.unionByName(spark.createDataFrame([(None, [1.0] * 8), (999, None)], da.schema))
    want = {(r.a_id, r["rank"]): (r.b_id, r.score) for r in vectors.best_matches(da, db, 5, metric=metric).collect()}
    hits, report = vectors.pruned_matches(da, db, 5, metric=metric, cells=24, block_rows=50)
    got = {(r.a_id, r["rank"]): (r.b_id, r.score) for r in hits.collect()}
    assert got.keys() == want.keys() and all(got[k][1] == pytest.approx(want[k][1], abs=1e-9) for k in want)
    ties = sum(got[k][0] != want[k][0] for k in want)
    assert ties <= 5  # only where rounding orders equal scores
    [said] = report.collect()
    assert said.pairs == 400 * 500 and said.skipped > 0.5 * said.pairs
    with pytest.raises(ValueError, match="dot"):
        vectors.pruned_matches(da, db, 5, metric="dot")
    assert vectors.pruned_matches(da, db.limit(0), 5, metric=metric)[0].count() == 0


def test_codebook_assignment_and_step(cloud, spark):
    a, b, da, db = cloud
    book = db.filter("b_id < 4").select(F.col("b_id").alias("code"), F.col("b_vec").alias("vec"))
    far = spark.createDataFrame([(9, [50.0] * 6)], "code bigint, vec array<double>")
    book = book.unionByName(far)
    centres = np.vstack([b[:4], [[50.0] * 6]])
    near = ((a[:, None] - centres[None]) ** 2).sum(-1)
    at = near.argmin(1)
    got = {r.a_id: r for r in vectors.nearest_code(da, book, key="a_id", vec="a_vec").collect()}
    names = [0, 1, 2, 3, 9]
    assert all(got[i].code == names[at[i]] and got[i].distance == pytest.approx(near[i].min()) for i in range(90))
    step = {r.code: r for r in vectors.kmeans_step(da, book, vec="a_vec").collect()}
    for c, name in enumerate(names):
        assert step[name].size == (at == c).sum()
        assert np.allclose(step[name].vec, a[at == c].mean(0) if (at == c).any() else centres[c])
    error = vectors.quantization_error(vectors.nearest_code(da, book, key="a_id", vec="a_vec"), 6, beta=2.0).first().error
    assert error == pytest.approx(2 * near.min(1).mean() / 6)
    blocked = {r.code: r for r in vectors.kmeans_step(da, book, vec="a_vec", block_values=6).collect()}
    assert all(blocked[c].size == step[c].size and np.allclose(blocked[c].vec, step[c].vec) for c in step)
    usage = {r.code: (r.n, r.dead) for r in vectors.code_usage(vectors.nearest_code(da, book, key="a_id", vec="a_vec"), 10).collect()}
    assert usage[9] == (0, True) and sum(n for n, _ in usage.values()) == 90 and len(usage) == 10


def test_kmeans_error_never_grows(cloud):
    _, _, da, db = cloud
    start = db.filter("b_id < 5").select(F.col("b_id").alias("code"), F.col("b_vec").alias("vec"))
    errors = []
    for iters in (1, 3, 6):
        book = vectors.kmeans(da, start, vec="a_vec", iters=iters)
        errors.append(vectors.quantization_error(vectors.nearest_code(da, book, key="a_id", vec="a_vec"), 6).first().error)
    assert errors == sorted(errors, reverse=True)
    assert jobs.fit_codebook(da, 3, key="a_id", vec="a_vec", iters=2).count() == 3


def test_bounded_rounds_give_the_same_centres(spark):
    rnd = np.random.default_rng(8)
    centres = rnd.normal(size=(10, 5)) * 6
    points = centres[rnd.integers(0, 10, 3000)] + rnd.normal(size=(3000, 5)) * 0.5
    points[100:400] = points[100]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "id bigint, v array<double>").repartition(4)
    df = df.unionByName(spark.createDataFrame([(-1, None)], df.schema))
    start = spark.createDataFrame([(i * 3, v.tolist()) for i, v in enumerate(points[[1, 2, 3, 4, 5, 6, 100, 100]])] + [(99, [500.0] * 5)], "code bigint, vec array<double>")
    want = {r.code: r for r in vectors.kmeans(df, start, vec="v", iters=8).collect()}
    book, report = vectors.kmeans_bounded(df, start, vec="v", iters=8)
    got = {r.code: r for r in book.collect()}
    assert got.keys() == want.keys() and all(got[c].size == want[c].size and np.allclose(got[c].vec, want[c].vec, atol=1e-9) for c in want)
    assert report[0]["distances"] == 3000 * 9 and report[0]["moved"] == 3000
    assert sum(r["distances"] for r in report) < 0.6 * 3000 * 9 * len(report)
    _, ended = vectors.kmeans_bounded(df, start, vec="v", iters=60)
    assert len(ended) < 60 and ended[-1]["moved"] == 0
    with pytest.raises(ValueError, match="use kmeans"):
        vectors.kmeans_bounded(df, start, vec="v", block_values=10)


def test_moving_codebook(cloud, spark):
    a, b, da, _ = cloud
    a = a / np.linalg.norm(a, axis=1, keepdims=True)
    unit = b[:4] / np.linalg.norm(b[:4], axis=1, keepdims=True)
    prev = spark.createDataFrame([(i, [float(x) for x in v], 10.0 * i) for i, v in enumerate(unit)], "code bigint, vec array<double>, size double")
    batch = spark.createDataFrame([([float(x) for x in v],) for v in a], "vec array<double>")
    moved = {r.code: r for r in vectors.ema_codebook(prev, batch, vec="vec", decay=0.8).collect()}
    at = ((a[:, None] - unit[None]) ** 2).sum(-1).argmin(1)
    for c in range(4):
        target = a[at == c].mean(0) if (at == c).any() else unit[c]
        mixed = 0.8 * unit[c] + 0.2 * target / np.linalg.norm(target)
        assert np.allclose(moved[c].vec, mixed / np.linalg.norm(mixed))
        assert moved[c].size == pytest.approx(8.0 * c + 0.2 * (at == c).sum())
    sizes = vectors.smoothed_sizes(prev, eps=0.5).collect()
    assert sum(r.smoothed for r in sizes) == pytest.approx(60) and sizes[0].smoothed > 0


def test_code_maps(spark):
    used = spark.createDataFrame([(3, 0), (7, 1)], "code bigint, index bigint")
    codes = spark.createDataFrame([(0, 3), (1, 7), (2, 5)], "k int, code bigint")
    index = lambda policy: {r.k: r["index"] for r in vectors.remap_codes(codes, used, policy=policy).collect()}
    assert index("extra") == {0: 0, 1: 1, 2: 2} and index(1) == {0: 0, 1: 1, 2: 1}
    drawn = index("random")
    assert drawn == index("random") and drawn[2] in (0, 1)
    back = vectors.unmap_codes(vectors.remap_codes(codes, used, policy="extra").drop("code"), used)
    assert {r.k: r.code for r in back.collect()} == {0: 3, 1: 7, 2: 3}


def test_alignment_loss(cloud, spark):
    a, b, *_ = cloud
    rows = [(i // 8, [float(x) for x in a[i]], [float(x) for x in b[i]]) for i in range(20)]
    df = spark.createDataFrame(rows, "batch_id bigint, a_vec array<double>, b_vec array<double>")
    odd = spark.createDataFrame([(None, [1.0] * 6, [1.0] * 6), (0, None, [1.0] * 6)], df.schema)
    got = {r.batch_id: r for r in vectors.alignment_loss(df.unionByName(odd), scale=0.5).collect()}
    blocked = {r.batch_id: r for r in vectors.alignment_loss(df.repartition(3), scale=0.5, block_rows=3).collect()}
    mixed = {r.batch_id: r for r in vectors.alignment_loss(df, scale=0.5, block_rows=5).collect()}
    for other in (blocked, mixed):  # every batch in blocks; the last one, of four pairs, in one group
        assert {b: r.n for b, r in other.items()} == {b: r.n for b, r in got.items()}
        assert all(other[b].loss == pytest.approx(got[b].loss, abs=1e-12) for b in got)
    for batch in range(3):
        x, y = a[batch * 8 : min(batch * 8 + 8, 20)], b[batch * 8 : min(batch * 8 + 8, 20)]
        logits = (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T * math.exp(0.5)
        p, q = (np.log(np.exp(m).sum(1)) - np.diag(m) for m in (logits, logits.T))
        assert got[batch].n == len(x) and got[batch].loss == pytest.approx((p.mean() + q.mean()) / 2)


def test_alignment_loss_of_a_large_batch(spark):
    """One batch in many blocks, with logits far apart: no matrix of the whole batch in any task."""
    rnd = np.random.default_rng(6)
    x, y = rnd.normal(size=(700, 4)), rnd.normal(size=(700, 4))
    df = spark.createDataFrame([(1, a.tolist(), b.tolist()) for a, b in zip(x, y, strict=True)], "batch_id bigint, a_vec array<double>, b_vec array<double>")
    [got] = vectors.alignment_loss(df.repartition(5), scale=4.0, block_rows=40).collect()
    logits = (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T * math.exp(4.0)
    p, q = (np.log(np.exp(m - m.max(1)[:, None]).sum(1)) + m.max(1) - np.diag(m) for m in (logits, logits.T))
    assert got.n == 700 and got.loss == pytest.approx((p.mean() + q.mean()) / 2)


# -- caller's Python


def words():
    return lambda texts: [[len(w) for w in t.split()] for t in texts]


def test_tokenizer_sees_a_bounded_piece_of_a_batch(spark, monkeypatch):
    """Texts of a batch become Python objects piece by piece; nulls, empty texts and long ones keep their rows."""
    monkeypatch.setattr(models, "PIECE_BYTES", 100)
    import pyarrow as pa

    texts = pa.array(["a" * 30, None, "", "b" * 250, "c", "d" * 90, None])
    pieces = list(models._text_pieces(texts))
    assert pa.concat_arrays(pieces) == texts and len(pieces) > 2 and [len(p) for p in models._text_pieces(pa.array([], pa.string()))] == [0]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts.to_pylist())], "k int, t string").coalesce(1)
    got = {r.k: r.ids for r in models.with_tokens(df, "t", words).collect()}
    assert got == {0: [30], 1: None, 2: [], 3: [250], 4: [1], 5: [90], 6: None}


def test_digests_of_packed_arrays(spark):
    """As md5 of the joined numbers, in one piece or in many."""
    import hashlib

    from catalog import packing

    rows = [(0, [1, None, 22]), (1, []), (2, None), (3, list(range(-3, 9))), (4, [7])]
    df = spark.createDataFrame(rows, "k int, a array<int>").coalesce(1)
    md5 = lambda a, null: None if a is None else hashlib.md5(" ".join(null if x is None else str(x) for x in a if x is not None or null).encode()).hexdigest()
    for null in (None, "0"):
        got = {r.k: r.d for r in df.select("k", packing._shown("a", null).alias("d")).collect()}
        assert got == {k: md5(a, null) for k, a in rows}


def test_digests_of_numbers_far_apart(spark):
    """Texts of numbers come from a look-up, of all between the ends or of those that occur."""
    import hashlib

    from catalog import packing

    rows = [(0, [2**31 - 1, None, -(2**31), 0, -100]), (1, [70_000, 0]), (2, [None]), (3, [5, 5])]
    for part in (rows, rows[2:]):
        df = spark.createDataFrame(part, "k int, a array<int>").coalesce(1)
        got = {r.k: r.d for r in df.select("k", packing._shown("a", "0").alias("d")).collect()}
        assert got == {k: hashlib.md5(" ".join("0" if x is None else str(x) for x in a).encode()).hexdigest() for k, a in part}


def test_tokenizers_may_return_arrow_lists(spark):
    from catalog import packing

    texts = ["a bb", "", " ", None, "é\u4e2d \U0001f600x  y"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1)
    want = {k: None if t is None else [len(w) for w in t.split(" ")] for k, t in enumerate(texts)}
    assert {r.k: r.ids for r in models.with_tokens(df, "t", packing._lengths).collect()} == want
    packed = models.with_tokens(df, "t", packing._lengths, packed=True)
    assert {r.k: None if r.ids is None else bytes(r.ids) for r in packed.collect()} == {
        k: None if v is None else b"".join(x.to_bytes(4, "little") for x in v) for k, v in want.items()
    }
    from polysift.functions import tokens

    assert {r.k: r.ids for r in packed.select("k", tokens.unpacked("ids").alias("ids")).collect()} == want


def test_callers_python(spark):
    df = spark.createDataFrame([(i, "a bb " + "c" * i) for i in range(20)], "k bigint, t string")
    assert {r.k: r.ids for r in models.with_tokens(df, "t", words).collect()}[3] == [1, 2, 3]

    def model():
        return lambda texts: [f"{len(texts)}" for _ in texts]

    sizes = models.batch_predict(df.coalesce(1), "t", model, batch=8).groupBy("predict").count().collect()
    assert {r.predict: r["count"] for r in sizes} == {"8": 16, "4": 4}

    def decoder():
        return lambda content: {"n": len(content)}

    media = df.select(F.col("k").alias("path"), F.encode("t", "UTF-8").alias("content"))
    assert {r.path: r.n for r in models.map_media(media, decoder, "n bigint").collect()}[4] == 9


def test_packing_jobs(spark):
    df = spark.createDataFrame([(f"s{i}", "t", "a bb " * (i + 1), "ccc") for i in range(11)], "sample_id string, task string, instruction string, output string")
    got = jobs.pack_batches(df, words, jobs.PackConfig(batch_size=4)).collect()
    assert sorted(r.position for r in got) == list(range(11)) and {r.batch_id for r in got} == {0, 1, 2}
    for r in got:
        assert len(r.input_ids) == len(r.labels) == r.width == max(len(x.input_ids) for x in got if x.batch_id == r.batch_id)
    left = jobs.pack_batches(df, words, jobs.PackConfig(batch_size=4, side="left", evaluate=True)).collect()
    assert all(set(r.labels) == {-100} for r in left)

    def special():
        table = {"<video>": 103, "<question_start>": 109, "<question_end>": 110}
        return lambda texts: [[table.get(w, 1) for w in t.split()] for t in texts]

    av = df.withColumn("instruction", F.lit("x <video> <question_start> q q <question_end>"))
    row = jobs.pack_media_slots(av, special, vocab_size=100, widths={"<video>": 3}).first()
    assert (row.video, row.question, row.labels) == ([0, 1, 1, 1, 0, 0, 0], [0, 0, 0, 0, 1, 1, 0], [-100] * 6 + [1])


def test_image_chat_job(spark):
    def tokenizer():
        table = {"[INST]": 50, "[/INST]": 51, "</s>": 2, "<image>": 99}
        return lambda texts: [[table.get(w, 7) for w in t.replace("<image>", " <image> ").split()] for t in texts]

    turn = "array<struct<from:string,value:string>>"
    rows = [("a", [("human", "<image> why ?"), ("gpt", "because so")]), ("b", [("gpt", "x")]), ("c", [("human", "q"), ("gpt", "r")])]
    batches, rejects = jobs.pack_image_chat(
        spark.createDataFrame(rows, f"sample_id string, conversation {turn}"), tokenizer,
        jobs.ChatConfig(start_marker=[51], end_marker=[2], image_id=99, slots=2),
    )
    got = {r.sample_id: r for r in batches.collect()}
    assert set(got) == {"a", "c"} and [r.sample_id for r in rejects.collect()] == ["b"]
    a = got["a"]
    assert sum(a.image_mask) == 2 and 99 not in a.input_ids and [x for x in a.labels if x != -100] == [7, 7, 2]
    assert sum(a.question_mask) == 3 and not any(got["c"].question_mask)
    assert len(got["c"].input_ids) == len(a.input_ids) == len(a.position_ids)


def test_prepare_job(spark):
    rows = spark.createDataFrame([(5 * i, f"id{i % 4}") for i in range(10)], "position bigint, id string")
    before, after = (spark.createDataFrame([(x,) for x in xs], "id string") for xs in (["id0"], ["id0", "id1"]))
    todo, report = jobs.prepare_subset(rows, before, after, n=3, key="id", position="position")
    assert sorted(r.id for r in todo.collect()) == ["id1", "id2"]
    assert report.first().asDict() == {"total_unique": 3, "ok": 1, "fail": 1, "skip": 1}


# -- streams


def test_scratch_reads_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or shared_dir(spark, "x").startswith(base)
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    assert materialise(spark.range(5), "five").count() == 5


@pytest.mark.parametrize(("master", "fine"), [("local[4]", True), ("local", True), ("local-cluster[2,1,512]", False), ("yarn", False)])
def test_a_folder_of_one_machine_is_refused_on_a_cluster(spark, master, fine):
    from types import SimpleNamespace

    conf = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}
    context = SimpleNamespace(master=master, applicationId="app", _jvm=spark.sparkContext._jvm, _jsc=spark.sparkContext._jsc)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, *d: conf.get(k)), sparkContext=context)
    if fine:
        assert shared_dir(session, "x").startswith("file:/tmp/warehouse/polysift-scratch/app/x-")
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session, "x")
    conf["spark.checkpoint.dir"] = "hdfs:/shared"
    assert shared_dir(session, "x").startswith("hdfs:/shared/app/x-")


def test_streams_equal_batch(spark, tmp_path):
    from polysift import sinks
    from polysift.sources import schemas

    rows = [
        {"rank": p % 3, "index": p // 3, "image_path": f"{p % 10}.jpg", "question": f"q{p % 10}", "answer": "yes", "output": ["yes" if p % 10 % 4 else "hm"]}
        for p in range(12)
    ]
    df = spark.createDataFrame(rows, schemas.IMAGE_PREDICTION.replace("subtask string, ", ""))
    for part in (df.filter("index < 2"), df.filter("index >= 2")):
        sinks.write_jsonl(part, f"{tmp_path}/in")
    stream = streams.stream_predictions(spark, f"{tmp_path}/in", schema=schemas.IMAGE_PREDICTION, files_per_batch=1)
    yes = streams.run_available(streams.running_yesno(stream), f"{tmp_path}/yes", mode="complete").first()
    assert (yes.total, yes.correct, yes.unparsed) == (12, 8, 4)
    known = streams.run_available(streams.stream_dedup(stream, world=3, n_total=10), f"{tmp_path}/known")
    assert sorted(r.position for r in known.collect()) == list(range(10))
    sinks.write_jsonl(df, f"{tmp_path}/in")
    again = streams.stream_predictions(spark, f"{tmp_path}/in", schema=schemas.IMAGE_PREDICTION)
    once = streams.run_available(streams.drop_redelivered(again), f"{tmp_path}/once")
    assert once.count() == 12 and once.select(subset.merged_position(world=3).alias("p")).distinct().count() == 12
    assert sorted(r.position for r in subset.dedup_padded(once, world=3).collect()) == list(range(10))
    running = streams.run_available(streams.running_yesno(stream).withColumn("k", F.lit(1)), f"{tmp_path}/update", mode="update", keys=("k",))
    assert (running.first().total, running.count()) == (24, 1)


def test_a_stream_without_files_gives_no_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = streams.stream_events(spark, f"{tmp_path}/in", "a bigint", pattern="*.parquet")
    assert streams.run_available(stream, f"{tmp_path}/out").count() == 0


def test_closed_windows_leave_and_late_rows_do_not_come_back(spark, tmp_path):
    import datetime as dt
    import os

    at = lambda minute: dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute)
    batches = [[0, 1, 5], [40, 41, 2], [90], [3, 91]]  # minute 2 is within the delay, minute 3 long past it
    for i, minutes in enumerate(batches):
        path = f"{tmp_path}/in{i}"
        spark.createDataFrame([(at(m), "x") for m in minutes], "ts timestamp, event_type string").coalesce(1).write.parquet(path)
        part = next(f for f in os.listdir(path) if f.endswith(".parquet"))
        os.makedirs(f"{tmp_path}/in", exist_ok=True)
        os.replace(f"{path}/{part}", f"{tmp_path}/in/{i}.parquet")
        os.utime(f"{tmp_path}/in/{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    stream = streams.stream_events(spark, f"{tmp_path}/in", "ts timestamp, event_type string", pattern="*.parquet", files_per_batch=1)
    rows = streams.run_available(streams.stream_segments(stream, seconds=600, delay="10 minutes"), f"{tmp_path}/out").collect()
    assert sorted((r.window.start.minute, r.n) for r in rows) == [(0, 4), (40, 2)]


def test_stream_codebook_moves_per_batch(spark, tmp_path):
    for i, vec in enumerate(([1.0, 0.0], [0.0, 1.0])):
        spark.createDataFrame([(vec,)], "vec array<double>").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = streams.stream_events(spark, f"{tmp_path}/in", "vec array<double>", pattern="*.parquet", files_per_batch=1)
    start = spark.createDataFrame([(0, [1.0, 0.0], 0.0), (1, [0.0, 1.0], 0.0)], "code bigint, vec array<double>, size double")
    latest = streams.stream_codebook(stream, start, f"{tmp_path}/out", vec="vec", decay=0.5)
    sizes = {r.code: r.size for r in latest().collect()}
    assert sorted(sizes.values()) == [0.25, 0.5]


# -- packing whole jobs


def _word_lengths():
    return lambda texts: [[len(w) for w in t.split(" ")] for t in texts]


def test_every_row_is_packed_once_whatever_its_key(spark):
    from polysift.plans import jobs

    rows = [("a.jpg#0", "t", "one two", "x")] * 2 + [("a.jpg#0", "t", "three", "yy")] + [(None, "t", f"null {'w ' * i}", "z") for i in range(9)]
    df = spark.createDataFrame(rows, "sample_id string, task string, instruction string, output string").repartition(4)
    out = jobs.pack_batches(df, _word_lengths, jobs.PackConfig(batch_size=4, seed=1)).collect()
    assert sorted(r.position for r in out) == list(range(12))
    assert all(len(r.input_ids) == r.width == len(r.labels) for r in out)
    want = sorted([len(w) for w in i.split(" ")] + [len(w) for w in o.split(" ")] for _, _, i, o in rows)
    assert sorted(r.input_ids[: sum(r.attention_mask)] for r in out) == want


def test_rows_of_one_id_are_ranked_in_many_tasks(spark, monkeypatch):
    """A third of all rows under one id: no range of the ranking holds much more than its share."""
    from polysift.operators import position
    from polysift.plans import jobs

    sizes = []

    def noted(df, name, keep=position.materialise):
        out = keep(df, name)
        if name == "ordered":
            sizes.extend(r["count"] for r in out.groupBy(F.shiftright("_at", 33)).count().collect())
        return out

    monkeypatch.setattr(position, "materialise", noted)
    rows = [("hot" if i % 3 == 0 else f"s{i}", "t", f"w {i % 5}", "x") for i in range(2400)]
    df = spark.createDataFrame(rows, "sample_id string, task string, instruction string, output string").repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        out = jobs.pack_batches(df, _word_lengths, jobs.PackConfig(batch_size=8, seed=1))
        assert sorted(r.position for r in out.select("position").collect()) == list(range(2400))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert max(sizes) < 3 * 2400 / 12


def _stored(monkeypatch):
    """Columns and types of the tokenized rows that a packing job writes."""
    from polysift.plans import jobs

    kinds, keep = {}, jobs.materialise

    def noted(df, name):
        kinds.update({n: t for n, t in df.dtypes if name == "tokenized"})
        return keep(df, name)

    monkeypatch.setattr(jobs, "materialise", noted)
    return kinds


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("side", "evaluate"), [("right", False), ("left", False), ("right", True)])
def test_packing_moves_ids_only(spark, monkeypatch, side, evaluate):
    """Labels are made behind the join, from one packed binary a row, which is never broadcast; null texts keep null arrays."""
    from polysift.plans import jobs

    kinds = _stored(monkeypatch)
    rows = [(f"s{i}", "t", "x yy " * i + "zzz", "aaaa b") for i in range(6)] + [("p", "t", None, "a"), ("q", "t", "", ""), ("r", "t", "a", None)]
    df = spark.createDataFrame(rows, "sample_id string, task string, instruction string, output string")
    out = jobs.pack_batches(df, _word_lengths, jobs.PackConfig(batch_size=3, seed=2, side=side, evaluate=evaluate))
    assert {n: t for n, t in kinds.items() if t not in ("string", "bigint", "int")} == {"input_ids": "binary"}
    assert "ShuffledHashJoin [_place" in _plan(out)
    got = {r.sample_id: r for r in out.collect()}
    n = lambda t: None if t is None else [len(w) for w in t.split(" ")]
    for key, _, prompt, answer in rows:
        p, a, r = n(prompt), [] if evaluate else n(answer), got[key]
        if p is None or a is None:
            assert r.input_ids is None and r.labels is None
            continue
        pad = r.width - len(p + a)
        want = (p + a, [-100] * len(p) + a, [True] * len(p + a))
        pads = ([2] * pad, [-100] * pad, [False] * pad)
        want = [y + x if side == "left" else x + y for x, y in zip(want, pads)]
        assert [r.input_ids, r.labels, r.attention_mask] == want


def test_ids_are_narrow_on_disk(spark):
    from polysift.functions import tokens

    ids = [[1, 2, 255], [], None, [256, 1], [65535], [65536, 0, 3], [-100, 5], [2**31 - 1, -(2**31)], [0]]
    rows = [(k, None if a is None else b"".join(x.to_bytes(4, "little", signed=True) for x in a)) for k, a in enumerate(ids)]
    df = spark.createDataFrame(rows, "k int, packed binary")
    for part in (df.coalesce(1), df.repartition(4), df.filter("k = 2"), df.filter("k = 1"), df.filter("k < 0"), df.filter("k in (2, 5, 8)").coalesce(1)):
        narrow = part.select("k", tokens.narrowed("packed").alias("n"))
        sizes = {r.k: None if r.n is None else len(r.n) for r in narrow.collect()}
        want = {0: 4, 1: 1, 2: None, 3: 5, 4: 3, 5: 13, 6: 9, 7: 9, 8: 2}
        assert sizes == {k: want[k] for k in sizes} and len(sizes) == part.count()
        assert {r.k: r.w for r in narrow.select("k", tokens.unpacked(tokens.widened("n")).alias("w")).collect()} == {k: ids[k] for k in sizes}


def test_packing_keeps_little_on_disk(spark, monkeypatch, tmp_path):
    """What was read may be deleted once it is tokenized; ids below 256 take a byte; keys are kept once, in order."""
    import shutil

    from polysift import scratch
    from polysift.operators import position
    from polysift.plans import jobs

    written, keep = {}, scratch.materialise

    def noted(df, name):
        out = keep(df, name)
        written[name] = out._scratch_path
        if name == "tokenized":
            written["bytes"] = out.agg(F.sum(F.octet_length("input_ids"))).first()[0]
        return out

    monkeypatch.setattr(jobs, "materialise", noted)
    monkeypatch.setattr(position, "materialise", noted)
    rows = [(f"s{i}", "t", "x yy " * i + "zzz", "aaaa b") for i in range(20)]
    spark.createDataFrame(rows, "sample_id string, task string, instruction string, output string").write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    out = jobs.pack_batches(df, _word_lengths, jobs.PackConfig(batch_size=3), after_read=lambda: shutil.rmtree(f"{tmp_path}/in"))
    assert written["bytes"] == sum(1 + 2 * i + 3 for i in range(20))
    assert scratch.exists(spark, written["tokenized"]) and not scratch.exists(spark, written["unordered"])
    got = {r.sample_id: r.input_ids[: sum(r.attention_mask)] for r in out.collect()}
    assert got == {f"s{i}": [1, 2] * i + [3, 4, 1] for i in range(20)}


def test_chats_move_ids_only(spark, monkeypatch):
    """Masks and labels are made behind the join, in one trip to Python."""
    from polysift.plans import jobs

    kinds = _stored(monkeypatch)
    rows = [(f"c{i}", [("human", f"<image> why {'w ' * i}?"), ("gpt", "because so")]) for i in range(9)]
    chats = spark.createDataFrame(rows, "sample_id string, conversation array<struct<from:string,value:string>>")
    out, _ = jobs.pack_image_chat(chats, _word_lengths, jobs.ChatConfig(start_marker=[7], end_marker=[4], image_id=2, slots=2, batch_size=3))
    assert {n: t for n, t in kinds.items() if t not in ("string", "bigint", "int")} == {"_raw": "binary"}
    assert "ShuffledHashJoin [_place" in _plan(out) and _plan(out).count("ArrowEvalPython ") == 1
    assert len(out.collect()) == 9


def test_samples_flow_into_the_packer(spark):
    from polysift.operators import conversations
    from polysift.plans import jobs
    from polysift.sources import samples

    turns = [("human", "<image>\nwhat"), ("gpt", "cat"), ("human", "why"), ("gpt", "fur")]
    images = spark.createDataFrame([("a.jpg", turns), ("a.jpg", turns[:2]), ("b.jpg", turns)], "image string, conversations array<struct<`from`:string,value:string>>")
    choices = spark.createDataFrame([("q", "A", None, "x", "y"), ("q", "A", None, "x", "y"), ("r", "B", "img", "x", None)], "question string, answer string, image string, A string, B string")
    for c in "CDE":
        choices = choices.withColumn(c, F.lit(None).cast("string"))
    built = samples.load_tasks(spark, {"i": samples.instruct_samples(images, root="r"), "c": samples.choice_samples(choices.withColumn("hint", F.lit(None).cast("string")))})
    assert built.filter("sample_id is null").count() == 0
    assert built.filter("task = 'instruct'").select("sample_id").distinct().count() == 5
    for template, style in (("plain", "plain"), ("inst", "seq2")):
        records = conversations.sft_records(built, template=template, style=style)
        packed = jobs.pack_batches(records, _word_lengths, jobs.PackConfig(batch_size=2))
        assert packed.count() == built.count() == 8
    shown = conversations.sft_records(built.filter("output = 'why'").limit(0).unionByName(built.limit(1)), template="inst", style="seq2").first()
    assert shown.instruction.startswith("<s>[INST] <<SYS>>\nYou are a helpful assistant.\n<</SYS>>\n\n") and shown.instruction.endswith(" [/INST]")
    assert shown.output.endswith("</s>")


def test_first_rows_are_cut_before_they_move(spark):
    from polysift.operators.position import int_bucket, with_position

    df = spark.range(10_000).repartition(4)
    cut = with_position(df, "id", bucket=int_bucket("id", 100), first=250)
    assert sorted((r.id, r.position) for r in cut.collect()) == [(i, i) for i in range(250)]
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("scalar-subquery")
    grouped = df.withColumn("g", F.col("id") % 3)
    capped = subset.cap_per_task(grouped, 5, position="id", bucket=int_bucket("id", 100), task="g")
    assert sorted(r.id for r in capped.collect()) == list(range(15))
    totals = with_position(grouped, "id", by=["g"], bucket=int_bucket("id", 100), total="n").groupBy("g").agg(F.max("n").alias("n"), F.max("position").alias("p"))
    assert {r.g: (r.n, r.p) for r in totals.collect()} == {0: (3334, 3333), 1: (3333, 3332), 2: (3333, 3332)}


RECORD = "rank int, index bigint, subtask string, image_path string, question string, answer string, output array<string>"


def merged_run(spark, rows, world, **options):
    """Positions kept of a run of (subtask, image, question, answer, output), padded to equal shards unless ``padded=False``."""
    padded = rows + rows[: -len(rows) % world] if options.pop("padded", True) else rows
    records = [(p % world, p // world, *r[:4], [r[4]]) for p, r in enumerate(padded)]
    df = spark.createDataFrame(records, RECORD).repartition(3)
    return sorted(r.position for r in subset.dedup_padded(df, world=world, **options).collect())


def test_padding_is_told_from_repeated_questions(spark):
    def run(questions, world):
        return merged_run(spark, [("s", f"{i}.jpg", q, "yes", "yes") for i, q in enumerate(questions)], world)

    assert run(["a", "b", "a", "c", "b"], 3) == list(range(5))
    assert run(["a", "b", "c", "d", "e", "f", "g"], 4) == list(range(7))
    assert run(["a", "b", "c", "d"], 4) == list(range(4))
    assert run(["q", "b", "b", "b", "x", "b"], 5) == list(range(6))


def test_genuine_rows_at_the_tail_are_never_dropped(spark):
    """Without media names, equal questions at both ends may be genuine."""
    plain = [("s", None, q, "A", "A") for q in "abcde"]
    # Another subtask: no repeat at all, whatever the question.
    assert merged_run(spark, [*plain, ("t", None, "a", "A", "B")], 2) == list(range(6))
    assert merged_run(spark, plain, 5) == list(range(5))
    for last in (("s", None, "a", "A", "A"), ("s", None, "a", "A", "B")):
        with pytest.raises(Exception, match="give n_total"):
            merged_run(spark, [*plain, last], 2)
        assert merged_run(spark, [*plain, last], 2, n_total=6) == list(range(6))
    with pytest.raises(Exception, match="give n_total"):
        merged_run(spark, plain, 2)
    assert merged_run(spark, plain, 2, n_total=5) == list(range(5))
    # The same image and question, answered otherwise.
    named = [("s", f"{q}.jpg", q, "A", "A") for q in "abcde"]
    with pytest.raises(Exception, match="give n_total"):
        merged_run(spark, [*named, ("s", "a.jpg", "a", "A", "B")], 2)


def test_written_pairs_come_back_whole(spark, tmp_path):
    from polysift import sinks
    from polysift.sources import predictions

    rows = [("s", i, image, q, "yes", pred) for i, (image, q, pred) in enumerate([("a\tb", "line\none", "no"), ("c\\n", None, None), ("\\N", "\\\\t", "yes"), ("x\r", "", "no")])]
    df = spark.createDataFrame(rows, "subtask string, position bigint, image string, question string, gold string, pred string")
    sinks.write_by_subtask(df, str(tmp_path / "p"))
    back = predictions.read_qa_tsv(spark, str(tmp_path / "p"), escaped=True).orderBy("position").collect()
    assert [(r.image, r.question, r.gold, r.pred) for r in back] == [r[2:] for r in rows]
