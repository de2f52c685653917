"""Streams over many batches: runs merged without their length, results and states that do not pile up, repeated writes."""

import json

import pytest
from pyspark.sql import functions as F

from polysift import scratch, sinks
from polysift.sources import annotations, schemas
from polysift.streaming import streams

FIELDS = "rank bigint, index bigint, image_path string, question string, answer string, output array<string>"


def shards(folder, rows, world, name="result"):
    folder.mkdir(exist_ok=True)
    for r in range(world):
        mine = [{"rank": r, "index": p // world, **row} for p, row in enumerate(rows) if p % world == r]
        (folder / f"{name}_{r}.json").write_text("\n".join(map(json.dumps, mine)) + "\n")


def row(i, image="{}.jpg"):
    return {"image_path": image and image.format(i), "question": f"q{i}", "answer": "yes", "output": ["yes"]}


@pytest.mark.parametrize(("n", "world"), [(10, 4), (8, 4), (3, 3)])
def test_a_run_is_merged_without_its_length(spark, tmp_path, n, world):
    rows = [row(i) for i in range(n)]
    padded = rows + rows[: -n % world]
    shards(tmp_path / "in", padded, world)
    preds = streams.stream_predictions(spark, str(tmp_path / "in"), schema=FIELDS, files_per_batch=1)
    got = streams.run_merge(preds, str(tmp_path / "out"), world=world, silence=3.0, timeout=120.0)
    assert sorted(r.position for r in got.collect()) == list(range(n))
    assert {r.question for r in got.collect()} == {f"q{i}" for i in range(n)}


def test_genuine_last_rows_stay_or_are_asked_about(spark, tmp_path):
    rows = [row(i, None) for i in range(5)] + [row(0, None) | {"question": "other"}]
    shards(tmp_path / "in", rows, 2)
    read = lambda name: streams.stream_predictions(spark, str(tmp_path / name), schema=FIELDS)
    got = streams.run_merge(read("in"), str(tmp_path / "out"), world=2, silence=1.0, timeout=120.0)
    assert sorted(r.position for r in got.collect()) == list(range(6))
    shards(tmp_path / "in2", rows[:5] + [rows[0]], 2)
    unclear = streams.run_merge(read("in2"), str(tmp_path / "out2"), world=2, silence=1.0, timeout=120.0)
    with pytest.raises(Exception, match="give n_total"):
        unclear.collect()


def test_a_missing_rank_is_not_taken_for_the_end(spark, tmp_path):
    shards(tmp_path / "in", [row(i) for i in range(4)], 2)
    preds = streams.stream_predictions(spark, str(tmp_path / "in"), schema=FIELDS)
    with pytest.raises(TimeoutError):
        streams.run_merge(preds, str(tmp_path / "out"), world=3, silence=1.0, timeout=15.0)


def counted(spark, tmp_path, n, compact):
    (tmp_path / "in").mkdir()
    for i in range(n):
        (tmp_path / "in" / f"{i:03d}.json").write_text(json.dumps({"k": i % 3, "v": i}) + "\n")
    source = spark.readStream.schema("k bigint, v bigint").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    stream = source.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("last"))
    return streams.run_available(stream, str(tmp_path / "out"), mode="update", keys=("k",), compact=compact), stream.schema


def test_results_by_key_stay_few_files(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got, schema = counted(spark, tmp_path, 50, 7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = {k: (len(range(k, 50, 3)), max(range(k, 50, 3))) for k in range(3)}
    shown = lambda df: {r.k: (r.n, r["last"]) for r in df.collect()}
    assert shown(got) == want
    out = str(tmp_path / "out")
    assert len(scratch.children(spark, f"{out}/data", "batch_id=")) <= 14 and len(scratch.children(spark, f"{out}/merged", "upto=")) <= 2
    # The batch of the last merge is repeated: the merged table and the result stay as they are.
    streams._merge_batches(spark, out, schema, ("k",), 48, 7)
    assert shown(streams.newest_rows(spark, out, schema, ("k",))) == want


def test_old_codebook_states_go(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(6):
        spark.createDataFrame([(i, [1.0, float(i)])], "id bigint, v array<double>").coalesce(1).write.parquet(str(tmp_path / "in" / f"b{i}"))
    source = spark.readStream.schema("id bigint, v array<double>").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    start = spark.createDataFrame([(0, [1.0, 0.0], 1.0), (1, [0.0, 1.0], 1.0)], "code bigint, vec array<double>, size double")
    latest = streams.stream_codebook(source, start, str(tmp_path / "out"), vec="v")
    assert latest().count() == 2
    assert scratch.children(spark, str(tmp_path / "out" / "state"), "v=") == ["v=5", "v=6"]


def test_a_repeated_append_adds_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.range(100).repartition(3)
    assert sinks.append_once(df, out, "a") and not sinks.append_once(df, out, "a")
    assert sinks.append_once(spark.range(100, 130), out, "b")
    sinks.write_jsonl(spark.range(130, 140), out)
    read = lambda: sorted(r.id for r in spark.read.schema("id bigint").json(out).collect())
    assert read() == list(range(140))
    # A write that stopped before its id was noted, with files of it in place and others not.
    scratch.delete(spark, f"{out}/_writes/a")
    scratch.delete(spark, f"{out}/part-a-00001.json")
    assert sinks.append_once(df, out, "a") and read() == list(range(140))
    with pytest.raises(ValueError, match="write id"):
        sinks.append_once(df, out, "../x")


def test_a_tree_is_listed_by_tasks(spark, tmp_path):
    for name in ("a/x.jpg", "a/b/y.jpg", "a/b/c/d/z.jpg", "e/empty.jpg", "e/note.txt", "top.jpg", "_hidden/h.jpg", "a/.dot.jpg", "sp ace/ö+%.jpg"):
        path = tmp_path / "tree" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if "empty" in name else name.encode())
    root = str(tmp_path / "tree")
    got = {r.path: r.length for r in annotations.walk_media(spark, root, pattern="*.jpg").collect()}
    spark_lists = {r.path for r in annotations.list_media(spark, root + "/*", pattern="*.jpg").collect()}
    assert len(got) == 6 and got[f"{root}/e/empty.jpg"] == 0 and got[f"{root}/sp ace/ö+%.jpg"] == len("sp ace/ö+%.jpg".encode())
    assert len(spark_lists) <= len(got)
    (tmp_path / "none").mkdir()
    assert annotations.walk_media(spark, str(tmp_path / "none")).count() == 0


def test_rows_of_a_rank_leave_part_by_part():
    """A rank's rows are not gathered: each part yields what passes before the next one is asked for."""
    import pandas as pd

    class State:
        row = None

        def exists(self):
            return self.row is not None

        def get(self):
            return self.row

        def update(self, row):
            self.row = row

    class Handle:
        timers = []

        def listTimers(self):
            return []

        def registerTimer(self, at):
            self.timers.append(at)

    class Times:
        def getCurrentProcessingTimeInMs(self):
            return 5

    processor, asked = streams._LastOfRank(10), []
    processor.held, processor.handle = State(), Handle()

    def parts():
        for i in range(3):
            asked.append(i)
            yield pd.DataFrame({"index": [2 * i, 2 * i + 1], "row": [f"r{2 * i}", f"r{2 * i + 1}"]})

    out = processor.handleInputRows(("0",), parts(), Times())
    assert next(out)["row"].tolist() == ["r0"] and asked == [0]
    assert [r for frame in out for r in frame["row"]] == ["r1", "r2", "r3", "r4"]
    assert processor.held.row == (5, "r5") and Handle.timers == [15]
