"""Readers and sample projections on small hand-written files."""

import json

import pytest
from pyspark.sql import functions as F

from polysift import sinks
from polysift.operators import lookup, subset
from polysift.plans import jobs
from polysift.sources import annotations, predictions, samples, schemas


def dump(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8")
    return str(path)


AVQA = [
    {"video_id": "1", "question_id": "7", "type": ["Audio", "Counting"], "video_path": "MUSIC_AVQA_data/a.mp4",
     "audio_path": "b.mp3", "question": "How many?", "answer": "two", "label": "<answer>two</answer>"},
]


def test_typed_questions(spark, tmp_path):
    path = dump(tmp_path / "avqa.json", AVQA)
    train = samples.avqa_samples(annotations.read_avqa(spark, path)).first()
    assert train.output == "<answer>two</answer>" and train.vid == "1" and train.qid == "7" and train.question_type == ["Audio", "Counting"]
    assert train.instruction == (
        "This is a video:\n<video_start><video><video_end>\nThis is an audio:\n<audio_start><audio><audio_end>\n"
        "<question_start>Please answer this question: How many?<question_end>"
    )
    test_rows = annotations.read_avqa(spark, path, "test")
    assert "label" not in test_rows.columns and samples.avqa_samples(test_rows, "test").first().output == "two"


def test_events_with_labels(spark, tmp_path):
    path = dump(tmp_path / "ave.json", [
        {"event": "Bell", "vid": "v 1+x", "start_time": 0, "end_time": 10}, {"event": "Dog", "vid": "v2", "start_time": 2, "end_time": 3},
    ])
    labels = tmp_path / "labels"
    labels.mkdir()
    (labels / "v 1+x.txt").write_text("first\nsecond")
    (labels / "empty.txt").write_text("")
    rows = annotations.read_ave(spark, path)
    side = annotations.read_labels(spark, str(labels))
    assert {r.vid: r.label for r in side.collect()} == {"v 1+x": "first\nsecond"}
    assert {r.vid: r.output for r in samples.ave_samples(rows, "train", root="x", labels=side, missing="").collect()} == {"v 1+x": "first\nsecond", "v2": ""}
    train = samples.ave_samples(rows, "train", root="AVE_data", labels=side).collect()
    assert [(r.vid, r.output, r.video_path) for r in train] == [("v 1+x", "first\nsecond", "AVE_data/AVE/v 1+x.mp4")]
    assert [r.vid for r in lookup.unlabelled(rows, side).collect()] == ["v2"]
    listing = spark.createDataFrame([(f"{labels}/empty.txt", 0), (f"{labels}/v 1+x.txt", 12)], "path string, length bigint")
    assert {r.vid: r.label for r in annotations.read_labels(spark, str(labels), listing=listing).collect()} == {"v 1+x": "first\nsecond", "empty": ""}
    test = {r.vid: r.output for r in samples.ave_samples(rows, "test", root="AVE_data").collect()}
    assert test["v 1+x"] == "event:Bell start_time:0 end_time:10"
    assert {r.vid: r.label for r in lookup.attach_labels(rows, side).collect()}["v2"] == "no label."


def test_captions(spark, tmp_path):
    turns = [{"from": "human", "value": "<image>\nDescribe\nit"}, {"from": "gpt", "value": "A cat"}]
    path = dump(tmp_path / "image.json", [{"image": "x/1.jpg", "conversations": turns}])
    row = samples.caption_samples(annotations.read_image_caption(spark, path), "image", root="root").first()
    assert (row.task, row.image_path, row.question, row.output) == ("image_caption", "root/x/1.jpg", "Describeit", "A cat.")
    turns = [{"value": "<video>\nWhat?"}, {"value": "Done!"}]
    path = dump(tmp_path / "video.json", [{"video": "1.mp4", "conversations": turns}])
    row = samples.caption_samples(annotations.read_video_caption(spark, path), "video", root="r").first()
    assert row.instruction == "This is a video:\n<video_start><video><video_end>\nPlease answer the question:\nWhat?" and row.output == "Done!"


def test_audio_captions_drop_the_bad_id_in_training_only(spark, tmp_path):
    rows = [{"audiocap_id": i, "youtube_id": "y", "start_time": 1.5, "caption": f"c{i}"} for i in ("12347", "1")]
    dump(tmp_path / "train.json", rows)
    dump(tmp_path / "val.json", rows)
    got = samples.audio_caption_samples(annotations.read_audio_caption(spark, str(tmp_path)), root="AC").collect()
    assert sorted(r.audio_path for r in got) == ["AC/data/1.wav", "AC/data/1.wav", "AC/data/12347.wav"]


def test_choice_sets(spark, tmp_path):
    cells = [
        "index\tquestion\tanswer\timage\tA\tB\tC\thint",
        '1\t"two\nlines ""q"""\tA\taW1n\tx\tNone\tz\tnan',
        "2\tplain\tB\taW1n\tx\ty\t\tlook",
    ]
    (tmp_path / "c.tsv").write_text("\n".join(cells) + "\n")
    df = annotations.read_choice_tsv(spark, str(tmp_path / "c.tsv"))
    first, second = df.orderBy("index").collect()
    assert first.question == 'two\nlines "q"' and first.B is None and first.hint is None and first.D is None and second.C is None
    one, two = samples.choice_samples(df.orderBy("index")).collect()
    assert "(A) x\n(C) z\n\nPlease" in one.instruction and "Hint: look\nQuestion: plain\nOptions:\n(A) x\n(B) y\n\n" in two.instruction
    assert one.conversation[0]["from"] == "human" and one.conversation[0]["value"] == one.instruction
    q = {"answer": "A", "choice_a": "1", "choice_b": "2", "choice_c": "3", "choice_d": "4", "data_id": "d.jpg", "question": "Q?"}
    seed = samples.fixed_choice_samples(annotations.read_choice_json(spark, dump(tmp_path / "s.json", {"questions": [q, q]})), root="SEED-Bench-image")
    assert seed.count() == 2 and seed.first().image_path == "SEED-Bench-image/d.jpg" and "\n(D) 4\nPlease" in seed.first().instruction


def test_question_tree(spark, tmp_path):
    sub = tmp_path / "tree" / "color"
    sub.mkdir(parents=True)
    (sub / "a b.txt").write_text("Is it red? Please answer yes or no.\tYes\nIs it blue? Please answer yes or no. No\n")
    (sub / "a b.jpg").write_bytes(b"x")
    (sub / "orphan.txt").write_text("Is it? Please answer yes or no. No")
    rows = annotations.read_qa_dir(spark, str(tmp_path / "tree")).orderBy("line").collect()
    assert [(r.subtask, r.question, r.answer) for r in rows] == [("color", "Is it red?", "Yes"), ("color", "Is it blue?", "No")]
    assert rows[0].image_path.endswith("/color/a b.jpg")
    sample = samples.yesno_samples(annotations.read_qa_dir(spark, str(tmp_path / "tree"))).first()
    assert sample.subtask == "color" and sample.conversation[0]["value"].startswith("This is an image:\n<image_start><image><image_end>\nPlease answer this")


def test_instruction_set_and_splits(spark, tmp_path):
    turns = [{"from": f, "value": v} for f, v in (("human", "<image>\n Q1 "), ("gpt", "A1"), ("gpt", "A2"), ("human", "Q2"), ("human", "Q3"))]
    path = dump(tmp_path / "i.json", [{"image": "1.jpg", "conversations": turns}, {"image": "2.jpg", "conversations": []}])
    rows = samples.instruct_samples(annotations.read_instruct_json(spark, path), root="img").collect()
    assert [(r.sample_id[:6], r.sample_id[-2:], r.output) for r in rows] == [("1.jpg#", "#0", "A1")]
    assert rows[0].instruction.endswith("<image_end>\nPlease answer this question: Q1")
    base = str(tmp_path / "splits")
    spark.range(3).write.parquet(f"{base}/val")
    assert annotations.read_split(spark, base, ["validation", "val"]).count() == 3
    with pytest.raises(FileNotFoundError):
        annotations.read_split(spark, base, "test")
    pope = spark.range(1).select(F.lit("Q?").alias("question"), F.lit("yes").alias("answer"), F.lit("s.jpg").alias("image_source"))
    assert samples.pope_samples(pope).first().image_path == "s.jpg"


def test_vocabulary_and_listing(spark, tmp_path):
    (tmp_path / "v.txt").write_text("Church bell&x&good&0&1\nchurch bell&y&good&0&1\nDog&z\n")
    vocab = annotations.read_vocab(spark, str(tmp_path / "v.txt"))
    assert {r.event for r in vocab.collect()} == {"church bell", "dog", "none"}
    numbered = {r.event: r.class_id for r in lookup.number_vocab(vocab).collect()}
    assert numbered["none"] == 0 and sorted(numbered.values()) == [0, 1, 2]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.wav").write_bytes(b"123")
    (tmp_path / "m" / "b.txt").write_bytes(b"1")
    listing = annotations.list_media(spark, str(tmp_path / "m"), pattern="*.wav")
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in listing.collect()] == [("a.wav", 3)]
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_rank_files_merge(spark, tmp_path):
    world, n = 4, 10
    rows = [{"rank": p % world, "index": p // world, "image_path": None, "question": f"q{p % n}", "answer": "Yes", "output": ["yes"]} for p in range(12)]
    for r in range(world):
        (tmp_path / f"result_{r}.jsonl").write_text("\n".join(json.dumps(x) for x in rows if x["rank"] == r))
    (tmp_path / "merged.jsonl").write_text(json.dumps(rows[0]))
    assert predictions.read_rank_files(spark, str(tmp_path)).count() == 12
    got = jobs.merge_predictions(spark, str(tmp_path), world=world, n_total=n)
    assert sorted(r.position for r in got.collect()) == list(range(n))
    with pytest.raises(Exception, match="give n_total"):  # no media names: the tail could be genuine
        jobs.merge_predictions(spark, str(tmp_path), world=world).collect()
    assert jobs.merge_predictions(spark, str(tmp_path), world=world, dedup=False).count() == 12


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("é", None), ("b", 1)], "a string, n int")
    path = str(tmp_path / "out")
    sinks.write_jsonl(df, path)
    sinks.write_jsonl(df, path)
    assert spark.read.schema("a string, n int").json(path).count() == 4
    sinks.reset_output(df, path)
    assert spark.read.schema("a string, n int").json(path).count() == 0
    rows = spark.createDataFrame([("s", i, f"i{i // 2}", "q", "Yes", "no") for i in range(6)], "subtask string, position bigint, image string, question string, gold string, pred string")
    for _ in range(2):
        sinks.write_by_subtask(rows, str(tmp_path / "pairs"))
    back = predictions.read_qa_tsv(spark, str(tmp_path / "pairs")).orderBy("position").collect()
    assert [(r.subtask, r.image, r.gold, r.position) for r in back] == [("s", f"i{i // 2}", "yes", i) for i in range(6)]
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat" / "color.txt").write_text("i1\tq\tyes\tno\nbad line\ni2\tq\tNo\tno\n")
    flat = predictions.read_qa_tsv(spark, str(tmp_path / "flat")).orderBy("position").collect()
    assert [(r.subtask, r.image, r.gold, r.position) for r in flat] == [("color", "i1", "yes", 0), ("color", "i2", "no", 1)]


def test_build_job_and_remapping(spark, tmp_path):
    path = dump(tmp_path / "avqa.json", AVQA)
    listing = spark.createDataFrame([("pre/MUSIC_AVQA_data/a.mp4",), ("b.mp3",)], "path string")
    cfg = jobs.BuildConfig(avqa=path, root="pre", listing=listing)
    row = jobs.build_samples(spark, cfg).first()
    assert (row.video_path, row.audio_path) == ("pre/MUSIC_AVQA_data/a.mp4", "b.mp3")
    assert jobs.build_samples(spark, jobs.BuildConfig()).count() == 0
    assert jobs.build_samples(spark, jobs.BuildConfig()).columns == [c.split()[0] for c in schemas.SAMPLE.split(", ")]


def test_fallback_and_existing(spark):
    listing = spark.createDataFrame([("img/a",), ("videos/b",)], "path string")
    rows = spark.createDataFrame([("img/a",), ("img/b",), ("img/c",)], "image_path string")
    got = {r.image_path: (r.media_kind, r.media_path) for r in lookup.fallback_media(rows, listing, image_root="img", video_root="videos").collect()}
    assert got == {"img/a": ("image", "img/a"), "img/b": ("video", "videos/b"), "img/c": ("blank", None)}
    have, todo = lookup.split_existing(rows, listing, path="image_path")
    assert have.count() == 1 and todo.count() == 2


def test_subset_bookkeeping(spark):
    rows = spark.createDataFrame([(0, "a"), (1, ""), (2, "b"), (3, "a"), (4, None)], "position bigint, key string")
    assert {(r.key, r.position) for r in subset.distinct_keep_first(rows, "key").collect()} == {("a", 0), ("b", 2)}
    assert subset.head_n(rows, 0).count() == 0 and subset.head_n(rows, 2).count() == 2
    order = subset.first_seen_order(rows.filter("key != ''"), "key").collect()
    assert {r.key: r.group_order for r in order} == {"a": 0, "b": 1}
    ids = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "id string")
    before, after = (spark.createDataFrame([(x,) for x in xs], "id string") for xs in ("1", "13"))
    assert subset.fetch_report(ids, before, after, key="id").first().asDict() == {"total_unique": 3, "ok": 1, "fail": 1, "skip": 1}
    assert sorted(r.id for r in subset.missing(ids, after, key="id").collect()) == ["2"]


def test_sampling(spark):
    df = spark.range(50).select(F.col("id").alias("k"))
    few = subset.sample_n(df, 20, key="k", seed=1).collect()
    assert len({r.k for r in few}) == 20 and sorted(r.draw for r in few) == list(range(20))
    many = subset.sample_n(df, 500, key="k", seed=1).collect()
    assert len(many) == 500 and len({r.draw for r in many}) == 500 and {r.k for r in many} <= set(range(50))
    tasks = df.select("k", F.lit("t").alias("task"))
    from polysift.operators.position import int_bucket

    capped = subset.cap_per_task(tasks, 5, position="k", bucket=int_bucket("k", 3), carry_over=1)
    assert sorted(r.k for r in capped.collect()) == list(range(6))


def test_normalized_rows_and_bad_json(spark, tmp_path):
    rows = spark.createDataFrame([(7, "y", "3", "c", 1)], "audiocap_id int, youtube_id string, start_time string, caption string, extra int")
    assert subset.normalize_row(rows).first().asDict() == {"audiocap_id": "7", "youtube_id": "y", "start_time": 3.0, "caption": "c"}
    (tmp_path / "bad.jsonl").write_text("{broken")
    with pytest.raises(Exception):
        predictions.read_predictions(spark, str(tmp_path / "bad.jsonl")).collect()
    with pytest.raises(ValueError):
        annotations.read_json(spark, "x", schemas.AVE, "rows")
