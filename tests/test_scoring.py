"""Scores on hand rows for each known quirk."""

import random

import pytest
from pyspark.sql import functions as F

from polysift.operators import lookup, scoring
from polysift.plans import jobs

AV = "output string, question_type array<string>, predict string"


def avqa(spark, rows, **options):
    got = scoring.avqa_score(spark.createDataFrame(rows, AV), **options).collect()
    return {(r.modality, r.kind): (r.n, r.correct, r.accuracy) for r in got}


def test_typed_report(spark):
    rows = [
        ("ten</s>", ["Audio", "Counting"], "<answer>more than ten</answer>"),
        ("Two</s>", ["Audio", "Counting"], "<answer> TWO </answer></s>"),
        ("two", ["Audio", "Counting"], "two"),
        ("yes", ["Audio", "Comparative"], "<answer>no</answer>"),
        ("yes", ["Visual", "Odd"], "<answer>yes</answer>"),
        ("yes", ["Visual", "Location"], "<answer>banana</answer>"),
    ]
    got = avqa(spark, rows)
    assert len(got) == 13
    assert got[("Audio", "Counting")] == (2, 2, 100.0) and got[("Audio", "Comparative")] == (1, 0, 0.0)
    assert got[("Audio", None)][:2] == (3, 2) and got[("Visual", None)] == (0, 0, None)
    assert got[(None, None)] == (4, 3, 75.0)
    assert avqa(spark, rows, exact=True)[("Audio", "Counting")][:2] == (2, 1)
    reasons = scoring.parse_report(scoring.judge_avqa(spark.createDataFrame(rows, AV))).collect()
    assert {r.reason: r.n for r in reasons} == {"accepted": 4, "no answer tag": 1, "answer outside the vocabulary": 1}


def ave(spark, rows):
    return spark.createDataFrame(rows, "output string, predict string"), scoring.vocab_frame(spark, ["Dog", "church bell"])


def test_event_judgements(spark):
    gold = "event:Dog start_time:2 end_time:4</s>"
    cases = [
        (gold, "<event>Dog</event><range>2,4</range>", None),
        (gold, "<event>Dog</event>", "no range"),
        (gold, "<event>Dog</event><range>x</range>", "no valid range"),
        (gold, "<event>Church Bell, (1 2)</event>", None),
        (gold, "<event>Cat (1 2)</event>", "event outside the vocabulary"),
        (gold, "<event>Cat</event>", "no bracketed range"),
        (gold, "none", "event tag count"),
        (gold, "<event>None</event><range>0,9</range>", None),
        ("event:Cat start_time:0 end_time:1", "<event>Dog</event><range>2,4</range>", "gold_unknown"),
        ("nothing", "<event>Dog</event><range>2,4</range>", "gold_unreadable"),
    ]
    preds, vocab = ave(spark, [(o, p) for o, p, _ in cases])
    got = {(r.output, r.predict): r for r in scoring.judge_ave(preds, vocab).collect()}
    for o, p, reason in cases:
        assert got[(o, p)].reason == reason, p
    assert got[(gold, cases[3][1])].event == "church bell" and [tuple(x) for x in got[(gold, cases[3][1])].ranges] == [(1, 2)]


def test_slot_scores_in_both_modes(spark):
    rows = [
        ("event:Dog start_time:0 end_time:10", "<event>dog</event><range>0,4</range><range>8,12</range>"),
        ("event:Dog start_time:3 end_time:3", "<event>none</event><range>0,9</range>"),
        ("event:Dog start_time:3 end_time:3", "rejected"),
    ]
    preds, vocab = ave(spark, rows)
    got = {r.mode: (r.clips, r.accepted, r.correct, r.slots) for r in scoring.ave_score(preds, vocab, mode=("strict", "compat")).collect()}
    assert got == {"strict": (3, 2, 7 + 9, 20), "compat": (3, 2, 26, 30)}
    slots = scoring.ave_slots(scoring.judge_ave(preds, vocab))
    assert slots.count() == 20 and slots.filter("real = pred").count() == 16
    with pytest.raises(ValueError):
        scoring.ave_score(preds, vocab, mode="other")


def test_published_event_figure(spark):
    """402 clips, 397 accepted, 3 048 matching slots: 76.78 strictly, 77.06 with the free matches."""
    hit, miss = "<event>dog</event><range>0,9</range>", "<event>none</event><range>0,9</range>"
    gold = "event:dog start_time:0 end_time:9"
    rows = [(gold, hit)] * 304 + [(gold, "<event>dog</event><range>0,7</range>")] + [(gold, miss)] * 92 + [(gold, "x")] * 5
    preds, vocab = ave(spark, rows)
    got = {r.mode: round(100 * r.accuracy, 2) for r in scoring.ave_score(preds, vocab, mode=("strict", "compat")).collect()}
    assert got == {"strict": 76.78, "compat": 77.06}


IMG = "answer string, output array<string>"


def test_choice_and_yesno_shares(spark):
    rows = [("A", ["a x"]), ("(B)", ["(b ) "]), ("A", ["pizza b"]), ("C", ["???"]), ("B", ["b"])]
    got = jobs.score_choice(spark.createDataFrame(rows, IMG)).first()
    # "pizza b" reads as a, and a bare letter without a blank behind it reads as nothing.
    assert (got.total, got.unparsed, got.correct) == (5, 2, 3)
    rows = [("yes", ["Yes."]), ("no", ["unknown"]), ("no", ["maybe"]), (None, ["yes"])]
    got = jobs.score_yesno(spark.createDataFrame(rows, IMG)).first()
    assert (got.total, got.unparsed, got.correct, got.accuracy) == (4, 1, 2, 50.0)
    empty = jobs.score_yesno(spark.createDataFrame([], IMG)).first()
    assert (empty.total, empty.accuracy) == (0, None)


PAIR = "subtask string, image string, gold string, pred string, position bigint"


def test_odd_last_row_is_dropped_by_position(spark):
    rows = [("scene", "i", "yes", "yes", p) for p in (2, 0, 1)] + [("scene", "j", "yes", "no", p) for p in (3, 4)]
    df = spark.createDataFrame(rows, PAIR)
    for width in (1, 2, 65_536):
        kept = scoring.drop_odd_tail(df, bucket_rows=width).collect()
        assert sorted(r.position for r in kept) == [0, 1, 3, 4]
    got = {r.subtask: r for r in scoring.paired_score(df, bucket_rows=1).collect()}
    assert (got["scene"].images, got["scene"].images_right, got["scene"].n, got["scene"].acc) == (2, 1, 4, 0.5)
    assert got[None].score == got["scene"].score == 100.0


def test_paired_score_against_a_loop(spark):
    rnd = random.Random(2)
    tasks = [*scoring.PERCEPTION[:3], "code_reasoning"]
    rows = []
    for p in range(1_200):
        # One image holds a third of the rows.
        task, image = (tasks[0], "hot") if p % 3 == 0 else (rnd.choice(tasks), f"i{rnd.randrange(60)}")
        rows.append((task, image, rnd.choice(["yes", "no"]), rnd.choice(["yes", "no", "maybe", "no way"]), p))
    got = {r.subtask: r for r in scoring.paired_score(spark.createDataFrame(rows, PAIR), bucket_rows=16).collect()}
    total = 0.0
    for task in tasks[:3]:
        groups = {}
        for t, i, g, x, p in rows:
            if t == task:
                groups.setdefault(i, []).append((p, g, "no" if x == "no way" else x if x in ("yes", "no") else "other"))
        pairs = []
        for g in groups.values():
            g.sort()
            pairs += [(g[k], g[k + 1]) for k in range(0, len(g) - 1, 2)]
        flat = [r for pair in pairs for r in pair]
        tp = sum(g == x == "yes" for _, g, x in flat)
        fp = sum(g == "no" and x == "yes" for _, g, x in flat)
        acc = sum(g == x for _, g, x in flat) / len(flat)
        plus = sum(all(g == x for _, g, x in pair) for pair in pairs) / len(pairs)
        r = got[task]
        assert (r.tp, r.fp, r.images, r.other_num) == (tp, fp, len(pairs), sum(x == "other" for *_, x in flat))
        assert r.acc == pytest.approx(acc) and r.precision == pytest.approx(tp / (tp + fp)) and r.score == pytest.approx(100 * acc + 100 * plus)
        total += r.score
    assert set(got) == {*tasks[:3], None} and got[None].score == pytest.approx(total)


def test_scene_uses_its_own_rows(spark):
    rows = [(0, p, s, f"d/{s}{p // 2}.jpg", f"q{p}", "Yes", [o], p) for p, (s, o) in enumerate([("posters", "yes")] * 2 + [("scene", "no")] * 2)]
    df = spark.createDataFrame(rows, "rank bigint, index bigint, subtask string, image_path string, question string, answer string, output array<string>, position bigint")
    got = {r.subtask: r.score for r in jobs.score_paired(df).collect()}
    assert got == {"posters": 200.0, "scene": 0.0, None: 200.0}


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "task string")
    assert {r.task: r.n for r in scoring.task_counts(df).collect()} == {"a": 2, "b": 1, None: 3}
    assert {r.subtask: r.n for r in scoring.subtask_counts(df.withColumnRenamed("task", "subtask")).collect()} == {"a": 2, "b": 1}
    assert scoring.eval_group_filter(df.withColumnRenamed("task", "subtask"), ["b"]).count() == 1


def test_known_names_are_joined(spark):
    rows = [("event:Dog start_time:2 end_time:4", "<event>dog</event><range>2,4</range>"), ("event:Cat start_time:2 end_time:4", "<event>x (1 2)</event>")]
    _, vocab = ave(spark, rows)
    flags = {"output": "a", "predict": "b"}
    known = spark.createDataFrame([("dog",), ("x",), (None,)], "output string").withColumn("predict", F.lit("none"))
    found = lookup.flag_known(known, flags, vocab.unionByName(vocab)).collect()
    assert {r.output: (r.a, r.b) for r in found} == {"dog": (True, True), "x": (False, True), None: (False, True)} and len(found) == 3
