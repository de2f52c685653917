"""Array, parsing and frame expressions against plain Python on random rows."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from polysift.functions import frames, parse, prompts, text, tokens, vectors
from polysift.operators import batching

START, END = [7, 8], [9]


def starts_of(ids, marker):
    return [i for i in range(len(ids)) if ids[i : i + len(marker)] == marker]


def brute_labels(ids):
    keep, free = [False] * len(ids), 0
    for s in starts_of(ids, START):
        if s < free:
            continue
        close = [e for e in starts_of(ids, END) if e >= s + len(START)]
        if close:
            free = close[0] + len(END)
            for i in range(s + len(START), free):
                keep[i] = True
    return [t if k else -100 for t, k in zip(ids, keep)]


def test_span_labels_match_a_scan(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([1, 2, 7, 8, 8, 9]) for _ in range(rnd.randrange(0, 40))]) for i in range(300)]
    rows += [(900, [7, 8, 1]), (901, []), (902, [7, 8, 9]), (903, [9, 7, 8, 7, 8, 1, 9, 7])]
    df = spark.createDataFrame(rows, "k int, ids array<int>")
    got = df.select("k", tokens.span_labels("ids", tokens.target_spans("ids", START, END)).alias("y")).collect()
    assert {r.k: r.y for r in got} == {k: brute_labels(ids) for k, ids in rows}


def test_span_markers_must_not_share_tokens():
    with pytest.raises(ValueError):
        tokens.target_spans(F.col("ids"), [1, 2], [2])


def test_masks_and_positions(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.randrange(4) for _ in range(rnd.randrange(0, 12))]) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, ids array<int>").withColumn("m", tokens.tag_mask("ids", 1))
    df = df.withColumn("y", F.transform("ids", lambda x: F.when(x == 2, x).otherwise(-100)))
    got = df.select(
        "*", tokens.question_mask("m", "y").alias("q"), tokens.running_positions("m", masked=1).alias("p"),
        tokens.running_positions("m", masked=None).alias("c"), tokens.complement("m").alias("t"), tokens.clear_tag("ids", 1).alias("z"),
    ).collect()
    for r in got:
        last = max([i for i, x in enumerate(r.ids) if x == 1], default=None)
        counts = np.cumsum([x == 1 for x in r.ids]).tolist() if r.ids else []
        assert r.q == [last is not None and i > last and x not in (1, 2) for i, x in enumerate(r.ids)]
        assert r.p == [c - 1 if x == 1 else 1 for c, x in zip(counts, r.ids)]
        assert r.c == [max(c - 1, 0) for c in counts]
        assert r.t == [x != 1 for x in r.ids] and r.z == [0 if x == 1 else x for x in r.ids]


def test_chat_arrays_are_those_of_the_helpers(spark):
    """In one trip, on packed ids; null and empty rows, and rows that begin or end with a marker."""
    rng = random.Random(3)
    ids = [None, [], [7, 8], [9], [7, 8, 9], [1, 7, 8, 1, 9, 9, 7, 8], *[[rng.choice([1, 2, 7, 8, 9]) for _ in range(rng.randrange(30))] for _ in range(200)]]
    packed = [(k, a, None if a is None else b"".join(x.to_bytes(4, "little") for x in a)) for k, a in enumerate(ids)]
    df = spark.createDataFrame(packed, "k int, ids array<int>, packed binary")
    whole = df.select("k", tokens.chat_arrays("packed", 1, START, END).alias("c")).select("k", "c.*")
    one = df.withColumn("image_mask", tokens.tag_mask("ids", 1)).withColumn("input_ids", tokens.clear_tag("ids", 1))
    one = one.withColumn("labels", tokens.span_labels("input_ids", tokens.target_spans("input_ids", START, END)))
    one = one.withColumns({"text_mask": tokens.complement("image_mask"), "question_mask": tokens.question_mask("image_mask", "labels")})
    got, want = ({r.k: r for r in x.select(*whole.columns).collect()} for x in (whole, one))
    assert got == want and got[0][1:] == (None,) * 5 and got[1].labels == []
    for k, a in enumerate(ids[1:], 1):
        cleared = [0 if x == 1 else x for x in a]
        last = max((i for i, x in enumerate(a) if x == 1), default=len(a))
        assert (got[k].input_ids, got[k].labels) == (cleared, brute_labels(cleared))
        assert got[k].question_mask == [x != 1 and y == -100 and i > last for i, (x, y) in enumerate(zip(a, got[k].labels))]


def test_null_ids_have_no_targets(spark):
    df = spark.createDataFrame([(0, None), (1, []), (2, [7, 8, 1, 9])], "k int, ids array<int>")
    spans = tokens.target_spans("ids", START, END)
    got = {r.k: (r.s, r.y) for r in df.select("k", spans.alias("s"), tokens.span_labels("ids", spans).alias("y")).collect()}
    assert got == {0: ([], None), 1: ([], []), 2: ([(2, 4)], [-100, -100, 1, 9])}


def test_null_ids_in_masks(spark):
    """A null id is no tag and no marker; its mask is null unless it is not behind the media."""
    df = spark.createDataFrame([(0, [None, 1, None, 5], [-100, -100, -100, 5]), (1, None, [1]), (2, [1], None)], "k int, ids array<int>, y array<int>")
    df = df.withColumn("m", tokens.tag_mask("ids", 1)).select(
        "k", "m", tokens.complement("m").alias("t"), tokens.clear_tag("ids", 1).alias("z"), tokens.question_mask("m", "y").alias("q"),
        tokens.span_labels("ids", tokens.target_spans("ids", [1], [5])).alias("s"),
    )
    got = {r.k: tuple(r)[1:] for r in df.collect()}
    assert got[0] == ([None, True, None, False], [None, False, None, True], [None, 0, None, 5], [False, False, None, False], [-100, -100, None, 5])
    assert got[1] == (None,) * 5 and got[2] == ([True], [False], [0], None, [-100])


def test_splice_opens_slots(spark):
    names = tokens.special_token_ids(100)
    assert names["<image>"] == 100 and names["<question_end>"] == 110
    rnd = random.Random(8)
    cutting = {names[t]: t for t in tokens.SPLICE_TOKENS}
    widths = {"<image>": 3, "<video>": 2, "<audio>": 1}
    rows = [(i, [rnd.choice([1, 2, 3, *cutting]) for _ in range(rnd.randrange(0, 15))]) for i in range(150)]
    df = spark.createDataFrame(rows, "k int, ids array<int>").withColumn("y", F.transform("ids", lambda x: x * 10))
    got = {r.k: r.s for r in df.select("k", tokens.splice_segments("ids", "y", 100, widths).alias("s")).collect()}
    for k, ids in rows:
        want, run = [], []
        for x in [*ids, None]:
            if x is not None and x not in cutting:
                run.append(x)
                continue
            tag = cutting.get(x)
            want += [(t, t * 10, 1, 0, 0, int(tag == "<question_end>")) for t in run]
            kind = {"<image>": (1, 0), "<video>": (1, 0), "<audio>": (0, 1)}.get(tag)
            want += [(None, -100, 0, *kind, 0)] * widths[tag] if kind else []
            run = []
        assert [tuple(s) for s in got[k]] == want


def test_padding(spark):
    rows = [(0, 0, [1, 2, 3]), (1, 0, [4]), (2, 1, [5, 6]), (3, 2, [])]
    df = spark.createDataFrame(rows, "k int, batch_id int, input_ids array<int>").withColumn("labels", F.col("input_ids"))
    df = df.withColumn("m", F.transform("input_ids", lambda x: F.lit(True)))
    right = {r.k: r for r in batching.pad_right(df, masks=("m",)).collect()}
    assert right[1].input_ids == [4, 2, 2] and right[1].labels == [4, -100, -100]
    assert right[1].attention_mask == [True, False, False] and right[1].position_ids == [0, 1, 2] and right[1].m == [True, False, False]
    left = {r.k: r for r in batching.pad_left(df.withColumn("m", F.transform("m", lambda x: x.cast("int"))), masks=("m",), pad_id=0).collect()}
    assert left[1].input_ids == [0, 0, 4] and left[1].position_ids == [0, 0, 0] and left[1].m == [0, 0, 1]
    assert left[0].position_ids == [0, 1, 2] and left[3].input_ids == []


def test_codes_and_token_names(spark):
    row = spark.range(1).select(
        parse.media_codes(F.lit("a<vqgan_12><vqgan_x><vqgan_0>")).alias("c"),
        tokens.unshift_codes(F.array(F.lit(5), F.lit(200), F.lit(99_999)), 100).alias("u"),
        tokens.shift_codes(F.array(F.lit(5)), 100).alias("s"),
        tokens.token_id(F.lit("<audio_end>"), 50).alias("i"), tokens.token_id(F.lit("word"), 50).alias("n"),
        tokens.token_name(F.lit(58), 50).alias("b"), tokens.token_name(F.lit(49), 50).alias("o"),
    ).first()
    assert (row.c, row.u, row.s, row.i, row.n, row.b, row.o) == ([12, 0], [0, 100, 16_383], [105], 58, None, "<audio_end>", None)


CASES = {
    "one": "<answer> Ten \t</answer></s>",
    "two": "<answer>a</answer><answer>b</answer>",
    "none": "no tag here",
    "broken": "<answer>a\nb</answer>",
    "return": "<answer>a\rb</answer>",
    "nbsp": "<answer> 　x\x1f</answer>",
}


def test_single_tag_keeps_exactly_one_match(spark):
    df = spark.createDataFrame(list(CASES.items()), "k string, t string")
    got = {r.k: r.a for r in df.select("k", parse.single_tag("t", "answer").alias("a")).collect()}
    for k, t in CASES.items():
        found = re.findall(r"<answer>(.*?)</answer>", t)
        assert got[k] == (found[0].strip() if len(found) == 1 else None), k


def test_ranges(spark):
    rows = [
        ("<range>1</range><range>2, 5</range>", [(2, 5)]), ("<range>1_0,2</range>", []), ("<range> -1 , +4 </range>", [(-1, 4)]),
        ("<range>1,2,3</range>", []), ("<range>1.5,2</range>", []), ("nothing", []),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "k int, t string")
    got = {r.k: [tuple(x) for x in r.a] for r in df.select("k", parse.parse_ranges("t").alias("a")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(rows)}


def test_bracketed_events(spark):
    df = spark.createDataFrame([("Dog barking, ( 1 3 )",), ("Bell,, (0 1),(4  9) x",), ("none",)], "t string")
    got = [(r.e, [tuple(x) for x in r.a]) for r in df.select(parse.paren_event("t").alias("e"), parse.parse_paren_ranges("t").alias("a")).collect()]
    assert got == [("dog barking", [(1, 3)]), ("bell", [(0, 1), (4, 9)]), ("", [])]


def test_gold_events(spark):
    df = spark.createDataFrame([("event:Church bell start_time:0 end_time:10</s>",), ("event:x start_time:a end_time:1",), ("",)], "t string")
    got = df.select(parse.event_of("t").alias("e"), parse.event_second("t", 2).alias("s"), parse.event_second("t", 1).alias("f")).collect()
    assert [tuple(r) for r in got] == [("church bell", 0, 10), ("x", None, 1), (None, None, None)]


def test_choice_and_yesno_readings(spark):
    words = ["pizza b ", "(B) ", "b x", "unknown", "maybe", "Yes.", "nothing", "the yes", "other", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "k int, w string")
    got = df.select(
        "k", parse.parse_choice("w").alias("c"), parse.parse_yesno("w").alias("y"), parse.parse_yesno_lax("w").alias("l"),
        parse.parse_yesno_prefix("w").alias("p"), parse.label_code(parse.parse_yesno_prefix("w")).alias("n"),
    ).collect()
    got = {words[r.k]: tuple(r)[1:] for r in got}
    assert got["pizza b "] == ("(a)", None, "no", "other", -1)
    assert got["b x"][0] == "(b)" and got["(B) "][0] is None
    assert got["unknown"][1] == "no" and got["maybe"][1:4] == (None, "no", "other")
    assert got["Yes."] == (None, "yes", "yes", "yes", 1) and got["nothing"][3] == "no" and got["the yes"][3] == "other"


def test_folded_words_and_contains(spark):
    row = spark.range(1).select(
        parse.normalize_yesno_text(F.lit("不是\n是 否 TRUE false")).alias("f"),
        parse.contains_answer(F.lit("ten"), F.lit("more than ten")).alias("c"),
        parse.contains_answer(F.lit("ten"), F.lit("more than ten"), exact=True).alias("e"),
        parse.answer_in_vocab(F.lit(" More than TEN ")).alias("v"),
    ).first()
    assert tuple(row) == ("noyes no yes no", True, False, True)
    assert len(parse.AVQA_ANSWERS) == 42 == len(set(parse.AVQA_ANSWERS))


def test_text_helpers(spark):
    row = spark.range(1).select(
        text.question_part(F.lit(" Is it? Please answer yes or no. Yes \n")).alias("q"),
        text.answer_part(F.lit(" Is it? Please answer yes or no. Yes \n")).alias("a"), text.answer_part(F.lit("x")).alias("n"),
        text.cut_at_eos(F.lit("a</s>b</s>")).alias("c"), text.drop_eos(F.lit("a</s>b</s>")).alias("d"),
        text.ensure_terminal_punct(F.lit("a")).alias("p"), text.ensure_terminal_punct(F.lit("a!")).alias("x"),
        text.expand_placeholder(F.lit("<image>b"), n=2).alias("i"), text.normalise_slashes(F.lit("a\\b")).alias("s"),
        text.stem(F.lit("x/y.z.jpg")).alias("t"), prompts.append_eos(F.lit("o"), "eot").alias("e"),
    ).first()
    assert tuple(row) == ("Is it?", "Yes", None, "a", "ab", "a.", "a!", "<image><image>b", "a/b", "y.z", "o<|eot_id|>")


def test_choice_prompt_lines(spark):
    df = spark.createDataFrame([("Q", "one", None, "three", None), ("Q", "one", "two", None, "look")], "q string, A string, B string, C string, h string")
    options = [(k, F.col(k)) for k in "ABC"]
    a, b = [r[0] for r in df.select(prompts.choice_prompt("q", options, F.col("h"))).collect()]
    assert a.startswith("\n This is an image:\n<image_start><image><image_end>\nQuestion: Q\nOptions:\n(A) one\n(C) three\n\nPlease select")
    assert "\nHint: look\nQuestion: Q\nOptions:\n(A) one\n(B) two\n\nPlease select" in b
    assert df.select(prompts.fixed_choice_prompt("q", options[:1])).first()[0].startswith(
        "This is an image:\n<image_start><image><image_end>. Question: Q\nOptions:\n(A) one\nPlease select"
    )


def test_frames_match_numpy(spark):
    df = spark.range(0, 400).select(F.col("id").alias("n"))
    got = df.select(
        "n", frames.frames_uniform("n", 8).alias("u"), frames.frames_linspace("n", 8).alias("l"), frames.frames_linspace("n", 1).alias("o"),
        frames.frames_headtail("n", 8, "n", 2).alias("h"),
    ).collect()
    for r in got:
        if r.n:
            k = min(8, r.n)
            assert r.u == np.arange(0, r.n, r.n / k).astype(int).tolist()
            assert r.l == np.linspace(0, r.n - 1, 8, dtype=int).tolist() and r.o == [0]
        take = min(8, r.n) // 2
        head, tail = r.h[:take], r.h[take:]
        assert head == sorted(set(head)) and all(i < r.n // 2 for i in head) and len(head) == take
        assert tail == sorted(set(tail)) and all(r.n // 2 <= i < r.n for i in tail) and len(tail) == take


def test_frame_message(spark):
    df = spark.createDataFrame([(100, 24.0), (7, 29.97)], "n bigint, fps double").withColumn("i", frames.frames_uniform("n", 4))
    for r in df.withColumn("m", frames.frame_message("n", "i", F.col("fps"))).collect():
        shown = ", ".join(str(round(i / r.fps, 1)) for i in r.i)
        assert r.m == f"Vlen: {r.n} fps: {r.fps} The video contains {len(r.i)} frames sampled at {shown} seconds. "


def test_signal_values(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([float(i) for i in range(10)],)], "s array<float>")
    got = df.select(frames.clip_and_pad("s", 4, min_s=1, max_s=2).alias("c"), frames.normalize("s", 1.0, 0.5).alias("z")).collect()
    assert got[0].c == [1.0, 2.0, 0.0, 0.0] and got[1].c == [float(i) for i in range(8)] and got[0].z == [0.0, 1.0]
    image = spark.range(1).select(frames.normalize_channels(F.array(*[F.array(F.lit(0.5))] * 3)).alias("c")).first().c
    assert np.allclose(np.ravel(image), [(0.5 - m) / s for m, s in zip(frames.IMAGE_MEAN, frames.IMAGE_STD)])
    assert tuple(spark.range(1).select(frames.clip_window(F.lit(3))).first()[0]) == (3.0, 13.0)


def test_vectors(spark):
    rows = [([3.0, 4.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 1.0]), ([float("nan"), 1.0], [1.0, 1.0]), ([float("-inf"), 1.0], [0.0, 1.0])]
    got = spark.createDataFrame(rows, "a array<float>, b array<float>").select(
        vectors.l2_normalize("a").alias("u"), vectors.dot("a", "b").alias("d"), vectors.squared_distance("a", "b").alias("s"), vectors.valid_numeric("a").alias("ok")
    ).collect()
    assert np.allclose(got[0].u, [0.6, 0.8]) and got[1].u == [0.0, 0.0] and got[0].d == 3.0 and math.isclose(got[0].s, 20.0)
    assert [r.ok for r in got] == [True, True, False, False]
