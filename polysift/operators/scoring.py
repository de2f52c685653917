"""Answer scoring. Every report is pre-aggregated by its category before totals are formed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse
from ..functions.bind import let
from .lookup import flag_known
from .position import BUCKET_ROWS, int_bucket, with_position

# The question types that have a line of their own in the audio-visual report.
AVQA_TYPES = [
    ("Audio", "Counting"), ("Audio", "Comparative"),
    ("Visual", "Counting"), ("Visual", "Location"),
    ("Audio-Visual", "Existential"), ("Audio-Visual", "Counting"), ("Audio-Visual", "Location"),
    ("Audio-Visual", "Comparative"), ("Audio-Visual", "Temporal"),
]
# Subtask groups of the paired yes / no benchmark.
PERCEPTION = ["existence", "count", "position", "color", "posters", "celebrity", "scene", "landmark", "artwork", "OCR"]
COGNITION = ["commonsense_reasoning", "numerical_calculation", "text_translation", "code_reasoning"]
SLOTS = 10
BACKGROUND = "none"


def _count_if(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def _percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


# -- typed questions -----------------------------------------------------------------------------------


def judge_avqa(preds: DataFrame, answers: list[str] | None = None, *, exact: bool = False) -> DataFrame:
    """Add ``answer``, ``reason`` (null when accepted) and ``right`` to predictions with ``output`` and ``predict``."""
    tags = F.size(parse.tag_bodies("predict", "answer"))
    answer = F.lower(parse.single_tag("predict", "answer"))
    known = F.col("answer").isin(answers or parse.AVQA_ANSWERS)
    reason = (
        F.when(F.coalesce(tags, F.lit(0)) == 0, "no answer tag")
        .when(tags > 1, "several answer tags")
        .when(~known, "answer outside the vocabulary")
    )
    judged = preds.withColumn("answer", answer).withColumn("reason", reason)
    return judged.withColumn("right", parse.contains_answer(parse.gold_text("output"), "answer", exact=exact))


def drop_unparsed(judged: DataFrame) -> DataFrame:
    """Rows without a reject reason."""
    return judged.filter(F.col("reason").isNull()).drop("reason")


def avqa_score(
    preds: DataFrame, answers: list[str] | None = None, *, exact: bool = False, types: list[tuple[str, str]] | None = None
) -> DataFrame:
    """Accuracy per (modality, kind), per modality and overall, over parsable rows only.

    Rows of unlisted types count overall but in no subtotal. A listed type without rows gets a null
    accuracy. Columns: modality, kind, n, correct, accuracy; totals have null keys.
    """
    types = types or AVQA_TYPES
    judged = drop_unparsed(judge_avqa(preds, answers, exact=exact))
    kinds = judged.groupBy(F.get("question_type", F.lit(0)).alias("modality"), F.get("question_type", F.lit(1)).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), _count_if(F.col("right")).alias("correct")
    )
    return avqa_report(kinds, types)


def avqa_report(kinds: DataFrame, types: list[tuple[str, str]] | None = None) -> DataFrame:
    """Totals from per-type counts; the input has one row per question type, so nothing large moves."""
    types = types or AVQA_TYPES
    listed = F.array(*[F.struct(F.lit(m).alias("modality"), F.lit(k).alias("kind")) for m, k in types])
    spark = kinds.sparkSession
    empty = spark.range(1).select(F.inline(listed)).select("*", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("correct"))
    rows = kinds.unionByName(empty).withColumn(
        "_listed", F.coalesce(F.array_contains(listed, F.struct("modality", "kind")), F.lit(False))
    )
    only_listed = [F.sum(F.when(F.col("_listed"), F.col(c))).alias(f"_{c}") for c in ("n", "correct")]
    totals = rows.rollup("modality", "kind").agg(
        F.sum("n").alias("n"), F.sum("correct").alias("correct"), *only_listed, F.grouping_id().alias("_level")
    )
    everything = F.col("_level") == 3
    shown = totals.filter(everything | F.col("_n").isNotNull()).select(
        "modality",
        "kind",
        *[F.when(everything, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in ("n", "correct")],
    )
    return shown.withColumn("accuracy", _percent(F.col("correct"), F.col("n")))


# -- events over time ----------------------------------------------------------------------------------


def judge_ave(preds: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add gold interval, predicted event and ranges, and ``reason`` to predictions with ``output`` and ``predict``.

    ``vocab`` has one lower-case ``event`` per row, the background class included.
    """
    tags = F.coalesce(F.size(parse.tag_bodies("predict", "event")), F.lit(0))
    rows = preds.withColumns(
        {
            "gold_event": parse.event_of("output"),
            "gold_start": parse.event_second("output", 2),
            "gold_end": parse.event_second("output", 1),
            "_tags": tags,
            "_body": parse.single_tag("predict", "event"),
        }
    )
    rows = rows.withColumns({"_direct": F.lower("_body"), "_paren": parse.paren_event("_body")})
    rows = flag_known(rows, {"gold_event": "_gold_ok", "_direct": "_direct_ok", "_paren": "_paren_ok"}, vocab)
    direct = F.col("_direct_ok")
    rows = rows.withColumns(
        {
            "event": F.when(direct, F.col("_direct")).otherwise(F.col("_paren")),
            "ranges": F.when(direct, parse.parse_ranges("predict")).otherwise(parse.parse_paren_ranges("_body")),
            "_written": F.size(parse.tag_bodies("predict", "range")),
        }
    )
    reason = (
        F.when(F.col("gold_event").isNull() | F.col("gold_start").isNull() | F.col("gold_end").isNull(), "gold_unreadable")
        .when(F.col("_tags") != 1, "event tag count")
        .when(direct & (F.col("_written") == 0), "no range")
        .when(direct & (F.size("ranges") == 0), "no valid range")
        .when(~direct & (F.size("ranges") == 0), "no bracketed range")
        .when(~direct & ~F.col("_paren_ok"), "event outside the vocabulary")
        .when(~F.col("_gold_ok"), "gold_unknown")
    )
    return rows.withColumn("reason", reason).drop(
        "_tags", "_body", "_direct", "_paren", "_gold_ok", "_direct_ok", "_paren_ok", "_written"
    )


def slot_overlap(slot: Column, ranges: Column | str) -> Column:
    """Slot lies in any of the closed ranges."""
    ranges = F.col(ranges) if isinstance(ranges, str) else ranges
    return F.exists(ranges, lambda r: (r["start"] <= slot) & (slot <= r["end"]))


def ave_slots(judged: DataFrame, slots: int = SLOTS) -> DataFrame:
    """One row per accepted clip and second with the real and the predicted class.

    The clip's judgement is bound once and its seconds are made from the bound value, null for rejected clips; the filter
    on the reason then has nothing of the parser to pull below the explode.
    """
    fields = ["reason", "gold_event", "gold_start", "gold_end", "event", "ranges"]

    def seconds(c: Column) -> Column:
        def one(slot: Column) -> Column:
            real = F.when(slot.between(c["gold_start"], c["gold_end"]), c["gold_event"]).otherwise(BACKGROUND)
            pred = F.when(slot_overlap(slot, c["ranges"]), c["event"]).otherwise(BACKGROUND)
            return F.struct(slot.alias("slot"), real.alias("real"), pred.alias("pred"))

        return F.when(c["reason"].isNull(), F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), one))

    bound = let(lambda c: seconds(c), c=F.struct(*fields))
    rows = judged.select(*[c for c in judged.columns if c not in ("slot", "real", "pred")], F.explode(bound).alias("_second"))
    return rows.select("*", "_second.slot", "_second.real", "_second.pred").drop("_second")


def ave_totals(preds: DataFrame, vocab: DataFrame, *, slots: int = SLOTS) -> DataFrame:
    """One row: clips, accepted clips and matching slots of the accepted ones. Slots are counted in place."""
    judged = judge_ave(preds, vocab)

    def same(slot: Column) -> Column:
        real = F.when(slot.between(F.col("gold_start"), F.col("gold_end")), F.col("gold_event")).otherwise(BACKGROUND)
        pred = F.when(slot_overlap(slot, "ranges"), F.col("event")).otherwise(BACKGROUND)
        return real == pred

    seconds = F.sequence(F.lit(0), F.lit(slots - 1))
    hits = F.when(F.col("reason").isNull(), F.size(F.filter(seconds, same)))
    return judged.select("reason", hits.alias("_hits")).agg(
        F.count(F.lit(1)).alias("clips"),
        _count_if(F.col("reason").isNull()).alias("accepted"),
        F.coalesce(F.sum("_hits"), F.lit(0)).cast("bigint").alias("matches"),
    )


def ave_score(
    preds: DataFrame, vocab: DataFrame, *, mode: str | tuple[str, ...] = "strict", slots: int = SLOTS
) -> DataFrame:
    """Per-second accuracy over all clips, one row per mode.

    ``strict`` divides by the slots of accepted clips. ``compat`` divides by the slots of all clips and
    counts every slot of a rejected clip as right.
    """
    modes = (mode,) if isinstance(mode, str) else mode
    clips, accepted, matches = F.col("clips"), F.col("accepted"), F.col("matches")
    parts = {
        "strict": (matches, slots * accepted),
        "compat": (matches + slots * (clips - accepted), slots * clips),
    }
    if not set(modes) <= set(parts):
        raise ValueError(f"unknown mode in {modes!r}")
    rows = [F.struct(F.lit(m).alias("mode"), parts[m][0].alias("correct"), parts[m][1].alias("slots")) for m in modes]
    scored = ave_totals(preds, vocab, slots=slots).select("clips", "accepted", F.inline(F.array(*rows)))
    return scored.withColumn("accuracy", F.col("correct") / F.nullif(F.col("slots"), F.lit(0)))


def parse_report(judged: DataFrame) -> DataFrame:
    """Accepted and rejected rows per reason."""
    return judged.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


# -- multiple choice and yes / no -----------------------------------------------------------------------


def first_output(c: str = "output") -> Column:
    """Predictions of the image benchmarks hold their text in a one-element list."""
    return F.get(c, F.lit(0))


def _share_score(preds: DataFrame, parsed: Column, gold: Column, by: tuple[str, ...], exact: bool) -> DataFrame:
    rows = preds.select(*by, parsed.alias("_p"), gold.alias("_g"))
    right = parse.contains_answer("_g", "_p", exact=exact)
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        _count_if(F.col("_p").isNull()).alias("unparsed"),
        _count_if(F.coalesce(right, F.lit(False))).alias("correct"),
    )
    return sums.withColumns(
        {
            "accuracy": _percent(F.col("correct"), F.col("total")),
            "accuracy_parsed": _percent(F.col("correct"), F.col("total") - F.col("unparsed")),
        }
    )


def choice_score(preds: DataFrame, *, by: tuple[str, ...] = (), exact: bool = False) -> DataFrame:
    """Multiple choice: accuracy over all rows, unparsed answers wrong; also over parsed rows."""
    gold = F.lower(parse.py_strip("answer"))
    return _share_score(preds, parse.parse_choice(first_output()), gold, by, exact)


def yesno_score(preds: DataFrame, *, by: tuple[str, ...] = (), exact: bool = False) -> DataFrame:
    """Yes / no: the same with the yes / no parser."""
    gold = F.lower(parse.py_strip("answer"))
    return _share_score(preds, parse.parse_yesno(first_output()), gold, by, exact)


# -- paired yes / no -------------------------------------------------------------------------------------


def bucket_pairs(preds: DataFrame) -> DataFrame:
    """Merged predictions -> subtask, image, question, gold and pred, keeping the position for pairing."""
    return preds.select(
        "subtask",
        "image_path",
        F.substring_index("image_path", "/", -1).alias("image"),
        "question",
        F.lower(parse.py_strip("answer")).alias("gold"),
        parse.parse_yesno_lax(first_output()).alias("pred"),
        "position",
    )


def pair_rows(
    rows: DataFrame, *, image: tuple[str, ...] = ("subtask", "image"), position: str = "position",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Number the rows of each image by position and cut them into consecutive pairs (column ``pair``)."""
    placed = with_position(rows, position, by=list(image), bucket=int_bucket(position, bucket_rows), name="_place")
    return placed.withColumn("pair", F.call_function("div", F.col("_place"), F.lit(2))).drop("_place")


def drop_odd_tail(
    rows: DataFrame, *, image: tuple[str, ...] = ("subtask", "image"), position: str = "position",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Drop the last row of every image with an odd number of rows."""
    bucket = int_bucket(position, bucket_rows)
    placed = with_position(rows, position, by=list(image), bucket=bucket, name="_place", total="_rows")
    odd_tail = (F.col("_place") == F.col("_rows") - 1) & (F.col("_rows") % 2 == 1)
    return placed.filter(~odd_tail).drop("_place", "_rows")


def confusion_sums() -> list[Column]:
    """Conditional counts on ``gold`` and ``label`` (the prefix-parsed prediction); "other" stays out."""
    gold, label = F.col("gold"), F.col("label")
    return [
        _count_if((gold == "yes") & (label == "yes")).alias("tp"),
        _count_if((gold == "yes") & (label == "no")).alias("fn"),
        _count_if((gold == "no") & (label == "yes")).alias("fp"),
        _count_if((gold == "no") & (label == "no")).alias("tn"),
        _count_if(label == "other").alias("other_num"),
        _count_if(gold == label).alias("correct"),
        F.count(F.lit(1)).alias("n"),
    ]


def confusion(rows: DataFrame, *, by: tuple[str, ...] = ("subtask",)) -> DataFrame:
    """TP, FN, FP, TN, other and row counts of ``gold`` against ``pred``."""
    return rows.withColumn("label", parse.parse_yesno_prefix("pred")).groupBy(*by).agg(*confusion_sums())


def rates(counts: DataFrame) -> DataFrame:
    """Precision and recall of yes (0 when undefined) and accuracy with "other" counted as wrong."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": F.coalesce(tp / F.nullif(tp + fp, F.lit(0)), F.lit(0.0)),
            "recall": F.coalesce(tp / F.nullif(tp + fn, F.lit(0)), F.lit(0.0)),
            "acc": F.col("correct") / F.nullif(F.col("n"), F.lit(0)),
        }
    )


def paired_counts(rows: DataFrame, *, image: tuple[str, ...] = ("subtask", "image"), bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Confusion counts per subtask over complete pairs, plus images whose both answers are right.

    An odd last row of an image is a pair of one, so dropping incomplete pairs drops the odd tail.
    """
    pairs = (
        pair_rows(rows.withColumn("label", parse.parse_yesno_prefix("pred")), image=image, bucket_rows=bucket_rows)
        .groupBy(*image, "pair")
        .agg(*confusion_sums())
        .filter("n = 2")
    )
    names = ["tp", "fn", "fp", "tn", "other_num", "correct", "n"]
    return pairs.groupBy("subtask").agg(
        *[F.sum(c).alias(c) for c in names],
        F.count(F.lit(1)).alias("images"),
        _count_if(F.col("correct") == 2).alias("images_right"),
    )


def eval_group_filter(rows: DataFrame, groups: list[str]) -> DataFrame:
    return rows.filter(F.col("subtask").isin(groups))


def paired_score(
    rows: DataFrame, *, groups: list[str] | None = PERCEPTION, image: tuple[str, ...] = ("subtask", "image"),
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Per subtask 100 * acc + 100 * acc_plus with all counts, and their sum as the row with a null subtask."""
    rows = rows if groups is None else eval_group_filter(rows, groups)
    table = rates(paired_counts(rows, image=image, bucket_rows=bucket_rows)).withColumn(
        "acc_plus", F.col("images_right") / F.col("images")
    )
    table = table.withColumn("score", 100 * F.col("acc") + 100 * F.col("acc_plus"))
    # One row per subtask goes in, so the total costs nothing and the table is computed once.
    kept = [F.when(F.grouping("subtask") == 0, F.max(c)).alias(c) for c in table.columns if c not in ("subtask", "score")]
    return table.rollup("subtask").agg(*kept, F.sum("score").alias("score"))


def task_counts(samples: DataFrame) -> DataFrame:
    """Rows per task and in total (null task)."""
    counts = samples.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    return counts.rollup("task").agg(F.sum("n").alias("n"))


def subtask_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("subtask").agg(F.count(F.lit(1)).alias("n"))


def vocab_frame(spark: SparkSession, events: list[str]) -> DataFrame:
    """Vocabulary table from a short list, background class included."""
    names = sorted({e.strip().lower() for e in events} | {BACKGROUND})
    return spark.range(1).select(F.explode(F.lit(names)).alias("event"))
