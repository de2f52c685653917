"""Answer parsing, benchmark scores and prediction merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from polysift import sinks
from polysift.functions import parse, text
from polysift.operators import lookup, scoring, subset
from polysift.plans import jobs
from polysift.scratch import shared_dir
from polysift.sources import predictions as readers
from polysift.sources import schemas

from .tables import ADAPTER_SQL, EVENT_TYPES, av_predictions, image_predictions, predictions, table

_LIST = "(" + ", ".join(f"'{e}'" for e in EVENT_TYPES) + ")"
_IMAGE_KEY = ("subtask", "image")


# -- typed questions


def answer_judgements(spark, sf):
    rows = scoring.judge_avqa(av_predictions(spark, sf), EVENT_TYPES)
    return rows.select("event_id", "answer", "reason", (F.col("reason").isNull() & F.col("right")).alias("right"))


def avqa_report(spark, sf):
    rows = scoring.avqa_score(av_predictions(spark, sf), EVENT_TYPES)
    return rows.withColumn("accuracy", F.round("accuracy", 6))


_JUDGED = f"""
a as ({ADAPTER_SQL}),
t as (select *, regexp_extract_all(pred_tag, '<answer>(.*?)</answer>', 1) as tags,
      lower(trim(string_split(output, '</s>')[1])) as gold from a),
j as (select *, case when len(tags) = 1 then lower(trim(tags[1])) end as answer from t),
q as (select *, case when len(tags) = 0 then 'no answer tag' when len(tags) > 1 then 'several answer tags'
      when answer not in {_LIST} then 'answer outside the vocabulary' end as reason from j)"""


# -- events over time


def _vocab(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_type").alias("event"))
    return events.unionByName(spark.range(1).select(F.lit("none").alias("event"))).distinct()


def _ave(spark, sf):
    return av_predictions(spark, sf, "gold_ave", "pred_ave")


def event_judgements(spark, sf):
    rows = scoring.judge_ave(_ave(spark, sf), _vocab(spark, sf))
    shown = F.array_join(F.transform("ranges", lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string"))), ";")
    return rows.select(
        "event_id", "gold_event", "gold_start", "gold_end", "reason",
        F.when(F.col("reason").isNull(), F.col("event")).alias("event"),
        F.when(F.col("reason").isNull(), shown).alias("ranges"),
    )


def event_slot_report(spark, sf):
    """Per second: rows, covered predictions and matches."""
    slots = scoring.ave_slots(scoring.judge_ave(_ave(spark, sf), _vocab(spark, sf)))
    return slots.groupBy(F.col("slot").cast("bigint").alias("slot"), "real").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("pred") != "none").alias("covered"), F.count_if(F.col("real") == F.col("pred")).alias("correct")
    )


def event_score(spark, sf):
    rows = scoring.ave_score(_ave(spark, sf), _vocab(spark, sf), mode=("strict", "compat"))
    return rows.withColumn("accuracy", F.round("accuracy", 6))


def event_reject_report(spark, sf):
    return scoring.parse_report(scoring.judge_ave(_ave(spark, sf), _vocab(spark, sf)))


def class_histogram(spark, sf):
    """Rows per class id; predictions outside the vocabulary are left out."""
    pred = predictions(spark, sf).select(F.coalesce(F.lower(parse.single_tag("pred_tag", "answer")), F.lit("none")).alias("event"))
    known = lookup.in_vocab(pred, _vocab(spark, sf), column="event")
    numbered = lookup.class_ids(known, lookup.number_vocab(_vocab(spark, sf)), column="event")
    return numbered.groupBy("event", "class_id").agg(F.count(F.lit(1)).alias("n"))


_AVE_SQL = f"""
a as ({ADAPTER_SQL}),
v as (select distinct event_type as event from events union select 'none'),
g as (select *, lower(trim(regexp_extract(gold_ave, 'event:(.*?)start_time', 1))) as gold_event,
  event_id % 10 as gold_start, event_id % 10 + user_id % 5 as gold_end,
  regexp_extract_all(pred_ave, '<event>(.*?)</event>', 1) as tags,
  regexp_extract_all(pred_ave, '<range>(.*?)</range>', 1) as bodies from a),
b as (select *, case when len(tags) = 1 then trim(tags[1]) end as body from g),
d as (select *, lower(body) in (select event from v) as direct,
  lower(rtrim(trim(regexp_extract(body, '^(.*?)\\(\\s*[0-9]+\\s+[0-9]+\\s*\\)', 1)), ',')) as paren,
  list_transform(list_filter(bodies, lambda x: regexp_matches(trim(x), '^\\s*[+-]?[0-9]+\\s*,\\s*[+-]?[0-9]+\\s*$')),
    lambda x: [cast(trim(string_split(x, ',')[1]) as bigint), cast(trim(string_split(x, ',')[2]) as bigint)]) as tagged,
  list_transform(regexp_extract_all(body, '\\(\\s*[0-9]+\\s+[0-9]+\\s*\\)'),
    lambda x: [cast(regexp_extract(x, '([0-9]+)\\s+([0-9]+)', 1) as bigint),
               cast(regexp_extract(x, '([0-9]+)\\s+([0-9]+)', 2) as bigint)]) as bracketed from b),
e as (select *, case when direct then tagged else bracketed end as ranges,
  case when direct then lower(body) else paren end as ev from d),
r as (select *, case when len(tags) <> 1 then 'event tag count' when direct and len(bodies) = 0 then 'no range'
  when direct and len(ranges) = 0 then 'no valid range' when not direct and len(ranges) = 0 then 'no bracketed range'
  when not direct and ev not in (select event from v) then 'event outside the vocabulary' end as reason from e),
s as (select *, case when slot between gold_start and gold_end then gold_event else 'none' end as real,
  case when len(list_filter(ranges, lambda p: p[1] <= slot and slot <= p[2])) > 0 then ev else 'none' end as pred
  from r, range(0, 10) s(slot) where reason is null)"""


# -- multiple choice and yes / no


def choice_report(spark, sf):
    preds = image_predictions(spark, sf, "gold_choice", "pred_choice")
    rows = subset.tagged_union(
        {"contains": scoring.choice_score(preds, by=("subtask",)), "exact": scoring.choice_score(preds, by=("subtask",), exact=True)},
        name="rule",
    )
    return rows.withColumns({c: F.round(c, 6) for c in ("accuracy", "accuracy_parsed")})


def yesno_report(spark, sf):
    rows = scoring.yesno_score(image_predictions(spark, sf, "gold_yn", "pred_yn"))
    return rows.withColumns({c: F.round(c, 6) for c in ("accuracy", "accuracy_parsed")})


def yesno_readings(spark, sf):
    p = F.col("pred_yn")
    return predictions(spark, sf).select(
        "event_id",
        parse.parse_yesno(p).alias("strict"),
        parse.parse_yesno_lax(p).alias("lax"),
        parse.parse_yesno_prefix(text.py_strip(p)).alias("prefix"),
        parse.label_code(parse.parse_yesno_prefix(text.py_strip(p))).alias("label"),
        parse.normalize_yesno_text(F.concat(p, F.lit("\n是 True 不是"))).alias("folded"),
        parse.parse_choice("pred_choice").alias("choice"),
    )


def _pair_rows(spark, sf):
    p = predictions(spark, sf)
    return p.select(
        F.col("event_type").alias("subtask"), F.col("user_id").cast("string").alias("image"),
        F.lower("gold_yn").alias("gold"), F.lower(text.py_strip("pred_yn")).alias("pred"), F.col("event_id").alias("position"),
    )


def confusion_report(spark, sf):
    return scoring.rates(scoring.confusion(_pair_rows(spark, sf))).withColumns({c: F.round(c, 6) for c in ("precision", "recall", "acc")})


def paired_report(spark, sf):
    rows = scoring.paired_score(_pair_rows(spark, sf), groups=[e for e in EVENT_TYPES if e != "view"])
    return rows.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "acc", "acc_plus", "score")})


def paired_job_report(spark, sf):
    """The job on merged prediction records: lax parsing, image from the path."""
    rows = jobs.score_paired(image_predictions(spark, sf, "gold_yn", "pred_yn"), groups=None)
    return rows.select("subtask", "images", "images_right", "n", "correct", F.round("score", 6).alias("score"))


def even_image_rows(spark, sf):
    return scoring.drop_odd_tail(_pair_rows(spark, sf)).select("subtask", "image", "position")


def image_pairs(spark, sf):
    return scoring.pair_rows(_pair_rows(spark, sf)).select("subtask", "image", "position", "pair")


def subtask_sizes(spark, sf):
    return scoring.subtask_counts(_pair_rows(spark, sf))


def image_order(spark, sf):
    return subset.first_seen_order(_pair_rows(spark, sf), "image")


_PAIR_SQL = f"""
a as ({ADAPTER_SQL}),
p as (select event_type as subtask, cast(user_id as varchar) as image, lower(gold_yn) as gold, lower(trim(pred_yn)) as pred,
      event_id as position from a),
l as (select *, case when pred in ('yes', 'no') then pred when contains(pred[1:4], 'yes') then 'yes'
      when contains(pred[1:4], 'no') then 'no' else 'other' end as label from p),
k as (select *, row_number() over (partition by subtask, image order by position) - 1 as rn,
      count(*) over (partition by subtask, image) as cnt from l)"""
_SUMS = """
  cast(count(*) filter (gold = 'yes' and label = 'yes') as bigint) as tp, cast(count(*) filter (gold = 'yes' and label = 'no') as bigint) as fn,
  cast(count(*) filter (gold = 'no' and label = 'yes') as bigint) as fp, cast(count(*) filter (gold = 'no' and label = 'no') as bigint) as tn,
  cast(count(*) filter (label = 'other') as bigint) as other_num, cast(count(*) filter (gold = label) as bigint) as correct, count(*) as n"""
_RATES = """
  round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) as "precision", round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) as recall,
  round(correct / n, 6) as acc"""


# -- merging shards


def _rank_files(spark, sf):
    """Shards of equal size: the first rows are repeated at the end, one folder of result files."""
    world = 7
    events = table(spark, sf, "events")
    n = events.agg(F.count(F.lit(1))).scalar()
    padded = F.floor((n + world - 1) / world) * world
    base = predictions(spark, sf).select("event_id", "gold_yn", "pred_yn", "event_type", "user_id")
    again = base.filter(F.col("event_id") < padded - n).withColumn("position", F.col("event_id") + n)
    rows = base.withColumn("position", F.col("event_id")).unionByName(again)
    records = rows.select(
        (F.col("position") % world).alias("rank"),
        F.floor(F.col("position") / world).alias("index"),
        F.col("event_type").alias("subtask"),
        F.concat(F.lit("images/"), F.col("user_id").cast("string"), F.lit(".jpg")).alias("image_path"),
        F.concat(F.lit("q"), F.col("event_id").cast("string")).alias("question"),
        F.col("gold_yn").alias("answer"),
        F.array("pred_yn").alias("output"),
    )
    path = shared_dir(spark, "ranks")
    sinks.reset_output(records, f"{path}/result-0")
    sinks.write_jsonl(records, f"{path}/result-0")
    return path, world


def merged_with_repeats(spark, sf):
    """A run whose last two rows ask the first two questions again, in a subtask of their own, and that padding follows: merged without the total."""
    path, world = _rank_files(spark, sf)
    n = table(spark, sf, "events").agg(F.count(F.lit(1))).scalar()
    once = jobs.merge_predictions(spark, path, world=world, dedup=False).filter(F.col("position") < n)
    asked = once.filter("position < 2").withColumns({"position": F.col("position") + n, "subtask": F.lit("again")})
    run = once.unionByName(asked)
    size = n + 2
    spare = F.ceil(size / world).cast("bigint") * world - size
    padded = run.unionByName(run.filter(F.col("position") < spare).withColumn("position", F.col("position") + size))
    records = padded.withColumns({"rank": F.col("position") % world, "index": F.floor(F.col("position") / world)}).drop("position")
    sinks.reset_output(records, f"{path}-repeats/result-0")
    sinks.write_jsonl(records, f"{path}-repeats/result-0")
    merged = jobs.merge_predictions(spark, f"{path}-repeats", world=world)
    return merged.select("position", "subtask", "image_path", "question", "answer", F.col("output")[0].alias("output"))


def merged_predictions(spark, sf):
    """Padded shards written, read back, merged with the total known and without it, and written once more."""
    path, world = _rank_files(spark, sf)
    n = table(spark, sf, "events").agg(F.count(F.lit(1))).scalar()
    records = readers.read_rank_files(spark, path)
    known = jobs.merge_predictions(spark, path, world=world, dedup=False).filter(F.col("position") < n)
    parts = {"total known": known, "from the tail": subset.dedup_padded(records, world=world)}
    merged = subset.tagged_union(parts, name="how")
    sinks.write_merged(merged, f"{path}-merged")
    back = spark.read.schema(merged.schema).json(f"{path}-merged")
    return back.select("how", "position", "subtask", "image_path", "question", "answer", F.col("output")[0].alias("output"))


def prediction_records(spark, sf):
    """Records of the audio-visual task written as JSON lines, read back and scored."""
    path = shared_dir(spark, "preds")
    sinks.write_jsonl(av_predictions(spark, sf).drop("event_id"), path, mode="overwrite")
    rows = scoring.avqa_score(readers.read_predictions(spark, path, schema=schemas.AV_PREDICTION), EVENT_TYPES)
    return rows.withColumn("accuracy", F.round("accuracy", 6))


QUERIES = {
    f.__name__: f
    for f in (
        answer_judgements, avqa_report, event_judgements, event_slot_report, event_score, event_reject_report, class_histogram,
        choice_report, yesno_report, yesno_readings, confusion_report, paired_report, paired_job_report, even_image_rows,
        image_pairs, subtask_sizes, image_order, merged_predictions, merged_with_repeats, prediction_records,
    )
}

_REPORT = f"""
with {_JUDGED}, z as (select modality, kind, count(*) as n, count(*) filter (contains(answer, gold)) as correct
  from q where reason is null group by all
  union all select * from (values ('Audio', 'Counting', 0, 0), ('Audio', 'Comparative', 0, 0), ('Visual', 'Counting', 0, 0),
   ('Visual', 'Location', 0, 0), ('Audio-Visual', 'Existential', 0, 0), ('Audio-Visual', 'Counting', 0, 0),
   ('Audio-Visual', 'Location', 0, 0), ('Audio-Visual', 'Comparative', 0, 0), ('Audio-Visual', 'Temporal', 0, 0))),
listed as (select * from z where (modality = 'Audio' and kind in ('Counting', 'Comparative'))
  or (modality = 'Visual' and kind in ('Counting', 'Location')) or modality = 'Audio-Visual'),
u as (select modality, kind, sum(n) as n, sum(correct) as correct from listed group by modality, kind
  union all select modality, null, sum(n), sum(correct) from listed group by modality
  union all select null, null, sum(n), sum(correct) from z)
select modality, kind, cast(n as bigint) as n, cast(correct as bigint) as correct,
  round(100.0::double * correct / nullif(n, 0), 6) as accuracy from u"""


def _share_sql(rule: str, test: str, by: str = "") -> str:
    group = f"group by {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""select {rule}{lead}count(*) as total, count(*) filter (p is null) as unparsed,
      count(*) filter ({test}) as correct, round(100.0::double * count(*) filter ({test}) / count(*), 6) as accuracy,
      round(100.0::double * count(*) filter ({test}) / nullif(count(*) filter (p is not null), 0), 6) as accuracy_parsed
      from c {group}"""


_CHOICE = """case when contains(x, 'a ') then '(a)' when contains(x, 'b ') then '(b)' when contains(x, 'c ') then '(c)'
      when contains(x, 'd ') then '(d)' when contains(x, 'e ') then '(e)' end"""
_YESNO = "case when contains(x, 'yes') then 'yes' when contains(x, 'no') then 'no' end"
_MERGED = f"""
with a as ({ADAPTER_SQL}) select how, event_id as position, event_type as subtask, 'images/' || user_id || '.jpg' as image_path,
  'q' || event_id as question, gold_yn as answer, pred_yn as output
from a, (values ('total known'), ('from the tail')) h(how)"""
SQL = {
    "answer_judgements": f"with {_JUDGED} select event_id, answer, reason, "
    "coalesce(reason is null and contains(answer, gold), false) as \"right\" from q",
    "avqa_report": _REPORT,
    "prediction_records": _REPORT,
    "event_judgements": f"""with {_AVE_SQL} select event_id, gold_event, gold_start, gold_end, reason,
      case when reason is null then ev end as event,
      case when reason is null then array_to_string(list_transform(ranges, lambda p: p[1] || '-' || p[2]), ';') end as ranges
      from r""",
    "event_slot_report": f"""with {_AVE_SQL} select slot, real, count(*) as n, count(*) filter (pred <> 'none') as covered,
      count(*) filter (real = pred) as correct from s group by slot, real""",
    "event_score": f"""with {_AVE_SQL}, t as (select (select count(*) from r) as clips,
        (select count(*) from r where reason is null) as accepted, (select count(*) from s where real = pred) as m)
      select 'strict' as mode, clips, accepted, m as correct, 10 * accepted as slots, round(m / (10 * accepted), 6) as accuracy from t
      union all select 'compat', clips, accepted, m + 10 * (clips - accepted), 10 * clips,
        round((m + 10 * (clips - accepted)) / (10 * clips), 6) from t""",
    "event_reject_report": f"with {_AVE_SQL} select coalesce(reason, 'accepted') as reason, count(*) as n from r group by all",
    "class_histogram": f"""
      with a as ({ADAPTER_SQL}), v as (select distinct event_type as event from events),
      ids as (select event, row_number() over (order by md5(event), event) as class_id from v union all select 'none', 0),
      t as (select regexp_extract_all(pred_tag, '<answer>(.*?)</answer>', 1) as tags from a),
      e as (select case when len(tags) = 1 then lower(trim(tags[1])) else 'none' end as event from t)
      select event, class_id, count(*) as n from e join ids using (event) group by all""",
    "choice_report": f"""with a as ({ADAPTER_SQL}), c as (select event_type as subtask, lower(trim(pred_choice)) as x,
        lower(gold_choice) as g, {_CHOICE} as p from a)
      {_share_sql("'contains' as rule, ", "contains(p, g)", "subtask")}
      union all {_share_sql("'exact' as rule, ", "p = g", "subtask")}""",
    "yesno_report": f"""with a as ({ADAPTER_SQL}), c as (select lower(trim(pred_yn)) as x, lower(gold_yn) as g, {_YESNO} as p from a)
      {_share_sql("", "contains(p, g)")}""",
    "yesno_readings": f"""with a as ({ADAPTER_SQL}), c as (select *, lower(trim(pred_yn)) as x from a),
      d as (select *, case when x in ('yes', 'no') then x when contains(x[1:4], 'yes') then 'yes'
        when contains(x[1:4], 'no') then 'no' else 'other' end as prefix from c)
      select event_id, {_YESNO} as strict, case when contains(x, 'yes') then 'yes' else 'no' end as lax, prefix,
        case prefix when 'yes' then 1 when 'no' then 0 else -1 end as label,
        lower(pred_yn) || 'yes yes' || 'no' as folded_raw, choice from d, lateral (select lower(trim(pred_choice)) as x2),
        lateral (select {_CHOICE.replace('x,', 'x2,')} as choice)""".replace(
        "lower(pred_yn) || 'yes yes' || 'no' as folded_raw", "lower(pred_yn) || 'yes yes no' as folded"
    ),
    "confusion_report": f"with {_PAIR_SQL}, c as (select subtask, {_SUMS} from l group by subtask) select *, {_RATES} from c",
    "paired_report": f"""
      with {_PAIR_SQL}, f as (select * from k where rn < cnt - cnt % 2 and subtask <> 'view'),
      c as (select subtask, {_SUMS} from f group by subtask),
      i as (select subtask, count(*) as images, cast(count(*) filter (r = 2) as bigint) as images_right from (
        select subtask, image, rn // 2 as pair, count(*) filter (gold = label) as r from f group by all) group by subtask),
      j as (select c.*, i.images, i.images_right, {_RATES}, images_right / images as ap, correct / n as ac from c join i using (subtask))
      select subtask, tp, fn, fp, tn, other_num, correct, n, images, images_right, "precision", recall, acc,
        round(ap, 6) as acc_plus, round(100 * ac + 100 * ap, 6) as score from j
      union all select null, null, null, null, null, null, null, null, null, null, null, null, null, null,
        round(sum(100 * ac + 100 * ap), 6) from j""",
    "paired_job_report": f"""
      with a as ({ADAPTER_SQL}), p as (select event_type as subtask, user_id, event_id, lower(gold_yn) as gold,
        case when contains(lower(pred_yn), 'yes') then 'yes' else 'no' end as label from a),
      k as (select *, row_number() over (partition by subtask, user_id order by event_id) - 1 as rn,
        count(*) over (partition by subtask, user_id) as cnt from p),
      i as (select subtask, user_id, rn // 2 as pair, count(*) filter (gold = label) as r from k where rn < cnt - cnt % 2 group by all),
      s as (select subtask, count(*) as images, cast(count(*) filter (r = 2) as bigint) as images_right, cast(2 * count(*) as bigint) as n,
        cast(sum(r) as bigint) as correct from i group by subtask),
      t as (select *, 100.0::double * correct / n + 100.0::double * images_right / images as score from s)
      select subtask, images, images_right, n, correct, round(score, 6) as score from t
      union all select null, null, null, null, null, round(sum(score), 6) from t""",
    "even_image_rows": f"with {_PAIR_SQL} select subtask, image, position from k where rn < cnt - cnt % 2",
    "image_pairs": f"with {_PAIR_SQL} select subtask, image, position, rn // 2 as pair from k",
    "subtask_sizes": "select event_type as subtask, count(*) as n from events group by all",
    "image_order": """select cast(user_id as varchar) as image, min(event_id) as first_position,
      row_number() over (order by min(event_id)) - 1 as group_order from events group by user_id""",
    "merged_predictions": _MERGED,
    "merged_with_repeats": f"""
      with a as ({ADAPTER_SQL}), n as (select count(*) as n from events)
      select event_id as position, event_type as subtask, 'images/' || user_id || '.jpg' as image_path, 'q' || event_id as question,
        gold_yn as answer, pred_yn as output from a
      union all select event_id + n, 'again', 'images/' || user_id || '.jpg', 'q' || event_id, gold_yn, pred_yn from a, n where event_id < 2""",
}
