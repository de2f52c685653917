"""Token, label and mask columns over whole document texts; arrays are reported as digests of their elements."""

from __future__ import annotations

from pyspark.sql import functions as F

from polysift.functions import frames, models, tokens
from polysift.operators import batching, segments
from polysift.operators.position import hash_bucket, seeded_hash, with_position

from .tables import table

VOCAB = 1_000
START, END, TAG = [5, 2], [8], 1


def _lengths_tokenizer():
    return lambda texts: [[len(w) for w in t.split(" ")] for t in texts]


def _digest(c):
    c = F.col(c) if isinstance(c, str) else c
    return F.md5(F.array_join(c.cast("array<int>").cast("array<string>"), " "))


def _ids(spark, sf):
    """Word lengths of the whole text as token ids, by the native expression."""
    docs = table(spark, sf, "documents")
    return docs.withColumn("ids", F.transform(F.split("text", " ", -1), lambda w: F.length(w)))


def token_labels(spark, sf):
    docs = table(spark, sf, "documents").withColumn("reply", F.concat_ws(" ", "source", "lang"))
    rows = models.with_tokens(docs, {"p": "text", "a": "reply"}, _lengths_tokenizer)
    return rows.select(
        "doc_id", F.size("p").alias("n"),
        _digest(tokens.input_ids("p", "a")).alias("ids"),
        _digest(tokens.label_ids("p", "a")).alias("labels"),
        _digest(tokens.label_ids_eval("p")).alias("eval_labels"),
    )


def _marked(spark, sf):
    rows = _ids(spark, sf).withColumn("spans", tokens.target_spans("ids", START, END))
    return rows.withColumn("labels", tokens.span_labels("ids", "spans"))


def span_labels(spark, sf):
    return _marked(spark, sf).select("doc_id", F.size("spans").alias("spans"), _digest("labels").alias("labels"))


def media_masks(spark, sf):
    rows = _marked(spark, sf).withColumn("media", tokens.tag_mask("ids", TAG))
    rows = rows.withColumn("question", tokens.question_mask("media", "labels"))
    return rows.select(
        "doc_id",
        _digest("media").alias("media"),
        _digest(tokens.complement("media")).alias("words"),
        _digest(tokens.clear_tag("ids", TAG)).alias("cleared"),
        _digest("question").alias("question"),
        _digest(tokens.running_positions("media", masked=1)).alias("positions"),
        _digest(tokens.running_positions("media", masked=None)).alias("counts"),
    )


def _batched(spark, sf):
    """Batches and their widths from keys and lengths; the arrays move once, to meet their batch."""
    docs = _ids(spark, sf)
    keys = docs.select("doc_id", F.size("ids").alias("_n"), seeded_hash(3, "doc_id").alias("_hash"))
    placed = batching.batch_ids(with_position(keys, ["_hash", "doc_id"], bucket=hash_bucket("_hash")), 8)
    batches = batching.batch_max(placed, F.col("_n")).select("doc_id", "batch_id", "width")
    rows = docs.select("doc_id", F.col("ids").alias("input_ids"), F.transform("ids", lambda x: -x).alias("labels"))
    return rows.withColumn("media", tokens.tag_mask("input_ids", TAG)).join(batches, "doc_id")


def _padded(rows, media):
    return rows.select(
        "doc_id", "batch_id", "width", _digest("input_ids").alias("ids"), _digest("labels").alias("labels"),
        _digest(media).alias("media"), _digest("attention_mask").alias("attention"), _digest("position_ids").alias("positions"),
    )


def padded_right(spark, sf):
    return _padded(batching.pad_right(_batched(spark, sf), masks=("media",), width="width"), "media")


def padded_left(spark, sf):
    rows = _batched(spark, sf).withColumn("media", F.transform("media", lambda m: m.cast("int")))
    return _padded(batching.pad_left(rows, masks=("media",), width="width"), "media")


def _tagged(spark, sf):
    """Video and audio blocks, bracketed question, answer."""
    special = tokens.special_token_ids(VOCAB)
    block = [special[t] for m in ("video", "audio") for t in (f"<{m}_start>", f"<{m}>", f"<{m}_end>")]
    rows = _ids(spark, sf).withColumn("tail", F.array(F.length("source"), F.length("lang")))
    ids = F.concat(F.lit([*block, special["<question_start>"]]), "ids", F.lit([special["<question_end>"]]), "tail")
    labels = F.concat(F.array_repeat(F.lit(-100), F.size("ids") + 8), "tail")
    return rows.select("doc_id", ids.alias("ids"), labels.alias("labels"))


def spliced_slots(spark, sf):
    widths = {"<video>": 10, "<audio>": 4}
    rows = _tagged(spark, sf).withColumn("slots", tokens.splice_segments("ids", "labels", VOCAB, widths))
    shown = [_digest(F.col(f"slots.{f}")).alias(f) for f in ("label", "text", "video", "audio", "question")]
    ids = _digest(F.transform("slots.token", lambda t: F.coalesce(t, F.lit(0)))).alias("token")
    return rows.select("doc_id", F.size("slots").alias("n"), ids, *shown)


def special_tokens(spark, sf):
    name = F.get(F.lit(tokens.ADDED_TOKENS), (F.col("doc_id") % 13).cast("int"))
    rows = table(spark, sf, "documents").select("doc_id", name.alias("token"))
    rows = rows.withColumn("id", tokens.token_id("token", VOCAB))
    return rows.withColumn("back", tokens.token_name("id", VOCAB))


def media_codes(spark, sf):
    from polysift.functions import parse

    tag = F.concat(F.lit("a<vqgan_"), "event_id", F.lit("> <vqgan_"), F.col("user_id") * 1000, F.lit("><vqgan_x>"))
    rows = table(spark, sf, "events").select("event_id", parse.media_codes(tag).alias("codes"))
    return rows.select(
        "event_id",
        F.array_join("codes", " ").alias("codes"),
        F.array_join(tokens.shift_codes("codes", 32_000), " ").alias("shifted"),
        F.array_join(tokens.unshift_codes("codes", 100, 16_384), " ").alias("clipped"),
    )


# -- frames and signals


def frame_indices(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        *[F.array_join(frames.frames_uniform("n_chars", k), " ").alias(f"uniform_{k}") for k in (8, 10)],
        *[F.array_join(frames.frames_linspace("n_chars", k), " ").alias(f"linspace_{k}") for k in (1, 8)],
    )


def frame_draws(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars").withColumn("frames", F.floor(F.col("n_chars") / 25))
    return docs.select("doc_id", F.array_join(frames.frames_headtail("frames", 16, "doc_id", 11), " ").alias("picked"))


def frame_messages(spark, sf):
    docs = table(spark, sf, "documents").withColumn("picked", frames.frames_uniform("n_chars", 8))
    return docs.select("doc_id", frames.frame_message("n_chars", "picked", 25.0).alias("message"))


def _signals(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("signal"))


def _summary(rows):
    shown = F.array_join(F.transform("samples", lambda x: F.format_string("%.6f", F.round(x.cast("double"), 6) + F.lit(0.0))), " ")
    return rows.select("vec_id", F.col("segment").cast("bigint").alias("segment"), F.size("samples").alias("n"), F.md5(shown).alias("values"))


def signal_seconds(spark, sf):
    return _summary(segments.segments_fixed(_signals(spark, sf), rate=10))


def signal_parts(spark, sf):
    return _summary(segments.segments_equal(_signals(spark, sf), n=10))


def signal_hops(spark, sf):
    return _summary(segments.segments_hop(_signals(spark, sf), total=30, hop=3))


def clipped_signals(spark, sf):
    rows = _signals(spark, sf).withColumns(
        {"x": frames.clip_and_pad("signal", 8, min_s=1, max_s=6), "y": frames.clip_and_pad("signal", 80, min_s=1, max_s=6)}
    )
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return rows.select(
        "vec_id", F.size("x").alias("cut"), F.size("y").alias("padded"),
        F.round(total(frames.normalize("x")), 6).alias("total_x"), F.round(total(frames.normalize("y")), 6).alias("total_y"),
    )


def clip_windows(spark, sf):
    window = frames.clip_window("value")
    return table(spark, sf, "events").select("event_id", window["start"].alias("start"), window["end"].alias("end"))


def event_hops(spark, sf):
    """Events per type and hop mark: 90 s windows around every 300 s."""
    rows = segments.event_windows(table(spark, sf, "events"), hop=300, before=30, after=60)
    return rows.groupBy("mark", "event_type").agg(F.count(F.lit(1)).alias("n"))


def event_seconds(spark, sf):
    rows = segments.event_slots(table(spark, sf, "events"), seconds=600)
    rows = rows.withColumn("_start", F.col("window.start"))
    start = segments.epoch_micros(rows, "_start") / F.lit(1_000_000)
    return rows.groupBy(start.cast("bigint").alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        token_labels, span_labels, media_masks, padded_right, padded_left, spliced_slots, special_tokens, media_codes,
        frame_indices, frame_draws, frame_messages, signal_seconds, signal_parts, signal_hops, clipped_signals,
        clip_windows, event_hops, event_seconds,
    )
}

_IDS = "select *, list_transform(string_split(text, ' '), lambda w: cast(length(w) as integer)) as ids from documents"


def _md5(expr: str) -> str:
    return f"md5(array_to_string({expr}, ' '))"


_LONG = f"""
d as ({_IDS}),
t as (select doc_id, unnest(ids) as tok, generate_subscripts(ids, 1) - 1 as i from d),
m as (select *, lead(tok) over (partition by doc_id order by i) as nxt from t),
w as (select *, case when tok = 5 and nxt = 2 then i + 2 end as begin_at, case when tok = 8 then i end as close_at from m),
x as (select *, lag(begin_at, 2) over (partition by doc_id order by i) as b from w),
y as (select *, max(b) over (partition by doc_id order by i rows unbounded preceding) as bstar,
      min(close_at) over (partition by doc_id order by i rows between current row and unbounded following) as nextclose from x),
z as (select y.doc_id, y.i, y.tok, case when o.nextclose is not null and y.i <= o.nextclose then y.tok else -100 end as label,
      o.nextclose as stop from y left join y o on y.doc_id = o.doc_id and y.bstar = o.i)"""
_BATCH = f"""
d as ({_IDS}), b as (select doc_id, ids, (row_number() over (order by md5('3:' || doc_id), doc_id) - 1) // 8 as batch_id from d),
p as (select *, cast(max(len(ids)) over (partition by batch_id) as integer) as width, len(ids) as n from b),
q as (select *, list_transform(ids, lambda x: -x) as labels, list_transform(ids, lambda x: cast(x = 1 as integer)) as media from p)"""
_PAD = "list_transform(range(0, width - n), lambda z: {})"
_COMMON = "doc_id, batch_id, width"
_SIGNAL = "select vec_id, list_transform(embedding, lambda x: cast(x as double)) as s from embeddings"


def _signal_sql(cte: str) -> str:
    return f"""with e as ({_SIGNAL}), {cte}
      select vec_id, segment, cast(len(v) as integer) as n,
        md5(array_to_string(list_transform(v, lambda x: printf('%.6f', round(x, 6) + 0.0)), ' ')) as "values" from f"""


_ZERO = "list_transform(range(0, {}), lambda z: 0.0::double)"
SQL = {
    "token_labels": f"""
      with d as ({_IDS}), r as (select *, list_transform(string_split(source || ' ' || lang, ' '), lambda w: cast(length(w) as integer)) as a from d)
      select doc_id, cast(len(ids) as integer) as n, {_md5('list_concat(ids, a)')} as ids_,
        {_md5('list_concat(list_transform(ids, lambda x: -100), a)')} as labels,
        {_md5('list_transform(ids, lambda x: -100)')} as eval_labels from r""".replace("ids_", "ids"),
    "span_labels": f"""with {_LONG}
      select doc_id, cast(count(distinct stop) as integer) as spans, md5(string_agg(cast(label as varchar), ' ' order by i)) as labels
      from z group by doc_id""",
    "media_masks": f"""with {_LONG}, l as (select *, max(case when tok = 1 then i end) over (partition by doc_id) as last_media,
        sum(case when tok = 1 then 1 else 0 end) over (partition by doc_id order by i rows unbounded preceding) - 1 as c from z)
      select doc_id, md5(string_agg(case when tok = 1 then '1' else '0' end, ' ' order by i)) as media,
        md5(string_agg(case when tok = 1 then '0' else '1' end, ' ' order by i)) as words,
        md5(string_agg(cast(case when tok = 1 then 0 else tok end as varchar), ' ' order by i)) as cleared,
        md5(string_agg(case when tok <> 1 and label = -100 and i > last_media then '1' else '0' end, ' ' order by i)) as question,
        md5(string_agg(cast(case when tok = 1 then c else 1 end as varchar), ' ' order by i)) as positions,
        md5(string_agg(cast(greatest(c, 0) as varchar), ' ' order by i)) as counts
      from l group by doc_id""",
    "padded_right": f"""with {_BATCH} select {_COMMON}, {_md5('list_concat(ids, ' + _PAD.format('2') + ')')} as ids,
      {_md5('list_concat(labels, ' + _PAD.format('-100') + ')')} as labels, {_md5('list_concat(media, ' + _PAD.format('0') + ')')} as media,
      {_md5('list_concat(list_transform(ids, lambda x: 1), ' + _PAD.format('0') + ')')} as attention,
      {_md5('range(0, width)')} as positions from q""",
    "padded_left": f"""with {_BATCH} select {_COMMON}, {_md5('list_concat(' + _PAD.format('2') + ', ids)')} as ids,
      {_md5('list_concat(' + _PAD.format('-100') + ', labels)')} as labels, {_md5('list_concat(' + _PAD.format('0') + ', media)')} as media,
      {_md5('list_concat(' + _PAD.format('0') + ', list_transform(ids, lambda x: 1))')} as attention,
      {_md5('list_concat(' + _PAD.format('0::bigint') + ', range(0, n))')} as positions from q""",
    "spliced_slots": f"""
      with d as ({_IDS}), s as (select doc_id, list_concat([1004, 1003, 1005, 1007, 1006, 1008, 1009], ids, [1010, length(source), length(lang)]) as ids,
        len(ids) as k from d),
      t as (select doc_id, k, unnest(ids) as tok, generate_subscripts(ids, 1) - 1 as i from s),
      u as (select *, case when tok in (1000, 1003, 1006, 1009, 1010) then i end as cut,
        case when i >= k + 8 then tok else -100 end as label from t),
      v as (select *, min(cut) over (partition by doc_id order by i rows between current row and unbounded following) as closing from u),
      w as (select v.*, coalesce(o.tok, 0) as close_tok from v left join t o on v.doc_id = o.doc_id and v.closing = o.i),
      x as (select doc_id, i, j, case when cut is null then tok else 0 end as token, case when cut is null then label else -100 end as label,
        cast(cut is null as integer) as text, case when tok = 1003 then 1 else 0 end as video, case when tok = 1006 then 1 else 0 end as audio,
        case when cut is null and close_tok = 1010 then 1 else 0 end as question
        from w, lateral (select unnest(range(0, case when cut is null then 1 when tok = 1003 then 10 when tok = 1006 then 4 else 0 end)) as j))
      select doc_id, cast(count(*) as integer) as n, {", ".join(f"md5(string_agg(cast({c} as varchar), ' ' order by i, j)) as {c}" for c in ("token", "label", "text", "video", "audio", "question"))}
      from x group by doc_id""",
    "special_tokens": """
      with n as (select ['<image>', '<image_start>', '<image_end>', '<video>', '<video_start>', '<video_end>', '<audio>',
        '<audio_start>', '<audio_end>', '<question_start>', '<question_end>'] as names)
      select doc_id, names[doc_id % 13 + 1] as token, case when doc_id % 13 < 11 then cast(1000 + doc_id % 13 as integer) end as id,
        names[doc_id % 13 + 1] as back from documents, n""",
    "media_codes": """
      select event_id, event_id || ' ' || user_id * 1000 as codes, (event_id + 32000) || ' ' || (user_id * 1000 + 32000) as shifted,
        least(greatest(event_id - 100, 0), 16383) || ' ' || least(greatest(user_id * 1000 - 100, 0), 16383) as clipped from events""",
    "frame_indices": """select doc_id, """
    + ", ".join(
        f"array_to_string(list_transform(range(0, least({k}, n_chars)), lambda i: i * n_chars // least({k}, n_chars)), ' ') as uniform_{k}"
        for k in (8, 10)
    )
    + """, '0' as linspace_1, array_to_string(list_transform(range(0, 8), lambda i: i * (n_chars - 1) // 7), ' ') as linspace_8
      from documents""",
    "frame_draws": """
      with f as (select doc_id, n_chars // 25 as n from documents),
      i as (select doc_id, n, unnest(range(0, n)) as i from f),
      h as (select *, i >= n // 2 as tail, row_number() over (partition by doc_id, i >= n // 2 order by md5('11:' || doc_id || ':' || i), i) as rn from i),
      k as (select doc_id, string_agg(cast(i as varchar), ' ' order by i) as picked from h where rn <= least(16, n) // 2 group by doc_id)
      select doc_id, coalesce(picked, '') as picked from f left join k using (doc_id)""",
    "frame_messages": """
      with p as (select doc_id, n_chars as n, list_transform(range(0, least(8, n_chars)), lambda i: i * n_chars // least(8, n_chars)) as idx from documents)
      select doc_id, 'Vlen: ' || n || ' fps: 25.0 The video contains ' || len(idx) || ' frames sampled at '
        || array_to_string(list_transform(idx, lambda i: printf('%.1f', round_even(i / 25.0::double, 1))), ', ') || ' seconds. ' as message from p""",
    "signal_seconds": _signal_sql(
        f"""f as (select vec_id, unnest(range(0, 7)) as segment, unnest(list_transform(range(0, 7), lambda i:
        list_concat(s[i * 10 + 1:i * 10 + 10], {_ZERO.format('10 - len(s[i * 10 + 1:i * 10 + 10])')}))) as v from e)"""
    ),
    "signal_parts": _signal_sql(
        "f as (select vec_id, unnest(range(0, 10)) as segment, unnest(list_transform(range(0, 10), lambda i: s[i * 6 + 1:i * 6 + 6])) as v from e)"
    ),
    "signal_hops": _signal_sql(
        f"""f as (select vec_id, unnest(range(0, 10)) as segment, unnest(list_transform(range(0, 10), lambda i:
        case when i = 0 then list_concat({_ZERO.format('1')}, s[1:3]) else s[i * 6:i * 6 + 3] end)) as v from e)"""
    ),
    "clipped_signals": f"""with e as ({_SIGNAL}), c as (select vec_id, s[1:48] as x, list_concat(s, {_ZERO.format('16')}) as y from e)
      select vec_id, cast(len(x) as integer) as cut, cast(len(y) as integer) as padded,
        round(list_sum(list_transform(x, lambda v: (v - 15.41663::double) / 13.11164::double)), 6) as total_x,
        round(list_sum(list_transform(y, lambda v: (v - 15.41663::double) / 13.11164::double)), 6) as total_y from c""",
    "clip_windows": 'select event_id, value as "start", value + 10.0 as "end" from events',
    "event_hops": """
      with s as (select event_type, epoch_us(ts) / 1000000.0::double as t from events),
      m as (select event_type, t, cast(floor((t + 30) / 300) as bigint) * 300 as mark from s)
      select mark, event_type, count(*) as n from m where t >= mark - 30 and t < mark + 60 group by all""",
    "event_seconds": """select cast(epoch_us(ts) // 600000000 * 600 as bigint) as "start", event_type, count(*) as n from events group by all""",
}
