"""Turn pairing, chat rendering and sample projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from polysift.functions import prompts, text
from polysift.operators import conversations, lookup, scoring, subset
from polysift.sources import samples

from .tables import sql_text, table


def _pairs(spark, sf):
    return conversations.single_turn_pairs(table(spark, sf, "conversations"))


_PAIRS_SQL = """
said as (select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn) - 1 as p
         from conversations where role <> 'system'),
pairs as (select a.conv_id, a.p // 2 as pair, a.text as question, b.text as answer
          from said a join said b on a.conv_id = b.conv_id and b.p = a.p + 1
          where a.p % 2 = 0 and a.role = 'user' and b.role = 'assistant')"""
_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"
_IMAGE = "'This is an image:' || chr(10) || '<image_start><image><image_end>' || chr(10)"
_AV = (
    "'This is a video:' || chr(10) || '<video_start><video><video_end>' || chr(10) || 'This is an audio:' || chr(10) "
    "|| '<audio_start><audio><audio_end>' || chr(10)"
)
_TURN = f"{_IMAGE} || 'Please answer this question: ' || trim(replace(question, '<image>', ''), {_STRIP})"


def turn_pairs(spark, sf):
    return _pairs(spark, sf)


def instruction_records(spark, sf):
    rows = conversations.instruction_pairs(_pairs(spark, sf)).withColumn("task", F.lit("instruct"))
    rows = rows.withColumn("sample_id", F.concat_ws("#", "conv_id", "pair"))
    return conversations.sft_records(rows, template="none", style="seq2").select("instruction", "output", "task_name")


def task_totals(spark, sf):
    pairs = _pairs(spark, sf).select(F.lit("instruct").alias("task"))
    docs = table(spark, sf, "documents").select(F.concat(F.lit("caption_"), "lang").alias("task"))
    return scoring.task_counts(pairs.unionByName(docs))


def role_order_violations(spark, sf):
    return conversations.check_alternation(table(spark, sf, "conversations"), skip=())


def chat_prompts(spark, sf):
    rows = conversations.instruction_pairs(_pairs(spark, sf))
    turn = [F.struct(F.lit(w).alias("from"), F.col(c).alias("value")) for w, c in (("human", "instruction"), ("gpt", "output"))]
    rows = rows.select("conv_id", "pair", F.array(*turn).alias("conversation"))
    return conversations.render_image_chat(rows).select("conv_id", "pair", "prompt", "reject")


def plain_prompts(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        prompts.render_plain("text").alias("prompt"),
        prompts.append_eos("source", "plain").alias("plain_output"),
        prompts.append_eos("source", "seq2").alias("seq2_output"),
        prompts.append_eos("source", "eot").alias("eot_output"),
    )


def _typed(spark, sf):
    return table(spark, sf, "documents").select(
        F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("video_id"),
        F.col("doc_id").cast("string").alias("question_id"),
        F.array("lang", "source").alias("type"),
        F.concat(F.lit("MUSIC_AVQA_data\\"), F.col("doc_id").cast("string"), F.lit(".mp4")).alias("video_path"),
        F.concat(F.lit("other/"), F.col("doc_id").cast("string"), F.lit(".mp3")).alias("audio_path"),
        F.col("text").alias("question"),
        F.col("lang").alias("answer"),
        F.col("source").alias("label"),
    )


def typed_question_samples(spark, sf):
    parts = {s: samples.avqa_samples(_typed(spark, sf), s) for s in ("train", "test")}
    rows = subset.tagged_union(parts, name="split")
    return rows.select("split", "task", "vid", "qid", "video_path", "audio_path", "instruction", "output")


def _clips(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("event"), F.col("event_id").cast("string").alias("vid"),
        (F.col("event_id") % 10).alias("start_time"), (F.col("event_id") % 10 + F.col("user_id") % 5).alias("end_time"),
    )


def _clip_labels(spark, sf):
    return table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("vid"), F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("label")
    )


def event_samples(spark, sf):
    clips = _clips(spark, sf)
    parts = {
        "train": samples.ave_samples(clips, "train", root="AVE_data", labels=_clip_labels(spark, sf), missing=""),
        "test": samples.ave_samples(clips, "test", root="AVE_data"),
    }
    rows = subset.tagged_union(parts, name="split")
    return rows.select("split", "task", "vid", "video_path", "audio_path", "instruction", "output")


def labelled_clips(spark, sf):
    return lookup.attach_labels(_clips(spark, sf).select("vid", "event"), _clip_labels(spark, sf))


def caption_samples(spark, sf):
    def rows(media: str):
        first = F.concat(F.lit(f"<{media}>\n"), F.col("source"), F.lit("\nwhat is shown"))
        turns = F.array(
            F.struct(F.lit("human").alias("from"), first.alias("value")),
            F.struct(F.lit("gpt").alias("from"), F.col("text").alias("value")),
        )
        return table(spark, sf, "documents").select(
            F.concat(F.col("doc_id").cast("string"), F.lit(".jpg")).alias(media), turns.alias("conversations")
        )

    parts = [samples.caption_samples(rows(m), m, root="root") for m in ("image", "video")]
    return parts[0].unionByName(parts[1]).select("task", "image_path", "video_path", "question", "instruction", "output")


def audio_caption_samples(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("audiocap_id"), F.col("text").alias("caption"),
        F.when(F.col("lang") == "en", "train").otherwise("val").alias("split"),
    )
    out = samples.audio_caption_samples(rows, root="AudioCaps", bad_ids={"train": ["3", "4", "5"], "val": []})
    return out.select("task", "sample_id", "audio_path", "question", "instruction", "output")


def choice_prompts(spark, sf):
    e = table(spark, sf, "events")
    opt = {letter: F.when(F.col("event_id") % 5 >= i, F.concat(F.col("event_type"), F.lit(f" {i}"))) for i, letter in enumerate("ABCDE")}
    rows = e.select(
        "event_id", F.col("props").alias("question"), F.lit("A").alias("answer"), F.lit("img").alias("image"),
        *[c.alias(k) for k, c in opt.items()],
        F.when(F.col("user_id") % 2 == 0, F.col("event_type")).alias("hint"),
    )
    options = [(k, F.col(k)) for k in "ABCDE"]
    fixed = [(k, F.concat(F.lit(k), "event_type")) for k in "ABCD"]
    full = rows.select("event_id", prompts.choice_prompt("question", options, F.col("hint")).alias("prompt"))
    other = e.select("event_id", prompts.fixed_choice_prompt("props", fixed).alias("fixed_prompt"))
    return full.join(other, "event_id")


def yesno_prompts(spark, sf):
    line = F.concat(F.lit("  "), F.col("url"), F.lit(" Please answer yes or no. "), F.when(F.col("page_id") % 2 == 0, "Yes").otherwise("No"))
    rows = table(spark, sf, "pages").withColumn("line", line)
    return rows.select(
        "page_id",
        text.question_part("line").alias("question"),
        text.answer_part("line").alias("answer"),
        prompts.yesno_prompt(text.question_part("line")).alias("prompt"),
    )


def path_parts(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.basename("url").alias("base"), text.stem(F.concat("url", F.lit(".jpg"))).alias("stem"),
        text.media_path("root", "data", F.col("page_id").cast("string"), ".wav").alias("path"),
    )


def caption_rows(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").alias("audiocap_id"), F.col("source").alias("youtube_id"),
        (F.col("n_chars") % 50).cast("string").alias("start_time"), F.col("text").alias("caption"), "lang",
    )
    return subset.normalize_row(rows)


QUERIES = {
    f.__name__: f
    for f in (
        turn_pairs, instruction_records, task_totals, role_order_violations, chat_prompts, plain_prompts,
        typed_question_samples, event_samples, labelled_clips, caption_samples, audio_caption_samples,
        choice_prompts, yesno_prompts, path_parts, caption_rows,
    )
}
_AUDIO = "'This is an audio:' || chr(10) || '<audio_start><audio><audio_end>' || chr(10)"
_TAIL = sql_text(prompts.CHOICE_TAIL)
_EVENT_Q = "'<question_start>Please describe the events and time range that occurred in the video.<question_end>'"
SQL = {
    "turn_pairs": f"with {_PAIRS_SQL} select conv_id, pair, question, answer from pairs",
    "instruction_records": f"with {_PAIRS_SQL} select {_TURN} as instruction, answer || '</s>' as output, "
    "'instruct' as task_name from pairs",
    "task_totals": f"with {_PAIRS_SQL}, s as (select 'instruct' as task from pairs union all "
    "select 'caption_' || lang from documents) select task, count(*) as n from s group by rollup (task)",
    "role_order_violations": """
        select conv_id, turn, role, p as place, expected from (
          select conv_id, turn, role, p, case when p % 2 = 0 then 'user' else 'assistant' end as expected from (
            select *, row_number() over (partition by conv_id order by turn) - 1 as p
            from conversations))
        where role <> expected""",
    "chat_prompts": f"""
        with {_PAIRS_SQL}, r as (select conv_id, pair, {_TURN} as instruction, answer as output from pairs)
        select conv_id, pair, cast(null as varchar) as reject,
          replace('<s>[INST] ' || trim('<<SYS>>' || chr(10) || 'You are a helpful assistant.' || chr(10) || '<</SYS>>'
            || chr(10) || chr(10) || instruction, {_STRIP}) || ' [/INST] ' || trim(output, {_STRIP}) || ' </s>',
            '<image>', repeat('<image>', 32)) as prompt
        from r""",
    "plain_prompts": """
        select doc_id, '### System: You are a helpful assistant.' || chr(10) || '### User: ' || text || chr(10)
          || '### Assistant: ' as prompt, source || ' </s>' as plain_output, source || '</s>' as seq2_output,
          source || '<|eot_id|>' as eot_output from documents""",
    "typed_question_samples": f"""
        select split, 'avqa' as task, 'v' || doc_id as vid, cast(doc_id as varchar) as qid,
          'MUSIC_AVQA_data' || chr(92) || doc_id || '.mp4' as video_path, 'other/' || doc_id || '.mp3' as audio_path,
          {_AV} || '<question_start>Please answer this question: ' || text || '<question_end>' as instruction,
          case when split = 'train' then source else lang end as output
        from documents, (values ('train'), ('test')) s(split)""",
    "event_samples": f"""
        with c as (select *, cast(event_id as varchar) as vid from events),
        o as (select 'train' as split, vid, coalesce('quality ' || quality, '') as output from c left join labels on c.event_id = labels.doc_id
              union all select 'test', vid, 'event:' || event_type || ' start_time:' || (event_id % 10) || ' end_time:'
                || (event_id % 10 + user_id % 5) from c)
        select split, 'ave' as task, vid, 'AVE_data/AVE/' || vid || '.mp4' as video_path,
          'AVE_data/audio_data/' || vid || '.mp3' as audio_path, {_AV} || {_EVENT_Q} as instruction, output from o""",
    "labelled_clips": """
        select cast(event_id as varchar) as vid, event_type as event, coalesce('quality ' || quality, 'no label.') as label
        from events left join labels on event_id = doc_id""",
    "caption_samples": """
        with m(media) as (values ('image'), ('video'))
        select media || '_caption' as task, case when media = 'image' then 'root/' || doc_id || '.jpg' end as image_path,
          case when media = 'video' then 'root/' || doc_id || '.jpg' end as video_path,
          source || 'what is shown' as question,
          case when media = 'image' then 'This is an image:' || chr(10) || '<image_start><image><image_end>'
               else 'This is a video:' || chr(10) || '<video_start><video><video_end>' end || chr(10)
            || 'Please answer the question:' || chr(10) || source || 'what is shown' as instruction,
          case when right(text, 1) in ('.', '!', '?') then text else text || '.' end as output
        from documents, m""",
    "audio_caption_samples": f"""
        select 'audio_cap' as task, cast(doc_id as varchar) as sample_id, 'AudioCaps/data/' || doc_id || '.wav' as audio_path,
          'Please describe this audio.' as question, {_AUDIO} || 'Please describe this audio.' as instruction, text as output
        from documents where not (lang = 'en' and doc_id in (3, 4, 5))""",
    "choice_prompts": f"""
        select event_id,
          chr(10) || ' ' || {_IMAGE} || case when user_id % 2 = 0 then 'Hint: ' || event_type || chr(10) else '' end
          || 'Question: ' || props || chr(10) || 'Options:' || chr(10) || '(A) ' || event_type || ' 0'
          || case when event_id % 5 >= 1 then chr(10) || '(B) ' || event_type || ' 1' else '' end
          || case when event_id % 5 >= 2 then chr(10) || '(C) ' || event_type || ' 2' else '' end
          || case when event_id % 5 >= 3 then chr(10) || '(D) ' || event_type || ' 3' else '' end
          || case when event_id % 5 >= 4 then chr(10) || '(E) ' || event_type || ' 4' else '' end
          || chr(10) || {_TAIL} as prompt,
          'This is an image:' || chr(10) || '<image_start><image><image_end>. Question: ' || props || chr(10) || 'Options:'
          || chr(10) || '(A) A' || event_type || chr(10) || '(B) B' || event_type || chr(10) || '(C) C' || event_type
          || chr(10) || '(D) D' || event_type || {_TAIL} as fixed_prompt
        from events""",
    "yesno_prompts": f"""
        select page_id, url as question, case when page_id % 2 = 0 then 'Yes' else 'No' end as answer,
          {_IMAGE} || 'Please answer this question with yes or no, and no other content. Question: ' || url as prompt
        from pages""",
    "path_parts": r"""
        select page_id, list_last(string_split(url, '/')) as base,
          regexp_replace(list_last(string_split(url || '.jpg', '/')), '\.[^.]*$', '') as stem,
          'root/data/' || page_id || '.wav' as path from pages""",
    "caption_rows": """
        select cast(doc_id as varchar) as audiocap_id, source as youtube_id, cast(n_chars % 50 as double) as start_time,
          text as caption from documents""",
}
