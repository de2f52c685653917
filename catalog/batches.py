"""Sharding, batching, subset building, listings and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from polysift import sinks
from polysift.functions import models, prompts
from polysift.operators import batching, lookup, scoring, subset
from polysift.operators.position import hash_bucket, int_bucket, seeded_hash, with_position
from polysift.plans import jobs
from polysift.scratch import shared_dir
from polysift.sources import annotations, predictions, samples

from .scoring import _PAIR_SQL, _pair_rows
from .tables import sql_text, table

WORLD, SIZE, SEED = 3, 7, 5


def _placed(spark, sf, seed=SEED):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    keyed = docs.withColumn("_hash", seeded_hash(seed, "doc_id"))
    return with_position(keyed, ["_hash", "doc_id"], bucket=hash_bucket("_hash")).drop("_hash")


def ordered_documents(spark, sf):
    """Places of documents by source, length and id within their language: text, repeated and sparse keys, without a bucket expression."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return with_position(docs, ["source", "n_chars", "doc_id"], by=["lang"], name="place", total="rows").select("doc_id", "lang", "place", "rows")


def strided_shards(spark, sf):
    rows = batching.shard_strided(_placed(spark, sf), 7)
    return rows.select("doc_id", "position", F.col("shard").cast("bigint").alias("shard"), "slot")


def fixed_batches(spark, sf):
    rows = batching.batch_max(batching.batch_ids(_placed(spark, sf), 8), F.col("n_chars"))
    return rows.select("doc_id", "batch_id", "width")


def length_batches(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    rows = batching.length_grouped(docs, key="doc_id", length="n_chars", batch_size=SIZE, world=WORLD, seed=SEED)
    return rows.select("doc_id", "mega", F.col("chunk").cast("bigint").alias("chunk"), F.col("place").cast("bigint").alias("place"))


def modality_batches(spark, sf):
    signed = F.when(F.col("lang") == "en", F.col("n_chars")).otherwise(-F.col("n_chars"))
    docs = table(spark, sf, "documents").select("doc_id", signed.alias("signed"))
    rows = batching.modality_grouped(docs, key="doc_id", signed_length="signed", batch_size=SIZE, world=WORLD, seed=SEED)
    return rows.select("doc_id", "position")


# -- subsets


def first_rows(spark, sf):
    """A fifth of the rows, by position; the row count comes from the table."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    fifth = F.floor(docs.agg(F.count(F.lit(1))).scalar() / 5)
    placed = with_position(docs, "doc_id", bucket=int_bucket("doc_id", 1_000), first=fifth)
    return subset.head_n(placed, fifth).select("doc_id", "source", "position")


def capped_sources(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("task"))
    return subset.cap_per_task(docs, 20, position="doc_id", bucket=int_bucket("doc_id"), carry_over=1)


def random_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return subset.sample_n(docs, 100, key="doc_id", seed=SEED)


def oversampled_rows(spark, sf):
    docs = table(spark, sf, "benchmark").select("item_id")
    return subset.sample_n(docs, 1_000, key="item_id", seed=SEED)


def first_of_each(spark, sf):
    docs = table(spark, sf, "documents").withColumn("media", F.when(F.col("doc_id") % 9 > 0, F.concat_ws("/", "source", "lang")).otherwise(""))
    return subset.distinct_keep_first(docs, "media", position="doc_id", payload=("n_chars",))


def both_splits(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.lit("web").alias("lang"))
    rows = subset.concat_splits(docs, pages)
    return rows.withColumn("split_order", F.col("split_order").cast("bigint"))


def media_union(spark, sf):
    images = table(spark, sf, "documents").select(F.concat(F.lit("image/"), "source").alias("path")).distinct()
    videos = table(spark, sf, "pages").select("url").withColumnRenamed("url", "path")
    return subset.tagged_union({"image": images, "video": videos})


# -- listings


def _listing(spark, sf, root, ext, condition="true"):
    rows = table(spark, sf, "labels").filter(condition)
    return rows.select(F.concat(F.lit(root), F.col("doc_id").cast("string"), F.lit(ext)).alias("path"), F.lit(1).alias("length"))


def remapped_paths(spark, sf):
    """Some paths exist as they are, some under the root, some nowhere; half are written with backslashes."""
    docs = table(spark, sf, "documents")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".mp4"))
    path = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("AVE_data/"), name))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("MUSIC_AVQA_data\\"), name))
        .otherwise(F.concat(F.lit("elsewhere/"), name))
    )
    rows = docs.select("doc_id", path.alias("video_path"))
    listing = _listing(spark, sf, "prepared_datasets/AVE_data/", ".mp4", "quality = 1")
    listing = listing.unionByName(_listing(spark, sf, "prepared_datasets/MUSIC_AVQA_data/", ".mp4"))
    listing = listing.unionByName(_listing(spark, sf, "AVE_data/", ".mp4", "toxic = 1"))
    return lookup.remap_paths(rows, listing, column="video_path", root="prepared_datasets", prefixes=jobs.KNOWN_PREFIXES)


def fallback_paths(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("SEED-Bench-image/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("image_path")
    )
    listing = _listing(spark, sf, "SEED-Bench-image/", ".jpg", "quality = 1").unionByName(_listing(spark, sf, "videos/", ".jpg"))
    return lookup.fallback_media(rows, listing, image_root="SEED-Bench-image", video_root="videos")


def fetch_status(spark, sf):
    manifest = table(spark, sf, "documents").select(F.concat(F.lit("d/"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("path"), "doc_id")
    have, todo = lookup.split_existing(manifest, _listing(spark, sf, "d/", ".wav"))
    return subset.tagged_union({"have": have, "todo": todo}, name="status")


def fetch_totals(spark, sf):
    manifest = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    manifest = manifest.unionByName(manifest)
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality")
    todo, report = jobs.prepare_subset(
        manifest.withColumn("position", F.col("id")), labels.filter("quality = 1"), labels, n=2**62, key="id", position="position"
    )
    missing = subset.missing(manifest, labels, key="id")
    return report.select(
        "*", missing.agg(F.count(F.lit(1))).scalar().alias("missing"), todo.agg(F.count(F.lit(1))).scalar().alias("todo")
    )


def missing_ids(spark, sf):
    return subset.missing(table(spark, sf, "documents"), table(spark, sf, "labels"), key="doc_id")


# -- written and read back


def written_subset(spark, sf):
    """Subset under two names, id list and failure list, all read back."""
    path = shared_dir(spark, "subset")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    sinks.write_subset(docs, path, name="subset.json", default_name="default.json")
    sinks.write_ids(missing_ids(spark, sf), f"{path}/missing", column="doc_id")
    failures = missing_ids(spark, sf).select(
        F.lit("image").alias("kind"), F.concat(F.lit("p/"), F.col("doc_id").cast("string")).alias("path"), F.lit("no\tfile").alias("error")
    )
    sinks.write_failures(failures, f"{path}/failed")
    schema = "doc_id bigint, text string, lang string"
    parts = {
        name: annotations.read_json(spark, f"{path}/{name}", schema, "lines").select(F.col("doc_id").cast("string").alias("id"), F.md5("text").alias("body"))
        for name in ("subset.json", "default.json")
    }
    parts["missing"] = spark.read.text(f"{path}/missing").select(F.col("value").alias("id"), F.lit("").alias("body"))
    failed = spark.read.csv(f"{path}/failed", sep="\t", schema="kind string, path string, error string")
    parts["failed"] = failed.select(F.col("path").alias("id"), F.concat_ws("|", "kind", "error").alias("body"))
    return subset.tagged_union(parts, name="file")


def written_pairs(spark, sf):
    """Scored pairs written per subtask, read back in order and scored."""
    path = shared_dir(spark, "pairs")
    rows = scoring.drop_odd_tail(_pair_rows(spark, sf).withColumn("question", F.concat(F.lit("q"), F.col("position").cast("string"))))
    sinks.write_by_subtask(rows, path)
    back = predictions.read_qa_tsv(spark, path, escaped=True)
    table_ = scoring.paired_score(back, groups=None)
    return table_.select("subtask", "images", "images_right", "n", "correct", F.round("score", 6).alias("score"))


def built_samples(spark, sf):
    """Annotation sets written as JSON lines, read back by every reader, and counted per task with a text digest."""
    base = shared_dir(spark, "sets")
    docs, events = table(spark, sf, "documents"), table(spark, sf, "events")
    key = F.col("doc_id").cast("string")
    turns = F.array(
        F.struct(F.lit("human").alias("from"), F.concat(F.lit("<image>\n"), "source").alias("value")),
        F.struct(F.lit("gpt").alias("from"), F.col("text").alias("value")),
        F.struct(F.lit("human").alias("from"), F.col("lang").alias("value")),
    )
    sinks.write_annotations(
        docs.select(key.alias("video_id"), key.alias("question_id"), F.array("lang", "source").alias("type"), key.alias("video_path"),
                    key.alias("audio_path"), F.col("text").alias("question"), F.col("lang").alias("answer"), F.col("source").alias("label")),
        f"{base}/avqa")
    sinks.write_annotations(
        events.select(F.col("event_type").alias("event"), F.col("event_id").cast("string").alias("vid"),
                      (F.col("event_id") % 10).alias("start_time"), (F.col("event_id") % 10 + 1).alias("end_time")), f"{base}/ave")
    sinks.write_annotations(docs.select(key.alias("image"), turns.alias("conversations")), f"{base}/image")
    sinks.write_annotations(docs.select(key.alias("video"), turns.alias("conversations")), f"{base}/video")
    for name, keep in (("train.json", "lang = 'en'"), ("val.json", "lang != 'en'")):
        sinks.write_annotations(
            docs.filter(keep).select(key.alias("audiocap_id"), F.col("source").alias("youtube_id"), F.lit(1.0).alias("start_time"), F.col("text").alias("caption")),
            f"{base}/audio/{name}")
    cfg = jobs.BuildConfig(
        split="test", avqa=f"{base}/avqa", ave=f"{base}/ave", image_caption=f"{base}/image", video_caption=f"{base}/video",
        audio_caption=f"{base}/audio", instruct=f"{base}/image", image_root="root", layout="lines",
    )
    rows = jobs.build_samples(spark, cfg)
    return rows.groupBy("task").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("instruction")).alias("instruction_chars"), F.sum(F.length("output")).alias("output_chars")
    )


def choice_files(spark, sf):
    """Choice questions written tab-separated and as JSON lines, read back and prompted."""
    base = shared_dir(spark, "choice")
    docs = table(spark, sf, "documents")
    cells = docs.select(
        F.col("doc_id").cast("string").alias("index"), F.col("text").alias("question"), F.lit("A").alias("answer"), F.lit("aW1n").alias("image"),
        F.col("source").alias("A"), F.col("lang").alias("B"), F.when(F.col("doc_id") % 2 == 0, F.lit("None")).otherwise("c").alias("C"),
        F.when(F.col("doc_id") % 3 == 0, F.lit('say "d"')).alias("D"), F.when(F.col("doc_id") % 4 == 0, F.col("lang")).alias("hint"),
    )
    cells.write.csv(f"{base}/tsv", sep="\t", header=True, quote='"', escape='"')
    wide = samples.choice_samples(annotations.read_choice_tsv(spark, f"{base}/tsv"))
    plain = docs.select(
        F.lit("A").alias("answer"), *[F.col(c).alias(f"choice_{k}") for k, c in zip("abcd", ("source", "lang", "source", "lang"))],
        F.col("doc_id").cast("string").alias("data_id"), F.col("text").alias("question"),
    )
    sinks.write_annotations(plain, f"{base}/json")
    fixed = samples.fixed_choice_samples(annotations.read_choice_json(spark, f"{base}/json", layout="lines"), root="SEED-Bench-image")
    rows = wide.unionByName(fixed)
    return rows.select("task", "image_path", F.md5("instruction").alias("prompt"), "output")


def split_files(spark, sf):
    """Columnar splits, the second one under its alternative name, and the class list file."""
    base = shared_dir(spark, "splits")
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("question"), F.col("lang").alias("answer"))
    docs.filter("lang = 'en'").write.parquet(f"{base}/train")
    docs.filter("lang != 'en'").write.parquet(f"{base}/val")
    both = subset.concat_splits(annotations.read_split(spark, base, "train"), annotations.read_split(spark, base, ["validation", "val"]))
    events = table(spark, sf, "events")
    events.select(F.concat_ws("&", F.initcap("event_type"), F.col("event_id").cast("string"), F.lit("good")).alias("value")).write.text(f"{base}/classes")
    vocab = annotations.read_vocab(spark, f"{base}/classes")
    rows = both.groupBy("split", "answer").agg(F.count(F.lit(1)).alias("n"))
    names = vocab.select(F.lit("vocab").alias("split"), F.col("event").alias("answer"), F.lit(1).cast("bigint").alias("n"))
    return rows.unionByName(names)


# -- caller's Python


def decoded_contents(spark, sf):
    """Document bytes through a caller's decoder."""
    rows = table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))

    def make():
        return lambda content: {"n_bytes": len(content), "n_lines": content.count(b"\n")}

    return models.map_media(rows, make, "n_bytes bigint, n_lines bigint", key="doc_id")


def predicted_texts(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text")

    def make():
        return lambda texts: [f"<answer>{len(t)}</answer>" for t in texts]

    return models.batch_predict(rows, "text", make).select("doc_id", "predict")


def packed_batches(spark, sf):
    """Samples tokenized, batched and padded by the job; digests of the padded arrays."""
    docs = table(spark, sf, "documents")
    rows = docs.select(F.lit("doc").alias("task"), F.col("doc_id").alias("sample_id"), F.col("text").alias("instruction"), F.col("source").alias("output"))

    def make():
        return lambda texts: [[len(w) for w in t.split(" ")] for t in texts]

    out = jobs.pack_batches(rows, make, jobs.PackConfig(batch_size=8, seed=SEED))
    digest = lambda c: F.md5(F.array_join(c, " "))
    return out.select("sample_id", "batch_id", "width", digest("input_ids").alias("ids"), digest("labels").alias("labels"))


QUERIES = {
    f.__name__: f
    for f in (
        ordered_documents, strided_shards, fixed_batches, length_batches, modality_batches, first_rows, capped_sources, random_rows, oversampled_rows,
        first_of_each, both_splits, media_union, remapped_paths, fallback_paths, fetch_status, fetch_totals, missing_ids,
        written_subset, written_pairs, built_samples, choice_files, split_files, decoded_contents, predicted_texts, packed_batches,
    )
}

_P = f"p as (select doc_id, n_chars, lang, row_number() over (order by md5('{SEED}:' || doc_id), doc_id) - 1 as position from documents)"


def _dealt(side: str) -> str:
    """Chunk and place per row; ``side`` names the group column."""
    zero = "[" + ", ".join(["0"] * WORLD) + "]"
    return f"""
h as (select doc_id, n_chars, {side} as side, row_number() over (partition by {side} order by md5('{SEED}:' || doc_id), doc_id) - 1 as p from documents),
m as (select *, p // {WORLD * SIZE} as mega from h),
r as (select *, row_number() over (partition by side, mega order by n_chars desc, p) - 1 as rk, count(*) over (partition by side, mega) as sz from m),
g as (select distinct side, mega, cast(-1 as bigint) as rk, cast(0 as bigint) as chunk, cast(0 as bigint) as place,
        cast({zero} as double[]) as load, cast({zero} as bigint[]) as cnt from r where sz % {WORLD} = 0
      union all
      select side, mega, rk, target - 1, cnt[target], list_transform(load, lambda x, i: case when i <> target then x
          when cnt[target] + 1 = sz // {WORLD} then 'infinity'::double else x + n_chars end),
        list_transform(cnt, lambda x, i: case when i = target then x + 1 else x end)
      from (select r.*, g.load, g.cnt, list_position(g.load, list_min(g.load)) as target from g
            join r on r.side = g.side and r.mega = g.mega and r.rk = g.rk + 1)),
dealt as (select r.side, r.mega, r.doc_id, case when r.sz % {WORLD} = 0 then g.chunk else r.rk % {WORLD} end as chunk,
        case when r.sz % {WORLD} = 0 then g.place else r.rk // {WORLD} end as place
      from r left join g on g.side = r.side and g.mega = r.mega and g.rk = r.rk)"""


_IMG = sql_text(prompts.IMAGE_BLOCK.rstrip("\n"))
_TAIL = sql_text(prompts.CHOICE_TAIL)
_AV_LEN = len("This is a video:\n<video_start><video><video_end>\nThis is an audio:\n<audio_start><audio><audio_end>\n")
_Q_LEN = len("<question_start>Please answer this question: <question_end>")
_E_LEN = len("<question_start>Please describe the events and time range that occurred in the video.<question_end>")
_I_LEN = len("This is an image:\n<image_start><image><image_end>\n")
_V_LEN = len("This is a video:\n<video_start><video><video_end>\n")
_A_LEN = len("This is an audio:\n<audio_start><audio><audio_end>\nPlease describe this audio.")
_PUNCT = "length(text) + case when right(text, 1) in ('.', '!', '?') then 0 else 1 end"
SQL = {
    "ordered_documents": """select doc_id, lang, row_number() over (partition by lang order by source, n_chars, doc_id) - 1 as place,
      count(*) over (partition by lang) as "rows" from documents""",
    "written_pairs": f"""
      with {_PAIR_SQL}, i as (select subtask, image, rn // 2 as pair, count(*) filter (gold = label) as r from k where rn < cnt - cnt % 2 group by all),
      s as (select subtask, count(*) as images, cast(count(*) filter (r = 2) as bigint) as images_right, cast(2 * count(*) as bigint) as n,
        cast(sum(r) as bigint) as correct from i group by subtask),
      t as (select *, 100.0::double * correct / n + 100.0::double * images_right / images as score from s)
      select subtask, images, images_right, n, correct, round(score, 6) as score from t
      union all select null, null, null, null, null, round(sum(score), 6) from t""",
    "strided_shards": f"with {_P} select doc_id, position, position % 7 as shard, position // 7 as slot from p",
    "fixed_batches": f"with {_P} select doc_id, position // 8 as batch_id, max(n_chars) over (partition by position // 8) as width from p",
    "length_batches": f"with recursive {_dealt('true')} select doc_id, mega, chunk, place from dealt",
    "modality_batches": f"""
      with recursive {_dealt("lang = 'en'")},
      l as (select side, max(mega) as last from dealt group by side),
      o as (select side, mega, row_number() over (order by md5('{SEED}:mega:' || case when side then 'true' else 'false' end || ':' || mega), side, mega) - 1 as round
            from (select distinct d.side, d.mega from dealt d join l on l.side = d.side and d.mega < l.last)),
      x as (select d.*, coalesce(o.round, (select count(*) from o)) as round, o.round is null as tail from dealt d left join o on o.side = d.side and o.mega = d.mega)
      select doc_id, round * {WORLD * SIZE} + row_number() over (partition by round order by case when tail then 0 else chunk end,
        case when tail then 0 else place end, doc_id) - 1 as position from x""",
    "first_rows": """
      with p as (select doc_id, source, row_number() over (order by doc_id) - 1 as position from documents)
      select * from p where position < (select count(*) // 5 from documents)""",
    "capped_sources": """select doc_id, task from (select doc_id, source as task, row_number() over (partition by source order by doc_id) as rn
      from documents) where rn <= 21""",
    "oversampled_rows": f"""
      with p as (select item_id, row_number() over (order by md5('{SEED}:' || item_id), item_id) - 1 as place, count(*) over () as n from benchmark),
      d as (select i as draw, cast('0x' || substr(md5('{SEED}:' || i), 1, 15) as bigint) % (select count(*) from benchmark) as pick from range(0, 1000) r(i))
      select p.item_id, d.draw from d join p on p.place = case when p.n >= 1000 then d.draw else d.pick end""",
    "random_rows": f"""select doc_id, source, draw from (select doc_id, source,
      row_number() over (order by md5('{SEED}:' || doc_id), doc_id) - 1 as draw from documents) where draw < 100""",
    "first_of_each": """
      select media, min(doc_id) as doc_id, arg_min(n_chars, doc_id) as n_chars
      from (select *, case when doc_id % 9 > 0 then source || '/' || lang else '' end as media from documents) where media <> '' group by media""",
    "both_splits": """select doc_id, lang, 'train' as split, cast(0 as bigint) as split_order from documents
      union all select page_id, 'web', 'val', 1 from pages""",
    "media_union": "select distinct 'image/' || source as path, 'image' as kind from documents union all select url, 'video' from pages",
    "remapped_paths": """
      select d.doc_id, case
        when d.doc_id % 3 = 0 and coalesce(l.toxic, 0) = 1 then 'AVE_data/' || d.doc_id || '.mp4'
        when d.doc_id % 3 = 0 and coalesce(l.quality, 0) = 1 then 'prepared_datasets/AVE_data/' || d.doc_id || '.mp4'
        when d.doc_id % 3 = 0 then 'AVE_data/' || d.doc_id || '.mp4'
        when d.doc_id % 3 = 1 and l.doc_id is not null then 'prepared_datasets/MUSIC_AVQA_data/' || d.doc_id || '.mp4'
        when d.doc_id % 3 = 1 then 'MUSIC_AVQA_data' || chr(92) || d.doc_id || '.mp4'
        else 'elsewhere/' || d.doc_id || '.mp4' end as video_path
      from documents d left join labels l using (doc_id)""",
    "fallback_paths": """
      select d.doc_id, 'SEED-Bench-image/' || d.doc_id || '.jpg' as image_path,
        case when l.quality = 1 then 'image' when l.doc_id is not null then 'video' else 'blank' end as media_kind,
        case when l.quality = 1 then 'SEED-Bench-image/' || d.doc_id || '.jpg' when l.doc_id is not null then 'videos/' || d.doc_id || '.jpg' end as media_path
      from documents d left join labels l using (doc_id)""",
    "fetch_status": """select 'd/' || d.doc_id || '.wav' as path, d.doc_id, case when l.doc_id is null then 'todo' else 'have' end as status
      from documents d left join labels l using (doc_id)""",
    "fetch_totals": """
      with j as (select d.doc_id, l.quality from documents d left join labels l using (doc_id))
      select count(*) as total_unique, count(*) filter (quality = 0) as ok, count(*) filter (quality is null) as fail,
        count(*) filter (quality = 1) as skip, count(*) filter (quality is null) as missing,
        count(*) filter (quality is null or quality = 0) as todo from j""",
    "missing_ids": "select doc_id from documents where doc_id not in (select doc_id from labels)",
    "written_subset": """
      select f as file, cast(doc_id as varchar) as id, md5(text) as body from documents, (values ('subset.json'), ('default.json')) t(f)
      union all select 'missing', cast(doc_id as varchar), '' from documents where doc_id not in (select doc_id from labels)
      union all select 'failed', 'p/' || doc_id, 'image|no' || chr(9) || 'file' from documents where doc_id not in (select doc_id from labels)""",
    "built_samples": f"""
      with t as (
        select 'avqa' as task, {_AV_LEN + _Q_LEN} + length(text) as i, length(lang) as o from documents
        union all select 'ave', {_AV_LEN + _E_LEN}, length('event:' || event_type || ' start_time:' || event_id % 10 || ' end_time:' || (event_id % 10 + 1)) from events
        union all select 'image_caption', {_I_LEN + len("Please answer the question:") + 1} + length(source), {_PUNCT} from documents
        union all select 'video_caption', {_V_LEN + len("Please answer the question:") + 1} + length('<image>' || source), {_PUNCT} from documents
        union all select 'audio_cap', {_A_LEN}, length(text) from documents where not (lang = 'en' and doc_id = 12347)
        union all select 'instruct', {_I_LEN + len("Please answer this question: ")} + length(source), length(text) from documents)
      select task, count(*) as n, cast(sum(i) as bigint) as instruction_chars, cast(sum(o) as bigint) as output_chars from t group by task""",
    "choice_files": f"""
      select 'mmbench' as task, 'aW1n' as image_path, md5(chr(10) || ' ' || {_IMG} || chr(10)
        || case when doc_id % 4 = 0 then 'Hint: ' || lang || chr(10) else '' end || 'Question: ' || text || chr(10) || 'Options:'
        || chr(10) || '(A) ' || source || chr(10) || '(B) ' || lang || case when doc_id % 2 = 0 then '' else chr(10) || '(C) c' end
        || case when doc_id % 3 = 0 then chr(10) || '(D) say "d"' else '' end || chr(10) || {_TAIL}) as prompt, 'A' as output from documents
      union all select 'seed', 'SEED-Bench-image/' || doc_id, md5({_IMG} || '. Question: ' || text || chr(10) || 'Options:'
        || chr(10) || '(A) ' || source || chr(10) || '(B) ' || lang || chr(10) || '(C) ' || source || chr(10) || '(D) ' || lang || {_TAIL}), 'A' from documents""",
    "split_files": """
      select case when lang = 'en' then 'train' else 'val' end as split, lang as answer, count(*) as n from documents group by all
      union all select distinct 'vocab', event_type, 1 from events union all select 'vocab', 'none', 1""",
    "decoded_contents": """select doc_id, cast(strlen(text) as bigint) as n_bytes,
      cast(length(text) - length(replace(text, chr(10), '')) as bigint) as n_lines from documents""",
    "predicted_texts": "select doc_id, '<answer>' || length(text) || '</answer>' as predict from documents",
    "packed_batches": f"""
      with d as (select doc_id, source, list_transform(string_split(text, ' '), lambda w: cast(length(w) as integer)) as a from documents),
      p as (select *, (row_number() over (order by md5('{SEED}:' || doc_id), doc_id) - 1) // 8 as batch_id from d),
      w as (select *, cast(max(len(a) + 1) over (partition by batch_id) as integer) as width from p)
      select doc_id as sample_id, batch_id, width,
        md5(array_to_string(list_concat(a, [cast(length(source) as integer)], list_transform(range(0, width - len(a) - 1), lambda z: 2)), ' ')) as ids,
        md5(array_to_string(list_concat(list_transform(a, lambda x: -100), [cast(length(source) as integer)], list_transform(range(0, width - len(a) - 1), lambda z: -100)), ' ')) as labels
      from w""",
}
