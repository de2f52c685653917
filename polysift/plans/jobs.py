"""The jobs a user runs. Each is one lazy plan built from the operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import models, prompts, tokens
from ..operators import batching, conversations, lookup, scoring, segments, subset, vectors
from ..operators.position import BUCKET_ROWS, int_bucket, seeded_hash, with_position
from ..scratch import materialise
from ..sources import annotations, predictions, samples

# Folder prefixes of paths that may live under the prepared root.
KNOWN_PREFIXES = ("MUSIC_AVQA_data/", "AVE_data/")


@dataclass
class BuildConfig:
    """Which annotation sets to read and where; a task without a path is switched off.

    ``caps`` limits sources by task name to their first rows in reading order, before they become samples.
    """

    split: str = "train"
    root: str = "prepared_datasets"
    avqa: str | None = None
    ave: str | None = None
    ave_labels: str | None = None
    label_listing: DataFrame | None = None
    image_caption: str | None = None
    video_caption: str | None = None
    audio_caption: str | None = None
    instruct: str | None = None
    choice_tsv: str | None = None
    choice_json: str | None = None
    qa_dir: str | None = None
    pope: str | None = None
    pope_splits: tuple[str, ...] = ("test",)
    caps: dict[str, int] = field(default_factory=dict)
    image_root: str = ""
    listing: DataFrame | None = None
    layout: str = "array"


def build_samples(spark: SparkSession, cfg: BuildConfig) -> DataFrame:
    """All enabled annotation sets in the sample schema, media paths remapped when a listing is given."""
    lay = {"layout": "ranges+places" if cfg.layout == "ranges" and cfg.caps else cfg.layout}
    ann, smp = annotations, samples

    def capped(task: str, rows: DataFrame) -> DataFrame:
        return subset.first_read(rows, cfg.caps[task]) if task in cfg.caps else rows.drop("_file", "_record")

    def avqa() -> DataFrame:
        rows = smp.avqa_samples(capped("avqa", ann.read_avqa(spark, cfg.avqa, cfg.split, **lay)), cfg.split)
        if cfg.listing is None:
            return rows
        for column in ("video_path", "audio_path"):
            rows = lookup.remap_paths(rows, cfg.listing, column=column, root=cfg.root, prefixes=KNOWN_PREFIXES)
        return rows

    def ave() -> DataFrame:
        labels = ann.read_labels(spark, cfg.ave_labels, listing=cfg.label_listing) if cfg.split == "train" else None
        return smp.ave_samples(capped("ave", ann.read_ave(spark, cfg.ave, cfg.split, **lay)), cfg.split, root=f"{cfg.root}/AVE_data", labels=labels)

    readers: dict[str, tuple[str | None, Callable[[], DataFrame]]] = {
        "avqa": (cfg.avqa, avqa),
        "ave": (cfg.ave, ave),
        "image_caption": (
            cfg.image_caption,
            lambda: smp.caption_samples(capped("image_caption", ann.read_image_caption(spark, cfg.image_caption, **lay)), "image", root=cfg.image_root),
        ),
        "video_caption": (
            cfg.video_caption,
            lambda: smp.caption_samples(capped("video_caption", ann.read_video_caption(spark, cfg.video_caption, **lay)), "video", root=cfg.image_root),
        ),
        "audio_caption": (
            cfg.audio_caption,
            lambda: smp.audio_caption_samples(capped("audio_caption", ann.read_audio_caption(spark, cfg.audio_caption, **lay)), root=cfg.audio_caption),
        ),
        "instruct": (
            cfg.instruct,
            lambda: smp.instruct_samples(capped("instruct", ann.read_instruct_json(spark, cfg.instruct, **lay)), root=cfg.image_root),
        ),
        "choice_tsv": (cfg.choice_tsv, lambda: smp.choice_samples(capped("choice_tsv", ann.read_choice_tsv(spark, cfg.choice_tsv, layout="ranges" if cfg.layout == "ranges" and "choice_tsv" not in cfg.caps else "whole")))),
        "choice_json": (
            cfg.choice_json,
            lambda: smp.fixed_choice_samples(capped("choice_json", ann.read_choice_json(spark, cfg.choice_json)), root=cfg.image_root),
        ),
        "qa_dir": (cfg.qa_dir, lambda: smp.yesno_samples(capped("qa_dir", ann.read_qa_dir(spark, cfg.qa_dir)))),
        "pope": (cfg.pope, lambda: smp.pope_samples(capped("pope", ann.read_split(spark, cfg.pope, list(cfg.pope_splits))))),
    }
    return samples.load_tasks(spark, {name: read() if path else None for name, (path, read) in readers.items()})


@dataclass
class PackConfig:
    """Batch size, order and padding of :func:`pack_batches`."""

    key: str = "sample_id"
    batch_size: int = 8
    seed: int = 0
    side: str = "right"
    evaluate: bool = False


def pack_batches(
    rows: DataFrame,
    make_tokenizer: Callable[[], Callable[[list[str]], list[list[int]]]],
    cfg: PackConfig | None = None,
    *,
    after_read: Callable[[], None] | None = None,
) -> DataFrame:
    """Tokenize instruction and output, label, batch in a seeded random order, pad per batch.

    ``rows`` are read once, before this returns; then ``after_read`` is called, which may delete the files behind them.

    ``rows`` has ``cfg.key``, ``task``, ``instruction`` and ``output``, such as ``conversations.sft_records`` makes of
    samples. Every row is packed once, whatever its key: keys may repeat or be null.
    """
    cfg = cfg or PackConfig()
    encoded = models.with_tokens(rows, {"_prompt": "instruction", "_answer": "output"}, make_tokenizer, packed=True)
    ids = F.col("_prompt") if cfg.evaluate else tokens.input_ids("_prompt", "_answer")
    ready = encoded.select(cfg.key, "task", ids.alias("input_ids"), tokens.packed_size("_prompt").alias("_lead"))
    batched = _in_batches(ready, cfg.key, cfg.batch_size, cfg.seed, packed="input_ids", after_read=after_read)
    # Labels follow from the ids and the length of the prompt, so they are made where the rows have met their batch.
    labels = tokens.packed_label_ids("input_ids", "_lead").alias("labels")
    pad = batching.pad_right if cfg.side == "right" else batching.pad_left
    return pad(batched.select(*[labels if c == "_lead" else c for c in batched.columns]), width="width")


@dataclass
class ChatConfig:
    """Token ids and batch shape of :func:`pack_image_chat`; markers are the encoded start and end texts."""

    start_marker: list[int]
    end_marker: list[int]
    image_id: int
    key: str = "sample_id"
    batch_size: int = 8
    seed: int = 0
    slots: int = 32
    system: str = prompts.SYSTEM_TEXT


def pack_image_chat(
    rows: DataFrame, make_tokenizer: Callable[[], Callable[[list[str]], list[list[int]]]], cfg: ChatConfig
) -> tuple[DataFrame, DataFrame]:
    """Conversations -> chat text -> ids, span labels and masks, padded right per batch: (batches, rejects).

    Placeholder ids are cleared after the media mask is taken, as the media features replace them.
    """
    rendered = conversations.render_image_chat(rows.select(cfg.key, "conversation"), slots=cfg.slots, system=cfg.system)
    rejects = rendered.filter("reject is not null").select(cfg.key, "reject")
    encoded = models.with_tokens(rendered.filter("reject is null"), "prompt", make_tokenizer, name="_raw", packed=True)
    # Masks and labels follow from the ids, so they are made where the rows have met their batch.
    batched = _in_batches(encoded.select(cfg.key, "_raw"), cfg.key, cfg.batch_size, cfg.seed, packed="_raw")
    chat = tokens.chat_arrays("_raw", cfg.image_id, cfg.start_marker, cfg.end_marker)
    ready = batched.withColumn("_chat", chat).select(*[c for c in batched.columns if c != "_raw"], "_chat.*")
    return batching.pad_right(ready, masks=("image_mask", "text_mask", "question_mask"), width="width"), rejects


def pack_media_slots(
    rows: DataFrame,
    make_tokenizer: Callable[[], Callable[[list[str]], list[list[int]]]],
    *,
    vocab_size: int,
    widths: dict[str, int],
    cfg: PackConfig | None = None,
) -> DataFrame:
    """Tokenized samples with media placeholders opened into slots, padded left per batch with their masks."""
    cfg = cfg or PackConfig()
    encoded = models.with_tokens(rows, {"_prompt": "instruction", "_answer": "output"}, make_tokenizer)
    ids = encoded.select(
        cfg.key, tokens.input_ids("_prompt", "_answer").alias("_ids"), tokens.label_ids("_prompt", "_answer").alias("_labels")
    )
    slots = ids.select(cfg.key, tokens.splice_segments("_ids", "_labels", vocab_size, widths).alias("_slots"))
    masks = ("text", "video", "audio", "question")
    flat = slots.select(
        cfg.key, F.col("_slots.token").alias("input_ids"), F.col("_slots.label").alias("labels"), *[F.col(f"_slots.{m}").alias(m) for m in masks]
    )
    return batching.pad_left(_in_batches(flat, cfg.key, cfg.batch_size, cfg.seed), masks=masks, width="width")


def _in_batches(ready: DataFrame, key: str, size: int, seed: int, *, packed: str | None = None, after_read: Callable[[], None] | None = None) -> DataFrame:
    """Add ``position``, ``batch_id`` and the batch's ``width``, in seeded random order.

    The tokenized rows are written once, with the length of ``input_ids``, or of the ``packed`` ids, which are narrow on disk and on the way. A row
    is known by a number written with it, so keys need not be unique; ranking and widths read keys and lengths only, and the ids move once, to meet
    their batch. Rows are ranked in ranges of hash, content and that number, so rows of one key spread over many tasks. ``after_read`` is called when
    ``ready`` is written.
    """
    length = tokens.packed_size(packed) if packed else F.size("input_ids")
    added = {"_content": F.xxhash64(*ready.columns), "_length": length, "_place": F.monotonically_increasing_id()}
    held = ready.withColumns(added)
    stored = materialise(held.withColumn(packed, tokens.narrowed(packed)) if packed else held, "tokenized")
    if after_read:
        after_read()
    name = F.coalesce(F.col(key).cast("string"), F.col("_content").cast("string"))
    keys = stored.select("_place", "_length", "_content", F.unhex(seeded_hash(seed, name)).alias("_hash"), F.col(key).alias("_key"))
    placed = batching.batch_ids(with_position(keys, ["_hash", "_key", "_content", "_place"]), size)
    batches = batching.batch_max(placed, F.col("_length")).select("_place", "position", "batch_id", "width")
    # A few numbers a row are hashed and the ids pass by unsorted. Their files are small for what they hold, so they must never be broadcast.
    met = stored.drop("_content", "_length").join(batches.hint("shuffle_hash"), "_place").drop("_place")
    return met.withColumn(packed, tokens.widened(packed)) if packed else met


@dataclass
class SegmentConfig:
    """How signals are cut: ``fixed`` seconds, ``equal`` parts or ``hop`` windows."""

    mode: str = "fixed"
    rate: int = 16_000
    options: dict = field(default_factory=dict)


def segment_manifest(media: DataFrame, cfg: SegmentConfig | None = None, *, signal: str = "signal") -> DataFrame:
    """One row per segment; no shuffle."""
    cfg = cfg or SegmentConfig()
    if cfg.mode == "fixed":
        return segments.segments_fixed(media, rate=cfg.rate, signal=signal)
    cut = {"equal": segments.segments_equal, "hop": segments.segments_hop}[cfg.mode]
    return cut(media, signal=signal, **cfg.options)


def merge_predictions(spark: SparkSession, path: str, *, world: int, n_total: int | None = None, dedup: bool = True) -> DataFrame:
    """All rank files as one table with ``position``, without the rows that padded shards repeat."""
    preds = predictions.read_rank_files(spark, path)
    if not dedup:
        return preds.withColumn("position", subset.merged_position(world=world))
    return subset.dedup_padded(preds, world=world, n_total=n_total)


def score_avqa(preds: DataFrame, **options) -> DataFrame:
    return scoring.avqa_score(preds, **options)


def score_ave(preds: DataFrame, vocab: DataFrame, **options) -> DataFrame:
    return scoring.ave_score(preds, vocab, **options)


def score_choice(preds: DataFrame, **options) -> DataFrame:
    return scoring.choice_score(preds, **options)


def score_yesno(preds: DataFrame, **options) -> DataFrame:
    return scoring.yesno_score(preds, **options)


def score_paired(preds: DataFrame, *, groups: list[str] | None = scoring.PERCEPTION, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Merged predictions of the paired benchmark -> score per subtask and in total."""
    return scoring.paired_score(scoring.bucket_pairs(preds), groups=groups, bucket_rows=bucket_rows)


def prepare_subset(rows: DataFrame, before: DataFrame, after: DataFrame, *, n: int, key: str, position: str) -> tuple[DataFrame, DataFrame]:
    """First ``n`` rows by ``position``: (distinct ids still to fetch, fetch report).

    ``before`` and ``after`` list the ids present before and after the external fetch.
    """
    chosen = with_position(rows, position, bucket=int_bucket(position), name="_place", first=n).drop("_place")
    return subset.missing(chosen, before, key=key), subset.fetch_report(chosen, before, after, key=key)


def fit_codebook(df: DataFrame, k: int, *, key: str, vec: str, iters: int = 10, cosine: bool = True, seed: int = 0) -> DataFrame:
    """k-means codebook from ``k`` seeded random rows: code, vec, size."""
    start = subset.sample_n(df, k, key=key, seed=seed).select(
        F.col("draw").alias("code"), F.transform(vec, lambda x: x.cast("double")).alias("vec")
    )
    return vectors.kmeans(df, start, vec=vec, iters=iters, cosine=cosine)


def assign_codes(df: DataFrame, codebook: DataFrame, *, key: str, vec: str) -> DataFrame:
    return vectors.nearest_code(df, codebook, key=key, vec=vec)
