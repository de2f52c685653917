"""Streams over growing prediction folders and event tables.

``run_available`` drains what is there and stops; the same plans run continuously with another trigger.
Results are written per micro-batch under its id, so a repeated batch replaces its own output. Results by key and codebook states are
compacted as they go: what a later version has replaced is deleted once no repeated batch can need it.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .. import scratch
from ..operators import scoring, segments, subset, vectors
from ..sources import schemas


def stream_predictions(
    spark: SparkSession, path: str, *, schema: str = schemas.AV_PREDICTION, files_per_batch: int = 1_000
) -> DataFrame:
    """Prediction records as files appear, with their arrival time in ``arrived``."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).withColumn("arrived", F.col("_metadata.file_modification_time"))


def running_avqa(preds: DataFrame, answers: list[str] | None = None) -> DataFrame:
    """Counts per question type so far (update or complete mode); its state is one row per type."""
    judged = scoring.drop_unparsed(scoring.judge_avqa(preds, answers))
    return judged.groupBy(F.get("question_type", F.lit(0)).alias("modality"), F.get("question_type", F.lit(1)).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("right").alias("correct")
    )


def running_choice(preds: DataFrame) -> DataFrame:
    return scoring.choice_score(preds)


def running_yesno(preds: DataFrame) -> DataFrame:
    return scoring.yesno_score(preds)


def stream_dedup(preds: DataFrame, *, world: int, n_total: int) -> DataFrame:
    """Rows of padded shards once; adds ``position``. A filter without state.

    Which rows are padding shows only at the end of a run; without the total use :func:`run_merge`.
    """
    return subset.dedup_padded(preds, world=world, n_total=n_total)


class _LastOfRank(StatefulProcessor):
    """Lets the rows of a rank pass but the last one, which goes when the rank has been silent for a while."""

    def __init__(self, silence_ms: int):
        self.silence_ms = silence_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "index long, row string")

    def handleInputRows(self, key, rows, timerValues):
        held = self.held.get() if self.held.exists() else None
        for part in rows:
            # A batch may hold a whole rank: what passes leaves with the part it came in.
            passed = []
            for index, row in zip(part["index"].tolist(), part["row"].tolist(), strict=True):
                if held is None or index > held[0]:
                    if held is not None:
                        passed.append(held[1])
                    held = (int(index), row)
                elif index < held[0]:
                    passed.append(row)
            yield pd.DataFrame({"row": passed, "tail": [False] * len(passed)}).astype({"row": "object", "tail": "bool"})
        if held is not None:
            self.held.update(held)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silence_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.held.exists():
            row = self.held.get()[1]
            self.held.clear()
            yield pd.DataFrame({"row": [row], "tail": [True]})

    def close(self) -> None:
        pass


_EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def stream_tails(preds: DataFrame, *, silence: float) -> DataFrame:
    """The records, and ``tail``: true for a rank's last one, which is held back until the rank has been silent for so many seconds.

    The state is one record per rank, whatever the length of the run; a rank that goes on after a silence has several tails, of which the
    last counts. Needs a state store with timers (:func:`run_merge` sets it).
    """
    told = preds.select("rank", "index", F.to_json(F.struct(*preds.columns), _EXACT_TIMES).alias("row"))
    passed = told.groupBy("rank").transformWithStateInPandas(_LastOfRank(int(silence * 1000)), "row string, tail boolean", "Append", "ProcessingTime")
    return passed.select(F.from_json("row", preds.schema, _EXACT_TIMES).alias("row"), "tail").select("row.*", "tail")


_STORE = "spark.sql.streaming.stateStore.providerClass"
_TIMED_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_merge(preds: DataFrame, out: str, *, world: int, silence: float = 60.0, timeout: float = 3600.0) -> DataFrame:
    """Merge a run while its shards are written, without knowing its length; returns when all ``world`` ranks have fallen silent.

    Rows are final as they are written, but for the last one of each rank: these, at most ``world``, are compared with the head at the
    end, as ``subset.padded_rows`` does, which fails where a repeated row need not be padding. A query that is stopped goes on from its
    checkpoint under ``out``.
    """
    spark, data = preds.sparkSession, f"{out}/data"
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _TIMED_STORE)
    try:
        query = (
            stream_tails(preds, silence=silence).writeStream.outputMode("append")
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(processingTime="1 second")
            .foreachBatch(lambda batch, batch_id: batch.write.mode("overwrite").partitionBy("tail").parquet(f"{data}/batch_id={batch_id}"))
            .start()
        )
    finally:
        spark.conf.set(_STORE, before)
    schema, ends = StructType([*preds.schema.fields, StructField("tail", BooleanType())]), time.monotonic() + timeout
    try:
        while not query.awaitTermination(1):
            if _ended(spark, data, schema) == world:
                break
            if time.monotonic() > ends:
                raise TimeoutError(f"not all of {world} ranks ended within {timeout} seconds")
    finally:
        query.stop()
    rows = spark.read.schema(schema).parquet(data).drop("batch_id").withColumn("position", subset.merged_position(world=world))
    ends_only = rows.filter(F.col("tail") | (F.col("position") < world)).drop("tail")
    end = ends_only.agg(F.max("position") + 1).scalar()
    return rows.filter(F.col("position") < end - subset.padded_rows(ends_only, world=world)).drop("tail")


def _ended(spark: SparkSession, data: str, schema: StructType) -> int:
    """Ranks whose last record has been let go."""
    try:
        return spark.read.schema(schema).parquet(data).filter("tail").select("rank").distinct().count()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def drop_redelivered(preds: DataFrame, *, delay: str = "1 day") -> DataFrame:
    """Records that arrive again under their own (rank, index) once, as long as ``delay`` after they came; ``arrived`` comes
    from :func:`stream_predictions`. Padding repeats rows under a (rank, index) of its own and stays."""
    return preds.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["rank", "index"])


def stream_events(spark: SparkSession, path: str, schema: str, *, pattern: str, files_per_batch: int = 1_000) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_segments(events: DataFrame, *, ts: str = "ts", seconds: int = 1, delay: str = "10 minutes") -> DataFrame:
    """Tumbling windows: events per window and type.

    In append mode a window is put out once the watermark has passed it, and its state goes.
    """
    slots = segments.event_slots(events.withWatermark(ts, delay), ts=ts, seconds=seconds)
    return slots.groupBy("window", "event_type").agg(F.count(F.lit(1)).alias("n"))


def stream_hops(events: DataFrame, *, ts: str = "ts", delay: str = "10 minutes", **hops) -> DataFrame:
    """Counts per hop mark; marks are event time too, so late marks are dropped by the watermark.

    In append mode a mark is put out, and forgotten, once the watermark has passed it.
    """
    marked = segments.event_windows(events, ts=ts, **hops).withColumn("mark_ts", F.timestamp_seconds("mark"))
    return marked.withWatermark("mark_ts", delay).groupBy("mark_ts").agg(F.count(F.lit(1)).alias("n"))


#: Batches of a result by key that are merged into one table at a time.
COMPACT = 10


def run_available(stream: DataFrame, out: str, *, mode: str = "append", keys: tuple[str, ...] = (), compact: int = COMPACT) -> DataFrame:
    """Drain the stream into ``out`` and return its result.

    ``append``: the rows of all batches. ``complete``: those of the last batch; older ones are deleted as it replaces them.
    ``update``: of rows with equal ``keys`` the one of the last batch; every ``compact`` batches they are merged into one table, and
    the batches before the last merge but one are deleted. A stream without a batch gives no rows.
    """
    spark, data = stream.sparkSession, f"{out}/data"

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{data}/batch_id={batch_id}")
        if mode == "complete" and batch_id:
            scratch.delete(spark, f"{data}/batch_id={batch_id - 1}")
        if mode == "update" and (batch_id + 1) % compact == 0:
            _merge_batches(batch.sparkSession, out, stream.schema, keys, batch_id, compact)

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
    query.awaitTermination()
    if mode == "update":
        return newest_rows(spark, out, stream.schema, keys)
    try:
        rows = spark.read.parquet(data)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], stream.schema)
    if mode == "complete":
        rows = rows.filter(F.col("batch_id") == rows.select(F.max("batch_id")).scalar())
    return rows.drop("batch_id")


def _newest(rows: DataFrame, keys: tuple[str, ...], columns: list[str]) -> DataFrame:
    """Of rows with equal keys the one of the last ``batch_id``, with it."""
    rest = [c for c in columns if c not in keys]
    found = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"), F.max("batch_id").alias("batch_id"))
    return found.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in columns], "batch_id")


def _versions(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the complete folders ``name=<number>``."""
    return sorted(int(p.split("=")[-1]) for p in scratch.children(spark, folder, f"{name}=") if scratch.exists(spark, f"{folder}/{p}/_SUCCESS"))


def _parts(spark: SparkSession, out: str, schema: StructType, upto: int | None = None) -> DataFrame:
    """Rows with their batch: the last merged table below ``upto``, and the batches after it."""
    known = StructType([*schema.fields, StructField("batch_id", LongType())])
    merged = [v for v in _versions(spark, f"{out}/merged", "upto") if upto is None or v < upto]
    after = merged[-1] if merged else -1
    batches = [v for v in _versions(spark, f"{out}/data", "batch_id") if v > after and (upto is None or v <= upto)]
    rows = spark.read.schema(known).parquet(f"{out}/merged/upto={after}") if merged else spark.createDataFrame([], known)
    for v in batches:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{out}/data/batch_id={v}").withColumn("batch_id", F.lit(v).cast("long")))
    return rows


def _merge_batches(spark: SparkSession, out: str, schema: StructType, keys: tuple[str, ...], batch_id: int, compact: int) -> None:
    """Write the merged table of all batches so far; it is made from the merge before, so a repeated batch makes it again."""
    _newest(_parts(spark, out, schema, batch_id), keys, schema.names).write.mode("overwrite").parquet(f"{out}/merged/upto={batch_id}")
    for folder, name, below in ((f"{out}/merged", "upto", batch_id - compact), (f"{out}/data", "batch_id", batch_id - compact + 1)):
        for v in _versions(spark, folder, name):
            if v < below:
                scratch.delete(spark, f"{folder}/{name}={v}")


def newest_rows(spark: SparkSession, out: str, schema: StructType, keys: tuple[str, ...]) -> DataFrame:
    """Result in ``update`` mode of what :func:`run_available` has written under ``out``."""
    return _newest(_parts(spark, out, schema), keys, schema.names).drop("batch_id")


def stream_codebook(stream: DataFrame, start: DataFrame, out: str, *, vec: str, decay: float = 0.99) -> Callable[[], DataFrame]:
    """Move a codebook with each micro-batch and return a reader of the latest one.

    State ``v=<n+1>`` is always made from ``v=<n>``, so a repeated batch writes the same state again; older states are deleted.
    """
    spark = stream.sparkSession
    if not _versions(spark, f"{out}/state", "v"):
        start.write.mode("overwrite").parquet(f"{out}/state/v=0")

    def update(batch: DataFrame, batch_id: int) -> None:
        prev = batch.sparkSession.read.parquet(f"{out}/state/v={batch_id}")
        moved = vectors.ema_codebook(prev, batch, vec=vec, decay=decay)
        moved.write.mode("overwrite").parquet(f"{out}/state/v={batch_id + 1}")
        for old in _versions(batch.sparkSession, f"{out}/state", "v"):
            if old < batch_id:
                scratch.delete(batch.sparkSession, f"{out}/state/v={old}")

    query = (
        stream.writeStream.option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(update)
        .start()
    )
    query.awaitTermination()

    def latest() -> DataFrame:
        states = spark.read.parquet(f"{out}/state")
        return states.filter(F.col("v") == states.select(F.max("v")).scalar()).drop("v")

    return latest
