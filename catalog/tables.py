"""Given tables, and the prediction table derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


# The same expressions run in both engines; ``{s}`` is the text type.
_ADAPTER = """
event_id, user_id, event_type, event_id % 4 as rank, cast(floor(event_id / 4) as bigint) as idx,
concat(event_type, '</s>') as output,
case when user_id % 3 = 0 then 'Audio' when user_id % 3 = 1 then 'Visual' else 'Audio-Visual' end as modality,
case when event_id % 3 = 0 then 'Counting' when event_id % 3 = 1 then 'Location' else 'Temporal' end as kind,
case when event_id % 7 = 0 then concat('<answer>', event_type, '</answer> <answer>x</answer>')
     when event_id % 7 = 1 then 'no tag'
     when event_id % 7 = 2 then '<answer> view </answer>'
     when event_id % 7 = 3 then '<answer>outside</answer>'
     else concat('text <answer>', upper(event_type), '</answer></s>') end as pred_tag,
case when value >= 10 then 'Yes' else 'No' end as gold_yn,
case when event_id % 5 = 0 then concat('Yes, ', event_type) when event_id % 5 = 1 then 'no'
     when event_id % 5 = 2 then ' YES ' when event_id % 5 = 3 then 'unknown' else 'maybe' end as pred_yn,
concat('event:', event_type, ' start_time:', cast(event_id % 10 as {s}), ' end_time:',
       cast(event_id % 10 + user_id % 5 as {s}), '</s>') as gold_ave,
case when event_id % 6 = 0 then concat('<event>', event_type, '</event><range>', cast(event_id % 10 as {s}), ', ',
          cast(event_id % 10 + 3 as {s}), '</range><range>bad</range>')
     when event_id % 6 = 1 then concat('<event>', event_type, ' ( 2 5 ), (7 8)</event>')
     when event_id % 6 = 2 then '<event>nothing here</event>'
     when event_id % 6 = 3 then concat('<event>', event_type, '</event>')
     when event_id % 6 = 4 then concat('<event>', upper(event_type), '</event> <event>x</event>')
     else '<event>click</event><range>0,9</range>' end as pred_ave,
case when event_id % 6 = 0 then 'It is A here' when event_id % 6 = 1 then 'b ' when event_id % 6 = 2 then ' (C) '
     when event_id % 6 = 3 then 'pizza b x' when event_id % 6 = 4 then 'D or E maybe' else '???' end as pred_choice,
case when user_id % 5 = 0 then 'A' when user_id % 5 = 1 then 'B' when user_id % 5 = 2 then 'C'
     when user_id % 5 = 3 then 'D' else 'E' end as gold_choice
"""
ADAPTER_SQL = f"select {_ADAPTER.format(s='varchar')} from events"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return spark.sql(f"select {_ADAPTER.format(s='string')} from {{events}}", events=events)


def av_predictions(spark: SparkSession, sf_dir: str, output: str = "output", predict: str = "pred_tag") -> DataFrame:
    """Prediction records of the audio-visual tasks."""
    return predictions(spark, sf_dir).select(
        "event_id",
        F.col(output).alias("output"),
        F.array("modality", "kind").alias("question_type"),
        F.col(predict).alias("predict"),
    )


def image_predictions(spark: SparkSession, sf_dir: str, answer: str, predict: str) -> DataFrame:
    """Prediction records of the image benchmarks; the position is the event id."""
    return predictions(spark, sf_dir).select(
        F.col("rank"),
        F.col("idx").alias("index"),
        F.col("event_type").alias("subtask"),
        F.concat(F.lit("images/"), F.col("user_id").cast("string"), F.lit(".jpg")).alias("image_path"),
        F.concat(F.lit("q"), F.col("event_id").cast("string")).alias("question"),
        F.col(answer).alias("answer"),
        F.array(predict).alias("output"),
        F.col("event_id").alias("position"),
    )


def sql_text(text: str) -> str:
    """A text as an SQL expression."""
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
