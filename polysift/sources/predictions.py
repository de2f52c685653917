"""Prediction files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .annotations import file_path
from ..functions.text import stem
from ..operators.position import with_position


def read_predictions(spark: SparkSession, path: str, *, schema: str = schemas.AV_PREDICTION) -> DataFrame:
    """One JSON record per line."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def read_rank_files(spark: SparkSession, path: str, *, schema: str = schemas.IMAGE_PREDICTION) -> DataFrame:
    """All files (or folders of part files) of a directory whose name contains ``result``."""
    return spark.read.schema(schema).json(f"{path}/*result*", mode="FAILFAST")


def _unescaped(c: Column) -> Column:
    """Text of an escaped field; ``\\N`` is null."""
    parts = F.split(c, "\\\\\\\\", -1)

    def plain(p: Column) -> Column:
        for raw, shown in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            p = F.replace(p, F.lit(shown), F.lit(raw))
        return p

    return F.when(c != "\\N", F.array_join(F.transform(parts, plain), "\\"))


def read_qa_tsv(spark: SparkSession, path: str, *, escaped: bool = False) -> DataFrame:
    """Scored pairs, one text file or folder per subtask: subtask, image, question, gold, pred, position.

    Lines without exactly four tab-separated fields are left out. ``position`` counts the kept lines of a
    subtask in file and line order. ``escaped`` reads what ``sinks.write_by_subtask`` writes.
    """
    lines = spark.read.text(path, recursiveFileLookup=True, pathGlobFilter="*.txt").select(
        F.split("value", "\t", -1).alias("f"),
        file_path().alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    folder = F.regexp_extract("_file", r"/subtask=([^/]+)/[^/]*$", 1)
    names = ["image", "question", "gold", "pred"]
    if escaped:
        lines = lines.withColumn("f", F.transform("f", _unescaped))
    rows = lines.filter(F.size("f") == 4).select(
        F.when(folder != "", folder).otherwise(stem("_file")).alias("subtask"),
        *[(F.lower(F.col("f")[i]) if i > 1 else F.col("f")[i]).alias(n) for i, n in enumerate(names)],
        "_file", "_block", "_line",
    )
    placed = with_position(
        rows, ["_file", "_block", "_line"], by=["subtask"], bucket=F.struct("_file", "_block"), name="position"
    )
    return placed.drop("_file", "_block", "_line")
