"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

#: Bytes that are not part of a word become spaces, A-Z become a-z; every byte of a non-ASCII character is kept.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Shared:
    """A broadcast object of this package's classes, sent by value: workers need not have the package on their path."""

    def __init__(self, spark: SparkSession, value):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self):
        """The object, unpickled once per call; call it once per task."""
        return cloudpickle.loads(self._bytes.value)


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of digits, letters and non-ASCII characters, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def spaced_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs without space, tab, line feed, vertical tab, form feed, carriage return."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def map_texts(
    df: DataFrame, columns: list[str], schema: str, fields: dict[str, pa.DataType], start: Callable[[], Callable]
) -> DataFrame:
    """Rows computed from whole rows, batch by batch, without moving any.

    ``start()`` runs once per task and returns ``f(*lists) -> dict of lists``, one output row per input row or as many
    as it likes. Long texts come in batches of bounded rows (``spark.sql.execution.arrow.maxRecordsPerBatch``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = step(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in fields.items()], names=list(fields))

    return df.select(*columns).mapInArrow(run, schema)
