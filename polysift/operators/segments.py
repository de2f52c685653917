"""Cutting signals and event tables into time segments. Signals are exploded in place, never shuffled whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

ZERO = 0.0


def _zeros(n: Column) -> Column:
    return F.array_repeat(F.lit(ZERO).cast("float"), F.greatest(n, F.lit(0)).cast("int"))


def _cut(signal: str, begin: Column, length: Column) -> Column:
    return F.slice(F.col(signal), begin.cast("int") + 1, F.greatest(length, F.lit(0)).cast("int"))


def _explode(df: DataFrame, count: Column, name: str) -> DataFrame:
    steps = F.when(count > 0, F.sequence(F.lit(0), count.cast("int") - 1))
    return df.withColumn(name, F.explode(steps))


def segments_fixed(df: DataFrame, *, rate: int, signal: str = "signal") -> DataFrame:
    """One-second windows; signals under a second are padded to one, the last window is padded at its end."""
    n = F.size(signal)
    count = F.greatest(F.ceil(n / F.lit(rate)), F.lit(1))
    rows = _explode(df, count, "segment")
    part = _cut(signal, F.col("segment") * rate, F.lit(rate))
    return _padded(rows, part, F.lit(rate), signal, front=F.lit(False))


def segments_equal(df: DataFrame, *, n: int = 10, signal: str = "signal") -> DataFrame:
    """``n`` parts of ``len div n`` samples; the remainder is dropped."""
    width = F.call_function("div", F.size(signal), F.lit(n)).cast("int")
    rows = _explode(df, F.lit(n), "segment")
    part = _cut(signal, F.col("segment") * width, width)
    return _padded(rows, part, width, signal, front=F.lit(False))


def segments_hop(
    df: DataFrame, *, total: int = 60, hop: int = 6, before: float = 0.5, after: float = 1.5, signal: str = "signal"
) -> DataFrame:
    """Windows of ``before + after`` seconds around every ``hop`` seconds of a ``total``-second signal.

    A window that starts before the signal is padded in front, one that ends behind it at the end.
    """
    rate = F.call_function("div", F.size(signal), F.lit(total)).cast("int")
    rows = _explode(df, F.lit(-(-total // hop)), "segment")
    mark = F.col("segment") * hop
    start = F.greatest(mark - F.lit(before), F.lit(0.0))
    stop = F.least(mark + F.lit(after), F.lit(float(total)))
    begin, end = (start * rate).cast("int"), (stop * rate).cast("int")
    part = _cut(signal, begin, end - begin)
    width = (F.lit(before + after) * rate).cast("int")
    return _padded(rows, part, width, signal, front=(mark - F.lit(before)) < 0)


def _padded(rows: DataFrame, part: Column, width: Column, signal: str, front: Column) -> DataFrame:
    rows = rows.withColumns({"_part": part, "_width": width}).drop(signal)
    gap = _zeros(F.col("_width") - F.size("_part"))
    value = F.when(front, F.concat(gap, F.col("_part"))).otherwise(F.concat(F.col("_part"), gap))
    return rows.withColumn("samples", value).drop("_part", "_width")


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since the epoch; timestamps without time zone are read as UTC whatever the session zone is."""
    if not isinstance(df.schema[ts].dataType, TimestampNTZType):
        return F.unix_micros(ts)
    gap = F.col(ts) - F.lit("1970-01-01").cast("timestamp_ntz")

    def part(field: str) -> Column:
        return F.date_part(F.lit(field), gap)

    minutes = (part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000_000 + (part("SECOND") * 1_000_000).cast("bigint")


def event_windows(
    events: DataFrame, *, ts: str = "ts", hop: int = 6, before: float = 0.5, after: float = 1.5
) -> DataFrame:
    """Event rows with each hop mark (seconds since the epoch) whose window holds them.

    Windows are narrower than the hop, so a row lies in at most ``ceil(width / hop)`` windows and the marks
    follow from the timestamp alone; rows between windows are left out.
    """
    seconds = epoch_micros(events, ts) / F.lit(1_000_000.0)
    low = F.ceil((seconds - F.lit(after)) / F.lit(hop))
    high = F.floor((seconds + F.lit(before)) / F.lit(hop))
    rows = events.withColumns({"_low": low, "_high": high, "_seconds": seconds}).filter("_low <= _high")
    rows = rows.withColumn("mark", F.explode(F.transform(F.sequence("_low", "_high"), lambda i: i * hop)))
    # Windows are half open: [mark - before, mark + after).
    return rows.filter(F.col("_seconds") < F.col("mark") + F.lit(after)).drop("_low", "_high", "_seconds")


def event_slots(events: DataFrame, *, ts: str = "ts", seconds: int = 1) -> DataFrame:
    """Tumbling windows on event time as column ``window``."""
    return events.withColumn("window", F.window(ts, f"{seconds} seconds"))
