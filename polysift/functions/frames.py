"""Frame indices and signal arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Filter-bank statistics, and the per-channel statistics of the image encoder.
FBANK_MEAN, FBANK_STD = 15.41663, 6.55582
IMAGE_MEAN = [0.48145466, 0.4578275, 0.40821073]
IMAGE_STD = [0.26862954, 0.26130258, 0.27577711]


def _range0(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1)).otherwise(
        F.array().cast("array<bigint>")
    )


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def frames_uniform(n_frames: Column | str, k: int) -> Column:
    """min(k, n) indices at floor(i * n / k)."""
    n = col(n_frames).cast("bigint")
    m = F.least(F.lit(k).cast("bigint"), n)
    return F.transform(_range0(m), lambda i: _div(i * n, m))


def frames_linspace(n_frames: Column | str, k: int) -> Column:
    """k indices from 0 to n - 1 inclusive, truncated; short clips repeat frames."""
    n = col(n_frames).cast("bigint")
    steps = F.lit(max(k - 1, 1)).cast("bigint")
    return F.transform(_range0(F.lit(k)), lambda i: _div(i * (n - 1), steps))


def frames_headtail(n_frames: Column | str, k: int, clip: Column | str, seed: int) -> Column:
    """k/2 distinct indices drawn from each half of the clip, each half sorted.

    The draw keeps the smallest hashes of (seed, clip, frame), so reruns pick the same frames.
    """
    n = col(n_frames).cast("bigint")
    half = _div(n, F.lit(2).cast("bigint"))
    take = _div(F.least(F.lit(k).cast("bigint"), n), F.lit(2).cast("bigint")).cast("int")

    def key(i: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), col(clip).cast("string"), i.cast("string")))

    def draw(begin: Column, stop: Column) -> Column:
        keyed = F.transform(
            _range0(stop - begin), lambda i: F.struct(key(i + begin).alias("h"), (i + begin).alias("i"))
        )
        picked = F.slice(F.sort_array(keyed), F.lit(1), take)
        return F.sort_array(F.transform(picked, lambda s: s["i"]))

    return F.concat(draw(F.lit(0).cast("bigint"), half), draw(half, n))


def frame_seconds(indices: Column | str, fps: Column | float) -> Column:
    """Seconds of each frame rounded to one digit, ties to even."""
    rate = F.lit(float(fps)) if isinstance(fps, (int, float)) else fps
    return F.transform(col(indices), lambda i: F.bround(i / rate, 1))


def frame_message(n_frames: Column | str, indices: Column | str, fps: Column | float) -> Column:
    rate = F.lit(float(fps)) if isinstance(fps, (int, float)) else fps
    shown = F.array_join(F.transform(frame_seconds(indices, fps), lambda s: s.cast("string")), ", ")
    return F.concat(
        F.lit("Vlen: "), col(n_frames).cast("string"), F.lit(" fps: "), rate.cast("string"),
        F.lit(" The video contains "), F.size(col(indices)).cast("string"),
        F.lit(" frames sampled at "), shown, F.lit(" seconds. "),
    )


def clip_and_pad(signal: Column | str, rate: int, min_s: int = 1, max_s: int = 60) -> Column:
    """Zero-pad to at least ``min_s`` seconds, cut at ``max_s`` seconds."""
    x = F.slice(col(signal), 1, rate * max_s)
    return F.concat(x, F.array_repeat(F.lit(0.0).cast("float"), F.greatest(F.lit(rate * min_s) - F.size(x), F.lit(0))))


def normalize(values: Column | str, mean: float = FBANK_MEAN, std: float = FBANK_STD, k: float = 2.0) -> Column:
    """(x - mean) / (k * std)."""
    return F.transform(col(values), lambda x: (x - F.lit(mean)) / F.lit(k * std))


def normalize_channels(values: Column | str, mean: list[float] | None = None, std: list[float] | None = None) -> Column:
    """Per-channel (x - mean[c]) / std[c] for an array of channel arrays."""
    means, stds = F.lit(mean or IMAGE_MEAN), F.lit(std or IMAGE_STD)
    return F.transform(
        col(values), lambda ch, c: F.transform(ch, lambda x: (x - F.get(means, c)) / F.get(stds, c))
    )


def clip_window(start: Column | str, duration: float = 10.0) -> Column:
    """``{start, end}`` of a clip of fixed duration."""
    s = col(start).cast("double")
    return F.struct(s.alias("start"), (s + F.lit(duration)).alias("end"))
