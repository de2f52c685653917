"""Quality by hierarchical empirical Bayes: a text classifier's evidence with posteriors of host and path.

A logistic regression over shape features of the text gives every document a probability. Sums of labels (or, without a
label, of these probabilities) per host and per path are shrunk: a path's rate towards its host's, a host's towards the
corpus rate, by strengths estimated from the spread between groups, so a site with few documents hardly moves from
its parent. A document's own evidence is left out of its path and host before they shift its odds.

The classifier is fitted on at most ``TRAIN_ROWS`` labelled documents, those with the smallest hash of their id; all
sums cover all documents. Only numbers are grouped and joined, texts stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polysift.llm import logistic
from polysift.scratch import materialise

TRAIN_ROWS = 20_000
THRESHOLD = 0.5
_STRENGTHS = (1.0, 1e6)

_CLASSES = np.zeros((256, 8))
for _i, _members in enumerate(
    (range(65, 91), range(97, 123), range(48, 58), (32, 9, 10, 13), b".,;:?'\"()-", b"!", b"#$%&*|~^=+<>{}[]\\/_@`", range(128, 256))
):
    _CLASSES[list(_members), _i] = 1
N_FEATURES = 18


def features(text: str | None) -> list[float]:
    """Shape of a text: shares of character classes, repetition of words and lines, lengths; all zero without words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES / len(data)
    lines = [x for x in data.split(b"\n") if x]
    distinct = len(set(words))
    same = sum(map(bytes.__eq__, words[1:], words[:-1])) / n
    per_word = len(data) / n
    return [
        *shares.tolist(), shares[5] * per_word, shares[6] * per_word, min(1.0, shares[0] * 5), np.log1p(n), np.log1p(distinct) / np.log1p(n),
        distinct / n, same, len(set(lines)) / max(1, len(lines)), np.log(per_word), 1.0 if n < 12 else 0.0,
    ]


def _name(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def fit_classifier(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, train_rows: int) -> logistic.Logistic:
    """Model from the labelled documents with the smallest hash of their id."""
    chosen = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id_"))
    chosen = chosen.agg(F.avg(label_col).alias("label_")).orderBy(F.xxhash64("id_"), "id_").limit(train_rows)
    # At most train_rows pairs of numbers are broadcast.
    texts = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_")).join(F.broadcast(chosen), "id_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1).cast(pa.float64())], names=["x", "y"])

    got = texts.select("text_", "label_").mapInArrow(run, "x array<double>, y double").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, N_FEATURES)
    order = np.lexsort((*x.T, got["y"].to_numpy(float))) if len(x) else np.zeros(0, int)
    return logistic.fit(x[order], (got["y"].to_numpy(float) >= 0.5).astype(float)[order])


def _with_logit(docs: DataFrame, model: logistic.Logistic, text_col: str, logit_col: str) -> DataFrame:
    @F.pandas_udf("double")
    def logit(texts):
        import pandas as pd

        rows = np.array([features(t) for t in texts], float).reshape(-1, N_FEATURES)
        return pd.Series(model.logits(rows))

    return docs.withColumn(logit_col, logit(F.col(text_col)))


def _strength(groups: DataFrame, rate: str, prior: str) -> float:
    """Prior strength of a level, by moments: how many documents a parent's rate is worth."""
    m = F.col(prior)
    row = groups.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(F.col(rate) - m, 2)).alias("spread"),
        F.sum(m * (1 - m)).alias("noise"),
        F.sum(F.col("n") * m * (1 - m)).alias("scale"),
    ).first()
    if not row["n"]:
        return _STRENGTHS[0]
    between = (row["spread"] - row["noise"]) / max(row["scale"], 1e-12)
    return float(np.clip(1 / max(between, 1e-9) - 1, *_STRENGTHS))


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def posteriors(evidence: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """(host, path, n, s, host_n, host_s) and the numbers of the hierarchy, from rows (host, path, p)."""
    paths = materialise(evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s")).first()
    corpus = float(np.clip(((total["s"] or 0.0) + 1) / ((total["n"] or 0) + 2), 1e-6, 1 - 1e-6))
    rated = hosts.select(F.col("host_n").alias("n"), (F.col("host_s") / F.col("host_n")).alias("r"), F.lit(corpus).alias("m"))
    host_strength = _strength(rated, "r", "m")
    joined = paths.join(hosts, "host")
    parent = (F.col("host_s") + host_strength * corpus) / (F.col("host_n") + host_strength)
    path_strength = _strength(joined.select("n", (F.col("s") / F.col("n")).alias("r"), parent.alias("m")), "r", "m")
    return joined, {"corpus": corpus, "host_strength": host_strength, "path_strength": path_strength}


def _combined(rows: DataFrame, prior: dict[str, float]) -> DataFrame:
    """Rows (own, logit, sums of path and host) with ``host_rate``, ``path_rate`` and ``probability``."""
    k, kp, corpus = prior["host_strength"], prior["path_strength"], prior["corpus"]
    rows = rows.withColumn("host_rate", (F.col("host_s") - F.col("own") + k * corpus) / (F.col("host_n") - 1 + k))
    rows = rows.withColumn("path_rate", (F.col("s") - F.col("own") + kp * F.col("host_rate")) / (F.col("n") - 1 + kp))
    rate = F.least(F.greatest(F.col("path_rate"), F.lit(1e-6)), F.lit(1 - 1e-6))
    return rows.withColumn("probability", 1 / (1 + F.exp(-(F.col("logit") + _odds(rate) - _odds(F.lit(corpus))))))


def quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host: Column | str = "source",
    path: Column | str = "lang", label_col: str = "quality", train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: id, ``classifier`` (text alone), ``host_rate``, ``path_rate``, ``probability``, ``keep``.

    A null text counts as empty, a null host or path as one with an empty name; without labels every probability starts at
    one half and ``keep`` is true. Repeated rows each count. Labels that repeat an id are averaged, null ones ignored.
    Other columns are ignored.
    """
    model = fit_classifier(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, train_rows=train_rows)
    rows = docs.select(F.col(id_col).alias("id_"), _name(host).alias("host"), _name(path).alias("path"), F.col(text_col).alias("text_"))
    rows = materialise(_with_logit(rows, model, "text_", "logit").select("id_", "host", "path", "logit"), "logits")
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col("doc_id").alias("id_")).agg(F.avg(label_col).alias("label_"))
    rows = rows.join(known, "id_", "left").withColumn("classifier", 1 / (1 + F.exp(-F.col("logit"))))
    rows = rows.withColumn("own", F.coalesce("label_", "classifier"))
    groups, prior = posteriors(rows.select("host", "path", F.col("own").alias("p")))
    out = _combined(rows.join(groups, ["host", "path"]), prior)
    return out.select(
        F.col("id_").alias(id_col), "host", "path", "classifier", "host_rate", "path_rate", "probability", (F.col("probability") >= threshold - 1e-9).alias("keep")
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that ``quality`` keeps, all columns as they were; rows that repeat an id go or stay together."""
    id_col = options.get("id_col", "doc_id")
    found = quality(docs, labels, **options).groupBy(F.col(id_col).alias("gone_")).agg(F.max("keep").alias("keep_"))
    bad = materialise(found.filter(~F.col("keep_")).select("gone_"), "rejected")
    return docs.join(bad, docs[id_col].eqNullSafe(bad["gone_"]), "left_anti")
