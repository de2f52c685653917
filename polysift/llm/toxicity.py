"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexer transducer maps words to symbols: insult, threat, target, negation, reported speech, other. Transducers for
negation, reported speech and target read the symbols of a clause and multiply the weight of an insult or threat; they are
composed into one machine whose states carry all three memories, so a clause is read once. A document's matched clauses
give a few numbers, and a logistic regression turns them into the probability of the label.

Targets, negations, verbs of speech, threats and a few insults are fixed lists. Further insults, whole words or word beginnings,
are learned from labelled documents: entries that stand nearly always in toxic ones, in at least ``MIN_CONTEXTS`` different
contexts, so that the words of one much-copied document do not count. Learning reads at most ``TRAIN_ROWS`` labelled
documents, those with the smallest hash of their id; scoring reads whole texts, row by row, without moving any.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polysift.llm import logistic
from polysift.llm.common import Shared, map_texts

TRAIN_ROWS = 20_000
MIN_CONTEXTS = 4
PURITY = 0.8
#: Learned entries, the heaviest first; with the fixed lists they are the broadcast lexicon.
MAX_LEARNED = 20_000
PREFIXES = (4, 5, 6)
REMEMBERED = 400_000

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
FIXED_WEIGHT = 4.0
FIXED = {
    INSULT: "idiot idiots moron morons stupid loser losers scum worthless pathetic dumb fool imbecile trottel dummkopf"
    " idiota imbecil estupido crétin débile",
    THREAT: "kill hurt destroy attack stab shoot töten sterben umbringen tuer mourir frapper matar morir golpear",
    TARGET: "you your yours he she they them him her people everyone du dich dein ihr sie tu toi vous ton tú usted vosotros ellos",
    NEGATION: "not never no don't isn't aren't without nicht kein keine nie pas jamais ne sans nunca sin",
    REPORT: "said says quoted wrote reported claimed allegedly sagte schrieb behauptete dit écrit déclaré dijo escribió según",
}
#: Words a negation reaches, words around a target, and what they and reported speech do to a weight.
NEGATION_REACH, TARGET_REACH = 3, 4
NEGATED, REPORTED, TARGETED, UNTARGETED_THREAT = 0.35, 0.5, 1.5, 0.4

_CLAUSE_BYTES = bytes(
    10 if b in b".!?;\n" else b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 or b == 39 else 32 for b in range(256)
)
N_FEATURES = 5


def clauses(text: str | None) -> Iterator[list[bytes]]:
    """Lower-cased words of every clause."""
    data = text.encode("utf-8", "surrogatepass").translate(_CLAUSE_BYTES) if text else b""
    return (c.split() for c in data.split(b"\n"))


# A transducer is (start, step); step(state, symbol) gives the next state and a factor for the weight of the word.
def _negation():
    def step(state: int, symbol: int) -> tuple[int, float]:
        if symbol == NEGATION:
            return NEGATION_REACH, 1.0
        return max(0, state - 1), NEGATED if state and symbol in (INSULT, THREAT) else 1.0

    return 0, step


def _report():
    def step(state: int, symbol: int) -> tuple[int, float]:
        return (1, 1.0) if symbol == REPORT else (state, REPORTED if state and symbol in (INSULT, THREAT) else 1.0)

    return 0, step


def _target():
    def step(state: int, symbol: int) -> tuple[int, float]:
        if symbol == TARGET:
            return TARGET_REACH, 1.0
        factor = 1.0
        if symbol in (INSULT, THREAT):
            factor = TARGETED if state else UNTARGETED_THREAT if symbol == THREAT else 1.0
        return max(0, state - 1), factor

    return 0, step


def compose(*machines) -> tuple[list[list[tuple[int, float]]], int]:
    """One machine that runs all of them: table[state][symbol] = (next state, product of the factors)."""
    start = tuple(m[0] for m in machines)
    numbers, table, todo = {start: 0}, [], [start]
    while todo:
        state = todo.pop(0)
        row = []
        for symbol in range(6):
            moves = [m[1](s, symbol) for m, s in zip(machines, state, strict=True)]
            after = tuple(m[0] for m in moves)
            if after not in numbers:
                numbers[after] = len(numbers)
                todo.append(after)
            row.append((numbers[after], math.prod(m[1] for m in moves)))
        table.append(row)
    return table, 0


MACHINE, START = compose(_negation(), _report(), _target())
#: After so many other words every memory but that of reported speech is gone.
_FADE = max(NEGATION_REACH, TARGET_REACH)


class Lexer(dict):
    """Word -> (symbol, weight), or None for other words; entries ending in ``*`` match word beginnings."""

    def __init__(self, entries: dict[str, tuple[int, float]]):
        super().__init__()
        self.entries = {k.encode(): v for k, v in entries.items()}

    def __missing__(self, word: bytes) -> tuple[int, float] | None:
        if len(self) > REMEMBERED:
            self.clear()
        found = self.entries.get(word)
        if found is None:
            text = word.decode("utf-8", "replace")
            heads = [self.entries.get((text[:n] + "*").encode()) for n in PREFIXES if len(text) > n]
            found = max((h for h in heads if h), key=lambda h: h[1], default=None)
        self[word] = found
        return found


def clause_score(words: list[bytes], lexer: Lexer) -> float:
    """Weight of the insults and threats of a clause, as the composed machine leaves it."""
    hits = [(i, e) for i, w in enumerate(words) if (e := lexer[w])]
    if not any(e[0] in (INSULT, THREAT) for _, e in hits):
        return 0.0
    # A target counts on either side: the clause is read once more from its end.
    ahead = _factors(hits)
    back = _factors([(len(words) - 1 - i, e) for i, e in reversed(hits)], only_target=True)[::-1]
    return sum(e[1] * f * (TARGETED if b > 1 and f <= 1 else 1.0) for (_, e), f, b in zip(hits, ahead, back, strict=True) if e[0] in (INSULT, THREAT))


def _factors(hits: list[tuple[int, tuple[int, float]]], only_target: bool = False) -> list[float]:
    table, state = (_TARGET_ONLY if only_target else MACHINE), START
    out, at = [], 0
    for i, (symbol, _) in hits:
        for _ in range(min(i - at, _FADE)):
            state = table[state][OTHER][0]
        state, factor = table[state][symbol]
        out.append(factor)
        at = i + 1
    return out


_TARGET_ONLY = compose(_target())[0]


def features(text: str | None, lexer: Lexer) -> list[float]:
    """Largest clause, sum of clauses, matched clauses and their share, whether any."""
    n = matched = 0
    top = total = 0.0
    for words in clauses(text):
        n += len(words)
        if words and (score := clause_score(words, lexer)) > 0:
            matched += 1
            total += score
            top = max(top, score)
    return [min(top, 20.0), math.log1p(total), math.log1p(matched), matched / (1 + n) * 100, float(matched > 0)]


def _entries_of(word: bytes) -> Iterator[str]:
    text = word.decode("utf-8", "replace")
    if len(text) > 2:
        yield text
    for n in PREFIXES:
        if len(text) > n:
            yield text[:n] + "*"


def fixed_entries() -> dict[str, tuple[int, float]]:
    return {w: (symbol, FIXED_WEIGHT if symbol in (INSULT, THREAT) else 0.0) for symbol, words in FIXED.items() for w in words.split()}


def _training(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """(text, toxic) of the chosen labelled documents; at most ``rows`` pairs of numbers are broadcast."""
    chosen = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id_"))
    chosen = chosen.agg(F.max(label_col).cast("double").alias("toxic")).orderBy(F.xxhash64("id_"), "id_").limit(rows)
    texts = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    return texts.join(F.broadcast(chosen), "id_").select("text_", "toxic")


def learn_insults(sample: DataFrame) -> dict[str, tuple[int, float]]:
    """Entries of words that mark toxic documents, from rows (text_, toxic)."""
    sums = "entry string, toxic long, clean long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {w for c in clauses(text) for w in c}
                seen[toxic < 0.5].update({e for w in words for e in _entries_of(w)} | {""})
        names = list(seen[0])  # an entry that no toxic text has is never learned; its clean count alone is of no use
        both = names + [k for k in seen[1] if k not in seen[0]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(both, pa.string()), *(pa.array([s[k] for k in both], pa.int64()) for s in seen)], names=["entry", "toxic", "clean"]
        )

    counts = sample.mapInArrow(count, sums).groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).cache()
    whole = counts.filter("entry = ''").first()
    if whole is None or not whole["toxic"]:
        return {}
    pure = (F.col("toxic") >= MIN_CONTEXTS) & (F.col("toxic") >= PURITY * (F.col("toxic") + F.col("clean"))) & (F.col("entry") != "")
    rows = counts.filter(pure).orderBy(F.desc("toxic"), "entry").limit(4 * MAX_LEARNED).collect()  # bounded by the limit
    counts.unpersist()
    shared = sample.sparkSession.sparkContext.broadcast(frozenset(r["entry"] for r in rows))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = set()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if toxic >= 0.5:
                    words = [w for c in clauses(text) for w in c]
                    for i, w in enumerate(words):
                        for e in _entries_of(w):
                            if e in known:
                                found.add((e, xxhash.xxh64_intdigest(b" ".join(words[max(0, i - 1) : i] + words[i + 1 : i + 2])) >> 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())], names=["entry", "context"]
            )

    places = sample.mapInArrow(contexts, "entry string, context long").groupBy("entry").agg(F.countDistinct("context").alias("places"))
    kept = {r["entry"] for r in places.filter(F.col("places") >= MIN_CONTEXTS).collect()}  # of the bounded entries above
    out = {}
    for r in rows:
        if r["entry"] in kept and len(out) < MAX_LEARNED:
            odds = math.log((r["toxic"] + 0.5) / (whole["toxic"] + 1)) - math.log((r["clean"] + 0.5) / (whole["clean"] + 1))
            out[r["entry"]] = (INSULT, max(0.5, odds))
    return out


class Model:
    """Lexicon and calibration."""

    def __init__(self, entries: dict[str, tuple[int, float]], calibration: logistic.Logistic):
        self.entries, self.calibration = entries, calibration


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS
) -> Model:
    """Model from labelled documents; without toxic labels the fixed lists remain, uncalibrated."""
    sample = _training(docs, labels, id_col, text_col, label_col, train_rows).persist()
    entries = learn_insults(sample)
    entries = {**entries, **fixed_entries()} | {k: v for k, v in entries.items() if v[1] > FIXED_WEIGHT}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexer = Lexer(entries)
        for batch in batches:
            rows = [features(t, lexer) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    got = sample.mapInArrow(run, "x array<double>, y double").toPandas()  # a few numbers for each of at most train_rows
    sample.unpersist()
    x = np.array(got["x"].tolist(), float).reshape(-1, N_FEATURES)
    y = (got["y"].to_numpy(float) >= 0.5).astype(float)
    if not y.any() or y.all():
        plain = logistic.Logistic(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.array([0.0, 0, 0, 0, 4.0]), -2.0)
        return Model(entries, plain)
    order = np.lexsort((*x.T, y))
    return Model(entries, logistic.fit(x[order], y[order]))


def toxicity(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``score`` from 0 to 1 and ``predicted`` (1 from one half on), from the text alone.

    A null text counts as empty; an empty one gets the score of a text without matches. Repeated rows give repeated rows; other
    columns are ignored.
    """
    shared = Shared(docs.sparkSession, model)
    shown = "bigint" if docs.schema[id_col].dataType.simpleString() == "bigint" else "string"

    def start():
        known = shared.get()
        lexer, calibration = Lexer(known.entries), known.calibration

        def step(ids, texts):
            x = np.array([features(t, lexer) for t in texts], float).reshape(-1, N_FEATURES)
            score = 1 / (1 + np.exp(-np.clip(calibration.logits(x), -40, 40)))
            return {"id_": ids, "score": score, "predicted": (score >= 0.5).astype(np.int32)}

        return step

    fields = {"id_": pa.int64() if shown == "bigint" else pa.string(), "score": pa.float64(), "predicted": pa.int32()}
    picked = docs.select(F.col(id_col).cast(shown).alias("id_"), F.col(text_col).alias("text_"))
    return map_texts(picked, ["id_", "text_"], f"id_ {shown}, score double, predicted int", fields, start).withColumnRenamed("id_", id_col)


def fold(id_column: Column) -> Column:
    """Fold of a document: crc32 of its id as text, modulo 5."""
    return F.crc32(id_column.cast("string")) % 5
