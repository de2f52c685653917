"""Spelling variants: words one edit apart, each hung on its most frequent neighbour.

Bigrams are ranked, rare ones first; a word's prefix are its three first bigrams and those that tie with the third, each with its
place. Two disjoint bigrams of the prefix, those of least total frequency, are its pivots, found by dynamic programming over
places. One edit spoils at most one of two disjoint bigrams, so of two words one edit apart, the one whose prefix ends
first (ties by the words) has a pivot that is whole in the other word, and there it lies in the prefix.

A whole pivot has the edit wholly on one side. Its position limits are therefore strict: up to and with the pivot, or
from it on, the words are equal, and lengths differ by at most one. Index keys are this equal side, the length, and the two code points
at the other end of the word; an edit that reaches these two leaves everything before (or behind) them equal, which is a key of its
own. Candidates that share a key are verified by their edit distance.

Words are counted by partial aggregation before anything moves; the table of bigrams has at most 90 * 90 rows, as words have 90
letters, and is the only thing that is broadcast. Keys are 64-bit hashes: a clash costs a verification, never a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polysift.llm.common import Shared
from polysift.scratch import discard, materialise

#: Runs of these letters are words: 26 lower-case ones and the 64 from U+00C0 to U+00FF.
RUN = r"[a-z\u00C0-\u00FF]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form is at least so many times as frequent.
FACTOR = 2
#: Bigrams of a prefix: those that one edit can spoil, and one more.
PREFIX = 3
#: Texts that Unicode lower-casing changes in no other way than A-Z: ASCII, lower-case Latin-1, punctuation, scripts without case.
_PLAIN = r"^[\x00-\x7F\u00A0-\u00BF\u00D7\u00DF-\u00FF\u2000-\u206F\u3000-\u9FFF]*$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", change: Callable[[Column, Column], Column] | None = None,
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n): runs of letters of whole texts, A-Z lower-cased, after ``change(run, id)``, that are long and frequent enough.

    A null text has none; a null id counts as empty text.
    """
    text = F.col(text_col)
    lower = F.when(text.rlike(_PLAIN), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(ident.alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    word = change(F.col("run"), F.col("id")) if change else F.col("run")
    counts = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.length("word") >= least_length) & (F.col("n") >= least_count))


def pivots(places: list[int], costs: list[int]) -> tuple[int, int]:
    """Of bigrams at ascending places, the two disjoint ones of least total cost (ties: the first found).

    ``best[j]`` is the cheapest choice of ``j`` bigrams that all end before the one at hand begins.
    """
    one: list[tuple[int, int]] = []  # by bigram: the cheapest up to it
    both: tuple[int, int, int] | None = None
    behind = -1
    for place, cost in zip(places, costs, strict=True):
        while behind + 1 < len(one) and places[behind + 1] <= place - 2:
            behind += 1
        if behind >= 0:
            total = one[behind][0] + cost
            if both is None or total < both[0]:
                both = (total, one[behind][1], place)
        one.append(min(one[-1], (cost, place)) if one else (cost, place))
    return both[1:]


def keys_of(word: str, ranks: dict[str, int], sizes: list[int]) -> tuple[int, list[str], list[str]]:
    """Rank of the prefix's last bigram, the keys under which the word looks for others, and those under which it is found.

    ``sizes[r]`` is the frequency of the bigram of rank ``r``.
    """
    n = len(word)
    order = sorted((ranks[a + b], i) for i, (a, b) in enumerate(pairwise(word)))
    last = order[PREFIX - 1][0]
    prefix = sorted((i, r) for r, i in order if r <= last)
    asks = [f"T{word[2:]}", f"H{word[:-2]}"]
    listed = [f"T{word[k:]}" for k in (1, 2, 3)] + [f"H{word[:-k]}" for k in (1, 2, 3)]
    chosen = pivots([i for i, _ in prefix], [sizes[r] for _, r in prefix])
    for i, _ in prefix:
        sides = []
        if i + 2 <= n - 2:
            sides.append(f"L{word[:i + 2]} {word[-2:]}")
        if i >= 2:
            sides.append(f"R{word[i:]} {word[:2]}")
        listed += [f"{s}{n}" for s in sides]
        if i in chosen:
            asks += [f"{s}{m}" for s in sides for m in (n - 1, n, n + 1)]
    return last, asks, listed


def _keyed(words: DataFrame) -> DataFrame:
    """(word, n, last, asks, listed) of words (word, n)."""
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, 2))).alias("gram"))
    table = sorted((r["n"], r["gram"]) for r in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect())
    shared = Shared(words.sparkSession, ({g: r for r, (_, g) in enumerate(table)}, [n for n, _ in table]))
    kinds = {"word": pa.string(), "n": pa.int64(), "last": pa.int32(), "asks": pa.list_(pa.int64()), "listed": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, sizes = shared.get()
        hashed = lambda keys: [xxhash.xxh3_64_intdigest(k) - (1 << 63) for k in set(keys)]
        for batch in batches:
            found = [keys_of(w, ranks, sizes) for w in batch.column(0).to_pylist()]
            parts = [[f[0] for f in found], [hashed(f[1]) for f in found], [hashed(f[2]) for f in found]]
            arrays = [batch.column(0), batch.column(1)] + [pa.array(p, k) for p, k in zip(parts, list(kinds.values())[2:], strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=list(kinds))

    return words.select("word", "n").mapInArrow(run, "word string, n long, last int, asks array<long>, listed array<long>")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, m): both directions of all pairs of words (word, n) that differ by one inserted, deleted or replaced code point.

    Words have at least four code points, so that three bigrams are left to choose from, and letters of ``RUN`` only.
    """
    keyed = materialise(_keyed(words), "spelling-keys")
    a = keyed.select(F.col("word").alias("a"), F.col("n").alias("na"), F.col("last").alias("la"), F.explode("asks").alias("key"))
    b = keyed.select(F.col("word").alias("b"), F.col("n").alias("nb"), F.col("last").alias("lb"), F.explode("listed").alias("key"))
    first = F.struct("la", "a") < F.struct("lb", "b")
    met = a.join(b, "key").filter(first & (F.levenshtein("a", "b", 1) == 1)).select("a", "na", "b", "nb").distinct()
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("other"), F.col("nb").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("nb").alias("n"), F.col("a").alias("other"), F.col("na").alias("m")),
    )
    return met.select(F.explode(sides).alias("s")).select("s.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the end of the chain of forms, by pointer jumping.

    Frequencies at least double along a chain, so it has fewer links than a count has bits, and the rounds are their logarithm.
    """
    out = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = out.select(F.col("word").alias("at"), F.col("root").alias("next"))
        jumped = out.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        done = materialise(jumped, "spelling-roots")
        moved = done.agg(F.max("moved")).first()[0]
        discard(out)
        out = done.drop("moved")
        out._scratch_path = done._scratch_path
        if not moved:
            return out


def variants(words: DataFrame, *, factor: int = FACTOR) -> DataFrame:
    """One row per word (word, n): word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest count (ties: the smallest in code-point order) if that is at least ``factor`` times
    the word's own, else null; ``root`` the end of the chain of forms, the word itself without one. Words must be distinct. An empty table
    gives no rows.
    """
    words = materialise(words.select("word", "n"), "spelling-words")
    near = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("form"))).alias("best")
    )
    known = words.join(near.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left")
    large = -F.col("best.less") >= factor * F.col("n")
    told = materialise(
        known.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(large, F.col("best.form")).alias("form"),
            F.when(large, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(told.filter("form is not null")).withColumnRenamed("word", "of")
    return told.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
