"""Spelling variants against all pairs of words in plain Python."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from polysift.llm import spelling


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(words):
    """Sorted (word, form, root, n, n_near, form_n)."""
    near = {w: [v for v in words if v != w and one_apart(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def typos(r, word, letters):
    i = r.randint(0, len(word))
    return r.choice([word[:i] + r.choice(letters) + word[i:], word[: i - 1] + word[i:], word[:i] + r.choice(letters) + word[i + 1 :]])


def some_words(seed, letters, n):
    r = random.Random(seed)
    words = {"".join(r.choice(letters) for _ in range(r.randint(4, 12))) for _ in range(n)}
    for _ in range(3):
        words |= {typos(r, w, letters) for w in words}
    return {w: r.choice([3, 3, 4, 7, 20, 50, 400, 10**6]) for w in sorted(words) if len(w) >= 5}


@pytest.mark.parametrize(("letters", "n"), [("ab", 60), ("abcdéÿ", 90), ("abcdefghijklmnopqrstuvwxyz", 60)])
def test_variants_equal_all_pairs(spark, letters, n):
    words = some_words(len(letters), letters, n) | {"aaaaa": 9, "aaaaaa": 18, "aaaaaaa": 36, "ababababab": 5, "abababab": 5, "babababab": 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5).withColumn("key", F.lit(1)).withColumn("root", F.lit(""))
    assert sorted(tuple(r) for r in spelling.variants(df).collect()) == plain(words)


def test_pivots_and_prefixes_lose_no_pair():
    """Every pair one apart shares a key, asked by the word whose prefix ends first."""
    for letters in ("ab", "abcd", "abcdefghijkl"):
        words = some_words(1, letters, 150)
        counts = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
        table = sorted((k, g) for g, k in counts.items())
        ranks, sizes = {g: r for r, (_, g) in enumerate(table)}, [k for k, _ in table]
        keys = {w: spelling.keys_of(w, ranks, sizes) for w in words}
        for a, b in combinations(words, 2):
            if one_apart(a, b):
                a, b = sorted((a, b), key=lambda w: (keys[w][0], w))
                assert set(keys[a][1]) & set(keys[b][2]), (a, b)


def test_pivots_are_the_cheapest_disjoint_bigrams():
    r = random.Random(4)
    for _ in range(300):
        places = sorted(r.sample(range(12), r.randint(3, 7)))
        costs = [r.randint(1, 9) for _ in places]
        cost = dict(zip(places, costs, strict=True))
        p, q = spelling.pivots(places, costs)
        best = min(cost[a] + cost[b] for a, b in combinations(places, 2) if b >= a + 2)
        assert q >= p + 2 and cost[p] + cost[q] == best


def test_words_of_documents(spark):
    texts = ["Häuser HÄUSER häuser HÄuser", "İstanbul istanbul KKelvin Kelvin", "naïve-naïve naïve " * 2, None, "", "x1yyyyyz yyyyyz" * 3, "ΣΑΣ straße STRASSE straße", "word " * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "yyyyyz yyyyyz"), (3, "again again"), (3, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit("z") for c in ("id", "run", "word", "n")})
    counts = Counter()
    for _, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        counts.update(re.findall("[a-zÀ-ÿ]+", lower))
    want = {w: n for w, n in counts.items() if len(w) >= 4 and n >= 2}
    assert {r.word: r.n for r in spelling.word_counts(df, least_length=4, least_count=2).collect()} == want
    changed = Counter()
    for i, text in rows:
        for w in re.findall("[a-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            changed[w[1:] if zlib.crc32(f"{'' if i is None else i}:{w}".encode()) % 3 == 0 else w] += 1
    got = spelling.word_counts(
        df, change=lambda run, i: F.when(F.crc32(F.concat(i, F.lit(":"), run)) % 3 == 0, F.substring(run, 2, 10**6)).otherwise(run), least_length=1, least_count=1
    )
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in changed.items() if w}
    assert spelling.variants(spelling.word_counts(df.limit(0))).count() == 0
