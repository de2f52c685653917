"""The Merkle manifest against a plain Python tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from polysift.llm import manifest

DOCS = "doc_id long, source string, lang string, n_chars long, text string"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests, fanout):
    """(root, siblings of every leaf by level as (left, right))"""
    steps = [[] for _ in digests]
    at = list(range(len(digests)))
    while len(digests) > 1:
        for i, p in enumerate(at):
            start = p // fanout * fanout
            run = digests[start : start + fanout]
            steps[i].append(("".join(run[: p - start]), "".join(run[p - start + 1 :])))
            at[i] = p // fanout
        digests = [digest(*digests[s : s + fanout]) for s in range(0, len(digests), fanout)]
    return (digests[0] if digests else None), steps


def plain(rows, fanout=2):
    """Sorted (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    parts = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    trees = {g: tree([leaf(r) for r in rs], fanout) for g, rs in parts.items()}
    root, above = tree([trees[g][0] for g in langs], fanout)
    out = []
    for g, up in zip(langs, above, strict=True):
        for r, steps in zip(parts[g], trees[g][1], strict=True):
            seen = list(r)
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                seen[3] += 1
            folded = leaf(seen)
            for left, right in steps + up:
                folded = digest(left, folded, right)
            proof = digest(*(a + b for a, b in steps + up))
            out.append((r[0], leaf(r), trees[g][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def spark_rows(spark, rows, **options):
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = {"n_chars": F.when(touched, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    for name in ("pos", "total", "digest", "group_", "tie_", "slots", "steps", "root", "leaf"):
        df = df.withColumn(name, F.lit(name))
    return manifest.verified(manifest.manifest(df, FIELDS, changed=changed, **options))


def some_rows(n, langs, seed=1):
    r = random.Random(seed)
    texts = ["", "é" * 50, "plain", None, "x" * 30_000]
    rows = [(i * 7, r.choice(["s", None, ""]), r.choice(langs), r.choice([i, None]), r.choice(texts)) for i in range(n)]
    rows += [rows[0]] * 40 + [(3, "s", langs[0], 1, "a"), (3, "s", langs[0], 1, "b"), (None, None, None, None, None), (None, "", langs[0], 0, "")]
    return rows


@pytest.mark.parametrize(("fanout", "levels"), [(2, 4), (2, 1), (3, 2)])
def test_manifest_equals_a_plain_tree(spark, fanout, levels):
    rows = some_rows(230, ["en", "en", "de", "é", "", None])
    got = sorted((tuple(r) for r in spark_rows(spark, rows, fanout=fanout, levels=levels).collect()), key=repr)
    assert got == plain(rows, fanout)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_trees_of_any_height(spark, n):
    rows = [(i, "s", "en", 5, str(i)) for i in range(n)]
    got = sorted((tuple(r) for r in spark_rows(spark, rows).collect()), key=repr)
    assert got == plain(rows)
    if n == 1:
        assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == digest("")


def test_only_what_was_tampered_with_fails(spark):
    out = spark_rows(spark, [(i, "s", None if i % 3 else "en", i, "t") for i in range(100)]).collect()
    assert {r.doc_id for r in out if not r.verified} == {i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 0}
