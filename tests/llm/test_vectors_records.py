"""Vectors, WARC records and the pipeline."""

import gzip
import hashlib
import math
import random
from fractions import Fraction

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from polysift.llm import topk, warc
from polysift.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def brute_top(rows, k):
    usable = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for q, x in {i: x for i, x in reversed(usable) if i % 50 == 0}.items():
        scores = sorted((-int(x @ y), i) for i, y in usable if i != q and len(x) == len(y))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def test_top_k(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=8).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[50][1]) for i in range(30)]
    rows += [(2000, None), (2050, [None] * 8), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8), (None, rows[3][1]), (2200, [0.5, 0.5]), (2201, [1.0, 0.1]), (2250, [])]
    rows += [(7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4).withColumn("score", F.lit(1)).withColumn("id_", F.lit(1))
    got = sorted(tuple(x) for x in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert got == brute_top(rows, 5)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_in_blocks(spark):
    r = np.random.default_rng(2)
    rows = [(i, (r.normal(size=16) * r.choice((0.01, 1, 40))).tolist()) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, block_rows=64, query_rows=3)
    assert sorted(tuple(x) for x in got.collect()) == brute_top(rows, 5)


def exact_top(rows, k):
    """With Python's integers; scores are clamped to a long after ranking."""
    ints = [(i, [math.floor(Fraction(x) * 256) for x in v]) for i, v in rows]
    out = []
    for q, x in ints:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in ints if i != q)[:k]
            out += [(q, n + 1, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("size", [1e4, 1e7, 1e12, 1e17, 1e200, 1e307])
def test_top_k_of_large_components(spark, size):
    r = np.random.default_rng(int(math.log10(size)))
    rows = [(i, [float(x) for x in r.normal(size=6) / 8 * size]) for i in range(150)]
    rows += [(1000 + i, [i / 400 * size] * 6) for i in range(300)] + [(5000, [1.5] * 6), (5001, [-1e-9] * 6), (5050, [size, -size, 0.0, 1.0, 0.25, -0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, block_rows=128)
    assert sorted(tuple(x) for x in got.collect()) == exact_top(rows, 5)


def test_index_of_large_integers():
    """Scores within a long whose sums leave the range of exact doubles."""
    values = np.array([[i * 10**7] * 4 for i in range(300)], np.int64)
    index = topk.Index(np.arange(300, dtype=np.int64), values)
    rows, scores = index.best(values[299], 3, 299)
    assert index.ids[rows].tolist() == [298, 297, 296] and scores == [4 * 299 * i * 10**14 for i in (298, 297, 296)]


def test_scores_sort_as_text():
    scores = [0, 1, -1, 9, 10, -10, -9, 10**30, -(10**30), 10**30 + 1, 2**63, 123456789]
    assert sorted(scores, key=topk.sortable) == sorted(scores)


@pytest.mark.parametrize("d", [1, 4, 64])
def test_index_narrows_down_exactly(d):
    r = np.random.default_rng(d)
    values = np.floor(256 * r.normal(size=(2000, d)) / d**0.5).astype(np.int64)
    values[:40] = values[0]
    ids = r.permutation(2000).astype(np.int64)
    index = topk.Index(ids, values)
    for q in range(0, 2000, 97):
        rows, scores = index.best(values[q], 5, int(ids[q]))
        want = [i for i in np.lexsort((ids, -(values @ values[q]))) if ids[i] != ids[q]][:5]
        assert index.ids[rows].tolist() == ids[want].tolist() and scores == (values[want] @ values[q]).tolist()


PAGES = "page_id long, url string, html string"


def some_pages(n=600):
    r = random.Random(3)
    rows = [(i, f"http://h{i % 7}/é{i}", "<p>" + "x\r\n\r\n" * r.randint(0, 4) + f"{i}é") for i in range(n)]
    return rows + [(n, None, None), (n + 1, "u\r\nv", ""), (None, "n", "null id"), (5, "again", "b"), (5, "again", "b"), (10**5, "far", "y")]


def test_warc_files_and_manifest(spark, tmp_path):
    rows = warc.records(spark.createDataFrame(some_pages(), PAGES).repartition(5).withColumn("file", F.lit(1)))
    path = str(tmp_path / "warc")
    warc.write_warc(rows, path)
    read = warc.read_warc(spark, path).withColumn("number", F.regexp_extract("file", "file=(-?[0-9]+)", 1).cast("long"))
    found = {(r.number, r.offset): (r.length, r.sha256, r.uri, bytes(r.body)) for r in read.collect()}
    listed = {(r.file, r.offset): r for r in warc.manifest(rows).collect()}
    assert set(found) == set(listed)
    pages = {i: (u, h) for i, u, h in some_pages() if i not in (5, None)}
    for at, r in listed.items():
        length, digest, uri, body = found[at]
        assert (length, digest) == (r.length, r.sha256)
        if r.id_ in pages:
            assert body == (pages[r.id_][1] or "").encode() and uri == " ".join((pages[r.id_][0] or "").split("\r\n")).replace("u v", "u  v")


def test_audit_finds_what_differs(spark):
    pages = spark.createDataFrame(some_pages(), PAGES).repartition(3)
    ours = warc.manifest(warc.records(pages, per_file=40))
    same = warc.fixity(ours, ours)
    assert [tuple(r) for r in same.groupBy("status").count().collect()] == [("intact", len(some_pages()))]
    spoilt = F.when(F.col("id_") == 17, F.lit("0" * 64)).when(F.col("id_") != 333, F.col("sha256"))
    theirs = ours.withColumn("sha256", F.when(F.col("id_").isNull(), F.col("sha256")).otherwise(spoilt)).filter(~F.col("id_").eqNullSafe(F.lit(100)))
    extra = ours.filter("id_ = 200").withColumn("seq", F.lit(500).cast("long"))
    out = warc.fixity(ours, theirs.unionByName(extra)).filter("status != 'intact'")
    assert sorted(((r.id_, r.status) for r in out.collect()), key=repr) == sorted([(17, "corrupt"), (333, "missing"), (100, "missing"), (None, "extra")], key=repr)
    none = ours.limit(0)
    assert warc.fixity(none, none).count() == 0
    assert {r.status for r in warc.fixity(ours, none).collect()} == {"missing"}


@pytest.mark.parametrize("named", [True, False])
def test_one_lost_or_added_record_is_one_finding(spark, named):
    """Later records of the file move, and are found again by their digests."""
    pages = spark.createDataFrame([(i, "u", f"page {i}") for i in range(600)], PAGES)
    ours = warc.manifest(warc.records(pages))
    theirs = warc.manifest(warc.records(pages.filter("page_id != 5").unionByName(spark.createDataFrame([(300, "u", "another 300")], PAGES))))
    if not named:
        ours, theirs = ours.drop("id_"), theirs.drop("id_")
    found = [(r.status, r.seq) for r in warc.fixity(ours, theirs).filter("status != 'intact'").collect()]
    assert sorted(s for s, _ in found) == ["extra", "missing"] and ("missing", 5) in found


def record(body, name=b"Content-Length: ", version=b"WARC/1.1", end=b"\r\n", uri=b"http://x/"):
    head = [version, b"WARC-Type: resource", b"WARC-Target-URI: " + uri, name + str(len(body)).encode()]
    return end.join(head) + end + end + body


def test_other_spellings_of_records():
    bodies = [b"one", b"", b"two\r\n\r\nWARC/1.0\r\n", b"x" * 100_000]
    spelt = [record(bodies[0], version=b"WARC/1.0"), record(bodies[1], b"content-length:"), record(bodies[2], b"CONTENT-LENGTH :   "), record(bodies[3], end=b"\n", uri=b"<http://x/>")]
    whole = b"\r\n\r\n".join(spelt) + b"\r\n\r\n"
    members = b"".join(gzip.compress(r + b"\r\n\r\n") for r in spelt)
    for data in (whole, members, gzip.compress(whole)):
        rows = list(warc.parsed(data))
        assert [(uri, body) for _, _, uri, body, _ in rows] == [("http://x/", b) for b in bodies]
        assert [whole[at : at + n] for at, n, *_ in rows] == spelt
        assert [d for *_, d in rows] == [hashlib.sha256(r).hexdigest() for r in spelt]
    folded = b"WARC/1.0\r\nWARC-Target-URI: http://x/\r\n y\r\nContent-Length: 2\r\n\r\nok"
    assert [(u, b) for _, _, u, b, _ in warc.parsed(folded)] == [("http://x/ y", b"ok")]


def test_unreadable_records_and_members():
    good = record(b"good")
    for bad in (b"junk", b"WARC/1.0\r\nContent-Length: x\r\n\r\nbody", b"WARC/1.0\r\nno end"):
        rows = list(warc.parsed(good + b"\r\n\r\n" + bad + b"\r\n" + good))
        assert [r[3] for r in rows][0] == b"good" and [r[3] for r in rows][-1] == b"good" and None in [r[3] for r in rows]
    short = record(b"body")[:-1]
    assert [r[3] for r in warc.parsed(good + b"\r\n\r\n" + short)] == [b"good", None]
    parts = [gzip.compress(good + b"\r\n\r\n") for _ in range(3)]
    parts[1] = parts[1][:-9] + b"\x00" * 9
    bodies = [r[3] for r in warc.parsed(b"".join(parts))]
    assert bodies.count(b"good") >= 2 and bodies[0] == bodies[-1] == b"good"
    assert list(warc.parsed(b"")) == [] and list(warc.parsed(gzip.compress(b""))) == []


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    texts = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name == "byte_bpe":
            rows = out.collect()
            break
        out = corpus_pipeline.materialise(out, name)
        assert out.columns == columns and dict(out.dtypes) == dict(docs.dtypes)
        now = {r.doc_id: r for r in out.collect()}
        assert set(now) <= ids
        before = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
            assert sum((i in now) == (q == 1) for i, q in labels.items()) >= 0.95 * len(labels)
        if name == "near_duplicates":
            assert set(now) == {d for d, (_, c) in brute.components(list(before.items())).items() if c == d}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            windows = {tuple(w[s : s + 13]) for _, t in items for w in [brute.words_of(t)] for s in range(max(1, len(w) - 12)) if w}
            for d, t in before.items():
                w = brute.words_of(t)
                hit = {p for s in range(len(w)) for k in {len(x) for x in windows} if tuple(w[s : s + k]) in windows for p in range(s, s + k)}
                assert (d in now) == (not (hit and 20 * len(hit) >= len(w)))
        if name == "personal_data":
            assert set(now) == ids and all(not brute.EMAIL.search(r.text) and r.n_chars == len(r.text) for r in now.values())
            assert all(r.text == before[d] for d, r in now.items() if not brute.base_spans(before[d]) and "[" not in r.text)
        docs, ids, texts = out, set(now), {d: r.text for d, r in now.items()}
    assert {r.doc_id for r in rows} == ids
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids) for r in rows)


def test_every_operator_has_one_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(SQL) <= set(QUERIES) and corpus_pipeline.QUERIES["pipeline"] is corpus_pipeline.run
