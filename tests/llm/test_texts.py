"""Operators over texts against plain Python, with odd rows: nulls, empty and long texts, repeats, clashing columns."""

import base64
import hashlib
import random
import re
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from polysift.llm import bpe, decontaminate, html_main, licenses, ngram_join, pii, quality, toxicity
from polysift.llm.components import components

DOCS = "doc_id long, text string"


def frame(spark, rows, schema=DOCS, **extra):
    df = spark.createDataFrame(rows, schema).repartition(3)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=300, seed=1):
    r = random.Random(seed)
    parts = ["the", " cat", "'s", "\n", "\t ", " 12", "é", "中文", "😀", "!!", "  ", " ", "\x1c", "x" * 40, "<|endoftext|>", "\u0085"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)] + ["", "ab" * 1_500, "é" * 5000]


def test_perfect_hash_has_a_slot_for_every_key():
    keys = [str(i).encode() for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert sorted(h.slot(k) for k in keys) == list(range(5000))
    assert all(keys[h.key_at[h.slot(k)]] == k for k in keys)


def test_bpe_equals_the_reference_library(vocabulary, reference):
    encoder = bpe.Encoder(vocabulary)
    for text in odd_texts():
        ids = encoder.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert vocabulary.decode(ids) == text.encode()
    for cp in [*range(0, 0x3100), 0x1680, 0x180E, 0xFEFF, *range(0x1F600, 0x1F650)]:
        text = f"a{chr(cp)}b 1{chr(cp)}2  {chr(cp)}"
        assert encoder.encode(text) == reference.encode_ordinary(text)


def test_bpe_rows(spark, vocabulary, reference):
    rows = [*enumerate(odd_texts(40)), (900, None), (901, ""), (None, "null id"), (5, "again"), (5, "again")]
    df = frame(spark, rows, n_tokens=1, ids="x", id_="y")
    got = bpe.round_trip(df, vocabulary, with_ids=True).collect()
    assert len(got) == len(rows)
    want = sorted(
        (
            (i is None, i or 0, len(ids := reference.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((t or "").encode()).hexdigest(), ids)
            for i, t in rows
        )
    )
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.ids)) for r in got) == want
    assert bpe.round_trip(frame(spark, []), vocabulary).count() == 0
    back = bpe.decode(bpe.encode(df, vocabulary), vocabulary).select("text", "decoded").collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back)


def random_docs(seed=2, n=60):
    r = random.Random(seed)
    items = [(i, " ".join(r.choice("abcdefg") for _ in range(k))) for i, k in enumerate((0, 1, 3, 12, 13, 14, 30, 30))] + [(8, None), (8, "Q r s"), (9, "Ünï cödé"), (None, "b c d"), (None, "B, c d"), (None, None), (None, " ".join("abcdefghi" * 4))]
    docs = []
    for d in range(n):
        words = [r.choice("abcdefghi") + r.choice(("", "", "1")) for _ in range(r.randint(0, 40))]
        if r.random() < 0.6:
            words[r.randint(0, len(words)) : 0] = (r.choice(items)[1] or "").upper().split()
        docs.append((d, r.choice((" ", ", ", "\n- ")).join(words)))
    return docs + [(900, None), (901, ""), (902, "ünï, CÖDÉ! Ünï cödé")], items


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_contamination(spark, block_words):
    docs, items = random_docs()
    bench = frame(spark, items, "item_id long, text string", doc_id=1)
    got = by_id(decontaminate.contamination(frame(spark, docs, n_words=7, items="x"), bench, block_words=block_words))
    want = brute.contamination(docs, items)
    texts = dict(docs)
    for d, (n_words, n_hit, ids, n_items) in want.items():
        r = got[d]
        assert (r.n_words, r.n_hit, r.n_items, r["items"]) == (n_words, n_hit, n_items, ids)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert r.contaminated == (n_hit > 0 and 20 * n_hit >= n_words)
        assert sum(len(brute.words_of(texts[d][s.start : s.end])) for s in r.spans) == n_hit
    kept = decontaminate.drop_contaminated(frame(spark, docs, n_words=7), bench, block_words=block_words)
    assert {r.doc_id for r in kept.collect()} == {d for d, (n, h, *_) in want.items() if not (h and 20 * h >= n)}
    assert kept.columns == ["doc_id", "text", "n_words"]


def test_items_without_an_id_hit_words(spark):
    bench = frame(spark, [(None, "alpha beta"), ("i1", "gamma")], "item_id string, text string")
    [r] = decontaminate.contamination(frame(spark, [(1, "alpha beta gamma")]), bench).collect()
    assert (r.n_hit, r.n_items, r["items"]) == (3, 2, ["i1"])


def test_a_long_item_is_cut_without_losing_a_window(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 40)
    words = [f"w{i}" for i in range(500)]
    docs = [(at, " ".join(["x", *words[at : at + 13], "y"])) for at in range(0, 488)]
    for block_words in (1_000_000, 100):
        out = by_id(decontaminate.contamination(frame(spark, docs), frame(spark, [(1, " ".join(words))], "item_id long, text string"), block_words=block_words))
        assert all(r.n_hit == 13 and r["items"] == ["1"] for r in out.values()) and len(out) == 488


def test_contamination_without_rows(spark):
    none = frame(spark, [], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(frame(spark, [(1, "a b")]), none).collect()] == [0]
    assert decontaminate.contamination(frame(spark, []), none).count() == 0


PIECES = ["a", "b.", "@", "x@y.zz", ".", "1", "22", "333", "255", "256", " ", "-", "+", "(", ")", "_", "%", "é", "😀", "\n", "4111111111111111",
          "4111 1111-1111 1111", "+1 (017) 555-7713", "1.2.3.4", "000.0.255.0001", "DE89 3704 0044 0532 0130 00", "phone 030 1234567", "ssn 123-45-6789"]


def test_base_spans_of_personal_data(spark):
    r = random.Random(3)
    docs = [(i, "".join(r.choice(PIECES) for _ in range(r.randint(0, 50)))) for i in range(400)]
    docs += [(900, None), (901, ""), (902, "1." * 3000), (903, "a@b.c " * 700), (904, "a" * 4_000), (905, "7" * 30_000), (906, "x@" + "a." * 20_000 + "b")]
    got = by_id(pii.personal_data(frame(spark, docs, found=1, kind="k")))
    base = {k.name for k in pii.BASE}
    for d, text in docs:
        assert [(s.kind, s.start, s.end) for s in got[d].found if s.kind in base] == brute.base_spans(text)


def test_checks_and_context_of_added_kinds(spark):
    docs = [
        (1, "pay to DE89 3704 0044 0532 0130 00 now"), (2, "pay to DE88 3704 0044 0532 0130 00 now"), (3, "my SSN is 123-45-6789"),
        (4, "part 123-45-6789"), (5, "call me: 030 1234567"), (6, "lot 030 1234567"),
    ]
    got = by_id(pii.personal_data(frame(spark, docs)))
    kinds = {d: [s.kind for s in got[d].found] for d, _ in docs}
    assert kinds == {1: ["iban"], 2: [], 3: ["ssn"], 4: [], 5: ["tel"], 6: []}
    masked = by_id(pii.masked(frame(spark, [*docs, (7, None), (8, "a@b.c, x@y.z!")])))
    assert masked[1].text == "pay to [IBAN] now" and masked[2].text == docs[1][1] and masked[7].text is None
    assert masked[8].text == "[EMAIL], [EMAIL]!"


def near_copies(r, base, m, share):
    return [" ".join(w if r.random() > share else f"z{r.randrange(10**6)}" for w in base) for _ in range(m)]


def join_docs(seed):
    r = random.Random(seed)
    texts = ["", " ", None, "\t\n", "a b c", "A b  c", "a b c", "a b c d e f", "a b c d e f"]
    for n, m, share in ((40, 60, 0.03), (12, 10, 0.05), (100, 15, 0.02), (7, 15, 0.05), (30, 5, 0.1)):
        texts += near_copies(r, [f"w{r.randrange(300)}" for _ in range(n)], m, share)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"q{r.randrange(10**7)}" for _ in range(r.randint(5, 25))) for _ in range(25)]
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("rare", "hot"), [(32, 256), (3, 256), (3, 8)])
def test_join_components(spark, monkeypatch, rare, hot):
    monkeypatch.setattr(ngram_join, "RARE_COUNT", rare)
    monkeypatch.setattr(ngram_join, "HOT_KEY", hot)
    docs = join_docs(4)
    df = frame(spark, docs, n=1, key="k", node=5, component_id=9)
    got = by_id(ngram_join.similar_components(df))
    assert {d: (got[d].n_shingles, got[d].component_id) for d, _ in docs} == brute.components(docs)


def test_members_of_hot_keys_meet_in_bounded_tiles(spark, monkeypatch):
    """A passage in many texts and a large group of near copies: tables grow with the members, not with their square."""
    r = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(24))
    texts = [f"{passage} " + " ".join(f"q{r.randrange(10**7)}" for _ in range(r.randint(6, 10))) for _ in range(240)]
    texts += near_copies(r, [f"w{i}" for i in range(60)], 120, 0.03) + texts[:5]
    docs = list(enumerate(texts))
    for name, value in (("RARE_COUNT", 3), ("HOT_KEY", 32), ("TILE", 16)):
        monkeypatch.setattr(ngram_join, name, value)
    rows, hot = {}, []
    materialise, tiles = ngram_join.materialise, ngram_join._hot_tiles

    def counted(df, name):
        out = materialise(df, name)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    def tiled(*args):
        members, pairs = tiles(*args)
        sizes = [x["count"] for x in members.groupBy("chunk").count().collect()]
        hot.extend([sum(sizes), max(sizes), pairs.count(), pairs.distinct().count()])
        return members, pairs

    monkeypatch.setattr(ngram_join, "materialise", counted)
    monkeypatch.setattr(ngram_join, "_hot_tiles", tiled)
    got = by_id(ngram_join.similar_components(frame(spark, docs)))
    assert {d: (got[d].n_shingles, got[d].component_id) for d, _ in docs} == brute.components(docs)
    members, largest, pairs, distinct = hot
    assert members > 200 and largest <= 40 and pairs == distinct
    assert max(rows.values()) < 240 * 240 / 4, rows


def test_join_odd_rows(spark):
    docs = [(5, "one two three four five six"), (5, "one two three four five six"), (None, "one two three four five six"), (7, None), (8, "")]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.similar_components(frame(spark, docs)).collect())
    assert got == [(-1, 2, 5), (5, 2, 5), (5, 2, 5), (7, 0, 7), (8, 0, 8)]
    assert ngram_join.similar_components(frame(spark, [])).count() == 0
    kept = ngram_join.first_of_components(frame(spark, [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None)], n_chars=3))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3] and kept.columns == ["doc_id", "text", "n_chars"]


def test_prefixes_of_similar_sets_share_a_key():
    import numpy as np

    r = np.random.default_rng(6)
    for _ in range(300):
        n = int(r.integers(3, 200))
        x = np.unique(r.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        lost = int(r.integers(0, len(x) // 7 + 1))
        y = np.unique(np.concatenate((r.permutation(x)[lost:], r.integers(0, 2**63, lost).astype(np.uint64))))
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both):
            continue
        pool = np.concatenate((x, y))
        counted = pool[pool < ngram_join._LIMIT]
        frequent = np.unique(ngram_join._class_ids(r.permutation(counted)[: len(counted) * int(r.integers(0, 5)) // 4], 7))
        a, b = (ngram_join.prefix_keys(s, frequent, 7, 75) for s in (x, y))
        assert len(np.intersect1d(a[0], b[0])) or len(np.intersect1d(a[1], b[1]))
        low = np.minimum(*(np.frombuffer(ngram_join._sketch(s), np.uint8).astype(int) for s in (x, y)))
        assert low.sum() >= both


def test_connected_components(spark):
    r = random.Random(8)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(30)] + [(400, 400 + i) for i in range(1, 40)]
    links += [(None, 5), (6, 6), *links[:5]]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def top(v):
        while root.setdefault(v, v) != v:
            v = root[v]
        return v

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    assert got == {v: top(v) for v in root}


def test_quality(spark):
    r = random.Random(9)
    good = lambda: " ".join(r.choice(("alpha", "beta", "gamma", "delta", "of", "the")) + r.choice(("", "", ",")) for _ in range(r.randint(20, 80)))
    junk = lambda: (r.choice(("BUY", "WIN")) + "!! ") * r.randint(20, 80)
    rows = [(i, junk() if i % 4 == 0 else good(), "bad.example" if i % 8 == 0 else f"h{i % 3}", "en") for i in range(240)]
    rows += [(900, None, None, None), (901, "", "h1", None), (None, good(), "h1", "en")]
    docs = frame(spark, rows, "doc_id long, text string, source string, lang string", host=1, probability=2, n=3)
    labels = frame(spark, [(i, int(i % 4 != 0)) for i in range(0, 240, 3)] + [(3, None), (None, 1)], "doc_id long, quality int")
    out = quality.quality(docs, labels)
    got = by_id(out)
    assert out.count() == len(rows)
    assert sum(got[i].keep == (i % 4 != 0) for i in range(240)) >= 236
    assert got[0].host_rate < got[1].host_rate
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.keep}
    unlabelled = quality.quality(docs, labels.limit(0))
    assert unlabelled.filter("keep").count() == len(rows)
    assert quality.quality(docs.limit(0), labels).count() == 0


def test_sparse_sites_shrink_to_their_parents(spark):
    rows = [("big", "a", 0.1)] * 200 + [("big", "b", 0.9)] * 3 + [(f"h{i}", "a", 0.9) for i in range(60)] + [("mid", "a", 0.2)] * 20
    groups, prior = quality.posteriors(spark.createDataFrame(rows, "host string, path string, p double"))
    rated = quality._combined(groups.withColumn("own", F.col("s") / F.col("n")).withColumn("logit", F.lit(0.0)), prior)
    rate = {(r.host, r.path): (r.host_rate, r.path_rate) for r in rated.collect()}
    assert rate["big", "a"][0] < prior["corpus"] < rate["h1", "a"][1] + 1e-9
    host, path = rate["big", "b"]
    assert abs(path - host) < abs(path - 0.9)


def test_toxicity(spark):
    r = random.Random(10)
    words = ["river", "table", "green", "walks", "seven", "often", "paper", "stone"]
    rows, labels = [], []
    for i in range(600):
        text = [r.choice(words) + r.choice(("", "", ".")) for _ in range(r.randint(10, 60))]
        toxic = i % 6 == 0
        if toxic:
            text.insert(r.randint(0, len(text)), r.choice(("grobnak", "grobnaken", "vexil", "idiot")))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (902, "he said " + "word " * 50_000)]
    docs = frame(spark, rows, score=1, predicted="x", toxic=5)
    train = frame(spark, [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5], "doc_id long, toxic int")
    got = by_id(toxicity.toxicity(docs, toxicity.fit(docs, train)))
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].predicted == y for i, y in held) >= 0.97 * len(held)
    assert all(0 <= x.score <= 1 for x in got.values()) and got[900].score == got[901].score
    assert by_id(docs.select("doc_id", toxicity.fold(F.col("doc_id")).alias("f")))[17].f == zlib.crc32(b"17") % 5
    plain = toxicity.fit(docs.limit(0), train.limit(0))
    assert by_id(toxicity.toxicity(frame(spark, [(1, "you idiot"), (2, "fine")]), plain))[1].predicted == 1


def test_grammar_weighs_clauses():
    lexer = toxicity.Lexer(toxicity.fixed_entries())
    score = lambda t: max(toxicity.clause_score(c, lexer) for c in toxicity.clauses(t))
    assert score("you are an idiot") > score("an idiot") > score("not an idiot") > 0
    assert score("she wrote a long note calling them an idiot") < score("calling them an idiot")
    assert score("i will kill you") > score("frost will kill grass")
    assert score("you. idiot") == score("idiot") and score("nice day") == 0


def test_html(spark):
    model = html_main.fitted()
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href="/a">Menu</a></li>'
        '<li><a href="/b">More</a></li></ul></nav><!-- ad <p>x</p> --><div class="ad">Buy this now, only today.</div><article><h1>A title &amp; more</h1>'
        "<p><b>First   paragraph,\n with some text in it, and a bit more.<br><p>Second one goes on &lt;here&gt; for a while, too.</article>"
        '<section class="comments"><p>I liked it.</p></section><footer>&copy; someone, 2020</footer></body></html>'
    )
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "v", ""), (None, "w", "<" * 3000), (4, "x", "<div>" * 3000 + "deep"), (5, "y", '<p class="a>broken'), (6, "z", page.replace("</p>", "").replace("</li>", ""))]
    got = html_main.extract_all(frame(spark, rows, "page_id long, url string, html string", text=1, n_chars=2), model).collect()
    want = "A title & more\nFirst paragraph, with some text in it, and a bit more.\nSecond one goes on <here> for a while, too."
    texts = sorted((r.page_id or 0, r.text, r.n_chars) for r in got)
    assert len(got) == len(rows) and [t for t in texts if t[0] == 1] == [(1, want, len(want))] * 2
    assert [t[1] for t in texts if t[0] in (2, 3)] == ["", ""]
    assert html_main.extract_all(frame(spark, [], "page_id long, url string, html string"), model).count() == 0


def test_html_labels_on_new_pages():
    model = html_main.fitted()
    exact = shown = 0
    for html, labels in html_main.training_pages(80, seed=123):
        blocks, runs = html_main.read(html)
        rows = [i for i, b in enumerate(blocks) if not b.hidden]
        assert len(rows) == len(labels)
        truth = dict(zip(rows, labels, strict=True))
        found = html_main.decode(blocks, model.log_probabilities(html_main.block_features(blocks)))
        for i, b in enumerate(blocks[1:], 1):
            assert found[blocks[i].parent] != html_main.DROP or found[i] == html_main.DROP
        shown += 1
        exact += all((found[b] == html_main.MAIN) == (truth.get(b) == html_main.MAIN) for b, _ in runs)
    assert exact >= 0.85 * shown


def plain_license_lines(text, model):
    """The operator in plain Python: windows of a text's paragraphs, scored, confirmed and joined."""
    tokens = []
    for i, line in enumerate((text or "").lower().replace("licence", "license").split("\n") if text is not None else ()):
        words = re.findall(licenses._WORD, line)
        tokens += [(w, i) for w in words] or [("", -1)] * (licenses.WINDOW + licenses.STEP)
    known = set(model.grams)
    held = {}
    for at, (w, line) in enumerate(tokens):
        after = tokens[at + 1][0] if at + 1 < len(tokens) else ""
        for g in {w, f"{w} {after}" if w and after else w} & known:
            for win in {at // licenses.STEP, max(0, at // licenses.STEP - 1)}:
                held.setdefault(win, []).append((at, line, g))
    place = {g: i for i, g in enumerate(model.grams)}
    some = []
    for win, found in sorted(held.items()):
        rows = {place[g] for *_, g in found}
        z = np.array(model.bias) + sum((np.array(model.weights[r]) for r in sorted(rows)), np.zeros(len(model.classes)))
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        top = int(z.argmax())
        if model.classes[top] == licenses.NONE:
            continue
        confirmed = any(c == top and len(rows & set(t)) >= need for c, t, need in model.templates)
        sure = model.classes[top] != licenses.UNKNOWN and p[top] >= licenses.THRESHOLD and confirmed
        some.append((win, min(found)[1], model.classes[top] if sure else licenses.UNKNOWN, p[top] if sure else p[-2]))
    kept = [x for x in some if x[2] != licenses.UNKNOWN or not any(y[2] != licenses.UNKNOWN and abs(y[0] - x[0]) <= 1 for y in some)]
    starts = [x for x in kept if not any(y[2] == x[2] and y[0] == x[0] - 1 for y in kept)]
    return sorted((x[1], x[2], max(y[3] for y in kept if y[2] == x[2] and y[0] - x[0] in (0, 1))) for x in starts)


def license_families(spark, texts):
    out = by_id(licenses.license_lines(frame(spark, list(enumerate(texts))), licenses.fitted()))
    return [sorted({x.family for x in out[i]["lines"]}) for i in range(len(texts))]


def test_licenses_equal_plain_python(spark):
    model = licenses.fitted()
    r = random.Random(2)
    pool = [t for ts in (*licenses.TEMPLATES.values(), *licenses.NAMES.values()) for t in ts] + list(licenses._PROSE) + list(licenses._PROPRIETARY) + ["x y z " * 9, "not", "", " \t"]
    texts = ["".join(r.choice(pool) + r.choice((" ", "\n", "\n\n", "\n \n")) for _ in range(r.randint(1, 9))) for _ in range(120)]
    texts += [None, "", "\n\n", "word " * 30_000 + "\nReleased under the MIT License.", "MIT", "not", "LICENCE"]
    rows = [*enumerate(texts), (None, texts[0]), (None, texts[1]), (3, texts[3]), (3, "other")]
    out = licenses.license_lines(frame(spark, rows, lines=1, family="x", win=2, held="y"), model)
    assert out.columns == ["doc_id", "lines"]
    got = sorted(((row.doc_id, [(x.line, x.family) for x in row["lines"]]) for row in out.collect()), key=repr)
    assert got == sorted(((i, [x[:2] for x in plain_license_lines(t, model)]) for i, t in rows), key=repr)
    sure = {row.doc_id: [x.probability for x in row["lines"]] for row in out.collect() if row.doc_id not in (None, 3)}
    for i, t in rows:
        if i in sure:
            assert sure[i] == pytest.approx([x[2] for x in plain_license_lines(t, model)], abs=1e-5)
    assert licenses.license_lines(frame(spark, []), model).count() == 0


def test_templates_are_found(spark):
    for family, texts in licenses.TEMPLATES.items():
        assert license_families(spark, [f"Some text.\n{t}\nMore." for t in texts]) == [[family]] * len(texts)


def test_near_licences_and_denials(spark):
    affero = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
    unknown = [licenses.UNKNOWN]
    cases = {
        affero: ["AGPL-3.0"],
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["CC-BY-SA"],
        "This work is licensed under CC BY-ND 4.0.": ["CC-BY-ND"],
        "This work is licensed under CC BY-NC-SA 4.0.": unknown,
        "Licensed under the Acme Proprietary License, Version 2.0.": unknown,
        "This project is not licensed under the terms of the MIT license.": unknown,
        "This library is not released under the GNU Lesser General Public License.": unknown,
        "The code is available under the MIT licence.": ["MIT"],
        "Use of this code is governed by the Mozilla Public License 2.0.": ["MPL-2.0"],
        "You need a driving license to rent this car.": [],
        "Copyright law protects authors.": [],
    }
    assert license_families(spark, list(cases)) == list(cases.values())


def test_probabilities_on_licences_never_trained_on(spark):
    """Other licences are unknown, and how sure the model is of families and of the unknown class holds on new wordings."""
    model = licenses.fitted()
    others = ["Zope Public License 2.1", "Boost Software License 1.0", "Academic Free License version 3.0", "Open Software License 3.0", "CeCILL License 2.1", "Mulan PSL v2",
              "University of Illinois Open Source License", "Sleepycat License", "Ruby License", "Vim License", "Intel Open Source License", "LaTeX Project Public License 1.3c"]
    wordings = ["Our tool ships under the {}.", "Code in this folder: {}.", "{} applies to all files here.", "Contributions are accepted under the {} only."]
    judged = [(w.format(n), licenses.UNKNOWN) for n in others for w in wordings]
    judged += [(w.format(ns[0]), f) for f, ns in licenses.NAMES.items() for w in wordings]
    sure = []
    for text, want in judged:
        p = model.probabilities(licenses.words_of(text))
        sure.append((p.max(), model.classes[int(p.argmax())] == want))
    right = sum(r for _, r in sure) / len(sure)
    stated = sum(p for p, _ in sure) / len(sure)
    assert right > 0.9 and abs(right - stated) < 0.1
    named = license_families(spark, [t for t, w in judged if w == licenses.UNKNOWN])
    assert sum(x in ([], [licenses.UNKNOWN]) for x in named) >= 0.95 * len(named)


NOTICES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.""",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.""",
    "LGPL": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
}


def test_licenses_of_wrapped_notices(spark):
    narrow = lambda t: "\n\n".join("\n".join(p.split()) for p in t.split("\n\n"))
    folded = lambda t: "\n".join(" ".join(p.split()) for p in t.split("\n\n"))
    starred = lambda t: "/*\n" + "\n".join(f" * {x}".rstrip() for x in t.split("\n")) + "\n */\nint main() {}"
    forms = (str, narrow, folded, starred, lambda t: "Words before it.\n" + t + "\nAnd after it.")
    rows = [(10 * i + k, form(t)) for i, t in enumerate(NOTICES.values()) for k, form in enumerate(forms)]
    both = NOTICES["MIT"] + "\n" + NOTICES["Apache-2.0"]
    apart = "Released under\n\nthe MIT\n\nLicense of free will"
    out = by_id(licenses.license_lines(frame(spark, [*rows, (900, both), (901, apart)]), licenses.fitted()))
    known = {i: {x.family for x in r["lines"]} - {licenses.UNKNOWN} for i, r in out.items()}
    assert known == {10 * i + k: {n} for i, n in enumerate(NOTICES) for k in range(len(forms))} | {900: {"MIT", "Apache-2.0"}, 901: set()}
    assert [x.line for x in out[0]["lines"] if x.family == "MIT"] == [0, 7]
    assert [x.family for x in out[900]["lines"]].count("Apache-2.0") >= 1


def test_html_of_many_siblings():
    hint = '<p class="advert">x</p>'
    blocks, _ = html_main.read("<html><body><div>" + "<p>Some words.</p>" * 299 + hint + "</div></body></html>")
    x = html_main.block_features(blocks)
    rows = [i for i, b in enumerate(blocks) if b.tag == "p"]
    assert [round(v * 299) for v in x[rows, 13]] == list(range(300))
    [div] = [i for i, b in enumerate(blocks) if b.tag == "div"]
    assert x[div, -len(html_main._GROUPS) :].sum() == 1
    model = html_main.fitted()
    right = shown = 0
    for html, labels in html_main.training_pages(20, seed=321, kind="long"):
        blocks, runs = html_main.read(html)
        rows = [i for i, b in enumerate(blocks) if not b.hidden]
        truth = dict(zip(rows, labels, strict=True))
        found = html_main.decode(blocks, model.log_probabilities(html_main.block_features(blocks)))
        shown += len(runs)
        right += sum((found[b] == html_main.MAIN) == (truth.get(b) == html_main.MAIN) for b, _ in runs)
    assert right >= 0.97 * shown


def test_html_without_a_body():
    model = html_main.fitted()
    texts = {
        "Some text<br>more": "Some text more",
        "Just a line of <b>plain</b> text, and a second sentence.": "Just a line of plain text, and a second sentence.",
        "<title>T</title>First words of it.<p>Then a paragraph, with more.": "First words of it.\nThen a paragraph, with more.",
        "<html><head><title>T</title>Text in an open head, some words.": "Text in an open head, some words.",
        "<body>A first sentence.</body></html>And one after the end.": "A first sentence.\nAnd one after the end.",
        "Before it.<html><body class='x'>Inside it, with words.": "Before it.\nInside it, with words.",
    }
    assert {h: html_main.extract(h, model) for h in texts} == texts
    around = lambda x: f"<html><body><nav><a href='/'>Home</a></nav><article><h1>Title</h1><p>First of the paragraphs, with some words.</p>{x}<p>Last of the paragraphs, with more words.</p></article></body></html>"
    for inside, want in (
        ("<p>As <math><mi>a</mi><mo>+</mo><mi>b</mi></math> shows, they meet.</p>", "As a+b shows, they meet."),
        ("<noscript><p>The picture shows a river in the spring, with boats.</p></noscript>", "The picture shows a river in the spring, with boats."),
        ("<object data='x'><p>The chart shows how rivers rise in the spring.</p></object>", "The chart shows how rivers rise in the spring."),
        ("<video src='x'><p>The film shows how rivers rise in the spring.</p></video>", "The film shows how rivers rise in the spring."),
    ):
        assert want in html_main.extract(around(inside), model).split("\n")
    assert html_main.extract("<script>var a = 1</script><style>p{}</style>", model) == ""
