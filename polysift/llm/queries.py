"""Registered queries of this subpackage over the given tables, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polysift.llm import bpe, decontaminate, html_main, licenses, manifest, near_vectors, ngram_join, pii, quality, spelling, topk, toxicity, warc
from polysift.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is good, from its text, its source and its language within the source."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the 50k byte vocabulary."""
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingles have a Jaccard similarity of 0.75 or more."""
    return ngram_join.similar_components(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of fold 0 are held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = toxicity.fold(F.col("doc_id")) == 0
    scored = toxicity.toxicity(docs, toxicity.fit(docs, labels.filter(~held_out)))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    base = [k.name for k in pii.BASE]
    of = lambda *kinds: F.filter("found", lambda s: s.kind.isin(*kinds))
    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in base]
    digest = F.sha2(pii.span_text(of(*base)), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), pii.span_text(F.col("found")).alias("spans"))


def op6_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_main.extract_all(table(spark, sf_dir, "pages"), html_main.fitted())


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, and what a Merkle audit says of a replica.

    The replica has the pages again, every 97th with its first character overwritten; every 389th is lost, so that all later ones of its file move.
    """
    pages = table(spark, sf_dir, "pages")
    spoilt = F.when((F.col("page_id") % 97 == 13) & F.col("html").rlike("^[\\x00-\\x7F]"), F.concat(F.lit("?"), F.substring("html", 2, 2**31 - 1)))
    ours = warc.manifest(warc.records(pages))
    kept = pages.filter(F.coalesce(F.col("page_id") % 389, F.lit(0)) != 7)
    theirs = warc.manifest(warc.records(kept.withColumn("html", F.coalesce(spoilt, "html"))))
    out = warc.fixity(ours, theirs)
    return out.select(F.col("id_").alias("page_id"), "file", "seq", "offset", "length", "sha256", "status")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of every document, and its lines that speak of licences without a known one."""
    found = licenses.license_lines(table(spark, sf_dir, "documents"), licenses.fitted())
    known = F.filter("lines", lambda x: x.family != licenses.UNKNOWN)
    families = F.array_sort(F.array_distinct(F.transform(known, lambda x: x.family)))
    return found.select(
        "doc_id", F.size("lines").cast("bigint").alias("n_lines"), F.size(known).cast("bigint").alias("n_known"), F.array_join(families, ",").alias("families")
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in 13-word windows of benchmark items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of embeddings with a cosine of 0.9 or more."""
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all documents; one run in 97, by crc32, loses a letter first."""

    def lose_a_letter(run: Column, doc_id: Column) -> Column:
        hashed = F.crc32(F.concat(doc_id, F.lit(":"), run))
        at = (hashed % F.length(run)).cast("int")
        return F.when(hashed % 97 != 0, run).otherwise(F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run))))

    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents"), change=lose_a_letter))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of every document by language, folded again from a replica in which every seventh id by crc32 has one character more."""
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = {"n_chars": F.when(touched, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    return manifest.verified(manifest.manifest(table(spark, sf_dir, "documents"), fields, changed=changed))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_ngram_join": op3_ngram_join,
    "op4_toxicity": op4_toxicity,
    "op5_pii": op5_pii,
    "op6_html_main": op6_html_main,
    "op7_exact_topk": op7_exact_topk,
    "op8_warc_audit": op8_warc_audit,
    "op9_licenses": op9_licenses,
    "op10_decontamination": op10_decontamination,
    "op11_near_vectors": op11_near_vectors,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = f"regexp_extract_all(coalesce({_LOWER}, ''), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

#: crc32 of a text: its bytes from their hexadecimal form, then a table of 256 remainders.
_CRC_TABLE = (
    "list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),"
    " lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end))"
)
_BYTES = "list_transform(range(strlen({x})), lambda i: cast('0x' || substr(hex({x}), 2 * i + 1, 2) as bigint))"
_CRC = "xor(list_reduce(list_prepend(4294967295, " + _BYTES + "), lambda c, x: xor(c // 256, t[cast(xor(c, x) % 256 as integer) + 1])), 4294967295)"


def _part(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    values = ["cast(doc_id as varchar)", "source", "lang", f"cast({n_chars} as varchar)", "text"]
    return f"sha256(concat({', '.join(map(_part, values))}))"


def _tree(name: str, keys: str, leaves: str) -> str:
    """Levels of trees over ``leaves`` (keys, pos, d, n), as a recursive table (keys, lvl, pos, d, n)."""
    on = " and ".join(f"l.{k} is not distinct from r.{k}" for k in keys.split(", "))
    return f"""
{name} as (
    select {keys}, 0 as lvl, pos, d, n from {leaves}
    union all
    select {keys}, lvl + 1, pos // 2, sha256(string_agg(d, '' order by pos)), (n + 1) // 2
    from {name} where n > 1 group by {keys}, lvl, pos // 2, n),
{name}_sib as (
    select l.*, r.d as sib from {name} l left join {name} r on {on} and l.lvl = r.lvl and r.pos = xor(l.pos, 1) where l.n > 1)"""


SQL = {
    "op3_ngram_join": f"""
with recursive docs as (
    select doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^ \\x09-\\x0D]+') as w from documents),
sets as (
    select distinct doc_id, array_to_string(list_slice(w, s, s + 4), ' ') as t
    from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) as s from docs where len(w) > 0)),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as met
    from sets a join sets b on a.t = b.t and a.doc_id <> b.doc_id group by 1, 2),
links as (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * met >= 75 * (x.n + y.n - met)),
reach(doc_id, other) as (
    select a, b from links union select reach.doc_id, links.b from reach join links on reach.other = links.a)
select docs.doc_id, cast(coalesce(max(n), 0) as bigint) as n_shingles,
       least(docs.doc_id, coalesce(min(other), docs.doc_id)) as component_id
from docs left join sizes using (doc_id) left join reach using (doc_id) group by docs.doc_id
""",
    "op7_exact_topk": """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 5
""",
    "op8_warc_audit": """
with parts as (
    select page_id, coalesce(url, '') as u, coalesce(html, '') as h, sha256(coalesce(url, '') || chr(10) || coalesce(html, '')) as n
    from pages),
records as (
    select page_id, cast(floor(page_id / 256.0) as bigint) as file,
           'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:uuid:'
           || n[1:8] || '-' || n[9:12] || '-' || n[13:16] || '-' || n[17:20] || '-' || n[21:32] || '>' || chr(13) || chr(10)
           || 'WARC-Date: 2024-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || u || chr(13) || chr(10)
           || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(h) || chr(13) || chr(10)
           || chr(13) || chr(10) || h as r
    from parts)
select page_id, file, row_number() over w - 1 as seq,
       cast(coalesce(sum(strlen(r) + 4) over (w rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset",
       cast(strlen(r) as bigint) as length, sha256(r) as sha256,
       case when page_id % 389 = 7 then 'missing' when page_id % 97 = 13 then 'corrupt' else 'intact' end as status
from records window w as (partition by file order by page_id, sha256(r))
""",
    "op10_decontamination": f"""
with items as (
    select cast(item_id as varchar) as item, coalesce(cast(item_id as varchar), chr(10) || array_to_string(w, ' ')) as owner, w
    from (select item_id, {_ALNUM} as w from benchmark)),
windows as (
    select distinct owner, item, least(len(w), 13) as k, array_to_string(list_slice(w, s, s + 12), ' ') as win
    from (select owner, item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) as s from items where len(w) > 0)),
sizes as (select distinct k from windows),
docs as (select doc_id, {_ALNUM} as w from documents),
places as (
    select doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) as s
    from docs, sizes where len(w) >= k),
runs as (select doc_id, s, k, array_to_string(list_slice(w, s, s + k - 1), ' ') as win from places),
hits as (select doc_id, s, k, item, owner from runs join windows using (k, win)),
words as (select doc_id, count(distinct p) as n_hit
          from (select distinct doc_id, unnest(generate_series(s, s + k - 1)) as p from hits) group by doc_id),
found as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
          from (select distinct doc_id, owner, item from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join words using (doc_id) left join found using (doc_id)
""",
    "op11_near_vectors": """
with recursive v as (
    select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
    select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, other) as (
    select a, b from links union select reach.vec_id, links.b from reach join links on reach.other = links.a),
counts as (select a as vec_id, count(*) as n from links group by a),
least_ as (select vec_id, min(other) as o from reach group by vec_id)
select e.vec_id, cast(coalesce(n, 0) as bigint) as n_links, least(e.vec_id, coalesce(o, e.vec_id)) as component_id,
       e.vec_id = least(e.vec_id, coalesce(o, e.vec_id)) as kept
from embeddings e left join counts using (vec_id) left join least_ using (vec_id)
""",
    "op12_spelling_variants": f"""
with recursive crc as (select {_CRC_TABLE} as t),
runs as (
    select coalesce(cast(doc_id as varchar), '') || ':' || run as tag, run, count(*) as k
    from (select doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) as run from documents) group by doc_id, run),
hashed as (select run, k, {_CRC.format(x="tag")} as h from runs, crc),
changed as (
    select case when h % 97 <> 0 then run else substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) end as word, k from hashed),
words as (select word, cast(sum(k) as bigint) as n from changed where length(word) >= 5 group by word having sum(k) >= 3),
cuts as (
    select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
    from (select word, n, unnest(generate_series(1, length(word))) as i from words)),
near as (
    select a.word, a.n, b.word as other, b.n as m from cuts a join cuts b on a.i = b.i and a.rest = b.rest and a.word <> b.word
    union select a.word, a.n, w.word, w.n from cuts a join words w on a.rest = w.word
    union select w.word, w.n, a.word, a.n from cuts a join words w on a.rest = w.word),
best as (
    select word, count(*) over (partition by word) as n_near, other, m from near
    qualify row_number() over (partition by word order by m desc, other) = 1),
forms as (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 2 * w.n then other end as form, case when m >= 2 * w.n then m end as form_n
    from words w left join best b on b.word = w.word),
climb as (
    select word, word as tip, 0 as steps from forms
    union all select c.word, f.form, steps + 1 from climb c join forms f on f.word = c.tip where f.form is not null),
ends as (select word as of, arg_max(tip, steps) as root from climb group by word)
select word, form, root, n, cast(n_near as bigint) as n_near, form_n from forms join ends on of = word
""",
    "op13_merkle_manifest": f"""
with recursive crc as (select {_CRC_TABLE} as t),
docs as (
    select doc_id, lang, {_leaf("n_chars")} as leaf, {_leaf("n_chars + 1")} as other, {_CRC.format(x="cast(doc_id as varchar)")} % 7 = 0 as touched
    from documents, crc),
base as (
    select *, leaf as d, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n
    from docs),
{_tree("nodes", "lang", "base")},
subs as (select lang, d, 1 as one, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from nodes where n = 1),
{_tree("tops", "one", "subs")},
up as (
    select b.lang, b.pos as start, b.d as leaf, b.doc_id, case when touched then other else b.d end as seen, b.n,
           0 as lvl, b.pos as pos, case when touched then other else b.d end as acc, '' as proof
    from base b
    union all
    select up.lang, start, leaf, doc_id, seen, up.n, up.lvl + 1, up.pos // 2,
           sha256(case when up.pos % 2 = 1 then s.sib || acc else acc || coalesce(s.sib, '') end), proof || coalesce(s.sib, '')
    from up join nodes_sib s on s.lang is not distinct from up.lang and s.lvl = up.lvl and s.pos = up.pos),
sub_done as (select * from up qualify row_number() over (partition by lang, start order by lvl desc) = 1),
rise as (
    select s.lang, start, leaf, doc_id, acc, proof, x.d as subroot, 0 as lvl, x.pos as pos
    from sub_done s join subs x on x.lang is not distinct from s.lang
    union all
    select r.lang, start, leaf, doc_id, sha256(case when r.pos % 2 = 1 then s.sib || acc else acc || coalesce(s.sib, '') end),
           proof || coalesce(s.sib, ''), subroot, r.lvl + 1, r.pos // 2
    from rise r join tops_sib s on s.lvl = r.lvl and s.pos = r.pos),
done as (select * from rise qualify row_number() over (partition by lang, start order by lvl desc) = 1)
select doc_id, leaf, subroot, (select d from tops where n = 1) as root, sha256(proof) as proof_sha256, acc as folded_root,
       acc = (select d from tops where n = 1) as verified
from done
""",
}
