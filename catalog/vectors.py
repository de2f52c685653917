"""Embedding queries. The codebook is the mean vector of every label, derived from the whole table."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from polysift.functions import vectors as exprs
from polysift.operators import batching, subset, vectors
from polysift.operators.position import hash_bucket, seeded_hash, with_position
from polysift.plans import jobs

from .tables import table

DIM, SEED, K, ITERS = 64, 7, 8, 3


def _emb(spark, sf):
    return table(spark, sf, "embeddings")


def _codebook(spark, sf):
    sums = vectors.group_vector_sum(_emb(spark, sf), "label", "embedding")
    return sums.select(F.col("label").cast("bigint").alias("code"), F.col("vec_mean").alias("vec"), F.col("n").alias("size"))


def _shown(vec):
    """Vector as text, six digits per element."""
    return F.array_join(F.transform(vec, lambda x: F.format_string("%.6f", F.round(x.cast("double"), 6) + F.lit(0.0))), " ")


def valid_vectors(spark, sf):
    x = F.when(F.col("vec_id") % 5 == 0, F.array(F.lit(float("nan")).cast("float"))).when(
        F.col("vec_id") % 5 == 1, F.array(F.lit(float("-inf")).cast("float"))
    )
    rows = _emb(spark, sf).withColumn("vec", F.coalesce(x, F.col("embedding")))
    return rows.filter(exprs.valid_numeric("vec")).select("vec_id", "label")


def normalized_vectors(spark, sf):
    scaled = F.transform("embedding", lambda x: x * (F.col("vec_id") % 3))
    rows = _emb(spark, sf).withColumn("unit", exprs.l2_normalize(scaled))
    return rows.select("vec_id", F.md5(_shown("unit")).alias("unit"), F.round(exprs.norm("unit"), 6).alias("length"))


def similar_vectors(spark, sf):
    emb = _emb(spark, sf)
    a = emb.select(F.col("vec_id").alias("a_id"), F.col("embedding").alias("a_vec"))
    b = emb.select(F.col("vec_id").alias("b_id"), F.col("embedding").alias("b_vec"))
    rows = vectors.topk_similar(a, b, 5, scale=1.5)
    return rows.select("a_id", F.col("rank").cast("bigint").alias("rank"), "b_id", F.round("score", 6).alias("score"))


def label_logits(spark, sf):
    """The three best labels per vector, by logit."""
    a = _emb(spark, sf).select(F.col("vec_id").alias("a_id"), F.col("embedding").alias("a_vec"))
    b = _codebook(spark, sf).select(F.col("code").alias("b_id"), F.col("vec").alias("b_vec"))
    rows = vectors.topk_similar(a, b, 3, scale=1.0)
    return rows.select("a_id", F.col("rank").cast("bigint").alias("rank"), "b_id", F.round("score", 6).alias("score"))


def all_label_logits(spark, sf):
    """Every label's logit per vector, best first."""
    a = _emb(spark, sf).select(F.col("vec_id").alias("a_id"), F.col("embedding").alias("a_vec"))
    b = _codebook(spark, sf).select(F.col("code").alias("b_id"), F.col("vec").alias("b_vec"))
    rows = vectors.topk_similar(a, b, b.count(), scale=1.0)
    return rows.select("a_id", F.col("rank").cast("bigint").alias("rank"), "b_id", F.round("score", 6).alias("score"))


def label_means(spark, sf):
    sums = vectors.group_vector_sum(_emb(spark, sf), "label", "embedding")
    return sums.select("label", "n", _shown("vec_sum").alias("total"), _shown("vec_mean").alias("mean"))


def _nearest(spark, sf):
    return jobs.assign_codes(_emb(spark, sf), _codebook(spark, sf), key="vec_id", vec="embedding")


def nearest_codes(spark, sf):
    return _nearest(spark, sf).select("vec_id", "code", F.round("distance", 6).alias("distance"))


def nearest_directions(spark, sf):
    rows = vectors.nearest_code(_emb(spark, sf), _codebook(spark, sf), key="vec_id", vec="embedding", cosine=True)
    return rows.select("vec_id", "code", F.round("similarity", 6).alias("similarity"))


def code_histogram(spark, sf):
    """Codes 0..15; those beyond the labels are dead."""
    return vectors.code_usage(_nearest(spark, sf), 16)


def quantization_error(spark, sf):
    return vectors.quantization_error(_nearest(spark, sf), DIM, beta=0.25).select(F.round("error", 6).alias("error"))


def code_vectors(spark, sf):
    rows = vectors.code_lookup(_nearest(spark, sf), _codebook(spark, sf))
    return rows.select("vec_id", "code", F.md5(_shown("vec")).alias("vec"))


def remapped_codes(spark, sf):
    used = _codebook(spark, sf).select("code", F.call_function("div", F.col("code"), F.lit(2)).alias("index")).filter("code % 2 = 0")
    codes = _nearest(spark, sf).select("vec_id", "code")
    parts = {p: vectors.remap_codes(codes, used, policy=v) for p, v in (("extra", "extra"), ("fixed", 1))}
    rows = subset.tagged_union(parts, name="policy").withColumnRenamed("code", "seen")
    return vectors.unmap_codes(rows, used).select("policy", "vec_id", "seen", "index", "code")


def randomly_remapped_codes(spark, sf):
    used = _codebook(spark, sf).select("code", F.call_function("div", F.col("code"), F.lit(2)).alias("index")).filter("code % 2 = 0")
    return vectors.remap_codes(_nearest(spark, sf).select("vec_id", "code"), used, policy="random", seed=SEED)


def kmeans_round(spark, sf):
    rows = vectors.kmeans_step(_emb(spark, sf), _codebook(spark, sf), vec="embedding", cosine=True)
    return rows.select("code", "size", _shown("vec").alias("vec"))


def kmeans_centres(spark, sf):
    rows = jobs.fit_codebook(_emb(spark, sf), K, key="vec_id", vec="embedding", iters=ITERS, cosine=False, seed=SEED)
    return rows.select("code", "size", _shown("vec").alias("vec"))


def moved_codebook(spark, sf):
    """One moving-average update of a codebook whose last code gets no rows, with smoothed sizes."""
    far = spark.range(1).select(F.lit(99).cast("bigint").alias("code"), F.array_repeat(F.lit(-0.125), DIM).alias("vec"), F.lit(5).cast("bigint").alias("size"))
    prev = _codebook(spark, sf).unionByName(far)
    moved = vectors.smoothed_sizes(vectors.ema_codebook(prev, _emb(spark, sf), vec="embedding", decay=0.9))
    return moved.select("code", F.round("size", 6).alias("size"), F.round("smoothed", 6).alias("smoothed"), _shown("vec").alias("vec"))


def alignment_losses(spark, sf):
    """Batches of 16 vectors in hash order, each aligned with the mean vector of its label."""
    rows = vectors.code_lookup(_emb(spark, sf), _codebook(spark, sf), column="label").withColumn("_hash", seeded_hash(SEED, "vec_id"))
    placed = with_position(rows, ["_hash", "vec_id"], bucket=hash_bucket("_hash"))
    batches = batching.batch_ids(placed, 16)
    out = vectors.alignment_loss(batches, a="embedding", b="vec", scale=1.0)
    return out.select("batch_id", "n", F.round("loss", 6).alias("loss"))


def tiled_vectors(spark, sf):
    """The matches of every vector among all, both tables cut into blocks that meet inside tasks."""
    emb = _emb(spark, sf)
    a = emb.select(F.col("vec_id").alias("a_id"), F.col("embedding").alias("a_vec"))
    b = emb.select(F.col("vec_id").alias("b_id"), F.col("embedding").alias("b_vec"))
    rows = vectors.topk_similar(a, b, 5, scale=1.5, block_values=DIM * 64)
    return rows.select("a_id", F.col("rank").cast("bigint").alias("rank"), "b_id", F.round("score", 6).alias("score"))


def pruned_vectors(spark, sf):
    """The same, cells left out where the triangle inequality allows it."""
    emb = _emb(spark, sf)
    a = emb.select(F.col("vec_id").alias("a_id"), F.col("embedding").alias("a_vec"))
    b = emb.select(F.col("vec_id").alias("b_id"), F.col("embedding").alias("b_vec"))
    rows, _ = vectors.pruned_matches(a, b, 5, scale=math.exp(1.5), cells=16)
    return rows.select("a_id", F.col("rank").cast("bigint").alias("rank"), "b_id", F.round("score", 6).alias("score"))


def bounded_centres(spark, sf):
    """k-means whose rows carry their distance bounds from round to round."""
    start = subset.sample_n(_emb(spark, sf), K, key="vec_id", seed=SEED).select(F.col("draw").alias("code"), F.col("embedding").alias("vec"))
    rows, _ = vectors.kmeans_bounded(_emb(spark, sf), start, vec="embedding", iters=ITERS)
    return rows.select("code", "size", _shown("vec").alias("vec"))


def large_batch_loss(spark, sf):
    """All vectors as one batch, aligned with the mean vector of their label, by blocks."""
    rows = vectors.code_lookup(_emb(spark, sf), _codebook(spark, sf), column="label").withColumn("batch_id", F.lit(0))
    out = vectors.alignment_loss(rows, a="embedding", b="vec", scale=1.0, block_rows=64)
    return out.select("batch_id", "n", F.round("loss", 6).alias("loss"))


QUERIES = {
    f.__name__: f
    for f in (
        valid_vectors, normalized_vectors, similar_vectors, label_logits, all_label_logits, label_means, nearest_codes, nearest_directions,
        code_histogram, quantization_error, code_vectors, remapped_codes, randomly_remapped_codes, kmeans_round, kmeans_centres,
        moved_codebook, alignment_losses, tiled_vectors, pruned_vectors, bounded_centres, large_batch_loss,
    )
}

_E = "e as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings)"


def _means(name: str, source: str, key: str) -> str:
    """Element-wise mean per key."""
    return f"""{name} as (select {key} as code, list(m order by pos) as vec, any_value(n) as size from (
      select {key}, pos, avg(x) as m, count(*) as n from (select {key}, unnest(v) as x, generate_subscripts(v, 1) as pos from {source}) group by all) group by {key})"""


_C = _means("c0", "e", "label") + ", c as (select cast(code as bigint) as code, vec, size from c0)"
_DIST = "list_sum(list_transform(list_zip({}, {}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
_N = f"n as (select vec_id, code, d from (select vec_id, code, d, row_number() over (partition by vec_id order by d, code) as rn from (select vec_id, code, {_DIST.format('v', 'vec')} as d from e, c)) where rn = 1)"
_UNIT = "list_transform({0}, lambda x: x / greatest(sqrt(list_inner_product({0}, {0})), 1e-12))"
_SHOW = "array_to_string(list_transform({}, lambda x: printf('%.6f', round(x, 6) + 0.0)), ' ')"


def _kmeans_sql() -> str:
    parts = [f"""k0 as (select code, v as vec from (select v, row_number() over (order by md5('{SEED}:' || vec_id), vec_id) - 1 as code from e) where code < {K})"""]
    for i in range(ITERS):
        parts.append(
            f"""a{i} as materialized (select vec_id, v, code from (select vec_id, v, code, row_number() over (partition by vec_id order by
              {_DIST.format('v', 'vec')}, code) as rn from e, k{i}) where rn = 1)"""
        )
        parts.append(_means(f"m{i}", f"a{i}", "code"))
        parts.append(
            f"""k{i + 1} as materialized (select k{i}.code, coalesce(m{i}.vec, k{i}.vec) as vec, coalesce(m{i}.size, 0) as size
            from k{i} left join m{i} on k{i}.code = m{i}.code)"""
        )
    return f"with {_E}, {', '.join(parts)} select code, size, {_SHOW.format('vec')} as vec from k{ITERS}"


SQL = {
    "valid_vectors": "select vec_id, label from embeddings where vec_id % 5 > 1",
    "normalized_vectors": f"""with {_E}, s as (select vec_id, list_transform(v, lambda x: x * (vec_id % 3)) as w from e),
      u as (select vec_id, {_UNIT.format('w')} as u from s)
      select vec_id, md5({_SHOW.format('u')}) as unit, round(sqrt(list_inner_product(u, u)), 6) as length from u""",
    "similar_vectors": f"""with {_E}, s as (select a.vec_id as a_id, b.vec_id as b_id, list_cosine_similarity(a.v, b.v) * exp(1.5) as score from e a, e b)
      select a_id, rank, b_id, round(score, 6) as score from (select *, row_number() over (partition by a_id order by score desc, b_id) as rank from s) where rank <= 5""",
    "label_logits": f"""with {_E}, {_C}, s as (select vec_id as a_id, code as b_id, list_cosine_similarity(v, vec) * exp(1.0) as score from e, c)
      select a_id, rank, b_id, round(score, 6) as score from (select *, row_number() over (partition by a_id order by score desc, b_id) as rank from s) where rank <= 3""",
    "all_label_logits": f"""with {_E}, {_C}, s as (select vec_id as a_id, code as b_id, list_cosine_similarity(v, vec) * exp(1.0) as score from e, c)
      select a_id, row_number() over (partition by a_id order by score desc, b_id) as rank, b_id, round(score, 6) as score from s""",
    "label_means": f"""with {_E}, {_C} select cast(code as integer) as label, size as n,
      {_SHOW.format('list_transform(vec, lambda x: x * size)')} as total, {_SHOW.format('vec')} as mean from c""",
    "nearest_codes": f"with {_E}, {_C}, {_N} select vec_id, code, round(d, 6) as distance from n",
    "nearest_directions": f"""with {_E}, {_C}, s as (select vec_id, code, list_inner_product(v, vec) as d from e, c)
      select vec_id, code, round(d, 6) as similarity from (select *, row_number() over (partition by vec_id order by d desc, code) as rn from s) where rn = 1""",
    "code_histogram": f"""with {_E}, {_C}, {_N}, h as (select code, count(*) as n from n group by code)
      select r.i as code, coalesce(n, 0) as n, n is null as dead from range(0, 16) r(i) left join h on h.code = r.i""",
    "quantization_error": f"with {_E}, {_C}, {_N} select round(0.25 * avg(d) / 64, 6) as error from n",
    "code_vectors": f"with {_E}, {_C}, {_N} select vec_id, code, md5({_SHOW.format('vec')}) as vec from n join c using (code)",
    "remapped_codes": f"""with {_E}, {_C}, {_N}, u as (select code, code // 2 as idx from c where code % 2 = 0),
      k as (select count(*) as k from u), p as (select policy, vec_id, n.code as seen, coalesce(u.idx, case policy when 'extra' then k else 1 end) as idx
        from n left join u on n.code = u.code, k, (values ('extra'), ('fixed')) t(policy))
      select policy, vec_id, seen, p.idx as "index", u.code as code from p, k, u where u.idx = case when p.idx >= k then 0 else p.idx end""",
    "randomly_remapped_codes": f"""with {_E}, {_C}, {_N}, u as (select code, code // 2 as idx from c where code % 2 = 0), k as (select count(*) as k from u)
      select n.vec_id, n.code, coalesce(u.idx, cast('0x' || substr(md5('{SEED}:' || n.vec_id || ':' || n.code), 1, 15) as bigint) % k) as "index"
      from n left join u on n.code = u.code, k""",
    "kmeans_round": f"""with {_E}, {_C}, s as (select vec_id, v, code, list_inner_product(v, vec) as d from e, c),
      a as (select * from (select *, row_number() over (partition by vec_id order by d desc, code) as rn from s) where rn = 1),
      {_means('m', 'a', 'code')}
      select c.code, coalesce(m.size, 0) as size, {_SHOW.format(f"coalesce({_UNIT.format('m.vec')}, c.vec)")} as vec
      from c left join m on c.code = m.code""",
    "kmeans_centres": _kmeans_sql(),
    "moved_codebook": f"""with {_E}, {_C.replace(', c as (', ', c as (select 99::bigint as code, list_transform(range(0, 64), lambda i: -0.125::double) as vec, 5::bigint as size union all ')},
      s as (select vec_id, v, code, {_DIST.format('v', 'vec')} as d from e, c),
      a as (select * from (select *, row_number() over (partition by vec_id order by d, code) as rn from s) where rn = 1),
      {_means('m', 'a', 'code')},
      j as (select c.code, c.vec as old, c.size as old_size, coalesce(m.size, 0) as n, coalesce({_UNIT.format('m.vec')}, c.vec) as target from c left join m on c.code = m.code),
      x as (select code, old_size * 0.9::double + n * (1 - 0.9::double) as size, list_transform(list_zip(old, target), lambda p: p[1] * 0.9::double + p[2] * (1 - 0.9::double)) as mixed from j),
      t as (select sum(size) as total, count(*) as k from x)
      select code, round(size, 6) as size, round((size + 1e-5::double) / (total + k * 1e-5::double) * total, 6) as smoothed,
        {_SHOW.format(_UNIT.format('mixed'))} as vec from x, t""",
    "alignment_losses": f"""with {_E}, {_C}, b as (select vec_id, v, label, (row_number() over (order by md5('{SEED}:' || vec_id), vec_id) - 1) // 16 as batch_id from e),
      p as (select vec_id, v, vec, batch_id from b join c on c.code = b.label),
      l as (select x.batch_id, x.vec_id as i, y.vec_id as j, list_cosine_similarity(x.v, y.vec) * exp(1.0) as g from p x join p y on x.batch_id = y.batch_id),
      r as (select batch_id, i, ln(sum(exp(g))) - max(case when i = j then g end) as e from l group by batch_id, i),
      q as (select batch_id, j, ln(sum(exp(g))) - max(case when i = j then g end) as e from l group by batch_id, j)
      select batch_id, rn as n, round((a + b) / 2, 6) as loss from (select batch_id, count(*) as rn, avg(e) as a from r group by batch_id)
      join (select batch_id, avg(e) as b from q group by batch_id) using (batch_id)""",
}
SQL["tiled_vectors"] = SQL["pruned_vectors"] = SQL["similar_vectors"]
SQL["bounded_centres"] = SQL["kmeans_centres"]
SQL["large_batch_loss"] = SQL["alignment_losses"].replace(f"(row_number() over (order by md5('{SEED}:' || vec_id), vec_id) - 1) // 16 as batch_id", "cast(0 as bigint) as batch_id")
