"""Near vectors against all pairs in double precision, and the quantisation bounds against exact products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from polysift.llm import near_vectors

ROWS = "vec_id long, embedding array<double>"


def plain(rows, threshold=0.9):
    """Sorted (vec_id, n_links, component_id, kept) by all pairs."""

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v) / max(map(abs, v))
        return x / np.sqrt((x * x).sum())

    units = [unit(v) for _, v in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    n = [0] * len(rows)
    for i, x in enumerate(units):
        for j, y in enumerate(units[:i]):
            if x is not None and y is not None and len(x) == len(y) and x @ y >= threshold:
                n[i] += 1
                n[j] += 1
                root[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return sorted(((k, n[i], least.get(top(i)), k == least.get(top(i))) for i, (k, _) in enumerate(rows)), key=repr)


def cloud(seed, n, d, groups):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, d))
    return [(centres[i % groups] + r.normal(size=d) * r.choice([0.05, 0.3, 0.45, 1.0])).tolist() for i in range(n)]


@pytest.mark.parametrize(("block_rows", "group_blocks"), [(4096, 8), (40, 3)])
def test_links_equal_all_pairs(spark, block_rows, group_blocks):
    vectors = cloud(1, 260, 12, 9)
    rows = [(3 * i + 5, v) for i, v in enumerate(vectors)]
    rows += [(10_000 + i, vectors[4]) for i in range(90)] + [(20_000 + i, [x * 2.5**i for x in vectors[7]]) for i in range(25)]
    rows += [(1, [1e300] * 12), (2, [9e299] * 12), (3, [1e-320] * 12), (4, [0.0] * 12), (0, [-0.0] * 12), (6, None), (7, []), (9, [None] * 12)]
    rows += [(11, [float("nan")] * 12), (12, [float("inf")] * 12), (None, vectors[4]), (None, [1.0, 0.0]), (13, [2.0, -0.0]), (13, [0.0, 1.0]), (None, None), (30_000, [1.0])]
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    for name in ("node", "block", "width", "n", "links", "id_", "vec_", "label"):
        df = df.withColumn(name, F.lit(1))
    out = near_vectors.near_vectors(df, block_rows=block_rows, group_blocks=group_blocks)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == plain(rows)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], ROWS)
    assert near_vectors.near_vectors(empty).count() == 0
    alone = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in near_vectors.near_vectors(alone).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("d", [1, 2, 64, 1500])
def test_bounds_hold_for_every_pair(d):
    r = np.random.default_rng(d)
    data = r.normal(size=(120, d)) * 10.0 ** r.integers(-300, 300, size=(120, 1))
    data[:30] = data[0] * (1 + r.normal(size=(30, d)) * 1e-3)
    q, scale, length, error = near_vectors.quantised(data)
    x, size = near_vectors.scaled(data)
    unit = x / size[:, None]
    about = near_vectors._product(q, q) * scale[:, None] * scale[None, :]
    off = length[:, None] * error[None, :] + error[:, None] * (length + error)[None, :] + near_vectors.SLACK
    assert (np.abs(unit @ unit.T - about) <= off).all()
    assert (near_vectors._product(q, q) == q.astype(np.int64) @ q.astype(np.int64).T).all()


def test_few_pairs_are_computed_again():
    """Pairs that the bounds decide are not looked at in full precision."""
    r = np.random.default_rng(3)
    centres = r.normal(size=(40, 64))
    data = (centres[r.integers(0, 40, 600)] + r.normal(size=(600, 64)) * 0.1).astype(np.float32)
    q, *bounds = near_vectors.quantised(data)
    keys = np.stack([np.arange(600), np.ones(600)], axis=1).astype("<i8")
    row = {"block": 0, "n": 600, "width": 64, "keys": keys.tobytes(), "data": data.tobytes(), "q": q.tobytes(), "bounds": np.stack(bounds).tobytes()}
    side = near_vectors.Side(row, "<f4")
    found = list(near_vectors.links(side, side, 0.9))
    x, size = near_vectors.scaled(data)
    want = (x @ x.T) / np.outer(size, size) >= 0.9
    np.fill_diagonal(want, False)
    got = np.zeros_like(want)
    for i, j, _ in found:
        got[i, j] = True
    assert (got == want).all() and want.sum() > 1000
    assert sum(n for *_, n in found) < 0.05 * want.size


def test_components_of_places():
    r = np.random.default_rng(0)
    for n in (1, 5, 300):
        order = r.permutation(n)
        a, b = order[:-1], order[1:]
        assert (near_vectors.joined(n, a, b) == 0).all()
        assert (near_vectors.joined(n, a[:0], b[:0]) == np.arange(n)).all()
