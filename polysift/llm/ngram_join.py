"""Exact n-gram Jaccard join and its connected components, by token-combination prefixes.

A text is a set of word shingles (tokens). Equal sets become one node. Tokens fall in two classes by their count over all
documents: rare ones and frequent ones; rare tokens come first in the global order. A set of ``n`` tokens misses at most
``e = floor(n (1 - t))`` of them in any partner, so a prefix of ``e + 1`` rare tokens must share one with it: rare tokens
are indexed singly. Where rare tokens do not suffice the prefix is extended by frequent ones, dealt into small groups by
hash, and a group of ``l`` prefix tokens counts as ``l - 1``: a partner then shares one rare token, or two tokens of a
group, so frequent tokens are indexed as pairs only. Candidates whose sketches (tokens per hash cell) leave no room for enough
common tokens drop out, the others are verified on the full sets.

Which tokens are frequent only has to be the same for all documents; any choice gives the same links. The table of frequent
tokens is broadcast and has at most ``CLASS_ENTRIES`` entries; a larger corpus raises the count where frequent begins.

Hot groups: a group of copies is a single node from the start. Every set is first compared with one centre for each of its
``FIRST`` smallest tokens, a row per token, which hangs the bulk of a group of near copies on one root; from then on only
members under different roots are compared. The members of a usual key travel as one list of at most ``HOT_KEY`` nodes, and lists of
the same documents meet in one task with the sketches of their members, so that a pair is written only if its sketches leave
room. The members of keys with more nodes are dealt into chunks of bounded size; chunks that share such a key meet in one task with their sketches,
once whatever the number of these keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polysift.llm.components import components
from polysift.llm.shingles import mix, set_key, sorted_unique, text_sets
from polysift.scratch import discard, materialise

WORDS = 5
PERCENT = 75
#: Entries of the broadcast class table, 8 bytes each.
CLASS_ENTRIES = 2_000_000
#: A token counted more often is frequent.
RARE_COUNT = 32
#: Tokens with hashes below this share of all hashes are counted; the others are put in the frequent class unseen.
COUNTED_SHARE = 0.4
#: Tokens a range of the hash space should hold, so that one task can sort it.
RANGE_TOKENS = 1 << 20
#: Tokens a task gathers before it hands them on.
FLUSH_TOKENS = 1 << 21
#: Tokens of sets that a task keeps while it verifies pairs: a set has many partners.
HELD_TOKENS = 1 << 22
#: Smallest tokens by which a set is first compared with a centre.
FIRST = 8
#: Cells of the sketch by which most candidate pairs are told apart before their texts are fetched.
CELLS = 512
#: Keys with more nodes than this are hot.
HOT_KEY = 4096
#: Hot keys that are told apart by a broadcast list; with more of them, a hot key has more nodes.
HOT_KEYS = 1_000_000
#: Members of hot keys that meet as many others in one group.
TILE = 1024

_LIMIT = np.uint64(int(COUNTED_SHARE * 2**64))
_LOW = np.uint64(0xFFFFFFFF)
_M1, _M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _slack(n: int, percent: int) -> int:
    """Most tokens of a set of ``n`` that a partner can lack."""
    return n - -(-percent * n // 100)


def _ranges(tokens: np.ndarray, n_ranges: int) -> np.ndarray:
    return ((tokens & _LOW) * np.uint64(n_ranges)) >> np.uint64(32)


def _class_ids(tokens: np.ndarray, n_ranges: int) -> np.ndarray:
    """Entries of the class table: range and 24 high bits of a counted token."""
    return (_ranges(tokens, n_ranges) << np.uint64(24)) | (tokens >> np.uint64(39))


def _by_range(ids: np.ndarray, n_ranges: int) -> Iterator[tuple[int, slice]]:
    """Ranges that occur in sorted range numbers, with their rows."""
    cut = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1 if len(ids) else ids)) if len(ids) else []
    stops = [*cut[1:], len(ids)]
    for a, b in zip(cut, stops, strict=True):
        yield int(ids[a]), slice(int(a), int(b))


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _node(tokens: np.ndarray) -> int:
    """Key of a set, with its lowest bit free."""
    return set_key(tokens) & ~1


def _distinct_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Node and tokens of every distinct set of a task, sets too small for a partner other than a copy left out."""
    seen: set[int] = set()
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            for tokens in text_sets(_texts(batch.column(0).slice(at, 512)), k):
                if len(tokens) > 2 and (node := _node(tokens)) not in seen:
                    seen.add(node)
                    yield node, tokens


def read_sets(docs: DataFrame, id_col: str, text_col: str, words: int, n_ranges: int) -> DataFrame:
    """Two kinds of rows from one pass over the texts.

    (id_, mark_, n_shingles, node, first): size and key of every document's set, key null for an empty one, its smallest tokens, and a hash of its text;
    and (part, blob): the counted tokens of each task as 3-byte numbers by range.
    """
    ident = docs.select(F.col(id_col).alias("id_"))
    kind = ident.schema["id_"].dataType.simpleString()
    names = ["id_", "mark_", "n_shingles", "node", "first", "part", "blob"]
    longs = pa.list_(pa.int64())

    def pack(sets: list[np.ndarray], ids: pa.DataType) -> pa.RecordBatch:
        found = np.sort(_class_ids(np.concatenate(sets), n_ranges))
        low = found.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :3]
        rows = [(r, low[at].tobytes()) for r, at in _by_range(found >> np.uint64(24), n_ranges)]
        none = [pa.nulls(len(rows), t) for t in (ids, pa.int64(), pa.int64(), pa.int64(), longs)]
        return pa.RecordBatch.from_arrays([*none, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, size, ids = [], 0, pa.null()
        for batch in batches:
            ids = batch.column(0).type
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, nodes, first = [], [], []
                for tokens in text_sets(_texts(part.column(2)), words):
                    n.append(len(tokens))
                    nodes.append(_node(tokens) if len(tokens) else None)
                    first.append(tokens[:FIRST].view(np.int64))
                    if len(tokens) > 2 and nodes[-1] not in seen:
                        seen.add(nodes[-1])
                        counted = tokens[: np.searchsorted(tokens, _LIMIT)]
                        held.append(counted)
                        size += len(counted)
                none = [pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.binary())]
                facts = [pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(first, longs)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *facts, *none], names=names)
                if size > FLUSH_TOKENS:
                    yield pack(held, ids)
                    held, size = [], 0
        if size:
            yield pack(held, ids)

    picked = docs.select(F.col(id_col).alias("id_"), F.xxhash64(F.col(text_col)).alias("mark_"), F.col(text_col).alias("text_"))
    return picked.mapInArrow(run, f"id_ {kind}, mark_ long, n_shingles long, node long, first array<long>, part long, blob binary")


def _frequent(blobs: DataFrame, least: int) -> DataFrame:
    """(id, count) of tokens counted more than ``least`` times; a range is one task's work of bounded size."""

    def count(part: pa.Table) -> pa.Table:
        low = np.frombuffer(b"".join(part.column("blob").to_pylist()), np.uint8).reshape(-1, 3).astype(np.uint64)
        ids, n = np.unique(low[:, 0] | (low[:, 1] << np.uint64(8)) | (low[:, 2] << np.uint64(16)), return_counts=True)
        kept = n > least
        top = np.uint64(part.column("part")[0].as_py() << 24) if part.num_rows else np.uint64(0)
        return pa.table({"id": (ids[kept] | top).astype(np.int64), "n": n[kept].astype(np.int64)})

    return blobs.groupBy("part").applyInArrow(count, "id long, n long")


def class_table(blobs: DataFrame) -> np.ndarray:
    """Sorted ids of the frequent tokens, at most ``CLASS_ENTRIES``: a power-of-two count bounds the class from below."""
    found = materialise(_frequent(blobs, RARE_COUNT), "frequent")
    steps = found.groupBy(F.floor(F.log2("n")).alias("step")).count().orderBy(F.desc("step")).collect()  # at most 63 rows
    least, total = RARE_COUNT, 0
    for row in steps:
        total += row["count"]
        if total > CLASS_ENTRIES:
            least = 2 ** (row["step"] + 1) - 1
            break
    ids = found.filter(F.col("n") > least).select("id").toPandas()["id"].to_numpy(np.int64)  # bounded by the loop above
    discard(found)
    return np.sort(ids.astype(np.uint64))


def prefix_keys(tokens: np.ndarray, frequent: np.ndarray, n_ranges: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rare tokens to index singly, and keys of the pairs of frequent ones.

    The earlier of two prefixes to end lies within the other, so what it must share is indexed for both sets.
    """
    n = len(tokens)
    need = _slack(n, percent) + 1
    counted = tokens[: np.searchsorted(tokens, _LIMIT)]
    if len(frequent) and len(counted):
        ids = _class_ids(counted, n_ranges)
        is_rare = frequent[np.minimum(np.searchsorted(frequent, ids), len(frequent) - 1)] != ids
        rare = counted[is_rare]
    else:
        rare, is_rare = counted, np.ones(len(counted), bool)
    if len(rare) >= need:
        return rare[:need], tokens[:0]
    rest = np.concatenate((counted[~is_rare], tokens[len(counted) :]))
    need -= len(rare)
    keys = []
    # A pair is met in the size class of its larger set.
    for size_class in sorted({n.bit_length(), (100 * n // percent).bit_length()}):
        n_groups = max(1, (1 << (size_class - 1)) // 6)
        groups = mix(rest ^ _M1) % np.uint64(n_groups)
        covers = np.ones(len(rest), np.int64)
        covers[np.unique(groups, return_index=True)[1]] = 0
        reach = int(np.searchsorted(np.cumsum(covers), need)) + 1
        order = np.lexsort((rest[:reach], groups[:reach]))
        t, g = rest[:reach][order], groups[:reach][order]
        step = 1
        while step < len(t) and (same := g[step:] == g[:-step]).any():
            keys.append(mix(t[:-step][same] * _M1 + t[step:][same] * _M2 + np.uint64(size_class)))
            step += 1
    return rare, np.concatenate(keys) if keys else tokens[:0]


def rare_blobs(texts: DataFrame, words: int, n_ranges: int, percent: int, frequent) -> DataFrame:
    """Singly indexed tokens of every distinct set by range: (part, tokens, nodes) as numbers."""

    def pack(found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        tokens = np.concatenate([t for _, t in found])
        nodes = np.repeat(np.array([k for k, _ in found], np.int64), [len(t) for _, t in found])
        parts = _ranges(tokens, n_ranges)
        order = np.lexsort((tokens, parts))
        tokens, nodes, parts = (tokens[order] >> np.uint64(32)).astype("<u4"), nodes[order], parts[order]
        rows = [(r, tokens[s].tobytes(), nodes[s].astype("<i8").tobytes()) for r, s in _by_range(parts, n_ranges)]
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["part", "tokens", "nodes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for node, tokens in _distinct_sets(batches, words):
            single, _ = prefix_keys(tokens, frequent.value, n_ranges, percent)
            if len(single):
                held.append((node, single))
                size += len(single)
            if size > FLUSH_TOKENS:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    return texts.mapInArrow(run, "part long, tokens binary, nodes binary")


def pair_blobs(texts: DataFrame, words: int, n_ranges: int, percent: int, frequent) -> DataFrame:
    """Keys of the pairs of frequent tokens of every distinct set that indexes any, and its size: (tokens, node, n), a row per set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, int]] = []
        for node, tokens in _distinct_sets(batches, words):
            _, both = prefix_keys(tokens, frequent.value, n_ranges, percent)
            if len(both):
                held.append((sorted_unique(both).astype("<u8").tobytes(), node, len(tokens)))
            if len(held) >= 256:
                yield batch_of(held)
                held = []
        yield batch_of(held)

    def batch_of(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.binary(), pa.int64(), pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["tokens", "node", "n"])

    return texts.mapInArrow(run, "tokens binary, node long, n long")


def _rare_lists(blobs: DataFrame) -> DataFrame:
    """(m): sorted nodes of rare tokens that several share, a list once however many tokens have just these nodes.

    A rare token has at most ``RARE_COUNT`` of them; a range of the hash space is one task's work of bounded size.
    """

    def meet(part: pa.Table) -> pa.Table:
        tokens, nodes = (np.frombuffer(b"".join(part.column(c).to_pylist()), t) for c, t in (("tokens", "<u4"), ("nodes", "<i8")))
        order = np.lexsort((nodes, tokens))
        tokens, nodes = tokens[order], nodes[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])
        tokens, nodes = tokens[new], nodes[new]
        edges = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1], [True]))) if len(tokens) else np.zeros(1, int)
        lengths = np.diff(edges)
        found = {nodes[a : a + n].tobytes() for a, n in zip(edges[:-1][lengths > 1].tolist(), lengths[lengths > 1].tolist(), strict=True)}
        lists = [np.frombuffer(m, "<i8") for m in sorted(found)]
        return pa.table({"key": pa.array([set_key(m) for m in lists], pa.int64()), "m": pa.array(lists, pa.list_(pa.int64()))})

    found = blobs.groupBy("part").applyInArrow(meet, "key long, m array<long>")
    return found.groupBy("key").agg(F.first("m").alias("m")).select("m")


def _pair_keys(blobs: DataFrame, hot=None, want_hot: bool = False, facts: tuple[str, ...] = ()) -> DataFrame:
    """(key, node, facts) of pairs of frequent tokens: all, or given the ``hot`` keys only these or only the others."""
    names = ["key", "node", *facts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hot.value if hot is not None else None
        for batch in batches:
            for tokens, *same in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = np.frombuffer(tokens, "<i8")
                if known is not None:
                    inside = known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys if len(known) else np.zeros(len(keys), bool)
                    keys = keys[inside == want_hot]
                for at in range(0, len(keys), 1 << 16):
                    part = keys[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array(np.full(len(part), x, np.int64)) for x in same)], names=names)

    return blobs.select("tokens", "node", *facts).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _hot_keys(blobs: DataFrame) -> np.ndarray:
    """Sorted keys with more than ``HOT_KEY`` rows, at most ``HOT_KEYS``; a power-of-two count bounds them from below."""
    counts = _pair_keys(blobs).groupBy("key").agg(F.count("*").alias("held")).filter(F.col("held") > HOT_KEY)
    counts = materialise(counts, "hot")
    least, total = HOT_KEY, 0
    for row in counts.groupBy(F.floor(F.log2("held")).alias("step")).count().orderBy(F.desc("step")).collect():  # at most 63 rows
        total += row["count"]
        if total > HOT_KEYS:
            least = 2 ** (row["step"] + 1) - 1
            break
    keys = counts.filter(F.col("held") > least).select("key").toPandas()["key"].to_numpy(np.int64)  # bounded by the loop above
    discard(counts)
    return np.sort(keys)


def _lists(rare: DataFrame, blobs: DataFrame, hot) -> DataFrame:
    """(first, m): sorted nodes of all keys that are not hot, by their first node."""
    pairs = _pair_keys(blobs, hot, False).groupBy("key").agg(F.sort_array(F.collect_set("node")).alias("m")).filter(F.size("m") > 1)
    every = rare.unionByName(pairs.select("m")).distinct()
    return every.select(F.get("m", F.lit(0)).alias("first"), "m")


def _members(lists: DataFrame) -> DataFrame:
    """(first, node) of the lists, once for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, size = [], None, 0
        for batch in batches:
            firsts, column = batch.column(0).to_pylist(), batch.column(1)
            flat, cuts = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
            for k, first in enumerate(firsts):
                if held and (first != last or size > 1_000_000):
                    nodes = np.unique(np.concatenate(held))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), last, np.int64)), pa.array(nodes)], names=["first", "node"])
                    held, size = [], 0
                last = first
                held.append(flat[cuts[k] : cuts[k + 1]])
                size += len(held[-1])
        if held:
            nodes = np.unique(np.concatenate(held))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), last, np.int64)), pa.array(nodes)], names=["first", "node"])

    return lists.repartition("first").sortWithinPartitions("first").mapInArrow(run, "first long, node long").distinct()


def _listed_pairs(lists: DataFrame, members: DataFrame, texts: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b) of nodes of the same list that are under different roots and whose sketches leave room.

    Lists with the same first node meet its members in one group: as many lists as this node has keys, each of at most
    ``HOT_KEY`` nodes.
    """
    known = texts.select("node", "n", "sketch").join(roots.select("node", "component"), "node", "left")
    facts = members.join(known, "node").select("first", "node", "n", "sketch", F.coalesce("component", "node").alias("comp"))

    def pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        lists, right = left.column("m").combine_chunks(), right.sort_by("node")
        nodes, n, comp = (right.column(c).to_numpy() for c in ("node", "n", "comp"))
        cells = np.frombuffer(b"".join(right.column("sketch").to_pylist()), np.uint8).reshape(-1, CELLS)
        flat, cuts = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        place = np.searchsorted(nodes, flat)
        out_a, out_b = [], []
        for i, j in _blocks_of(place, cuts, len(nodes)):
            fits = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            i, j = i[fits], j[fits]
            for at in range(0, len(i), 8192):
                x, y = i[at : at + 8192], j[at : at + 8192]
                kept = _leaves_room(cells[x], cells[y], n[x] + n[y], percent)
                out_a.append(nodes[x[kept]])
                out_b.append(nodes[y[kept]])
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([*out_a, none]), "b": np.concatenate([*out_b, none])})

    grouped = lists.groupBy("first").cogroup(facts.groupBy("first"))
    return grouped.applyInArrow(pairs, "a long, b long").distinct()


def _blocks_of(place: np.ndarray, cuts: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places that are in a common list, each pair once, some thousand first members at a time."""
    step = max(1, (1 << 22) // max(1, n))
    for low in range(0, n, step):
        table = np.zeros((min(step, n - low), n), bool)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            members = place[a:b]
            inside = members[(members >= low) & (members < low + step)] - low
            if len(inside):
                table[np.ix_(inside, members)] = True
        i, j = np.nonzero(table)
        ahead = j > i + low
        yield i[ahead] + low, j[ahead]


def _leaves_room(p: np.ndarray, q: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Whether the tokens that two sketches may share are enough for two sets of ``n`` tokens together."""
    low = np.minimum(p, q)
    return (low == 255).any(1) | ((100 + percent) * low.sum(1, dtype=np.int64) >= percent * n)


def _sketch(tokens: np.ndarray) -> bytes:
    """Tokens in each cell of the hash space, 255 standing for any more."""
    cells = np.bincount((tokens >> np.uint64(20)).astype(np.int64) % CELLS, minlength=CELLS)
    return np.minimum(cells, 255).astype(np.uint8).tobytes()


def _room(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sketches leave room for enough common tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                p, q = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint8).reshape(-1, CELLS) for i in (2, 3))
                kept.append(_leaves_room(p, q, part.column(4).to_numpy() + part.column(5).to_numpy(), percent))
            mask = pa.array(np.concatenate(kept) if kept else np.zeros(0, bool))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(mask)

    left = texts.select(F.col("node").alias("a"), F.col("sketch").alias("p"), F.col("n").alias("na"))
    right = texts.select(F.col("node").alias("b"), F.col("sketch").alias("q"), F.col("n").alias("nb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "p", "q", "na", "nb")
    return joined.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, linked) of candidate pairs, from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0

        def tokens(node: int, text: bytes) -> np.ndarray:
            nonlocal size
            if node not in held:
                found = next(text_sets([text], words))
                if size + len(found) > HELD_TOKENS:
                    held.clear()
                    size = 0
                held[node] = found
                size += len(found)
            return held[node]

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                a, b = part.column(0), part.column(1)
                linked = []
                for x, y, s, t in zip(a.to_pylist(), b.to_pylist(), _texts(part.column(2)), _texts(part.column(3)), strict=True):
                    p, q = tokens(x, s), tokens(y, t)
                    both = len(p) + len(q) - len(sorted_unique(np.concatenate((p, q))))
                    linked.append(100 * both >= percent * (len(p) + len(q) - both))
                yield pa.RecordBatch.from_arrays([a, b, pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    left = texts.select(F.col("node").alias("a"), F.col("text_").alias("p"))
    right = texts.select(F.col("node").alias("b"), F.col("text_").alias("q"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "p", "q").mapInArrow(run, "a long, b long, linked boolean")


def _with_nodes(rows: DataFrame, words: int) -> DataFrame:
    """(node, text_, n, sketch) of rows (node_, text_) whose text has that node, once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                kept, n, sketches = [], [], []
                for k, (node, tokens) in enumerate(zip(part.column(0).to_pylist(), text_sets(_texts(part.column(1)), words), strict=True)):
                    if len(tokens) and node not in seen and _node(tokens) == node:
                        seen.add(node)
                        kept.append(k)
                        n.append(len(tokens))
                        sketches.append(_sketch(tokens))
                rows = part.take(pa.array(kept, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(n, pa.int64()), pa.array(sketches, pa.binary())], names=["node", "text_", "n", "sketch"])

    return rows.select("node_", "text_").mapInArrow(run, "node long, text_ string, n long, sketch binary")


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def _first_pairs(keyed: DataFrame, percent: int) -> DataFrame:
    """(a, b) of every node and a centre for each of its smallest tokens, where their sizes allow a link.

    Each token has a centre of its own: a set that is far from one of them may be close to another.
    """
    rows = keyed.filter("node is not null").groupBy("node").agg(F.first("first").alias("first"), F.first("n_shingles").alias("n"))
    rows = rows.select("node", "n", F.explode("first").alias("token"))
    tops = rows.groupBy("token").agg(F.count("*").alias("held"), F.min_by(F.struct("node", "n"), F.xxhash64("node", "token")).alias("c")).filter("held > 1")
    met = rows.join(tops, "token").filter("node != c.node").filter(100 * F.least("n", "c.n") >= percent * F.greatest("n", "c.n"))
    return _ordered(met, "node", "c.node").distinct()


def _joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) from the roots of nodes and further links: only links between roots are followed."""
    up = {c: roots.select(F.col("node").alias(c), F.col("component").alias(f"r{c}")) for c in ("a", "b")}
    tops = links.join(up["a"], "a", "left").join(up["b"], "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    above = materialise(components(tops.distinct()), "above")
    ends = above.select(F.col("node").alias("component"), F.col("component").alias("top"))
    below = roots.join(ends, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return below.unionByName(above.join(roots.select("node"), "node", "left_anti").select("node", "component"))


def _hot_tiles(blobs: DataFrame, hot, roots: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(node, chunk, comp) of the members of hot keys, and (a, b) of the chunks to be compared, a <= b.

    A node's home is the hot key with most rows among its own. The members of a home, those under its largest root apart and by classes of size,
    are dealt into chunks of about ``TILE`` nodes. Two chunks meet once, however many keys they share, unless they are under one root or no two of
    their sets are close enough in size.
    """
    labelled = blobs.join(roots.select("node", "component"), "node", "left").withColumn("comp", F.coalesce("component", "node"))
    rows = materialise(_pair_keys(labelled, hot, True, ("comp", "n")), "hot")
    mixed = rows.groupBy("key").agg(F.count("*").alias("held"), F.min("comp").alias("least"), F.max("comp").alias("most")).filter("least < most")
    met = materialise(rows.join(mixed.select("key", "held"), "key"), "met")
    nodes = met.groupBy("node").agg(F.max(F.struct("held", "key"))["key"].alias("home"), F.first("comp").alias("comp"), F.first("n").alias("n"))
    largest = nodes.groupBy("home", "comp").agg(F.count("*").alias("held")).groupBy("home").agg(F.max(F.struct("held", "comp"))["comp"].alias("main"))
    step = F.floor(F.log("n") / F.log(F.lit(100 / percent))) if percent < 100 else F.col("n")
    sorts = nodes.join(largest, "home").withColumns({"inner": F.col("comp") == F.col("main"), "step": step})
    sizes = sorts.groupBy("home", "inner", "step").agg(F.ceil(F.count("*") / TILE).alias("parts"))
    dealt = sorts.join(sizes, ["home", "inner", "step"]).withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    dealt = materialise(dealt.select("node", "n", "comp", F.xxhash64("home", "inner", "step", "part").alias("chunk")), "chunks")
    discard(rows)

    facts = dealt.groupBy("chunk").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("n", "comp")])
    keys = met.select("key", "node").join(dealt.select("node", "chunk"), "node").select("key", "chunk").distinct().join(facts, "chunk")
    keys = materialise(keys, "keys")
    one, two = (keys.select("key", *[F.col(c).alias(f"{side}_{c}") for c in ("chunk", *facts.columns[1:])]) for side in "ab")
    pairs = one.join(two, "key").filter("a_chunk <= b_chunk")
    apart = (F.col("a_min_comp") != F.col("b_max_comp")) | (F.col("b_min_comp") != F.col("a_max_comp"))
    close = [100 * F.col(f"{y}_max_n") >= percent * F.col(f"{x}_min_n") for x, y in ("ab", "ba")]
    pairs = pairs.filter(apart & close[0] & close[1]).select(F.col("a_chunk").alias("a"), F.col("b_chunk").alias("b")).distinct()
    pairs = materialise(pairs, "tiles")
    discard(met, keys)
    return dealt.select("node", "chunk", "comp"), pairs


def _hot_pairs(blobs: DataFrame, hot, texts: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b) of members of hot keys that are under different roots and whose sizes and sketches leave room.

    Sketches meet chunk by chunk, a tile of two chunks in one group, so a pair is written only if it has room.
    """
    dealt, pairs = _hot_tiles(blobs, hot, roots, percent)
    members = dealt.join(texts.select("node", "n", "sketch"), "node")
    # A chunk that meets itself comes once.
    ends = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("chunk"))
    tiles = ends.join(members, "chunk").select("a", "b", "chunk", "node", "n", "comp", "sketch")

    def compared(tile: pa.Table) -> pa.Table:
        first, second, own = (tile.column(c).to_numpy() for c in ("a", "b", "chunk"))
        once = len(own) and first[0] == second[0]
        sides = [tile.filter(pa.array(own == ends)) for ends in (first, second)]
        (a, na, ca), (b, nb, cb) = ([t.column(c).to_numpy() for c in ("node", "n", "comp")] for t in sides)
        p, q = (np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, CELLS) for t in sides)
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        step = max(1, (1 << 20) // max(1, len(b)))
        for low in range(0, len(a), step):
            x, n = slice(low, low + step), na[low : low + step, None]
            fits = (ca[x, None] != cb) & (100 * np.minimum(n, nb) >= percent * np.maximum(n, nb))
            if once:
                fits &= a[x, None] < b
            i, j = np.nonzero(fits)
            i += low
            for at in range(0, len(i), 8192):
                k, m = i[at : at + 8192], j[at : at + 8192]
                kept = _leaves_room(p[k], q[m], na[k] + nb[m], percent)
                out_a.append(a[k[kept]])
                out_b.append(b[m[kept]])
        return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return _ordered(tiles.groupBy("a", "b").applyInArrow(compared, "a long, b long"), "a", "b").distinct()


def similar_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles`` (size of its set) and ``component_id``.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of their sets; a component's id is the smallest
    document id reachable by links. Null, empty and blank texts have an empty set and link with nothing. Repeated ids:
    each row is a document of its own. A null id keeps its row; the component id is then the smallest id that is not null,
    or null. Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text_"))
    # Five bytes and a space are a usual word; the number of ranges only sizes tasks.
    size = texts.agg(F.sum(F.octet_length("text_"))).first()[0] or 0
    n_ranges = max(4, size // 6 // RANGE_TOKENS)
    read = materialise(read_sets(docs, id_col, text_col, words, n_ranges), "sets")
    keyed = materialise(read.filter("part is null").select("id_", "mark_", "n_shingles", "node", "first"), "keys")
    nodes = keyed.filter("node is not null").groupBy("node").agg(F.min("id_").alias("doc"), F.min(F.struct("id_", "mark_")).alias("at"))
    nodes = materialise(nodes, "nodes")
    frequent = spark.sparkContext.broadcast(class_table(read.filter("part is not null").select("part", "blob")))
    blobs = materialise(pair_blobs(texts, words, n_ranges, percent, frequent), "pairs")
    hot_keys = spark.sparkContext.broadcast(_hot_keys(blobs))
    first = materialise(_first_pairs(keyed, percent), "first")
    lists = materialise(_lists(_rare_lists(rare_blobs(texts, words, n_ranges, percent, frequent)), blobs, hot_keys), "lists")
    members = materialise(_members(lists), "members")
    discard(read)

    # One text of each candidate is kept: a row of its smallest id, known by the hash of its text as well, as ids may repeat.
    ends = first.select(F.col("a").alias("node")).unionByName(first.select(F.col("b").alias("node")))
    ends = ends.unionByName(members.select("node")).unionByName(_pair_keys(blobs, hot_keys, True).select("node")).distinct()
    wanted = ends.join(nodes, "node").select(F.col("at.id_").alias("doc_"), F.col("at.mark_").alias("mark_"), F.col("node").alias("node_"))
    again = docs.select(F.col(id_col).alias("id_"), F.xxhash64(F.col(text_col)).alias("own_"), F.col(text_col).alias("text_"))
    # Rows of one id and text meet in one task, so a text that is repeated is taken once.
    chosen = again.join(wanted, F.col("id_").eqNullSafe(F.col("doc_")) & (F.col("own_") == F.col("mark_")))
    chosen = materialise(_with_nodes(chosen, words), "texts")

    links = materialise(_verified(_room(first, chosen, percent), chosen, words, percent).filter("linked").select("a", "b"), "links")
    roots = materialise(components(links), "roots")
    discard(first, links)
    met = _hot_pairs(blobs, hot_keys, chosen, roots, percent)
    apart = materialise(_listed_pairs(lists, members, chosen, roots, percent).unionByName(met).distinct(), "apart")
    more = materialise(_verified(apart, chosen, words, percent).filter("linked").select("a", "b").distinct(), "links")
    discard(blobs, lists, members, chosen, apart)
    comps = materialise(_joined_roots(roots, more), "components")
    discard(roots, more)

    joined = nodes.join(comps, "node").select("node", "component", "doc")
    tops = joined.groupBy("component").agg(F.min("doc").alias("top"))
    linked = joined.join(tops, "component").select("node", "top")
    least = nodes.join(linked, "node", "left").select("node", F.coalesce("top", "doc").alias("doc"))
    out = keyed.drop("first", "mark_").join(least, "node", "left")
    return out.select(F.col("id_").alias(id_col), "n_shingles", F.coalesce("doc", "id_").alias("component_id"))


def first_of_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents with the smallest id of their component, all columns as they were.

    Rows with a null id stay. Rows that repeat an id stay or go together.
    """
    found = similar_components(docs, id_col=id_col, text_col=text_col, words=words, percent=percent)
    extra = found.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone_")).distinct()
    extra = materialise(extra, "extra")
    return docs.join(extra, docs[id_col] == extra["gone_"], "left_anti")
