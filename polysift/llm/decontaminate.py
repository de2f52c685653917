"""Benchmark decontamination: one Aho-Corasick automaton over the words of all test items, texts scanned once.

Every distinct benchmark word becomes one symbol, so a window of words is a short string of symbols and a text is a
string with one symbol per word (a common symbol stands for words no item has). The automaton reports where windows
end; word places map back to code point offsets of the original text.

The benchmark is cut into pieces of items and these into blocks of about ``BLOCK_WORDS`` words, counted and numbered by Spark; a block is
broadcast as plain words and its automaton is built in the tasks. A benchmark of one block, the usual case, takes one pass
over the texts, in place. With more blocks each has a pass of its own, so that neither the driver nor a task ever holds more than one; a pass
writes only the hits it found, and they meet at the end by the texts' numbers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polysift.llm.common import alnum_words, map_texts
from polysift.scratch import materialise

WINDOW = 13
#: Words of one automaton, on average at most half of them; also below the number of code points that can stand for a word.
BLOCK_WORDS = 1_000_000
#: Words of a piece of an item; pieces overlap by a window less one word, so no window is lost.
PIECE_WORDS = 50_000
#: A text is contaminated if hit words are at least one in so many.
SHARE = 20

#: Words of a text before lower-casing.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SCHEMA = (
    "n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, contaminated boolean,"
    " spans array<struct<start:long,end:long>>"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FIELDS = {
    "n_words": pa.int64(), "n_hit": pa.int64(), "n_items": pa.int64(), "items": pa.list_(pa.string()),
    "items_sha256": pa.string(), "contaminated": pa.bool_(), "spans": _SPANS,
}


def _symbol(k: int) -> str:
    """Code point of the k-th word, from 1, around the surrogates; 0 stands for all other words."""
    return chr(k if k < 0xD800 else k + 0x800)


#: Owner of a window: the item's id, or for an item without one a digest of its text.
Owner = tuple[bool, str]


def block_automaton(items: list[tuple[Owner, list[bytes]]], window: int) -> tuple[dict[bytes, str], ahocorasick.Automaton | None]:
    """Symbols by word, and the automaton whose values are (window length, owners); none without windows."""
    symbols: dict[bytes, str] = {}
    windows: dict[str, set[Owner]] = {}
    for item, words in items:
        line = "".join(symbols.setdefault(w, _symbol(len(symbols) + 1)) for w in words)
        for at in range(max(1, len(line) - window + 1)):
            windows.setdefault(line[at : at + window], set()).add(item)
    if not windows:
        return {}, None
    automaton = ahocorasick.Automaton()
    for line, owners in windows.items():
        automaton.add_word(line, (len(line), tuple(sorted(owners))))
    automaton.make_automaton()
    return symbols, automaton


def _pieces(benchmark: DataFrame, item_col: str, text_col: str, window: int, size: int) -> DataFrame:
    """(item, named, words, n): whole items, or overlapping pieces of long ones."""
    names = ["item", "named", "words", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = alnum_words(text)
                owner = item if item is not None else hashlib.sha256(b" ".join(words)).hexdigest()
                for at in range(0, max(1, len(words) - window + 1), size) if words else ():
                    part = words[at : at + size + window - 1]
                    row = [owner, item is not None, b" ".join(part), len(part)]
                    kinds = [pa.string(), pa.bool_(), pa.binary(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    told = benchmark.select(F.col(item_col).cast("string"), F.col(text_col))
    return materialise(told.mapInArrow(run, "item string, named boolean, words binary, n long"), "benchmark")


class _Blocks:
    """The benchmark's blocks, each read when it is asked for."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int):
        size = max(window, min(PIECE_WORDS, block_words // 4))
        self.pieces = _pieces(benchmark, item_col, text_col, window, size)
        total = self.pieces.agg(F.sum("n")).first()[0] or 0
        self.count = 1 if total <= block_words else -(-2 * total // block_words)

    def broadcast(self, number: int):
        """The words of one block, of a size that the number of blocks was chosen for."""
        place = F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
        rows = self.pieces.filter(F.pmod(place, F.lit(self.count)) == number).collect()
        return self.pieces.sparkSession.sparkContext.broadcast([((r["named"], r["item"]), bytes(r["words"])) for r in rows])


def _built(shared, window: int):
    """The block's automaton, built in the task."""
    return block_automaton([(owner, words.split(b" ")) for owner, words in shared.value], window)


def word_offsets(text: str, first: np.ndarray, last: np.ndarray) -> list[dict[str, int]]:
    """Code point offsets of runs of words, given by their first and last word."""
    at = [m.span() for m in _WORD.finditer(text)]
    return [{"start": at[a][0], "end": at[b][1]} for a, b in zip(first.tolist(), last.tolist(), strict=True)]


def hits(text: str | None, block) -> tuple[int, list[tuple[int, int]], set[Owner]]:
    """Number of words, runs of hit words (first, after the last) and owners of the windows that a block finds."""
    words = alnum_words(text)
    symbols, automaton = block
    if automaton is None:
        return len(words), [], set()
    get = symbols.get
    found: set[Owner] = set()
    runs: list[tuple[int, int]] = []
    for end, (length, owners) in automaton.iter("".join([get(w, "\0") for w in words])):
        runs.append((end - length + 1, end + 1))
        found.update(owners)
    return len(words), _united(runs), found


def _united(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words in runs that neither touch nor overlap."""
    out: list[tuple[int, int]] = []
    for first, after in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(after, out[-1][1]))
        else:
            out.append((first, after))
    return out


def told(text: str | None, n: int, runs: list[tuple[int, int]], found: set[Owner], share: int) -> tuple:
    """The values of ``_FIELDS``; items without an id are counted but have no place among the ids."""
    n_hit = sum(after - first for first, after in runs)
    ids = sorted(item for named, item in found if named)
    spans = word_offsets(text, np.array([r[0] for r in runs]), np.array([r[1] - 1 for r in runs])) if runs else []
    digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
    return n, n_hit, len(found), ids, digest, n_hit > 0 and share * n_hit >= n, spans


_HITS = "row long, runs array<struct<first:long,after:long>>, items array<struct<named:boolean,item:string>>"


def _passes(stored: DataFrame, blocks: _Blocks, window: int) -> DataFrame:
    """(row_, hits_): what all blocks found in numbered texts (row_, text_); texts without a hit are left out."""
    runs_kind = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))
    items_kind = pa.list_(pa.struct([("named", pa.bool_()), ("item", pa.string())]))
    written = []
    for number in range(blocks.count):
        shared = blocks.broadcast(number)

        def start(shared=shared):
            block = _built(shared, window)

            def step(rows, texts):
                found = [(row, *hits(t, block)[1:]) for row, t in zip(rows, texts, strict=True)]
                some = [f for f in found if f[1]]
                runs = [[{"first": a, "after": b} for a, b in f[1]] for f in some]
                return {"row": [f[0] for f in some], "runs": runs, "items": [[{"named": n, "item": i} for n, i in sorted(f[2])] for f in some]}

            return step

        part = map_texts(stored, ["row_", "text_"], _HITS, {"row": pa.int64(), "runs": runs_kind, "items": items_kind}, start)
        written.append(materialise(part, "hits"))
        shared.destroy()
    union = written[0]
    for part in written[1:]:
        union = union.unionByName(part)
    flat = lambda c: F.flatten(F.collect_list(c))  # noqa: E731  at most the windows of one text
    return union.groupBy(F.col("row").alias("row_")).agg(F.struct(flat("runs").alias("runs"), flat("items").alias("items")).alias("hits_"))


def _numbered(docs: DataFrame, text_col: str, keep: list) -> DataFrame:
    return materialise(docs.select(*keep, F.col(text_col).alias("text_"), F.monotonically_increasing_id().alias("row_")), "texts")


def _merged(text: str | None, found: dict | None, share: int) -> tuple:
    runs = _united([(r["first"], r["after"]) for r in found["runs"]]) if found else []
    items = {(i["named"], i["item"]) for i in found["items"]} if found else set()
    return told(text, len(alnum_words(text)), runs, items, share)


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, share: int = SHARE, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: id, words, hit words, items found, contaminated or not, spans of the hits.

    A null text or item has no words. Items without words are never found; repeated items count once. An item without an
    id hits words and counts as an item (equal texts as one), but has no place among the item ids. No documents or no items: no rows, or rows
    without hits. Other columns are ignored. The result has the id column first, under its own name, and the columns of ``_SCHEMA``.
    """
    ident = docs.schema[id_col]
    kind = pa.int64() if ident.dataType.simpleString() == "bigint" else pa.string()
    shown = "bigint" if kind == pa.int64() else "string"
    blocks = _Blocks(benchmark, item_col, item_text_col, window, block_words)
    fields, schema = {"id_": kind, **_FIELDS}, f"id_ {shown}, {_SCHEMA}"
    ids = F.col(id_col).cast(shown).alias("id_")
    if blocks.count == 1:
        shared = blocks.broadcast(0)

        def start():
            block = _built(shared, window)

            def step(ids, texts):
                found = [told(t, *hits(t, block), share) for t in texts]
                return {"id_": ids} | {k: [f[i] for f in found] for i, k in enumerate(_FIELDS)}

            return step

        out = map_texts(docs.select(ids, F.col(text_col).alias("text_")), ["id_", "text_"], schema, fields, start)
    else:
        stored = _numbered(docs, text_col, [ids])

        def finish():
            def step(ids, texts, found):
                rows = [_merged(t, f, share) for t, f in zip(texts, found, strict=True)]
                return {"id_": ids} | {k: [f[i] for f in rows] for i, k in enumerate(_FIELDS)}

            return step

        joined = stored.join(_passes(stored, blocks, window), "row_", "left")
        out = map_texts(joined, ["id_", "text_", "hits_"], schema, fields, finish)
    return out.withColumnRenamed("id_", id_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", window: int = WINDOW, share: int = SHARE,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that are not contaminated, all their columns as they were; with one block a filter in place, without a shuffle."""
    blocks = _Blocks(benchmark, "item_id", "text", window, block_words)
    if blocks.count > 1:
        stored = _numbered(docs, text_col, [F.struct(*docs.columns).alias("doc_")])

        def judge():
            def step(rows, texts, found):
                bad = [r for r, t, f in zip(rows, texts, found, strict=True) if _merged(t, f, share)[5]]
                return {"bad_": bad}

            return step

        some = stored.join(_passes(stored, blocks, window), "row_")
        bad = map_texts(some, ["row_", "text_", "hits_"], "bad_ long", {"bad_": pa.int64()}, judge)
        return stored.join(bad, F.col("row_") == F.col("bad_"), "left_anti").select("doc_.*")
    shared = blocks.broadcast(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _built(shared, window)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                clean = []
                for t in texts:
                    n, runs, _ = hits(t, block)
                    n_hit = sum(b - a for a, b in runs)
                    clean.append(not (n_hit and share * n_hit >= n))
                yield part.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
