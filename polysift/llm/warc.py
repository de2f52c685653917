"""WARC records, and a Merkle audit that finds the records in which two replicas differ.

Records of a file are leaves in offset order. ``FANOUT`` neighbours make a node whose digest covers their offset ranges and
digests in order, up to one node per file; the files, in order of their number, are combined the same way up to one root. Trees of
replicas are compared from the root: only the children of differing nodes are looked at, level by level.

What the descent leaves is aligned by content: in a file that lost a record or got one more, all later places differ, but their records
are found again by their digests, so that one lost record is one finding.

Record bodies are hashed where they are read; what moves is one digest per record, and a node's children, at most
``FANOUT`` rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from polysift.scratch import materialise

FANOUT = 16
RECORDS_PER_FILE = 256
#: Levels of 16 children above 64-bit file numbers.
MAX_LEVELS = 17
VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
_END = "\r\n\r\n"


def record_text(url: Column, body: Column, *, date: str = DATE) -> Column:
    """A ``resource`` record without the closing line feeds; null parts count as empty."""
    body, url = F.coalesce(body, F.lit("")), F.coalesce(url, F.lit(""))
    name = F.sha2(F.concat_ws("\n", url, body), 256)
    uuid = F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    lines = [
        F.lit(VERSION), F.lit("WARC-Type: resource"), F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), uuid, F.lit(">")),
        F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(url, "[\r\n]", " ")),
        F.lit("Content-Type: text/html"), F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(_END), body)


def file_number(page_id: Column, *rest: Column, per_file: int = RECORDS_PER_FILE) -> Column:
    """File of a record by its id; records without an id are spread by their content."""
    return F.floor(F.coalesce(page_id.cast("bigint"), F.xxhash64(*rest)) / per_file)


def records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """(file, id_, record): the pages as records of numbered files."""
    page_id, url, html = F.col(id_col), F.col(url_col), F.col(html_col)
    return pages.select(
        file_number(page_id, url, html, per_file=per_file).alias("file"), page_id.cast("bigint").alias("id_"), record_text(url, html).alias("record")
    )


def write_warc(rows: DataFrame, path: str) -> None:
    """Records as uncompressed WARC files, one folder per file number; Spark's text writer ends each with two line breaks."""
    ordered = rows.select("file", "id_", "record").repartition("file").sortWithinPartitions("file", "id_", F.sha2("record", 256))
    ordered.select("file", F.col("record").alias("value")).write.option("lineSep", _END).partitionBy("file").mode("overwrite").text(path)


#: Bytes that are taken from a compressed file at a time.
CHUNK = 1 << 22
_VERSION_LINE = re.compile(rb"WARC/[0-9]+\.[0-9]+[ \t]*\r?\n")
_HEAD_END = re.compile(rb"\r?\n\r?\n")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, length, uri, body, sha256) of every record under a folder; a file, one gigabyte by custom, is one task's work.

    Any version, plain or gzip, with a member per record or otherwise; offsets and digests are those of the uncompressed records. Names of
    headers in any case, with or without a space behind the colon, lines that go on with a space. A record ends where its
    ``Content-Length`` says; what cannot be read as a record up to the next version line, or a damaged gzip member, is a row
    with a null uri and body. A record without a target has an empty uri.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "offset", "length", "uri", "body", "sha256"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows: list[tuple] = []
                for record in parsed(content.as_buffer()):
                    rows.append((name, *record))
                    if len(rows) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
                        rows = []
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, offset long, length long, uri string, body binary, sha256 string")


def _uncompressed(data) -> Iterator[bytes | None]:
    """Chunks of a file's content; a damaged gzip member is a None, and reading goes on with the next one."""
    view = memoryview(data)
    if bytes(view[:2]) != b"\x1f\x8b":
        yield from (bytes(view[at : at + CHUNK]) for at in range(0, len(view), CHUNK))
        return
    at = 0
    while at < len(view):
        member, fed = zlib.decompressobj(31), at
        try:
            while not member.eof and fed < len(view):
                piece = view[fed : fed + CHUNK]
                fed += len(piece)
                if chunk := member.decompress(piece):
                    yield chunk
            if not member.eof:
                raise zlib.error("the file ends within a member")
            at = fed - len(member.unused_data)
        except zlib.error:
            yield None
            found = bytes(view[at + 2 :]).find(b"\x1f\x8b\x08")
            at = len(view) if found < 0 else at + 2 + found


def parsed(data) -> Iterator[tuple[int, int, str | None, bytes | None, str]]:
    """(offset, length, uri, body, sha256) of the records of a file; what is read is forgotten, but for the record at hand."""
    held, offset, chunks, more = bytearray(), 0, _uncompressed(data), True

    def row(end: int, uri: str | None, body: bytes | None) -> tuple:
        return offset, end, uri, body, hashlib.sha256(memoryview(held)[:end]).hexdigest()

    while True:
        at = len(held) - len(held.lstrip(b"\r\n"))
        del held[:at]
        offset += at
        found = _record(held) if held else None
        if found is None and more:  # the record may go on
            chunk = next(chunks, b"")
            if chunk is None:
                yield row(len(held), None, None)
                offset += len(held)
                held.clear()
            elif chunk:
                held += chunk
            else:
                more = False
            continue
        if not held:
            return
        end, uri, body = found or _unreadable(held)
        yield row(end, uri, body)
        del held[:end]
        offset += end


def _record(held: bytearray) -> tuple[int, str | None, bytes | None] | None:
    """End, uri and body of the record that ``held`` begins with; None if it is not there as a whole."""
    if not _VERSION_LINE.match(held):
        following = re.search(rb"\nWARC/[0-9]+\.[0-9]+[ \t]*\r?\n", held)
        return (following.start() + 1, None, None) if following else None
    head = _HEAD_END.search(held)
    if not head:
        return None
    another = re.search(rb"\nWARC/[0-9]+\.[0-9]+[ \t]*\r?\n", bytes(held[: head.start()]))
    if another:  # a head without an end
        return another.start() + 1, None, None
    lines = re.sub(rb"\r?\n[ \t]+", b" ", bytes(held[: head.start()])).split(b"\n")[1:]
    fields = {name.strip().lower(): value.strip() for name, colon, value in (line.partition(b":") for line in lines) if colon}
    length = fields.get(b"content-length", b"")
    if not length.isdigit():
        return _unreadable(held, head.end()) if re.search(rb"\nWARC/", held) else None
    end = head.end() + int(length)
    if end > len(held):
        return None
    return end, fields.get(b"warc-target-uri", b"").strip(b"<>").decode("utf-8", "replace"), bytes(held[head.end() : end])


def _unreadable(held: bytearray, start: int = 1) -> tuple[int, None, None]:
    """Up to the next version line."""
    following = re.compile(rb"\nWARC/[0-9]+\.[0-9]+[ \t]*\r?\n").search(held, start - 1)
    return (following.start() + 1 if following else len(held)), None, None


def manifest(rows: DataFrame) -> DataFrame:
    """(file, seq, id_, offset, length, sha256, sum): place and digest of every record of ``records``, in id order.

    Repeated ids stand next to each other in order of their digest. The window of a file covers its records, numbers only.
    """
    hashed = rows.select("file", "id_", F.octet_length("record").cast("bigint").alias("length"), F.sha2("record", 256).alias("sha256"))
    order = Window.partitionBy("file").orderBy(F.col("id_").asc_nulls_last(), "sha256")
    before = F.sum(F.col("length") + len(_END)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return hashed.select(
        "file", (F.row_number().over(order) - 1).cast("bigint").alias("seq"), "id_", F.coalesce(before, F.lit(0)).cast("bigint").alias("offset"), "length", "sha256"
    )


def _parent(level: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes over runs of at most ``FANOUT`` children; the digest covers their ranges in order.

    An only record, or run of records, keeps its digest, so that a longer file elsewhere does not change a file's digest.
    """
    last = keys[-1]
    line = F.concat_ws(":", F.col(last).cast("string"), F.col("first").cast("string"), F.col("end").cast("string"), F.coalesce("sha256", F.lit("-")))
    grouped = level.groupBy(*keys[:-1], F.shiftright(last, 4).alias("up")).agg(
        F.sort_array(F.collect_list(F.struct(F.col(last).alias("k"), line.alias("line"), "sha256"))).alias("kids"), F.min("first").alias("first"), F.max("end").alias("end")
    )
    text = F.concat_ws("\n", F.transform("kids", lambda x: x.line))
    digest = F.sha2(text, 256)
    if last == "seq":
        digest = F.when(F.size("kids") == 1, F.get("kids", F.lit(0))["sha256"]).otherwise(digest)
    return grouped.select(*keys[:-1], F.col("up").alias(last), "first", "end", digest.alias("sha256"))


@dataclass(frozen=True)
class Tree:
    """Levels from the bottom: nodes (file, seq, first, end, sha256) over records, and (file, first, end, sha256) over files."""

    records: list[DataFrame]
    files: list[DataFrame]


def tree(leaves: DataFrame, *, name: str = "tree") -> Tree:
    """Tree over records (file, seq, offset, length, sha256); a null digest stands for a record that cannot be read."""
    level = leaves.select("file", "seq", F.col("offset").alias("first"), (F.col("offset") + F.col("length")).alias("end"), "sha256")
    records = [materialise(level, name)]
    while (top := records[-1].agg(F.max("seq")).first()[0]) is not None and top > 0:
        records.append(materialise(_parent(records[-1], ["file", "seq"]), name))
    files = [materialise(records[-1].drop("seq"), name)]
    while len(files) < MAX_LEVELS and files[-1].limit(2).count() > 1:
        files.append(materialise(_parent(files[-1], ["file"]), name))
    return Tree(records, files)


def _compared(mine: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes that differ, with what is wrong with them."""
    a, b = mine.select(*keys, F.struct("first", "end", "sha256").alias("a")), other.select(*keys, F.struct("first", "end", "sha256").alias("b"))
    both = a.join(b, keys, "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
    lost = F.col("b").isNull() | F.col("b.sha256").isNull() & F.col("a.sha256").isNotNull()
    status = F.when(F.col("a").isNull(), "extra").when(lost, "missing").otherwise("corrupt")
    return materialise(both.select(*keys, status.alias("status")), "differing")


def audit(ours: Tree, theirs: Tree) -> DataFrame:
    """(file, seq, status) of records that differ: ``corrupt``, ``missing`` from theirs or ``extra`` there.

    Equal roots end it at once. Trees of different heights are compared from their common top; a level is read only under
    nodes that differ.
    """
    differing = None
    for mine, other in reversed(list(zip(ours.files, theirs.files))):
        if differing is not None:
            up = differing.select(F.col("file").alias("up"))
            mine, other = (x.withColumn("up", F.shiftright("file", 4)).join(up, "up", "left_semi").drop("up") for x in (mine, other))
        differing = _compared(mine, other, ["file"])
    inside = differing.select("file")
    for depth, (mine, other) in reversed(list(enumerate(zip(ours.records, theirs.records)))):
        if depth == min(len(ours.records), len(theirs.records)) - 1:
            mine, other = (x.join(inside, "file", "left_semi") for x in (mine, other))
        else:
            up = differing.select("file", F.col("seq").alias("up"))
            mine, other = (x.withColumn("up", F.shiftright("seq", 4)).join(up, ["file", "up"], "left_semi").drop("up") for x in (mine, other))
        differing = _compared(mine, other, ["file", "seq"])
    return differing


def fixity(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Records of a manifest with ``status``: ``intact`` or what the audit of the replica found, and extra ones of the replica.

    Both tables have (file, seq, offset, length, sha256); other columns of ``ours`` are kept. A null digest of theirs is a record that cannot
    be read and counts as missing. Where both have ``id_``, a record with the id of another digest is corrupt; without, one at the
    same place. Two empty tables give no rows.
    """
    ours, theirs = materialise(ours, "manifest"), materialise(theirs, "replica")
    found = _aligned(audit(tree(ours, name="ours"), tree(theirs, name="theirs")), ours, theirs)
    joined = ours.join(found, ["file", "seq"], "full_outer")
    return joined.withColumn("status", F.coalesce("status", F.lit("intact")))


def _aligned(differing: DataFrame, ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(file, seq, status) of places that differ, once records are found again that only moved.

    Equal digests of a file meet in order, then equal ids (or places) of what is left. Extra records have a negative ``seq``: theirs, less one, negated.
    """
    name = ["id_"] if "id_" in ours.columns and "id_" in theirs.columns else ["seq"]

    def side(rows: DataFrame) -> DataFrame:
        kept = rows.select("file", "seq", "sha256", *[c for c in name if c != "seq"]).join(differing.select("file", "seq"), ["file", "seq"], "left_semi")
        return materialise(kept, "differing")

    def counted(rows: DataFrame, keys: list[str]) -> DataFrame:
        """With the number of a row among those of equal keys, which few share."""
        return rows.withColumn("nth", F.row_number().over(Window.partitionBy("file", *keys).orderBy("seq")))

    def left(rows: DataFrame, met: DataFrame, place: str) -> DataFrame:
        return rows.join(met.select("file", F.col(place).alias("seq")), ["file", "seq"], "left_anti")

    def meet(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
        """(file, seq, other, lost) of rows of equal keys, nulls being equal, in order."""
        b = counted(b, keys).select(F.col("file").alias("f"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col("nth").alias("m"), F.col("seq").alias("other"), F.col("sha256").isNull().alias("lost"))
        same = (F.col("file") == F.col("f")) & (F.col("nth") == F.col("m"))
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"k{i}"))
        return materialise(counted(a, keys).join(b, same).select("file", "seq", "other", "lost"), "aligned")

    mine, other = side(ours), side(theirs)
    moved = meet(mine.filter("sha256 is not null"), other.filter("sha256 is not null"), ["sha256"])
    mine, other = left(mine, moved, "seq"), left(other, moved, "other")
    changed = meet(mine, other, name)
    gone, extra = left(mine, changed, "seq"), left(other, changed, "other")
    status = F.when(F.col("lost"), "missing").otherwise("corrupt")
    return changed.select("file", "seq", status.alias("status")).unionByName(gone.select("file", "seq", F.lit("missing").alias("status"))).unionByName(
        extra.select("file", (-F.col("seq") - 1).alias("seq"), F.lit("extra").alias("status"))
    )
