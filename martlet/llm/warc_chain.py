"""WARC archives: written as text by Spark, read back by boundary chains.

Writing: one record a page, a ``revisit`` of the page that holds the same payload
under the largest id, else a ``response``. Records are lines of a text file whose
line separator is the end of a WARC record.

Reading: a record's magic may stand inside a payload, and a task that reads a part
of a file cannot tell. So archives are read as lines that end at a line break with
the magic behind it (a separator that cannot overlap with itself: every split of a
file cuts the same lines), and every task emits, for each line that begins like a
record, the offset where it starts and the offset where its successor must start.
Offsets are counted from the first line of the task's block of the file; a running
sum over the blocks, one row each, places them in the file.

A record is real where the chain from the file's start reaches it. Inside a block
the task itself follows every candidate to the offset where its chain leaves the
block; among blocks, pointers jump (each round doubles their reach) from the file's
start to the one candidate by which the chain enters each block. Only the real
records are kept. Lines in between belong to the payload of the record before them:
such a record's lines are read once more and joined, all others were read whole in
the first pass. No group is larger than a block's lines or one record.

Defined results: a null payload is empty, a null URL is left out; line breaks in a
URL are escaped; a null page id is written as such and read as null; of equal
payloads under one largest id (repeated rows) one is the response; an archive whose
chain breaks gives its records up to the break, a record that ends behind its file
is not ``complete``; an archive that does not begin with a record, an empty one and
an empty table give no rows; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martlet.llm.registry import read_table, register
from martlet.session import cut_lineage, ensure_checkpoint_dir

# The format's magic, line break, end of a header and end of a record.
MAGIC, BREAK, RECORD_END = "WARC/1.", "\r\n", "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: What ends a line of the reader: the magic behind a line break.
MARK = "\n" + MAGIC
#: Bytes of lines that the second pass hands on at a time.
PIECE = 1 << 20
DATE = "2000-01-07T09:00:00Z"


# ---------------------------------------------------------------- writing


def base32_of_hex(digits: Column) -> Column:
    """Upper-case base 32 of 40 hex digits: five digits are four letters."""
    letters = []
    for i in range(0, 40, 5):
        number = F.conv(F.substring(digits, i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def with_roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages`` (page_id, url, body) with the payload's size, its SHA-1 as hex,
    ``revisits`` and ``refers_to``, the largest id among equal payloads of
    ``least`` bytes or more."""
    repeated = pages.groupBy("page_id").count().filter("count > 1").limit(1).count()
    if repeated:  # rows that share an id are told apart by a number
        pages = cut_lineage(pages.withColumn("row", F.monotonically_increasing_id()), "pages")
    else:
        pages = pages.withColumn("row", F.lit(0).cast("long"))
    raw = F.col("body").cast("binary")
    pages = pages.withColumns({"size": F.octet_length("body").cast("long"), "sha": F.sha1(raw), "other": F.xxhash64("body")})
    same = ["sha", "other", "size"]
    groups = (pages.filter(F.col("size") >= least).groupBy(*same)
              .agg(F.max(F.struct("page_id", "row")).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    # A table of known size: Spark broadcasts it only where it is small.
    groups = cut_lineage(groups, "payloads")
    met = pages.join(groups, same, "left")
    own = F.col("first.page_id").eqNullSafe(F.col("page_id")) & (F.col("first.row") == F.col("row"))
    return met.withColumn("revisits", F.col("first").isNotNull() & ~F.coalesce(own, F.lit(False))).withColumn(
        "refers_to", F.when(F.col("revisits"), F.col("first.page_id"))).drop("first", "other", "row")


def record_text(date: str = DATE) -> Column:
    """A page with its role as WARC record, but for the record's end."""
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(RECORD_END))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    length = F.octet_length(head) + F.when(F.col("revisits"), F.lit(0)).otherwise(F.col("size"))
    field = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(BREAK))
    return F.concat(
        F.lit(MAGIC + "1" + BREAK), field("WARC-Type", F.when(F.col("revisits"), F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", name("page_id")), field("WARC-Date", F.lit(date)),
        F.coalesce(field("WARC-Target-URI", uri), F.lit("")), field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha")))),
        F.when(F.col("revisits"), F.concat(field("WARC-Refers-To", name("refers_to")), field("WARC-Profile", F.lit(REVISIT)))).otherwise(F.lit("")),
        field("Content-Type", F.lit("application/http; msgtype=response")), field("Content-Length", length.cast("string")),
        F.lit(BREAK), head, F.when(F.col("revisits"), F.lit("")).otherwise(F.col("body")))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html",
                   least: int = 0, date: str = DATE) -> None:
    """Write a record for every row of ``pages`` into archives under ``path``."""
    told = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("body"))
    with_roles(told, least).select(record_text(date).alias("value")).write.option("lineSep", RECORD_END).text(path)


# ---------------------------------------------------------------- reading


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the archives' lines as ``MARK`` parts them, in the
    order of each block (the part of a file that one split reads)."""
    return spark.read.option("lineSep", MARK).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bytes]]:
    """(file, block, offset from the block's first magic, bytes up to the next
    magic, bytes behind the own magic) of every line. A file's first line carries
    its magic itself."""
    at, here = 0, None
    for batch in batches:
        files, blocks, values = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
        for file, block, value in zip(files, blocks, values):
            data = value.as_buffer().to_pybytes()
            if (file, block) != here:
                here, at = (file, block), 0
                if block == 0:
                    if not data.startswith(MAGIC.encode()):
                        at = len(data) + 1
                        yield file, block, 0, at, b""  # no record: what follows keeps its place
                        continue
                    data = data[len(MAGIC):]
            yield file, block, at, len(data) + len(MARK), data
            at += len(data) + len(MARK)


def header(data: bytes) -> tuple[int, dict[str, str]] | None:
    """(length of the header behind the magic, its fields) of a line that begins
    like a record; None for others."""
    end = data.find(b"\r\n\r\n")
    if end < 0 or data[:3] not in (b"0\r\n", b"1\r\n"):
        return None
    fields = {}
    for line in data[3:end].split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[key.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isascii() or not fields.get("content-length", "").isdigit() or not fields.get("warc-type"):
        return None
    return end + 4, fields


def payload_of(content: bytes, http: bool, kind: str, stated: str | None) -> tuple[int, str | None, bytes | None]:
    """(size, digest, bytes) of a record's payload. A revisit holds none: its
    size stands in the HTTP header and its digest in the record's."""
    end = content.find(b"\r\n\r\n") if http else -4
    if kind == "revisit":
        sizes = [x.partition(b":")[2].strip() for x in content[:max(end, 0)].split(b"\r\n") if x.lower().startswith(b"content-length:")]
        size = int(sizes[0]) if sizes and sizes[0].isdigit() else None
        return size, stated, None
    payload = content[end + 4:] if end >= 0 or not http else b""
    return len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), payload


_FIELDS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("start", pa.int64()), ("size", pa.int64()), ("next", pa.int64()),
                     ("exit", pa.int64()), ("last", pa.int64()), ("head", pa.int64()), ("content", pa.int64()), ("http", pa.bool_()),
                     ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()),
                     ("stated_digest", pa.string()), ("whole", pa.bool_()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("payload", pa.binary())])
_SCHEMA = ("file string, block long, start long, size long, next long, exit long, last long, head long, content long, http boolean, "
           "record_type string, record_id string, refers_to string, target_uri string, stated_digest string, whole boolean, "
           "payload_bytes long, payload_digest string, payload binary")


def _bare(digest: str | None) -> str | None:
    return digest.partition(":")[2] or digest if digest else None


def _candidate(file: str, block: int, start: int, size: int, data: bytes, payloads: bool) -> dict:
    """A line as row: offsets, and what a record that begins here would be."""
    row = {"file": file, "block": block, "start": start, "size": size, "whole": False}
    found = header(data)
    if found is None:
        return row
    head, fields = found
    content = int(fields["content-length"])
    if content > 1 << 60:  # no file is that long
        return row
    kind, stated = fields["warc-type"], _bare(fields.get("warc-payload-digest"))
    http = fields.get("content-type", "").startswith("application/http")
    row |= {"next": start + len(MAGIC) + head + content + len(RECORD_END), "head": head, "content": content, "http": http, "record_type": kind,
            "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to"), "target_uri": fields.get("warc-target-uri"),
            "stated_digest": stated}
    # All of the record stands in this line: the end's last byte is the mark's first, but at the file's end.
    if data[head + content:] in (b"\r\n\r", b"\r\n\r\n"):
        length, digest, payload = payload_of(data[head:head + content], http, kind, stated)
        row |= {"whole": True, "payload_bytes": length, "payload_digest": digest, "payload": payload if payloads else None}
    return row


def follow(rows: list[dict]) -> None:
    """Set where each candidate's chain leaves the block (``exit``), and its
    ``last`` record in it: successors come behind, so from the back."""
    at: dict[int, dict] = {}
    for row in reversed(rows):
        if row.get("next") is not None:
            there = at.get(row["next"])
            row["exit"], row["last"] = (there["exit"], there["last"]) if there else (row["next"], row["start"])
            at[row["start"]] = row


def candidates(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every line of the archives under ``path``; ``next`` is set for those that
    begin like a record. All offsets count from the block's first magic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for file, block, start, size, data in _blocks(batches):
            if rows and (rows[-1]["file"], rows[-1]["block"]) != (file, block):
                follow(rows)
                yield pa.RecordBatch.from_pylist(rows, _FIELDS)
                rows = []
            rows.append(_candidate(file, block, start, size, data, payloads))
        if rows:
            follow(rows)
            yield pa.RecordBatch.from_pylist(rows, _FIELDS)

    return _lines(spark, path).mapInArrow(run, _SCHEMA)


def reached(entries: DataFrame) -> DataFrame:
    """Those of ``entries`` (file, start, exit) that a file's start reaches, by
    pointer jumping: each round doubles the jumps."""
    starts = entries.select("file", F.col("start").alias("to"))
    jumps = cut_lineage(entries.select("file", "start", F.col("exit").alias("to")).join(starts, ["file", "to"], "left_semi").select("file", "start", "to"), "jumps")
    found = cut_lineage(entries.filter("start = 0").select("file", "start"), "found")
    n = found.count()
    while n:
        step = found.join(jumps, ["file", "start"]).select("file", F.col("to").alias("start"))
        more = cut_lineage(found.unionByName(step).distinct(), "found")
        if (m := more.count()) == n:
            break
        found, n = more, m
        onward = jumps.select("file", F.col("start").alias("to"), F.col("to").alias("far"))
        jumps = cut_lineage(jumps.join(onward, ["file", "to"]).select("file", "start", F.col("far").alias("to")), "jumps")
    return entries.join(found, ["file", "start"], "left_semi")


def with_owners(lines: DataFrame) -> DataFrame:
    """``lines`` with ``at``, their offset in the file, and ``owner``, the offset
    of the real record that they begin or belong to; null where no record does."""
    by_file = Window.partitionBy("file").orderBy("block")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut_lineage(lines.groupBy("file", "block").agg(F.sum("size").alias("advance"))
                         .withColumn("base", F.coalesce(F.sum("advance").over(before), F.lit(0))), "blocks")
    placed = (lines.filter("next IS NOT NULL").select("file", "block", "start", "exit", "last").join(blocks, ["file", "block"])
              .select("file", "block", *[(F.col(c) + F.col("base")).alias(c) for c in ("start", "exit", "last")]))
    # A chain enters a block at the file's start or where some chain left another block.
    targets = placed.select("file", F.col("exit").alias("start")).unionByName(
        blocks.select("file", F.lit(0).cast("long").alias("start"))).distinct()
    entries = cut_lineage(placed.join(targets, ["file", "start"], "left_semi"), "entries")
    real = reached(entries).select("file", "block", F.col("start").alias("entry"), "last", "exit")
    spans = blocks.join(real, ["file", "block"], "left").withColumn(
        "carried", F.last(F.when(F.col("entry").isNotNull(), F.struct("last", "exit")), ignorenulls=True).over(before))
    spans = cut_lineage(spans.select("file", "block", "base", "entry", F.col("carried.last").alias("carried"), F.col("carried.exit").alias("until")), "spans")
    names = lines.columns
    schema = lines.select("*").schema.add("at", "long").add("owner", "long")

    def mark(table: pa.Table) -> pa.Table:
        base, entry, carried, until = (table.column(c)[0].as_py() for c in ("base", "entry", "carried", "until"))
        start = table.column("start").to_numpy() + base
        following = {int(s): int(n) + base for s, n in zip(start, table.column("next").fill_null(-1).to_numpy()) if n >= 0}
        real, end = [], []
        while entry in following:
            real.append(entry)
            entry = following[entry]
            end.append(entry)
        real, end = np.array(real, np.int64), np.array(end, np.int64)
        k = np.searchsorted(real, start, "right") - 1
        owner = np.full(len(start), -1 if carried is None else carried, np.int64)
        reach = np.full(len(start), -1 if until is None else until, np.int64)
        owner[k >= 0], reach[k >= 0] = real[k[k >= 0]], end[k[k >= 0]]
        outside = start >= reach
        return table.select(names).append_column("at", pa.array(start)).append_column("owner", pa.array(owner, mask=outside))

    return lines.join(spans, ["file", "block"]).groupBy("file", "block").applyInArrow(mark, schema)


def _joined(spark: SparkSession, path: str, marked: DataFrame, open_: DataFrame, payloads: bool) -> DataFrame:
    """(file, owner, payload columns) of real records that several lines hold."""
    pieces = (marked.select("file", "block", "start", "at", "owner")
              .join(open_.select("file", "owner", "head", "content", "http", "record_type", "stated_digest"), ["file", "owner"]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for file, block, start, _, data in _blocks(batches):
            if held and n + len(data) > PIECE:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held)], names=["file", "block", "start", "data"])
                held, n = [], 0
            held.append((file, block, start, data))
            n += len(data)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held)], names=["file", "block", "start", "data"])

    texts = _lines(spark, path).mapInArrow(place, "file string, block long, start long, data binary")

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        first = {c: table.column(c)[0].as_py() for c in ("file", "owner", "head", "content", "http", "record_type", "stated_digest")}
        data = [x.as_buffer().to_pybytes() for x in table.column("data")]
        content = MARK.encode().join([data[0][first["head"]:], *data[1:]])[:first["content"]]
        size, digest, payload = payload_of(content, first["http"], first["record_type"], first["stated_digest"])
        return pa.table({"file": [first["file"]], "owner": [first["owner"]], "payload_bytes": pa.array([size], pa.int64()),
                         "payload_digest": pa.array([digest], pa.string()), "payload": pa.array([payload if payloads else None], pa.binary())})

    return (texts.join(pieces, ["file", "block", "start"]).groupBy("file", "owner")
            .applyInArrow(join, "file string, owner long, payload_bytes long, payload_digest string, payload binary"))


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(file, offset, record_type, record_id, refers_to, target_uri,
    stated_digest, payload_bytes, payload_digest, complete[, payload]) of every
    real record of the archives under ``path``."""
    lines = cut_lineage(candidates(spark, path, payloads), "lines")
    marked = cut_lineage(with_owners(lines), "marked")
    ends = lines.groupBy("file").agg((F.sum("size") - 1).alias("file_end"))
    real = marked.filter("owner = at")
    whole, open_ = real.filter("whole"), real.filter("NOT whole")
    if open_.limit(1).count():
        found = _joined(spark, path, marked, open_, payloads)
        open_ = open_.drop("payload_bytes", "payload_digest", "payload").join(found, ["file", "owner"])
        whole = whole.unionByName(open_.select(*whole.columns))
    reach = F.col("at") + F.col("next") - F.col("start")
    out = whole.join(ends, "file").select(
        "file", F.col("at").alias("offset"), "record_type", "record_id", "refers_to", "target_uri", "stated_digest", "payload_bytes",
        "payload_digest", (reach <= F.col("file_end")).alias("complete"), "payload")
    return out if payloads else out.drop("payload")


def page_of(record: Column) -> Column:
    """Page id of a record id that ``write_archives`` made."""
    return F.regexp_extract(record, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, b, octet_length(b) AS n, sha1(b) AS x,
             max(page_id) OVER (PARTITION BY b) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{BASE32}',
         CAST((CAST('0x' || substr(x, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM d"""


@register("op11_warc", _SQL)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as archives, and what is read back of them."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex[:12]}"
    write_archives(read_table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to")).alias("refers_to"))
