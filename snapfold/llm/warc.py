"""WARC archives, written as text files and read back by boundary-chain verification.

A WARC file has no index, and its magic may occur inside a payload.  Files are read in blocks, split at
the magic.  Each task emits, for every place of the magic in its block, a candidate: its offset, that of
the record that would follow it, and the offset at which the chain from there leaves the block.  Only a
chain that starts at the beginning of the file is true; pointer jumping over the blocks' exits (the step
doubles every round) finds where it enters each block, and the block's records on it are kept.  What is
not on it lies inside a payload and is put back there.

Payloads of at least ``LEAST`` bytes are stored once: the row with the largest page_id is the response,
the others are revisit records that refer to it.

Defined results: a null html is an empty payload; payloads are written and read whole; rows without a page_id
are written under an empty one, and are revisits of equal payloads that have one; rows that share the largest
page_id are all responses; a null url is empty; line ends in a url are percent-encoded; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from ..session import saved, scratch_folder
from . import common

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
LEAST = 1000
DATE = "1970-01-01T00:00:00Z"

CANDIDATES = (
    "file string, block long, place long, at long, size long, next long, leaves long, record_type string, "
    "page_id long, refers_to long, payload_bytes long, payload_digest string, head long, read_digest string"
)


def _copies(pages: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, html, bytes, digest, response): the page that a payload is stored with, if it has copies."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html")).withColumn("bytes", F.octet_length("html").cast("long"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("hash", F.xxhash64("digest"))
    stored = rows.where(F.col("bytes") >= LEAST).groupBy("digest", "hash").agg(
        F.max("page_id").alias("response"), F.count("*").alias("times")).where("times > 1")
    stored = saved(stored.select("digest", "hash", "response"), f"{folder}/stored")
    flagged = common.flag(rows, stored, "hash", "copied")
    alone = flagged.where("not copied").withColumn("response", F.lit(None).cast("long"))
    joined = flagged.where("copied").join(stored.drop("hash"), "digest", "left")
    return alone.unionByName(joined).drop("hash", "copied")


def record(date: str = DATE) -> Column:
    """One record's text, without the end that closes it, of the columns that ``_copies`` gives."""
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    size = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    refers = F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("response").cast("string"),
                                      F.lit(f">\r\nWARC-Profile: {PROFILE}\r\n"))).otherwise(F.lit(""))
    return F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), number, F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\nWARC-Payload-Length: "),
        F.col("bytes").cast("string"), F.lit("\r\n"), refers,
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), size.cast("string"), F.lit(END), block)


def write(pages: DataFrame, folder: str, date: str = DATE) -> None:
    """Write (page_id, url, html) as WARC files into a new folder, one file for each task."""
    rows = _copies(pages, scratch_folder(pages.sparkSession, "warc-stored"))
    rows.select(record(date).alias("value")).write.option("lineSep", END).text(folder)


def _number(value: bytes | None) -> int | None:
    text = (value or b"").strip().removeprefix(b"<urn:page:").removesuffix(b">")
    return int(text) if text.lstrip(b"-").isdigit() else None


def parse(body: bytes) -> tuple | None:
    """What follows a magic, if it is a header: (length with header and end, the last CANDIDATES)."""
    top, mark, _ = body.partition(END.encode())
    if not mark:
        return None
    fields = dict(line.partition(b":")[::2] for line in top.split(b"\r\n"))
    size = fields.get(b"Content-Length", b"").strip()
    if not size.isdigit() or b"WARC-Type" not in fields:
        return None
    begin = len(top) + len(mark)
    end = begin + int(size)
    kind = fields[b"WARC-Type"].strip().decode("ascii", "replace")
    length = _number(fields.get(b"WARC-Payload-Length"))
    told = fields.get(b"WARC-Payload-Digest", b"").strip().removeprefix(b"sha1:").decode("ascii", "replace")
    head = body.find(END.encode(), begin) + len(END)  # the payload follows the HTTP header
    whole = kind == "response" and end <= len(body) and begin < head <= end
    read = hashlib.sha1(body[head:end]).hexdigest() if whole else None
    return end + len(END), kind, _number(fields.get(b"WARC-Record-ID")), _number(fields.get(b"WARC-Refers-To")), \
        length, told, head, read


def _split(spark: SparkSession, folder: str) -> DataFrame:
    """(file, block, value): what stands between magics, in the order of each block."""
    rows = spark.read.option("lineSep", MAGIC).text(folder)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.col("value").cast("binary").alias("value"))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``CANDIDATES`` for each block; ``at`` counts from the block's first row."""
    names = [part.split()[0] for part in CANDIDATES.split(", ")]
    kinds = [pa.string() if part.endswith("string") else pa.int64() for part in CANDIDATES.split(", ")]

    def out(rows: list[list]) -> pa.RecordBatch:
        leaves: dict[int, int] = {}
        for row in reversed(rows):  # a successor in the block hands its exit on
            if row[5] is not None:
                row[6] = leaves[row[3]] = leaves.get(row[5], row[5])
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    held, now, at = [], None, 0
    for batch in batches:
        for file, block, value in zip(*(batch.column(i) for i in range(3)), strict=True):
            value, where = value.as_py(), (file.as_py(), block.as_py())
            if where != now:
                if held:
                    yield out(held)
                held, now, at = [], where, 0
            found = parse(value)
            following = at + found[0] if found else None
            held.append([*where, len(held), at - len(MAGIC), len(value), following, None, *(found[1:] if found else [None] * 7)])
            at += len(value) + len(MAGIC)
    if held:
        yield out(held)


def _entries(rows: DataFrame, folder: str) -> DataFrame:
    """(file, at): where the chain from the start of each file enters a block, by pointer jumping."""
    ends = rows.select("file", F.col("leaves").alias("at")).where("at is not null").distinct()
    starts = rows.select("file").distinct().withColumn("at", F.lit(0).cast("long"))
    nodes = ends.unionByName(starts).distinct()
    jumps = saved(rows.where("leaves is not null").select("file", "at", F.col("leaves").alias("to")).join(
        nodes, ["file", "at"]), f"{folder}/jumps-0")
    reached, count, turn = saved(starts.join(jumps.select("file", "at"), ["file", "at"]), f"{folder}/reached-0"), -1, 0
    while (size := reached.count()) != count:
        count, turn = size, turn + 1
        on = reached.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = saved(reached.unionByName(on).distinct(), f"{folder}/reached-{turn}")
        next_ = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("then"))
        jumps = saved(jumps.join(next_, ["file", "to"]).select("file", "at", F.col("then").alias("to")), f"{folder}/jumps-{turn}")
    return reached


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``real``: whether a candidate is on its block's chain; rows come in the order of each block."""
    now, due = None, None
    for batch in batches:
        real = []
        for file, block, at, following, entry in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "at", "next", "entry")), strict=True):
            if (file, block) != now:
                now, due = (file, block), None
            if entry:
                due = at
            real.append(at == due)
            if at == due:
                due = following
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(real, pa.bool_())], [*batch.schema.names, "real"])


def candidates(spark: SparkSession, folder: str, work: str) -> DataFrame:
    """All candidates of the archives in a folder, with offsets in their file, and ``real`` on those on the chain."""
    rows = saved(_split(spark, folder).mapInArrow(_candidates, CANDIDATES), f"{work}/candidates")
    # a block's rows begin where those of the blocks before it end; a file has few blocks
    sizes = rows.groupBy("file", "block").agg(F.max(F.col("at") + F.col("size")).alias("size")).withColumn(
        "size", F.col("size") + 2 * len(MAGIC))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = saved(sizes.select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), f"{work}/bases")
    rows = rows.join(bases, ["file", "block"])
    for name in ("at", "next", "leaves"):
        rows = rows.withColumn(name, F.col(name) + F.col("base"))
    rows = saved(rows.where("at >= 0").drop("base"), f"{work}/placed")
    entries = _entries(rows, work).withColumn("entry", F.lit(True))
    marked = rows.join(entries, ["file", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    marked = marked.repartition("file", "block").sortWithinPartitions("file", "block", "at")
    schema = T.StructType([*marked.schema.fields, T.StructField("real", T.BooleanType())])
    return saved(marked.mapInArrow(_chain, schema).drop("entry"), f"{work}/marked")


def _mended(spark: SparkSession, folder: str, marked: DataFrame, work: str) -> DataFrame:
    """(file, at, mended): digests of the payloads that have a magic inside, put together again."""
    cut = marked.where("not real or (record_type = 'response' and read_digest is null)")
    owner = F.max(F.when(F.col("real"), F.col("at"))).over(
        Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    cut = saved(cut.select("file", "block", "place", "at", owner.alias("owner"), F.when(F.col("real"), F.col("head")).alias("head"),
                           F.when(F.col("real"), F.col("payload_bytes")).alias("payload_bytes")), f"{work}/cut")
    if cut.isEmpty():
        return cut.select("file", "at", F.lit("").alias("mended"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place = None, 0
        for batch in batches:
            places = []
            for where in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                now, place = where, place + 1 if where == now else 0
                places.append(place)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "place"])

    values = _split(spark, folder).mapInArrow(number, "file string, block long, value binary, place long")
    parts = values.join(cut, ["file", "block", "place"]).groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"),  # of one payload
        F.max("head").alias("head"), F.max("payload_bytes").alias("payload_bytes"))
    body = F.aggregate("parts", F.lit(b""), lambda got, part: F.concat(got, part["value"], F.lit(MAGIC.encode())))
    payload = F.substring(body, (F.col("head") + 1).cast("int"), F.col("payload_bytes").cast("int"))
    return parts.where("owner is not null").select("file", F.col("owner").alias("at"), F.sha1(payload).alias("mended"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: what it says, and whether the payload read agrees with it (null for revisits)."""
    work = scratch_folder(spark, "warc-read")
    marked = candidates(spark, folder, work)
    mended = saved(_mended(spark, folder, marked, work), f"{work}/mended")
    rows = marked.where("real").join(mended, ["file", "at"], "left")
    digest = F.coalesce("read_digest", "mended")
    return rows.select("page_id", "payload_bytes", F.coalesce(digest, "payload_digest").alias("payload_digest"), "record_type",
                       "refers_to", (digest == F.col("payload_digest")).alias("verified"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "warc")
    write(common.table(spark, sf_dir, "pages"), folder)
    return read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


OP7_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
q as (select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as payload_digest, html from p),
r as (select *, max(page_id) over (partition by html) as response from q)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> response then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> response then response end as refers_to,
  case when payload_bytes >= 1000 and page_id <> response then null else true end as verified
from r
"""
