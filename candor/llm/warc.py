"""WARC archives: writing pages as records, and reading archives back by verified record chains.

Writing is Spark's text writer: a record's header and block are the line and two line ends the
separator, one archive a task. Of records with equal payloads of at least ``REVISIT_BYTES`` the one
with the largest page_id is a response and the others are revisits that name it and hold no payload.

Reading does not trust the magic at a record's start, which a payload may hold too. Tasks look at chunks
of an archive; for every magic they find they emit where the chain of records from there leaves the
chunk, if the lengths lead from magic to magic. Pointer jumping from offset 0 over those links (the
links are doubled every round, so rounds grow with the logarithm of an archive's chunks) finds each
chunk's true first record; what is not reached lies inside payloads. Then each chunk is read from
there. Payloads are never shuffled; a task holds a chunk or a record.

Defined results: null html is an empty payload; a null page_id or url gives no such header and is read
back as null; rows that repeat are records of their own, exactly one of equal ones with a long
payload is the response; an empty table writes no record and reads no row; an archive whose chain does
not end at its last byte raises ValueError. page_id, url and html are read by name, so further columns
can have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, require, scratch, table, with_row_id

MAGIC = b"WARC/1.0\r\n"
END = b"\r\n\r\n"
REVISIT_BYTES = 1000
STEP = 1 << 16  # bytes that are read on at a time for the end of a header
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _record_id(page_id: Column, rid: Column) -> Column:
    h = F.md5(F.concat_ws("/", page_id.cast("string"), rid.cast("string")).cast("binary"))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_pages(pages: DataFrame, path: str, records_per_file: int = 100_000, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) to archives under ``path``."""
    rows = with_row_id(require(pages, ["page_id", "url", "html"]))
    payload = F.coalesce(F.col("row.html"), F.lit("")).cast("binary")
    slim = rows.select(F.col("row.page_id").alias("page_id"), "rid", F.octet_length(payload).alias("n"),
                       F.sha1(payload).alias("digest"))
    slim = materialise(slim.where(F.col("n") >= REVISIT_BYTES), "warc-digests")
    groups = slim.groupBy("digest", "n").agg(F.max(F.struct("page_id", "rid")).alias("response"), F.count(F.lit(1)).alias("copies"))
    groups = materialise(groups.where("copies > 1").drop("copies"), "warc-groups")
    # One row per revisit, set down first: Spark then knows its size, and sends it to all tasks only if
    # that is below the session's limit. Otherwise pages are joined by their row ids, which are all different.
    revisits = slim.join(groups, ["digest", "n"]).where("rid != response.rid").select(
        F.col("rid").alias("of"), _record_id(F.col("response.page_id"), F.col("response.rid")).alias("refers_to"))
    rows = rows.join(materialise(revisits, "warc-revisits"), F.col("rid") == F.col("of"), "left")
    html = F.coalesce(F.col("row.html"), F.lit(""))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(html))
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))
    header = F.concat(
        F.lit(MAGIC.decode()), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("row.page_id"), F.col("rid"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("row.url", r"[\x00-\x20\x7F]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(html.cast("binary")))),
        line("WARC-Refers-To", F.col("refers_to")), line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("X-Page-ID", F.col("row.page_id").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    (rows.select(F.concat(header, block).alias("record")).write.option("lineSep", END.decode())
         .option("maxRecordsPerFile", records_per_file).text(path))


def _open(path: str):
    """A file of any store that Arrow knows, for reading at offsets."""
    from pyarrow import fs

    if re.match("file:|/", path):
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/*", "/", path))
    store, at = fs.FileSystem.from_uri(path)
    return store.open_input_file(at)


def _header(data: bytes, at: int = 0, until: int | None = None) -> tuple[dict[str, str], int] | None:
    """Header fields (lower-case names) of the record at ``at`` and the header's length, or None if it doesn't end
    before ``until``."""
    stop = data.find(END, at, until)
    if stop < 0 or not data.startswith(MAGIC, at):
        return None
    lines = data[at + len(MAGIC):stop].decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    return fields, stop + len(END) - at


def _read_on(f, begin: int, stop: int, size: int) -> bytes:
    """The bytes from ``begin`` to ``stop`` and on to the first end of a header that is not before ``stop``: whatever
    the length of headers, those of all records that begin before ``stop`` are whole. A record ends with the same
    bytes, so this is never further than the end of the record that holds ``stop``."""
    f.seek(begin)
    data = bytearray(f.read(stop - begin))
    seen = max(0, stop - begin - len(END) + 1)
    while data.find(END, seen) < 0 and begin + len(data) < size:
        seen = max(seen, len(data) - len(END) + 1)
        data += f.read(STEP)
    return bytes(data)


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For every magic in a chunk: its offset and where the chain of records from it leaves the chunk."""
    for batch in batches:
        for path, size, begin, stop in batch.itertuples(index=False):
            with _open(path) as f:
                data = _read_on(f, begin, stop, size)
            found, at = [], data.find(MAGIC)
            while 0 <= at < stop - begin:
                found.append(at)
                at = data.find(MAGIC, at + 1)
            leaves: dict[int, int] = {}
            for at, until in zip(reversed(found), [None, *reversed(found)], strict=False):  # no header holds another magic
                if head := _header(data, at, until):
                    after = at + head[1] + int(head[0]["content-length"]) + len(END)
                    after = after if after >= stop - begin else leaves.get(after, -1)
                    if 0 <= after <= size - begin:
                        leaves[at] = after
            yield pd.DataFrame({"path": path, "at": [begin + k for k in leaves], "to": [begin + v for v in leaves.values()]},
                               columns=["path", "at", "to"]).astype({"at": "int64", "to": "int64"})


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The records that begin in a chunk, from its first true one on."""
    names = ["path", "offset", "record_id", "record_type", "page_id", "url", "refers_to", "declared", "payload"]
    for batch in batches:
        for path, begin, stop in batch.itertuples(index=False):
            rows, held = [], 0
            with _open(path) as f:
                at = begin
                while at < stop:
                    fields, n = _header(_read_on(f, at, at + len(MAGIC), f.size()))
                    f.seek(at + n)
                    block = f.read(int(fields["content-length"]))
                    payload = block.partition(END)[2] if "application/http" in fields.get("content-type", "") else block
                    rows.append((path, at, fields.get("warc-record-id"), fields["warc-type"], fields.get("x-page-id"),
                                 fields.get("warc-target-uri"), fields.get("warc-refers-to"),
                                 fields.get("warc-payload-digest"), payload))
                    at += n + len(block) + len(END)
                    held += len(block)
                    if held > 8 << 20:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names)


def read_records(spark: SparkSession, path: str, chunk: int = 1 << 20) -> DataFrame:
    """Every record of the archives under ``path``: path, offset, record_id, record_type, page_id (string),
    url, refers_to (a record id), declared (its payload digest by the header), payload."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", F.col("length").alias("size"))
    files = materialise(files, "warc-files")
    archives, n_chunks = files.agg(F.count(F.lit(1)), F.sum(F.ceil(F.col("size") / chunk))).first()
    # rows here are places in files, too small for Spark to see the work in them: tasks are given in number
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (n_chunks or 0) // 32)
    chunks = files.withColumn("begin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(chunk).cast("long"))))
    chunks = chunks.withColumn("stop", F.least("size", F.col("begin") + chunk))
    links = chunks.repartition(tasks, "path", "begin").mapInPandas(_links, "path string, at bigint, to bigint")
    links = materialise(links, "warc-links")
    ends = files.withColumnRenamed("path", "of")
    inner = links.join(ends, F.col("path") == F.col("of")).where("to < size").select("path", "at", "to")
    reached = materialise(files.select("path", F.lit(0).cast("long").alias("at")), "warc-reached")
    jump, n = materialise(inner, "warc-jump"), archives
    while True:
        further = reached.join(jump, ["path", "at"]).select("path", F.col("to").alias("at"))
        reached = materialise(reached.unionByName(further).distinct(), "warc-reached")
        before, n = n, reached.count()
        if n == before:
            break
        second = jump.select("path", F.col("at").alias("to"), F.col("to").alias("then"))
        jump = materialise(jump.join(second, ["path", "to"]).select("path", "at", F.col("then").alias("to")), "warc-jump")
    whole = links.join(reached, ["path", "at"]).join(ends, F.col("path") == F.col("of")).where("to = size")
    if (ended := whole.select("path").distinct().count()) != archives:
        raise ValueError(f"{archives - ended} of {archives} archives are cut or damaged")
    starts = reached.withColumn("begin", F.col("at") - F.col("at") % chunk).join(chunks, ["path", "begin"])
    return starts.select("path", "at", "stop").repartition(tasks, "path", "at").mapInPandas(
        _records, "path string, offset bigint, record_id string, record_type string, page_id string, url string, "
                  "refers_to string, declared string, payload binary")


def described(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Each record's page_id, record_type, refers_to (page_id of the response), and size and SHA-1 of its
    full payload; a revisit has them from the response that it names."""
    slim = records.select(
        F.col("page_id").cast(id_type).alias("page_id"), "record_type", "record_id", "refers_to",
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    slim = materialise(slim, "warc-described")
    named = slim.where("record_type = 'revisit'").select(F.col("refers_to").alias("named")).distinct()
    named = slim.where("record_type = 'response'").join(named, F.col("record_id") == F.col("named"), "left_semi")
    named = materialise(named.select(
        F.col("record_id").alias("of"), F.col("page_id").alias("response_id"), F.col("payload_bytes").alias("response_bytes"),
        F.col("payload_digest").alias("response_digest")), "warc-named")
    out = slim.join(named, F.col("refers_to") == F.col("of"), "left")
    return out.select(
        "page_id", F.coalesce("response_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("response_digest", "payload_digest").alias("payload_digest"), "record_type",
        F.col("response_id").alias("refers_to"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written and read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    pages = table(spark, sf_dir, "pages")
    path = scratch(spark, "warc")
    write_pages(pages, path)
    return described(read_records(spark, path), pages.schema["page_id"].dataType.simpleString())


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM g
"""
