"""WARC archives: an index of byte ranges first, then the records, then coalesced reads by the index.

Each record is a gzip member of its own, so archives are small and any record can be read alone; unpacked as a whole, a
file is a plain WARC archive. Members are lines of Spark's text writer whose line separator is an empty gzip member, so the
writer's commit protocol guards them. One folder per archive holds one file; its records are sorted, and the index repeats
that order to give each record's offset before any archive exists. Workers must pack alike, that is, share one zlib.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fitmesh.llm.storage import stored
from fitmesh.sources.records import scratch_path

END = "\r\n\r\n"  # fixed value: ends a record
_SEPARATOR = gzip.compress(b"", mtime=0)  # follows each record's member
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: RFC 4648
_TASK_BYTES = 16 << 20  # bytes of archives that one task reads
_ORDER = ["page_id", "url", "digest", "record_type"]


def base32_sha1(text: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text's UTF-8 bytes: 40 bits at a time."""
    digest = F.sha1(text.cast("binary"))
    out = []
    for k in range(4):
        number = F.conv(F.substring(digest, 10 * k + 1, 10), 16, 10).cast("long")
        out += [F.substring(F.lit(_BASE32), F.shiftright(number, s).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1)) for s in range(35, -1, -5)]
    return F.concat(*out)


def plan_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages with digest, record type and the page they refer to.

    Of pages with equal payloads of at least ``least`` bytes the largest page_id is the response; rows that repeat it
    are responses too. A null html is empty. A page without page_id refers to the response when there is one with an id;
    if no page of a payload has an id, all are responses.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("url"), html.alias("html"))
    p = p.select("*", F.octet_length("html").cast("long").alias("payload_bytes"), base32_sha1(F.col("html")).alias("digest"))
    first = p.where(F.col("payload_bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("_first"))
    return p, first


def _header(record_type: Column, refers_to: Column, length: Column) -> Column:
    clean = F.regexp_replace("url", r"[\r\n]", " ")
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), record_type, F.lit("\r\nWARC-Target-URI: "), clean,
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(refers_to.isNotNull(), F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), refers_to.cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"))


def _member(record: Column) -> Column:
    """A record text as a gzip member; null stays null."""

    @F.arrow_udf("binary")
    def packed(records: pa.Array) -> pa.Array:
        return pa.array([zlib.compress(r.as_buffer(), wbits=31) if r.is_valid else None for r in records], pa.binary())

    return packed(record)


def write_archives(pages: DataFrame, path: str, archive_bytes: int = 32 << 20, least: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``path`` and return the index: ``page_id, url, digest, payload_bytes,
    record_type, refers_to, archive, offset, length, file``.

    Revisits hold the HTTP head (with the full payload's length) and no payload. Archives hold about ``archive_bytes``
    unpacked; a page goes to an archive by a hash of its row, so their number follows the data.
    """
    p, first = plan_records(pages, least)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    response = F.concat(_header(F.lit("response"), F.lit(None).cast("long"), F.octet_length(http) + F.col("payload_bytes")), http, F.col("html"), F.lit(END))
    revisit = F.when(F.col("record_type") == "revisit", F.concat(_header(F.lit("revisit"), F.col("refers_to"), F.octet_length(http)), http, F.lit(END)))
    total = p.agg(F.sum(F.col("payload_bytes") + 512)).first()[0] or 0
    archives = int(total // archive_bytes) + 1
    p = p.withColumn("archive", F.pmod(F.xxhash64("page_id", "url", "digest"), F.lit(archives)).cast("int"))
    texts = p.select("archive", *_ORDER[:3], "payload_bytes", _member(response).alias("member"))
    typed = texts.withColumn("packed", F.octet_length("member")).drop("member").join(first, "digest", "left")
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")) & (F.col("payload_bytes") >= least)
    typed = typed.withColumns({"record_type": F.when(again, F.lit("revisit")).otherwise(F.lit("response")), "refers_to": F.when(again, F.col("_first"))}).drop("_first")
    packed = F.coalesce(F.octet_length(_member(revisit)), F.col("packed")) + len(_SEPARATOR)
    sized = typed.withColumn("length", packed.cast("long")).drop("packed")
    order = Window.partitionBy("archive").orderBy(*_ORDER)
    rows = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    index = stored(sized.withColumn("offset", F.sum("length").over(rows) - F.col("length")), "warc-index")

    # members are dealt once: the index sends each record's type to the same archive, where both rows meet
    texts = texts.withColumns({"record_type": F.lit(None).cast("string"), "refers_to": F.lit(None).cast(index.schema["refers_to"].dataType)})
    both = texts.unionByName(index.select(*[c for c in texts.columns if c != "member"], F.lit(None).cast("binary").alias("member"))).repartition("archive")
    same = Window.partitionBy("archive", "page_id", "url", "digest")
    whole = both.withColumns({c: F.max(c).over(same) for c in ("record_type", "refers_to")}).where(F.col("member").isNotNull())
    lines = whole.select("archive", *_ORDER, F.coalesce(_member(revisit), F.col("member")).cast("string").alias("value")).sortWithinPartitions("archive", *_ORDER)
    writer = lines.select("archive", "value").write.partitionBy("archive").option("compression", "none")
    writer.option("encoding", "ISO-8859-1").option("lineSep", _SEPARATOR.decode("latin-1")).text(path)
    files = pages.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        F.col("path").alias("file"), F.regexp_extract("path", r"archive=(\d+)", 1).cast("int").alias("archive"))
    return index.join(files, "archive")


def _opened(uri: str):
    from pyarrow import fs

    if "://" not in uri and uri.startswith("file:"):
        uri = uri[5:]
    store, path = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
    return store.open_input_file(path)


def parse_record(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and the payload of one record."""
    def fields(block: bytes) -> dict[str, str]:
        return dict(line.split(": ", 1) for line in block.decode("utf-8").split("\r\n")[1:] if ": " in line)

    head, _, rest = record.partition(b"\r\n\r\n")
    warc = fields(head)
    block = rest[: int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http), payload


def _read(gap: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, handle = None, None
        for batch in batches:
            file, offset, length = (batch.column(i).to_pylist() for i in range(3))
            at, out = 0, []
            while at < len(file):
                to, end = at + 1, offset[at] + length[at]
                while to < len(file) and file[to] == file[at] and offset[to] - end <= gap and offset[to] + length[to] - offset[at] <= most:
                    end, to = max(end, offset[to] + length[to]), to + 1
                if file[at] != source:
                    source, handle = file[at], _opened(file[at])
                handle.seek(offset[at])
                block = handle.read(end - offset[at])
                for k in range(at, to):
                    member = block[offset[k] - offset[at] : offset[k] - offset[at] + length[k]]
                    warc, http, payload = parse_record(zlib.decompressobj(wbits=31).decompress(member))
                    page, refers = (warc.get(n, "<urn:page:>")[10:-1] for n in ("WARC-Record-ID", "WARC-Refers-To"))
                    digest, kind = warc["WARC-Payload-Digest"].removeprefix("sha1:"), warc["WARC-Type"]
                    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"record at {offset[k]} of {file[k]} does not match its digest")
                    out.append((int(page) if page else None, warc["WARC-Target-URI"], int(http["Content-Length"]), digest, kind, int(refers) if refers else None, payload if kind == "response" else None))
                at = to
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()))] if out else
                [pa.array([], k) for k in (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())],
                names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    return run


def read_records(index: DataFrame, gap: int = 64 << 10, most: int = 8 << 20) -> DataFrame:
    """The records that ``index`` names: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload``.

    Each archive's ranges are sorted; ranges at most ``gap`` bytes apart are read at once, at most ``most`` bytes each (a
    larger record alone). Digests are verified. An empty selection reads nothing.
    """
    # the ranges are few bytes but stand for many: the number of tasks follows what they read, not the index
    tasks = int((index.agg(F.sum("length")).first()[0] or 0) // _TASK_BYTES) + 1
    ranges = index.select("file", "offset", "length", "archive").repartition(tasks, "archive").sortWithinPartitions("file", "offset").drop("archive")
    return ranges.mapInArrow(_read(gap, most), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive_round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write every page, then read every record back."""
    return read_records(write_archives(pages, scratch_path(pages.sparkSession, "warc"), least=least))
