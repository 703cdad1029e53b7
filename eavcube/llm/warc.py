"""Deduplicated WARC archives: revisits are resolved by payload digest before records are written."""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eavcube.llm.common import staged

# Fixed values of the format.
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP_OK = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "

_PARSED = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "digest_ok boolean, payload binary")


def base32_digest(hexadecimal: Column) -> Column:
    """A hexadecimal SHA-1 (40 digits) as 32 base32 characters: five digits at a time make four."""
    letters = []
    for at in range(1, 41, 5):
        bits = F.conv(F.substring(hexadecimal, at, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Records that repeat the payload of an earlier one: page_id, digest (hex), refers_to, refers_url.

    Only digests, sizes, ids and URLs are shuffled. Of the records with one payload of at least `min_bytes` bytes, that
    with the smallest page_id is the response; all rows that carry this page_id are. A null page_id comes after all
    others.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    headers = staged(pages.select(F.col("page_id").cast("long"), "url", F.sha1(payload.cast("binary")).alias("digest"),
                                  F.octet_length(payload).alias("bytes")).where(F.col("bytes") >= min_bytes))
    originals = staged(headers.groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("late"), "page_id", "url")).alias("first"), F.count("*").alias("n"),
    ).where("n > 1").select(F.col("digest").alias("d"), F.col("first.page_id").alias("refers_to"),
                            F.col("first.url").alias("refers_url")))
    found = headers.join(originals, F.col("digest") == F.col("d"))
    return found.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(
        "page_id", "digest", "refers_to", "refers_url").distinct()


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _uri(url: Column) -> Column:
    """Header values hold no white space or control characters; a missing URL is about:blank."""
    return F.coalesce(F.regexp_replace(url, r"[\x00-\x20\x7f]", "%20"), F.lit("about:blank"))


def records(pages: DataFrame, min_bytes: int = 0, date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """One WARC/1.1 record for each page, without the blank lines that end it, in the column `record`.

    Revisits keep the HTTP header only. Payload digest and size are always those of the full payload. Null html is an
    empty payload, repeated rows give repeated records, an empty table gives none; other columns are not looked at.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    again = staged(revisits(pages, min_bytes)).select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to", "refers_url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
                        F.sha1(payload.cast("binary")).alias("digest"))
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left")
    size = F.octet_length("payload").cast("string")
    http = F.concat(F.lit(HTTP_OK), size, F.lit(END))
    repeat = F.col("_digest").isNotNull()
    block = F.when(repeat, http).otherwise(F.concat(http, F.col("payload")))
    header = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(repeat, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _uri(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_digest(F.col("digest"))),
        F.concat(F.lit("WARC-Block-Digest: sha1:"), base32_digest(F.sha1(F.col("block").cast("binary")))),
        F.concat(F.lit("X-Payload-Length: "), size),
        F.when(repeat, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(repeat, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")))),
        F.when(repeat, F.concat(F.lit("WARC-Refers-To-Target-URI: "), _uri(F.col("refers_url")))),
        F.when(repeat, F.lit(f"WARC-Refers-To-Date: {date}")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")))
    return rows.withColumn("block", block).select("page_id", F.concat(header, F.lit(END), F.col("block")).alias("record"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2026-01-01T00:00:00Z") -> None:
    """Write gzip archives, one for each task, through Spark's committer: lost tasks leave nothing behind."""
    records(pages, min_bytes, date).select("record").write.option("lineSep", END).option("compression", "gzip").text(path)


def _parse(batches):
    """Records of the archives of one task. Blank-line pieces are joined again and cut by Content-Length."""
    end = END.encode()
    held, out = bytearray(), []

    def take():
        while held[:2] == b"\r\n":
            del held[:2]
        stop = held.find(end)
        if stop < 0:
            return None
        head = {}
        for line in bytes(held[:stop]).split(b"\r\n")[1:]:
            name, _, value = line.partition(b": ")
            head[name.decode()] = value.decode("utf-8", "replace")
        size = int(head["Content-Length"])
        if len(held) < stop + 4 + size + 4:
            return None
        block = bytes(held[stop + 4 : stop + 4 + size])
        del held[: stop + 8 + size]
        number = lambda name: (int(x) if (x := head[name][12:-1]) != "null" else None) if name in head else None
        told = head["WARC-Payload-Digest"].removeprefix("sha1:")
        kind, payload = head["WARC-Type"], None
        if kind == "response":
            payload = block[block.index(end) + 4 :]
            told_ok = base64.b32encode(hashlib.sha1(payload).digest()).decode() == told
        else:
            told_ok = None
        return (number("WARC-Record-ID"), head["WARC-Target-URI"], kind, number("WARC-Refers-To"),
                len(payload) if payload is not None else int(head["X-Payload-Length"]), told, told_ok, payload)

    names = [f.split()[0] for f in _PARSED.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    as_batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
    for batch in batches:
        size = 0
        for piece in batch.column(0):
            held += piece.as_py() + end
            while held and (found := take()) is not None:
                out.append(found)
                size += found[4]
            if size > 1 << 22:
                yield as_batch()
                out.clear()
                size = 0
        if out:
            yield as_batch()
            out.clear()
    if held.strip(b"\r\n"):
        raise ValueError("an archive ends inside a record")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of gzip archives: ids, type, refers_to, payload size and digest, whether a response's payload has that
    digest, and the payload (null for revisits). A gzip file is read by one task from its start."""
    pieces = spark.read.option("lineSep", END).text(path).select(F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(_parse, _PARSED)
