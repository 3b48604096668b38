"""WARC archives of pages, and the assembly of their transactions.

Archives are written by Spark's text writer: a row is one record (header, block) and the separator
of rows is the empty lines that end a record, so a lost task leaves nothing behind. Each page gives
a request, a response or revisit, and a metadata record, tied by WARC-Concurrent-To. Reading parses
archives by Content-Length; transactions are joined over the identifiers.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import cut_lineage

END = "\r\n\r\n"
RECORDS_PER_FILE = 3_000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as 32 letters of base 32: five hex digits are four letters."""

    def letters(value: Column) -> Column:
        return F.concat(
            *[F.substring(F.lit(BASE32), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        )

    def text(digest: Column) -> Column:
        parts = F.transform(
            F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        )
        return F.array_join(F.transform(parts, letters), "")

    # the digest is an element of an array, so that it is computed once
    return F.get(F.transform(F.array(F.sha1(payload)), text), F.lit(0))


def record_id(kind: str, capture: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind + " "), capture.cast("string")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: str, own: Column, uri: Column, block: list[Column], *more: Column) -> Column:
    """A record; the parts of its block are only joined into the whole."""
    length = sum((F.octet_length(b) for b in block[1:]), F.octet_length(block[0]))
    head = [
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Record-ID: "), own,
        F.lit("\r\nWARC-Target-URI: "), uri, *more,
        F.lit("\r\nContent-Length: "), length.cast("string"), F.lit(END), *block,
    ]
    return F.concat(*head)


def archive_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0
) -> DataFrame:
    """One text column: the records of every page. Of payloads of at least `least` bytes that are
    equal, the one with the largest id is a response and the others revisit it."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    base = pages.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("capture"),
        F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\x00-\x1f]", "").alias("uri"),
        html.alias("html"), F.sha2(html, 256).alias("hash"), F.octet_length(html).alias("size"),
    )
    one = F.max(F.struct(F.col("id"), F.col("capture"))).alias("top")
    same = base.where(F.col("size") >= least).groupBy("hash").agg(one, F.count("*").alias("n")).where("n > 1")
    again = (
        base.where(F.col("size") >= least).join(same, "hash")
        .where(~F.col("id").eqNullSafe(F.col("top.id")))
        .select("capture", F.col("top.capture").alias("first"))
    )
    # written, so that the join sees its size: while the copies are few, pages are not shuffled
    rows = base.drop("hash").join(cut_lineage(again), "capture", "left")
    digest = F.concat(F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_sha1(F.col("html")))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit(END),
    )
    own = record_id("page", F.col("capture"))
    tied = F.concat(F.lit("\r\nWARC-Concurrent-To: "), own)
    uri = F.col("uri")
    kind_http = F.lit("\r\nContent-Type: application/http;msgtype=response")
    response = _record("response", own, uri, [http, F.col("html")], digest, kind_http)
    revisit = _record(
        "revisit", own, uri, [http], digest, kind_http,
        F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        F.lit("\r\nWARC-Refers-To: "), record_id("page", F.col("first")),
    )
    request = _record(
        "request", record_id("request", F.col("capture")), uri, [F.lit("GET "), uri, F.lit(" HTTP/1.1" + END)],
        tied, F.lit("\r\nContent-Type: application/http;msgtype=request"),
    )
    page = F.col("id").cast("string")
    facts = F.coalesce(F.concat(F.lit("page_id: "), page, F.lit("\r\n")), F.lit(""))
    metadata = _record(
        "metadata", record_id("metadata", F.col("capture")), uri, [facts], tied,
        F.lit("\r\nContent-Type: application/warc-fields"),
    )
    three = F.array(request, F.when(F.col("first").isNull(), response).otherwise(revisit), metadata)
    return rows.select(F.explode(three).alias("value"))


def write_archives(pages: DataFrame, folder: str, **names) -> None:
    """Archives of `pages` as gzip files of some thousand records each."""
    (
        archive_records(pages, **names).write.option("lineSep", END).option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)
    )


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record of an archive."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        fields = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode()
        start = end + 4
        at = start + int(fields["content-length"])
        yield fields, data[start:at]
        at += 4


def gunzip(data: bytes) -> bytes:
    """All members of a gzip file; other data as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data.lstrip(b"\0")
    return b"".join(out)


RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
    "page string, payload_bytes long, payload_digest string, payload binary"
)


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """A row per record. Bytes and digest of a response are those of its payload; those of a revisit
    are what its header says of the payload it stands for. `payloads` false leaves the column null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        kinds = [pa.int64() if c.endswith("long") else pa.binary() if c.endswith("binary") else pa.string() for c in RECORD.split(", ")]
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for fields, block in parse_records(gunzip(data.as_py())):
                    kind, page, size, digest, payload = fields["warc-type"], None, None, None, None
                    if kind in ("response", "revisit"):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        if kind == "response":
                            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        else:
                            told = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
                            size, payload = int(told[b"Content-Length"]), None
                            digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    elif kind == "metadata" and block.startswith(b"page_id: "):
                        page = block[9:].split(b"\r\n")[0].decode()
                    rows.append(
                        (fields["warc-record-id"], kind, fields.get("warc-concurrent-to"), fields.get("warc-refers-to"),
                         fields.get("warc-target-uri"), page, size, digest, payload if payloads else None)
                    )
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture, response, request, metadata). Requests and metadata
    records join the response or revisit that they are concurrent to; a response without either
    stays, with nulls."""
    fields = [c for c in records.columns if c != "concurrent_to"]
    main = records.where(F.col("type").isin("response", "revisit"))
    main = main.select(F.col("record_id").alias("capture"), F.struct(*fields).alias("response"))

    def of(kind: str) -> DataFrame:
        """The first record of a kind, by its identifier, for each capture."""
        light = F.struct("record_id", "target_uri", "page")
        return records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull()).groupBy(
            F.col("concurrent_to").alias("capture")
        ).agg(F.min(light).alias(kind))

    return main.join(of("request"), "capture", "left").join(of("metadata"), "capture", "left")


def archived_pages(pages: DataFrame, folder: str, id_col: str = "page_id", **names) -> DataFrame:
    """Write `pages` to archives in `folder`, read them back and return a row per page: id,
    payload_bytes, payload_digest, record_type and refers_to (the id of the response that a revisit
    stands for). Null html is an empty payload; repeated rows are captures of their own, responses
    all if their id is the largest; a null id revisits and never is revisited unless alone."""
    write_archives(pages, folder, id_col=id_col, **names)
    # without payloads the records are small; written once, archives are not parsed for each kind
    captures = assemble(cut_lineage(read_archives(pages.sparkSession, folder, payloads=False)))
    kind = pages.schema[id_col].dataType.simpleString()
    rows = captures.select(
        "capture", F.col("metadata.page").cast(kind).alias(id_col), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        # a response looks itself up, so that those without a reference are no single key
        F.coalesce("response.refers_to", "capture").alias("_to"),
    )
    first = rows.where(F.col("record_type") == "response").select(
        F.col("capture").alias("_to"), F.col(id_col).alias("_first")
    )
    refers = F.when(F.col("record_type") == "revisit", F.col("_first")).alias("refers_to")
    return rows.join(first, "_to", "left").select(
        id_col, "payload_bytes", "payload_digest", "record_type", refers
    )
