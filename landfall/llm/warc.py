"""Web archives: writing records, and reading them back with segments put together.

Writing is one Spark text write: a row is a record, and the record separator is the line end.
A block longer than a segment is cut; the pieces that follow are continuation records that name
the first by its identifier. Reading parses files record by record by Content-Length.
"""

import zlib

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import sized, stored
from landfall.session import scratch_dir

SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 8 * 1024
#: With SEGMENT_BYTES this keeps a file under 34 MB, so that a task reads files of bounded size.
RECORDS_PER_FILE = 512
END = "\r\n"
HTTP_HEAD = END.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8",
                      "Transfer-Encoding: chunked", "", ""])
READ_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


def base32(hexadecimal):
    """Upper-case base32 of a hexadecimal sha1, 40 bits at a time."""
    parts = [F.lpad(F.conv(F.substring(hexadecimal, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _cut(data, size):
    """Pieces of ``size`` bytes of a binary column, as texts of the same bytes; none if empty."""
    starts = F.when(F.octet_length(data) > 0, F.sequence(F.lit(0), F.octet_length(data) - 1, F.lit(size)))
    pieces = F.transform(starts, lambda i: F.substring(data, i + 1, F.lit(size)).cast("string"))
    return F.coalesce(pieces, F.array().cast("array<string>"))


def _chunked(payload):
    framed = F.transform(_cut(payload, CHUNK_BYTES), lambda c: F.concat(
        F.hex(F.octet_length(c)), F.lit(END), c, F.lit(END)))
    return F.concat(F.array_join(framed, ""), F.lit(f"0{END}{END}"))


def revisits(pages):
    """(digest, first): payloads that occur more than once, and the page that keeps them."""
    return pages.groupBy("digest").agg(
        F.max("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")


def _line(name, value):
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(END))).otherwise(F.lit(""))


def write_archives(spark, pages, path, segment_bytes=SEGMENT_BYTES):
    """Write a record for every row of ``pages`` (page_id, url, html) as gzip files under ``path``.

    The payload is the html in UTF-8; NULL is empty. Of equal payloads the one with the largest
    page_id is a response and the others are revisits of it without a payload of their own; rows
    that share that page_id are all responses. An identifier holds the page_id (nothing for NULL)
    and, behind #, a number that keeps repeated rows apart.
    """
    payload = F.coalesce("html", F.lit(""))
    digest = base32(F.sha1(payload.cast("binary")))
    known = pages.select("page_id", "url", payload.cast("binary").alias("payload"), digest.alias("digest"))
    again = stored(spark, revisits(pages.select("page_id", digest.alias("digest"))), "revisits")
    again = sized(again, 96).withColumnRenamed("digest", "same")
    rows = known.join(again, F.col("digest") == F.col("same"), "left")
    number = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("#"),
                      F.monotonically_increasing_id().cast("string"))
    is_again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.withColumn("id", F.concat(F.lit("<urn:page:"), number, F.lit(">"))).withColumn(
        "type", F.when(is_again, "revisit").otherwise("response")).withColumn(
        "block", F.when(is_again, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), _chunked(F.col("payload")))))
    rows = rows.withColumn("pieces", _cut(F.col("block").cast("binary"), segment_bytes)).select(
        "id", "type", "url", "digest", "first", F.size("pieces").alias("of"),
        F.octet_length("block").alias("total"), F.posexplode("pieces").alias("at", "piece"))
    head = F.col("at") == 0
    many, last = F.col("of") > 1, F.col("at") + 1 == F.col("of")
    piece_id = F.when(head, F.col("id")).otherwise(
        F.concat(F.regexp_replace("id", ">$", "."), F.col("at").cast("string"), F.lit(">")))
    text = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(head, F.col("type")).otherwise("continuation")),
        _line("WARC-Record-ID", piece_id),
        _line("WARC-Date", F.lit("2000-01-01T00:00:00Z")),
        _line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")),
        _line("WARC-Payload-Digest", F.when(head, F.concat(F.lit("sha1:"), "digest"))),
        _line("WARC-Refers-To", F.when(head & (F.col("type") == "revisit"), F.concat(
            F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))),
        _line("WARC-Segment-Number", F.when(many, (F.col("at") + 1).cast("string"))),
        _line("WARC-Segment-Origin-ID", F.when(~head, F.col("id"))),
        _line("WARC-Segment-Total-Length", F.when(many & last, F.col("total").cast("string"))),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length("piece").cast("string")),
        F.lit(END), "piece")
    rows.select(text.alias("value")).write.option("lineSep", END * 2).option(
        "compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _bytes_of(content):
    """Decompressed pieces of a file of one or more gzip members, or the file itself."""
    if content[:2] != b"\x1f\x8b":
        for at in range(0, len(content), READ_BYTES):
            yield content[at:at + READ_BYTES]
        return
    data = content
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        while not member.eof:
            out = member.decompress(data, READ_BYTES)
            data = member.unconsumed_tail or member.unused_data
            if out:
                yield out
            elif not data and not member.eof:
                raise ValueError("archive ends inside a gzip member")


def parse_records(content):
    """(headers, block) of every record in a file."""
    stream, buffer, ended = _bytes_of(content), bytearray(), False

    def fill(size):
        nonlocal ended
        while len(buffer) < size and not ended:
            piece = next(stream, None)
            ended = piece is None
            buffer.extend(piece or b"")

    while True:
        fill(4)
        if not buffer.strip(b"\r\n"):
            if ended:
                return
            buffer.clear()
            continue
        while (end := buffer.find(b"\r\n\r\n", 0)) < 0 or not buffer[:end].strip():
            if end >= 0:
                del buffer[:end + 4]
                continue
            if ended:
                raise ValueError("archive ends inside a record's header")
            fill(len(buffer) + 1)
        lines = bytes(buffer[:end]).decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        fill(end + 4 + size)
        if len(buffer) < end + 4 + size:
            raise ValueError(f"archive ends inside record {headers.get('warc-record-id')}")
        block = bytes(buffer[end + 4:end + 4 + size])
        del buffer[:end + 4 + size]
        yield headers, block


def http_payload(block):
    """The body of an HTTP response, without chunked transfer framing."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower() or not body:
        return body
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        if len(body) < end + 4 + size or body[end + 2 + size:end + 4 + size] != b"\r\n":
            raise ValueError("broken chunk")
        out.append(body[end + 2:end + 2 + size])
        at = end + 4 + size


_META = [("record_id", pa.string()), ("record_type", pa.string()), ("target", pa.string()),
         ("refers", pa.string()), ("digest", pa.string())]
_PARSED = "record_id string, record_type string, target string, refers string, digest string, " \
          "origin string, segment int, total long, body binary"


def _parse(batches):
    names = [n for n, _ in _META] + ["origin", "segment", "total", "body"]
    types = [t for _, t in _META] + [pa.string(), pa.int32(), pa.int64(), pa.binary()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    rows, size = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            for h, block in parse_records(batch.column("content")[i].as_py()):
                number = h.get("warc-segment-number")
                body = block if number else http_payload(block)
                rows.append((h.get("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"),
                             h.get("warc-refers-to"), h.get("warc-payload-digest"),
                             h.get("warc-segment-origin-id") or h.get("warc-record-id"),
                             number and int(number),
                             int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, body))
                size += len(body)
                if size >= BATCH_BYTES:
                    yield batch_of(rows)
                    rows, size = [], 0
    if rows:
        yield batch_of(rows)


def _reassemble(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            part = batch.slice(at, 16)
            bodies = []
            for row in part.select(["origin", "pieces"]).to_pylist():
                pieces = sorted(row["pieces"], key=lambda p: p["segment"])
                block = b"".join(p["body"] for p in pieces)
                totals = [p["total"] for p in pieces if p["total"] is not None]
                if [p["segment"] for p in pieces] != list(range(1, len(pieces) + 1)) or totals != [len(block)]:
                    raise ValueError(f"segments of {row['origin']} are not whole")
                bodies.append(http_payload(block))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n, _ in _META), pa.array(bodies, pa.binary())],
                names=[*(n for n, _ in _META), "payload"])


def read_archives(spark, path):
    """record_id, record_type, target, refers, digest and payload of the records under ``path``.

    Records in one piece are decoded where they are parsed. Segmented ones are grouped by the
    origin they name, ordered by segment number, and their numbers and total length verified; a
    missing, repeated or short segment is an error, as is a file that ends inside a record.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = files.mapInArrow(_parse, _PARSED)
    meta = [n for n, _ in _META]
    whole = parsed.where("segment is null").select(*meta, F.col("body").alias("payload"))
    first = F.col("segment") == 1
    grouped = parsed.where("segment is not null").groupBy("origin").agg(
        *(F.max(F.when(first, F.col(n))).alias(n) for n in meta),
        F.collect_list(F.struct("segment", "total", "body")).alias("pieces"))
    schema = T.StructType([*(T.StructField(n, T.StringType()) for n in meta),
                           T.StructField("payload", T.BinaryType())])
    return whole.union(grouped.mapInArrow(_reassemble, schema))


def _page(column):
    return F.nullif(F.regexp_extract(column, r"^<urn:page:(-?[0-9]*)", 1), F.lit("")).cast("long")


def round_trip(spark, pages):
    """page_id, payload_bytes, payload_digest, record_type and refers_to, read from the archives.

    A revisit has the bytes and the digest of the response it refers to. NULL html is an empty
    payload, equal to other empty ones; a NULL page_id stays NULL; repeated rows stay; an empty
    table gives no rows. Other columns play no part.
    """
    path = scratch_dir(spark, "warc")
    write_archives(spark, pages.select("page_id", "url", "html"), path)
    read = read_archives(spark, path).select(
        _page("record_id").alias("page_id"), "record_type", _page("refers").alias("refers_to"),
        F.regexp_replace("digest", "^sha1:", "").alias("named"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32(F.sha1("payload")).alias("payload_digest"))
    read = stored(spark, read, "read")
    again = read.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "named")
    kept = read.where("record_type = 'response'")
    named = stored(spark, again.select("refers_to").distinct(), "referred")
    bodies = kept.join(sized(named.toDF("wanted"), 16), F.col("page_id") == F.col("wanted"), "left_semi").select(
        F.col("page_id").alias("of"), "payload_bytes", "payload_digest").distinct()
    bodies = stored(spark, bodies, "bodies")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return kept.select(*columns).union(
        again.join(bodies, (F.col("refers_to") == F.col("of")) & (F.col("named") == F.col("payload_digest"))).select(*columns))
