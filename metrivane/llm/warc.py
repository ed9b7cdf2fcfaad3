"""WARC archives with Zstandard: one frame per record, dictionary in the leading skippable frame.

Archives are real files in a folder that all executors share.  A task writes a file under a name of its
own and moves it in place when it is whole, so a task that is run again replaces its file by an equal one.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrivane.llm.common import shared_folder, ship, stored, table

# fixed values of the format
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

SAMPLE = 1 << 20  # payload bytes of an archive that its dictionary is trained on
DICTIONARY = 16 << 10  # bytes of a dictionary
READ = 1 << 20
LEAST = 0  # payloads below this size are always whole responses
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id, url: str | None, html: bytes | None, digest: str, size: int, refers_to) -> bytes:
    """A response record, or with ``html`` None a revisit record that refers to another page's."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (html or b"")
    headers = [
        ("WARC-Type", "revisit" if html is None else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join(c for c in url or "" if c.isprintable())),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Length", str(len(block))),
    ]
    if html is None:
        headers[3:3] = [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", record_id(refers_to))]
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    return head + b"\r\n" + block + b"\r\n\r\n"


def record_id(page_id) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def page_of(value: str | None):
    name = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return None if name in ("", "none") else int(name)


def trained(samples: list[bytes]):
    """A dictionary, or None where there is too little to train one on."""
    parts = [s[i : i + 4096] for s in samples for i in range(0, len(s), 4096)]
    if len(parts) < 16:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY, parts)
    except zstandard.ZstdError:
        return None


def write_archive(out, records, level: int = 3) -> tuple[int, int]:
    """Write (record bytes) to ``out``: the dictionary's skippable frame, then a frame for each record.

    The first SAMPLE bytes wait in memory for the dictionary.  Returns (records, bytes)."""
    waiting, size, compressor, n, written = [], 0, None, 0, 0

    def start():
        dictionary = trained(waiting)
        if dictionary is not None:
            data = dictionary.as_bytes()
            out.write(struct.pack("<II", SKIPPABLE, len(data)) + data)
        return zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True, write_content_size=True), 8 + len(data) if dictionary is not None else 0

    def put(record):
        nonlocal n, written
        frame = compressor.compress(record)
        out.write(frame)
        n, written = n + 1, written + len(frame)

    for record in records:
        if compressor is None:
            waiting.append(record)
            size += len(record)
            if size < SAMPLE:
                continue
            compressor, head = start()
            written += head
            for r in waiting:
                put(r)
            waiting = []
        else:
            put(record)
    if compressor is None and waiting:
        compressor, head = start()
        written += head
        for r in waiting:
            put(r)
    return n, written


class BadArchive(ValueError):
    """An archive that breaks the format."""


def frames(stream):
    """The decoded frames of an archive, one after another; the dictionary comes from the first frame, if it is
    skippable.  Reads READ bytes at a time, so memory depends on the longest record, not on the archive."""
    head = stream.read(4)
    dictionary, rest = None, head
    if len(head) == 4 and struct.unpack("<I", head)[0] == SKIPPABLE:
        (size,) = struct.unpack("<I", exactly(stream, 4))
        data = exactly(stream, size)
        if data[:4] == struct.pack("<I", FRAME):  # a dictionary may itself be compressed
            data = zstandard.ZstdDecompressor().decompress(data)
        dictionary, rest = zstandard.ZstdCompressionDict(data), b""
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        rest = rest or stream.read(READ)
        if not rest:
            return
        own, parts = decompressor.decompressobj(), []
        while True:
            try:
                parts.append(own.decompress(rest))
            except zstandard.ZstdError as e:
                raise BadArchive(f"broken frame: {e}") from e
            if own.eof:
                rest = own.unused_data
                break
            rest = stream.read(READ)
            if not rest:
                raise BadArchive("the archive ends within a frame")
        yield b"".join(parts)


def exactly(stream, n: int) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise BadArchive("the archive ends within its dictionary")
    return data


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record; raises BadArchive where version, headers, lengths or digests are wrong."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/1."):
        raise BadArchive("no WARC version line or no end of the headers")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise BadArchive(f"not a header: {line[:80]!r}")
        headers[name.decode().strip().lower()] = value.decode().strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise BadArchive(f"no {name}")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise BadArchive(f"{headers['warc-record-id']}: Content-Length {headers['content-length']} for {len(rest) - 4} bytes")
    block = rest[:-4]
    if "warc-block-digest" in headers and headers["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
        raise BadArchive(f"{headers['warc-record-id']}: the block digest differs")
    return headers, block


def read_record(data: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of a record.

    A response's payload is checked against its HTTP length and its digest; a revisit has none."""
    headers, block = parse_record(data)
    http, found, payload = block.partition(b"\r\n\r\n")
    lengths = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not found or not lengths:
        raise BadArchive(f"{headers['warc-record-id']}: no HTTP headers with a length")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    revisit = headers["warc-type"] == "revisit"
    if not revisit and (len(payload) != lengths[0] or sha1_base32(payload) != digest):
        raise BadArchive(f"{headers['warc-record-id']}: the payload differs from its headers")
    page, refers = page_of(headers["warc-record-id"]), page_of(headers.get("warc-refers-to"))
    return page, lengths[0], digest, headers["warc-type"], refers, None if revisit else payload


def plan_records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html (null for a revisit), payload_bytes, refers_to for each page.

    Payloads are equal by SHA-256 and length.  Counting and joining need the digests alone; a payload that holds a
    third of all pages is combined within map tasks, and adaptive execution splits its part of the join.
    """
    html = F.coalesce(pages["html"], F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), pages["url"], html.alias("html"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "key": F.sha2("html", 256)})
    last = rows.groupBy("key", "payload_bytes").agg(F.max("page_id").alias("last"))
    joined = rows.join(last, ["key", "payload_bytes"])
    revisit = (F.col("payload_bytes") >= least) & (F.col("page_id").isNull() | (F.col("page_id") < F.col("last"))) & F.col("last").isNotNull()
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "payload_bytes", F.when(revisit, F.col("last")).alias("refers_to"),
        F.when(revisit, F.unhex(F.sha1("html"))).alias("sha1"),
    )


def archive_task(folder: str):
    """mapInArrow function: writes the records of a task to one archive, gives (path, records, bytes)."""

    def records(batches):
        for batch in batches:
            for page, url, html, size, refers, sha1 in zip(*[c for c in batch.columns]):
                html = html.as_py()
                digest = base64.b32encode(sha1.as_py()).decode() if html is None else sha1_base32(html)
                yield record_bytes(page.as_py(), url.as_py(), html, digest, size.as_py(), refers.as_py())

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        path = f"{root}/part-{TaskContext.get().partitionId():06d}.warc.zst"
        store.create_dir(root, recursive=True)
        own = f"{path}.{uuid.uuid4().hex}"
        with store.open_output_stream(own, compression=None) as out:
            n, written = write_archive(out, records(batches))
        if n:
            store.move(own, path)
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n], "bytes": [written]})
        else:
            store.delete_file(own)

    return run


def write(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Write the archives of ``pages`` (page_id, url, html) to ``folder``; gives path, records, bytes of each.

    A null html is an empty payload.  Of pages with equal payloads of at least ``least`` bytes the one with the
    largest page_id is the response and the others revisit it; pages without an id revisit one that has, and are
    responses where none has.  Control characters in a URL are left out of its header.  Repeated rows with one page_id are responses alike.
    """
    ship(pages.sparkSession)
    return stored(plan_records(pages, least).mapInArrow(archive_task(folder), "path string, records long, bytes long"), "warc-files")


def read_task(folder: str, payloads: bool):
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    if not payloads:
        schema = schema.remove(5)

    def run(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for data in frames(stream):
                        rows.append(read_record(data)[: len(schema)])
                        size += len(data) if payloads else 200
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return run


def read(files: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the archives in ``files`` (column path): page_id, payload_bytes, payload_digest, record_type,
    refers_to, and on request payload (null for revisits).  Breaks off with BadArchive at a broken archive."""
    spark: SparkSession = files.sparkSession
    ship(spark)
    paths = files.select("path").repartition(max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return paths.mapInArrow(read_task(folder, payloads), RECORD + (", payload binary" if payloads else ""))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    folder = folder if "://" in folder else folder.replace("file:", "file://") if folder.startswith("file:") else f"file://{folder}"
    return read(write(table(spark, sf_dir, "pages"), folder), folder)


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
g AS (SELECT b, max(page_id) AS last FROM p GROUP BY b),
r AS (SELECT page_id, octet_length(p.b) AS payload_bytes, sha1(p.b) AS h, page_id < last AS again, last FROM p JOIN g ON p.b = g.b)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + ((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1)), '') AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN last END AS refers_to
FROM r
"""
