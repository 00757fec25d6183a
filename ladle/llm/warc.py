"""WARC archives, index first.

Writing: equal payloads are found from their digests (one row per page, the
payload stays out of that shuffle); every task then streams its pages into one
archive file in the shared folder, each record a gzip member of its own, and
returns the index rows: file, offset, length, URL, digest, type.  The index,
written as a table, is the commit record: a task that ran twice leaves an
archive that no index row names.

Reading: the selected index rows are range-partitioned by file and offset, and
every task reads its sorted byte ranges with neighbours coalesced into one
request, parses each record and checks the payload's digest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.batches import bounded_batches
from ladle.llm.registry import query, table
from ladle.session import ensure_checkpoint_dir, materialize

MIN_REVISIT_BYTES = 0     # equal payloads of at least so many bytes are stored once
MAX_REQUEST = 8 << 20     # bytes of one coalesced read
TASK_BYTES = 4 << 20   # of archives that one task reads
MAX_GAP = 64 << 10        # unselected bytes read along rather than asking twice
DATE = "2020-01-01T00:00:00Z"  # records carry no clock, so that reruns write equal archives
_INDEX = ("page_id long, url string, record_type string, payload_digest string, refers_to long, "
          "file string, offset long, length long")
_RECORD = ("page_id long, url string, record_type string, payload_digest string, refers_to long, "
           "payload binary")


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 revisit: bool) -> bytes:
    """One record: headers, blank line, block, two line ends.  A revisit has no block."""
    block = b"" if revisit else payload
    clean = None if url is None else url.encode("utf-8").replace(b"\r", b"%0D").replace(b"\n", b"%0A")
    lines = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"),
             b"WARC-Record-ID: " + _record_id(page_id).encode(), b"WARC-Date: " + DATE.encode(),
             b"WARC-Payload-Digest: sha1:" + digest.encode()]
    if clean is not None:
        lines.append(b"WARC-Target-URI: " + clean)
    if page_id is not None:
        lines.append(b"X-Page-ID: %d" % page_id)
    if revisit:
        lines += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  b"WARC-Refers-To: " + _record_id(refers_to).encode()]
        if refers_to is not None:
            lines.append(b"X-Refers-To-Page-ID: %d" % refers_to)
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers (lower-case names) and block of one uncompressed record."""
    head, block = raw.split(b"\r\n\r\n", 1)
    first, *lines = head.split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    headers = {k.decode("ascii").lower(): v.decode("utf-8") for k, v in (x.split(b": ", 1) for x in lines)}
    n = int(headers["content-length"])
    if len(block) != n + 4 or block[n:] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its header")
    return headers | {"block": block[:n]}


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that Spark names as a URI or a bare path."""
    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)


def _payload_key(html: Column) -> Column:
    """Digest that decides equality: SHA-256 and length beside the record's SHA-1."""
    return F.concat_ws(":", F.sha2(html.cast("binary"), 256), F.octet_length(html).cast("string"))


def write_archives(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url",
                   html: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write one record per page and return the index (see ``_INDEX``), a
    table of its own in the shared folder.

    Of pages whose payloads are equal and at least ``min_bytes`` long the one
    with the smallest page_id is the response; the others revisit it.

    * null html: empty payload; null url: a record without target URI;
    * null page_id: a record without page number, a response only if no equal
      page has a number;
    * rows that repeat the response's page_id with an equal payload are
      responses, too; empty table: an empty index and no archive.
    """
    spark = pages.sparkSession
    bounded_batches(spark, 128)
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    whole = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    keyed = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
                         whole.alias("html"), _payload_key(whole).alias("key"))
    firsts = keyed.groupBy("key").agg(F.min("page_id").alias("first_id"))
    same = F.col("page_id").eqNullSafe(F.col("first_id")) | (F.octet_length("html") < min_bytes)
    rows = (keyed.join(firsts, "key").select("page_id", "url", "html", "first_id", (~same).alias("revisit")))

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, offset = _arrow_schema(_INDEX), None, 0
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"  # a name per attempt: attempts never write the same file
        for batch in batches:
            index = []
            for number, address, text, first, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                payload = text.encode("utf-8")
                digest = payload_digest(payload)
                member = gzip.compress(build_record(number, address, payload, digest, first, revisit), 4, mtime=0)
                out = out or system.open_output_stream(f"{base}/{name}", compression=None)
                out.write(member)
                index.append((number, address, "revisit" if revisit else "response", digest,
                              first if revisit else None, name, offset, len(member)))
                offset += len(member)
            columns = zip(*index) if index else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        if out:
            out.close()

    index = materialize(rows.mapInArrow(archived, _INDEX), "warc-index")
    return index.withColumn("file", F.concat(F.lit(folder + "/"), F.col("file")))


def coalesced(ranges: list[tuple[int, int]], max_gap: int, max_request: int) -> list[tuple[int, int, list[int]]]:
    """(offset, length, members) of the requests that serve sorted (offset, length) ranges."""
    requests: list[tuple[int, int, list[int]]] = []
    for k, (offset, length) in enumerate(ranges):
        if requests:
            start, size, members = requests[-1]
            end = max(start + size, offset + length)
            if offset - (start + size) <= max_gap and end - start <= max_request:
                members.append(k)
                requests[-1] = (start, end - start, members)
                continue
        requests.append((offset, length, [k]))
    return requests


def read_records(index: DataFrame, max_gap: int = MAX_GAP, max_request: int = MAX_REQUEST,
                 task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records (see ``_RECORD``) that index rows select, parsed from the
    archives.  A revisit has no payload; a response whose payload does not
    match its digest fails the read.  Rows repeated in ``index`` are read once
    each; an empty index gives no rows.

    Tasks follow the archive bytes behind the rows (``task_bytes`` each), not
    the few bytes of the index; a file is shared by as many as its records fill."""
    bounded_batches(index.sparkSession, 128)
    total = index.agg(F.sum("length")).first()[0] or 0

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, name, source = _arrow_schema(_RECORD), None, None
        for batch in batches:
            files, offsets, lengths = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(files):
                end = at
                while end < len(files) and files[end] == files[at]:
                    end += 1
                if files[at] != name:
                    if source:
                        source.close()
                    name = files[at]
                    system, path = _open(name)
                    source = system.open_input_file(path)
                ranges = list(zip(offsets[at:end], lengths[at:end]))
                for start, size, members in coalesced(ranges, max_gap, max_request):
                    data, records = source.read_at(size, start), []
                    for k in members:
                        offset, length = ranges[k]
                        records.append(_parsed(zlib.decompress(data[offset - start:offset - start + length], 31)))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*records), schema)],
                                                     schema=schema)
                at = end
        if source:
            source.close()

    return (index.select("file", "offset", "length")
            .repartitionByRange(max(1, -(-total // task_bytes)), "file", "offset")
            .sortWithinPartitions("file", "offset").mapInArrow(read, _RECORD))


def _parsed(raw: bytes) -> tuple:
    record = parse_record(raw)
    digest = record["warc-payload-digest"].removeprefix("sha1:")
    revisit = record["warc-type"] == "revisit"
    if not revisit and payload_digest(record["block"]) != digest:
        raise ValueError(f"payload of {record['warc-record-id']} does not match its digest")
    number, refers = record.get("x-page-id"), record.get("x-refers-to-page-id")
    return (None if number is None else int(number), record.get("warc-target-uri"), record["warc-type"], digest,
            None if refers is None else int(refers), None if revisit else record["block"])


@query("op5_warc_index_first", r"""
SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER w THEN min(page_id) OVER w END AS refers_to
FROM (SELECT page_id, html, (
        SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
                 (('0x' || substr(h, (5 * i) // 4 + 1, 3))::INT >> (7 - (5 * i) % 4)) & 31), 1), '' ORDER BY i)
        FROM range(32) AS r(i)) AS d
      FROM (SELECT page_id, html, sha1(coalesce(html, '')) || '00' AS h FROM pages))
WINDOW w AS (PARTITION BY coalesce(html, ''))
""")
def op5_warc_index_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(table(spark, sf_dir, "pages"))
    records = materialize(read_records(index).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
                          .drop("payload", "url"), "warc-read")
    # A revisit's full payload is that of the response with its digest.
    sizes = (records.where("record_type = 'response'").groupBy("payload_digest")
             .agg(F.max("payload_bytes").alias("full_bytes")))
    return (records.join(sizes, "payload_digest", "left")
            .select("page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest",
                    "record_type", "refers_to"))
