"""WARC archives with an index: written once, read back by coalesced byte ranges.

Writing: payload digests are compared first, on small rows: of the records with
one payload of at least ``MIN_REVISIT`` bytes that with the smallest id is the
response, the others become revisits of it.  Each task then streams its records
into one archive in the shared store, every record its own gzip member, and
yields an index row (archive, offset, length, URL, digest) per record.  The
index is written by Spark's committer: archives of lost or repeated attempts
are in no index.

Reading: index rows, sorted by archive and offset, are put together to ranges
of up to ``RANGE_BYTES`` with gaps of at most ``GAP_BYTES``; one read serves a
range, and records are cut from it by their index rows.

Defined cases: a null payload is an empty one; a null URL is written as an
empty one; records with a null id come last in the choice of the response and
have no ``refers_to`` if all are null; equal records with the same smallest id
are all responses; payloads of any length are written and read whole, one at a
time; an empty table gives no archives; other columns are not read, so their names
don't matter.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import common

MIN_REVISIT = 100
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
#: Date written to every record: captures carry none.
DATE = "2024-01-01T00:00:00Z"
GZIP_LEVEL = 1

INDEX = "page_id bigint, archive string, offset bigint, length bigint, url string, digest string, record_type string"
RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None) -> bytes:
    """One uncompressed WARC/1.1 record.  A revisit has the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~-._')}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    warc = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(warc["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def member(raw: bytes) -> bytes:
    """A gzip member that holds ``raw``."""
    z = zlib.compressobj(GZIP_LEVEL, wbits=31)
    return z.compress(raw) + z.flush()


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", uri: str | None = None) -> DataFrame:
    """Write all records below ``uri``; the stored index, a row per record."""
    spark = pages.sparkSession
    common.prepare(spark)
    uri = uri or common.scratch_uri(spark, "warc")
    payload = F.coalesce(common.column(pages, payload_col), F.lit("")).cast("binary")
    rows = pages.select(common.column(pages, id_col).cast("bigint").alias("page_id"), common.column(pages, url_col).alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    large = rows.where(F.octet_length("payload") >= MIN_REVISIT).select("page_id", "digest")
    firsts = large.groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("refers_to")).where("n > 1").drop("n")
    again = large.join(firsts, "digest").where("NOT page_id <=> refers_to").distinct()
    # Ids spread evenly, digests of many copies don't: payloads move by id.
    again = again.select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to", F.lit(True).alias("revisit"))
    same = F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest"))
    decided = rows.join(again, same, "left").select("page_id", "url", "payload", "digest", F.coalesce("revisit", F.lit(False)).alias("revisit"), "refers_to")
    schema = pa.schema([("page_id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                        ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{uri}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}.warc.gz"
        out, at = None, 0
        for batch in batches:
            index = []
            for r in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "payload", "digest", "revisit", "refers_to"))):
                if out is None:
                    filesystem, where = common.store_files(path)
                    filesystem.create_dir(where.rpartition("/")[0], recursive=True)
                    out = filesystem.open_output_stream(where, compression=None)
                    info = member(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:info>\r\nWARC-Date: " + DATE.encode() + b"\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
                    out.write(info)
                    at = len(info)
                raw = member(record(*r))
                out.write(raw)
                index.append((r[0], path, at, len(raw), r[1], r[3], "revisit" if r[4] else "response"))
                at += len(raw)
            yield from common.batches(iter(index), schema)
        if out is not None:
            out.close()

    return common.stored(common.gathered(decided, pages.count()).mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records that the rows of ``index`` name, from the archives: ``RECORD`` and, if wanted, ``payload``."""
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * with_payload
    schema = pa.schema(fields)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Index rows by shared byte range; a task may hold several sorted runs, so a step back ends a range too."""
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("archive", "offset", "length", "url"))):
                if held and (row[0] != held[0][0] or row[1] < held[-1][1] + held[-1][2] or row[1] - (held[-1][1] + held[-1][2]) > GAP_BYTES or row[1] + row[2] - held[0][1] > RANGE_BYTES):
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            path, file = None, None
            for chunk in ranges(batches):
                if chunk[0][0] != path:
                    path = chunk[0][0]
                    filesystem, where = common.store_files(path)
                    file = filesystem.open_input_file(where)
                begin = chunk[0][1]
                raw = file.read_at(chunk[-1][1] + chunk[-1][2] - begin, begin)
                for _, offset, length, url in chunk:
                    warc, http, payload = parse(zlib.decompress(raw[offset - begin: offset - begin + length], wbits=31))
                    kind, digest = warc["WARC-Type"], warc["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"a payload in {path} doesn't match its digest")
                    yield (_page(warc["WARC-Record-ID"]), url, int(http["Content-Length"]), digest, kind, _page(warc.get("WARC-Refers-To")), payload)[: len(fields)]

        yield from common.batches(rows(), schema, 256 if with_payload else 4096)

    ordered = index.select("archive", "offset", "length", "url").repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset")
    return common.gathered(ordered, index.count()).mapInArrow(read, RECORD + ", payload binary" * with_payload)
