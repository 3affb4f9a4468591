"""WARC archives: writing with deduplication and segments, reading with reassembly.

Every page becomes a record of a gzip member of its own. Of equal payloads (by SHA-256) of
at least ``min_bytes``, the one with the largest page_id is a ``response``, the others are
``revisit`` records that refer to it. Response blocks are HTTP messages in chunked transfer
framing; those over ``SEGMENT`` bytes are cut, and their ``continuation`` records stand in
files of their own.

Reading streams the files of a list, member by member. Segments are grouped by the id of
their origin, put in order of their numbers, and their total length is verified before the
chunked framing is taken off. Length and digest are computed from what was read.

Null html is an empty payload. A page without page_id is always a response. Rows repeated
with the same page_id and payload are all responses. An empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.shared import new_folder, only, open_new, open_old, stored

SEGMENT, CHUNK_SIZE = 16 << 10, 4 << 10
FILE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
OUT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, verified boolean"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_SIZE) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[k:k + size]), payload[k:k + size]) for k in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[line + 2:line + 2 + size])
        if len(out[-1]) != size or body[line + 2 + size:line + 4 + size] != b"\r\n":
            raise ValueError("broken chunk")
        at = line + 4 + size


def record(block: bytes, **headers: object) -> bytes:
    """One gzip member."""
    lines = [b"WARC/1.1"]
    for name, value in headers.items():
        clean = str(value).replace("\r", "%0D").replace("\n", "%0A")
        lines.append(f"{name.replace('_', '-')}: {clean}".encode())
    lines.append(b"Content-Length: %d" % len(block))
    press = zlib.compressobj(4, wbits=31)
    return press.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + press.flush()


def records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each member of a file, with one record in memory."""
    press, parts, data = zlib.decompressobj(31), [], b""
    while True:
        if not data:
            data = source.read(1 << 20)
            if not data:
                break
        parts.append(press.decompress(data))
        data = press.unused_data
        if press.eof:
            head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
            headers = dict(line.decode().split(": ", 1) for line in head.split(b"\r\n")[1:])
            size = int(headers["Content-Length"])
            if len(rest) != size + 4:
                raise ValueError("record of another length than it says")
            yield headers, rest[:size]
            press, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("file ends inside a record")


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to: null for responses, else the page that is kept."""
    slim = only(pages, page_id="page_id", url="url", html="html").withColumn("html", F.coalesce("html", F.lit("")))
    keyed = slim.withColumn("key", F.sha2("html", 256))
    kept = keyed.filter(F.octet_length("html") >= min_bytes).groupBy("key").agg(
        F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
    return keyed.join(kept, "key", "left").select("page_id", "url", "html", F.when(
        (F.col("page_id") != F.col("kept")), F.col("kept")).alias("refers_to"))


class _Files:
    """Files of one kind that a task writes, one open at a time."""

    def __init__(self, folder: str, kind: str):
        self.folder, self.kind, self.open, self.paths = folder, kind, None, []

    def write(self, data: bytes) -> None:
        if self.open is None:
            self.paths.append(f"{self.folder}/{self.kind}-{uuid.uuid4().hex}.warc.gz")
            self.open = open_new(self.paths[-1])
            self.out = self.open.__enter__()
        self.out.write(data)
        if self.out.tell() >= FILE_BYTES:
            self.close()

    def close(self) -> None:
        if self.open is not None:
            self.open.__exit__(None, None, None)
            self.open = None


def write(pages: DataFrame, folder: str, min_bytes: int = 0, segment: int = SEGMENT) -> DataFrame:
    """Write archives below ``folder``; gives the stored list of files (path).

    Only files of tasks that ended well are in the list.
    """
    def run(batches):
        files, more = _Files(folder, "pages"), _Files(folder, "continued")
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for page_id, url, html, refers in zip(*[c.to_pylist() for c in batch.columns]):
                payload, n = html.encode(), n + 1
                name = f"<urn:page:{'' if page_id is None else page_id}:{task}-{n}>"
                common = dict(WARC_Record_ID=name, WARC_Date=DATE, WARC_Target_URI=url or "",
                              WARC_Payload_Digest=f"sha1:{digest(payload)}",
                              Content_Type="application/http;msgtype=response")
                if refers is not None:
                    block = _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload)
                    files.write(record(block, WARC_Type="revisit", WARC_Profile=_REVISIT,
                                       WARC_Refers_To=f"<urn:page:{refers}>", **common))
                    continue
                block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
                if len(block) <= segment:
                    files.write(record(block, WARC_Type="response", **common))
                    continue
                files.write(record(block[:segment], WARC_Type="response", WARC_Segment_Number=1, **common))
                for number, at in enumerate(range(segment, len(block), segment), 2):
                    last = {"WARC_Segment_Total_Length": len(block)} if at + segment >= len(block) else {}
                    more.write(record(block[at:at + segment], WARC_Type="continuation",
                                      WARC_Record_ID=f"{name[:-1]}:{number}>", WARC_Segment_Origin_ID=name,
                                      WARC_Segment_Number=number, WARC_Date=DATE, **last))
        files.close()
        more.close()
        yield pa.RecordBatch.from_arrays([pa.array(files.paths + more.paths, pa.string())], names=["path"])

    return stored(plan_records(pages, min_bytes).mapInArrow(run, "path string"))


def _page(name: str) -> int | None:
    """Page of a record id ``<urn:page:PAGE:...>``."""
    number = name.strip("<>").split(":")[2]
    return int(number) if number else None


def _described(headers: dict[str, str], block: bytes, whole: bool) -> tuple:
    """The output row of a record."""
    head, _, body = block.partition(b"\r\n\r\n")
    page, said = _page(headers["WARC-Record-ID"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "revisit":
        size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        return page, size, said, "revisit", _page(headers["WARC-Refers-To"]), True
    try:
        payload = unchunked(body) if b"Transfer-Encoding: chunked" in head else body
    except ValueError:
        payload, whole = body, False
    found = digest(payload)
    return page, len(payload), found, "response", None, whole and found == said


def read(files: DataFrame) -> DataFrame:
    """The pages of the listed archives (columns ``OUT``).

    ``verified``: all segments are there, they have the stated total length, the framing is
    sound and the digest is the stated one.
    """
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.string())), pa.binary()]
    parsed = "origin string, number long, total long, headers array<array<string>>, block binary"
    names = [c.split()[0] for c in parsed.split(", ")]

    def parse(batches):
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_old(path) as source:
                    for headers, block in records(source):
                        first = headers["WARC-Type"] != "continuation"
                        total = headers.get("WARC-Segment-Total-Length")
                        rows.append((headers["WARC-Record-ID"] if first else headers["WARC-Segment-Origin-ID"],
                                     int(headers.get("WARC-Segment-Number", 0)), total and int(total),
                                     [list(h) for h in headers.items()] if first else None, block))
                        size += len(block)
                        if headers["WARC-Type"] == "revisit" or "WARC-Segment-Number" not in headers:
                            # Whole records travel as what they say, without their block.
                            row = _described(headers, block, True)
                            rows[-1] = (*rows[-1][:3], [[None if x is None else str(x) for x in row]], None)
                            size -= len(block)
                        if size > 4 << 20 or len(rows) == 2000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def assemble(batches):
        origin, held = None, []

        def whole():
            """The record of the held segments; without the first one, what is left of its payload."""
            if held and held[0][1] > 1:
                yield _page(origin), None, None, "response", None, False
            elif held:
                numbers = [h[1] for h in held]
                block = b"".join(h[4] for h in held)
                sound = numbers == list(range(1, len(held) + 1)) and held[-1][2] == len(block)
                yield _described(dict(held[0][3]), block, sound)

        for batch in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[1] == 0:
                    page, size, said, kind, refers, sound = row[3][0]
                    out.append((page and int(page), int(size), said, kind, refers and int(refers), sound == "True"))
                    continue
                if row[0] != origin:
                    out += whole()
                    origin, held = row[0], []
                held.append(row)
            yield _out(out)
        yield _out(list(whole()))

    n = max(1, files.count())
    return files.repartition(n).mapInArrow(parse, parsed).repartition("origin") \
        .sortWithinPartitions("origin", "number").mapInArrow(assemble, OUT)


def _out(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [c.split() for c in OUT.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f[1]]) for c, f in zip(columns, fields)],
                                      names=[f[0] for f in fields])


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None, **settings) -> DataFrame:
    """Write the pages as archives and report what reading them back gives."""
    return read(write(pages, folder or new_folder(spark, "warc"), **settings))


#: The same in DuckDB.
SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT html, max(page_id) AS kept FROM p GROUP BY html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((CAST('0x' || substr(sha1(html), 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31)::INT, 1)), '')
        AS payload_digest,
    CASE WHEN page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id <> kept THEN kept END AS refers_to, true AS verified
FROM p JOIN k USING (html)
"""
