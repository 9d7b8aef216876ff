"""WARC archives: written with an index, read back by coalesced byte ranges.

Every task writes its own archive of gzip members, one per record, and returns one index row per
record: archive, offset, length, url, digest. The index is kept as a table, which also fixes which
attempt's archive counts when a task runs twice (names are never reused). Reading takes selected
index rows, sorts them by archive and offset, joins neighbouring records to one byte range up to a
bound, and reads each range once.

Records with equal payloads of ``min_revisit`` bytes or more: that with the smallest id is the
response, the others are revisits that name it and hold its digest and size but not its payload.
Which pages these are is worked out on (id, digest, size) alone; payloads do not shuffle for it
unless the list of revisits is too long to broadcast.

Null html: empty payload. Null url: empty target. Rows that repeat an id with an equal payload are
responses if that id is the smallest, else revisits; a null id counts as the largest. An empty
table writes nothing. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.lookup import lookup_join
from gaugeworks.session import fresh_path, materialise

MIN_REVISIT = 100
BLOCK_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
# Fixed value of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _named(page_id) -> str:
    return f"<urn:x-page:{quote(str(page_id), safe='')}>"


def record(page_id, url: str, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC record, not compressed."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_named(page_id)}",
        f"WARC-Date: {DATE}",
        # Blanks and control characters would end the header.
        "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url),
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    block = http
    if revisit:
        head += [f"WARC-Refers-To: {_named(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of one record; the payload of a revisit is empty."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    named = re.fullmatch(r"<urn:x-page:(.*)>", fields.get("WARC-Refers-To", ""))
    return {
        "record_type": fields["WARC-Type"],
        "url": fields["WARC-Target-URI"],
        "payload": payload,
        "payload_bytes": size,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "refers_to": unquote(named[1]) if named else None,
    }


def _payload(html: str) -> Column:
    return F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")


def revisits(pages: DataFrame, id_col: str, html_col: str, least: int) -> DataFrame:
    """(id, digest, refers_to) of the records that repeat an earlier payload."""
    payload = _payload(html_col)
    narrow = materialise(
        pages.select(
            F.col(id_col).alias("page_id"),
            F.sha2(payload, 256).alias("digest"),
            F.octet_length(payload).cast("bigint").alias("size"),
        ).filter(F.col("size") >= least),
        "digests",
    )
    first = (
        narrow.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    return (
        lookup_join(narrow, first, ["digest"], "inner")
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .groupBy("page_id", "digest")
        .agg(F.first("refers_to").alias("refers_to"))
    )


def write_warc(
    pages: DataFrame,
    path: str | None = None,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit: int = MIN_REVISIT,
) -> DataFrame:
    """Write the archives under ``path`` and return their index, a table of its own."""
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    again = materialise(revisits(pages, id_col, html_col, min_revisit), "revisits")
    again = again.select(
        F.col("page_id").alias("__id"), F.col("digest").alias("__digest"), "refers_to"
    )
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        _payload(html_col).alias("payload"),
    ).withColumn("payload_digest", F.sha2("payload", 256))
    rows = rows.join(
        again,
        F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("payload_digest") == F.col("__digest")),
        "left",
    ).select(
        "page_id", "url", "payload", "payload_digest", "refers_to",
        F.col("__digest").isNotNull().alias("revisit"),
    )
    schema = T.StructType(
        [
            rows.schema["page_id"],
            *T.StructType.fromDDL(
                "url string, payload_digest string, record_type string, archive string,"
                " offset long, length long"
            ).fields,
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{path}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        system, place = _file_system(name)
        stream, offset = None, 0
        for batch in batches:
            lengths, offsets = [], []
            for row in zip(*(batch.column(i) for i in range(6))):
                page_id, url, payload, digest, refers_to, revisit = (x.as_py() for x in row)
                squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                raw = record(page_id, url, payload, digest, refers_to, revisit)
                member = squeeze.compress(raw) + squeeze.flush()
                if stream is None:
                    system.create_dir(place.rpartition("/")[0], recursive=True)
                    stream = system.open_output_stream(place, compression=None)
                stream.write(member)
                offsets.append(offset)
                lengths.append(len(member))
                offset += len(member)
            kinds = ["revisit" if x else "response" for x in batch.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(3),
                    pa.array(kinds, pa.string()),
                    pa.array([name] * batch.num_rows, pa.string()),
                    pa.array(offsets, pa.int64()),
                    pa.array(lengths, pa.int64()),
                ],
                schema.names,
            )
        if stream is not None:
            stream.close()

    return materialise(rows.mapInArrow(run, schema), "warc-index")


def read_warc(
    selected: DataFrame,
    *,
    with_payload: bool = True,
    range_bytes: int = RANGE_BYTES,
    gap_bytes: int = GAP_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The records of selected index rows: page_id, url, type, payload and what it refers to.

    Length and digest of a response are those of the payload that was read; ``intact`` tells
    whether they are the ones in the record's head. A revisit has no payload: its head counts.
    """
    kind = selected.schema["page_id"].dataType
    schema = T.StructType(
        [
            selected.schema["page_id"],
            *T.StructType.fromDDL(
                "url string, record_type string, payload_bytes long, payload_digest string,"
                " refers_to string, intact boolean" + ", payload binary" * with_payload
            ).fields,
        ]
    )
    # A task gets whole blocks of an archive, so neighbours stay together and long ones spread.
    block = F.floor(F.col("offset") / block_bytes)
    placed = selected.select("page_id", "archive", "offset", "length", block.alias("block"))
    # A fixed number of partitions: an index row is small, what it stands for is not.
    n = int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    placed = placed.repartition(n, "archive", "block").sortWithinPartitions("archive", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple = (None, None)
        for batch in batches:
            archives = batch.column(1).to_pylist()
            offsets = batch.column(2).to_pylist()
            lengths = batch.column(3).to_pylist()
            at, n = 0, batch.num_rows
            while at < n:
                start, stop, end = offsets[at], offsets[at] + lengths[at], at + 1
                while (
                    end < n
                    and archives[end] == archives[at]
                    and offsets[end] - stop <= gap_bytes
                    and offsets[end] + lengths[end] - start <= range_bytes
                ):
                    stop = max(stop, offsets[end] + lengths[end])
                    end += 1
                if opened[0] != archives[at]:
                    if opened[1] is not None:
                        opened[1].close()
                    system, place = _file_system(archives[at])
                    opened = (archives[at], system.open_input_file(place))
                raw = opened[1].read_at(stop - start, start)
                found = []
                for i in range(at, end):
                    low = offsets[i] - start
                    got = parse(zlib.decompress(raw[low : low + lengths[i]], 31))
                    got["intact"] = True
                    if got["record_type"] != "revisit":
                        head = got["payload_digest"], got["payload_bytes"]
                        read = hashlib.sha256(got["payload"]).hexdigest(), len(got["payload"])
                        got["payload_digest"], got["payload_bytes"] = read
                        got["intact"] = head == read
                    found.append(got)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[at:end]]
                    + [
                        pa.array([x[f] for x in found], t)
                        for f, t in (
                            ("url", pa.string()),
                            ("record_type", pa.string()),
                            ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()),
                            ("refers_to", pa.string()),
                            ("intact", pa.bool_()),
                            ("payload", pa.binary()),
                        )[: 7 if with_payload else 6]
                    ],
                    schema.names,
                )
                at = end
        if opened[1] is not None:
            opened[1].close()

    read = placed.select("page_id", "archive", "offset", "length").mapInArrow(run, schema)
    return read.withColumn("refers_to", F.col("refers_to").cast(kind))
