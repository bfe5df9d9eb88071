"""WARC archives of web pages: a writer with revisit records, and a sequential reader.

Archives are files of gzip members, one per record. The reader inflates a file
piece by piece, finds each record's block by its content length and checks the
digests, so it holds one piece of input and at most one payload.

Tasks write and read the files through Arrow's file systems, under the shared
folder of the cluster (any scheme that Arrow opens: file, hdfs, s3, gs). A task
names its files anew at each attempt and reports the ones it closed; only files
in that stored report are read, so leftovers of lost tasks do not count.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import fits_broadcast
from ..session import pin, work_path
from .shipping import map_arrow

# Fixed value: payloads below this size are never replaced by a revisit record.
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20
LEVEL = 6
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_BREAK = b"\r\n\r\n"


class DamagedArchive(ValueError):
    """An archive that does not hold whole, valid records."""


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _urn(page_id) -> str:
    return "<urn:page>" if page_id is None else f"<urn:page:{quote(str(page_id), safe='')}>"


def record(page_id, url: str | None, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One record: the HTTP message of a page, or a revisit that carries its header only."""
    block = _HTTP % len(payload) + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", _base32(hashlib.sha1(payload).digest())),
        ("WARC-Block-Digest", _base32(hashlib.sha1(block).digest())),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    if revisit:
        fields += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + _BREAK


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def plan_records(pages: DataFrame) -> DataFrame:
    """Rows of ``pages`` with ``refers_to`` and ``revisit``.

    Of rows with equal payloads of at least ``REVISIT_BYTES`` bytes the one with
    the largest ``page_id`` is the response, also if several rows share that id;
    the others revisit it. Rows whose equals all lack an id stay responses.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select(
        "page_id", "url", "html", F.sha1(body.cast("binary")).alias("_digest"), (F.octet_length(body) >= REVISIT_BYTES).alias("_large")
    )
    groups = (
        keyed.where("_large").groupBy("_digest").agg(F.max("page_id").alias("_response"), F.count(F.lit(1)).alias("_n"))
    )
    groups = pin(groups.where((F.col("_n") > 1) & F.col("_response").isNotNull()).drop("_n"), "warc-equal")
    groups = F.broadcast(groups) if fits_broadcast(groups) else groups
    revisit = F.col("_response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_response"))
    # small payloads are in no group, so a large one with the same digest does not exist
    return keyed.join(groups, "_digest", "left").select(
        "page_id", "url", "html", F.when(revisit, F.col("_response")).alias("refers_to"), revisit.alias("revisit")
    )


def write_archives(pages: DataFrame, folder: str, level: int = LEVEL, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row below ``folder``; returns the stored list of archives (``archive``, ``records``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        out, name, records, size = None, "", 0, 0

        def close():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], ["archive", "records"])

        for batch in batches:
            for page_id, url, html, refers_to, revisit in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    name, records, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                whole = record(page_id, url, (html or "").encode(), refers_to, revisit)
                member = gzip.compress(whole, level, mtime=0)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return pin(map_arrow(plan_records(pages), run, "archive string, records long"), "warc-archives")


def members(source, read_bytes: int = READ_BYTES) -> Iterator[Iterator[bytes]]:
    """Inflated pieces of each gzip member of a stream. A member must be used up before the next is asked for."""
    rest, done = source.read(read_bytes), False

    def inflate() -> Iterator[bytes]:
        nonlocal rest, done
        engine = zlib.decompressobj(wbits=31)
        while not engine.eof:
            if not rest:
                rest = source.read(read_bytes)
                if not rest:
                    raise DamagedArchive("the archive ends inside a record")
            piece = engine.decompress(rest, read_bytes)
            rest = engine.unused_data if engine.eof else engine.unconsumed_tail
            if piece:
                yield piece

    while rest or (rest := source.read(read_bytes)):
        yield inflate()


class Block:
    """Reads a record's bytes by count or up to a mark."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, b""

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        while (at := self.held.find(mark)) < 0:
            if len(self.held) > most:
                raise DamagedArchive("a header does not end")
            self.held += self._more()
        found, self.held = self.held[:at], self.held[at + len(mark) :]
        return found

    def take(self, count: int) -> Iterator[bytes]:
        while count:
            if not self.held:
                self.held = self._more()
            found, self.held = self.held[:count], self.held[count:]
            count -= len(found)
            yield found

    def end(self) -> bytes:
        return self.held + b"".join(self.pieces)

    def _more(self) -> bytes:
        piece = next(self.pieces, b"")
        if not piece:
            raise DamagedArchive("a record is shorter than its content length")
        return piece


def _page(urn: str) -> str | None:
    return unquote(urn.removeprefix("<urn:page:").removesuffix(">")) if urn != "<urn:page>" else None


def read_record(pieces: Iterator[bytes], with_payload: bool) -> dict:
    """One record: its fields, its payload's size and digest as found, and whether the digests hold."""
    block = Block(pieces)
    version, *lines = block.until(_BREAK).split(b"\r\n")
    if version != VERSION:
        raise DamagedArchive(f"not a record: {version[:20]!r}")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    length, revisit = int(fields["Content-Length"]), fields["WARC-Type"] == "revisit"
    head = block.until(_BREAK) + _BREAK
    if len(head) > length:
        raise DamagedArchive("a header is longer than its block")
    whole, payload, kept, size = hashlib.sha1(head), hashlib.sha1(), [], 0
    for piece in block.take(length - len(head)):
        whole.update(piece)
        payload.update(piece)
        size += len(piece)
        if with_payload:
            kept.append(piece)
    if block.end() != _BREAK:
        raise DamagedArchive("a record is longer than its content length")
    stated = fields["WARC-Payload-Digest"]
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "record_type": "revisit" if revisit else "response",
        "refers_to": _page(fields["WARC-Refers-To"]) if revisit else None,
        "payload_bytes": None if revisit else size,
        "payload_digest": base64.b32decode(stated.removeprefix("sha1:")).hex(),
        "verified": _base32(whole.digest()) == fields["WARC-Block-Digest"] and (revisit or _base32(payload.digest()) == stated),
        "payload": b"".join(kept) if with_payload and not revisit else None,
    }


_RECORD = pa.schema(
    [("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("verified", pa.bool_()), ("payload", pa.binary())]
)


def read_archives(archives: DataFrame, folder: str, with_payload: bool = True, id_type: str = "bigint") -> DataFrame:
    """One row per record of the listed archives, in no order. A damaged archive fails the job.

    Every archive is a task of its own. Ids are given as ``id_type``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        for batch in batches:
            for name, records in zip(batch["archive"].to_pylist(), batch["records"].to_pylist(), strict=True):
                found, held, seen = [], 0, 0
                with system.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for pieces in members(source):
                        row = read_record(pieces, with_payload)
                        found.append(row)
                        seen, held = seen + 1, held + len(row["payload"] or b"")
                        if len(found) == 1000 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(found, _RECORD)
                            found, held = [], 0
                if seen != records:
                    raise DamagedArchive(f"{name} has {seen} records instead of {records}")
                yield pa.RecordBatch.from_pylist(found, _RECORD)

    # ranges of one name each; dealing them in turn starts anew for each task that has names, and two meet.
    # A number that is asked for is not reduced when the plan runs
    each = archives.select("archive", "records").repartitionByRange(max(1, archives.count()), "archive")
    found = map_arrow(
        each, run,
        "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, verified boolean, payload binary",
    )
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives, read them back, and give every record the full payload's size.

    A revisit's size is that of the response it refers to, if their digests agree;
    ``verified`` tells whether all digests hold. A null page is empty, a null URL
    has no field, repeated rows give repeated records. Other columns are not
    written. An empty table writes no archive and gives an empty table.
    """
    folder = work_path(spark, "warc")
    kind = pages.schema["page_id"].dataType.simpleString()
    found = read_archives(write_archives(pages, folder), folder, with_payload=False, id_type=kind)
    records = pin(found.drop("payload"), "warc-records")
    revisit = F.col("record_type") == "revisit"
    responses = records.where(~revisit & (F.col("payload_bytes") >= REVISIT_BYTES)).select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("_bytes"), F.col("verified").alias("_good")
    )
    resolved = (
        records.where(revisit)
        .join(responses.distinct(), ["refers_to", "payload_digest"], "left")
        .withColumn("payload_bytes", F.col("_bytes"))
        .withColumn("verified", F.col("verified") & F.coalesce("_good", F.lit(False)))
        .drop("_bytes", "_good")
    )
    return records.where(~revisit).unionByName(resolved)
