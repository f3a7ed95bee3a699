"""Web archives: written as compressed records, read back by a salvaging reader.

Every record is its own gzip member, so a reader can start at any of them. The
reader checks each record (member checksum, header, declared length, digests).
After a failure it looks for the next place where a whole valid record begins, at
a gzip member or a version line, goes on from there, and reports the bytes
between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.session import written

# Fixed values of the archive format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\nContent-Length: {n}\r\n\r\n"
MEMBER = b"\x1f\x8b\x08"
RECORD_START = re.compile(rb"WARC/1\.[01]\r\n")
PIECE = 1 << 12  # bytes of a member unpacked at once
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
# A gzip member without content: it ends each line that Spark's text writer writes.
NOTHING = bytes.fromhex("1f8b080000000000000303000000000000000000")

RECORD = (
    "file string, place long, length long, problem string, record_id string, record_type string, "
    "target_uri string, refers_to string, payload_digest string, payload binary"
)
_SCHEMA = pa.schema(
    [
        ("file", pa.string()), ("place", pa.int64()), ("length", pa.int64()), ("problem", pa.string()),
        ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
        ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ]
)


def _digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _line(text) -> str:
    """A header value: line breaks would end the field."""
    return re.sub(r"[\r\n]+", " ", text)


def record_bytes(record_id, uri, payload, refers_to, date: str, kind: str) -> bytes:
    """One record: a response with its payload, or a revisit that refers to one."""
    payload = payload or b""
    head = HTTP.format(kind=kind, n=len(payload)).encode()
    block = head if refers_to else head + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", f"<{_line(record_id)}>"),
        ("WARC-Date", date),
        *([("WARC-Target-URI", _line(uri))] if uri is not None else []),
        *([("WARC-Refers-To", f"<{_line(refers_to)}>"), ("WARC-Profile", PROFILE)] if refers_to else []),
        ("WARC-Payload-Digest", _digest(payload)),
        ("WARC-Block-Digest", _digest(block)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _members(date: str, kind: str):
    def run(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("record_id", "uri", "payload", "refers_to")]
            out = []
            for row in zip(*columns):
                raw = record_bytes(*(v.as_py() for v in row), date, kind)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                out.append(packer.compress(raw) + packer.flush())
            yield pa.RecordBatch.from_pydict({"member": pa.array(out, pa.binary())})

    return run


def write_archives(
    records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", kind: str = "text/html; charset=utf-8",
    per_file: int = 20_000,
) -> None:
    """Write ``records(record_id, uri, payload, refers_to)`` as archives under ``path``.

    A record with refers_to is a revisit and carries no payload, only its digest.
    Null payloads are empty, null uris are left out, a null record_id becomes the
    id ``urn:none``. Files are made by Spark's own writer and its commit protocol,
    so lost tasks leave no partial archive; ``per_file`` bounds the records of one.
    """
    wanted = records.select(
        F.coalesce(F.col("record_id"), F.lit("urn:none")).alias("record_id"), "uri", "payload", "refers_to"
    )
    members = wanted.mapInArrow(_members(date, kind), "member binary")
    (
        members.select(F.col("member").cast("string").alias("value"))
        .write.option("lineSep", NOTHING.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", per_file)
        .text(path)
    )


def _unpack(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at`` and where it ends; raises if damaged."""
    unpacker, content, end = zlib.decompressobj(31), [], at
    # Fed in pieces: what is left over behind the member is copied, and must not be the rest of the file.
    while end < len(data) and not unpacker.eof:
        content.append(unpacker.decompress(data[end : end + PIECE]))
        end = min(end + PIECE, len(data))
    if not unpacker.eof:
        raise ValueError("member is cut short")
    return b"".join(content), end - len(unpacker.unused_data)


def _parse(raw: bytes, at: int) -> tuple[dict, bytes, int]:
    """Fields, block and end of the record at ``at``; raises if it is not whole."""
    if not re.compile(rb"WARC/1\.[01]\r\n").match(raw, at):
        raise ValueError("no version line")
    end = raw.find(b"\r\n\r\n", at)
    if end < 0:
        raise ValueError("header is cut short")
    fields = {}
    for line in raw[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without a name")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit():
        raise ValueError("no length")
    start = end + 4
    stop = start + int(fields["content-length"])
    block = raw[start:stop]
    if raw[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("block does not end where declared")
    declared = fields.get("warc-block-digest")
    if declared and declared.startswith("sha1:") and declared != _digest(block):
        raise ValueError("block digest differs")
    return fields, block, stop + 4


def _inside(raw: bytes) -> Iterator[tuple[int, int, str | None, dict, bytes]]:
    """(begin, end, problem, fields, block) of plain records and, with a problem, of gaps."""
    at, gap, why = 0, None, ""
    while at < len(raw):
        try:
            fields, block, end = _parse(raw, at)
        except ValueError as error:
            if gap is None:
                gap, why = at, str(error)
            nxt = RECORD_START.search(raw, at + 1)
            at = nxt.start() if nxt else len(raw)
            continue
        if gap is not None:
            yield gap, at, why, {}, b""
            gap = None
        yield at, end, None, fields, block
        at = end
    if gap is not None:
        yield gap, len(raw), why, {}, b""


def _one(data: bytes, at: int) -> tuple[list, int]:
    """(length, problem, fields, block) of the member, or the one plain record, at ``at``, and its end.

    A gap inside a member has its place in the content in its problem. Raises if no
    record is whole.
    """
    if data[at : at + 3] != MEMBER:
        fields, block, end = _parse(data, at)
        return [(end - at, None, fields, block)], end
    raw, end = _unpack(data, at)
    parts = list(_inside(raw))
    if parts and all(why for _, _, why, _, _ in parts):
        raise ValueError(parts[0][2])
    found = []
    for a, b, why, fields, block in parts:
        found.append((b - a, f"{why}, at {a} of the member's content", {}, b"") if why else (end - at, None, fields, block))
    return found, end


def _rest(data: bytes, at: int) -> bytes:
    """The content of the damaged member at ``at`` as far as it unpacks."""
    unpacker, out = zlib.decompressobj(31), []
    for begin in range(at, len(data), PIECE):
        before = unpacker.copy()
        try:
            out.append(unpacker.decompress(data[begin : begin + PIECE]))
        except zlib.error:
            try:
                for k in range(begin, begin + PIECE):
                    out.append(before.decompress(data[k : k + 1]))
            except zlib.error:
                break
        if unpacker.eof:
            break
    return b"".join(out)


def _damaged(data: bytes, at: int, why: str) -> Iterator[tuple[int, int, str, dict, bytes]]:
    """Records of the damaged member at ``at`` whose block digest agrees, with a problem.

    The member's checksum cannot vouch for them. Content that was stored as it is
    shows its version lines in the file, where the search finds them.
    """
    if data[at : at + 3] != MEMBER:
        return
    raw = _rest(data, at)
    stored = RECORD_START.search(data, at) is not None
    for a, b, problem, fields, block in _inside(raw):
        checked = fields.get("warc-block-digest", "").startswith("sha1:")
        if not problem and checked and not (stored and data.find(raw[a:b], at) >= 0):
            yield at, 0, f"in a damaged member ({why}), at {a} of its content", fields, block


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, dict, bytes]]:
    """(place, length, problem, fields, block) of records and, with a problem, of gaps."""
    at, gap, why = 0, None, ""
    while at < len(data):
        try:
            found, end = _one(data, at)
        except (ValueError, zlib.error) as error:
            if gap is None:
                gap, why = at, str(error)
            yield from _damaged(data, at, str(error))
            nxt = START.search(data, at + 1)
            at = nxt.start() if nxt else len(data)
            continue
        if gap is not None:
            yield gap, at - gap, why, {}, b""
            gap = None
        for length, problem, fields, block in found:
            yield at, length, problem, fields, block
        at = end
    if gap is not None:
        yield gap, len(data) - gap, why, {}, b""


def _plain(uri: str | None) -> str | None:
    return uri.strip("<>") if uri else None


def _payload(fields: dict, block: bytes) -> bytes:
    if fields.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _hex(digest: str | None) -> str | None:
    if not digest or not digest.startswith("sha1:"):
        return None
    try:
        return base64.b32decode(digest[5:]).hex()
    except ValueError:
        return None


def _read(batches):
    for batch in batches:
        for file, data in zip(batch.column("path"), batch.column("content")):
            file, out, room = file.as_py(), [], 0
            for place, length, problem, fields, block in salvage(data.as_py()):
                kind = fields.get("warc-type")
                payload = None if not fields or kind == "revisit" else _payload(fields, block)
                digest = _hex(fields.get("warc-payload-digest"))
                if payload is not None and not problem and digest and digest != hashlib.sha1(payload).hexdigest():
                    problem = "payload digest differs"
                out.append(
                    (file, place, length, problem, _plain(fields.get("warc-record-id")), kind,
                     fields.get("warc-target-uri"), _plain(fields.get("warc-refers-to")), digest, payload)
                )
                room += len(payload or b"")
                if room > 4 << 20 or len(out) > 5000:
                    yield _batch(out)
                    out, room = [], 0
            if out:
                yield _batch(out)


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records under ``path`` and, with ``problem`` set, what could not be read.

    A row with a problem and no record_type is a gap: ``length`` bytes from
    ``place`` of ``file`` are quarantined; for a gap inside a whole member the
    length counts bytes of its content and the problem tells where they are. A
    record whose payload digest differs is returned with that problem, and so are
    records of a damaged member whose block digest agrees, with length 0, as the
    gap covers their bytes. Compressed and plain records may be mixed. A file
    is read whole by one task, so files must fit an executor's memory.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read, RECORD)


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Add refers_to to ``pages(id, payload)``: null for responses.

    Of rows with equal payloads of at least ``least`` bytes, the one with the
    largest id is the response and the others refer to it; equal largest ids are
    all responses, and a null id never is one's largest. Other columns pass through,
    whatever their names; one called refers_to is replaced. Digests are grouped with
    partial aggregates and only those that repeat are joined back.
    """
    size = F.coalesce(F.octet_length("payload"), F.lit(0))
    keyed = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != "refers_to"]).alias("row"),
        F.when(size >= least, F.sha1("payload")).alias("digest"),
    )
    repeated = (
        keyed.where("digest is not null")
        .groupBy("digest")
        .agg(F.max("row.id").alias("first_id"), F.count("*").alias("c"))
        .where("c > 1 and first_id is not null")
        .select("digest", "first_id")
    )
    first = F.when(~F.col("first_id").eqNullSafe(F.col("row.id")), F.col("first_id"))
    return keyed.join(repeated, "digest", "left").select("row.*", first.alias("refers_to"))


def resolved(records: DataFrame) -> DataFrame:
    """Records with payload_bytes: a revisit has those of the response it refers to.

    That response has the id and the payload digest of the revisit, so records that
    repeat an id with other payloads do not mix. A digest that the reader checked is
    taken as it is; a payload with a problem, or without a digest, is hashed here.
    """
    checked = F.when(F.col("problem").isNull(), F.col("payload_digest"))
    plain = records.select(
        "record_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("own_bytes"),
        F.coalesce(checked, F.sha1("payload"), F.col("payload_digest")).alias("payload_digest"),
    )
    plain = written(plain, "records")
    sizes = (
        plain.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_to"), "payload_digest")
        .agg(F.max("own_bytes").alias("seen_bytes"))
    )
    return plain.join(sizes, ["refers_to", "payload_digest"], "left").select(
        "record_id", "record_type", "refers_to", "payload_digest",
        F.coalesce("own_bytes", "seen_bytes").alias("payload_bytes"),
    )
