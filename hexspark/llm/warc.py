"""ARC to WARC: parse legacy archives from a store and write equivalent WARC archives.

An ARC file starts with a filedesc record whose second line names the version; version 1 header lines
are ``url ip date type length`` and version 2 lines carry ``url ip date type code checksum location
offset filename length``.  Lengths are declared, so bodies may hold anything.  Each record becomes a
WARC record: an identifier derived from its content and place, the 14-digit date as a UTC timestamp, a
type, and digests of its block and, for an HTTP response, of the payload after the HTTP header lines.

Archives are read twice: first for digests, which alone are shuffled to find records of equal payload,
then to be converted where they are.  They are written through Spark's own writer, one archive of bounded
size a row, so any store works and a lost task leaves nothing behind.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexspark.llm import common

#: Records with payloads of fewer bytes are never revisits.
LEAST_SHARED = 100
END = b"\r\n\r\n"
#: An archive is closed when it has so many bytes; a record is never cut.
ARCHIVE_BYTES = 32 << 20
#: Decisions are broadcast up to so many archives; beyond, archives and decisions meet in a shuffle by archive.
BROADCAST_ARCHIVES = 20_000
V1_FIELDS = "URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"


class ArchiveError(ValueError):
    """An archive that breaks its own declared lengths or header lines."""


@dataclass(frozen=True)
class ArcRecord:
    url: str
    ip: str
    date: str
    mime: str
    body: bytes
    code: str = "-"
    #: Why the record could not be read; its body is then the bytes passed over.
    damage: str = ""


def _field(value: str) -> str:
    """ARC header fields hold no white space: it is percent-coded, as is a percent sign; empty is a hyphen."""
    return re.sub(r"[\s%]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value) or "-"


def _unfield(value: str) -> str:
    if value == "-":
        return ""
    raw = re.sub(rb"%([0-9A-Fa-f]{2})", lambda m: bytes([int(m[1], 16)]), value.encode("utf-8", "surrogateescape"))
    return raw.decode("utf-8", "surrogateescape")


def arc_bytes(records: Iterable[ArcRecord], version: int, name: str = "part.arc") -> bytes:
    """An ARC file of the given version, 1 or 2."""
    note = f"{version} 0 hexspark\n{V1_FIELDS if version == 1 else V2_FIELDS}\n".encode()
    first = f"filedesc://{name} 0.0.0.0 20000101000000 text/plain"
    out = [f"{first} {len(note)}\n" if version == 1 else f"{first} 200 - - 0 {name} {len(note)}\n", note, "\n"]
    at = sum(map(len, out))
    for r in records:
        head = f"{_field(r.url)} {_field(r.ip)} {r.date} {_field(r.mime)} "
        head += f"{len(r.body)}\n" if version == 1 else f"{_field(r.code)} - - {at} {name} {len(r.body)}\n"
        out += [head, r.body, "\n"]
        at += len(head.encode("utf-8", "surrogateescape")) + len(r.body) + 1
    return b"".join(x if isinstance(x, bytes) else x.encode("utf-8", "surrogateescape") for x in out)


def _header(line: bytes, fields: int) -> list[str] | None:
    """The fields of an ARC header line, None if it is none.  Only the URL may hold spaces, so the others are read from the right."""
    own = line.decode("utf-8", "surrogateescape").rstrip("\r\n").rsplit(" ", fields - 1)
    return own if line.endswith(b"\n") and len(own) == fields and own[-1].isdecimal() and own[0] else None


def parse_arc(data: bytes | IO[bytes], lenient: bool = False) -> Iterator[ArcRecord]:
    """The records of an ARC file after its filedesc record, one at a time; the version decides how header lines are read.

    What cannot be read raises; with lenient it is a record of its own with its `damage`, and reading goes on at the next line that can
    be a header line, with a date of 14 digits, or ends where the archive does.
    """
    stream = io.BytesIO(data) if isinstance(data, bytes) else data

    def damaged(body: bytes, why: str) -> ArcRecord:
        if not lenient:
            raise ArchiveError(why)
        return ArcRecord("", "", "", "", body, "", why)

    try:
        line = stream.readline()
        if not line:
            return
        first = line.rstrip(b"\r\n").split(b" ")
        note = stream.read(int(first[-1])) if line.startswith(b"filedesc://") and line.endswith(b"\n") and first[-1].isdigit() else b""
        fields = {b"1": 5, b"2": 10}.get(note[:1])
        if fields is None:
            yield damaged(line + note, f"no filedesc record of a known version: {line[:60]!r} {note[:20]!r}")
            fields = 5
        while line := stream.readline():
            if not line.strip(b"\r\n"):  # between records
                continue
            own = _header(line, fields)
            if own is None:
                passed, size = [line], len(line)
                why = f"header line without the {fields} fields of this version: {line[:60]!r}"
                while line := stream.readline():
                    own = _header(line, fields)
                    if own is not None and re.fullmatch(r"\d{14}", own[2]):
                        break
                    passed.append(line)
                    size += len(line)
                    own = None
                    if size >= ARCHIVE_BYTES:  # as much as a worker may hold
                        yield damaged(b"".join(passed), why)
                        passed, size = [], 0
                yield damaged(b"".join(passed), why)
                if own is None:
                    return
            body = stream.read(int(own[-1]))
            if len(body) < int(own[-1]):
                yield damaged(line + body, f"record of {own[-1]} bytes runs over the end of the archive")
                return
            url, ip, date, mime = own[:4]
            yield ArcRecord(_unfield(url), _unfield(ip), date, _unfield(mime), body, _unfield(own[4]) if fields == 10 else "")
    except (EOFError, OSError, zlib.error) as error:  # a compressed file cut off or spoilt
        yield damaged(b"", f"{type(error).__name__}: {error}")


_HEAD_END = re.compile(rb"\r?\n\r?\n")


def payload_at(body: bytes) -> int:
    """Where the payload of a body begins: after the header lines of an HTTP response, which CR and LF or bare LF end, else at once."""
    if not body.startswith(b"HTTP/"):
        return 0
    end = _HEAD_END.search(body)
    return end.end() if end else len(body)


def http_fields(body: bytes) -> dict[str, str]:
    """The HTTP header lines of a body by name in lower case; the white space around a value is not part of it."""
    lines = re.split(r"\r?\n", body[: payload_at(body)].decode("utf-8", "surrogateescape"))[1:]
    return {name.strip().lower(): value.strip() for name, colon, value in (x.partition(":") for x in lines) if colon}


def warc_date(date: str) -> str:
    """A 14-digit ARC date as a WARC timestamp.

    Missing digits are filled with the first moment, and so is everything from the first part on that no date can have (month 13, hour 25);
    without a year it is 1970.
    """
    digits = re.sub(r"\D", "", date)[:14]
    parts = [int(digits[i : i + n]) for i, n in ((0, 4), (4, 2), (6, 2), (8, 2), (10, 2), (12, 2)) if len(digits) >= i + n]
    while parts:
        try:
            return datetime(*(parts + [1, 1, 1][len(parts) :])).strftime("%Y-%m-%dT%H:%M:%SZ").zfill(20)
        except ValueError:
            parts.pop()
    return "1970-01-01T00:00:00Z"


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>"


def _line(value: str) -> str:
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", value)


def warc_bytes(record: ArcRecord, own_id: str, digest: str, refers_to: str | None = None, extra: dict[str, str] | None = None) -> bytes:
    """One WARC record without its final two line ends; digest: of its payload.

    With refers_to, the identifier of the record that holds the same payload, it is a revisit whose block is
    the HTTP header lines alone.
    """
    revisit, http = refers_to is not None, record.body.startswith(b"HTTP/")
    start = payload_at(record.body)
    block = record.body[:start] if revisit else record.body
    head = {
        "WARC-Type": "revisit" if revisit else "response" if http else "resource",
        "WARC-Record-ID": own_id,
        "WARC-Date": warc_date(record.date),
        "WARC-Target-URI": record.url,
        "WARC-IP-Address": record.ip or "0.0.0.0",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "WARC-Identified-Payload-Type": record.mime or "application/octet-stream",
        "Content-Type": "application/http; msgtype=response" if http else record.mime or "application/octet-stream",
        **(extra or {}),
    }
    if record.damage:
        head["X-Damage"] = record.damage
    if revisit:
        head["X-Payload-Bytes"] = str(len(record.body) - start)
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = refers_to
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {_line(v)}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogateescape") + b"\r\n" + block


def parse_warc(data: bytes | IO[bytes], lenient: bool = False) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, by declared lengths; a stream is read record by record.

    What cannot be read raises; with lenient it is a record of its own whose only header, `damage`, says why, and reading goes on
    at the next line that begins a record.
    """
    stream = io.BytesIO(data) if isinstance(data, bytes) else data
    line = b""
    try:
        line = stream.readline()
        while line:
            if not line.strip(b"\r\n"):
                line = stream.readline()
                continue
            why, passed = "", [line]
            head: dict[str, str] = {}
            if line.startswith(b"WARC/"):
                while (line := stream.readline()).strip(b"\r\n"):
                    name, colon, value = line.decode("utf-8", "surrogateescape").rstrip("\r\n").partition(":")
                    passed.append(line)
                    if not colon:
                        why = f"no header line: {line[:60]!r}"
                        break
                    head[name.strip().lower()] = value.strip()
                declared = head.get("content-length", "")
                if not why:
                    block = stream.read(int(declared)) if declared.isdecimal() else b""
                    passed.append(block)
                    end = (stream.readline(), stream.readline()) if declared.isdecimal() else (b"?", b"?")
                    if not declared.isdecimal() or len(block) < int(declared) or any(x.strip(b"\r\n") for x in end):
                        passed += end if declared.isdecimal() else ()
                        why = f"record {head.get('warc-record-id')} does not end where it declares"
            else:
                why = f"no WARC record: {line[:60]!r}"
            if not why:
                yield head, block
                line = stream.readline()
                continue
            if not lenient:
                raise ArchiveError(why)
            size = sum(map(len, passed))
            while (line := stream.readline()) and not line.startswith(b"WARC/1"):
                passed.append(line)
                size += len(line)
                if size >= ARCHIVE_BYTES:  # as much as a worker may hold
                    yield {"damage": why}, b"".join(passed)
                    passed, size = [], 0
            yield {"damage": why}, b"".join(passed)
    except (EOFError, OSError, zlib.error) as error:
        if not lenient:
            raise ArchiveError(f"{type(error).__name__}: {error}") from error
        yield {"damage": f"{type(error).__name__}: {error}"}, b""


def _opened(data: pa.Scalar) -> IO[bytes]:
    """An archive as a stream, decompressed as it is read: memory holds the stored bytes and one record."""
    raw = io.BytesIO(data.as_buffer())
    packed = raw.getbuffer()[:2] == b"\x1f\x8b"
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 16) if packed else raw


def _archives(records: Iterator[bytes], between: bytes) -> Iterator[bytes]:
    """Records joined into archives of about ARCHIVE_BYTES; the writer adds what follows the last one."""
    held, size = [], 0
    for r in records:
        held.append(r)
        size += len(r)
        if size >= ARCHIVE_BYTES:
            yield between.join(held)
            held, size = [], 0
    if held:
        yield between.join(held)


def _write_archives(rows: DataFrame, path: str, end: bytes) -> None:
    """Each row, an archive without its last line end, as a compressed file of its own."""
    writer = rows.select(F.col("archive").cast("string").alias("value")).write.option("lineSep", end.decode())
    writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.option("maxRecordsPerFile", 1).text(path)


def _files(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path).select("path", "content")


def write_arc(pages: DataFrame, path: str) -> None:
    """Write pages (page_id, url, html) as gzip-compressed ARC files of both versions under path.

    A record's body is an HTTP response whose header lines give the page_id, if there is one, and the length
    of the payload, the html in UTF-8 (null: empty).  Pages have neither an address nor a date, so both follow
    from the url.  An archive's version follows from its first record.
    """
    rows = pages.select(F.col("page_id").cast("string"), F.col("url").cast("string"), F.coalesce(F.col("html"), F.lit("")).cast("binary"))

    def record(pid: str | None, url: str | None, payload: bytes) -> ArcRecord:
        seed = zlib.crc32((url or "").encode())
        date = datetime(2024, 1, 1, tzinfo=UTC) + timedelta(seconds=seed % 31_536_000)
        own = "" if pid is None else f"X-Page-ID: {_field(pid)}\r\n"
        head = f"HTTP/1.1 200 OK\r\n{own}Content-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        return ArcRecord(url or "", f"192.0.2.{seed % 254 + 1}", date.strftime("%Y%m%d%H%M%S"), "text/html", head.encode() + payload, "200")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def archive(held: list[ArcRecord]) -> pa.RecordBatch:
            made = arc_bytes(held, 1 + zlib.crc32(held[0].url.encode()) % 2)
            return pa.RecordBatch.from_arrays([pa.array([made[:-1]], pa.binary())], ["archive"])

        held, size = [], 0
        for batch in batches:
            for pid, url, payload in zip(*batch.to_pydict().values(), strict=True):
                held.append(record(pid, url, payload))
                size += len(held[-1].body)
                if size >= ARCHIVE_BYTES:
                    yield archive(held)
                    held, size = [], 0
        if held:
            yield archive(held)

    _write_archives(rows.mapInArrow(common.freed(run), "archive binary"), path, b"\n")


def _place_id(record: ArcRecord, digest: str, place: int) -> str:
    """A record's identifier, from its content and place."""
    return record_id(f"{record.url} {record.date} {http_fields(record.body).get('x-page-id', '')} {digest} {place}")


def _digest(record: ArcRecord) -> str:
    return hashlib.sha256(memoryview(record.body)[payload_at(record.body) :]).hexdigest()


def describe_arc(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """A row per ARC record under path: archive, place in it, url, ip, date, mime, page_id (text, of the HTTP header), payload_bytes, digest, record_id, damage.

    Damaged records and archives are rows too, with what is wrong as damage (else empty) and the bytes passed over as payload.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("archive", "place", "url", "ip", "date", "mime", "page_id", "payload_bytes", "digest", "record_id", "damage")
        kinds = (pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), *[pa.string()] * 3)
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for place, r in enumerate(parse_arc(_opened(data), lenient=True)):
                    digest, pid = _digest(r), http_fields(r.body).get("x-page-id")
                    rows.append((
                        name, place, r.url, r.ip, r.date, r.mime, None if pid is None else _unfield(pid), len(r.body) - payload_at(r.body), digest,
                        _place_id(r, digest, place), r.damage,
                    ))
                cols = zip(*rows, strict=True) if rows else ([],) * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], list(names))

    schema = "archive string, place long, url string, ip string, date string, mime string, page_id string, payload_bytes long, digest string, record_id string, damage string"
    return _files(spark, path, pattern).mapInArrow(common.freed(run), schema)


def revisits(described: DataFrame, kind: str = "long") -> DataFrame:
    """archive, place, first (a page_id as text) and first_id of every record that revisits another.

    Of records with equal payloads of 100 bytes or more one is kept, that with the smallest page_id, those without one last
    and of equals the first by archive and place; all others revisit it.  Damaged records stay as they are.  Digests and numbers
    alone are shuffled, and only digests that several records have are joined.
    """
    pid = F.col("page_id").cast(kind)
    shared = described.where((F.col("payload_bytes") >= LEAST_SHARED) & (F.col("damage") == ""))
    least = shared.groupBy(F.col("digest").alias("_d")).agg(F.min(F.struct(pid.isNull().alias("none"), pid.alias("pid"), "archive", "place", "record_id")).alias("_first"), F.count("*").alias("_n"))
    least = common.stored(least.where("_n > 1").select("_d", "_first"), "firsts")
    found = shared.join(least, F.col("digest") == F.col("_d")).where((F.col("archive") != F.col("_first.archive")) | (F.col("place") != F.col("_first.place")))
    return found.select("archive", "place", F.col("_first.pid").cast("string").alias("first"), F.col("_first.record_id").alias("first_id"))


def convert(spark: SparkSession, arc_path: str, warc_path: str, kind: str = "long", pattern: str | None = None) -> None:
    """Write a WARC record for every record of the ARC files under arc_path, compressed or not, to archives under warc_path.

    Url, address, date, type, code and body come from the archive; a damaged record becomes a resource of the bytes passed
    over, with the damage in its header lines.  kind: the type of page_ids, which tells which one is smallest.
    """
    described = common.stored(describe_arc(spark, arc_path, pattern).select("archive", "place", "page_id", "payload_bytes", "digest", "record_id", "damage"), "described")
    by_archive = revisits(described, kind).groupBy(F.col("archive").alias("_a")).agg(F.collect_list(F.struct("place", "first", "first_id")).alias("again"))
    by_archive = common.stored(by_archive, "revisits")  # a row holds no more than an archive's records
    few = by_archive.count() <= BROADCAST_ARCHIVES
    files = _files(spark, arc_path, pattern)
    joined = files.join(F.broadcast(by_archive) if few else by_archive, F.col("path") == F.col("_a"), "left").select("content", "again")

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            for data, again in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                of = {x["place"]: (x["first"], x["first_id"]) for x in again or ()}
                for place, r in enumerate(parse_arc(_opened(data), lenient=True)):
                    digest, (first, first_id) = _digest(r), of.get(place, (None, None))
                    yield warc_bytes(r, _place_id(r, digest, place), digest, first_id, {} if first is None else {"X-Refers-To-Page": _field(first)})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for archive in _archives(records(batches), END):
            yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], ["archive"])

    _write_archives(joined.mapInArrow(common.freed(run), "archive binary"), warc_path, END)


def _checked(head: dict[str, str], block: bytes) -> tuple[str | None, int | None, str | None]:
    """The payload's digest and length, and what is wrong with the digests that are declared as SHA-256."""

    def declared(name: str) -> str | None:
        label, _, value = head.get(name, "").rpartition(":")
        return value.lower() if label.lower() == "sha256" and re.fullmatch("[0-9A-Fa-f]{64}", value) else None

    start, revisit = payload_at(block), head.get("warc-type") == "revisit"
    own = None if revisit else hashlib.sha256(memoryview(block)[start:]).hexdigest()
    payload, whole = declared("warc-payload-digest"), declared("warc-block-digest")
    if whole is not None and hashlib.sha256(block).hexdigest() != whole:
        return own, len(block) - start, "the block does not have the digest it declares"
    if own is not None and payload is not None and own != payload:
        return own, len(block) - start, "the payload does not have the digest it declares"
    if not revisit:
        return own, len(block) - start, None
    said = head.get("x-payload-bytes") or http_fields(block).get("content-length", "")
    return payload, int(said) if said.isdecimal() else None, None


def read_archives(spark: SparkSession, path: str, kind: str = "long", pattern: str | None = None) -> DataFrame:
    """A row per WARC record under path, read by declared lengths; digests of blocks and payloads are checked.

    Fields that a record lacks are null, as is the payload length of a revisit that neither says it nor has a Content-Length.  Records
    that cannot be read or fail their digests are rows with what is wrong as damage (else null).
    """
    names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "warc_date", "ip", "damage")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "payload_bytes" else pa.string()) for c, n in zip(zip(*rows, strict=True), names, strict=True)], list(names))

        for batch in batches:
            for data in batch.column(1):
                rows = []
                for head, block in parse_warc(_opened(data), lenient=True):
                    digest, size, wrong = _checked(head, block)
                    revisit, http = head.get("warc-type") == "revisit", http_fields(block)
                    pid, first = http.get("x-page-id"), head.get("x-refers-to-page")
                    rows.append((
                        None if pid is None else _unfield(pid), head.get("warc-target-uri"), size, digest, head.get("warc-type"), _unfield(first) if revisit and first is not None else None,
                        head.get("warc-record-id"), head.get("warc-date"), head.get("warc-ip-address"), head.get("damage") or head.get("x-damage") or wrong,
                    ))
                    if len(rows) >= 5000:
                        yield flush(rows)
                        rows = []
                if rows:
                    yield flush(rows)

    schema = ", ".join(f"{n} {'long' if n == 'payload_bytes' else 'string'}" for n in names)
    out = _files(spark, path, pattern).mapInArrow(common.freed(run), schema)
    return out.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages (page_id of any type, url, html; other columns are not read) as ARC files to the shared folder, convert them to WARC, and read that back.

    Null pages are pages of an empty payload; of rows equal in payload one is a response, also of those equal in page_id or
    without one, which come last; pages of any length are one record; an empty table gives no rows.
    """
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType.simpleString()
    legacy, path = common.new_path(spark, "arc"), common.new_path(spark, "warc")
    write_arc(pages, legacy)
    convert(spark, legacy, path, kind)
    return read_archives(spark, path, kind)
