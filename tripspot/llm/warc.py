"""WARC archives: writing with revisit records, and a reader that salvages what damage leaves."""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tripspot.session import Scratch

VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER = b"\x1f\x8b\x08"
SEARCH = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
CACHE = 1 << 20
CUT_OFF = "member is cut off"
ONCE = {"warc-type", "warc-record-id", "warc-date", "content-length"}
URI = "warc-target-uri"
HEADER = 1 << 16  # bytes first read of a plain record; a header may be longer
READ = (
    "file string, start long, stop long, problem string, page_id long, record_type string, payload_bytes long,"
    " payload_digest string, refers_to long"
)


class Record(NamedTuple):
    start: int
    stop: int
    headers: dict
    payload: bytes


class Gap(NamedTuple):
    """Bytes that hold no valid record, and the first check that failed there."""

    start: int
    stop: int
    problem: str


class Damaged(Exception):
    """A check failed."""


def header(pairs) -> bytes:
    """Header lines; control characters in a value become spaces, so that no value can end its line."""
    lines = [VERSION]
    for name, value in pairs:
        if value is not None:
            lines.append(f"{name}: {re.sub(r'[\x00-\x1f\x7f]', ' ', str(value))}".encode())
    return b"\r\n".join(lines) + b"\r\n\r\n"


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """A response with its payload, or a revisit that names the response with the same payload."""
    common = [("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Date", date), ("WARC-Target-URI", url),
              ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        kind = [("WARC-Type", "revisit"), ("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        block = b""
    else:
        kind = [("WARC-Type", "response"), ("Content-Type", "application/http;msgtype=response")]
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        block += payload
    last = [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", len(block))]
    return header(kind + common + last) + block + b"\r\n\r\n"


def member(data: bytes, level=4) -> bytes:
    """A gzip member of its own."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Bytes:
    """Random access over a file through one buffer."""

    def __init__(self, stream):
        self.stream, self.base, self.data = stream, 0, b""

    def at(self, start: int, size: int) -> bytes:
        """Up to `size` bytes from `start`; fewer only at the end."""
        if start < self.base or start + size > self.base + len(self.data):
            self.stream.seek(start)
            self.base, self.data = start, self.stream.read(max(size, CACHE))
        return self.data[start - self.base : start - self.base + size]


def _fields(head: bytes) -> tuple[dict, bool]:
    """The fields of whole header lines, and whether a Target-URI ends like a version line; Damaged if a line is none
    of a header."""
    headers, doubtful = {}, False
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        name = name.decode("latin-1").lower()
        if not colon:
            raise Damaged("header line without a colon")
        if line.endswith((b"WARC/1.0", b"WARC/1.1")):
            if name != URI:
                raise Damaged("version line inside a header")
            doubtful = True
        if name in headers and (name in ONCE or doubtful and name == URI):
            raise Damaged("header field twice")  # the rest of a header that was cut off
        headers[name] = value.strip().decode("utf-8", "replace")
    return headers, doubtful


def _parse(raw: bytes, start: int, stop: int, offset=0) -> tuple[Record, int]:
    """The record at `offset` of some bytes and where it ends; Damaged if any check fails."""
    end = raw.find(b"\r\n\r\n", offset)
    if not raw.startswith(b"WARC/1.", offset) or end < 0:
        raise Damaged("no version line" if end >= 0 else "header without an end")
    headers, doubtful = _fields(raw[offset:end])
    if not headers.get("content-length", "").isdecimal():
        raise Damaged("no content length")
    begin = end + 4
    close = begin + int(headers["content-length"])
    if raw[close : close + 4] != b"\r\n\r\n":
        raise Damaged("record does not end where its length says")
    block = raw[begin:close]
    method, _, digest = headers.get("warc-block-digest", "").partition(":")
    if method == "sha256" and hashlib.sha256(block).hexdigest() != digest:
        raise Damaged("block digest differs")
    if doubtful and method != "sha256":
        raise Damaged("version line inside a header")
    if headers.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    return Record(start, stop, headers, block), close + 4


class _Member:
    """The bytes of a gzip member as they are unpacked: those from `base` on are held."""

    def __init__(self, data: _Bytes, start: int):
        self.data, self.at, self.step = data, start, 1 << 12
        self.unpack, self.packed, self.later = zlib.decompressobj(31), b"", b""
        self.held, self.base, self.problem = bytearray(), 0, ""

    def need(self, size: int) -> bool:
        """Hold `size` bytes, if the member has as many."""
        while len(self.held) < size and not self.unpack.eof and not self.problem:
            if not self.packed:
                self.packed, self.later = self.later, b""
            if not self.packed:
                self.packed = self.data.at(self.at, self.step)
                self.at, self.step = self.at + len(self.packed), min(CACHE, self.step * 4)
            if not self.packed:
                self.problem = CUT_OFF
                break
            before = self.unpack.copy()
            try:
                self.held += self.unpack.decompress(self.packed, CACHE)
            except zlib.error as problem:
                half = len(self.packed) // 2
                if half:  # what can be unpacked before the damage is
                    self.unpack, self.packed, self.later = before, self.packed[:half], self.packed[half:] + self.later
                    continue
                self.problem = f"member: {str(problem).partition(': ')[2] or problem}"
                break
            self.packed = self.unpack.unconsumed_tail
        return len(self.held) >= size

    @property
    def stop(self) -> int:
        """Where the member ends in the file, once it has been read."""
        return self.at - len(self.unpack.unused_data) - len(self.later)

    def drop(self, size: int) -> None:
        del self.held[:size]
        self.base += size

    def _more(self) -> bool:
        return self.need(len(self.held) + 1)

    def record(self, start: int) -> tuple[Record, bool]:
        """The record that begins here, and whether its own digest vouches for it; Damaged if any check fails."""
        end = self.held.find(b"\r\n\r\n")
        while end < 0:
            if len(self.held) >= 7 and not self.held.startswith(b"WARC/1."):
                raise Damaged("no version line")
            _fields(bytes(self.held[: max(0, self.held.rfind(b"\r\n"))]))
            before = max(0, len(self.held) - 3)
            if not self._more():
                raise Damaged(self.problem or "header without an end")
            end = self.held.find(b"\r\n\r\n", before)
        length = re.search(rb"\r\n[Cc]ontent-[Ll]ength:\s*(\d{1,15})\r\n", self.held[: end + 2])
        size = end + 4 + int(length[1]) + 4 if length else end + 4
        self.need(size)
        one, used = _parse(bytes(self.held[:size]), start, start)
        self.drop(used)
        return one, "warc-block-digest" in one.headers

    def seek(self) -> None:
        """Go on to the next version line, or to the end of what can be unpacked."""
        self.need(1)
        self.drop(min(1, len(self.held)))
        while True:
            found = self.held.find(b"WARC/1.")
            if found >= 0:
                return self.drop(found)
            self.drop(max(0, len(self.held) - 6))  # one that is not whole yet
            if not self._more():
                return self.drop(len(self.held))


class _End(NamedTuple):
    """Where a member ends, or the problem that it broke off with."""

    stop: int
    problem: str


def _member(data: _Bytes, start: int):
    """The records and gaps inside the gzip member at `start`, and last its _End.

    All but the last have no bytes of the file to their name; the last has the member's. In a member that breaks off or
    fails its checksum a record counts only if its own digest vouches for it; those without one wait for the end. The
    record that a cut ends with does not count: what followed it is not known.
    """
    inside, waiting, last, lost, problem = _Member(data, start), [], None, None, ""
    while inside.need(1):
        at = inside.base
        try:
            one, sure = inside.record(start)
        except Damaged as reason:
            lost, problem = (at, str(reason)) if lost is None else (lost, problem)
            inside.seek()
            continue
        found = [Gap(start, start, f"{problem}, bytes {lost} to {at} of a member")] if lost is not None else []
        lost = None
        for item, certain in (*((g, True) for g in found), (one, sure)):
            if not certain or waiting:
                waiting.append((item, certain))
                continue
            if last is not None:
                yield last
            last = item
    if lost is not None and not inside.problem:
        waiting.append((Gap(start, start, f"{problem}, bytes {lost} to {inside.base} of a member"), True))
    for item, certain in waiting:
        if certain or not inside.problem:
            if last is not None:
                yield last
            last = item
    if last is None or inside.problem:
        if isinstance(last, Record) and not (inside.problem == CUT_OFF and lost is None):
            yield last
        yield _End(start, inside.problem or problem or "empty member")
        return
    yield last._replace(stop=inside.stop)
    yield _End(inside.stop, "")


def _plain(data: _Bytes, start: int) -> tuple[list[Record], int]:
    """The uncompressed record at `start` and where it ends."""
    size, end = HEADER, -1
    while end < 0:
        head = data.at(start, size)
        end = head.find(b"\r\n\r\n")
        if end < 0:
            _fields(head[: max(0, head.rfind(b"\r\n"))])  # no reading on after a line that no header has
            if len(head) < size:
                raise Damaged("header without an end")
            size *= 4
    length = re.search(rb"\r\n[Cc]ontent-[Ll]ength:\s*(\d{1,15})\r\n", head[: end + 2])
    if not length:
        raise Damaged("header without a length")
    size = end + 4 + int(length[1]) + 4
    raw = data.at(start, size)
    if len(raw) < size:
        raise Damaged("record is cut off")
    one, _ = _parse(raw, start, start + size)
    return [one], start + size


def salvage(stream):
    """Records and gaps of an archive in order, from a seekable binary file.

    Each record must pass all checks: the gzip checksum, the version line, the length, the end mark and the block
    digest. After a failed one the next bytes that begin a gzip member or a version line are tried, and so on; what
    lies between is one gap with the first problem. Inside a gzip member, too, reading goes on at the next version line,
    and of a member that breaks off or fails its checksum the records before are kept as far as their own digests vouch
    for them. Memory holds one record at a time, and of a member those that have no digest. Records and gaps together
    cover every byte once.
    """
    data, at, lost, problem, known = _Bytes(stream), 0, None, "", set()
    while data.at(at, 1):
        try:
            if data.at(at, 3) == MEMBER:
                found, broken = _member(data, at), None
                for item in found:
                    if isinstance(item, _End):
                        stop, broken = item
                        break
                    if isinstance(item, Record):
                        known.add(item.headers.get("warc-record-id"))
                    if lost is not None:
                        yield Gap(lost, at, problem)
                        lost = None
                    yield item
                if broken:
                    raise Damaged(broken)
                known.clear()
            elif data.at(at, 7) == b"WARC/1.":
                records, stop = _plain(data, at)
                if lost is not None and records[0].headers.get("warc-record-id") in known:
                    raise Damaged("a record of the broken member again")  # its bytes may lie in it unpacked
                if lost is not None:
                    yield Gap(lost, at, problem)
                    lost = None
                yield from records
            else:
                raise Damaged("no record begins here")
        except Damaged as reason:
            if lost is None:
                lost, problem = at, str(reason)
            at = _next(data, at + 1)
            continue
        at = stop
    if lost is not None:
        yield Gap(lost, at, problem)


def _next(data: _Bytes, start: int) -> int:
    """Where the next gzip member or version line may begin, or the end of the file."""
    while True:
        chunk = data.at(start, CACHE)
        found = SEARCH.search(chunk)
        if found:
            return start + found.start()
        if len(chunk) < CACHE:
            return start + len(chunk)
        start += CACHE - 16  # one that lies across the border


def _page(reference: str):
    number = re.fullmatch(r"<urn:page:(-?\d+)>", reference or "")
    return int(number[1]) if number else None


def _write(batches, folder: str, date: str, file_bytes: int):
    context = TaskContext.get()
    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    out, name, count, size, files = None, "", 0, 0, 0
    done = []
    for batch in batches:
        for page, url, html, digest, refers in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if out is None:
                # Named by attempt: a repeated task writes files of its own, and only committed ones are listed.
                name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{files}.warc.gz"
                out, count, size, files = system.open_output_stream(f"{base}/{name}", compression=None), 0, 0, files + 1
            data = member(record(page, url, (html or "").encode(), digest, refers, date))
            out.write(data)
            count, size = count + 1, size + len(data)
            if size >= file_bytes:
                out.close()
                done.append((f"{folder}/{name}", count, size))
                out = None
    if out is not None:
        out.close()
        done.append((f"{folder}/{name}", count, size))
    yield pa.RecordBatch.from_arrays(
        [pa.array([d[0] for d in done], pa.string()), *(pa.array([d[i] for d in done], pa.int64()) for i in (1, 2))],
        ["file", "records", "bytes"],
    )


def write_archives(
    pages: DataFrame, scratch: Scratch, folder: str, id_col="page_id", url_col="url", html_col="html",
    shared_bytes=100, date="2024-01-01T00:00:00Z", file_bytes=256 << 20,
) -> DataFrame:
    """Write one record per page, each in a gzip member of its own, and return the files: file, records, bytes.

    Of pages with equal payloads of at least `shared_bytes`, the one with the smallest id is the response and the
    others are revisits of it. Only digests that occur more than once are shuffled ahead of the writing; if they are
    few, Spark sends them to the pages, else it splits the join. Tasks write straight to the shared folder under names
    of their attempt, and the list of files is committed by Spark: a lost or repeated task leaves nothing in it.

    A null html is an empty payload. Null ids are never the smallest; equal ids with equal payloads are all
    responses. An empty table gives no files.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    own = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest")
    )
    shared = scratch.store(
        own.filter(F.octet_length("html") >= shared_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null")
        .drop("n"),
        "shared",
    )
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    rows = own.join(shared, "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    write = functools.partial(_write, folder=folder, date=date, file_bytes=file_bytes)
    return scratch.store(rows.mapInArrow(write, "file string, records long, bytes long"), "files")


def _read(batches):
    for batch in batches:
        for path in batch.column("file").to_pylist():
            system, base = fs.FileSystem.from_uri(path)
            rows = []
            with system.open_input_file(base) as stream:
                for found in salvage(stream):
                    if isinstance(found, Gap):
                        rows.append((path, found.start, found.stop, found.problem, None, None, None, None, None))
                    else:
                        h = found.headers
                        kind = h.get("warc-type")
                        response = kind != "revisit"
                        digest = hashlib.sha256(found.payload).hexdigest() if response else h.get("warc-payload-digest", "").partition(":")[2]
                        size = len(found.payload) if response else None
                        rows.append((path, found.start, found.stop, None, _page(h.get("warc-record-id")), kind, size, digest,
                                     _page(h.get("warc-refers-to"))))
                    if len(rows) >= 4096:
                        yield _batch(rows)
                        rows = []
            yield _batch(rows)


def _batch(rows):
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["file", "start", "stop", "problem", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def read_archives(files: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Records and quarantined gaps of the archives named in column `file`, one file to a task.

    Records: file, start, stop, page_id, record_type, payload_bytes, payload_digest, refers_to; a revisit's bytes are
    those of the response it names with the same digest, null if that one was lost. Gaps: file, start, stop, problem.
    """
    tasks = max(1, files.count())
    read = scratch.store(files.select("file").repartition(tasks).mapInArrow(_read, READ), "read")
    gaps = read.filter("problem is not null").select("file", "start", "stop", "problem")
    found = read.filter("problem is null").drop("problem")
    responses = found.filter("record_type <> 'revisit'").groupBy(
        F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest")
    ).agg(F.max("payload_bytes").alias("_bytes"))
    revisits = found.filter("record_type = 'revisit'").join(
        responses, (F.col("refers_to") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest")), "left"
    )
    records = found.filter("record_type <> 'revisit'").unionByName(
        revisits.withColumn("payload_bytes", F.col("_bytes")).drop("_page", "_digest", "_bytes")
    )
    return records, gaps
