"""WARC archives: a writer with revisit records and a salvage reader.

The writer puts one record a page into archives of gzip members, one member a record. Of records with
equal payloads of at least ``MIN_REVISIT`` bytes the one with the largest page_id is the response;
the others are revisits that name it. Who is the response is found on narrow rows: digests are
reduced by (digest, salt) and then by digest, so a payload that a third of all pages share never
meets in one task, and the compressed records are shuffled once. Each task streams its records to a
file of its own name in the shared folder; only files of successful tasks are in the manifest, so
what a lost executor left behind is never read.

The salvage reader takes archives as gzip members, of one record or many, or plain records. A record
counts when its version line and headers parse, its Content-Length fits, for responses the payload's
SHA-1 agrees with its header and, in a member, another record's version line or the member's end with the right
checksum follows. After a failed check it searches for the next version line in the inflated bytes, or the
next valid member (gzip magic) or version line in the archive, goes on from there, and logs the bytes
between as a quarantined gap. A gap inside a member that has good records is logged with the archive bytes
of the member, and its inflated bytes in the reason; the records before a damaged end count, but the last.
Members are inflated in pieces: memory is bounded by the largest record, not the archive or the member.

Defined cases: a null html is an empty payload; a null page_id is written without a page header, read
back as null, always a response and never named by a revisit; rows with the same page_id and payload as the
response are responses too; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipwright.llm.common import shared_path, stage

MIN_REVISIT = 1000
ARCHIVE_BYTES = 64 << 20      # compressed; a task starts a new archive beyond it
SALTS = 64
READ_BYTES = 1 << 20
MAX_RECORD = 1 << 31          # bytes of a block or of headers: what a binary value can hold, so only a damaged length is larger
TASK_BYTES = 128 << 20        # archives a reading task gets, about
VERSION = b"WARC/1."
GZIP = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_MARK = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")

RECORDS = ("path string, at long, record_type string, page_id long, url string, payload_digest string, payload_bytes long, "
           "refers_to long, payload binary")
GAPS = "path string, gap_start long, gap_end long, reason string"


# ------------------------------------------------------------------ records
def record_bytes(page_id, url, digest: str, length: int, payload: bytes | None = None, refers_to=None) -> bytes:
    """One record: a response with its payload, or (without one) a revisit that names the response."""
    kind = "response" if payload is not None else "revisit"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload or b"")
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {length}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", "", url))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if payload is None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"X-Refers-To-Page: {refers_to}")
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 4) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class BadRecord(ValueError):
    """A failed check; the message is the reason in the quarantine log."""


class More(Exception):
    """The bytes at hand end inside a record."""


def parse_record(data: bytes | bytearray, at: int = 0, max_record: int = MAX_RECORD) -> tuple[dict, int]:
    """(record, end) of the plain record that begins at ``at``; raises BadRecord or More."""
    if not data.startswith(VERSION, at):
        raise More if VERSION.startswith(bytes(data[at:at + len(VERSION)])) else BadRecord("no version line")
    end = data.find(b"\r\n\r\n", at)
    if (len(data) if end < 0 else end) - at > max_record:
        raise BadRecord("headers don't end")
    if end < 0:
        raise More
    headers = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise BadRecord("header line without a colon")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    try:
        length = int(headers["content-length"])
        kind = headers["warc-type"]
    except (KeyError, ValueError):
        raise BadRecord("no Content-Length or WARC-Type") from None
    if length < 0 or length > max_record:
        raise BadRecord("Content-Length out of range")
    stop = end + 4 + length
    if len(data) < stop + 4:
        raise More
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise BadRecord("record doesn't end at its Content-Length")
    block = bytes(data[end + 4:stop])
    if headers.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    else:
        payload = block
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:").lower()
    if kind != "revisit" and re.fullmatch("[0-9a-f]{40}", digest) and hashlib.sha1(payload).hexdigest() != digest:
        raise BadRecord("payload digest differs")

    def number(name):
        try:
            return int(headers[name])
        except (KeyError, ValueError):
            return None

    return {"record_type": kind, "page_id": number("x-page-id"), "url": headers.get("warc-target-uri"),
            "payload_digest": digest or None,
            "payload_bytes": number("x-payload-length") if kind == "revisit" else len(payload),
            "refers_to": number("x-refers-to-page"), "payload": None if kind == "revisit" else payload}, stop + 4


class _Member:
    """Records of one gzip member, inflated in pieces."""

    def __init__(self, max_record: int = MAX_RECORD):
        self.max_record = max_record
        self.z = zlib.decompressobj(31)
        self.plain, self.base, self.at = bytearray(), 0, 0       # plain[0] stands at inflated offset base
        self.held = None                                 # a good record that nothing vouches for yet
        self.held_at = 0
        self.gap_from, self.reason = None, ""
        self.gaps: list[tuple[int, int, str]] = []

    def inflate(self, piece: bytes) -> tuple[int, str | None]:
        """(bytes taken, error or None); what inflates before an error is kept."""
        before = self.z.copy()
        try:
            self.plain += self.z.decompress(piece)
            return len(piece) - len(self.z.unused_data), None
        except zlib.error as e:
            self.z, error = before, f"member: {str(e)[:60]}"
        for i in range(len(piece)):                      # up to the byte that fails
            try:
                self.plain += self.z.decompress(piece[i:i + 1])
            except zlib.error:
                return i, error
        return len(piece), error

    def _bad(self, reason: str) -> None:
        if self.gap_from is None:
            self.gap_from, self.reason = self.base + self.at, reason

    def records(self, ended: bool) -> Iterator[dict]:
        """Records that count by now; ``ended``: nothing more will inflate."""
        while True:
            if self.gap_from is not None:                # look for the next version line
                hit = _VERSION_LINE.search(self.plain, self.at)
                if not hit:
                    self.at = max(self.at, len(self.plain) - (0 if ended else 16))
                    break
                self.at = hit.start()
            elif self.at >= len(self.plain):
                break
            try:
                record, end = parse_record(self.plain, self.at, self.max_record)
            except More:
                if not ended:
                    break
                self._bad("ends inside a record")
                self.at += 1
                continue
            except BadRecord as e:
                self._bad(str(e))
                self.at += 1
                continue
            if self.gap_from is not None:
                self.gaps.append((self.gap_from, self.base + self.at, self.reason))
                self.gap_from = None
            if self.held is not None:
                yield self.held
            self.held, self.held_at, self.at = record, self.base + self.at, end
        if self.at > READ_BYTES:
            del self.plain[:self.at]
            self.base, self.at = self.base + self.at, 0

    def close(self, error: str | None) -> Iterator[dict]:
        """The last records; after an error the last good one goes with the damage."""
        yield from self.records(True)
        end = self.base + len(self.plain)
        if error is not None:
            lost = [x for x in (self.gap_from, self.held_at if self.held is not None else None) if x is not None]
            self.gaps.append((min(lost, default=end), end, error))
            return
        if self.gap_from is not None:
            self.gaps.append((self.gap_from, end, self.reason))
        if self.held is not None:
            yield self.held


def salvage(read, read_bytes: int = READ_BYTES, max_record: int = MAX_RECORD) -> Iterator[tuple[str, int, object]]:
    """("record", offset, record) and ("gap", start, (end, reason)) of an archive.

    ``read(n)`` gives the next bytes, none at the end. Offsets count archive bytes, of a record in a member the
    member's; a gap holds everything between the last good record and the next one.
    """
    data, base, done = b"", 0, False         # data[0] stands at archive offset base
    gap_from, reason = None, ""
    at = 0
    floor = 0                                # version lines before this archive offset lie in a member that was read

    def fill() -> bool:
        nonlocal data, done
        if done:
            return False
        more = read(read_bytes)
        done = not more
        data += more
        return not done

    while True:
        if at > 4 * read_bytes:              # let go of what is behind
            data, base, at = data[at:], base + at, 0
        if len(data) - at < 16 and fill():
            continue
        if at >= len(data):
            break
        start = at + 1                       # where to search on after a failed check
        if data.startswith(GZIP, at):
            member, member_at, pos, good, error = _Member(max_record), base + at, at, 0, None
            resume = base + start
            while not member.z.eof and error is None:
                if pos >= len(data) and not fill():
                    error = "ends inside a record"
                    break
                begin = base + pos
                taken, error = member.inflate(data[pos:pos + (1 << 16)])
                pos += taken
                for record in member.records(False):
                    if gap_from is not None:
                        yield "gap", gap_from, (member_at, reason)
                        gap_from = None
                    yield "record", member_at, record
                    good, resume = good + 1, max(resume, begin)
                if good and resume - base > 4 * READ_BYTES:
                    data, base, pos = data[resume - base:], resume, pos - (resume - base)
            for record in member.close(error):
                if gap_from is not None:
                    yield "gap", gap_from, (member_at, reason)
                    gap_from = None
                yield "record", member_at, record
                good += 1
            if good or (error is None and not member.gaps):
                if gap_from is not None:
                    yield "gap", gap_from, (member_at, reason)
                    gap_from = None
                lost = [f"member bytes {a}-{b}: {why}" for a, b, why in member.gaps]
                if error is None:
                    for why in lost:
                        yield "gap", member_at, (base + pos, why)
                    at = pos
                    continue
                gap_from, reason = member_at, "; ".join(lost)
                start, floor = max(0, resume - base), base + pos
                at = start - 1
            else:
                error = member.gaps[0][2]
                at = start - 1
        else:
            try:
                record, end = parse_record(data, at, max_record)
            except More:
                if fill():
                    read_bytes = min(max(READ_BYTES, len(data)), 64 << 20)   # a large record: read on in growing steps
                    continue
                error = "ends inside a record"
            except BadRecord as e:
                error = str(e)
            else:
                if gap_from is not None:
                    yield "gap", gap_from, (base + at, reason)
                    gap_from = None
                yield "record", base + at, record
                at = end
                continue
        if gap_from is None:
            gap_from, reason = base + at, error
        # the next place that may begin a member or a record
        while True:
            hit = _MARK.search(data, start)
            if hit and base + hit.start() < floor and not hit[0].startswith(GZIP):
                start = hit.end()
                continue
            if hit:
                break
            cut = max(start, len(data) - 16)
            data, base, start = data[cut:], base + cut, 0
            if not fill():
                break
        at = hit.start() if hit else len(data)
    if gap_from is not None:
        yield "gap", gap_from, (base + len(data), reason)


# ------------------------------------------------------------------ writing
def _filesystem(path: str):
    """(filesystem, path in it) of a shared folder: a mounted path, file:, hdfs:, s3:, gs:, ..."""
    from pyarrow import fs
    if path.startswith("file:") or ":/" not in path:
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def _roles(pages: DataFrame) -> DataFrame:
    """(digest, salt) -> response page_id of payloads that several pages share; salted, so no digest is hot."""
    by_salt = pages.filter(F.col("n") >= MIN_REVISIT).groupBy("digest", "n", "salt").agg(F.max("page_id").alias("top"), F.count("*").alias("c"))
    by_salt = stage(by_salt, "warcdigests")
    best = by_salt.groupBy("digest", "n").agg(F.max("top").alias("answer"), F.sum("c").alias("c")).filter("c > 1").drop("c")
    return by_salt.join(best, ["digest", "n"]).select("digest", "n", "salt", "answer")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record for each page; returns the manifest (path, records, bytes) of the archives."""
    base = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    base = base.withColumns({"digest": F.unhex(F.sha1("payload")), "n": F.octet_length("payload").cast("long"),
                             "salt": F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")})
    salted = base.filter(F.col("page_id").isNotNull()).drop("payload", "url")
    roles = stage(_roles(salted), "warcroles")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Response records, compressed before the shuffle (a revisit takes its target from the join)."""
        for batch in batches:
            rows, held = [], 0
            for row in batch.to_pylist():
                payload = row.pop("payload")
                row["member"] = gzip_member(record_bytes(row["page_id"], row["url"], row["digest"].hex(), row["n"], payload))
                rows.append(row)
                held += len(row["member"])
                if held >= _OUT_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, _PACKED)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _PACKED)

    packed = base.mapInArrow(members, _PACKED_DDL)
    joined = packed.join(roles, ["digest", "n", "salt"], "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _filesystem(folder)
        partition, out, done = TaskContext.get().partitionId(), None, []

        def close():
            out.close()
            done.append((f"{folder}/{name}", count, size))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, count, size = f"part-{partition:06d}-{len(done):04d}-{uuid.uuid4().hex[:12]}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                answer, member = row["answer"], row["member"]
                if answer is not None and row["page_id"] is not None and row["page_id"] != answer:
                    member = gzip_member(record_bytes(row["page_id"], row["url"], row["digest"].hex(), row["n"], None, answer))
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["path", "records", "bytes"])

    store, root = _filesystem(folder)
    store.create_dir(root, recursive=True)
    return stage(joined.mapInArrow(write, "path string, records long, bytes long"), "warcmanifest")


_PACKED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.binary()), ("n", pa.int64()), ("salt", pa.int32()),
                     ("member", pa.binary())])
_PACKED_DDL = "page_id long, url string, digest binary, n long, salt int, member binary"


# ------------------------------------------------------------------ reading
_RECORD_FIELDS = ("record_type", "page_id", "url", "payload_digest", "payload_bytes", "refers_to", "payload")
_RECORD_SCHEMA = pa.schema([("path", pa.string()), ("at", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()),
                            ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                            ("refers_to", pa.int64()), ("payload", pa.binary())])
_GAP_SCHEMA = pa.schema([("path", pa.string()), ("gap_start", pa.int64()), ("gap_end", pa.int64()), ("reason", pa.string())])
_OUT_BYTES = 8 << 20


def _emit(opened, what: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    """Batches of the records, or of the gaps, of (path, read function) pairs."""
    rows, held, schema = [], 0, _RECORD_SCHEMA if what == "record" else _GAP_SCHEMA
    for path, read in opened:
        for kind, at, found in salvage(read):
            if kind != what:
                continue
            if kind == "gap":
                rows.append({"path": path, "gap_start": at, "gap_end": found[0], "reason": found[1]})
            else:
                rows.append({"path": path, "at": at} | (found if payloads else found | {"payload": None}))
                held += len(found["payload"] or b"")
            if held >= _OUT_BYTES or len(rows) >= 5000:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def _from_manifest(what: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def opened():
            for batch in batches:
                for path in batch.column(0).to_pylist():
                    store, inside = _filesystem(path)
                    with store.open_input_stream(inside, compression=None) as stream:
                        yield path, stream.read
        yield from _emit(opened(), what, payloads)
    return run


def _spread(manifest: DataFrame) -> DataFrame:
    """Paths dealt to tasks evenly: a task an archive, as long as that gives no more tasks than their bytes are worth."""
    total = manifest.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    tasks = max(1, min(total.n, max(1000, -(-(total.bytes or 0) // TASK_BYTES))))
    return manifest.select("path").repartitionByRange(tasks, "path")       # a number of its own, which is not coalesced


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the archives a manifest lists, streamed from the shared store; without payloads if not asked for."""
    return _spread(manifest).mapInArrow(_from_manifest("record", payloads), RECORDS)


def quarantined(manifest: DataFrame) -> DataFrame:
    """Byte gaps that the salvage reader skipped, with the reason of the first failed check."""
    return _spread(manifest).mapInArrow(_from_manifest("gap", False), GAPS)


def _from_content(what: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def opened():
            import io
            for batch in batches:
                for row in batch.to_pylist():
                    yield row["path"], io.BytesIO(row["content"]).read
        yield from _emit(opened(), what, payloads)
    return run


def read_files(spark: SparkSession, path: str, payloads: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of archives in a store that only Spark reads; each archive must fit a task (2 GB at most)."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_from_content("record", payloads), RECORDS), files.mapInArrow(_from_content("gap", False), GAPS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages to archives in the shared folder and reads the records back."""
    folder = shared_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), payloads=False)
