"""Pages to WARC archives and back, with segmented records and chunked transfer framing.

Writing. The payload (the page's bytes) of every distinct content is stored once, by the smallest page id;
the others are ``revisit`` records that name it. An HTTP response with a chunked body is cut into
segments: the first is the ``response`` record, the rest are ``continuation`` records with the origin's
identifier and a number, and the last one carries the total length. Tasks write gzip members, a record
each, into files of about ``FILE_BYTES`` with names of their own attempt; a table of the committed
attempts' files says what belongs to the archive, so a lost or repeated task leaves nothing behind that
would be read.

Reading. Files are parsed by tasks, segments grouped by origin, ordered by number and joined; a record
counts only if the numbers run from 1 without a gap and the total length agrees, then the chunked framing
is taken off. Revisits find the length of their payload at the record that they name.

Defined cases: a null or empty page is an empty payload; a null url leaves out the target; rows with a null
page id are written too, and refer to the smallest non-null id with the same payload or, without
one, are responses; repeated rows (same id, same payload) are stored each; an empty table gives no files
and no rows; other columns are ignored. A broken or incomplete record raises an error that names it.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm import arrays
from zonewatch.llm.shared import new_folder, opened, written

FILE_BYTES = 16 << 20
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
SALTS = 16
#: Repeated payloads up to this number (about 40 MB of digests and ids) are broadcast.
BROADCAST_DIGESTS = 500_000
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    out = bytearray()
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        out += b"%x\r\n%b\r\n" % (len(part), part)
    return bytes(out + b"0\r\n\r\n")


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions of a chunk's size and trailers are passed over."""
    out, at = bytearray(), 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return bytes(out)
        part = body[end + 2 : end + 2 + size]
        if len(part) < size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is cut off")
        out += part
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def record(kind: str, name: str, block: bytes, **more: str | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in more.items() if v is not None]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def response(name: str, payload: bytes, segment: int, **fields: str | None) -> Iterator[bytes]:
    """The records of one response, in segments of ``segment`` bytes at most."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    if len(parts) == 1:
        yield record("response", name, block, **fields)
        return
    yield record("response", name, parts[0], WARC_Segment_Number="1", **fields)
    for i, part in enumerate(parts[1:], 2):
        total = str(len(block)) if i == len(parts) else None
        yield record("continuation", f"{name}:{i}", part, WARC_Segment_Origin_ID=f"<{name}>", WARC_Segment_Number=str(i), WARC_Segment_Total_Length=total)


def line(text: str | None) -> str | None:
    """A header's value holds no line ends."""
    return None if text is None else " ".join(text.split())


def planned(pages: DataFrame, page_id: str, html: str, url: str, least: int) -> DataFrame:
    """Pages with ``refers_to``: the id that holds their payload, null for those that hold it themselves."""
    rows = pages.selectExpr(f"cast(`{page_id}` AS long) AS page_id", f"`{url}` AS url", f"cast(coalesce(`{html}`, '') AS binary) AS payload").withColumn("sha", F.sha1("payload"))
    shared = rows.where(F.length("payload") >= least).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    shared = written(shared.drop("n"), "shared-payloads")
    if shared.count() <= BROADCAST_DIGESTS:  # the pages stay where they are
        held = rows.join(F.broadcast(shared), "sha", "left")
    else:  # a payload may belong to a third of all pages: its rows are dealt over the salts
        salted = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        held = rows.join(salted, ["sha", "salt"], "left")
    return held.selectExpr("page_id", "url", "payload", f"if(first <=> page_id OR octet_length(payload) < {least}, NULL, first) AS refers_to")


def write(pages: DataFrame, page_id: str = "page_id", html: str = "html", url: str = "url", least: int = 0, file_bytes: int = FILE_BYTES, segment: int = SEGMENT_BYTES) -> DataFrame:
    """Writes the archive into a new shared folder; returns the table of its files (path, records, bytes)."""
    folder = new_folder(pages.sparkSession, "warc")

    def run(batches):
        task = TaskContext.get()
        stem, number, count = f"part-{task.partitionId():05d}-{task.taskAttemptId()}", 0, 0
        store, inside = opened(folder)
        held, size, records = [], 0, 0

        def closed():
            name = f"{stem}-{number:05d}.warc.gz"
            with store.open_output_stream(f"{inside}/{name}", compression=None) as out:  # else packed again for its name
                out.write(b"".join(held))
            return arrays.batch(path=[f"{folder}/{name}"], records=[records], bytes=[size])

        for batch in batches:
            columns = [batch[c] for c in ("page_id", "url", "payload", "refers_to")]
            for values in zip(*columns, strict=True):
                key, target, payload, first = (v.as_py() for v in values)
                sha = digest(payload)
                fields = {"X_Page_ID": None if key is None else str(key), "WARC_Target_URI": line(target), "WARC_Payload_Digest": f"sha1:{sha}"}
                name = f"urn:page:{key}:{sha}:{stem}.{count}"
                if first is None:
                    parts = response(name, payload, segment, **fields)
                else:
                    parts = [record("revisit", name, b"HTTP/1.1 200 OK\r\n\r\n", WARC_Refers_To=f"<urn:page:{first}:{sha}>", WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", **fields)]
                count += 1
                for part in map(member, parts):
                    held.append(part)
                    size, records = size + len(part), records + 1
                    if size >= file_bytes:
                        yield closed()
                        held, size, records, number = [], 0, 0, number + 1
        if held:
            yield closed()

    return written(planned(pages, page_id, html, url, least).mapInArrow(run, "path string, records long, bytes long"), "warc-files")


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of a file, unpacked. Fed in small pieces, as what follows a member is copied back."""
    at, piece = 0, 16 << 10
    while at < len(data):
        inflate, out = zlib.decompressobj(31), []
        while not inflate.eof:
            if at >= len(data):
                raise ValueError("an archive is cut off")
            out.append(inflate.decompress(data[at : at + piece]))
            at += piece
        at = min(at, len(data)) - len(inflate.unused_data)
        yield b"".join(out)


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record in a file of gzip members."""
    for raw in members(stream.read()):
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        length = int(fields["Content-Length"])
        if len(rest) != length + 4:
            raise ValueError(f"{fields['WARC-Record-ID']}: its length differs")
        yield fields, rest[:length]


SEGMENTS = "origin string, number int, total long, kind string, page_id long, url string, digest string, refers_to string, block binary"


def segments(files: DataFrame) -> DataFrame:
    """A row per record in the files."""

    def run(batches):
        for batch in batches:
            for path in batch["path"].to_pylist():
                store, inside = opened(path)
                rows, size = [], 0
                with store.open_input_stream(inside, compression=None) as stream:
                    for fields, block in records_of(stream):
                        name = fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"])
                        total = fields.get("WARC-Segment-Total-Length", None if "WARC-Segment-Number" in fields else len(block))
                        key = fields.get("X-Page-ID")
                        sha = fields.get("WARC-Payload-Digest")
                        rows.append((name, int(fields.get("WARC-Segment-Number", 1)), None if total is None else int(total), fields["WARC-Type"], None if key is None else int(key), fields.get("WARC-Target-URI"), sha and sha.split(":")[1], fields.get("WARC-Refers-To"), block))
                        size += len(block)
                        if size >= arrays.BLOCK_BYTES:
                            yield _rows(rows)
                            rows, size = [], 0
                if rows:
                    yield _rows(rows)

    # a file a task: each is bounded, their number grows with the pages
    return files.select("path").repartition(files.sparkSession.sparkContext.defaultParallelism * 4).mapInArrow(run, SEGMENTS)


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in SEGMENTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def assembled(origin: str, parts: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of a record from its segments (number, total, bytes) in any order."""
    parts = sorted(parts, key=lambda x: x[0])
    block = b"".join(x[2] for x in parts)
    if [x[0] for x in parts] != list(range(1, len(parts) + 1)):
        raise ValueError(f"{origin}: a segment is missing")
    if parts[-1][1] != len(block):
        raise ValueError(f"{origin}: the total length differs")
    return block


def read(files: DataFrame, payloads: bool = True) -> DataFrame:
    """Per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to (a page id) and, on
    request, payload (null for revisits, which do not hold it). The archive is parsed once."""
    grouped = segments(files).groupBy("origin").agg(
        F.collect_list(F.struct("number", "total", "block")).alias("parts"),
        *[F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("kind", "page_id", "url", "digest", "refers_to")],
    )

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                block = assembled(row["origin"], [(p["number"], p["total"], p["block"]) for p in row["parts"]])
                if row["kind"] == "revisit":
                    out.append((row["page_id"], row["url"], None, row["digest"], "revisit", int(row["refers_to"].split(":")[2]), None))
                    continue
                payload = payload_of(block)
                sha = digest(payload)
                if sha != row["digest"]:
                    raise ValueError(f"{row['origin']}: the payload's digest differs")
                out.append((row["page_id"], row["url"], len(payload), sha, "response", None, payload if payloads else None))
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], names=[c.split()[0] for c in RECORD.split(", ")])

    found = written(grouped.mapInArrow(run, RECORD), "warc-records")
    whole, again = found.where("record_type = 'response'"), found.where("record_type = 'revisit'").drop("payload_bytes")
    # revisits of one response may be a third of all records: they are dealt over salts, and the
    # responses that are asked for stand in each salt
    asked = again.select("refers_to", "payload_digest").distinct()
    held = whole.selectExpr("page_id AS refers_to", "payload_digest", "payload_bytes").distinct().join(asked, ["refers_to", "payload_digest"], "left_semi")
    held = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    again = again.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return whole.unionByName(again.join(held, ["refers_to", "payload_digest", "salt"], "left").drop("salt"))
