"""WARC archives: written with deduplicated payloads, segments and chunked transfer framing; read back by reassembly.

**Writing.** A page becomes one record. Of pages with equal payloads of at least MIN_REVISIT bytes, the one with the
largest page_id is a ``response``; the others are ``revisit`` records that refer to it and hold no payload. A response holds an
HTTP head and the payload in chunked framing; where that block is longer than a segment it goes on in ``continuation``
records, which name the record they belong to (WARC-Segment-Origin-ID) and their number; the last states the total length.
Archives are written by Spark's text sink with the record separator of WARC (two CRLFs) as its line separator, so a
failed or repeated task leaves no half archive, on any store that Spark writes to. A file is compressed as a whole.

**Reading.** Spark's text source gives the pieces between two CRLFs of each file in order; a parser in the task puts them
together as a byte stream, cuts records by Content-Length, and settles every record that is whole by itself. Only segments
are shuffled: by origin, sorted by segment number, and streamed, so that no list of them is gathered. A block is complete if its
numbers run from 1 without a gap, the last states a total length and the bytes add up to it; its chunked framing is then undone.
Revisits meet the response they refer to in a join that splits hot responses.

Defined results. A null html is an empty payload; a null page_id is smaller than any other and is read back as null; a null url gives no
target. Rows with the same page_id and payload are ordered by url; of rows equal in all three, one is the response and the others
revisit it. Blocks of any length are cut into segments; text, control characters and separators inside a payload change nothing.
Empty tables give an archive without records and no rows. A record that cannot be settled has status ``incomplete`` (a segment is
missing, or the total length is not met) or ``damaged`` (bad framing, or a digest that does not match), null bytes and digest, and is kept;
so is a record cut off by the end of its file. Of a segment that is there twice, the first is used.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.llm.common import map_batches
from pluvia.operators.joins import lookup_join
from pluvia.session import materialise, scratch_path

#: Payloads from this size on are deduplicated.
MIN_REVISIT = 1000
#: Bytes of a block in one record.
SEGMENT_BYTES = 1 << 16
#: Payload bytes in one chunk of the transfer framing.
CHUNK_BYTES = 1 << 12

# Fixed values of the formats.
SEPARATOR = "\r\n\r\n"
CRLF = b"\r\n"
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

COMPLETE, INCOMPLETE, DAMAGED = "complete", "incomplete", "damaged"


# --- framing -----------------------------------------------------------------------------------


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing, with its last empty chunk."""
    parts = [b"%x\r\n%b\r\n" % (len(part := payload[i : i + size]), part) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, or None if its framing is wrong. Chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(b"[0-9A-Fa-f]{1,15}", size):
            return None
        if not (n := int(size, 16)):
            break
        at = end + 2
        if len(body) < at + n + 2 or body[at + n : at + n + 2] != CRLF:
            return None
        out.append(body[at : at + n])
        at += n + 2
    while True:  # trailers, up to an empty line
        at, end = end + 2, body.find(CRLF, end + 2)
        if end < 0:
            return None
        if end == at:
            return b"".join(out) if end + 2 == len(body) else None


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP response, or None if the block is none or its framing is wrong."""
    head, found, body = block.partition(CRLF + CRLF)
    if not found or not head.startswith(b"HTTP/"):
        return None
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked[ \t]*\r?$", head) else body


def record(kind: str, block: bytes, **fields: str | int | None) -> bytes:
    """One WARC record without its final separator. Names of fields have ``_`` for ``-``; a None is left out."""
    lines = [VERSION, b"WARC-Type: " + kind.encode()]
    lines += [f"{name.replace('_', '-')}: {value}".encode() for name, value in fields.items() if value is not None]
    return CRLF.join([*lines, b"Content-Length: %d" % len(block), b"", block])


class Parser:
    """Cuts a stream of bytes into records: (fields with names in lower case, block)."""

    def __init__(self) -> None:
        self.fields: dict[str, str] | None = None
        self.parts: list[bytes] = []
        self.held = 0
        self.need = 0  # bytes to wait for, or 0 where the end of the fields is looked for

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.parts.append(data)
        self.held += len(data)
        while self.held and self.held >= self.need:
            buffer = b"".join(self.parts)
            done = self._step(buffer)
            if done is None:
                self.parts = [buffer]
                return
            found, used = done
            self.parts, self.held = [buffer[used:]], len(buffer) - used
            if found:
                yield found

    def _step(self, buffer: bytes) -> tuple[tuple[dict[str, str], bytes] | None, int] | None:
        """What was found and the bytes it took, or None for more bytes."""
        if self.fields is None:
            skipped = len(buffer) - len(buffer.lstrip(CRLF))
            end = buffer.find(CRLF + CRLF, skipped)
            if end < 0:
                return (None, skipped) if skipped else None
            head = buffer[skipped:end].decode("utf-8", "replace").split("\r\n")
            if not head[0].startswith("WARC/"):
                raise ValueError(f"not a WARC record: {head[0][:80]!r}")
            pairs = (line.partition(":") for line in head[1:])
            self.fields = {name.strip().lower(): value.strip() for name, _, value in pairs}
            self.need = int(self.fields["content-length"]) + len(SEPARATOR)
            return None, end + len(SEPARATOR)
        block, fields = buffer[: self.need - len(SEPARATOR)], self.fields
        used, self.fields, self.need = self.need, None, 0
        return (fields, block), used

    def rest(self) -> dict[str, str] | None:
        """The fields of a record that the end of the file cuts off."""
        return self.fields


# --- writing -----------------------------------------------------------------------------------


def _target(url: str | None) -> str | None:
    return None if url is None else re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def response_id(sha1: str, size: int) -> str:
    """The id of the one response that holds a payload which others may revisit."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{sha1}:{size}')}>"


def with_roles(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, sha1, size, role, payload): what each row is written as; a revisit has no payload.

    Only digests are grouped, and combined before the shuffle. The rows meet the groups of more than one row, a side
    that is broadcast if measured to fit and else joined with its hot payloads apart.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("payload")).withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    alike = rows.where(F.col("size") >= min_revisit).groupBy("sha1", "size", "page_id", "url").agg(F.count("*").alias("equal"))
    most = F.max(F.struct(F.col("page_id").alias("top_id"), F.col("url").alias("top_url"), "equal"))
    groups = alike.groupBy("sha1", "size").agg(most.alias("top"), F.sum("equal").alias("n")).where("n > 1").select("sha1", "size", "top.*")
    groups = materialise(groups, "payloads")
    met = lookup_join(rows, groups, ["sha1", "size"], "left")
    top = F.col("page_id").eqNullSafe(F.col("top_id")) & F.col("url").eqNullSafe(F.col("top_url"))
    role = F.when(F.col("equal").isNull() | top, "response").otherwise("revisit")
    columns = ["page_id", "url", "sha1", "size", "role", F.when(F.col("role") == "response", F.col("payload")).alias("payload")]
    met = met.withColumn("role", role)
    if groups.where("equal > 1").isEmpty():
        return met.select(*columns)
    # Rows equal in everything: one of them is written with its payload, and revisits for the count of the others.
    same = (F.col("role") == "response") & (F.coalesce("equal", F.lit(1)) > 1)
    once = met.where(same).dropDuplicates(["sha1", "size"]).select(*columns)
    others = groups.where("equal > 1").withColumn("_", F.explode(F.expr("sequence(2L, equal)")))
    others = others.select(
        F.col("top_id").alias("page_id"), F.col("top_url").alias("url"), "sha1", "size", F.lit("revisit").alias("role"), F.lit(None).cast("binary").alias("payload")
    )
    return met.where(~same).select(*columns).unionByName(once).unionByName(others)


def to_records(rows: DataFrame, min_revisit: int = MIN_REVISIT, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES, date: str | None = None) -> DataFrame:
    """``record`` (binary): the records of ``with_roles``, one row each."""
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        task, made = TaskContext.get(), 0
        run = f"{task.stageId() if task else 0}:{task.partitionId() if task else 0}:{date}"
        for batch in batches:
            out = []

            def own_id() -> str:
                nonlocal made
                made += 1
                return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{run}:{made}')}>"

            columns = (batch[c].to_pylist() for c in ("page_id", "url", "sha1", "size", "role", "payload"))
            for page, url, sha1, size, role, payload in zip(*columns, strict=True):
                of_all = {
                    "WARC_Date": date, "WARC_Target_URI": _target(url), "Page_Id": page, "Content_Type": "application/http; msgtype=response",
                    "WARC_Payload_Digest": "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode(),
                }
                known = response_id(sha1, size) if size >= min_revisit else None
                if role == "revisit":
                    out.append(record("revisit", HEAD + CRLF, WARC_Record_ID=own_id(), WARC_Refers_To=known, WARC_Profile=SAME_PAYLOAD, **of_all))
                    continue
                block = b"%bTransfer-Encoding: chunked\r\n\r\n%b" % (HEAD, chunked(payload, chunk_bytes))
                parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
                origin = known or own_id()
                out.append(record("response", parts[0], WARC_Record_ID=origin, WARC_Segment_Number=1 if len(parts) > 1 else None, **of_all))
                for number, part in enumerate(parts[1:], 2):
                    total = len(block) if number == len(parts) else None
                    out.append(
                        record("continuation", part, WARC_Record_ID=own_id(), WARC_Date=date, WARC_Segment_Origin_ID=origin, WARC_Segment_Number=number, WARC_Segment_Total_Length=total)
                    )
            yield {"record": pa.array(out, pa.binary())}

    return map_batches(rows, write, "record binary")


def write_archives(pages: DataFrame, path: str, *, min_revisit: int = MIN_REVISIT, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Archives of ``pages`` (page_id, url, html), one file for each task, below ``path``."""
    records = to_records(with_roles(pages, min_revisit), min_revisit, segment_bytes, chunk_bytes)
    records.select(F.col("record").cast("string")).write.options(lineSep=SEPARATOR, compression="gzip").text(path)


# --- reading -----------------------------------------------------------------------------------

RECORD = (
    "file string, kind string, record_id string, page_id long, refers_id string, declared string, origin string, segment long, total long, "
    "status string, payload_bytes long, payload_digest string, payload binary, block binary"
)


def _long(text: str | None) -> int | None:
    return int(text) if text else None


def _settled(block: bytes, declared: str | None, payloads: bool) -> dict:
    payload = payload_of(block)
    if payload is None:
        return {"status": DAMAGED}
    digest = hashlib.sha1(payload).hexdigest()
    if declared is not None and declared != digest:
        return {"status": DAMAGED}
    return {"status": COMPLETE, "payload_bytes": len(payload), "payload_digest": digest, "payload": payload if payloads else None}


def _hex_digest(field: str | None) -> str | None:
    """The SHA-1 of a digest field in hex, or None: base 32 as is usual, or hex."""
    name, _, value = (field or "").partition(":")
    if name.lower() != "sha1":
        return None
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def _columns(rows: list[dict]) -> dict:
    names = [c.split()[0] for c in RECORD.split(", ")]
    return {n: pa.array([r.get(n) for r in rows], pa.int64() if n in _LONGS else pa.binary() if n in ("payload", "block") else pa.string()) for n in names}


_LONGS = {c.split()[0] for c in RECORD.split(", ") if c.endswith(" long")}


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every record of the archives below ``path``: settled if it is whole by itself, with its block if it is a segment.

    Archives are gzip files, which Spark reads unsplit and in order; an uncompressed one that is split raises.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        parser, file = Parser(), None

        def row(fields: dict[str, str], block: bytes) -> dict:
            kind, number = fields.get("warc-type"), _long(fields.get("warc-segment-number"))
            digest = _hex_digest(fields.get("warc-payload-digest"))
            out = {
                "file": file, "kind": kind, "record_id": fields.get("warc-record-id"), "page_id": _long(fields.get("page-id")),
                "refers_id": fields.get("warc-refers-to"), "declared": digest, "segment": number, "total": _long(fields.get("warc-segment-total-length")),
            }
            if number is not None:
                return out | {"origin": fields.get("warc-segment-origin-id") or out["record_id"], "block": block}
            return out | (_settled(block, digest, payloads) if kind == "response" else {"status": COMPLETE})

        def cut_off() -> list[dict]:
            if (fields := parser.rest()) is None:
                return []
            lost = row(fields, b"")  # an empty segment leaves its block short of its total length
            return [lost if lost.get("block") is not None else {k: lost[k] for k in ("file", "kind", "record_id", "page_id")} | {"status": INCOMPLETE}]

        for batch in batches:
            out, size = [], 0
            for name, start, piece in zip(batch["file"].to_pylist(), batch["start"].to_pylist(), batch["piece"].to_pylist(), strict=True):
                if start:
                    raise ValueError(f"{name} was split: archives must be compressed")
                if name != file:
                    out += cut_off()
                    parser, file = Parser(), name
                for fields, block in parser.feed(piece + CRLF + CRLF):
                    out.append(row(fields, block))
                    size += len(block)
                if size >= 1 << 24:
                    yield _columns(out)
                    out, size = [], 0
            yield _columns(out)
        yield _columns(cut_off())

    lines = spark.read.option("lineSep", SEPARATOR).text(path)
    lines = lines.select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return map_batches(lines, read, RECORD)


def reassemble(segments: DataFrame, payloads: bool = False) -> DataFrame:
    """One row for each origin of ``segments``, settled: grouped by origin, ordered by number, verified and unframed.

    Segments of one block come to one task, sorted, and are streamed: what a task holds at a time is one block.
    """

    def close(first: dict, parts: list[bytes], numbers: list[int], total: int | None) -> dict:
        whole = numbers == list(range(1, len(numbers) + 1)) and total is not None and sum(map(len, parts)) == total
        return first | (_settled(b"".join(parts), first["declared"], payloads) if whole else {"status": INCOMPLETE})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        first, parts, numbers, total = None, [], [], None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if first is None or r["origin"] != first["origin"]:
                    if first is not None:
                        out.append(close(first, parts, numbers, total))
                    first, parts, numbers, total = {**r, "kind": "response", "record_id": r["origin"], "block": None}, [], [], None
                if not numbers or r["segment"] != numbers[-1]:
                    parts.append(r["block"])
                    numbers.append(r["segment"])
                    total = r["total"] if r["total"] is not None else total
            yield _columns(out)
        if first is not None:
            yield _columns([close(first, parts, numbers, total)])

    return map_batches(segments.repartition("origin").sortWithinPartitions("origin", "segment", "record_id"), run, RECORD)


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(record_id, page_id, kind, status, payload_bytes, payload_digest, payload, refers_to), one row for each response and revisit.

    A revisit has the bytes and digest of the response that it refers to, and ``refers_to`` is the page_id of that. Payloads themselves are
    given with ``payloads``, for responses.
    """
    found = materialise(read_records(spark, path, payloads), "records")
    segmented = F.col("segment").isNotNull() & F.col("status").isNull()
    names = ["record_id", "page_id", "kind", "status", "payload_bytes", "payload_digest", "payload"]
    settled = found.where(~segmented & F.col("kind").isin("response", "continuation")).withColumn("kind", F.lit("response")).select(*names)
    settled = settled.unionByName(materialise(reassemble(found.where(segmented), payloads).select(*names), "blocks"))
    first = settled.select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes"), F.col("payload_digest"), F.col("status").alias("of")
    )
    revisits = lookup_join(found.where("kind = 'revisit'").select("record_id", "page_id", "kind", "refers_id", "declared"), first, ["refers_id"], "left")
    same = (F.col("of") == COMPLETE) & (F.col("declared").isNull() | (F.col("declared") == F.col("payload_digest")))
    status = F.when(F.col("of").isNull() | (F.col("of") == INCOMPLETE), INCOMPLETE).when(same, COMPLETE).otherwise(DAMAGED)
    revisits = revisits.withColumn("status", status).withColumns({c: F.when(F.col("status") == COMPLETE, F.col(c)) for c in ("payload_bytes", "payload_digest", "refers_to")})
    return settled.withColumn("refers_to", F.lit(None).cast("long")).unionByName(revisits.withColumn("payload", F.lit(None).cast("binary")).select(*names, "refers_to"))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """``pages`` written as archives in the shared folder and read back."""
    path = scratch_path(pages.sparkSession, "archives")
    write_archives(pages, path, **options)
    return read_archives(pages.sparkSession, path)
