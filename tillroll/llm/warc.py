"""WARC archives written and read as Spark tables of gzip members.

Writing: one member per record. Spark's text sink writes the members of a partition one after
the other into a part file in any file system it knows, with a zero byte as padding between
members, which gzip readers skip.

Reading: files are cut into byte ranges by Spark. Its text source splits at the gzip magic bytes,
so each task scans its own range for the magic and gets what follows up to the next one, beyond
its range if need be. A piece is the start of a record if it decodes to a WARC header; a piece too
short to tell is a candidate, and what follows is added to it until its header is confirmed or
refuted. If it is refuted, the next piece is the candidate. While a record is not complete, pieces
that follow belong to it (the magic occurred inside its data). A record belongs to the task in
whose range it starts. If such a false start lies at a range's border, the rest of the record is in
the next task; both report their fragments, which are joined by file in the order of the bytes.
Memory holds one record. (Not decidable from a range alone: a record that stores a whole
compressed archive uncompressed, with a border inside. This writer deflates, and text has no magic.)

Records have the headers that WARC/1.1 demands and a block of HTTP head and payload, a revisit the head alone.
The date is a parameter with a fixed default, so that reruns write the same bytes.

A member that is cut short or does not decode is a row of type "damaged", with the id and the URI if its header
could be read, or an error if the caller wants one; the records after it are read. So are bytes between members
that begin with the magic and belong to no record. (A member whose magic is lost cannot be told from padding.)

Null payloads are empty. Ids are strings in the record header; null ids get a generated one, null URLs a fixed
URI, and both are read as null. Repeated rows give records of their own, those of one id with the same record id.
An empty table gives an empty archive. Columns other than page_id, url and html have no effect.
"""

import base64
import hashlib
import zlib
from collections import deque
from typing import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.groups import with_group_min

# fixed values: the gzip magic with the deflate method, and the WARC version
MAGIC = b"\x1f\x8b\x08"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http"

UNNUMBERED = "urn:unnumbered:"  # record ids of rows without an id
UNKNOWN = "urn:unknown"  # the URI of rows without a URL
DATE = "1970-01-01T00:00:00Z"

RECORD = (
    "complete boolean, file string, range long, place long, opened boolean, rest binary, record_type string, record_id string, "
    "uri string, refers_to string, digest string, payload_bytes long, payload binary"
)
#: What a record's decoded bytes begin with.
BEGIN = b"WARC/"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to: of equal payloads the largest page_id responds, the others revisit it.

    Payloads of fewer than min_bytes all respond. Rows that repeat the largest page_id all respond.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("same", F.when(F.octet_length("html") >= min_bytes, F.sha1(F.col("html").cast("binary"))))
    found = with_group_min(rows, "same", "page_id", "first_id", spread="page_id", largest=True)
    refers = F.when(F.col("page_id") != F.col("first_id"), F.col("first_id"))
    return found.select("page_id", "url", "html", refers.alias("refers_to"))


def header_value(text: str) -> str:
    """A header's value: line ends cannot stand in it."""
    return " ".join(text.split("\n")).replace("\r", " ")


def member(page_id, url, payload: bytes, refers_to, serial: str = "0", date: str = DATE) -> bytes:
    """One gzip member with one record; a revisit has the payload's digest and, in its HTTP head, size.

    serial makes the id of a row without page_id; it should be unique in the archive.
    """
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head if revisit else head + payload
    record_id = f"{UNNUMBERED}{serial}" if page_id is None else f"urn:page:{page_id}"
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {UNKNOWN if url is None else header_value(url)}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"Content-Type: {HTTP}; msgtype=response", f"Content-Length: {len(body)}"]
    block = "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(block) + packer.flush()


def write_archive(planned: DataFrame, path: str, date: str = DATE) -> None:
    """Write the records that plan_records gives as part files under path."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                payloads = part.column(2).cast(pa.binary())
                members = [
                    member(i.as_py(), u.as_py(), p.as_py(), r.as_py(), f"{task}-{n}", date)
                    for n, (i, u, p, r) in enumerate(zip(part.column(0), part.column(1), payloads, part.column(3)), row)
                ]
                row += len(members)
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])

    packed = planned.select("page_id", "url", "html", "refers_to").mapInArrow(pack, "member binary")
    packed.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


class _Probe:
    """Decodes the first bytes of a candidate; says whether it is a record's start, or None while that is open."""

    def __init__(self):
        self.decoder, self.head = zlib.decompressobj(31), b""

    def add(self, piece: bytes):
        try:
            self.head += self.decoder.decompress(piece, len(BEGIN) - len(self.head))
        except zlib.error:
            return False
        if self.head == BEGIN:
            return True
        return None if BEGIN.startswith(self.head) and not self.decoder.eof else False


def _fields(head: bytes) -> dict:
    """The header lines that follow the first line."""
    found = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _id(value):
    uri = (value or "").strip("<>")
    return None if not uri or uri.startswith(UNNUMBERED) else uri.rpartition(":")[2]


def _named(fields):
    """Record id and URI."""
    uri = fields.get("warc-target-uri")
    return _id(fields.get("warc-record-id")), None if uri == UNKNOWN else uri


def parse_block(block: bytes):
    """Type, id, uri, refers-to, digest, size and payload of a decoded record."""
    head, _, rest = block.partition(b"\r\n\r\n")
    fields = _fields(head)
    payload, sent = rest[: int(fields.get("content-length", 0))], {}
    if fields.get("content-type", "").startswith(HTTP):
        http, _, payload = payload.partition(b"\r\n\r\n")
        sent = _fields(http)
    kind = fields.get("warc-type", "")
    if kind == "revisit":
        digest, size = fields.get("warc-payload-digest", "").rpartition(":")[2], sent.get("content-length", "")
        size = int(size) if size.isdigit() else None
    else:
        digest, size = base32_sha1(payload), len(payload)
    record_id, uri = _named(fields)
    return kind, record_id, uri, _id(fields.get("warc-refers-to")), digest, size, payload


def _damaged(raw: list[bytes]):
    """As parse_block, for the bytes of a member that does not decode to its end."""
    decoder, head, data = zlib.decompressobj(31), b"", b"".join(raw[:1])
    try:
        while b"\r\n\r\n" not in head and data:
            head += decoder.decompress(data, 256)
            data = decoder.unconsumed_tail
    except zlib.error:
        pass
    head, end, _ = head.partition(b"\r\n\r\n")
    return "damaged", *(_named(_fields(head)) if end else (None, None)), None, None, None, None


class _Range:
    """The records of one byte range of a file, from its pieces in order."""

    def __init__(self, file, offset):
        self.file, self.offset = file, offset
        self.open = None  # decoder of the record that is not complete
        self.raw, self.block = [], []
        self.probe, self.pending = None, []  # a candidate and the pieces after it, while its header is not decoded
        self.orphan = []

    def add(self, piece):
        """Feed a piece; gives the rows of the records that it completes."""
        rows, waiting = [], deque([piece])
        while waiting:
            piece = waiting.popleft()
            if self.open is not None:
                found, again = self._continue(piece)
                rows.extend(found)
                waiting.extendleft(reversed(again))
                continue
            if not self.pending:
                self.probe = _Probe()
            self.pending.append(piece)
            begins = self.probe.add(piece)
            if begins is None:
                continue
            if begins:
                self.open, self.raw, self.block = zlib.decompressobj(31), [], []
            else:
                self.orphan.append(self.pending.pop(0))
            waiting.extendleft(reversed(self.pending))
            self.pending = []
        return rows

    def _continue(self, piece):
        """Rows of the open record if the piece ends it, and pieces that turn out not to be its own."""
        self.raw.append(piece)
        try:
            self.block.append(self.open.decompress(piece))
        except zlib.error:  # the member was cut short or damaged before: what follows its first piece is looked at again
            return self.close(), self.raw[1:]
        if not self.open.eof:
            return [], []
        self.open = None
        return [self._row(parse_block(b"".join(self.block)))], []

    def _row(self, facts):
        return (True, self.file, self.offset, 0, False, None, *facts)

    def close(self):
        """Give up the record that is open; gives its row."""
        if self.open is None:
            return []
        self.open = None
        return [self._row(_damaged(self.raw))]

    def skip(self):
        """Give up the candidate, as nothing follows or what follows is not its own; gives rows like add."""
        rows = []
        while self.pending:
            rest, self.pending = self.pending[1:], []
            for piece in rest:
                rows.extend(self.add(piece))
        return rows

    def fragments(self):
        """What is not decided here, in order: orphans, then a candidate's pieces or the begin of a record."""
        nothing = (None,) * 7
        parts = [*self.orphan, *self.pending]
        for place, piece in enumerate(parts):
            yield (False, self.file, self.offset, place, False, piece, *nothing)
        if self.open is not None:
            yield (False, self.file, self.offset, len(parts), True, b"".join(self.raw), *nothing)


def _batch(rows):
    names = [part.split()[0] for part in RECORD.split(", ")]
    kinds = {"boolean": pa.bool_(), "string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[part.split()[1]] for part in RECORD.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def scan_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Complete records and, rarely, fragments of records that a range's border cuts."""

    def scan(batches):
        current = None
        for batch in batches:
            rows = []
            for value, file, offset in zip(batch.column(0), batch.column(1), batch.column(2)):
                key = file.as_py(), offset.as_py()
                if current is None or (current.file, current.offset) != key:
                    if current is not None:
                        rows.extend(current.fragments())
                    current = _Range(*key)
                piece = value.as_py()
                if piece == b"" and key[1] == 0 and current.open is None and not current.orphan and not current.pending:
                    continue  # before the first magic of a file
                rows.extend(current.add(MAGIC + piece))
                if len(rows) >= 256:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
        if current is not None:
            yield _batch(list(current.fragments()))

    raw = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    pieces = raw.select(F.col("value").cast("binary").alias("piece"), "_metadata.file_path", "_metadata.file_block_start")
    return pieces.mapInArrow(scan, RECORD)


def _mend(frame):
    """Records of one file that borders cut, from its fragments (a false magic right at a border; very rare)."""
    import pandas as pd

    done, current = [], _Range(frame["file"].iloc[0], 0)

    def finish():
        rows = current.close() + current.skip()
        return rows + current.close() + [current._row(_damaged([piece])) for piece in current.orphan]

    for row in frame.sort_values(["range", "place"]).itertuples():
        if row.opened:  # known to be a start: what came before has ended
            done.extend(finish())
            current = _Range(row.file, row.range)
        done.extend(current.add(bytes(row.rest)))
    done.extend(finish())
    return pd.DataFrame(done, columns=list(frame.columns))


def read_archive(spark: SparkSession, path: str, damaged: str = "report") -> DataFrame:
    """Records of all part files: record_type, record_id, uri, refers_to, digest, payload_bytes, payload.

    Damaged members are rows of type "damaged" ("report"), or fail the query ("raise").
    """
    if damaged not in ("report", "raise"):
        raise ValueError(f"damaged must be report or raise, got {damaged!r}")
    scanned = scan_pieces(spark, path)
    cut = scanned.where("NOT complete").groupBy("file").applyInPandas(_mend, RECORD)
    records = scanned.where("complete").unionByName(cut)
    kind = F.col("record_type")
    if damaged == "raise":
        told = F.raise_error(F.concat(F.lit("damaged member in "), "file")).cast("string")
        kind = F.when(kind == "damaged", told).otherwise(kind)
    return records.select(kind.alias("record_type"), "record_id", "uri", "refers_to", "digest", "payload_bytes", "payload")
