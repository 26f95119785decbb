import base64
import gzip
import hashlib
import io
import os
import zlib

import pytest

from tillroll.llm import warc
from tillroll.session import new_path

ROWS = [
    (1, "http://a/\r\nx", "same", "u"), (7, "http://b", "same", "u"), (3, None, None, "u"), (4, "c", "", "u"), (4, "c", "", "u"),
    (None, "n", "né🙂", "u"), (9, "long", "long text " * 30_000, "u"), (10, "w", "WARC/1.1\r\n\r\n\x1f\x0b\0", "u"), (2, "http://a", "same", "u"),
]
SCHEMA = "page_id long, url string, html string, payload string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows):
    largest = {}
    for page, _, html, _ in rows:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", page))
    found = []
    for page, _, html, _ in rows:
        first = largest.get(html or "")
        revisit = page is not None and page != first
        found.append((page, len((html or "").encode()), digest(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(found, key=str)


def read(spark, path):
    return sorted(
        [
            (r.record_id and int(r.record_id), r.payload_bytes, r.digest, r.record_type, r.refers_to and int(r.refers_to))
            for r in warc.read_archive(spark, path).collect()
        ],
        key=str,
    )


@pytest.mark.parametrize("size", ["128m", "97", "1000"])
def test_round_trip_at_any_range_size(spark, size):
    path = new_path(spark)
    warc.write_archive(warc.plan_records(spark.createDataFrame(ROWS, SCHEMA)), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert read(spark, path) == expected(ROWS)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_other_gzip_readers_read_it(spark):
    path = new_path(spark)
    warc.write_archive(warc.plan_records(spark.createDataFrame(ROWS, SCHEMA).coalesce(1)), path)
    blocks = b""
    for name in os.listdir(path):
        if name.startswith("part-"):
            with open(f"{path}/{name}", "rb") as file:
                blocks += gzip.decompress(file.read())
    assert blocks.count(b"WARC-Type:") == len(ROWS)


@pytest.mark.parametrize("size, nested", [("128m", True), ("10", False), ("64", False), ("200", False)])
def test_false_magic_inside_a_member(spark, size, nested):
    """Stored members keep the magic inside a payload; within one range even a whole archive may be there."""
    inner = warc.member(99, "inner", b"nested", None) if nested else warc.MAGIC + b"\0" * 30 + b"WARC/"
    members, want = [], {}
    for i in range(6):
        want[i] = payload = b"x" * i + inner + warc.MAGIC * 3 + b"end" + inner
        text = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(payload)}\r\n\r\n"
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        members.append(packer.compress(text.encode() + payload + b"\r\n\r\n") + packer.flush())
    path = new_path(spark)
    os.makedirs(path)
    with open(f"{path}/part-0.txt", "wb") as file:
        file.write(b"".join(members))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        if not nested:
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows = warc.read_archive(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {int(r.record_id): bytes(r.payload) for r in rows} == want and len(rows) == 6


def test_small_payloads_all_respond(spark):
    planned = warc.plan_records(spark.createDataFrame(ROWS, SCHEMA), min_bytes=5).collect()
    assert all(r.refers_to is None for r in planned)


def test_empty(spark):
    path = new_path(spark)
    warc.write_archive(warc.plan_records(spark.createDataFrame([], SCHEMA)), path)
    assert read(spark, path) == []


@pytest.mark.parametrize("size", ["128m", "10", "25", "64", "200"])
@pytest.mark.parametrize("extra", [warc.MAGIC, warc.MAGIC * 2, warc.MAGIC + b"\x1f\0\0" + warc.MAGIC + b"\x08"])
def test_false_magic_before_the_header_decodes(spark, size, extra):
    """The gzip header has an extra field, so the magic stands 20 bytes into the member, before its first block."""
    members, want = [], {}
    for i in range(6):
        want[i] = payload = f"payload {i} ".encode() * (i + 1)
        field = b"e" * 8 + extra + b"e" * i
        text = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(payload)}\r\n\r\n"
        block = text.encode() + payload + b"\r\n\r\n"
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        data = packer.compress(block) + packer.flush()
        head = warc.MAGIC + b"\x04" + b"\0" * 6 + len(field).to_bytes(2, "little") + field
        assert head.index(warc.MAGIC, 1) == 20
        members.append(head + data + zlib.crc32(block).to_bytes(4, "little") + len(block).to_bytes(4, "little"))
    path = new_path(spark)
    os.makedirs(path)
    with open(f"{path}/part-0.txt", "wb") as file:
        file.write(b"\0".join(members))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows = warc.read_archive(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {int(r.record_id): bytes(r.payload) for r in rows} == want and len(rows) == 6


def plain_records(data):
    """An independent reader: header fields and block of each record, by the standard's grammar."""
    stream, found = gzip.GzipFile(fileobj=io.BytesIO(data)), []
    while line := stream.readline():
        assert line == b"WARC/1.1\r\n"
        fields = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().partition(":")
            assert name.lower() not in fields
            fields[name.lower()] = value.strip()
        found.append((fields, stream.read(int(fields["content-length"]))))
        assert stream.read(4) == b"\r\n\r\n"
    return found


def test_records_are_valid(spark):
    path = new_path(spark)
    warc.write_archive(warc.plan_records(spark.createDataFrame(ROWS + [(None, None, "other", "u")], SCHEMA)), path)
    records = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(f"{path}/{name}", "rb") as file:
                records += plain_records(file.read())
    assert len(records) == len(ROWS) + 1
    ids = [fields["warc-record-id"] for fields, _ in records]
    assert len(set(ids)) == len(ids) - 1  # one page stands twice
    bodies = {}
    for fields, block in records:
        assert {"warc-type", "warc-date", "warc-target-uri", "content-type"} <= set(fields)
        head, _, body = block.partition(b"\r\n\r\n")
        assert head.startswith(b"HTTP/1.1 200 ") and fields["content-type"] == "application/http; msgtype=response"
        if fields["warc-type"] == "revisit":
            assert fields["warc-profile"].endswith("/identical-payload-digest") and not body
            assert fields["warc-refers-to"] in ids
        else:
            assert fields["warc-payload-digest"] == "sha1:" + digest(body.decode())
            bodies[fields["warc-record-id"]] = body.decode()
    assert sorted(bodies.values()) == sorted({**{r[0]: r[2] or "" for r in ROWS if r[0] not in (1, 2, 3)}, "x": "other"}.values())


@pytest.mark.parametrize("size", ["128m", "40", "200"])
@pytest.mark.parametrize("harm", ["flipped", "cut", "last", "start"])
def test_damaged_members_are_told(spark, size, harm):
    texts = {i: "".join(chr(97 + (i * 7 + k * k) % 26) for k in range(300)) for i in range(6)}
    members = [warc.member(i, f"http://{i}", t.encode(), None) for i, t in texts.items()]
    at = 5 if harm == "last" else 2
    if harm == "flipped":
        members[at] = members[at][:-6] + bytes([members[at][-6] ^ 255]) + members[at][-5:]
    elif harm == "start":
        members[at] = members[at][:10] + b"\xff" * 8 + members[at][18:]
    else:
        members[at] = members[at][:-40]
    path = new_path(spark)
    os.makedirs(path)
    with open(f"{path}/part-0.txt", "wb") as file:
        file.write(b"\0".join(members))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows = warc.read_archive(spark, path).collect()
        with pytest.raises(Exception, match="damaged member"):
            warc.read_archive(spark, path, damaged="raise").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    told = [r for r in rows if r.record_type == "damaged"]
    assert {int(r.record_id): bytes(r.payload).decode() for r in rows if r.record_type == "response"} == {i: t for i, t in texts.items() if i != at}
    assert [r.record_id for r in told] == [None if harm == "start" else str(at)] and len(rows) == 6
