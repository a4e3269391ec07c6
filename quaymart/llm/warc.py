"""WARC archives: a writer that stores equal payloads once, and a reader that salvages.

Records are single gzip members.  The reader works through a file of any length in
bounded memory, but for a member's content; where a member or a record fails its checks,
it looks for the next start of a member or version line, also within what a member holds
or held before its damage, goes on there, and reports the bytes between.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import stored, text_or_empty
from quaymart.sources import staging_path

VERSION, MAGIC = b"WARC/1.1", b"\x1f\x8b\x08"
DATE = "2000-01-01T00:00:00Z"  # fixed, so that reruns write the same bytes
_READ = 1 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    page_id: int | None, url: str, payload: bytes, refers_to: int | None, of: bool
) -> bytes:
    """One record; with ``of`` a revisit, which repeats no payload."""
    block = HTTP if of else HTTP + payload
    lines = [
        VERSION,
        b"WARC-Type: " + (b"revisit" if of else b"response"),
        b"WARC-Record-ID: <urn:page:%s>" % _number(page_id),
        b"WARC-Date: " + DATE.encode(),
        b"WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", "", url).encode(),
        b"WARC-Payload-Digest: sha1:" + digest(payload).encode(),
        b"WARC-Block-Digest: sha1:" + digest(block).encode(),
        b"X-Payload-Length: %d" % len(payload),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if of:
        lines.insert(2, b"WARC-Refers-To: <urn:page:%s>" % _number(refers_to))
        lines.insert(
            3,
            b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        )
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(page_id: int | None) -> bytes:
    return b"none" if page_id is None else b"%d" % page_id


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    found = re.match(r"([a-z][a-z0-9+.-]*):/*", path)
    if found and found[1] != "file":
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path if not found else "/" + path[found.end() :]


def write(pages: DataFrame, path: str) -> DataFrame:
    """Write an archive per task below ``path``; returns ``file, n_records``.

    Of rows with equal html, those with the largest ``page_id`` are responses and the
    others revisits of it.  Null html is an empty payload, a null id is smaller than
    any other, and repeated rows are repeated records.  A task writes a file of its
    own name, so a task that runs twice leaves a file that no returned row names.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        text_or_empty("html").cast("binary").alias("payload"),
    )
    keyed = rows.withColumn("hash", F.sha1("payload"))
    ids = keyed.select("page_id", "hash").distinct()
    last = ids.groupBy("hash").agg(F.max("page_id").alias("last"))
    # Joined on the page, not on the payload: no payload is hot there.
    kinds = ids.join(last, "hash").select(
        F.col("page_id").alias("id"), F.col("hash").alias("of"), "last"
    )
    marked = keyed.join(
        kinds, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("of"))
    ).select("page_id", "url", "payload", "last")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(path)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        name = f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz"
        out, n = None, 0
        for batch in batches:
            for start in range(batch.num_rows):
                page_id, url, payload, last_id = (
                    batch.column(i)[start].as_py() for i in range(4)
                )
                out = out or store.open_output_stream(f"{root}/{name}", compression=None)
                out.write(
                    member(record(page_id, url, payload, last_id, page_id != last_id))
                )
                n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{path}/{name}"]), pa.array([n], pa.int64())], ["file", "n_records"]
            )

    return stored(marked.mapInArrow(run, "file string, n_records long"), "archives")


class Source:
    """A file read forward, with as much of it at hand as is asked for."""

    def __init__(self, stream: BinaryIO) -> None:
        self._stream, self.data, self.at = stream, bytearray(), 0

    def more(self) -> bool:
        block = self._stream.read(_READ)
        self.data += block
        return bool(block)

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.at += n


_SLICE = 1 << 10


class Broken(Exception):
    """A member or record that fails its checks."""


def _unpacked(source: Source) -> tuple[bytes, int, str]:
    """The content of the member at the start, its length in the file, and what broke it.

    Of a member that is damaged or cut off, the content is what was unpacked before.
    """
    unpack, content, used = zlib.decompressobj(31), bytearray(), 0
    while not unpack.eof:
        if used == len(source.data) and not source.more():
            return bytes(content), used, "cut off"
        # Small slices first: most false starts of a member end within a few bytes.
        block = bytes(source.data[used : used + min(max(used, _SLICE), _READ)])
        before = unpack.copy()
        try:
            content += unpack.decompress(block)
        except zlib.error as e:
            # A failed call gives nothing: byte by byte up to the one at fault.
            for i in range(len(block)):
                try:
                    content += before.decompress(block[i : i + 1])
                except zlib.error:
                    return bytes(content), used + i, str(e)
            return bytes(content), used + len(block), str(e)
        used += len(block) - len(unpack.unused_data)
    return bytes(content), used, ""


_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$")


def parse(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block and length of the record at the start of ``data``."""
    head, gap, _ = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1.") or not gap:
        raise Broken("no header")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Broken("bad header line")
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = fields.get("content-length", "")
    if not size.isdecimal():
        raise Broken("no length")
    start = len(head) + 4
    block = data[start : start + int(size)]
    end = start + int(size) + 4
    if len(block) < int(size) or data[end - 4 : end] != b"\r\n\r\n":
        raise Broken("bad length")
    stated = fields.get("warc-block-digest")
    if stated and stated != f"sha1:{digest(block)}":
        raise Broken("bad digest")
    return fields, block, end


def _inside(
    content: bytes, sound: bool
) -> Iterator[tuple[int, int, dict[str, str], bytes | None]]:
    """``start, length, fields, block`` of what a member holds; a gap has no block.

    After a record that fails its checks the next version line at the start of a line
    is looked for.  In a member that is not ``sound``, cut off ones among them, a record
    must state its digest, as nothing else tells whether it was damaged.
    """
    at, gap, reason = 0, None, ""
    while at < len(content):
        try:
            head = content.find(b"\r\n\r\n", at)
            size = _LENGTH.search(content, at, head) if head >= 0 else None
            if not content.startswith(b"WARC/1.", at):
                raise Broken("no record")
            if not size:
                raise Broken("no length" if head >= 0 else "cut off")
            fields, block, n = parse(content[at : head + 4 + int(size[1]) + 4])
            if not sound and "warc-block-digest" not in fields:
                raise Broken("not checked")
        except Broken as e:
            if not _NOT_BLANK.search(content, at):
                break
            gap, reason = (at, str(e)) if gap is None else (gap, reason)
            found = content.find(b"\nWARC/1.", at)
            at = found + 1 if found >= 0 else len(content)
            continue
        if gap is not None:
            yield gap, at - gap, {"reason": reason}, None
            gap = None
        yield at, n, fields, block
        at += n
    if gap is not None:
        yield gap, len(content) - gap, {"reason": reason}, None


_NOT_BLANK = re.compile(rb"[^\r\n]")


def _plain(source: Source) -> tuple[dict[str, str], bytes, int]:
    """The record of an unpacked file at the start."""
    while (head := source.data.find(b"\r\n\r\n")) < 0 and len(source.data) < _READ:
        if not source.more():
            raise Broken("cut off")
    size = _LENGTH.search(source.data[: max(head, 0)])
    if not size:
        raise Broken("no length")
    end = head + 4 + int(size[1]) + 4
    while len(source.data) < end:
        if not source.more():
            raise Broken("cut off")
    return parse(bytes(source.data[:end]))


def _next_start(source: Source) -> int:
    """Bytes to the next possible start of a member or version line, after the first.

    Version lines count at the start of a line only.
    """
    seen = 1
    while True:
        found = [source.data.find(MAGIC, seen), source.data.find(b"\nWARC/1.", seen - 1)]
        found = [found[0]] * (found[0] >= 0) + [found[1] + 1] * (found[1] >= 0)
        if found:
            return min(found)
        seen = max(1, len(source.data) - 8)
        if seen > _READ:  # nothing here: let it go
            return seen
        if not source.more():
            return len(source.data)


def read_stream(stream: BinaryIO) -> Iterator[tuple[str, int, int, dict[str, str], bytes]]:
    """``("record", offset, length, fields, block)`` and ``("gap", offset, length, …)``.

    Records of one member have its offset and length.  A gap within a member whose
    packing is sound too, with its ``inner_offset`` and ``inner_length`` in the content
    among its fields.  A damaged member is a gap after the records before the damage; its
    ``inner_offset`` is the end of the last one, if there is one.
    """
    source, gap, reason, inner = Source(stream), None, "", {}
    packed = False  # whether the gap at hand began with a member
    given: set[bytes] = set()  # what damaged members gave, which may also stand in raw bytes
    while source.data or source.more():
        while len(source.data) < 10 and source.more():
            pass
        items, used, broken = [], 0, ""
        try:
            if source.data.startswith(MAGIC):
                content, used, broken = _unpacked(source)
                items = list(_inside(content, not broken))
                if broken:
                    own = [hashlib.sha1(content[a : a + n]).digest() for a, n, _, b in items if b is not None]
                    # What follows the last record belongs to the gap of the member.
                    while items and items[-1][3] is None:
                        items.pop()
                    given.update(own)
                elif len(items) == 1 and items[0][3] is None and not items[0][0]:
                    raise Broken(items[0][2]["reason"])
            elif source.data.startswith(b"WARC/1."):
                fields, block, used = _plain(source)
                if hashlib.sha1(bytes(source.data[:used])).digest() in given:
                    raise Broken("already read")
                if packed and "warc-block-digest" not in fields:
                    raise Broken("not checked")  # perhaps the raw bytes of a damaged member
                items.append((0, used, fields, block))
            else:
                raise Broken("no record")
        except Broken as e:
            items, broken = [], str(e)
        if gap is not None and (items or not broken):
            yield "gap", gap, source.at - gap, {"reason": reason, **inner}, b""
            gap, reason, inner, packed = None, "", {}, False
        for start, n, fields, block in items:
            if block is None:
                fields = fields | {"inner_offset": start, "inner_length": n}
                yield "gap", source.at, used, fields, b""
            else:
                yield "record", source.at, used, fields, block
        if not broken:
            source.drop(used)
            continue
        reason = reason or broken
        packed = packed or source.data.startswith(MAGIC)
        gap = source.at if gap is None else gap
        if items:
            inner = {"inner_offset": items[-1][0] + items[-1][1]}
        source.drop(_next_start(source))
    if gap is not None:
        yield "gap", gap, source.at - gap, {"reason": reason, **inner}, b""


RECORDS = (
    "file string, kind string, offset long, length long, reason string, record_type string, "
    "page_id long, refers_to long, payload_bytes long, payload_digest string, payload binary, "
    "inner_offset long, inner_length long"
)


def _id(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


def read(files: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps of the archives that column ``file`` names.

    The files are dealt by name over twice as many tasks as there are files, a number that
    adaptive execution leaves alone; an archive is read by one task.

    A record whose payload does not have its stated digest is a gap too.  A gap has
    ``kind`` "gap", its offset, length and reason, and its place within a member if known.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, path = opened(file)
                with store.open_input_stream(path, compression=None) as stream:
                    rows, size = [], 0
                    for item in read_stream(stream):
                        rows.append(_shown(file, item, payloads))
                        size += len(rows[-1]["payload"] or b"")
                        if len(rows) >= 1000 or size > 1 << 24:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    spread = files.select("file").repartition(max(1, 2 * files.count()), F.col("file"))
    return spread.mapInArrow(run, RECORDS)


_SCHEMA = pa.schema(
    [
        ("file", pa.string()),
        ("kind", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("reason", pa.string()),
        ("record_type", pa.string()),
        ("page_id", pa.int64()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("inner_offset", pa.int64()),
        ("inner_length", pa.int64()),
    ]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def _shown(file: str, item: tuple, payloads: bool) -> dict:
    kind, offset, length, fields, block = item
    row = dict.fromkeys(_SCHEMA.names) | {"file": file, "offset": offset, "length": length}
    if kind == "gap":
        return row | {"kind": "gap"} | fields
    payload = block.partition(b"\r\n\r\n")[2]
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    revisit = fields.get("warc-type") == "revisit"
    if not revisit and stated and digest(payload) != stated:
        return row | {"kind": "gap", "reason": "bad payload digest"}
    size = fields.get("x-payload-length", "") if revisit else str(len(payload))
    return row | {
        "kind": "record",
        "record_type": fields.get("warc-type"),
        "page_id": _id(fields.get("warc-record-id")),
        "refers_to": _id(fields.get("warc-refers-to")),
        "payload_bytes": int(size) if size.isdecimal() else None,
        "payload_digest": stated or digest(payload),
        "payload": payload if payloads and not revisit else None,
    }


def archived(pages: DataFrame) -> DataFrame:
    """Pages written to archives and read back, one row a record; a gap is an error.

    Null and empty html are the same empty payload, a very long one is one record like any
    other.  Of equal payloads the largest ``page_id`` is the response, rows that repeat it are
    responses too, and a null id is smaller than any other.  An empty table gives no records;
    columns other than ``page_id, url, html`` are ignored, whatever their names.
    """
    files = write(pages, staging_path(pages.sparkSession, "warc"))
    lost = F.raise_error(F.concat_ws(" ", F.lit("gap in archive:"), "file", "offset", "reason"))
    return (
        read(files, payloads=False)
        .where(F.when(F.col("kind") == "record", True).otherwise(lost.cast("boolean")))
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    )
