"""WARC records in ZIP packages, and a reader that never extracts them.

Writing: every task packs its rows into archives of its own. An archive is a ZIP package (ZIP64 fields, members stored,
not deflated) of `archive/data.warc.gz`, in which each record is a gzip member, and `indexes/index.cdxj`, a line for
each record with its place. Of records with equal payloads of at least `least` bytes that with the largest id is the
response, the others are revisits that refer to it and carry no payload. An archive's name is fresh for each attempt and
counts only through the row that names it, so lost or repeated tasks leave no trace in the result.

Reading: the end record, the ZIP64 locator and record where they are, and the central directory are parsed from ranges
of bytes; the stored members' places follow. Any member named *.warc.gz or *.warc is an archive, any named *.cdxj, *.cdx,
*.jsonl or *.json (or those with .gz) an index, of lines that end in a JSON object with offset, length and, if there are
several archives, filename. Indexed records are read by range, neighbours together; an archive that no index lists, or that
the package deflates, is read through, gzip member after member or, unpacked, by the lengths that records state. Deflated
indexes are inflated. Members of those names that hold no index count as none, and records that are neither response nor
revisit are passed over.

Null payloads are empty ones. Very long payloads are records like others; one record at a time is in memory. Of equal ids
among equal payloads, ties, one row is the response and the others refer to the same id. Null ids are kept as null and count as smaller than any other. Rows that repeat an id and
a payload are records each. An empty table gives no archive and an empty result. Extra columns are not written.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import lean, new_path, written

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVES, INDEXES = (".warc.gz", ".warc"), (".cdxj", ".cdx", ".jsonl", ".json")
#: An archive is closed when it holds so many bytes; a range of neighbouring records that is read at once.
ARCHIVE_BYTES, READ_BYTES = 64 << 20, 2 << 20
LENGTH, PAGE = re.compile(rb"(?im)^content-length:[ \t]*(\d+)"), re.compile(r"<urn:page:(-?\d+)>")
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- records


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    """One gzip member. A revisit keeps the response's HTTP header, with the payload's length, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    uri = "".join(c if " " < c < "\x7f" else f"%{b:02X}" if len(e := c.encode("utf-8", "replace")) == 1 and (b := e[0]) is not None else "".join(f"%{b:02X}" for b in e) for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 3, mtime=0)


def parsed(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers and HTTP headers (names in lower case), and the payload, of a gzip member or a bare record."""
    raw = zlib.decompress(member, wbits=31) if member[:2] == b"\x1f\x8b" else member
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = lambda lines: {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines)}
    warc = fields(head.split(b"\r\n")[1:])
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, fields(http.split(b"\r\n")[1:]), payload


# ---- packages


class Package:
    """A ZIP package being written to a stream that needs no seeking."""

    def __init__(self, folder: str):
        files, path = opened(folder)
        files.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.zip"
        self.stream = files.open_output_stream(f"{path}/{self.name}")
        self.zip = zipfile.ZipFile(_Forward(self.stream), "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.lines: list[str] = []
        self.at = 0

    def add(self, page_id: int | None, body: bytes) -> None:
        self.member.write(body)
        self.lines.append(f"urn:page:{'none' if page_id is None else page_id} 19700101000000 " + json.dumps({"offset": self.at, "length": len(body), "filename": DATA.rpartition("/")[2]}))
        self.at += len(body)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.lines))
        self.zip.close()
        self.stream.close()
        return self.name, len(self.lines), self.at


class _Forward(io.RawIOBase):
    def __init__(self, stream):
        self.stream = stream

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        return len(data)


def typed(pages: DataFrame, least: int = 0) -> DataFrame:
    """pages(page_id, url, html) with sha, kind and refers_to. Payloads are compared by digest; html moves once, by page_id."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("sha"), F.octet_length(html).alias("n"))
    keys = rows.select("page_id", "sha", "n").distinct()
    last = keys.groupBy("sha").agg(F.max("page_id").alias("last"))
    known = keys.join(last, "sha").select(F.col("page_id").alias("__id"), F.col("sha").alias("__sha"), F.when((F.col("n") >= least) & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))
    out = rows.join(known, rows.page_id.eqNullSafe(known["__id"]) & (rows.sha == known["__sha"]))
    return out.select("page_id", "url", "html", "refers_to")


def write(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write all rows; the result has a row for each archive that counts: archive, records, bytes."""

    @lean
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for page_id, url, html, refers in zip(*(c.to_pylist() if i != 2 else c for i, c in enumerate(batch.columns))):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                package = package or Package(folder)
                package.add(page_id, record(page_id, url, payload, "response" if refers is None else "revisit", refers))
                if package.at >= ARCHIVE_BYTES:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["archive", "records", "bytes"])

    packed = typed(pages, least).mapInArrow(pack, "archive string, records long, bytes long")
    return written(packed, "warc-manifest")


# ---- the reader


class Archive:
    """The members of a ZIP package, found by ranges of bytes."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size = file, file.size()
        self.members = {name: (method, size, at) for name, method, size, at in self._directory()}

    def read(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def _directory(self) -> Iterator[tuple[str, int, int, int]]:
        tail_at = max(0, self.size - 22 - 0xFFFF - 20)
        tail = self.read(tail_at, self.size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        while end >= 0 and (len(tail) < end + 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
            end = tail.rfind(b"PK\x05\x06", 0, end)  # the signature may stand in a comment
        if end < 0:
            raise ValueError("no end record: not a ZIP package")
        count, length, at = struct.unpack_from("<HII", tail, end + 10)
        if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":
            place = struct.unpack_from("<Q", tail, end - 12)[0]
            big = self.read(place, 56)
            if big[:4] != b"PK\x06\x06":
                raise ValueError("the ZIP64 locator leads nowhere")
            count, length, at = struct.unpack_from("<QQQ", big, 32)
        entries, k = self.read(at, length), 0
        for _ in range(count):
            if entries[k : k + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            method, packed, size, n, m, c, offset = *struct.unpack_from("<H", entries, k + 10), *struct.unpack_from("<II", entries, k + 20), *struct.unpack_from("<HHH", entries, k + 28), struct.unpack_from("<I", entries, k + 42)[0]
            name, extra = entries[k + 46 : k + 46 + n].decode("utf-8", "replace"), entries[k + 46 + n : k + 46 + n + m]
            e = 0
            while e + 4 <= len(extra):
                tag, width = struct.unpack_from("<HH", extra, e)
                if tag == 1:  # ZIP64: only those fields that overflowed, in this order
                    wide = list(struct.unpack_from(f"<{width // 8}Q", extra, e + 4))
                    size = wide.pop(0) if size == 0xFFFFFFFF else size
                    packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                    offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
                e += 4 + width
            yield name, method, packed, offset
            k += 46 + n + m + c

    def stored(self, name: str) -> tuple[int, int]:
        """(place of the first byte, size) of a stored member."""
        method, size, at = self.members[name]
        if method:
            raise ValueError(f"{name} is deflated, so it has no ranges")
        head = self.read(at, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"{name} isn't where the directory has it")
        n, m = struct.unpack_from("<HH", head, 26)
        return at + 30 + n + m, size

    def chunks(self, name: str) -> Iterator[bytes]:
        """A member's content, piece by piece; a deflated one is inflated."""
        method, size, at = self.members[name]
        if method not in (0, 8):
            raise ValueError(f"{name} is packed by method {method}")
        self.members[name] = 0, size, at
        try:
            place, _ = self.stored(name)
        finally:
            self.members[name] = method, size, at
        inflate = zlib.decompressobj(-15) if method else None
        for k in range(0, size, READ_BYTES):
            part = self.read(place + k, min(READ_BYTES, size - k))
            while inflate and part:
                yield inflate.decompress(part, READ_BYTES)
                part = inflate.unconsumed_tail
            if not inflate:
                yield part
        if inflate:
            yield inflate.flush()

    def indexed(self) -> dict[str, list[tuple[int, int]]]:
        """Of each archive member, the places (offset, length) that the package's indexes list, in order. Members that are named
        like an index and hold none count as none."""
        archives = [m for m in self.members if m.endswith(ARCHIVES)]
        named = {m.rpartition("/")[2]: m for m in archives}
        found: dict[str, set[tuple[int, int]]] = {m: set() for m in archives}
        for name in self.members:
            if name.removesuffix(".gz").endswith(INDEXES) and name not in found:
                body = b"".join(self.chunks(name))
                try:
                    lines = (gzip.decompress(body) if name.endswith(".gz") else body).splitlines()
                except (OSError, EOFError, zlib.error):
                    continue
                for line in lines:
                    try:
                        entry = json.loads(line[line.index(b"{") :])
                        place = int(entry["offset"]), int(entry["length"])
                    except (ValueError, KeyError, TypeError):
                        continue  # a header, or a line of another kind of JSON member
                    of = named.get(str(entry.get("filename", "")).rpartition("/")[2]) or (archives[0] if len(archives) == 1 else None)
                    if of:
                        found[of].add(place)
        return {m: sorted(places) for m, places in found.items()}

    def records(self) -> Iterator[bytes]:
        """The records of all archives: by their index, neighbours read together, or else one after the other. A member that
        the package deflates has no ranges, so it is read through."""
        for name, places in self.indexed().items():
            if not places or self.members[name][0]:
                yield from (_members if name.endswith(".gz") else _plain)(self.chunks(name))
                continue
            start, total = self.stored(name)
            i = 0
            while i < len(places):
                j, first = i, places[i][0]
                while j < len(places) and places[j][0] + places[j][1] - first <= max(READ_BYTES, places[i][1]):
                    j += 1
                if places[j - 1][0] + places[j - 1][1] > total:
                    raise ValueError("the index leaves its member")
                body = self.read(start + first, places[j - 1][0] + places[j - 1][1] - first)
                yield from (body[a - first : a - first + n] for a, n in places[i:j])
                i = j


def _members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Gzip members without an index: where one ends, the next begins."""
    unzip, member = zlib.decompressobj(wbits=31), []
    for held in chunks:
        while held:
            unzip.decompress(held)
            used = len(held) - len(unzip.unused_data)
            member.append(held[:used])
            held = held[used:]
            if unzip.eof:
                yield b"".join(member)
                unzip, member = zlib.decompressobj(wbits=31), []
    if member:
        raise ValueError("the last record is cut off")


def _plain(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Records that aren't packed: a head states how long its block is."""
    held = bytearray()
    for chunk in chunks:
        held += chunk
        while (end := held.find(b"\r\n\r\n", len(held) - len(held.lstrip(b"\r\n")))) >= 0:
            size = LENGTH.search(held, 0, end)
            if not size:
                raise ValueError("a record without a length")
            total = end + 4 + int(size[1])
            if len(held) < total:
                break
            yield bytes(held[:total]).lstrip(b"\r\n")
            del held[:total]
    if held.strip(b"\r\n"):
        raise ValueError("the last record is cut off")


def facts(member: bytes) -> tuple[int | None, int, str, str, int | None] | None:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; none of a record that is neither response nor revisit."""
    warc, http, payload = parsed(member)
    kind = warc.get("warc-type", "")
    if kind not in ("response", "revisit"):
        return None
    number = lambda x: int(m[1]) if (m := PAGE.fullmatch(x or "")) else None
    digest = warc.get("warc-payload-digest", f"sha1:{digest_of(payload)}").removeprefix("sha1:")
    if kind == "response" and digest_of(payload) != digest:
        raise ValueError(f"{warc['warc-record-id']}: the payload doesn't have its digest")
    return number(warc.get("warc-record-id")), int(http.get("content-length", len(payload))), digest, kind, number(warc.get("warc-refers-to"))


def read(archives: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """A row for each record of the named archives: page_id, payload_bytes, payload_digest, record_type, refers_to, and the
    payload as stored (none for revisits) if asked for."""
    names = [f.split()[0] for f in RECORDS.split(", ")] + ["payload"] * payload

    @lean
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch.archive:
                files, path = opened(folder)
                with files.open_input_file(f"{path}/{name}") as f:
                    rows: list = []
                    for member in Archive(f).records():
                        if (known := facts(member)) is None:
                            continue
                        rows.append(known + ((parsed(member)[2],) if payload else ()))
                        if len(rows) >= (500 if payload else 20_000):
                            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
                            rows = []
                    yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    spread = archives.select("archive").repartition(max(1, archives.count()))
    return spread.mapInPandas(scan, RECORDS + ", payload binary" * payload)


def round_trip(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    folder = new_path(spark, "warc")
    return read(write(pages, folder, least), folder)
