"""Web archives packed in ZIP files: written by Spark tasks, and read back by byte ranges without extraction.

An archive is a ZIP file with two stored (uncompressed) members: ``archive/data.warc.gz``, a gzip member per record,
and ``indexes/index.cdx``, a JSON line per record with its offset and length. The reader finds the members from the
end of the file (end record, ZIP64 end record, central directory), reads the index, and then reads record ranges;
neighbouring ranges are fetched together. Each archive is one row of a DataFrame, so Spark deals archives to tasks.
Archives lie in a folder that all executors reach, under names of their own; a repeated task writes new ones, and
only those that its manifest rows name are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import cut

#: Payloads from so many bytes on are revisits of an equal one; bytes of an archive, and of one read, about.
REVISIT_BYTES, ARCHIVE_BYTES, READ_BYTES = 1_000, 32 << 20, 4 << 20
#: Parts in which the rows of one payload look up its largest id.
SALTS = 32
LEVEL, DATE = 4, "2024-01-01T00:00:00Z"
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


# ---- records


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'-' if page_id is None else page_id}>"


def _from_urn(urn: str | None) -> int | None:
    name = (urn or "-").rstrip(">").rpartition(":")[2]
    return None if name == "-" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit has the HTTP header, with the full length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {url.replace('%', '%25').replace(chr(13), '%0D').replace(chr(10), '%0A')}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        *([f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"] if revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse_record(data: bytes) -> tuple:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload`` of a record (payload None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    h = _headers(head)
    block = rest[: int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(h["warc-payload-digest"].partition(":")[2]).hex()
    if h["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
    full = int(_headers(http)["content-length"])
    url = h.get("warc-target-uri")
    url = url if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    revisit = h["warc-type"] == "revisit"
    return _from_urn(h["warc-record-id"]), url, h["warc-type"], _from_urn(h.get("warc-refers-to")), full, digest, None if revisit else payload


# ---- ZIP directories


@dataclass
class Member:
    name: str
    method: int
    size: int
    stored_size: int
    header: int  # offset of the local header


def members(read: Callable[[int, int], bytes], size: int) -> list[Member]:
    """The central directory of a ZIP file of ``size`` bytes, ZIP64 or not; ``read(offset, length)`` reads a range."""
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    # The comment may hold the signature itself: the end record is one whose comment ends with the file.
    end = len(tail)
    while (end := tail.rfind(b"PK\x05\x06", 0, end)) >= 0:
        if end + 22 <= len(tail) and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
    if end < 0:
        raise ValueError("no end record: not a ZIP file")
    count, length, offset = struct.unpack_from("<HII", tail, end + 10)
    before = tail_at + end
    if before >= 20 and (locator := read(before - 20, 20))[:4] == b"PK\x06\x07":
        at = struct.unpack_from("<Q", locator, 8)[0]
        end64 = read(at, 56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end record is not where its locator says")
        count, length, offset = struct.unpack_from("<QQQ", end64, 32)
    directory, out, at = read(offset, length), [], 0
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        stored, full, n, m, k = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n].decode("utf-8", "replace")
        extra, e = directory[at + 46 + n : at + 46 + n + m], 0
        while e + 4 <= len(extra):
            kind, room = struct.unpack_from("<HH", extra, e)
            if kind == 1:  # ZIP64: only the fields that are all ones in the entry, in this order
                wide = iter(struct.unpack_from(f"<{room // 8}Q", extra, e + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                header = next(wide) if header == 0xFFFFFFFF else header
            e += 4 + room
        out.append(Member(name, method, full, stored, header))
        at += 46 + n + m + k
    return out


def data_offset(read: Callable[[int, int], bytes], member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    head = read(member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header for {member.name}")
    n, m = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n + m


def records(read: Callable[[int, int], bytes], size: int) -> Iterator[tuple]:
    """All records of an archive, by range reads of those that its index names."""
    found = {m.name: m for m in members(read, size)}
    for name, index in found.items():
        if not (name.startswith("indexes/") and name.endswith(".cdx")):
            continue
        entries = sorted(((e["filename"], int(e["offset"]), int(e["length"])) for e in map(json.loads, read(data_offset(read, index), index.size).splitlines())))
        starts = {f: data_offset(read, found[f"archive/{f}"]) for f in {e[0] for e in entries}}
        i = 0
        while i < len(entries):
            file, first, length = entries[i]
            j, stop = i + 1, first + length
            while j < len(entries) and entries[j][0] == file and entries[j][1] == stop and stop + entries[j][2] - first <= READ_BYTES:
                stop += entries[j][2]
                j += 1
            chunk = read(starts[file] + first, stop - first)
            for _, at, n in entries[i:j]:
                yield parse_record(gzip.decompress(chunk[at - first : at - first + n]))
            i = j


# ---- Spark


def revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, payload, digest, refers_to, revisit``: of equal payloads of at least ``REVISIT_BYTES`` bytes, all but that of the largest id revisit it.

    The rows of a payload meet its largest id in ``SALTS`` parts, so that a page that very many urls answer with is in
    many tasks. Smaller payloads, empty ones among them, meet nothing and are spread by row.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    named = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    named = named.withColumns({"digest": F.sha1("payload"), "digest2": F.sha2("payload", 256), "bytes": F.octet_length("payload")})
    keys = ["digest", "digest2", "bytes"]
    first = named.where(F.col("bytes") >= REVISIT_BYTES).groupBy(*keys).agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>"))
    row = F.xxhash64("page_id", "url")
    named = named.withColumn("salt", F.when(F.col("bytes") >= REVISIT_BYTES, F.pmod(row, F.lit(SALTS))).otherwise(row))
    out = named.join(cut(first.drop("n")).withColumn("salt", salts), [*keys, "salt"], "left")
    return out.select("page_id", "url", "payload", "digest", F.col("first").alias("refers_to"), (F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))).alias("revisit"))


def _write(folder: str):
    def flush(body: io.BytesIO, index: list[str]) -> tuple[str, int, int]:
        from pyarrow import fs

        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_STORED) as z:
            z.writestr(WARC_MEMBER, body.getvalue())
            z.writestr(INDEX_MEMBER, "\n".join(index))
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        with store.open_output_stream(f"{path}/{name}") as out:
            out.write(packed.getbuffer())
        return f"{folder}/{name}", packed.getbuffer().nbytes, len(index)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        body, index, made = io.BytesIO(), [], []
        for batch in batches:
            columns = (batch[c] for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit"))
            for page_id, url, payload, digest, refers_to, revisit in zip(*columns, strict=True):
                ids = (None if pd.isna(x) else int(x) for x in (page_id, refers_to))
                own, other = ids
                packed = gzip.compress(record(own, url, payload.encode("utf-8", "surrogatepass"), digest, other, revisit), LEVEL, mtime=0)
                index.append(json.dumps({"offset": body.tell(), "length": len(packed), "filename": WARC_MEMBER.partition("/")[2]}))
                body.write(packed)
                if body.tell() >= ARCHIVE_BYTES:
                    made.append(flush(body, index))
                    body, index = io.BytesIO(), []
        if index:
            made.append(flush(body, index))
        yield pd.DataFrame(made, columns=["path", "bytes", "records"])

    return write


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes ``pages`` to archives in ``folder`` (a URI or path that executors reach); returns ``path, bytes, records`` of each.

    Null html is an empty payload; a null url is left out of the record; rows that repeat an id are records each, and
    those with the largest id of equal payloads are all responses. An empty table writes nothing.
    """
    rows = revisits(pages, id_col, url_col, html_col)
    return cut(rows.mapInPandas(_write(folder), "path string, bytes long, records long"))


def read_archives(archives: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the archives that ``archives`` names in ``path``; with ``payload`` as binary (null for revisits) if wanted.

    A response whose payload does not match its digest, a compressed member or a broken directory raises an error.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        frame = lambda rows: pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})[names if payload else names[:-1]]
        for batch in batches:
            for uri in batch["path"]:
                store, path = fs.FileSystem.from_uri(uri)
                with store.open_input_file(path) as f:
                    rows, held = [], 0
                    for row in records(lambda at, n, f=f: f.read_at(n, at), f.size()):
                        rows.append(row if payload else (*row[:-1], None))
                        held += row[4] if payload else 200
                        if held > READ_BYTES:
                            yield frame(rows)
                            rows, held = [], 0
                    yield frame(rows)

    return archives.select("path").mapInPandas(read, _RECORD + (", payload binary" if payload else ""))
