"""WARC archives: write them, and normalise archives that were compressed as one gzip stream.

An archive in one stream cannot be read from the middle. The normaliser inflates such a stream once, record
by record, rewrites each record as a gzip member of its own, and writes a sidecar with each member's offset,
length, type and ids, so that any record is one seek away. A stream is read by one task, as gzip asks; the
writer starts a new archive at `most_bytes`, and records pass through in pieces.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.files import default_folder, in_arrow, new_file, one_each, open_file, open_stream
from tallyloom.session import materialise

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PIECE = 1 << 20
HEAD_LINE = 1 << 16
SIDECAR = ".idx"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def mark_revisits(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html and refers_to: null, or the largest page_id of the pages with this payload.

    Payloads below `min_bytes` never refer. A null html is an empty payload. Equal payloads are counted by
    digest before anything is joined, so no group of copies meets in one task; pages without an id refer, if
    another page has one. Rows that repeat an id with its payload stay as they are.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select("page_id", "url", "html", F.sha1(payload).alias("_sha1"), F.octet_length(payload).alias("_bytes"))
    groups = own.where(F.col("_bytes") >= min_bytes).groupBy("_sha1").agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("n"))
    # written first: where few payloads recur, the table is small and the pages need no shuffle
    last = materialise(groups.where(F.col("n") > 1).select("_sha1", "_last"), "payloads")
    refers = F.when(~F.col("_last").eqNullSafe(F.col("page_id")) & (F.col("_bytes") >= min_bytes), F.col("_last"))
    return own.join(last, "_sha1", "left").select("page_id", "url", "html", refers.alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response record, or a revisit record whose HTTP head still tells the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_monolithic(
    pages: DataFrame, *, folder: str | None = None, level: int = 1, most_bytes: int = 1 << 30, date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """Archives of the pages (page_id, url, html, refers_to), each one gzip stream: path, n_records."""
    folder = default_folder(pages.sparkSession, folder, "warc-streams")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, count, size = "", None, 0, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path, stream = new_file(folder, ".warc.gz")
                    out, count, size = gzip.GzipFile(fileobj=stream, mode="wb", compresslevel=level, mtime=0), 0, 0
                data = record(row[0], row[1], (row[2] or "").encode(), row[3], date)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= most_bytes:
                    out.close()
                    stream.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [count]})
        if out is not None:
            out.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [count]})

    rows = pages.select("page_id", "url", "html", "refers_to")
    return materialise(in_arrow(rows, write, "path string, n_records long"), "warc-manifest")


def _line(stream: io.BufferedIOBase) -> bytes:
    """The next line whole, however long; read in pieces."""
    parts = [stream.readline(HEAD_LINE)]
    while len(parts[-1]) == HEAD_LINE and not parts[-1].endswith(b"\n"):
        parts.append(stream.readline(HEAD_LINE))
    return b"".join(parts)


def read_head(stream: io.BufferedIOBase) -> dict[str, str] | None:
    """The fields of the next record's head, names in lower case; None at the end."""
    line = _line(stream)
    while line in (b"\r\n", b"\n"):
        line = _line(stream)
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {line[:40]!r}")
    fields = {"": line.decode().strip()}
    while (line := _line(stream)).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


class _Member:
    """One gzip member, written in pieces."""

    def __init__(self, out, level: int):
        self.out, self.size, self.packer = out, 0, zlib.compressobj(level, zlib.DEFLATED, 16 + zlib.MAX_WBITS)

    def write(self, data: bytes) -> None:
        self._put(self.packer.compress(data))

    def close(self) -> int:
        self._put(self.packer.flush())
        return self.size

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.size += len(data)


NAMES = {
    "warc-type": "WARC-Type", "warc-record-id": "WARC-Record-ID", "warc-date": "WARC-Date", "warc-target-uri": "WARC-Target-URI",
    "warc-payload-digest": "WARC-Payload-Digest", "warc-refers-to": "WARC-Refers-To", "warc-profile": "WARC-Profile",
    "content-type": "Content-Type", "content-length": "Content-Length",
}


def _rewrite(source, out, level: int) -> Iterator[tuple[int, int, str, str]]:
    """Copies each record into a member; offset, length, type and id of each."""
    at = 0
    while (fields := read_head(source)) is not None:
        member = _Member(out, level)
        lines = [fields.pop("")] + [f"{NAMES.get(n, n)}: {v}" for n, v in fields.items()]
        member.write("\r\n".join(lines).encode() + b"\r\n\r\n")
        left = int(fields["content-length"])
        while left:
            if not (data := source.read(min(PIECE, left))):
                raise ValueError("the stream ends inside a record")
            member.write(data)
            left -= len(data)
        member.write(b"\r\n\r\n")
        size = member.close()
        yield at, size, fields.get("warc-type", ""), fields.get("warc-record-id", "")
        at += size


def normalise(files: DataFrame, *, folder: str | None = None, level: int = 6) -> DataFrame:
    """Rewrite archives (`path`) record by record: source, path, index_path, n_records, n_bytes.

    The sidecar has a line for each record: offset, length, type and record id, by tabs. An archive of several
    members is read through as well; a damaged one raises. An empty archive has an empty result and sidecar.
    """
    folder = default_folder(files.sparkSession, folder, "warc-members")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target, out = new_file(folder, ".warc.gz")
                count = size = 0
                with open_stream(path) as raw, gzip.GzipFile(fileobj=raw) as whole, out:
                    index_path, index = new_file(folder, SIDECAR)
                    with index:
                        for at, length, kind, name in _rewrite(io.BufferedReader(whole, PIECE), out, level):
                            index.write(f"{at}\t{length}\t{kind}\t{name}\n".encode())
                            count, size = count + 1, at + length
                row = {"source": [path], "path": [target], "index_path": [index_path], "n_records": [count], "n_bytes": [size]}
                yield pa.RecordBatch.from_pydict(row)

    rows = one_each(files.select("path"))
    return materialise(in_arrow(rows, rewrite, "source string, path string, index_path string, n_records long, n_bytes long"), "warc-index")


def read_member(file, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Head and block of the record in one member."""
    data = io.BytesIO(gzip.decompress(file.read_at(length, offset)))
    fields = read_head(data)
    return fields, data.read(int(fields["content-length"]))


RECORDS = pa.schema({
    "page_id": pa.int64(), "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string(),
    "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary(),
})


def _record_row(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    page = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    head, _, payload = block.partition(b"\r\n\r\n")
    if fields["warc-type"] == "revisit":
        size, digest, payload = int(re.search(rb"(?i)content-length: *(\d+)", head)[1]), fields["warc-payload-digest"].removeprefix("sha1:"), None
    else:
        size, digest = len(payload), payload_digest(payload)
    return page("warc-record-id"), fields["warc-type"], page("warc-refers-to"), fields.get("warc-target-uri"), size, digest, payload if with_payload else None


def read_archives(archives: DataFrame, *, with_payload: bool = True, batch_bytes: int = 16 << 20) -> DataFrame:
    """Every record of normalised archives, by its sidecar's offsets.

    page_id, record_type, refers_to, url, payload_bytes, payload_digest (both of the full payload; recomputed for a
    response, from the record's head for a revisit), payload (null for a revisit).
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, index_path in zip(*(c.to_pylist() for c in batch.columns)):
                rows, held = [], 0
                with open_file(path) as file, open_stream(index_path) as index:
                    for line in io.BufferedReader(index, PIECE):
                        offset, length, _ = line.split(b"\t", 2)
                        rows.append(_record_row(*read_member(file, int(offset), int(length)), with_payload))
                        held += len(rows[-1][-1] or b"") + 256
                        if held >= batch_bytes:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORDS)], schema=RECORDS)

    schema = "page_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string, payload binary"
    return in_arrow(one_each(archives.select("path", "index_path")), read, schema)
