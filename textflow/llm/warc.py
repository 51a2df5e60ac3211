"""WARC archives: written as one gzip stream each, made anew with one gzip member for each record and an index."""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.llm.tables import written
from textflow.session import work_folder

# Bytes of payload after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
RAW_LEVEL, MEMBER_LEVEL = 1, 4
# Names and lines of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"

RECORD_COLUMNS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
ARCHIVE_COLUMNS = "archive string, records long, bytes long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    number = uri.strip("<>").rpartition(":")[2]
    return None if number == "none" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,) -> bytes:
    """One record. A revisit has no payload of its own: the http head tells its length, the WARC head its digest and
    the response that has it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", EPOCH),
        ("WARC-Target-URI", quote(url or "", safe="/:?#[]@!$&'()*+,;=%~")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields[4:4] = [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:] if x)}


def inflated(source: io.IOBase) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, piece by piece."""
    unzip, rest = zlib.decompressobj(31), b""
    while True:
        rest = rest or source.read(CHUNK)
        if not rest:
            if not unzip.eof:
                yield unzip.flush()
                if not unzip.eof:
                    raise EOFError("a gzip stream ends early")
            return
        if unzip.eof:
            unzip = zlib.decompressobj(31)
        piece = unzip.decompress(rest, CHUNK)
        rest = unzip.unused_data if unzip.eof else unzip.unconsumed_tail
        if piece:
            yield piece


def records(source: io.IOBase) -> Iterator[bytes]:
    """The records of an archive, cut by their declared lengths, inflating the file once from its start."""
    held = bytearray()
    pieces = inflated(source)

    def need(count: int) -> bool:
        while len(held) < count:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        at = 0
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            at = max(0, len(held) - 3)
            if not need(len(held) + 1):
                if held.strip():
                    raise EOFError("an archive ends within a record")
                return
        length = end + 4 + int(parse_head(bytes(held[:end]))["content-length"]) + 4
        if not need(length):
            raise EOFError("an archive ends within a record")
        yield bytes(held[:length])
        del held[:length]


def _open(url: str) -> tuple[fs.FileSystem, str]:
    """A shared folder by its url; a path without scheme is a mounted one."""
    return fs.FileSystem.from_uri(url) if ":" in url.split("/")[0] else (fs.LocalFileSystem(), url)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes pages (`page_id, url, html, first_page`) as archives, each one gzip stream, `archive_bytes` of
    payload or a little more; returns the names of the archives, `archive`.

    A page whose `first_page` is another one becomes a revisit. Every attempt of a task writes under new names and only
    the names that the table of the result has committed count, so a repeated or lost task leaves no record
    twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        out, zipped, size, done = None, None, 0, []

        def close() -> None:
            nonlocal out
            if out is not None:
                out.write(zipped.flush())
                out.close()
                out = None

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url", "html", "first_page")]
            for i in range(batch.num_rows):
                page_id, url, html, first = (c[i].as_py() for c in columns)
                payload = (html or "").encode()
                if out is None:
                    done.append(f"raw-{uuid.uuid4().hex}.warc.gz")
                    out, zipped, size = system.open_output_stream(f"{root}/{done[-1]}", compression=None), zlib.compressobj(RAW_LEVEL, zlib.DEFLATED, 31), 0
                revisit = first is not None and first != page_id
                out.write(zipped.compress(record(page_id, url, payload, first, revisit)))
                size += len(payload)
                if size >= archive_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}" for name in done], pa.string())], names=["archive"])

    return written(pages.mapInArrow(run, "archive string"), "archives")


def one_task_each(archives: DataFrame) -> DataFrame:
    """The names of archives, one in a task: their rows are small, the files are not."""
    return archives.repartition(max(1, archives.count()))


def normalise(archives: DataFrame) -> DataFrame:
    """Makes each archive anew: it is inflated once from start to end, and every record becomes a gzip member
    of its own. Next to the new archive lies its index, a line `offset length record-id` for each record. Returns
    `archive, records, bytes` of the new ones.

    Memory is that of one record and one piece of the stream, and of the archive's index. Names are new for each
    attempt, as in `write_archives`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch.column(0).to_pylist():
                system, path = _open(url)
                folder, name = url.rpartition("/")[0], f"{uuid.uuid4().hex}.warc.gz"
                target = f"{path.rpartition('/')[0]}/{name}"
                at, lines = 0, []
                with system.open_input_stream(path, compression=None) as source, system.open_output_stream(target, compression=None) as out:
                    for each in records(source):
                        zipper = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, 31)
                        member = zipper.compress(each) + zipper.flush()
                        out.write(member)
                        name_of = parse_head(each[: each.index(b"\r\n\r\n")])["warc-record-id"]
                        lines.append(f"{at} {len(member)} {quote(name_of)}\n")
                        at += len(member)
                with system.open_output_stream(f"{target}.idx", compression=None) as index:
                    index.write("".join(lines).encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{folder}/{name}"], pa.string()), pa.array([len(lines)], pa.int64()), pa.array([at], pa.int64())],
                    names=["archive", "records", "bytes"],
                )

    return written(one_task_each(archives).mapInArrow(run, ARCHIVE_COLUMNS), "normalised")


def read_index(system: fs.FileSystem, path: str) -> list[tuple[int, int, str]]:
    """The lines of a sidecar index."""
    with system.open_input_stream(f"{path}.idx", compression=None) as source:
        lines = source.read().decode().split("\n")
    return [(int(a), int(n), unquote(i)) for a, n, i in (x.split(" ") for x in lines if x)]


def describe(each: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page, bytes and digest of the payload, type, page referred to) of a record; the digest of a response is made
    from the payload that was read, and has to be the one its head declares."""
    end = each.index(b"\r\n\r\n")
    head = parse_head(each[:end])
    block = each[end + 4 : end + 4 + int(head["content-length"])]
    http_end = block.index(b"\r\n\r\n")
    http = dict(x.split(b": ", 1) for x in block[:http_end].split(b"\r\n")[1:])
    payload, declared = block[http_end + 4 :], head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "revisit":
        return page_of(head["warc-record-id"]), int(http[b"Content-Length"]), declared, "revisit", page_of(head["warc-refers-to"])
    if digest(payload) != declared:
        raise ValueError(f"{head['warc-record-id']}: the payload is not the one that was written")
    return page_of(head["warc-record-id"]), len(payload), declared, "response", None


def read_records(archives: DataFrame, at_once: int = 1000) -> DataFrame:
    """`page_id, payload_bytes, payload_digest, record_type, refers_to` of all records of the archives: each is found
    by its line in the index, read from its offset and inflated alone."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch.column(0).to_pylist():
                system, path = _open(url)
                index = read_index(system, path)
                with system.open_input_file(path) as source:
                    for first in range(0, len(index), at_once):
                        rows = []
                        for at, length, _ in index[first : first + at_once]:
                            source.seek(at)
                            rows.append(describe(zlib.decompress(source.read(length), 31)))
                        columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    return one_task_each(archives.select("archive")).mapInArrow(run, RECORD_COLUMNS)


def with_first_page(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages (`page_id, url, html`) with `first_page`, the smallest page with an equal payload: null where no
    other payload is equal or the payload has fewer than `least_bytes` bytes.

    Hashes alone are grouped, after a count in each task, so any number of copies is one row of a task. The pages
    get to know their first one by a join on the hash, in which Spark splits a frequent one. Null page ids come
    last: they are revisits of a page with an id, and responses where there is none. Rows that repeat the smallest
    id are all responses. Null html is an empty payload.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    hashed = pages.select("page_id", "url", "html", F.sha1(payload.cast("binary")).alias("__hash"))
    long_enough = hashed.filter(F.octet_length(payload) >= least_bytes)
    firsts = long_enough.groupBy("__hash").agg(F.min("page_id").alias("first_page"), F.count("*").alias("__n"))
    firsts = written(firsts.filter("__n > 1").drop("__n"), "first_pages")
    return hashed.join(firsts, "__hash", "left").drop("__hash")


def archive_and_read(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Writes pages as archives to `folder` (by default one below the shared folder), makes them anew with an index
    and reads all records back through it: a row for each page, as `read_records` gives it."""
    folder = folder or work_folder(pages.sparkSession, "warc")
    return read_records(normalise(write_archives(with_first_page(pages, least_bytes), folder)))
