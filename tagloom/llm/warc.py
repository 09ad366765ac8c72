"""WARC archives: whole-file gzip streams of records, rewritten one member per record with an offset index."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import new_folder, qualified, written

CHUNK = 1 << 16
# An archive is closed once its records have this many bytes.
ARCHIVE_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ANY_GZIP = zlib.MAX_WBITS | 16


def _open(folder: str):
    """File system and path of a folder's URI, as ``qualified`` gives it; a bare path is one of this machine."""
    if "://" in folder or folder.startswith("file:"):
        return pa.fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))
    return pa.fs.LocalFileSystem(), folder


def _header(value: object) -> str:
    """A header value without line ends and other control characters."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(value))


def record_head(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *[f"{name}: {_header(value)}" for name, value in fields if value is not None], "", ""]
    return "\r\n".join(lines).encode()


def page_record(page_id, url, payload: bytes | None, n: int, digest: str, refers_to, date: str) -> bytes:
    """A response with the payload, or (without it) a revisit that names the page it repeats."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = [
        ("WARC-Type", "revisit" if payload is None else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Page-ID", page_id),
        ("WARC-Refers-To-Page-ID", refers_to if payload is None else None),
        ("WARC-Profile", PROFILE if payload is None else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    return record_head(head) + block + b"\r\n\r\n"


def inflated(stream) -> Iterator[bytes]:
    """What a gzip file holds, be it one member or many, in bounded chunks; a cut-off file raises ``EOFError``."""
    engine, open_member = zlib.decompressobj(ANY_GZIP), False
    while data := stream.read(CHUNK):
        while data:
            if engine.eof:
                engine = zlib.decompressobj(ANY_GZIP)
            out = engine.decompress(data, CHUNK)
            open_member = not engine.eof
            yield out
            data = engine.unused_data if engine.eof else engine.unconsumed_tail
    while open_member:
        out = engine.decompress(b"", CHUNK)
        if not out:
            raise EOFError("the gzip stream is cut off")
        yield out
        open_member = not engine.eof


class Records:
    """Records of an inflated stream, one after the other; a body is read in chunks and need not fit in memory."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.held = chunks, b""

    def _more(self) -> bool:
        for chunk in self.chunks:
            if chunk:
                self.held += chunk
                return True
        return False

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._more():
                raise EOFError("the record is cut off")
            part, self.held = self.held[:n], self.held[n:]
            n -= len(part)
            yield part

    def __iter__(self) -> Iterator[tuple[bytes, dict[str, str], Iterator[bytes]]]:
        """(head as stored, its fields in lower case, the block). The block must be read before the next record."""
        while True:
            while self.held[:2] == b"\r\n" or len(self.held) < 2:
                if self.held[:2] == b"\r\n":
                    self.held = self.held[2:]
                elif not self._more():
                    if self.held:
                        raise EOFError("the record is cut off")
                    return
            while (end := self.held.find(b"\r\n\r\n")) < 0:
                if not self._more():
                    raise EOFError("the record is cut off")
            head, self.held = self.held[: end + 4], self.held[end + 4 :]
            lines = head.decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no record begins here: {lines[0][:40]!r}")
            fields = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:]) if name}
            yield head, fields, self.take(int(fields["content-length"]))


def normalise(source, target, level: int = 6) -> Iterator[dict]:
    """Rewrites a gzip stream of records with a gzip member for each; yields the index entry of each record."""
    at = 0
    for head, fields, body in Records(inflated(source)):
        engine = zlib.compressobj(level, zlib.DEFLATED, ANY_GZIP)
        size = target.write(engine.compress(head)) or 0
        for part in body:
            size += target.write(engine.compress(part)) or 0
        size += target.write(engine.compress(b"\r\n\r\n") + engine.flush()) or 0
        names = ("warc-record-id", "warc-type", "warc-target-uri", "warc-payload-digest")
        yield {"offset": at, "length": size} | {name: fields.get(name) for name in names}
        at += size


@dataclass
class _Writer:
    """Writes whole-file gzip archives of a task, a new one whenever one is full. Names are new for every attempt."""

    folder: str
    archive_bytes: int

    def __post_init__(self):
        self.system, self.path = _open(self.folder)
        self.system.create_dir(self.path, recursive=True)
        self.file = None

    def add(self, record: bytes) -> None:
        if self.file is None:
            self.name, self.size, self.n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
            self.file = self.system.open_output_stream(f"{self.path}/{self.name}", compression=None)
            self.engine = zlib.compressobj(1, zlib.DEFLATED, ANY_GZIP)
        self.file.write(self.engine.compress(record))
        self.size, self.n = self.size + len(record), self.n + 1

    def full(self) -> bool:
        return self.file is not None and self.size >= self.archive_bytes

    def close(self) -> tuple[str, int]:
        self.file.write(self.engine.flush())
        self.file.close()
        self.file = None
        return self.name, self.n


ARCHIVES = T.StructType([T.StructField("name", T.StringType()), T.StructField("records", T.LongType())])


def write_raw(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 100,
    date: str = "1970-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes a record for every page to archives compressed as one stream each; (name, records) of each archive.

    Pages with equal payloads (the UTF-8 bytes of ``html``) of at least
    ``min_bytes`` are one response, that with the smallest ``page_id``, and
    revisits of it. A NULL html is an empty payload. A page without an id is a
    revisit if a page with one has its payload, else a response; rows that
    repeat the smallest id are responses. Other columns are ignored; no pages
    give no archives.

    Only digests are shuffled to find the responses. They are written to a table
    of their own, so that Spark broadcasts it if it is small and otherwise splits
    the join where one payload is very common. Only archives named in the result
    count: what a lost attempt has written has another name.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("n"),
    )
    firsts = (
        rows.filter(F.col("n") >= min_bytes)
        .groupBy(F.col("digest").alias("shared"))
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter((F.col("copies") > 1) & F.col("first").isNotNull())
        .select("shared", "first")
    )
    firsts = written(firsts, "page-responses")
    typed = rows.join(firsts, F.col("digest") == F.col("shared"), "left").select(
        "page_id", "url", "digest", "n",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
        "payload",
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = _Writer(folder, archive_bytes), []
        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, digest, n, refers_to, body = [batch.column(c)[at].as_py() for c in range(6)]
                writer.add(page_record(page_id, url, body if refers_to is None else None, n, digest, refers_to, date))
                if writer.full():
                    done.append(writer.close())
        if writer.file is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], ARCHIVES.names
        )

    return written(typed.mapInArrow(write, ARCHIVES), "raw-archives")


def normalise_archives(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrites archives of ``source`` in ``target``, one gzip member per record, each with an index beside it.

    The index is a file of JSON lines: offset, length and the main fields of every record, in order. Gives (name,
    records) of the archives written; an archive is read once, as a stream, by one task.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(source)
        out_system, out_path = _open(target)
        out_system.create_dir(out_path, recursive=True)
        for batch in batches:
            names, counts = [], []
            for value in batch.column(0):
                name, n = f"{uuid.uuid4().hex}.warc.gz", 0
                with (
                    system.open_input_stream(f"{path}/{value.as_py()}", compression=None) as raw,
                    out_system.open_output_stream(f"{out_path}/{name}", compression=None) as out,
                    out_system.open_output_stream(f"{out_path}/{name}.index", compression=None) as index,
                ):
                    for entry in normalise(raw, out):
                        index.write(json.dumps(entry, ensure_ascii=False).encode() + b"\n")
                        n += 1
                names.append(name)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ARCHIVES.names)

    return written(_one_per_task(archives).mapInArrow(rewrite, ARCHIVES), "archives")


def _one_per_task(archives: DataFrame) -> DataFrame:
    return archives.repartition(max(1, archives.count()))


PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives, read member by member at the offsets of their indexes.

    ``payload`` is NULL for a revisit; its digest and length are those of the payload it repeats, from its headers.
    A response whose payload doesn't match its digest raises ``ValueError``.
    """
    import hashlib

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _open(folder)
        for batch in batches:
            for value in batch.column(0):
                rows, held = [], 0
                with (
                    system.open_input_stream(f"{path}/{value.as_py()}.index", compression=None) as index,
                    system.open_input_file(f"{path}/{value.as_py()}") as archive,
                ):
                    for line in _lines(index):
                        entry = json.loads(line)
                        archive.seek(entry["offset"])
                        member = zlib.decompress(archive.read(entry["length"]), ANY_GZIP)
                        ((_, fields, body),) = _only(member)
                        http, _, payload = body.partition(b"\r\n\r\n")
                        revisit = fields["warc-type"] == "revisit"
                        digest = fields["warc-payload-digest"].removeprefix("sha256:")
                        if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"damaged payload in {value.as_py()} at {entry['offset']}")
                        length = int(http.rpartition(b"Content-Length: ")[2]) if revisit else len(payload)
                        page, first = fields.get("warc-page-id"), fields.get("warc-refers-to-page-id")
                        rows.append(
                            (page and int(page), fields.get("warc-target-uri"), fields["warc-type"], length, digest,
                             first and int(first), None if revisit else payload)
                        )
                        held += len(payload)
                        if held >= 1 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                yield _batch(rows)

    return _one_per_task(archives).mapInArrow(read, PAGES)


def _only(member: bytes) -> list[tuple[bytes, dict[str, str], bytes]]:
    return [(head, fields, b"".join(body)) for head, fields, body in Records(iter([member]))]


def _lines(stream) -> Iterator[bytes]:
    held = b""
    while data := stream.read(CHUNK):
        *whole, held = (held + data).split(b"\n")
        yield from whole


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(PAGES)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], PAGES.names)


def archived(
    spark: SparkSession, pages: DataFrame, folder: str | None = None, min_bytes: int = 100, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Writes the pages to archives, normalises them, and gives what is read back from the normalised ones.

    Archives stay in ``folder`` (one in the shared folder if none is named): ``raw`` and, normalised, ``archives``.
    A path without a scheme is on the file system that Spark takes for it, the same on every executor.
    """
    folder = qualified(spark, folder or new_folder(spark, "warc"))
    raw = write_raw(pages, f"{folder}/raw", min_bytes, archive_bytes=archive_bytes)
    return read_archives(normalise_archives(raw, f"{folder}/raw", f"{folder}/archives"), f"{folder}/archives")
