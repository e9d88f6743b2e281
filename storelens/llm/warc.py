"""Web archives of Zstandard frames: one frame per WARC record, a dictionary in the leading skippable frame.

``write_archives`` puts a record per page into archives under a shared folder and returns the manifest of the files
that count; a task tried again writes files of other names, which no manifest lists. ``read_archives`` streams the
files: it takes the dictionary from the skippable frame at the start (plain or itself compressed), decodes one
frame per record, and checks version line, required headers, declared lengths, digests and the record's end;
a record that fails raises ``ValueError`` with file and position.

Of records with equal payloads the smallest page id is the response; others revisit it.

Defined results: null payloads are empty payloads, null urls leave the target header out; equal page ids that are
the smallest of their payload are all responses; rows without an id never are the one referred to, and are
responses where no row of their payload has an id; control characters and spaces in urls are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.materialize import checkpointed, ensure_checkpoint_dir

DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 64_000_000
SAMPLE_BYTES = 2_000_000
DICTIONARY_BYTES = 64_000
READ_BYTES = 1 << 20


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to=None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record, uncompressed: the page's response, or a revisit of ``refers_to`` with HTTP headers alone."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
            f"WARC-Block-Digest: sha1:{sha1_base32(block)}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if url is not None:
        clean = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
        head.append(f"WARC-Target-URI: {clean}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, where: str) -> dict:
    """The checked fields of one record."""
    def need(true: bool, what: str) -> None:
        if not true:
            raise ValueError(f"{where}: {what}")
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    need(bool(mark) and lines[0] in ("WARC/1.0", "WARC/1.1"), "no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        need(bool(colon), f"header line without a name: {line!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        need(name in fields, f"header {name} is missing")
    need(fields["content-length"].isdigit(), "the declared length is no number")
    size = int(fields["content-length"])
    need(len(rest) == size + 4, f"declared {size} bytes, found {len(rest) - 4}")
    need(rest.endswith(b"\r\n\r\n"), "the record does not end with two line ends")
    block = rest[:size]
    if "warc-block-digest" in fields:
        need(fields["warc-block-digest"] == f"sha1:{sha1_base32(block)}", "the block's digest differs")
    http, mark, payload = block.partition(b"\r\n\r\n")
    need(bool(mark), "the block has no HTTP header")
    length = [int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    need(len(length) == 1, "the HTTP header has no length")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields["warc-type"]
    need(kind in ("response", "revisit"), f"type {kind}")
    if kind == "response":
        need(len(payload) == length[0], "the payload's length differs")
        need(digest == sha1_base32(payload), "the payload's digest differs")
    else:
        need(not payload and "warc-refers-to" in fields, "a revisit with a payload or without a reference")
    def page(text: str | None):
        return None if text in (None, "<urn:page:None>") else text.removeprefix("<urn:page:").removesuffix(">")
    return {"page_id": page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload": payload if kind == "response" else None, "payload_bytes": length[0], "payload_digest": digest,
            "refers_to": page(fields.get("warc-refers-to"))}


def _dictionary(samples: list[bytes]):
    import zstandard
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:  # too few or too small samples to train on: their text itself serves
        return zstandard.ZstdCompressionDict((b"".join(samples))[:DICTIONARY_BYTES] or b"WARC/1.1\r\n",
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes records to numbered files of about ``ARCHIVE_BYTES``; the first records of a file train its dictionary."""

    def __init__(self, folder: str, stem: str):
        from pyarrow import fs
        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.folder, self.stem, self.number, self.out = folder, stem, 0, None
        self.early: list[bytes] = []
        self.early_bytes = self.count = self.size = 0

    def add(self, data: bytes):
        """Yields a manifest row whenever a file is complete."""
        if self.out is None:
            self.early.append(data)
            self.early_bytes += len(data)
            if self.early_bytes >= SAMPLE_BYTES:
                self._open()
        else:
            self._frame(data)
        if self.size >= ARCHIVE_BYTES:
            yield self._close()

    def finish(self):
        if self.out is None and self.early:
            self._open()
        if self.out is not None:
            yield self._close()

    def _open(self) -> None:
        import zstandard
        trained = _dictionary(self.early)
        self.coder = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True, write_content_size=True)
        self.name = f"{self.stem}-{self.number}.warc.zst"
        self.out = self.files.open_output_stream(f"{self.root}/{self.name}", compression=None)
        packed = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes())
        self.out.write(DICTIONARY_MAGIC + len(packed).to_bytes(4, "little") + packed)
        for data in self.early:
            self._frame(data)
        self.early, self.early_bytes = [], 0

    def _frame(self, data: bytes) -> None:
        frame = self.coder.compress(data)
        self.out.write(frame)
        self.count, self.size = self.count + 1, self.size + len(frame)

    def _close(self) -> tuple[str, int, int]:
        self.out.close()
        row = (f"{self.folder}/{self.name}", self.count, self.size)
        self.out, self.count, self.size = None, 0, 0
        self.number += 1
        return row


def frames(stream, where: str):
    """The decompressed frames of an archive after its dictionary frame, read in bounded steps."""
    import zstandard
    left = stream.read(8)
    kwargs = {}
    if left[:4] == DICTIONARY_MAGIC:
        size = int.from_bytes(left[4:8], "little")
        packed = stream.read(size)
        if len(packed) != size:
            raise ValueError(f"{where}: the dictionary frame is cut off")
        if packed[:4] == FRAME_MAGIC:
            packed = zstandard.ZstdDecompressor().decompress(packed)
        kwargs["dict_data"] = zstandard.ZstdCompressionDict(packed)
        left = b""
    reader = zstandard.ZstdDecompressor(**kwargs)
    while True:
        if not left:
            left = stream.read(READ_BYTES)
            if not left:
                return
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(left))
            if frame.eof:
                left = frame.unused_data
                break
            left = stream.read(READ_BYTES)
            if not left:
                raise ValueError(f"{where}: the last frame is cut off")
        yield b"".join(parts)


def with_response_ids(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages`` (page_id, url, payload) and the id of the response that a row revisits, null for responses."""
    keyed = pages.withColumn("content", F.sha2("payload", 256))
    first = keyed.where(F.length("payload") >= least).groupBy("content").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    return keyed.join(first, "content", "left").select(
        "page_id", "url", "payload",
        F.when((F.length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
        .alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Archives of ``pages`` (page_id long, url string, payload binary) under ``folder``; their manifest."""
    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get()
        out = ArchiveWriter(folder, f"part-{task.partitionId():05d}-{task.taskAttemptId()}")

        def rows(found):
            return pa.RecordBatch.from_pydict(
                {"path": [r[0] for r in found], "records": [r[1] for r in found], "bytes": [r[2] for r in found]},
                schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
            for i in range(batch.num_rows):
                yield from map(lambda r: rows([r]), out.add(record(
                    columns[0][i].as_py(), columns[1][i].as_py(), columns[2][i].as_py() or b"", columns[3][i].as_py())))
        yield rows(list(out.finish()))
    made = with_response_ids(pages, least).mapInArrow(run, "path string, records long, bytes long")
    return checkpointed(made)


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the files that a manifest (path, records) lists, each file's number of records checked."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        *([("payload", pa.binary())] if payloads else []), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64())])

    def run(batches):
        from pyarrow import fs
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                files, name = fs.FileSystem.from_uri(path)
                count, rows, size = 0, [], 0
                with files.open_input_stream(name, compression=None) as stream:
                    for data in frames(stream, path):
                        row = parse_record(data, f"{path} record {count}")
                        for key in ("page_id", "refers_to"):
                            row[key] = None if row[key] is None else int(row[key])
                        rows.append({f.name: row[f.name] for f in schema})
                        count, size = count + 1, size + len(data) * payloads
                        if len(rows) >= 1000 or size > READ_BYTES * 8:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                if count != expected:
                    raise ValueError(f"{path}: {count} records, the manifest has {expected}")
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    text = ", ".join(f"{f.name} {({'int64': 'long', 'binary': 'binary'}).get(str(f.type), 'string')}" for f in schema)
    return manifest.select("path", "records").mapInArrow(run, text)


def archive_folder(spark: SparkSession) -> str:
    """A new folder under the shared one, as a URI; a plain path counts as one on a file system that all mount."""
    from pyarrow import fs
    base = ensure_checkpoint_dir(spark)
    base = base if "://" in base else "file://" + base.removeprefix("file:")
    folder = f"{base}/archives-{uuid.uuid4().hex}"
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    return folder


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    manifest = write_archives(pages, archive_folder(spark))
    return read_archives(manifest, payloads=False).drop("url")
