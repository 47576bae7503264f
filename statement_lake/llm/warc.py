"""Deterministic sharded WARC writer with payload revisits, and its reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statement_lake.session import settle

#: Payload bytes a shard holds about, and compressed bytes after which a file is full.
SHARD_BYTES, ROLL_BYTES = 32 << 20, 128 << 20
#: All records carry one date, so that equal input gives equal archives.
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard's name space for addresses
#: Where a reader's record stops being a header.
HEADER_BYTES = 1 << 20

Record = dict[str, str]


def _place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The store of a folder that all executors share."""
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def digest(block: bytes) -> str:
    return base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(page_id: int | None, copy: int) -> str:
    """The id of a page's record; copies of a page number have an id each."""
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}/{copy}')}>"


def _header(fields: Record, block: bytes) -> bytes:
    lines = {**fields, "WARC-Block-Digest": f"sha1:{digest(block)}", "Content-Length": str(len(block))}
    text = "".join(f"{name}: {value}\r\n" for name, value in lines.items())
    return b"WARC/1.1\r\n" + text.encode() + b"\r\n" + block + b"\r\n\r\n"


def _target(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(
    page_id: int | None, copy: int, url: str | None, payload: bytes, first: int | None, revisit: bool
) -> bytes:
    """One record, its headers and digests made anew from the payload."""
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, copy),
        "WARC-Date": DATE,
        "WARC-Target-URI": _target(url, page_id),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
        "X-Page-ID": "" if page_id is None else str(page_id),
        "X-Payload-Length": str(len(payload)),
    }
    head = HTTP + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["WARC-Refers-To"] = record_id(first, 0)
        fields["X-Refers-To-Page-ID"] = "" if first is None else str(first)
        return _header(fields, head)
    return _header(fields, head + payload)


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Roller:
    """Writes members to files under temporary names; a full file is followed by the next."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.store, self.folder = _place(folder)
        self.store.create_dir(f"{self.folder}/_temporary", recursive=True)
        self.shard, self.roll, self.attempt = shard, roll_bytes, uuid.uuid4().hex
        self.out, self.done = None, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.file = f"part-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.temporary = f"_temporary/{self.attempt}-{self.file}"
            self.out = self.store.open_output_stream(
                f"{self.folder}/{self.temporary}", compression=None
            )
            self.bytes, self.records, self.sum = 0, 0, hashlib.sha1()
            info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(NAMES, self.file)}>",
                    "WARC-Date": DATE, "WARC-Filename": self.file, "Content-Type": "application/warc-fields"}
            self._put(member(_header(info, b"format: WARC File Format 1.1\r\n")))
        self._put(member(data))
        self.records += 1
        if self.bytes >= self.roll:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sum.update(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append((self.file, self.temporary, self.bytes, self.records, self.sum.hexdigest()))


MANIFEST = "file string, temporary string, bytes long, records long, sha1 string"


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    least_bytes: int = 0,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Writes every page as a record and returns the manifest (file, bytes, records, sha1).

    Records are range-sorted by page number and payload digest.  Of records with
    equal payloads of least_bytes at least, that with the smallest page number
    holds the payload; the others are revisits.  Of repeated rows the first (in
    order of url) counts as that record.  A null html is an empty payload; a null
    page number sorts first and is referred to only if all equal payloads lack
    one; a null url becomes an address made of the page number.  No rows: an
    empty manifest.  Other columns are ignored.

    Tasks write under temporary names that no other attempt uses and report what
    they wrote; a second job moves the reported files to their names, which is
    safe to repeat; the manifest is written last, and readers go by it alone.
    """
    base = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(html_column), F.lit("")).cast("binary").alias("payload"),
    )
    narrow = base.select("page_id", F.sha1("payload").alias("sum"), F.length("payload").alias("size"))
    told = narrow.agg(F.sum("size"), F.count("*")).first()
    count = max(1, -(-(told[0] or 0) // shard_bytes))
    first = (
        narrow.where(F.col("size") >= least_bytes)
        .groupBy("sum")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )
    notes = narrow.join(first, "sum").select("page_id", "sum", F.lit(0).alias("kind"), "first")
    # Payloads are shuffled once; notes on repeated payloads travel to the same place.
    rows = notes.unionByName(
        base.select("*", F.sha1("payload").alias("sum"), F.lit(1).alias("kind")),
        allowMissingColumns=True,
    )
    sorted_rows = rows.repartitionByRange(count, "page_id", "sum").sortWithinPartitions(
        "page_id", "sum", "kind", "url"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Roller(folder, TaskContext.get().partitionId(), roll_bytes)
        key, note, copy = object(), None, 0
        page, copies = object(), 0
        for batch in batches:
            names = batch.schema.names
            columns = [batch.column(names.index(c)) for c in ("page_id", "sum", "kind", "first", "url", "payload")]
            for i in range(batch.num_rows):
                page_id, total, kind, of, url, payload = (c[i].as_py() for c in columns)
                if (page_id, total) != key:
                    key, note, copy = (page_id, total), None, 0
                if page_id != page:
                    page, copies = page_id, 0
                if kind == 0:
                    note = (of,)
                    continue
                revisit = note is not None and (note[0] != page_id or copy > 0)
                files.add(record(page_id, copies, url, payload, note[0] if note else None, revisit))
                copy, copies = copy + 1, copies + 1
        files.close()
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        if files.done:
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*files.done)))))

    written = settle(sorted_rows.mapInArrow(write, MANIFEST), "warc-written")

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = _place(folder)
        for batch in batches:
            for row in batch.to_pylist():
                old, new = f"{at}/{row['temporary']}", f"{at}/{row['file']}"
                try:
                    store.move(old, new)
                except OSError:  # another attempt has moved it
                    found = store.get_file_info(new)
                    if found.size != row["bytes"]:
                        raise
            yield batch

    manifest = written.mapInArrow(move, MANIFEST).select("file", "bytes", "records", "sha1")
    path = f"{folder}/manifest.parquet"
    manifest.write.parquet(path)
    return pages.sparkSession.read.schema(manifest.schema).parquet(path)


def read_records(stream) -> Iterator[tuple[Record, bytes]]:
    """Headers and block of each record of an archive, one record at a time."""
    while True:
        line = stream.readline(HEADER_BYTES)
        if not line:
            return
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:40]!r}")
        fields: Record = {}
        while (line := stream.readline(HEADER_BYTES)) != b"\r\n":
            name, _, value = line.decode().partition(":")
            fields[name] = value.strip()
        block = stream.read(int(fields["Content-Length"]))
        if f"sha1:{digest(block)}" != fields["WARC-Block-Digest"]:
            raise ValueError(f"block digest differs: {fields['WARC-Record-ID']}")
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("record end is missing")
        yield fields, block


def read_archives(manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to), a row a record.

    Goes through each file of the manifest record by record and fails on a file,
    block or payload whose digest or length differs.  payloads: the payload of
    responses as one more column.
    """
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if payloads:
        names, kinds, schema = [*names, "payload"], [*kinds, pa.binary()], f"{schema}, payload binary"

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = _place(folder)
        for batch in batches:
            for file, records in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                rows, held, seen = [], 0, 0
                with store.open_input_stream(f"{at}/{file}", compression=None) as raw:
                    for fields, block in read_records(gzip.GzipFile(fileobj=raw)):
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        seen += 1
                        payload = block.partition(b"\r\n\r\n")[2]
                        told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(fields["X-Payload-Length"])
                        if kind == "response" and (digest(payload), len(payload)) != (told, size):
                            raise ValueError(f"payload differs: {fields['WARC-Record-ID']}")
                        page, first = fields["X-Page-ID"], fields.get("X-Refers-To-Page-ID")
                        row = (int(page) if page else None, fields["WARC-Target-URI"], size, told, kind,
                               int(first) if first else None)
                        rows.append((*row, payload if kind == "response" else None) if payloads else row)
                        held += len(payload) if payloads else 0
                        if len(rows) >= 5_000 or held >= 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if seen != records:
                    raise ValueError(f"{file} has {seen} records instead of {records}")
                if rows:
                    yield batch_of(rows)

    files = manifest.select("file", "records")
    return files.repartition(max(1, files.count())).mapInArrow(read, schema)
