"""Fill-in-the-middle transformation by rotations of blocks in place."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Percent of texts that are transformed, and of those that begin with the suffix.
RATE, SPM_SHARE, SEED = 100, 50, 7
#: Bytes of texts that are handed on together, about.
GROUP_BYTES = 8 << 20


def draws(seed: int, doc: int | None) -> list[int]:
    """Four 32-bit numbers from the SHA-256 of seed and id; a null id counts as blank."""
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends; a line feed belongs to its line."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if text and not text.endswith(b"\n"):
        ends = np.append(ends, len(text))
    return ends


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange the neighbours [start, cut) and [cut, end) by three reversals."""
    for low, high in ((start, cut), (cut, end), (start, end)):
        buffer[low:high] = buffer[low:high][::-1]


def transform(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text with its blocks, cut at first and second, in the order of the form."""
    buffer = bytearray(text)
    if form == PLAIN:
        return buffer
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))
    return buffer


def invert(output: bytes, form: str) -> bytearray:
    """The text that transform() was given.

    Texts that hold a sentinel are never transformed, so each sentinel is found
    where it was put: no other place of a transformed text can read like one.
    """
    buffer = bytearray(output)
    if form == PLAIN:
        return buffer
    start = buffer.find(SUFFIX)
    cut = buffer.find(MIDDLE if form == PSM else PREFIX)
    rotate(buffer, start, cut, len(buffer))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.find(sentinel)
        del buffer[at : at + len(sentinel)]
    return buffer


def characters(text: bytes | bytearray) -> int:
    """Code points of UTF-8: bytes that continue none."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def _described(
    doc: int | None, text: bytes, seed: int, rate: int, spm_share: int
) -> tuple[int | None, int, str, int | None, int | None, bytearray]:
    h1, h2, h3, h4 = draws(seed, doc)
    ends = line_ends(text)
    n = len(ends)
    marked = any(sentinel in text for sentinel in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or h3 % 100 >= rate:
        return doc, n, PLAIN, None, None, transform(text, 0, 0, PLAIN)
    form = SPM if h4 % 100 < spm_share else PSM
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = (int(ends[c - 1]) if c else 0 for c in cuts)
    view = memoryview(text)
    output = transform(text, first, second, form)
    return doc, n, form, characters(view[:first]), characters(view[first:second]), output


def _in_groups(
    columns: Iterator[tuple], made: Callable[..., tuple], schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Rows made one by one, in batches that hold GROUP_BYTES of text, about."""
    rows: list[tuple] = []
    held = 0
    for values in columns:
        rows.append(made(*values))
        held += len(rows[-1][-1])
        if held >= GROUP_BYTES:
            yield _batch(rows, schema)
            rows, held = [], 0
    if rows:
        yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(map(_plain, column), kind) for column, kind in zip(zip(*rows), schema.types)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _plain(value: object) -> object:
    return bytes(value) if isinstance(value, bytearray) else value


TRANSFORMED = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()), ("output", pa.binary()),
    ]
)


def fill_in_middle(
    documents: DataFrame,
    seed: int = SEED,
    rate: int = RATE,
    spm_share: int = SPM_SHARE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): one row a document row.

    A text is cut into prefix, middle and suffix at the ends of lines, drawn by
    its doc_id; output has them as `<P>`prefix`<S>`suffix`<M>`middle (psm) or
    `<S>`suffix`<P>`prefix`<M>`middle (spm).

    Null text counts as empty.  Empty texts, texts that hold a sentinel and those
    beyond the rate stay as they are (plain, without lengths).  A null doc_id
    draws as a blank one; rows with equal doc_ids are cut by the same draws, each
    in its own lines.  No rows: no rows.  Other columns are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = zip(batch.column("doc_id").to_pylist(), batch.column("text"))
            yield from _in_groups(
                ((doc, text.as_py()) for doc, text in values),
                lambda doc, text: _described(doc, text, seed, rate, spm_share),
                TRANSFORMED,
            )

    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    found = rows.mapInArrow(
        cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
    )
    return found.withColumn("output", F.col("output").cast("string"))


def restore(transformed: DataFrame) -> DataFrame:
    """The rows of fill_in_middle() with `restored`, the text rebuilt from output and form."""
    kept = [field for field in transformed.schema.fields if field.name != "restored"]
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kept)

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, held, size = 0, [], 0
            forms, outputs = batch.column("form").to_pylist(), batch.column("output")
            for i, form in enumerate(forms):
                held.append(bytes(invert(outputs[i].cast(pa.binary()).as_py(), form)))
                size += len(held[-1])
                if size >= GROUP_BYTES or i + 1 == len(forms):
                    part = batch.slice(done, len(held))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(held, pa.binary())], [*part.schema.names, "restored"]
                    )
                    done, held, size = i + 1, [], 0

    found = transformed.select(*[f"`{field.name}`" for field in kept]).mapInArrow(
        rebuilt, f"{schema}, restored binary"
    )
    return found.withColumn("restored", F.col("restored").cast("string"))
