"""Main text of web pages by a recurrent labeller of their blocks."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statement_lake.llm.block_labeller import Labeller, sequenced
from statement_lake.llm.html_blocks import Block, read_blocks
from statement_lake.llm.page_layouts import Layouts, told_labels

#: Pages that the labeller learns from, and the longest of them in characters.
SAMPLE_PAGES, SAMPLE_CHARS = 100, 50_000
#: Layouts drawn, rounds of learning, blocks of a page that are learned from at most.
LAYOUTS, ROUNDS, LEARNED_BLOCKS = 2500, 6, 200
SEED = 12
#: Bytes of pages that are read together, about.
GROUP_BYTES = 4 << 20
#: Words a text of the sample needs to serve as prose.
PROSE_WORDS = 12


def learn(
    pages: Sequence[str], layouts: int = LAYOUTS, rounds: int = ROUNDS, seed: int = SEED
) -> Labeller:
    """A labeller fitted to texts of these pages in drawn layouts, and to the pages that tell their parts."""
    read = [read_blocks(page) for page in pages]
    prose = [b.text for blocks in read for b in blocks if b.text.count(" ") >= PROSE_WORDS]
    drawn = Layouts(prose, seed)
    examples = [drawn.page() for _ in range(layouts)]
    for blocks in read:
        labels = told_labels(blocks)
        if labels:
            examples.append((blocks, labels))
    model = Labeller(seed)
    fitted = [sequenced(b[:LEARNED_BLOCKS], labels[:LEARNED_BLOCKS]) for b, labels in examples]
    model.fit(fitted, rounds, seed)
    return model


def main_texts(pages: Sequence[list[Block]], model: Labeller, level: float = 0.5) -> list[str]:
    """The blocks of each page that the labeller takes for main text, joined by blanks."""
    found = model.probabilities([sequenced(blocks) for blocks in pages])
    return [
        " ".join([b.text for b, p in zip(blocks, chances.tolist()) if p >= level])
        for blocks, chances in zip(pages, found)
    ]


def learn_from(
    pages: DataFrame, html_column: str, size: int, longest: int, layouts: int, rounds: int
) -> bytes:
    """A pickled labeller, learned in one task from a bounded sample.

    The sample is up to `size` pages of up to `longest` characters, the same ones
    however the rows are dealt.
    """

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [page for batch in batches for page in batch.column("html").to_pylist()]
        model = pickle.dumps(learn(given, layouts, rounds), protocol=5)
        yield pa.RecordBatch.from_pydict({"model": pa.array([model], pa.binary())})

    rows = pages.select(F.col(html_column).cast("string").alias("html"))
    rows = rows.where((F.length("html") > 0) & (F.length("html") <= longest))
    some = rows.orderBy(F.xxhash64("html"), "html").limit(size)
    found = some.coalesce(1).mapInArrow(fitted, "model binary").first()
    return bytes(found.model) if found else pickle.dumps(Labeller(SEED), protocol=5)


def extract(
    pages: DataFrame,
    sample_pages: int = SAMPLE_PAGES,
    sample_chars: int = SAMPLE_CHARS,
    layouts: int = LAYOUTS,
    rounds: int = ROUNDS,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    model: Labeller | None = None,
) -> DataFrame:
    """(page_id, url, text, n_chars): one row a page row.

    The labeller learns from `sample_pages` pages of at most `sample_chars`
    characters, a bounded sample, unless a model is given; every page is read
    whole and each of its blocks labelled in the light of all.

    Null html counts as empty and gives empty text, as does a page without main
    text.  Null and repeated ids and urls stay as they are.  No rows: no rows.
    Other columns are ignored.
    """
    if model is None:
        learned = learn_from(pages, html_column, sample_pages, sample_chars, layouts, rounds)
    else:
        learned = pickle.dumps(model, protocol=5)
    shipped = pages.sparkSession.sparkContext.broadcast(learned)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = pickle.loads(shipped.value)
        for batch in batches:
            read: list[list[Block]] = []
            held, done = 0, 0
            column = batch.column("html")
            for i in range(len(column)):
                page = column[i].as_py()
                read.append(read_blocks(page))
                held += len(page)
                if held >= GROUP_BYTES or i + 1 == len(column):
                    part = batch.slice(done, len(read))
                    texts = pa.array(main_texts(read, labeller), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("page_id"), part.column("url"), texts], ["page_id", "url", "text"]
                    )
                    done, read, held = i + 1, [], 0

    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"),
    )
    found = rows.mapInArrow(labelled, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
