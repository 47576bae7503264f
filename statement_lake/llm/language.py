"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statement_lake.session import settle

#: Character n-gram lengths and hash buckets (a power of two).
LENGTHS, BUCKETS = (1, 2, 3), 1 << 16
#: The model is learned from about this many documents a language, spread by a hash of the id.
LEARNED_A_LANGUAGE = 4_000
#: Characters that are hashed at a time, and the weight of an n-gram never seen.
PIECE, SMOOTHING = 1 << 18, 0.5
UNKNOWN = "und"


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of a text's n-grams, piece by piece; letters count in lower case."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    reach = max(LENGTHS) - 1
    for at in range(0, len(codes), PIECE):
        part = codes[max(0, at - reach) : at + PIECE].astype(np.uint64)
        had = min(at, reach)  # characters of the piece before
        value = np.zeros(len(part), np.uint64)
        for n in range(1, max(LENGTHS) + 1):
            if len(part) < n:
                break
            value = value[: len(part) - n + 1] * np.uint64(0x100000001B3) + part[n - 1 :] + np.uint64(n)
            if n in LENGTHS:
                new = value[max(0, had - n + 1) :]
                mixed = new * np.uint64(0x9E3779B97F4A7C15)
                yield (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def learn(documents: DataFrame, id_column: str, text_column: str, label_column: str) -> tuple:
    """(languages, log-probabilities (buckets, languages), log priors) from labelled documents.

    A bounded sample: of each language about LEARNED_A_LANGUAGE documents, those
    whose id's hash is lowest in share; all of a language that has fewer.  Labels
    are few: their counts, and the n-gram counts of each, come to the driver.
    """
    rows = documents.select(
        F.col(id_column).cast("string").alias("id"),
        F.col(text_column).alias("text"),
        F.col(label_column).cast("string").alias("lang"),
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return [], np.zeros((BUCKETS, 0), np.float32), np.zeros(0)
    share = F.create_map(
        *[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, LEARNED_A_LANGUAGE / n)]
    )
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(1 << 20)
    sample = rows.where(place < share[F.col("lang")])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                found = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for buckets in ngrams(text.as_py()):
                    found += np.bincount(buckets, minlength=BUCKETS)
        for lang, found in held.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * len(at)), "bucket": pa.array(at.astype(np.int32)), "n": found[at]}
            )

    tallied = (
        sample.select("text", "lang")
        .mapInArrow(tally, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    ).toPandas()  # languages times buckets at most
    langs = sorted(sizes)
    table = np.full((BUCKETS, len(langs)), SMOOTHING)
    number = {lang: i for i, lang in enumerate(langs)}
    table[tallied["bucket"], tallied["lang"].map(number)] += tallied["n"]
    logs = np.log(table / table.sum(axis=0))
    prior = np.log(np.array([sizes[lang] for lang in langs]) / sum(sizes.values()))
    return langs, logs.astype(np.float32), prior


def score(text: str, logs: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Log posterior of each language, up to a constant."""
    total = prior.astype(float).copy()
    for buckets in ngrams(text):
        for at in range(0, len(buckets), 1 << 14):
            total += logs[buckets[at : at + (1 << 14)]].sum(axis=0, dtype=np.float64)
    return total


def identify(
    documents: DataFrame,
    learn_from: Column | DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
) -> DataFrame:
    """(doc_id, lang_pred, score), one row a document row.

    learn_from: a condition on the columns id and lang, or a table with the same
    columns, that gives the documents to learn from; their ids decide on the
    sample, and only text and label are learned.  A prediction depends on the
    text alone.  score: the posterior probability of the prediction.

    Null texts, and texts without any letter, are `und` with score 0, as is every
    text if nothing could be learned.  Languages that tie: the first in order of
    their names.  Null labels teach nothing.  Rows with null or equal ids have
    their own rows.  Other columns are ignored.
    """
    tell = _teller(documents, learn_from, id_column, text_column, label_column)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column("doc_id"), *tell(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")


def predict_rows(
    documents: DataFrame,
    learn_from: Column | DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
) -> DataFrame:
    """(row, lang_pred, score): as identify(), with all columns of the documents in row.

    Python workers get the texts alone and give back the predictions alone.
    """
    tell = _teller(documents, learn_from, id_column, text_column, label_column)

    def predict(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(tell(texts), ["lang_pred", "score"])

    # not evaluated once more for each condition on the prediction
    told = F.arrow_udf(predict, "lang_pred string, score double").asNondeterministic()
    rows = documents.select(F.struct("*").alias("row"), told(F.col(text_column)).alias("told"))
    return rows.select("row", "told.lang_pred", "told.score")


def _teller(
    documents: DataFrame, learn_from: Column | DataFrame, id_column: str, text_column: str, label_column: str
) -> Callable[[pa.Array], list[pa.Array]]:
    """What gives [languages, probabilities] of an array of texts."""
    lessons = documents.where(learn_from) if isinstance(learn_from, Column) else learn_from
    langs, logs, prior = learn(lessons, id_column, text_column, label_column)
    model = documents.sparkSession.sparkContext.broadcast((langs, logs, prior))

    def tell(texts: pa.Array) -> list[pa.Array]:
        langs, logs, prior = model.value
        found, sure = [], []
        for text in texts:
            text = text.as_py()
            if not langs or text is None or not any(map(str.isalpha, text)):
                found.append(UNKNOWN)
                sure.append(0.0)
                continue
            total = score(text, logs, prior)
            best = int(total.argmax())
            found.append(langs[best])
            sure.append(float(1 / np.exp(total - total[best]).sum()))
        return [pa.array(found, pa.string()), pa.array(sure, pa.float64())]

    return tell


def held_out(id_column: str = "doc_id") -> Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 4 == 2
