"""Typed ingest of statement files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statement_lake.functions.fingerprint import fingerprint
from statement_lake.functions.typed import STRICT_TYPES, has_text, is_bad, typed, value_text
from statement_lake.session import discard, scratch_path, settle, settle_at
from statement_lake.sources.elements import (
    FILE_ORDER, FOREIGN_TAG, STATEMENT_FILES, read_tag_text, split_tags,
)
from statement_lake.sources.specs import SourceSpec
from statement_lake.sources.triage import RESPONSE_ROOT

#: Verdict on a file whose prolog names an encoding that is not read.
FOREIGN = "foreign encoding"


@dataclass(frozen=True)
class Ingested:
    """Result of one ingest.

    ``rows``: admitted records with ``file`` and ``file_order``.
    ``quarantine``: records that were held back, with the reason.
    ``rejects``: per file and column, how many values could not be read.
    ``files``: per file, ``reason`` (NULL when loaded).
    ``bare``: files that are whole and hold no record; they are told as empty and are no fault.
    ``staged``: the folder that the others are read from, if it can go when they have been stored.
    """

    rows: DataFrame
    quarantine: DataFrame
    rejects: DataFrame
    files: DataFrame
    bare: DataFrame | None = None
    staged: str | None = None

    def release(self) -> None:
        """Everything was stored: remove the typed copy."""
        if self.staged:
            discard(self.rows.sparkSession, self.staged)


def admits_detail(level: Column) -> Column:
    """Detail records only: an absent or empty level counts as detail."""
    return ~has_text(level) | F.coalesce(level == "DETAIL", F.lit(False))


def _required(spec: SourceSpec) -> Column:
    types = {column.name: column.dataType.simpleString() for column in spec.columns}
    admitted = F.lit(True)
    for name in spec.required:
        value = F.col(name)
        admitted = admitted & (has_text(value) if types[name] == "string" else value.isNotNull())
    return admitted


def type_records(records: DataFrame, spec: SourceSpec, accept_compact: bool = False) -> DataFrame:
    """Add the spec's typed columns, the fingerprint, ``bad`` column names and ``admitted``.

    ``records`` needs an ``attributes`` map column.
    """
    raw = F.col("attributes")
    by_kind: dict[str, list[str]] = {}
    for column in spec.columns:
        by_kind.setdefault(column.dataType.simpleString(), []).append(column.name)
    strings = by_kind.pop("string")
    wanted = admits_detail(raw[spec.detail_attribute]) if spec.detail_attribute else F.lit(True)

    # Columns of one kind are parsed as one array: the generated code stays small
    # enough to be compiled however wide the source is.
    texts = records.select(
        "*",
        *[raw[name].alias(name) for name in strings],
        *[
            F.array(*[value_text(raw[name]) for name in names]).alias(f"_{kind}_text")
            for kind, names in by_kind.items()
        ],
        *([fingerprint(raw).alias(spec.hash)] if spec.hash else []),
        wanted.alias("_wanted"),
    )
    arrays = texts.withColumns(
        {
            f"_{kind}": F.transform(f"_{kind}_text", _reader(kind, accept_compact))
            for kind in by_kind
        }
    )
    values = arrays.withColumns(
        {
            name: F.col(f"_{kind}")[position]
            for kind, names in by_kind.items()
            for position, name in enumerate(names)
        }
    )
    strict = [kind for kind in STRICT_TYPES if kind in by_kind]
    # most records are sound, so names are made only where a text gave no value
    any_bad = reduce(
        Column.__or__,
        [F.size(F.array_compact(f"_{kind}_text")) > F.size(F.array_compact(f"_{kind}")) for kind in strict],
    )
    bad_names = F.array_compact(F.concat(*[_bad_names(kind, by_kind[kind]) for kind in strict]))
    kept = [name for name in records.columns if name != "attributes"]
    return values.select(
        *kept,
        *spec.schema.names,
        F.when(F.col("_wanted") & any_bad, bad_names).otherwise(F.array().cast("array<string>")).alias("bad"),
        (F.col("_wanted") & _required(spec)).alias("admitted"),
    )


def _reader(kind: str, accept_compact: bool) -> Callable[[Column], Column]:
    # an absent text is not tried against one pattern after another
    return lambda text: F.when(text.isNotNull(), typed(text, kind, accept_compact))


def _bad_names(kind: str, names: list[str]) -> Column:
    def bad(name: Column, position: Column) -> Column:
        text = F.get(F.col(f"_{kind}_text"), position)
        return F.when(is_bad(text, F.get(F.col(f"_{kind}"), position)), name)

    return F.transform(F.array(*[F.lit(name) for name in names]), bad)


def ingest_tags(
    tag_text: DataFrame, spec: SourceSpec, strict: bool = True, accept_compact: bool = False
) -> Ingested:
    """Type the records of the given tags and hold back what is faulty.

    Strict: a file that is cut off, faulty, a service response instead of a
    statement, or has one unreadable value is held back whole.  Otherwise unreadable values become NULL and only records that
    cannot be read at all are held back.

    The files are scanned once; everything else runs on the typed copy.
    """
    tags = split_tags(tag_text, spec.element)
    is_record = F.col("is_record")
    named = type_records(tags, spec, accept_compact)
    faulty = ~F.col("whole") | (F.size("bad") > 0)
    path = scratch_path(tag_text.sparkSession, f"ingest-{spec.name}")
    staged = settle_at(named.withColumn("text", F.when(is_record & faulty, F.col("text"))), path)

    per_tag = staged.groupBy("file", "tag").agg(
        F.sum("step").alias("open"),
        F.bool_and("whole").alias("whole"),
        F.bool_or(is_record & (F.size("bad") > 0)).alias("bad"),
    )
    files = settle(
        per_tag.groupBy("file")
        .agg(
            (F.bool_and("whole") & (F.max(F.abs("open")) == 0) & (F.max("tag") != "")).alias("whole"),
            F.bool_or("bad").alias("bad"),
            F.bool_or(F.col("tag") == RESPONSE_ROOT).alias("is_response"),
            F.bool_or(F.col("tag") == FOREIGN_TAG).alias("is_foreign"),
        )
        .select(
            "file",
            F.when(F.col("is_foreign"), F.lit(FOREIGN))
            .when(~F.col("whole"), F.lit("malformed"))
            .when(F.col("is_response"), F.lit("no statement"))
            .when(F.col("bad"), F.lit("unreadable value"))
            .alias("reason"),
        ),
        f"files-{spec.name}",
    )

    records = staged.where(is_record)
    columns = ["file", F.expr(FILE_ORDER).alias("file_order"), *spec.schema.names]
    held_columns = ["file", "reason", "text", "bad", *spec.schema.names]
    if strict:
        held_files = files.where(F.col("reason").isNotNull())
        good = records.join(held_files, "file", "left_anti")
        held = records.join(held_files, "file")
    else:
        # text in another encoding would be read wrongly, whatever the mode
        foreign = files.where(F.col("reason") == FOREIGN)
        legible = records.join(foreign, "file", "left_anti")
        good = legible.where("whole")
        held = legible.where(~F.col("whole")).withColumn("reason", F.lit("malformed"))
        held = held.unionByName(records.join(foreign, "file"))
        whole_file = F.col("reason").isin(FOREIGN, "no statement")
        files = files.withColumn("reason", F.when(whole_file, F.col("reason")))
    rejects = (
        records.select("file", F.explode("bad").alias("column"))
        .groupBy("file", "column")
        .agg(F.count("*").alias("values"))
    )
    return Ingested(
        rows=good.where("admitted").select(*columns),
        quarantine=held.select(*held_columns),
        rejects=rejects,
        files=files,
        staged=path,
    )


def ingest(
    spark: SparkSession,
    paths: str | list[str],
    spec: SourceSpec,
    strict: bool = True,
    accept_compact: bool = False,
    whole_files: bool = False,
    pattern: str = STATEMENT_FILES,
    but: DataFrame | None = None,
) -> Ingested:
    """Ingest every statement file under ``paths``, but those of ``but`` (file)."""
    tags = read_tag_text(spark, paths, whole_files, pattern)
    if but is not None:
        tags = tags.join(but, "file", "left_anti")
    ingested = ingest_tags(tags, spec, strict=strict, accept_compact=accept_compact)
    met = ingested.files.select("file")
    met = met if but is None else met.unionByName(but.select("file"))
    return replace(ingested, files=ingested.files.unionByName(empty_files(spark, paths, pattern, met)))


def empty_files(
    spark: SparkSession, paths: str | list[str], pattern: str, seen: DataFrame
) -> DataFrame:
    """(file, reason): the files that gave no row.

    Their names come from the listing that Spark's driver makes of a folder anyway,
    as its readers leave out files without a byte.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(paths)
        .inputFiles()
    )
    given = spark.createDataFrame([(name,) for name in listed], "file string")
    return but_files(given, seen).select("file", F.lit("empty").alias("reason"))


def but_files(files: DataFrame, others: DataFrame) -> DataFrame:
    """Those of the files (file) that are not among the others."""
    # a local file's name may begin with one slash or three
    plain = lambda name: F.regexp_replace(name, "^file:/+", "file:/")
    met = others.select(plain("file").alias("_seen"))
    return files.join(met, plain("file") == F.col("_seen"), "left_anti")
