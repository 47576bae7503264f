"""Landed answers of the statement service: what each reference waits for, and its statement's load.

An answer is a file.  Its folder or file name says which request it answers and
the how-manieth attempt it is: ``reference.attempt``.  Answers are looked at once;
the last attempt of a reference says what to do with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statement_lake.plans.lake import Lake, utc_now
from statement_lake.plans.pipeline import Outcome, end_load, load_rows, log_outcome
from statement_lake.session import settle
from statement_lake.sources.elements import FILE_ORDER, STATEMENT_FILES, read_tag_text
from statement_lake.sources.specs import SourceSpec
from statement_lake.sources.statements import ingest_tags
from statement_lake.sources.triage import triage

#: Where an answer says reference.attempt: a folder named file=…, or as the name of the file.
NAMED_FOLDER = r"/file=([^/]+)/[^/]*$"
NAMED_FILE = r"([^/]+?)(?:\.[A-Za-z]+)?$"
ATTEMPT = r"\.(\d+)$"
#: What the ledger calls a verdict.
STATUS = {"poll": "skipped", "restart": "error", "fatal": "error"}


def _name(file: Column) -> Column:
    folder = F.regexp_extract(file, NAMED_FOLDER, 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(file, NAMED_FILE, 1))


def answers(tag_text: DataFrame) -> DataFrame:
    """(reference, attempt, file, verdict, status, code): one row a file."""
    name = _name(F.col("file"))
    attempt = F.coalesce(F.regexp_extract(name, ATTEMPT, 1).try_cast("int"), F.lit(1))
    return triage(tag_text).select(
        F.regexp_replace(name, ATTEMPT, "").alias("reference"),
        attempt.alias("attempt"),
        "file",
        F.col("fetch_verdict").alias("verdict"),
        "status",
        "code",
    )


def landing_latest(landed: DataFrame) -> DataFrame:
    """(reference, attempts, file, verdict, status, code): the last attempt of each reference."""
    last = F.struct("attempt", F.expr(FILE_ORDER))
    return (
        landed.groupBy("reference")
        .agg(
            F.count("*").alias("attempts"),
            F.max_by(F.struct("file", "verdict", "status", "code"), last).alias("last"),
        )
        .select("reference", "attempts", "last.*")
    )


def land(
    lake: Lake,
    spec: SourceSpec,
    paths: str | Sequence[str],
    strict: bool = True,
    pattern: str = STATEMENT_FILES,
) -> list[Outcome]:
    """Look at answers that have not been looked at, and load the statements among them.

    Every verdict is stored with its file before anything is loaded.  Statements
    go the way of all statement files; of the other references the ledger counts
    those that wait, ask for a new request or failed for good, and answers that
    failed for good are kept in quarantine.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    tags = read_tag_text(lake.spark, paths, pattern=pattern)
    seen = lake.landed(spec).select("file")
    new = settle(answers(tags).join(seen, "file", "left_anti"), f"landed-{spec.name}")
    if new.isEmpty():
        return []
    ready = settle(new.where("verdict = 'ready'").select("file"), f"ready-{spec.name}")
    outcomes = []
    if not ready.isEmpty():
        ingested = ingest_tags(tags.join(ready, "file", "left_semi"), spec, strict=strict)
        outcomes.append(end_load(lake, spec, ingested, load_rows(lake, spec, ingested.rows)))
    # noted when their statements are stored: a run that dies before loads them again, which changes nothing
    lake.note_landed(spec, new)
    touched = lake.landed(spec).join(new.select("reference").distinct(), "reference", "left_semi")
    states = settle(landing_latest(touched), f"states-{spec.name}")
    lost = states.where("verdict = 'fatal'").select("file", "reference", "code")
    lost.write.mode("append").parquet(f"{lake.root}/landing/{spec.name}/fatal")
    for row in states.groupBy("verdict").count().where("verdict <> 'ready'").orderBy("verdict").collect():
        reason = f"{row['count']} references: {row.verdict}"
        outcomes.append(Outcome("bronze", spec.name, STATUS[row.verdict], reason))
    now = utc_now()
    for outcome in outcomes:
        log_outcome(lake, now, outcome)
    return outcomes
