"""What a downloaded response asks for, before any of it is parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markers and error codes of the statement service.
STATEMENT_ROOT = "FlexQueryResponse"
RESPONSE_ROOT = "FlexStatementResponse"
SEND_RETRY_CODES = (
    "1001", "1003", "1004", "1005", "1006", "1007", "1008", "1009", "1018", "1021",
)
POLL_CODES = ("1018", "1019")
RESTART_CODES = ("1001", "1009", "1017", "1020", "1021")


def statement_verdict(
    has_statement: Column, root: Column, status: Column, code: Column
) -> Column:
    """Reply to a statement fetch: ready, poll, restart or fatal.

    Anything that is no recognised failure is polled again.
    """
    failed = (root == RESPONSE_ROOT) & (status == "Fail")
    return (
        F.when(has_statement, F.lit("ready"))
        .when(failed & code.isin(*POLL_CODES), F.lit("poll"))
        .when(failed & code.isin(*RESTART_CODES), F.lit("restart"))
        .when(failed, F.lit("fatal"))
        .otherwise(F.lit("poll"))
    )


def request_verdict(root: Column, status: Column, code: Column, reference: Column) -> Column:
    """Reply to a statement request: accepted, retry or fatal."""
    answered = F.coalesce(root == RESPONSE_ROOT, F.lit(False))
    succeeded = answered & F.coalesce(status == "Success", F.lit(False))
    return (
        F.when(succeeded & (F.coalesce(reference, F.lit("")) != ""), F.lit("accepted"))
        .when(succeeded, F.lit("fatal"))
        .when(answered & code.isin(*SEND_RETRY_CODES), F.lit("retry"))
        .otherwise(F.lit("fatal"))
    )


def triage(tag_text: DataFrame) -> DataFrame:
    """One row per file: (file, status, code, reference, fetch_verdict, request_verdict).

    ``tag_text`` holds one row per tag, so no file is ever read whole into a row.
    """
    text = F.col("text")

    def content(tag: str) -> Column:
        pattern = rf"(?s)^{tag}(?:\s[^>]*)?>(.*)$"
        return F.max(F.when(text.rlike(pattern), F.trim(F.regexp_extract(text, pattern, 1))))

    facts = tag_text.groupBy("file").agg(
        F.bool_or(text.startswith(STATEMENT_ROOT)).alias("has_statement"),
        F.bool_or(text.rlike(rf"^{RESPONSE_ROOT}[\s>/]")).alias("is_response"),
        F.bool_or(text.rlike(rf"^/{RESPONSE_ROOT}\s*>")).alias("is_complete"),
        content("Status").alias("status"),
        content("ErrorCode").alias("code"),
        content("ReferenceCode").alias("reference"),
    )
    root = F.when(F.col("is_response") & F.col("is_complete"), F.lit(RESPONSE_ROOT))
    return facts.select(
        "file",
        "status",
        "code",
        "reference",
        statement_verdict(F.col("has_statement"), root, F.col("status"), F.col("code")).alias(
            "fetch_verdict"
        ),
        request_verdict(root, F.col("status"), F.col("code"), F.col("reference")).alias(
            "request_verdict"
        ),
    )
