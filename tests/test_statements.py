import datetime as dt

import pytest
from pyspark.sql import functions as F

from statement_lake.sources.elements import read_tag_text
from statement_lake.sources.specs import CASH_TRANSACTIONS, POSITIONS, SOURCES, TRADES
from statement_lake.sources.statements import ingest
from statement_lake.sources.triage import triage
from tests.helpers import as_list, as_set, element, sha, statement, write

GOOD = {"accountId": "U1", "symbol": "AAA", "tradeDate": "20240102", "quantity": "1,000.5"}


def trade(**changes):
    attributes = {**GOOD, **changes}
    return element("Trade", **{k: v for k, v in attributes.items() if v is not None})


def reasons(ingested):
    return {row.file.rsplit("/", 1)[1]: row.reason for row in ingested.files.collect()}


def test_specs_match_the_known_widths():
    widths = {spec.name: len(spec.schema) for spec in SOURCES}
    assert widths == {
        "trades": 40, "corporate_actions": 47, "positions": 25, "cash_transactions": 26,
        "account_nav": 16, "tickers_daily": 9,
    }


def test_types_and_fingerprints(spark, tmp_path):
    odd = {**GOOD, "Zed": "1", "unknown": " é & <b> ", "description": ""}
    write(tmp_path, "a.xml", statement(trade(), element("Trade", **odd), element("TradeConfirm", accountId="U9")))
    rows = ingest(spark, str(tmp_path), TRADES).rows
    assert as_set(rows, "accountId", "tradeDate", "quantity", "description", "sourceHashHex") == {
        ("U1", dt.date(2024, 1, 2), 1000.5, None, sha(GOOD)),
        ("U1", dt.date(2024, 1, 2), 1000.5, "", sha(odd)),
    }
    assert rows.select(*TRADES.schema.names).schema == TRADES.schema or [
        f.dataType for f in rows.select(*TRADES.schema.names).schema
    ] == [f.dataType for f in TRADES.schema]


def test_markup_forms(spark, tmp_path):
    text = """﻿<FlexQueryResponse>
    <Trade accountId='U1' symbol="A&#65;'&quot;" tradeDate = "20240102"
       note="1 > 0"></Trade><Other><Trade accountId="U2" symbol="B" tradeDate="20240103"><x y="1"/></Trade></Other>
    </FlexQueryResponse>"""
    write(tmp_path, "a.xml", text)
    ingested = ingest(spark, str(tmp_path), TRADES)
    assert reasons(ingested) == {"a.xml": None}
    assert as_set(ingested.rows, "accountId", "symbol") == {("U1", "AA'\""), ("U2", "B")}


def test_comments_need_whole_files(spark, tmp_path):
    text = "<R><!-- plain --><!-- <Trade accountId='no' symbol='no' tradeDate='20240101'/> -->" + trade() + "</R>"
    write(tmp_path, "a.xml", text)
    held = ingest(spark, str(tmp_path), TRADES)
    assert reasons(held) == {"a.xml": "malformed"} and held.rows.count() == 0
    whole = ingest(spark, str(tmp_path), TRADES, whole_files=True)
    assert as_set(whole.rows, "accountId") == {("U1",)}


@pytest.mark.parametrize(
    "broken",
    [
        "<R>" + trade() + "<Trade accountId='U2'",
        "<R>" + trade(),
        "<R>" + trade() + "</R></R>",
        "<R>" + trade() + "<Trade accountId=U2/></R>",
        "<R>" + trade() + "<Trade a='1' a='2'/></R>",
        "<R>" + trade() + "<Trade a='x & y'/></R>",
        "<R>" + trade() + "<Trade a='&bad;'/></R>",
        "no markup at all",
        "<?xml version='1.0' encoding='ISO-8859-1'?><R>" + trade() + "</R>",
    ],
)
def test_broken_files_are_held_back_whole(spark, tmp_path, broken):
    """An encoding that is not read is a reason of its own, beside faulty markup."""
    write(tmp_path, "good.xml", statement(trade(accountId="G")))
    write(tmp_path, "broken.xml", broken)
    ingested = ingest(spark, str(tmp_path), TRADES)
    reason = "foreign encoding" if "ISO-8859-1" in broken else "malformed"
    assert reasons(ingested) == {"good.xml": None, "broken.xml": reason}
    assert as_set(ingested.rows, "accountId") == {("G",)}


def test_one_unreadable_value_holds_back_its_file(spark, tmp_path):
    write(tmp_path, "good.xml", statement(trade(accountId="G")))
    bad = statement(trade(accountId="B"), trade(accountId="C", quantity="abc", tradeDate="20240230"))
    write(tmp_path, "bad.xml", bad)
    ingested = ingest(spark, str(tmp_path), TRADES)
    assert as_set(ingested.rows, "accountId") == {("G",)}
    assert reasons(ingested)["bad.xml"] == "unreadable value"
    assert as_set(ingested.quarantine, "accountId", "reason") == {
        ("B", "unreadable value"), ("C", "unreadable value"),
    }
    assert as_set(ingested.rejects, "column", "values") == {("quantity", 1), ("tradeDate", 1)}
    lenient = ingest(spark, str(tmp_path), TRADES, strict=False)
    # C loses its only trade date and is not admitted.
    assert as_set(lenient.rows, "accountId") == {("G",), ("B",)}


def test_a_service_response_is_no_statement(spark, tmp_path):
    write(tmp_path, "good.xml", statement(trade()))
    write(tmp_path, "wait.xml", response("Fail", "1019"))
    ingested = ingest(spark, str(tmp_path), TRADES)
    assert reasons(ingested) == {"good.xml": None, "wait.xml": "no statement"}
    assert ingested.rows.count() == 1


def test_admission(spark, tmp_path):
    write(
        tmp_path / "t", "a.xml",
        statement(trade(), trade(accountId=""), trade(symbol=None), trade(tradeDate="")),
    )
    assert ingest(spark, str(tmp_path / "t"), TRADES).rows.count() == 1
    write(tmp_path / "p", "a.xml", statement(element("OpenPosition", accountId="U1", symbol="A")))
    assert as_set(ingest(spark, str(tmp_path / "p"), POSITIONS).rows, "symbol", "reportDate") == {
        ("A", None)
    }


def test_cash_keeps_detail_rows(spark, tmp_path):
    base = {"accountId": "U1", "currency": "USD", "reportDate": "20240102"}
    rows = [
        element("CashTransaction", **base, amount="1", levelOfDetail="DETAIL"),
        element("CashTransaction", **base, amount="oops", levelOfDetail="SUMMARY"),
        element("CashTransaction", **base, amount="3", levelOfDetail=""),
        element("CashTransaction", **base, amount="4"),
    ]
    write(tmp_path, "a.xml", statement(*rows))
    assert as_set(ingest(spark, str(tmp_path), CASH_TRANSACTIONS).rows, "amount") == {
        (1.0,), (3.0,), (4.0,),
    }


def test_copies_inside_a_file_stay(spark, tmp_path):
    write(tmp_path, "a.xml", statement(trade(), trade()))
    assert ingest(spark, str(tmp_path), TRADES).rows.count() == 2


def test_large_file_is_read_by_several_tasks(spark, tmp_path):
    n = 20000
    write(tmp_path, "big.xml", statement(*[trade(tradeID=str(i)) for i in range(n)]))
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        assert read_tag_text(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 4
        rows = ingest(spark, str(tmp_path), TRADES).rows
        assert rows.agg(F.count("*"), F.count_distinct("tradeID")).first()[:] == (n, n)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


def response(status, code="", reference=""):
    return (
        f"<FlexStatementResponse timestamp='x'><Status>{status}</Status><ErrorCode>{code}</ErrorCode>"
        f"<ReferenceCode>{reference}</ReferenceCode></FlexStatementResponse>"
    )


def test_triage(spark, tmp_path):
    files = {
        "ready.xml": statement(trade()),
        "wait.xml": response("Fail", "1019"),
        "busy.xml": response("Fail", " 1018 "),
        "again.xml": response("Fail", "1020"),
        "dead.xml": response("Fail", "1012"),
        "warn.xml": response("Warn", "1019"),
        "sent.xml": response("Success", "", "42"),
        "blank.xml": response("Success"),
        "cut.xml": response("Fail", "1012")[:-10],
        "other.xml": "<html/>",
    }
    for name, text in files.items():
        write(tmp_path, name, text)
    found = triage(read_tag_text(spark, str(tmp_path)))
    verdicts = {
        file.rsplit("/", 1)[1][:-4]: (fetch, request)
        for file, fetch, request in as_list(found, "file", "fetch_verdict", "request_verdict")
    }
    assert verdicts == {
        "ready": ("ready", "fatal"),
        "wait": ("poll", "fatal"),
        "busy": ("poll", "retry"),
        "again": ("restart", "fatal"),
        "dead": ("fatal", "fatal"),
        "warn": ("poll", "fatal"),
        "sent": ("poll", "accepted"),
        "blank": ("poll", "fatal"),
        "cut": ("poll", "fatal"),
        "other": ("poll", "fatal"),
    }
