"""Landed answers: verdicts once, statements loaded, the last attempt counts."""

from statement_lake.operators.ledger import job_state
from statement_lake.plans.lake import Lake
from statement_lake.plans.landing import land, landing_latest
from statement_lake.sources import specs
from tests.helpers import as_list, as_set, element, statement, write


def answer(status, code):
    return f"<FlexStatementResponse><Status>{status}</Status><ErrorCode>{code}</ErrorCode></FlexStatementResponse>"


def trade(symbol):
    return element("Trade", accountId="U1", symbol=symbol, tradeDate="20240102")


def test_landed_answers(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    folder = write(tmp_path / "in", "111.1.xml", answer("Fail", "1019"))
    write(tmp_path / "in", "222.1.xml", statement(trade("A")))
    write(tmp_path / "in", "333.1.xml", answer("Fail", "1009"))
    write(tmp_path / "in", "444.xml", answer("Fail", "1012"))
    write(tmp_path / "in", "555.1.xml", "<html>busy</html>")
    first = land(lake, specs.TRADES, folder)
    assert [(o.status, o.reason, o.rows) for o in first] == [
        ("ok", "loaded", 1), ("error", "1 references: fatal", 0), ("skipped", "2 references: poll", 0),
        ("error", "1 references: restart", 0),
    ]
    assert land(lake, specs.TRADES, folder) == []

    write(tmp_path / "in", "111.2.xml", answer("Fail", "1018"))
    write(tmp_path / "in", "111.10.xml", statement(trade("B")))
    again = land(lake, specs.TRADES, folder)
    assert [(o.status, o.rows) for o in again] == [("ok", 1)]
    states = landing_latest(lake.landed(specs.TRADES))
    assert as_set(states, "reference", "attempts", "verdict", "code") == {
        ("111", 3, "ready", None), ("222", 1, "ready", None), ("333", 1, "restart", "1009"), ("444", 1, "fatal", "1012"),
        ("555", 1, "poll", None),
    }
    assert as_list(lake.bronze(specs.TRADES), "symbol") == [("A",), ("B",)]
    assert as_set(spark.read.parquet(f"{lake.root}/landing/trades/fatal"), "reference", "code") == {("444", "1012")}
    assert as_list(job_state(lake.ledger()), "job_id", "last_rows", "last_error") == [("trades", 1, None)]
