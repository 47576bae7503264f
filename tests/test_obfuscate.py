import pytest

from statement_lake.operators import obfuscate as X
from statement_lake.session import settle
from tests.helpers import as_list, as_set


def code(n, width=4):
    letters = ""
    for _ in range(width):
        n, rest = divmod(n, 26)
        letters = chr(65 + rest) + letters
    return letters


def codes_of(spark, *symbols):
    return settle(X.symbol_codes(spark.createDataFrame([(s,) for s in symbols], "symbol string")), "c")


def test_codes_follow_code_point_order_across_partitions(spark):
    symbols = [f"{'é' if i % 7 == 0 else 's'}{i * 37 % 2003}" for i in range(2003)]
    found = dict(as_list(codes_of(spark, *symbols), "symbol", "code"))
    assert found == {s: code(i) for i, s in enumerate(sorted(set(symbols)))}


def test_codes_widen_and_stay_unique(spark):
    symbols = spark.createDataFrame([(f"{i:03d}",) for i in range(700)], "symbol string")
    found = as_list(X.symbol_codes(symbols, width=2), "symbol", "code")
    assert [c for _, c in found] == [code(i, 2 if i < 676 else 3) for i in range(700)]


def test_symbols_come_from_eligible_datasets_and_symbol_columns(spark):
    def one(**values):
        return spark.createDataFrame([tuple(values.values())], ", ".join(f"`{n}` string" for n in values))

    found = X.distinct_symbols(
        {
            "trades_history": one(symbol="A", symbol_old="B", symbolic="no"),
            "positions_latest": one(Symbol=" "),
            "tickers_daily_history": one(symbol="no"),
            "symbols_dictionary": one(symbol="A"),
        }
    )
    assert as_list(found, "symbol") == [("A",), ("B",)]


def test_factor_is_one_of_the_steps_and_repeatable():
    steps = {n * 0.1 for n in range(20, 201)}
    assert {X.draw_factor(seed) for seed in range(50)} <= steps
    assert X.draw_factor(7) == X.draw_factor(7)


def test_trades(spark):
    rows = spark.createDataFrame(
        [("A", "B", 10.0, 3.0, 5.0, "text"), (None, "?", None, 1.0, 1.0, None)],
        "symbol string, symbol_old string, tradePrice double, quantity double, NetCash double, description string",
    )
    out = X.obfuscate(rows, "trades_history", codes_of(spark, "A", "B"), 2.5, ["quantity"])
    assert out.columns == rows.columns
    assert as_set(out, *out.columns) == {
        ("AAAA", "AAAB", 25.0, 7.5, 12.5, "text"), (None, "?", None, 2.5, 2.5, None),
    }


@pytest.mark.parametrize(
    "dataset, expected",
    [
        ("symbols_dictionary", {("AAAA", "Company AAAA"), ("?", "raw")}),
        ("positions_history", {("AAAA", "Company AAAA"), ("?", "raw")}),
        ("corporate_actions_history", {("AAAA", "Corporate action for AAAA"), ("?", "Corporate action")}),
        ("trades_history", {("AAAA", "raw"), ("?", "raw")}),
    ],
)
def test_descriptions_by_dataset(spark, dataset, expected):
    rows = spark.createDataFrame([("A", "raw"), ("?", "raw")], "symbol string, description string")
    assert as_set(X.obfuscate(rows, dataset, codes_of(spark, "A"), 2.0), "symbol", "description") == expected


def test_cash_texts(spark):
    texts = {
        "AAA(US0001) CASH DIVIDEND": "AAAA CASH DIVIDEND",
        "A.B-c_1(x)  two": "AAAA two",
        "no prefix": "no prefix",
        "AAA(US0001)": "AAA(US0001)",
        None: None,
    }
    rows = spark.createDataFrame([("A", t) for t in texts], "symbol string, description string")
    out = X.obfuscate(rows, "cash_transactions_history", codes_of(spark, "A"), 2.0)
    assert as_set(out, "description") == {(t,) for t in texts.values()}
    unknown = spark.createDataFrame([("?", "AAA(US0001) X")], rows.schema)
    out = X.obfuscate(unknown, "cash_transactions_history", codes_of(spark, "A"), 2.0)
    assert as_set(out, "description") == {("AAA(US0001) X",)}


def test_action_texts(spark):
    rows = spark.createDataFrame(
        [("A", "SO", "x", "t1"), ("A", "SO", None, "t2"), ("A", None, "x", "t3"), ("A", None, None, "t4")],
        "symbol string, type string, code string, actionDescription string",
    )
    out = X.obfuscate(rows, "corporate_actions_history", codes_of(spark, "A"), 2.0)
    assert as_set(out, "actionDescription") == {("SO / x",), ("SO",), ("x",), ("Corporate action",)}
