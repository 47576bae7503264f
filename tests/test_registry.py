import datetime as dt
import random

import pytest

from statement_lake.operators import registry as R
from statement_lake.operators.snapshot import batch_summary, in_order, latest_snapshot
from statement_lake.plans.marts import extend_registry
from statement_lake.session import settle
from statement_lake.sources import specs
from tests.helpers import as_list, as_set

D = dt.date


def registry(spark, *rows):
    return settle(spark.createDataFrame(list(rows), R.REGISTRY_SCHEMA), "t")


def row(symbol, conid, text, day, src="trades", to=None):
    return (to, symbol, conid, text, None if day is None else D(2024, 1, day), src)


def mapping(df):
    return as_set(df, "symbol", "conid", "description", "map_to")


def literal(rows, key):
    """Pair every row with all earlier rows of its key; map open rows to the earliest."""
    out = []
    for to, symbol, conid, text, day, src in rows:
        value = conid if key == "conid" else text
        if to is None and symbol is not None and value is not None:
            group = [r for r in rows if (r[2] if key == "conid" else r[3]) == value]
            own = [r for r in group if r[1] == symbol and r[4] is not None]
            early = [
                r for r in group if r[4] is not None and any(o[4] > r[4] for o in own)
            ]
            if early:
                to = min(early, key=lambda r: (r[4], r[1] is None, r[1] or ""))[1]
        out.append((to, symbol, conid, text, day, src))
    return out


@pytest.mark.parametrize("key", ["conid", "description"])
def test_rewrite_equals_the_literal_self_join(spark, key):
    for seed in range(4):
        rng = random.Random(seed)
        seen, rows = set(), []
        for _ in range(60):
            symbol = rng.choice(["A", "B", "C", "D", None])
            conid, text = rng.randint(1, 4), rng.choice(["x", "y", "", None, "z"])
            if (symbol, conid, text) in seen:
                continue
            seen.add((symbol, conid, text))
            day = rng.choice([None, *range(1, 28)])
            rows.append(row(symbol, conid, text, day, to=rng.choice([None, None, "M"])))
        found = R.map_by(registry(spark, *rows), key)
        assert as_list(found, *found.columns) == sorted(literal(rows, key), key=repr)


def test_rename_and_one_hop(spark):
    rows = registry(
        spark,
        row("OLD", 1, "Acme", 1), row("NEW", 1, "Acme Corp", 5), row("NEWER", 1, "Acme SE", 9),
        row("SAME", 2, "Same", 3), row("SAME", 2, "Same Inc", 4),
        # B came before A by contract, C before B by text: A follows one hop only.
        row("C", 4, "shared", 1), row("B", 3, "shared", 2), row("A", 3, "other", 3),
        row("TIE2", 5, "t2", 6), row("TIE1", 5, "t1", 6),
    )
    assert mapping(R.resolve(rows)) == {
        ("OLD", 1, "Acme", "OLD"), ("NEW", 1, "Acme Corp", "OLD"), ("NEWER", 1, "Acme SE", "OLD"),
        ("SAME", 2, "Same", "SAME"), ("SAME", 2, "Same Inc", "SAME"),
        ("C", 4, "shared", "C"), ("B", 3, "shared", "C"), ("A", 3, "other", "B"),
        ("TIE2", 5, "t2", "TIE2"), ("TIE1", 5, "t1", "TIE1"),
    }


def test_blank_and_missing_descriptions(spark):
    rows = registry(spark, row("A", 1, "", 1), row("B", 2, "", 2), row("C", 3, None, 1), row("D", 4, None, 2))
    assert mapping(R.resolve(rows)) == {
        ("A", 1, "", "A"), ("B", 2, "", "A"), ("C", 3, None, "C"), ("D", 4, None, "D"),
    }
    assert ("B", 2, "", "B") in mapping(R.resolve(rows, ignore_blank_description=True))


def facts(spark, *rows):
    schema = (
        "symbol string, conid bigint, description string, actionDescription string, "
        "assetCategory string, reportDate date"
    )
    return spark.createDataFrame(list(rows), schema)


def test_fold_is_path_dependent_and_first_writer_wins(spark):
    start = registry(spark)
    later = facts(spark, ("NEW", 1, "Acme", None, "STK", D(2024, 1, 5)), ("OPT", 9, "o", None, "OPT", D(2024, 1, 1)))
    one = extend_registry(start, specs.TRADES, later)
    assert as_set(one, "symbol", "map_to", "first_seen") == {("NEW", "NEW", D(2024, 1, 5))}
    older = facts(spark, ("OLD", 1, "Acme plc", None, "STK", D(2023, 1, 1)), ("NEW", 1, "Acme", None, "STK", D(2022, 1, 1)))
    two = extend_registry(one, specs.TRADES, older)
    assert as_set(two, "symbol", "map_to", "first_seen") == {
        ("NEW", "NEW", D(2024, 1, 5)), ("OLD", "OLD", D(2023, 1, 1)),
    }
    assert extend_registry(two, specs.TRADES, older).count() == 2


def test_missing_texts_are_registered_once(spark):
    rows = facts(spark, ("A", 1, None, None, None, D(2024, 1, 1)))
    one = extend_registry(registry(spark), specs.POSITIONS, rows)
    assert extend_registry(one, specs.POSITIONS, rows).count() == 1


def test_corporate_actions_register_the_action_text_but_join_on_description(spark):
    rows = facts(spark, ("A", 1, "plain", "action", "STK", D(2024, 1, 2)), ("B", 1, "b", None, "STK", D(2024, 1, 3)))
    done = extend_registry(registry(spark), specs.CORPORATE_ACTIONS, rows)
    assert as_set(done, "symbol", "description", "map_to") == {("A", "action", "A"), ("B", "b", "A")}
    assert as_list(R.canonical(rows, done), "symbol") == [("A",), ("A",)]


def test_canonical_joins_exact_triples_without_multiplying(spark):
    known = registry(
        spark, row("B", 1, "x", 2, to="A"), row("B", 1, None, 2, to="Z"), row("B", 2, "x", 2, to="Q"),
    )
    rows = facts(
        spark,
        ("B", 1, "x", None, "STK", D(2024, 1, 1)), ("B", 1, "x", None, "STK", D(2024, 1, 1)),
        ("B", 1, None, None, "STK", D(2024, 1, 2)), ("B", None, "x", None, "STK", D(2024, 1, 3)),
        ("C", 1, "x", None, "STK", D(2024, 1, 4)),
    )
    assert as_list(R.canonical(rows, known), "symbol") == [("A",), ("A",), ("B",), ("B",), ("C",)]


def test_dictionary_takes_the_latest_text_of_trades_and_positions(spark):
    rows = registry(
        spark,
        row("A", 1, "first", 1, "trades", "A"), row("B", 1, "second", 5, "positions", "A"),
        row("C", 1, "third", 9, "corporate_actions", "A"), row("X", 2, "only", 2, "cash_transactions", "X"),
        row("Y", 3, "t2", 4, "trades", "Y"), row("Y", 3, "t1", 4, "trades", "Y"),
        row("N", 4, "undated", None, "trades", "N"),
    )
    assert as_set(R.dictionary(rows), "symbol", "description") == {("A", "second"), ("Y", "t1")}


def test_latest_snapshot_summary_and_order(spark):
    rows = spark.createDataFrame(
        [("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 3), 2), ("b", D(2024, 1, 2), 3), ("b", None, 4)],
        "account string, day date, v int",
    )
    assert as_set(latest_snapshot(rows, "day"), "v") == {(2,)}
    assert as_set(batch_summary(rows, "account", "day"), "account", "rows", "min_date", "max_date", "dates") == {
        ("a", 2, D(2024, 1, 1), D(2024, 1, 3), 2), ("b", 2, D(2024, 1, 2), D(2024, 1, 2), 1),
    }
    assert [r.v for r in in_order(rows, "account", "day").collect()] == [1, 2, 4, 3]
