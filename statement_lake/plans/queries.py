"""Registered queries: each operator on the stand-in sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statement_lake.functions.typed import date_of, double_of, flag_of, is_bad, long_of, timestamp_of, value_text
from statement_lake.operators import ledger as runs
from statement_lake.operators import upsert
from statement_lake.operators.obfuscate import distinct_symbols, obfuscate, symbol_codes
from statement_lake.operators.registry import (
    REGISTRY_SCHEMA,
    candidates,
    dictionary,
    map_by,
    register,
    resolve,
)
from statement_lake.operators.snapshot import batch_summary, in_order, stored_positions
from statement_lake.plans import stand_ins as base
from statement_lake.plans.lake import Lake
from statement_lake.plans.landing import land, landing_latest
from statement_lake.plans.marts import extend_registry, mart
from statement_lake.plans.pipeline import Phases, Request, load_files, refresh
from statement_lake.session import scratch_path, settle
from statement_lake.sources import specs
from statement_lake.sources.bars import BarFiles, normalize_bars, trailing_bars
from statement_lake.sources.specs import SourceSpec
from statement_lake.sources.statements import admits_detail, ingest
from statement_lake.sources.triage import request_verdict, statement_verdict
from statement_lake.streaming.folder import follow_folder

Query = Callable[[SparkSession, str], DataFrame]

FACTOR = 2.5
NOW = dt.datetime(2024, 3, 1)


#: Records of a statement file, about.
FILE_ROWS = 20_000


def _month_file(rows: DataFrame, date: str) -> Column:
    """File of a record: month of its date, and as many files a month as the rows ask for."""
    month = F.coalesce(F.date_format(date, "yyyyMM"), F.lit("undated"))
    most = rows.groupBy(month).count().agg(F.max("count")).first()[0] or 0
    buckets = -(-most // FILE_ROWS) or 1
    bucket = F.pmod(F.xxhash64(*rows.columns), F.lit(buckets)).cast("string")
    return F.concat(month, F.lit("-"), bucket)


def hashed(rows: DataFrame) -> DataFrame:
    return base.with_fingerprint(rows, "h")


# -- text to types ---------------------------------------------------------------------


def content_hash(spark: SparkSession, folder: str) -> DataFrame:
    rows = base.with_fingerprint(base.trades(spark, folder))
    return rows.select("tradeID", "sourceHashHex")


def _variant(texts: dict[str, Column]) -> Column:
    """Pick a rendering by priority and status of the order."""
    kind = F.concat("o_orderpriority", "o_orderstatus")
    chosen = F.lit(None).cast("string")
    for name, text in reversed(texts.items()):
        chosen = F.when(kind == name, text).otherwise(chosen)
    return chosen


def _date_texts(spark: SparkSession, folder: str) -> DataFrame:
    date = F.col("o_orderdate")

    def like(pattern: str) -> Column:
        return F.date_format(date, pattern)

    raw = _variant(
        {
            "1-URGENTF": like("yyyyMMdd"),
            "1-URGENTO": like("yyyy-MM-dd"),
            "1-URGENTP": F.concat(F.lit(" "), like("yyyy-MM-dd"), F.lit(" ")),
            "2-HIGHF": F.concat(like("yyyyMM"), F.lit("31")),
            "2-HIGHO": like("yyyy-M-d"),
            "2-HIGHP": like("yyyy/MM/dd"),
            "3-MEDIUMF": F.lit(""),
            "3-MEDIUMO": F.lit("  "),
            "3-MEDIUMP": F.concat(like("yyyyMMdd"), F.lit("093000")),
            "4-NOT SPECIFIEDF": F.concat(like("yyyy-MM-dd"), F.lit(";09:30:00")),
            "4-NOT SPECIFIEDO": F.concat(like("yyyy-MM-dd"), F.lit("T09:30:00")),
            "4-NOT SPECIFIEDP": F.concat(like("yyyy-MM-dd"), F.lit(" 24:00:00")),
            "5-LOWF": F.concat(like("yyyyMMdd"), F.lit(";093000")),
            "5-LOWO": F.concat(like("yyyy-MM-dd"), F.lit(" 9:5:0")),
        }
    )
    return base.table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))


def _number_texts(spark: SparkSession, folder: str) -> DataFrame:
    price = base.money(F.col("o_totalprice"))
    key = F.col("o_custkey").cast("string")
    raw = _variant(
        {
            "1-URGENTF": price,
            "1-URGENTO": key,
            "1-URGENTP": F.concat(F.lit("-"), key),
            "2-HIGHF": F.concat(F.lit("1,"), F.lpad(key, 9, "0")),
            "2-HIGHO": F.concat(F.lit(" "), price, F.lit(" ")),
            "2-HIGHP": F.concat(key, F.lit("d")),
            "3-MEDIUMF": F.lit(""),
            "3-MEDIUMO": F.lit("  "),
            "3-MEDIUMP": F.concat(key, F.lit("e2")),
            "4-NOT SPECIFIEDF": F.lit("n/a"),
            "4-NOT SPECIFIEDO": F.lit(".5"),
            "4-NOT SPECIFIEDP": F.concat(key, F.lit("_000")),
            "5-LOWF": F.lit("Y"),
            "5-LOWO": F.lit(" n "),
        }
    )
    return base.table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))


def _checked(rows: DataFrame, **values: Column) -> DataFrame:
    """Parsed values of ``text``, and whether the first could not be read."""
    first = next(iter(values.values()))
    texts = rows.select("o_orderkey", value_text(F.col("raw")).alias("text"))
    return texts.select(
        "o_orderkey",
        *[value.alias(name) for name, value in values.items()],
        is_bad(F.col("text"), first).alias("bad"),
    )


def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(_date_texts(spark, folder), value=date_of(F.col("text")))


def parse_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(_date_texts(spark, folder), value=timestamp_of(F.col("text")))


def parse_numbers(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return _checked(_number_texts(spark, folder), value=double_of(text), whole=long_of(text))


def parse_flags(spark: SparkSession, folder: str) -> DataFrame:
    rows = _number_texts(spark, folder)
    return rows.select("o_orderkey", flag_of(value_text(F.col("raw"))).alias("value"))


def admit_detail_rows(spark: SparkSession, folder: str) -> DataFrame:
    return base.cash_transactions(spark, folder).where(admits_detail(F.col("levelOfDetail")))


# -- sources ---------------------------------------------------------------------------


def _statement_folder(spark: SparkSession, rows: DataFrame, spec: SourceSpec) -> str:
    """Statement files of the rows, by month of the source's date."""
    folder = scratch_path(spark, f"statements-{spec.name}")
    base.write_statements(rows, spec.element, _month_file(rows, spec.date), folder)
    return folder


def _ingested(spark: SparkSession, rows: DataFrame, spec: SourceSpec) -> DataFrame:
    folder = _statement_folder(spark, rows, spec)
    names = [name for name in rows.columns if name != spec.detail_attribute]
    read = ingest(spark, folder, spec, pattern=base.WRITTEN_FILES).rows
    return read.select(*names, spec.hash)


def ingest_trades(spark: SparkSession, folder: str) -> DataFrame:
    return _ingested(spark, base.trades(spark, folder), specs.TRADES)


def ingest_corporate_actions(spark: SparkSession, folder: str) -> DataFrame:
    return _ingested(spark, base.corporate_actions(spark, folder), specs.CORPORATE_ACTIONS)


def ingest_positions(spark: SparkSession, folder: str) -> DataFrame:
    return _ingested(spark, base.positions(spark, folder), specs.POSITIONS)


def ingest_cash_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _ingested(spark, base.cash_transactions(spark, folder), specs.CASH_TRANSACTIONS)


def ingest_account_nav(spark: SparkSession, folder: str) -> DataFrame:
    return _ingested(spark, base.account_nav(spark, folder), specs.ACCOUNT_NAV)


def bars(spark: SparkSession, folder: str) -> DataFrame:
    raw = base.raw_bars(spark, folder)
    return normalize_bars(raw, F.col("symbol"), F.lit("stand-in"))


def bars_trailing_days(spark: SparkSession, folder: str) -> DataFrame:
    return trailing_bars(bars(spark, folder), _last_day(spark, folder))


def _last_day(spark: SparkSession, folder: str) -> dt.date:
    events = base.table(spark, folder, "events")
    return events.agg(F.max(F.col("ts").cast("date")).alias("d")).first().d


def summary(spark: SparkSession, folder: str) -> DataFrame:
    return batch_summary(base.positions(spark, folder), "accountId", "reportDate")


def response_triage(spark: SparkSession, folder: str) -> DataFrame:
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    replies = base.table(spark, folder, "orders").select(
        "o_orderkey",
        (priority == "1-URGENT").alias("has_statement"),
        F.when(priority != "2-HIGH", "FlexStatementResponse").otherwise("html").alias("root"),
        F.when(status == "F", "Fail").when(status == "O", "Success").otherwise("Warn").alias("status"),
        (F.lit(1000) + F.dayofmonth("o_orderdate")).cast("string").alias("code"),
        F.when(priority != "5-LOW", F.col("o_orderkey").cast("string"))
        .otherwise(F.lit(""))
        .alias("reference"),
    )
    root, state, code = F.col("root"), F.col("status"), F.col("code")
    return replies.select(
        "o_orderkey",
        statement_verdict(F.col("has_statement"), root, state, code).alias("fetch_verdict"),
        request_verdict(root, state, code, F.col("reference")).alias("request_verdict"),
    )


# -- upserts ---------------------------------------------------------------------------


def upsert_by_hash(spark: SparkSession, folder: str) -> DataFrame:
    """All trades are delivered again, one kind with corrected prices."""
    stored = base.trades(spark, folder)
    corrected = F.when(F.col("transactionType") == "A", F.col("tradePrice") * 2)
    batch = stored.withColumn("tradePrice", corrected.otherwise(F.col("tradePrice")))
    return upsert.replace_by_hash(hashed(stored), settle(hashed(batch), "batch"), "h")


def _new_positions(spark: SparkSession, folder: str) -> DataFrame:
    """The trailing ten days and the undated rows again, clicks corrected."""
    start = _last_day(spark, folder) - dt.timedelta(days=10)
    rows = base.positions(spark, folder)
    again = rows.where((F.col("symbol") == "ERROR") | (F.col("reportDate") >= F.lit(start)))
    corrected = F.when(F.col("symbol") == "CLICK", F.col("position") * 2)
    return again.withColumn("position", corrected.otherwise(F.col("position")))


def upsert_replace_dates(spark: SparkSession, folder: str) -> DataFrame:
    stored = hashed(base.positions(spark, folder))
    batch = settle(hashed(_new_positions(spark, folder)), "batch")
    return upsert.replace_dates(stored, batch, "reportDate", "h")


def upsert_positions_backfill(spark: SparkSession, folder: str) -> DataFrame:
    stored = hashed(base.positions(spark, folder))
    batch = settle(hashed(_new_positions(spark, folder)), "batch")
    return upsert.replace_by_hash(stored, batch, "h")


def _one_nav(rows: DataFrame) -> DataFrame:
    return upsert.greatest_hash_per_key(hashed(rows), ["accountId", "reportDate"], "h")


def upsert_by_key(spark: SparkSession, folder: str) -> DataFrame:
    stored = base.account_nav(spark, folder)
    again = stored.where(F.col("currency") != "CUO").withColumn("total", F.col("total") * 2)
    return upsert.replace_by_key(_one_nav(stored), _one_nav(again), ["accountId", "reportDate"])


def upsert_bars(spark: SparkSession, folder: str) -> DataFrame:
    stored = bars(spark, folder)
    batch = trailing_bars(stored, _last_day(spark, folder)).withColumn("close", F.col("close") * 2)
    return upsert.replace_by_key(stored, batch, ["symbol", "source", "reportDate"])


def bulk_last_file_wins(spark: SparkSession, folder: str) -> DataFrame:
    rows = base.table(spark, folder, "lineitem").select(
        F.concat("l_returnflag", F.col("l_partkey").cast("string")).alias("content"),
        base.tagged("file-", "l_linenumber").alias("file_order"),
        "l_orderkey",
    )
    return upsert.last_file_by_hash(rows, "content").select("content", "file_order", "l_orderkey")


def bulk_last_file_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Trades that several files deliver, by the hash of their content: the last file's copies stay.

    Every trade is in the file of its kind, and every third order in a later one
    as well, twice.
    """
    trades = hashed(base.trades(spark, folder))
    first = trades.withColumn("file_order", F.concat(F.lit("file-"), "transactionType"))
    later = trades.where("tradeID % 3 = 0").withColumn("file_order", F.lit("later"))
    rows = first.unionByName(later).unionByName(later)
    return upsert.last_file_copies(rows, "h", trades.columns)


def bulk_last_file_by_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = hashed(base.account_nav(spark, folder)).withColumn("file_order", F.col("currency"))
    last = upsert.last_file_by_key(rows, ["accountId", "reportDate"], "h")
    return last.drop("file_order")


# -- registry --------------------------------------------------------------------------


def _found_trades(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(base.trades(spark, folder), "trades", category="STK")


def symbol_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    return _found_trades(spark, folder)


def _found_actions(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("actionDescription", "description")
    return candidates(base.corporate_actions(spark, folder), "corporate_actions", text, "STK")


def register_corporate_actions(spark: SparkSession, folder: str) -> DataFrame:
    return register(_found_trades(spark, folder), _found_actions(spark, folder))


def symbol_map_conid(spark: SparkSession, folder: str) -> DataFrame:
    return map_by(settle(_found_trades(spark, folder), "registry"), "conid")


def symbol_map_description(spark: SparkSession, folder: str) -> DataFrame:
    return map_by(settle(_found_trades(spark, folder), "registry"), "description")


def symbol_map_full(spark: SparkSession, folder: str) -> DataFrame:
    return resolve(settle(_found_trades(spark, folder), "registry"))


def _folded(spark: SparkSession, sources: dict[SourceSpec, DataFrame]) -> DataFrame:
    registry = spark.createDataFrame([], REGISTRY_SCHEMA)
    for spec, rows in sources.items():
        registry = extend_registry(registry, spec, rows)
    return registry


def _cash(spark: SparkSession, folder: str) -> DataFrame:
    """Cash movements as bronze admits them."""
    return base.cash_transactions(spark, folder).where(admits_detail(F.col("levelOfDetail")))


def registry_fold(spark: SparkSession, folder: str) -> DataFrame:
    return _folded(
        spark,
        {
            specs.TRADES: base.trades(spark, folder),
            specs.CORPORATE_ACTIONS: base.corporate_actions(spark, folder),
            specs.POSITIONS: base.positions(spark, folder),
            specs.CASH_TRANSACTIONS: _cash(spark, folder),
        },
    )


def symbol_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    return dictionary(registry_fold(spark, folder))


# -- marts -----------------------------------------------------------------------------


def _mart(dataset_id: str, rows: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """A dataset in full width over stand-in rows."""
    spec, definition = next((s, m) for s in specs.SOURCES for m in s.marts if m.dataset_id == dataset_id)
    return mart(definition, spec, base.whole(rows, spec), registry)


def trades_history(spark: SparkSession, folder: str) -> DataFrame:
    return _mart("trades_history", base.trades(spark, folder), registry_fold(spark, folder))


def corporate_actions_history(spark: SparkSession, folder: str) -> DataFrame:
    rows = base.corporate_actions(spark, folder)
    return _mart("corporate_actions_history", rows, registry_fold(spark, folder))


def cash_transactions_history(spark: SparkSession, folder: str) -> DataFrame:
    return _mart("cash_transactions_history", _cash(spark, folder), registry_fold(spark, folder))


def positions_history(spark: SparkSession, folder: str) -> DataFrame:
    return _mart("positions_history", base.positions(spark, folder), registry_fold(spark, folder))


def positions_latest(spark: SparkSession, folder: str) -> DataFrame:
    return _mart("positions_latest", base.positions(spark, folder))


def account_nav_latest(spark: SparkSession, folder: str) -> DataFrame:
    return _mart("account_nav_latest", _one_nav(base.account_nav(spark, folder)))


def account_nav_history(spark: SparkSession, folder: str) -> DataFrame:
    return _mart("account_nav_history", _one_nav(base.account_nav(spark, folder)))


def account_nav_order(spark: SparkSession, folder: str) -> DataFrame:
    """Where each account's day stands in the files of the ordered history."""
    rows = in_order(_one_nav(base.account_nav(spark, folder)), "accountId", "reportDate")
    path = scratch_path(spark, "ordered")
    rows.write.parquet(path)
    return stored_positions(spark.read.parquet(path)).select("accountId", "reportDate", "position")


def tickers_daily_history(spark: SparkSession, folder: str) -> DataFrame:
    """Bar files of all ticks, loaded, stored and published."""
    files = scratch_path(spark, "bar-files")
    base.write_bars(base.raw_bars(spark, folder), files)
    root = scratch_path(spark, "lake")
    inputs = {specs.TICKERS_DAILY.name: BarFiles(files, source="stand-in")}
    _refreshed(spark, root, inputs, [specs.TICKERS_DAILY])
    return Lake(spark, root).dataset("tickers_daily_history")


# -- obfuscated copies -----------------------------------------------------------------


def _codes(spark: SparkSession, folder: str, cash: DataFrame | None = None) -> DataFrame:
    return symbol_codes(
        distinct_symbols(
            {
                "trades_history": base.trades(spark, folder),
                "corporate_actions_history": base.corporate_actions(spark, folder),
                "cash_transactions_history": _cash(spark, folder) if cash is None else cash,
                "positions_history": base.positions(spark, folder),
            }
        )
    )


def _obfuscated(
    rows: DataFrame, dataset_id: str, spark: SparkSession, folder: str, columns: str
) -> DataFrame:
    codes = settle(_codes(spark, folder), "codes")
    return obfuscate(rows.select(*columns.split()), dataset_id, codes, FACTOR)


def obfuscate_trades(spark: SparkSession, folder: str) -> DataFrame:
    columns = "symbol assetCategory reportDate quantity tradePrice taxes"
    return _obfuscated(base.trades(spark, folder), "trades_history", spark, folder, columns)


def obfuscate_company(spark: SparkSession, folder: str) -> DataFrame:
    columns = "symbol description reportDate position positionValue"
    return _obfuscated(base.positions(spark, folder), "positions_latest", spark, folder, columns)


def obfuscate_cash_text(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of all cash movements, summaries too: whatever a table holds is rewritten.

    The codes cover the symbols of all these rows, so that none stays readable.
    """
    rows = base.cash_transactions(spark, folder)
    codes = settle(_codes(spark, folder, rows), "codes")
    columns = rows.select("symbol", "description", "reportDate", "amount")
    return obfuscate(columns, "cash_transactions_history", codes, FACTOR)


def obfuscate_action_text(spark: SparkSession, folder: str) -> DataFrame:
    columns = "symbol type code reportDate description actionDescription quantity value"
    rows = base.corporate_actions(spark, folder)
    return _obfuscated(rows, "corporate_actions_history", spark, folder, columns)


# -- ledger and manifest ---------------------------------------------------------------


def job_state(spark: SparkSession, folder: str) -> DataFrame:
    return runs.job_state(base.ledger(spark, folder), F.struct("run_utc", "event_id"))


def job_ages(spark: SparkSession, folder: str) -> DataFrame:
    return runs.job_ages(base.ledger(spark, folder), NOW)


def last_run(spark: SparkSession, folder: str) -> DataFrame:
    return runs.last_run(base.ledger(spark, folder), NOW)


def manifest_latest(spark: SparkSession, folder: str) -> DataFrame:
    registrations = base.table(spark, folder, "events").select(
        base.tagged("dataset-", "user_id").alias("dataset_id"),
        base.tagged("/gold/", "event_id").alias("path"),
        F.col("event_type").alias("kind"),
        F.col("ts").alias("updated_utc"),
        "event_id",
    )
    latest = runs.manifest_latest(registrations, F.struct("updated_utc", "event_id"))
    return latest.drop("event_id")


# -- whole lake ------------------------------------------------------------------------


def _statement_rows(spark: SparkSession, folder: str) -> dict[SourceSpec, DataFrame]:
    return {
        specs.TRADES: base.trades(spark, folder),
        specs.CORPORATE_ACTIONS: base.corporate_actions(spark, folder),
        specs.POSITIONS: base.positions(spark, folder),
        specs.CASH_TRANSACTIONS: base.cash_transactions(spark, folder),
    }


def _refreshed(
    spark: SparkSession, root: str, inputs: dict, sources: Sequence[SourceSpec], phases: Phases = Phases()
) -> None:
    outcomes = refresh(spark, root, inputs, phases, pattern=base.WRITTEN_FILES, sources=sources)
    failed = [outcome for outcome in outcomes if outcome.status != "ok"]
    if failed:
        raise RuntimeError(f"refresh failed: {failed}")


def lake_trades_history(spark: SparkSession, folder: str) -> DataFrame:
    """Statement files of four sources through bronze, registry and marts."""
    rows = _statement_rows(spark, folder)
    inputs = {spec.name: _statement_folder(spark, df, spec) for spec, df in rows.items()}
    root = scratch_path(spark, "lake")
    _refreshed(spark, root, inputs, list(rows))
    return Lake(spark, root).dataset("trades_history")


def _corrected_lake(spark: SparkSession, folder: str) -> Lake:
    """A lake after two refreshes.

    The second one brings options of the last two years under new symbols (as
    cash movements, which name securities of any kind) and the last trades again
    with other prices; most months stay as they are.
    """
    root = scratch_path(spark, "lake")
    trades, cash = base.trades(spark, folder), base.renamed_cash(spark, folder)
    loaded = {specs.TRADES: base.whole(base.with_fingerprint(trades), specs.TRADES)}
    typed = {spec.name: df.select(*spec.schema.names) for spec, df in loaded.items()}
    sources = [specs.TRADES, specs.CASH_TRANSACTIONS]
    _refreshed(spark, root, typed, sources)
    again = trades.where(F.col("tradeDate") >= F.lit(base.CORRECTED_FROM))
    again = again.withColumn("tradePrice", F.col("tradePrice") * 2)
    loaded = {
        specs.TRADES: base.whole(base.with_fingerprint(again), specs.TRADES),
        specs.CASH_TRANSACTIONS: base.whole(base.with_fingerprint(cash), specs.CASH_TRANSACTIONS),
    }
    typed = {spec.name: df.select(*spec.schema.names) for spec, df in loaded.items()}
    _refreshed(spark, root, typed, sources)
    return Lake(spark, root)


def lake_registry_after_correction(spark: SparkSession, folder: str) -> DataFrame:
    return _corrected_lake(spark, folder).registry()


def lake_trades_after_correction(spark: SparkSession, folder: str) -> DataFrame:
    return _corrected_lake(spark, folder).dataset("trades_history")


def lake_reloaded_trades(spark: SparkSession, folder: str) -> DataFrame:
    """The same statement files loaded twice are stored once."""
    rows = base.trades(spark, folder)
    files = _statement_folder(spark, rows, specs.TRADES)
    lake = Lake(spark, scratch_path(spark, "lake"))
    for _ in range(2):
        ingested = ingest(spark, files, specs.TRADES, pattern=base.WRITTEN_FILES)
        lake.upsert(specs.TRADES, ingested.rows)
        ingested.release()
    return lake.bronze(specs.TRADES).select(*rows.columns, "sourceHashHex")


def _typed(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    return base.whole(base.with_fingerprint(rows, spec.hash), spec).select(*spec.schema.names)


def lake_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger's loads after two runs: three sources, then the last trades again and a batch without rows."""
    root = scratch_path(spark, "lake")
    trades = base.trades(spark, folder)
    again = trades.where(F.col("tradeDate") >= F.lit(base.CORRECTED_FROM))
    positions = base.positions(spark, folder)
    first = {specs.TRADES: trades, specs.CASH_TRANSACTIONS: _cash(spark, folder), specs.POSITIONS: positions}
    second = {specs.TRADES: again, specs.POSITIONS: positions.where("accountId IS NULL")}
    for number, batch in enumerate((first, second), 1):
        given = {spec.name: _typed(rows, spec) for spec, rows in batch.items()}
        asked = {"trades": Request(f"query-{number}", f"reference-{number}"), "positions": Request("query-3")}
        only = Phases(silver=False, gold=False)
        outcomes = refresh(spark, root, given, only, sources=list(batch), requests=asked)
        if any(outcome.status != "ok" for outcome in outcomes):
            raise RuntimeError(f"refresh failed: {outcomes}")
    loads = Lake(spark, root).ledger().where("phase = 'bronze'")
    runs_in_order = loads.select("run_utc").distinct().sort("run_utc").collect()  # two
    first_run = F.lit(runs_in_order[0].run_utc).cast("timestamp_ntz")
    return loads.select(
        F.when(F.col("run_utc") == first_run, 1).otherwise(2).cast("bigint").alias("run"),
        "job_id", "query_id", "reference_code", "status", "report_date", "rows", "error",
    )


def lake_obfuscated_copy(spark: SparkSession, folder: str) -> DataFrame:
    """The anonymised copy of all eight datasets, one row a record: who, when, how much and which text."""
    root = scratch_path(spark, "lake")
    given = {
        specs.TRADES: base.trades(spark, folder),
        specs.CORPORATE_ACTIONS: base.corporate_actions(spark, folder),
        specs.POSITIONS: base.positions(spark, folder),
        specs.CASH_TRANSACTIONS: _cash(spark, folder),
        specs.ACCOUNT_NAV: base.account_nav(spark, folder),
    }
    outcomes = refresh(
        spark, root, {spec.name: _typed(rows, spec) for spec, rows in given.items()},
        Phases(obfuscate=True), factor=FACTOR, sources=list(given),
    )
    if any(outcome.status != "ok" for outcome in outcomes):
        raise RuntimeError(f"refresh failed: {outcomes}")
    lake = Lake(spark, root)
    shown = {
        "trades_history": ("symbol", "reportDate", "tradePrice", None),
        "corporate_actions_history": ("symbol", "reportDate", "value", "description"),
        "cash_transactions_history": ("symbol", "reportDate", "amount", "description"),
        "positions_history": ("symbol", "reportDate", "positionValue", None),
        "positions_latest": ("symbol", "reportDate", "positionValue", "description"),
        "account_nav_history": (None, "reportDate", "total", None),
        "account_nav_latest": (None, "reportDate", "cash", None),
        "symbols_dictionary": ("symbol", None, None, "description"),
    }
    kinds = {"symbol": "string", "reportDate": "date", "money": "double", "text": "string"}
    parts = [
        lake.dataset(dataset_id, "obfuscated").select(
            F.lit(dataset_id).alias("dataset_id"),
            *[(F.col(c) if c else F.lit(None)).cast(t).alias(n) for c, (n, t) in zip(columns, kinds.items())],
        )
        for dataset_id, columns in shown.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def folder_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A watched folder in three micro-batches; after a restart a fourth one brings corrections."""
    rows = base.trades(spark, folder)
    files = scratch_path(spark, "watched")
    lake, checkpoint = Lake(spark, scratch_path(spark, "lake")), scratch_path(spark, "stream")

    def caught_up(part: DataFrame, name: str, batches: int) -> None:
        base.write_statements(part, specs.TRADES.element, _month_file(part, specs.TRADES.date), f"{files}/{name}")
        new = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
            "pathGlobFilter", base.WRITTEN_FILES
        ).load(f"{files}/{name}")
        many = -(-len(new.inputFiles()) // batches)
        follow_folder(
            spark, lake, specs.TRADES, files, checkpoint, max_files=many, pattern=base.WRITTEN_FILES
        ).awaitTermination()

    caught_up(rows, "first", 3)
    late = rows.where(F.col("tradeDate") >= F.lit(base.CORRECTED_FROM))
    caught_up(late.withColumn("tradePrice", F.col("tradePrice") * 2), "second", 1)
    ended = lake.batches().count()
    if ended < 4:
        raise RuntimeError(f"{ended} batches")
    return lake.bronze(specs.TRADES).select(*rows.columns, "sourceHashHex")


def backfill_files(spark: SparkSession, folder: str) -> DataFrame:
    """A backfill of a file a month that broke off after the early ones and was resumed, as its file ledger."""
    rows = base.trades(spark, folder)
    month = F.date_format("tradeDate", "yyyyMM")
    files = scratch_path(spark, "backfill")
    early = F.col("tradeDate") < F.lit(base.CASH_FROM)
    lake = Lake(spark, scratch_path(spark, "lake"))
    for part, name in ((rows.where(early), "early"), (rows.where(~early), "late")):
        base.write_statements(part, specs.TRADES.element, month, f"{files}/{name}")
        load_files(lake, specs.TRADES, files, backfill=True, pattern=base.WRITTEN_FILES, resume=True)
    ledger = lake.files(specs.TRADES)
    return ledger.select(
        F.regexp_extract("file", "file=([0-9]+)", 1).alias("month"), "rows", "min_date", "max_date", "dates", "reason"
    )


def landing_states(spark: SparkSession, folder: str) -> DataFrame:
    """Answers of the statement service, landed as files: what became of each reference."""
    files = scratch_path(spark, "landing")
    base.write_responses(spark, folder, files)
    lake = Lake(spark, scratch_path(spark, "lake"))
    for _ in range(2):  # what has been dealt with is not dealt with again
        land(lake, specs.TRADES, files, pattern=base.WRITTEN_FILES)
    loaded = lake.bronze(specs.TRADES).groupBy(F.col("ibExecID").alias("reference")).agg(F.count("*").alias("rows"))
    states = landing_latest(lake.landed(specs.TRADES))
    return states.join(loaded, "reference", "left").select(
        "reference", "attempts", "verdict", "code", F.coalesce("rows", F.lit(0)).alias("rows")
    )


def queries() -> dict[str, Query]:
    return {
        "content_hash": content_hash,
        "parse_dates": parse_dates,
        "parse_timestamps": parse_timestamps,
        "parse_numbers": parse_numbers,
        "parse_flags": parse_flags,
        "admit_detail_rows": admit_detail_rows,
        "ingest_trades": ingest_trades,
        "ingest_corporate_actions": ingest_corporate_actions,
        "ingest_positions": ingest_positions,
        "ingest_cash_transactions": ingest_cash_transactions,
        "ingest_account_nav": ingest_account_nav,
        "normalize_bars": bars,
        "bars_trailing_days": bars_trailing_days,
        "batch_summary": summary,
        "response_triage": response_triage,
        "upsert_by_hash": upsert_by_hash,
        "upsert_replace_dates": upsert_replace_dates,
        "upsert_positions_backfill": upsert_positions_backfill,
        "upsert_by_key": upsert_by_key,
        "upsert_bars": upsert_bars,
        "bulk_last_file_wins": bulk_last_file_wins,
        "bulk_last_file_copies": bulk_last_file_copies,
        "bulk_last_file_by_key": bulk_last_file_by_key,
        "symbol_first_seen": symbol_first_seen,
        "register_corporate_actions": register_corporate_actions,
        "symbol_map_conid": symbol_map_conid,
        "symbol_map_description": symbol_map_description,
        "symbol_map_full": symbol_map_full,
        "registry_fold": registry_fold,
        "symbol_dictionary": symbol_dictionary,
        "trades_history": trades_history,
        "corporate_actions_history": corporate_actions_history,
        "cash_transactions_history": cash_transactions_history,
        "positions_history": positions_history,
        "positions_latest": positions_latest,
        "account_nav_latest": account_nav_latest,
        "account_nav_history": account_nav_history,
        "account_nav_order": account_nav_order,
        "tickers_daily_history": tickers_daily_history,
        "symbol_codes": _codes,
        "obfuscate_trades": obfuscate_trades,
        "obfuscate_company": obfuscate_company,
        "obfuscate_cash_text": obfuscate_cash_text,
        "obfuscate_action_text": obfuscate_action_text,
        "job_state": job_state,
        "job_ages": job_ages,
        "last_run": last_run,
        "manifest_latest": manifest_latest,
        "lake_trades_history": lake_trades_history,
        "lake_registry_after_correction": lake_registry_after_correction,
        "lake_trades_after_correction": lake_trades_after_correction,
        "lake_reloaded_trades": lake_reloaded_trades,
        "lake_ledger": lake_ledger,
        "lake_obfuscated_copy": lake_obfuscated_copy,
        "folder_stream": folder_stream,
        "landing_states": landing_states,
        "backfill_files": backfill_files,
    }
