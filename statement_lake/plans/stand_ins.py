"""Statement sources made out of order, line item and event tables.

Order lines stand in for trades and corporate actions, events for position
snapshots and price bars, orders for cash movements and account values.  Every
row of a table becomes a record, so the work grows with the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statement_lake.functions.fingerprint import fingerprint_of
from statement_lake.session import shuffles_freed
from statement_lake.sources.specs import SourceSpec


#: Names of the files that are written here; statements are compressed.
WRITTEN_FILES = "*.txt*"

#: Days from which the corrected lake has its second load.
CASH_FROM, CORRECTED_FROM = dt.date(2000, 1, 1), dt.date(2001, 1, 1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(value: Column) -> Column:
    return value.cast("decimal(20,2)").cast("string")


def compact(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def tagged(prefix: str, *parts: str) -> Column:
    return F.concat(F.lit(prefix), *[F.col(part).cast("string") for part in parts])


def whole(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    """The rows with all columns of their source; what the stand-in lacks is missing."""
    absent = [field for field in spec.schema.fields if field.name not in rows.columns]
    return rows.select("*", *[F.lit(None).cast(field.dataType).alias(field.name) for field in absent])


def with_fingerprint(rows: DataFrame, column: str = "sourceHashHex") -> DataFrame:
    """Content hash over all columns as they are written to text."""
    return rows.withColumn(
        column, fingerprint_of(**{name: text(rows, name) for name in rows.columns})
    )


def text(rows: DataFrame, name: str) -> Column:
    kind = dict(rows.dtypes)[name]
    if kind == "double":
        return money(F.col(name))
    if kind == "date":
        return compact(F.col(name))
    return F.col(name).cast("string")


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """A part is a contract that trades under each supplier's symbol; three parts share a text."""
    day = F.col("l_shipdate").cast("date")
    return table(spark, folder, "lineitem").select(
        tagged("U", "l_suppkey").alias("accountId"),
        F.when(F.col("l_returnflag") == "R", "OPT").otherwise("STK").alias("assetCategory"),
        tagged("S", "l_suppkey").alias("symbol"),
        F.col("l_partkey").alias("conid"),
        F.concat(F.lit("D"), F.expr("l_partkey div 3").cast("string")).alias("description"),
        F.col("l_orderkey").alias("tradeID"),
        F.col("l_returnflag").alias("transactionType"),
        day.alias("reportDate"),
        day.alias("tradeDate"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("tradePrice"),
        F.col("l_tax").alias("taxes"),
    )


def corporate_actions(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    family = F.concat(F.lit("D"), F.expr("l_partkey div 3").cast("string"))
    return table(spark, folder, "lineitem").select(
        tagged("U", "l_suppkey").alias("accountId"),
        F.when(F.col("l_returnflag") == "A", "OPT").otherwise("STK").alias("assetCategory"),
        tagged("S", "l_suppkey").alias("symbol"),
        F.col("l_partkey").alias("conid"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("type"),
        F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")).alias("code"),
        day.alias("reportDate"),
        family.alias("description"),
        F.when(F.col("l_linestatus") == "F", F.concat(family, F.lit(" split"))).alias(
            "actionDescription"
        ),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("value"),
    )


def positions(spark: SparkSession, folder: str) -> DataFrame:
    """Daily holdings of users; error events have no report date."""
    day = F.when(F.col("event_type") != "error", F.col("ts").cast("date"))
    return table(spark, folder, "events").select(
        tagged("U", "user_id").alias("accountId"),
        F.upper("event_type").alias("symbol"),
        F.concat(F.lit("D"), F.expr("user_id div 3").cast("string")).alias("description"),
        F.col("user_id").alias("conid"),
        F.col("event_id").cast("string").alias("securityID"),
        day.alias("reportDate"),
        F.col("value").alias("position"),
        F.col("value").alias("positionValue"),
    )


def cash_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Dividends; low priority texts lack the leading security."""
    named = F.concat(
        tagged("S", "o_custkey"), F.lit("(US"), F.col("o_custkey").cast("string"),
        F.lit(") CASH DIVIDEND "), F.col("o_orderstatus"),
    )
    return table(spark, folder, "orders").select(
        tagged("U", "o_custkey").alias("accountId"),
        F.concat(F.lit("CU"), F.col("o_orderstatus")).alias("currency"),
        tagged("S", "o_custkey").alias("symbol"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("BROKER INTEREST"))
        .when(F.col("o_orderpriority") != "4-NOT SPECIFIED", named)
        .alias("description"),
        F.col("o_custkey").alias("conid"),
        F.col("o_orderdate").cast("date").alias("reportDate"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderkey").cast("string").alias("transactionID"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("SUMMARY"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("DETAIL"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(""))
        .alias("levelOfDetail"),
    )


def account_nav(spark: SparkSession, folder: str) -> DataFrame:
    """Account values by customer and order date; several orders of a day compete."""
    return table(spark, folder, "orders").select(
        tagged("U", "o_custkey").alias("accountId"),
        F.concat(F.lit("CU"), F.col("o_orderstatus")).alias("currency"),
        F.col("o_orderdate").cast("date").alias("reportDate"),
        F.col("o_totalprice").alias("cash"),
        F.col("o_totalprice").alias("total"),
    )


def renamed_cash(spark: SparkSession, folder: str) -> DataFrame:
    """Cash movements that name the options traded since CASH_FROM, which no trade registers."""
    day = F.col("l_shipdate").cast("date")
    return (
        table(spark, folder, "lineitem")
        .where((F.col("l_returnflag") == "R") & (day >= F.lit(CASH_FROM)))
        .select(
            tagged("U", "l_suppkey").alias("accountId"),
            F.lit("CUX").alias("currency"),
            tagged("S", "l_suppkey").alias("symbol"),
            F.concat(F.lit("D"), F.expr("l_partkey div 3").cast("string")).alias("description"),
            F.col("l_partkey").alias("conid"),
            day.alias("reportDate"),
            F.col("l_tax").alias("amount"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transactionID"),
        )
    )


def raw_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Price ticks as a bar file gives them: text, with unreadable numbers."""
    value = money(F.col("value"))
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        tagged("U", "user_id").alias("symbol"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Datetime"),
        value.alias("Open"),
        value.alias("High"),
        value.alias("Low"),
        value.alias("Close"),
        F.when(kind == "error", F.lit("n/a"))
        .when(kind == "view", F.concat(value, F.lit("d")))
        .when(kind == "signup", F.lit("1,000"))
        .when(kind == "click", F.lit(" "))
        .otherwise(value)
        .alias("Adj Close"),
        F.col("event_id").cast("string").alias("Volume"),
    )


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Events as run records: a user is a job, errors fail, views are skipped."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("ts").cast("timestamp_ntz").alias("run_utc"),
        F.when(kind == "signup", F.lit("silver")).otherwise(F.lit("bronze")).alias("phase"),
        tagged("job-", "user_id").alias("job_id"),
        F.lit(None).cast("string").alias("query_id"),
        F.when(kind == "error", F.lit("error"))
        .when(kind == "view", F.lit("skipped"))
        .otherwise(F.lit("ok"))
        .alias("status"),
        tagged("ref-", "event_id").alias("reference_code"),
        F.col("ts").cast("date").alias("report_date"),
        F.col("event_id").alias("rows"),
        F.when(kind == "error", tagged("failed ", "event_id")).alias("error"),
        F.col("event_id"),
    )


# -- statement files out of the same records ------------------------------------------


def _escaped(value: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(plain), F.lit(entity))
    return value


def write_statements(rows: DataFrame, element: str, file: Column, folder: str) -> None:
    """Write records as statement files, one file per value of ``file``.

    Records meet their file's first and last line in one task, so files should
    have a bounded size.
    """
    names = F.array(*[F.lit(name) for name in rows.columns])
    texts = F.transform(F.array(*[text(rows, name) for name in rows.columns]), _escaped)
    attributes = F.array_join(
        F.zip_with(
            names, texts, lambda name, value: F.concat(name, F.lit('="'), value, F.lit('"'))
        ),
        " ",
    )
    opening = F.lit('<?xml version="1.0" encoding="UTF-8"?><FlexQueryResponse><FlexStatement>')
    closing = F.lit("</FlexStatement></FlexQueryResponse>")
    keyed = rows.select(file.alias("_file"), F.lit(1).alias("_part"), "*")
    frame = keyed.select("_file").distinct()
    frame = frame.select("_file", F.explode(F.array(F.lit(0), F.lit(2))).alias("_part"))
    with shuffles_freed(rows.sparkSession):
        (
            keyed.unionByName(frame, allowMissingColumns=True)
            .repartition("_file")
            .sortWithinPartitions("_file", "_part")
            .select(
                F.col("_file").alias("file"),
                F.when(F.col("_part") == 0, opening)
                .when(F.col("_part") == 2, closing)
                .otherwise(F.concat(F.lit(f"<{element} "), attributes, F.lit("/>")))
                .alias("value"),
            )
            .write.partitionBy("file")
            .option("compression", "gzip")
            .text(folder)
        )


def write_responses(spark: SparkSession, folder: str, target: str) -> None:
    """Answers to statement requests: a reference for each month and priority of the orders.

    Urgent ones are ready at once, high ones at the second attempt; the others
    wait, ask for a new request, or fail for good.
    """
    orders = table(spark, folder, "orders")
    kind = F.substring("o_orderpriority", 1, 1)
    reference = F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("-"), kind)
    asked = orders.select(
        reference.alias("ibExecID"), kind.alias("kind"), F.col("o_orderkey").alias("tradeID"),
        tagged("U", "o_custkey").alias("accountId"), tagged("S", "o_custkey").alias("symbol"),
        F.col("o_orderdate").cast("date").alias("tradeDate"),
    )
    ready = asked.where(F.col("kind").isin("1", "2"))
    attempt = F.when(F.col("ibExecID").endswith("1"), F.lit(".1")).otherwise(F.lit(".2"))
    write_statements(ready.drop("kind"), "Trade", F.concat("ibExecID", attempt), f"{target}/statements")
    codes = F.create_map(*[F.lit(x) for pair in {"2": "1018", "3": "1019", "4": "1009", "5": "1012"}.items() for x in pair])
    waits = asked.select("ibExecID", "kind").distinct().where("kind <> '1'").select(
        "ibExecID", codes[F.col("kind")].alias("code"),
        F.explode(F.when(F.col("kind") == "3", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("attempt"),
    )
    answer = F.concat(
        F.lit("<FlexStatementResponse><Status>Fail</Status><ErrorCode>"), "code", F.lit("</ErrorCode></FlexStatementResponse>")
    )
    (
        waits.select(F.concat("ibExecID", F.lit("."), F.col("attempt").cast("string")).alias("file"), answer.alias("value"))
        .repartition("file")
        .write.partitionBy("file")
        .text(f"{target}/answers")
    )


def write_bars(bars: DataFrame, folder: str) -> None:
    """Bar files in two makes: times under `Datetime`, and under `Date` with the columns turned round."""
    even = F.pmod(F.xxhash64("symbol"), F.lit(2)) == 0
    bars.where(even).write.option("header", True).csv(f"{folder}/intraday")
    turned = bars.where(~even).withColumnRenamed("Datetime", "Date")
    turned.select(*reversed(turned.columns)).write.option("header", True).csv(f"{folder}/daily")
