"""What each statement source holds, as data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- Fixed values: statement formats, column names and their types -----------------

TRADE_COLUMNS = """
    accountId string, currency string, assetCategory string, symbol string, conid bigint,
    listingExchange string, tradeID bigint, transactionID string, ibExecID string,
    ibOrderID bigint, reportDate date, tradeDate date, dateTime timestamp_ntz,
    orderTime timestamp_ntz, transactionType string, exchange string, buySell string,
    openCloseIndicator string, quantity double, tradePrice double, tradeMoney double,
    proceeds double, taxes double, ibCommission double, ibCommissionCurrency string,
    netCash double, closePrice double, cost double, fifoPnlRealized double, mtmPnl double,
    orderType string, orderReference string, brokerageOrderID string, isAPIOrder boolean,
    description string, fxRateToBase double, subCategory string, multiplier double,
    settleDateTarget date
"""

CASH_COLUMNS = """
    accountId string, currency string, fxRateToBase double, assetCategory string,
    subCategory string, symbol string, description string, conid bigint, securityID string,
    securityIDType string, cusip string, isin string, figi string, listingExchange string,
    issuerCountryCode string, multiplier double, dateTime timestamp_ntz, settleDate date,
    availableForTradingDate date, reportDate date, amount double, type string,
    transactionID string, clientReference string, actionID string
"""

POSITION_COLUMNS = """
    accountId string, currency string, fxRateToBase double, assetCategory string,
    subCategory string, symbol string, description string, conid bigint, securityID string,
    securityIDType string, cusip string, isin string, listingExchange string,
    multiplier double, reportDate date, position double, markPrice double,
    positionValue double, openPrice double, costBasisPrice double, costBasisMoney double,
    percentOfNAV double, fifoPnlUnrealized double, side string
"""

NAV_COLUMNS = """
    accountId string, currency string, reportDate date, cash double, stock double,
    options double, funds double, dividendAccruals double, interestAccruals double,
    forexCfdUnrealizedPl double, cfdUnrealizedPl double, crypto double, total double,
    totalLong double, totalShort double
"""

CORPORATE_ACTION_COLUMNS = """
    accountId string, model string, currency string, fxRateToBase double,
    assetCategory string, subCategory string, symbol string, underlyingSymbol string,
    conid bigint, underlyingConid bigint, listingExchange string,
    underlyingListingExchange string, transactionID string, actionID bigint, type string,
    code string, reportDate date, dateTime timestamp_ntz, description string,
    actionDescription string, quantity double, amount double, proceeds double, value double,
    costBasis double, fifoPnlRealized double, mtmPnl double, securityID string,
    securityIDType string, cusip string, isin string, figi string,
    underlyingSecurityID string, issuer string, issuerCountryCode string, multiplier double,
    strike double, expiry date, putCall string, principalAdjustFactor double,
    levelOfDetail string, serialNumber string, deliveryType string, commodityType string,
    fineness double, weight double
"""

BAR_COLUMNS = """
    symbol string, reportDate date, open double, high double, low double, close double,
    adjClose double, volume double, source string
"""

TRADES_HISTORY = (
    "symbol currency assetCategory reportDate dateTime orderTime transactionType buySell "
    "openCloseIndicator quantity tradePrice tradeMoney proceeds taxes ibCommission "
    "ibCommissionCurrency netCash closePrice cost fifoPnlRealized mtmPnl orderType "
    "fxRateToBase subCategory multiplier settleDateTarget"
)
CASH_HISTORY = (
    "symbol currency fxRateToBase assetCategory subCategory description issuerCountryCode "
    "multiplier dateTime settleDate availableForTradingDate reportDate amount type"
)
POSITIONS_LATEST = (
    "currency fxRateToBase assetCategory subCategory symbol description multiplier reportDate "
    "position markPrice positionValue openPrice costBasisPrice costBasisMoney percentOfNAV "
    "fifoPnlUnrealized"
)
POSITIONS_HISTORY = (
    "symbol currency fxRateToBase assetCategory subCategory multiplier reportDate position "
    "markPrice positionValue openPrice costBasisPrice costBasisMoney percentOfNAV "
    "fifoPnlUnrealized"
)
NAV_MART = (
    "currency reportDate cash stock options funds dividendAccruals interestAccruals "
    "forexCfdUnrealizedPl cfdUnrealizedPl crypto total totalLong totalShort"
)
CORPORATE_ACTIONS_HISTORY = (
    "symbol currency assetCategory subCategory reportDate dateTime type code quantity amount "
    "proceeds value costBasis fifoPnlRealized mtmPnl securityIDType listingExchange "
    "description actionDescription"
)
BARS_HISTORY = "symbol reportDate open high low close adjClose volume source"

# --- End of fixed values -----------------------------------------------------------

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class Mart:
    """One published dataset of a source.

    ``shape`` is ``history`` (every row), ``latest`` (rows of the last report date)
    or ``sorted`` (every row, ordered by account and date).
    """

    dataset_id: str
    columns: tuple[str, ...]
    shape: str = "history"
    canonical: bool = False
    notes: str = ""


@dataclass(frozen=True)
class RegistryRule:
    """How a source introduces securities to the symbol registry."""

    category: str | None = None
    description: tuple[str, ...] = ("description",)


@dataclass(frozen=True)
class SourceSpec:
    """Declarative description of one source.

    ``upsert`` is ``hash`` (replace records of equal content), ``dates`` (replace whole
    report dates) or ``key`` (replace by ``key``).  ``backfill`` is the mode for history
    folders where it differs.
    """

    name: str
    element: str | None
    ddl: str
    required: tuple[str, ...]
    upsert: str
    date: str = "reportDate"
    progress_date: str = "reportDate"
    hash: str | None = "sourceHashHex"
    key: tuple[str, ...] = ()
    backfill: str | None = None
    detail_attribute: str | None = None
    registry: RegistryRule | None = None
    resolves_symbols: bool = True
    marts: tuple[Mart, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> T.StructType:
        pairs = (column.split() for column in self.ddl.split(","))
        return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])

    @property
    def schema(self) -> T.StructType:
        columns = self.columns
        return columns.add(self.hash, T.StringType()) if self.hash else columns


TRADES = SourceSpec(
    name="trades",
    element="Trade",
    ddl=TRADE_COLUMNS,
    required=("accountId", "symbol", "tradeDate"),
    upsert="hash",
    date="tradeDate",
    progress_date="tradeDate",
    registry=RegistryRule(category="STK"),
    marts=(
        Mart(
            "trades_history",
            tuple(TRADES_HISTORY.split()),
            canonical=True,
            notes="Trades history",
        ),
    ),
)

CORPORATE_ACTIONS = SourceSpec(
    name="corporate_actions",
    element="CorporateAction",
    ddl=CORPORATE_ACTION_COLUMNS,
    required=("accountId", "symbol", "reportDate"),
    upsert="hash",
    registry=RegistryRule(category="STK", description=("actionDescription", "description")),
    marts=(
        Mart(
            "corporate_actions_history",
            tuple(CORPORATE_ACTIONS_HISTORY.split()),
            canonical=True,
            notes="Corporate actions history",
        ),
    ),
)

POSITIONS = SourceSpec(
    name="positions",
    element="OpenPosition",
    ddl=POSITION_COLUMNS,
    required=("accountId", "symbol"),
    upsert="dates",
    backfill="hash",
    hash="sourceHash",
    registry=RegistryRule(),
    marts=(
        Mart(
            "positions_latest",
            tuple(POSITIONS_LATEST.split()),
            shape="latest",
            notes="Latest positions snapshot",
        ),
        Mart(
            "positions_history",
            tuple(POSITIONS_HISTORY.split()),
            canonical=True,
            notes="Positions history",
        ),
    ),
)

CASH_TRANSACTIONS = SourceSpec(
    name="cash_transactions",
    element="CashTransaction",
    ddl=CASH_COLUMNS,
    required=("accountId", "currency", "reportDate"),
    upsert="hash",
    detail_attribute="levelOfDetail",
    registry=RegistryRule(),
    marts=(
        Mart(
            "cash_transactions_history",
            tuple(CASH_HISTORY.split()),
            canonical=True,
            notes="Cash transactions history",
        ),
    ),
)

ACCOUNT_NAV = SourceSpec(
    name="account_nav",
    element="EquitySummaryByReportDateInBase",
    ddl=NAV_COLUMNS,
    required=("accountId", "reportDate"),
    upsert="key",
    key=("accountId", "reportDate"),
    hash="sourceHash",
    marts=(
        Mart(
            "account_nav_latest",
            tuple(NAV_MART.split()),
            shape="latest",
            notes="Latest account NAV snapshot",
        ),
        Mart(
            "account_nav_history",
            tuple(NAV_MART.split()),
            shape="sorted",
            notes="Account NAV history",
        ),
    ),
)

TICKERS_DAILY = SourceSpec(
    name="tickers_daily",
    element=None,
    ddl=BAR_COLUMNS,
    required=("symbol", "reportDate", "source"),
    upsert="key",
    key=("symbol", "source", "reportDate"),
    hash=None,
    resolves_symbols=False,
    marts=(
        Mart("tickers_daily_history", tuple(BARS_HISTORY.split()), notes="Daily market data history"),
    ),
)

# Registry and marts follow this order.
SOURCES = (
    TRADES,
    CORPORATE_ACTIONS,
    POSITIONS,
    CASH_TRANSACTIONS,
    ACCOUNT_NAV,
    TICKERS_DAILY,
)
