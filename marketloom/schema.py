"""The thirteen relations as data: columns, keys, references and value rules.

Everything that needs to know the shape of a table (readers, writers, the
data-quality jobs, the DDL helpers) reads it from here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
TEXT = T.StringType()
DATE = T.DateType()


def DEC(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


@dataclass(frozen=True)
class Col:
    name: str
    type: T.DataType
    required: bool = False
    max_chars: int | None = None
    default: object = None
    allowed: tuple[str, ...] | None = None
    minimum: int | None = None
    exclusive: bool = False


@dataclass(frozen=True)
class Ref:
    """``column`` points at the primary key of ``parent``."""

    column: str
    parent: str
    on_delete: str


@dataclass(frozen=True)
class Table:
    name: str
    key: tuple[str, ...]
    cols: tuple[Col, ...]
    refs: tuple[Ref, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    dependencies: tuple[tuple[tuple[str, ...], tuple[str, ...]], ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [c.name for c in self.cols]

    @property
    def struct(self) -> T.StructType:
        """Read schema. Columns stay nullable: absence is reported by a quality job."""
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.cols])


def _text(name, chars, required=True, **kw):
    return Col(name, TEXT, required=required, max_chars=chars, **kw)


# The closed value sets, defaults and limits of the data model.
SECURITY_TYPES = ("stock", "etf", "option")
OPTION_TYPES = ("call", "put")
ACTION_TYPES = ("dividend", "split", "reverse_split", "spinoff")
DEFAULT_COUNTRY = "US"
DEFAULT_CURRENCY = "USD"

# Parents come before children, so this is also the load order.
_TABLES = (
    Table("Sector", ("sector_id",), (
        Col("sector_id", LONG, required=True),
        _text("sector_name", 100),
    ), unique=(("sector_name",),)),
    Table("Industry", ("industry_id",), (
        Col("industry_id", LONG, required=True),
        _text("industry_name", 100),
        Col("sector_id", LONG, required=True),
    ), refs=(Ref("sector_id", "Sector", "restrict"),)),
    Table("Company", ("company_id",), (
        Col("company_id", LONG, required=True),
        _text("company_name", 200),
        Col("industry_id", LONG, required=True),
        _text("country", 100, default=DEFAULT_COUNTRY),
    ), refs=(Ref("industry_id", "Industry", "restrict"),)),
    Table("Exchange", ("exchange_id",), (
        Col("exchange_id", LONG, required=True),
        _text("exchange_name", 100),
        _text("country", 100),
        _text("timezone", 50),
    )),
    Table("Security", ("security_id",), (
        Col("security_id", LONG, required=True),
        _text("ticker", 20),
        Col("exchange_id", LONG, required=True),
        _text("currency", 10, default=DEFAULT_CURRENCY),
        Col("security_type", TEXT, required=True, allowed=SECURITY_TYPES),
    ), refs=(Ref("exchange_id", "Exchange", "restrict"),),
        unique=(("ticker", "exchange_id"),),
        dependencies=((("ticker", "exchange_id"), ("security_id", "currency", "security_type")),)),
    Table("Stock", ("security_id",), (
        Col("security_id", LONG, required=True),
        Col("company_id", LONG, required=True),
    ), refs=(Ref("security_id", "Security", "cascade"), Ref("company_id", "Company", "restrict"))),
    Table("ETF", ("security_id",), (
        Col("security_id", LONG, required=True),
        _text("fund_name", 200),
        Col("expense_ratio", DEC(6, 4), minimum=0),
    ), refs=(Ref("security_id", "Security", "cascade"),)),
    Table("Option_Contract", ("option_id",), (
        Col("option_id", LONG, required=True),
        Col("security_id", LONG, required=True),
        Col("expiration_date", DATE, required=True),
        Col("strike_price", DEC(12, 2), required=True, minimum=0, exclusive=True),
        Col("option_type", TEXT, required=True, allowed=OPTION_TYPES),
        Col("implied_volatility", DEC(8, 4)),
        Col("open_interest", INT, default=0, minimum=0),
    ), refs=(Ref("security_id", "Security", "cascade"),),
        unique=(("security_id", "expiration_date", "strike_price", "option_type"),),
        dependencies=((("security_id", "expiration_date", "strike_price", "option_type"),
                       ("implied_volatility", "open_interest")),)),
    Table("Portfolio", ("portfolio_id",), (
        Col("portfolio_id", LONG, required=True),
        _text("portfolio_name", 100),
        _text("owner_name", 100),
    )),
    Table("Holding", ("portfolio_id", "security_id"), (
        Col("portfolio_id", LONG, required=True),
        Col("security_id", LONG, required=True),
        Col("shares", DEC(14, 4), required=True, minimum=0, exclusive=True),
        Col("average_cost", DEC(12, 4), required=True, minimum=0),
    ), refs=(Ref("portfolio_id", "Portfolio", "cascade"), Ref("security_id", "Security", "cascade"))),
    Table("Price", ("security_id", "trade_date"), (
        Col("security_id", LONG, required=True),
        Col("trade_date", DATE, required=True),
        Col("open", DEC(12, 4)),
        Col("high", DEC(12, 4)),
        Col("low", DEC(12, 4)),
        Col("close", DEC(12, 4), required=True),
        Col("volume", LONG, default=0, minimum=0),
    ), refs=(Ref("security_id", "Security", "cascade"),)),
    Table("Financial_Snapshot", ("snapshot_id",), (
        Col("snapshot_id", LONG, required=True),
        Col("security_id", LONG, required=True),
        Col("snapshot_date", DATE, required=True),
        Col("market_cap", LONG),
        Col("pe_ratio", DEC(10, 2)),
        Col("eps", DEC(10, 4)),
        Col("beta", DEC(6, 4)),
    ), refs=(Ref("security_id", "Security", "cascade"),),
        unique=(("security_id", "snapshot_date"),),
        dependencies=((("security_id", "snapshot_date"),
                       ("snapshot_id", "market_cap", "pe_ratio", "eps", "beta")),)),
    Table("Corporate_Action", ("action_id",), (
        Col("action_id", LONG, required=True),
        Col("security_id", LONG, required=True),
        Col("action_date", DATE, required=True),
        Col("action_type", TEXT, required=True, allowed=ACTION_TYPES),
        Col("amount", DEC(14, 6)),
    ), refs=(Ref("security_id", "Security", "cascade"),)),
)

TABLES: dict[str, Table] = {t.name: t for t in _TABLES}
LOAD_ORDER: list[str] = list(TABLES)
DROP_ORDER: list[str] = LOAD_ORDER[::-1]


def dependencies(table: Table):
    """Every functional dependency of a table: the key's own and the listed ones."""
    rest = tuple(c for c in table.columns if c not in table.key)
    if rest:
        yield table.key, rest
    yield from table.dependencies


def children(parent: str):
    """(table, reference) pairs that point at ``parent``."""
    for table in _TABLES:
        for ref in table.refs:
            if ref.parent == parent:
                yield table, ref
