"""Fixed values of the ingest: curated symbols, fallbacks and sample positions."""

from __future__ import annotations

# Symbols whose fundamentals are refreshed in daily mode, in order.
DAILY_SYMBOLS = (
    "AAPL", "MSFT", "NVDA", "GOOGL", "GOOG", "AMZN", "META", "TSLA", "BRK-B", "LLY", "JPM", "V", "XOM", "UNH", "MA",
    "AVGO", "JNJ", "PG", "HD", "COST", "ORCL", "ABBV", "MRK", "CVX", "KO", "ADBE", "PEP", "WMT", "BAC", "CRM",
    "NFLX", "AMD", "TMO", "MCD", "CSCO", "ACN", "ABT", "LIN", "DHR", "WFC", "TXN", "DIS", "INTC", "VZ", "PM",
    "INTU", "IBM", "QCOM", "CAT", "GE",
)

# Symbols listed on the second exchange; all others are on the first.
SECOND_EXCHANGE_SYMBOLS = (
    "AAPL", "MSFT", "NVDA", "GOOGL", "GOOG", "AMZN", "META", "TSLA", "AVGO", "COST", "PEP", "CSCO", "ADBE", "NFLX",
    "AMD", "INTC", "QCOM", "TXN", "INTU", "AMGN", "HON", "SBUX", "GILD", "MU", "ADP", "ISRG", "BKNG", "REGN", "VRTX",
    "PYPL", "MDLZ", "ADI", "PANW", "KLAC", "SNPS", "CDNS", "MRVL", "ORLY", "CRWD", "ABNB", "FTNT", "ADSK", "NXPI",
    "MCHP", "IDXX",
)

# Exchanges as (exchange_id, exchange_name, country, timezone).
EXCHANGES = (
    (1, "New York Stock Exchange", "US", "America/New_York"),
    (2, "NASDAQ", "US", "America/New_York"),
    (3, "Chicago Board Options Exchange", "US", "America/Chicago"),
)

# Funds as (symbol, fallback name, fallback expense ratio).
FUNDS = (
    ("SPY", "SPDR S&P 500 ETF Trust", 0.0945),
    ("QQQ", "Invesco QQQ Trust", 0.2),
    ("IWM", "iShares Russell 2000 ETF", 0.19),
    ("VTI", "Vanguard Total Stock Market ETF", 0.03),
    ("XLK", "Technology Select Sector SPDR Fund", 0.09),
)

# Options as (underlying, expiration, strike, type, fallback iv, fallback open interest).
OPTIONS = (
    ("AAPL", "2025-04-18", 200.0, "call", 0.285, 45230),
    ("AAPL", "2025-04-18", 200.0, "put", 0.291, 32100),
    ("MSFT", "2025-04-18", 400.0, "call", 0.265, 28400),
    ("TSLA", "2025-04-18", 250.0, "call", 0.52, 19800),
    ("SPY", "2025-04-18", 550.0, "put", 0.182, 61200),
)

# Sample portfolios as (portfolio_id, portfolio_name, owner_name).
PORTFOLIOS = (
    (1, "Growth Portfolio", "Alice Chen"),
    (2, "Value Portfolio", "Bob Martinez"),
    (3, "Tech Focus", "Charlie Kim"),
    (4, "Dividend Income", "Diana Patel"),
    (5, "Balanced Fund", "Ethan Brooks"),
)

# Sample holdings as (portfolio_id, ticker, shares, average cost).
HOLDINGS = (
    (1, "AAPL", 100, 178.5), (1, "NVDA", 50, 480.25), (1, "AMZN", 30, 185.0), (1, "TSLA", 40, 245.8),
    (1, "NFLX", 25, 620.0),
    (2, "JNJ", 80, 155.2), (2, "JPM", 60, 195.0), (2, "KO", 200, 58.5), (2, "PG", 90, 165.4),
    (3, "MSFT", 70, 380.0), (3, "NVDA", 40, 490.0), (3, "AMD", 120, 155.6), (3, "AVGO", 30, 170.0),
    (3, "QQQ", 100, 480.5),
    (4, "XOM", 150, 105.3), (4, "KO", 300, 57.9), (4, "PG", 120, 162.0), (4, "MCD", 50, 290.0), (4, "VTI", 200, 250.0),
    (5, "AAPL", 50, 180.0), (5, "JPM", 40, 200.0), (5, "SPY", 150, 540.0), (5, "XLK", 80, 200.0),
)

FIRST_EXCHANGE = 1
SECOND_EXCHANGE = 2
OPTION_EXCHANGE = 3
TICKER_CHARS = 20
