"""Fixed values of the collection job.

These are the values the original collection job is configured with; they are
kept verbatim because results depend on them (match keywords, expiry flags and
codes, strike steps, start dates, the requested stock list). Strike-bucket
labels are built from their rule (``ATM``, ``ATM+1..10``, ``ATM-1..10``).
"""

from __future__ import annotations

from datetime import date

# ---- fixed values (must equal the original job's) -------------------------

# IST is a fixed +05:30 offset, not a tz-database zone.
IST_OFFSET_SECONDS = 5 * 3600 + 30 * 60
IST_SUFFIX = "+05:30"

SPOT_START_DATE = date(2021, 1, 1)
OPTIONS_START_DATE = date(2025, 1, 1)
STOCKS_START_DATE = date(2023, 1, 1)

CANDLE_WINDOW_DAYS = 90
OPTION_WINDOW_DAYS = 30

INDEX_EXCHANGE_SEGMENT = "IDX_I"
INDEX_INSTRUMENT_TYPE = "INDEX"
NSE_EQ = "NSE_EQ"
EQUITY = "EQUITY"
NSE_FNO = "NSE_FNO"
BSE_FNO = "BSE_FNO"
OPTIDX = "OPTIDX"

EXPIRY_FLAGS = ["WEEK", "MONTH"]
EXPIRY_CODES = [1, 2, 3]
OPTION_SIDES = [("CALL", "CE"), ("PUT", "PE")]
STRIKE_STEPS = {"NIFTY": 50, "SENSEX": 100}

# name -> (preferred keywords, fallback keywords, exclude keywords, preferred exchange)
INDEX_MATCH_RULES = {
    "NIFTY_50": (["NIFTY 50"], ["NIFTY"], ["BANK", "FIN", "MIDCAP", "NEXT 50", "IT"], "NSE"),
    "SENSEX": (["S&P BSE SENSEX", "SENSEX"], [], ["MIDCAP", "SMALLCAP"], "BSE"),
}

# Spot indices: name, short name used in reports.
SPOT_INDICES = [("NIFTY_50", "nifty"), ("SENSEX", "sensex")]
# Option underlyings: name, index rule name, exchange segment.
OPTION_UNDERLYINGS = [("NIFTY", "NIFTY_50", NSE_FNO), ("SENSEX", "SENSEX", BSE_FNO)]

# Error codes that mean "no data for this request" when the message says so.
NO_DATA_ERROR_CODES = ["DH-905", "DH-907"]
NO_DATA_TEXT = "no data"

STOCK_SYMBOLS = [
    "ABB", "ADANIENT", "ADANIENSOL", "ADANIGREEN", "ADANIPORTS", "ADANIPOWER",
    "AMBUJACEM", "APOLLOHOSP", "ASIANPAINT", "ATGL", "AXISBANK", "BAJAJ-AUTO",
    "BAJAJFINSV", "BAJAJHLDNG", "BAJFINANCE", "BANKBARODA", "BEL", "BHARTIARTL",
    "BHEL", "BOSCHLTD", "BPCL", "BRITANNIA", "CANBK", "CHOLAFIN", "CIPLA",
    "COALINDIA", "DABUR", "DIVISLAB", "DLF", "DMART", "DRREDDY", "EICHERMOT",
    "GAIL", "GODREJCP", "GRASIM", "HAL", "HAVELLS", "HCLTECH", "HDFCBANK",
    "HDFCLIFE", "HEROMOTOCO", "HINDALCO", "HINDUNILVR", "ICICIBANK", "ICICIGI",
    "ICICIPRULI", "INDHOTEL", "INDIGO", "INDUSINDBK", "INFY", "IOC", "IRCTC",
    "IRFC", "ITC", "JINDALSTEL", "JIOFIN", "JSWENERGY", "JSWSTEEL", "KOTAKBANK",
    "LT", "LICI", "LODHA", "LTIM", "LUPIN", "M&M", "MARICO", "MARUTI",
    "MOTHERSON", "NAUKRI", "NESTLEIND", "NHPC", "NTPC", "ONGC", "PAGEIND", "PFC",
    "PIDILITIND", "PNB", "POWERGRID", "RECLTD", "RELIANCE", "SAIL", "SBICARD",
    "SBILIFE", "SBIN", "SHREECEM", "SHRIRAMFIN", "SIEMENS", "SUNPHARMA",
    "TATACONSUM", "TMCV", "TMPV", "TATAPOWER", "TATASTEEL", "TCS", "TECHM",
    "TITAN", "TORNTPHARM", "TRENT", "TVSMOTOR", "ULTRACEMCO", "UNIONBANK",
    "UNITDSPR", "VEDL", "VBL", "WIPRO", "ETERNAL", "ZYDUSLIFE",
]

# ---- end of fixed values ---------------------------------------------------


def strike_buckets(max_offset: int = 10) -> list[str]:
    """Bucket labels in request order: ATM, ATM+1..+n, ATM-1..-n."""
    return (["ATM"] + [f"ATM+{i}" for i in range(1, max_offset + 1)]
            + [f"ATM-{i}" for i in range(1, max_offset + 1)])


STRIKE_BUCKETS = strike_buckets()
