"""The one table every operator reads: daily price bars of many tickers.

Key ``(ticker, date)``: bars built from ticks have it by construction,
``load_bars`` checks it unless told to trust the source. Because there is at most
one bar per ticker and calendar day, the rows of one ticker are bounded by the number of
days it covers (about 250 a year for a trading calendar, 366 at most).  Every
ordered window in this package is partitioned by ``ticker``, so no window
task ever holds more than one ticker's daily history, whatever the total
size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

PRICE_COLUMNS = ("open", "high", "low", "close", "adj_close", "volume")
KEY_COLUMNS = ("ticker", "date")
BAR_COLUMNS = KEY_COLUMNS + PRICE_COLUMNS

BARS = StructType(
    [StructField("ticker", StringType(), True), StructField("date", DateType(), True)]
    + [StructField(c, DoubleType(), True) for c in PRICE_COLUMNS]
)

# The column labels of the daily-history layout the analyses were
# written for, mapped to our lower snake case names.
SOURCE_NAMES = {
    "Ticker": "ticker",
    "Date": "date",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
}

# What CSV and JSON sources are read with: those labels, dates as text or dates.
DAILY_HISTORY = StructType(
    [StructField("Ticker", StringType()), StructField("Date", StringType())]
    + [StructField(label, DoubleType()) for label, name in SOURCE_NAMES.items() if name in PRICE_COLUMNS]
)


def numeric_columns(df) -> list[str]:
    """The double-typed columns of ``df``, read from its schema (no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]


def nan_to_null(c: Column) -> Column:
    """NaN becomes NULL once, at load time; later operators only meet NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))
