"""barlab — Spark-native analytics over daily price bars of many tickers.

Every analysis is a ``DataFrame -> DataFrame`` function over one long
``bars`` table (key ``ticker, date``), usable with ``df.transform``.  No
operator builds a session or collects to the driver.
"""

from barlab.schema import BAR_COLUMNS, BARS, PRICE_COLUMNS

__all__ = ["BARS", "BAR_COLUMNS", "PRICE_COLUMNS"]
