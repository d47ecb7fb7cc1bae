"""Per-ticker results listed for a given set of tickers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def of_universe(universe: DataFrame | None, per_ticker: DataFrame) -> DataFrame:
    """``per_ticker`` (keyed by ``ticker``) left-joined onto the tickers of
    ``universe``, a small table the caller keeps; unchanged without one.  The
    bars are thus read once, with the selection's filters at the scan."""
    return per_ticker if universe is None else universe.select("ticker").distinct().join(per_ticker, "ticker", "left")
