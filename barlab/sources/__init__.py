"""Bar sources and sinks."""

from barlab.sources.bars import (
    bars_from_events,
    bars_from_orders,
    bars_from_ticks,
    filter_bars,
    load_bars,
    normalize_bars,
    union_bars,
    write_bars,
)
from barlab.sources.table import bars_table, save_bars_table
from barlab.sources.zones import Zones, open_zones, save_zones

__all__ = [
    "Zones",
    "open_zones",
    "save_zones",
    "bars_table",
    "save_bars_table",
    "bars_from_events",
    "bars_from_orders",
    "bars_from_ticks",
    "filter_bars",
    "load_bars",
    "normalize_bars",
    "union_bars",
    "write_bars",
]
