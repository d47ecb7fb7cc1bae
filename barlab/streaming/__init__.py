"""Structured Streaming: incremental bar building, returns and streaks."""

from barlab.streaming.bars import stream_bars, write_bars_stream
from barlab.streaming.series import final_bars, late_ticks, stream_series

__all__ = ["final_bars", "late_ticks", "stream_bars", "stream_series", "write_bars_stream"]
