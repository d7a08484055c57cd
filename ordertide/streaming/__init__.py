"""Structured Streaming ingest of order documents."""

from ordertide.streaming.orders import (  # noqa: F401
    OrderStream,
    explode_line_items,
    flatten_orders,
)
from ordertide.streaming.progress import ProgressLog, trigger_check  # noqa: F401
