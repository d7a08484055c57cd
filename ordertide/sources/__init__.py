"""File sources: fixed-width, delimited, XML, JSON (static and streaming)."""

from ordertide.sources.files import (  # noqa: F401
    file_inventory,
    preview,
    read_delimited,
    read_fixed_width,
    read_orders_json,
    read_products_xml,
    stream_orders_json,
)
