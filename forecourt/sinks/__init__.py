from forecourt.sinks.publish import (
    blank_fill, publish_margin, publish_snapshot, publish_table, publish_text, published_table, trailing_window,
)

__all__ = ["blank_fill", "publish_margin", "publish_snapshot", "publish_table", "publish_text", "published_table",
           "trailing_window"]
