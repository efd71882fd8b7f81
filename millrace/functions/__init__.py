from .messages import defaulted, iso_timestamp, json_record
from .text import WHITESPACE, sse_last, sse_lines, sse_values, strip

__all__ = ["WHITESPACE", "defaulted", "iso_timestamp", "json_record", "sse_last", "sse_lines",
           "sse_values", "strip"]
