from .changes import decode_sse, normalise_recentchange
from .events import encode_messages, human_article_edits, parse_json_events
from .nested import lift_nested_field
from .ranking import rank_within
from .ratings import count_by, enrich_with_title, global_average, rated_items, top_rated
from .text import words
from .windows import flatten_window, windowed_counts, windowed_edit_counts

__all__ = [
    "count_by", "decode_sse", "encode_messages", "enrich_with_title", "flatten_window",
    "global_average", "human_article_edits", "lift_nested_field", "normalise_recentchange",
    "parse_json_events", "rank_within", "rated_items", "top_rated", "windowed_counts",
    "windowed_edit_counts", "words",
]
