"""Edit counts from JSON messages, for a batch of messages or a stream of them."""

from pyspark.sql import DataFrame

from ..operators import (
    human_article_edits, parse_json_events, windowed_counts, windowed_edit_counts,
)
from ..schemas import CHANGE, EDIT


def page_edit_counts(messages: DataFrame, width: str = "1 minute",
                     delay: str = "2 minutes") -> DataFrame:
    """Simulated edits: ``window, page_title, count``."""
    edits = parse_json_events(messages, EDIT, ["page_title", "event_time"], require_time=True)
    return windowed_counts(edits, "page_title", width=width, delay=delay)


def article_edit_counts(messages: DataFrame, width: str = "2 minutes",
                        delay: str = "10 minutes") -> DataFrame:
    """Change events: counts of human edits to articles per window and page.

    The filter comes before the watermark, so events that are not counted do not close windows.
    """
    used = ["event_type", "page_title", "event_time", "namespace", "bot", "minor"]
    changes = parse_json_events(messages, CHANGE, used)
    return windowed_edit_counts(human_article_edits(changes), width=width, delay=delay)
