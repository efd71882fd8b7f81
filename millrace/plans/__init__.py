from .edits import article_edit_counts, page_edit_counts
from .feed import change_messages
from .reports import ratings_report

__all__ = ["article_edit_counts", "change_messages", "page_edit_counts", "ratings_report"]
