"""Captured change feed to messages."""

from pyspark.sql import DataFrame

from ..operators import decode_sse, encode_messages, normalise_recentchange


def change_messages(blocks: DataFrame) -> DataFrame:
    """Event text blocks to keyed JSON messages, one per well-formed change."""
    return encode_messages(normalise_recentchange(decode_sse(blocks)))
