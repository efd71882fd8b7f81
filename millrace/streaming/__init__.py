from .batches import (
    batch_ledger, batch_writer, late_splitter, read_committed, stream_in_batches,
)
from .compaction import compact_output, read_compacted
from .sinks import (
    jdbc_batch_writer, kafka_sink, stream_sse, stream_to_console, stream_to_jdbc,
    stream_to_parquet,
)
from .sources import kafka_source, line_source
from .state import open_windows

__all__ = [
    "batch_ledger", "batch_writer", "compact_output", "jdbc_batch_writer", "kafka_sink",
    "kafka_source", "late_splitter", "line_source", "open_windows", "read_committed",
    "read_compacted", "stream_in_batches", "stream_sse", "stream_to_console", "stream_to_jdbc",
    "stream_to_parquet",
]
