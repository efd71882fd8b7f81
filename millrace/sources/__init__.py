from .files import (
    read_csv_inferred, read_delimited, read_json, read_sse, read_stream_output, stream_parquet,
)
from .params import job_param

__all__ = ["job_param", "read_csv_inferred", "read_delimited", "read_json", "read_sse",
           "read_stream_output", "stream_parquet"]
