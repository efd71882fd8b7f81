from .files import write_csv, write_parquet

__all__ = ["write_csv", "write_parquet"]
