"""Batch and streaming analytics as plain DataFrame-to-DataFrame functions on PySpark.

Transforms in ``operators`` and ``plans`` take and return DataFrames and start no job, so the
same function serves a batch table and a stream.  ``rank_within`` is the one exception: it stores
its ranked parts first.  ``sources``, ``sinks`` and ``streaming`` hold the edges.
"""

__version__ = "0.1.0"
