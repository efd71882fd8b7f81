"""Column expressions for JSON messages."""

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType


def json_record(text: Column, schema: StructType) -> Column:
    """Generator that turns JSON text into one row of top-level columns.

    ``select(from_json(..).alias("d")).select("d.*")`` reads the same, but a filter on its result is
    pushed below the projection and each tested field then parses the text once more.  Nothing is
    pushed through a generator, so here the text is parsed exactly once.
    """
    return F.inline(F.array(F.from_json(text, schema)))


def iso_timestamp(text: Column) -> Column:
    """ISO text to timestamp; NULL for text that is none, under ANSI mode as well."""
    return F.try_to_timestamp(text)


def defaulted(value: Column, keys: Column, key: str, default) -> Column:
    """``value``, or ``default`` where ``key`` is missing; an explicit JSON null stays NULL.

    NULL ``keys`` stand for none that is NULL.
    """
    missing = ~F.coalesce(F.array_contains(keys, key), F.lit(False))
    return F.coalesce(value, F.when(missing, F.lit(default)))
