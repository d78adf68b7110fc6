"""Costly columns that are computed once per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters use as finished values.

    The optimizer pushes a filter below a projection by putting the projected
    expressions into it, so filtering on a parsed field would parse each line
    once more for every mention. It does not push filters into a generator, so
    the columns come as the one row of an ``inline``.
    """
    fields = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.select("*", F.inline(F.array(fields)))
