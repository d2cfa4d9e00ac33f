"""Columns that are computed once and then only read."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, **columns) -> DataFrame:
    """Adds or replaces columns behind a generator of one row.

    The optimizer moves filters and later columns through plain projections by writing an
    expression out wherever its column is named, which multiplies a parsed graph or a chosen
    subject into every property read off it. It does not look through a generator, which itself
    is a narrow step inside the same stage.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
