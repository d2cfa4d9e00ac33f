"""Joins on keys that may be missing or lopsided."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

# How many ways rows without a key are spread. They match nothing, so where they go is free.
NULL_SPREAD = 256


def left_lookup(rows: DataFrame, table: DataFrame, on, spread_by=None) -> DataFrame:
    """Left join on one key, where the key of `rows` may be null on any share of them.

    Null keys would all hash to one task; they are sent to `NULL_SPREAD` keys of their own
    instead, by a hash of `spread_by` (by default all plain columns), so a retried task sends
    them to the same place. No broadcast is asked for: Spark broadcasts `table` when its measured
    size is under the session's threshold, and otherwise shuffles, splitting skewed keys under
    AQE.
    """
    if spread_by is None:
        spread_by = [f.name for f in rows.schema.fields if isinstance(f.dataType, AtomicType)]
    place = F.pmod(F.xxhash64(*spread_by), F.lit(NULL_SPREAD)).cast("string")
    key = F.coalesce(F.col(on).cast("string"), F.concat(F.lit("\u0000"), place))
    other = table.withColumn("_on", F.col(on).cast("string")).drop(on)
    return rows.withColumn("_on", key).join(other, "_on", "left").drop("_on")
