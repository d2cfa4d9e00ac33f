"""Continuous upserts: arriving files into the store, whatever order they arrive in.

Neither needs a watermark: a late row loses by comparison with what is held. A batch adds its own rows as
one delta and rewrites nothing; its number is published in the same pointer, so a batch that is run again
after a lost driver is left out.
"""

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.operators.links import latest_per_url
from metaloom.session import cut_lineage
from metaloom.sources import files
from metaloom.sources.store import Store, latest_per_key


def _started(stream: DataFrame, write, checkpoint, trigger):
    """`write(batch, (stream's id, batch number))` for every batch. The id is the checkpoint's own, so a
    stream begun anew elsewhere is another one."""
    spark = stream.sparkSession

    def numbered(batch, number):
        write(batch, (json.loads(files.read_text(spark, f"{checkpoint}/metadata"))["id"], number))

    return (stream.writeStream.foreachBatch(numbered).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def upsert_records(stream: DataFrame, store: Store, checkpoint, now, **trigger):
    """Starts a query that keeps the newest record of every key; a tie goes to the later arrival."""
    def write(batch, number):
        newest = cut_lineage(latest_per_key(batch))
        store.upsert(newest, now() if callable(now) else now, only_newer=True, batch=number)

    return _started(stream, write, checkpoint, trigger)


def verdicts_of_checks(checks: DataFrame) -> DataFrame:
    """The latest check of each URL in the shape the store keeps."""
    latest = latest_per_url(checks)
    return latest.select(F.col("uri").alias("url"), "status", F.col("statusMessage").alias("reason"),
                         F.col("checkedAt").alias("checked"), F.lit(False).alias("invalid_cert"))


def upsert_checks(stream: DataFrame, store: Store, checkpoint, table="link_checks", **trigger):
    """Starts a query that keeps the latest check of every URL; a tie goes to the later arrival."""
    def write(batch, number):
        store.upsert_table(table, cut_lineage(verdicts_of_checks(batch)), "url", latest="checked", batch=number)

    return _started(stream, write, checkpoint, trigger)
