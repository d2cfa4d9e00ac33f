"""Windows of a result: pages in a fixed total order, and the newest first."""

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.operators.filters import QueryError
from metaloom.session import shared_folder

TOTAL_ORDER = ["uri", "context_id", "entry_id"]


def check_window(limit, offset):
    """A window is two counts; only the limit may be left open."""
    for name, count in (("limit", limit), ("offset", offset)):
        if count is None and name == "limit":
            continue
        if type(count) is not int or count < 0:
            raise QueryError(f"{name} is a count of records, not {count!r}")


def page(matches: DataFrame, limit=None, offset=0, order=TOTAL_ORDER) -> DataFrame:
    """Matches from `offset`, at most `limit`, in an order without ties.

    A deep offset is counted through by one task; `Pages` and `page_after` have no such cost.
    """
    check_window(limit, offset)
    ordered = matches.orderBy(*order)
    ordered = ordered.offset(offset) if offset else ordered
    return ordered if limit is None else ordered.limit(limit)


class Pages:
    """A result written once in its order, as files of consecutive ranges; a page opens only the files it lies in."""

    def __init__(self, matches: DataFrame, order=TOTAL_ORDER, file_rows=100_000):
        self.spark, self.order, self.schema = matches.sparkSession, list(order), matches.schema
        path = f"{shared_folder(self.spark)}/pages-{uuid.uuid4().hex}"
        matches.orderBy(*self.order).write.option("maxRecordsPerFile", file_rows).parquet(path)
        # One row per file, off the footers; the numbers in their names, of the task and its file, follow the ranges.
        held = self._read(path).groupBy(F.col("_metadata.file_path").alias("file")).count().collect()
        self.files = sorted((tuple(r) for r in held), key=lambda f: [int(n) for n in re.search(r"part-(\d+)-.*-c(\d+)\.[^/]*$", f[0]).groups()])
        self.total = sum(n for _, n in held)

    def _read(self, *paths):
        return self.spark.read.schema(self.schema).parquet(*paths)

    def page(self, limit=None, offset=0) -> DataFrame:
        check_window(limit, offset)
        end, before, opened, skipped = self.total if limit is None else offset + limit, 0, [], 0
        for file, n in self.files:
            if before + n > offset and before < end:
                skipped = skipped if opened else offset - before
                opened.append(file)
            before += n
        if not opened:
            return self.spark.createDataFrame([], self.schema)
        rows = self._read(*opened).orderBy(*self.order).offset(skipped)
        return rows if limit is None else rows.limit(limit)


def page_after(matches: DataFrame, last, limit, order=TOTAL_ORDER) -> DataFrame:
    """The `limit` matches that follow the row whose `order` columns are `last` (None: from the start).

    The place is a filter, so what lies before it is never sorted or held.
    """
    check_window(limit, 0)
    if last is not None:
        later = F.lit(False)
        for i, column in enumerate(order):
            same = F.lit(True)
            for c, v in list(zip(order, last))[:i]:
                same = same & (F.col(c) == F.lit(v))
            later = later | (same & (F.col(column) > F.lit(last[i])))
        matches = matches.filter(later)
    return matches.orderBy(*order).limit(limit)


def has_more(offset, returned, total):
    """Whether a page is followed by another; works on columns and numbers."""
    return offset + returned < total


def newest_first(records: DataFrame, *ties) -> DataFrame:
    """By `modified`, else `issued`, else nothing, newest first."""
    stamp = F.coalesce(F.when(F.col("modified") != "", F.col("modified")), "issued", F.lit(""))
    return records.orderBy(F.desc(stamp), *(ties or TOTAL_ORDER))
