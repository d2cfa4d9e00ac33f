"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Each source's target is its share by weight, at most `most` times what it has. The mix is cut into
blocks of equal length; blocks go to the sources by highest quotients target/1, /3, /5, ..., and each
source's blocks to its shards in the same way. Inside a shard the documents stand in a seeded order on
a ring of words; whole turns of the ring and one run of blocks from a seeded start are taken.
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metaloom.llm.common import WORD, stored, word_count

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 16
SHARD_ROWS = 50_000


def apportion(weights, seats):
    """Seats by highest quotients weight/(2k+1); ties go to the earlier place."""
    weights = np.asarray(weights, dtype=np.float64)
    got = np.zeros(len(weights), dtype=np.int64)
    if seats <= 0 or weights.sum() <= 0:
        return got
    low, high = 0.0, 2.0 * (seats + len(weights)) / weights.max()
    for _ in range(200):  # close to the largest multiplier that gives at most `seats`
        middle = (low + high) / 2
        if np.floor(weights * middle + 0.5).sum() <= seats:
            low = middle
        else:
            high = middle
    # A little below it, so that ties stay open; the few seats left go out one by one.
    got = np.floor(weights * low * (1 - 1e-9) + 0.5).astype(np.int64)
    queue = [(-q, i) for i, q in enumerate(weights / (2 * got + 1))]
    heapq.heapify(queue)
    for _ in range(seats - int(got.sum())):
        _, i = queue[0]
        got[i] += 1
        heapq.heapreplace(queue, (-weights[i] / (2 * got[i] + 1), i))
    return got


def _targets(sources: DataFrame, most) -> DataFrame:
    """Adds `target`: the share of the total by weight, stopped at `most` times the size, the excess shared out again.

    All sources that are not stopped have one multiple of their weight; each round adds up what is stopped
    and raises the multiple, until none is above its stop.
    """
    limit, total = F.col("source_size") * most, sources.agg(F.sum("source_size")).head()[0] or 0
    if not total:
        return sources.withColumn("target", F.lit(0.0))
    share, stopped = 0.0, -1
    while True:
        above = limit < F.col("weight") * share
        now, held, rest = sources.agg(F.count_if(above), F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))).head()
        if now == stopped or not rest:
            return sources.withColumn("target", F.when(above, limit.cast("double")).otherwise(F.col("weight") * share))
        share, stopped = float(total - (held or 0)) / rest, now if share else -1


def _numbered(rows: DataFrame, *order) -> DataFrame:
    """Adds `place`, from 0 in an order: sorted and numbered across partitions, one row at a time in none."""
    numbered = rows.orderBy(*order).rdd.zipWithIndex().map(lambda row: (*row[0], row[1]))
    return rows.sparkSession.createDataFrame(numbered, rows.schema.add("place", "long"))


def _seated(sources: DataFrame, seats) -> DataFrame:
    """Adds `_blocks`: seats by highest quotients target/(2k+1); ties go to the earlier place.

    A source's seats are its target times a multiplier, rounded, and n sources round off n/2 seats at most. So
    the multiplier that gives n seats too few hands out nearly all at once, and the next quotients of each
    source, up to the one that gives n too many, hold all that are left: a few per source, which are sorted.
    """
    total, n = sources.agg(F.sum("target"), F.count_if(F.col("target") > 0)).head()
    if seats <= 0 or not total:
        return sources.withColumn("_blocks", F.lit(0).cast("bigint"))
    target, few, many = F.col("target"), max(0.0, (seats - n) / total), (seats + n) / total
    given = sources.withColumn("_given", F.floor(target * few + 0.5).cast("bigint"))
    left = seats - given.agg(F.sum("_given")).head()[0]
    last = F.col("_given") + F.ceil(target * (many - few)).cast("bigint") + 1
    quotients = (given.where("target > 0").withColumn("_k", F.explode(F.sequence(F.col("_given"), last)))
                 .select(F.col("place").alias("_of"), (target / (F.col("_k") * 2 + 1)).alias("_quotient")))
    more = (_numbered(quotients, F.desc("_quotient"), "_of").where(F.col("place") < left)
            .groupBy(F.col("_of").alias("place")).agg(F.count("*").alias("_more")))
    return (given.join(more, "place", "left").withColumn("_blocks", F.col("_given") + F.coalesce("_more", F.lit(0)))
            .drop("_given", "_more"))


def planned(sources: DataFrame, block=BLOCK, weights=WEIGHTS, most=MOST) -> DataFrame:
    """(_source, source_size, target, _blocks) of `(_source, source_size)`, one row each.

    The weights repeat over the sources in the order of their names, null last. Sources are never gathered: they
    are numbered across partitions, and targets and seats come from sums over them.
    """
    ranked = _numbered(sources.select("_source", "source_size"), F.col("_source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", weight), "sources")
    aimed = stored(_targets(ranked, most), "targets")
    seats = (aimed.agg(F.sum("source_size")).head()[0] or 0) // block
    return _seated(aimed, seats).select("_source", "source_size", "target", "_blocks")


def _plan_shards(shards: pd.DataFrame) -> pd.DataFrame:
    shards = shards.sort_values("_shard").reset_index(drop=True)
    return shards.assign(_blocks=apportion(shards["_held"], int(shards["_blocks"].iloc[0])))


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, most=MOST,
        block=BLOCK, seed=7) -> DataFrame:
    """All columns of `docs` with size, source_size, target, taken and what the mix takes of each row:
    _turns (whole copies) and two runs of words, [_a1, _b1) and [_a2, _b2), of the part after them.

    A null or blank text has size 0 and is not taken. Null is a source of its own, the last. Rows that
    repeat id and size are interchangeable. A block has `block` words at every size of the corpus, so a
    source is off its target by up to a block. Tasks that apportion see one narrow row per source, or per shard of one source, never documents.
    """
    own = ["size", "source_size", "target", "taken"]
    rows = docs.select(*[c for c in docs.columns if c not in own]).withColumn("size", word_count(F.col(text_col)))
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    rows = (rows.withColumn("_order", F.xxhash64(F.lit(seed), F.col(id_col)))
            .withColumn("_shard", F.pmod(F.xxhash64(F.lit(seed + 1), F.col(id_col)), F.lit(shards)))
            .withColumn("_source", F.col(source_col).cast("string")))
    held = stored(rows.groupBy("_source", "_shard").agg(F.sum("size").alias("_held")), "shards")
    sources = held.groupBy("_source").agg(F.sum("_held").alias("source_size"))
    plan = stored(planned(sources, block, weights, most), "planned")
    quotas = (held.join(plan.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
              .groupBy("_source").applyInPandas(_plan_shards, "_source string, _shard bigint, _held bigint, "
                                                "source_size bigint, target double, _blocks bigint"))
    quotas = stored(quotas, "quotas")
    quotas = quotas.withColumnRenamed("_source", "_s").withColumnRenamed("_shard", "_n")
    ring = Window.partitionBy("_source", "_shard").orderBy("_order", id_col, "size")
    rows = rows.withColumn("_end", F.sum("size").over(ring.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(quotas, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_n")))
    words = F.least(F.col("_blocks") * block, most * F.col("_held"))
    start = F.col("_end") - F.col("size")
    rows = (rows.withColumn("_turns", F.when(F.col("_held") > 0, F.floor(words / F.col("_held"))).otherwise(0).cast("long"))
            .withColumn("_run", (words - F.col("_turns") * F.col("_held")).cast("long"))
            .withColumn("_from", F.when(F.col("_held") > 0, F.pmod(F.xxhash64(F.lit(seed + 2), "_source", "_shard"),
                                                                  F.col("_held"))).otherwise(0).cast("long")))

    def run(low, high):
        first = F.greatest(low - start, F.lit(0))
        return first, F.greatest(F.least(high - start, F.col("size")), first)

    a2, b2 = run(F.col("_from"), F.least(F.col("_from") + F.col("_run"), F.col("_held")))
    a1, b1 = run(F.lit(0), F.col("_from") + F.col("_run") - F.col("_held"))
    rows = rows.withColumns({"_a1": a1, "_b1": b1, "_a2": a2, "_b2": b2})
    rows = rows.withColumn("taken", F.col("_turns") * F.col("size") + F.col("_b1") - F.col("_a1") + F.col("_b2") - F.col("_a2"))
    return rows.select(*[c for c in docs.columns if c not in own], *own, "_turns", "_a1", "_b1", "_a2", "_b2")


def mixed_documents(mixed: DataFrame, columns, text_col="text") -> DataFrame:
    """The mix as documents: each row as often as it is taken whole, and then the part taken besides."""
    words = F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), F.lit(1))
    part = F.concat(F.slice(words, (F.col("_a1") + 1).cast("int"), (F.col("_b1") - F.col("_a1")).cast("int")),
                    F.slice(words, (F.col("_a2") + 1).cast("int"), (F.col("_b2") - F.col("_a2")).cast("int")))
    over = F.col("_b1") - F.col("_a1") + F.col("_b2") - F.col("_a2")
    rest = (F.when(over == 0, F.array().cast("array<string>")).when(over == F.col("size"), F.array(text_col))
            .otherwise(F.array(F.array_join(part, " "))))
    copies = F.concat(F.array_repeat(F.col(text_col), F.col("_turns").cast("int")), rest)
    rows = mixed.where("taken > 0").withColumn("_copy", F.explode(copies))
    replaced = {text_col: F.col("_copy"), "n_chars": F.length("_copy").cast("long")}
    return rows.select(*[replaced.get(c, F.col(c)).alias(c) for c in columns])
