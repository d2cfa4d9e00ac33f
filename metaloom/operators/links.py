"""Link checks, harvest runs and local verdicts: the latest of each, joined on and weighed."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metaloom.constants import GIVE_UP_AFTER, TOO_MANY_REQUESTS
from metaloom.functions.quality import is_dead, kind_of
from metaloom.functions.text import nullif_empty
from metaloom.functions.uris import host_of
from metaloom.operators.joins import left_lookup

# Rows of one host per block when work within a host has to follow an order.
BLOCK_ROWS = 100_000


def _row(df, *but):
    return F.struct(*[F.col(c) for c in df.columns if c not in but])


def latest_per_context(reports: DataFrame) -> DataFrame:
    """The newest report of each context: greatest `created`; a tie keeps the first by `ord`."""
    dated = reports.filter(F.col("context_id") != "").withColumn("_at", F.coalesce("created", F.lit("")))
    first = (dated.groupBy("context_id", "_at")
             .agg(F.min_by(_row(reports, "context_id"), "ord").alias("_row")))
    return (first.groupBy("context_id").agg(F.max_by("_row", "_at").alias("_row"))
            .select("context_id", "_row.*").select(*reports.columns))


def latest_per_url(checks: DataFrame, tie=("context", "pos")) -> DataFrame:
    """The newest verdict of each URL; a tie keeps the later in context and list order."""
    order = F.struct(F.coalesce("checkedAt", F.lit("")), *tie)
    return (checks.filter(F.col("uri") != "").groupBy("uri")
            .agg(F.max_by(_row(checks, "uri"), order).alias("_row"))
            .select("uri", "_row.*").select(*checks.columns))


def latest_harvest(runs: DataFrame, order="ord") -> DataFrame:
    """The newest run of each source `(context_id, status, harvested, title)`; a tie keeps the
    later."""
    best = F.max_by(F.struct("status", "harvested", "title"),
                    F.struct(F.coalesce("harvested", F.lit("")), F.col(order)))
    return runs.groupBy("context_id").agg(best.alias("_row")).select("context_id", "_row.*")


def broken_marks(checks: DataFrame) -> DataFrame:
    """`(url, mark)` of the latest checks that found a link broken."""
    mark = F.struct(nullif_empty(F.col("statusMessage")).alias("reason"),
                    nullif_empty(F.substring("checkedAt", 1, 19)).alias("checked"),
                    F.lit(None).cast("string").alias("by"))
    return (latest_per_url(checks).filter(F.col("status") == "broken")
            .select(F.col("uri").alias("url"), mark.alias("mark")))


def local_answers(verdicts: DataFrame) -> DataFrame:
    """`(url, answer)` of local verdicts that are an answer."""
    answer = F.struct((F.col("status") == "dead").alias("dead"),
                      F.coalesce("checked", F.lit("")).alias("at"), "reason", "checked")
    return (verdicts.filter(F.col("status").isin("alive", "dead"))
            .select("url", answer.alias("answer")))


def split_mark(mark) -> tuple:
    """(broken, unverified): a mark whose reason is no death is only unverified."""
    dead = is_dead(mark["reason"])
    return F.when(mark.isNotNull() & dead, mark), F.when(mark.isNotNull() & ~dead, mark)


def overlay(broken, unverified, download_answer, access_answer) -> tuple:
    """(broken, unverified) after the local answers for a distribution's two addresses.

    A death outweighs a life, then the later look wins, then the download address. A registry
    death that is strictly later stands.
    """
    def weight(a):
        return F.struct(a["dead"].alias("dead"), a["at"].alias("at"))

    chosen = (F.when(access_answer.isNull(), download_answer)
              .when(download_answer.isNull(), access_answer)
              .when(weight(access_answer) > weight(download_answer), access_answer)
              .otherwise(download_answer))
    stands = broken.isNotNull() & (F.coalesce(broken["checked"], F.lit("")) > chosen["at"])
    applies = chosen.isNotNull() & ~F.coalesce(stands, F.lit(False))
    local = F.struct(chosen["reason"].alias("reason"), chosen["checked"].alias("checked"),
                     F.lit("local").alias("by"))
    return (F.when(~applies, broken).when(chosen["dead"], local),
            F.when(~applies, unverified))


def _by_address(rows, keys, table, value):
    """Adds `<value>_download` and `<value>_access`, looked up by each address."""
    for name in ("download", "access"):
        named = table.select(F.col("url").alias("_url"), F.col(value).alias(f"{value}_{name}"))
        asked = rows.withColumn("_url", nullif_empty(F.col(f"{name}_url")))
        rows = left_lookup(asked, named, "_url", keys).drop("_url")
    return rows


def mark_distributions(distributions: DataFrame, checks: DataFrame, verdicts=None,
                       keys=("uri",)) -> DataFrame:
    """Adds `broken`, `unverified` and `kind` to flat distributions, in order of precedence:
    the registry's mark (download address first), the dead/unverified split, local answers."""
    marked = _by_address(distributions, keys, broken_marks(checks), "mark")
    marked = marked.withColumn("_mark", F.coalesce("mark_download", "mark_access"))
    broken, unverified = split_mark(F.col("_mark"))
    marked = (marked.withColumn("broken", broken).withColumn("unverified", unverified)
              .drop("_mark", "mark_download", "mark_access"))
    if verdicts is not None:
        asked = _by_address(marked, keys, local_answers(verdicts), "answer")
        broken, unverified = overlay(F.col("broken"), F.col("unverified"),
                                     F.col("answer_download"), F.col("answer_access"))
        marked = (asked.withColumn("_broken", broken).withColumn("_unverified", unverified)
                  .drop("broken", "unverified", "answer_download", "answer_access")
                  .withColumnsRenamed({"_broken": "broken", "_unverified": "unverified"}))
    has_service = F.size("access_service_uris") > 0
    return marked.withColumn("kind", kind_of("format", "download_url", "access_url", has_service))


def with_stale(records: DataFrame, sources: DataFrame, keys=("context_id", "entry_id")) -> DataFrame:
    """Adds `stale` to records whose source failed its latest harvest. Nothing is removed."""
    failed = (sources.filter(F.col("status") == "failed")
              .select("context_id", F.struct(F.lit("harvest failed").alias("reason"),
                                             F.col("harvested").alias("checked"),
                                             F.lit(None).cast("string").alias("by"))
                      .alias("stale")))
    return records.join(failed, "context_id", "left")


# --- scope -------------------------------------------------------------------

def living(distributions) -> Column:
    return F.filter(distributions, lambda d: d["broken"].isNull())


def scope(records: DataFrame) -> DataFrame:
    """Records without their dead distributions, and without the datasets that had nothing
    else. What never had a distribution stays."""
    alive = living(F.col("distributions"))
    had = F.coalesce(F.size("distributions") > 0, F.lit(False))
    return (records.filter(~had | (F.size(alive) > 0))
            .withColumn("distributions", F.when(had, alive).otherwise(F.col("distributions"))))


def scope_counts(records: DataFrame) -> DataFrame:
    """What `scope` leaves out: dead distributions, and datasets that had nothing else."""
    files = F.coalesce(F.size("distributions"), F.lit(0))
    files = F.when(files < 0, 0).otherwise(files)
    alive = F.coalesce(F.size(living(F.col("distributions"))), F.lit(0))
    alive = F.when(alive < 0, 0).otherwise(alive)
    return records.agg(F.coalesce(F.sum(files - alive), F.lit(0)).alias("dead_distributions"),
                       F.count_if((files > 0) & (alive == 0)).alias("dead_datasets"))


# --- within one host, in order -----------------------------------------------

def _block(seq, rows):
    return F.floor(F.col(seq) / F.lit(rows)).cast("bigint")


def interleave_hosts(urls: DataFrame, order="ord", limit=None, block_rows=BLOCK_ROWS) -> DataFrame:
    """Distinct URLs with their place: one URL per host in turn, hosts as first seen.

    The place within a host is counted in two steps, within blocks of `order` and over the
    blocks' sizes, so that no task sees a whole host.
    """
    distinct = (urls.groupBy("url").agg(F.min(order).alias("ord"))
                .withColumn("host", host_of(F.col("url")))
                .withColumn("block", _block("ord", block_rows)))
    in_block = Window.partitionBy("host", "block").orderBy("ord", "url")
    before = (Window.partitionBy("host").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    whole = (Window.partitionBy("host"))
    blocks = (distinct.groupBy("host", "block")
              .agg(F.count("*").alias("n"), F.min("ord").alias("first"))
              .select("host", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"),
                      F.min("first").over(whole).alias("host_first")))
    placed = (distinct.withColumn("_n", F.row_number().over(in_block))
              .join(blocks, ["host", "block"])
              .select("url", "host", (F.col("_n") + F.col("skip")).alias("turn"), "host_first"))
    ordered = placed.orderBy("turn", "host_first", "host")
    return ordered if limit is None else ordered.limit(limit)


def give_up_on_hosts(probes: DataFrame, block_rows=BLOCK_ROWS) -> DataFrame:
    """Verdicts `(url, host, seq, status, reason, invalid_cert, answered)` with what follows a
    host's stop inheriting its reason.

    A host stops at the second silence in a row, or the first 429; an answer ends a run of
    silence, a missing host or an odd address does neither. Looking one row back finds a run of
    two, within a block of `seq`; the last row of a block is carried to the next over one summary
    row per block, so that no task sees a whole host.
    """
    assert GIVE_UP_AFTER == 2, "the look back is one row"
    told = probes.filter(F.col("answered").isNotNull() & (F.col("host") != ""))
    told = told.withColumn("block", _block("seq", block_rows))
    in_block = Window.partitionBy("host", "block").orderBy("seq")
    looked = told.withColumn("_before", F.lag("answered").over(in_block))
    silent = ~F.col("answered")
    limited = F.col("answered") & (F.col("reason") == TOO_MANY_REQUESTS)
    stop_here = F.coalesce(limited, F.lit(False)) | (silent & F.coalesce(~F.col("_before"), F.lit(False)))
    stop = F.struct("seq", "reason")
    blocks = looked.groupBy("host", "block").agg(
        F.min(F.when(stop_here, stop)).alias("inside"),
        F.min_by(F.struct("answered", "seq", "reason"), "seq").alias("head"),
        F.max_by("answered", "seq").alias("tail"))
    over = Window.partitionBy("host").orderBy("block")
    carried = blocks.withColumn("_tail", F.lag("tail").over(over))
    at_edge = F.when(~F.col("_tail") & ~F.col("head.answered"),
                     F.struct(F.col("head.seq").alias("seq"), F.col("head.reason").alias("reason")))
    stops = (carried.groupBy("host")
             .agg(F.min(F.least("inside", at_edge)).alias("stop"))
             .filter(F.col("stop").isNotNull()))
    joined = probes.join(stops, "host", "left")
    skipped = (F.coalesce(F.col("seq") > F.col("stop.seq"), F.lit(False)) & (F.col("host") != "")
               & ~F.coalesce(F.col("reason") == "not an http address", F.lit(False)))
    return joined.select(
        "url", "host", "seq",
        F.when(skipped, "unverified").otherwise(F.col("status")).alias("status"),
        F.when(skipped, F.col("stop.reason")).otherwise(F.col("reason")).alias("reason"),
        (F.col("invalid_cert") & ~skipped).alias("invalid_cert"), skipped.alias("given_up"))
