"""What a store holds after rebuilds, upserts, refreshes and streams, over the given tables."""

import uuid

from pyspark.sql import functions as F

from metaloom.plans import build
from metaloom.plans.queries_assembly import MIDDLE
from metaloom.plans.queries_entities import agent_entries, line_entries, order_entries, type_labels
from metaloom.plans.refresh import MARK, refresh
from metaloom.plans.registry import query
from metaloom.session import cut_lineage, shared_folder
from metaloom.sources.store import Store
from metaloom.streaming import upserts

NOW = "2024-02-01T00:00:00"


def new_store(t, **settings):
    return Store(t.spark, f"{shared_folder(t.spark)}/store-{uuid.uuid4().hex}", **settings)


def event_records(events):
    """Events as records: what a user did last is one entry."""
    return events.select(
        F.lit("ctx").alias("context_id"), F.col("user_id").cast("string").alias("entry_id"),
        F.concat(F.lit("urn:user:"), "user_id").alias("uri"), F.lit("dataset").alias("type"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("harvested"), "event_type", "event_id")


def newest_events(store):
    return store.records().select(F.col("entry_id").cast("bigint").alias("user_id"), "event_type", "event_id")


def event_checks(events):
    """Events as link checks; the user is the URL."""
    return events.select(
        F.concat(F.lit("https://dl.example.org/"), "user_id").alias("uri"), F.lit("ctx").alias("context"),
        F.col("event_type").alias("status"), F.lit(None).cast("string").alias("statusMessage"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("checkedAt"), F.col("event_id").alias("pos"))


def as_stream(t, name):
    rows = getattr(t, name)
    return t.spark.readStream.schema(rows.schema).parquet(f"{t.folder}/{name}.parquet*")


SQL_NEWEST = "SELECT user_id, arg_max(event_type, ts) AS event_type, arg_max(event_id, ts) AS event_id FROM events GROUP BY ALL"
SQL_CHECKS = """SELECT 'https://dl.example.org/' || user_id AS url, arg_max(event_type, struct_pack(a := ts, b := event_id)) AS status,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS checked FROM events GROUP BY ALL"""


@query("store_rebuild", "SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS customer FROM orders")
def store_rebuild(t):
    """Every order, once; a rebuild replaces what an earlier one held."""
    store = new_store(t, bucket_rows=2_000)
    rows = t.orders.select(
        F.lit("ctx").alias("context_id"), F.col("o_orderkey").cast("string").alias("entry_id"), F.concat(F.lit("urn:"), "o_orderkey").alias("uri"),
        F.lit("dataset").alias("type"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("harvested"), "o_orderkey", "o_orderstatus", "o_custkey")
    store.rebuild(rows.withColumn("context_id", F.lit("old")), NOW)
    store.rebuild(rows, NOW)
    return store.records("dataset").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer"))


@query("store_upsert", SQL_NEWEST)
def store_upsert(t):
    """The later half of the log over the earlier one, then the earlier one once more, which changes nothing."""
    store, middle = new_store(t, bucket_rows=50), F.lit(MIDDLE).cast("timestamp")
    old, new = (event_records(t.events.filter(half)) for half in (F.col("ts") < middle, F.col("ts") >= middle))
    store.rebuild(old, NOW)
    store.upsert(new, NOW)
    store.upsert(old, NOW, only_newer=True)
    return newest_events(store)


@query("upsert_verdicts", SQL_CHECKS)
def upsert_verdicts(t):
    """A table beside the records, merged week by week, the weeks out of order."""
    store = new_store(t, bucket_rows=50)
    for week in (2, 0, 3, 1):
        rows = t.events.filter(F.pmod(F.weekofyear("ts"), F.lit(4)) == week)
        store.upsert_table("link_checks", cut_lineage(upserts.verdicts_of_checks(event_checks(rows))), "url", latest="checked")
    return store.link_checks().select("url", "status", "checked")


@query("store_sources", """
SELECT lower(n_name) AS context_id, count(*) AS held FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""")
def store_sources(t):
    """A snapshot replaces the one before it."""
    store, nations = new_store(t), t.nation.withColumnRenamed("n_nationkey", "s_nationkey")
    store.replace_table("sources", t.nation.select(F.col("n_name").alias("context_id"), F.lit(0).cast("bigint").alias("held")))
    store.replace_table("sources", t.supplier.join(nations, "s_nationkey").groupBy(F.lower("n_name").alias("context_id")).agg(F.count("*").alias("held")))
    return store.sources()


@query("stream_upsert", SQL_NEWEST)
def stream_upsert(t):
    """The log as a stream into the store."""
    store = new_store(t)
    upserts.upsert_records(event_records(as_stream(t, "events")), store, f"{store.root}-checkpoint", NOW).awaitTermination()
    return newest_events(store)


@query("stream_verdicts", SQL_CHECKS)
def stream_verdicts(t):
    """The log as a stream of link checks; the later arrival wins a tie."""
    store = new_store(t)
    upserts.upsert_checks(event_checks(as_stream(t, "events")), store, f"{store.root}-checkpoint").awaitTermination()
    return store.link_checks().select("url", "status", "checked")


@query("refresh_targeted", """
WITH l AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT o_orderkey AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name ELSE 'T ' || c_name END AS publisher,
       CASE WHEN l_orderkey IS NULL THEN 0 ELSE 1 END AS files, strftime((SELECT max(o_orderdate) FROM orders), '%Y-%m-%dT%H:%M:%S+00:00') AS mark
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN l ON l_orderkey = o_orderkey""")
def refresh_targeted(t):
    """A catalogue of the orders up to a day, then a refresh with all that came after it, through the store."""
    rows = None
    for part in (order_entries(t), line_entries(t), agent_entries(t)):
        part = part.select("context_id", "entry_id", "rights", "metadata", "info",
                           F.struct(F.lit("f").alias("file"), F.col("entry_id").cast("bigint").alias("pos")).alias("ord"))
        rows = part if rows is None else rows.unionByName(part)
    store, labels = new_store(t), cut_lineage(type_labels(t))
    staged = build.stage_entries(rows)
    middle = staged.agg(F.percentile_approx(F.unix_timestamp(F.try_to_timestamp("harvested")), 0.5)).head()[0]
    stamp = F.unix_timestamp(F.try_to_timestamp("harvested"))
    refresh(store, staged.filter(stamp.isNull() | (stamp <= middle)), labels, NOW)
    refresh(store, staged, labels, NOW)
    mark = store.meta().filter(F.col("key") == MARK).select(F.col("value").alias("mark"))
    first = F.coalesce(F.try_element_at("publisher.name", F.lit("sv")), F.try_element_at("publisher.name", F.lit("en")))
    return store.records("dataset").crossJoin(F.broadcast(mark)).select(
        F.col("entry_id").cast("bigint").alias("id"), first.alias("publisher"), F.size("distributions").alias("files"), "mark")
