"""References spliced into records; the latest of each log; counts per source."""

from pyspark.sql import functions as F

from metaloom.operators import assemble, links, reports
from metaloom.plans.registry import query
from metaloom.plans.standins import entries_of, graph_text, literal, none
from metaloom.sources import exports, registry, store


def part_distributions(t):
    """Every part as one distribution with its own URI."""
    return t.part.select(F.concat(F.lit("urn:part:"), "p_partkey").alias("uri"),
                         F.lower("p_type").alias("format"), "p_size")


def orders_with_references(t):
    """Orders with the parts of their lines as references, in line order, each part once."""
    line = F.struct("l_linenumber", "l_partkey")
    wanted = t.lineitem.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_set(line)).alias("lines"))
    refs = F.array_distinct(F.transform("lines", lambda x: F.concat(F.lit("urn:part:"), x["l_partkey"] * 2)))
    orders = t.orders.withColumnRenamed("o_orderkey", "l_orderkey")
    return orders.join(wanted, "l_orderkey", "left").select(
        F.lit("ctx").alias("context_id"), F.col("l_orderkey").cast("string").alias("entry_id"),
        "o_custkey", F.coalesce(refs, F.array().cast("array<string>")).alias("distribution_uris"))


SQL_REFERENCES = """
WITH x AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem),
y AS (SELECT l_orderkey, l_partkey * 2 AS ref, row_number() OVER (PARTITION BY l_orderkey, l_partkey
             ORDER BY l_linenumber) AS again, l_linenumber, l_partkey FROM x),
r AS (SELECT l_orderkey, ref, row_number() OVER (PARTITION BY l_orderkey
             ORDER BY l_linenumber, l_partkey) - 1 AS pos FROM y WHERE again = 1)
"""


@query("nest_distributions", SQL_REFERENCES + """
SELECT o_orderkey AS id, coalesce(string_agg(lower(p_type) || p_partkey, ',' ORDER BY pos), '') AS nested
FROM orders LEFT JOIN r ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = ref GROUP BY ALL""")
def nest_distributions(t):
    """Half of the references lead to no part and are left out."""
    nested = assemble.nest(orders_with_references(t), assemble.KEYS, "distribution_uris",
                           part_distributions(t), "distributions")
    text = F.array_join(F.transform("distributions", lambda d: F.concat(
        d["format"], F.substring_index(d["uri"], ":", -1))), ",")
    return nested.select(F.col("entry_id").cast("bigint").alias("id"), text.alias("nested"))


@query("missing_references", SQL_REFERENCES + """
SELECT DISTINCT 'urn:part:' || ref AS uri FROM r WHERE ref NOT IN (SELECT p_partkey FROM part)""")
def missing_references(t):
    refs = assemble.references_of(orders_with_references(t), assemble.KEYS, "distribution_uris")
    return assemble.missing_references(refs, part_distributions(t))


@query("targeted_lookup", SQL_REFERENCES + """
SELECT 'urn:part:' || p_partkey AS uri, lower(p_type) AS format, p_size FROM part
WHERE p_partkey IN (SELECT ref FROM r)""")
def targeted_lookup(t):
    refs = assemble.references_of(orders_with_references(t), assemble.KEYS, "distribution_uris")
    return assemble.targeted(part_distributions(t), refs)


@query("assemble_publisher", """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
            THEN 'urn:gone:' || o_custkey ELSE 'urn:agent:' || o_custkey END AS uri,
       CASE WHEN o_orderstatus <> 'P' AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN c_name
            WHEN o_orderpriority = '1-URGENT' THEN 'inline' END AS name
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def assemble_publisher(t):
    """Some orders name no publisher, some describe it, and some name one nobody knows."""
    agent = "struct<uri:string,name:map<string,string>,type_uri:string,homepage:string,email:string,identifiers:array<string>>"
    known = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "urn:gone:").otherwise("urn:agent:")
    uri = F.when(F.col("o_orderstatus") != "P", F.concat(known, "o_custkey"))

    def described(name, at):
        return F.struct(at.alias("uri"), F.create_map(F.lit("en"), name).alias("name"),
                        none().alias("type_uri"), none().alias("homepage"), none().alias("email"),
                        F.array().cast("array<string>").alias("identifiers")).cast(agent)

    records = t.orders.select(
        F.lit("ctx").alias("context_id"), F.col("o_orderkey").cast("string").alias("entry_id"),
        uri.alias("publisher_uri"),
        F.when(F.col("o_orderpriority") == "1-URGENT", described(F.lit("inline"), uri)).alias("publisher"))
    agents = (t.customer.select(described(F.col("c_name"), F.concat(F.lit("urn:agent:"), "c_custkey")).alias("a"))
              .select("a.*"))
    named = assemble.with_publisher(records, agents)
    return named.select(F.col("entry_id").cast("bigint").alias("id"), "publisher.uri",
                        F.try_element_at("publisher.name", F.lit("en")).alias("name"))


@query("assemble_contacts", """
SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'inline'
       WHEN o_custkey < c2.n THEN coalesce((SELECT c_name FROM customer WHERE c_custkey = o_custkey), '') || ';' ||
            coalesce((SELECT s_name FROM supplier WHERE s_suppkey = o_custkey), '')
       ELSE coalesce((SELECT c_name FROM customer WHERE c_custkey = o_custkey), '') || ';' END AS names
FROM orders, (SELECT count(*) AS n FROM supplier) c2""")
def assemble_contacts(t):
    """Contacts found by reference where a record describes none itself."""
    contact = "array<struct<uri:string,name:string,email:string>>"
    inline = F.array(F.struct(none().alias("uri"), F.lit("inline").alias("name"), none().alias("email")))
    records = t.orders.select(
        F.lit("ctx").alias("context_id"), F.col("o_orderkey").cast("string").alias("entry_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", inline).otherwise(F.array().cast(contact))
        .alias("contact_points"),
        F.array(F.concat(F.lit("urn:c:"), "o_custkey"), F.concat(F.lit("urn:s:"), "o_custkey"))
        .alias("contact_point_uris"))
    contacts = (t.customer.select(F.concat(F.lit("urn:c:"), "c_custkey").alias("uri"),
                                  F.concat("c_name", F.lit(";")).alias("name"), none().alias("email"))
                .unionByName(t.supplier.select(F.concat(F.lit("urn:s:"), "s_suppkey").alias("uri"),
                                               F.col("s_name").alias("name"), none().alias("email"))))
    found = assemble.with_contacts(records, contacts)
    names = F.array_join(F.transform("contact_points", lambda c: c["name"]), "")
    return found.select(F.col("entry_id").cast("bigint").alias("id"), names.alias("names"))


@query("dedupe_last", """
SELECT user_id AS uri, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type
FROM events GROUP BY ALL""")
def dedupe_last(t):
    rows = t.events.select(F.col("user_id").cast("string").alias("uri"), "event_id", "event_type",
                           F.col("event_id").alias("ord"))
    return assemble.last_by_uri(rows).select(F.col("uri").cast("bigint").alias("uri"), "event_id", "event_type")


@query("get_first_by_uri", """
SELECT regexp_extract(url, '^([^?#]*)', 1) AS uri, min(page_id) AS page_id FROM pages GROUP BY ALL""")
def get_first_by_uri(t):
    rows = t.pages.select(F.regexp_extract("url", "^([^?#]*)", 1).alias("uri"), "page_id")
    return assemble.first_by_uri(rows, [F.col("page_id")])


@query("latest_report", """
WITH r AS (SELECT 'ctx' || (user_id // 10) AS context_id, strftime(ts, '%Y-%m-%d') AS created, event_id
           FROM events)
SELECT context_id, created, event_id AS ord FROM (SELECT *, row_number() OVER (
    PARTITION BY context_id ORDER BY created DESC, event_id) AS n FROM r) WHERE n = 1""")
def latest_report(t):
    """The newest day of each context; among its reports of that day the first."""
    context = F.concat(F.lit("ctx"), F.floor(F.col("user_id") / 10).cast("string"))
    graph = graph_text([(F.concat(F.lit("urn:report:"), "event_id"), {
        "dcterms:created": [literal(F.date_format("ts", "yyyy-MM-dd"))]})])
    order = F.struct(F.lit("page").alias("file"), F.col("event_id").alias("pos"))
    entries = entries_of(t.events, F.col("event_id"), graph, context=context, extra=[order.alias("ord")])
    newest = links.latest_per_context(registry.report_entries(entries))
    return newest.select("context_id", "created", F.col("ord.pos").alias("ord"))


SQL_CHECKS = """
WITH c AS (SELECT 'https://dl.example.org/' || user_id || '.zip' AS uri,
    'ctx' || CAST(json_extract(props, '$.k') AS INTEGER) // 15 AS context,
    CASE event_type WHEN 'error' THEN 'broken' WHEN 'signup' THEN 'excluded' ELSE 'success' END AS status,
    CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 50 THEN 'Not Found' ELSE 'timeout' END AS message,
    strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(extract('millisecond' FROM ts)::INT % 1000 AS VARCHAR), 3, '0') || 'Z' AS tm, event_id
    FROM events),
v AS (SELECT uri, arg_max(status, {order}) AS status, arg_max(message, {order}) AS message,
             arg_max(tm, {order}) AS tm, arg_max(event_id, {order}) AS pos FROM c GROUP BY uri)
"""
SQL_CHECKS_EXACT = SQL_CHECKS.replace("{order}", "struct_pack(a := tm, b := context, c := event_id)")
SQL_CHECKS_DAY = SQL_CHECKS.replace("{order}", "struct_pack(a := tm[:10], b := context, c := event_id)")


@query("latest_verdict", SQL_CHECKS_DAY + "SELECT uri, status, message AS reason, pos FROM v")
def latest_verdict(t):
    """Checks of one day tie; the later context, then the later place in its list, stands."""
    rows = t.link_log.withColumn("checkedAt", F.substring("checkedAt", 1, 10))
    return links.latest_per_url(rows).select("uri", "status", F.col("statusMessage").alias("reason"), "pos")


def line_addresses(t):
    """Parts as distributions whose download address is in the link log for some."""
    return t.part.select(
        F.concat(F.lit("urn:part:"), "p_partkey").alias("uri"), F.lower("p_type").alias("format"),
        F.when(F.col("p_size") > 10, F.concat(F.lit("https://dl.example.org/"), "p_partkey", F.lit(".zip"))).alias("download_url"),
        F.concat(F.lit("https://dl.example.org/"), F.floor(F.col("p_partkey") / 2).cast("string"), F.lit(".zip")).alias("access_url"),
        F.array().cast("array<string>").alias("access_service_uris"))


SQL_MARKED = SQL_CHECKS_EXACT + """
, b AS (SELECT uri AS url, message AS reason, tm[:19] AS checked FROM v WHERE status = 'broken'),
p AS (SELECT 'urn:part:' || p_partkey AS uri,
             CASE WHEN p_size > 10 THEN 'https://dl.example.org/' || p_partkey || '.zip' END AS d,
             'https://dl.example.org/' || (p_partkey // 2) || '.zip' AS a FROM part),
m AS (SELECT p.uri, p.d, p.a, coalesce(bd.reason, ba.reason) AS reason, coalesce(bd.checked, ba.checked) AS checked
      FROM p LEFT JOIN b bd ON bd.url = d LEFT JOIN b ba ON ba.url = a)
"""


@query("attach_verdict", SQL_MARKED + """
SELECT uri, CASE WHEN reason = 'Not Found' THEN checked END AS broken,
       CASE WHEN reason <> 'Not Found' THEN checked END AS unverified,
       'file' AS kind FROM m""")
def attach_verdict(t):
    marked = links.mark_distributions(line_addresses(t), t.link_log)
    return marked.select("uri", F.col("broken.checked").alias("broken"),
                         F.col("unverified.checked").alias("unverified"), "kind")


def local_verdicts(t):
    """Users' accounts as local verdicts of some addresses."""
    return t.events.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("e"), F.max_by("value", "event_id").alias("value")).select(
        F.concat(F.lit("https://dl.example.org/"), "user_id", F.lit(".zip")).alias("url"),
        F.when(F.col("e") == "view", "alive").when(F.col("e") == "click", "dead").otherwise("unverified").alias("status"),
        F.when(F.col("e") == "click", "Gone").alias("reason"),
        F.when(F.col("value") > 8, "2024-01-30T12:00:00").otherwise("2024-02-02T00:00:00").alias("checked"),
        F.lit(False).alias("invalid_cert"))


@query("verdict_overlay", SQL_MARKED + """
, l AS (SELECT 'https://dl.example.org/' || user_id || '.zip' AS url, arg_max(event_type, event_id) AS e,
               CASE WHEN arg_max(value, event_id) > 8 THEN '2024-01-30T12:00:00' ELSE '2024-02-02T00:00:00' END AS tm
        FROM events GROUP BY user_id HAVING arg_max(event_type, event_id) IN ('view', 'click')),
o AS (SELECT m.*, CASE WHEN ld.url IS NULL THEN la.e WHEN la.url IS NULL THEN ld.e
             WHEN (la.e = 'click') > (ld.e = 'click') OR ((la.e = 'click') = (ld.e = 'click') AND la.tm > ld.tm) THEN la.e ELSE ld.e END AS e,
             CASE WHEN ld.url IS NULL THEN la.tm WHEN la.url IS NULL THEN ld.tm
             WHEN (la.e = 'click') > (ld.e = 'click') OR ((la.e = 'click') = (ld.e = 'click') AND la.tm > ld.tm) THEN la.tm ELSE ld.tm END AS tm
      FROM m LEFT JOIN l ld ON ld.url = d LEFT JOIN l la ON la.url = a),
z AS (SELECT *, e IS NOT NULL AND NOT coalesce(reason = 'Not Found' AND checked > tm, FALSE) AS applies FROM o)
SELECT uri, CASE WHEN NOT applies THEN CASE WHEN reason = 'Not Found' THEN reason END
                 WHEN e = 'click' THEN 'Gone' END AS broken,
       CASE WHEN NOT applies AND reason <> 'Not Found' THEN reason END AS unverified,
       CASE WHEN applies AND e = 'click' THEN 'local' END AS by FROM z""")
def verdict_overlay(t):
    marked = links.mark_distributions(line_addresses(t), t.link_log, local_verdicts(t))
    return marked.select("uri", F.col("broken.reason").alias("broken"),
                         F.col("unverified.reason").alias("unverified"), F.col("broken.by").alias("by"))


def harvest_log(t):
    """events as harvest runs of the sources src0.., an error a failure."""
    return t.events.select(
        F.concat(F.lit("src"), F.floor(F.col("user_id") / 5).cast("string")).alias("context_id"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.date_format("ts", "yyyy-MM-dd'T'HH").alias("harvested"), none().alias("title"),
        F.col("event_id").alias("ord"))


SQL_SOURCES = """
WITH h AS (SELECT 'src' || (user_id // 5) AS context_id,
                  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
                  strftime(ts, '%Y-%m-%dT%H') AS harvested, event_id FROM events),
s AS (SELECT context_id, arg_max(status, struct_pack(a := harvested, b := event_id)) AS status,
             max(harvested) AS harvested FROM h GROUP BY ALL),
d AS (SELECT source AS context_id, count(*) AS n FROM documents GROUP BY ALL),
w AS (SELECT s.*, coalesce(d.n, 0) AS dataset_count,
             coalesce((SELECT count(*) FROM supplier WHERE 'src' || s_nationkey = s.context_id), 0) AS data_service_count
      FROM s LEFT JOIN d USING (context_id))
"""


def source_rows_of(t):
    services = t.supplier.select(F.concat(F.lit("src"), "s_nationkey").alias("context_id"))
    return reports.source_rows(links.latest_harvest(harvest_log(t)), t.document_records, services)


@query("latest_harvest", SQL_SOURCES + "SELECT context_id, status, harvested FROM s")
def latest_harvest(t):
    return links.latest_harvest(harvest_log(t)).select("context_id", "status", "harvested")


@query("source_rows", SQL_SOURCES + """
SELECT context_id, status, harvested, dataset_count, data_service_count FROM w
ORDER BY dataset_count DESC, data_service_count DESC, context_id""")
def source_rows(t):
    return source_rows_of(t).drop("title")


@query("source_summary", SQL_SOURCES + """
SELECT count(*) AS total, count(*) FILTER (status = 'success') AS succeeded,
       count(*) FILTER (status = 'failed') AS failed,
       count(*) FILTER (status = 'failed' AND dataset_count + data_service_count > 0) AS failed_holding_records
FROM w""")
def source_summary(t):
    return reports.source_summary(source_rows_of(t))


@query("stale_mark", SQL_SOURCES + """
SELECT doc_id AS id, CASE WHEN status = 'failed' THEN 'harvest failed' END AS reason,
       CASE WHEN status = 'failed' THEN harvested END AS checked
FROM documents LEFT JOIN s ON s.context_id = source""")
def stale_mark(t):
    marked = links.with_stale(t.document_records.drop("stale"), links.latest_harvest(harvest_log(t)))
    return marked.select(F.col("entry_id").cast("bigint").alias("id"), "stale.reason", "stale.checked")


@query("catalogue_info", """
WITH d AS (SELECT doc_id, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
s AS (SELECT lower(n_name) AS source FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT count(*) FILTER (quality IS NULL OR quality <> 0) AS datasets,
       (SELECT count(*) FROM s) AS data_services,
       count(DISTINCT source) FILTER (quality IS NULL OR quality <> 0) + (SELECT count(DISTINCT source) FROM s) AS publishers,
       count(*) FILTER (quality = 0) AS dead_distributions, count(*) FILTER (quality = 0) AS dead_datasets,
       CAST(0 AS BIGINT) AS stale_datasets,
       count(*) FILTER (quality = 1 AND toxic = 1) AS unverified_distributions,
       date_diff('day', (SELECT max(ts) FROM events)::DATE, DATE '2024-03-01') AS age_days FROM d""")
def catalogue_info(t):
    """The copy was refreshed when the log ends."""
    refreshed = t.events.agg(F.max("ts")).head()[0]
    return reports.catalogue_info(store.union_kinds(t.document_records, t.supplier_services), refreshed, "2024-03-01")


@query("run_summary", """
SELECT (SELECT count(*) FROM orders) AS datasets, (SELECT count(*) FROM supplier) AS data_services,
       (SELECT count(*) FROM lineitem) AS distributions, (SELECT count(*) FROM pages) AS texts_read,
       (SELECT CAST(sum(strlen(html)) AS BIGINT) FROM pages) AS bytes_read""")
def run_summary(t):
    """The pages are what the build read."""
    run = reports.Run(t.spark)
    run.reads(t.pages, "html").write.format("noop").mode("overwrite").save()
    return run.summary(store.union_kinds(t.order_records, t.supplier_services)).drop("seconds")


@query("duplicate_keys", """
SELECT l_orderkey || '/' || l_linenumber AS uri, count(*) AS records FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(t):
    rows = t.lineitem.select(F.concat_ws("/", "l_orderkey", "l_linenumber").alias("uri"))
    return reports.duplicate_uris(rows)


@query("union_kinds", """
SELECT 'https://data.example.org/doc/' || doc_id AS uri, 'dataset' AS type, source AS context_id FROM documents
UNION ALL SELECT 'https://data.example.org/service/' || s_suppkey, 'data_service', lower(n_name)
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def union_kinds(t):
    return store.union_kinds(t.document_records, t.supplier_services).select("uri", "type", "context_id")


@query("flat_export", """
SELECT 'https://data.example.org/order/' || l_orderkey AS dataset, 'Order ' || l_orderkey AS title, c_name AS publisher,
       CASE l_returnflag WHEN 'A' THEN 'csv' WHEN 'N' THEN 'html' ELSE 'wms_service' END AS format,
       CASE WHEN l_linestatus = 'F' THEN 'https://dl.example.org/' || l_partkey || '.zip'
            ELSE 'https://api.example.org/part/' || l_partkey END AS url
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def flat_export(t):
    return exports.flat_distributions(t.order_records).drop("pos", "kind")


@query("get_record", """
SELECT 'https://data.example.org/doc/' || doc_id AS uri, source AS context_id FROM documents
WHERE doc_id = (SELECT min(doc_id) FROM labels)""")
def get_record(t):
    """One record by its URI, out of all of them."""
    lowest = t.labels.agg(F.concat(F.lit("https://data.example.org/doc/"), F.min("doc_id")).alias("uri"))
    uri = lowest.head()["uri"]  # the one that is asked for
    return assemble.record_by_uri(t.document_records, uri).select("uri", "context_id")


# --- changes -----------------------------------------------------------------------

MIDDLE = "2024-01-15"


def stamped(t):
    """events with their time as text, written with one offset or the other."""
    form = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    there = F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOURS"), form), F.lit("+02:00"))
    return t.events.withColumn("harvested", F.when(F.col("event_type") == "click", there).otherwise(
        F.concat(F.date_format("ts", form), F.lit("Z"))))


@query("upsert_latest", """
SELECT user_id, arg_max(event_type, ts) AS event_type, arg_max(event_id, ts) AS event_id FROM events GROUP BY ALL""")
def upsert_latest(t):
    """What the first half of the log left, with the second half's rows over it, newest by moment."""
    middle = F.lit(MIDDLE).cast("timestamp")
    old, new = (store.latest_per_key(stamped(t).filter(half), ["user_id"]).select("user_id", "event_type", "event_id")
                for half in (F.col("ts") < middle, F.col("ts") >= middle))
    return store.upserted(old, new, keys=["user_id"])


@query("changed_since", f"SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '{MIDDLE}'")
def changed_since(t):
    """The mark has an offset of its own."""
    return store.changed_since(stamped(t), f"{MIDDLE}T03:00:00+03:00").select("event_id", "user_id")


@query("high_water", "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS high_water FROM events")
def high_water(t):
    return store.high_water(t.events, "ts").select(
        F.date_format("high_water", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("high_water"))


@query("rebuild_diff", f"""
WITH a AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '{MIDDLE}'),
b AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-25')
SELECT user_id, event_type, 'added' AS change FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
UNION ALL SELECT user_id, event_type, 'removed' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""")
def rebuild_diff(t):
    """What users did in the first half of the month, and in its last days."""
    did = t.events.select("user_id", "event_type", "ts")
    return store.rebuild_diff(did.filter(F.col("ts") < F.lit(MIDDLE).cast("timestamp")).drop("ts").distinct(),
                              did.filter(F.col("ts") >= F.lit("2024-01-25").cast("timestamp")).drop("ts").distinct(),
                              keys=["user_id", "event_type"])


@query("quarantine_pages", """
SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN 'page' WHEN p_type = 'SMALL' THEN 'graph' END AS unreadable,
       CASE WHEN p_type = 'PROMO' THEN 0 ELSE 1 END AS entries FROM part""")
def quarantine_pages(t):
    """A page per part; some are torn, and some hold a graph that is none."""
    graph = F.when(F.col("p_type") == "SMALL", "{torn").otherwise("{}")
    child = F.struct(F.col("p_brand").alias("contextId"), F.col("p_partkey").cast("string").alias("entryId"), graph.alias("metadata"))
    text = F.to_json(F.struct(F.struct(F.array(child).alias("children")).alias("resource")))
    torn = F.when(F.col("p_type") == "PROMO", F.expr("left(text, length(text) - 4)")).otherwise(F.col("text"))
    texts = t.part.select(F.col("p_partkey").cast("string").alias("file"), "p_type", text.alias("text")).select("file", torn.alias("text"))
    pages, unreadable = registry.split_pages(texts)
    rows = (registry.entries_of_pages(pages).select(F.col("ord.file").alias("file"), none().alias("unreadable"), F.lit(1).alias("entries"))
            .unionByName(unreadable.select("file", F.lit("page").alias("unreadable"), F.lit(0).alias("entries")))
            .unionByName(registry.unreadable_graphs(pages).select("file", F.lit("graph").alias("unreadable"), F.lit(0).alias("entries"))))
    return rows.groupBy(F.col("file").cast("bigint").alias("id")).agg(F.max("unreadable").alias("unreadable"), F.max("entries").alias("entries"))
