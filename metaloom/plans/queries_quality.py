"""Rules read off one row, scope, and work within one host."""

from pyspark.sql import functions as F

from metaloom.functions import quality, text, typed, uris
from metaloom.operators import links
from metaloom.operators.computed import computed
from metaloom.operators.publishers import with_publisher_id
from metaloom.plans.registry import query, sql_slug
from metaloom.plans.standins import none


def page_distributions(t):
    """pages with a format, a download and an access address made from their URL."""
    access = F.col("url")
    for language, path in (("/fr/", "/rowstore/dataset/"), ("/de/", "/dataset/x/resource/"),
                           ("/es/", "/arcgis/rest/services/")):
        access = F.replace(access, F.lit(language), F.lit(path))
    return t.pages.select(
        "page_id", "url",
        F.when(F.endswith("url", F.lit(".html")), "html")
        .when(F.contains("url", F.lit("ref=")), "csv").alias("format"),
        F.when(F.contains("url", F.lit("utm_source")),
               F.regexp_replace(access, "\\?utm_source=.*$", ".csv")).alias("download_url"),
        F.when(~F.endswith("url", F.lit("/")), access).alias("access_url"),
        F.contains("url", F.lit("//blog.")).alias("has_service"))


def sql_shape(u):
    return f"""CASE WHEN contains(lower({u}), '/rowstore/dataset/') THEN 'rowstore'
     WHEN regexp_matches(lower({u}), '/dataset/[^/]+/resource/') THEN 'ckan'
     WHEN contains(lower({u}), '/arcgis/rest/services') THEN 'geodata' END"""


SQL_PAGES = """
WITH q AS (SELECT *, replace(replace(replace(url, '/fr/', '/rowstore/dataset/'),
           '/de/', '/dataset/x/resource/'), '/es/', '/arcgis/rest/services/') AS a FROM pages),
p AS (SELECT page_id, url,
    CASE WHEN url LIKE '%.html' THEN 'html' WHEN contains(url, 'ref=') THEN 'csv' END AS format,
    CASE WHEN contains(url, 'utm_source') THEN regexp_replace(a, '\\?utm_source=.*$', '.csv') END
        AS download_url,
    CASE WHEN url NOT LIKE '%/' THEN a END AS access_url,
    contains(url, '//blog.') AS has_service FROM q)
"""


@query("kind_of_page", SQL_PAGES + f"""
, s AS (SELECT *, {sql_shape('download_url')} AS ds, {sql_shape('access_url')} AS ac FROM p)
SELECT page_id, CASE
    WHEN download_url IS NOT NULL THEN CASE WHEN ds IN ('geodata', 'rowstore') THEN ds ELSE 'file' END
    WHEN access_url IS NOT NULL AND ac IS NOT NULL THEN ac
    WHEN access_url IS NOT NULL AND format = 'html' THEN 'web_page'
    WHEN access_url IS NOT NULL AND format IS NOT NULL THEN 'file'
    WHEN has_service THEN 'api' ELSE 'unknown' END AS kind FROM s""")
def kind_of_page(t):
    return page_distributions(t).select("page_id", quality.kind_of(
        "format", "download_url", "access_url", F.col("has_service")).alias("kind"))


@query("kind_by_address", SQL_PAGES + f"SELECT page_id, {sql_shape('access_url')} AS shape FROM p")
def kind_by_address(t):
    return page_distributions(t).select("page_id", quality.kind_by_address("access_url").alias("shape"))


@query("host_and_path", """
SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1)) AS host,
       regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages""")
def host_and_path(t):
    return t.pages.select("page_id", uris.host_of("url").alias("host"), uris.path_of("url").alias("path"))


@query("uri_spellings", """
WITH b AS (SELECT page_id, url, regexp_replace(url, '#.*$', '') AS base FROM pages),
c AS (SELECT *, regexp_replace(base, '/+$', '') AS bare FROM b),
tw AS (SELECT page_id, [url, base, twin(base), bare, twin(bare), bare || '/', twin(bare || '/')] AS forms
       FROM c),
u AS (SELECT page_id, unnest(forms) AS spelling, generate_subscripts(forms, 1) AS n FROM tw),
d AS (SELECT page_id, spelling, min(n) AS n FROM u GROUP BY ALL)
SELECT page_id, spelling, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INTEGER) AS pos
FROM d""".replace("twin(base)", "CASE WHEN base LIKE 'https://%' THEN 'http' || base[6:] ELSE 'https' || base[5:] END")
       .replace("twin(bare || '/')", "CASE WHEN bare LIKE 'https://%' THEN 'http' || bare[6:] || '/' ELSE 'https' || bare[5:] || '/' END")
       .replace("twin(bare)", "CASE WHEN bare LIKE 'https://%' THEN 'http' || bare[6:] ELSE 'https' || bare[5:] END"))
def uri_spellings(t):
    return t.pages.select("page_id", F.posexplode(uris.uri_spellings("url")).alias("pos", "spelling"))


@query("first_url", """
SELECT page_id, CASE WHEN url LIKE 'https%' THEN url WHEN url LIKE '%.html' THEN 'x' || url END AS address
FROM pages""")
def first_url(t):
    field = F.array(none(), F.lit(""), F.when(F.startswith("url", F.lit("https")), F.col("url")),
                    F.when(F.endswith("url", F.lit(".html")), F.concat(F.lit("x"), "url")))
    return t.pages.select("page_id", uris.first_url(field, is_array=True).alias("address"))


@query("slugify", f"""
SELECT 'd' || doc_id AS id, {sql_slug('text')} AS slug FROM documents
UNION ALL SELECT 'p' || p_partkey, {sql_slug("p_name || ' (' || p_brand || ') ' || p_type")} FROM part
UNION ALL SELECT 'n' || n_nationkey, {sql_slug('n_name')} FROM nation""")
def slugify(t):
    part = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(") "), "p_type")
    rows = (t.documents.select(F.concat(F.lit("d"), "doc_id").alias("id"), F.col("text").alias("x"))
            .unionByName(t.part.select(F.concat(F.lit("p"), "p_partkey").alias("id"), part.alias("x")))
            .unionByName(t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("id"),
                                         F.col("n_name").alias("x"))))
    return rows.select("id", text.slugify("x").alias("slug"))


@query("dead_reason", """
SELECT event_id, event_type IN ('error', 'signup')
    OR (event_type = 'view' AND user_id < 75) AS dead FROM events""")
def dead_reason(t):
    reason = (F.when(F.col("event_type") == "error", " Not Found ")
              .when(F.col("event_type") == "signup", "503")
              .when(F.col("event_type") == "click", "Too Many Requests")
              .when(F.col("event_type") == "view", F.concat(
                  F.lit("request to http://h"), "user_id", F.lit("/ failed, reason: "),
                  F.when(F.col("user_id") < 75, "getaddrinfo ENOTFOUND h").otherwise("read ECONNRESET"))))
    return t.events.select("event_id", quality.is_dead(reason).alias("dead"))


SQL_LINES = """
WITH l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_discount >= 0.09) AS dead
           FROM lineitem GROUP BY ALL)
"""


@query("scope_exclude_dead", SQL_LINES + """
SELECT o_orderkey AS id, CAST(coalesce(n - dead, 0) AS INTEGER) AS kept
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey WHERE n IS NULL OR n > dead""")
def scope_exclude_dead(t):
    return links.scope(t.order_records).select(
        F.col("entry_id").cast("bigint").alias("id"), F.size("distributions").alias("kept"))


@query("scope_counts", SQL_LINES + """
SELECT CAST(sum(dead) AS BIGINT) AS dead_distributions, count(*) FILTER (n = dead) AS dead_datasets
FROM orders JOIN l ON l_orderkey = o_orderkey""")
def scope_counts(t):
    return links.scope_counts(t.order_records)


@query("split_broken", """
SELECT doc_id AS id, quality = 0 AS dead, quality = 1 AND toxic = 1 AS unverified FROM labels""")
def split_broken(t):
    """A registry mark whose reason is no death is only unverified."""
    reason = F.when(F.col("quality") == 0, "Internal Server Error").when(F.col("toxic") == 1, "timeout")
    mark = F.when(reason.isNotNull(), F.struct(reason.alias("reason")))
    dead, unverified = links.split_mark(mark)
    return t.labels.select(F.col("doc_id").alias("id"), dead.isNotNull().alias("dead"),
                           unverified.isNotNull().alias("unverified"))


# --- publishers and texts of a record -------------------------------------------

def customers_as_records(t):
    """Customers as publishers: nation URIs, with a closing slash on some, unknown on others."""
    nation = F.concat(F.lit("http://org.example.org/nation/"), "c_nationkey")
    uri = (F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("http://other.example.org/"), "c_custkey"))
           .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(nation, F.lit("/"))).otherwise(nation))
    swedish = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("Företag "), "c_name")).otherwise("")
    return t.customer.select("c_custkey", F.struct(
        uri.alias("uri"), F.create_map(F.lit("sv"), swedish, F.lit("en"), "c_name").alias("name"),
        F.lower("c_mktsegment").alias("type"), none().alias("homepage"), none().alias("email"),
        none("array<string>").alias("identifiers")).alias("publisher"))


def nation_publishers(t):
    """Nations as the publisher table. Region 0 nations share an alias, which then names nobody."""
    alias = F.when(F.col("n_regionkey") == 0, "Shared").otherwise(
        F.concat(F.lit("N "), "n_nationkey"))
    return t.nation.select(
        F.lower("n_name").alias("id"),
        F.concat(F.lit("http://org.example.org/nation/"), "n_nationkey").alias("uri"),
        alias.alias("alias"), F.concat(F.lit("se"), F.col("n_nationkey") + 2020000000).alias("org_no"))


SQL_PUBLISHER = f"""
WITH c AS (SELECT c_custkey, c_mktsegment, n_nationkey, n_regionkey,
    CASE WHEN c_mktsegment = 'MACHINERY'
         THEN {sql_slug("CASE WHEN c_acctbal > 0 THEN 'Företag ' || c_name ELSE c_name END")}
         ELSE lower(n_name) END AS id
    FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""


@query("publisher_id", SQL_PUBLISHER + "SELECT c_custkey, id FROM c")
def publisher_id(t):
    rows = with_publisher_id(customers_as_records(t), nation_publishers(t))
    return rows.select("c_custkey", F.col("publisher.id").alias("id"))


@query("publisher_struct", SQL_PUBLISHER + """
SELECT c_custkey, id, CASE WHEN c_mktsegment <> 'MACHINERY' AND n_regionkey <> 0
       THEN 'n_' || n_nationkey END AS alias, lower(c_mktsegment) AS type, 0 AS identifiers FROM c""")
def publisher_struct(t):
    rows = with_publisher_id(customers_as_records(t), nation_publishers(t))
    return rows.select("c_custkey", "publisher.id", "publisher.alias", "publisher.type",
                       F.size("publisher.identifiers").alias("identifiers"))


def _said(value):
    """A language map of one turn: users Swedish, assistants English, others a third language."""
    return F.map_filter(F.create_map(
        F.lit("sv"), F.when(F.col("role") == "user", value),
        F.lit("en"), F.when(F.col("role") == "assistant", value),
        F.lit("no"), F.when(F.col("role") == "system", value)), lambda _, v: v.isNotNull())


@query("text_in_language", """
SELECT conv_id, turn, role, text AS sv, text AS en FROM conversations""")
def text_in_language(t):
    rows = t.conversations.withColumn("said", _said(F.col("text")))
    return rows.select("conv_id", "turn", "role", text.localized_text(F.col("said"), "sv").alias("sv"),
                       text.localized_text(F.col("said"), "en").alias("en"))


@query("keywords_in_language", """
WITH w AS (SELECT conv_id, turn, role, string_split(text, ' ') AS words FROM conversations)
SELECT conv_id, turn, role,
       CASE WHEN role = 'system' THEN 0 ELSE CAST(len(words) AS INTEGER) END AS sv,
       CAST(len(list_distinct(words)) AS INTEGER) AS every FROM w""")
def keywords_in_language(t):
    words = _said(F.split("text", " "))
    return t.conversations.select("conv_id", "turn", "role",
                                  F.size(text.keywords_in(words, "sv")).alias("sv"),
                                  F.size(text.all_keywords(words)).alias("every"))


@query("byte_size_parse", r"""
WITH x AS (SELECT l_returnflag, l_linestatus, CASE l_returnflag
    WHEN 'A' THEN regexp_replace(CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR), '(\d{3})$', ' \1')
    WHEN 'N' THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '.00'
    ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '.5' END AS raw FROM lineitem),
y AS (SELECT *, replace(raw, ' ', '') AS digits FROM x)
SELECT l_returnflag, l_linestatus, count(*) AS lines,
       count(*) FILTER (regexp_full_match(digits, '\d+(\.0*)?')) AS readable,
       CAST(coalesce(sum(CAST(split_part(digits, '.', 1) AS BIGINT))
            FILTER (regexp_full_match(digits, '\d+(\.0*)?')), 0) AS BIGINT) AS bytes
FROM y GROUP BY ALL""")
def byte_size_parse(t):
    whole = F.floor("l_extendedprice").cast("bigint").cast("string")
    pieces = F.floor("l_quantity").cast("bigint").cast("string")
    raw = (F.when(F.col("l_returnflag") == "A", F.regexp_replace(whole, "(\\d{3})$", " $1"))
           .when(F.col("l_returnflag") == "N", F.concat(pieces, F.lit(".00")))
           .otherwise(F.concat(pieces, F.lit(".5"))))
    size = typed.byte_size(raw)
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("lines"), F.count(size).alias("readable"),
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))


# --- probes ----------------------------------------------------------------------

def probes(t):
    """events as recorded probes: one row per address asked, all answers beside each other."""
    number = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    host = F.concat(F.lit("https://h"), "user_id", F.lit(".example.org"))
    url = (F.when((kind == "view") & (number < 10), F.concat(F.lit("ftp://h"), "user_id", F.lit("/f/"), "event_id"))
           .otherwise(F.concat(host, F.lit("/f/"), "event_id")))
    rows = t.events.select(
        "event_id", "user_id", url.alias("url"),
        F.when(kind == "click", 200).when(kind == "view", 404).when(kind == "purchase", F.when(number < 5, 429).otherwise(200))
        .when(kind == "signup", 503).alias("head"),
        F.when(kind == "view", F.when(number < 50, 200).otherwise(404)).when(kind == "signup", 503).alias("get"),
        F.when(kind == "click", F.when(number < 20, F.concat(host, F.lit("/home/")))
               .when(number < 40, F.concat(url, F.lit("/"))).otherwise(url)).alias("final"),
        F.concat(host, F.lit("/home")).alias("baseline"),
        F.when(kind == "error", F.when(number < 40, "timeout").when(number < 70, "connection")
               .otherwise("certificate")).alias("error"),
        (F.col("value") >= 5).alias("host_known"),
        F.when(number < 85, 200).otherwise(410).alias("second_head"),
        F.when(number >= 85, 410).alias("second_get"))
    verdict = quality.probe_verdict(
        F.col("url"), F.col("head"), F.col("get"), F.col("final"), F.col("baseline"), F.col("error"),
        F.col("host_known"), F.col("second_head"), F.col("second_get"))
    return (computed(rows, v=verdict)
            .select("event_id", "url", uris.host_of("url").alias("host"), F.col("event_id").alias("seq"), "v.*"))


SQL_PROBES = """
WITH e AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
v AS (SELECT event_id, user_id, 'h' || user_id || CASE WHEN event_type = 'view' AND k < 10 THEN '' ELSE '.example.org' END AS host,
    CASE WHEN event_type = 'view' AND k < 10 THEN 'unverified|not an http address||'
         WHEN event_type = 'error' AND k < 40 THEN 'unverified|timeout||n'
         WHEN event_type = 'error' AND k < 70 AND value < 5 THEN 'dead|host not found||'
         WHEN event_type = 'error' AND k < 70 THEN 'unverified|connection||n'
         WHEN event_type = 'error' AND k < 85 THEN 'alive||c|y'
         WHEN event_type = 'error' THEN 'dead|Gone|c|y'
         WHEN event_type = 'purchase' AND k < 5 THEN 'unverified|Too Many Requests||y'
         WHEN event_type = 'view' AND k >= 50 THEN 'dead|Not Found||y'
         WHEN event_type = 'signup' THEN 'unverified|Service Unavailable||y'
         WHEN event_type = 'click' AND k < 20 THEN 'dead|soft 404||y'
         ELSE 'alive|||y' END AS told FROM e),
p AS (SELECT event_id, host, split_part(told, '|', 1) AS status,
             nullif(split_part(told, '|', 2), '') AS reason, split_part(told, '|', 3) = 'c' AS invalid_cert,
             CASE split_part(told, '|', 4) WHEN 'y' THEN TRUE WHEN 'n' THEN FALSE END AS answered FROM v)
"""


@query("probe_verdict", SQL_PROBES + "SELECT event_id, status, reason, invalid_cert FROM p")
def probe_verdict(t):
    return probes(t).select("event_id", "status", "reason", "invalid_cert")


@query("give_up_hosts", SQL_PROBES + """
, told AS (SELECT *, lag(answered) OVER (PARTITION BY host ORDER BY event_id) AS before
           FROM p WHERE answered IS NOT NULL),
stop AS (SELECT host, min(event_id) AS stop_at, arg_min(reason, event_id) AS why FROM told
         WHERE reason = 'Too Many Requests' OR (NOT answered AND NOT before) GROUP BY host),
j AS (SELECT p.*, why, event_id > stop_at AND coalesce(reason, '') <> 'not an http address' AS skipped
      FROM p LEFT JOIN stop USING (host))
SELECT event_id, CASE WHEN skipped THEN 'unverified' ELSE status END AS status,
       CASE WHEN skipped THEN why ELSE reason END AS reason,
       invalid_cert AND NOT coalesce(skipped, FALSE) AS invalid_cert, coalesce(skipped, FALSE) AS given_up
FROM j""")
def give_up_hosts(t):
    """Blocks smaller than a host's rows, so that runs of silence cross them."""
    return links.give_up_on_hosts(probes(t), block_rows=2000).select(
        F.col("seq").alias("event_id"), "status", "reason", "invalid_cert", "given_up")


@query("verdict_summary", SQL_PROBES + """
SELECT count(*) AS checked, count(*) FILTER (status = 'alive') AS alive,
       count(*) FILTER (status = 'dead') AS dead, count(*) FILTER (status = 'unverified') AS unverified,
       count(*) FILTER (invalid_cert) AS invalid_cert FROM p""")
def verdict_summary(t):
    from metaloom.operators.reports import verdict_summary as summary
    return summary(probes(t))


@query("interleave_hosts", """
WITH u AS (SELECT url, min(page_id) AS ord, lower(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1)) AS host
           FROM pages GROUP BY ALL),
r AS (SELECT url, row_number() OVER (PARTITION BY host ORDER BY ord, url) AS turn,
             min(ord) OVER (PARTITION BY host) AS host_first FROM u)
SELECT url, turn, host_first FROM r ORDER BY turn, host_first""")
def interleave_hosts(t):
    return links.interleave_hosts(t.pages, order="page_id", block_rows=40).select(
        "url", "turn", "host_first")
