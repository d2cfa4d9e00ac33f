"""Facets and filters over the given tables."""

from pyspark.sql import functions as F

from metaloom.constants import DATA_SERVICE_FILTERS
from metaloom.functions.text import slugify
from metaloom.operators import facets, filters, windows
from metaloom.operators.graph import triples
from metaloom.operators.publishers import agents_of, name_keys, resolve
from metaloom.plans.registry import query, sql_fold, sql_slug, sql_strip
from metaloom.session import cut_lineage
from metaloom.plans.standins import entries_of, graph_text, literal, reference

DOCUMENT_FACETS = ["publisher", "publisher_type", "theme", "access_rights", "accrual_periodicity"]

SQL_DOCUMENTS = """
WITH d AS (SELECT doc_id, lang, source, n_chars, text, quality, toxic,
                  CASE toxic WHEN 0 THEN 'public' WHEN 1 THEN 'restricted' END AS access_rights,
                  CASE WHEN n_chars < 500 THEN 'daily' WHEN n_chars < 2000 THEN 'monthly' END
                      AS accrual_periodicity
           FROM documents LEFT JOIN labels USING (doc_id))
"""
SQL_DOCUMENT_FACETS = SQL_DOCUMENTS + """, f AS (
    SELECT 'publisher' AS facet, source AS value FROM d
    UNION ALL SELECT 'publisher_type', lang FROM d
    UNION ALL SELECT 'theme', lang FROM d
    UNION ALL SELECT 'access_rights', access_rights FROM d
    UNION ALL SELECT 'accrual_periodicity', accrual_periodicity FROM d),
c AS (SELECT facet, value, count(*) AS count FROM f WHERE value IS NOT NULL GROUP BY ALL)
"""

def part_facets(t):
    """Three facets of parts, keywords in mixed case among them."""
    words = F.concat(
        F.split("p_name", " "),
        F.when(F.col("p_size") > 25, F.split(F.upper("p_name"), " ")).otherwise(F.array()),
        F.when(F.col("p_type") == "PROMO", F.array(F.concat(F.lit("  "), "p_brand", F.lit("\n"))))
        .otherwise(F.array(F.lower("p_brand"), F.lit("\n    "))))
    return {"theme": F.array(F.lower("p_type")), "format": F.array(slugify("p_brand")),
            "keyword": words}


SQL_PART_WORDS = f"""
WITH w AS (
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part
    UNION ALL SELECT p_partkey, unnest(string_split(upper(p_name), ' ')) FROM part WHERE p_size > 25
    UNION ALL SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN '  ' || p_brand || chr(10)
                                     ELSE lower(p_brand) END FROM part),
k AS (SELECT DISTINCT p_partkey, {sql_fold('word')} AS key, {sql_strip('word')} AS form FROM w),
n AS (SELECT key, count(DISTINCT p_partkey) AS count FROM k GROUP BY key),
s AS (SELECT key, form, row_number() OVER (PARTITION BY key ORDER BY count(*) DESC, form) AS r
      FROM k GROUP BY key, form)
"""
SQL_PART_FACETS = SQL_PART_WORDS + f""", c AS (
    SELECT 'keyword' AS facet, form AS value, count FROM n JOIN s USING (key) WHERE r = 1
    UNION ALL SELECT 'theme', lower(p_type), count(*) FROM part GROUP BY ALL
    UNION ALL SELECT 'format', {sql_slug('p_brand')}, count(*) FROM part GROUP BY ALL)
"""


@query("facets_documents", SQL_DOCUMENT_FACETS + "SELECT facet, value, count FROM c")
def facets_documents(t):
    return facets.facet_counts(t.document_records, DOCUMENT_FACETS)


@query("facets_parts", SQL_PART_FACETS + "SELECT facet, value, count FROM c")
def facets_parts(t):
    return facets.facet_counts(t.part, ["theme", "format", "keyword"], part_facets(t))


@query("keyword_facet", SQL_PART_WORDS + """
SELECT form AS value, count FROM n JOIN s USING (key) WHERE r = 1""")
def keyword_facet(t):
    return facets.facet_counts(t.part, ["keyword"], part_facets(t)).select("value", "count")


@query("facets_ordered", SQL_PART_FACETS + """
SELECT facet, value, count FROM c ORDER BY facet, count DESC, value""")
def facets_ordered(t):
    return facets.ordered(facets_parts(t))


@query("facets_limited", SQL_PART_FACETS + """, r AS (
    SELECT *, row_number() OVER (PARTITION BY facet ORDER BY count DESC, value) AS rank FROM c)
SELECT facet, value, count, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def facets_limited(t):
    return facets.limited(facets_parts(t), 3)


@query("facets_limited_deep", """
WITH c AS (SELECT 'order' AS facet, CAST(l_orderkey AS VARCHAR) AS value, count(*) AS count FROM lineitem GROUP BY ALL
           UNION ALL SELECT 'part', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY count DESC, value) AS rank FROM c)
SELECT facet, value, count, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5000""")
def facets_limited_deep(t):
    """More values than Spark's own early cut takes."""
    both = F.array(F.struct(F.lit("order").alias("facet"), F.col("l_orderkey").alias("key")), F.struct(F.lit("part").alias("facet"), F.col("l_partkey").alias("key")))
    counted = t.lineitem.select(F.inline(both)).groupBy("facet", F.col("key").cast("string").alias("value")).agg(F.count("*").alias("count"))
    return facets.limited(counted, 5_000)


@query("facets_omitted", SQL_PART_FACETS + """
SELECT facet, count(*) - 3 AS omitted FROM c GROUP BY facet HAVING count(*) > 3""")
def facets_omitted(t):
    return facets.omitted(facets_parts(t), 3)


@query("facet_top", SQL_DOCUMENT_FACETS + """, r AS (
    SELECT *, row_number() OVER (PARTITION BY facet ORDER BY count DESC, value) AS rank FROM c)
SELECT facet, value, count FROM r WHERE rank = 1""")
def facet_top(t):
    return facets.top(facets_documents(t))


@query("service_facets", """
WITH s AS (SELECT * FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey), f AS (
    SELECT 'publisher' AS facet, lower(n_name) AS value FROM s
    UNION ALL SELECT 'publisher_type', 'region_' || n_regionkey FROM s
    UNION ALL SELECT 'service_type', 'rest' FROM s WHERE s_acctbal > 5000
    UNION ALL SELECT 'theme', 'region_' || n_regionkey FROM s
    UNION ALL SELECT 'keyword', 'Service' FROM s
    UNION ALL SELECT 'keyword', lower(n_name) FROM s
    UNION ALL SELECT 'access_rights', 'public' FROM s WHERE s_acctbal >= 0)
SELECT facet, value, count(*) AS count FROM f WHERE value IS NOT NULL GROUP BY ALL""")
def service_facets(t):
    return facets.facet_counts(t.supplier_services, DATA_SERVICE_FILTERS)


def type_labels(t):
    """A vocabulary of part types: one English and, for some, one Swedish label."""
    types = t.part.select("p_type").distinct()
    return types.select(
        F.concat(F.lit("http://themes.example.org/"), F.lower("p_type")).alias("uri"),
        F.map_filter(F.create_map(
            F.lit("en"), F.when(F.col("p_type") != "SMALL", F.concat(F.initcap("p_type"), F.lit(" parts"))),
            F.lit("sv"), F.concat(F.initcap("p_type"), F.lit("e delar"))),
            lambda _, v: v.isNotNull()).alias("label"), F.col("p_type").alias("ord"))


@query("label_join", """
WITH c AS (SELECT CASE WHEN p_type = 'SMALL' THEN 'smalle_delar' ELSE lower(p_type) || '_parts' END
                      AS value, p_type, count(*) AS count FROM part GROUP BY ALL)
SELECT 'theme' AS facet, value, count, upper(p_type[1]) || lower(p_type[2:]) || 'e delar' AS sv,
       CASE WHEN p_type <> 'SMALL' THEN upper(p_type[1]) || lower(p_type[2:]) || ' parts' END AS en
FROM c
UNION ALL SELECT 'kind', lower(p_brand), count(*), NULL, NULL FROM part GROUP BY ALL""")
def label_join(t):
    name = F.when(F.col("p_type") == "SMALL", "smalle_delar").otherwise(
        F.concat(F.lower("p_type"), F.lit("_parts")))
    counted = facets.facet_counts(t.part, ["theme", "kind"], {
        "theme": F.array(name), "kind": F.array(F.lower("p_brand"))})
    rows = facets.labelled(counted, type_labels(t))
    return rows.select("facet", "value", "count", F.try_element_at("label", F.lit("sv")).alias("sv"),
                       F.try_element_at("label", F.lit("en")).alias("en"))


@query("folded_facet", """
SELECT CASE WHEN p_type = 'PROMO' THEN 'promotion' ELSE lower(p_type) END AS value, count(*) AS count
FROM part WHERE p_brand <> 'Brand#1' GROUP BY ALL""")
def folded_facet(t):
    raw = F.concat(F.lit("http://ft.example.org/"), F.lower(F.regexp_replace("p_brand", "#", "_")),
                   F.lit("/"), F.lower("p_type"))
    counted = t.part.groupBy(raw.alias("raw")).agg(F.count("*").alias("count"))
    labels = counted.filter(F.endswith("raw", F.lit("/promo"))).select(
        F.col("raw").alias("uri"),
        F.create_map(F.lit("en"), F.lit("Promotion (.pro)")).alias("label"),
        F.col("raw").alias("ord"))
    return facets.folded(counted, labels, excluded="/brand_1/")


# --- filters -------------------------------------------------------------------

def ids(rows):
    return rows.select(F.col("entry_id").cast("bigint").alias("id"))


@query("filter_any_of", "SELECT doc_id AS id FROM documents WHERE lang IN ('fr', 'es')")
def filter_any_of(t):
    return ids(t.document_records.filter(filters.facet_filter("theme", ["fr", "es"])))


@query("filter_and", SQL_DOCUMENTS + """
SELECT doc_id AS id FROM d WHERE lang IN ('en', 'de') AND source IN ('src1', 'src2')
AND accrual_periodicity = 'daily' AND (access_rights = 'public' OR access_rights IS NULL)""")
def filter_and(t):
    return ids(t.document_records.filter(filters.all_of(
        filters.facet_filter("theme", ["en", "de"]),
        filters.facet_filter("publisher", ["src1", "src2"]),
        filters.facet_filter("accrual_periodicity", ["daily"]),
        filters.access_rights_filter(["public", "none"]))))


@query("filter_not", SQL_DOCUMENTS + """
SELECT doc_id AS id FROM d WHERE access_rights IS NULL OR access_rights <> 'public'""")
def filter_not(t):
    return ids(t.document_records.filter(
        filters.none_of(filters.term("access_rights", "public"))))


@query("filter_unset", SQL_DOCUMENTS + "SELECT doc_id AS id FROM d WHERE access_rights IS NULL")
def filter_unset(t):
    return ids(t.document_records.filter(filters.unset("access_rights")))


@query("filter_range", """
SELECT o_orderkey AS id FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1998-06-15'""")
def filter_range(t):
    return t.orders.filter(filters.within("o_orderdate", "1997", "1998-06-15", kind="timestamp")).select(
        F.col("o_orderkey").alias("id"))


@query("filter_composed", SQL_DOCUMENTS + """
SELECT doc_id AS id FROM d
WHERE (lang = 'en' AND source = 'src3') OR (NOT coalesce(access_rights = 'public', FALSE)
      AND accrual_periodicity IN ('daily', 'monthly'))""")
def filter_composed(t):
    """AND, OR, NOT and grouping; an empty list of values is neutral."""
    either = filters.any_of(
        filters.all_of(filters.facet_filter("theme", ["en"]), filters.term("context_id", "src3"),
                       filters.one_of("context_id", [])),
        filters.all_of(filters.none_of(filters.term("access_rights", "public")),
                       filters.one_of("accrual_periodicity", ["daily", "monthly"])))
    return ids(t.document_records.filter(either))


@query("filter_exists_nested", """
SELECT o_orderkey AS id FROM orders
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
  AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A')""")
def filter_exists_nested(t):
    return ids(t.order_records.filter(filters.facet_filter("format", ["wms_service"])
                                      & filters.facet_filter("kind", ["file"])
                                      & filters.facet_filter("format", ["csv"])))


@query("phrase_substring", """
SELECT doc_id AS id FROM documents WHERE contains(lower(text), 'the by')
   OR contains(lower(text), 'éau')""")
def phrase_substring(t):
    records = t.document_records
    return ids(records.filter(filters.phrase_in("The By") | filters.phrase_in("ÉAU")))


@query("phrase_words", r"""
SELECT doc_id AS id FROM documents WHERE regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])of[^\p{L}\p{N}_]+the($|[^\p{L}\p{N}_])')""")
def phrase_words(t):
    return t.documents.filter(filters.phrase_of_words("of the", "text")).select(
        F.col("doc_id").alias("id"))


@query("modified_after", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
                  THEN strftime(o_orderdate, '%Y-%m-%d') || 'T12:00:00'
                  ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' END AS stamp FROM orders)
SELECT o_orderkey AS id FROM o WHERE stamp >= '1998-03-04T00:00:01'""")
def modified_after(t):
    """`modified` where there is one, else `issued`, as text; the offset is not looked at."""
    return ids(t.order_records.filter(filters.modified_after("1998-03-04T00:00:01+05:00")))


@query("observed_values", SQL_DOCUMENT_FACETS + "SELECT facet, value FROM c")
def observed_values(t):
    return filters.observed_values(t.document_records, DOCUMENT_FACETS)


@query("resolve_exact_then_synonym", """
WITH asked AS (SELECT DISTINCT lower(p_type) || '_parts' AS value, p_type FROM part
               UNION SELECT DISTINCT p_type, p_type FROM part
               UNION SELECT DISTINCT p_name, NULL FROM part),
held AS (SELECT DISTINCT lower(p_type) AS slug FROM part WHERE p_size > 48 AND p_type <> 'LARGE'),
named AS (SELECT DISTINCT CASE WHEN p_type = 'SMALL' THEN 'smalle_delar'
                               ELSE lower(p_type) || '_parts' END AS slug FROM part)
SELECT value, CASE WHEN h.slug IS NOT NULL THEN h.slug ELSE n.slug END AS slug,
       CASE WHEN h.slug IS NOT NULL THEN 'data' WHEN n.slug IS NOT NULL THEN 'vocabulary'
            ELSE 'unknown' END AS found
FROM (SELECT DISTINCT value FROM asked) a
LEFT JOIN held h ON h.slug = replace(lower(value), ' ', '_')
LEFT JOIN named n ON n.slug = replace(lower(value), ' ', '_')""")
def resolve_exact_then_synonym(t):
    asked = (t.part.select(F.concat(F.lower("p_type"), F.lit("_parts")).alias("value"))
             .unionByName(t.part.select(F.col("p_type").alias("value")))
             .unionByName(t.part.select(F.col("p_name").alias("value"))))
    held = (t.part.filter((F.col("p_size") > 48) & (F.col("p_type") != "LARGE"))
            .select(F.lower("p_type").alias("value")))
    return filters.resolve_values(asked, held, type_labels(t))


@query("filter_keyword", f"""
SELECT p_partkey AS id FROM part
WHERE list_has_any(list_transform(string_split(p_name, ' '), lambda x: {sql_fold('x')}),
                   ['red', 'widget'])""")
def filter_keyword(t):
    records = t.part.select(F.col("p_partkey").alias("id"), F.create_map(
        F.lit("en"), F.split(F.initcap("p_name"), " ")).alias("keywords"))
    return records.filter(filters.keyword_filter(["red", "widget"])).select("id")


@query("keyword_spellings", SQL_PART_WORDS + f"""
, asked AS (SELECT DISTINCT lower(split_part(p_name, ' ', 2)) AS key FROM part)
SELECT key, word AS spelling, count(DISTINCT p_partkey) AS records
FROM (SELECT *, {sql_fold('word')} AS key FROM w) JOIN asked USING (key) GROUP BY ALL""")
def keyword_spellings(t):
    records = t.part.withColumn("keywords", F.create_map(F.lit("en"), part_facets(t)["keyword"]))
    asked = t.part.select(F.upper(F.split("p_name", " ")[1]).alias("value"))
    return filters.keyword_spellings(records, asked)


@query("filter_publisher", """
SELECT o_orderkey AS id FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9000""")
def filter_publisher(t):
    """Publishers named by URI, name and id all resolve to ids; the orders are theirs."""
    records = t.order_publishers.withColumn("publisher", F.struct(
        "publisher.id", "publisher.uri", "publisher.name", F.array().cast("array<string>").alias("identifiers")))
    chosen = t.customer.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 9000))
    uri = F.concat(F.lit("https://org.example.org/"), "c_custkey")
    asked = chosen.select(F.when(F.col("c_nationkey") < 12, uri).otherwise(
        F.concat(F.lit(" "), F.upper("c_name"))).alias("value"))
    nobody = t.fixed([], "id string, uri string, alias string, org_no string")
    keys = cut_lineage(name_keys(agents_of(records), nobody))
    wanted = resolve(asked, keys, nobody).select("id").distinct()
    return ids(records.withColumn("id", F.col("publisher.id")).join(wanted, "id", "left_semi"))


@query("filter_field_pair", "SELECT p_partkey AS id FROM part WHERE p_brand = 'Brand#7'")
def filter_field_pair(t):
    """Entries that hold one predicate and object pair in their graph."""
    graph = graph_text([(F.concat(F.lit("https://p.example.org/"), "p_partkey"), {
        "dcat:theme": [reference(F.concat(F.lit("http://b.example.org/"), "p_brand"))],
        "dcterms:title": [literal(F.col("p_name"))]})])
    entries = entries_of(t.part, F.col("p_partkey"), graph)
    found = filters.with_pair(entries, "http://www.w3.org/ns/dcat#theme",
                              "http://b.example.org/Brand#7")
    return ids(found)


@query("filter_dual_format", """
SELECT p_partkey AS id FROM part
WHERE (p_size > 25 AND p_type = 'PROMO') OR (p_size <= 25 AND p_type IN ('SMALL', 'LARGE'))""")
def filter_dual_format(t):
    """Formats stated as a URI by some and as a media type by others."""
    rows = t.part.select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") > 25, F.concat(F.lit("http://ft.example.org/"), F.lower("p_type")))
        .alias("format_uri"),
        F.when(F.col("p_size") <= 25, F.concat(F.lit("text/"), F.lower("p_type")))
        .alias("format_literal"))
    return rows.filter(filters.format_either_way(
        ["http://ft.example.org/promo", "text/small", "text/large"])).select("id")


@query("score_boost", """
SELECT doc_id AS id, (CASE WHEN contains(lower(text), 'the by') THEN 2.0 ELSE 0.0 END
     + CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END
     + CASE WHEN source = 'src4' THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM documents ORDER BY score DESC, id""")
def score_boost(t):
    text = F.contains(F.lower("text"), F.lit("the by"))
    scored = t.documents.select(F.col("doc_id").alias("id"), filters.score(
        (text, 2), (filters.term("lang", "en"), 1), (filters.term("source", "src4"), 0.5))
        .alias("score"))
    return scored.orderBy(F.desc("score"), "id")


@query("filter_overlap", """
SELECT p_partkey AS id FROM part
WHERE list_has_any(string_split(p_name, ' '), [lower(p_type), 'blue', 'ring'])""")
def filter_overlap(t):
    """Row-level overlap of what a record has with what is wanted."""
    wanted = F.array(F.lower("p_type"), F.lit("blue"), F.lit("ring"))
    return t.part.filter(F.arrays_overlap(F.split("p_name", " "), wanted)).select(
        F.col("p_partkey").alias("id"))


# --- windows and totals ----------------------------------------------------------

@query("total_count", "SELECT count(*) AS total, count(*) > 30 AS has_more FROM orders WHERE o_orderstatus = 'F'")
def total_count(t):
    found = t.order_records.filter(filters.facet_filter("accrual_periodicity", ["f"]))
    return found.agg(F.count("*").alias("total")).withColumn(
        "has_more", windows.has_more(F.lit(20), F.lit(10), F.col("total")))


@query("page_window", """
SELECT 'https://data.example.org/order/' || o_orderkey AS uri, o_orderpriority FROM orders
WHERE o_orderstatus = 'O' ORDER BY uri LIMIT 25 OFFSET 50""")
def page_window(t):
    rows = t.orders.filter(F.col("o_orderstatus") == "O").select(
        F.concat(F.lit("https://data.example.org/order/"), "o_orderkey").alias("uri"),
        "o_orderpriority")
    return windows.page(rows, limit=25, offset=50, order=["uri"])


@query("page_deep", """
SELECT 'https://data.example.org/order/' || o_orderkey AS uri, o_orderpriority FROM orders
ORDER BY uri LIMIT 25 OFFSET (SELECT count(*) * 3 // 4 FROM orders)""")
def page_deep(t):
    """A page behind three quarters of the result."""
    pages = windows.Pages(t.orders.select(F.concat(F.lit("https://data.example.org/order/"), "o_orderkey").alias("uri"), "o_orderpriority"), ["uri"])
    return pages.page(25, pages.total * 3 // 4)


@query("page_order", """
SELECT source AS context_id, CAST(doc_id AS VARCHAR) AS entry_id FROM documents
ORDER BY context_id, entry_id""")
def page_order(t):
    """Many datasets share a source; the entry id leaves no ties."""
    rows = t.document_records.select("context_id", "entry_id")
    return windows.page(rows, order=["context_id", "entry_id"])


@query("newest_first", """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P'
       THEN strftime(o_orderdate, '%Y-%m-%d') || 'T12:00:00+02:00'
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS stamp
FROM orders ORDER BY stamp DESC, id""")
def newest_first(t):
    rows = t.order_records.withColumn("id", F.col("entry_id").cast("bigint"))
    return windows.newest_first(rows, "id").select(
        "id", F.coalesce("modified", "issued").alias("stamp"))
