"""Who publishes, and how much."""

from pyspark.sql import functions as F

from metaloom.constants import PUBLISHER_FACETS
from metaloom.operators import publishers
from metaloom.operators.facets import facet_counts
from metaloom.plans.registry import query, sql_slug
from metaloom.session import cut_lineage


def nation_records(t, orders=None):
    """Orders published by the customer's nation: one publisher, one agent per customer."""
    agent = F.struct(
        F.col("publisher.type").alias("id"), "publisher.uri", "publisher.name",
        F.lit(None).cast("string").alias("alias"), F.col("context_id").alias("type"),
        F.lit(None).cast("string").alias("homepage"), F.lit(None).cast("string").alias("email"),
        F.array(F.concat(F.lit(" SE-"), F.substring_index("publisher.uri", "/", -1))).alias("identifiers"))
    return (t.order_publishers if orders is None else orders).withColumn("publisher", agent)


def nation_keys(t):
    """Written once, as a catalogue's are: `resolve` names them more than once."""
    return cut_lineage(publishers.name_keys(publishers.agents_of(nation_records(t)), nation_table(t)))


def nation_table(t):
    """The publisher table: a row per customer under their nation, with an alias; only some are listed under
    the URI that records give them, the others under one that nobody uses."""
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    base = F.when(F.col("c_acctbal") > 9900, "https://org.example.org/").otherwise("https://nobody.example.org/")
    return customers.select(F.lower("n_name").alias("id"), F.concat(base, "c_custkey").alias("uri"),
                       F.concat(F.lit("Alias "), "c_custkey").alias("alias"),
                       F.lit(None).cast("string").alias("org_no"))


SQL_AGENTS = """
WITH a AS (SELECT 'nation_' || c_nationkey AS id, 'https://org.example.org/' || c_custkey AS uri,
                  c_custkey, c_name, c_acctbal > 9900 AS known, count(*) AS records
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
"""


@query("publisher_counts", """
WITH d AS (SELECT 'nation_' || c_nationkey AS id, count(*) AS n FROM orders
           JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
s AS (SELECT lower(n_name) AS id, count(*) AS n FROM supplier
      JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
SELECT id, coalesce(d.n, 0) AS dataset_count, coalesce(s.n, 0) AS data_service_count
FROM d FULL JOIN s USING (id) ORDER BY dataset_count DESC, id""")
def publisher_counts(t):
    return publishers.counts(nation_records(t), t.supplier_services).orderBy(
        F.desc("dataset_count"), "id")


@query("publisher_entity", SQL_AGENTS + """
, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY known DESC, records DESC, uri) AS n FROM a)
SELECT id, uri, records, c_name AS name FROM r WHERE n = 1""")
def publisher_entity(t):
    best = publishers.representatives(publishers.agents_of(nation_records(t)), nation_table(t))
    return best.select("id", "uri", "records", F.try_element_at("agent.name", F.lit("en")).alias("name"))


@query("publisher_rows", SQL_AGENTS + """
, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY known DESC, records DESC, uri) AS n,
               sum(records) OVER (PARTITION BY id) AS total FROM a),
s AS (SELECT lower(n_name) AS id, count(*) AS services FROM supplier
      JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
SELECT id, uri, CAST(total AS BIGINT) AS dataset_count, coalesce(services, 0) AS data_service_count
FROM r LEFT JOIN s USING (id) WHERE n = 1 ORDER BY dataset_count DESC, id""")
def publisher_rows(t):
    records = nation_records(t)
    best = publishers.representatives(publishers.agents_of(records), nation_table(t))
    counted = publishers.counts(records, t.supplier_services)
    return publishers.publisher_rows(counted, best).select(
        "id", "uri", "dataset_count", "data_service_count")


SQL_KEYS = SQL_AGENTS + f"""
, k AS (SELECT id AS key, id, 0 AS tier FROM a
        UNION ALL SELECT uri, id, 2 FROM a
        UNION ALL SELECT 'SE-' || c_custkey, id, 3 FROM a
        UNION ALL SELECT {sql_slug('c_name')}, id, 4 FROM a
        UNION ALL SELECT 'alias_' || c_custkey, 'nation_' || c_nationkey, 1 FROM customer
            WHERE 'nation_' || c_nationkey IN (SELECT id FROM a)),
f AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY tier, id) AS n FROM k)
"""


@query("publisher_keys", SQL_KEYS + "SELECT key, id, tier FROM f WHERE n = 1")
def publisher_keys(t):
    return publishers.name_keys(publishers.agents_of(nation_records(t)), nation_table(t))


@query("publisher_resolve", SQL_KEYS + """
, asked AS (SELECT upper(c_name) AS value, lower(replace(c_name, '#', '_')) AS key FROM customer
            UNION ALL SELECT ' SE-' || c_custkey || ' ', 'SE-' || c_custkey FROM customer
            UNION ALL SELECT 'Alias ' || c_custkey, 'alias_' || c_custkey FROM customer
            UNION ALL SELECT s_name, NULL FROM supplier)
SELECT value, f.id AS id, f.id IS NOT NULL AS held
FROM asked LEFT JOIN (SELECT key, id FROM f WHERE n = 1) f USING (key)""")
def publisher_resolve(t):
    """Names, numbers and aliases of customers lead to their nation; suppliers are unknown."""
    customer = t.customer
    asked = (customer.select(F.upper("c_name").alias("value"))
             .unionByName(customer.select(F.concat(F.lit(" SE-"), "c_custkey", F.lit(" ")).alias("value")))
             .unionByName(customer.select(F.concat(F.lit("Alias "), "c_custkey").alias("value")))
             .unionByName(t.supplier.select(F.col("s_name").alias("value"))))
    return publishers.resolve(asked, nation_keys(t), cut_lineage(nation_table(t)))


@query("publisher_detail", """
WITH o AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 7),
l AS (SELECT DISTINCT o_orderkey, l_returnflag FROM o JOIN lineitem ON l_orderkey = o_orderkey),
f AS (SELECT 'theme' AS facet, lower(o_orderstatus) AS value FROM o
      UNION ALL SELECT 'accrual_periodicity', lower(o_orderstatus) FROM o WHERE o_orderstatus <> 'P'
      UNION ALL SELECT 'access_rights', lower(o_orderpriority) FROM o WHERE o_orderpriority <> '4-NOT SPECIFIED'
      UNION ALL SELECT 'format', CASE l_returnflag WHEN 'A' THEN 'csv' WHEN 'N' THEN 'html' ELSE 'wms_service' END FROM l
      UNION ALL SELECT * FROM (SELECT DISTINCT 'kind', CASE WHEN l_returnflag = 'R' THEN 'geodata'
            WHEN l_returnflag = 'A' OR l_linestatus = 'F' THEN 'file' ELSE 'web_page' END || '#' || o_orderkey FROM o JOIN lineitem ON l_orderkey = o_orderkey))
SELECT facet, split_part(value, '#', 1) AS value, count(*) AS count FROM f GROUP BY ALL""")
def publisher_detail(t):
    """What one publisher's datasets are made of."""
    mine = nation_records(t, t.order_records).filter(F.col("publisher.id") == "nation_7")
    return facet_counts(mine, PUBLISHER_FACETS)
