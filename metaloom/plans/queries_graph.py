"""RDF/JSON graphs made from the given tables, written as text and read back."""

from pyspark.sql import functions as F

from metaloom.constants import iri
from metaloom.functions import typed, uris
from metaloom.operators import graph as g
from metaloom.plans.registry import query
from metaloom.plans.standins import entries_of, graph_text, literal, none, reference

BASE = "https://s.example.org/"


def supplier_subject():
    return F.concat(F.lit(BASE), "s_suppkey")


def supplier_entries(t, **more):
    """A service with its publisher in one graph; some entries describe a blank node first."""
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    agent = F.concat(F.lit("https://n.example.org/"), "n_nationkey")
    kind = F.when(F.col("s_acctbal") > 5000, iri("dcat:DataService")).when(
        F.col("s_acctbal") > 2000, iri("dcat:Dataset")).otherwise("http://else.example.org/Thing")
    graph = graph_text([
        (F.lit("_:b0"), {"rdf:type": [reference(F.lit(iri("vcard:Organization")))],
                         "vcard:fn": [literal(F.concat(F.lit("Desk "), "s_suppkey"))]}),
        (supplier_subject(), {
            "rdf:type": [reference(kind)],
            "dcterms:title": [literal(F.col("s_name"), F.lit("en")), literal(F.col("n_name"), F.lit("sv"))],
            "dcterms:publisher": [reference(agent), literal(F.lit("not a node"))],
            "dcat:contactPoint": [reference(F.lit("_:b0"), "bnode"), reference(F.lit("_:gone"), "bnode")]}),
        (agent, {"rdf:type": [reference(F.lit(iri("foaf:Agent")))],
                 "foaf:name": [literal(F.col("n_name"))]})])
    return entries_of(rows, F.col("s_suppkey"), graph, **more)


SQL_TRIPLES = f"""
WITH s AS (SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey),
t AS (
    SELECT s_suppkey AS id, '_:b0' AS s, 'rdf:type' AS p, 0 AS pos, 'uri' AS o_type, '{iri("vcard:Organization")}' AS o_value, NULL AS o_lang FROM s
    UNION ALL SELECT s_suppkey, '_:b0', 'vcard:fn', 0, 'literal', 'Desk ' || s_suppkey, NULL FROM s
    UNION ALL SELECT s_suppkey, '{BASE}' || s_suppkey, 'rdf:type', 0, 'uri', CASE WHEN s_acctbal > 5000 THEN '{iri("dcat:DataService")}'
        WHEN s_acctbal > 2000 THEN '{iri("dcat:Dataset")}' ELSE 'http://else.example.org/Thing' END, NULL FROM s
    UNION ALL SELECT s_suppkey, '{BASE}' || s_suppkey, 'dcterms:title', 0, 'literal', s_name, 'en' FROM s
    UNION ALL SELECT s_suppkey, '{BASE}' || s_suppkey, 'dcterms:title', 1, 'literal', n_name, 'sv' FROM s
    UNION ALL SELECT s_suppkey, '{BASE}' || s_suppkey, 'dcterms:publisher', 0, 'uri', 'https://n.example.org/' || n_nationkey, NULL FROM s
    UNION ALL SELECT s_suppkey, '{BASE}' || s_suppkey, 'dcterms:publisher', 1, 'literal', 'not a node', NULL FROM s
    UNION ALL SELECT s_suppkey, '{BASE}' || s_suppkey, 'dcat:contactPoint', 0, 'bnode', '_:b0', NULL FROM s
    UNION ALL SELECT s_suppkey, '{BASE}' || s_suppkey, 'dcat:contactPoint', 1, 'bnode', '_:gone', NULL FROM s
    UNION ALL SELECT s_suppkey, 'https://n.example.org/' || n_nationkey, 'rdf:type', 0, 'uri', '{iri("foaf:Agent")}', NULL FROM s
    UNION ALL SELECT s_suppkey, 'https://n.example.org/' || n_nationkey, 'foaf:name', 0, 'literal', n_name, NULL FROM s)
"""


def entry_id():
    return F.col("entry_id").cast("bigint").alias("id")


@query("triples_flatten", SQL_TRIPLES + "SELECT id, s, p, CAST(pos AS INTEGER) AS pos, o_type, o_value, o_lang FROM t")
def triples_flatten(t):
    return g.triples(supplier_entries(t)).select(
        entry_id(), "s", uris.shorten_uri("p").alias("p"), "pos", "o_type", "o_value", "o_lang")


@query("triples_count", SQL_TRIPLES + """
SELECT id, count(*) AS triples, count(DISTINCT s) AS subjects, count(DISTINCT p) AS predicates FROM t GROUP BY id""")
def triples_count(t):
    rows = g.triple_counts(supplier_entries(t))
    return rows.select(entry_id(), "triples", "subjects", "predicates")


@query("graph_merge", """
SELECT CAST(n_nationkey AS BIGINT) AS id, 'a,b' || CASE WHEN n_regionkey > 2 THEN ',c' ELSE '' END AS themes,
       CASE WHEN n_regionkey > 2 THEN n_name ELSE NULL END AS title FROM nation""")
def graph_merge(t):
    """Two graphs of one subject that share a triple."""
    subject = F.concat(F.lit("urn:"), "n_nationkey")
    more = F.col("n_regionkey") > 2
    left = graph_text([(subject, {"dcat:theme": [reference(F.lit("a")), reference(F.lit("b"))]})])
    right = graph_text([(subject, {
        "dcat:theme": [reference(F.lit("b")), reference(F.when(more, "c")), reference(F.when(more, "c"))],
        "dcterms:title": [literal(F.when(more, F.col("n_name")))]})])
    merged = g.merge_graphs(g.parse_graph(left), g.parse_graph(right))
    node = g.described(F.col("m"), subject)
    return t.nation.select("*", merged.alias("m")).select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.array_join(g.uris(g.objects(node, "dcat:theme")), ",").alias("themes"),
        g.first(g.values(g.objects(node, "dcterms:title"))).alias("title"))


@query("subjects_of_type", SQL_TRIPLES + f"""
SELECT id, s FROM t WHERE p = 'rdf:type' AND o_value IN ('{iri("dcat:DataService")}', '{iri("foaf:Agent")}')""")
def subjects_of_type(t):
    found = F.concat(g.subjects_of_type(F.col("metadata"), "dcat:DataService"),
                     g.subjects_of_type(F.col("metadata"), "foaf:Agent"))
    return supplier_entries(t).select(entry_id(), F.explode(found).alias("s"))


@query("main_subject", f"""
SELECT s_suppkey AS id, CASE WHEN s_acctbal > 2000 THEN '{BASE}' || s_suppkey
       ELSE 'https://n.example.org/' || s_nationkey END AS subject,
       CASE WHEN s_acctbal > 5000 THEN 'data_service' WHEN s_acctbal > 2000 THEN 'dataset' ELSE 'agent' END AS entity
FROM supplier""")
def main_subject(t):
    """Without an envelope's word for it, the most specific class decides."""
    return g.classify_entries(supplier_entries(t)).select(entry_id(), "subject", "entity")


@query("envelope_subject", f"""
SELECT s_suppkey AS id, CASE WHEN s_acctbal > 0 THEN '_:b0' ELSE '{BASE}' || s_suppkey END AS subject,
       CASE WHEN s_acctbal > 0 THEN 'contact' END AS entity,
       CASE WHEN s_acctbal > 0 THEN '_:b0' ELSE '{BASE}' || s_suppkey END AS uri FROM supplier""")
def envelope_subject(t):
    """The envelope names a subject that no class would have chosen."""
    resource = F.when(F.col("s_acctbal") > 0, "_:b0").otherwise(supplier_subject())
    found = g.classify_entries(supplier_entries(t, resource=resource))
    return found.select(entry_id(), "subject", F.when(F.col("subject") == "_:b0", F.col("entity")).alias("entity"), "uri")


@query("envelope_fields", """
SELECT o_orderkey AS id, 'https://registry.example.org/entry/' || o_orderkey AS entry_uri,
       'urn:o:' || o_orderkey AS resource_uri, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS harvested,
       'es:Link' AS entry_type, o_orderstatus = 'F' AS is_public FROM orders""")
def envelope_fields(t):
    subject = F.concat(F.lit("urn:o:"), "o_orderkey")
    rights = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("readmetadata"), F.lit("other"))).otherwise(F.array(F.lit("other")))
    entries = entries_of(t.orders, F.col("o_orderkey"), graph_text([(subject, {"dcterms:title": [literal(F.col("o_orderpriority"))]})]),
                         resource=subject, rights=rights, modified=F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return entries.select(entry_id(), "entry_uri", "resource_uri", "harvested",
                          uris.shorten_uri("entry_type").alias("entry_type"), "is_public")


@query("curie_expand_shorten", """
SELECT p_partkey AS id, CASE WHEN p_type = 'SMALL' THEN 'http://www.w3.org/ns/dcat#' || p_brand
     WHEN p_type = 'PROMO' THEN 'http://purl.org/dc/terms/' || p_brand
     WHEN p_type = 'LARGE' THEN 'http://entrystore.org/terms/statistics#' || p_brand
     WHEN p_type = 'MEDIUM' THEN 'nope:' || p_brand ELSE p_name END AS expanded,
   CASE WHEN p_type = 'SMALL' THEN 'dcat:' || p_brand WHEN p_type = 'PROMO' THEN 'dcterms:' || p_brand
     WHEN p_type = 'LARGE' THEN 'stats:' || p_brand WHEN p_type = 'MEDIUM' THEN 'nope:' || p_brand ELSE p_name END AS shortened
FROM part""")
def curie_expand_shorten(t):
    term = (F.when(F.col("p_type") == "SMALL", F.concat(F.lit("dcat:"), "p_brand"))
            .when(F.col("p_type") == "PROMO", F.concat(F.lit("dct:"), "p_brand"))
            .when(F.col("p_type") == "LARGE", F.concat(F.lit("stats:"), "p_brand"))
            .when(F.col("p_type") == "MEDIUM", F.concat(F.lit("nope:"), "p_brand")).otherwise(F.col("p_name")))
    rows = t.part.select(F.col("p_partkey").alias("id"), uris.expand_curie(term).alias("expanded"))
    return rows.select("id", "expanded", uris.shorten_uri("expanded").alias("shortened"))


@query("typed_literal", """
SELECT o_orderkey AS id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'integer' WHEN '2-HIGH' THEN 'float' WHEN '3-MEDIUM' THEN 'date'
         WHEN '5-LOW' THEN 'datetime' ELSE CASE o_orderstatus WHEN 'F' THEN 'boolean' WHEN 'O' THEN 'integer' ELSE 'string' END END AS family,
    CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey
         WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN CAST(year(o_orderdate) AS BIGINT) END AS integer,
    CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END AS float,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN TRUE END AS boolean,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d') END AS date,
    CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%dT08:30:00+02:00') END AS datetime,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'not a number' END AS string
FROM orders""")
def typed_literal(t):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    value = (F.when(priority == "1-URGENT", F.concat(F.lit(" "), "o_orderkey")).when(priority == "2-HIGH", F.col("o_totalprice").cast("string"))
             .when(priority == "3-MEDIUM", day).when(priority == "5-LOW", F.concat(day, F.lit("T08:30:00+02:00")))
             .when(status == "F", "True ").when(status == "O", F.concat(F.year("o_orderdate"), F.lit("-XX"))).otherwise("not a number"))
    kind = (F.when(priority == "1-URGENT", "long").when(priority == "2-HIGH", "decimal").when(priority == "3-MEDIUM", "date")
            .when(priority == "5-LOW", "dateTime").when(status == "F", "boolean").when(status == "O", "gYear").otherwise("int"))
    literals = typed.typed_literal(value, F.concat(F.lit(iri("xsd:")), kind))
    return t.orders.select(F.col("o_orderkey").alias("id"), literals.alias("v")).select("id", "v.*")


def conversation_entries(t):
    """One graph per conversation: every turn a title, tagged by its role, in order."""
    tag = F.when(F.col("role") == "user", "sv-SE").when(F.col("role") == "assistant", "en")
    turn = F.struct("turn", literal(F.col("text"), tag).alias("node"))
    rows = t.conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    nodes = F.transform("turns", lambda x: x["node"])
    graph = graph_text([(F.concat(F.lit("urn:c:"), "conv_id"), {"dcterms:title": nodes, "dcat:keyword": nodes})])
    return g.with_subject(entries_of(rows, F.col("conv_id"), graph))


SQL_TURNS = """
WITH c AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS u,
                  arg_min(text, turn) FILTER (role = 'assistant') AS a,
                  arg_min(text, turn) FILTER (role = 'system') AS s, min(turn) FILTER (role = 'user') AS ut,
                  min(turn) FILTER (role = 'system') AS st FROM conversations GROUP BY ALL)
"""


@query("language_pick", SQL_TURNS + """
SELECT conv_id AS id, coalesce(u, a, s) AS swedish, coalesce(a, s, u) AS english, coalesce(s, u, a) AS german FROM c""")
def language_pick(t):
    """Exact tag, else a regional variant, else untagged, else the first."""
    nodes = g.objects(F.col("node"), "dcterms:title")
    return conversation_entries(t).select(
        entry_id(), g.pick_language(nodes).alias("swedish"), g.pick_language(nodes, ["en"]).alias("english"),
        g.pick_language(nodes, ["de"]).alias("german"))


@query("localized_map", SQL_TURNS + 'SELECT conv_id AS id, u AS "sv-SE", a AS en, s AS untagged FROM c')
def localized_map(t):
    rows = conversation_entries(t).select(entry_id(), g.localized_map(g.objects(F.col("node"), "dcterms:title")).alias("m"))
    return rows.select("id", *[F.try_element_at("m", F.lit(k)).alias(k or "untagged") for k in ("sv-SE", "en", "")])


@query("fold_languages", SQL_TURNS + """
SELECT conv_id AS id, CASE WHEN st IS NULL OR ut < st THEN u ELSE s END AS sv, a AS en FROM c""".replace("WHEN st IS NULL OR ut < st THEN u ELSE s END", "WHEN ut IS NULL OR st < ut THEN s ELSE u END"))
def fold_languages(t):
    """English under `en`, everything else under `sv`, the first of each."""
    rows = conversation_entries(t).select(entry_id(), g.text_map(g.objects(F.col("node"), "dcterms:title")).alias("m"))
    return rows.select("id", F.try_element_at("m", F.lit("sv")).alias("sv"), F.try_element_at("m", F.lit("en")).alias("en"))


@query("keywords_by_language", """
WITH k AS (SELECT conv_id, turn, text, CASE role WHEN 'user' THEN 'sv-SE' WHEN 'assistant' THEN 'en' ELSE '' END AS tag FROM conversations),
f AS (SELECT *, CASE WHEN tag = 'en' THEN 'en' ELSE 'sv' END AS key,
             min(turn) OVER (PARTITION BY conv_id, tag) AS tag_first FROM k),
o AS (SELECT *, tag_first = min(turn) OVER (PARTITION BY conv_id, key) AS of_first,
             row_number() OVER (PARTITION BY conv_id, key, text ORDER BY tag_first, turn) AS again FROM f)
SELECT conv_id AS id, coalesce(string_agg(text, '|' ORDER BY tag_first, turn) FILTER (key = 'sv' AND (of_first OR again = 1)), '') AS sv,
       coalesce(string_agg(text, '|' ORDER BY tag_first, turn) FILTER (key = 'en' AND (of_first OR again = 1)), '') AS en
FROM o GROUP BY ALL""")
def keywords_by_language(t):
    rows = conversation_entries(t).select(entry_id(), g.word_map(g.objects(F.col("node"), "dcat:keyword")).alias("m"))
    return rows.select("id", *[F.coalesce(F.array_join(F.try_element_at("m", F.lit(k)), "|"), F.lit("")).alias(k) for k in ("sv", "en")])


@query("values_in_language", """
SELECT conv_id AS id, count(*) FILTER (role = 'user') AS swedish, count(*) AS every,
       first(text ORDER BY turn) AS first_value FROM conversations GROUP BY ALL""")
def values_in_language(t):
    nodes = g.objects(F.col("node"), "dcterms:title")
    return conversation_entries(t).select(
        entry_id(), F.size(g.values(nodes, "sv")).cast("bigint").alias("swedish"),
        F.size(g.values(nodes)).cast("bigint").alias("every"), g.first(g.values(nodes)).alias("first_value"))


@query("follow_reference", SQL_TRIPLES + """
SELECT t.id, t.s AS from_s, x.s, x.p, x.o_value FROM t JOIN t x ON t.id = x.id AND x.s = t.o_value
WHERE t.p IN ('dcterms:publisher', 'dcat:contactPoint') AND t.o_type <> 'literal'""")
def follow_reference(t):
    """Literals and undescribed targets are skipped."""
    found = g.follow(supplier_entries(t), "dcterms:publisher", "dcat:contactPoint")
    return found.select(entry_id(), "from_s", "s", uris.shorten_uri("p").alias("p"), "o_value")


@query("uri_objects", SQL_TRIPLES + """
SELECT id, arg_min(o_value, pos) FILTER (p = 'dcterms:publisher') AS publisher,
       count(*) FILTER (p = 'dcat:contactPoint') AS contacts FROM t
WHERE s LIKE 'https://s.%' AND (o_type = 'uri' OR p = 'dcat:contactPoint') GROUP BY ALL""".replace("count(*) FILTER (p = 'dcat:contactPoint')", "count(*) FILTER (p = 'dcat:contactPoint' AND o_type = 'uri')"))
def uri_objects(t):
    """URIs only: blank nodes and literals are not among them."""
    rows = supplier_entries(t).select("*", F.concat(F.lit(BASE), "entry_id").alias("subject"))
    node = g.described(F.col("metadata"), F.col("subject"))
    return rows.select(entry_id(), g.first_uri(g.objects(node, "dcterms:publisher")).alias("publisher"),
                       F.size(g.uris(g.objects(node, "dcat:contactPoint"))).cast("bigint").alias("contacts"))


@query("entity_pivot", SQL_TRIPLES + """
SELECT id, p AS curie, string_agg(o_value, ',' ORDER BY pos) AS objects FROM t WHERE s LIKE 'https://s.%' GROUP BY ALL""")
def entity_pivot(t):
    node = g.described(F.col("metadata"), F.concat(F.lit(BASE), "entry_id"))
    rows = supplier_entries(t).select(entry_id(), F.explode(g.pivot_subject(node)).alias("curie", "o"))
    return rows.select("id", "curie", F.array_join("o", ",").alias("objects"))


@query("scalar_literals", """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS whole,
       CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS flag, o_totalprice AS number,
       CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00')
            WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
FROM orders""")
def scalar_literals(t):
    """A whole number, a flag, a fraction and a date off graphs; the second literal where the
    first is no date."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    subject = F.concat(F.lit("urn:o:"), "o_orderkey")
    graph = graph_text([(subject, {
        "schema:whole": [literal(F.when(status == "P", "12.5").otherwise(F.col("o_orderkey").cast("string")))],
        "schema:flag": [literal(F.when(status == "F", "TRUE").when(status == "O", "0").otherwise("perhaps"), datatype=iri("xsd:boolean"))],
        "schema:number": [literal(F.col("o_totalprice"), datatype=iri("xsd:double"))],
        "schema:day": [literal(F.lit("soon")), literal(
            F.when(priority == "1-URGENT", F.concat(day, F.lit("T00:00:00Z"))).when(priority == "2-HIGH", F.date_format("o_orderdate", "yyyy"))
            .otherwise(day))]})])
    rows = g.with_subject(entries_of(t.orders, F.col("o_orderkey"), graph))

    def of(name):
        return g.objects(F.col("node"), f"schema:{name}")

    return rows.select(entry_id(), g.integer_of(of("whole")).alias("whole"), g.boolean_of(of("flag")).alias("flag"),
                       g.float_of(of("number")).alias("number"), g.date_of(of("day")).alias("day"))


@query("quarantine_nodes", """
SELECT p_partkey AS id, p_size <= 40 AS sound, CASE WHEN p_size > 45 THEN NULL WHEN p_size > 40 THEN 'thing' ELSE 'literal' END AS o_type FROM part""")
def quarantine_nodes(t):
    """Objects without a kind, or of a kind nobody knows, are put aside."""
    kind = F.when(F.col("p_size") > 45, none()).when(F.col("p_size") > 40, "thing").otherwise("literal")
    node = F.struct(kind.alias("type"), F.col("p_name").alias("value"), none().alias("lang"), none().alias("datatype"))
    entries = entries_of(t.part, F.col("p_partkey"), graph_text([(F.concat(F.lit("urn:p:"), "p_partkey"), {"dcterms:title": [node]})]))
    good, bad = g.quarantine(g.triples(entries))
    both = good.withColumn("sound", F.lit(True)).unionByName(bad.withColumn("sound", F.lit(False)))
    return both.select(entry_id(), "sound", "o_type")
