"""Entities read off graphs made from the given tables, and whole builds."""

from pyspark.sql import functions as F

from metaloom.constants import iri
from metaloom.operators import entities
from metaloom.operators.entities import project
from metaloom.operators.graph import with_subject
from metaloom.plans import build
from metaloom.plans.queries_vocabulary import SQL_TYPES
from metaloom.plans.queries_facets import type_labels
from metaloom.plans.registry import query
from metaloom.plans.standins import entries_of, graph_text, literal, reference

SV, EN = "sv", "en"


def text(first, rest):
    return F.concat(F.lit(first), F.col(rest).cast("string"))


def a(kind):
    return {"rdf:type": [reference(F.lit(iri(kind)))]}


def identity():
    return F.col("entry_id").cast("bigint").alias("id")


def order_graph():
    """A dataset with its publisher, contact and period described in its own graph."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    publisher = text("urn:agent:", "o_custkey")
    own = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("_:c0"))
    return graph_text([
        (text("urn:order:", "o_orderkey"), {
            **a("dcat:Dataset"),
            "dcterms:title": [literal(text("Order ", "o_orderkey"), EN), literal(text("Beställning ", "o_orderkey"), "und")],
            "dcterms:description": [literal(F.lit(""), SV), literal(F.col("o_orderpriority"), "en-GB")],
            "dcat:keyword": [literal(F.col("o_orderstatus"), SV), literal(F.lit("order"), EN)],
            "dcterms:identifier": [literal(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))), reference(text("urn:id:", "o_orderkey"))],
            "dcterms:publisher": [reference(publisher)],
            "dcat:theme": [reference(text("http://t.example.org/Status ", "o_orderstatus")), reference(F.lit("http://themes.example.org/promo"))],
            "dcterms:license": [reference(F.lit("https://themes.example.org/large/"))],
            "dcterms:accessRights": [reference(F.when(F.col("o_orderstatus") != "O", text("http://ar.example.org/", "o_orderpriority")))],
            "dcterms:language": [reference(F.lit("http://publications.europa.eu/resource/authority/language/SWE"))],
            "dcterms:issued": [literal(day, datatype=iri("xsd:date"))],
            "dcterms:modified": [literal(F.when(F.col("o_orderstatus") != "P", F.concat(day, F.lit("T10:00:00Z"))))],
            "dcterms:temporal": [reference(F.lit("_:t0"), "bnode")],
            "dcat:contactPoint": [reference(own, "bnode"), reference(F.concat(F.when(F.col("o_orderstatus") == "P", "urn:contact:gone:").otherwise("urn:contact:"), "o_custkey"))],
            "dcat:distribution": [reference(text("urn:line:", "o_orderkey")), reference(text("urn:nowhere:", "o_orderkey"))]}),
        (F.lit("_:t0"), {
            **a("dcterms:PeriodOfTime"),
            "dcat:startDate": [literal(F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy")))],
            "schema:startDate": [literal(day, datatype=iri("xsd:date"))],
            "schema:endDate": [literal(F.when(F.col("o_orderstatus") == "O", day))]}),
        (F.lit("_:c0"), {**a("vcard:Organization"), "vcard:fn": [literal(text("Desk ", "o_custkey"))],
                         "vcard:hasEmail": [reference(F.concat(F.lit("MAILTO:desk@"), F.col("o_custkey"), F.lit(".example.org")))]})])


def order_entries(t):
    return entries_of(t.orders, F.col("o_orderkey"), order_graph(), resource=text("urn:order:", "o_orderkey"),
                      modified=F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))


@query("dataset_record", """
SELECT o_orderkey AS id, 'urn:order:' || o_orderkey AS uri, 'Beställning ' || o_orderkey AS title_sv, 'Order ' || o_orderkey AS title_en,
       CAST(NULL AS VARCHAR) AS description_sv, o_orderpriority AS description_en, o_orderstatus AS keyword_sv,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) ELSE 'urn:id:' || o_orderkey END AS identifier,
       'urn:agent:' || o_custkey AS publisher_uri, 2 AS themes,
       CASE WHEN o_orderstatus <> 'O' THEN 'http://ar.example.org/' || o_orderpriority END AS access_rights_uri,
       strftime(o_orderdate, '%Y-%m-%d') AS issued,
       CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%dT10:00:00+00:00') END AS modified
FROM orders""")
def dataset_record(t):
    rows = project(order_entries(t), "dataset")

    def of(field, tag):
        return F.try_element_at(field, F.lit(tag))

    return rows.select(
        identity(), "uri", of("title", "sv").alias("title_sv"), of("title", "en").alias("title_en"),
        of("description", "sv").alias("description_sv"), of("description", "en").alias("description_en"),
        of("keywords", "sv")[0].alias("keyword_sv"), "identifier", F.col("publisher.uri").alias("publisher_uri"),
        F.size("theme_uris").alias("themes"), "access_rights_uri", "issued", "modified")


@query("period_record", """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "start",
       CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END AS "end" FROM orders""")
def period_record(t):
    """A bare year stays as written; `dcat:` goes before `schema:`."""
    return project(order_entries(t), "dataset").select(identity(), "temporal.start", "temporal.end")


@query("contact_record", """
SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS contacts,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'Desk ' || o_custkey END AS name,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'desk@' || o_custkey || '.example.org' END AS email,
       CAST(NULL AS VARCHAR) AS uri FROM orders""")
def contact_record(t):
    rows = project(order_entries(t), "dataset").withColumn("c", F.try_element_at("contact_points", F.lit(1)))
    return rows.select(identity(), F.size("contact_points").alias("contacts"), "c.name", "c.email", "c.uri")


def line_entries(t):
    """One distribution per order: its lines added up."""
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("part"), F.sum("l_quantity").cast("bigint").alias("bytes"),
        F.max("l_returnflag").alias("flag"), F.min("l_shipdate").alias("shipped"))
    size = F.regexp_replace(F.col("bytes").cast("string"), "(\\d{2})$", " $1")
    graph = graph_text([
        (text("urn:line:", "l_orderkey"), {
            **a("dcat:Distribution"),
            "dcterms:title": [literal(text("File ", "l_orderkey"), SV)],
            "dcat:accessURL": [reference(F.concat(F.lit("https://a.example.org/"), "part")), reference(F.lit("https://second.example.org/"))],
            "dcat:downloadURL": [reference(F.when(F.col("flag") == "R", F.concat(F.lit("https://d.example.org/"), "part", F.lit(".zip"))))],
            "dcterms:format": [literal(F.when(F.col("flag") == "N", "text/csv")), reference(F.when(F.col("flag") != "N", "http://ft.example.org/JSON"))],
            "dcat:byteSize": [literal(F.lit("about 5")), literal(size, datatype=iri("xsd:decimal"))],
            "dcterms:issued": [literal(F.date_format("shipped", "yyyy-MM-dd"))],
            "spdx:checksum": [reference(F.lit("_:sum"), "bnode")],
            "dcat:accessService": [reference(F.lit("urn:service"))]}),
        (F.lit("_:sum"), {"spdx:algorithm": [reference(F.lit("http://spdx.org/rdf/terms#checksumAlgorithm_md5"))],
                          "spdx:checksumValue": [literal(F.md5(F.col("part").cast("string")))]})])
    return entries_of(lines, F.col("l_orderkey"), graph, resource=text("urn:line:", "l_orderkey"), context="files")


@query("distribution_record", """
SELECT l_orderkey AS id, 'File ' || l_orderkey AS title, 'https://a.example.org/' || min(l_partkey) AS access_url,
       CASE WHEN max(l_returnflag) = 'R' THEN 'https://d.example.org/' || min(l_partkey) || '.zip' END AS download_url,
       CASE WHEN max(l_returnflag) = 'N' THEN 'text/csv' ELSE 'http://ft.example.org/JSON' END AS format_uri,
       CAST(sum(l_quantity) AS BIGINT) AS byte_size, strftime(min(l_shipdate), '%Y-%m-%d') AS issued, 1 AS services
FROM lineitem GROUP BY l_orderkey""")
def distribution_record(t):
    return project(line_entries(t), "distribution").select(
        identity(), F.try_element_at("title", F.lit(SV)).alias("title"), "access_url", "download_url", "format_uri",
        "byte_size", "issued", F.size("access_service_uris").alias("services"))


@query("checksum_record", """
SELECT l_orderkey AS id, 'http://spdx.org/rdf/terms#checksumAlgorithm_md5' AS algorithm,
       md5(CAST(min(l_partkey) AS VARCHAR)) AS value FROM lineitem GROUP BY l_orderkey""")
def checksum_record(t):
    rows = with_subject(line_entries(t), "distribution")
    found = entities.checksum_struct(F.col("node"), F.col("metadata"))
    return rows.select("entry_id", found.alias("c")).select(identity(), "c.algorithm", "c.value")


def service_entries(t):
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    graph = graph_text([(text("urn:service:", "s_suppkey"), {
        **a("escape:IndependentDataService"),
        "dcterms:title": [literal(F.col("s_name"), EN)],
        "dcterms:type": [reference(F.when(F.col("s_acctbal") > 0, "http://st.example.org/View Service"))],
        "dcat:endpointURL": [reference(F.concat(F.lit("https://api.example.org/"), "s_suppkey"))],
        "dcat:endpointDescription": [reference(F.lit("https://api.example.org/doc")), reference(F.lit("https://second.example.org/"))],
        "dcat:servesDataset": [reference(text("urn:order:", "s_suppkey")), reference(text("urn:order:", "s_nationkey"))],
        "dcterms:conformsTo": [reference(F.when(F.col("s_acctbal") > 5000, "urn:standard"))],
        "dcterms:publisher": [reference(text("urn:agent:", "s_suppkey"))],
        "dcat:contactPoint": [reference(text("urn:desk:", "s_suppkey"))],
        "dcat:keyword": [literal(F.col("n_name"))]})])
    return entries_of(rows, F.col("s_suppkey"), graph, resource=text("urn:service:", "s_suppkey"),
                      context="svc")


@query("service_record", """
SELECT s_suppkey AS id, s_name AS title, CASE WHEN s_acctbal > 0 THEN 'http://st.example.org/View Service' END AS service_type_uri,
       'https://api.example.org/' || s_suppkey AS endpoint_url, 'https://api.example.org/doc' AS endpoint_description,
       'urn:order:' || s_suppkey || ' urn:order:' || s_nationkey AS serves, CASE WHEN s_acctbal > 5000 THEN 1 ELSE 0 END AS conforms
FROM supplier""")
def service_record(t):
    return project(service_entries(t), "data_service").select(
        identity(), F.try_element_at("title", F.lit(EN)).alias("title"), "service_type_uri", "endpoint_url",
        "endpoint_description", F.array_join("serves_datasets", " ").alias("serves"), F.size("conforms_to").alias("conforms"))


def agent_entries(t):
    graph = graph_text([
        (text("urn:agent:", "c_custkey"), {
            **a("foaf:Agent"),
            "foaf:name": [literal(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")), SV)],
            "dcterms:title": [literal(F.concat(F.lit("T "), "c_name"), EN)],
            "dcterms:type": [reference(F.concat(F.lit("http://purl.org/adms/publishertype/"), "c_mktsegment"))],
            "foaf:homepage": [reference(F.when(F.col("c_acctbal") > 0, F.concat(F.lit("https://home.example.org/"), "c_custkey")))],
            "foaf:page": [reference(F.lit("https://page.example.org/"))],
            "foaf:mbox": [reference(F.concat(F.lit("mailto:c"), "c_custkey", F.lit("@example.org")))],
            "dcterms:identifier": [reference(text("urn:u:", "c_custkey")), literal(F.col("c_nationkey"))],
            "adms:identifier": [reference(F.lit("_:i0"), "bnode")]}),
        (F.lit("_:i0"), {"skos:notation": [literal(text("SE", "c_custkey"))]})])
    return entries_of(t.customer, F.col("c_custkey"), graph, resource=text("urn:agent:", "c_custkey"), context="agents")


@query("agent_record", """
SELECT c_custkey AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS sv, CASE WHEN c_mktsegment = 'BUILDING' THEN 'T ' || c_name END AS en,
       'http://purl.org/adms/publishertype/' || c_mktsegment AS type_uri,
       CASE WHEN c_acctbal > 0 THEN 'https://home.example.org/' || c_custkey ELSE 'https://page.example.org/' END AS homepage,
       'c' || c_custkey || '@example.org' AS email, c_nationkey || ' urn:u:' || c_custkey || ' SE' || c_custkey AS identifiers FROM customer""")
def agent_record(t):
    return project(agent_entries(t), "agent").select(
        identity(), F.try_element_at("name", F.lit(SV)).alias("sv"), F.try_element_at("name", F.lit(EN)).alias("en"), "type_uri",
        "homepage", "email", F.array_join("identifiers", " ").alias("identifiers"))


def contact_entries(t):
    graph = graph_text([(text("urn:contact:", "c_custkey"), {
        **a("vcard:Individual"), "vcard:organization-name": [literal(F.concat(F.lit("Contact "), "c_name"))],
        "vcard:hasEmail": [reference(F.lit("_:e"), "bnode")]}),
        (F.lit("_:e"), {"vcard:value": [reference(F.concat(F.lit("mailto:e"), "c_custkey", F.lit("@example.org")))]})])
    return entries_of(t.customer, F.col("c_custkey"), graph, resource=text("urn:contact:", "c_custkey"), context="contacts")


@query("contact_entry_record", """
SELECT c_custkey AS id, 'urn:contact:' || c_custkey AS uri, 'Contact ' || c_name AS name, 'e' || c_custkey || '@example.org' AS email
FROM customer""")
def contact_entry_record(t):
    """The e-mail is nested in a node of its own."""
    return project(contact_entries(t), "contact").select(identity(), "uri", "name", "email")


@query("longtail_record", """
SELECT p_partkey AS id, CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) ELSE 'v' || p_size END AS version,
       p_name || ' urn:prov' AS provenance, 'urn:std:' || p_size AS conforms_to, 'P1D' AS temporal_resolution,
       p_retailprice AS spatial_resolution, 1 AS categories, 1 AS series FROM part""")
def longtail_record(t):
    graph = graph_text([(text("urn:part:", "p_partkey"), {
        **a("dcat:Dataset"),
        "owl:versionInfo": [literal(F.when(F.col("p_size") > 25, F.col("p_size")))],
        "dcat:version": [literal(F.concat(F.lit("v"), "p_size"))],
        "dcterms:provenance": [reference(F.lit("urn:prov")), literal(F.col("p_name"))],
        "dcterms:conformsTo": [reference(F.concat(F.lit("urn:std:"), "p_size"))],
        "dcat:temporalResolution": [literal(F.lit("P1D"), datatype=iri("xsd:duration"))],
        "dcat:spatialResolutionInMeters": [literal(F.col("p_retailprice"), datatype=iri("xsd:decimal"))],
        "dcatap:hvdCategory": [reference(F.lit("urn:hvd"))], "dcat:inSeries": [reference(F.lit("urn:series"))]})])
    entries = entries_of(t.part, F.col("p_partkey"), graph)
    return entities.long_tail(entries).select(
        identity(), "version", F.array_join("provenance", " ").alias("provenance"),
        F.array_join("conforms_to", " ").alias("conforms_to"), "temporal_resolution",
        F.col("spatial_resolution_in_meters").alias("spatial_resolution"),
        F.size("hvd_categories").alias("categories"), F.size("in_series_uris").alias("series"))


# --- whole builds ------------------------------------------------------------------

def registry(t):
    """Everything a registry would hand out for the given tables, as entries of one kind. Orders and
    their lines stand on an earlier page too."""
    parts = [order_entries(t), line_entries(t), service_entries(t), agent_entries(t), contact_entries(t)]
    rows = None
    for number, part in enumerate(parts):
        place = F.col("entry_id").cast("bigint").alias("pos")
        pages = F.array(*[F.struct(F.lit(file).alias("file"), place) for file in ("f", "e")[:2 if number < 2 else 1]])
        part = part.select("context_id", "entry_id", "rights", "metadata", "info", F.explode(pages).alias("ord"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query("build_datasets", SQL_TYPES + """
, l AS (SELECT l_orderkey, max(l_returnflag) AS flag, min(l_partkey) AS part FROM lineitem GROUP BY ALL)
SELECT o_orderkey AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name ELSE 'T ' || c_name END AS publisher,
       lower(c_mktsegment) AS publisher_type, 'status_' || lower(o_orderstatus) || ',promo_parts' AS themes,
       (SELECT slug FROM ty WHERE p_type = 'LARGE') AS licence, (SELECT sv FROM ty WHERE p_type = 'LARGE') AS licence_label,
       CASE WHEN o_orderstatus <> 'O' THEN regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g') END AS access_rights,
       'sv' AS languages, CASE WHEN l_orderkey IS NULL THEN 0 ELSE 1 END AS files,
       CASE WHEN flag = 'N' THEN 'csv' WHEN flag IS NOT NULL THEN 'json' END AS format,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'Desk ' || o_custkey WHEN o_orderstatus <> 'P' THEN 'Contact ' || c_name END AS contact,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS harvested
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN l ON l_orderkey = o_orderkey""")
def build_datasets(t):
    """From graphs to records: projections, names, distributions, publishers and contacts."""
    labels = type_labels(t)
    rows = build.records(build.stage_entries(registry(t)), labels).filter(F.col("type") == "dataset")
    first = F.try_element_at("distributions", F.lit(1))
    return rows.select(
        identity(), F.coalesce(F.try_element_at("publisher.name", F.lit(SV)), F.try_element_at("publisher.name", F.lit(EN))).alias("publisher"),
        F.col("publisher.type").alias("publisher_type"), F.array_join("themes", ",").alias("themes"),
        F.col("license.id").alias("licence"), F.try_element_at("license.label", F.lit(SV)).alias("licence_label"), "access_rights",
        F.array_join("languages", ",").alias("languages"), F.size("distributions").alias("files"), first["format"].alias("format"),
        F.try_element_at("contact_points", F.lit(1))["name"].alias("contact"), "harvested")


@query("build_services", """
SELECT s_suppkey AS id, coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END, 'T ' || c_name) AS publisher,
       CASE WHEN s_acctbal > 0 THEN 'view_service' END AS service_type, 'data_service' AS type
FROM supplier JOIN customer ON s_suppkey = c_custkey""")
def build_services(t):
    rows = build.service_records(build.stage_entries(registry(t), wanted=build.SERVICES), type_labels(t))
    return rows.select(identity(), F.coalesce(F.try_element_at("publisher.name", F.lit(SV)), F.try_element_at("publisher.name", F.lit(EN))).alias("publisher"),
                       "service_type", "type")


@query("build_unresolved", """
SELECT 'urn:nowhere:' || o_orderkey AS uri FROM orders
UNION SELECT 'urn:line:' || o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION SELECT 'urn:contact:gone:' || o_custkey FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_orderstatus = 'P'
UNION SELECT 'urn:desk:' || s_suppkey FROM supplier""")
def build_unresolved(t):
    return build.unresolved(build.stage_entries(registry(t), wanted=build.REFERENCES))


@query("catalogue_view", """
WITH c AS (SELECT user_id, arg_max(event_type, struct_pack(a := date_trunc('millisecond', ts), b := CAST(json_extract(props, '$.k') AS INTEGER) // 15, c := event_id)) AS e,
                  arg_max(CAST(json_extract(props, '$.k') AS INTEGER) < 50, struct_pack(a := date_trunc('millisecond', ts), b := CAST(json_extract(props, '$.k') AS INTEGER) // 15, c := event_id)) AS gone
           FROM events GROUP BY ALL)
SELECT p_partkey AS id, e = 'error' AND gone AS broken, e = 'error' AND NOT gone AS unverified,
       CASE WHEN p_size > 10 THEN 'file' WHEN p_type = 'PROMO' THEN 'web_page' ELSE 'file' END AS kind
FROM part LEFT JOIN c ON user_id = p_partkey // 3""".replace("e = 'error' AND gone AS broken", "coalesce(e = 'error' AND gone, FALSE) AS broken")
       .replace("e = 'error' AND NOT gone AS unverified", "coalesce(e = 'error' AND NOT gone, FALSE) AS unverified"))
def catalogue_view(t):
    """Stored records as handed out: marks by address, kinds read off the metadata."""
    from metaloom import schemas
    address = F.concat(F.lit("https://dl.example.org/"), F.floor(F.col("p_partkey") / 3).cast("string"), F.lit(".zip"))
    given = {"uri": F.concat(F.lit("urn:part:"), "p_partkey"), "format": F.when(F.col("p_type") == "PROMO", "html").otherwise("csv"),
             "download_url": F.when(F.col("p_size") > 10, address), "access_url": address,
             "access_service_uris": F.array().cast("array<string>")}
    d = F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.DISTRIBUTION.fields])
    stored = t.part.select(F.lit("ctx").alias("context_id"), F.col("p_partkey").cast("string").alias("entry_id"), F.array(d).alias("distributions"))
    shown = build.view(stored, checks=t.link_log)
    one = F.col("distributions")[0]
    return shown.select(identity(), one["broken"].isNotNull().alias("broken"), one["unverified"].isNotNull().alias("unverified"), one["kind"].alias("kind"))
