"""Labels, short names and coverage of vocabulary URIs."""

from pyspark.sql import functions as F

from metaloom.functions.uris import language_code
from metaloom.operators import vocabulary
from metaloom.operators.graph import triples
from metaloom.plans.queries_facets import type_labels
from metaloom.plans.queries_quality import nation_publishers
from metaloom.plans.registry import query
from metaloom.plans.standins import entries_of, graph_text, literal, reference

EU_LANGUAGE = "http://publications.europa.eu/resource/authority/language/"


def part_uri(t):
    """A part's type as a URI, spelled in one of several ways, or one nobody labelled."""
    path = F.concat(F.lit("themes.example.org/"), F.lower("p_type"))
    return (F.when(F.col("p_size") <= 10, F.concat(F.lit("http://"), path))
            .when(F.col("p_size") <= 20, F.concat(F.lit("https://"), path))
            .when(F.col("p_size") <= 30, F.concat(F.lit("https://"), path, F.lit("/")))
            .when(F.col("p_size") <= 40, F.concat(F.lit("http://"), path, F.lit("/#about")))
            .otherwise(F.concat(F.lit("http://other.example.org/a/"), F.lower(F.regexp_replace("p_brand", "#", "_")))))


def language_uri():
    code = F.col("lang")
    return (F.when(code == "en", F.concat(F.lit(EU_LANGUAGE), F.lit("ENG")))
            .when(code == "fr", F.lit("http://id.loc.gov/vocabulary/iso639-1/fr"))
            .when(code == "de", F.concat(F.lit(EU_LANGUAGE), F.lit("DEU/")))
            .otherwise(F.lit("http://lexvo.org/id/iso639-3/spa")))


SQL_TYPES = """
WITH ty AS (SELECT DISTINCT p_type, 'http://themes.example.org/' || lower(p_type) AS uri,
    CASE WHEN p_type <> 'SMALL' THEN upper(p_type[1]) || lower(p_type[2:]) || ' parts' END AS en,
    upper(p_type[1]) || lower(p_type[2:]) || 'e delar' AS sv,
    CASE WHEN p_type <> 'SMALL' THEN lower(p_type) || '_parts' ELSE 'smalle_delar' END AS slug FROM part),
pu AS (SELECT p_partkey, p_size, p_type, CASE
    WHEN p_size <= 10 THEN 'http://themes.example.org/' || lower(p_type)
    WHEN p_size <= 20 THEN 'https://themes.example.org/' || lower(p_type)
    WHEN p_size <= 30 THEN 'https://themes.example.org/' || lower(p_type) || '/'
    WHEN p_size <= 40 THEN 'http://themes.example.org/' || lower(p_type) || '/#about'
    ELSE 'http://other.example.org/a/' || lower(replace(p_brand, '#', '_')) END AS uri,
    p_size <= 40 AS held, lower(replace(p_brand, '#', '_')) AS brand FROM part)
"""


@query("label_best", SQL_TYPES + """
SELECT p_partkey AS id, CASE WHEN held THEN coalesce(en, sv) END AS label FROM pu JOIN ty USING (p_type)""")
def label_best(t):
    rows = t.part.select(F.col("p_partkey").alias("id"), part_uri(t).alias("uri"))
    found = vocabulary.with_labels(rows, "uri", type_labels(t))
    return found.select("id", vocabulary.best_label(F.col("label"), ["en"]).alias("label"))


@query("label_terms", SQL_TYPES + """
SELECT p_partkey AS id, CAST(0 AS INTEGER) AS pos, pu.uri, CASE WHEN held THEN sv END AS label
FROM pu JOIN ty USING (p_type)
UNION ALL SELECT p_partkey, 2, 'http://themes.example.org/promo', (SELECT sv FROM ty WHERE p_type = 'PROMO') FROM pu""")
def label_terms(t):
    rows = t.part.select(F.col("p_partkey").alias("id"), F.array(
        part_uri(t), F.lit(""), F.lit("http://themes.example.org/promo")).alias("uris"))
    return vocabulary.label_terms(rows, ["id"], "uris", type_labels(t))


@query("language_codes", """
SELECT doc_id AS id, CASE WHEN lang <> 'es' THEN lang END AS code FROM documents""")
def language_codes(t):
    return t.documents.select(F.col("doc_id").alias("id"), language_code(language_uri()).alias("code"))


def mixed_labels(t):
    """Part types, languages, and file types that show an extension."""
    languages = t.documents.select("lang").distinct().select(
        language_uri().alias("uri"),
        F.create_map(F.lit("en"), F.concat(F.lit("Language "), "lang")).alias("label"), F.col("lang").alias("ord"))
    brands = t.part.select("p_brand").distinct().select(
        F.concat(F.lit("application/"), F.lower("p_brand")).alias("uri"),
        F.create_map(F.lit("sv"), F.concat(F.lit("Märke "), "p_brand", F.lit(" (.x"),
                                           F.length("p_brand").cast("string"), F.lit(")"))).alias("label"),
        F.col("p_brand").alias("ord"))
    return type_labels(t).unionByName(languages).unionByName(brands)


SQL_ALIASES = SQL_TYPES + f"""
, la AS (SELECT DISTINCT lang, CASE lang WHEN 'en' THEN '{EU_LANGUAGE}ENG'
    WHEN 'fr' THEN 'http://id.loc.gov/vocabulary/iso639-1/fr' WHEN 'de' THEN '{EU_LANGUAGE}DEU/'
    ELSE 'http://lexvo.org/id/iso639-3/spa' END AS uri FROM documents),
br AS (SELECT DISTINCT p_brand, 'application/' || lower(p_brand) AS uri FROM part),
al AS (SELECT slug, uri, TRUE AS is_primary FROM ty
    UNION ALL SELECT lang, uri, TRUE FROM la WHERE lang <> 'es'
    UNION ALL SELECT 'language_' || lang, uri, lang = 'es' FROM la
    UNION ALL SELECT 'marke_' || lower(replace(p_brand, '#', '_')), uri, TRUE FROM br
    UNION ALL SELECT 'x' || length(p_brand), uri, FALSE FROM br)
"""


@query("slug_tables", SQL_ALIASES + "SELECT slug, uri, is_primary FROM al")
def slug_tables(t):
    return vocabulary.slug_aliases(mixed_labels(t)).select("slug", "uri", "is_primary")


@query("resolve_slug", SQL_ALIASES + """
, asked AS (SELECT DISTINCT upper(replace(slug, '_', ' ')) AS value, slug FROM al
            UNION SELECT DISTINCT p_name, replace(p_name, ' ', '_') FROM part)
SELECT value, uri FROM asked LEFT JOIN (SELECT DISTINCT slug, uri FROM al) USING (slug)""")
def resolve_slug(t):
    """Names to URIs; names of parts are unknown."""
    labels = mixed_labels(t)
    asked = (vocabulary.slug_aliases(labels).select(F.upper(F.replace("slug", F.lit("_"), F.lit(" "))).alias("value"))
             .unionByName(t.part.select(F.col("p_name").alias("value"))).distinct())
    return vocabulary.resolve_slugs(asked, labels).select("value", "uri")


@query("slug_label", SQL_ALIASES + """
SELECT slug, first(coalesce(ty.en, 'Language ' || la.lang) ORDER BY al.uri) AS en,
       first(coalesce(ty.sv, 'Märke ' || br.p_brand || ' (.x' || length(br.p_brand) || ')') ORDER BY al.uri) AS sv
FROM al LEFT JOIN ty USING (uri) LEFT JOIN la USING (uri) LEFT JOIN br USING (uri)
GROUP BY slug""".replace("LEFT JOIN ty USING (uri)", "LEFT JOIN (SELECT uri, en, sv FROM ty) ty USING (uri)"))
def slug_label(t):
    """Several brands share the extension as a name; the first by URI gives the label."""
    rows = vocabulary.slug_labels(mixed_labels(t).withColumn("ord", F.col("uri")))
    return rows.select("slug", F.try_element_at("label", F.lit("en")).alias("en"),
                       F.try_element_at("label", F.lit("sv")).alias("sv"))


SQL_SLUGS = SQL_TYPES + """
, named AS (SELECT p_partkey, pu.uri, CASE WHEN held THEN slug ELSE brand END AS slug
            FROM pu JOIN ty USING (p_type))
"""


@query("uri_to_slug", SQL_SLUGS + "SELECT p_partkey AS id, slug FROM named")
def uri_to_slug(t):
    rows = t.part.select(F.col("p_partkey").alias("id"), part_uri(t).alias("uri"))
    return vocabulary.with_slug(rows, "uri", type_labels(t)).select("id", "slug")


@query("slugs_of_array", SQL_SLUGS + """
SELECT p_partkey AS id, slug || CASE WHEN slug = 'promo_parts' THEN '' ELSE ',promo_parts' END AS slugs FROM named""")
def slugs_of_array(t):
    rows = t.part.select(F.col("p_partkey").alias("id"), F.array(
        part_uri(t), F.lit("http://themes.example.org/promo"), part_uri(t), F.lit(None).cast("string")).alias("uris"))
    return vocabulary.distinct_slugs(rows, ["id"], "uris", type_labels(t)).select(
        "id", F.array_join("slugs", ",").alias("slugs"))


@query("licence_struct", SQL_SLUGS + """
SELECT p_partkey AS id, CASE WHEN p_size % 1 = 0 AND p_size > 5 THEN slug END AS licence,
       CASE WHEN held AND p_size > 5 THEN en END AS label,
       lower(p_type) AS themes FROM named JOIN pu USING (p_partkey) JOIN ty USING (p_type)""".replace("p_size % 1 = 0 AND ", "")
       .replace("JOIN pu USING (p_partkey) JOIN ty USING (p_type)", "JOIN (SELECT p_partkey, p_size, held, p_type FROM pu) USING (p_partkey) JOIN (SELECT p_type, en FROM ty) USING (p_type)"))
def licence_struct(t):
    """Licence, themes and a single term of every record, named in one go."""
    rows = t.part.select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 5, part_uri(t)).alias("license_uri"),
        F.array(F.concat(F.lit("http://x.example.org/"), F.lower("p_type"))).alias("theme_uris"))
    named = vocabulary.resolve_terms(rows, ["id"], type_labels(t), ["license", "themes"])
    return named.select("id", F.col("license.id").alias("licence"),
                        F.try_element_at("license.label", F.lit("en")).alias("label"),
                        F.array_join("themes", ",").alias("themes"))


@query("merge_labels", """
SELECT 'urn:' || n_nationkey AS uri,
    CASE WHEN n_nationkey < 3 OR n_regionkey = 4 THEN 'own ' || n_name
         WHEN n_regionkey <= 1 THEN CASE WHEN n_regionkey = 0 THEN n_name || ' t' END
         WHEN n_regionkey = 2 THEN n_name || ' g'
         ELSE 'd' || n_name END AS en,
    CASE WHEN n_regionkey <= 1 THEN 'sv ' || n_name || ' t' WHEN n_regionkey = 2 THEN n_name || ' g' END AS sv
FROM nation""")
def merge_labels(t):
    """Nations in four sources: choice lists, a gazetteer, fetched documents, and our own."""
    uri, name, region = F.concat(F.lit("urn:"), "n_nationkey").alias("uri"), F.col("n_name"), F.col("n_regionkey")

    def source(keep, **texts):
        pairs = F.create_map(*[x for k, v in texts.items() for x in (F.lit(k), v)])
        return t.nation.filter(keep).select(uri, F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("label"))

    rows = vocabulary.merge_labels(
        source(region <= 1, sv=F.concat(F.lit("sv "), name, F.lit(" t")),
               en=F.when(region == 0, F.concat(name, F.lit(" t")))),
        source(region <= 2, sv=F.concat(name, F.lit(" g")), en=F.concat(name, F.lit(" g"))),
        source(F.lit(True), en=F.concat(F.lit("d"), name)),
        source((F.col("n_nationkey") < 3) | (region == 4), en=F.concat(F.lit("own "), name)))
    return rows.select("uri", F.try_element_at("label", F.lit("en")).alias("en"),
                       F.try_element_at("label", F.lit("sv")).alias("sv"))


@query("gazetteer", """
SELECT 'https://sws.geonames.org/' || c_custkey || '/about.rdf' AS uri, s_name AS sv, s_name AS en
FROM customer JOIN supplier ON c_custkey = s_suppkey""")
def gazetteer(t):
    uris = (t.customer.select(F.concat(F.lit("https://sws.geonames.org/"), "c_custkey", F.lit("/about.rdf")).alias("uri"))
            .unionByName(t.customer.select(F.concat(F.lit("urn:x:"), "c_custkey").alias("uri"))))
    names = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    return vocabulary.gazetteer_labels(uris, names).select(
        "uri", F.try_element_at("label", F.lit("sv")).alias("sv"), F.try_element_at("label", F.lit("en")).alias("en"))


@query("known_values", SQL_ALIASES + """
SELECT DISTINCT 'format' AS filter, slug FROM al WHERE uri LIKE 'application/%' AND contains(slug, 'marke_brand_1')
UNION ALL SELECT DISTINCT 'language', slug FROM al WHERE uri LIKE 'http://%' AND slug IN ('en', 'fr', 'de')
UNION ALL SELECT DISTINCT 'any', slug FROM al""")
def known_values(t):
    labels = mixed_labels(t)

    def listed(name, rows):
        return rows.select(F.lit(name).alias("filter"), "slug")

    return (listed("format", vocabulary.known_values(labels, "format", prefix="Märke Brand 1"))
            .unionByName(listed("language", vocabulary.known_values(labels, "language")))
            .unionByName(listed("any", vocabulary.known_values(labels))))


@query("known_publishers", """
SELECT lower(n_name) AS name FROM nation UNION SELECT 'se' || (n_nationkey + 2020000000) FROM nation
UNION SELECT 'n_' || n_nationkey FROM nation WHERE n_regionkey <> 0""")
def known_publishers(t):
    return vocabulary.known_publishers(nation_publishers(t))


@query("alias_collisions", """
SELECT 'shared' AS alias, count(*) AS claims, FALSE AS taken FROM nation WHERE n_regionkey = 0
UNION ALL SELECT 'nation_' || s_nationkey, count(*), TRUE FROM supplier GROUP BY ALL""")
def alias_collisions(t):
    """An alias several claim, and one that is somebody's id."""
    thief = t.supplier.select(
        F.lower("s_name").alias("id"), F.lit("urn:s").alias("uri"),
        F.concat(F.lit("Nation "), "s_nationkey").alias("alias"),
        F.lit(None).cast("string").alias("org_no"))
    return vocabulary.publisher_aliases(nation_publishers(t).unionByName(thief))[1]


def part_entries(t):
    graph = graph_text([(F.concat(F.lit("https://p.example.org/"), "p_partkey"), {
        "dcat:theme": [reference(part_uri(t))],
        "dcterms:language": [reference(F.concat(F.lit("urn:lang:"), "p_size"))],
        "dcterms:format": [literal(F.col("p_type")), reference(F.concat(F.lit("http://f.example.org/"), F.lower("p_type")))],
        "dcterms:title": [literal(F.concat(F.lit("http://not-a-value/"), "p_name"))],
        "dcat:landingPage": [reference(F.concat(F.lit("http://land.example.org/"), "p_partkey"))]})])
    return entries_of(t.part, F.col("p_partkey"), graph)


@query("uris_in_use", SQL_TYPES + """
SELECT DISTINCT uri FROM pu UNION SELECT DISTINCT 'http://f.example.org/' || lower(p_type) FROM part""")
def uris_in_use(t):
    return vocabulary.uris_in_use(triples(part_entries(t)))


@query("unlabelled_uris", SQL_TYPES + """
SELECT DISTINCT uri FROM pu WHERE uri NOT IN (SELECT uri FROM ty)
UNION SELECT DISTINCT 'http://f.example.org/' || lower(p_type) FROM part""")
def unlabelled_uris(t):
    return vocabulary.unlabelled(uris_in_use(t), type_labels(t))


def used_values(t):
    return (t.part.select(F.lit("themes").alias("field"), part_uri(t).alias("uri"))
            .unionByName(t.documents.select(F.lit("languages").alias("field"), language_uri().alias("uri"))))


@query("label_coverage", SQL_TYPES + """
, x AS (SELECT 'themes' AS field, held FROM pu UNION ALL SELECT 'languages', FALSE FROM documents)
SELECT coalesce(field, 'TOTAL') AS field, CAST(count(*) FILTER (held) AS BIGINT) AS labelled, count(*) AS total
FROM x GROUP BY ROLLUP (field)""")
def label_coverage(t):
    return vocabulary.coverage(used_values(t), type_labels(t))


SQL_UNLABELLED = SQL_TYPES + f"""
, x AS (SELECT uri FROM pu WHERE NOT held UNION ALL SELECT CASE lang WHEN 'en' THEN '{EU_LANGUAGE}ENG'
        WHEN 'fr' THEN 'http://id.loc.gov/vocabulary/iso639-1/fr' WHEN 'de' THEN '{EU_LANGUAGE}DEU/'
        ELSE 'http://lexvo.org/id/iso639-3/spa' END FROM documents)
"""


@query("unlabelled_top", SQL_UNLABELLED + """
SELECT 'parent' AS by, * FROM (SELECT regexp_replace(uri, '/[^/]*$', '') AS "group", count(*) AS occurrences
    FROM x GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 8)
UNION ALL SELECT 'host', * FROM (SELECT lower(regexp_extract(uri, '^[a-z]+://([^/]*)', 1)), count(*)
    FROM x GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 12)""")
def unlabelled_top(t):
    values, labels = used_values(t).select("uri"), type_labels(t)

    def by(name, n):
        return vocabulary.unlabelled_groups(values, labels, name, n).select(F.lit(name).alias("by"), "group", "occurrences")

    return by("parent", 8).unionByName(by("host", 12))


@query("nearest_value", """
WITH asked AS (SELECT DISTINCT substr(p_name, 2) AS value FROM part UNION SELECT DISTINCT replace(p_brand, 'ra', 'r') FROM part
               UNION SELECT DISTINCT split_part(p_name, ' ', 1) FROM part),
known AS (SELECT DISTINCT p_name AS known FROM part UNION SELECT DISTINCT p_brand FROM part),
c AS (SELECT value, known, round(1 - levenshtein(value, known) / greatest(length(value), length(known)), 6) AS similarity
      FROM asked, known),
close AS (SELECT *, row_number() OVER (PARTITION BY value ORDER BY similarity DESC, known DESC) AS rank FROM c WHERE similarity >= 0.7),
held AS (SELECT value, known, NULL AS similarity, row_number() OVER (PARTITION BY value ORDER BY known) AS rank FROM c
         WHERE contains(known, value) AND value NOT IN (SELECT value FROM close))
SELECT value, known, CAST(rank AS INTEGER) AS rank FROM close WHERE rank <= 3
UNION ALL SELECT value, known, CAST(rank AS INTEGER) FROM held WHERE rank <= 3""")
def nearest_value(t):
    asked = (t.part.select(F.expr("substring(p_name, 2)").alias("value"))
             .unionByName(t.part.select(F.replace("p_brand", F.lit("ra"), F.lit("r")).alias("value")))
             .unionByName(t.part.select(F.substring_index("p_name", " ", 1).alias("value"))))
    known = t.part.select(F.col("p_name").alias("known")).union(t.part.select("p_brand"))
    return vocabulary.nearest_known(asked, known).select("value", "known", "rank")


@query("sample_fixed", """
SELECT doc_id, lang, source FROM documents ORDER BY md5('20260922|' || doc_id), doc_id LIMIT 500""")
def sample_fixed(t):
    """The same 500 documents for the same seed."""
    return vocabulary.seeded_sample(t.documents.select("doc_id", "lang", "source"), ["doc_id"], 500, seed=20260922)
