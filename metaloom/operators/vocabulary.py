"""Controlled vocabularies: labels, short names and coverage.

A vocabulary is a small table `(uri, label MAP<lang, text>, ord)`; `ord` is its written order.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metaloom.constants import (FILTER_VOCABULARIES, FIXED_SLUGS, GAZETTEER_ID, LANGUAGES,
                                VOCABULARY_PREDICATES, iri)
from metaloom.functions.literals import literal_map
from metaloom.functions.text import nullif_empty, slugify
from metaloom.functions.uris import (host_of, is_plain_spelling, language_code, last_segment, spelling_key,
                                     uri_spellings)
from metaloom.operators.joins import left_lookup


# --- looking URIs up ---------------------------------------------------------

def spelled_lookup(rows: DataFrame, uri, table: DataFrame, payload) -> DataFrame:
    """Left join `rows` to a table keyed by URI, whichever way the URI is spelled.

    The URI as given comes first, then its spellings in order. Spellings share a key, so this is
    two equi-joins on unique keys: rows are not multiplied by their spellings. Each different URI is
    spelled and looked up once, however many rows name it. `payload` names the columns of `table` to add.
    """
    asked = rows.select(F.col(uri).alias("_asked")).filter(F.col("_asked").isNotNull()).distinct()
    found = _looked_up(asked, "_asked", table, payload).select("_asked", F.struct(*payload).alias("_found"))
    joined = left_lookup(rows.withColumn("_asked", F.col(uri)), found, "_asked").drop("_asked")
    return joined.select(*rows.columns, *[F.col(f"_found.{name}").alias(name) for name in payload])


def _looked_up(rows, uri, table, payload) -> DataFrame:
    """`spelled_lookup`, row by row."""
    value = F.struct(*payload)
    exact = table.select(F.col("uri").alias("_uri"), value.alias("_exact")).dropDuplicates(["_uri"])
    # Only a spelling without fragment or page suffix can be met by another spelling, so an
    # entry of this list differs by scheme and slashes alone.
    plain = table.filter(is_plain_spelling("uri"))
    near = plain.groupBy(spelling_key("uri").alias("_key")).agg(
        F.collect_list(F.struct(F.col("uri").alias("uri"), value.alias("value"))).alias("_near"))
    keyed = rows.withColumn("_uri", F.col(uri)).withColumn("_key", spelling_key("_uri"))
    joined = left_lookup(left_lookup(keyed, exact, "_uri"), near, "_key")
    hits = F.transform(uri_spellings("_uri"), lambda s: F.try_element_at(
        F.filter("_near", lambda n: n["uri"] == s), F.lit(1)))
    first_hit = F.try_element_at(F.filter(hits, lambda h: h.isNotNull()), F.lit(1))["value"]
    found = F.coalesce(F.col("_exact"), F.when(F.col("_near").isNotNull(), first_hit))
    return (joined.withColumn("_found", found)
            .select(*rows.columns, *[F.col(f"_found.{name}").alias(name) for name in payload]))


def with_labels(rows: DataFrame, uri, labels: DataFrame) -> DataFrame:
    """Adds `label`, the language map of a URI under any of its spellings."""
    held = labels.filter(F.size("label") > 0)
    return spelled_lookup(rows, uri, held, ["label"])


def best_label(label, languages=LANGUAGES) -> Column:
    """One label: the asked languages, then the usual two, then any. Null, never a guess."""
    wanted = list(dict.fromkeys([*languages, *LANGUAGES]))
    return F.coalesce(*[F.try_element_at(label, F.lit(tag)) for tag in wanted],
                      F.try_element_at(F.map_values(label), F.lit(1)))


def label_terms(rows: DataFrame, keys, uris, labels: DataFrame, languages=LANGUAGES) -> DataFrame:
    """`{uri, label}` of every non-empty URI of an array, in order, one row each."""
    terms = rows.select(*keys, F.posexplode(uris).alias("pos", "uri")).filter(F.col("uri") != "")
    return (with_labels(terms, "uri", labels)
            .select(*keys, "pos", "uri", best_label(F.col("label"), languages).alias("label")))


# --- short names -------------------------------------------------------------

def slug_aliases(labels: DataFrame) -> DataFrame:
    """`(slug, uri, ord, is_primary)`: every name a labelled term answers to.

    A term's own name is its ISO code where it is a language, a fixed name where it has one, and
    else its English label, or its Swedish one, as a short name. A language also answers to its
    label, and a file type to the extension its label shows.
    """
    label = F.coalesce(nullif_empty(F.try_element_at("label", F.lit("en"))),
                       nullif_empty(F.try_element_at("label", F.lit("sv"))))
    fixed = literal_map(FIXED_SLUGS)
    named = (labels.select("uri", "ord", label.alias("_label"), language_code("uri").alias("_code"))
             .withColumn("_slug", F.coalesce(F.try_element_at(fixed, F.col("uri")),
                                             slugify("_label")))
             .filter(F.col("_slug") != ""))
    extension = slugify(F.regexp_extract("_label", "\\(\\s*\\.([A-Za-z0-9]{1,8})\\s*\\)", 1))
    primary = F.coalesce("_code", "_slug")
    names = F.array_distinct(F.filter(F.array(
        primary, F.col("_slug"), F.when(F.col("_code").isNull(), extension)),
        lambda n: n.isNotNull() & (n != "")))
    return named.select(F.explode(names).alias("slug"), "uri", "ord", primary.alias("_own")).select(
        "slug", "uri", "ord", (F.col("slug") == F.col("_own")).alias("is_primary"))


def term_slugs(labels: DataFrame) -> DataFrame:
    """`(uri, slug)`: the own name of every labelled term."""
    return slug_aliases(labels).filter("is_primary").select("uri", "slug")


def with_slug(rows: DataFrame, uri, labels: DataFrame, into="slug") -> DataFrame:
    """Adds the short name of a URI: the vocabulary's, a language code, else its last segment."""
    terms = rows.select(F.col(uri).alias("_term")).filter(F.col("_term") != "").distinct()
    found = _looked_up(terms, "_term", term_slugs(labels).withColumnRenamed("slug", "_slug"), ["_slug"])
    named = found.select("_term", F.coalesce(
        "_slug", language_code("_term"), nullif_empty(slugify(last_segment("_term")))).alias(into))
    return left_lookup(rows.withColumn("_term", F.col(uri)).drop(into), named, "_term").drop("_term")


def resolve_slugs(requested: DataFrame, labels: DataFrame, value="value") -> DataFrame:
    """The URIs each requested value stands for; null where it is no known term."""
    wanted = requested.withColumn("slug", slugify(value))
    return wanted.join(slug_aliases(labels).select("slug", "uri"), "slug", "left")


def slug_labels(labels: DataFrame) -> DataFrame:
    """`(slug, label)`: the label of the first of a name's URIs that has one, both languages."""
    kept = F.map_filter("label", lambda k, _: k.isin(*LANGUAGES))
    named = slug_aliases(labels).join(labels.select("uri", "label"), "uri")
    return (named.filter(F.size("label") > 0)
            .groupBy("slug").agg(F.min_by("label", F.struct("ord", "uri")).alias("label"))
            .select("slug", kept.alias("label")))


def distinct_slugs(rows: DataFrame, keys, uris, labels: DataFrame) -> DataFrame:
    """`(*keys, slugs)`: an array of URIs as distinct short names, order kept."""
    exploded = rows.select(*keys, F.posexplode(uris).alias("pos", "uri"))
    named = with_slug(exploded, "uri", labels).filter(F.col("slug").isNotNull())
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "slug"))),
                          lambda t: t["slug"])
    return named.groupBy(*keys).agg(F.array_distinct(ordered).alias("slugs"))


# Field of a record -> the URI column it is named from. Arrays end in `_uris`.
TERM_FIELDS = {
    "themes": "theme_uris", "languages": "language_uris", "spatial": "spatial_uris",
    "license": "license_uri", "access_rights": "access_rights_uri",
    "accrual_periodicity": "accrual_periodicity_uri", "service_type": "service_type_uri",
    "format": "format_uri", "status": "status_uri", "availability": "availability_uri",
    "type": "type_uri", "publisher_type": "publisher.type_uri",
}


def resolve_terms(records: DataFrame, keys, labels: DataFrame, fields) -> DataFrame:
    """Names every vocabulary field of the records at once.

    All URIs of a record become rows of one narrow table, which is looked up once and gathered
    again by the record's key: two exchanges on that key however many fields there are. A licence
    becomes `{id, label, uri}`; a field ending in `_uris` an array; any other a single name.
    `keys` must identify a row.
    """
    def as_array(source):
        column = F.col(source)
        return column if source.endswith("_uris") else F.array(column)

    def pieces_of(field):
        return F.transform(as_array(TERM_FIELDS[field]), lambda u, i: F.struct(
            F.lit(field).alias("field"), i.alias("pos"), u.alias("term")))

    parts = [pieces_of(f) for f in fields]
    pieces = F.filter(F.concat(*[F.coalesce(p, F.array().cast(
        "array<struct<field:string,pos:int,term:string>>")) for p in parts]),
        lambda t: t["term"].isNotNull())
    rows = records.select(*keys, F.explode(pieces).alias("t")).select(*keys, "t.*")
    named = with_slug(rows, "term", labels)
    if "license" in fields:
        licence_label = slug_labels(labels).withColumnRenamed("label", "_label")
        named = named.withColumn("_licence", F.when(F.col("field") == "license", F.col("slug")))
        named = left_lookup(named, licence_label.withColumnRenamed("slug", "_licence"),
                            "_licence", keys)
    else:
        named = named.withColumn("_label", F.create_map().cast("map<string,string>"))
    terms = named.groupBy(*keys).agg(F.collect_list(
        F.struct("field", "pos", "slug", F.col("_label").alias("label"))).alias("_terms"))
    joined = records.join(terms, list(keys), "left")

    def of(field):
        held = F.filter("_terms", lambda t: t["field"] == field)
        return F.array_sort(held, lambda a, b: a["pos"] - b["pos"])

    columns = []
    for field in fields:
        if TERM_FIELDS[field].endswith("_uris"):
            names = F.filter(F.transform(of(field), lambda t: t["slug"]), lambda s: s.isNotNull())
            column = F.coalesce(F.array_distinct(names), F.array().cast("array<string>"))
        elif field == "license":
            one = F.try_element_at(of(field), F.lit(1))
            none = F.create_map().cast("map<string,string>")
            column = F.when(F.col("license_uri").isNotNull(), F.struct(
                one["slug"].alias("id"), F.coalesce(one["label"], none).alias("label"),
                F.col("license_uri").alias("uri")))
        else:
            column = F.try_element_at(of(field), F.lit(1))["slug"]
        columns.append(column.alias(field))
    dropped = {TERM_FIELDS[f] for f in fields}
    kept = [c for c in records.columns if c not in dropped and c not in fields]
    return joined.select(*kept, *columns)


# --- building the vocabulary -------------------------------------------------

def merge_labels(templates, gazetteer, dereferenced, overrides) -> DataFrame:
    """One label map per URI. The first of the three sources that knows a URI gives its labels;
    our own labels go over them, language by language. Each input is `(uri, label)`, and where a
    source may list a URI twice, a number `ord`: its last row counts."""
    ranked = [df.select("uri", "label", F.lit(rank).alias("rank"),
                        (-F.col("ord") if "ord" in df.columns else F.lit(0)).cast("double").alias("ord"),
                        F.to_json(F.array_sort(F.map_entries("label"))).alias("told"))
              for rank, df in enumerate((templates, gazetteer, dereferenced, overrides))]
    rows = ranked[0]
    for more in ranked[1:]:
        rows = rows.unionByName(more)
    own = F.when(F.col("rank") == 3, F.col("label"))
    empty = F.create_map().cast("map<string,string>")
    merged = rows.groupBy("uri").agg(
        F.min_by("label", F.when(F.col("rank") < 3, F.struct("rank", "ord", "told"))).alias("base"),
        F.min_by(own, F.when(F.col("rank") == 3, F.struct("ord", "told"))).alias("own"))
    base, over = F.coalesce("base", empty), F.coalesce("own", empty)
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k))
    return merged.select("uri", F.map_concat(kept, over).alias("label"))


def gazetteer_labels(uris: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Labels of the place URIs whose number the gazetteer `(id, name)` holds, one name for both
    languages."""
    places = (uris.select("uri", F.regexp_extract("uri", GAZETTEER_ID, 1).alias("id"))
              .filter(F.col("id") != ""))
    return places.join(gazetteer, "id").select("uri", F.create_map(
        F.lit("sv"), F.col("name"), F.lit("en"), F.col("name")).alias("label"))


def with_order(labels: DataFrame) -> DataFrame:
    """Adds `ord`. A built vocabulary is written in URI order, so the URI is its own order."""
    return labels.withColumn("ord", F.col("uri"))


# --- what is known -----------------------------------------------------------

def known_values(labels: DataFrame, filter_name=None, prefix=None) -> DataFrame:
    """The short names a filter takes, or all of them, in order."""
    aliases = slug_aliases(labels)
    if filter_name is not None:
        backed = F.lit(False)
        for start in FILTER_VOCABULARIES[filter_name]:
            backed = backed | F.startswith("uri", F.lit(start))
        aliases = aliases.filter(backed)
        if filter_name == "language":
            aliases = aliases.filter(language_code("uri") == F.col("slug"))
    if prefix:
        aliases = aliases.filter(F.contains("slug", slugify(F.lit(prefix))))
    return aliases.select("slug").distinct().orderBy("slug")


def publisher_aliases(publishers: DataFrame):
    """(accepted, rejected) aliases of the publisher table `(id, uri, alias, org_no)`.

    An alias claimed twice, or equal to an id or an organisation number, names nobody. Claims and
    names that are taken are counted side by side, in one pass."""
    held = F.col("uri").isNotNull()
    uses = F.array(*[F.struct(name.alias("alias"), F.when(F.lit(not taken), F.col("id")).alias("id"), F.lit(taken).alias("taken"))
                     for name, taken in ((slugify("alias"), False), (F.when(held, F.col("id")), True),
                                         (F.when(held, F.col("org_no")), True))])
    counted = (publishers.select(F.inline(uses)).filter(F.col("alias") != "").groupBy("alias")
               .agg(F.count("id").alias("claims"), F.min("id").alias("id"), F.max("taken").alias("taken"))
               .filter(F.col("claims") > 0))
    clashes = (F.col("claims") > 1) | F.col("taken")
    return (counted.filter(~clashes).select("alias", "id"),
            counted.filter(clashes).select("alias", "claims", "taken"))


def known_publishers(publishers: DataFrame, prefix=None) -> DataFrame:
    """Every publisher name that resolves: ids, organisation numbers and aliases, in order."""
    held = publishers.filter(F.col("uri").isNotNull())
    names = (held.select(F.col("id").alias("name"))
             .unionByName(held.select(F.col("org_no").alias("name")))
             .unionByName(publisher_aliases(publishers)[0].select(F.col("alias").alias("name")))
             .filter(F.col("name").isNotNull()))
    if prefix:
        names = names.filter(F.contains("name", slugify(F.lit(prefix))))
    return names.distinct().orderBy("name")


def _bigrams(text):
    """Distinct pairs of neighbouring characters."""
    last = F.greatest(F.length(text) - 1, F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), last),
                                        lambda i: F.substring(text, i, F.lit(2))))


def nearest_known(requested: DataFrame, known: DataFrame, n=3, cutoff=0.7) -> DataFrame:
    """Up to `n` known names close to each requested one, or holding it where none is close.

    Closeness is 1 - edit distance / longer length. Two names that close share a pair of
    neighbouring characters once the longer has four (at most 3/10 of it is edited, and an edit
    spoils two pairs), and differ in length by at most the distance, so candidates come from an
    equi-join on (pair, length) and nothing is missed; shorter names are close only when equal.
    """
    requested = requested.select("value").distinct()
    known = known.select("known").distinct()
    length = F.length("value")
    widths = F.sequence(F.ceil(length * F.lit(cutoff)).cast("int"),
                        F.floor(length / F.lit(cutoff)).cast("int"))
    asked = (requested.select("value", F.explode(_bigrams(F.col("value"))).alias("gram"))
             .withColumn("width", F.explode(widths)))
    held = known.select("known", F.length("known").alias("width"),
                        F.explode(_bigrams(F.col("known"))).alias("gram"))
    longer = F.greatest(F.length("value"), F.length("known"))
    similarity = 1 - F.levenshtein("value", "known") / longer
    close = (asked.join(held, ["gram", "width"]).select("value", "known").distinct()
             .withColumn("similarity", F.round(similarity, 6))
             .filter(F.col("similarity") >= cutoff))
    # Names that hold the value share its first pair, or its only character.
    characters = F.array_distinct(F.filter(F.split("known", ""), lambda c: c != ""))
    parts = known.select("known", F.explode(F.array_union(
        _bigrams(F.col("known")), characters)).alias("gram"))
    holding = (requested.join(close.select("value").distinct(), "value", "left_anti")
               .filter(length > 0).withColumn("gram", F.substring("value", 1, 2))
               .join(parts, "gram").filter(F.contains("known", F.col("value")))
               .select("value", "known", F.lit(None).cast("double").alias("similarity")))
    best_first = Window.partitionBy("value").orderBy(F.desc("similarity"), F.desc("known"))
    by_name = Window.partitionBy("value").orderBy("known")
    top = close.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= n)
    rest = holding.withColumn("rank", F.row_number().over(by_name)).filter(F.col("rank") <= n)
    return top.unionByName(rest)


# --- coverage ----------------------------------------------------------------

def uris_in_use(triples: DataFrame, predicates=VOCABULARY_PREDICATES) -> DataFrame:
    """Distinct web URIs that vocabulary predicates point at."""
    wanted = [iri(p) for p in predicates]
    return (triples.filter(F.col("p").isin(wanted) & F.startswith("o_value", F.lit("http"))
                           & (F.col("o_type") == "uri"))
            .select(F.col("o_value").alias("uri")).distinct())


def unlabelled(uris: DataFrame, labels: DataFrame) -> DataFrame:
    """URIs in use that the vocabulary does not list."""
    return uris.join(labels.select("uri"), "uri", "left_anti")


def coverage(values: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled and total occurrences per field of `(field, uri)`, with a total row.

    Occurrences are counted per (field, URI) before the lookup, so a URI on a third of all rows
    is looked up once."""
    counted = values.groupBy("field", "uri").agg(F.count("*").alias("n"))
    found = with_labels(counted, "uri", labels)
    held = F.when(F.size("label") > 0, F.col("n")).otherwise(0)
    return (found.rollup("field").agg(F.sum(held).alias("labelled"), F.sum("n").alias("total"))
            .withColumn("field", F.coalesce("field", F.lit("TOTAL"))))


def unlabelled_groups(values: DataFrame, labels: DataFrame, by="parent", n=8) -> DataFrame:
    """The commonest groups of unlabelled occurrences, by URI parent or by host."""
    counted = values.groupBy("uri").agg(F.count("*").alias("n"))
    missing = with_labels(counted, "uri", labels).filter(F.col("label").isNull())
    group = (host_of(F.col("uri")) if by == "host"
             else F.regexp_replace("uri", "/[^/]*$", ""))
    return (missing.groupBy(group.alias("group")).agg(F.sum("n").alias("occurrences"))
            .orderBy(F.desc("occurrences"), "group").limit(n))


def seeded_sample(rows: DataFrame, keys, n, seed) -> DataFrame:
    """Exactly `n` rows (or all, if there are fewer), the same ones for the same seed."""
    place = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return rows.orderBy(place, *keys).limit(n)
