"""RDF/JSON graphs: row-local accessors over the graph map, and the long triple form.

An entry's graph fits its row, so reading properties off it needs no shuffle: the accessors are
plain columns. Triples are for work that crosses entries.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaloom import schemas
from metaloom.constants import (ENTITY_TYPES, LANGUAGES, OTHER_TYPES, RDF_TYPE, TYPE_PRIORITY,
                                iri)
from metaloom.functions import typed
from metaloom.functions.text import fold_language, let
from metaloom.functions.uris import expand_curie, shorten_uri
from metaloom.operators.computed import computed

NODE_KINDS = ("uri", "bnode", "literal")
NODES = "array<struct<type:string,value:string,lang:string,datatype:string>>"


def first(items) -> Column:
    return F.try_element_at(items, F.lit(1))


def is_blank_node(subject) -> Column:
    return F.startswith(subject, F.lit("_:"))


def parse_graph(text) -> Column:
    """RDF/JSON text as a GRAPH; null for text that is not one.

    Text with nothing to put right, no second place for a language, no empty language and no null, is
    read into its final shape at once.
    """
    raw = F.from_json(text, schemas.RAW_GRAPH)
    odd = (F.contains(text, F.lit("xml:lang")) | F.contains(text, F.lit("null")) | F.contains(text, F.lit("\\u"))
           | (F.contains(text, F.lit('""')) & text.rlike('"lang"\\s*:\\s*""')))

    def node(o):
        language = F.coalesce(F.when(o["lang"] != "", o["lang"]), o["xml:lang"])
        return F.struct(o["type"].alias("type"), o["value"].alias("value"),
                        language.alias("lang"), o["datatype"].alias("datatype"))

    whole = F.transform_values(raw, lambda _, ps: F.transform_values(
        F.coalesce(ps, F.create_map().cast("map<string,array<struct<type:string,value:string,"
                                           "lang:string,`xml:lang`:string,datatype:string>>>")),
        lambda _, os: F.transform(os, node)))
    return F.when(odd, whole).otherwise(F.from_json(text, schemas.GRAPH))


def empty_graph() -> Column:
    return F.create_map().cast(f"map<string,map<string,{NODES}>>")


# --- one subject -------------------------------------------------------------

def described(graph, subject) -> Column:
    """`{predicate: [object]}` of one subject, null where the graph does not describe it."""
    return F.try_element_at(graph, subject)


def objects(node, predicate) -> Column:
    """Objects of one predicate, in order; empty where there are none. `node` may be a dict of them."""
    if isinstance(node, dict):
        return node[predicate]
    key = F.lit(iri(predicate) if "://" not in predicate else predicate)
    return F.coalesce(F.try_element_at(node, key), F.array().cast(NODES))


def _few(nodes, kind, none, one, two, rest) -> Column:
    """`none` where there is no object, `one` or `two` of the only ones where these are of the kind, else `rest`.

    Most properties have two objects at most, one a language, which needs no function per element. Where `two`
    is null, `rest` is asked.
    """
    a, b = F.get(nodes, F.lit(0)), F.get(nodes, F.lit(1))
    found = F.when(F.size(nodes) == 0, none).when((F.size(nodes) == 1) & (a["type"] == kind), one(a))
    if two is not None:
        found = found.when((F.size(nodes) == 2) & (a["type"] == kind) & (b["type"] == kind), F.coalesce(two(a, b), rest))
    return found.otherwise(rest)


def _no_texts():
    return F.array().cast("array<string>")


def literals(nodes) -> Column:
    return F.filter(nodes, lambda o: o["type"] == "literal")


def uris(nodes) -> Column:
    found = F.transform(F.filter(nodes, lambda o: o["type"] == "uri"), lambda o: o["value"])
    return _few(nodes, "uri", _no_texts(), lambda o: F.array(o["value"]), lambda a, b: F.array(a["value"], b["value"]), found)


def first_uri(nodes) -> Column:
    head = F.get(nodes, F.lit(0))
    return (F.when(F.size(nodes) == 0, F.lit(None).cast("string"))
            .when(head["type"] == "uri", head["value"]).otherwise(first(uris(nodes))))


def primary_tag(tag) -> Column:
    return F.lower(F.split(tag, "-")[0])


def values(nodes, language=None) -> Column:
    """Literal values, of one language only where one is asked for."""
    found = literals(nodes)
    if language is not None:
        found = F.filter(
            found, lambda o: primary_tag(F.coalesce(o["lang"], F.lit(""))) == language.lower())
    texts = F.transform(found, lambda o: o["value"])
    return texts if language is not None else _few(
        nodes, "literal", _no_texts(), lambda o: F.array(o["value"]), lambda a, b: F.array(a["value"], b["value"]), texts)


def pick_language(nodes, languages=LANGUAGES) -> Column:
    """One literal value: per language its exact tag, then a regional variant; then an untagged
    literal; then the first."""
    def picked(found):
        def first_where(test):
            return first(F.filter(found, test))["value"]

        choices = []
        for language in languages:
            choices.append(first_where(lambda o: o["lang"] == language))
            choices.append(first_where(lambda o: primary_tag(o["lang"]) == language.lower()))
        return F.coalesce(*choices, first_where(lambda o: o["lang"].isNull()), first(found)["value"])

    return _few(nodes, "literal", F.lit(None).cast("string"), lambda o: o["value"], None, let(literals(nodes), picked))


def first_per(items, key) -> Column:
    """The items that are the first of their key, in order."""
    def kept(held):
        keys = F.transform(held, lambda x: F.coalesce(key(x), F.lit("\u0000")))
        return let(keys, lambda ks: F.filter(held, lambda x, i: F.array_position(ks, F.element_at(ks, i + 1)) == i + 1))

    return let(items, lambda held: F.when(F.size(held) < 2, held).otherwise(kept(held)))


def localized(nodes) -> Column:
    """The first literal of each language tag, as structs in order of appearance."""
    return first_per(literals(nodes), lambda o: o["lang"])


def localized_map(nodes) -> Column:
    """`{tag: value}` with an empty key for untagged text."""
    return F.map_from_entries(F.transform(
        localized(nodes),
        lambda o: F.struct(F.coalesce(o["lang"], F.lit("")).alias("key"), o["value"].alias("value"))))


def text_map(nodes) -> Column:
    """Localized text folded to two languages; empty texts dropped, the first of a key wins."""
    kept = F.filter(localized(nodes), lambda o: o["value"] != "")
    pairs = F.transform(kept, lambda o: F.struct(
        fold_language(o["lang"]).alias("key"), o["value"].alias("value")))
    several = F.map_from_entries(first_per(pairs, lambda p: p["key"]))
    empty = F.create_map().cast("map<string,string>")

    def one(o):
        return F.when(o["value"] != "", F.create_map(fold_language(o["lang"]), o["value"])).otherwise(empty)

    def two(a, b):
        """The later one counts where it has a tag of its own and, beside an earlier one that counts, a key of its own."""
        keys = fold_language(a["lang"]), fold_language(b["lang"])
        later = (b["value"] != "") & ~a["lang"].eqNullSafe(b["lang"])
        return (F.when(~F.coalesce(later, F.lit(False)), one(a))
                .when(~F.coalesce(a["value"] != "", F.lit(False)), one(b))
                .when(keys[0] == keys[1], one(a))
                .otherwise(F.create_map(keys[0], a["value"], keys[1], b["value"])))

    return _few(nodes, "literal", empty, one, two, several)


def word_map(nodes) -> Column:
    """Lists per language folded to two: the first tag's list as it is, then what later tags of
    the same language add."""
    tagged = F.transform(literals(nodes), lambda o: F.struct(
        fold_language(o["lang"]).alias("key"), F.coalesce(o["lang"], F.lit("")).alias("tag"),
        o["value"].alias("value")))

    def lists(words):
        def merged(key):
            def of_tag(tag):
                return F.transform(F.filter(words, lambda o: (o["key"] == key) & (o["tag"] == tag)), lambda o: o["value"])

            def joined(tags):
                later = F.flatten(F.transform(F.slice(tags, F.lit(2), F.greatest(F.size(tags) - 1, F.lit(0))), of_tag))
                return F.aggregate(
                    later, of_tag(F.element_at(tags, 1)),
                    lambda held, item: F.when(F.array_contains(held, item), held)
                    .otherwise(F.array_append(held, item)))

            return let(F.array_distinct(F.transform(F.filter(words, lambda o: o["key"] == key), lambda o: o["tag"])), joined)

        keys = F.array_distinct(F.transform(words, lambda o: o["key"]))
        return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), merged(k).alias("value"))))

    empty = F.create_map().cast("map<string,array<string>>")

    def two(a, b):
        keys = fold_language(a["lang"]), fold_language(b["lang"])
        return F.when(keys[0] != keys[1], F.create_map(keys[0], F.array(a["value"]), keys[1], F.array(b["value"])))

    return _few(nodes, "literal", empty, lambda o: F.create_map(fold_language(o["lang"]), F.array(o["value"])), two, let(tagged, lists))


def date_of(nodes) -> Column:
    """ISO text of the first literal that reads as a date or moment."""
    dates = F.transform(literals(nodes), lambda o: typed.date_text(o["value"], o["datatype"]))
    return _few(nodes, "literal", F.lit(None).cast("string"), lambda o: typed.date_text(o["value"], o["datatype"]), None,
                first(F.filter(dates, lambda d: d.isNotNull())))


def _first_typed(nodes, body):
    """`body` of the first literal as typed, computed once."""
    return let(first(literals(nodes)), lambda o: let(
        typed.typed_literal(o["value"], o["datatype"]), lambda v: body(v, o["value"])))


def integer_of(nodes) -> Column:
    """The first literal as a whole number; a boolean counts as 0 or 1."""
    return _first_typed(nodes, lambda v, text: (
        F.when(v["family"] == "boolean", v["boolean"].cast("bigint"))
        .when(v["family"] == "integer", v["integer"])
        .when(v["family"] == "string", typed.integer_value(text))))


def boolean_of(nodes) -> Column:
    return _first_typed(nodes, lambda v, text: (
        F.when(v["family"] == "boolean", v["boolean"])
        .when(v["family"] == "string", typed.boolean_value(text))))


def float_of(nodes) -> Column:
    return _first_typed(nodes, lambda v, text: F.coalesce(
        v["float"], v["integer"].cast("double"), v["boolean"].cast("int").cast("double")))


def byte_size_of(nodes) -> Column:
    sizes = F.transform(values(nodes), typed.byte_size)
    return first(F.filter(sizes, lambda s: s.isNotNull()))


def references(graph, nodes) -> Column:
    """Subjects of the same graph that the objects point at; undescribed targets are skipped."""
    targets = F.transform(F.filter(nodes, lambda o: o["type"] != "literal"), lambda o: o["value"])
    head = F.get(nodes, F.lit(0))
    only = F.when((head["type"] != "literal") & F.map_contains_key(graph, head["value"]), F.array(head["value"])).otherwise(_no_texts())
    return (F.when(F.size(nodes) == 0, _no_texts()).when(F.size(nodes) == 1, only)
            .otherwise(F.filter(targets, lambda t: F.map_contains_key(graph, t))))


def pivot_subject(node) -> Column:
    """`{curie: [value]}` of one subject, every predicate."""
    return F.map_from_entries(F.transform(F.map_entries(node), lambda e: F.struct(
        shorten_uri(e["key"]).alias("key"),
        F.transform(e["value"], lambda o: o["value"]).alias("value"))))


# --- which subject an entry is about -----------------------------------------

def subjects_of_type(graph, rdf_type) -> Column:
    """Subjects that carry the class, in order. The class may be a CURIE."""
    if isinstance(rdf_type, Column):
        wanted = expand_curie(rdf_type)
    else:
        wanted = F.lit(rdf_type if "://" in rdf_type else iri(rdf_type))
    return F.filter(F.map_keys(graph), lambda s: F.exists(
        objects(described(graph, s), RDF_TYPE), lambda o: o["value"] == wanted))


def _named_before_blank(subjects):
    return F.coalesce(first(F.filter(subjects, lambda s: ~is_blank_node(s))), first(subjects))


def named_subjects(graph) -> Column:
    return F.filter(F.map_keys(graph), lambda s: ~is_blank_node(s))


def main_subject(graph, resource_uri, own_types=()) -> Column:
    """The subject a graph is about: the envelope's resource if described, then the asked
    classes, then the most specific known class, then any named subject, then any."""
    types = [iri(t) for t in own_types] + [t for t, _ in TYPE_PRIORITY]

    def chosen(told):
        by_type = [_named_before_blank(subjects_of_type(told, t)) for t in dict.fromkeys(types)]
        return F.coalesce(*by_type, _named_before_blank(F.map_keys(told)), resource_uri)

    return F.when(F.map_contains_key(graph, resource_uri), resource_uri).otherwise(let(graph, chosen))


def entity_of_types(types) -> Column:
    """Which entity a subject's classes make it: the priority list, then other registered
    classes; null for an untyped one."""
    chosen = [F.when(F.array_contains(types, rdf_type), entity)
              for rdf_type, entity in [*TYPE_PRIORITY, *OTHER_TYPES] if entity]
    return F.coalesce(*chosen)


def with_envelope(entries: DataFrame) -> DataFrame:
    """Adds the envelope's fields, read off the `info` graph, and whether a guest may read the
    entry. One step finds the envelope's node; fields nobody asks for are not read."""
    head = F.get(F.map_keys("info"), F.lit(0))
    uri = F.when(~is_blank_node(head), head).otherwise(first(named_subjects(F.col("info"))))
    held = entries.withColumn("_uri", uri).withColumn("_node", described(F.col("info"), F.col("_uri")))
    found = computed(held, _envelope=F.struct(
        F.col("_uri").alias("uri"), F.col("_node").alias("node"),
        first_uri(objects(F.col("_node"), "es:resource")).alias("resource"))).drop("_uri", "_node")
    node = F.col("_envelope.node")
    return found.withColumns({
        "entry_uri": F.col("_envelope.uri"),
        "resource_uri": F.col("_envelope.resource"),
        "created": date_of(objects(node, "dcterms:created")),
        "harvested": date_of(objects(node, "dcterms:modified")),
        "creator": first_uri(objects(node, "dcterms:creator")),
        "entry_type": first_uri(objects(node, "rdf:type")),
        "is_public": F.array_contains(F.coalesce("rights", F.array().cast("array<string>")),
                                      "readmetadata")}).drop("_envelope")


def _about(entries: DataFrame, subject) -> DataFrame:
    def about(chosen):
        named = ~is_blank_node(chosen) & (chosen != "")
        return F.struct(chosen.alias("subject"), described(F.col("metadata"), chosen).alias("node"),
                        F.coalesce("resource_uri", F.when(named, chosen)).alias("uri"))

    found = computed(entries.withColumn("_subject", subject), _about=about(F.col("_subject"))).drop("_subject")
    return found.withColumns({n: F.col(f"_about.{n}") for n in ("subject", "node", "uri")}).drop("_about")


def with_subject(entries: DataFrame, entity=None) -> DataFrame:
    """Adds `subject`, its `node`, and the entry's `uri`. Needs `metadata` and `resource_uri`."""
    own = ENTITY_TYPES[entity] if entity else ()
    return _about(entries, main_subject(F.coalesce("metadata", empty_graph()), F.col("resource_uri"), own))


def with_own_subject(classified: DataFrame, entities) -> DataFrame:
    """The same for entries of several entities side by side, each by the classes of its own."""
    graph, uri = F.coalesce("metadata", empty_graph()), F.col("resource_uri")
    own = let(graph, lambda told: F.coalesce(*[F.when(F.col("entity") == name, main_subject(
        told, uri, ENTITY_TYPES[name])) for name in entities]))
    return _about(classified, F.when(F.col("entity").isin(*entities), F.when(
        F.map_contains_key(graph, uri), uri).otherwise(own)))


def classify_entries(entries: DataFrame) -> DataFrame:
    """Adds `entity` from the classes of the entry's own subject."""
    return computed(with_subject(entries),
                    entity=entity_of_types(uris(objects(F.col("node"), RDF_TYPE))))


# --- triples -----------------------------------------------------------------

def merge_graphs(left, right) -> Column:
    """Triples of both graphs; what the left one has is not repeated."""
    nothing = F.array().cast(NODES)

    def merge_objects(_, a, b):
        return F.concat(F.coalesce(a, nothing), F.array_except(F.coalesce(b, nothing),
                                                               F.coalesce(a, nothing)))

    empty_node = F.create_map().cast(f"map<string,{NODES}>")
    return F.map_zip_with(left, right, lambda _, a, b: F.map_zip_with(
        F.coalesce(a, empty_node), F.coalesce(b, empty_node), merge_objects))


def triples(entries: DataFrame, graph="metadata", keys=("context_id", "entry_id")) -> DataFrame:
    """One row per triple, with the position of each object. A narrow operation."""
    subjects = entries.select(*keys, F.posexplode(F.map_entries(graph)).alias("s_pos", "subject"))
    predicates = subjects.select(*keys, F.col("subject.key").alias("s"), "s_pos",
                                 F.explode(F.map_entries("subject.value")).alias("predicate"))
    rows = predicates.select(*keys, "s", "s_pos", F.col("predicate.key").alias("p"),
                             F.posexplode("predicate.value").alias("pos", "o"))
    return rows.select(*keys, "s", "s_pos", "p", "pos", F.col("o.type").alias("o_type"),
                       F.col("o.value").alias("o_value"), F.col("o.lang").alias("o_lang"),
                       F.col("o.datatype").alias("o_datatype"))


def triple_counts(entries: DataFrame, graph="metadata", keys=("context_id", "entry_id")) -> DataFrame:
    """Triples, subjects and predicates per entry that has any; an entry's graph is in its row."""
    nodes = F.map_values(F.col(graph))
    stated = F.filter(F.flatten(F.transform(nodes, lambda n: F.map_entries(n))), lambda e: F.size(e["value"]) > 0)
    described_ = F.filter(nodes, lambda n: F.exists(F.map_values(n), lambda v: F.size(v) > 0))
    counted = entries.select(*keys, F.aggregate(stated, F.lit(0).cast("bigint"), lambda n, e: n + F.size(e["value"])).alias("triples"),
                             F.size(described_).cast("bigint").alias("subjects"),
                             F.size(F.array_distinct(F.transform(stated, lambda e: e["key"]))).cast("bigint").alias("predicates"))
    return counted.filter(F.col("triples") > 0)


def quarantine(rows: DataFrame):
    """(good, bad) triples: an object needs a value and one of the three node kinds."""
    sound = F.coalesce(F.col("o_type").isin(*NODE_KINDS) & F.col("o_value").isNotNull(),
                       F.lit(False))
    return rows.filter(sound), rows.filter(~sound)


def follow(entries: DataFrame, *predicates, graph="metadata", keys=("context_id", "entry_id")) -> DataFrame:
    """Triples `(*keys, from_s, from_pos, s, p, pos, o_type, o_value)` of the subjects that the
    predicates point at within the same entry. A narrow operation: the targets are looked up in
    the entry's own graph."""
    wanted = [iri(p) for p in predicates]
    whole = F.col(graph)
    subjects = entries.select(*keys, whole.alias("_graph"), F.explode(F.map_entries(whole)).alias("_s"))
    pointing = subjects.select(*keys, "_graph", F.col("_s.key").alias("from_s"), F.explode(F.filter(
        F.map_entries("_s.value"), lambda e: e["key"].isin(wanted))).alias("_p"))
    targets = pointing.select(*keys, "_graph", "from_s", F.posexplode("_p.value").alias("from_pos", "_o")).filter(
        (F.col("_o.type") != "literal") & F.map_contains_key("_graph", F.col("_o.value")))
    nodes = targets.select(*keys, "from_s", "from_pos", F.col("_o.value").alias("s"), F.explode(F.map_entries(
        F.try_element_at("_graph", F.col("_o.value")))).alias("_t"))
    found = nodes.select(*keys, "from_s", "from_pos", "s", F.col("_t.key").alias("p"), F.posexplode("_t.value").alias("pos", "_v"))
    return found.select(*keys, "from_s", "from_pos", "s", "p", "pos", F.col("_v.type").alias("o_type"), F.col("_v.value").alias("o_value"))
