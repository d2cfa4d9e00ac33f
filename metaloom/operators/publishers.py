"""Who publishes: one organisation out of its registry agents, and every way of naming it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.functions.text import nullif_empty, slugify, strip
from metaloom.operators.joins import left_lookup
from metaloom.operators.vocabulary import publisher_aliases


def with_publisher_id(records: DataFrame, publishers: DataFrame) -> DataFrame:
    """The publisher struct as handed out: with `id` and `alias`.

    The id is the publisher table's for the URI, with or without a closing slash, else the
    organisation's name as a short name. Both are added when reading, so a new table needs no
    rebuild.
    """
    agent = F.col("publisher")
    by_uri = (publishers.filter(F.col("uri").isNotNull())
              .select(F.col("uri").alias("_uri"), F.col("id").alias("_id"))
              .dropDuplicates(["_uri"]))
    bare = F.regexp_replace("publisher.uri", "/+$", "")
    keyed = records.withColumn("_uri", F.col("publisher.uri"))
    joined = left_lookup(keyed, by_uri, "_uri").withColumnRenamed("_id", "_exact").drop("_uri")
    joined = left_lookup(joined.withColumn("_uri", F.when(bare != F.col("publisher.uri"), bare)),
                         by_uri, "_uri").drop("_uri")
    name = F.coalesce(nullif_empty(F.try_element_at("publisher.name", F.lit("sv"))),
                      nullif_empty(F.try_element_at("publisher.name", F.lit("en"))))
    joined = joined.withColumn("_pid", F.coalesce("_exact", "_id", nullif_empty(slugify(name))))
    aliases = publisher_aliases(publishers)[0].select(
        F.col("id").alias("_pid"), F.col("alias").alias("_alias"))
    table = aliases.withColumnRenamed("_pid", "_key")
    named = left_lookup(joined.withColumn("_key", F.col("_pid")), table, "_key").drop("_key")
    return named.withColumn("publisher", F.struct(
        F.col("_pid").alias("id"), agent["uri"].alias("uri"),
        F.coalesce(agent["name"], F.create_map().cast("map<string,string>")).alias("name"),
        F.col("_alias").alias("alias"), agent["type"].alias("type"),
        agent["homepage"].alias("homepage"), agent["email"].alias("email"),
        F.coalesce(agent["identifiers"], F.array().cast("array<string>")).alias("identifiers"),
    )).drop("_exact", "_id", "_pid", "_alias")


def agents_of(records: DataFrame) -> DataFrame:
    """`(id, uri, records, agent)`: the agents each publisher id goes by, from every record,
    before any scope narrows them. Counted before the shuffle."""
    publisher = F.col("publisher")
    return (records.filter(F.col("publisher.id") != "")
            .groupBy(F.col("publisher.id").alias("id"), F.col("publisher.uri").alias("uri"))
            .agg(F.count("*").alias("records"), F.min_by(
                publisher, F.struct("context_id", "entry_id")).alias("agent")))


def representatives(agents: DataFrame, publishers: DataFrame) -> DataFrame:
    """`(id, uri, records, agent)`: the one agent that stands for a publisher, never a merge.
    A URI the publisher table knows comes first, then the most records, then the lowest URI."""
    known = (publishers.filter(F.col("uri").isNotNull())
             .select(F.col("uri"), F.lit(0).alias("_unknown")).dropDuplicates(["uri"]))
    ranked = agents.join(known, "uri", "left")
    order = F.struct(F.coalesce("_unknown", F.lit(1)), -F.col("records"),
                     F.coalesce("uri", F.lit("")))
    best = F.min_by(F.struct("uri", "records", "agent"), order)
    return ranked.groupBy("id").agg(best.alias("_best")).select("id", "_best.*")


TIERS = ["id", "alias", "uri", "identifier", "name"]


def name_keys(agents: DataFrame, publishers: DataFrame) -> DataFrame:
    """`(key, id, tier)`: what names a publisher. The first tier to claim a key keeps it, ids
    ascending within a tier. Every agent states its own claims in one row; aliases belong to an id, so
    they are stated once for it, not by each of its agents."""
    def claims(keys, tier):
        return F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(tier).alias("tier")))

    names = F.filter(F.coalesce(F.map_values("agent.name"), F.array().cast("array<string>")), lambda n: n != "")
    own = F.concat(*[claims(F.coalesce(keys, F.array().cast("array<string>")), TIERS.index(tier)) for tier, keys in (
        ("id", F.array("id")), ("uri", F.array("uri")),
        ("identifier", F.transform("agent.identifiers", strip)), ("name", F.transform(names, slugify)))])
    held = agents.select("id").distinct()
    called = publisher_aliases(publishers)[0].join(held, "id").select(
        "id", F.col("alias").alias("key"), F.lit(TIERS.index("alias")).alias("tier"))
    stated = agents.select("id", F.inline(own)).unionByName(called)
    first = F.min(F.struct("tier", "id"))
    return (stated.filter(F.col("key").isNotNull()).groupBy("key").agg(first.alias("_first"))
            .select("key", "_first.id", "_first.tier"))


def resolve(requested: DataFrame, keys: DataFrame, publishers: DataFrame) -> DataFrame:
    """`(value, id, held)`: the id each requested value names.

    The value as given, then as a short name; then what the publisher table knows, an
    organisation that holds nothing here included. An unknown value has a null id. `keys` are named
    twice, so a catalogue's should be written first.
    """
    raw = strip("value")
    spellings = F.array(F.struct(raw.alias("name"), F.lit(False).alias("short")),
                        F.struct(slugify(raw).alias("name"), F.lit(True).alias("short")))
    asked = requested.select("value").distinct().select("value", F.inline(spellings))
    held = keys.select(F.col("key"), F.col("id").alias("_id"))
    # What the table's rows lead to, folded per id before its aliases meet it: an id has many of both.
    listed = publishers.filter(F.col("uri").isNotNull()).join(held.withColumnRenamed("key", "uri"), "uri", "left").select(
        "id", "org_no", F.when(F.col("_id").isNotNull(), F.struct("uri", "_id")).alias("_hit"))
    numbered = listed.select("id", "_hit", F.explode(F.array("id", "org_no")).alias("name")).filter(F.col("name").isNotNull())
    of_id = listed.groupBy("id").agg(F.min("_hit").alias("_hit"))
    called = publisher_aliases(publishers)[0].join(of_id, "id").select("id", "_hit", F.col("alias").alias("name"))
    of_table = numbered.unionByName(called).groupBy("name").agg(
        F.min("_hit")["_id"].alias("_by_uri"), F.min("id").alias("_listed"))
    found = asked.join(held.withColumnRenamed("key", "name"), "name", "left").join(of_table, "name", "left")
    short = F.col("short")
    best = found.groupBy("value").agg(
        F.max(F.when(~short, F.col("_id"))).alias("_by_raw"), F.max(F.when(short, F.col("_id"))).alias("_by_slug"),
        F.max(F.when(short, F.col("_by_uri"))).alias("_by_uri"), F.max(F.when(short, F.col("_listed"))).alias("_listed"))
    return best.select("value", F.coalesce("_by_raw", "_by_slug", "_by_uri", "_listed").alias("id"),
                       F.coalesce("_by_raw", "_by_slug", "_by_uri").isNotNull().alias("held"))


def counts(datasets: DataFrame, services: DataFrame) -> DataFrame:
    """`(id, dataset_count, data_service_count)`: publishers with something, both kinds side by
    side in one aggregate."""
    both = (datasets.select(F.col("publisher.id").alias("id"), F.lit(True).alias("dataset"))
            .unionByName(services.select(F.col("publisher.id").alias("id"),
                                         F.lit(False).alias("dataset"))))
    return (both.filter(F.col("id") != "").groupBy("id")
            .agg(F.count_if("dataset").alias("dataset_count"),
                 F.count_if(~F.col("dataset")).alias("data_service_count")))


def publisher_rows(counted: DataFrame, representatives: DataFrame) -> DataFrame:
    """Counted publishers with the attributes of their agent, biggest first."""
    entities = representatives.select(
        "id", F.col("agent.uri").alias("uri"), F.col("agent.name").alias("name"),
        F.col("agent.alias").alias("alias"), F.col("agent.type").alias("type"),
        F.col("agent.homepage").alias("homepage"), F.col("agent.email").alias("email"),
        F.col("agent.identifiers").alias("identifiers"))
    return (entities.join(counted, "id")
            .orderBy(F.desc("dataset_count"), "id"))

