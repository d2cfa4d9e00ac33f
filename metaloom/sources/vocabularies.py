"""Reading vocabularies: label tables, publishers, gazetteers, choice lists, label documents."""

import xml.etree.ElementTree as ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom import schemas
from metaloom.constants import (LABEL_LANGUAGES, LABEL_PREDICATES, LANGUAGES,
                                ORGANISATION_NUMBER, iri)
from metaloom.functions.literals import literal_map
from metaloom.functions.text import strip
from metaloom.sources import files

LABELS_SCHEMA = "uri string, label map<string,string>, ord int"
PUBLISHERS_SCHEMA = "id string, uri string, alias string, org_no string"


def _documents(spark, path):
    return spark.read.option("wholetext", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), "value")


def read_labels(spark: SparkSession, path) -> DataFrame:
    """`(uri, label, ord)` of `{"labels": {uri: {lang: label}}}`; a missing file is empty."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], LABELS_SCHEMA)
    parsed = F.from_json("value", "labels map<string,map<string,string>>")
    return (_documents(spark, path)
            .select(F.posexplode(F.map_entries(parsed["labels"])).alias("ord", "e"))
            .select("e.key", "e.value", "ord").toDF("uri", "label", "ord"))


def read_publishers(spark: SparkSession, path) -> DataFrame:
    """`(id, uri, alias, org_no)` of `{"publishers": {id: {uri, name, alias}}}`. Only rows with a
    URI carry an organisation number."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], PUBLISHERS_SCHEMA)
    parsed = F.from_json("value", "publishers map<string,struct<uri:string,name:string,alias:string>>")
    rows = (_documents(spark, path)
            .select(F.explode(F.map_entries(parsed["publishers"])).alias("e"))
            .select(F.col("e.key").alias("id"), "e.value.uri", "e.value.alias"))
    return rows.select("id", "uri", "alias", organisation_number(F.col("uri")).alias("org_no"))


def organisation_number(uri):
    number = F.lower(F.regexp_extract(uri, ORGANISATION_NUMBER, 1))
    return F.when(number != "", number)


def read_gazetteer(spark: SparkSession, layouts) -> DataFrame:
    """`(id, name)` of tab-separated dumps `[(path, id column, name column)]`.

    Blank and `#` lines are skipped; the first line of an id wins, earlier dumps first.
    """
    parts = []
    for rank, (path, id_column, name_column) in enumerate(layouts):
        cells = F.split("value", "\t", -1)
        lines = spark.read.text(path).select(
            "value", F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"))
        rows = lines.filter((F.col("value") != "") & ~F.startswith("value", F.lit("#")))
        parts.append(rows.select(
            strip(F.try_element_at(cells, F.lit(id_column + 1))).alias("id"),
            strip(F.try_element_at(cells, F.lit(name_column + 1))).alias("name"),
            F.struct(F.lit(rank).alias("rank"), "file", "start", "line").alias("ord")))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    kept = rows.filter(F.col("id").rlike("^\\d+$") & (F.col("name") != ""))
    return kept.groupBy("id").agg(F.min_by("name", "ord").alias("name"))


def read_templates(spark: SparkSession, path) -> DataFrame:
    """`(uri, label)` of choice lists `{"choices": [{value, label: {lang: text}}]}`.

    Later files add to and replace what earlier ones say, language by language. A label that is
    no language map is skipped, as is a file that cannot be read.
    """
    parsed = F.from_json("value", "choices array<struct<value:string,label:string>>")
    choices = _documents(spark, path).select(
        "file", F.posexplode(parsed["choices"]).alias("pos", "c"))
    labels = choices.select(
        F.col("c.value").alias("uri"), F.struct("file", "pos").alias("ord"),
        F.explode(F.map_entries(F.from_json("c.label", schemas.TEXT))).alias("l"))
    kept = labels.filter((F.col("uri") != "") & F.col("l.key").isin(*LANGUAGES)
                         & F.col("l.value").isNotNull())
    latest = kept.groupBy("uri", F.col("l.key").alias("lang")).agg(
        F.max_by("l.value", "ord").alias("text"))
    return latest.groupBy("uri").agg(F.map_from_entries(
        F.sort_array(F.collect_list(F.struct("lang", "text")))).alias("label"))


_LABEL = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in
                                   ("about", "predicate", "lang", "text")]))


@F.pandas_udf(_LABEL)
def _label_elements(documents: pd.Series) -> pd.Series:
    """Every labelled element of an RDF/XML document: what it is about, and each label."""
    about = "{%s}about" % iri("rdf:")
    language = "{http://www.w3.org/XML/1998/namespace}lang"
    tags = {"{%s}%s" % (iri(p.split(":")[0] + ":"), p.split(":")[1]): p for p in LABEL_PREDICATES}

    def read(text):
        try:
            root = ElementTree.fromstring(text or "")
        except ElementTree.ParseError:
            return []
        return [{"about": element.get(about), "predicate": tags[child.tag],
                 "lang": child.get(language), "text": child.text}
                for element in root.iter() if element.get(about)
                for child in element if child.tag in tags]

    return documents.map(read)


def labels_of_documents(documents: DataFrame) -> DataFrame:
    """`(uri, label)` of RDF/XML documents `(uri, xml, final_url)` fetched for a URI.

    Any element about the URI or the address it led to counts, however http, https and the
    closing slash are written. Predicates come in order of preference, then the first label of a
    language wins; three-letter tags stand for two-letter ones.
    """
    def bare(column):
        return F.regexp_replace(F.regexp_replace(column, "/+$", ""), "^https?://", "")

    elements = documents.select("uri", "final_url", F.posexplode(_label_elements("xml"))
                                .alias("pos", "l"))
    final = F.regexp_replace("final_url", "/+$", "")
    slashes = F.col("l.about").rlike("//$")
    about_it = ~slashes & ((bare(F.col("l.about")) == bare(F.col("uri")))
                           | F.coalesce(F.regexp_replace("l.about", "/$", "") == final,
                                        F.lit(False)))
    aliases = literal_map(LABEL_LANGUAGES)
    tag = F.lower(F.split(F.coalesce("l.lang", F.lit("")), "-")[0])
    place = F.array_position(F.array(*[F.lit(p) for p in LABEL_PREDICATES]), F.col("l.predicate"))
    rows = elements.filter(about_it).select(
        "uri", F.try_element_at(aliases, tag).alias("lang"), strip("l.text").alias("text"),
        F.struct(place.alias("place"), "pos").alias("ord"))
    kept = rows.filter(F.col("lang").isNotNull() & (F.col("text") != ""))
    firsts = kept.groupBy("uri", "lang").agg(F.min_by("text", "ord").alias("text"))
    return firsts.groupBy("uri").agg(F.map_from_entries(
        F.sort_array(F.collect_list(F.struct("lang", "text")))).alias("label"))
