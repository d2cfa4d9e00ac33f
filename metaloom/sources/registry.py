"""Reading what a registry hands out: pages of entries, link-check reports, harvest results."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom import schemas
from metaloom.functions.text import nullif_empty
from metaloom.operators.computed import computed
from metaloom.operators.graph import empty_graph, first, objects, parse_graph


def entries_of_pages(pages: DataFrame) -> DataFrame:
    """One row per entry of the pages, graphs parsed. `ord` is the order of arrival."""
    children = pages.select(F.col("file"), F.posexplode("resource.children").alias("pos", "e"))
    graphs = {name: F.coalesce(parse_graph(F.col(f"e.{name}")), empty_graph())
              for name in ("metadata", "info", "relations")}
    rows = children.select(
        F.col("e.contextId").alias("context_id"), F.col("e.entryId").alias("entry_id"),
        F.coalesce("e.rights", F.array().cast("array<string>")).alias("rights"),
        F.struct(F.col("file").alias("file"), F.col("pos").alias("pos")).alias("ord"), "e")
    return computed(rows, **graphs).drop("e")


def split_pages(texts: DataFrame):
    """(pages, unreadable) of `(file, text)`: a page is a JSON document that lists its entries; any
    other text is put aside whole, by file name."""
    parsed = computed(texts, page=F.from_json("text", schemas.ENTRY_PAGE))
    sound = F.col("page.resource.children").isNotNull()
    return (parsed.filter(sound).select("file", "page.resource"),
            parsed.filter(F.coalesce(~sound, F.lit(True))).select("file", "text"))


def unreadable_graphs(pages: DataFrame) -> DataFrame:
    """`(file, pos, entry_id, graph, text)` of graphs that are no RDF/JSON. Their entries are read
    with an empty graph in that place."""
    children = pages.select("file", F.posexplode("resource.children").alias("pos", "e"))
    told = F.array(*[F.struct(F.lit(name).alias("graph"), F.col(f"e.{name}").alias("text"))
                     for name in ("metadata", "info", "relations")])
    rows = children.select("file", "pos", F.col("e.entryId").alias("entry_id"), F.inline(told))
    return rows.filter((F.col("text") != "") & parse_graph(F.col("text")).isNull())


def read_pages(spark: SparkSession, path):
    """(pages, unreadable) of a registry's files, one JSON document each."""
    texts = spark.read.option("wholetext", True).text(path)
    return split_pages(texts.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")))


def read_entries(spark: SparkSession, path) -> DataFrame:
    """The entries of a registry's files; `read_pages` also tells which files could not be read."""
    return entries_of_pages(read_pages(spark, path)[0])


def split_reports(texts: DataFrame):
    """(checks, unreadable) of link-check reports as `(file, text)`, the file named `<context>/<entry>.json`.

    A report is a JSON list. One that is no list or cannot be read is put aside by file name,
    and its catalogue goes without; checks without a URL are dropped.
    """
    texts = texts.select("file", F.trim("text").alias("text"))
    lists = F.from_json("text", T.ArrayType(schemas.LINK_CHECK))
    parsed = texts.select("file", F.when(F.startswith("text", F.lit("[")), lists).alias("checks"))
    names = parsed.select(
        "*", F.regexp_extract("file", "([^/]+)/[^/]+$", 1).alias("context_id"),
        F.regexp_extract("file", "([^/]+)\\.json$", 1).alias("report_id"))
    sound = names.filter(F.col("checks").isNotNull())
    checks = sound.select("context_id", "report_id", F.posexplode("checks").alias("pos", "c"))
    rows = (checks.select("context_id", "report_id", "pos", "c.*").filter(F.col("uri") != "")
            .withColumn("context", F.col("context_id")))
    return rows, names.filter(F.col("checks").isNull()).select("file")


def read_link_checks(spark: SparkSession, path):
    """`split_reports` of a file per report. A file costs the driver a listing, so for very many reports
    see `read_packed_checks`."""
    texts = spark.read.option("wholetext", True).text(path)
    return split_reports(texts.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")))


def pack_reports(texts: DataFrame, path):
    """Writes reports, `(file, text)`, as rows of few Parquet files."""
    texts.select("file", "text").write.mode("overwrite").parquet(path)


def read_packed_checks(spark: SparkSession, path):
    """`split_reports` of reports that `pack_reports` wrote: as many files as tasks, however many reports."""
    return split_reports(spark.read.schema("file string, text string").parquet(path))


def report_entries(entries: DataFrame) -> DataFrame:
    """`(context_id, report_id, created, ord)` of link-check report entries."""
    node = first(F.map_values("metadata"))
    return entries.select(
        "context_id", F.col("entry_id").alias("report_id"),
        F.coalesce(first(objects(node, "dcterms:created"))["value"], F.lit("")).alias("created"),
        "ord")


def harvest_runs(entries: DataFrame) -> DataFrame:
    """`(context_id, status, harvested, title, ord)` of harvest result entries."""
    def last_of(predicate):
        """First object of the last subject of the envelope that has the predicate."""
        found = F.filter(F.transform(F.map_values("info"),
                                     lambda n: first(objects(n, predicate))["value"]),
                         lambda v: v.isNotNull())
        return F.try_element_at(found, F.lit(-1))

    titles = F.filter(F.transform(F.map_values("metadata"),
                                  lambda n: first(objects(n, "dcterms:title"))["value"]),
                      lambda v: v != "")
    status = F.lower(F.try_element_at(F.split(last_of("es:status"), "/"), F.lit(-1)))
    return entries.filter(F.col("context_id") != "").select(
        "context_id", nullif_empty(status).alias("status"),
        nullif_empty(F.substring(last_of("dcterms:modified"), 1, 19)).alias("harvested"),
        first(titles).alias("title"), "ord")
