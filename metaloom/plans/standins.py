"""The given tables seen as a catalogue.

documents are datasets (first line the title), labels their link verdicts; orders are datasets
with lineitems as distributions; customers publish orders; suppliers are data services; pages
are distributions by URL; parts carry vocabulary terms and keywords; events are logs.
"""

from functools import cached_property, reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaloom.constants import iri
from metaloom.functions.quality import kind_of
from metaloom.functions.text import fold_language
from metaloom.operators.computed import computed
from metaloom.operators.graph import parse_graph, with_envelope

_NODE = "struct<type:string,value:string,lang:string,datatype:string>"
TEXT = "string"


def none(kind="string"):
    return F.lit(None).cast(kind)


class Tables:
    """The given Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder):
        self.spark, self.folder = spark, str(folder)

    def __getattr__(self, name) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def fixed(self, rows, schema) -> DataFrame:
        """A short list of requested values."""
        return self.spark.createDataFrame(rows, schema)

    @cached_property
    def document_records(self) -> DataFrame:
        """Datasets of documents. Labelled ones have a distribution: broken where quality is 0,
        unverified where only toxic is 1."""
        title = F.substring_index("text", "\n", 1)
        key = fold_language(F.col("lang"))
        reason = F.when(F.col("quality") == 0, "Not Found").when(F.col("toxic") == 1, "timeout")
        mark = F.when(reason.isNotNull(), F.struct(reason.alias("reason"),
                                                   F.lit("2024-01-01T00:00:00").alias("checked"),
                                                   none().alias("by")))
        broken = F.when(F.col("quality") == 0, mark)
        distribution = F.struct(
            F.concat(F.lit("https://files.example.org/"), "lang", F.lit("/"), "doc_id").alias("uri"),
            F.lit("txt").alias("format"), F.lit("file").alias("kind"),
            none().alias("download_url"),
            F.concat(F.lit("https://files.example.org/"), "doc_id").alias("access_url"),
            broken.alias("broken"),
            F.when(broken.isNull(), mark).alias("unverified"))
        distributions = F.when(F.col("quality").isNotNull(), F.array(distribution))
        return self.documents.join(self.labels, "doc_id", "left").select(
            F.concat(F.lit("https://data.example.org/doc/"), "doc_id").alias("uri"),
            F.col("source").alias("context_id"), F.col("doc_id").cast("string").alias("entry_id"),
            F.lit("dataset").alias("type"), F.create_map(key, title).alias("title"),
            F.create_map(key, "text").alias("description"),
            F.create_map(key, F.split(title, " ")).alias("keywords"),
            F.struct(F.col("source").alias("id"),
                     F.concat(F.lit("https://org.example.org/"), "source").alias("uri"),
                     F.create_map(F.lit("en"), F.upper("source")).alias("name"),
                     F.col("lang").alias("type")).alias("publisher"),
            F.array("lang").alias("themes"),
            F.when(F.col("toxic") == 0, "public").when(F.col("toxic") == 1, "restricted")
            .alias("access_rights"),
            F.when(F.col("n_chars") < 500, "daily").when(F.col("n_chars") < 2000, "monthly")
            .alias("accrual_periodicity"),
            none().alias("issued"), none().alias("modified"),
            F.coalesce(distributions, F.array()).alias("distributions"),
            none("struct<reason:string,checked:string,by:string>").alias("stale"))

    @cached_property
    def line_distributions(self) -> DataFrame:
        """lineitems as flat distributions, in a total order."""
        fmt = (F.when(F.col("l_returnflag") == "A", "csv")
               .when(F.col("l_returnflag") == "N", "html").otherwise("wms_service"))
        download = F.when(F.col("l_linestatus") == "F", F.concat(
            F.lit("https://dl.example.org/"), "l_partkey", F.lit(".zip")))
        access = F.concat(F.lit("https://api.example.org/part/"), "l_partkey")
        return self.lineitem.select(
            "l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                   "l_extendedprice", "l_shipdate").alias("line"),
            fmt.alias("format"), download.alias("download_url"), access.alias("access_url"),
            kind_of(fmt, download, access, F.lit(False)).alias("kind"),
            (F.col("l_discount") >= 0.09).alias("dead"))

    @cached_property
    def order_publishers(self) -> DataFrame:
        """Who publishes the orders, without what the orders hold."""
        customers = self.customer.withColumnRenamed("c_custkey", "o_custkey")
        return self.orders.join(customers, "o_custkey", "left").select(
            F.col("c_mktsegment").alias("context_id"), F.col("o_orderkey").cast("string").alias("entry_id"),
            F.struct(F.col("c_name").alias("id"),
                     F.concat(F.lit("https://org.example.org/"), "o_custkey").alias("uri"),
                     F.create_map(F.lit("en"), "c_name").alias("name"),
                     F.concat(F.lit("nation_"), "c_nationkey").alias("type")).alias("publisher"))

    @cached_property
    def order_records(self) -> DataFrame:
        """Datasets of orders; publisher is the customer, context its market segment."""
        mark = F.struct(F.lit("Gone").alias("reason"), F.lit("2024-01-01").alias("checked"),
                        none().alias("by"))
        d = F.struct("line", "format", "kind", "download_url", "access_url",
                     F.when(F.col("dead"), mark).alias("broken"),
                     F.when(F.col("dead") & F.lit(False), mark).alias("unverified"))
        lines = self.line_distributions.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.sort_array(F.collect_list(d)).alias("distributions"))
        customers = self.customer.withColumnRenamed("c_custkey", "o_custkey")
        day = F.date_format("o_orderdate", "yyyy-MM-dd")
        empty = F.array().cast(lines.schema["distributions"].dataType)
        return (self.orders.join(lines, "o_orderkey", "left").join(customers, "o_custkey", "left")
                .select(
            F.concat(F.lit("https://data.example.org/order/"), "o_orderkey").alias("uri"),
            F.col("c_mktsegment").alias("context_id"),
            F.col("o_orderkey").cast("string").alias("entry_id"), F.lit("dataset").alias("type"),
            F.create_map(F.lit("en"), F.concat(F.lit("Order "), "o_orderkey")).alias("title"),
            F.struct(F.col("c_name").alias("id"),
                     F.concat(F.lit("https://org.example.org/"), "o_custkey").alias("uri"),
                     F.create_map(F.lit("en"), "c_name").alias("name"),
                     F.concat(F.lit("nation_"), "c_nationkey").alias("type")).alias("publisher"),
            F.array(F.lower("o_orderstatus")).alias("themes"),
            F.create_map(F.lit("en"), F.split("o_orderpriority", "-")).alias("keywords"),
            F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.lower("o_orderpriority"))
            .alias("access_rights"),
            F.when(F.col("o_orderstatus") != "P", F.lower("o_orderstatus"))
            .alias("accrual_periodicity"),
            F.when(F.col("o_orderstatus") != "P", F.concat(day, F.lit("T12:00:00+02:00")))
            .alias("modified"), day.alias("issued"),
            F.coalesce("distributions", empty).alias("distributions"),
            none("struct<reason:string,checked:string,by:string>").alias("stale")))

    @cached_property
    def supplier_services(self) -> DataFrame:
        """Data services of suppliers; publisher and its type from the nation."""
        nations = self.nation.withColumnRenamed("n_nationkey", "s_nationkey")
        return self.supplier.join(nations, "s_nationkey", "left").select(
            F.concat(F.lit("https://data.example.org/service/"), "s_suppkey").alias("uri"),
            F.lower("n_name").alias("context_id"),
            F.col("s_suppkey").cast("string").alias("entry_id"),
            F.lit("data_service").alias("type"),
            F.create_map(F.lit("en"), "s_name").alias("title"),
            F.struct(F.lower("n_name").alias("id"),
                     F.concat(F.lit("https://org.example.org/n/"), "s_nationkey").alias("uri"),
                     F.create_map(F.lit("en"), "n_name").alias("name"),
                     F.concat(F.lit("region_"), "n_regionkey").alias("type")).alias("publisher"),
            F.when(F.col("s_acctbal") > 5000, "rest").alias("service_type"),
            F.array(F.concat(F.lit("region_"), "n_regionkey")).alias("themes"),
            F.create_map(F.lit("en"), F.array(F.lit("Service"), F.lower("n_name"))).alias("keywords"),
            F.when(F.col("s_acctbal") >= 0, "public").alias("access_rights"))

    @cached_property
    def link_log(self) -> DataFrame:
        """events as link checks: the user is the URL, an error a broken link."""
        number = F.get_json_object("props", "$.k").cast("int")
        return self.events.select(
            F.concat(F.lit("https://dl.example.org/"), "user_id", F.lit(".zip")).alias("uri"),
            F.concat(F.lit("ctx"), F.floor(number / 15).cast("string")).alias("context"),
            F.when(F.col("event_type") == "error", "broken")
            .when(F.col("event_type") == "signup", "excluded").otherwise("success").alias("status"),
            F.when(number < 50, "Not Found").otherwise("timeout").alias("statusMessage"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("checkedAt"),
            F.col("event_id").alias("pos"))


# --- RDF/JSON out of columns ---------------------------------------------------

def literal(value, lang=None, datatype=None):
    return F.struct(F.lit("literal").alias("type"), value.cast("string").alias("value"),
                    (F.lit(lang).cast("string") if lang is None or isinstance(lang, str) else lang).alias("lang"),
                    (none() if datatype is None else F.lit(datatype)).alias("datatype"))


def reference(value, kind="uri"):
    return F.struct(F.lit(kind).alias("type"), value.cast("string").alias("value"),
                    none().alias("lang"), none().alias("datatype"))


def graph_text(subjects):
    """RDF/JSON text of `[(subject column, {curie: [node] or array column})]`, nulls left out."""
    pairs = []
    for subject, predicates in subjects:
        inner = []
        for predicate, nodes in predicates.items():
            inner.append(F.lit(iri(predicate)))
            if isinstance(nodes, list):
                whole = reduce(and_, [n["value"].isNotNull() for n in nodes])
                held = F.array(*nodes)
                none = F.array().cast(f"array<{_NODE}>")
                inner.append(F.when(whole, held).otherwise(
                    none if len(nodes) == 1 else F.filter(held, lambda n: n["value"].isNotNull())))
            else:
                inner.append(F.filter(nodes.cast(f"array<{_NODE}>"), lambda n: n["value"].isNotNull()))
        pairs += [subject, F.create_map(*inner)]
    return F.to_json(F.create_map(*pairs))


def entries_of(rows: DataFrame, entry_id, metadata, resource=None, context="ctx", rights=None,
               modified=None, extra=()) -> DataFrame:
    """Entries whose graphs went through RDF/JSON text and back, as from a registry page.

    A table of one row group would be read and written out by one task; a registry hands out many pages.
    """
    rows = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)
    entry_uri = F.concat(F.lit("https://registry.example.org/entry/"), entry_id.cast("string"))
    told = {"rdf:type": [reference(F.lit(iri("es:Link")))]}
    if resource is not None:
        told["es:resource"] = [reference(resource)]
    if modified is not None:
        told["dcterms:modified"] = [literal(modified, datatype=iri("xsd:dateTime"))]
    texts = rows.select(
        (F.lit(context) if isinstance(context, str) else context).alias("context_id"),
        entry_id.cast("string").alias("entry_id"), *extra,
        (F.array(F.lit("readmetadata")) if rights is None else rights).alias("rights"),
        metadata.alias("_metadata_text"), graph_text([(entry_uri, told)]).alias("_info_text"))
    texts = computed(texts, _metadata_text=F.col("_metadata_text"), _info_text=F.col("_info_text"))
    parsed = computed(texts, metadata=parse_graph(F.col("_metadata_text")),
                      info=parse_graph(F.col("_info_text")))
    return with_envelope(parsed.drop("_metadata_text", "_info_text"))
