"""Facets: which values each filter has in a set of records, and how many records carry each."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metaloom.constants import DATASET_FILTERS, VOCABULARY_FACETS
from metaloom.functions.text import fold_keyword, keyword_values, strip
from metaloom.operators.joins import left_lookup
from metaloom.operators.vocabulary import slug_labels, with_slug

_NONE = "array<string>"


def _one(column):
    return F.array(F.col(column) if isinstance(column, str) else column)


# Facet -> every value it reads out of a record, as an array.
FACET_VALUES = {
    "publisher": lambda: _one("publisher.id"),
    "publisher_type": lambda: _one("publisher.type"),
    "theme": lambda: F.col("themes"),
    "keyword": lambda: keyword_values(F.col("keywords")),
    "format": lambda: F.transform("distributions", lambda d: d["format"]),
    "kind": lambda: F.transform("distributions", lambda d: d["kind"]),
    "access_rights": lambda: _one("access_rights"),
    "accrual_periodicity": lambda: _one("accrual_periodicity"),
    "service_type": lambda: _one("service_type"),
}


def nonblank(values) -> Column:
    values = F.coalesce(values, F.array().cast(_NONE))
    return F.filter(values, lambda v: v.isNotNull() & (strip(v) != ""))


def values_of(facet, expressions=None) -> Column:
    """Values one filter reads out of a record, blanks excluded."""
    column = (expressions or {}).get(facet)
    return nonblank(FACET_VALUES[facet]() if column is None else column)


def _facet_structs(facet, expressions):
    """`(facet, value, form)` once per distinct value of a record.

    A keyword counts once however it is spelt: one struct per folded key with a null form, and
    one per spelling, so both counts come out of the same pass.
    """
    values = values_of(facet, expressions)

    def struct(value, form):
        return F.struct(F.lit(facet).alias("facet"), value.alias("value"),
                        form.cast("string").alias("form"))

    if facet != "keyword":
        return F.transform(F.array_distinct(values), lambda v: struct(v, F.lit(None)))
    keys = F.array_distinct(F.transform(values, fold_keyword))
    forms = F.array_distinct(F.transform(values, strip))
    return F.concat(F.transform(keys, lambda k: struct(k, F.lit(None))),
                    F.transform(forms, lambda f: struct(fold_keyword(f), f)))


def facet_counts(records: DataFrame, facets=DATASET_FILTERS, expressions=None) -> DataFrame:
    """`(facet, value, count)` over every record, all facets in one pass.

    One generate and one exchange of partial counts, whatever the number of facets. A keyword is
    shown in its commonest spelling, the first in code-point order among equals; choosing it is a
    second aggregate over the counts, not over the records.
    """
    structs = F.concat(*[_facet_structs(f, expressions) for f in facets])
    counted = (records.select(F.explode(structs).alias("f")).select("f.*")
               .groupBy("facet", "value", "form").agg(F.count("*").alias("count")))
    if "keyword" not in facets:
        return counted.select("facet", "value", "count")
    spelled = F.col("form").isNotNull()
    chosen = counted.groupBy("facet", "value").agg(
        F.max(F.when(~spelled, F.col("count"))).alias("count"),
        F.min_by("form", F.when(spelled, F.struct(-F.col("count"), "form"))).alias("shown"))
    return chosen.select("facet", F.coalesce("shown", "value").alias("value"), "count")


# Shares in which a facet is cut when its limit is large.
SHARES = 32


def ordered(facets: DataFrame) -> DataFrame:
    """Facets by name, each with its biggest values first."""
    return facets.orderBy("facet", F.desc("count"), "value")


def _top_of(facets, limit, *within):
    rank = F.row_number().over(Window.partitionBy("facet", *within).orderBy(F.desc("count"), "value"))
    return facets.withColumn("rank", rank).filter(F.col("rank") <= limit)


def limited(facets: DataFrame, limit) -> DataFrame:
    """The `limit` biggest values of each facet with their rank.

    Up to a limit that it is set to, Spark cuts each partition to `limit` rows per facet before the
    exchange. Beyond it a facet is first cut in shares of its values, each by a task of its own, so a facet
    of millions of values is no hot task at any limit: the last one sees `limit` rows of each share.
    """
    cut_by_spark = int(facets.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if limit <= cut_by_spark:
        return _top_of(facets, limit)
    shares = facets.withColumn("_share", F.pmod(F.xxhash64("value"), F.lit(SHARES)))
    return _top_of(_top_of(shares, limit, "_share").drop("_share", "rank"), limit)


def omitted(facets: DataFrame, limit) -> DataFrame:
    """How many values a limit cuts from each facet, for those it cuts."""
    counted = facets.groupBy("facet").agg(F.count("*").alias("values"))
    return (counted.select("facet", (F.col("values") - limit).alias("omitted"))
            .filter(F.col("omitted") > 0))


def top(facets: DataFrame) -> DataFrame:
    """The commonest value of each facet."""
    best = F.min_by(F.struct("value", "count"), F.struct(-F.col("count"), "value"))
    return facets.groupBy("facet").agg(best.alias("top")).select("facet", "top.value", "top.count")


def labelled(facets: DataFrame, labels: DataFrame, publisher_names=None) -> DataFrame:
    """Adds `label`: the vocabulary's for vocabulary facets, the organisation's for publishers,
    none for keywords and kinds, which are their own label."""
    empty = F.create_map().cast("map<string,string>")
    terms = slug_labels(labels).select(F.col("slug").alias("_value"), F.col("label").alias("_term"))
    asked = F.when(F.col("facet").isin(VOCABULARY_FACETS), F.col("value"))
    joined = left_lookup(facets.withColumn("_value", asked), terms, "_value").drop("_value")
    label = F.col("_term")
    if publisher_names is not None:
        names = publisher_names.select(F.col("id").alias("_id"), F.col("name").alias("_name"))
        asked = F.when(F.col("facet") == "publisher", F.col("value"))
        joined = left_lookup(joined.withColumn("_id", asked), names, "_id").drop("_id")
        label = F.coalesce("_term", "_name")
    return joined.select(*facets.columns, F.coalesce(label, empty).alias("label"))


def folded(raw: DataFrame, labels: DataFrame, excluded=None) -> DataFrame:
    """A facet `(raw, count)` of raw values by short name: several can share one."""
    named = raw.filter(F.col("raw") != "")
    if excluded:
        named = named.filter(~F.contains("raw", F.lit(excluded)))
    return (with_slug(named, "raw", labels).filter(F.col("slug").isNotNull())
            .groupBy(F.col("slug").alias("value")).agg(F.sum("count").alias("count")))
