"""Writing results out."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.functions.text import localized_text
from metaloom.operators.windows import TOTAL_ORDER


def flat_distributions(datasets: DataFrame, language="sv") -> DataFrame:
    """One row per distribution, for spreadsheets and joins."""
    rows = datasets.select("uri", "title", "publisher", F.posexplode("distributions").alias("pos", "d"))
    return rows.select(
        F.col("uri").alias("dataset"), localized_text(F.col("title"), language).alias("title"),
        F.col("publisher.id").alias("publisher"), "pos", F.col("d.kind").alias("kind"),
        F.col("d.format").alias("format"),
        F.coalesce("d.download_url", "d.access_url").alias("url"))


def write_flat(datasets: DataFrame, path, format="parquet"):
    flat_distributions(datasets).write.mode("overwrite").option("header", True).format(format).save(path)


def to_json(rows: DataFrame) -> DataFrame:
    """Each row as one JSON text, nulls kept."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def result_document(window: DataFrame, facets: DataFrame, omitted: DataFrame, total, offset=0,
                    limit=None, order=TOTAL_ORDER) -> DataFrame:
    """One row `{total, offset, limit, datasets, facets, facets_omitted}` of a page of results, its datasets
    by `order`.

    `window` is a page and `facets` are limited, so both are bounded by what was asked for. For
    an unpaged result write `to_json` of each part instead.
    """
    placed = window.select(F.struct(*order).alias("place"), F.struct("*").alias("row"))
    held = F.array_sort(F.collect_list(F.struct("place", "row")),
                        lambda a, b: F.when(a["place"] < b["place"], -1).when(a["place"] > b["place"], 1).otherwise(0))
    rows = placed.agg(F.transform(held, lambda x: x["row"]).alias("datasets"))
    values = F.transform(F.array_sort(F.collect_list(F.struct("rank", "value", "count", "label")),
                                       lambda a, b: a["rank"] - b["rank"]),
                         lambda v: F.struct(v["value"].alias("value"), v["count"].alias("count"),
                                            v["label"].alias("label")))
    by_facet = facets.groupBy("facet").agg(values.alias("values"))
    counted = by_facet.agg(F.map_from_entries(F.collect_list(
        F.struct("facet", "values"))).alias("facets"))
    cut = omitted.agg(F.map_from_entries(F.collect_list(
        F.struct("facet", "omitted"))).alias("facets_omitted"))
    one = F.lit(1).alias("_one")
    joined = (rows.select("*", one).join(counted.select("*", one), "_one")
              .join(cut.select("*", one), "_one"))
    return joined.select(F.lit(total).cast("bigint").alias("total"), F.lit(offset).alias("offset"),
                         F.lit(limit).cast("int").alias("limit"), "datasets", "facets",
                         "facets_omitted")
