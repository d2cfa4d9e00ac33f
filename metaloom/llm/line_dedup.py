"""Removal of lines that spread over many sites, with DataFrame functions only.

Per line, HyperLogLog sketches of its sites merge by aggregation, so a line on a third of all documents
is reduced before the shuffle. Estimates far from the threshold decide at once; lines near it get an
exact count of distinct sites. Of a spread line the first occurrence, by document and place, stays, so
no text is lost altogether; every later one goes.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.llm.common import BLANKS, stored

MIN_SITES = 3
# 2**11 registers have a standard error of 2.3 %; the margin is over four of them.
SKETCH_BITS, MARGIN = 11, 0.1
# Stands for a missing site, which counts as one site.
NO_SITE = "\x01"


def line_key(line):
    """128 bits of a line with its white space made even; null for a blank line, which never goes."""
    even = F.trim(F.regexp_replace(line, BLANKS, " "))
    return F.when(even != "", F.unhex(F.md5(even)))


def row_key(id_col, text_col):
    return F.unhex(F.md5(F.concat_ws("\x00", F.coalesce(F.col(id_col).cast("string"), F.lit("\x01")), F.col(text_col))))


def lines_of(docs: DataFrame, id_col, text_col, site_col) -> DataFrame:
    """_row, _id, _site, pos, key of every line that is not blank, written once."""
    keys = docs.select(
        row_key(id_col, text_col).alias("_row"), F.col(id_col).alias("_id"),
        F.coalesce(F.col(site_col).cast("string"), F.lit(NO_SITE)).alias("_site"),
        F.transform(F.split(F.col(text_col), "\n"), line_key).alias("keys"))
    keys = stored(keys, "lines")
    return keys.select("_row", "_id", "_site", F.posexplode("keys").alias("pos", "key")).where("key is not null")


def spread_lines(lines: DataFrame, min_sites=MIN_SITES) -> DataFrame:
    """key, first (document and place of the first occurrence) of lines on at least `min_sites` sites."""
    sketched = stored(
        lines.groupBy("key").agg(F.hll_sketch_agg("_site", SKETCH_BITS).alias("sketch"),
                                 F.min(F.struct("_id", "pos")).alias("first"))
        .select("key", "first", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") > min_sites * (1 - MARGIN) - 1.5), "sketched")
    sure = sketched.where(F.col("sites") > min_sites * (1 + MARGIN) + 1)
    near = sketched.where(F.col("sites") <= min_sites * (1 + MARGIN) + 1).select("key", "first")
    exact = (lines.select("key", "_site").join(near.select("key"), "key", "left_semi").distinct()
             .groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites))
    return sure.select("key", "first").unionByName(near.join(exact.select("key"), "key"))


def drop_spread_lines(docs: DataFrame, id_col="doc_id", text_col="text", site_col="source",
                      min_sites=MIN_SITES) -> DataFrame:
    """All columns of `docs`, the text without later occurrences of spread lines, and lines_removed.

    Lines end at line feeds. A null text stays null; a text whose lines all go becomes empty. Rows that
    repeat both id and text are treated alike. Null ids come first in the order of documents. A column
    n_chars is recounted where the text changed, and one called lines_removed replaced.
    """
    lines = lines_of(docs, id_col, text_col, site_col)
    spread = spread_lines(lines, min_sites)
    later = (lines.join(spread, "key")
             .where(~(F.col("_id").eqNullSafe(F.col("first._id")) & (F.col("pos") == F.col("first.pos"))))
             .groupBy("_row").agg(F.collect_set("pos").alias("_gone")))
    marked = docs.withColumn("_row", row_key(id_col, text_col)).join(later, "_row", "left")
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n"),
                                 lambda line, i: ~F.array_contains(F.col("_gone"), i)), "\n")
    gone = F.col("_gone").isNotNull()
    columns = {text_col: F.when(gone, kept).otherwise(F.col(text_col))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(gone, F.length(kept).cast("long")).otherwise(F.col("n_chars"))
    return marked.select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns if c != "lines_removed"],
                         F.coalesce(F.size("_gone"), F.lit(0)).alias("lines_removed"))
