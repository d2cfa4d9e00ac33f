"""What the operators of this subpackage share: white space, written tables, connected components."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# White space and words are ASCII ones throughout; both patterns read the same in Java, Python and SQL.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: str.translate table of A-Z to a-z; other letters keep their case.
ASCII_LOWER = str.maketrans(_UPPER, _LOWER)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(column):
    """A-Z to a-z, leaving every other letter alone."""
    return F.translate(column, _UPPER, _LOWER)


def word_count(text):
    """Words of a text; 0 where it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share.

    The cluster names the folder in `spark.checkpoint.dir`. A local session may leave it unset and
    then gets a temporary folder; a cluster that leaves it unset is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: lineage ends there, and rows stay as they are."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in the edges (a, b); a component's name is its smallest node.

    Alternating large-star and small-star rounds, each a minimum per node and a join back on it, until
    every component is a star. A node with very many edges is reduced before the shuffle, and its join
    is split by AQE; nothing is gathered per node. Each round is written, so lost executors cost at
    most one round.
    """
    def directed(high, low):
        return F.greatest(high, low).alias("a"), F.least(high, low).alias("b")

    def mark(stars):
        return stars.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).head()

    stars = stored(edges.where("a <> b").select(*directed("a", "b")).distinct(), "edges")
    before = mark(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = stored(least.select("a", F.col("m").alias("b")).unionByName(small).distinct(), "edges")
        after = mark(stars)
        if after == before:
            break
        before = after
    kept = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return kept.unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
