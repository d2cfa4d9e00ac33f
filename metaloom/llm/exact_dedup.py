"""Exact duplicates by an extendible-hash index whose buckets are files in the shared folder.

A key is the 64-bit hash of a normalised text. The directory starts with one bucket and doubles while a
bucket would hold more than `capacity` entries, splitting only the overfull ones. Each bucket, a range of
keys, goes to one task, its owner, which reads the texts in the order of their keys, compares those that
share a key byte by byte, and chains the ones that differ; of equal ones it notes the smallest id and how
many there are. What it finds is the bucket's file, and the answer is read from there. Before texts are
sent to owners, map tasks fold equal ones batch by batch, so a text on a third of all rows arrives a few times.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaloom.llm.common import BLANKS, shared_path, stored

# The directory never has more than 2**MAX_DEPTH slots, whatever the corpus: it is metadata.
MAX_DEPTH = 16
# Entries of a bucket.
CAPACITY = 4096


@dataclass
class Index:
    """Where the bucket files are, and the directory: (first slot, last slot, bucket, local depth)."""

    path: str
    schema: object
    depth: int
    slots: list

    def entries(self, spark: SparkSession) -> DataFrame:
        """bucket, key, link (place in the chain of its key), digest, keep_id, group_size."""
        return spark.read.schema(self.schema).parquet(self.path)

    def lookup(self, rows: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
        """Which rows' texts are in the index already: id, keep_id (null if the text is new)."""
        probes = keyed(rows.select(id_col, text_col), text_col).drop(text_col, "_text")
        found = self.entries(rows.sparkSession).select("key", "digest", "keep_id")
        return probes.join(found, ["key", "digest"], "left").select(id_col, "keep_id")


def normalised(text):
    """Runs of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def keyed(rows: DataFrame, text_col="text") -> DataFrame:
    """Adds _text, key and digest."""
    return (rows.withColumn("_text", normalised(F.col(text_col)))
            .withColumn("key", F.xxhash64("_text"))
            .withColumn("digest", F.unhex(F.sha2("_text", 256))))


def directory(counts, capacity):
    """Splits from entry counts per slot of MAX_DEPTH bits; (depth, [(first, last, bucket, local depth)]).

    A bucket is the span of slots under one prefix. Overfull buckets split on their next bit; when one
    is as deep as the directory, the directory doubles.
    """
    depth, final, pending = 0, [], [(0, 0)]
    while pending:
        overfull = []
        for prefix, local in pending:
            width = 1 << (MAX_DEPTH - local)
            first = prefix * width
            held = sum(counts.get(s, 0) for s in range(first, first + width))
            if held > capacity and local < MAX_DEPTH:
                overfull.append((prefix, local))
            else:
                final.append((first, first + width - 1, local))
        if overfull:
            depth = max(depth, overfull[0][1] + 1)
        pending = [(2 * prefix + bit, local + 1) for prefix, local in overfull for bit in (0, 1)]
    final.sort()
    return depth, [(first, last, bucket, local) for bucket, (first, last, local) in enumerate(final)]


def slot(key):
    """The first MAX_DEPTH bits of a key."""
    return F.shiftrightunsigned(key, 64 - MAX_DEPTH)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a batch as one row: key, text, smallest id, how many."""
    for batch in batches:
        if batch.num_rows:
            found = pa.Table.from_batches([batch]).group_by(["key", "text"]).aggregate([("id", "min"), ([], "count_all")])
            yield from found.select(["key", "text", "id_min", "count_all"]).rename_columns(["key", "text", "id", "n"]).to_batches()


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An owner's rows, in the order of their keys, as entries. Only texts that share a key are held."""
    held_key, bucket, chain = None, None, {}

    def entries(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
             pa.array(columns[3], pa.binary()), pa.array(columns[4], kind), pa.array(columns[5], pa.int64())],
            names=["bucket", "key", "link", "digest", "keep_id", "group_size"])

    def linked():
        digests = {}
        for text, (least, n) in chain.items():
            digest = hashlib.sha256(text).digest()
            if digests.setdefault(digest, text) is not text:
                raise ValueError("two different texts share a key and a SHA-256 digest")
            yield digest, least, n

    kind = None
    for batch in batches:
        kind, found = batch.column("id").type, []
        texts = batch.column("text").cast(pa.binary())
        for place, key, text, least, n in zip(batch.column("bucket").to_pylist(), batch.column("key").to_pylist(), texts,
                                              batch.column("id").to_pylist(), batch.column("n").to_pylist()):
            if key != held_key:
                if chain:
                    found += [(bucket, held_key, link, *entry) for link, entry in enumerate(sorted(linked(), key=lambda e: e[0]), 1)]
                held_key, bucket, chain = key, place, {}
            # A dictionary of byte strings compares them in full where their hashes meet.
            text = text.as_py()
            before, count = chain.get(text, (None, 0))
            chain[text] = (least if before is None else before if least is None else min(before, least), count + n)
        if found:
            yield entries(found)
    if chain:
        yield entries([(bucket, held_key, link, *entry) for link, entry in enumerate(sorted(linked(), key=lambda e: e[0]), 1)])


def build(rows: DataFrame, id_col="doc_id", text_col="text", capacity=CAPACITY) -> Index:
    """Writes the index of all rows.

    The bucket capacity grows with the corpus where 2**MAX_DEPTH buckets would not hold it.
    """
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    keyed_rows = rows.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text"))
    folded = stored(keyed_rows.select(F.xxhash64("text").alias("key"), "text", "id")
                    .mapInArrow(_fold, f"key bigint, text string, id {kind}, n bigint"), "folded")
    # At most 2**MAX_DEPTH rows of two numbers, by construction.
    counts = {r[0]: r[1] for r in folded.groupBy(slot(F.col("key")).alias("s")).agg(F.approx_count_distinct("key")).collect()}
    depth, slots = directory(counts, max(capacity, sum(counts.values()) >> (MAX_DEPTH - 2)))
    owners = spark.createDataFrame([(s, b) for first, last, b, _ in slots for s in range(first, last + 1)],
                                   "s bigint, bucket int")
    owned = (folded.withColumn("s", slot(F.col("key"))).join(F.broadcast(owners), "s")
             .repartitionById(len(slots), F.col("bucket")).sortWithinPartitions("bucket", "key"))
    entries = owned.select("bucket", "key", "text", "id", "n").mapInArrow(
        _chain, f"bucket int, key bigint, link int, digest binary, keep_id {kind}, group_size bigint")
    path = shared_path(spark, "exact-index")
    entries.write.partitionBy("bucket").parquet(path)
    return Index(path, entries.schema, depth, slots)


def exact_duplicates(rows: DataFrame, id_col="doc_id", text_col="text", capacity=CAPACITY) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts (null is empty) the smallest id stays; rows that repeat that id with that text are
    all marked kept. A null id stays only in a group that has no other. An empty table gives no rows;
    other columns are ignored. Rows find their entry by key and SHA-256 digest; should two different texts
    ever share both, building the index fails.
    """
    entries = build(rows, id_col, text_col, capacity).entries(rows.sparkSession).select("key", "digest", "keep_id", "group_size")
    members = keyed(rows.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_raw")), "_raw").select("_id", "key", "digest")
    return members.join(entries, ["key", "digest"]).select(
        F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
