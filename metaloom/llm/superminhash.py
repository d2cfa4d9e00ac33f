"""Near-duplicates by SuperMinHash signatures, banding, verification and union-find grouping.

Each shingle of a document draws, step by step, a slot from its own random permutation and a value that
grows with the step, so slots of one signature depend on each other and vary less than independent
ones; drawing stops once no slot can improve. Documents that agree on all slots of a band share a
bucket. A bucket is never expanded into all its pairs: every member is first verified against the
smallest leader of its buckets, then what stays outside a bucket's largest component against a few
members of that, and only what is still outside against all members, in blocks and with pairs inside
one component left out. Links are confirmed on full shingle sets.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.llm.common import ASCII_LOWER, WORD, components, stored

# 24 bands of 4 slots meet at a similarity of 0.8 in all but about 3 of a million pairs.
BANDS, ROWS = 24, 4
WORDS, PERCENT = 5, 80
# Members of a bucket that are held at once while the others pass by, and followers per copy of a leader.
BLOCK, FOLLOWERS = 64, 256
# Members of a bucket's largest component that the others are compared with before all of them are.
LEADERS = 8
KNOWN_WORDS = 400_000

_MIX, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x):
    """Scrambles 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of shingle hashes of texts; remembers the hashes of words."""

    def __init__(self, size):
        self.size = size
        self.find = re.compile(WORD).findall
        self.known = {}

    def _hashes(self, words):
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def words(self, text):
        return self.find(text.translate(ASCII_LOWER)) if text else []

    def shingles(self, words):
        """Sorted distinct 64-bit shingles; the whole sequence is one where there are fewer words."""
        if not words:
            return np.zeros(0, np.uint64)
        hashes = self._hashes(words)
        k = min(self.size, len(hashes))
        out = np.full(len(hashes) - k + 1, np.uint64(k))
        for j in range(k):
            out = _mixed(out * _STEP + hashes[j:len(hashes) - k + 1 + j])
        return np.unique(out)


def signatures(sets, slots=BANDS * ROWS):
    """One SuperMinHash signature per set, as an array of len(sets) x slots; empty sets get infinity."""
    signature = np.full((len(sets), slots), np.inf)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if not sizes.sum():
        return signature
    element = np.concatenate(sets).astype(np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(element), 1))
    flat = signature.reshape(-1)
    with np.errstate(over="ignore"):
        for j in range(slots):
            drawn = _mixed(element + np.uint64(2 * j + 1) * _STEP)
            pick = j + (_mixed(element + np.uint64(2 * j + 2) * _STEP) % np.uint64(slots - j)).astype(np.int64)
            rows = np.arange(len(element))
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, j]
            value = j + (drawn >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            np.minimum.at(flat, owner * slots + slot, value)
            open_ = signature.max(axis=1) >= j + 1  # else no later value can be smaller
            left = open_[owner]
            if not left.any():
                break
            if not left.all():
                element, owner, order = element[left], owner[left], order[left]
    return signature


def band_hashes(signature, bands=BANDS, rows=ROWS):
    """A 64-bit name per band of each signature."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    with np.errstate(over="ignore"):
        out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, bits.shape[:2]).copy()
        for j in range(rows):
            out = _mixed(out * _STEP + bits[:, :, j])
    return out.view(np.int64)


def similar(a, b, percent=PERCENT):
    """Whether 100 * |a and b| >= percent * |a or b|, for sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _signer(size, bands, rows):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            for low in range(0, batch.num_rows, 400):
                part = batch.slice(low, 400)
                words = [shingler.words(t) for t in part.column("text").to_pylist()]
                sets = [shingler.shingles(w) for w in words]
                signed = band_hashes(signatures(sets, bands * rows), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([xxhash.xxh128_digest(" ".join(w)) for w in words], pa.binary()),
                     pa.array(list(signed), pa.list_(pa.int64()))],
                    names=["_id", "n_shingles", "key", "bands"])
    return sign


def counts_of(shingles):
    """How many shingles fall into each of 512 classes; the overlap of two sets is no larger than
    the sum of the smaller counts."""
    return np.bincount((shingles & np.uint64(511)).astype(np.int64), minlength=512)


class _Member:
    """A document in a group; its shingles are made when they are first asked for."""

    def __init__(self, shingler, one, component, size, text):
        self.shingler, self.one, self.component, self.size, self.text = shingler, one, component, size, text
        self.shingles = self.counts = None

    def ready(self):
        if self.shingles is None:
            self.shingles = self.shingler.shingles(self.shingler.words(self.text.as_py()))
            self.counts = counts_of(self.shingles)
        return self

    def links_with(self, other, percent):
        if 100 * min(self.size, other.size) < percent * max(self.size, other.size):
            return False
        most = int(np.minimum(self.ready().counts, other.ready().counts).sum())
        return (100 * most >= percent * (self.size + other.size - most)
                and similar(self.shingles, other.shingles, percent))


def _verifier(size, percent):
    """Rows come sorted by group and salt, those with role 0 first: these are held, and the rows with
    role 1 are compared with them unless both are of one component."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        group, held, root = None, [], {}

        def find(x):
            while root.get(x, x) != x:
                root[x] = x = root.get(root[x], root[x])
            return x

        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("group", "salt", "role", "_id", "component", "n_shingles")]
            texts = batch.column("text")
            for i, (g, salt, role, one, component, n) in enumerate(zip(*columns)):
                if (g, salt) != group:
                    group, held, root = (g, salt), [], {}
                member = _Member(shingler, one, component, n, texts[i])
                if role == 0:
                    held.append(member)
                    continue
                for other in held:
                    if (other.one != one and find(other.component) != find(component)
                            and member.links_with(other, percent)):
                        found.append((other.one, one))
                        root[find(other.component)] = find(component)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])
    return verify


def _verified(held, passing, texts, size, percent) -> DataFrame:
    """Links (a, b). held and passing: group, salt, _id, component."""
    rows = (held.withColumn("role", F.lit(0)).unionByName(passing.withColumn("role", F.lit(1)))
            .join(texts, "_id").repartition("group", "salt").sortWithinPartitions("group", "salt", "role", "_id"))
    return rows.select("group", "salt", "role", "_id", "component", "n_shingles", "text").mapInArrow(
        _verifier(size, percent), "a bigint, b bigint")


def _open(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components: bucket, rep, component, major, minor.

    `major` is the bucket's largest component and `minor` the number of members outside it. Of
    buckets with the same members one is enough.
    """
    named = members.select("bucket", "rep").join(components(links).withColumnRenamed("node", "rep"), "rep", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "rep")), "named")
    parts = named.groupBy("bucket", "component").agg(
        F.count("*").alias("n"), F.expr("bit_xor(xxhash64(rep))").alias("x"), F.expr("bit_xor(xxhash64(rep, 1))").alias("y"))
    whole = (parts.groupBy("bucket").agg(
        F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("major"),
        F.expr("bit_xor(x)").alias("x"), F.expr("bit_xor(y)").alias("y")).where("parts > 1")
        .groupBy("n", "x", "y").agg(F.min(F.struct("bucket", "major")).alias("b")))
    whole = whole.select("b.bucket", F.col("b.major.component").alias("major"), (F.col("n") - F.col("b.major.n")).alias("minor"))
    return named.join(whole, "bucket")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", words=WORDS, percent=PERCENT,
                    bands=BANDS, rows=ROWS) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    A text's set is its distinct shingles of `words` words after lower-casing A-Z; texts with the same
    words in the same order are one node. Texts without words have no shingles and link with nothing.
    Ids are bigints and meant to be unique: rows that share one may be linked through it. A row
    without an id is not linked, has no component and is kept. An empty table gives no rows.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = stored(plain.mapInArrow(_signer(words, bands, rows), "_id bigint, n_shingles bigint, key binary, bands array<bigint>"),
                    "signatures")
    linkable = signed.where("n_shingles > 0 and _id is not null")
    classes = stored(linkable.groupBy("key").agg(F.min("_id").alias("rep")), "classes")
    reps = linkable.join(classes, ["key"]).where("_id = rep").select("rep", F.explode("bands").alias("bucket")).distinct()
    buckets = reps.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("leader")).where("n > 1")
    members = stored(reps.join(buckets, "bucket").select("bucket", "leader", "rep"), "members")
    wanted = members.select(F.col("rep").alias("_id")).distinct().join(
        linkable.join(classes, "key").where("_id = rep").groupBy("_id").agg(F.max("n_shingles").alias("n_shingles")), "_id")
    texts = stored(plain.join(wanted, "_id").dropDuplicates(["_id"]), "texts")

    # Each member against one leader.
    stars = members.where("leader <> rep").groupBy("rep").agg(F.min("leader").alias("leader"))
    sized = stars.groupBy("leader").agg(F.ceil(F.count("*") / FOLLOWERS).cast("int").alias("salts"))
    lead = sized.select(F.col("leader").alias("group"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                        F.col("leader").alias("_id"), F.col("leader").alias("component"))
    follow = stars.join(sized, "leader").select(
        F.col("leader").alias("group"), F.pmod(F.xxhash64("rep"), F.col("salts")).cast("int").alias("salt"),
        F.col("rep").alias("_id"), F.col("rep").alias("component"))
    links = stored(_verified(lead, follow, texts, words, percent), "links")

    # Members outside the largest component of a bucket against a few members of it.
    rest = stored(_open(members, links), "open")
    picked = rest.where("component = major").groupBy("bucket").agg(
        F.array(*[F.min_by("rep", F.xxhash64("rep", F.lit(i))) for i in range(LEADERS)]).alias("reps"),
        F.first("component").alias("component"), F.first("minor").alias("minor"))
    salts = F.ceil(F.col("minor") / FOLLOWERS).cast("int")
    lead = (picked.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
            .select(F.col("bucket").alias("group"), "salt", F.explode(F.array_distinct("reps")).alias("_id"), "component"))
    follow = rest.where("component <> major").select(
        F.col("bucket").alias("group"), F.pmod(F.xxhash64("rep"), salts).cast("int").alias("salt"), F.col("rep").alias("_id"), "component")
    links = stored(links.unionByName(_verified(lead, follow, texts, words, percent)), "links")

    # What is left outside, in blocks, against all members of the bucket.
    rest = stored(_open(members, links), "open")
    blocks = F.ceil(F.col("minor") / BLOCK).cast("int")
    held = rest.where("component <> major").select(
        F.col("bucket").alias("group"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("salt"), F.col("rep").alias("_id"), "component")
    passing = rest.select(F.col("bucket").alias("group"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("salt"),
                          F.col("rep").alias("_id"), "component")
    more = stored(_verified(held, passing, texts, words, percent), "links")
    joined = components(links.unionByName(more)).withColumnRenamed("node", "rep").withColumnRenamed("component", "_c")
    of_class = classes.join(joined, "rep", "left").select("key", F.coalesce("_c", "rep").alias("_component"))
    own = signed.select("_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("key")).alias("key"))
    found = (own.where("key is not null and _id is not null").join(of_class, "key").drop("key")
             .unionByName(own.where("key is null or _id is null").select("_id", "n_shingles", F.col("_id").alias("_component"))))
    return found.select(F.col("_id").alias(id_col), "n_shingles", F.col("_component").alias("component_id"),
                        F.col("_id").eqNullSafe(F.col("_component")).alias("kept"))
