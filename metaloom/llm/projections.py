"""Embedding near-duplicates by counting collisions of projections.

Vectors of one label are sorted along many one-dimensional projections, one per table; in each table a
few further projections cut the order into cells, so that a window holds few vectors however many there
are. A pair collides in a table if it shares the cell and lies within the window that is centred on
either of them. Pairs with enough collisions are verified by their cosine. Window, tables and the count
asked for are set from the recall wanted at the threshold. A pair is counted once, in the first table
in which it collides: any task that meets both vectors can count all their collisions by itself, so no
pair is ever sent anywhere.
"""

from collections.abc import Iterator
from math import erf, exp, lgamma, log, log1p, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.llm.common import components, stored

COSINE, RECALL = 0.98, 0.99999
# Collisions asked for, and the mates a vector should meet in one table by chance.
COUNT, MATES = 2, 32
# Vectors of a cell compared in one task; larger cells are split into pairs of parts.
PART = 2048
# Pairs verified at a time.
CHUNK = 200_000


def _normal_within(x):
    return erf(x / sqrt(2))


def same_cell(distance, width):
    """How likely two points at a distance share a cell of a randomly shifted grid on a Gaussian projection."""
    c = width / distance
    return _normal_within(c) - 2 / (sqrt(2 * pi) * c) * (1 - exp(-c * c / 2))


def calibrated(vectors, cosine=COSINE, recall=RECALL, count=COUNT, mates=MATES):
    """(cuts per table, tables, cell width, window) for a number of vectors.

    Cell width and window are in terms of a unit Gaussian direction; the collisions of a pair at the
    threshold are binomial, and so many tables are taken that they reach `count` with chance `recall`.
    """
    near, far = sqrt(2 - 2 * cosine), sqrt(2)
    width, window = 5 * near, 2 * near
    cuts = 1
    while cuts < 16 and vectors * same_cell(far, width) ** cuts * _normal_within(window / far) > mates:
        cuts += 1
    hit = same_cell(near, width) ** cuts * _normal_within(window / near)

    def missed(tables):
        return sum(exp(lgamma(tables + 1) - lgamma(k + 1) - lgamma(tables - k + 1) + k * log(hit)
                       + (tables - k) * log1p(-hit)) for k in range(count))

    tables = count
    while missed(tables) > 1 - recall:
        tables += 1
    return cuts, tables, width, window


class Tables:
    """The projections of all tables; the same in every task by their seed."""

    def __init__(self, dimensions, cuts, tables, width, window, seed=3):
        draw = np.random.default_rng([seed, dimensions, cuts, tables])
        self.cuts, self.tables, self.width, self.window = cuts, tables, width, window
        self.cut = draw.standard_normal((dimensions, tables * cuts))
        self.shift = draw.uniform(0, width, tables * cuts)
        self.line = draw.standard_normal((dimensions, tables))

    def places(self, unit):
        """Cell numbers (vectors x tables) and places along the sorted projection of each table."""
        cell = np.floor((unit @ self.cut + self.shift) / self.width).astype(np.int64)
        cell = cell.reshape(len(unit), self.tables, self.cuts)
        mixed = np.zeros(cell.shape[:2], dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(self.cuts):
                mixed = (mixed ^ cell[:, :, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
        return mixed.view(np.int64), unit @ self.line


def unit_vectors(rows):
    """Rows divided by their lengths, in double precision; scaled first, so that squares keep finite."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def roots_of(n, a, b):
    """The smallest member of each of n nodes' components under the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
        if (root == before).all():
            return root


def linked_pairs(unit, cells, along, table, key, part, tables: Tables, cosine, count):
    """Pairs (i, j) that this run of rows owns and that are linked, chunk by chunk.

    Rows with one key are compared inside a window; where parts are given (0 and 1), only rows of
    different parts. The rows are sorted by key and place first.
    """
    own = along[np.arange(len(along)), table]
    order = np.lexsort((own, key))
    key, own = key[order], own[order]
    active, step = np.arange(len(order)), 0
    while True:
        step += 1
        active = active[active + step < len(order)]
        active = active[(key[active + step] == key[active]) & (own[active + step] - own[active] <= tables.window)]
        if not len(active):
            return
        for low in range(0, len(active), CHUNK):
            at = active[low:low + CHUNK]
            i, j = order[at], order[at + step]
            if part is not None:
                crossing = part[i] != part[j]
                i, j = i[crossing], j[crossing]
            if not len(i):
                continue
            hit = (cells[i] == cells[j]) & (np.abs(along[i] - along[j]) <= tables.window)
            good = (hit.sum(axis=1) >= count) & (hit.argmax(axis=1) == table[i])
            i, j = i[good], j[good]
            near = (unit[i] * unit[j]).sum(axis=1) >= cosine
            if near.any():
                yield i[near], j[near]


def _placer(dimensions, calibration, kind):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(dimensions, *calibration)
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, _ = tables.places(unit_vectors(_vectors(batch.column("v"), kind)))
            labels = np.array(batch.column("_group").to_numpy(zero_copy_only=False), dtype=np.int64).view(np.uint64)
            with np.errstate(over="ignore"):
                key = (cells.view(np.uint64) ^ labels[:, None]) + np.arange(1, tables.tables + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), tables.tables))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(rows), batch.column("_group").take(rows),
                 pa.array(np.tile(np.arange(tables.tables, dtype=np.int32), batch.num_rows)),
                 pa.array(key.view(np.int64).reshape(-1))], names=["rep", "_group", "table", "cell"])
    return place


def _matcher(dimensions, calibration, cosine, count, kind):
    """Rows come sorted by (cell, first, second); whole cells are gathered and compared together."""
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(dimensions, *calibration)
        waiting, rows = [], 0

        def compare(table):
            columns = {c: table.column(c).to_numpy() for c in ("rep", "size", "table", "cell", "first", "second", "part")}
            unit = unit_vectors(_vectors(table.column("v"), kind))
            cells, along = tables.places(unit)
            changed = np.zeros(table.num_rows, dtype=bool)
            for c in ("cell", "first", "second", "table"):
                changed[1:] |= columns[c][1:] != columns[c][:-1]
            key = np.cumsum(changed)
            part = np.where(columns["first"] == columns["second"], -1, columns["part"])
            part = np.where(part < 0, -1 - np.arange(table.num_rows), part)  # inside one part all pairs count
            links, ones, others = np.zeros(table.num_rows, np.int64), [], []
            size, held = columns["size"], 0
            for i, j in linked_pairs(unit, cells, along, columns["table"], key, part, tables, cosine, count):
                np.add.at(links, i, size[j])
                np.add.at(links, j, size[i])
                ones.append(i)
                others.append(j)
                held += len(i)
                if held > 5 * CHUNK:  # a forest says the same with no more links than rows
                    root = roots_of(len(links), np.concatenate(ones), np.concatenate(others))
                    child = np.flatnonzero(root != np.arange(len(root)))
                    ones, others, held = [child], [root[child]], len(child)
            touched = np.flatnonzero(links)
            root = roots_of(len(links), np.concatenate(ones), np.concatenate(others)) if ones else np.arange(len(links))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns["rep"][touched]), pa.array(columns["rep"][root[touched]]), pa.array(links[touched])],
                names=["a", "b", "links"])

        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            rows += batch.num_rows
            if rows < 20_000:
                continue
            whole = pa.Table.from_batches(waiting)
            marks = [whole.column(c).to_numpy() for c in ("cell", "first", "second")]
            same = np.ones(whole.num_rows, dtype=bool)
            for m in marks:
                same &= m == m[-1]
            cut = whole.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield compare(whole.slice(0, cut).combine_chunks())
                waiting, rows = whole.slice(cut).to_batches(), whole.num_rows - cut
        if rows:
            yield compare(pa.Table.from_batches(waiting).combine_chunks())
    return match


def near_duplicates(vectors: DataFrame, id_col="vec_id", vector_col="embedding", label_col="label", cosine=COSINE,
                    recall=RECALL, count=COUNT) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null and their cosine in double precision reaches
    `cosine`. Null, empty and zero vectors, and those with a null or non-finite component, link with
    nothing, nor do rows without label or id; vectors of different lengths do not link. Equal vectors of a label
    are one node with a size. Ids are bigints and meant to be unique. An empty table gives no rows.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label_col).alias("_label"), vector.alias("_vector"))
    sound = (F.col("_id").isNotNull() & F.col("_label").isNotNull() & (F.size("_vector") > 0)
             & F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("_vector", lambda x: x != 0))
    rows = rows.withColumn("_sound", F.coalesce(sound, F.lit(False)))
    rows = rows.withColumn("_key", F.when(F.col("_sound"), F.unhex(F.sha2(F.concat_ws(",", F.col("_label").cast("string"), F.transform(
        "_vector", lambda x: (x + F.lit(0.0)).cast("string"))), 256))))
    nodes = (rows.where("_sound").groupBy("_key").agg(F.min("_id").alias("rep"), F.count("*").alias("size")))
    nodes = stored(rows.where("_sound").join(nodes, "_key").where("_id = rep").dropDuplicates(["rep"])
                   .select("rep", "size", "_vector", F.size("_vector").alias("_n"), F.xxhash64("_label", F.size("_vector")).alias("_group")), "nodes")
    links, edges = None, None
    # Usually one length; each has projections of its own.
    lengths = nodes.groupBy("_n", "_group").count().groupBy("_n").agg(F.max("count").alias("most")).collect()
    single = dict(vectors.dtypes)[vector_col] == "array<float>"
    for length, most in lengths:
        found = stored(_found(nodes.where(F.col("_n") == length), length, calibrated(most, cosine, recall, count),
                              cosine, count, single), "links")
        links = found if links is None else links.unionByName(found)
    if links is None:
        of_node = nodes.select("rep", F.lit(0).cast("bigint").alias("links"), F.col("rep").alias("component"))
    else:
        summed = links.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
        named = components(links.select("a", "b")).withColumnRenamed("node", "rep")
        of_node = (nodes.join(summed, "rep", "left").join(named, "rep", "left")
                   .select("rep", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component")))
    keyed = rows.where("_sound").select("_id", "_key")
    node_of = keyed.groupBy("_key").agg(F.min("_id").alias("rep"), F.count("*").alias("size")).join(of_node, "rep")
    whole = keyed.join(node_of, "_key").select("_id", (F.col("links") + F.col("size") - 1).alias("n_links"), "component")
    whole = whole.unionByName(rows.where("not _sound").select("_id", F.lit(0).cast("bigint").alias("n_links"), F.col("_id").alias("component")))
    return whole.select(F.col("_id").alias(id_col), "n_links", F.col("component").alias("component_id"),
                        F.col("_id").eqNullSafe(F.col("component")).alias("kept"))


def _found(nodes: DataFrame, length, calibration, cosine, count, single) -> DataFrame:
    """(a, b, links): per task and node the sizes it links to, and a node of its component there."""
    kind = "<f4" if single else "<f8"
    nodes = nodes.mapInArrow(_packer(kind), "rep bigint, size bigint, _group bigint, v binary")
    nodes = stored(nodes, "packed")
    placed = stored(nodes.select("rep", "_group", "v").mapInArrow(_placer(length, calibration, kind),
                                                                 "rep bigint, _group bigint, table int, cell bigint"), "placed")
    cells = placed.groupBy("cell").count().where("count > 1")
    cells = cells.select("cell", F.ceil(F.col("count") / PART).cast("int").alias("parts"))
    rows = placed.join(cells, "cell").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("rep", "table", "cell", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"), "part")
    rows = (rows.join(nodes.select("rep", "size", "v"), "rep").repartition("cell", "first", "second")
            .sortWithinPartitions("cell", "first", "second", "table"))
    return rows.select("rep", "size", "table", "cell", "first", "second", "part", "v").mapInArrow(
        _matcher(length, calibration, cosine, count, kind), "a bigint, b bigint, links bigint")


def _packer(kind):
    """Vectors as bytes; single precision where the table has no more, computed with in double."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("_vector").flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("size"), batch.column("_group"),
                                              pa.array([v.tobytes() for v in flat], pa.binary())],
                                             names=["rep", "size", "_group", "v"])
    return pack


def _vectors(column, kind):
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1).astype(np.float64)
