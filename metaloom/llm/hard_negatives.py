"""Hard negatives by cover trees over norm-augmented candidates.

A further coordinate lifts all candidates of a tree to one length, so large inner products with an anchor
are small angles. Nodes of a cover tree know the distance from their centre to the farthest candidate
under them; that covering radius bounds the inner products of all of these. A descent opens the node with
the greatest bound first, leaves out nodes whose bounds lie outside every window that still wants
candidates, and scores the candidates of leaves exactly, in whole numbers.

Candidates are dealt to cells around pivots and, where a cell is large, to parts of it; each part is one
tree, built by one task. Anchors in blocks meet trees in groups, so a task holds a bounded number of
both, and what it returns is a few rows an anchor. Positives are found first; each of them then asks for
a window of scores among the candidates of other labels.
"""

import io
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metaloom.llm.centroids import quantised
from metaloom.llm.common import stored

POSITIVES = NEGATIVES = 5
# Candidates of a tree, and of a leaf.
PART, LEAF = 4096, 16
# Pivots at most, and the rows they are chosen from: the rows with the smallest hashes of their ids.
PIVOTS, SAMPLE = 256, 2048
# Anchors of a block and trees of a group: what one task holds.
ANCHORS, TREES = 256, 8
# Nodes opened at a time, candidates for centres tried at a time.
OPENED, TRIED = 32, 64
# Squared lengths stay below this, so that all inner products fit 64 bits.
LONGEST = float(2 ** 61)
# Relative to the common length, above the rounding of any distance computed here.
SLACK = 1e-6


# Trees.

class Tree:
    """Nodes in breadth-first order, the children of each next to each other, as are the candidates of each leaf."""

    FIELDS = ("ids", "labels", "points", "centre", "radius", "child", "children", "first", "held")

    def __init__(self, **fields):
        for name in self.FIELDS:
            setattr(self, name, fields[name])
        squares = (self.points.astype(np.float64) ** 2).sum(axis=1)
        self.length = max(float(np.sqrt(squares.max())), 1.0)
        self.largest = float(np.abs(self.points).max(initial=0))
        self.plain = self.points.astype(np.float64)
        self.angle = 2 * np.arcsin(np.minimum(1.0, self.radius / (2 * self.length) + SLACK))

    @classmethod
    def build(cls, ids, labels, points, leaf=LEAF):
        """Over at least one point (int64). Children lie within half the power of two that covers their
        parent, their centres farther apart than that; the parent's centre is one of them."""
        plain = points.astype(np.float64)
        squares = (plain ** 2).sum(axis=1)
        most = squares.max()
        lifted = np.column_stack([plain, np.sqrt(np.maximum(most - squares, 0))])
        flat = SLACK * max(np.sqrt(most), 1.0)

        def distances(centres, members):
            products = lifted[centres] @ lifted[members].T
            return np.sqrt(np.maximum(2 * most - 2 * products, 0))

        order, nodes, waiting = [], [], [(0, np.arange(len(points)))]
        while waiting:  # breadth first: a whole level at a time
            level, waiting, after = waiting, [], len(nodes) + len(waiting)
            for centre, members in level:
                own = distances([centre], members)[0]
                radius = own.max() + flat
                node = {"centre": centre, "radius": radius, "child": after, "children": 0, "first": len(order), "held": 0}
                nodes.append(node)
                if len(members) <= leaf or own.max() <= flat:
                    node["held"] = len(members)
                    order.extend(members.tolist())
                    continue
                within = 2.0 ** (np.ceil(np.log2(own.max())) - 1)
                near = own <= within
                found, left = [(centre, members[near])], members[~near]
                while len(left):
                    tried = left[:TRIED]
                    apart, chosen = distances(tried, left), []
                    for k in range(len(tried)):
                        if all(apart[c, k] > within for c in chosen):
                            chosen.append(k)
                    covered = apart[chosen] <= within
                    covered[np.arange(len(chosen)), chosen] = True
                    who = np.where(covered.any(axis=0), covered.argmax(axis=0), -1)
                    found += [(left[c], left[who == i]) for i, c in enumerate(chosen)]
                    left = left[who < 0]
                node["children"] = len(found)
                waiting += found
                after += len(found)
        place = np.empty(len(points), dtype=np.int64)
        place[order] = np.arange(len(order))
        fields = {name: np.array([n[name] for n in nodes]) for name in cls.FIELDS[3:]}
        fields["centre"] = place[fields["centre"].astype(np.int64)]
        return cls(ids=ids[order], labels=labels[order], points=points[order], **fields)

    def to_bytes(self):
        narrow = np.min_scalar_type(-int(self.largest) - 1)
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS} | {"points": self.points.astype(narrow)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data):
        with np.load(io.BytesIO(data)) as held:
            return cls(**{name: held[name].astype(np.int64) if name == "points" else held[name] for name in cls.FIELDS})

    def products(self, anchor, at):
        """Exact inner products with the points at some places."""
        if anchor.size * self.largest * float(np.abs(anchor).max(initial=0)) < 2 ** 53:
            return (self.plain[at] @ anchor.astype(np.float64)).astype(np.int64)
        return self.points[at] @ anchor  # whole products fit; what wraps on the way wraps back

    def bounds(self, anchor, length, nodes):
        """(least, greatest) inner product that anything under the nodes can have with the anchor."""
        reach = max(length, 1.0) * self.length
        angle = np.arccos(np.clip(self.products(anchor, self.centre[nodes]) / reach, -1, 1))
        slack = 1e-9 * reach
        return (reach * np.cos(np.minimum(angle + self.angle[nodes], np.pi)) - slack,
                reach * np.cos(np.maximum(angle - self.angle[nodes], 0)) + slack)


def _ranges(first, held):
    """first[0], first[0] + 1, ... for held[0] numbers, then the next."""
    ends = np.cumsum(held)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - held), held)


class Wanted:
    """The best candidates found so far in each of an anchor's windows [low, high]."""

    def __init__(self, low, high, most):
        self.low, self.high, self.most = np.asarray(low, np.int64), np.asarray(high, np.int64), most
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in self.low]

    def least(self):
        """What a score must reach to be of use, per window."""
        return np.array([max(low, scores[-1]) if len(scores) == self.most else low
                         for low, (scores, _) in zip(self.low, self.found)], dtype=np.int64)

    def take(self, scores, ids, least):
        for w, (low, high) in enumerate(zip(least, self.high)):
            good = (scores >= low) & (scores <= high)
            if good.any():
                held, names = (np.concatenate(x) for x in zip(self.found[w], (scores[good], ids[good])))
                best = np.lexsort((names, -held))[:self.most]
                self.found[w] = held[best], names[best]


def descend(tree: Tree, anchor, own, label, same, wanted: Wanted, opened=OPENED):
    """Puts the tree's best candidates into `wanted`: those of the anchor's label (but not the anchor) if `same`, else of others."""
    length = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
    nodes = np.zeros(1, dtype=np.int64)
    least, most = tree.bounds(anchor, length, nodes)
    seen = 0
    while len(nodes):
        asked = wanted.least()
        useful = ((most[:, None] >= asked) & (least[:, None] <= wanted.high)).any(axis=1)
        nodes, least, most = nodes[useful], least[useful], most[useful]
        if len(nodes) > opened:
            split = np.argpartition(-most, opened)
            now, rest = split[:opened], split[opened:]
        else:
            now, rest = np.arange(len(nodes)), np.empty(0, dtype=np.int64)
        open_, nodes, least, most = nodes[now], nodes[rest], least[rest], most[rest]
        at = _ranges(tree.first[open_], tree.held[open_])
        at = at[(tree.labels[at] == label) & (tree.ids[at] != own) if same else tree.labels[at] != label]
        seen += len(at)
        if len(at):
            wanted.take(tree.products(anchor, at), tree.ids[at], asked)
        inner = _ranges(tree.child[open_], tree.children[open_])
        if len(inner):
            low, high = tree.bounds(anchor, length, inner)
            nodes, least, most = np.r_[nodes, inner], np.r_[least, low], np.r_[most, high]
    return seen


# Spread over Spark.

def _pivots(rows: DataFrame, count):
    """{length: points}: of the sample, by farthest first, about one for every PART rows."""
    sample = rows.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE).select("_v").collect()
    of_length: dict[int, list] = {}
    for (v,) in sample:
        of_length.setdefault(len(v), []).append(v)
    wanted = min(PIVOTS, -(-count // PART))
    found = {}
    for length, vectors in of_length.items():
        points = np.array(vectors, dtype=np.float64).reshape(len(vectors), length)
        chosen, far = [0], ((points - points[0]) ** 2).sum(axis=1)
        while len(chosen) < wanted and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        found[length] = points[chosen]
    return found


def _celled(pivots):
    """Adds the cell, the nearest pivot of the same length (0 where there is none)."""
    def assign(batches):
        for rows in batches:
            cell = np.zeros(len(rows), dtype=np.int32)
            for length, places in rows.groupby("_n").indices.items():
                if length in pivots and length:
                    points = np.stack(rows["_v"].to_numpy()[places]).astype(np.float64)
                    p = pivots[length]
                    cell[places] = ((p ** 2).sum(axis=1) - 2 * points @ p.T).argmin(axis=1)
            yield rows.assign(_cell=cell)
    return assign


def _points(vectors, length):
    return np.array([np.asarray(v, dtype=np.int64) for v in vectors], dtype=np.int64).reshape(len(vectors), int(length))


def _growing(key, rows):
    tree = Tree.build(rows["_id"].to_numpy(), rows["_label"].to_numpy(), _points(rows["_v"], key[0]))
    return pd.DataFrame({"_n": [key[0]], "_cell": [key[1]], "_part": [key[2]], "tree": [tree.to_bytes()]})


def _searching(same, most) -> Callable:
    def search(key, anchors, trees):
        out: dict[str, list] = {"anchor": [], "asked": [], "id": [], "score": []}
        if len(anchors) and len(trees):
            points = _points(anchors["_v"], key[0])
            own, labels = anchors["_id"].to_numpy(), anchors["_label"].to_numpy()
            wanted = [Wanted(low, high, most) for low, high in zip(anchors["_low"], anchors["_high"])]
            for data in trees["tree"]:
                tree = Tree.from_bytes(data)
                for i in range(len(anchors)):
                    descend(tree, points[i], own[i], labels[i], same, wanted[i])
            for i, w in enumerate(wanted):
                for asked, (scores, ids) in enumerate(w.found):
                    out["anchor"] += [own[i]] * len(ids)
                    out["asked"] += [asked] * len(ids)
                    out["id"] += ids.tolist()
                    out["score"] += scores.tolist()
        return pd.DataFrame(out)
    return search


def _best(anchors: DataFrame, trees: DataFrame, blocks: DataFrame, same, most) -> DataFrame:
    """(anchor, asked, id, score, rank): the best of each window (its place in `_low` and `_high`) over all trees."""
    # An anchor goes once to each group of trees of its length, a tree once to each block of anchors.
    near = anchors.join(blocks, "_n").withColumn("_block", F.pmod(F.xxhash64("_id"), "blocks"))
    near = near.withColumn("_group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1)))
    far = trees.join(blocks, "_n").withColumn("_group", F.pmod(F.xxhash64("_cell", "_part"), "groups"))
    far = far.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    keys = ["_n", "_block", "_group"]
    found = (near.select(*keys, "_id", "_label", "_v", "_low", "_high").groupBy(*keys)
             .cogroup(far.select(*keys, "tree").groupBy(*keys))
             .applyInPandas(_searching(same, most), "anchor bigint, asked int, id bigint, score bigint"))
    order = Window.partitionBy("anchor", "asked").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(vectors: DataFrame, anchors: Column, id_col="vec_id", vector_col="embedding", label_col="label",
         positives=POSITIVES, negatives=NEGATIVES, scale=256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchors` says which rows are anchors. An anchor's positives are its best rows of the same label; for
    each of them, the best rows of other labels with 80 % to 100 % of its score are returned, ranked
    from 1. Scores are inner products of floor(scale * x); ties go to the smaller id. A negative
    positive score has an empty window, one of zero that of zero.

    Rows without id or label, with a null vector, a null or non-finite component, or a length that 64 bits
    cannot hold take no part. Only vectors of one length meet. Ids and labels are whole numbers; of rows that
    repeat an id the smallest by label and vector takes part. An empty table gives no rows; other columns are
    ignored.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label_col).cast("bigint").alias("_label"),
                          F.col(vector_col).alias("_vector"), F.coalesce(anchors, F.lit(False)).alias("_anchor"))
    rows = quantised(rows.where("_id is not null and _label is not null"), "_vector", scale, longest=LONGEST)
    rows = (rows.groupBy("_id").agg(F.min(F.struct("_label", "_v", "_anchor")).alias("r")).select("_id", "r.*")
            .withColumn("_n", F.size("_v")))
    rows = stored(rows, "rows")
    pivots = _pivots(rows, rows.count())
    celled = stored(rows.mapInPandas(_celled(pivots), "_id bigint, _label bigint, _v array<bigint>, _anchor boolean, _n int, _cell int"), "cells")
    parts = celled.groupBy("_n", "_cell").agg(F.ceil(F.count("*") / PART).alias("_parts"))
    trees = stored(celled.join(parts, ["_n", "_cell"]).withColumn("_part", F.pmod(F.xxhash64("_id"), "_parts"))
                   .select("_n", "_cell", "_part", "_id", "_label", "_v").groupBy("_n", "_cell", "_part")
                   .applyInPandas(_growing, "_n int, _cell int, _part bigint, tree binary"), "trees")
    asking = celled.where("_anchor").select("_id", "_label", "_v", "_n")
    blocks = (asking.groupBy("_n").agg(F.ceil(F.count("*") / ANCHORS).alias("blocks"))
              .join(trees.groupBy("_n").agg(F.ceil(F.count("*") / TREES).alias("groups")), "_n"))
    wide = F.lit(2 ** 62)
    near = _best(asking.withColumn("_low", F.array(-wide)).withColumn("_high", F.array(wide)), trees, blocks, True, positives)
    near = stored(near.select("anchor", "rank", "id", "score"), "positives")
    asked = near.groupBy(F.col("anchor").alias("_id")).agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("asked"))
    # At least 80 % is what is left after the whole part of a fifth is taken off; below zero nothing can be both.
    asked = asked.select("_id", F.expr("transform(asked, p -> if(p.score >= 0, p.score - p.score div 5, p.score + 1))").alias("_low"),
                         F.col("asked.score").alias("_high"))
    far = _best(asking.join(asked, "_id"), trees, blocks, False, negatives)
    positive = near.select("anchor", (F.col("rank") - 1).alias("asked"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(positive, ["anchor", "asked"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
