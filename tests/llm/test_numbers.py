"""Centroids, hard negatives and rules of quality against brute force, and odd tables."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaloom.llm import centroids, hard_negatives, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Centroids.

def brute_clusters(rows, dimensions, clusters, rounds):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, v) for i, v in kept if sum(x * x for x in v) < 2 ** 60]
    centres = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:clusters]]

    def assign():
        distances = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres] for _, v in kept]
        return [(d.index(min(d)), min(d)) for d in distances]

    for _ in range(rounds):
        best = assign()
        for c in range(len(centres)):
            own = [v for (_, v), (b, _) in zip(kept, best) if b == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own)]
    return sorted((i, c, d, hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for (i, _), (c, d) in zip(kept, assign()))


@pytest.mark.parametrize("clusters, block", [(1, 8192), (7, 8192), (7, 16), (500, 8192)])
def test_clusters_against_brute_force(frame, monkeypatch, clusters, block):
    monkeypatch.setattr(centroids, "BLOCK", block)
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(draw.integers(0, 4), 0.3, 6).tolist()) for i in range(300)]
    rows += [(1000 + i, [0.5] * 6) for i in range(150)] + [(2000, [1e6, -1e6, 0.0, 1e5, 3.0, 7.0]), (2001, [1e200] * 6), (7, rows[9][1])]
    rows += [(3000, None), (3001, []), (3002, [1.0] * 5), (3003, [1.0, None] * 3), (3004, [float("nan")] * 6), (3005, [float("inf")] * 6)]
    vectors = frame(rows, "vec_id bigint, embedding array<double>").withColumn("cluster", F.lit("mine"))
    got = centroids.cluster(vectors, 6, clusters=clusters, rounds=3).collect()
    expected = brute_clusters(rows, 6, clusters, 3)
    assert sorted((r["vec_id"], r["cluster"], r["distance"], r["centroid_sha256"]) for r in got) == expected
    inertia = collections.Counter()
    for _, c, d, _ in expected:
        inertia[c] += d
    assert all(r["cluster_inertia"] == inertia[r["cluster"]] and r["inertia"] == sum(inertia.values()) for r in got)


def test_clusters_of_odd_tables(frame):
    rows = [(None, [1.0, 2.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0]), (6, [3.0, 3.0])]
    got = centroids.cluster(frame(rows, "vec_id bigint, embedding array<float>"), 2).collect()
    assert sorted((r["vec_id"] or 0, r["distance"]) for r in got) == [(0, 0), (5, 0), (5, 0), (6, 0)]
    none = centroids.cluster(frame([(1, None)], "vec_id bigint, embedding array<float>"), 2)
    assert none.count() == 0 and none.columns[:3] == ["vec_id", "cluster", "distance"]


# Hard negatives.

def brute_negatives(rows, is_anchor, positives=5, negatives=5):
    held = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = (label, [math.floor(256 * float(x)) for x in v])
        if sum(x * x for x in whole[1]) < 2 ** 61:
            held[i] = min(held.get(i, whole), whole)
    found = []
    for a, (label, v) in held.items():
        if not is_anchor(a):
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in held.items() if len(w) == len(v)]
        near = sorted((s, i) for s, i, other in scored if other == label and i != a)[:positives]
        for p, positive in near:
            far = sorted((s, i) for s, i, other in scored if other != label and 80 * -p <= 100 * -s <= 100 * -p)[:negatives]
            found += [(a, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(far, 1)]
    return sorted(found)


@pytest.mark.parametrize("part, leaf, anchors, trees", [(4096, 16, 256, 8), (60, 1, 5, 2)])
def test_negatives_against_brute_force(frame, monkeypatch, part, leaf, anchors, trees):
    for name, value in (("PART", part), ("ANCHORS", anchors), ("TREES", trees)):
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(hard_negatives.Tree.build.__func__, "__defaults__", (leaf,))
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(draw.integers(-1, 2), 0.4, 5).tolist(), int(draw.integers(0, 4))) for i in range(400)]
    rows += [(500 + i, [0.5] * 5, i % 3) for i in range(120)]  # copies: ties by id
    rows += [(700, [3e6, 1.0, 0.0, 0.0, 0.0], 1), (701, [2.9e6, 1.0, 0.0, 0.0, 0.0], 2), (710, [3e6] * 5, 1), (720, [0.0] * 5, 0), (721, [0.0] * 5, 1),
             (730, [1.0, 2.0], 1), (731, [1.0, 1.0], 1), (732, [1.0, 1.1], 2), (740, [], 1), (741, [], 1), (742, [], 2), (750, [-9.0] * 5, 7), (760, [9.0] * 5, 7)]
    rows += [(800, None, 1), (810, [1.0] * 5, None), (None, [1.0] * 5, 1), (820, [None] * 5, 1), (830, [float("nan")] * 5, 1), (20, [9.0] * 5, 3)]
    vectors = frame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("rank", F.lit("mine"))
    got = hard_negatives.mine(vectors, F.col("vec_id") % 10 == 0).collect()
    expected = brute_negatives(rows, lambda i: i % 10 == 0)
    assert sorted(tuple(r) for r in got) == expected and len(expected) > 500


def test_negatives_of_odd_tables(frame):
    kinds = "vec_id bigint, embedding array<float>, label int"
    assert hard_negatives.mine(frame([], kinds), F.lit(True)).count() == 0
    assert hard_negatives.mine(frame([(1, [1.0], 1), (2, [1.0], 2)], kinds), F.lit(True)).count() == 0
    assert hard_negatives.mine(frame([(1, [1.0], 1), (2, [1.0], 1), (3, [0.9], 2)], kinds), F.lit(None).cast("boolean")).count() == 0


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_cover_tree(spread):
    draw = np.random.default_rng(3)
    points = np.floor(256 * (draw.normal(0, 1, (6, 8))[draw.integers(0, 6, 900)] + draw.normal(0, spread, (900, 8)))).astype(np.int64)
    points[100:300] = points[0]
    tree = hard_negatives.Tree.from_bytes(hard_negatives.Tree.build(np.arange(900), np.zeros(900, int), points, leaf=4).to_bytes())
    assert sorted(tree.ids) == list(range(900)) and (tree.points == points[tree.ids]).all()
    squares = (points.astype(float) ** 2).sum(axis=1)
    lifted = np.column_stack([tree.points, np.sqrt(squares.max() - squares[tree.ids])])

    def under(node):
        if tree.held[node]:
            return list(range(tree.first[node], tree.first[node] + tree.held[node]))
        return [p for c in range(tree.child[node], tree.child[node] + tree.children[node]) for p in under(c)]

    anchor = np.floor(256 * draw.normal(0, 1, 8)).astype(np.int64)
    low, high = tree.bounds(anchor, float(np.sqrt((anchor ** 2).sum())), np.arange(len(tree.centre)))
    for node in range(len(tree.centre)):
        members, scores = under(node), tree.points[under(node)] @ anchor
        assert tree.centre[node] in members
        assert np.linalg.norm(lifted[members] - lifted[tree.centre[node]], axis=1).max() <= tree.radius[node]
        assert low[node] <= scores.min() and scores.max() <= high[node]
        if tree.children[node]:
            centres = tree.centre[tree.child[node]:tree.child[node] + tree.children[node]]
            within = 2.0 ** (np.ceil(np.log2(tree.radius[node])) - 1)
            apart = np.linalg.norm(lifted[centres][:, None] - lifted[centres][None], axis=2)
            assert tree.centre[node] in centres and apart[~np.eye(len(centres), dtype=bool)].min() > within - 1e-3
    # A descent on clustered points scores few of them, and finds the best.
    wanted = hard_negatives.Wanted([-2 ** 62], [2 ** 62], 5)
    seen = hard_negatives.descend(tree, anchor, -1, 0, True, wanted)
    products = points @ anchor
    assert wanted.found[0][1].tolist() == np.lexsort((np.arange(900), -products))[:5].tolist()
    assert spread == 1.0 or seen < 450


# Rules of quality.

def brute_measures(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = collections.Counter(windows)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_lines": len(lines),
            "n_echoed_words": sum(a == b for a, b in zip(words, words[1:])),
            "n_repeat_words": len({j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)})}


TEXTS = [None, "", " \n\t\x0b", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 40, "é ü ß z #$% | <b>", "l\nl\n\nl \n  \n l",
         "a b c d e f g h i a b c d e f g h j b c d e f g h i", "- one\n* two\n• three\nand so on...\nand …", " ".join(f"w{i % 700}" for i in range(30_000)),
         "\r\n".join(["the same line of the text"] * 5), "\U0001d4d0\U0001d4d1 " * 9]


def test_measures_against_brute_force(frame):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = quality_rules.measured(frame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        expected = brute_measures(TEXTS[r["doc_id"]])
        assert {k: r[k] for k in expected} == expected, TEXTS[r["doc_id"]]
    other = {r["doc_id"]: r for r in got}
    assert (other[10]["n_bullet_lines"], other[10]["n_cut_lines"]) == (3, 2)


def test_rules_are_a_table(frame):
    prose = "It is the rule of the house that a text of this kind stays where it was, and for what it is worth."
    rows = [(1, prose), (2, " ".join(w + "###" for w in prose.split())), (3, None), (3, None), (4, "Oneaea " * 40), (5, prose.replace(" ", " | ")),
            (6, " ".join(f"zz{i}" for i in range(30)))]
    docs = frame(rows, "doc_id bigint, text string").withColumn("n_words", F.lit("mine")).withColumn("kept", F.lit(9))
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert {i for i, r in got.items() if r["kept"]} == {1}
    assert got[2]["failed_rules"] == ["symbols"] and got[3]["failed_rules"] == ["few_words"]
    assert got[4]["failed_rules"] == ["few_stop_words", "echoed_words", "repeated_windows"] and "symbols" in got[5]["failed_rules"]
    assert got[6]["failed_rules"] == ["few_stop_words"] and got[1]["n_words"] == len(prose.split())
    assert quality_rules.judge(docs).count() == len(rows)
    assert quality_rules.judge(docs, rules=[]).where("kept").count() == len(rows)
    none = quality_rules.judge(docs, rules=[quality_rules.Rule("some", "n_symbols", high=0)]).where("kept").count()
    assert none == 5
    assert quality_rules.judge(frame([], "doc_id bigint, text string")).count() == 0


def test_rules_stay_in_the_engine(frame):
    plan = quality_rules.judge(frame([(1, "a")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
