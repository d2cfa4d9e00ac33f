"""Exact, line and near-duplicate removal against brute force, and odd tables."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaloom.llm import exact_dedup, line_dedup, projections, superminhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in nodes}


# Exact duplicates.

def test_exact_groups(frame):
    rows = [(3, "a  b"), (1, "a\tb"), (2, "A b"), (5, None), (4, ""), (6, "a b "), (7, "x" * 200_000), (8, "x" * 200_000), (9, " ")]
    got = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(frame(rows, "doc_id bigint, text string")).collect()}
    keep = {3: 1, 1: 1, 2: 2, 5: 4, 4: 4, 6: 6, 7: 7, 8: 7, 9: 9}
    assert {i: r["keep_id"] for i, r in got.items()} == keep
    assert [got[i]["group_size"] for i in (3, 2, 5, 8)] == [2, 1, 2, 2]
    assert {i for i, r in got.items() if r["kept"]} == set(keep.values())
    assert got[3]["text_sha256"] == hashlib.sha256(b"a b").hexdigest()


def test_exact_odd_tables(frame):
    rows = [(None, "a", 1), (2, "a", 2), (2, "a", 3), (None, "b", 4)]
    got = exact_dedup.exact_duplicates(frame(rows, "doc_id bigint, text string, key int")).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in got) == [
        (0, 0, 1, True), (0, 2, 3, False), (2, 2, 3, True), (2, 2, 3, True)]
    assert exact_dedup.exact_duplicates(frame([], "doc_id bigint, text string")).count() == 0


def test_directory_splits_only_overfull_buckets():
    top = 1 << exact_dedup.MAX_DEPTH
    counts = {s: 10 for s in range(0, top // 8)}
    depth, slots = exact_dedup.directory(counts, capacity=10 * top // 32)
    assert depth == 5
    assert sorted({local for *_, local in slots}) == [1, 2, 3, 5]
    covered = [s for first, last, *_ in slots for s in (first, last)]
    assert covered[0] == 0 and covered[-1] == top - 1
    assert all(slots[i][1] + 1 == slots[i + 1][0] for i in range(len(slots) - 1))
    held = [sum(counts.get(s, 0) for s in range(first, last + 1)) for first, last, *_ in slots]
    assert max(held) <= 10 * top // 32


def test_index_finds_what_it_holds(spark, frame):
    index = exact_dedup.build(frame([(i, f"text {i % 50}") for i in range(200)], "doc_id bigint, text string"), capacity=5)
    assert len(index.slots) > 5
    assert index.entries(spark).count() == 50
    found = index.lookup(frame([(1, "text  7"), (2, "new")], "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["keep_id"] for r in found} == {1: 7, 2: None}


def test_owner_compares_texts_that_share_a_key():
    import pyarrow as pa

    rows = [(0, 7, "b", 5, 1), (0, 7, "a", 9, 2), (0, 7, "b", 2, 3), (0, 8, "c", None, 1), (1, 9, "a", 4, 1), (1, 9, "c", 3, 1)]
    names = ["bucket", "key", "text", "id", "n"]
    kinds = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names=names) for part in (rows[:2], rows[2:])]
    got = [r for b in exact_dedup._chain(iter(batches)) for r in b.to_pylist()]
    told = {(r["bucket"], r["key"], r["digest"]): (r["keep_id"], r["group_size"]) for r in got}
    digest = {t: hashlib.sha256(t.encode()).digest() for t in "abc"}
    assert told == {(0, 7, digest["a"]): (9, 2), (0, 7, digest["b"]): (2, 4), (0, 8, digest["c"]): (None, 1),
                    (1, 9, digest["a"]): (4, 1), (1, 9, digest["c"]): (3, 1)}
    assert sorted((r["key"], r["link"]) for r in got) == [(7, 1), (7, 2), (8, 1), (9, 1), (9, 2)]


@pytest.mark.parametrize("capacity", [3, 4096])
def test_exact_groups_over_split_buckets(frame, capacity):
    """A text on a third of all rows, ids as text, and a directory that doubles several times."""
    draw = random.Random(4)
    rows = [(f"{i:04d}", "hot  text" if i % 3 == 0 else f"t {draw.randrange(300)}") for i in range(1500)]
    got = exact_dedup.exact_duplicates(frame(rows, "doc_id string, text string"), capacity=capacity).collect()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(" +", " ", t)].append(i)
    expected = {i: (min(g), len(g)) for g in groups.values() for i in g}
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in got} == expected


# Lines.

def brute_lines(rows, min_sites):
    sites, first = collections.defaultdict(set), {}
    even = lambda line: re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")
    for i, text, site in sorted(rows, key=lambda r: r[0]):
        for pos, line in enumerate((text or "").split("\n")):
            sites[even(line)].add(site)
            first.setdefault(even(line), (i, pos))
    out = {}
    for i, text, _ in rows:
        keep = [line for pos, line in enumerate((text or "").split("\n"))
                if not even(line) or len(sites[even(line)]) < min_sites or first[even(line)] == (i, pos)]
        out[i] = None if text is None else "\n".join(keep)
    return out


@pytest.mark.parametrize("min_sites", [2, 3, 12])
def test_lines_against_brute_force(frame, min_sites):
    draw = random.Random(min_sites)
    lines = [f"line {k} of the corpus" for k in range(30)] + ["", "  "]
    rows = [(i, "\n".join(draw.choice(lines[:2 + i % 30]) for _ in range(draw.randint(0, 9))), f"s{draw.randint(0, 14)}")
            for i in range(150)]
    rows += [(900, None, "s1"), (901, "line  0\tof the corpus \nown", None), (902, "word " * 30_000, "s2")]
    got = line_dedup.drop_spread_lines(frame(rows, "doc_id bigint, text string, source string"), min_sites=min_sites)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == brute_lines(rows, min_sites)


def test_lines_keep_columns(frame):
    rows = [(i, "same", f"s{i}", 4, "k", i) for i in range(5)] + [(None, "same", "s9", 4, None, 7)]
    got = line_dedup.drop_spread_lines(frame(rows, "doc_id bigint, text string, source string, n_chars bigint, key string, pos int"))
    assert got.columns == ["doc_id", "text", "source", "n_chars", "key", "pos", "lines_removed"]
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"], r["n_chars"]) for r in got.collect()) == [
        (-1, "same", 4), (0, "", 0), (1, "", 0), (2, "", 0), (3, "", 0), (4, "", 0)]
    assert line_dedup.drop_spread_lines(frame([], "doc_id bigint, text string, source string")).count() == 0


def test_lines_stay_in_the_engine(frame):
    plan = line_dedup.drop_spread_lines(frame([(1, "a", "s")], "doc_id bigint, text string, source string"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


# Near-duplicate texts.

def shingle_set(text, k):
    words = WORD.findall((text or "").translate(superminhash.ASCII_LOWER))
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


@pytest.mark.parametrize("k", [4, 5])
def test_near_copies_against_brute_force(frame, k):
    draw = random.Random(k)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[draw.choice(vocabulary) for _ in range(draw.choice([1, 3, 8, 40, 120]))] for _ in range(60)]
    rows = []
    for b in base:
        for _ in range(draw.choice([1, 1, 2, 4])):
            copy = list(b)
            for _ in range(draw.choice([0, 0, 1, 2, 5])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "W1  w2\tw3"), (1004, "w1 w2 w3"), (1005, "z " * 50_000), (1006, "z " * 40_000)]
    chain = [f"c{i}" for i in range(200)]  # each near the next, the ends far apart
    rows += [(2000 + i, " ".join(chain[4 * i:4 * i + 120])) for i in range(15)]
    sets = {i: shingle_set(t, k) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components(sets, links)
    got = superminhash.near_duplicates(frame(rows, "doc_id bigint, text string"), words=k).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(links) > 50


def test_large_group_of_near_copies(frame):
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(words[:i % 300] + [f"x{i}"] + words[i % 300 + 1:])) for i in range(700)]
    got = superminhash.near_duplicates(frame(rows, "doc_id bigint, text string")).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == 700


def test_near_copies_odd_tables(frame):
    rows = [(None, "a b c d e f", 1), (5, "a b c d e f", 2), (5, "a b c d e f", 3), (4, "q", 4)]
    got = superminhash.near_duplicates(frame(rows, "doc_id bigint, text string, key int")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (4, 4, True), (5, 5, True), (5, 5, True)]
    assert superminhash.near_duplicates(frame([], "doc_id bigint, text string")).count() == 0


def test_signatures_estimate_similarity_and_vary_less():
    draw = np.random.default_rng(0)
    shared, n, found = 240, 300, []
    for _ in range(150):
        u = draw.integers(0, 2 ** 63, 2 * n - shared).astype(np.uint64)
        one, two = superminhash.signatures([u[:n], u[n - shared:]], 96)
        found.append((one == two).mean())
    similarity = shared / (2 * n - shared)
    assert abs(np.mean(found) - similarity) < 0.015
    # Where slots outnumber elements the ranks of one permutation leave far less to chance.
    few = [np.mean(np.equal(*superminhash.signatures([u[:8], u[2:10]], 96)))
           for u in (draw.integers(0, 2 ** 63, 10).astype(np.uint64) for _ in range(150))]
    assert np.var(few) < 0.6 * (0.6 * 0.4 / 96)


def test_signature_does_not_depend_on_the_batch():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 2 ** 63, n).astype(np.uint64)) for n in (1, 2, 50, 900)]
    together = superminhash.signatures(sets, 96)
    assert all((together[i] == superminhash.signatures([s], 96)[0]).all() for i, s in enumerate(sets))


# Embeddings.

def brute_vectors(rows, cosine):
    links = collections.Counter()
    pairs = []
    sound = [(i, np.array(v, dtype=np.float64), label) for i, v, label in rows
             if v is not None and label is not None and None not in v and np.isfinite(v).all() and any(v)]
    for x, (i, a, la) in enumerate(sound):
        for j, b, lb in sound[:x]:
            if la == lb and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    return links, components([r[0] for r in rows], pairs)


def test_vectors_against_brute_force(frame, monkeypatch):
    monkeypatch.setattr(projections, "PART", 40)  # so that cells split
    draw = np.random.default_rng(2)
    rows = []
    for c in range(12):
        centre = draw.standard_normal(24)
        for _ in range(int(draw.choice([1, 2, 12, 90]))):
            v = centre + draw.standard_normal(24) * draw.choice([0, 0.05, 0.12])
            rows.append((len(rows), [float(x) for x in v.astype(np.float32)], c % 3))
    rows += [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan")] * 24, 1), (903, rows[0][1], None),
             (904, [None] + [1.0] * 23, 1), (905, [float("inf")] * 24, 1), (906, [-0.0] + [1.0] * 23, 1), (907, [0.0] + [1.0] * 23, 1)]
    links, want = brute_vectors(rows, 0.98)
    got = projections.near_duplicates(frame(rows, "vec_id bigint, embedding array<float>, label int")).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == {r[0]: links[r[0]] for r in rows}
    assert {r["vec_id"]: r["component_id"] for r in got} == want
    assert sum(links.values()) > 500


def test_vectors_odd_tables(frame):
    schema = "vec_id bigint, embedding array<double>, label string, rep int"
    rows = [(None, [1.0, 0.0], "a", 1), (2, [1.0, 0.0], "a", 1), (2, [1.0, 0.0], "a", 1), (3, [1.0, 0.0, 0.0], "a", 1), (4, [2.0, 0.0], "a", 1),
            (5, [], "a", 1)]
    got = projections.near_duplicates(frame(rows, schema)).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, 0, True), (2, 2, 2, True), (2, 2, 2, True), (3, 0, 3, True), (4, 2, 2, False), (5, 0, 5, True)]
    assert projections.near_duplicates(frame([], schema)).count() == 0


def test_calibration_reaches_its_recall():
    for vectors in (10, 5_000, 10 ** 8):
        cuts, tables, width, window = projections.calibrated(vectors)
        draw = np.random.default_rng(3)
        a = draw.standard_normal((4_000, 64))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        side = draw.standard_normal((4_000, 64))
        side -= (side * a).sum(axis=1, keepdims=True) * a
        side /= np.linalg.norm(side, axis=1, keepdims=True)
        b = 0.98 * a + np.sqrt(1 - 0.98 ** 2) * side
        placed = projections.Tables(64, cuts, tables, width, window)
        (ca, la), (cb, lb) = placed.places(a), placed.places(b)
        hits = ((ca == cb) & (np.abs(la - lb) <= window)).sum(axis=1)
        assert (hits >= projections.COUNT).mean() >= 0.999


def test_sums_of_all_documents(spark, sf):
    """The registered near-duplicate query over a whole table."""
    from metaloom.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    sets = {r[0]: shingle_set(r[1], 4) for r in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = QUERIES["op7_superminhash"](spark, sf).select("doc_id", F.col("component_id")).collect()
    assert {r[0]: r[1] for r in got} == components(sets, links)
