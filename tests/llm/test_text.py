"""Extraction, language model, packing, mixing, toxicity and archives."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from metaloom.llm import backoff, extraction, mixing, packing, toxicity, warc
from metaloom.llm.common import ASCII_LOWER

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(["words"] * 30)


# Extraction.

@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>", ""), ("no markup, little text", ""), (LONG, LONG),
    ("<nav>menu</nav><main><p>Hi</p>\n<p> a \n b&nbsp;&amp;&#233;</p></main><footer>f</footer>", "Hi a b &é"),
    (f"<div class='top-header'>Site</div><h1>T</h1><p>{LONG}</p><p>Short.</p><div id='sidebar'><p>{LONG}</p></div>", f"T {LONG} Short."),
    (f"<p>{LONG}</p><section class='comments'><article>{LONG}</article></section>", LONG),
    (f"<article><h1>T</h1><p>{LONG}<div class='ad'>Buy</div><p>End</p></article><p>Copyright us", f"T {LONG} End"),
    (f"<div class='page with-sidebar'><article>{LONG}</article></div>", LONG),
    (f"<div class='menu'><ul><li>x</ul><article>{LONG}</article>", LONG),
    (f"<script>var a = '<p>no</p>';</script><style>p</style><article>{LONG}<!-- <p>no --></article>", LONG),
    (f"<form>{LONG}</form><div role='alert'>{LONG}</div><div class='cookie-notice'>{LONG}</div>", ""),
    ("<ul>" + "<li><a href='/x'>a link of some length</a></li>" * 9 + f"</ul><div>{LONG}</div>", LONG),
    (f"<td>{LONG}<td>cell<a title='a > b'> &lt;b&gt;", f"{LONG} cell <b>"),
    (f"<article>one <b>two</b>three<br>four</article", "one twothree four"),
])
def test_pages(page, text):
    assert extraction.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<h1>Title</h1><div class='share'>Share</div><p>{LONG}</p>", f"Title {LONG}"),
    (f"<h1><a href='/x'>Title</a></h1><div class='share'>Share</div><p>{LONG}</p>", f"Title {LONG}"),
    (f"<h1>Title</h1><div class='share'>Share</div><article>{LONG}</article>", f"Title {LONG}"),
    (f"<h1>Title<h2>More</h2><nav>Top</nav><p>{LONG}", f"Title More {LONG}"),
    (f"<p>Site</p><p>and</p><p>motto</p><h1>Title</h1><p>One.</p><p>Two.</p><p>Three.</p><p>{LONG}", f"Title One. Two. Three. {LONG}"),
    (f"<h1>Site</h1><p>motto</p><nav>Menu</nav><article>{LONG}</article>", LONG),
    (f"<p>{LONG}</p><div class='ad'>Buy</div><p>Short end.</p>", f"{LONG} Short end."),
    (f"<p>{LONG}</p><form>Join<input></form><p>Short.</p><div class='notice'>Note</div><p>End.</p>", f"{LONG} Short. End."),
    ("<p>Half of what it takes, and as much.</p><div class='ad'>Buy</div><p>And half of it after the advert, too.</p>",
     "Half of what it takes, and as much. And half of it after the advert, too."),
    ("<nav>Menu</nav><h1>Title</h1><div class='share'>Share</div><p>One short article.</p><footer>f</footer>", "Title One short article."),
    ("<div>One short article.</div>", "One short article."),
    ("".join(f"<p>line {i}</p>" for i in range(30)), " ".join(f"line {i}" for i in range(30))),
    ("<ul>" + "<li><a href='/x'>a link of some length</a> today</li>" * 9 + "</ul>", ""),
    (f"<p>Site</p><nav>Menu</nav><article>{LONG}</article><div class='ad'>Buy</div><p>Imprint</p>", LONG),
    (f"<nav><h1>Site</h1></nav><p>{LONG}</p><h3><a href='/y'>Next</a></h3>", LONG),
])
def test_pages_run_on_across_asides(page, text):
    assert extraction.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<div class='search-result-article'><p>{LONG}</p></div>", LONG), (f"<p class='notice-board'>{LONG}</p>", LONG),
    (f"<h1 class='post-header'>Title</h1><p>{LONG}</p>", f"Title {LONG}"), (f"<div class='form'>{LONG}</div>", LONG),
    (f"<form id='aspnet'><h1>Title</h1><p>{LONG}</p><nav>Menu</nav></form>", f"Title {LONG}"),
    (f"<div class='comments'><p>{LONG}</p></div>", ""), (f"<nav>{LONG}</nav>", ""),
    (f"<div class='sidebar'>{LONG} {LONG}</div><article>Short.</article>", "Short."),
])
def test_names_do_not_decide_alone(page, text):
    assert extraction.main_text(page) == text


def test_made_pages_without_article():
    """Pages put together from parts; what is text is known, whatever the names say."""
    draw = random.Random(5)
    for _ in range(250):
        sentence = lambda: " ".join(draw.choice(["word", "longer", "sentences", "of", "the", "page"]) for _ in range(draw.randint(20, 60)))
        body, expected = [], []
        title = f"Title {draw.randrange(100)}"
        name = draw.choice(["", " class='post-header'", " id='search-title'", " class='title'"])
        body.append(f"<h1{name}>{title}</h1>")
        expected.append(title)
        for k in range(draw.randint(1, 6)):
            text = sentence() if k != 2 else "Short one."
            body.append(f"<p{draw.choice(['', ' class=text', ' class=has-sidebar'])}>{text}</p>")
            expected.append(text)
            if draw.random() < 0.5:
                body.append(draw.choice(["<div class='ad-box'>Buy now</div>", "<aside>Related: <a href=/x>more of it</a></aside>", "<div class='share'>Tell others</div>",
                                         "<form>Your mail<input><button>Join</button></form>", "<script>var a = '<p>no</p>';</script>"]))
        wrapper = draw.choice(["<div>{}</div>", "<div class='page with-sidebar'>{}</div>", "<section id='story-content'>{}</section>", "<div class='widget-body'>{}</div>"])
        menu = "<ul class='menu'>" + "".join(f"<li><a href='/{i}'>Part {i}</a></li>" for i in range(8)) + "</ul>"
        page = f"<html><head><title>x</title></head><body><nav>{menu}</nav>{wrapper.format(chr(10).join(body))}<div id='sidebar'><p>Archive</p></div><footer>Imprint</footer></body></html>"
        assert extraction.main_text(page) == " ".join(expected), page


def test_pages_of_many_containers_take_linear_time():
    import time

    def seconds(n):
        started = time.process_time()
        extraction.main_text("<div class=menu><article>x</article></div>" * n)
        extraction.main_text("<div class=menu>x" * n)
        return time.process_time() - started

    seconds(100)
    assert seconds(20_000) < 15 * seconds(4_000)


def test_surge_and_dive():
    weights = [5, 0, 0, 0, 40, 50, 3, 0, 2, 0, 0, 0, 7, np.nan, 200, 1]
    kept = extraction.kept_lines(weights)
    assert np.flatnonzero(kept).tolist() == [4, 5, 6, 7, 8, 14, 15]


def test_long_and_broken_pages_end():
    assert extraction.main_text("<article>" + "<div title='" * 3000) is not None
    assert extraction.main_text("<" * 100_000) is not None
    assert len(extraction.main_text("<article>" + "<p>x" * 100_000)) == 199_999


def test_extract_keeps_columns(frame):
    rows = [(1, "u", f"<article>{LONG}</article>", "old"), (None, None, None, None), (1, "u", f"<article>{LONG}</article>", "old")]
    got = extraction.extract(frame(rows, "page_id bigint, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["text"], r["n_chars"]) for r in got.collect()) == [("", 0), (LONG, len(LONG)), (LONG, len(LONG))]
    assert extraction.extract(frame([], "page_id bigint, html string")).count() == 0


# Language model.

def test_scores_against_brute_force(frame, monkeypatch):
    monkeypatch.setattr(backoff, "CHUNK_TOKENS", 150)
    monkeypatch.setattr(backoff, "RANGE_KEYS", 60)
    draw = random.Random(1)
    words = [f"W{min(int(draw.expovariate(0.1)), 60)}" for _ in range(4000)]
    texts = [" ".join(words[i:i + draw.choice([0, 1, 5, 40])]) for i in range(0, 3000, 30)] + [None, "", "é É x", "new words", "a " * 2000]
    rows = list(enumerate(texts))
    got = backoff.score(frame(rows, "doc_id bigint, text string"), F.col("doc_id") % 5 == 2).collect()
    tokens = {i: [*WORD.findall((t or "").translate(ASCII_LOWER)), "<end>"] for i, t in rows}
    training = [i for i in tokens if i % 5 != 2]
    count = collections.Counter(w for i in training for w in tokens[i])
    total, distinct = sum(count.values()), len(count)
    pairs = collections.Counter(p for i in training for p in zip(["<begin>", *tokens[i]], tokens[i]))
    before = {**count, "<begin>": len(training)}
    ones, sums = collections.Counter(), collections.Counter()
    for (h, _), n in pairs.items():
        sums[int(math.log2(before[h]))] += n
        ones[int(math.log2(before[h]))] += n == 1
    share = {b: min(backoff.MOST, max(backoff.LEAST, ones[b] / sums[b])) for b in sums}
    assert len(got) == len(rows)
    for r in got:
        own = tokens[r["doc_id"]]
        base = [(count[w] + 1) / (total + distinct + 1) for w in own]
        p = []
        for h, w, b in zip(["<begin>", *own], own, base):
            n = before.get(h, 0)
            s = share[int(math.log2(n))] if n else 1.0
            p.append((1 - s) * pairs[h, w] / n + s * b if n else b)
        assert r["held_out"] == (r["doc_id"] % 5 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in count for w in own), total)
        assert r["base_score"] == pytest.approx(sum(map(math.log10, base)), abs=1e-8)
        assert r["score"] == pytest.approx(sum(map(math.log10, p)), abs=1e-8)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders_against_brute_force(frame, monkeypatch, order):
    monkeypatch.setattr(backoff, "CHUNK_TOKENS", 120)
    monkeypatch.setattr(backoff, "RANGE_KEYS", 40)
    monkeypatch.setattr(backoff, "FAN", 3)  # ranges in several levels
    draw = random.Random(order)
    words = [f"w{min(int(draw.expovariate(0.4)), 30)}" for _ in range(3000)]
    texts = [" ".join(words[i:i + draw.choice([0, 1, 3, 40])]) for i in range(0, 3000, 30)] + [None, "", "w1 new w1 w2", "w0 " * 300]
    rows = list(enumerate(texts))
    got = backoff.score(frame(rows, "doc_id bigint, text string"), F.col("doc_id") % 4 == 1, order=order).collect()
    tokens = {i: ["<begin>", *WORD.findall(t or ""), "<end>"] for i, t in rows}
    training = [i for i in tokens if i % 4 != 1]
    grams = collections.Counter(tuple(tokens[i][at - n:at]) for i in training for n in range(1, order + 1)
                                for at in range(n, len(tokens[i]) + 1))
    single = {g: n for g, n in grams.items() if len(g) == 1 and g != ("<begin>",)}
    ones, sums = collections.Counter(), collections.Counter()
    for g, n in grams.items():
        if len(g) > 1:
            band = len(g) - 1, int(math.log2(grams[g[:-1]]))
            sums[band] += n
            ones[band] += n == 1

    def p(h, w):
        if not h:
            return (grams[(w,)] + 1) / (sum(single.values()) + len(single) + 1)
        if not grams[h]:
            return p(h[1:], w)
        band = len(h), int(math.log2(grams[h]))
        share = min(backoff.MOST, max(backoff.LEAST, ones[band] / sums[band]))
        return (1 - share) * grams[h + (w,)] / grams[h] + share * p(h[1:], w)

    assert len(got) == len(rows)
    for r in got:
        own = tokens[r["doc_id"]]
        expected = sum(math.log10(p(tuple(own[max(0, at - order + 1):at]), own[at])) for at in range(1, len(own)))
        assert r["score"] == pytest.approx(expected, abs=1e-8)


def test_ranges_in_levels(monkeypatch):
    assert backoff._widths(1) == [1] and backoff._widths(1000) == [1000]
    assert backoff._widths(1025) == [33, 1089]
    monkeypatch.setattr(backoff, "FAN", 3)
    assert backoff._widths(20) == [3, 9, 27]
    keys = np.sort(np.random.default_rng(0).integers(0, 1 << backoff.KEY_BITS, 500).astype(np.uint64))
    fine = backoff._parts(keys, 27, 0, 27)
    coarse = backoff._parts(keys, 9, 0, 9)
    assert coarse == fine[::3]


def test_states_are_distributions():
    counts = np.array([6, 3, 4, 2, 1])
    pair_counts = np.array([[0, 0, 2, 1, 0], [0, 0, 1, 1, 1], [3, 0, 1, 0, 0], [2, 0, 0, 0, 0], [1, 0, 0, 0, 0]])
    pair_counts[0] = 0
    words = np.array([0, 2, 3, 4])
    total, distinct = counts[words].sum(), len(words)
    model = backoff.Automaton(counts, total, distinct, np.full(64, 0.3))
    for state in (1, 2, 3, 4):
        arcs = model.arcs(np.full(4, state), words, pair_counts[state, words] * counts[state] // max(1, pair_counts[state, words].sum()))
        p = np.where(np.isnan(arcs), 10 ** (model.fail[state] + model.root[words]), 10 ** arcs)
        seen = pair_counts[state, words] * counts[state] // max(1, pair_counts[state, words].sum())
        unknown = model.share[state] / (total + distinct + 1)
        assert p.sum() + unknown + (1 - model.share[state]) * (1 - seen.sum() / counts[state]) == pytest.approx(1)


def test_counts_beyond_32_bits():
    keys, counts = np.array([3, 9], "<u8"), np.array([0xF0000000, 2], "<u4")
    row = {"r": 0, "keys": backoff.pack(keys), "counts": backoff.pack(counts), "bands": backoff.pack(np.ones(2, np.uint8))}
    got = backoff._answer(pd.DataFrame([{"chunk": c, **row} for c in range(3)]))
    small = backoff._answer(pd.DataFrame([{"chunk": 0, **row, "r": 1}]))
    for chunk in range(3):
        parts = [*got[got["chunk"] == chunk].to_dict("records"), *small[small["chunk"] == 0].to_dict("records")]
        assert backoff._answers({"words": parts}, "words").tolist() == [3 * 0xF0000000, 6, 0xF0000000, 2]


def test_scores_of_odd_tables(frame):
    rows = [(None, "a b", 1), (1, "a b", 1), (1, "a b", 1)]
    got = backoff.score(frame(rows, "doc_id bigint, text string, score int"), F.lit(None).cast("boolean")).collect()
    assert len(got) == 3 and len({r["score"] for r in got}) == 1 and got[0]["train_tokens"] == 9
    got = backoff.score(frame(rows, "doc_id bigint, text string, score int"), F.lit(True)).collect()
    assert {(r["base_score"], r["n_known"]) for r in got} == {(0.0, 0)}
    assert backoff.score(frame([], "doc_id bigint, text string"), F.lit(False)).count() == 0


# Packing.

@pytest.fixture(scope="module")
def tokenizer():
    from public_tokenizers import path

    return path("word_bpe_49k.json")


def test_words_are_encoded_as_the_text_is(tokenizer):
    draw = random.Random(4)
    letters = "aAbBéÉßİıſ'’s’t'll漢字😀é́x01   ​\x1c\x85,.-\t\n"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(400)] + ["", " "]
    words = packing.WordTokenizer(tokenizer)
    assert [a.tolist() for a in words.encode(texts)] == [words.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [a.tolist() for a in words.encode(texts[::-1])][::-1] == [words.whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_added_tokens_are_encoded_as_in_the_text(tokenizer):
    texts = [f"plain words {w} and {w} again" for t in ("<|endoftext|>", "<|startoftext|>")
             for w in (t, f"foo{t}bar", f"É{t}'s", f"漢{t}", t + t, t.upper(), t[:-1], f"<{t}>", f"x{t[:5]}{t}")]
    texts = ["no such word"] * 3 + texts + ["<|endoftext|>", "a<|endoftext|>\n<|startoftext|> <|endoftext|><|startoftext|>b"]
    words = packing.WordTokenizer(tokenizer)
    want = [words.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert words.plain and sum(49407 in ids for ids in want) == 9 and sum(49406 in ids for ids in want) == 8
    assert [a.tolist() for a in words.encode(texts)] == want
    for text in texts:  # also first of all that a worker sees
        assert packing.WordTokenizer(tokenizer).encode([text])[0].tolist() == words.whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("lengths", [[], [4], [10] * 7, "random", "thirds", "halves"])
def test_evolved_packings(lengths):
    draw = np.random.default_rng(5)
    lengths = {"random": draw.integers(1, 99, 400).tolist(), "thirds": draw.integers(30, 36, 300).tolist(),
               "halves": draw.integers(40, 60, 300).tolist()}.get(lengths if isinstance(lengths, str) else "", lengths)
    order = sorted(range(len(lengths)), key=lambda p: -lengths[p])
    plain = packing.best_fit(lengths, order, 100)
    best = packing.evolve(lengths, [], 100, 1)
    assert sorted(p for b in best for p in b) == list(range(len(lengths)))
    assert all(sum(lengths[p] for p in b) <= 100 for b in best)
    assert -(-sum(lengths) // 100) <= len(best) <= len(plain)
    assert len(packing.evolve(lengths, [best], 100, 2)) <= len(best)


def test_crossover_keeps_injected_bins_whole():
    draw = np.random.default_rng(6)
    lengths = draw.integers(1, 60, 200).tolist()
    order = list(range(200))
    mother, father = packing.best_fit(lengths, order, 100), packing.best_fit(lengths, order[::-1], 100)
    child = packing.crossover(lengths, mother, father, 100, draw)
    assert sorted(p for b in child for p in b) == order
    whole = {frozenset(b) for b in father}
    assert sum(any(f <= set(b) for f in whole) for b in child) >= len(father) // 4


def test_packed_documents(frame, tokenizer):
    draw = random.Random(7)
    rows = [(i, " ".join(draw.choice(["alpha", "beta", "gammas", "xyzzy"]) for _ in range(draw.randint(0, 60))), 0) for i in range(300)]
    rows += [(500, None, 0), (501, "", 0), (502, "word " * 1000, 0), (None, "alpha", 0), (7, "twice", 0), (7, "twice", 0)]
    got = packing.pack(frame(rows, "doc_id bigint, text string, piece int"), tokenizer, capacity=64, shard_pieces=100).collect()
    whole = packing.WordTokenizer(tokenizer).whole
    want = collections.Counter()
    for i, text, _ in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[start:start + 64], dtype="<u4")
            want[i, k, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 64
    assert len(bins) <= -(-sum(r["length"] for r in got) // 64) + 3
    assert packing.pack(frame([], "doc_id bigint, text string"), tokenizer).count() == 0


# Mixing.

def brute_targets(sizes, weights, most):
    total, capped = sum(sizes), set()
    while True:
        rest = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(most * sizes[i] for i in capped)
        share = {i: left * weights[i] / sum(weights[j] for j in rest) for i in rest} if rest else {}
        above = [i for i in rest if share[i] > most * sizes[i]]
        if not above:
            return [most * sizes[i] if i in capped else share[i] for i in range(len(sizes))]
        capped.update(above)


def test_targets_and_seats():
    draw = random.Random(8)
    for _ in range(200):
        n = draw.randint(1, 9)
        votes, seats = [draw.randint(0, 40) for _ in range(n)], draw.randint(0, 60)
        want = [0] * n
        for _ in range(seats if sum(votes) else 0):  # one seat after another to the highest quotient
            best = max(range(n), key=lambda i: (votes[i] / (2 * want[i] + 1), -i))
            want[best] += 1
        assert mixing.apportion(votes, seats).tolist() == want
    assert mixing.apportion([3] * 1000 + [5000], 400).sum() == 400


@pytest.mark.parametrize("sizes, block", [([900, 0, 50, 50, 50, 5, 1, 900, 900, 5], 1), ([1000] * 40, 7), ([0, 0], 1), ([3_000_000_000, 17, 2_000_000], 16)])
def test_sources_are_planned_by_sums(frame, sizes, block):
    names = [None if i == 3 else f"s{i:02d}" for i in range(len(sizes))]
    got = {r["_source"]: r for r in mixing.planned(frame(list(zip(names, sizes)), "_source string, source_size bigint"), block).collect()}
    order = sorted(range(len(sizes)), key=lambda i: (names[i] is None, names[i] or ""))
    want = brute_targets([sizes[i] for i in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 3)
    assert [got[names[i]]["target"] for i in order] == pytest.approx(want)
    assert [got[names[i]]["_blocks"] for i in order] == mixing.apportion([got[names[i]]["target"] for i in order], sum(sizes) // block).tolist()


def test_mix(frame):
    draw = random.Random(9)
    rows = [(i, " ".join(f"{i}-{k}" for k in range(draw.choice([0, 1, 20, 90]))), draw.choice(["a", "a", "a", "b", "B", "c", None]), 0)
            for i in range(2000)]
    rows += [(5000, "z " * 3000, "é", 0), (5001, None, "é", 0), (5002, "q r", "tiny", 0)]
    docs = frame(rows, "doc_id bigint, text string, source string, taken int")
    mixed = mixing.mix(docs)
    got = {r["doc_id"]: r for r in mixed.collect()}
    size = {i: len(WORD.findall(t or "")) for i, t, *_ in rows}
    by = collections.defaultdict(int)
    for i, _, s, _ in rows:
        by[s] += size[i]
    order = sorted(by, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, brute_targets([by[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 3)))
    taken = collections.defaultdict(int)
    for i, _, s, _ in rows:
        r = got[i]
        assert (r["size"], r["source_size"]) == (size[i], by[s]) and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * size[i]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 16 for s in by)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {i: r["taken"] for i, r in got.items()}
    out = mixing.mixed_documents(mixed, ["doc_id", "text"]).collect()
    words = collections.Counter()
    for r in out:
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert set(r["text"].split()) <= set((dict((i, t) for i, t, *_ in rows)[r["doc_id"]] or "").split())
    assert words == {i: r["taken"] for i, r in got.items() if r["taken"]}
    assert mixing.mix(frame([], "doc_id bigint, text string, source string")).count() == 0


# Toxicity.

def test_unlabelled_positives_are_not_learned_as_clean():
    draw = np.random.default_rng(10)
    prior = 0.3
    positive = [[0] if draw.random() < 0.9 else [1] for _ in range(300)]
    unlabelled = [([0] if draw.random() < 0.9 else [1]) if draw.random() < prior else [int(draw.integers(1, 4))] for _ in range(3000)]
    bias, weights = toxicity.fit(positive, unlabelled, prior, 4)
    p = 1 / (1 + np.exp(-(bias + weights)))
    assert p[0] > 0.9 and p[2] < 0.1 and p[3] < 0.1


def test_toxicity_learns_and_scores_all(frame):
    draw = random.Random(11)
    clean, bad = [f"w{chr(97 + i)}rd{chr(97 + j)}" for i in range(26) for j in range(20)], ["vile", "nasty", "rotten"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        words = [draw.choice(clean) for _ in range(40)] + ([draw.choice(bad), draw.choice(bad)] if toxic else [])
        rows.append((i, " ".join(words), 1.5))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    rows += [(2000, None, 0.0), (2001, "", 0.0), (2002, "VILE, rotten! " * 20_000, 0.0), (None, "vile nasty", 0.0)]
    docs, known = frame(rows, "doc_id bigint, text string, score double"), frame(labels + [(0, None), (2, 0)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, known)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 900 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert sum((r["predicted"] == 1) == (r["doc_id"] % 5 == 0) for r in held) / len(held) > 0.97
    other = {r["doc_id"]: r["predicted"] for r in got}
    assert (other[2000], other[2001], other[2002], other[None]) == (0, 0, 1, 1)
    none = toxicity.train(docs, frame([], "doc_id bigint, toxic int"))
    assert toxicity.score(docs, none).where("score > 0.01").count() == 0
    assert toxicity.score(frame([], "doc_id bigint, text string"), model).count() == 0


def test_toxicity_held_out(spark):
    from metaloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    got = QUERIES["op8_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    held = got.where("held_out").select("predicted", "toxic").collect()
    assert sum(r[0] == r[1] for r in held) / len(held) > 0.9


# Archives.

def test_archives_round_trip(frame, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    monkeypatch.setattr(warc, "READ_BYTES", 700)
    big = 2 ** 60 + 1
    pages = [(1, "http://a/ b\r\n", "same"), (2, None, "same"), (9, "u", "same"), (big, "u", None), (4, "v", ""), (5, "w", "é\r\n\r\n" * 5000),
             (None, "z", "same"), (None, "y", "only null"), (6, "t", "twice"), (6, "t", "twice")] + [(100 + i, f"u{i}", f"p{i}") for i in range(60)]
    archives, index = warc.write(frame([(*p, 0) for p in pages], "page_id bigint, url string, html string, file int"))
    got = warc.read(archives, index, payloads=True).collect()
    assert len(got) == len(pages) and index.select("file").distinct().count() > 3
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    want = collections.Counter()
    for i, u, h in pages:
        refers = {"same": 9, "": big}.get(h or "", None) if (h or "") in ("same", "") else None
        again = refers is not None and refers != i
        want[i, u, "revisit" if again else "response", refers if again else None, len((h or "").encode()), digest(h),
             None if again else (h or "").encode()] += 1
    assert collections.Counter((r["page_id"], r["url"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"],
                                None if r["payload"] is None else bytes(r["payload"])) for r in got) == want
    some = warc.read(archives, index.where("page_id between 110 and 119")).collect()
    assert sorted(r["page_id"] for r in some) == list(range(110, 120))
    archives, index = warc.write(frame([], "page_id bigint, url string, html string"))
    assert warc.read(archives, index).count() == 0


def test_small_payloads_are_not_folded(frame):
    _, index = warc.write(frame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id bigint, url string, html string"), min_bytes=3)
    assert {r["page_id"]: r["refers_to"] for r in index.collect()} == {1: None, 2: None, 3: 4, 4: None}


def test_ranges_are_coalesced():
    assert warc.coalesced([], []) == []
    assert warc.coalesced([0, 10, 25, 200, 230], [10, 10, 5, 30, 5], gap=8, most=100) == [(0, 2), (3, 4)]
    assert warc.coalesced([0, 60, 120], [60, 60, 500], gap=8, most=100) == [(0, 0), (1, 1), (2, 2)]


# The pipeline.

def test_stages_take_odd_tables(frame, sf):
    import corpus_pipeline

    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, taken string, kept string"
    prose = " ".join(f"word{i}" for i in range(40))
    rows = [(1, prose, "en", "a", 1, 1, "x", "y"), (2, prose + " end", "en", "b", 1, 1, "x", "y"), (3, None, None, None, None, None, None, None),
            (3, "other text of the same id", "en", "a", 1, 1, "x", "y"), (None, prose, "en", "c", 1, 1, "x", "y"), (4, "", "en", "a", 0, 1, "x", "y"),
            (5, "line of all\n" + prose[::-1], "en", "a", 1, 1, "x", "y"), (6, "line of all", "en", "b", 1, 1, "x", "y"), (7, "line of all", "en", "c", 1, 1, "x", "y")]
    docs = frame(rows, kinds)
    got = {name: stage(docs.sparkSession, docs, sf) for name, stage in corpus_pipeline.STAGES}
    assert all(got[name].columns == docs.columns for name, _ in corpus_pipeline.STAGES[:-1])
    ids = {name: sorted((r["doc_id"] or 0) for r in df.select("doc_id").collect()) for name, df in got.items()}
    assert ids["toxicity"] == [0, 1, 2, 3, 3, 4, 5, 6, 7]
    # The line and the prose of document 1 stay at their first place: 6 and 7 are left empty and go.
    assert ids["line_dedup"] == [0, 1, 2, 3, 3, 4, 5]
    assert ids["minhash_near_dedup"] == [0, 1, 3, 3, 4, 5, 6]
    assert set(ids["mixing"]) <= {0, 1, 2, 3, 5, 6, 7} and set(ids["best_fit_packing"]) == {0, 1, 2, 3, 4, 5, 6, 7}
    empty = frame([], kinds)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(docs.sparkSession, empty, sf).count() == 0, name

def test_pipeline_stage_by_stage(spark, sf):
    import corpus_pipeline
    from metaloom.llm.common import stored

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], sf), name))
    raw, clean, lines, single, mixed, packed = [d.collect() for d in seen]
    assert all(d.columns == docs.columns for d in seen[:-1])
    assert {r["doc_id"] for r in clean} <= {r["doc_id"] for r in raw} and 0.8 * len(raw) < len(clean) < len(raw)
    texts = {r["doc_id"]: r["text"] for r in clean}
    assert all(set(r["text"].split("\n")) <= set(texts[r["doc_id"]].split("\n")) for r in lines)
    sets = {r["doc_id"]: {tuple(w[i:i + 5]) for w in [WORD.findall(r["text"].translate(ASCII_LOWER))] for i in range(max(1, len(w) - 4))}
            for r in lines if WORD.search(r["text"])}
    kept = {r["doc_id"] for r in single}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                assert not (a in kept and b in kept)
    words = lambda rows: sum(len(WORD.findall(r["text"])) for r in rows)
    assert abs(words(mixed) - words(single)) < 100
    assert {(r["doc_id"]) for r in packed} == {r["doc_id"] for r in mixed}
    assert corpus_pipeline.run(spark, sf).count() == len(packed)
