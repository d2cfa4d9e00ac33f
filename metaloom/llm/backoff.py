"""Language-model scores by a weighted backoff automaton.

N-grams of the training texts, smoothed, become an automaton: the root, a state per known history of up to
`order` - 1 words, arcs that read a word and weigh its log-probability after the state, and a failure arc
from every state to that of the history without its first word, from single words to the root. Texts are
read once from left to right; each carries its state along and adds up the weights it passes.

    p(w)     = (c(w) + 1) / (N + V + 1), the unknown words sharing one part
    p(w | h) = (1 - l) c(h w) / c(h) + l p(w | h without its first word), with l the share of n-grams seen
               once after histories of that length about as frequent as h (the weight of the failure arc)

No task holds the model. Texts are gathered into chunks; a chunk asks for the counts of its own words
and n-grams, as sorted 56-bit hashes cut into ranges. The task of a range adds up the training counts of
all chunks and answers each chunk in the order it asked. So both tables grow with the corpus while each
task holds one range or one chunk. A frequent n-gram is one entry per chunk.

A chunk cuts its hashes into at most `FAN` ranges. Where the corpus needs more, groups of chunks merge what
they ask within such a range, cut the sum into finer ranges, and so on; answers come down the same way. So
rows grow with the corpus, and not with chunks times ranges.
"""

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.llm.common import ASCII_LOWER, WORD, stored

CHUNK_TOKENS, RANGE_KEYS = 1_000_000, 2_000_000
# Ranges into which one chunk, or one group of chunks, cuts what it asks.
FAN = 1024
KEY_BITS = 56
# Places in a chunk's vocabulary of the end of a text, a token like a word, and of its beginning, which is none.
END, BEGIN = 0, 1
_SPECIAL = [xxhash.xxh64_intdigest(" end"), xxhash.xxh64_intdigest(" begin")]
LEAST, MOST = 0.001, 0.999


def pack(values):
    """An array's bytes, equal places side by side, compressed."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T if len(values) else values.view(np.uint8)
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data, kind):
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(64 - KEY_BITS)


class Grams(NamedTuple):
    """A chunk's n-grams of one length, by sorted key.

    `context` is the place of the history among the n-grams one shorter, `suffix` that of the n-gram without its
    first word (of words: places in the vocabulary), `at` each token's n-gram, -1 where its text begins too late.
    """
    keys: np.ndarray
    counts: np.ndarray
    context: np.ndarray
    suffix: np.ndarray
    at: np.ndarray


class Chunk:
    """Tokens of some texts as places in a vocabulary of their own; each text ends with END."""

    def __init__(self, vocabulary, tokens, lengths, held):
        self.vocabulary, self.tokens, self.lengths, self.held = vocabulary, tokens, lengths, held
        self.first = np.cumsum(lengths) - lengths

    def training(self):
        """Whether each token is of a training text."""
        return np.repeat(~self.held, self.lengths)

    def words(self):
        """Sorted keys, training counts, and the order that sorts the vocabulary."""
        counts = np.bincount(self.tokens[self.training()], minlength=len(self.vocabulary))
        counts[BEGIN] = (~self.held).sum()
        keys = _mixed(self.vocabulary)
        order = np.argsort(keys)
        return keys[order], counts[order], order

    def before(self, at, first):
        """What `at` has for the token before each; `first` for the first of a text."""
        out = np.empty_like(at)
        out[1:] = at[:-1]
        out[self.first] = first
        return out

    def grams(self, order):
        """The n-grams of 2, 3, ... `order` words."""
        size, training, out = len(self.vocabulary), self.training(), []
        keys, at = _mixed(self.vocabulary), self.tokens.astype(np.int64)
        for length in range(2, order + 1):
            history = self.before(at, BEGIN if length == 2 else -1)
            there = history >= 0
            code, inverse = np.unique(history[there] * size + self.tokens[there], return_inverse=True)
            counts = np.bincount(inverse[training[there]], minlength=len(code))
            suffix = np.empty(len(code), dtype=np.int64)
            suffix[inverse] = at[there]
            context, word = code // size, code % size
            with np.errstate(over="ignore"):
                found = _mixed(keys[context] * np.uint64(0x9E3779B97F4A7C15) + self.vocabulary[word])
            place = np.argsort(found)
            rank = np.empty(len(place), dtype=np.int64)
            rank[place] = np.arange(len(place))
            keys, at = found[place], np.full(len(at), -1, dtype=np.int64)
            at[there] = rank[inverse]
            out.append(Grams(keys, counts[place], context[place], suffix[place], at))
        return out


class States:
    """States of histories of one length: whether training has them, and what their failure arcs weigh."""

    def __init__(self, counts, shares):
        self.counts = counts
        self.state = counts > 0
        self.share = shares[np.log2(np.maximum(counts, 1)).astype(np.int64)]
        self.fail = np.log10(self.share)

    def weigh(self, context, backed, counts):
        """Weights of arcs; nan where there is none. `backed` weighs the same word after the failure arc."""
        seen = (counts > 0) & self.state[context]
        share = self.share[context]
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.log10((1 - share) * counts / self.counts[context] + share * 10.0 ** backed)
        return np.where(seen, weight, np.nan)


class Automaton(States):
    """The part of the model that one chunk can reach: its words, and longer n-grams as they are added.

    `root` weighs a word read at the root; a known word is the state that reading it leads to.
    """

    def __init__(self, counts, total, distinct, shares):
        super().__init__(counts, shares)
        self.root = np.log10((counts + 1) / (total + distinct + 1))
        self.weights, self.longest = self.root, self
        self.levels = []

    def arcs(self, context, word, pair_counts):
        """Weights of the arcs of pairs; nan where there is none."""
        return self.weigh(context, self.root[word], pair_counts)

    def add(self, grams, counts, shares, chunk):
        """Takes in the n-grams one longer than those before. `shares` are those of failure arcs from them."""
        history = chunk.before(chunk.tokens.astype(np.int64) if not self.levels else self.at,
                               BEGIN if not self.levels else -1)
        self.weights = self.longest.weigh(grams.context, self.weights[grams.suffix], counts)
        arc, fail = np.full(len(history), np.nan), np.zeros(len(history))
        reads, fails = grams.at >= 0, history >= 0
        arc[reads] = self.weights[grams.at[reads]]
        fail[fails] = self.longest.fail[history[fails]]
        self.levels.append((arc, ~np.isnan(arc), fail))
        self.at, self.longest = grams.at, States(counts, shares)

    def traverse(self, chunk):
        """log10 probability of every text: all advance by a word at a time, each carrying its state.

        A state is told by the length of its history, as the words are at hand; 0 is the root.
        """
        order = np.argsort(-chunk.lengths, kind="stable")
        lengths, first = chunk.lengths[order], chunk.first[order]
        score, top = np.zeros(len(order)), len(self.levels)
        state = np.full(len(order), min(top, int(self.state[BEGIN])), dtype=np.int64)
        known = np.minimum(self.state, top).astype(np.int64)
        ends = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0), side="left")
        for step, n in enumerate(ends.tolist()):  # the n longest texts still have a word here
            at = first[:n] + step
            here, own, word = state[:n], score[:n], chunk.tokens[at]
            backed = self.root[word]
            reached = known[word]
            # From the shortest history up, what a state of each length adds and leads to.
            for length, (arc, there, fail) in enumerate(self.levels, 1):
                reads = there[at]
                backed = np.where(here >= length, np.where(reads, arc[at], backed + fail[at]), backed)
                reached = np.where(reads & (here >= length), min(length + 1, top), reached)
            own += backed
            state[:n] = reached
        out = np.empty(len(order))
        out[order] = score
        return out


CHUNK_COLUMNS = "chunk bigint, held binary, lengths binary, vocabulary binary, tokens binary, n_words bigint, n_tokens bigint"


def _chunker(size):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(WORD).findall
        part, made = TaskContext.get().partitionId(), 0

        def fresh():
            return {}, [np.array(_SPECIAL, np.uint64)], [], [], [], []

        def flush():
            nonlocal made
            tokens = np.concatenate(pieces)
            vocabulary = np.concatenate([hashes[0], np.array(hashes[1:], np.uint64)])
            lengths = np.array([len(p) for p in pieces], np.int64)
            row = pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays([0, len(pieces)], pa.concat_arrays(ids)), pa.array([(part << 24) + made], pa.int64()),
                 *[pa.array([pack(a)], pa.binary()) for a in (np.array(held, np.uint8), lengths, vocabulary, tokens)],
                 pa.array([len(vocabulary)], pa.int64()), pa.array([len(tokens)], pa.int64())],
                names=["ids"] + [c.split()[0] for c in CHUNK_COLUMNS.split(", ")])
            made += 1
            return row

        known, hashes, pieces, held, ids, _ = fresh()
        count = 0
        for batch in batches:
            start = 0
            texts, flags = batch.column("text"), batch.column("held").to_pylist()
            for i in range(batch.num_rows):
                words = find(texts[i].as_py().translate(ASCII_LOWER))
                for w in words:
                    if w not in known:
                        known[w] = len(hashes) + 1
                        hashes.append(xxhash.xxh64_intdigest(w))
                tokens = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                pieces.append(np.append(tokens, np.int32(END)))
                held.append(flags[i])
                count += len(words) + 1
                if count >= size:
                    ids.append(batch.column("_id").slice(start, i + 1 - start))
                    yield flush()
                    known, hashes, pieces, held, ids, _ = fresh()
                    start, count = i + 1, 0
            if start < batch.num_rows:
                ids.append(batch.column("_id").slice(start))
        if pieces:
            yield flush()
    return gather


def _rows(batch):
    """Chunks one at a time; a batch may hold several large ones."""
    wanted = [c for c in batch.schema.names if c != "ids"]
    for i in range(batch.num_rows):
        yield batch.select(wanted).slice(i, 1).to_pylist()[0]


def _chunk(row):
    return Chunk(unpack(row["vocabulary"], "<u8"), unpack(row["tokens"], "<i4"), unpack(row["lengths"], "<i8"),
                 unpack(row["held"], "u1").astype(bool))


def _parts(keys, ranges, first, n):
    """Where each of `n` ranges from `first` on begins in sorted keys, of `ranges` in all."""
    edges = np.arange(first, first + n, dtype=object) * (1 << KEY_BITS) // ranges
    return np.searchsorted(keys, np.array([int(e) for e in edges], dtype=np.uint64)).tolist() + [len(keys)]


def _wide(counts):
    """Counts in 32 bits, or in 64 where the largest needs them."""
    return counts.astype("<u4" if counts.max(initial=0) <= 0xFFFFFFFF else "<u8")


def _counted(data, n):
    """`n` packed counts of either width."""
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return unpack(data, f"<u{len(planes) // n if n else 4}").astype(np.int64)


ASKED = "chunk bigint, r int, keys binary, counts binary, bands binary"


def _cuts(chunk, keys, counts, bands, ranges, first, n):
    """What a chunk, or a group of them, asks of each range."""
    cuts = _parts(keys, ranges, first, n)
    return [(chunk, first + i, pack(keys[a:b]), pack(_wide(counts[a:b])), pack(bands[a:b]))
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]


def _asked(*asks):
    columns = list(zip(*_cuts(*asks))) or [[]] * 5
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=[c.split()[0] for c in ASKED.split(", ")])


def _answers(row, column):
    """The counts of all ranges; each begins with the width of its numbers."""
    parts = [a["counts"] for a in sorted(row[column] or [], key=lambda a: a["r"])]
    return np.concatenate([np.zeros(0, "<u4"), *(unpack(p[1:], f"<u{p[0]}") for p in parts)]).astype(np.int64)


def _told(answer):
    """Counts as `_answers` reads them."""
    answer = _wide(answer)
    return bytes([answer.itemsize]) + pack(answer)


def _word_counts(chunk, row):
    """Training counts of a chunk's vocabulary."""
    _, _, order = chunk.words()
    counts = np.empty(len(order), dtype=np.int64)
    counts[order] = _answers(row, "n1")
    return counts


def _ask(length, ranges):
    """Asks for n-grams of a length. Their band is the logarithm of the count of their history; 255 where that is
    unknown. Of words it is 1, of the beginning 0."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                chunk = _chunk(row)
                if length == 1:
                    keys, counts, order = chunk.words()
                    bands = (order != BEGIN).astype(np.uint8)
                else:
                    keys, counts, context, _, _ = chunk.grams(length)[-1]
                    frequent = _word_counts(chunk, row) if length == 2 else _answers(row, f"n{length - 1}")
                    bands = np.where(frequent > 0, np.log2(np.maximum(frequent, 1)), 255).astype(np.uint8)[context]
                yield _asked(row["chunk"], keys, counts, bands, ranges, 0, ranges)
    return ask


def _together(rows):
    """Keys and counts of several asks, one after another, and how many keys each has."""
    keys = [unpack(k, "<u8") for k in rows["keys"]]
    counts = [_counted(c, len(k)) for c, k in zip(rows["counts"], keys)]
    return np.concatenate(keys), np.concatenate(counts), [len(k) for k in keys]


def _merge(ranges, fan):
    """Adds up what a group asks within one range, and cuts it into finer ones."""
    def merge(key, rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts, _ = _together(rows)
        bands = np.concatenate([unpack(b, "u1") for b in rows["bands"]])
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        total = np.zeros(len(unique), dtype=np.int64)
        np.add.at(total, inverse, counts)
        out = _cuts(int(key[0]), unique, total, bands[first], ranges, int(key[1]) * fan, fan)
        return pd.DataFrame(out, columns=[c.split()[0] for c in ASKED.split(", ")])
    return merge


def _hand_down(key, asks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """Gives what a group was answered to those who asked."""
    keys, _, sizes = _together(asks)
    _, inverse = np.unique(keys, return_inverse=True)
    answer = _answers({"n": answers.to_dict("records")}, "n")[inverse]
    ends = np.cumsum(sizes)
    told = [_told(answer[e - n:e]) for e, n in zip(ends, sizes)]
    return pd.DataFrame({"chunk": asks["chunk"], "r": asks["r"], "counts": told})


ANSWERED = "chunk bigint, r int, counts binary, band int, n bigint, ones bigint, kinds bigint"


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Adds up one range. Rows without a chunk carry per band the tokens, the keys seen once and the keys."""
    keys, counts, sizes = _together(rows)
    bands = np.concatenate([unpack(b, "u1") for b in rows["bands"]])
    unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    total = np.bincount(inverse, counts, minlength=len(unique)).astype(np.int64)
    answer, at, out = total[inverse], 0, []
    for chunk, n in zip(rows["chunk"], sizes):
        out.append((chunk, rows["r"].iloc[0], _told(answer[at:at + n]), None, None, None, None))
        at += n
    band, seen = bands[first], total > 0
    for b in np.unique(band[seen]).tolist():
        own = total[seen & (band == b)]
        out.append((None, rows["r"].iloc[0], None, b, int(own.sum()), int((own == 1).sum()), len(own)))
    frame = pd.DataFrame(out, columns=[c.split()[0] for c in ANSWERED.split(", ")], dtype=object)
    return frame.astype({c: "Int64" for c in ("chunk", "r", "band", "n", "ones", "kinds")})


def _widths(ranges):
    """Ranges at each level, the last of them `ranges` or more; a range has the same number of finer ones throughout."""
    levels = 1
    while FAN ** levels < ranges:
        levels += 1
    fan = 1
    while fan ** levels < ranges:
        fan += 1
    return [fan ** (i + 1) for i in range(levels)]


def _answered(chunks, length, sizes):
    """The answers, a list of ranges per chunk; and sums per band (at most 256 rows). `sizes` are the numbers of
    chunks and of keys."""
    name, (fan, *finer) = f"n{length}", _widths(max(1, -(-sizes[1] // RANGE_KEYS)))
    asked, groups = chunks.mapInArrow(_ask(length, fan), ASKED), []
    for level, ranges in enumerate(finer, 1):
        unit = F.pmod(F.xxhash64("chunk"), F.lit(-(-sizes[0] // fan ** level)))
        asked = stored(asked, f"asked{length}").withColumn("unit", unit).groupBy("unit", "r")
        groups.append(asked)
        asked = asked.applyInPandas(_merge(ranges, fan), ASKED)
    answers = stored(asked.groupBy("r").applyInPandas(_answer, ANSWERED), name)
    bands = (answers.where("chunk is null").groupBy("band")
             .agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"), F.sum("kinds").alias("kinds")).collect())
    told = answers.where("chunk is not null").select("chunk", "r", "counts")
    for asked in reversed(groups):
        told = told.groupBy(F.col("chunk").alias("unit"), F.floor(F.col("r") / fan).cast("int").alias("r"))
        told = asked.cogroup(told).applyInPandas(_hand_down, "chunk bigint, r int, counts binary")
    lists = told.groupBy("chunk").agg(F.collect_list(F.struct("r", "counts")).alias(name))
    return lists, {r["band"]: r for r in bands}


def _score(total, distinct, shares):
    """`shares`: per length of a history, from 1, those of failure arcs by band."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(_rows(batch)):
                chunk = _chunk(row)
                counts = _word_counts(chunk, row)
                model = Automaton(counts, total, distinct, shares[0])
                for length, grams in enumerate(chunk.grams(len(shares)), 2):
                    model.add(grams, _answers(row, f"n{length}"), shares[length - 1], chunk)
                own = np.repeat(np.arange(len(chunk.lengths)), chunk.lengths)
                base = np.bincount(own, model.root[chunk.tokens], minlength=len(chunk.lengths))
                known = np.bincount(own, counts[chunk.tokens] > 0, minlength=len(chunk.lengths)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, pa.array(chunk.held), pa.array(chunk.lengths), pa.array(known),
                     pa.array(np.full(len(chunk.lengths), total, np.int64)), pa.array(base),
                     pa.array(model.traverse(chunk))],
                    names=["_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return score


def score(docs: DataFrame, held_out, id_col="doc_id", text_col="text", order=2) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `held_out` is a column; texts where it is false (or null) train the model. A-Z are lower-cased; a text's tokens
    are its words and one end. Null and empty texts have the end alone. Repeated rows are scored, and
    counted in training, as often as they stand there. Without training texts every word is unknown.
    An empty table gives no rows; other columns are ignored. `order` is the length of the longest n-grams, 1 or more.
    """
    id_type = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held"))
    chunks = stored(rows.mapInArrow(_chunker(CHUNK_TOKENS), f"ids array<{id_type}>, {CHUNK_COLUMNS}"), "chunks")
    n_chunks, *sizes = (n or 0 for n in chunks.agg(F.count("*"), F.sum("n_words"), F.sum("n_tokens")).head())
    total = distinct = 0
    shares, with_counts = [], chunks
    for length in range(1, order + 1):
        lists, bands = _answered(with_counts, length, (n_chunks, sizes[min(length, 2) - 1]))
        with_counts = with_counts.join(lists, "chunk", "left")  # short texts alone hold no long n-grams
        if length == 1:
            total, distinct = (bands[1]["n"], bands[1]["kinds"]) if 1 in bands else (0, 0)
            continue
        share = np.full(64, MOST)
        for b, r in bands.items():
            if b < 64 and r["n"]:
                share[b] = min(MOST, max(LEAST, r["ones"] / r["n"]))
        shares.append(share)
    shares.append(np.full(64, MOST))  # the longest n-grams are no histories
    scored = with_counts.mapInArrow(
        _score(total, distinct, shares), f"_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double")
    return scored.withColumnRenamed("_id", id_col)
