"""Best-fit packing of tokenised documents into sequences by a grouping genetic algorithm.

Documents are tokenised, cut where longer than a sequence, and the lengths of the pieces packed. Pieces
that fill a sequence stand alone; the rest are dealt to shards of bounded size. Each shard is packed by
several islands, each a population of packings: crossover puts whole well-filled bins of one parent
into the other, removes the bins that held their pieces, and best-fits what was displaced. Between
rounds each island's elite moves to the next island. A shard stops as soon as it has as few bins as its
tokens need. Badly filled bins of all shards are dealt once more.
"""

import gc
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metaloom.llm.common import WORD, stored

CAPACITY, END = 4096, 1
SHARD_PIECES, ISLANDS, POPULATION, GENERATIONS, ROUNDS = 20_000, 2, 4, 4, 2
# Bins filled to this share or more are done; the others of all shards are dealt again.
FILLED = 0.99
# Words kept by a worker with their ids; beyond it the memory starts anew.
KNOWN_WORDS, KNOWN_PIECES = 800_000, 200_000


# Fixed values of byte-level tokenizers: their split pattern, and the characters that stand for bytes.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = dict(zip([b for b in range(256) if b not in _SHOWN], range(256, 512)))
# Letters and signs that no normal form changes and whose lower case depends on nothing else.
_PLAIN = re.compile("[!-~\xa1-\u012f\u0131-\u017f]+").fullmatch


class WordTokenizer:
    """Token ids by white-space separated words, each different word encoded once.

    The tokenizer must treat words on their own, which holds where white space always splits and is
    dropped; `encode` compares its first texts with encoding them whole. Where lower case, the split
    pattern and the model alone give the same ids for a set of trial words, plain words are encoded in
    that way, which is faster; all others, and all words of other tokenizers, are encoded in full.
    """

    TRIAL = "Hello, WORLD's it's 'tis we'll ÀÉß¿¡ straße 12,345 x2y²¼ ª a--b!? #@_~ Žluťoučký ŉ ſ Œuvre ...'s'S".split()

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.find = re.compile(WORD).findall
        self.checks = 3
        self.pieces = {}
        # Added tokens are found before or after lower case; either way a lower-cased word shows them.
        added = [re.escape(t.content.lower()) for t in self.whole.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(added) or r"(?!)").search
        self.plain = True
        try:
            self.plain = all(self._plain_ids(w) == self.whole.encode(w, add_special_tokens=False).ids for w in self.TRIAL)
        except Exception:  # a model that cannot read such pieces
            self.plain = False
        self.reset()

    def reset(self):
        self.place = {}
        self.ids, self.first, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _plain_ids(self, word):
        return [i for piece in _SPLIT.findall(word.lower()) for i in self._piece_ids(piece)]

    def _piece_ids(self, piece):
        known = self.pieces.get(piece)
        if known is None:
            if len(self.pieces) > KNOWN_PIECES:
                self.pieces.clear()
            shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTES)
            known = self.pieces[piece] = tuple([t.id for t in self.whole.model.tokenize(shown)])
        return known

    def learn(self, words):
        """Encodes new words, plain ones by themselves and others many to a call, cut up by their places."""
        collecting = gc.isenabled()
        gc.disable()  # very many small objects come to stay
        try:
            self._learn(words)
        finally:
            if collecting:
                gc.enable()

    def _learn(self, words):
        plain, other, flat, sizes = [], [], [], []
        known, split, added = self.pieces.get, _SPLIT.findall, self.added
        for w in words:
            low = w.lower()
            if not self.plain or not _PLAIN(w) or added(low):
                other.append(w)
                continue
            plain.append(w)
            before = len(flat)
            for piece in split(low):
                flat += known(piece) or self._piece_ids(piece)
            sizes.append(len(flat) - before)
        ids, counts = [self.ids, np.array(flat, np.uint32)], [self.count, np.array(sizes, np.int64)]
        for i in range(0, len(other), 256):
            part = other[i:i + 256]
            found = self.whole.encode(" ".join(part), add_special_tokens=False)
            starts = np.array([o[0] for o in found.offsets], dtype=np.int64)
            edges = np.cumsum([0] + [len(w) + 1 for w in part])
            ids.append(np.array(found.ids, dtype=np.uint32))
            counts.append(np.diff(np.searchsorted(starts, edges)))
        self.place.update(zip(plain + other, range(len(self.place), len(self.place) + len(words))))
        self.ids, self.count = np.concatenate(ids), np.concatenate(counts)
        self.first = np.cumsum(self.count) - self.count

    def encode(self, texts):
        """One array of ids per text."""
        if len(self.place) > KNOWN_WORDS:
            self.reset()
        words = [self.find(t) for t in texts]
        known = self.place
        new = list(set().union(*words) - known.keys())
        if new:
            self.learn(new)
        out = []
        for text, ws in zip(texts, words):
            at = np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))
            n = self.count[at]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.ids[np.repeat(self.first[at] - ends + n, n) + np.arange(total)])
            if self.checks > 0:
                self.checks -= 1
                if self.whole.encode(text, add_special_tokens=False).ids != out[-1].tolist():
                    raise ValueError("this tokenizer does not encode words on their own")
        return out


_TOKENIZERS = {}


def _tokenizer(path):
    """A worker's tokenizer; it outlives a task, so common words are encoded once per worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _cut(path, capacity, end):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                rows, pieces = [], []
                for row, ids in enumerate(tokenizer.encode(part.column("text").to_pylist())):
                    ids = np.append(ids, np.uint32(end)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        held = ids[start:start + capacity]
                        rows.append(row)
                        pieces.append((piece, start, len(held), zlib.crc32(held.tobytes())))
                piece, start, length, crc = zip(*pieces)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id").take(pa.array(rows)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["_id", "piece", "start", "length", "ids_crc32"])
    return cut


class Bins:
    """Open bins by free space; `fit` finds the fullest that still takes a piece."""

    def __init__(self, capacity):
        self.capacity, self.mask, self.by_free = capacity, 0, {}
        self.bins = []

    def add(self, bin_, free):
        self.bins.append(bin_)
        self._open(len(self.bins) - 1, free)

    def _open(self, number, free):
        if free > 0:
            self.by_free.setdefault(free, []).append(number)
            self.mask |= 1 << free

    def fit(self, piece, length):
        rest = self.mask >> length
        if rest:
            free = (rest & -rest).bit_length() - 1 + length
            stack = self.by_free[free]
            number = stack.pop()
            if not stack:
                self.mask ^= 1 << free
            self.bins[number].append(piece)
            self._open(number, free - length)
        else:
            self.add([piece], self.capacity - length)


def best_fit(lengths, order, capacity, bins=()):
    """Packs the pieces of `order`, one after another, into `bins` and new ones."""
    packed = Bins(capacity)
    for b in bins:
        packed.add(list(b), capacity - sum(lengths[p] for p in b))
    for p in order:
        packed.fit(p, lengths[p])
    return packed.bins


def fitness(lengths, bins, capacity):
    """Fewer bins first; among as many, the more unevenly filled, which leaves room to drop one."""
    return len(bins), -sum((sum(lengths[p] for p in b) / capacity) ** 2 for b in bins)


def crossover(lengths, mother, father, capacity, draw):
    """The mother's packing with a draw of the father's well-filled bins put in whole."""
    fills = [sum(lengths[p] for p in b) for b in father]
    good = np.flatnonzero(np.array(fills) >= np.median(fills))
    injected = [father[i] for i in draw.permutation(good)[:max(1, len(good) // 2)]]
    taken = {p for b in injected for p in b}
    kept, displaced = [], []
    for b in mother:
        if taken.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [p for p in b if p not in taken]
    displaced.sort(key=lambda p: -lengths[p])
    return best_fit(lengths, displaced, capacity, injected + kept)


def evolve(lengths, elites, capacity, seed, population=POPULATION, generations=GENERATIONS):
    """The best packing of one island after some generations, starting from elites, if any."""
    draw = np.random.default_rng(seed)
    least = -(-sum(lengths) // capacity)
    order = sorted(range(len(lengths)), key=lambda p: -lengths[p])
    people = [*elites] or [best_fit(lengths, order, capacity)]
    rate = lambda bins: fitness(lengths, bins, capacity)
    if min(len(p) for p in people) > least:
        noise = np.array(lengths, dtype=np.float64)
        while len(people) < population:  # decreasing but for some noise, so that parents differ
            shaken = np.argsort(-noise * draw.uniform(0.8, 1.0, len(noise)), kind="stable")
            people.append(best_fit(lengths, shaken.tolist(), capacity))
        for _ in range(generations):
            people.sort(key=rate)
            if len(people[0]) <= least:
                break
            one, other = draw.choice(len(people), 2, replace=False)
            people[-1] = crossover(lengths, people[min(one, other)], people[max(one, other)], capacity, draw)
    return min(people, key=rate)


def _island(capacity, seed):
    def island(key, rows: pd.DataFrame) -> pd.DataFrame:
        """rows: the pieces of a shard, and the elites that came in, as piece -> bin lists."""
        rows = rows.sort_values("_piece").reset_index(drop=True)
        lengths = rows["length"].tolist()
        elites = []
        for column in ("_own", "_incoming"):
            if rows[column].notna().all():
                groups = {}
                for p, b in enumerate(rows[column].astype(int)):
                    groups.setdefault(b, []).append(p)
                elites.append(list(groups.values()))
        best = evolve(lengths, elites, capacity, [seed, *map(int, key)])
        number = np.zeros(len(rows), dtype=np.int64)
        for i, b in enumerate(best):
            number[b] = i
        return pd.DataFrame({"_piece": rows["_piece"], "length": rows["length"], "_shard": int(key[0]),
                             "_island": int(key[1]), "_own": number, "_bins": len(best)})
    return island


def _packed(pieces: DataFrame, capacity, islands, rounds, seed) -> DataFrame:
    """_piece, length, _shard, _bin: the best island's packing of every shard."""
    state = (pieces.withColumn("_island", F.explode(F.array(*[F.lit(i) for i in range(islands)])))
             .withColumn("_own", F.lit(None).cast("bigint")).withColumn("_incoming", F.lit(None).cast("bigint")))
    schema = "_piece bigint, length bigint, _shard bigint, _island int, _own bigint, _bins bigint"
    for turn in range(rounds):
        state = stored(state.select("_piece", "length", "_shard", "_island", "_own", "_incoming")
                       .groupBy("_shard", "_island").applyInPandas(_island(capacity, seed + turn), schema), "islands")
        if turn + 1 < rounds:
            per_shard = state.groupBy("_shard").agg(F.min("_bins").alias("_best"), F.sum(
                F.when(F.col("_island") == 0, F.col("length"))).alias("_total"))
            short = per_shard.where(F.col("_best") > F.ceil(F.col("_total") / capacity)).select("_shard")
            if short.isEmpty():
                break
            moved = state.select("_piece", ((F.col("_island") + 1) % islands).cast("int").alias("_island"),
                                 F.col("_own").alias("_incoming"))
            state = state.join(moved, ["_piece", "_island"])
    winner = (state.groupBy("_shard").agg(F.min(F.struct("_bins", "_island")).alias("w"))
              .select("_shard", F.col("w._island").alias("_island")))
    return state.join(winner, ["_shard", "_island"]).select("_piece", "length", "_shard", F.col("_own").alias("_bin"))


def pack(docs: DataFrame, tokenizer_path, id_col="doc_id", text_col="text", capacity=CAPACITY, end=END,
         shard_pieces=SHARD_PIECES, islands=ISLANDS, rounds=ROUNDS, seed=11) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts have the end token alone. Every row is packed, repeated ones too; other columns
    are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"_id {dict(docs.dtypes)[id_col]}, piece int, start bigint, length bigint, ids_crc32 bigint"
    cut = stored(rows.mapInArrow(_cut(tokenizer_path, capacity, end), schema)
                 .withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    full = cut.where(F.col("length") == capacity).select(
        "_piece", (-F.col("_piece") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    open_ = cut.where(F.col("length") < capacity).select("_piece", "length")
    count = open_.count()

    def dealt(pieces, n):
        return pieces.withColumn("_shard", F.pmod(F.xxhash64(F.lit(seed), "_piece"), F.lit(max(1, -(-n // shard_pieces)))))

    first = stored(_packed(dealt(open_, count), capacity, islands, rounds, seed), "packed")
    fill = first.groupBy("_shard", "_bin").agg(F.sum("length").alias("_fill"))
    loose = first.join(fill.where(F.col("_fill") < FILLED * capacity), ["_shard", "_bin"], "left_semi")
    loose = stored(loose.select("_piece", "length"), "loose")
    left = loose.count()
    second = _packed(dealt(loose, left), capacity, islands, rounds, seed + 100)
    kept = first.join(loose.select("_piece"), "_piece", "left_anti")
    numbered = (kept.withColumn("sequence_id", F.col("_shard") * F.lit(1 << 32) + F.col("_bin") * 2)
                .unionByName(second.withColumn("sequence_id", F.col("_shard") * F.lit(1 << 32) + F.col("_bin") * 2 + 1)))
    inside = Window.partitionBy("sequence_id").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = numbered.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    placed = placed.select("_piece", "sequence_id", "offset").unionByName(full)
    return cut.join(placed, "_piece").select(F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32",
                                             "sequence_id", "offset")
