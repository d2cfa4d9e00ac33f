"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts drawn whatever their label are the unlabelled ones. A
linear classifier over words and beginnings of words is trained in numpy on the risk
prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]), whose second part is kept from turning
negative, so unlabelled toxic texts are not learned as clean ones.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.llm.common import stored

# Texts the classifier is fitted on, at most about so many, drawn by a hash of the id. All texts are scored.
POSITIVES, UNLABELLED = 4_000, 12_000
# Candidate features taken from the positives, and features of the model.
CANDIDATES, FEATURES = 50_000, 2_048
# What a feature must weigh against chance; rare coincidences stay below it.
MERIT = 4.0
THRESHOLD = 0.7
PREFIXES = (4, 5, 6, 7, 8)
STEPS, RATE, DECAY = 400, 0.1, 1e-4
# Words a worker remembers to have looked up.
KNOWN_WORDS = 400_000

# Letters and whatever is not ASCII; read after lower-casing.
_WORDS = re.compile(r"[^\x00-@\[-`{-\x7f]+")


def words(text):
    return set(_WORDS.findall(text.lower()))


def features(word):
    """A word, and its beginnings marked with a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def text_features(found, wanted=None):
    """Features of a set of words; a beginning shared by two, or by four, of them counts further.

    `wanted` narrows the features of single words.
    """
    held = Counter(f for w in found for f in features(w) if wanted is None or f in wanted)
    return {*held, *(f + "2" for f, n in held.items() if n >= 2), *(f + "4" for f, n in held.items() if n >= 4)}


@dataclass
class Model:
    bias: float = -50.0
    weights: dict = field(default_factory=dict)


class Scorer:
    """Scores texts with a model; remembers which words carry features."""

    def __init__(self, model):
        self.model = model
        self.single = {re.sub(r"\*[24]$", "*", f) for f in model.weights}
        self.seen, self.carrying = set(), set()

    def score(self, text):
        found = words(text)
        fresh = found - self.seen
        if fresh:
            if len(self.seen) > KNOWN_WORDS:
                self.seen = set(self.carrying)
            self.carrying.update(w for w in fresh if not self.single.isdisjoint(features(w)))
            self.seen |= fresh
        held = text_features(found & self.carrying, self.single)
        z = self.model.bias + sum(self.model.weights[f] for f in sorted(held) if f in self.model.weights)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def fit(positive, unlabelled, prior, size, steps=STEPS, rate=RATE, decay=DECAY):
    """(bias, weights) from lists of feature numbers per text, by full-batch Adam."""
    def packed(rows):
        return (np.array([f for r in rows for f in r], dtype=np.int64),
                np.repeat(np.arange(len(rows)), [len(r) for r in rows]), len(rows))

    def scores(rows, w):
        at, row, n = rows
        return w[-1] + np.bincount(row, w[at], minlength=n)

    def gradient(rows, outer):
        at, row, n = rows
        out = np.bincount(at, outer[row], minlength=size + 1) / n
        out[-1] += outer.mean()
        return out

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    p, u = packed(positive), packed(unlabelled)
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        zp, zu = scores(p, w), scores(u, w)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        down = gradient(u, sigmoid(zu)) - prior * gradient(p, sigmoid(zp))
        # Where the corrected risk of the negatives is below zero, the step goes back up.
        g = -down if negative < 0 else down + prior * gradient(p, sigmoid(zp) - 1)
        g[:-1] += decay * w[:-1]
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        w = w - rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return float(w[-1]), w[:-1]


def learns_from(id_col):
    """Rows whose label may be learned."""
    return F.crc32(F.col(id_col).cast("string")) % 3 != 1


def _share(id_col, wanted, there):
    """A hash-drawn share of rows, about `wanted` of `there`."""
    return F.pmod(F.xxhash64(F.lit(5), F.col(id_col)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, wanted / max(there, 1)))


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text") -> Model:
    """A model from the labels of rows whose id has a checksum that is not 1 modulo 3.

    Without positives, or without any other label to tell their share, the model scores all texts 0.
    An id with several labels is toxic if one says so.
    Texts that repeat weigh once in the fit; the share of positives counts all their labelled ids.
    """
    known = (labels.where(learns_from(id_col) & F.col("toxic").isNotNull())
             .groupBy(id_col).agg(F.max("toxic").alias("toxic")))
    counts = known.agg(F.count("*"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0))).head()
    there = docs.where(learns_from(id_col)).count()
    if not counts[0] or not counts[1] or counts[0] == counts[1] or not there:
        return Model()
    prior = counts[1] / counts[0]
    drawn = known.where("toxic = 1").where(_share(id_col, POSITIVES, counts[1])).select(id_col, F.lit(True).alias("_p"))
    sample = (docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(learns_from(id_col))
              .join(F.broadcast(drawn), id_col, "left")  # about POSITIVES ids at most
              .select("text", F.coalesce("_p", F.lit(False)).alias("p"), _share(id_col, UNLABELLED, there).alias("u"))
              .where("p or u").groupBy("text", "p", "u").agg(F.count("*").alias("n")))
    sample = stored(sample, "sample")
    positives = sample.where("p").count()
    if not positives:
        return Model()
    least = max(2, positives // 300)
    seen = sample.where("p").select("text").mapInPandas(_counted(None), "feature string, n bigint")
    candidates = (seen.groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
                  .orderBy(F.desc("n"), "feature").limit(CANDIDATES).collect())
    in_p = {r["feature"]: r["n"] for r in candidates}
    rest = sample.where("u").select("text").mapInPandas(_counted(set(in_p)), "feature string, n bigint")
    in_u = {r[0]: r[1] for r in rest.groupBy("feature").agg(F.sum("n")).collect()}  # CANDIDATES rows at most
    unlabelled = sample.where("u").count()

    def merit(f):
        """Poisson log-likelihood ratio of a feature's count in the positives against chance."""
        chance = positives * (in_u.get(f, 0) + 0.5) / (unlabelled + 1)
        return in_p[f] * np.log(in_p[f] / chance) - (in_p[f] - chance) if in_p[f] > 2 * chance else 0.0

    chosen = sorted((f for f in in_p if merit(f) >= MERIT), key=lambda f: (-merit(f), f))[:FEATURES]
    if not chosen or not unlabelled:
        return Model()
    number = {f: i for i, f in enumerate(chosen)}
    rows = sample.mapInPandas(_numbered(number), "p boolean, u boolean, held array<int>").collect()  # the bounded sample
    rows.sort(key=lambda r: (r["p"], r["u"], r["held"]))
    bias, weights = fit([r["held"] for r in rows if r["p"]], [r["held"] for r in rows if r["u"]], prior, len(chosen))
    return Model(bias, {f: float(w) for f, w in zip(chosen, weights)})


def _counted(wanted):
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = Counter()
        for batch in batches:
            for text in batch["text"]:
                held = text_features(words(text))
                total.update(held if wanted is None else held & wanted)
        yield pd.DataFrame({"feature": list(total), "n": list(total.values())}, columns=["feature", "n"]).astype({"n": "int64", "feature": "object"})
    return counted


def _numbered(number):
    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = [sorted(number[f] for f in text_features(words(t)) if f in number) for t in batch["text"]]
            yield pd.DataFrame({"p": batch["p"], "u": batch["u"], "held": held})
    return numbered


def score(docs: DataFrame, model: Model, text_col="text", threshold=THRESHOLD) -> DataFrame:
    """All columns of `docs` with score (0 to 1) and predicted; null and empty texts are scored too.

    Only the text counts, so repeated texts have equal scores. Columns called like the results are
    replaced.
    """
    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for batch in batches:
            yield batch.map(scorer.score).astype("float64")

    rows = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    rows = rows.withColumn("score", scores(F.coalesce(F.col(text_col), F.lit(""))))
    return rows.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
