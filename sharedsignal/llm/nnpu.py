"""Toxicity by non-negative positive-unlabelled learning.

Positives are texts confirmed as toxic; the unlabelled sample is drawn from all other
training text, labels unseen, so it holds toxic texts at the class prior.  A linear
model on the presence of words and of their beginnings (PREFIX bytes) minimises the prior-corrected risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

with the logistic loss; when the second term is negative, the step goes against it
(it is the sign of overfitting).  The prior is the toxic share of the labelled
training rows.

Training uses bounded samples, POSITIVES and UNLABELLED rows by the order of a hash of
the id, and at most FEATURES of these, those whose document frequency differs most
between the two samples (at least Z standard errors).  Equal texts of a class count once.  Scoring covers every text.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_word_table, pieces, scratch, table, utf8_column

POSITIVES, UNLABELLED, FEATURES, Z = 8_000, 24_000, 20_000, 4.0
STEPS, RATE, DECAY = 300, 0.05, 1e-4
PREFIX = (6, 7)
HELD_OUT = 5


def held_out(id_col: str = "doc_id"):
    """Whether crc32(id as text) mod 5 is 0; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def features_of(word: bytes) -> list[bytes]:
    """The word and its beginnings; ``^`` is no sign of a word."""
    return [word, *[b"^" + word[:n] for n in PREFIX if n < len(word)]]


def present_in(rows, vocabulary: dict) -> list[set]:
    """Numbers of the vocabulary's features in each row of words; every distinct word is looked up once."""
    known = {}
    for w in set().union(*rows):
        found = [vocabulary[f] for f in features_of(w) if f in vocabulary]
        if found:
            known[w] = found
    out = []
    for row in rows:
        words = set(row)
        out.append(set().union(*[known[w] for w in words if w in known]))
    return out


def shard_words(data, off, i, j, words):
    """Lists of words of rows i..j."""
    raw = data[off[i]:off[j]].tobytes()
    cut = (off[i:j + 1] - off[i]).tolist()
    return [raw[a:z].translate(words).split() for a, z in zip(cut, cut[1:])]


def document_frequencies(sample: DataFrame) -> DataFrame:
    """(word, p, u): rows of each class that hold the feature; sample: (text, positive)."""

    def run(batches):
        words = ascii_word_table()
        for b in batches:
            data, off = utf8_column(b.column(0))
            positive = b.column(1).to_pylist()
            for i, j in pieces(off):
                p, u = Counter(), Counter()
                for k, row in enumerate(shard_words(data, off, i, j, words)):
                    (p if positive[i + k] else u).update({f for w in set(row) for f in features_of(w)})
                every = list(p.keys() | u.keys())
                yield pa.RecordBatch.from_arrays([pa.array(every, pa.binary()), pa.array([p[w] for w in every], pa.int64()),
                                                  pa.array([u[w] for w in every], pa.int64())], names=["word", "p", "u"])

    return sample.mapInArrow(run, "word binary, p bigint, u bigint").groupBy("word").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def present(sample: DataFrame, vocabulary: dict) -> DataFrame:
    """(positive, words array<int>): the numbers of the vocabulary's features in each row of (text, positive)."""

    def run(batches):
        words = ascii_word_table()
        for b in batches:
            data, off = utf8_column(b.column(0))
            out = []
            for i, j in pieces(off):
                out += [sorted(x) for x in present_in(shard_words(data, off, i, j, words), vocabulary)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(out, pa.list_(pa.int32()))], names=["positive", "words"])

    return sample.mapInArrow(run, "positive boolean, words array<int>")


def fit(rows, positive, n_features: int, prior: float, steps: int = STEPS, rate: float = RATE, decay: float = DECAY):
    """Weights (index 0 is the bias) from word numbers per row by Adam on the non-negative risk.

    ``rows``: list of arrays with numbers 1..n_features; returns zeros with a bias at the prior when a class is empty.
    """
    w = np.zeros(n_features + 1)
    w[0] = np.log(prior / (1 - prior))
    if not positive.any() or positive.all():
        return w
    flat = np.concatenate([np.append(r, 0) for r in rows]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    n_p, n_u = positive.sum(), (~positive).sum()
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = np.bincount(owner, w[flat], len(rows))
        s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        loss = np.logaddexp(0, g)  # of calling it clean
        negative = loss[~positive].mean() - prior * loss[positive].mean()
        slope = np.where(positive, -prior * s / n_p, s / n_u)  # of the negative part
        if negative >= 0:
            slope = slope + np.where(positive, -prior * (1 - s) / n_p, 0)
        else:
            slope = -slope
        grad = np.bincount(flat, slope[owner], len(w))
        grad[1:] += decay * w[1:]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


class ToxicityModel:
    """A feature -> number vocabulary, its weights, and the class prior."""

    def __init__(self, vocabulary, weights, prior):
        self.vocabulary, self.weights, self.prior = vocabulary, weights, prior

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """All columns and _score in 0..1; null and empty texts score by the bias alone."""
        where = docs.columns.index(text_col)
        schema = T.StructType(docs.schema.fields + [T.StructField("_score", T.DoubleType())])
        vocabulary, weights = self.vocabulary, self.weights

        def run(batches):
            words = ascii_word_table()
            for b in batches:
                data, off = utf8_column(b.column(where))
                g = np.full(b.num_rows, weights[0])
                for i, j in pieces(off):
                    for k, found in enumerate(present_in(shard_words(data, off, i, j, words), vocabulary)):
                        if found:
                            g[i + k] += weights[list(found)].sum()
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(g, -30, 30))))], names=schema.names)

        return docs.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES, z: float = Z,
          prior: float | None = None) -> ToxicityModel:
    """Train on the rows that are not held out; only ``docs``'s text and ``labels``'s (id, label) are used.

    An id labelled both ways counts as toxic.  Null ids and labels are ignored.  Empty
    tables give a model that scores every text at the prior (one half without labels).
    """
    marks = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("y"))
             .filter("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y")).filter(~held_out("id")))
    if prior is None:
        n = marks.agg(F.count("*").alias("n"), F.sum("y").alias("p")).first()
        prior = min(0.95, max(0.005, n["p"] / n["n"])) if n["n"] else 0.5
    hashed = F.xxhash64("id")
    chosen = marks.filter("y = 1").orderBy(hashed, "id").limit(positives).select("id")
    ids = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    free = ids.select("id").filter("id is not null").filter(~held_out("id")).orderBy(F.xxhash64("id", F.lit(1)), "id").limit(unlabelled)
    drawn = F.broadcast(chosen.select("id", F.lit(True).alias("positive")).union(free.distinct().select("id", F.lit(False))))
    sample = scratch(ids.join(drawn, "id").select("text", "positive").distinct(), "toxicity-sample")
    size = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    n_p, n_u = size.get(True, 0), size.get(False, 0)
    if not n_p or not n_u:
        return ToxicityModel({}, fit([], np.zeros(0, bool), 0, prior), prior)
    pooled = (F.col("p") + F.col("u")) / (n_p + n_u)
    gap = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u) + F.lit(1e-12))
    best = (document_frequencies(sample).filter("p + u >= 5").withColumn("z", F.abs(gap)).filter(F.col("z") >= z)
            .orderBy(F.desc("z"), "word").limit(features).collect())
    vocabulary = {bytes(r["word"]): k + 1 for k, r in enumerate(best)}
    t = present(sample, vocabulary).toArrow()
    rows = [np.array(r, np.int64) for r in t.column("words").to_pylist()]
    weights = fit(rows, t.column("positive").to_numpy().astype(bool), len(vocabulary), prior)
    return ToxicityModel(vocabulary, weights, prior)


def query(spark, sf_dir):
    """op8: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return (model.score(docs).select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"),
                                     (F.col("_score") >= 0.5).cast("int").alias("predicted")))
