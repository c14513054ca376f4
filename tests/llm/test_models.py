import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sharedsignal.llm import knlm as Q
from sharedsignal.llm import nnpu as N


def units(text):
    raw = (text or "").encode("utf-16-le")
    return [0, 0, 0] + list(np.frombuffer(raw, np.uint16).tolist())


class SlowKneserNey:
    """The textbook recursion over dictionaries."""

    def __init__(self, texts):
        self.c = {4: collections.Counter(tuple(u[k:k + 4]) for u in map(units, texts) for k in range(len(u) - 3))}
        for n in (3, 2, 1):
            self.c[n] = collections.Counter(g[1:] for g in self.c[n + 1])
        self.d, self.ctx = {}, {}
        for n, c in self.c.items():
            m = collections.Counter(c.values())
            if all(m[k] for k in (1, 2, 3, 4)):
                y = m[1] / (m[1] + 2 * m[2])
                raw = [k - (k + 1) * y * m[k + 1] / m[k] for k in (1, 2, 3)]
                self.d[n] = [min(float(k), max(0.05 * k, x)) for k, x in zip((1, 2, 3), raw)]
            else:
                self.d[n] = [0.5, 1.0, 1.5]
            self.ctx[n] = collections.defaultdict(list)
            for g, x in c.items():
                self.ctx[n][g[:-1]].append(x)

    def p(self, gram):
        n = len(gram)
        below = self.p(gram[1:]) if n > 1 else 1 / 65536
        counts = self.ctx[n].get(gram[:-1])
        if not counts:
            return below
        cut = lambda x: self.d[n][min(x, 3) - 1]
        x = self.c[n].get(gram, 0)
        return ((x - cut(x) if x else 0) + sum(map(cut, counts)) * below) / sum(counts)

    def logp(self, text):
        u = units(text)
        return sum(math.log(self.p(tuple(u[k:k + 4]))) for k in range(len(u) - 3))


@pytest.mark.parametrize("shard", [Q.SHARD, 50])
def test_kneser_ney_equals_the_recursion(spark, rng, shard):
    texts = ["".join(rng.choice(list("abc é日👍."), rng.integers(0, 60))) for _ in range(60)]
    slow = SlowKneserNey(texts[:40])
    df = spark.createDataFrame([(t, k < 40) for k, t in enumerate(texts)], "text string, train boolean")
    counts = Q.gram_counts(df)
    got = {r.gram: r.logp for r in Q.log_probabilities(counts.persist()).collect()}
    for g, lp in got.items():
        g &= 2**64 - 1
        assert lp == pytest.approx(math.log(slow.p(tuple(g >> s & 0xFFFF for s in (48, 32, 16, 0)))), rel=1e-9)
    scored = Q.score(df, Q.model_shards(Q.log_probabilities(counts), shard)).collect()
    for r in scored:
        assert r._units == len(r.text.encode("utf-16-le")) // 2
        assert r._logp == pytest.approx(slow.logp(r.text), rel=1e-5, abs=1e-4)


def test_only_the_most_frequent_grams_pass_through_the_driver(spark, rng, hostile):
    texts = ["".join(rng.choice(list("abc é日👍."), rng.integers(0, 60))) for _ in range(60)]
    df = spark.createDataFrame([(t, k < 40) for k, t in enumerate(texts + texts[:20] * 3)], "text string, train boolean")
    table = Q.scratch(Q.log_probabilities(Q.scratch(Q.gram_counts(df), "grams")), "table")
    whole, parts = Q.model_shards(table), Q.model_shards(table, 50)
    assert whole[1] is None and len(whole[0].value[0]) == table.count()
    sent = set(parts[0].value[0].tolist())
    times = {r.gram: r.n for r in table.collect()}
    assert 0 < len(sent) <= 50 and parts[1].count() == len(times) - len(sent)
    assert min(times[g] for g in sent) > max(n for g, n in times.items() if g not in sent)
    for rows in (df, hostile):
        one, two = ([(r._units, r._logp) for r in sorted(Q.score(rows, m).collect(), key=lambda r: str(r[:-1]))] for m in (whole, parts))
        assert len(one) == rows.count() and [x[0] for x in one] == [x[0] for x in two]
        assert np.allclose([x[1] for x in one], [x[1] for x in two], rtol=1e-6)


def test_probabilities_sum_to_one():
    slow = SlowKneserNey(["abracadabra", "abacus and cadabra", "a banana"])
    for h in [(0, 0, 0), (97, 98, 114), (1, 2, 3)]:
        assert sum(slow.p((*h, w)) for w in range(65536)) == pytest.approx(1.0, abs=1e-9)


def corpus(rng, n=400):
    syllables = ["ba", "ne", "ti", "ro", "sul", "mar", "ken"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    rows = []
    for k in range(n):
        text = " ".join(word() for _ in range(rng.integers(20, 60))) + "."
        bad = k % 5 == 4
        rows.append((k, text.upper().replace(" ", "!! ") if bad else text, "en" if k % 2 else "de", 0 if bad else 1))
    return rows


def test_quality_decision(spark, rng, hostile, nothing):
    rows = corpus(rng)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    model = Q.train(docs, spark.createDataFrame([(r[0],) for r in rows if r[3]], "doc_id bigint"))
    keep = {r.doc_id: r._keep for r in model.judge(docs).collect()}
    good = [keep[r[0]] for r in rows if r[3]]
    assert sum(good) / len(good) > 0.97 and not any(keep[r[0]] for r in rows if not r[3])
    odd = {r.doc_id: r for r in model.judge(hostile).collect()}
    assert len(odd) == 8 and not odd[2]._keep and not odd[3]._keep and odd[2]._perplexity is None
    assert model.judge(nothing).count() == 0
    empty = Q.train(nothing, nothing.select("doc_id"))
    assert empty.judge(nothing).count() == 0 and empty.judge(docs).filter("_keep").count() == len(rows)


def test_languages_with_few_held_out_texts(spark, rng):
    rows = corpus(rng)
    ids = spark.range(1000, 2000).select("id", (F.pmod(F.xxhash64("id"), F.lit(Q.HELD_OUT)) == 0).alias("held")).collect()
    held, other = [r.id for r in ids if r.held], [r.id for r in ids if not r.held]
    sources = [t for _, t, _, q in corpus(rng, 200) if q]
    own, trusted = {}, [r[0] for r in rows if r[3]]
    for n in (1, 2, 3):
        mine = [held.pop() for _ in range(n)] + [other.pop() for _ in range(30)]
        own[n] = {i: sources.pop() for i in mine}
        trusted += mine[:n]
    junk = {n: f"{sources[n].upper().replace(' ', '!! ')}" for n in own}
    docs = [r[:3] for r in rows] + [(i, t, f"l{n}") for n, x in own.items() for i, t in x.items()] + [(5000 + n, t, f"l{n}") for n, t in junk.items()]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    model = Q.train(df, spark.createDataFrame([(i,) for i in trusted], "doc_id bigint"))
    got = {r.doc_id: r for r in model.judge(df).collect()}
    for n, x in own.items():
        assert sum(got[i]._keep for i in x) / len(x) > 0.9 and not got[5000 + n]._keep
        assert got[5000 + n]._low < got[min(x)]._perplexity < got[5000 + n]._high


def test_kept_rows_with_clashing_names(spark, rng):
    rows = [(k, "plain words of a trusted text " * 5 if k % 3 else "", "en" if k % 2 else None) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = Q.train(docs, spark.createDataFrame([(k,) for k in range(0, 60)], "doc_id bigint"))
    want = {r.doc_id for r in model.judge(docs).filter("_keep").collect()}
    names = ["_keep", "_units", "_low", "_high", "_lang", "_logp", "_digest", "_cold", "_mean", "_perplexity", "c", "c0", "gram", "logp", "low"]
    extra = docs.selectExpr(*[f"concat('{n}', doc_id) AS {n}" for n in names], "*")
    got = model.kept(extra).collect()
    assert {r.doc_id for r in got} == want and len(got) == len(want) and want
    assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in names) and model.kept(extra).columns == extra.columns


def test_nnpu_learns_toxic_words(spark, rng, hostile, nothing):
    clean = [f"{a}{b}" for a in ("ba", "ne", "ti", "ro") for b in ("sul", "mar", "ken", "dor")]
    toxic = ["grumpf", "zlorg", "snarkel"]
    rows = []
    for k in range(1500):
        bad = k % 8 == 0
        text = list(rng.choice(clean, rng.integers(15, 80))) + (list(rng.choice(toxic, 2)) if bad else [])
        rng.shuffle(text)
        rows.append((k, " ".join(text).title(), int(bad), int(rng.random() < 0.5)))
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[3]] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    model = N.train(docs, labels)
    assert 0.08 < model.prior < 0.18
    got = model.score(docs).select("doc_id", "_score", N.held_out().alias("out")).collect()
    truth = {r[0]: r[2] for r in rows}
    for out in (True, False):
        right = [(r._score >= 0.5) == bool(truth[r.doc_id]) for r in got if r.out == out]
        assert np.mean(right) > 0.97
    scores = {r.doc_id: r._score for r in model.score(hostile).collect()}
    assert all(0 <= x <= 1 for x in scores.values()) and scores[2] == scores[3] == scores[6]
    assert model.score(nothing).count() == 0
    blank = N.train(nothing, labels.limit(0))
    assert {r._score for r in blank.score(hostile).collect()} == {0.5}


def test_held_out_labels_are_not_read(spark, rng):
    docs = spark.createDataFrame([(k, f"w{k % 7} common word") for k in range(300)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k % 7 == 0)) for k in range(300)], "doc_id bigint, toxic int")
    flipped = labels.withColumn("toxic", F.when(N.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = N.train(docs, labels), N.train(docs, flipped)
    assert a.vocabulary == b.vocabulary and (a.weights == b.weights).all()


def test_risk_is_not_negative_driven(rng):
    rows = [rng.integers(1, 6, 3) for _ in range(60)]
    positive = np.arange(60) < 20
    w = N.fit(rows, positive, 5, 0.3)
    assert np.isfinite(w).all()
    assert N.fit([], np.zeros(0, bool), 0, 0.3)[0] == pytest.approx(math.log(0.3 / 0.7))
