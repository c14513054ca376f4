"""Quality filter: perplexity under an interpolated modified Kneser-Ney model.

The model is of order 4 over UTF-16 code units, so its vocabulary is closed (65,536
symbols), and a 4-gram is one 64-bit number.  Three boundary units stand before each
text.  It is trained on all trusted texts but a held-out fifth (by a hash of the id).

*Counts.*  One pass over the texts gives, per piece of bounded size, its distinct
4-grams with their trusted counts; one aggregation adds them up.  Lower orders are
continuation counts.  Discounts come from each order's counts of counts.

*Sharded joins.*  Every 4-gram of the corpus is joined with the count and context
tables of each order, from the shortest up, all keyed by the gram; the result is one
log probability per distinct 4-gram.

*Scores.*  The most frequent grams, at most SHARD, go to every task, which adds up their
part of each text's log probability in one pass.  Where the table holds more, the other
grams stay in Spark: (text, gram, count), with a digest for the text, are joined with the
table by the gram and added up by the text.  None of those grams has more than about
2 / SHARD of all occurrences, so the join has no hot key.

*Decision.*  Per language, quantiles of the held-out trusted texts' log perplexity; a
text outside [low, high] is rejected.  Four units see no more than a short word, so a
word repeated without end has about the perplexity of its grams and often passes.
The quantiles of n texts are uncertain, so their distance from the median, at least WIDTH,
is widened by the factor 1 + MARGIN / sqrt(n).  A language with fewer than LEAST held-out
texts also has at least the widened distances of all languages around its own median, and
the thresholds over all languages where those are wider.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, scratch, table, utf8_column

ORDER, UNIT = 4, 16
VOCABULARY = 1 << UNIT
LOW, HIGH, MARGIN = 0.002, 0.995, 6.0
HELD_OUT = 5
#: Held-out texts for a language's own thresholds, and the least distance of a threshold from the median (log perplexity).
LEAST, WIDTH = 30, 0.1
#: Most grams that pass through the driver and go to every task: 12 bytes each.
SHARD = 2_000_000
#: Trusted ids that may be sent to every task; more are joined by a shuffle.
BROADCAST_IDS = 4_000_000


def grams_of(texts):
    """4-grams of texts (bytes, UTF-8) as int64 and each text's number of code units."""
    parts = [t.decode().encode("utf-16-le") for t in texts]
    sizes = np.fromiter((len(p) // 2 for p in parts), np.int64, len(parts))
    pad = bytes(2 * (ORDER - 1))
    units = np.frombuffer(pad + pad.join(parts), np.uint16).astype(np.uint64)
    key = np.zeros(max(0, len(units) - ORDER + 1), np.uint64)
    for k in range(ORDER):
        key = (key << np.uint64(UNIT)) | units[k:k + len(key)]
    at = np.repeat(np.arange(len(parts)) * (ORDER - 1), sizes) + np.arange(sizes.sum())
    return key[at].view(np.int64), sizes


def texts_of(data, off, i, j):
    raw = data[off[i]:off[j]].tobytes()
    cut = (off[i:j + 1] - off[i]).tolist()
    return [raw[a:z] for a, z in zip(cut, cut[1:])]


def distinct(keys):
    keys = np.sort(keys)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[new], np.diff(np.append(new, len(keys)))


def gram_counts(docs: DataFrame) -> DataFrame:
    """(gram, c, n): every 4-gram of ``docs`` (text, train) with its count in the rows to train on and in all rows."""

    def run(batches):
        for b in batches:
            data, off = utf8_column(b.column(0))
            train = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for i, j in pieces(off):
                keys, sizes = grams_of(texts_of(data, off, i, j))
                mine = np.repeat(train[i:j], sizes)
                gram, c = distinct(keys[mine])
                other, n = distinct(keys[~mine])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([gram, other])),
                                                  pa.array(np.concatenate([c, np.zeros(len(other), np.int64)])),
                                                  pa.array(np.concatenate([c, n]))], names=["gram", "c", "n"])

    return docs.mapInArrow(run, "gram bigint, c bigint, n bigint").groupBy("gram").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def suffix(order: int):
    return F.col("gram").bitwiseAND(F.lit((1 << UNIT * order) - 1))


def context():
    return F.shiftrightunsigned("gram", UNIT)


def discounts(table_of: DataFrame) -> tuple[float, float, float]:
    """D1, D2, D3+ from the counts of counts; 0.5, 1, 1.5 where a count of counts is missing."""
    n = table_of.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    if not all((n[0], n[1], n[2], n[3])):
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    d = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return tuple(min(float(k), max(0.05 * k, x)) for k, x in zip((1, 2, 3), d))


def log_probabilities(counts: DataFrame) -> DataFrame:
    """(gram, n, logp) for every gram of ``counts`` (gram, c, n), also those with c = 0."""
    tables = {ORDER: counts.filter("c > 0")}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = tables[k + 1].groupBy(suffix(k).alias("gram")).agg(F.count("*").alias("c"))
        tables[k] = scratch(tables[k], f"order{k}")
    asked = {ORDER: counts.select("gram", "n")}
    for k in range(ORDER - 1, 0, -1):
        asked[k] = scratch(asked[k + 1].select(suffix(k).alias("gram")).distinct(), f"asked{k}")
    lower = None
    for k in range(1, ORDER + 1):
        d1, d2, d3 = discounts(tables[k])
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        seen = tables[k].withColumn("ctx", context() if k > 1 else F.lit(0).cast("bigint"))
        ctx = seen.groupBy("ctx").agg(F.sum("c").cast("double").alias("total"), F.sum(cut).alias("mass"))
        top = seen.select("gram", (F.col("c") - cut).alias("top"))
        rows = (asked[k].withColumn("ctx", context() if k > 1 else F.lit(0).cast("bigint"))
                .join(ctx, "ctx", "left").join(top, "gram", "left"))
        if lower is None:
            rows = rows.withColumn("below", F.lit(1.0 / VOCABULARY))
        else:
            rows = rows.withColumn("s", suffix(k - 1)).join(lower.select(F.col("gram").alias("s"), F.col("p").alias("below")), "s")
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise(
            (F.coalesce("top", F.lit(0.0)) + F.col("mass") * F.col("below")) / F.col("total"))
        lower = scratch(rows.select(*asked[k].columns, p.alias("p")), f"p{k}")
    return lower.select("gram", "n", F.log("p").alias("logp"))


def model_shards(probabilities: DataFrame, shard: int = SHARD) -> tuple:
    """(broadcast, rest): the most frequent grams, sorted, with their log probabilities, at most ``shard`` of them,
    and the rows (gram, logp) of the others, None if there are none.
    """
    spark, rest = probabilities.sparkSession, None
    if probabilities.count() > shard:
        size = F.floor(F.log2("n")).cast("int")
        sizes = probabilities.groupBy(size.alias("size")).count().collect()  # at most 64 rows
        least = max(r["size"] for r in sizes) + 1
        while sum(r["count"] for r in sizes if r["size"] >= least - 1) <= shard:
            least -= 1
        rest = probabilities.filter(size < least).select("gram", "logp")
        probabilities = probabilities.filter(size >= least)
    t = probabilities.select("gram", "logp").toArrow()
    gram, logp = t.column("gram").to_numpy(), t.column("logp").to_numpy().astype(np.float32)
    order = np.argsort(gram)
    return spark.sparkContext.broadcast((gram[order], logp[order])), rest


def found_in(grams, keys):
    """Places of sorted ``keys`` in sorted ``grams`` and whether they are there."""
    at = np.minimum(np.searchsorted(grams, keys), max(0, len(grams) - 1))
    return at, grams[at] == keys if len(grams) else np.zeros(len(keys), bool)


def score(docs: DataFrame, shards: tuple, text_col: str = "text") -> DataFrame:
    """All columns and _units (code units) and _logp (natural log probability of the text).

    Grams that the model lacks, in texts that were not counted, have probability 1 / VOCABULARY.
    """
    where = docs.columns.index(text_col)
    schema = T.StructType(docs.schema.fields + [T.StructField("_units", T.LongType()), T.StructField("_logp", T.DoubleType()),
                                                T.StructField("_cold", T.LongType())])
    hot, rest = shards
    floor = -float(np.log(VOCABULARY))
    other = floor if rest is None else 0.0

    def add(batches):
        grams, logp = hot.value
        for b in batches:
            data, off = utf8_column(b.column(where))
            units, sums, cold = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
            for i, j in pieces(off):
                keys, sizes = grams_of(texts_of(data, off, i, j))
                order = np.argsort(keys)
                ranked, times = distinct(keys[order])
                at, known = found_in(grams, ranked)
                value = np.full(len(ranked), other)
                value[known] = logp[at[known]]
                each, missing = np.empty(len(keys)), np.empty(len(keys), np.int64)
                each[order], missing[order] = np.repeat(value, times), np.repeat(~known, times)
                upto = np.concatenate([[0], np.cumsum(sizes)])
                units[i:j] = sizes
                sums[i:j] = np.diff(np.concatenate([[0.0], np.cumsum(each)])[upto])
                cold[i:j] = np.diff(np.concatenate([[0], np.cumsum(missing)])[upto])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(units), pa.array(sums), pa.array(cold)], names=schema.names)

    def left_out(batches):
        grams = hot.value[0]
        for b in batches:
            data, off = utf8_column(b.column(1))
            for i, j in pieces(off):
                keys, sizes = grams_of(texts_of(data, off, i, j))
                order = np.lexsort((np.repeat(np.arange(i, j), sizes), keys))
                row, keys = np.repeat(np.arange(i, j), sizes)[order], keys[order]
                cold = ~found_in(grams, keys)[1]
                row, keys = row[cold], keys[cold]
                new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])])) if len(keys) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row[new])), pa.array(keys[new]),
                                                  pa.array(np.diff(np.append(new, len(keys))))], names=["_digest", "gram", "c"])

    out = docs.mapInArrow(add, schema)
    if rest is None:
        return out.drop("_cold")
    # equal texts share a digest: the mean over all their left-out grams is that of each
    digest = F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    mean = (docs.select(digest.alias("_digest"), F.col(f"`{text_col}`").alias("text"))
            .mapInArrow(left_out, "_digest string, gram bigint, c bigint").join(rest, "gram", "left")
            .groupBy("_digest").agg((F.sum(F.col("c") * F.coalesce("logp", F.lit(floor))) / F.sum("c")).alias("_mean")))
    return (out.withColumn("_digest", digest).join(mean, "_digest", "left")
            .withColumn("_logp", F.col("_logp") + F.col("_cold") * F.coalesce("_mean", F.lit(0.0)))
            .select(*[F.col(f"`{c}`") for c in docs.columns], "_units", "_logp"))


class QualityModel:
    """A trained model: log probabilities (broadcast and rest) and thresholds by language."""

    def __init__(self, shards, thresholds):
        self.shards, self.thresholds = shards, thresholds

    def judge(self, docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
        """All columns and _units, _perplexity, _low, _high, _keep (``kept`` is for rows that may have columns of these names).

        Null and empty texts have no perplexity and are rejected.  A language without
        held-out trusted texts (null too) takes the thresholds over all languages;
        without any trusted text every text with a perplexity is kept.
        """
        t = self.thresholds
        every = t.filter("every").select(F.col("low").alias("_l"), F.col("high").alias("_h"))
        own = t.filter("not every").select(F.col("lang").alias("_lang"), F.col("low").alias("_low"), F.col("high").alias("_high"))
        scored = score(docs, self.shards, text_col).withColumn(
            "_perplexity", F.when(F.col("_units") > 0, F.exp(-F.col("_logp") / F.col("_units"))))
        general = every.first() or {"_l": None, "_h": None}  # one row, none without trusted texts
        return (scored.join(own, scored[lang_col].eqNullSafe(own["_lang"]), "left")
                .withColumn("_low", F.coalesce("_low", F.lit(general["_l"]).cast("double")))
                .withColumn("_high", F.coalesce("_high", F.lit(general["_h"]).cast("double")))
                .withColumn("_keep", F.coalesce((F.col("_perplexity") >= F.coalesce("_low", F.lit(0.0)))
                                                & (F.col("_perplexity") <= F.coalesce("_high", F.lit(float("inf")))), F.lit(False)))
                .drop("_lang", "_logp"))

    def kept(self, docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
        """The rows that ``judge`` keeps, with the columns of ``docs`` and no others.

        The columns go through under numbered names, so those that are called like a
        column of ``judge`` or of its joins keep their values.
        """
        names = [f"c{i}" for i in range(len(docs.columns))]
        text, lang = (names[docs.columns.index(c)] for c in (text_col, lang_col))
        return self.judge(docs.toDF(*names), text, lang).filter("_keep").select(*names).toDF(*docs.columns)


def train(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          low: float = LOW, high: float = HIGH, margin: float = MARGIN, shard: int = SHARD) -> QualityModel:
    """Train on the rows of ``docs`` whose id is in ``trusted`` (one id column) and set the thresholds.

    Null ids are never trusted.  Ids that ``trusted`` repeats count once; rows of ``docs`` that repeat an id count each.
    """
    ids = trusted.select(F.col(f"`{trusted.columns[0]}`").alias("_id")).filter("_id is not null").distinct()
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    slim = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    held = F.pmod(F.xxhash64("_id"), F.lit(HELD_OUT)) == 0
    marked = (slim.join(ids.withColumn("_t", F.lit(True)), "_id", "left")
              .select("text", (F.col("_t").isNotNull() & ~held).alias("train")))
    counts = scratch(gram_counts(marked), "grams")
    shards = model_shards(log_probabilities(counts), shard)
    sample = score(slim.join(ids, "_id").filter(held).select("text", "lang"), shards).filter("_units > 0")
    q = F.percentile_approx(-F.col("_logp") / F.col("_units"), F.array(F.lit(low), F.lit(0.5), F.lit(high)), F.lit(10000))
    found = sample.rollup("lang").agg(q.alias("q"), F.count("*").alias("n"), F.grouping("lang").alias("g"))
    return QualityModel(shards, scratch(limits(scratch(found, "quantiles"), margin), "thresholds"))


def limits(found: DataFrame, margin: float = MARGIN) -> DataFrame:
    """(lang, low, high, every) from written rows (lang, q, n, g): quantiles of log perplexity low, median, high."""
    wider, middle = 1 + margin / F.sqrt("n"), F.col("q")[1]
    own = found.select("lang", "n", "g", middle.alias("m"), (F.greatest(middle - F.col("q")[0], F.lit(WIDTH)) * wider).alias("below"),
                       (F.greatest(F.col("q")[2] - middle, F.lit(WIDTH)) * wider).alias("above"))
    low, high = F.col("m") - F.col("below"), F.col("m") + F.col("above")
    whole = own.filter("g = 1").first()  # one row, none without trusted texts
    if whole:
        few = F.col("n") < LEAST
        low = F.when(few, F.least(low, F.col("m") - whole["below"], F.lit(whole["m"] - whole["below"]))).otherwise(low)
        high = F.when(few, F.greatest(high, F.col("m") + whole["above"], F.lit(whole["m"] + whole["above"]))).otherwise(high)
    return own.select("lang", F.exp(low).alias("low"), F.exp(high).alias("high"), (F.col("g") == 1).alias("every"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.filter("quality = 1").select("doc_id")


def query(spark, sf_dir):
    """op2: doc_id, lang, n_units, perplexity, low, high, keep."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, trusted_ids(table(spark, sf_dir, "labels")))
    return model.judge(docs).select("doc_id", "lang", F.col("_units").alias("n_units"), F.col("_perplexity").alias("perplexity"),
                                    F.col("_low").alias("low"), F.col("_high").alias("high"), F.col("_keep").alias("keep"))
