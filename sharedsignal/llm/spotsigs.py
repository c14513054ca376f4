"""SpotSigs fingerprints with DataFrame functions only.

Words are runs of letters, marks and digits of the lower-cased text.  A spot is an
anchor, a common word of one of four languages, that stands directly before a content
word, with that word and the content word after it; common words in between are
skipped.  A text's signature is its set of hashed spots.  Texts without a spot take all
pairs of neighbouring content words, texts of one content word that word, and texts
without one themselves; only the empty text has an empty signature.

Near duplicates: equal signatures are one class; classes are partitioned by set length
so that only a partition and the next one can reach the threshold, meet on their
rarest spots, and are compared by Jaccard only where the lengths allow it.
"""

from __future__ import annotations

from math import isqrt, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ensure_scratch, scratch, shuffle_partitions, table

# Common function words of English, French, German and Spanish.
ANCHORS = ("a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their "
           "they this to was we were which will with you "
           "au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous on ou par pas plus pour que "
           "qui sa se ses son sur un une vous "
           "als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im ist mit "
           "nach nicht oder sein sich sie sind so über um und von war wie wird zu zum zur "
           "al como con del el ella es esta este fue ha la las lo los más muy no o para pero por se sin su sus y ya")
SIMILARITY = 0.8


def with_signature(df: DataFrame, text_col: str, out: str, anchors: str = ANCHORS) -> DataFrame:
    """``df`` and the sorted set of spot hashes (array<int>) of a text column without nulls."""
    common = sorted(set(anchors.split()))
    df = df.withColumn("_words", F.array_remove(F.split(F.lower(F.col(text_col)), r"[^\p{L}\p{M}\p{N}]+"), ""))

    def word(i):
        return F.get("_words", i)

    df = df.withColumn("_content", F.filter(
        F.transform("_words", lambda w, i: F.when(~w.isin(common), i)), lambda i: i.isNotNull()))

    def chain(first):
        def one(p, j):
            after = F.get("_content", j + 1)
            return F.when(after.isNotNull(), first(p, word(p), word(after)))
        return F.sort_array(F.array_distinct(F.array_compact(F.transform("_content", one))))

    spot = chain(lambda p, a, b: F.when(word(p - 1).isin(common), F.hash(word(p - 1), a, b)))
    df = df.withColumn("_spots", spot)
    spots = (F.when(F.size("_spots") > 0, F.col("_spots"))
             .when(F.size("_content") > 1, chain(lambda p, a, b: F.hash(a, b)))
             .when(F.size("_content") == 1, F.array(F.hash(word(F.get("_content", F.lit(0))))))
             .when(F.col(text_col) != "", F.array(F.hash(F.col(text_col))))
             .otherwise(F.array().cast("array<int>")))
    return df.withColumn(out, spots).drop("_words", "_content", "_spots")


def fingerprint(signature: Column) -> Column:
    """A signature as text: its numbers, sorted, joined by commas."""
    return F.concat_ws(",", signature.cast("array<string>"))


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Likeness of two signatures; 0 without a comparison where the lengths rule out ``least``.  Two empty ones are alike."""
    n, m = F.size(a), F.size(b)
    both = F.size(F.array_intersect(a, b))
    value = F.when((n == 0) & (m == 0), F.lit(1.0)).otherwise(both / (n + m - both))
    return F.when(F.least(n, m) < least * F.greatest(n, m), F.lit(0.0)).otherwise(value)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(members: id, class; pairs: a, b, likeness between classes of different signatures).

    ``class`` is a hash of the fingerprint.  Null texts are empty; empty texts are one
    class and pair with no other.  Pairs are complete for ``least`` > 0.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    signed = with_signature(docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("_text")), "_text", "signature")
    signed = signed.withColumn("class", F.sha2(fingerprint(F.col("signature")), 256)).drop("_text")
    members = scratch(signed, "spots")
    classes = scratch(members.groupBy("class").agg(F.first("signature").alias("signature")).filter(F.size("signature") > 0), "classes")
    often = classes.select(F.explode("signature").alias("spot")).groupBy("spot").agg(F.count("*").alias("often"))
    length = F.size("signature")
    spots = (classes.select("class", length.alias("n"), F.explode("signature").alias("spot")).join(often, "spot")
             .groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("often", "spot"))).alias("by")))
    # two sets within the threshold share one of their rarest spots
    prefix = (F.col("n") - F.ceil(F.col("n") * least) + 1).cast("int")
    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(log(1 / least) if least < 1 else 1.0)).cast("int")
    rare = scratch(spots.withColumn("part", part).select("class", "n", "part", F.explode(F.slice("by", F.lit(1), prefix)).alias("s"))
                   .select("class", "n", "part", "s.spot"), "rare")
    right = rare.select(F.col("class").alias("b"), F.col("n").alias("m"), "spot",
                        F.explode(F.array("part", F.col("part") - 1)).alias("part"), F.col("part").alias("own"))
    found = (rare.withColumnRenamed("class", "a").join(right, ["spot", "part"])
             .filter((F.col("own") > F.col("part")) | (F.col("a") < F.col("b")))
             .filter(F.least("n", "m") >= least * F.greatest("n", "m")).select("a", "b").distinct())
    s = classes.select(F.col("class"), F.col("signature"))
    pairs = (found.join(s.toDF("a", "sa"), "a").join(s.toDF("b", "sb"), "b")
             .withColumn("likeness", jaccard(F.col("sa"), F.col("sb"), least)).filter(F.col("likeness") >= least)
             .select("a", "b", "likeness"))
    return members.select("id", "class"), pairs


def range_bounds(ids: DataFrame, id_col: str, n: int) -> list:
    """At most n - 1 increasing bounds that cut the ids into ranges of about as many rows."""
    at = [k / n for k in range(1, n)]
    if not at:
        return []
    found = ids.agg(F.percentile_approx(id_col, at, 10000).alias("q")).first()["q"]
    return sorted(set(found or []))


def range_number(value: Column, bounds: list) -> Column:
    """How many bounds are below the value: a search in two levels of about the square root each."""
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds)) + 1
    groups = [bounds[k:k + step] for k in range(0, len(bounds), step)]
    tops = F.array(*[F.lit(g[-1]) for g in groups])
    inner = F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups])
    first = F.size(F.filter(tops, lambda x: x < value))
    group = F.coalesce(F.get(inner, first), F.array().cast("array<bigint>"))
    return first * step + F.size(F.filter(group, lambda x: x < value))


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (doc_id, text) with their signature and the next row's text and signature by descending id.

    After the last row comes the first.  Rows without an id come last; equal ids are
    ordered by a hash of the text.  The rows are dealt once, by ranges of the id; the
    first row of each range also goes to the range before it.
    """
    bounds = range_bounds(docs, "doc_id", buckets)
    place = F.coalesce(range_number(F.col("doc_id"), bounds), F.lit(-1))  # rows without an id: below all others
    tie = F.xxhash64("text")
    rows = docs.withColumn("bucket", place).withColumn("tie", tie)
    key = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "tie")
    heads = sorted((r["bucket"], r["top"]) for r in rows.groupBy("bucket").agg(F.max(key).alias("top")).collect())  # a row a bucket
    ghosts = [(heads[k + 1 if k + 1 < len(heads) else 0][0], top["doc_id"], top["tie"], b) for k, (b, top) in enumerate(heads)]
    spark = docs.sparkSession
    wanted = spark.createDataFrame(ghosts, "target int, g_id bigint, g_tie bigint, home int")
    copies = (rows.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("tie") == F.col("g_tie")))
              .dropDuplicates(["target"])
              .select("doc_id", "text", F.col("target").alias("bucket"), "tie", F.lit(True).alias("ghost")))
    dealt = rows.withColumn("ghost", F.lit(False)).unionByName(copies).repartition(buckets, "bucket")
    signed = with_signature(dealt, "text", "signature")
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return (signed.withColumn("next_text", F.lead("text").over(order)).withColumn("next_signature", F.lead("signature").over(order))
            .filter(~F.col("ghost")))


def query(spark, sf_dir):
    """op3: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    ensure_scratch(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                                   F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, shuffle_partitions(spark))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("n_chars", n.cast("bigint")).withColumn("edited", edited)
    rows = with_signature(rows, "edited", "edited_signature")
    return rows.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                       fingerprint(F.col("signature")).alias("fingerprint"),
                       fingerprint(F.col("edited_signature")).alias("edited_fingerprint"),
                       jaccard(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
                       jaccard(F.col("signature"), F.col("next_signature")).alias("near_next"))
