"""Hard-negative mining: exact windows of inner products by cover trees.

For an anchor, candidates with an inner product inside [ratio * p, p] of a positive's
score p are hard negatives.  Candidates of one label are dealt into shards; each shard
becomes a cover tree.

* *Norm augmentation.*  A candidate x gets one more coordinate sqrt(M^2 - |x|^2), M the
  largest norm of its shard, so all candidates lie on a sphere and the inner product with
  an anchor falls as the distance to it grows.
* *Covering radii.*  Level i of the tree covers its points with balls of radius
  R / 2 ** i whose centres are further than that from one another; a child's ball is
  covered by its parent's.  A node keeps the largest distance from its centre to a point
  below it, which on the sphere is an angle: inner products of everything below lie
  between |q| M cos(angle + radius) and |q| M cos(angle - radius).
* *Best-first descent.*  Nodes are taken by their upper bound; those outside every window
  of the anchor, or below what the window already has, are skipped.  Leaves are verified
  with exact integer products.

Anchors are a stated query set against all rows.  They are sent to the trees in blocks of
bounded size, and each task keeps an anchor's best over all its trees before the shuffle.
"""

from __future__ import annotations

import heapq
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ensure_scratch, pick, scratch, shuffle_partitions, table

SCALE, PERIOD, RELABEL, LABELS = 256, 100, 7, 10
POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
#: Rows of a tree, points of a leaf, anchors that are sent to the trees at once.
SHARD, LEAF, BLOCK = 4096, 8, 16384
#: Squared norms from here on could give products that no 64-bit number holds.
LARGEST = float(1 << 62)


# --- the tree ---------------------------------------------------------------------------

class CoverTree:
    """Points in tree order; node k has the points [lo, hi), its centre at lo, and children [child, child + children)."""

    FIELDS = ("lo", "hi", "child", "children", "radius")

    def __init__(self, ids, points, lo, hi, child, children, radius):
        self.ids, self.points = ids, points
        self.lo, self.hi, self.child, self.children, self.radius = lo, hi, child, children, radius
        norms = (points.astype(np.float64) ** 2).sum(1)
        self.norm = float(np.sqrt(norms.max(initial=0.0)))
        # products are exact in doubles while no sum of absolute products reaches 2 ** 53
        self.as_double = points.astype(np.float64)
        ratio = self.radius / (2 * self.norm) if self.norm else np.zeros(len(radius))
        self.angle = 2 * np.arcsin(np.minimum(1.0, ratio)) + 1e-9 * (self.radius > 0)

    @classmethod
    def build(cls, ids, points, leaf: int = LEAF):
        """Greedy covers, level by level, from the points ordered by id."""
        order = np.argsort(ids, kind="stable")
        ids, points = ids[order], points[order]
        real = points.astype(np.float64)
        norms = (real ** 2).sum(1)
        lifted = np.column_stack([real, np.sqrt(np.maximum(0.0, norms.max() - norms))])

        def distances(rows, centre):
            return np.sqrt(np.maximum(0.0, ((lifted[rows] - lifted[centre]) ** 2).sum(1)))

        everything = np.arange(len(ids))
        away = distances(everything, 0)
        nodes = [(everything, away)]  # members, centre first, and their distances to it
        lo, hi, child, children, radius, place = [0], [len(ids)], [0], [0], [float(away.max())], np.zeros(len(ids), np.int64)
        place[:] = everything
        k = 0
        while k < len(nodes):
            members, away = nodes[k]
            nodes[k] = None
            place[lo[k]:hi[k]] = members
            if len(members) > leaf and radius[k] > 0:
                cover, left, parts = radius[k] / 2, np.arange(len(members)), []
                centre_away = away
                while True:  # the node's centre first, then points that nothing covers yet
                    inside = centre_away <= cover
                    parts.append((left[inside], centre_away[inside]))
                    left = left[~inside]
                    if not len(left):
                        break
                    centre_away = distances(members[left], members[left[0]])
                child[k], children[k] = len(nodes), len(parts)
                at = lo[k]
                for rows, gap in parts:
                    own = members[rows]
                    if gap[0] > 0:  # a copy of the centre is not in front of it
                        raise AssertionError("a cover's centre is its first point")
                    nodes.append((own, gap))
                    lo.append(at)
                    at += len(own)
                    hi.append(at)
                    child.append(0)
                    children.append(0)
                    radius.append(float(gap.max()) * (1 + 1e-12))
            k += 1
        return cls(ids[place], points[place], *(np.array(x, np.int64) for x in (lo, hi, child, children)), np.array(radius))

    def products(self, q, rows, exact_doubles: bool):
        """Inner products of q with points[rows], as integers."""
        if exact_doubles:
            return (self.as_double[rows] @ q.astype(np.float64)).astype(np.int64)
        return (self.points[rows] * q).sum(1)  # wraps on the way, never in the end

    def search(self, q, windows: list["Window5"], skip_id=None) -> int:
        """Offer every point whose product may enter a window; returns the number of points verified."""
        size = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
        scale, seen = size * self.norm, 0
        doubles = scale < float(1 << 52)
        slack = 1e-9 * scale + 0.5

        def verify(rows):
            score = self.products(q, rows, doubles)
            ids = self.ids[rows]
            for w in windows:
                w.offer(score, ids, skip_id)
            return len(score)

        if not self.children[0]:
            return verify(slice(0, len(self.ids)))
        heap = [(-np.inf, 0)]
        while heap:
            upper, k = heapq.heappop(heap)
            if all(-upper < w.least for w in windows):
                break  # no node left reaches any window
            if not self.children[k]:
                seen += verify(slice(self.lo[k], self.hi[k]))
                continue
            below = np.arange(self.child[k], self.child[k] + self.children[k])
            first = self.lo[below]
            score = self.products(q, first, doubles)
            single = self.hi[below] - first == 1
            if single.any():
                ids = self.ids[first[single]]
                seen += len(ids)
                for w in windows:
                    w.offer(score[single], ids, skip_id)
                below, score = below[~single], score[~single]
            if not len(below):
                continue
            turn = np.arccos(np.clip(score / scale, -1.0, 1.0)) if scale else np.zeros(len(below))
            top = scale * np.cos(np.maximum(0.0, turn - self.angle[below])) + slack
            low = scale * np.cos(np.minimum(np.pi, turn + self.angle[below])) - slack
            wanted = np.zeros(len(below), bool)
            for w in windows:
                wanted |= (top >= w.least) & (low <= w.high)
            for node, bound in zip(below[wanted].tolist(), top[wanted].tolist()):
                heapq.heappush(heap, (-bound, node))
        return seen


class Window5:
    """The first ``most`` points of the products in [low, high]: higher products first, ties by smaller id."""

    __slots__ = ("low", "high", "most", "score", "ids", "least")

    def __init__(self, low, high, most: int):
        self.low, self.high, self.most, self.least = low, high, most, low
        self.score, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, score, ids, skip_id=None):
        inside = (score >= self.least) & (score <= self.high)
        if skip_id is not None:
            inside &= ids != skip_id
        if not inside.any():
            return
        score, ids = np.concatenate([self.score, score[inside]]), np.concatenate([self.ids, ids[inside]])
        order = np.lexsort((ids, -score))[:self.most]
        self.score, self.ids = score[order], ids[order]
        if len(order) == self.most:
            self.least = max(self.low, int(self.score[-1]))  # an equal product with a smaller id still enters


# --- rows and trees in Spark ----------------------------------------------------------------

def integer_rows(embeddings: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """(id, label, vec): rows that take part, components floor(scale * x); equal rows once.

    Rows with a null id, label or vector, with a null or non-finite component, or with a
    squared norm that a score could not hold take no part.
    """
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    size = F.aggregate("vec", F.lit(0.0), lambda s, x: s + F.floor(scale * x).cast("double") * F.floor(scale * x).cast("double"))
    real = F.transform(F.col("vec"), lambda x: x.cast("double"))
    largest = F.coalesce(F.array_max(F.transform("vec", F.abs)), F.lit(0.0))
    rows = (pick(embeddings, id=id_col, vec=vector_col, label=label_col).filter("id is not null and label is not null and vec is not null")
            .withColumn("vec", real).filter(sound).filter(largest < float(1 << 31) / scale).filter(size < LARGEST))
    return rows.select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"),
                       F.transform("vec", lambda x: F.floor(scale * x).cast("bigint")).alias("vec")).distinct()


def plant_trees(rows: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per tree: (label, size of a vector, bucket, node arrays, ids, points), written.

    A label's rows are dealt to as many buckets as they fill, so a label that holds a
    third of all rows is many trees.
    """
    wide = rows.withColumn("dim", F.size("vec"))
    counts = wide.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("buckets"))
    dealt = (wide.join(counts, ["label", "dim"])
             .withColumn("bucket", F.pmod(F.xxhash64("id", "vec"), F.col("buckets")))
             .groupBy("label", "dim", "bucket").agg(F.collect_list(F.struct("id", "vec")).alias("members")))
    names = ["label", "dim", "bucket", *CoverTree.FIELDS, "ids", "points"]

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                members = b.column(3)[r].values
                ids = members.field("id").to_numpy(zero_copy_only=False)
                dim = b.column(1)[r].as_py()
                points = members.field("vec").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), dim)
                tree = CoverTree.build(ids, points)
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).slice(r, 1) for k in range(3)]
                    + [pa.array([getattr(tree, f).tobytes()], pa.binary()) for f in CoverTree.FIELDS]
                    + [pa.array([tree.ids.tobytes()], pa.binary()), pa.array([tree.points.astype(np.int32).tobytes()], pa.binary())], names=names)

    return scratch(dealt.mapInArrow(run, "label bigint, dim int, bucket bigint, " + ", ".join(f"{f} binary" for f in names[3:])), "trees")


def grown(row: dict) -> CoverTree:
    arrays = [np.frombuffer(row[f], np.float64 if f == "radius" else np.int64) for f in CoverTree.FIELDS]
    points = np.frombuffer(row["points"], np.int32).astype(np.int64).reshape(-1, row["dim"]) if row["dim"] else np.zeros((len(row["ids"]) // 8, 0), np.int64)
    return CoverTree(np.frombuffer(row["ids"], np.int64), points, *arrays)


def descend(trees: DataFrame, sent, same_label: bool, most: int) -> DataFrame:
    """(k, slot, id, score): of every task's trees, each window's first ``most`` points.

    ``sent``: a broadcast of (labels, vectors, ids, windows) of a block of anchors, in
    which windows[k] lists the (low, high) of anchor k's slots.
    """
    spread = trees.repartition(shuffle_partitions(trees.sparkSession), "label", "dim", "bucket")

    def run(batches):
        labels, vectors, ids, windows = sent.value
        by_size: dict = {}
        for k, v in enumerate(vectors):
            by_size.setdefault(len(v), []).append(k)
        held: dict = {}
        for b in batches:
            for row in b.to_pylist():
                tree = grown(row)
                for k in by_size.get(row["dim"], ()):
                    if (labels[k] == row["label"]) != same_label or not windows[k]:
                        continue
                    if k not in held:
                        held[k] = [Window5(low, high, most) for low, high in windows[k]]
                    tree.search(vectors[k], held[k], ids[k] if same_label else None)
        found = [(k, slot, i, s) for k, own in held.items() for slot, w in enumerate(own) for i, s in zip(w.ids.tolist(), w.score.tolist())]
        for at in range(0, len(found), 10_000):
            columns = list(zip(*found[at:at + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k", "slot", "id", "score"])

    best = Window.partitionBy("k", "slot").orderBy(F.col("score").desc(), "id")
    return (spread.mapInArrow(run, "k bigint, slot bigint, id bigint, score bigint")
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most))


# --- the operator ------------------------------------------------------------------------

def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from rows (id, label, vec).

    Per anchor its first ``positives`` rows of the same label and another id, and for each
    of them the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score; higher scores
    first, ties by smaller id.  Vectors of another length than the anchor's are not
    compared with it.  An anchor or a positive without a negative gives no row; so do
    empty tables.  Rows that share an id but not their label or vector stand for themselves.
    """
    spark = rows.sparkSession
    trees = plant_trees(rows, shard)
    asked = anchors.select("id", "label", "vec").distinct()
    blocks = max(1, -(-asked.count() // block))
    asked = scratch(asked.withColumn("block", F.pmod(F.xxhash64("id", "label", "vec"), F.lit(blocks))).repartitionByRange(blocks, "block"), "anchors")
    ensure_scratch(spark)
    root = f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/text/negatives-{uuid.uuid4().hex[:12]}"
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    written = []
    for number in range(blocks):
        own = asked.filter(F.col("block") == number).orderBy("id", "label", "vec").toArrow()
        if not own.num_rows:
            continue
        ids, labels = own.column("id").to_pylist(), own.column("label").to_pylist()
        vectors = [np.array(v, np.int64) for v in own.column("vec").to_pylist()]
        everything = [[(-(1 << 63), (1 << 63) - 1)]] * len(ids)
        first = spark.sparkContext.broadcast((labels, vectors, ids, everything))
        found = descend(trees, first, True, positives).orderBy("k", "rank").toArrow().to_pylist()
        first.unpersist()
        windows, slots = [[] for _ in ids], []
        for r in found:
            # integer bounds of low * p <= 100 * n <= high * p
            windows[r["k"]].append((-((-low * r["score"]) // 100), high * r["score"] // 100))
            slots.append((r["k"], len(windows[r["k"]]) - 1, ids[r["k"]], r["id"], r["score"]))
        second = spark.sparkContext.broadcast((labels, vectors, ids, windows))
        pairs = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in (zip(*slots) if slots else [[]] * 5)],
                                               names=["k", "slot", "anchor_id", "positive_id", "positive_score"]))
        out = (descend(trees, second, False, negatives).join(F.broadcast(pairs), ["k", "slot"])
               .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
                       F.col("score").alias("negative_score")))
        out.write.parquet(f"{root}/{number}")
        second.unpersist()
        written.append(f"{root}/{number}")
    return spark.read.schema(schema).parquet(*written) if written else spark.createDataFrame([], schema)


def query(spark, sf_dir):
    """op12: anchors are rows whose id is divisible by 100; every seventh id gets the next label first."""
    rows = integer_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    rows = scratch(rows.withColumn("label", F.when(F.col("id") % RELABEL == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))), "vectors")
    return mine(rows, rows.filter(F.col("id") % PERIOD == 0))


#: The same rows from all products.
SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND NOT (a.label = b.label AND a.vec_id = b.vec_id)),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 5
"""
