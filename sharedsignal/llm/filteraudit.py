"""Filter interaction audit: what each filter removes in every order of the filters.

Every document gets a mask of the filters it fails.  For masks M (0 where a filter
fails, infinity where it passes) and the inverse permutations P of the orders (the
position of each filter), the min-plus product  R[m, o] = min over f (M[m, f] + P[o, f])
is the step at which order o removes a document of mask m.  Scatter-adds of the masks'
weights at R give what each step removes; a filter failed at a position after R is
redundant there.

1. *Masks.*  Filters on single texts run in one pass over the whole texts, in pieces
   of bounded size; E (a copy of a smaller id's text) joins each text's digest (SHA-256)
   with the least id of the digests that occur twice or more.
2. *Weights.*  Rows are counted by (part, mask), with a partial count in every task, so
   a part or a text that holds a third of all rows is a few rows before the shuffle.
3. *Ranks.*  A part is at most 2 ** (number of filters) rows; parts are dealt over the
   tasks, each computes its products and scatters.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE_BYTES, pick, scratch, table, utf8_column

LETTERS = "ABCDE"
#: A: fewest words. B: least per cent of distinct words. C: most per cent of capitals. D: forbidden characters.
FEWEST, DISTINCT, CAPITALS, FORBIDDEN = 200, 50, 2, "#$%&*|"


# --- 1. masks -------------------------------------------------------------------------

def word_lists(raw: bytes, most: int = PIECE_BYTES):
    """The words of a text (white space: 0x20 and 0x09-0x0D), in lists of about ``most`` bytes."""
    at = 0
    while len(raw) - at > most:
        cut = max(raw.rfind(c, at, at + most) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
        if cut <= at:  # no white space after the first byte: the piece ends at the next one
            later = re.compile(rb"[ \t-\r]").search(raw, at + most)
            cut = later.start() if later else len(raw)
        yield raw[at:cut].split()
        at = cut
    yield raw[at:].split()


def text_mask(raw: bytes) -> int:
    """Bits 0-3: whether the text (UTF-8) fails A, B, C, D."""
    words, different = 0, set()
    for part in word_lists(raw):
        words += len(part)
        different.update(part)
    capitals = len(raw) - len(raw.translate(None, bytes(range(0x41, 0x5B))))
    points = len(raw.translate(None, bytes(range(0x80, 0xC0))))
    failed = (words < FEWEST, 100 * len(different) < DISTINCT * words, 100 * capitals > CAPITALS * points,
              re.search(b"[" + re.escape(FORBIDDEN.encode()) + b"]", raw) is not None)
    return sum(1 << k for k, f in enumerate(failed) if f)


def document_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask): the filters that each row fails, bit k for letter k.

    Null text is the empty text and a null part the empty string.  A row fails E if a
    smaller id has the same text: rows that repeat the least id and its text pass, a null
    id is neither smaller nor larger than any other.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            data, off = utf8_column(b.column(2))
            raw, cut = data.tobytes(), off.tolist()
            texts = [raw[a:z] for a, z in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([text_mask(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], names=["id", "part", "mask", "digest"])

    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                         F.col(f"`{text_col}`").alias("text"))
    rows = scratch(source.mapInArrow(run, f"id {kind}, part string, mask int, digest binary"), "masks")
    first = scratch(rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "first")
    copy = F.when(F.col("first") < F.col("id"), 1 << LETTERS.index("E")).otherwise(0)
    return rows.join(first, "digest", "left").select("id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


# --- 3. ranks -------------------------------------------------------------------------

def positions(n: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of n filters and their inverse permutations: P[o, f] is the step of filter f, from 1."""
    orders = list(itertools.permutations(range(n)))
    return orders, np.argsort(np.array(orders, np.int64).reshape(-1, n), axis=1) + 1


def removal_steps(masks: np.ndarray, place: np.ndarray) -> np.ndarray:
    """R[m, o], the min-plus product of the masks' matrix and the positions; n + 1: never removed."""
    n = place.shape[1]
    fails = (masks[:, None] >> np.arange(n)) & 1 == 1
    never = np.int64(n + 1)
    out = np.full((len(masks), len(place)), never)
    for f in range(n):
        np.minimum(out, np.where(fails[:, f, None], place[None, :, f], never), out=out)
    return out


def tally(masks: np.ndarray, weights: np.ndarray, orders: list, place: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of one part by [order, step]; weights: one row per mask, the count and then the losses to add up."""
    n, count = place.shape[1], weights[:, 0]
    step = removal_steps(masks, place)
    lost = np.zeros((len(place), n + 2, weights.shape[1]), np.int64)
    every = np.broadcast_to(np.arange(len(place)), step.shape)
    np.add.at(lost, (every, step), weights[:, None, :])
    removed = lost[:, 1:n + 1, 0]
    filters = np.array(orders, np.int64).reshape(-1, n)
    redundant = np.zeros((len(place), n), np.int64)
    for f in range(n):
        fails = (masks >> f) & 1 == 1
        late = (step[fails] < place[None, :, f]) * count[fails, None]
        redundant[np.arange(len(place)), place[:, f] - 1] = late.sum(0)
    unique = np.array([count[masks == 1 << f].sum() for f in range(n)], np.int64)
    shapley = np.array([removed[np.arange(len(place)), place[:, f] - 1].sum() for f in range(n)], np.int64)
    return {"kept": count.sum() - np.cumsum(removed, 1), "removed": removed, "redundant": redundant, "unique_fails": unique[filters],
            "shapley": shapley[filters]} | {f"lost{k}": lost[:, 1:n + 1, k] for k in range(1, weights.shape[1])}


def audit(marked: DataFrame, letters: str, losses: dict[str, str]) -> DataFrame:
    """One row per part, order of the filters and step, from rows (part, mask, loss columns 0 or 1).

    ``losses`` names the columns whose removed sums are reported and the names of those
    reports; null counts as 0.  An empty table has no part and gives no row.
    """
    names = list(losses)
    counted = marked.groupBy("part", "mask").agg(
        F.count("*").alias("n"), *[F.sum(F.coalesce(F.col(f"`{c}`").cast("bigint"), F.lit(0).cast("bigint"))).alias(f"w{k}")
                                   for k, c in enumerate(names)])
    parts = counted.groupBy("part").agg(F.collect_list(F.struct(
        F.col("mask").cast("bigint").alias("mask"), "n", *[f"w{k}" for k in range(len(names))])).alias("rows"))
    columns = ["kept", "removed", "redundant", "unique_fails", *[losses[c] for c in names], "shapley"]

    def run(batches):
        orders, place = positions(len(letters))
        text = ["".join(letters[f] for f in o) for o in orders]
        cells = len(orders) * len(letters)
        order = pa.array([t for t in text for _ in letters])
        step = pa.array(np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(orders)))
        for b in batches:
            for part, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                table = np.array([list(r.values()) for r in rows], np.int64)
                found = tally(table[:, 0], table[:, 1:], orders, place)
                found |= {losses[c]: found[f"lost{k + 1}"] for k, c in enumerate(names)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * cells, pa.string()), order, step, *[pa.array(np.ascontiguousarray(found[c]).ravel()) for c in columns]],
                    names=["part", "filter_order", "step", *columns])

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in columns))


def interactions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """The audit of the five filters over ``docs``, with losses of good (quality 1) and toxic (toxic 1) rows.

    Rows of ``labels`` that share an id count as one label, which is 1 if any of them is;
    a document without a label, or without an id, is neither good nor toxic.
    """
    known = (pick(labels, id="doc_id", quality="quality", toxic="toxic").filter("id is not null").groupBy("id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    marked = document_masks(docs, id_col, text_col, part_col).join(known, "id", "left")
    return audit(marked, LETTERS, {"good": "good_lost", "toxic": "toxic_lost"})


def query(spark, sf_dir):
    """op13: one row per part, filter_order and step."""
    return interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The same rows from the orders' strings: a group's step is the least place of a letter that it fails.
SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT t.part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM t),
g AS (
  SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM m GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS o FROM l p, l q, l r, l s, l u
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
ranked AS (
  SELECT g.*, o, least(CASE WHEN a THEN instr(o, 'A') ELSE 6 END, CASE WHEN b THEN instr(o, 'B') ELSE 6 END,
                       CASE WHEN c THEN instr(o, 'C') ELSE 6 END, CASE WHEN d THEN instr(o, 'D') ELSE 6 END,
                       CASE WHEN e THEN instr(o, 'E') ELSE 6 END) AS r
  FROM g, o),
steps AS (
  SELECT *, substr(o, s, 1) AS letter,
         CASE substr(o, s, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails
  FROM ranked, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
counts AS (
  SELECT part, o, s, letter, sum(CASE WHEN r > s THEN n ELSE 0 END) AS kept, sum(CASE WHEN r = s THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails AND r < s THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails AND a::INT + b::INT + c::INT + d::INT + e::INT = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN r = s THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN r = s THEN toxic ELSE 0 END) AS toxic_lost
  FROM steps GROUP BY ALL)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counts
"""
