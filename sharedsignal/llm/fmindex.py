"""Benchmark decontamination with one FM-index per training shard.

A-Z is lower-cased; words are maximal runs of digits, a-z and bytes from 0x80.
A test phrase (window) is ``width`` consecutive words of a benchmark item; an item
of fewer words, but not none, is one window.  A document word inside any
occurrence of a window is hit, and runs of hit words are removal spans.

Each task cuts its rows into shards of bounded size.  The shard's words become
integers by the benchmark's vocabulary; other words cannot be part of an
occurrence, so runs between them that are as long as the shortest window are kept
and the rest is one separator each.  Over the kept words the task builds a suffix
array, the Burrows-Wheeler transform as a wavelet matrix with word-wise ranks, and
samples of suffix positions.  All windows are searched backwards at once, and
their occurrences are located by walking to the nearest sample.

The benchmark is the stated query set: it is sent to the tasks in blocks of at
most BLOCK_BYTES of text, whatever its size.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_word_table, pick, pieces, table, utf8_column

WIDTH = 10
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 32 << 20
SAMPLE = 16


# --- the index ---------------------------------------------------------------

def suffix_array(symbols):
    """Suffix order of an integer array by prefix doubling; a suffix's end sorts first."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        second = np.zeros(n, np.int64)
        if k < n:
            second[:n - k] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.ones(n, np.int64)
        new[0] = 0
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        k *= 2


class Bits:
    """Bit vector with rank: words of 64 bits and the ones before each word."""

    def __init__(self, bits):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, i):
        """Ones among the first i bits."""
        w, r = i >> 6, (i & 63).astype(np.uint64)
        return self.before[w] + np.bitwise_count(self.words[w] & ((np.uint64(1) << r) - np.uint64(1)))

    def get(self, i):
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    def __init__(self, symbols):
        top = int(symbols.max(initial=0))
        self.levels = []
        for b in range(max(1, top.bit_length()) - 1, -1, -1):
            bit = symbols >> b & 1
            self.levels.append((b, Bits(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, c, i):
        """Occurrences of symbol c among the first i symbols; c and i are arrays."""
        start = np.zeros_like(i)
        for b, bits, zeros in self.levels:
            one = (c >> b & 1).astype(bool)
            rs, ri = bits.rank(start), bits.rank(i)
            start = np.where(one, zeros + rs, start - rs)
            i = np.where(one, zeros + ri, i - ri)
        return i - start

    def at(self, i):
        """Symbols at positions i and their ranks there."""
        c, start = np.zeros_like(i), np.zeros_like(i)
        for b, bits, zeros in self.levels:
            one = bits.get(i)
            c |= one.astype(np.int64) << b
            rs, ri = bits.rank(start), bits.rank(i)
            start = np.where(one, zeros + rs, start - rs)
            i = np.where(one, zeros + ri, i - ri)
        return c, i - start


class FMIndex:
    """Index of an array of words (1 and up); 0 separates runs and stands at both ends.

    Every separator sorts as a symbol of its own, so no comparison crosses one.
    """

    def __init__(self, words):
        sep = words == 0
        ordered = np.where(sep, np.cumsum(sep), words + sep.sum() + 1)
        sa = suffix_array(ordered)
        self.bwt = WaveletMatrix(words[sa - 1])
        counts = np.bincount(words, minlength=int(words.max(initial=0)) + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        # a walk to the left must not cross a separator, so the first word of each run is sampled too
        after = np.zeros(len(words), bool)
        after[1:] = sep[:-1]
        chosen = ((np.arange(len(words)) % SAMPLE == 0) | after | sep)[sa]
        self.sampled = Bits(chosen)
        self.samples = sa[chosen]
        self.size = len(words)

    def search(self, windows):
        """Suffix ranges [lo, hi) of equally long windows (rows) by backward search."""
        lo = np.zeros(len(windows), np.int64)
        hi = np.full(len(windows), self.size, np.int64)
        alive = np.arange(len(windows))
        for j in range(windows.shape[1] - 1, -1, -1):
            c = windows[alive, j]
            known = c < len(self.first) - 1
            lo[alive[~known]] = hi[alive[~known]] = 0
            alive, c = alive[known], c[known]
            lo[alive] = self.first[c] + self.bwt.rank(c, lo[alive])
            hi[alive] = self.first[c] + self.bwt.rank(c, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
        hit = lo < hi
        hit[np.setdiff1d(np.arange(len(windows)), alive)] = False
        return lo, np.where(hit, hi, lo)

    def locate(self, rows):
        """Positions of suffixes by their rows: walk left until a sampled row."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        left = np.arange(len(rows))
        while len(left):
            done = self.sampled.get(at[left])
            d = left[done]
            out[d] = self.samples[self.sampled.rank(at[d])] + steps[d]
            left = left[~done]
            c, rank = self.bwt.at(at[left])
            at[left] = self.first[c] + rank
            steps[left] += 1
        return out


# --- the query set -----------------------------------------------------------

def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> list:
    """The benchmark as broadcast blocks [(item id as string, text bytes)] of bounded size."""
    spark = benchmark.sparkSession
    items = pick(benchmark, id=id_col, text=text_col).filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    out = []
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else items
        rows = [(str(r["id"]) if r["id"] is not None else "null", r["text"].encode()) for r in part.toLocalIterator()]
        out.append(spark.sparkContext.broadcast(sorted(rows)))
    return out


def windows_of(items, width: int, words):
    """Vocabulary {word: 1..}, window arrays by length, and the items of each window."""
    vocabulary, found = {}, {}
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in text.translate(words).split()]
        for k in range(max(1, len(ids) - width + 1) if ids else 0):
            found.setdefault(tuple(ids[k:k + width]), set()).add(item)
    by_length = {}
    for w, names in found.items():
        by_length.setdefault(len(w), []).append((w, names))
    return vocabulary, {n: (np.array([w for w, _ in x], np.int64), [i for _, i in x]) for n, x in by_length.items()}


def shard_hits(ids, by_length):
    """Over a shard's word ids (0 unknown, -1 between rows): hit mask and [(word position, items)]."""
    mark = np.zeros(len(ids) + 1, np.int64)
    found = []
    shortest = min(by_length)
    known = np.concatenate([[0], (ids > 0).astype(np.int8), [0]])
    edge = np.flatnonzero(np.diff(known))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= shortest
    begin, end = begin[long], end[long]
    if not len(begin):
        return mark[:-1].astype(bool), found
    # kept runs, each followed by one separator; position -> word of the shard
    length = end - begin + 1
    source = np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
    kept = ids[np.minimum(source, len(ids) - 1)]
    kept[np.cumsum(length) - 1] = 0
    kept, source = np.concatenate([[0], kept]).astype(np.int64), np.concatenate([[-1], source])
    index = FMIndex(kept)
    for n, (windows, items) in by_length.items():
        lo, hi = index.search(windows)
        count = hi - lo
        which = np.repeat(np.arange(len(windows)), count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + lo[which]
        at = source[index.locate(rows)]
        np.add.at(mark, at, 1)
        np.add.at(mark, at + n, -1)
        found += zip(at.tolist(), (items[w] for w in which.tolist()))
    return np.cumsum(mark)[:-1] > 0, found


def word_spans(text: bytes, words) -> tuple:
    """First and last byte (exclusive) of each word of a text."""
    inside = np.frombuffer(text.translate(words), np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def runs(mask):
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


# --- the operator --------------------------------------------------------------

REPORT = "n_words bigint, spans array<struct<first:bigint,last:bigint>>, items array<string>, clean_text string"


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH,
         shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` and ``_report``: n_words, spans (word positions, last exclusive),
    items (sorted ids of benchmark items that occur) and clean_text (null where nothing is hit;
    else the text without the bytes from each span's first to its last word).

    One row per input row, repeated ids included.  Null text has no words; null or
    wordless items have no window; an empty benchmark hits nothing.  A benchmark
    row with a null id counts under the id "null".
    """
    blocks = item_blocks(benchmark, item_id_col, item_text_col, block_bytes)
    where = docs.columns.index(text_col)
    schema = T.StructType(docs.schema.fields + [T.StructField("_report", T.StructType.fromDDL(REPORT))])

    def run(batches):
        words = ascii_word_table()
        sets = [windows_of(b.value, width, words) for b in blocks] if len(blocks) == 1 else None

        def shard(texts):
            """[(n_words, spans, items, clean text)] of a shard's rows."""
            low = [t.translate(words) for t in texts]
            split = b" \x00 ".join(low).split()
            hit, found, starts = np.zeros(len(split), bool), [], None
            for b in range(len(blocks)):
                vocabulary, by_length = sets[b] if sets else windows_of(blocks[b].value, width, words)
                vocabulary = {**vocabulary, b"\x00": -1}
                ids = np.fromiter(map(vocabulary.get, split, repeat(0)), np.int64, len(split))
                starts = np.concatenate([[0], np.flatnonzero(ids == -1) + 1])
                if by_length:
                    mask, more = shard_hits(ids, by_length)
                    hit |= mask
                    found += more
            ends = np.concatenate([starts[1:] - 1, [len(split)]])
            row_of = np.searchsorted(starts, [p for p, _ in found], side="right") - 1
            items = {}
            for r, (_, names) in zip(row_of.tolist(), found):
                items.setdefault(r, set()).update(names)
            for r, (lo, hi) in enumerate(zip(starts.tolist(), ends.tolist())):
                spans, clean = [], None
                if r in items:
                    spans = runs(hit[lo:hi])
                    first, last = word_spans(texts[r], words)
                    kept, at = [], 0
                    for a, z in spans:
                        kept.append(texts[r][at:first[a]])
                        at = last[z - 1]
                    clean = b"".join([*kept, texts[r][at:]]).decode()
                yield {"n_words": hi - lo, "spans": [{"first": a, "last": z} for a, z in spans],
                       "items": sorted(items.get(r, ())), "clean_text": clean}

        kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                          ("items", pa.list_(pa.string())), ("clean_text", pa.string())])
        for batch in batches:
            data, off = utf8_column(batch.column(where))
            out = []
            for i, j in pieces(off, shard_bytes):
                raw = data[off[i]:off[j]].tobytes()
                cut = (off[i:j + 1] - off[i]).tolist()
                out += shard([raw[a:z] for a, z in zip(cut, cut[1:])])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, "_report"])

    return docs.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every removal span cut out of the text; the columns stay the same.

    ``n_chars``, where it exists, follows the text.
    """
    found = scan(docs, benchmark, id_col, text_col, **options)
    text = F.coalesce(F.col("_report.clean_text"), F.col(f"`{text_col}`"))
    new = {text_col: text} | ({"n_chars": F.when(F.col("_report.clean_text").isNull(), F.col("n_chars"))
                               .otherwise(F.char_length(text))} if "n_chars" in docs.columns else {})
    return found.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def query(spark, sf_dir):
    """op7: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    hit = F.coalesce(F.aggregate("_report.spans", F.lit(0).cast("bigint"),
                                 lambda n, s: n + s["last"] - s["first"]), F.lit(0).cast("bigint"))
    return (scan(docs, table(spark, sf_dir, "benchmark"))
            .select("doc_id", F.col("_report.n_words").alias("n_words"), hit.alias("n_hit"),
                    F.size("_report.items").cast("bigint").alias("n_items"),
                    F.sha2(F.concat_ws(",", "_report.items"), 256).alias("items_sha256"))
            .withColumn("contaminated", F.col("n_hit") > 0))


#: The same rows by joins: every document position against every window of the same length.
SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k:k + 9], ' ') AS s
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS k FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, p.n, k, item FROM places p JOIN windows x ON p.n = x.n AND p.s = x.s),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS p FROM (SELECT DISTINCT doc_id, n, k FROM hits)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
