"""SimHash near-duplicates, compared bit-sliced.

*Fingerprint*: A-Z is lower-cased, words are maximal runs of bytes other than
ASCII white space, shingles are ``shingle`` consecutive words joined by a space
(repeats included; fewer words form one shingle).  A bit is 1 if it is set in
more than half of the shingles' XXH64 values (seed 42).  Null or empty text has
no shingle and the fingerprint 0, which links like any other.

*Links*: two fingerprints link when they differ in at most ``radius`` bits.  The
64 bits are cut into blocks; a pair within the radius agrees on at least
``blocks - radius`` of them, so every choice of that many blocks is one band and
candidates share a band key.  The number of blocks only decides how many
candidates a key holds, never which links are found.  Fingerprints are compared
once per distinct value.

*Comparison*: the members' bits are stored as planes (one bit vector per bit
position, 64 members to a word).  XORed planes are added into vertical
carry-save counters, and words in which every lane exceeds the radius are
dropped.  Keys with many members are cut into tiles, and every pair of tiles is
one group.  A group returns a spanning forest of its links, not the pairs.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_table, pick, scratch, sent, shuffle_partitions, table, utf8_column
from .components import components

SHINGLE, RADIUS = 4, 4
#: Members of a key that are compared in one group; larger keys are cut into tiles.
TILE = 4096
#: Largest group that goes through the shift kernel.
SMALL = 256
#: The number of blocks grows until a band key holds at most this many values on average.
OCCUPANCY = 256


def fingerprint_bytes(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one lower-cased text, unsigned."""
    words = text.split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(line)]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    n = len(words) - shingle + 1
    for k in range(0, n, 65536):
        m = min(n, k + 65536)
        h = np.array([digest(line[s:e], 42) for s, e in zip(starts[k:m], ends[k + shingle - 1:m + shingle - 1])],
                     dtype=np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp bigint) per row; one pass over the scan, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        low = lower_table()
        for b in batches:
            data, off = utf8_column(b.column(1))
            fps = np.fromiter((fingerprint_bytes(data[off[i]:off[i + 1]].tobytes().translate(low), shingle)
                               for i in range(b.num_rows)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return pick(docs, id=id_col, text=text_col).mapInArrow(run, f"id {kind}, fp bigint")


def block_ranges(blocks: int) -> list[tuple[int, int]]:
    """(first bit, width) of each block; the first blocks take the bits left over."""
    out, at = [], 0
    for i in range(blocks):
        w = 64 // blocks + (i < 64 % blocks)
        out.append((at, w))
        at += w
    return out


def choose_blocks(n: int, radius: int) -> int:
    """Fewest blocks whose band keys hold at most OCCUPANCY of ``n`` values on average."""
    for blocks in range(radius + 1, radius + 5):
        if n <= OCCUPANCY << (64 // blocks * (blocks - radius)):
            return blocks
    return radius + 4


def within(diff, planes: int, valid, radius: int):
    """Lanes of ``valid`` (uint64 words) whose planes differ in at most ``radius`` bits.

    ``diff(b, words)`` gives plane b's XORed bits of the chosen words.  Vertical
    counters of three or more bits are updated by carry-save steps; every eight
    planes, words without a lane in reach are dropped.
    """
    bits = radius.bit_length()
    words = np.flatnonzero(valid)
    live = valid[words]
    count = [np.zeros(len(words), np.uint64) for _ in range(bits)]
    over = np.zeros(len(words), np.uint64)

    def beyond():
        """Lanes whose counter is larger than the radius, from the highest bit down."""
        more, same = over.copy(), ~np.zeros(len(over), np.uint64)
        for k in range(bits - 1, -1, -1):
            if radius >> k & 1:
                same &= count[k]
            else:
                more |= same & count[k]
                same &= ~count[k]
        return more

    for b in range(planes):
        if not len(words):
            break
        carry = diff(b, words)
        for k in range(bits):
            count[k], carry = count[k] ^ carry, count[k] & carry
        over |= carry
        if b % 8 == 7 or b == planes - 1:
            live = live & ~beyond()
            keep = np.flatnonzero(live)
            if len(keep) < len(words):
                words, live, over = words[keep], live[keep], over[keep]
                count = [c[keep] for c in count]
    out = np.zeros(len(valid), np.uint64)
    out[words] = live
    return out


def bit_planes(fp):
    """64 x words array: plane b holds bit b of every fingerprint, 64 fingerprints to a word."""
    n = len(fp)
    padded = np.zeros(-(-n // 64) * 64, np.uint64)
    padded[:n] = fp
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)


def lanes(words, n: int):
    return np.unpackbits(words.view(np.uint8), bitorder="little")[:n].astype(bool)


def shifted_links(fp, group, radius: int):
    """Index pairs (i, j) of links inside groups of a sorted array: lane i against lane i + d."""
    left, right = [], []
    index = np.arange(len(fp))
    d = 1
    while len(fp) > d:
        same = group[d:] == group[:-d]
        if not same.any():
            break
        if d & (d - 1) == 0:  # now and then, drop the groups that have no member left at this distance
            sizes = np.unique(group, return_inverse=True, return_counts=True)
            keep = sizes[2][sizes[1]] > d
            fp, group, index = fp[keep], group[keep], index[keep]
            same = group[d:] == group[:-d]
            planes = np.concatenate([bit_planes(fp), np.zeros((64, 1 + d // 32 + 2), np.uint64)], axis=1)
        n = len(fp) - d
        width = -(-n // 64)
        mask = np.zeros(width * 64, np.uint8)
        mask[:n] = same
        valid = np.packbits(mask, bitorder="little").view(np.uint64)
        at, r = divmod(d, 64)

        def diff(b, w, at=at, r=r):
            row = planes[b]
            other = row[w + at]
            if r:
                other = (other >> np.uint64(r)) | (row[w + at + 1] << np.uint64(64 - r))
            return row[w] ^ other

        hit = np.flatnonzero(lanes(within(diff, 64, valid, radius), n))
        left.append(index[hit])
        right.append(index[hit + d])
        d += 1
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def tile_forest(fp, first: int, radius: int):
    """Spanning forest of a large group: [(i, j)].  ``first`` > 0 compares the first rows
    with the rest only (two tiles); 0 compares all with all."""
    n = len(fp)
    planes = bit_planes(fp)
    words = planes.shape[1]
    lane = np.arange(words * 64)
    queries = first or n
    allowed = (lane >= first) & (lane < n)
    valid = np.packbits(allowed, bitorder="little").view(np.uint64)
    rows = []
    for q0 in range(0, queries, 64):
        q = fp[q0:min(q0 + 64, queries)]
        set_bit = [((q >> np.uint64(b)) & np.uint64(1)).astype(bool) for b in range(64)]
        full = ~np.uint64(0)

        def diff(b, w, set_bit=set_bit):
            return planes[b][w % words] ^ np.where(set_bit[b][w // words], full, np.uint64(0))

        rows.append(within(diff, 64, np.tile(valid, len(q)), radius).reshape(len(q), words))
    hits = np.concatenate(rows) if rows else np.zeros((0, words), np.uint64)
    parent = np.arange(n)

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest, label = [], np.arange(n)
    for i in range(queries):
        j = np.flatnonzero(lanes(hits[i], n))
        for r in np.unique(label[j]).tolist():  # labels only go down, so a few roots stand for many hits
            a, b = find(r), find(i)
            if a != b:
                parent[max(a, b)] = min(a, b)
                forest.append((i, int(j[label[j] == r][0])))
        label[j] = find(i)
        label[i] = find(i)
    return forest


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``, enough to span each component."""
    spark = fps.sparkSession
    values = scratch(fps.select("fp").distinct(), "fps")
    blocks = choose_blocks(values.count(), radius)
    cuts, keys = block_ranges(blocks), []
    for k, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key = F.lit(0).cast("bigint")
        for c in chosen:
            at, w = cuts[c]
            key = F.shiftleft(key, w).bitwiseOR(F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << w) - 1)))
        keys.append(F.struct(F.lit(k).alias("band"), key.alias("key")))
    assert len(keys) == comb(blocks, radius)
    banded = values.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.band", "k.key", "fp")
    heavy = (banded.groupBy("band", "key").count().filter(F.col("count") > tile)
             .select("band", "key", F.ceil(F.col("count") / tile).cast("int").alias("tiles")))
    tiles = F.coalesce("tiles", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    grouped = (banded.join(heavy, ["band", "key"], "left")
               .withColumn("tiles", tiles).withColumn("own", own)
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
               .select("band", "key", F.least("own", "other").alias("ti"), F.greatest("own", "other").alias("tj"),
                       "own", "fp"))
    order = ["band", "key", "ti", "tj", "own", "fp"]
    dealt = grouped.repartition(shuffle_partitions(spark), "band", "key", "ti", "tj").sortWithinPartitions(*order)

    def run(batches):
        def solve(cols):
            """Links of whole groups; cols are sorted arrays."""
            band, key, ti, tj, own, fp = cols
            new = np.ones(len(fp), bool)
            new[1:] = (band[1:] != band[:-1]) | (key[1:] != key[:-1]) | (ti[1:] != ti[:-1]) | (tj[1:] != tj[:-1])
            group = np.cumsum(new)
            size = np.bincount(group)[group]
            small = (size > 1) & (size <= SMALL) & (ti == tj)
            fp = fp.view(np.uint64)
            i, j = shifted_links(fp[small], group[small], radius)
            a, b = [fp[small][i]], [fp[small][j]]
            for g in np.unique(group[(size > 1) & ~small]).tolist():
                lo, hi = np.searchsorted(group, [g, g + 1])
                first = 0 if ti[lo] == tj[lo] else int(np.searchsorted(own[lo:hi], tj[lo]))
                if ti[lo] != tj[lo] and first in (0, hi - lo):
                    continue
                found = np.array(tile_forest(fp[lo:hi], first, radius), np.int64).reshape(-1, 2)
                a.append(fp[lo:hi][found[:, 0]])
                b.append(fp[lo:hi][found[:, 1]])
            a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            last = np.ones(len(cols[0]), bool)
            for c in cols[:4]:
                last &= c == c[-1]
            cut = int(np.argmax(last))
            held = [c[cut:] for c in cols]
            if cut:
                yield solve([c[:cut] for c in cols])
        if held is not None and len(held[0]):
            yield solve(held)

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per input row: id, fp (bigint) and component (least id reachable by links).

    Null ids keep their row and share their group's component; a group without
    any id has a null component.  An empty table gives an empty result.
    """
    fps = scratch(fingerprints(docs, id_col, text_col, shingle), "simhash")
    roots = components(links(fps, radius))
    values = fps.groupBy("fp").agg(F.min("id").alias("least"))
    named = scratch(values.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                    .withColumn("root", F.coalesce("root", "fp")), "roots")
    # written first, so that the joins below have nothing but a shuffle under them and hot keys can be split
    least = scratch(named.groupBy("root").agg(F.min("least").alias("component")), "components")
    named = scratch(named.join(least, "root").select("fp", "component"), "named")
    return fps.join(named, "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows whose id is their component's least id; all columns of ``docs``.

    Rows that repeat one id are one document, so all rows of a kept id stay.
    Rows without an id stay: nothing names what they would be a copy of.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    gone = sent(scratch(found.filter(F.col("id") != F.col("component")).select(F.col("id").alias("_gone")).distinct(), "gone"))
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")


def query(spark, sf_dir):
    """op6: doc_id, fingerprint (16 hex digits), component_id."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
