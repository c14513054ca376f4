"""Exact substring de-duplication by hash-compared suffix sorting.

Texts are UTF-8 bytes, or sequences of words (``unit="word"``: 64-bit hashes of the
strings between ASCII white space).  Every unit covered by a string of ``span`` units (a
window) that also starts anywhere else in the table is removed; windows are judged on
the input and never cross a document.  Below, "bytes" holds for words too.

1. *Anchors.*  In each window the ``GRAM``-byte string of the least hash (the last
   of equals) is its anchor, so equal windows have equal anchors at equal places.
   Neighbouring windows mostly share theirs: one row per run of windows, with the
   anchor's hash and a second 64-bit digest of the run's bytes (its context).
2. *Classes.*  Contexts that occur twice or more have only repeated windows.  Where
   an anchor has several different contexts, one of each class goes on.
3. *Suffix sort.*  The contexts of an anchor meet in one task; where they are more than
   ``most``, its windows are dealt by a second key first (4).  Prefix polynomial
   hashes give every window's hash; runs of windows whose hash is not unique are
   sorted as suffixes by a mergesort whose comparisons find the common extension by
   binary search over prefix hashes.  Sorted neighbours with a common extension of
   ``span`` or more are repeated, after their bytes are compared.  Windows that no
   longer match covers start a new round.
4. *Second keys.*  Equal windows have their anchor at an equal place, so windows are cut
   into ranges of places.  All windows of a range share its core (what the first and the
   last of them both cover), and equal windows equal cores: (anchor, range, digest of the
   core) is the next key.  Contexts that are equal after the cut count once again (2).
   Ranges are a quarter of the places, then a ninth of that, then one place; there the core
   is the window itself, so nothing is left to sort, and 128-bit digests of the windows are
   counted.

Only rows of repeated anchors carry text, and identical contexts count once, so a
passage in a third of all documents is a few contexts with a large count.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE_BYTES, SEND, pieces, scratch, shuffle_partitions, table, unused, utf8_column

SPAN, GRAM = 400, 80
#: Bytes whose windows are hashed at once; longer texts are cut into overlapping segments.
SEGMENT = 1 << 19
#: The same for words.
WORD_SPAN, WORD_GRAM = 50, 10
#: Bits of a place: the number of windows of a run (at most SPAN - GRAM + 1), and the anchor's distance from the first.
PLACE = 16
#: Contexts that are sorted together under one key.
MOST = 128
#: Windows that a task sorts at once, over several anchors.
WINDOWS = 200_000
BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64


# --- polynomial hashes modulo 2**64 ---------------------------------------------

def powers(base: int, n: int):
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class PrefixHash:
    """Hashes of any substring from prefix sums of (byte + 1) * BASE**i."""

    def __init__(self, data):
        n = len(data)
        self.data = data
        self.power = powers(BASE, n)
        self.inverse = powers(pow(BASE, -1, 1 << 64), n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=self.sums[1:])

    def all(self, n: int):
        """Hash of the n bytes from each position on."""
        m = max(0, len(self.data) - n + 1)
        return (self.sums[n:n + m] - self.sums[:m]) * self.inverse[:m]

    def at(self, x, n):
        return (self.sums[x + n] - self.sums[x]) * self.inverse[x]

    def extension(self, x, y, most):
        """Common extension of the suffixes at x and y, at most ``most`` bytes, by binary search."""
        size = np.zeros(len(x), np.int64)
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            fits = np.flatnonzero(size + step <= most)
            u, v = x[fits] + size[fits], y[fits] + size[fits]
            # equal hashes without the inverse: multiply each side by the other's power
            same = (self.sums[u + step] - self.sums[u]) * self.power[v] == (self.sums[v + step] - self.sums[v]) * self.power[u]
            size[fits[same]] += step
            step >>= 1
        return size


def mixed(h):
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


# --- 1. anchors -------------------------------------------------------------------

def anchors_of(data, starts, ends, span: int, gram: int):
    """Runs of windows of the texts data[starts:ends]: (text, anchor, first window, last window, anchor hash)."""
    n = len(data)
    none = (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    if n < span:
        return none
    grams = mixed(PrefixHash(data).all(gram))
    bits = np.uint64(24)
    low = (np.uint64(1) << bits) - np.uint64(1)
    assert n <= int(low)
    key = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    width, reach = span - gram + 1, 1
    while 2 * reach <= width:
        key = np.minimum(key[:-reach], key[reach:])
        reach *= 2
    if reach < width:
        key = np.minimum(key[:len(key) - (width - reach)], key[width - reach:])
    anchor = (low - (key & low)).astype(np.int64)
    change = np.zeros(n + 1, np.int64)
    long = ends - starts >= span
    np.add.at(change, starts[long], 1)
    np.add.at(change, ends[long] - span + 1, -1)
    valid = np.cumsum(change)[:len(anchor)] > 0
    same = np.zeros(len(anchor), bool)
    same[1:] = (anchor[1:] == anchor[:-1]) & valid[:-1]
    first = np.flatnonzero(valid & ~same)
    stop = np.flatnonzero(valid & ~np.append(same[1:] & valid[1:], False))
    text = np.searchsorted(starts, first, side="right") - 1
    return text, anchor[first], first, stop, grams[anchor[first]]


def segments(data, off, span: int, most: int):
    """(first row, starts, ends, offset in the row, bytes) of bounded size; long rows in overlapping parts."""
    for i, j in pieces(off, most):
        lo = int(off[i])
        if off[j] - off[i] <= most + span:
            yield i, off[i:j] - lo, off[i + 1:j + 1] - lo, 0, data[lo:int(off[j])]
            continue
        size = int(off[j]) - lo
        for s in range(0, max(1, size - span + 1), most):
            part = data[lo + s:lo + min(size, s + most + span - 1)]
            yield i, np.zeros(1, np.int64), np.array([len(part)]), s, part


def word_symbols(data, off, most: int = PIECE_BYTES):
    """(hashes, offsets in words, first bytes, ends) of the words of texts data[off[k]:off[k + 1]]."""
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    inside = ~space[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]  # words end with their text
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(starts), np.uint64)
    cuts = np.unique(np.concatenate([np.searchsorted(starts, np.arange(0, len(data), most)), [len(starts)]]))
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        lo, size = int(starts[a]), ends[a:z] - starts[a:z]
        hashes = PrefixHash(data[lo:int(ends[z - 1])])
        out[a:z] = mixed(hashes.at(starts[a:z] - lo, size) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return out, np.searchsorted(starts, off), starts, ends


def units(data, off, unit: str):
    """Symbols and offsets that windows are made of."""
    return word_symbols(data, off)[:2] if unit == "word" else (data, off)


def anchor_rows(docs: DataFrame, span: int, gram: int, unit: str = "byte") -> DataFrame:
    """Rows (id, h, g, d, place) from docs (id, h, text); place packs the first window, the anchor's distance and their number."""
    kind = docs.schema["id"].dataType.simpleString()
    names = ["id", "h", "g", "d", "place"]

    def run(batches):
        for b in batches:
            data, off = utf8_column(b.column(2))
            # words need several arrays of their text's size, so they are made of few texts at a time
            for lo, hi in pieces(off) if unit == "word" else [(0, len(off) - 1)]:
                symbols, cut = units(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], unit)
                width = symbols.itemsize
                for i, starts, ends, base, part in segments(symbols, cut, span, SEGMENT // width):
                    text, a, p1, p2, g = anchors_of(part, starts, ends, span, gram)
                    if not len(a):
                        continue
                    raw = part.tobytes()
                    digest = xxhash.xxh3_64_intdigest
                    # the anchor's place in the context is part of what is digested
                    d = np.array([digest(raw[x * width:(z + span) * width], y - x) for x, z, y in zip(p1.tolist(), p2.tolist(), a.tolist())], np.uint64)
                    rows = pa.array(lo + i + text)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(rows), b.column(1).take(rows), pa.array(g.view(np.int64)), pa.array(d.view(np.int64)),
                         pa.array((p1 + base - starts[text] << 2 * PLACE) | (a - p1 << PLACE) | (p2 - p1 + 1))], names=names)

    return docs.mapInArrow(run, f"id {kind}, h bigint, g bigint, d bigint, place bigint")


# --- 3. suffix sort -----------------------------------------------------------------

def merge_sort(hashes: PrefixHash, x, end):
    """Order of the suffixes at x (each up to its ``end``), by merging sorted runs.

    Every element's place in the sibling run comes from a binary search, all elements
    of a level at once; suffixes compare by their common extension and the next byte.
    """
    n = len(x)
    order = np.arange(n)

    def less(i, j):
        most = np.minimum(end[i] - x[i], end[j] - x[j])
        size = hashes.extension(x[i], x[j], most)
        u, v = x[i] + size, x[j] + size
        done = size == most
        data = hashes.data
        a = np.where(done, 0, data[np.minimum(u, len(data) - 1)])
        b = np.where(done, 0, data[np.minimum(v, len(data) - 1)])
        ends = (end[i] - x[i] < end[j] - x[j]) | ((end[i] - x[i] == end[j] - x[j]) & (i < j))
        return np.where(done, ends, a < b)

    run = 1
    while run < n:
        place = np.arange(n)
        mine = place // run
        sibling = mine ^ 1
        lo = np.minimum(sibling * run, n)
        hi = np.minimum(lo + run, n)
        start, left = lo.copy(), np.flatnonzero(lo < hi)
        while len(left):
            mid = (lo[left] + hi[left]) >> 1
            below = less(order[mid], order[left])
            lo[left[below]] = mid[below] + 1
            hi[left[~below]] = mid[~below]
            left = left[lo[left] < hi[left]]
        pair = (place // (2 * run)) * 2 * run
        target = pair + (place - mine * run) + (lo - start)
        merged = np.empty(n, np.int64)
        merged[target] = order
        order = merged
        run *= 2
    return order


def equal_bytes(data, x, y, n):
    """Whether data[x:x+n] and data[y:y+n] are equal, row by row."""
    out = np.ones(len(x), bool)
    for k in range(0, len(x), 4096):
        s = slice(k, k + 4096)
        width = np.arange(int(n[s].max(initial=0)))
        inside = width < n[s][:, None]
        top = len(data) - 1
        same = data[np.minimum(x[s][:, None] + width, top)] == data[np.minimum(y[s][:, None] + width, top)]
        out[s] = (same | ~inside).all(1)
    return out


def repeated_windows(data, start, count, judged, span: int):
    """Mask over all windows of the contexts: which occur in another context too.

    Context c has the windows start[c] ... start[c] + count[c] - 1 of ``data`` and ends
    span - 1 bytes after the last; only contexts with ``judged`` are asked about.
    """
    hashes = PrefixHash(data)
    owner = np.repeat(np.arange(len(start)), count)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + start[owner]
    h = hashes.at(at, span)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    shared = np.zeros(len(h), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    partner = np.empty(len(h), np.int64)
    partner[order[:-1]] = order[1:]
    partner[order[1:][same]] = order[:-1][same]
    end = start[owner] + count[owner] + span - 1
    open_ = shared & judged[owner]
    found = np.zeros(len(h), bool)
    while open_.any():
        head = open_.copy()
        head[1:] &= ~(open_[:-1] & (owner[1:] == owner[:-1]))
        heads = np.flatnonzero(head)
        chosen = np.union1d(heads, partner[heads])
        x, e = at[chosen], end[chosen]
        rank = merge_sort(hashes, x, e)
        sx, se = x[rank], e[rank]
        near = hashes.extension(sx[:-1], sx[1:], np.minimum(se[:-1] - sx[:-1], se[1:] - sx[1:]))
        near[~equal_bytes(data, sx[:-1], sx[1:], np.where(near >= span, near, 0))] = 0
        best = np.maximum(np.concatenate([[0], near]), np.concatenate([near, [0]]))
        reach = np.empty(len(chosen), np.int64)
        reach[rank] = best
        reach = reach[np.searchsorted(chosen, heads)]
        covered = np.zeros(len(h) + 1, np.int64)
        hit = reach >= span
        np.add.at(covered, heads[hit], 1)
        np.add.at(covered, heads[hit] + reach[hit] - span + 1, -1)
        covered = np.cumsum(covered)[:-1] > 0
        found |= covered
        open_ &= ~covered
        open_[heads] = False
    return found


def judge(contexts: DataFrame, span: int, unit: str = "byte") -> DataFrame:
    """Intervals (id, h, first, last) of repeated windows of single contexts.

    ``contexts``: (g, n, id, h, p1, ctx), all of one ``g`` in one task and together.
    """
    kind = contexts.schema["id"].dataType.simpleString()
    size = 8 if unit == "word" else 1
    dealt = contexts.repartition(shuffle_partitions(contexts.sparkSession), "g").sortWithinPartitions("g")

    def solve(t):
        data, off = utf8_column(t.column("ctx"))
        if unit == "word":
            data, off = data.view(np.uint64), off // 8
        count = np.diff(off) - span + 1
        single = t.column("n").to_numpy(zero_copy_only=False) == 1
        found = repeated_windows(data, off[:-1], count, single, span)
        upto = np.concatenate([[0], np.cumsum(count)])
        owner = np.repeat(np.arange(len(count)), count)
        new = found.copy()
        new[1:] &= ~(found[:-1] & (owner[1:] == owner[:-1]))
        stop = found.copy()
        stop[:-1] &= ~(found[1:] & (owner[1:] == owner[:-1]))
        a, z = np.flatnonzero(new), np.flatnonzero(stop)
        c = owner[a]
        p1 = t.column("p1").to_numpy(zero_copy_only=False)[c]
        rows = pa.array(c)
        return pa.RecordBatch.from_arrays(
            [t.column("id").combine_chunks().take(rows), t.column("h").combine_chunks().take(rows),
             pa.array(p1 + a - upto[c]), pa.array(p1 + z - upto[c] + span)], names=["id", "h", "first", "last"])

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            g = held.column("g").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1])
            windows = pc.binary_length(held.column("ctx")).to_numpy().astype(np.int64) // size - span + 1
            upto = np.concatenate([[0], np.cumsum(windows)])
            at = 0
            for k in cuts[1:].tolist():  # whole anchors, several at a time
                if upto[k] - upto[at] >= WINDOWS:
                    yield solve(held.slice(at, k - at))
                    at = k
            last = int(cuts[-1])
            if last > at:
                yield solve(held.slice(at, last - at))
            held = held.slice(last)
        if held is not None and held.num_rows:
            yield solve(held)

    return dealt.mapInArrow(run, f"id {kind}, h bigint, first bigint, last bigint")


def judge_by_counts(windows: DataFrame, span: int) -> DataFrame:
    """The same intervals where every context is one window: counted by digest, twice or more is repeated."""
    keyed = windows.select("g", "n", "id", "h", "p1", F.xxhash64("ctx").alias("d1"), F.xxhash64(F.lit(1), "ctx").alias("d2"))
    twice = keyed.groupBy("g", "d1", "d2").agg(F.sum("n").alias("c")).filter("c > 1").drop("c")
    return (keyed.filter("n = 1").join(twice, ["g", "d1", "d2"])
            .select("id", "h", F.col("p1").alias("first"), (F.col("p1") + span).alias("last")))


CONTEXT = "g bigint, n bigint, id {kind}, h bigint, p1 bigint, off bigint, ctx binary"


def split_contexts(contexts: DataFrame, span: int, gram: int, width: int, unit: str) -> DataFrame:
    """Contexts (g, n, id, h, p1, off, ctx) cut into ranges of ``width`` places of the anchor, under second keys.

    ``off`` is the anchor's distance from the first window.  The new key is a digest of
    the old one, the range and the range's core; sorting compares bytes, so unlike
    contexts that meet under one key do no harm.
    """
    kind = contexts.schema["id"].dataType.simpleString()
    names = ["g", "n", "id", "h", "p1", "off", "ctx"]
    size = 8 if unit == "word" else 1
    digest = xxhash.xxh3_64_intdigest

    def run(batches):
        for b in batches:
            g, p1, off = (b.column(k).to_numpy() for k in (0, 4, 5))
            out = []
            for r in range(b.num_rows):
                raw = b.column(6)[r].as_py()
                last = len(raw) // size - span  # windows 0 ... last; the anchor is off[r] - x places into window x
                key, anchor = int(g[r]) & ((1 << 64) - 1), int(off[r])
                for j in range((anchor - last) // width, anchor // width + 1):
                    lo, hi = max(0, anchor - (j + 1) * width + 1), min(last, anchor - j * width)
                    core = raw[(anchor - j * width) * size:(anchor - (j + 1) * width + 1 + span) * size]
                    out.append((r, digest(core, key ^ (j + 1)), p1[r] + lo, anchor - lo, raw[lo * size:(hi + span) * size]))
                    if len(out) >= 4096:
                        yield rows(b, out)
                        out = []
            if out:
                yield rows(b, out)

    def rows(b, out):
        r, g, p1, off, ctx = zip(*out)
        at = pa.array(r)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(g, np.uint64).view(np.int64)), *(b.column(k).take(at) for k in (1, 2, 3)), pa.array(np.array(p1, np.int64)),
             pa.array(np.array(off, np.int64)), pa.array(ctx, pa.binary())], names=names)

    return contexts.mapInArrow(run, CONTEXT.format(kind=kind))


def merge_equal(cut: DataFrame, unit: str) -> tuple[DataFrame, DataFrame]:
    """(contexts, intervals): equal contexts of a key become one with their summed n, as in step 2.

    Near copies differ in few ranges, so most of what was cut is equal.  All windows of
    equal contexts are repeated: (id, h, first, last) of those that stood for one place.
    """
    size = 8 if unit == "word" else 1
    keys = ["g", "off", "d1", "d2"]
    keyed = cut.withColumns({"d1": F.xxhash64("ctx"), "d2": F.xxhash64(F.lit(1), "ctx")})
    classes = scratch(keyed.groupBy(*keys).agg(F.sum("n").alias("n"), F.min(F.struct("h", "p1", "id")).alias("one"), F.first("ctx").alias("ctx")),
                      "second-classes")
    sure = (keyed.filter("n = 1").select(*keys, "id", "h", "p1", (F.col("p1") + F.expr(f"octet_length(ctx) div {size}")).alias("last"))
            .join(classes.filter("n > 1").select(*keys), keys, "left_semi")
            .select("id", "h", F.col("p1").alias("first"), "last"))
    return classes.select("g", "n", "one.id", "one.h", "one.p1", "off", "ctx"), sure


def judge_all(contexts: DataFrame, several: DataFrame, span: int, gram: int, most: int, unit: str) -> DataFrame:
    """Intervals (id, h, first, last) of repeated windows of single contexts (g, n, id, h, p1, off, ctx, contexts).

    ``several``: the keys g with their number of contexts, written.
    """
    found, places = [], span - gram + 1
    widths = [w for w in (-(-places // 4), -(-places // 36)) if 1 < w < places]
    for width in [*dict.fromkeys(widths), 1]:
        found.append(judge(contexts.filter(F.col("contexts") <= most).drop("contexts", "off"), span, unit))
        if several.filter(F.col("contexts") > most).isEmpty():
            break
        hot = contexts.filter(F.col("contexts") > most).drop("contexts")
        cut = scratch(split_contexts(hot, span, gram, width, unit), "second-keys")
        if width == 1:
            found.append(judge_by_counts(cut, span))
            break
        cut, sure = merge_equal(cut, unit)
        found.append(sure)
        # a key with one context shares no window
        several = scratch(cut.groupBy("g").agg(F.count("*").alias("contexts")).filter("contexts > 1"), "several")
        contexts = scratch(cut.join(several, "g").select(*cut.columns, "contexts"), "dealt-again")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


# --- the operator --------------------------------------------------------------------

def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, text): rows that agree in id and text share a key, which stands for all of them."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("h"), text.alias("text"))


def on_key(a: DataFrame, b: DataFrame):
    return a["id"].eqNullSafe(b["id"]) & (a["h"] == b["h"])


def only(df: DataFrame, keys: DataFrame, key: str, or_all: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``: without a shuffle while the keys are few.

    With ``or_all`` a later join drops the others anyway, so beyond SEND keys nothing is done.
    """
    if keys.count() <= SEND:
        return df.join(F.broadcast(keys.select(key).distinct()), key, "left_semi")
    return df if or_all else df.join(keys, key, "left_semi")


def asked_contexts(touched: DataFrame, unit: str) -> DataFrame:
    """(g, n, id, h, p1, off, ctx, contexts) of the asked runs (g, n, contexts, p1, p2, off) of each text."""
    open_ = touched.filter(F.size("asked") > 0)
    if unit == "byte":
        cut = F.expr("transform(asked, r -> struct(r.g, r.n, r.contexts, r.p1, r.off, "
                     "substring(raw, cast(r.p1 + 1 as int), cast(r.p2 - r.p1 as int)) as ctx))")
        return (open_.select("id", "h", F.explode(cut).alias("r"))
                .select("r.g", "r.n", "id", "h", "r.p1", "r.off", "r.ctx", "r.contexts"))
    kind = touched.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            data, off = utf8_column(b.column(2))
            for i, j in pieces(off):
                symbols, cut = units(data[off[i]:off[j]], off[i:j + 1] - off[i], unit)
                runs = [(r, x) for r in range(i, j) for x in b.column(3)[r].as_py()]
                at = pa.array([r for r, _ in runs], pa.int64())
                raw = [symbols[cut[r - i] + x["p1"]:cut[r - i] + x["p2"]].tobytes() for r, x in runs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[c] for _, x in runs], pa.int64()) for c in ("g", "n")] + [b.column(0).take(at), b.column(1).take(at)]
                    + [pa.array([x[c] for _, x in runs], pa.int64()) for c in ("p1", "off")] + [pa.array(raw, pa.binary())]
                    + [pa.array([x["contexts"] for _, x in runs], pa.int64())], names=["g", "n", "id", "h", "p1", "off", "ctx", "contexts"])

    return open_.select("id", "h", "raw", "asked").mapInArrow(run, CONTEXT.format(kind=kind) + ", contexts bigint")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, gram: int = GRAM,
             most: int = MOST, unit: str = "byte") -> DataFrame:
    """One row per (id, h) with something to remove: n_removed, n_spans, kept_sha256, and clean: the
    remaining bytes as text, without characters that lost some of theirs.

    h is ``xxhash64(id, text)`` with null text as empty.  Rows that repeat an id and
    its text are copies of each other like any other two rows.  Texts shorter than
    ``span`` units keep everything; an empty table gives an empty result.  Removed words
    go with the white space after them.
    """
    source = keyed(docs, id_col, text_col)
    least = 2 * span - 1 if unit == "word" else span  # bytes that so many words need
    rows = scratch(anchor_rows(source.filter(F.octet_length("text") >= least), span, gram, unit), "anchors")
    twice = scratch(rows.groupBy("g").count().filter("count > 1").select("g"), "twice")
    ones = F.lit((1 << PLACE) - 1)
    first = F.shiftright("place", 2 * PLACE)
    rows = scratch(only(rows, twice, "g").select(
        "id", "h", "g", "d", first.alias("p1"), (first + F.col("place").bitwiseAND(ones) + (span - 1)).alias("p2"),
        F.shiftright("place", PLACE).bitwiseAND(ones).alias("off")), "repeated-anchors")
    place = F.struct("h", "p1", "p2", "off", "id")
    classes = scratch(rows.groupBy("g", "d").agg(F.count("*").alias("n"), F.min(place).alias("one")), "classes")
    # written first, so that the join has nothing but a shuffle under it and an anchor with many contexts can be split
    several = scratch(classes.groupBy("g").agg(F.count("*").alias("contexts")).filter("contexts > 1"), "several")
    sure = (rows.join(classes.filter("n > 1").select("g", "d"), ["g", "d"], "left_semi")
            .select("id", "h", F.struct("p1", "p2").alias("sure"),
                    F.lit(None).cast("struct<g:bigint,n:bigint,contexts:bigint,p1:bigint,p2:bigint,off:bigint>").alias("asked")))
    asked = (classes.join(several, "g")
             .select("one.id", "one.h", F.lit(None).cast("struct<p1:bigint,p2:bigint>").alias("sure"),
                     F.struct("g", "n", "contexts", "one.p1", "one.p2", "one.off").alias("asked")))
    need = scratch(sure.union(asked).groupBy("id", "h").agg(F.collect_list("sure").alias("sure"),
                                                            F.collect_list("asked").alias("asked")), "need")
    touched = scratch(only(source, need.select("h"), "h", or_all=True).alias("s")
                      .join(need.alias("n"), F.expr("s.id <=> n.id and s.h = n.h"))
                      .select("s.id", "s.h", F.col("s.text").cast("binary").alias("raw"), "sure", "asked"), "touched")
    judged = judge_all(asked_contexts(touched, unit), several, span, gram, most, unit)
    more = judged.groupBy("id", "h").agg(F.collect_list(F.struct("first", "last")).alias("more"))
    both = (touched.drop("asked").join(more, on_key(touched, more), "left")
            .select(touched["id"], touched["h"], "raw", F.concat(
                F.col("sure").cast("array<struct<first:bigint,last:bigint>>"),
                F.coalesce("more", F.array().cast("array<struct<first:bigint,last:bigint>>"))).alias("cuts"))
            .filter(F.size("cuts") > 0))
    kind = docs.schema[id_col].dataType.simpleString()

    def byte_cuts(raw, cuts):
        if unit == "byte":
            return [(c["first"], c["last"]) for c in cuts]
        data = np.frombuffer(raw, np.uint8)
        starts = np.append(word_symbols(data, np.array([0, len(data)]))[2], len(data))
        return [(int(starts[c["first"]]), int(starts[c["last"]])) for c in cuts]

    def run(batches):
        for b in batches:
            out = []
            for raw, cuts in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                kept, at, spans = [], 0, 0
                stop = -1
                for first, last in sorted(byte_cuts(raw, cuts)):
                    if first > stop:
                        kept.append(raw[at:first])
                        spans += 1
                    stop = max(stop, last)
                    at = stop
                kept = b"".join([*kept, raw[at:]])
                out.append((len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.string())], names=["id", "h", "n_removed", "n_spans", "kept_sha256", "clean"])

    # rows that repeat a key are equal, and one of them stands for all
    return both.mapInArrow(run, f"id {kind}, h bigint, n_removed bigint, n_spans bigint, kept_sha256 string, clean string")


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated bytes cut out of the text; the columns stay the same, whatever their names.

    A character that loses some of its bytes is dropped; ``n_chars``, where it exists, follows the text.
    """
    found = scratch(repeated(docs, id_col, text_col, **options).dropDuplicates(["id", "h"]).select("id", "h", "clean"), "cleaned")
    key, clean, other = unused(docs, "key", "clean", "other")
    h = F.xxhash64(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rest, changed = None, docs.withColumn(key, h)
    found = found.select(F.col("id").alias(other), F.col("h").alias(key), F.col("clean").alias(clean))
    keys = found.select(key)
    if keys.count() <= SEND:  # texts that stay as they are need no join
        keys = F.broadcast(keys.distinct())
        rest, changed = changed.join(keys, key, "left_anti"), changed.join(keys, key, "left_semi")
    joined = changed.alias("d").join(found.alias("f"), F.col(f"d.`{id_col}`").eqNullSafe(F.col(f"f.{other}")) & (F.col(f"d.{key}") == F.col(f"f.{key}")), "left")
    text = F.coalesce(F.col(f"f.{clean}"), F.col(f"d.`{text_col}`"))
    new = {text_col: text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(f"f.{clean}").isNull(), F.col("d.n_chars")).otherwise(F.char_length(text))
    out = joined.select(*[new.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns])
    return out.union(rest.select(*[F.col(f"`{c}`") for c in docs.columns])) if rest is not None else out


def remove_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = WORD_SPAN, gram: int = WORD_GRAM,
                          **options) -> DataFrame:
    """``docs`` without the passages of ``span`` words or more that stand anywhere else too."""
    return remove_repeated(docs, id_col, text_col, span=span, gram=gram, unit="word", **options)


def query(spark, sf_dir):
    """op9: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = table(spark, sf_dir, "documents")
    found = scratch(repeated(docs).drop("clean").dropDuplicates(["id", "h"]), "repeated")
    source = keyed(docs, "doc_id", "text").select("id", "h", F.octet_length("text").cast("bigint").alias("n_bytes"),
                                                 F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    zero = F.lit(0).cast("bigint")
    return (source.join(found, on_key(source, found), "left")
            .select(source["id"].alias("doc_id"), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                    F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")))
