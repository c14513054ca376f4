"""Tests of one region of a chromosome together: shared variants without rows per test and variant.

A signal's statistics are one row of arrays.  A group holds the tests whose left lead lies in
one region and the signals that they name, each once, however many tests use it; the rows of
tests and variants exist only inside the task.  What is shuffled grows with the tests and the
statistics, not with their product.  Regions with many signals are cut into several groups by
hashes of the left and of the right signal, so that a group stays small whatever its region holds.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import PRIOR_SD_CC, PRIOR_SD_QUANT
from ..sources.io import materialize
from .dictionary import dictionary, encode

#: Bases of a region; leads of a test are at most a quarter of it apart, so most signals are sent once or twice.
REGION = 2_000_000
#: About how many signals of one side a group may hold.
GROUP_SIGNALS = 256
#: Rows of tests and variants that a task holds at once.
_ROWS_AT_ONCE = 1 << 18
CONSTANTS = ("n_total", "n_cases", "is_cc")
ARRAYS = ["pos", "code", "z", "maf", "ok", *CONSTANTS]
SUMS_SCHEMA = "test_id bigint, nsnps int, L1 double, L2 double, L12 double"


def variant_code(prefix: str = "") -> Column:
    """chrom, ref and alt as one text from which each can be read back: lengths are written, so no separator can mislead."""
    chrom, ref, alt = (prefix + c for c in ("chrom", "ref", "alt"))
    return F.concat(F.length(chrom).cast("string"), F.lit(":"), chrom, F.length(ref).cast("string"), F.lit(":"), ref, alt)


def variant_text(code: str, pos: int) -> str:
    """``chrom:pos:ref:alt`` of a ``variant_code`` and a position."""
    parts, rest = [], code
    for _ in range(2):
        size, rest = rest.split(":", 1)
        parts.append(rest[:int(size)])
        rest = rest[int(size):]
    return f"{parts[0]}:{pos}:{parts[1]}:{rest}"


def add_groups(t: DataFrame, group_signals: int = GROUP_SIGNALS) -> DataFrame:
    """``t`` (left_signal_id, right_signal_id, left_lead_chrom, left_lead_pos and any other columns) with its ``group``.

    The regions' sizes, one row each, are written first: their exact size lets the next plan send them to the rows of ``t``.
    """
    t = t.withColumn("__region", F.xxhash64("left_lead_chrom", F.floor(F.col("left_lead_pos") / REGION)))
    sizes = t.groupBy("__region").agg(*[
        F.greatest(F.ceil(F.approx_count_distinct(f"{s}_signal_id") / group_signals), F.lit(1)).cast("bigint").alias(f"__{s}")
        for s in ("left", "right")])
    share = [F.pmod(F.xxhash64(f"{s}_signal_id"), F.col(f"__{s}")) for s in ("left", "right")]
    return (t.join(materialize(sizes, "region-sizes"), "__region").withColumn("group", F.xxhash64("__region", *share))
             .drop("__region", "__left", "__right"))


def with_groups(tests: DataFrame, group_signals: int = GROUP_SIGNALS) -> DataFrame:
    """(test_id, left_signal_id, right_signal_id, group) of tests with the left lead's chromosome and position."""
    named = tests.select("test_id", "left_signal_id", "right_signal_id", "left_lead_chrom", "left_lead_pos")
    return add_groups(named, group_signals).drop("left_lead_chrom", "left_lead_pos")


def signal_arrays(stats: DataFrame) -> DataFrame:
    """One row per signal: arrays of pos, code, z, maf, ok and the study constants (one entry where all rows agree).

    ``stats`` carry z, maf and ``informative``.  Rows without a whole variant match nothing and are left out.
    """
    usable = F.coalesce(F.col("informative") & (F.col("maf") > 0) & ~F.isnan("maf"), F.lit(False))
    x = stats.na.drop("any", subset=["chrom", "pos", "ref", "alt"])
    row = F.struct(F.col("pos").cast("bigint").alias("pos"), variant_code().alias("code"), "z", "maf", usable.alias("ok"), *CONSTANTS)
    total, one = F.count(F.lit(1)), F.lit(True)
    for c in CONSTANTS:
        one = one & ((F.count(c) == 0) | ((F.count(c) == total) & (F.min(c) == F.max(c))))
    # in order of position, so that neighbours look alike to the shuffle's compression
    g = x.groupBy("signal_id").agg(F.sort_array(F.collect_list(row)).alias("rows"), one.alias("one"))
    g = g.withColumn("constants", F.when(F.col("one"), F.slice("rows", 1, 1)).otherwise(F.col("rows")))
    return g.select("signal_id", *[F.col(f"rows.{c}").alias(c) for c in ("pos", "code", "z", "maf", "ok")],
                    *[F.col(f"constants.{c}").alias(c) for c in CONSTANTS])


def log_abf(z, maf, n, share, is_cc):
    """Wakefield log ABF of arrays; the formula of ``functions.stats.with_log_abf``."""
    base = 2.0 * n * maf * (1.0 - maf)
    v = 1.0 / np.where(is_cc, base * share * (1.0 - share), base)
    w = np.where(is_cc, PRIOR_SD_CC ** 2, PRIOR_SD_QUANT ** 2)
    r = w / (w + v)
    return 0.5 * (np.log(1.0 - r) + r * z * z)


def study_constants(n_total: pa.Array, n_cases: pa.Array, is_cc: pa.Array):
    """(N, share of cases or controls, is_cc, whether a Bayes factor exists) of arrays of constants."""
    n, cases = (_doubles(x) for x in (n_total, n_cases))
    cc = np.asarray(pc.fill_null(is_cc, False)).astype(bool)
    share = np.minimum(cases, n - cases) / n
    return n, share, cc, (n > 0) & (~cc | ((share > 0) & (share < 1)))


def _doubles(x: pa.Array) -> np.ndarray:
    return x.cast(pa.float64()).to_numpy(zero_copy_only=False)


def log_sums(test: np.ndarray, l1: np.ndarray, l2: np.ndarray):
    """(tests, rows, L1, L2, L12) by log-sum-exp of rows ordered by test; -inf stands for a row without a value."""
    start = np.flatnonzero(np.diff(test, prepend=test[0] - 1)) if len(test) else np.empty(0, np.int64)
    size = np.diff(start, append=len(test))
    out = []
    for x in (l1, l2, l1 + l2):
        top = np.maximum.reduceat(x, start) if len(start) else np.empty(0)
        out.append(top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, size)), start)) if len(start) else top)
    return test[start], size, out


def sums_table(test_ids: np.ndarray, size: np.ndarray, sums, tops_missing=None) -> pa.Table:
    """Rows of ``SUMS_SCHEMA``; a sum over no value at all is NULL."""
    columns = [pa.array(test_ids, pa.int64()), pa.array(size.astype(np.int32))]
    columns += [pa.array(x, pa.float64(), mask=m) for x, m in zip(sums, tops_missing)]
    return pa.table(columns, names=["test_id", "nsnps", "L1", "L2", "L12"])


def posterior_sums(test_ids, test, z1, maf1, none1, c1, z2, maf2, none2, c2) -> pa.Table:
    """Sums of usable rows; ``c1``, ``c2``: (N, share, is_cc) per row, ``none``: z is NULL."""
    l1, l2 = log_abf(z1, maf1, *c1), log_abf(z2, maf2, *c2)
    l1[none1], l2[none2] = -np.inf, -np.inf
    return _summed(test_ids, test, l1, l2)


def _summed(test_ids, test, l1, l2) -> pa.Table:
    owner, size, sums = log_sums(test, l1, l2)
    empty = np.add.reduceat(np.isneginf(np.stack([l1, l2, l1 + l2])).astype(np.int64), np.cumsum(size) - size, axis=1) == size if len(size) else [None] * 3
    return sums_table(test_ids[owner], size, sums, empty)


class _Windows:
    """The variants of a group's signals as flat arrays, ordered by (signal, variant)."""

    def __init__(self, table: pa.Table):
        self.column = {c: table.column(c).combine_chunks() for c in table.column_names}
        self.ids = np.asarray(self.column["signal_id"])
        self.size = np.asarray(self.column["pos"].value_lengths()).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.owner = np.repeat(np.arange(len(self.ids)), self.size)
        coded = self.column["code"].flatten().dictionary_encode()
        codes = np.array(coded.dictionary.to_pylist(), object)
        by_text = np.argsort(codes)
        place = np.empty(len(codes), np.int64)
        place[by_text] = np.arange(len(codes))
        self.codes = codes[by_text]
        self.positions, at = np.unique(np.asarray(self.column["pos"].flatten()), return_inverse=True)
        self.variants, rank = np.unique(at * max(len(codes), 1) + place[np.asarray(coded.indices)], return_inverse=True)
        self.order = np.lexsort((rank, self.owner))
        self.rank = rank[self.order]
        self.repeats = bool((np.diff(self.owner * (len(self.variants) + 1) + self.rank) == 0).any())

    def rows(self, signals: np.ndarray):
        """(number of the signal in ``signals``, place of the row) for all rows of ``signals``."""
        size = self.size[signals]
        owner = np.repeat(np.arange(len(signals)), size)
        return owner, np.arange(len(owner)) + np.repeat(self.start[signals] - (np.cumsum(size) - size), size)

    def shared(self, left: np.ndarray, right: np.ndarray):
        """(test, left row, right row) of the variants that each pair of signals shares, by test and variant."""
        width = len(self.variants)
        (to, l), (tr, r) = self.rows(left), self.rows(right)
        mine, theirs = to * width + self.rank[l], tr * width + self.rank[r]
        lo = np.searchsorted(mine, theirs, "left")
        if self.repeats:
            times = np.searchsorted(mine, theirs, "right") - lo
            k = np.repeat(np.arange(len(times)), times)
            at = lo[k] + np.arange(len(k)) - np.repeat(np.cumsum(times) - times, times)
        else:
            k = np.flatnonzero(mine[np.minimum(lo, len(mine) - 1)] == theirs) if len(mine) else np.empty(0, np.int64)
            at = lo[k]
        return tr[k], l[at], r[k]


class _Signals(_Windows):
    """``_Windows`` with the values that Bayes factors need."""

    def __init__(self, table: pa.Table):
        super().__init__(table)
        flat = {c: self.column[c].flatten() for c in ("z", "maf", "ok", *CONSTANTS)}
        self.none = np.asarray(flat["z"].is_null())[self.order]
        self.z, self.maf = _doubles(flat["z"])[self.order], _doubles(flat["maf"])[self.order]
        self.ok = np.asarray(flat["ok"])[self.order]
        entries = np.asarray(self.column["n_total"].value_lengths()).astype(np.int64)
        within = np.arange(len(self.owner)) - np.repeat(self.start, self.size)
        self.constant = (np.repeat(np.cumsum(entries) - entries, self.size) + np.where(np.repeat(entries, self.size) == 1, 0, within))[self.order]
        self.raw = [flat[c] for c in CONSTANTS]
        self.mixed = bool((entries > 1).any())

    def first(self, test: np.ndarray, l: np.ndarray):
        """Place of each test's first shared variant in text order, for tests in ascending order."""
        if not self.mixed:  # every row holds the same constants
            return np.flatnonzero(np.diff(test, prepend=-1))
        width = max(len(self.codes), 1)
        text = np.array([variant_text(self.codes[v % width], self.positions[v // width]) for v in self.variants], object)
        place = np.empty(len(text), np.int64)
        place[np.argsort(text, kind="stable")] = np.arange(len(text))
        order = np.lexsort((place[self.rank[l]], test))
        return order[np.flatnonzero(np.diff(test[order], prepend=-1))]


def _chunks(tests: pa.Table, signals: _Windows):
    """(rows of tests, left, right) of tests whose signals are both there, a bounded number of rows at a time."""
    order = np.argsort(signals.ids)
    sides = []
    for s in ("left", "right"):
        wanted = np.asarray(tests.column(f"{s}_signal_id"))
        at = np.minimum(np.searchsorted(signals.ids, wanted, sorter=order), len(order) - 1)
        sides.append(np.where(signals.ids[order[at]] == wanted, order[at], -1))
    keep = np.flatnonzero((sides[0] >= 0) & (sides[1] >= 0))
    left, right = sides[0][keep], sides[1][keep]
    part = np.cumsum(signals.size[left] + signals.size[right]) // _ROWS_AT_ONCE
    for k in np.split(np.arange(len(keep)), np.flatnonzero(np.diff(part)) + 1):
        if len(k):
            yield keep[k], left[k], right[k]


def _group_sums(tests: pa.Table, table: pa.Table) -> pa.Table:
    out = [pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64())], names=["test_id", "nsnps", "L1", "L2", "L12"])]
    if not (tests.num_rows and table.num_rows):
        return out[0]
    with np.errstate(all="ignore"):
        s = _Signals(table)
        n, share, cc, good = study_constants(*s.raw)
        if not s.mixed:  # the factors depend on the signal's row alone
            c = s.constant
            factors = log_abf(s.z, s.maf, n[c], share[c], cc[c])
            factors[s.none] = -np.inf
            usable = s.ok & good[c]
        test_ids = np.asarray(tests.column("test_id"))
        for own, left, right in _chunks(tests, s):
            ids = test_ids[own]
            test, l, r = s.shared(left, right)
            if not s.mixed:
                k = np.flatnonzero(usable[l] & usable[r])
                out.append(_summed(ids, test[k], factors[l[k]], factors[r[k]]))
                continue
            first = s.first(test, l)
            number = np.cumsum(np.diff(test, prepend=-1) > 0) - 1  # of the test among those that share a variant
            c1, c2 = s.constant[l[first]][number], s.constant[r[first]][number]
            k = np.flatnonzero(s.ok[l] & s.ok[r] & good[c1] & good[c2])
            l, r, c1, c2 = l[k], r[k], c1[k], c2[k]
            out.append(posterior_sums(ids, test[k], s.z[l], s.maf[l], s.none[l], (n[c1], share[c1], cc[c1]),
                                      s.z[r], s.maf[r], s.none[r], (n[c2], share[c2], cc[c2])))
    return pa.concat_tables(out)


def _group_first(tests: pa.Table, table: pa.Table) -> pa.Table:
    names = ["test_id", *[f"{s}_{c}" for s in ("left", "right") for c in ("n", "ncases", "cc")]]
    kinds = [table.schema.field(c).type.value_type for c in CONSTANTS]
    out = [pa.table([pa.array([], t) for t in (pa.int64(), *kinds, *kinds)], names=names)]
    if tests.num_rows and table.num_rows:
        s = _Signals(table)
        test_ids = np.asarray(tests.column("test_id"))
        for own, left, right in _chunks(tests, s):
            ids = test_ids[own]
            test, l, r = s.shared(left, right)
            first = s.first(test, l)
            out.append(pa.table([pa.array(ids[test[first]], pa.int64()), *[x.take(pa.array(s.constant[side[first]])) for side in (l, r) for x in s.raw]], names=names))
    return pa.concat_tables(out)


def window_blocks(stats: DataFrame, tracks: DataFrame, size: int) -> DataFrame:
    """One row per track (study, phenotype, feature, chromosome) and ``size`` bases: arrays of the statistics there, as ``signal_arrays`` has them."""
    named = encode(stats, tracks, {"study_id": "study_id", "phenotype_id": "phenotype_id", "bio_feature": "bio_feature", "chrom": "lead_chrom"}, "track")
    named = named.withColumn("__block", F.floor(F.col("pos") / size)).withColumn("signal_id", F.struct("track", "__block"))
    return signal_arrays(named).select(F.col("signal_id.track").alias("track"), F.col("signal_id.__block").alias("block"), *ARRAYS)


def _window_places(blocks: pa.Table, members: pa.Table, window: int, size: np.ndarray, pos: np.ndarray):
    """(members with rows, number of rows of each, those rows) of the windows of ``members`` (track, centre) in the flat rows of ``blocks``."""
    tracks, track = np.unique(np.repeat(np.asarray(blocks.column("track")), size), return_inverse=True)
    order = np.lexsort((pos, track))
    low, span = pos.min(), pos.max() - pos.min() + 1
    key = (track * span + pos - low)[order]
    wanted, centre = (np.asarray(members.column(c)) for c in ("track", "centre"))
    at = np.minimum(np.searchsorted(tracks, wanted), len(tracks) - 1)
    first, last = np.maximum(centre - window, low), np.minimum(centre + window, pos.max())
    inside = np.flatnonzero((tracks[at] == wanted) & (first <= last))
    start = np.searchsorted(key, at[inside] * span + first[inside] - low, "left")
    count = np.searchsorted(key, at[inside] * span + last[inside] - low, "right") - start
    inside, start, count = (x[count > 0] for x in (inside, start, count))
    ends = np.cumsum(count)
    return inside, count, order[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)]


def cut_windows(sent: pa.Table, window: int, arrays: Sequence[str] = tuple(ARRAYS), constants: Sequence[str] = CONSTANTS) -> pa.Table:
    """The rows of ``signal_arrays`` of the signals in ``sent``: rows with a signal_id are signals (track, centre), the others blocks of statistics."""
    sent = sent.combine_chunks()
    is_block = sent.column("signal_id").is_null()
    blocks, members = sent.filter(is_block).combine_chunks(), sent.filter(pc.invert(is_block)).combine_chunks()
    names = ["signal_id", *arrays]
    if not (blocks.num_rows and members.num_rows):
        return sent.select(names).slice(0, 0)
    lists = {c: blocks.column(c).combine_chunks() if blocks.column(c).num_chunks != 1 else blocks.column(c).chunk(0) for c in arrays}
    size = np.asarray(lists["pos"].value_lengths()).astype(np.int64)
    flat = {c: lists[c].flatten() for c in arrays}
    if constants:  # one entry per block where all its rows agree
        entries = np.asarray(lists[constants[0]].value_lengths()).astype(np.int64)
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        place = pa.array(np.repeat(np.cumsum(entries) - entries, size) + np.where(np.repeat(entries, size) == 1, 0, within))
        flat |= {c: flat[c].take(place) for c in constants}
    inside, count, rows = _window_places(blocks, members, window, size, np.asarray(flat["pos"]))
    ends = np.cumsum(count)
    one = np.ones(len(inside), bool)
    for c in constants:
        value = np.asarray(flat[c].dictionary_encode(null_encoding="encode").indices)[rows]
        if len(inside):
            one &= np.minimum.reduceat(value, ends - count) == np.maximum.reduceat(value, ends - count)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    columns = [pa.ListArray.from_arrays(offsets, flat[c].take(pa.array(rows))) for c in arrays if c not in constants]
    if constants and one.all():  # one entry of constants per signal, else one per row
        rows, offsets = rows[ends - count], pa.array(np.arange(len(inside) + 1).astype(np.int32))
    columns += [pa.ListArray.from_arrays(offsets, flat[c].take(pa.array(rows))) for c in constants]
    return pa.table([members.column("signal_id").take(pa.array(inside)), *columns], names=names)


def sent_windows(named: DataFrame, signals: DataFrame, blocks, window: int) -> tuple[DataFrame, DataFrame]:
    """(blocks of statistics with the group ``to`` that they go to, written members: to, track, signal_id, centre) of ``named`` (signal_id, to).

    ``blocks(tracks, size)`` gives the statistics by track and ``size`` bases.
    """
    keys = ["study_id", "phenotype_id", "bio_feature", "lead_chrom"]
    size = max(window // 2, 1)
    signals = signals.filter(F.col("lead_chrom").isNotNull() & F.col("lead_pos").isNotNull())
    tracks = dictionary(signals, keys, "track")
    members = (encode(signals, tracks, {c: c for c in keys}, "track")
               .select("signal_id", "track", F.col("lead_pos").cast("bigint").alias("centre")).join(named, "signal_id"))
    members = materialize(members, "group-signals")
    touched = F.sequence(F.floor((F.col("centre") - window) / size), F.floor((F.col("centre") + window) / size))
    asked = members.select("track", "to", F.explode(touched).alias("block")).distinct()
    return blocks(tracks, size).join(asked, ["track", "block"]), members


def _with_members(sent: DataFrame, members: DataFrame, arrays: Sequence[str]) -> DataFrame:
    none = F.lit(None).cast("bigint")
    sent = sent.select("to", "track", none.alias("signal_id"), none.alias("centre"), *arrays)
    kinds = dict(sent.dtypes)
    return sent.union(members.select("to", "track", "signal_id", "centre", *[F.lit(None).cast(kinds[c]).alias(c) for c in arrays]))


def _named(t: DataFrame) -> DataFrame:
    return t.select(F.explode(F.array("left_signal_id", "right_signal_id")).alias("signal_id"), F.col("group").alias("to")).distinct()


def window_sums(tests: DataFrame, signals: DataFrame, stats: DataFrame, window: int, group_signals: int = GROUP_SIGNALS) -> DataFrame:
    """``test_sums`` of statistics that no signal's window was cut from yet.

    ``signals``: signal_id, study_id, phenotype_id, bio_feature, lead_chrom, lead_pos (the window's centre); ``stats``: as
    ``signal_arrays`` needs them, with study_id, phenotype_id and bio_feature instead of signal_id.  A group gets each
    block of statistics that its signals touch once and cuts their windows there, so a statistic that lies in the windows
    of several signals is not sent, or written, once for each.
    """
    t = with_groups(tests, group_signals)
    blocks, members = sent_windows(_named(t), signals, lambda tracks, size: window_blocks(stats, tracks, size), window)
    sent = _with_members(blocks, members, ARRAYS)
    return t.groupBy("group").cogroup(sent.groupBy("to")).applyInArrow(lambda a, b: _group_sums(a, cut_windows(b, window)), SUMS_SCHEMA)


def value_blocks(stats: DataFrame, tracks: DataFrame, size: int, values: Sequence[str]) -> DataFrame:
    """``window_blocks`` with arrays of pos, code and ``values``, one entry per statistic."""
    x = stats.na.drop("any", subset=["chrom", "pos", "ref", "alt"])
    x = encode(x, tracks, {"study_id": "study_id", "phenotype_id": "phenotype_id", "bio_feature": "bio_feature", "chrom": "lead_chrom"}, "track")
    row = F.struct(F.col("pos").cast("bigint").alias("pos"), variant_code().alias("code"), *values)
    x = x.groupBy("track", F.floor(F.col("pos") / size).alias("block")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return x.select("track", "block", *[F.col(f"rows.{c}").alias(c) for c in ("pos", "code", *values)])


def code_parts(codes: Sequence[str]) -> list[tuple[str, str, str]]:
    """(chrom, ref, alt) of each ``variant_code``."""
    out = []
    for code in codes:
        size, rest = code.split(":", 1)
        chrom, rest = rest[:int(size)], rest[int(size):]
        size, rest = rest.split(":", 1)
        out.append((chrom, rest[:int(size)], rest[int(size):]))
    return out


def _group_shared(tests: pa.Table, table: pa.Table, keep: Sequence[str], value: str) -> pa.Table:
    """The rows of ``tests`` that share a variant, each with lists of its shared variants and both signals' values there."""
    lists = [pa.array([], pa.list_(k)) for k in (pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64())]
    names = [*keep, "pos", "ref", "alt", f"left_{value}", f"right_{value}"]
    out = [pa.table([*tests.select(keep).slice(0, 0).columns, *lists], names=names)]
    if tests.num_rows and table.num_rows:
        s = _Windows(table)
        values = s.column[value].flatten().cast(pa.float64()).take(pa.array(s.order))
        width = max(len(s.codes), 1)
        _, ref, alt = (pa.array(x, pa.string()) for x in zip(*code_parts(s.codes)))
        for own, left, right in _chunks(tests, s):
            test, l, r = s.shared(left, right)
            size = np.bincount(test, minlength=len(own))
            offsets = pa.array(np.concatenate([[0], np.cumsum(size[size > 0])]).astype(np.int32))
            at, code = np.divmod(s.variants[s.rank[l]], width)
            flat = [pa.array(s.positions[at]), ref.take(pa.array(code)), alt.take(pa.array(code)), values.take(pa.array(l)), values.take(pa.array(r))]
            out.append(pa.table([*tests.select(keep).take(pa.array(own[size > 0])).columns, *[pa.ListArray.from_arrays(offsets, x) for x in flat]], names=names))
    return pa.concat_tables(out)


#: About how many signals of one side a group may hold that returns every shared variant of its tests.
SHARED_SIGNALS = 64


def window_shared(tests: DataFrame, signals: DataFrame, stats: DataFrame, window: int, value: str, group_signals: int = SHARED_SIGNALS) -> DataFrame:
    """J10 of statistics that no signal's window was cut from yet: the columns of ``tests`` (with ids and the lead's position),
    pos, ref, alt and both sides' ``value``, one row per shared variant.

    A test leaves its group as one row with lists, which are unfolded where they arrive: no row of a shared variant is sent.
    """
    t = add_groups(tests, group_signals)
    blocks, members = sent_windows(_named(t), signals, lambda tracks, size: value_blocks(stats, tracks, size, [value]), window)
    keep, arrays = tests.columns, ["pos", "code", value]
    fields = ", ".join([*[f"`{c}` {k}" for c, k in tests.dtypes], "pos array<bigint>, ref array<string>, alt array<string>", *[f"left_{value} array<double>, right_{value} array<double>"]])
    lists = t.groupBy("group").cogroup(_with_members(blocks, members, arrays).groupBy("to")).applyInArrow(
        lambda a, b: _group_shared(a, cut_windows(b, window, arrays, ()), keep, value), fields)
    return lists.select(*keep, F.inline(F.arrays_zip("pos", "ref", "alt", f"left_{value}", f"right_{value}")))


def _by_group(tests: DataFrame, stats: DataFrame, function, schema: str, group_signals: int) -> DataFrame:
    t = with_groups(tests, group_signals)
    named = t.select(F.explode(F.array("left_signal_id", "right_signal_id")).alias("signal_id"), "group").distinct()
    signals = signal_arrays(stats).join(named.withColumnRenamed("group", "to"), "signal_id")
    return t.groupBy("group").cogroup(signals.groupBy("to")).applyInArrow(lambda a, b: function(a, b), schema)


def test_sums(tests: DataFrame, stats: DataFrame, group_signals: int = GROUP_SIGNALS) -> DataFrame:
    """``SUMS_SCHEMA`` per test with a usable shared variant; study constants are those of its first shared variant."""
    return _by_group(tests, stats, _group_sums, SUMS_SCHEMA, group_signals)


def first_constants(tests: DataFrame, stats: DataFrame, group_signals: int = GROUP_SIGNALS) -> DataFrame:
    """(test_id, left_n, left_ncases, left_cc, right_n, ...) of each test's first shared variant in variant-id order."""
    kinds = [stats.schema[c].dataType.simpleString() for c in CONSTANTS]
    fields = ", ".join(f"{s}_{c} {k}" for s in ("left", "right") for c, k in zip(("n", "ncases", "cc"), kinds))
    return _by_group(tests, stats, _group_first, f"test_id bigint, {fields}", group_signals)
