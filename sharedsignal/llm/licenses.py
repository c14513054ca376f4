"""Licence scans with a generalised suffix automaton of licence words.

A-Z is lower-cased; words are maximal runs of digits, a-z and bytes from 0x80.
All templates (notices and short phrases) go into one suffix automaton.  A file's
words are streamed through it, which gives its matching statistics: at each word
the longest match that ends there and occurs in a template.  Phrases are read off
the states.  Matches of at least LONG words that cannot be extended are chained
per template, in the order of both, over gaps of at most GAP words.  A template is a
whole text of one or more paragraphs (lines).  A chain is a span; it has the template's
label where it covers at least COVER of one of its paragraphs and no other label's
paragraph matches more of the same words.  Its share is that of the whole template.

Only stretches whose neighbouring words are neighbours in some template are
streamed: elsewhere every match is shorter than two words.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import licensetexts as X
from .common import ascii_word_table, pick, pieces, table, utf8_column

LONG, GAP, COVER = 4, 24, 0.75
SHARD_BYTES = 4 << 20

# Phrases and their labels, as the query's contract states them.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Whole texts and notices of widely published licences, and usual short notices.
NOTICES = [
    (X.MIT, "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    (X.APACHE_NOTICE, "apache"),
    (X.APACHE_BODY, "apache"),
    (X.GPL_NOTICE, "gpl"),
    (X.GPL2_BODY, "gpl"),
    (X.GPL3_BODY, "gpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    (X.LGPL_NOTICE, "lgpl"),
    (X.LGPL21_BODY, "lgpl"),
    (X.LGPL3_BODY, "lgpl"),
    (X.BSD, "bsd"),
    (X.ISC, "isc"),
    (X.MPL_NOTICE, "mpl"),
    (X.MPL_BODY, "mpl"),
    (X.UNLICENSE, "unlicense"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
]


class SuffixAutomaton:
    """Generalised suffix automaton of integer sequences.

    ``ends[state]`` maps a sequence's number to the first place (exclusive end) of
    the state's strings in it; ``complete[state]`` lists the sequences whose whole
    text is a suffix of the state's longest string, as (length, number).
    """

    def __init__(self, sequences, whole=()):
        self.next, self.link, self.size, self.ends = [{}], [-1], [0], [{}]
        for k, seq in enumerate(sequences):
            last = 0
            for at, c in enumerate(seq):
                last = self._extend(last, c)
                self.ends[last].setdefault(k, at + 1)
        for v in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            up = self.ends[self.link[v]]
            for k, e in self.ends[v].items():
                up[k] = min(e, up.get(k, e))
        self.complete = [[] for _ in self.size]
        for k in whole:
            v = 0
            for c in sequences[k]:
                v = self.next[v][c]
            self.complete[v].append((len(sequences[k]), k))
        for v in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            self.complete[v] = self.complete[v] + self.complete[self.link[v]]

    def _state(self, size, copy=None):
        self.next.append(dict(self.next[copy]) if copy is not None else {})
        self.link.append(self.link[copy] if copy is not None else 0)
        self.size.append(size)
        self.ends.append(dict(self.ends[copy]) if copy is not None else {})
        return len(self.size) - 1

    def _split(self, p, c, q):
        """State for the strings of q that are not longer than p's longest string and c."""
        if self.size[q] == self.size[p] + 1:
            return q
        clone = self._state(self.size[p] + 1, q)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last, c):
        if c in self.next[last]:
            return self._split(last, c, self.next[last][c])
        new = self._state(self.size[last] + 1)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        self.link[new] = 0 if p < 0 else self._split(p, c, self.next[p][c])
        return new

    def stream(self, ids):
        """Matching statistics: (state, length) after each id."""
        v = size = 0
        for c in ids:
            while v and c not in self.next[v]:
                v = self.link[v]
                size = self.size[v]
            v = self.next[v].get(c, 0)
            size = size + 1 if v else 0
            yield v, size


def chains(matches, lengths, gap: int = GAP):
    """Best chains of matches [(file start, file end, sequence, sequence start)].

    Per sequence: file and sequence places both rise, with at most ``gap`` words of
    the file between links.  Returns [(sequence, first, last, covered share)], the
    chains that no longer one continues, in file order.
    """
    by, out = {}, []
    for m in matches:
        by.setdefault(m[2], []).append(m)
    for k, own in by.items():
        best, begin, used = [], [], set()
        low = 0
        for i, (a, z, _, s) in enumerate(own):
            while own[low][1] < a - gap:
                low += 1
            top, frm = 0, None
            for j in range(low, i):
                b, y, _, t = own[j]
                if y <= a and t + (y - b) <= s and best[j] > top:
                    top, frm = best[j], j
            if frm is not None:
                used.add(frm)
            best.append(top + z - a)
            begin.append(a if frm is None else begin[frm])
        out += [(k, begin[i], own[i][1], min(1.0, best[i] / lengths[k])) for i in range(len(own)) if i not in used]
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


class EndsBeyond:
    """Most matched words among the chains that reach to a place or beyond, for all labels but one (a Fenwick tree).

    A node holds the two best (words, label) of different labels, so asking costs a logarithm of the places.
    """

    def __init__(self, places):
        self.rank = {p: i for i, p in enumerate(sorted(set(places), reverse=True), 1)}
        self.best = [((0, None), (0, None))] * (len(self.rank) + 1)

    def add(self, place, words, label):
        i = self.rank[place]
        while i < len(self.best):
            first, second = self.best[i]
            if words > first[0]:
                self.best[i] = (words, label), (second if label == first[1] else first)
            elif label != first[1] and words > second[0]:
                self.best[i] = first, (words, label)
            i += i & -i

    def most(self, place, label):
        i, top = self.rank[place], 0
        while i:
            first, second = self.best[i]
            top = max(top, second[0] if first[1] == label else first[0])
            i -= i & -i
        return top


def best_paragraphs(found, labels):
    """Chains of paragraphs [(paragraph, first, last, matched words)] without those inside the words of a chain
    of another label that matches more, in the given order.  One sweep by first word, n log n for n chains.
    """
    tree, kept = EndsBeyond([x[2] for x in found]), [True] * len(found)
    order = sorted(range(len(found)), key=lambda i: found[i][1])
    for _, same in groupby(order, key=lambda i: found[i][1]):
        same = list(same)
        for i in same:
            tree.add(found[i][2], found[i][3], labels[found[i][0]])
        for i in same:
            kept[i] = tree.most(found[i][2], labels[found[i][0]]) <= found[i][3]
    return [x for x, k in zip(found, kept) if k]


class Inside:
    """Whether an interval of a key lies inside asked words: starts sorted, with the least end from each start on."""

    def __init__(self, intervals):
        self.by = {}
        for key, first, last in sorted(intervals, reverse=True):
            starts, ends = self.by.setdefault(key, ([], []))
            starts.append(-first)
            ends.append(min(last, ends[-1]) if ends else last)

    def has(self, key, first, last):
        starts, ends = self.by.get(key, ((), ()))
        n = bisect_right(starts, -first)  # those that start at ``first`` or later
        return n > 0 and ends[n - 1] <= last


REPORT = ("n_words bigint, places array<struct<start:bigint,label:string>>, "
          "spans array<struct<first:bigint,last:bigint,label:string,covered:double>>")


def scan(docs: DataFrame, text_col: str = "text", phrases=PHRASES, notices=NOTICES, long: int = LONG, gap: int = GAP,
         cover: float = COVER) -> DataFrame:
    """All columns of ``docs`` and ``_report``: n_words, places of phrases (start word, label) and spans
    of notices (first word, last word exclusive, label, covered share of the whole notice; spans that
    cover less than ``cover`` of every paragraph are reported with label null).

    One row per input row; null text is empty and has no words.
    """
    where = docs.columns.index(text_col)
    schema = T.StructType(docs.schema.fields + [T.StructField("_report", T.StructType.fromDDL(REPORT))])
    kind = pa.struct([("n_words", pa.int64()), ("places", pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))),
                      ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()),
                                                    ("covered", pa.float64())])))])

    def run(batches):
        words = ascii_word_table()
        vocabulary = {}
        split_words = lambda t: [vocabulary.setdefault(w, len(vocabulary) + 1) for w in t.encode().translate(words).split()]
        sequences, notice, before, labels, lengths = [split_words(t) for t, _ in phrases], [], [], [x for _, x in phrases], []
        for k, (t, label) in enumerate(notices):  # a sequence per paragraph: its notice and its place there
            lengths.append(0)
            for paragraph in filter(None, map(split_words, t.split("\n"))):
                sequences.append(paragraph)
                notice.append(k)
                before.append(lengths[k])
                labels.append(label)
                lengths[k] += len(paragraph)
        n_phrases, of_sequence = len(phrases), [len(x) for x in sequences]
        automaton = SuffixAutomaton(sequences, range(n_phrases))
        neighbours = np.zeros((len(vocabulary) + 1, len(vocabulary) + 1), bool)
        for s in sequences:
            neighbours[s[:-1], s[1:]] = True
        vocabulary[b"\x00"] = -1

        def row(ids, stretches):
            places, matches = [], []
            for a, z in stretches:
                ids_of = ids[a:z].tolist()
                told = list(automaton.stream(ids_of))
                for i, (v, size) in enumerate(told):
                    for n, k in automaton.complete[v]:
                        if n <= size:
                            places.append((a + i + 1 - n, labels[k]))
                    if size >= long and (i + 1 == len(told) or told[i + 1][1] <= size):
                        for k, e in automaton.ends[v].items():
                            if k >= n_phrases:
                                matches.append((a + i + 1 - size, a + i + 1, k, e - size))
            told = best_paragraphs([(k, a, z, share * of_sequence[k]) for k, a, z, share in chains(matches, of_sequence, gap)
                                    if share >= cover], labels) if matches else []
            whole = [(a, z, notice[k - n_phrases], before[k - n_phrases] + s) for a, z, k, s in matches]
            inside = Inside([(notice[k - n_phrases], a, z) for k, a, z, _ in told])
            spans = [(a, z, notices[k][1] if inside.has(k, a, z) else None, share)
                     for k, a, z, share in chains(whole, lengths, gap)]
            return sorted(places), spans

        def shard(texts):
            split = b" \x00 ".join([t.translate(words) for t in texts]).split()
            ids = np.fromiter(map(vocabulary.get, split, repeat(0)), np.int64, len(split))
            starts = np.concatenate([[0], np.flatnonzero(ids == -1) + 1])
            ends = np.concatenate([starts[1:] - 1, [len(split)]])
            linked = neighbours[ids[:-1], ids[1:]] & (ids[:-1] > 0) & (ids[1:] > 0) if len(ids) > 1 else np.zeros(0, bool)
            edge = np.flatnonzero(np.diff(np.concatenate([[0], linked.view(np.int8), [0]])))
            first, last = edge[::2], edge[1::2] + 1
            rows = np.searchsorted(starts, first, side="right") - 1
            by = {}
            for r, a, z in zip(rows.tolist(), first.tolist(), last.tolist()):
                by.setdefault(r, []).append((a, z))
            for r, (lo, hi) in enumerate(zip(starts.tolist(), ends.tolist())):
                places, spans = row(ids[lo:hi], [(a - lo, z - lo) for a, z in by[r]]) if r in by else ([], [])
                yield {"n_words": hi - lo, "places": [{"start": p, "label": x} for p, x in places],
                       "spans": [{"first": a, "last": z, "label": x, "covered": c} for a, z, x, c in spans]}

        for batch in batches:
            data, off = utf8_column(batch.column(where))
            out = []
            for i, j in pieces(off, SHARD_BYTES):
                raw = data[off[i]:off[j]].tobytes()
                cut = (off[i:j + 1] - off[i]).tolist()
                out += shard([raw[a:z] for a, z in zip(cut, cut[1:])])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, "_report"])

    return docs.mapInArrow(run, schema)


def query(spark, sf_dir):
    """op10: base phrases (counts, places, labels), all labels and a score.

    The score is 1 where a phrase stands, else the largest covered share of a whole notice.
    """
    found = scan(pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"))
    base = F.array_sort(F.array_distinct("_report.places.label"))
    more = F.filter("_report.spans.label", lambda x: x.isNotNull())
    return found.select(
        "doc_id", F.col("_report.n_words").alias("n_words"), F.size("_report.places").cast("bigint").alias("n_base"),
        F.array_min("_report.places.start").alias("first_word"), F.array_max("_report.places.start").alias("last_word"),
        F.concat_ws(",", base).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(base, more)))).alias("labels"),
        F.when(F.size("_report.places") > 0, F.lit(1.0))
        .otherwise(F.coalesce(F.array_max("_report.spans.covered"), F.lit(0.0))).alias("score"))
