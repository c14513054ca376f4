import collections
import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sharedsignal.llm import components as CC
from sharedsignal.llm import simhash as S
from sharedsignal.llm import suffixdedup as D

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_simhash(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    count = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(shingles))


def least_reachable(links):
    lab = np.arange(len(links))
    while True:
        new = np.array([lab[j].min() for j in links])
        if (new == lab).all():
            return lab
        lab = new


def test_components(spark, rng):
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 120, (80, 2))] + [(200 + k, 201 + k) for k in range(60)] + [(7, 7)]
    got = {r.node: r.root for r in CC.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {x: find(x) for x in linked}
    assert CC.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_carry_save_counter(rng):
    fp = rng.integers(0, 2**63, 130, dtype=np.int64).astype(np.uint64)
    fp[1:60] = fp[0] ^ (np.uint64(1) << rng.integers(0, 64, 59, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 59, dtype=np.uint64))
    for radius in (0, 1, 3, 4, 6, 7):
        near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
        i, j = S.shifted_links(fp, np.zeros(len(fp), np.int64), radius)
        assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a, b in zip(*np.nonzero(near)) if a < b}
        for first in (0, 50):
            forest = S.tile_forest(fp, first, radius)
            allowed = near.copy()
            if first:
                allowed[:first, :first] = allowed[first:, first:] = False
            want = least_reachable([np.flatnonzero(allowed[k] | (np.arange(len(fp)) == k)) for k in range(len(fp))])
            linked = [[k] for k in range(len(fp))]
            for a, b in forest:
                assert near[a, b]
                linked[a].append(b)
                linked[b].append(a)
            assert (least_reachable([np.array(x) for x in linked]) == want).all() and len(forest) < len(fp)


@pytest.mark.parametrize("tile", [4096, 300])
def test_links_span_every_component(spark, rng, tile):
    values = []
    for b in rng.integers(0, 2**62, 100).tolist() + [0x123456789ABCDEF0] * 700:
        for t in rng.integers(0, 64, rng.integers(0, 4)).tolist():
            b ^= 1 << t
        values.append(b)
    values = sorted(set(values))
    fp = np.array(values, np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
    want = least_reachable([np.flatnonzero(x) for x in near])
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint")
    root = {r.node: r.root for r in CC.components(S.links(df, 4, tile)).collect()}
    groups = collections.defaultdict(set)
    for k, x in enumerate(fp.view(np.int64).tolist()):
        groups[root.get(x, x)].add(int(want[k]))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.tolist()))


def test_blocks_never_lose_a_pair():
    for n in (10, 10**7, 10**9, 10**12):
        blocks = S.choose_blocks(n, 4)
        assert 5 <= blocks <= 8 and sum(w for _, w in S.block_ranges(blocks)) == 64


def test_near_duplicates_on_hostile_rows(spark, hostile, nothing):
    got = S.near_duplicates(hostile).collect()
    assert len(got) == 9
    texts = {r.doc_id: r.text for r in hostile.collect()}
    for r in got:
        assert r.fp & (2**64 - 1) == slow_simhash(texts[r.id])
    by = {r.id: r.component for r in got}
    assert by[2] == by[3] == by[6] == 2 and by[1] == 1 and by[None] is None  # wordless texts share fingerprint 0
    kept = S.keep_one(hostile)
    assert kept.columns == hostile.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 1, 2, 5, 7, 8]
    assert S.near_duplicates(nothing).count() == 0 and S.keep_one(nothing).count() == 0


def slow_repeated(rows, span):
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[p:p + span] for b in texts for p in range(len(b) - span + 1))
    out = []
    for (i, _), b in zip(rows, texts):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - span + 1):
            if seen[b[p:p + span]] > 1:
                gone[p:p + span] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(rng):
    words = ["the", "of", "and", "zé", "qu", "lorem", "ip", "x"]
    text = lambda n: " ".join(rng.choice(words, n))
    base, rows = [text(60) for _ in range(4)], []
    for i in range(40):
        t = text(rng.integers(0, 40))
        for _ in range(rng.integers(0, 3)):
            b = base[rng.integers(0, 4)]
            x = rng.integers(0, len(b) - 30)
            part = b[x:rng.integers(x + 10, len(b) + 1)]
            if rng.random() < 0.5 and len(part) > 30:
                k = rng.integers(0, len(part))
                part = part[:k] + "#" + str(i) + part[k + 1:]
            t += " " + part + " " + text(rng.integers(0, 10))
        rows.append((i, t))
    return rows + [(100, "a" * 300), (101, None), (102, ""), (5, rows[5][1]), (None, rows[7][1]), (None, "q" * 20)]


@pytest.mark.parametrize("span, gram, most, segment", [(40, 10, 50_000, 1 << 20), (40, 10, 2, 1 << 20), (30, 8, 50_000, 100), (45, 12, 3, 1 << 20)])
def test_repeated_bytes_equal_brute_force(spark, rng, monkeypatch, span, gram, most, segment):
    monkeypatch.setattr(D, "SEGMENT", segment)
    rows = passages(rng)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = D.repeated(docs, span=span, gram=gram, most=most).drop("clean").dropDuplicates(["id", "h"])
    source = D.keyed(docs, "doc_id", "text")
    got = (source.join(found, D.on_key(source, found), "left")
           .select(source["id"], F.octet_length("text"), F.coalesce("n_removed", F.lit(0)), F.coalesce("n_spans", F.lit(0)),
                   F.coalesce("kept_sha256", F.sha2(F.col("text").cast("binary"), 256))).collect())
    assert sorted(map(tuple, got), key=str) == slow_repeated(rows, span)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def without_repeated_words(rows, span):
    """Texts' words left, by counting all windows of ``span`` words."""
    texts = [words(t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[p:p + span]) for w in texts for p in range(len(w) - span + 1))
    out = []
    for w in texts:
        gone = np.zeros(len(w), bool)
        for p in range(len(w) - span + 1):
            if seen[tuple(w[p:p + span])] > 1:
                gone[p:p + span] = True
        out.append([x for x, g in zip(w, gone) if not g])
    return out


@pytest.mark.parametrize("span, gram, most, segment", [(12, 3, 256, 1 << 20), (12, 3, 2, 1 << 20), (50, 10, 256, 300), (7, 2, 1, 1 << 20)])
def test_repeated_words_equal_brute_force(spark, rng, monkeypatch, span, gram, most, segment):
    monkeypatch.setattr(D, "SEGMENT", segment)
    text = lambda n: " ".join(rng.choice(["the", "of", "zé", "\u3000", "x", "ab\u00a0c"], n))
    base = [text(120) for _ in range(3)]
    rows = []
    for i in range(60):
        w = words(base[i % 3])
        x = rng.integers(0, 80)
        rows.append((i, text(rng.integers(0, 30)) + "\n\t " + "  ".join(w[x:x + rng.integers(3, 90)]) + " " + text(rng.integers(0, 30)) + " "))
    rows += [(70, None), (71, ""), (72, " \n "), (73, "a " * 200), (74, rows[3][1]), (None, rows[5][1]), (75, rows[8][1].replace(" ", "\r\n"))]
    docs = spark.createDataFrame([(i, t, 1, "k", "c") for i, t in rows], "doc_id bigint, text string, h bigint, _key string, _Clean string")
    out = D.remove_repeated_words(docs, span=span, gram=gram, most=most)
    assert out.columns == docs.columns
    got = sorted(([str(r.doc_id), words(r.text or "")] for r in out.collect()))
    assert got == sorted([str(i), w] for (i, _), w in zip(rows, without_repeated_words(rows, span)))
    assert {(r.h, r._key, r._Clean) for r in out.collect()} == {(1, "k", "c")}


def test_a_hot_anchor_is_sorted_in_small_groups(spark, rng, monkeypatch):
    """One passage in thousands of different surroundings: no key gathers more than ``most`` contexts."""
    phrase, letters = "".join(rng.choice(list("abcdefgh"), 34)), list("abcdefghijklmnopqrstuvwxyz")
    rows = [(i, "".join(rng.choice(letters, 40)) + phrase + "".join(rng.choice(letters, 40))) for i in range(3000)]
    rows += [(5000 + i, "#" + rows[i][1][20:90] + "#") for i in range(20)]
    sizes = []
    judge = D.judge

    def watched(contexts, span, unit="byte"):
        sizes.append(max([r["count"] for r in contexts.groupBy("g").count().collect()], default=0))
        return judge(contexts, span, unit)

    monkeypatch.setattr(D, "judge", watched)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.id: r.n_removed for r in D.repeated(docs, span=40, gram=30, most=50).collect()}
    assert found == {r[0]: r[2] for r in slow_repeated(rows, 40) if r[2]}
    assert len(sizes) > 1 and max(sizes) <= 50


def test_merge_sort_is_the_suffix_order(rng):
    data = rng.integers(97, 99, 300).astype(np.uint8)
    raw, x = data.tobytes(), np.arange(0, 300, 2)
    end = np.full(len(x), 300)
    order = D.merge_sort(D.PrefixHash(data), x, end)
    assert x[order].tolist() == sorted(x.tolist(), key=lambda p: raw[p:])


def test_remove_repeated_rows(spark, hostile, nothing):
    # the first characters before the shared passage differ in one byte of two, so a cut falls inside them
    passage = "é日 and a passage that stands in two texts, " * 12
    more = spark.createDataFrame([(20, "one ĩ" + passage, "en", "k", 1), (21, "two é" + passage + "ĩ end", "en", "k", 1)], hostile.schema)
    out = D.remove_repeated(hostile.union(more))
    assert out.columns == hostile.columns and out.count() == 11
    got = {r.doc_id: r for r in out.collect()}
    assert got[2].text is None and got[3].text == "" and got[2].n_chars == 2
    assert len(got[20].text) < 60 and got[20].n_chars == len(got[20].text) and got[21].text.startswith("two ")
    assert D.remove_repeated(nothing).count() == 0
