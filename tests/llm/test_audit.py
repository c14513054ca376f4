"""Filter interaction audit against a loop over documents and orders."""

import itertools
import re

import pytest

from sharedsignal.llm import filteraudit


def brute(docs, labels):
    """(part, order, step) -> counts, by applying the filters one after another."""
    texts = [(i, t or "", s or "") for i, t, s in docs]
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    rows = []
    for i, t, part in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and any(j is not None and j < i and u == t for j, u, _ in texts)}
        rows.append((part, {k for k, f in fails.items() if f}, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                before = [r for r in own if f in r[1] and not any(r is x for x in left)]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(before), sum(r[1] == {f} for r in own),
                                                   sum(r[2] for r in gone), sum(r[3] for r in gone), f]
        for k, v in out.items():
            if k[0] == part:
                v[-1] = shapley[v[-1]]
    return {k: tuple(v) for k, v in out.items()}


def got(frame):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in frame.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_one_filter_after_another(spark, seed):
    import random

    rng = random.Random(seed)
    pool = [" ".join(rng.choice(["Alpha", "beta", "ga#mma", "DELTA", "x", "é"]) + (str(rng.randrange(400)) if rng.random() < wide else "")
                     for _ in range(rng.choice([0, 5, 199, 200, 201, 400]))) for wide in (0, 0.5, 1) for _ in range(6)]
    docs = [(rng.choice([None, *range(12)]), rng.choice([None, "", *pool]), rng.choice([None, "", "a", "b"])) for _ in range(60)]
    labels = [(rng.choice([None, *range(12)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(15)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, source string, mask int, digest string")
    tags = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert got(filteraudit.interactions(frame, tags)) == brute(docs, labels)


def test_hostile_rows_and_empty_tables(spark, hostile, nothing):
    tags = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    found = got(filteraudit.interactions(hostile.withColumnRenamed("lang", "source"), tags))
    rows = [(r.doc_id, r.text, r.lang) for r in hostile.collect()]
    assert found == brute(rows, [(1, 1, 0), (1, 0, 1), (None, 1, 1)])
    assert filteraudit.interactions(nothing, tags).count() == 0


def test_words_are_cut_only_at_white_space():
    raw = (b"abc \t" * 50 + b"y" * 300 + b"\x0b" + b"d e") * 3
    for most in (1, 7, 64, 200, 5000):
        assert [w for part in filteraudit.word_lists(raw, most) for w in part] == raw.split()
