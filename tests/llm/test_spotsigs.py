import hashlib

import pytest
from pyspark.sql import functions as F

from sharedsignal.llm import spotsigs as P


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def numbers(fingerprint):
    return set(fingerprint.split(",")) if fingerprint else set()


def test_signature(spark, hostile, nothing):
    df = spark.createDataFrame([(1, "The quick brown fox and the lazy dog of a farm!"), (2, "alpha beta gamma"), (3, "alpha"), (4, ""),
                                (5, "the the the"), (6, "...")], "id int, t string")
    got = {r.id: list(r.s) for r in P.with_signature(df, "t", "s").collect()}
    spots = [("the", "quick", "brown"), ("the", "lazy", "dog")]  # 'a farm' has no content word after it
    want = spark.range(1).select(*[F.hash(*map(F.lit, s)) for s in spots]).first()
    assert got[1] == sorted(want) and len(got[2]) == 2 and len(got[3]) == 1 and got[4] == [] and len(got[5]) == len(got[6]) == 1
    rows = P.with_signature(hostile.fillna({"text": ""}), "text", "s").collect()
    assert len(rows) == 9 and all(list(r.s) == sorted(set(r.s)) for r in rows)


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_next_row_by_descending_id(spark, rng, buckets):
    rows = [(int(i), f"text {i} of the number {i % 5} words") for i in rng.permutation(60)[:40]] + [(None, "no id")]
    out = P.with_next(spark.createDataFrame(rows, "doc_id bigint, text string"), buckets).collect()
    order = sorted((r for r in rows if r[0] is not None), reverse=True) + [(None, "no id")]
    after = {order[k][0]: order[(k + 1) % len(order)][1] for k in range(len(order))}
    assert {r.doc_id: r.next_text for r in out} == after and len(out) == len(rows)
    one = P.with_next(spark.createDataFrame([(5, "alone here")], "doc_id bigint, text string"), buckets).collect()
    assert [(r.doc_id, r.next_text) for r in one] == [(5, "alone here")]
    assert P.with_next(spark.createDataFrame([], "doc_id bigint, text string"), buckets).count() == 0


def test_query_rows(spark, tmp_path):
    texts = {9: "The cat sat on the mat and the dog ran.", 7: None, 4: "é日👍 of the day and the night is long", 2: ""}
    spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in P.query(spark, str(tmp_path)).collect()}
    ids = sorted(texts, reverse=True)
    for k, i in enumerate(ids):
        t, nxt = texts[i] or "", texts[ids[(k + 1) % 4]] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(numbers(r.fingerprint), numbers(r.edited_fingerprint)))
        assert r.near_next == pytest.approx(jaccard(numbers(r.fingerprint), numbers(got[ids[(k + 1) % 4]].fingerprint)))


def test_near_duplicates_equal_brute_force(spark, rng, nothing):
    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(25):
        base = list(rng.choice(words, 40))
        for v in range(3):
            copy = list(base)
            if v:
                copy[int(rng.integers(0, 40))] = f"new{k}{v}"
            rows.append((3 * k + v, " ".join(f"the {w}" for w in copy)))
    rows += [(900, rows[0][1]), (901, None), (902, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    members, pairs = P.near_duplicates(docs)
    cls = {r.id: r["class"] for r in members.collect()}
    found = {frozenset((r.a, r.b)): r.likeness for r in pairs.collect()}
    sets = {cls[r.doc_id]: set(r.s) for r in P.with_signature(docs.fillna({"text": ""}), "text", "s").collect()}
    names = sorted(c for c, s in sets.items() if s)
    want = {frozenset((a, b)): jaccard(sets[a], sets[b]) for i, a in enumerate(names) for b in names[i + 1:]
            if jaccard(sets[a], sets[b]) >= P.SIMILARITY}
    assert set(found) == set(want) and len(want) > 20 and cls[0] == cls[900] and cls[901] == cls[902]
    assert P.near_duplicates(nothing)[0].count() == 0
