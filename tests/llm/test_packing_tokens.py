import os
import zlib

import numpy as np
import pytest

from sharedsignal.llm import costpack as C
from sharedsignal.llm import tokencounts as K
from sharedsignal.llm.common import utf8_column

import pyarrow as pa

TEXTS = ["Don't stop, it's the   best.Of all!", "", None, "É è ê ÇA va?que J̌ x'll ...'s İi", "日本語のテキスト 123 4,5",
         "naïve CAFÉ́ ǅ ﬁ \x1c a b c", "<|endoftext|> a<|startoftext|>b", "A" * 3000 + "." * 50, "tab\tnew\nline\r\nend \x0b\x0c",
         "Á á 'S 't're x''ve .'d !'m"]


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(C.tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_chunk_encoder_equals_the_tokenizer(rng):
    t, signs = tokenizer(), list("aAbBéÉ.,'!&$ 1\n-sStTdß́") + ["ll", "'s", "  "]
    texts = TEXTS + ["".join(rng.choice(signs, 60)) for _ in range(400)]
    data, off = utf8_column(pa.array(texts))
    ids, counts = C.ChunkEncoder(C.tokenizer_path())(data, off)
    at = 0
    for text, n in zip(texts, counts):
        assert ids[at:at + n].tolist() == t.encode(text or "", add_special_tokens=False).ids, text
        at += n
    assert at == len(ids)


def test_assign_fills_and_balances(rng):
    lengths = [int(x) for x in rng.integers(1, 9000, 60)]
    total = sum(lengths)
    capacities = [4096] * (total // 4096) + C.power_parts(total % 4096)
    parts = C.assign(lengths, capacities)
    filled = np.zeros(len(capacities), int)
    for d, n in enumerate(lengths):
        own = sorted((s, k) for dd, s, k, _ in parts if dd == d)
        assert [s for s, _ in own] == list(np.cumsum([0] + [k for _, k in own])[:-1]) and sum(k for _, k in own) == n
    for _, _, n, s in parts:
        filled[s] += n
    assert filled.tolist() == capacities
    assert C.power_parts(13) == [8, 4, 1] and C.power_parts(0) == []


def test_pack_round_trip(spark, hostile, nothing):
    t = tokenizer()
    for pool in (1 << 20, 8192):
        rows = C.pack(hostile, C.tokenizer_path(), pool=pool).collect()
        texts = hostile.select("doc_id", "text").collect()
        wanted = sorted(np.array(t.encode(r.text or "", add_special_tokens=False).ids + [2], np.uint32).tobytes() for r in texts)
        sequences = {}
        for r in rows:
            piece = np.array(r.ids, np.uint32)
            assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in sequences.values():
            parts.sort()
            assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])
            n = sum(k for _, k in parts)
            assert n == 4096 or n & (n - 1) == 0
        five = sorted((r.start, r.ids) for r in rows if r.doc_id == 5)
        whole = np.array([i for _, x in five for i in x], np.uint32).tobytes()
        assert whole in wanted and sum(r.length for r in rows) == sum(len(w) // 4 for w in wanted)
    assert C.pack(nothing, C.tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        C.pack(nothing, C.tokenizer_path(), capacity=1000)


def plain(word, scores, byte_score):
    """Best segmentation without sharing: (tokens, score)."""
    best = [(0, 0)]
    for j in range(1, len(word) + 1):
        n = len(word[j - 1].encode())
        options = [(best[j - 1][0] + n * byte_score, -(best[j - 1][1] + n))]
        options += [(best[i][0] + scores[word[i:j]], -(best[i][1] + 1)) for i in range(j) if word[i:j] in scores]
        s, c = max(options)
        best.append((s, -c))
    return best[-1][1], best[-1][0]


def test_trie_counts_equal_plain_dynamic_programming(rng):
    scores, byte_score = K.load_pieces(K.vocabulary_path())
    words = sorted({"▁" + "".join(rng.choice(list("theinga rousé日"), rng.integers(1, 12))).replace(" ", "") for _ in range(500)})
    assert K.trie_counts(words, scores, byte_score) == [plain(w, scores, byte_score) for w in words]
    toy = {"a": -1, "b": -1, "ab": -2, "abc": -9}
    assert K.trie_counts(["ab", "abc"], toy, -5) == [(1, -2), (2, -7)]  # a tie goes to fewer tokens; c is one byte


def test_count_tokens_rows(spark, hostile, nothing):
    scores, byte_score = K.load_pieces(K.vocabulary_path())
    got = K.count_tokens(hostile, K.vocabulary_path()).collect()
    assert len(got) == 9
    for r in got:
        words = [w.decode() for w in (r.text or "").encode().split()]
        each = [plain("▁" + w, scores, byte_score) for w in words[:200]]
        if len(words) <= 200:
            assert (r._pretokens, r._tokens, r._score) == (len(words), sum(c for c, _ in each), sum(s for _, s in each))
    assert K.count_tokens(nothing, K.vocabulary_path()).count() == 0
    assert os.path.exists(K.vocabulary_path())
