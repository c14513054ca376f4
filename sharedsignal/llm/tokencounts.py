"""Token counts by dynamic programming over a trie of pre-tokens.

A pre-token is a maximal run of characters other than ASCII white space, with the
vocabulary's word mark in front.  Its tokens are the segmentation into pieces of the
best total score; a character that is no piece counts as its UTF-8 bytes.  The public
vocabulary stores merge ranks, so a piece's score is that of Zipf's law, -log(rank + 2),
in whole millionths; ties go to fewer tokens.

The distinct pre-tokens of a piece of text form a trie.  Walking it depth first (the
sorted pre-tokens with the prefix each shares with the one before), the forward score
of a shared prefix is computed once, and each terminal keeps its count.
"""

from __future__ import annotations

import math
import os.path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, pieces, table, utf8_column

TEXT_BYTES, REMEMBER = 2 << 20, 400_000
MARK = "▁"


def load_pieces(path: str) -> tuple[dict, int]:
    """Scores of the pieces in whole millionths, and the score of one byte of an unknown character."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    real = [k for k in range(model.get_piece_size())
            if not (model.is_control(k) or model.is_byte(k) or model.is_unknown(k) or model.is_unused(k))]
    real.sort(key=lambda k: (-model.get_score(k), k))
    scores = {model.id_to_piece(k): -round(1e6 * math.log(rank + 2)) for rank, k in enumerate(real)}
    return scores, -round(1e6 * (math.log(len(real) + 2) + 2))


def trie_counts(words: list[str], scores: dict, byte_score: int) -> list[tuple[int, int]]:
    """(tokens, score) of each of the sorted, distinct ``words``, in order."""
    longest = max(map(len, scores), default=0)
    best, tokens, out, before = [0], [0], [], ""
    get = scores.get
    for w in words:
        shared = len(os.path.commonprefix((before, w)))
        del best[shared + 1:], tokens[shared + 1:]
        for j in range(shared + 1, len(w) + 1):
            n = len(w[j - 1].encode("utf-8", "surrogatepass"))
            top, count = best[j - 1] + n * byte_score, tokens[j - 1] + n
            for i in range(max(0, j - longest), j):
                s = get(w[i:j])
                if s is not None:
                    s += best[i]
                    if s > top or (s == top and tokens[i] + 1 < count):
                        top, count = s, tokens[i] + 1
            best.append(top)
            tokens.append(count)
        out.append((tokens[-1], best[-1]))
        before = w
    return out


def count_tokens(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """All columns and _pretokens, _tokens, _score (sum of the best scores, millionths).

    Null, empty and blank texts have no tokens; repeated rows count each; very long
    texts and pre-tokens are read whole.
    """
    where = docs.columns.index(text_col)
    schema = T.StructType(docs.schema.fields + [T.StructField(c, T.LongType()) for c in ("_pretokens", "_tokens", "_score")])

    def run(batches):
        scores, byte_score = load_pieces(vocabulary)
        known = {}
        for b in batches:
            column = b.column(where)
            _, off = utf8_column(column)
            totals = []
            for i, j in pieces(off, TEXT_BYTES):
                split = pc.ascii_split_whitespace(column.slice(i, j - i).fill_null(""))
                offsets = np.asarray(split.offsets)
                chunks = split.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).dictionary_encode()
                distinct = chunks.dictionary.to_pylist()
                if len(known) > REMEMBER:
                    known.clear()
                new = sorted({MARK + c for c in distinct if c and c not in known})
                known.update(zip([w[1:] for w in new], trie_counts(new, scores, byte_score)))
                known[""] = (0, 0)
                each = np.array([known[c] for c in distinct], np.int64).reshape(-1, 2)[np.asarray(chunks.indices)]
                real = np.array([bool(c) for c in distinct], np.int64)[np.asarray(chunks.indices)]
                upto = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(np.column_stack([real, each]), axis=0)])
                totals.append(np.diff(upto[offsets - offsets[0]], axis=0))
            totals = np.concatenate(totals) if totals else np.zeros((0, 3), np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(totals[:, k].copy()) for k in range(3)]], names=schema.names)

    return docs.mapInArrow(run, schema)


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(spark, sf_dir):
    """op5: doc_id, n_pretokens, n_tokens, score."""
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    return count_tokens(docs, vocabulary_path()).select(
        "doc_id", F.col("_pretokens").alias("n_pretokens"), F.col("_tokens").alias("n_tokens"),
        (F.col("_score") / 1e6).alias("score"))
