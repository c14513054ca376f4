"""Cost-balanced packing of token ids into sequences.

A document is the ids of its text (``tokenizers``, no special tokens) and the end
id.  Its estimated cost is linear plus quadratic in its length (attention looks
at pairs).  Each task takes its documents in pools of ``pool`` tokens, cut at a
multiple of the sequence length, so that no sequence of a pool is padded; what a
partition has left goes to sequences whose lengths are powers of two.  Within a
pool the documents are assigned in descending order, each to the sequence of the
lowest cost so far with room for it.  Only when none has room is a document cut:
the cheapest sequence with any room takes what fits.  Documents longer than a
sequence are cut into whole sequences first.

No row is shuffled: a pool holds hundreds of sequences, so balancing inside it is
balancing over all of them, and a lost task is repeated from its scan partition.
"""

from __future__ import annotations

import heapq
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import pick, pieces, table, utf8_column

CAPACITY, END_ID = 4096, 2
POOL = 1 << 20
#: Cost of a piece of n tokens: n + QUADRATIC * n * n.
QUADRATIC = 1 / 12288
#: Text that is split and looked up at once, and chunks that a task remembers.
TEXT_BYTES, REMEMBER = 2 << 20, 200_000


class ChunkEncoder:
    """Token ids of texts by way of their distinct chunks.

    The tokenizer lower-cases, drops white space and never joins a letter with other
    signs but the apostrophe.  So a text's ids are its chunks' ids in order, where
    chunks end at ASCII white space and between a letter (up to U+017F) and ASCII
    punctuation other than the apostrophe.  Each distinct chunk is encoded once;
    chunks that are one word share calls, as their last id marks a word's end.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        words = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True
        letter, sign = np.zeros(256, bool), np.zeros(256, bool)
        letter[[*range(65, 91), *range(97, 123)]] = True
        sign[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
        self.letter, self.sign = letter, sign
        self.lead = np.zeros(256, bool)
        self.lead[0xC3:0xC6] = True
        self.upper = np.zeros(256, np.uint8)
        self.upper[65:91] = 32
        self.plain = np.zeros(256, bool)  # what may follow a letter that is lower-cased here: no combining mark
        self.plain[:128] = True
        self.plain[0xC3:0xC6] = True
        self.forget()

    def forget(self):
        self.known, self.used = {}, 0
        self.flat = np.empty(1 << 16, np.uint16)
        self.start, self.size = np.empty(1 << 14, np.int32), np.empty(1 << 14, np.int32)

    def _ids(self, chunks):
        """Ids of the chunks in a row and their numbers."""
        whole = [c for c in chunks if c.isascii() and c.isalpha()]
        if len(whole) < len(chunks):
            other = [c for c in chunks if not (c.isascii() and c.isalpha())]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
        else:
            other, found = [], []
        lines = [" ".join(whole[k:k + 1000]) for k in range(0, len(whole), 1000)]
        parts = [np.array(e.ids, np.uint16) for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.concatenate([*parts, np.fromiter((i for x in found for i in x), np.uint16)])
        ends = np.flatnonzero(self.ends[ids[:sum(map(len, parts))]])
        assert len(ends) == len(whole)
        sizes = np.concatenate([np.diff(np.concatenate([[-1], ends])), np.fromiter(map(len, found), np.int64, len(found))])
        return whole + other, ids, sizes

    def _learn(self, chunks):
        known = self.known
        new = [c for c in chunks if c not in known]
        if not new:
            return
        new, ids, sizes = self._ids(new)
        n, total = len(known), len(ids)
        while n + len(new) > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used:self.used + total] = ids
        self.size[n:n + len(new)] = sizes
        self.start[n:n + len(new)] = self.used + np.cumsum(sizes) - sizes
        self.used += total
        known.update(zip(new, range(n, n + len(new))))

    def _cut(self, data, off):
        """The texts lower-cased and with a space at every chunk's end inside them."""
        if not len(data):
            return data, off
        after = np.append(data[1:], np.uint8(0x20))
        data = data + self.upper[data] * self.plain[after]
        pair = self.lead[data[:-1]]
        tail = np.concatenate([[False], pair]) & ~((np.concatenate([[0], data[:-1]]) == 0xC3) & ((data == 0x97) | (data == 0xB7)))
        letter, sign = self.letter[data], self.sign[data]
        begins = letter | (np.append(pair, False) & np.append(tail[1:], False))
        cut = np.flatnonzero(((letter | tail)[:-1] & sign[1:]) | (sign[:-1] & begins[1:])) + 1
        here = np.zeros(len(data) + 1, np.int32)
        here[cut] = 1
        moved = np.cumsum(here, dtype=np.int32)
        out = np.full(len(data) + len(cut), 0x20, np.uint8)
        kept = np.ones(len(out), bool)
        kept[cut + np.arange(len(cut))] = False
        out[kept] = data
        return out, off + moved[off] - here[off]

    def __call__(self, data: np.ndarray, off: np.ndarray):
        """Ids of all texts in a row (uint16) and the number of ids of each text."""
        data, off = self._cut(data, off)
        texts = pa.Array.from_buffers(pa.large_string(), len(off) - 1,
                                      [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)])
        split = pc.ascii_split_whitespace(texts)
        offsets = np.asarray(split.offsets)
        chunks = split.values.dictionary_encode()
        distinct = chunks.dictionary.to_pylist()
        if len(self.known) > REMEMBER:
            self.forget()
        self._learn([c for c in distinct if c])
        self.known.setdefault("", -1)
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int32, len(distinct))
        del self.known[""]
        size_of, start_of = np.append(self.size, np.int32(0)), np.append(self.start, np.int32(0))
        which = np.asarray(chunks.indices)
        size = size_of[number][which]
        upto = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        at = np.repeat((start_of[number][which] - upto[:-1]).astype(np.int32), size)
        at += np.arange(len(at), dtype=np.int32)
        return self.flat[at], np.diff(upto[offsets])


def assign(lengths, capacities, quadratic: float = QUADRATIC):
    """Pieces (document, start, length, sequence) that fill ``capacities`` exactly.

    The capacities' sum is the lengths' sum.  Ties go to the earlier document and sequence.
    """
    most = max(capacities, default=0)
    room = np.array(capacities, np.int64)
    cost = np.zeros(len(room))
    work, out = [], []

    def put(doc, start, n, s):
        room[s] -= n
        cost[s] += n + quadratic * n * n
        out.append((doc, start, n, s))

    for d, n in enumerate(lengths):
        start = 0
        while n - start > most:
            work.append((-most, d, start))
            start += most
        if n > start:
            work.append((start - n, d, start))
    heapq.heapify(work)
    while work:
        minus, d, start = heapq.heappop(work)
        n = -minus
        fits = np.flatnonzero(room >= n)
        if len(fits):
            put(d, start, n, int(fits[np.argmin(cost[fits])]))
            continue
        some = np.flatnonzero(room > 0)
        s = int(some[np.argmin(cost[some])])
        k = int(room[s])
        put(d, start, k, s)
        heapq.heappush(work, (k - n, d, start + k))
    return out


def power_parts(n: int) -> list[int]:
    """Powers of two that sum to n, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, pool: int = POOL, quadratic: float = QUADRATIC, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids.

    ``capacity`` is a power of two.  Null and empty texts are the end id alone.
    Rows that repeat an id are packed each; their pieces carry the same id.  Very
    long texts are cut over sequences.  An empty table gives an empty result.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    kind = docs.schema[id_col].dataType.simpleString()
    pool = max(1, pool // capacity) * capacity

    def run(batches):
        encode = ChunkEncoder(tokenizer)
        base, made = TaskContext.get().partitionId() << 32, 0
        held, waiting = [], 0  # [id, ids, first id's place, ids of the whole document]
        id_type = None

        def flush(docs, capacities):
            nonlocal made
            parts = assign([len(x[1]) for x in docs], capacities, quadratic)
            parts.sort(key=lambda p: (p[3], p[0], p[1]))
            at, rows = {}, []
            for d, start, n, s in parts:
                name, ids, before, total = docs[d]
                piece = ids[start:start + n]
                rows.append((name, before + start, n, zlib.crc32(piece.tobytes()), total, base + made + s, at.get(s, 0), piece))
                at[s] = at.get(s, 0) + n
            made += len(capacities)
            cols = list(zip(*rows))
            arrays = [pa.array(cols[0], id_type), *[pa.array(c, pa.int64()) for c in cols[1:7]]]
            if with_ids:
                upto = np.concatenate([[0], np.cumsum([len(p) for p in cols[7]])]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(upto), pa.array(np.concatenate(cols[7]).astype(np.int32))))
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for b in batches:
            id_type = b.schema.field(0).type
            data, off = utf8_column(b.column(1))
            for i, j in pieces(off, TEXT_BYTES):
                ids, counts = encode(data[off[i]:off[j]], off[i:j + 1] - off[i])
                ids = ids.astype(np.uint32)
                cut = np.concatenate([[0], np.cumsum(counts)])
                for k, name in enumerate(b.column(0).slice(i, j - i).to_pylist()):
                    own = np.append(ids[cut[k]:cut[k + 1]], np.uint32(end_id))
                    held.append((name, own, 0, len(own)))
                    waiting += len(own)
                    while waiting >= pool:
                        name, own, before, total = held[-1]
                        rest = waiting - pool
                        if rest:
                            held[-1] = (name, own[:len(own) - rest], before, total)
                        yield flush(held, [capacity] * (pool // capacity))
                        held = [(name, own[len(own) - rest:], before + len(own) - rest, total)] if rest else []
                        waiting = rest
        if waiting:
            yield flush(held, [capacity] * (waiting // capacity) + power_parts(waiting % capacity))

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in names[1:7]) + ", ids array<int>" * with_ids
    return pick(docs, id=id_col, text=text_col).mapInArrow(run, schema)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(spark, sf_dir):
    """op4: one row per piece, without the ids themselves."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


