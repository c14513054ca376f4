"""Shared helpers of the text operators.

Scratch tables go below ``spark.checkpoint.dir`` (written once, read back by the
next stage), so a lost executor costs one stage.  Python code in tasks works on
the UTF-8 buffers of Arrow batches, cut into pieces of bounded size.
"""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes of text that a task turns into numpy arrays at once.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_scratch(spark: SparkSession) -> None:
    """Local sessions without a checkpoint folder get one; a cluster must name its own."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="text-scratch-"))


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back."""
    spark = df.sparkSession
    ensure_scratch(spark)
    path = f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/text/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch where the session has Spark's default: whole texts pass, so 10,000 may be hundreds of MB.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the rows that a Python worker gets at once; a number that the session sets itself stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES):
    """Row ranges (i, j) of at most ``most`` bytes each; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def ascii_word_table(keep_case: bool = False) -> bytes:
    """Byte table for words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z:
    digits, a-z and all bytes from 0x80 stay, everything else is a space."""
    out = bytearray(b" " * 256)
    for c in range(0x30, 0x3A):
        out[c] = c
    for c in range(0x61, 0x7B):
        out[c] = c
        out[c - 32] = c - 32 if keep_case else c
    for c in range(0x80, 0x100):
        out[c] = c
    return bytes(out)


def lower_table() -> bytes:
    """Byte table that lower-cases A-Z and changes nothing else."""
    return bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


#: Keys that may be sent to every task to spare a shuffle of rows; beyond it, they are joined by one.
SEND = 2_000_000


def sent(keys: DataFrame) -> DataFrame:
    """``keys`` (one narrow column, written) marked for a broadcast while they are few."""
    return F.broadcast(keys.distinct()) if keys.count() <= SEND else keys


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names, so that extra columns cannot clash."""
    return df.select(*[F.col(f"`{c}`").alias(a) for a, c in columns.items()])


def unused(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` does not have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name, k = f"_{base}", 0
        while name.lower() in taken:
            k += 1
            name = f"_{base}_{k}"
        taken.add(name.lower())
        out.append(name)
    return out
