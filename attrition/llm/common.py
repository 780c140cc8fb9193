"""Helpers shared by the operators: narrow inputs, hash splits, byte views of Arrow text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.session import materialize
from attrition.sources.tables import table_path

__all__ = ["materialize", "documents", "crc_mod", "read", "chunks", "text_bytes", "table_width", "head_floor",
           "lowered", "word_keys", "END_WORD", "ODD", "MIX"]

#: Text that a task turns into arrays at once; they hold some hundred bytes for each of it.
CHUNK_BYTES = 1 << 19
#: Key that no word has; stands for the end of a text among words.
END_WORD = 0
#: Odd multipliers that spread 64-bit hashes.
ODD = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the columns an operator uses, so that extra columns of the input cannot clash."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def head_floor(counts: DataFrame, column: str, limit: int) -> int:
    """Least power of two such that at most ``limit`` rows have ``column`` of that size or more.

    The rows from there up are a head of proven size; one row per power of two is collected."""
    sizes = (counts.where(F.col(column) > 0).groupBy(F.floor(F.log2(column)).cast("int").alias("power"))
             .agg(F.count("*").alias("n")).collect())
    room, floor = limit, 62
    for row in sorted(sizes, key=lambda r: -r["power"]):
        if row["n"] > room:
            break
        room -= row["n"]
        floor = row["power"]
    return 1 << floor


def table_width(spark) -> int:
    """Shuffle partitions of the session, the unit in which intermediate tables are dealt."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and its len+1 offsets; null is empty."""
    import pyarrow as pa

    column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], wide)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if buffers[2] is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batch, column: str = "text", limit: int = CHUNK_BYTES):
    """Slices of a record batch of about ``limit`` bytes of text each; a text is never cut."""
    _, offsets = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def lowered(part) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a batch's texts with A-Z in lower case."""
    data, offsets = text_bytes(part.column("text"))
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    return low, offsets


def word_keys(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, owner) of every word: runs of bytes other than 0x20 and 0x09-0x0D within a text."""
    if not len(low):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    space = (low == 32) | ((low >= 9) & (low <= 13))
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    begins = np.flatnonzero(~space & (edge[:-1] | np.r_[True, space[:-1]]))
    ends = np.flatnonzero(~space & (edge[1:] | np.r_[space[1:], True])) + 1
    mixed = (low.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX)
    mixed ^= mixed >> np.uint64(31)
    power = np.cumprod(np.full(len(low), ODD, np.uint64))
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(mixed * power, out=total[1:])
    # The sum over a word starts at some power of the odd number; its inverse moves it to one place.
    inverse = np.cumprod(np.full(len(low), pow(ODD, -1, 1 << 64), np.uint64))
    key = (total[ends] - total[begins]) * inverse[begins]
    key = (key ^ (key >> np.uint64(32))) * np.uint64(MIX)
    key[key == END_WORD] = 1
    return key.view(np.int64), np.searchsorted(offsets, begins, side="right") - 1
