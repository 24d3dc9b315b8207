"""What several operators need: words, hashes, shared tables, and rows kept whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationfield.session import scratch_path

ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, *partitions: str) -> DataFrame:
    """Write `df` to the shared folder, in compact form, and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """The whole row in one column `row`, beside the named ones: no names can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in columns.items()])


def parts(n_rows: int, rows_each: int) -> int:
    """So many partitions that each has about `rows_each` rows."""
    return max(1, -(-n_rows // rows_each))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values, each scrambled so that any bits of the result can be used alone."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_hashes(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of the UTF-8 bytes of each value of a string array without nulls."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values.cast(pa.binary()).to_pylist()), np.uint64, len(values))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of all texts, one after another, and where each text's begin.

    Null texts have no words. The second value has one entry more than there are texts.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    words, bounds = lists.values, lists.offsets.to_numpy().astype(np.int64)
    words = words.slice(int(bounds[0]), int(bounds[-1] - bounds[0]))
    bounds = bounds - bounds[0]
    full = pc.not_equal(words, "")
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), before[bounds]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and where each text's words begin."""
    words, bounds = split_words(texts)
    coded = words.dictionary_encode()
    if not len(words):
        return np.empty(0, np.uint64), bounds
    return byte_hashes(coded.dictionary)[coded.indices.to_numpy()], bounds


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words; one entry for each start, none past the last."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * ODD + words[i : i + n]
    return mixed(out)


def by_batches(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, copied: kernels need not know of slices."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.take(pa.array(range(start, min(start + rows, batch.num_rows))))


#: A key with more than this part of all rows is hot: there are fewer than 1000 of them.
HOT_PART = 1000


def hot_join(rows: DataFrame, side: DataFrame, key: str, count: str, n_rows: int) -> DataFrame:
    """`rows` left-joined with `side`, which has one row for each key and how many `rows` it meets.

    Keys that meet a large part of the rows, few by construction, are broadcast; the others are
    joined by a shuffle, in which no key is large.
    """
    hot = F.broadcast(side.where(F.col(count) > n_rows / HOT_PART))
    cold = side.where(F.col(count) <= n_rows / HOT_PART)
    others = rows.join(hot.select(key), key, "left_anti").join(cold, key, "left")
    return rows.join(hot, key).unionByName(others)


def within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each length, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)
