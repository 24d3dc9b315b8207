"""Exact dedup by two passes over a Bloom filter of the text hashes.

Pass 1 counts how often each cell of the filter is hit and keeps the cells hit twice or more.
Pass 2 looks every row's cells up: a row with a cell hit only once has no copy and passes straight
through; only the others are shuffled and grouped by their SHA-256. A false positive costs a
shuffled row and is put right by the grouping.

The filter has `BITS_PER_ROW` cells a row, cut into slices of `SLICE_CELLS` by the hash, so that the
part that is broadcast at a time has a fixed bound (2**26 cells are at most 2**20 words of 64)
whatever the table's size. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationfield.llm.common import hot_join, packed, stored
from stationfield.session import scratch_path

BITS_PER_ROW = 16
SLICE_CELLS = 1 << 26


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _cells(sha: Column, slices: int) -> list[Column]:
    """Two cells, both in the slice of the hash."""
    base = F.pmod(F.xxhash64(sha), F.lit(slices)) * F.lit(SLICE_CELLS)
    return [base + F.pmod(F.xxhash64(sha, F.lit(i)), F.lit(SLICE_CELLS)) for i in (1, 2)]


def _repeated_cells(rows: DataFrame) -> DataFrame:
    """Pass 1: the cells hit at least twice, as words of 64 bits. Counts are added up before the shuffle."""
    hit = rows.select(F.explode(F.array("cell_1", "cell_2")).alias("cell")).groupBy("cell").count()
    return (
        hit.where("count >= 2")
        .groupBy(F.shiftright("cell", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(cell & 63 AS int)))").alias("bits"))
        .withColumn("slice", F.expr(f"word div {SLICE_CELLS // 64}"))
    )


def _flagged(rows: DataFrame, slices: int) -> DataFrame:
    """Pass 2: `rows` (row, sha, n) with `maybe`, true where a copy is possible. No shuffle of rows."""
    one, two = _cells(F.col("sha"), slices)
    rows = rows.withColumns({"cell_1": one, "cell_2": two, "slice": F.expr(f"pmod(xxhash64(sha), {slices})")})
    rows = stored(rows, "dedup-rows", "slice")
    words = stored(_repeated_cells(rows), "dedup-filter")
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "dedup-flagged")
    for k in range(slices):
        here = words.where(F.col("slice") == k).select("word", "bits")
        probed = rows.where(F.col("slice") == k).drop("slice")
        for i in ("1", "2"):
            look = F.broadcast(here.select(F.col("word").alias(f"word_{i}"), F.col("bits").alias(f"bits_{i}")))
            probed = probed.withColumn(f"word_{i}", F.shiftright(f"cell_{i}", 6)).join(look, f"word_{i}", "left")
        sure = F.lit(True)
        for i in ("1", "2"):
            bit = F.expr(f"getbit(bits_{i}, cast(cell_{i} & 63 AS int))")
            sure = sure & (F.coalesce(bit, F.lit(0)) == 1)
        out = probed.select("row", "sha", "n", sure.alias("maybe"))
        out.write.mode("append").option("compression", "zstd").partitionBy("maybe").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def _groups(rows: DataFrame, doc_id: Column) -> DataFrame:
    """Of rows that may repeat: size and the row that stays, a row for each text that does repeat."""
    best = F.max(F.struct(F.col("n").alias("n"), F.bitwise_not(doc_id).alias("flipped"))).alias("best")
    return (
        rows.groupBy("sha").agg(F.count("*").alias("group_size"), best).where("group_size > 1")
        .select("sha", "group_size", F.col("best.n").alias("keep_n"), F.bitwise_not("best.flipped").alias("keep_id"))
    )


def _rows(docs: DataFrame, text: str) -> tuple[DataFrame, int, int]:
    n_rows = docs.count()
    rows = packed(docs, sha=F.unhex(F.sha2(normal(F.col(text)), 256)), n=F.length(F.coalesce(F.col(text), F.lit(""))))
    return rows, n_rows, max(1, -(-n_rows * BITS_PER_ROW // SLICE_CELLS))


def copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 (of the text without white space).

    Null texts count as empty. The longest text stays (in code points), then the smallest doc_id;
    null ids come last. Of rows alike in text and doc_id, one is kept. An empty table gives no rows.
    """
    small = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows, n_rows, slices = _rows(small, "text")
    rows = _flagged(rows.withColumn("row", F.struct(F.col("row.doc_id").alias("doc_id"))), slices)
    rows = rows.select(F.col("row.doc_id").alias("doc_id"), "sha", "n", "maybe")
    single = rows.where("not maybe").withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    again = rows.where("maybe").select("doc_id", "sha", "n")
    merged = again.groupBy("sha", "n", "doc_id").agg(F.count("*").alias("times"))
    groups = stored(_groups(again, F.col("doc_id")), "dedup-groups")
    found = hot_join(merged, groups, "sha", "group_size", n_rows)
    found = found.select("*", F.posexplode(F.sequence(F.lit(1), F.col("times"))).alias("nth", "_"))
    lone = F.col("group_size").isNull()
    stays = (F.col("nth") == 0) & (lone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n"))))
    found = found.select(
        "doc_id", "sha", F.when(lone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), stays.alias("kept"),
    )
    columns = ["doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")]
    return single.select(columns).unionByName(found.select(columns))


def drop_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    rows, n_rows, slices = _rows(docs, text)
    rows = _flagged(rows, slices)
    again = rows.where("maybe").withColumn("doc_id", F.col(f"row.`{doc_id}`"))
    groups = stored(_groups(again.select("doc_id", "sha", "n"), F.col("doc_id")), "dedup-groups")
    found = hot_join(again.select("row", "doc_id", "sha", "n"), groups, "sha", "group_size", n_rows)
    lone = found.where(F.col("group_size").isNull()).select("row.*")
    first = found.where(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n")))
    return rows.where("not maybe").select("row.*").unionByName(lone).unionByName(
        first.dropDuplicates(["sha"]).select("row.*")
    )
