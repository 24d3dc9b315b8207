"""Repeated passages by minimizer groups of word windows, in place of prefix-partitioned suffix trees.

A suffix is what begins at a word; only its first 50 words matter here. Suffixes are dealt to
groups by a run of words, each group fits a task's memory, and in each the truncated suffixes are put in
order: what would be an inner node at depth 50 or more is a run of neighbours in that
order that agree in 50 words, found by doubling (order by 2, 4, 8, ... words). A node's windows are
repeats, of which the smallest document keeps its own.

To ship each word to few groups rather than 50, a window is not grouped by its first words but by
its least 25-word run (by hash, leftmost), which is the same run for equal windows and for most
neighbours: a row carries all windows that share it. Runs that occur in one text only cannot be
part of a repeat and are left out by counting first. A run found
more than `LONG_PREFIX` times is replaced by the hash of the whole 50 words, whose groups
need no more than the smallest document, added up before the shuffle. A text
gives each of its distinct windows once, with all places.

Runs and whole windows are told apart by 64-bit hashes, the words around a run by 32 bits each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationfield.llm.common import by_batches, gram_hashes, hot_join, parts, stored, within, word_hashes

WINDOW = 50
RUN = 25
LONG_PREFIX = 5_000
#: Rows (with their suffixes) in one task's subtrees.
TASK_ROWS = 20_000


def least_runs(words: np.ndarray, bounds: np.ndarray, window: int = WINDOW, run: int = RUN) -> tuple[np.ndarray, ...]:
    """For texts laid one after another: text, first window (within the text), number of windows, and
    hash of the run, for each row of neighbouring windows with the same least run."""
    grams = gram_hashes(words, run)
    width = window - run + 1
    n_windows = np.maximum(np.diff(bounds) - window + 1, 0)
    text = np.repeat(np.arange(len(n_windows)), n_windows)
    if not len(text):
        none = np.empty(0, np.int64)
        return none, none, none, none.view(np.uint64)
    first = np.cumsum(n_windows) - n_windows
    local = np.arange(len(text)) - first[text]
    start = bounds[:-1][text] + local
    views = np.lib.stride_tricks.sliding_window_view(grams, width)
    place = np.concatenate([start[a : a + 100_000] + views[start[a : a + 100_000]].argmin(axis=1) for a in range(0, len(start), 100_000)])
    turn = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    count = np.diff(np.append(turn, len(place)))
    return text[turn], local[turn], count, grams[place[turn]]


def joined_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _base(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [joined_words(t) for t in batch.column("text").to_pylist()]
            sha = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("hash"), batch.column("same"), pa.array(map(len, words), pa.int64()), pa.array(sha)],
                ["doc_id", "hash", "same", "n_words", "sha"],
            )

    return docs.mapInArrow(run, "doc_id bigint, hash bigint, same binary, n_words bigint, sha string")


def _runs(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, first, run) of all least runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_batches(batches, 1000):
            text, first, _, grams = least_runs(*word_hashes(batch.column("text")))
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("hash").take(at), pa.array(first.astype(np.int32)), pa.array(grams.view(np.int64))],
                ["doc_id", "hash", "first", "run"],
            )

    return docs.select("doc_id", "hash", "text").mapInArrow(run, "doc_id bigint, hash bigint, first int, run bigint")


def _suffixes(found: DataFrame, long: bool) -> DataFrame:
    """(doc_id, hash, text, places) to the rows at these places with their words; or to each text's distinct windows there, as hashes with their starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_batches(batches, 500):
            words, bounds = word_hashes(batch.column("text"))
            text, first, count, grams = least_runs(words, bounds)
            want = {(i, p["first"]) for i, places in enumerate(batch.column("places").to_pylist()) for p in places if p["long"] == long}
            keep = np.fromiter(((t, f) in want for t, f in zip(text.tolist(), first.tolist(), strict=True)), bool, len(text))
            text, first, count, grams = text[keep], first[keep], count[keep], grams[keep]
            start = bounds[:-1][text] + first
            names = ["doc_id", "hash"]
            if long:
                of, at = np.repeat(text, count), np.repeat(start, count) + within(count)
                whole = gram_hashes(words, WINDOW)[at]
                order = np.lexsort((at, whole, of))
                of, at, whole = of[order], at[order], whole[order]
                head = np.flatnonzero(np.concatenate([np.ones(min(len(of), 1), bool), (of[1:] != of[:-1]) | (whole[1:] != whole[:-1])]))
                starts = pa.ListArray.from_arrays(pa.array(np.append(head, len(of)), pa.int32()), pa.array((at - bounds[:-1][of]).astype(np.int32)))
                columns = [batch.column(c).take(pa.array(of[head])) for c in names] + [pa.array(whole[head].view(np.int64)), starts]
                yield pa.RecordBatch.from_arrays(columns, [*names, "window", "starts"])
            else:
                short = words.astype(np.uint32)
                cut = [short[a : a + n + WINDOW - 1].tobytes() for a, n in zip(start.tolist(), count.tolist(), strict=True)]
                columns = [batch.column(c).take(pa.array(text)) for c in names] + [pa.array(first.astype(np.int32)), pa.array(grams.view(np.int64)), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*names, "first", "run", "words"])

    kind = "doc_id bigint, hash bigint, window bigint, starts array<int>" if long else "doc_id bigint, hash bigint, first int, run bigint, words binary"
    return found.select("doc_id", "hash", "text", "places").mapInArrow(run, kind)


def deep_nodes(words: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """For each place the rank of its first `depth` words (an even number) among all places.

    Places of one rank hang below one node of at least that depth. Ranks near the end, where
    `depth` words do not follow, mean nothing.
    """
    rank, reach = words.astype(np.uint64), 1
    while reach < depth:
        step = min(reach, depth - reach)
        after = np.zeros_like(rank)
        after[:-step or None] = rank[step:]
        rank = np.unique((rank << np.uint64(32)) | after, return_inverse=True)[1].astype(np.uint64)
        reach += step
    return rank


def repeats_in(doc_id: np.ndarray, hash_: np.ndarray, first: np.ndarray, run: np.ndarray, words: list[bytes]) -> pd.DataFrame:
    """Of one task's rows: the windows that also begin in a smaller document, as (doc_id, hash, start, stop)."""
    lengths = np.fromiter((len(w) // 4 for w in words), np.int64, len(words))
    n_windows = lengths - WINDOW + 1
    row = np.repeat(np.arange(len(words)), n_windows)
    nth = within(n_windows)
    place = (np.cumsum(lengths) - lengths)[row] + nth
    rank = deep_nodes(np.frombuffer(b"".join(words), np.uint32))[place]
    whose = run[row].view(np.uint64)
    order = np.lexsort((rank, whose))
    new = np.concatenate([[True], (rank[order][1:] != rank[order][:-1]) | (whose[order][1:] != whose[order][:-1])])
    smallest = np.minimum.reduceat(doc_id[row][order], np.flatnonzero(new))[np.cumsum(new) - 1]
    again = np.zeros(len(row), bool)
    again[order] = doc_id[row][order] > smallest
    row, start = row[again], first[row[again]] + nth[again]
    if not len(row):
        return pd.DataFrame({"doc_id": [], "hash": [], "start": [], "stop": []}).astype({"doc_id": "int64", "hash": "int64", "start": "int32", "stop": "int32"})
    turn = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)])
    head = np.flatnonzero(turn)
    tail = np.append(head[1:], len(row)) - 1
    return pd.DataFrame(
        {
            "doc_id": doc_id[row[head]], "hash": hash_[row[head]],
            "start": start[head].astype(np.int32), "stop": (start[tail] + WINDOW).astype(np.int32),
        }
    )


def _short_repeats(rows: DataFrame, n_rows: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b for b in batches if len(b)]
        if got:
            p = pd.concat(got, ignore_index=True)
            yield repeats_in(p["doc_id"].to_numpy(), p["hash"].to_numpy(), p["first"].to_numpy(), p["run"].to_numpy(), p["words"].tolist())

    return rows.repartition(parts(n_rows, TASK_ROWS), "run").mapInPandas(run, "doc_id bigint, hash bigint, start int, stop int")


def _long_repeats(windows: DataFrame) -> DataFrame:
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"), F.count("*").alias("times"))
    met = hot_join(windows, least.where("times > 1"), "window", "times", windows.count()).where("doc_id > least")
    spans = F.transform("starts", lambda s: F.struct(s.alias("start"), (s + WINDOW).alias("stop")))
    return met.select("doc_id", "hash", spans.alias("spans"))


def _kept(found: DataFrame) -> DataFrame:
    """(doc_id, hash, text, gone) to doc_id, hash, n_removed, sha, kept: the text without the words gone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_batches(batches, 500):
            removed, sha, kept = [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                words = joined_words(text)
                stays = np.ones(len(words), bool)
                for g in gone:
                    stays[g["start"] : g["stop"]] = False
                left = b" ".join([words[i] for i in np.flatnonzero(stays)])
                removed.append(int((~stays).sum()))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode("utf-8", "surrogatepass"))
            columns = [batch.column("doc_id"), batch.column("hash"), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hash", "n_removed", "sha", "kept"])

    given = found.select("doc_id", "hash", "text", "gone")
    return given.mapInArrow(run, "doc_id bigint, hash bigint, n_removed bigint, sha string, kept string")


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", with_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and, on request, kept_text.

    Words are `[^\\x20\\x09-\\x0D]+`; a null text has none. A word goes if a window of 50 words over
    it also begins in a document with a smaller doc_id. Rows without a doc_id neither lose words
    nor take any from others; rows with one doc_id take none from each other. `kept_text` is null
    where nothing was removed (the text stays as it is).
    """
    given = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    given = given.withColumns({"hash": F.xxhash64("text"), "same": F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))})
    base = stored(_base(given), "repeat-base")
    n_docs = base.count()
    # a later copy of a whole text of 50 words or more loses all; only first ones are searched
    counted = base.where(f"doc_id IS NOT NULL AND n_words >= {WINDOW}")
    copies = stored(counted.groupBy("same").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")).where("copies > 1"), "repeat-copies")
    base = hot_join(base, copies, "same", "copies", n_docs).withColumn(
        "later", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    )
    runs = _runs(given.where("doc_id IS NOT NULL"))
    often = runs.groupBy("run").agg(F.min("hash").alias("low"), F.max("hash").alias("high"), F.count("*").alias("times"))
    often = stored(often.where("low < high").select("run", "times"), "repeat-runs")
    met = hot_join(runs, often, "run", "times", n_docs).where("times IS NOT NULL")
    places = met.groupBy("doc_id", "hash").agg(
        F.collect_set(F.struct("first", (F.col("times") > LONG_PREFIX).alias("long"))).alias("places")
    )
    first_ones = base.where("NOT later AND doc_id IS NOT NULL").select("doc_id", "hash").distinct()
    places = stored(places.join(first_ones, ["doc_id", "hash"]), "repeat-places")
    found = stored(given.select("doc_id", "hash", "text").join(places, ["doc_id", "hash"]), "repeat-texts")
    size = places.select(F.explode("places").alias("p")).groupBy("p.long").count().collect()
    n_rows = {r["long"]: r["count"] for r in size}
    gone = _short_repeats(_suffixes(found, False), n_rows.get(False, 0)).select("doc_id", "hash", F.array(F.struct("start", "stop")).alias("spans"))
    if n_rows.get(True):
        gone = gone.unionByName(_long_repeats(stored(_suffixes(found, True), "repeat-long")))
    gone = stored(gone, "repeat-gone").groupBy("doc_id", "hash").agg(F.flatten(F.collect_list("spans")).alias("gone"))
    cut = _kept(found.join(gone, ["doc_id", "hash"]))
    if not with_text:
        cut = cut.drop("kept")
    cut = stored(cut.dropDuplicates(["doc_id", "hash"]), "repeat-cut").withColumnRenamed("sha", "cut_sha")
    out = base.join(cut, ["doc_id", "hash"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    columns = [
        "doc_id", "n_words",
        F.when(F.col("later"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(F.col("later"), F.lit(nothing)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(F.when(F.col("later"), F.lit("")).otherwise(F.col("kept")).alias("kept_text"))
    return out.select(columns)
