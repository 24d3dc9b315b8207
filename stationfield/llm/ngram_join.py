"""N-gram Jaccard join by signature trees.

A document is its set of 5-word shingles (as 64-bit hashes). Documents with equal sets are one
representative. Blocks of representatives that may be linked are compared by a signature tree: its
nodes hold the OR of their documents' token bitmaps and the range of their set sizes, and two
nodes are descended into together only while the largest overlap that their bitmaps and sizes
allow could still be a link. What is left at the leaves is intersected exactly.

Blocks. At a similarity of 0.75 or more, each of the tokens of the union of two sets, in the order
of their hashes, is common with a chance of 0.75 or more. A document is known by its `SKETCH`
smallest hashes; the first common one is in both sketches, except with a chance below
0.25 ** SKETCH (48: 1e-29), far below that of two shingles sharing a 64-bit hash, on which all
set comparisons rest. So all linked pairs share a sketch token, and a document joins the block
of the smallest document that has the token: near copies, which share most tokens, meet in few
blocks. Prefix filter: two whole sketches have `SPARE` + 1 tokens in common (fewer have a chance
below 1e-12), so both documents may leave out their `SPARE` most frequent tokens, in one order
for all; the rarest common token is left to both. Passages found in many documents thus bring
nobody into a block.

A block of more than `BLOCK_DOCS` documents is dealt to several tasks, each with the block's
first document. Documents that this did not connect to the first one's component (few, where the
block is a group of near copies) are then compared with every task's part of the block. Pairs
already connected are never compared again, so a group of copies costs a link for each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationfield.llm.common import by_batches, gram_hashes, hot_join, mixed, parts, stored, word_hashes
from stationfield.llm.components import components

SHINGLE = 5
SKETCH = 48
SPARE = 12
BLOCK_DOCS = 1000
#: Documents (with their sets) a task compares in all its blocks.
TASK_DOCS = 4000
LEAF = 8


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than a shingle are one together."""
    lowered = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    words, bounds = word_hashes(lowered)
    grams = gram_hashes(words, size)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(mixed(gram_hashes(words[a:b], b - a) ^ np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


SETS = "doc_id bigint, n_shingles bigint, same binary, sketch array<bigint>"


def sketches(docs: DataFrame, sketch: int = SKETCH) -> DataFrame:
    """Per document: set size, 128 bits that equal sets share, and the sketch. Ids and texts may be null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_batches(batches, 1000):
            sets = shingle_sets(batch.column("text"))
            n = [len(s) for s in sets]
            with np.errstate(over="ignore"):
                same = [np.array([s.sum(), mixed(s).sum()], np.uint64).tobytes() for s in sets]
            small = [s[:sketch].view(np.int64) for s in sets]
            bounds = np.concatenate([[0], np.cumsum([len(s) for s in small])]).astype(np.int32)
            tokens = np.concatenate([*small, np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.ListArray.from_arrays(bounds, tokens)],
                ["doc_id", "n_shingles", "same", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SETS)


def _memberships(firsts: DataFrame) -> DataFrame:
    """(doc_id, block): a block is named by its smallest document."""
    entries = firsts.select("doc_id", F.size("sketch").alias("n"), F.explode("sketch").alias("token"))
    tokens = stored(entries.groupBy("token").agg(F.min("doc_id").alias("block"), F.count("*").alias("times")).where("times > 1"), "join-tokens")
    n_entries = tokens.agg(F.sum("times")).first()[0] or 0
    shared = hot_join(entries, tokens, "token", "times", n_entries).where("block IS NOT NULL")
    # at most SKETCH entries each; the most frequent come first. A set smaller than its sketch
    # shares three quarters of its tokens and can spare one less than that.
    mine = shared.groupBy("doc_id", "n").agg(F.sort_array(F.collect_list(F.struct("times", "token", "block")), asc=False).alias("met"))
    spared = F.expr(f"filter(met, (x, i) -> i >= least({SPARE}, ceil(0.75 * n) - 1))")
    return mine.select("doc_id", F.explode(F.array_distinct(F.transform(spared, lambda x: x["block"]))).alias("block"))


class SignatureTree:
    """Documents by size, `LEAF` to a node, and as many nodes to the node above."""

    def __init__(self, sets: list[np.ndarray], component: np.ndarray) -> None:
        sizes = np.array([len(s) for s in sets])
        bits = 1 << max(8, min(13, int(2 * sizes.max(initial=1)).bit_length()))
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for row, s in enumerate(sets):
            bit = (s & np.uint64(bits - 1)).astype(np.int64)
            np.bitwise_or.at(maps[row], bit >> 6, np.uint64(1) << (bit & 63).astype(np.uint64))
        spare = sizes - np.bitwise_count(maps).sum(axis=1)  # tokens that share a bit with another
        self.levels = [(maps, sizes, sizes, spare, component)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, spare, one = self.levels[-1]
            at = np.arange(0, len(maps), LEAF)
            first, last = np.minimum.reduceat(one, at), np.maximum.reduceat(one, at)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                    np.maximum.reduceat(spare, at), np.where(first == last, first, -1),
                )
            )

    def _may_link(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of nodes may hold a link between two components."""
        maps, low, high, spare, one = self.levels[level]
        keep = (4 * high[i] >= 3 * low[j]) & (4 * high[j] >= 3 * low[i]) & ~((one[i] >= 0) & (one[i] == one[j]))
        i, j, at = i[keep], j[keep], np.flatnonzero(keep)
        most = np.bitwise_count(maps[i] & maps[j]).sum(axis=1) + np.minimum(spare[i], spare[j])
        most = np.minimum(most, np.minimum(high[i], high[j]))
        out = np.zeros(len(keep), bool)
        out[at[7 * most >= 3 * (low[i] + low[j])]] = True
        return out

    def pairs(self, level: int | None = None, i: np.ndarray | None = None, j: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of documents left by descending from the root against itself."""
        if level is None:
            level, i, j = len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64)
        for a in range(0, len(i), 4096):
            p, q = i[a : a + 4096], j[a : a + 4096]
            keep = self._may_link(level, p, q) if level else (p < q) & self._may_link(0, p, q)
            p, q = p[keep], q[keep]
            if not len(p):
                continue
            if level == 0:
                yield p, q
                continue
            below = len(self.levels[level - 1][0])
            child = np.arange(LEAF)
            x = (p[:, None, None] * LEAF + child[None, :, None]).repeat(LEAF, 2).ravel()
            y = (q[:, None, None] * LEAF + child[None, None, :]).repeat(LEAF, 1).ravel()
            there = (x < below) & (y < below) & (x <= y)
            yield from self.pairs(level - 1, x[there], y[there])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union of two sorted sets."""
    if 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 7 * common >= 3 * len(both)


def links_in(sets: list[np.ndarray], group: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect whatever the block's links connect. Documents of one `group` need none."""
    root = np.arange(len(sets))
    if group is not None:
        _, first, inverse = np.unique(group, return_index=True, return_inverse=True)
        root = first[inverse]

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return int(x)

    out = []

    def compare(x: int, y: int) -> None:
        p, q = find(x), find(y)
        if p != q and linked(sets[x], sets[y]):
            root[max(p, q)] = min(p, q)
            out.append((x, y))

    for k in range(1, len(sets)):
        compare(0, k)
    if len(sets) > 2:
        order = np.argsort([len(s) for s in sets], kind="stable")
        now = np.array([find(int(k)) for k in order])
        if len(set(now.tolist())) > 1:
            for p, q in SignatureTree([sets[k] for k in order], now).pairs():
                for x, y in zip(order[p].tolist(), order[q].tolist(), strict=True):
                    compare(x, y)
    return out


def _compared(members: DataFrame, n_members: int) -> DataFrame:
    """(block, cell, doc_id, component, tokens) to links (a, b). Cells are small; many share a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def links(cell: pd.DataFrame) -> pd.DataFrame:
            cell = cell.sort_values("doc_id", kind="stable")
            ids = cell["doc_id"].to_numpy()
            sets = [np.frombuffer(t, np.uint64) for t in cell["tokens"]]
            found = links_in(sets, cell["component"].to_numpy())
            return pd.DataFrame({"a": [ids[x] for x, _ in found], "b": [ids[y] for _, y in found]}, dtype="int64")

        held: list[pd.DataFrame] = []
        for batch in batches:
            rows = pd.concat([*held, batch], ignore_index=True) if held else batch
            last = (rows["block"] == rows["block"].iloc[-1]) & (rows["cell"] == rows["cell"].iloc[-1])
            held = [rows[last]]  # the next batch may go on with it
            done = [links(c) for _, c in rows[~last].groupby(["block", "cell"], sort=False) if len(c) > 1]
            if done:
                yield pd.concat(done)
        for rows in held:
            yield links(rows)

    dealt = members.repartition(parts(n_members, TASK_DOCS), "block", "cell").sortWithinPartitions("block", "cell")
    return dealt.mapInPandas(run, "a bigint, b bigint")


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, cells) to (doc_id, tokens, cells): the sets, made anew from the texts of wanted documents only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_batches(batches, 500):
            tokens = pa.array([s.tobytes() for s in shingle_sets(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), tokens, batch.column("cells")], ["doc_id", "tokens", "cells"])

    given = docs.select("doc_id", "text").join(wanted.hint("merge"), "doc_id")  # shuffled at any size
    kind = given.schema["cells"].dataType.simpleString()
    return given.select("doc_id", "text", "cells").mapInArrow(run, f"doc_id bigint, tokens binary, cells {kind}")


def _links_of(docs: DataFrame, cells: DataFrame, n_members: int) -> DataFrame:
    """(block, cell, doc_id, component) to links."""
    wanted = cells.groupBy("doc_id").agg(F.collect_set(F.struct("block", "cell", "component")).alias("cells"))
    members = _sets_of(docs, wanted).select("doc_id", "tokens", F.inline("cells"))
    return _compared(members, n_members)


def _links(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks (doc_id, block) to links that connect what the pairs of the blocks connect."""
    sizes = stored(blocks.groupBy("block").count().where("count > 1").withColumn("cells", F.ceil(F.col("count") / BLOCK_DOCS)), "join-sizes")
    n_all, large = sizes.agg(F.sum("count"), F.max("cells")).first()
    placed = hot_join(blocks, sizes, "block", "count", n_all or 0).where("cells IS NOT NULL")
    own = F.expr("IF(doc_id = block, sequence(0, cells - 1), array(pmod(xxhash64(doc_id), cells)))")
    cells = placed.select("block", "doc_id", F.explode(own).alias("cell"), F.col("doc_id").alias("component"))
    cells = stored(cells, "join-cells")
    links = stored(_links_of(docs, cells, cells.count()), "join-links")
    if (large or 0) < 2:
        return links
    # large blocks: those not yet with the block's first document against every part of the block
    labels = components(links)
    big = placed.where("cells > 1").select("block", "doc_id", "cells")
    known = big.join(labels, big["doc_id"] == labels["node"], "left").select(
        "block", "doc_id", "cells", F.coalesce("label", "doc_id").alias("component")
    )
    first = labels.select(F.col("node").alias("block"), F.col("label").alias("main"))
    known = stored(known.join(first, "block", "left").withColumn("main", F.coalesce("main", "block")), "join-large")
    rest = known.where("component <> main")
    slices = rest.groupBy("block").agg(F.ceil(F.count("*") / BLOCK_DOCS).alias("slices"))
    here = known.join(slices, "block")
    part, piece = F.expr("pmod(xxhash64(doc_id), cells)"), F.expr("pmod(xxhash64(doc_id, 1), slices)")
    base = here.select("block", "doc_id", "component", part.alias("part"), F.explode(F.expr("sequence(0, slices - 1)")).alias("slice"))
    added = here.where("component <> main").select("block", "doc_id", "component", F.explode(F.expr("sequence(0, cells - 1)")).alias("part"), piece.alias("slice"))
    again = base.unionByName(added).withColumn("cell", F.expr("part * 1000000 + slice")).select("block", "cell", "doc_id", "component").distinct()
    again = stored(again, "join-cells")
    return links.unionByName(stored(_links_of(docs, again, again.count()), "join-links"))


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id it is linked to, over any number of links).

    A text that is null or has no words has an empty set and stays by itself. Rows without a
    doc_id are linked with nothing. Rows with one doc_id are one document.
    """
    docs = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = stored(sketches(docs), "join-sketches")
    joined = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = stored(joined.groupBy("same").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "join-same")
    firsts = joined.join(same.select("same", F.col("first").alias("doc_id")), ["same", "doc_id"]).dropDuplicates(["doc_id", "same"])
    blocks = stored(_memberships(firsts.select("doc_id", "sketch")), "join-blocks")
    links = _links(docs, blocks)
    # a document given with two texts ties both classes together
    copied = hot_join(joined.select("doc_id", "same"), same.where("copies > 1"), "same", "copies", rows.count())
    ties = copied.where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    labels = components(links.unionByName(ties))
    out = rows.select("doc_id", "n_shingles").join(
        labels.select(F.col("node").alias("doc_id"), F.col("label").alias("component_id")), "doc_id", "left"
    )
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that are alone in their class or the first of it, with all columns."""
    found = classes(docs, text, doc_id).where("doc_id <> component_id").select(F.col("doc_id").alias("_later")).distinct()
    return docs.join(found, docs[f"`{doc_id}`"].cast("bigint") == found["_later"], "left_anti")
