"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad. A line's features are its own and those of the lines before and after
it. Training maximises the likelihood of labelled documents, whose lines all carry the document's
label, by gradients from the forward-backward algorithm. A document's score is the mean of its
lines' marginal probabilities of being good, weighted by their lengths.

The model is fitted on the driver from the features, not the texts, of a bounded sample of
labelled documents; scoring is one pass over all whole texts without a shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationfield.llm.common import by_batches, packed

#: Labelled documents to learn from, and lines of each: of a longer one a run of so many lines, its place by hash.
SAMPLE_DOCS = 2000
SAMPLE_LINES = 80
ROUNDS = 120
THRESHOLD = 0.3

# Character classes by UTF-8 byte.
LOWER, UPPER, DIGIT, SPACE, STOP, MARK, BAR, SHOUT, WIDE = range(9)
_CLASS = np.full(256, MARK, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = LOWER
_CLASS[ord("A") : ord("Z") + 1] = UPPER
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_CLASS[[9, 11, 12, 13, 32]] = SPACE
_CLASS[[ord(c) for c in ".,;:'\"()-?"]] = STOP
_CLASS[ord("|")] = BAR
_CLASS[ord("!")] = SHOUT
_CLASS[128:] = WIDE

N_LINE = 17


def line_features(lines: list[str]) -> np.ndarray:
    """A row of numbers, all between 0 and about 1, for each line of one document."""
    out = np.zeros((len(lines), N_LINE))
    times = Counter(lines)
    for i, line in enumerate(lines):
        data = np.frombuffer(line.encode("utf-8", "surrogatepass"), np.uint8)
        words = line.split()
        n, n_words = max(1, len(data)), max(1, len(words))
        share = np.bincount(_CLASS[data], minlength=9) / n
        most = Counter(words).most_common(1)[0][1] if words else 0
        next_same = sum(a == b for a, b in zip(words, words[1:]))
        out[i, :9] = share
        out[i, 9:] = (
            1.0,
            min(1.0, np.log1p(len(words)) / 6),
            1 - len(set(words)) / n_words,
            most / n_words if len(words) > 3 else 0.0,
            next_same / n_words,
            (times[line] - 1) / len(lines),
            min(2.0, len(data) / n_words / 10),
            float(line.rstrip()[-1:] in tuple(".?!")) if words else 0.0,
        )
    return out


def with_neighbours(x: np.ndarray) -> np.ndarray:
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    return np.hstack([x, before, after])


def lines_of(text: str | None) -> list[str]:
    """Lines with words in them; a text without any has one empty line."""
    return [x for x in (text or "").split("\n") if x.strip()] or [""]


@dataclass
class Chain:
    """Weights of a line's being good (1) rather than bad (0), and of a line following another."""

    weights: np.ndarray
    steps: np.ndarray  # [from, to]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(lean: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once, longest first.

    `lean` [chain, line] is the weight of good. Gives P(good) by line, the expected number of
    each step by chain, and the log of each chain's sum.
    """
    n, t_most = lean.shape
    node = np.stack([np.zeros_like(lean), lean], axis=2)
    ahead, back = np.zeros((n, t_most, 2)), np.zeros((n, t_most, 2))
    ahead[:, 0] = node[:, 0]
    alive = [int((lengths > t).sum()) for t in range(t_most + 1)]
    for t in range(1, t_most):
        k = alive[t]
        ahead[:k, t] = node[:k, t] + _log_sum(ahead[:k, t - 1, :, None] + steps, 1)
    for t in range(t_most - 2, -1, -1):
        k = alive[t + 1]
        back[:k, t] = _log_sum(steps + (node[:k, t + 1] + back[:k, t + 1])[:, None, :], 2)
    total = _log_sum(ahead[np.arange(n), lengths - 1], 1)
    good = np.exp(ahead[:, :, 1] + back[:, :, 1] - total[:, None])
    pairs = np.zeros((n, 2, 2))
    for t in range(1, t_most):
        k = alive[t]
        both = ahead[:k, t - 1, :, None] + steps + (node[:k, t] + back[:k, t])[:, None, :]
        pairs[:k] += np.exp(both - total[:k, None, None])
    return good, pairs, total


def _laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order (longest first), padded features, lengths."""
    lengths = np.array([len(d) for d in docs])
    order = np.argsort(-lengths, kind="stable")
    x = np.zeros((len(docs), int(lengths.max(initial=1)), docs[0].shape[1]))
    for row, i in enumerate(order):
        x[row, : lengths[i]] = docs[i]
    return order, x, lengths[order]


def fit(docs: list[np.ndarray], labels: list[int], rounds: int = ROUNDS, decay: float = 1e-3) -> Chain:
    """Gradient ascent (Adam) on the mean log likelihood of a document, less a little for large weights.

    Without documents of both labels, every line is as likely good as bad.
    """
    size = 3 * N_LINE
    if len(set(labels)) < 2:
        return Chain(np.zeros(size), np.zeros((2, 2)))
    order, x, lengths = _laid_out(docs)
    y = np.array(labels)[order]
    there = np.arange(x.shape[1]) < lengths[:, None]
    theta = np.zeros(size + 4)
    speed, spread = np.zeros_like(theta), np.zeros_like(theta)
    seen = np.zeros((len(y), 2, 2))
    seen[np.arange(len(y)), y, y] = lengths - 1
    each = 1.0 / lengths  # a long document counts as one
    for k in range(1, rounds + 1):
        good, pairs, _ = marginals(x @ theta[:size], lengths, theta[size:].reshape(2, 2))
        miss = np.where(there, y[:, None] - good, 0.0) * each[:, None]
        slope = np.concatenate(
            [np.einsum("nt,ntf->f", miss, x), ((seen - pairs) * each[:, None, None]).sum(0).ravel()]
        ) / len(y) - decay * theta
        speed = 0.9 * speed + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        theta = theta + 0.15 * (speed / (1 - 0.9**k)) / (np.sqrt(spread / (1 - 0.99**k)) + 1e-8)
    return Chain(theta[:size], theta[size:].reshape(2, 2))


def score(texts: list[str | None], chain: Chain) -> np.ndarray:
    """0 to 1 for each text, higher for better."""
    lines = [lines_of(t) for t in texts]
    out = np.zeros(len(texts))
    # chains of like length together: the padded array stays small whatever the longest text is
    order = sorted(range(len(texts)), key=lambda i: -len(lines[i]))
    at = 0
    while at < len(order):
        take = max(1, min(256, 20_000 // len(lines[order[at]])))
        some = order[at : at + take]
        at += take
        _, x, lengths = _laid_out([with_neighbours(line_features(lines[i])) for i in some])
        good, _, _ = marginals(x @ chain.weights, lengths, chain.steps)
        for row, i in enumerate(some):
            weight = np.array([len(s) + 1.0 for s in lines[i]])
            out[i] = float((good[row, : len(weight)] * weight).sum() / weight.sum())
    return np.clip(out, 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE_DOCS) -> Chain:
    """A chain from at most `sample` labelled documents that are not held out, chosen by hash."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    picked = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id")).limit(sample)
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    given = given.join(F.broadcast(picked), "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("quality"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, t, q in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                x = line_features(lines_of(t)).astype(np.float32)
                at = zlib.crc32(str(i).encode()) % max(1, len(x) - SAMPLE_LINES + 1)
                x = x[at : at + SAMPLE_LINES]
                rows.append((i, q, len(x), x.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 4, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                ["doc_id", "quality", "n_lines", "features"],
            )

    # ids that repeat may give more rows than the sample has; which stay is decided by their content
    rows = given.mapInArrow(featured, "doc_id bigint, quality int, n_lines int, features binary")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("features"), "n_lines").limit(sample).collect()
    rows.sort(key=lambda r: (r.doc_id, r.features))
    docs_x = [with_neighbours(np.frombuffer(r.features, np.float32).reshape(r.n_lines, N_LINE).astype(float)) for r in rows]
    return fit(docs_x, [r.quality for r in rows])


def scored(docs: DataFrame, chain: Chain, text: str = "text", **columns) -> DataFrame:
    """`row` (the whole row), `score`, and the given columns. Null texts score as empty ones."""
    given = packed(docs, text=F.col(f"`{text}`"), **columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_batches(batches, 1000):
            names = [n for n in batch.schema.names if n != "text"]
            values = pa.array(score(batch.column("text").to_pylist(), chain), pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], values], [*names, "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name != "text"]
    return given.mapInArrow(run, ", ".join([*fields, "score double"]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    small = docs.select("doc_id", "text")
    out = scored(small, learn(small, labels)).select(F.col("row.doc_id").alias("doc_id"), "score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` with a score of at least the threshold, with all their columns."""
    return scored(docs, learn(docs, labels, text), text).where(F.col("score") >= THRESHOLD).select("row.*")
