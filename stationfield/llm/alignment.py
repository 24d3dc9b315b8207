"""Which tokens of two tokenizers end together, and how often each pair of ids does so.

A is a byte-level BPE, B a piece model; A encodes a space and the text, B the text with the space
that it adds itself. Both spell the same bytes, so a token is an end in the same sequence. The ends
that both have are found by galloping: the shorter list of ends drives, each of its ends doubles
its way into the longer list until it is passed and is then searched by halving. The common
indices cut both lists into groups, and the differences of their ranks say how many tokens of A
and B a group holds.

Neither tokenizer joins what lies before white space to the white space, but for the few
characters that pieces of B have inside (here the carriage return). A text is therefore the sequence
of its units, white space with what follows, whose ends are common ends; each distinct unit of a
batch is encoded and aligned once, whatever its length.

Two ids can only be linked if the bytes of one end with those of the other. So there are at most
as many pairs as the tokens of both vocabularies have suffixes in the other one, some hundred
thousand whatever the size of the corpus (`Tokens.most_pairs`). That is what makes the table of counts
fit a broadcast; it is counted by Spark over all documents.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationfield.llm.common import by_batches, packed, stored, within

SPACE = "▁"
#: Characters with the Unicode property White_Space.
WHITE = "\t\n\v\f\r \x85\xa0  -     　"
#: A pair of ids is one number: the id of A times this, plus the id of B.
PAIR = 1 << 20
#: Units a worker remembers in each of two generations.
MEMORY_UNITS = 100_000
#: Units put into one text for A.
UNITS_AT_ONCE = 64
BATCH_ROWS = 400

_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The character that byte-level BPE writes for each byte: printable ones as they are, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def gallop(short: np.ndarray, long: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where each of `short` stands in the ascending `long`, or -1.

    Each looks from `first` to `last` (both included) only: steps double until its value is
    reached, then the last step is halved.
    """
    low, high, step = first - 1, last.copy(), np.ones(len(short), np.int64)
    at = np.flatnonzero(first <= last)
    while len(at):
        probe = np.minimum(low[at] + step[at], last[at])
        passed = long[probe] >= short[at]
        high[at[passed]] = probe[passed]
        on = ~passed & (probe < last[at])
        low[at[~passed]] = probe[~passed]
        step[at] *= 2
        at = at[on]
    at = np.flatnonzero(high - low > 1)
    while len(at):
        middle = (low[at] + high[at]) >> 1
        passed = long[middle] >= short[at]
        high[at[passed]], low[at[~passed]] = middle[passed], middle[~passed]
        at = at[high[at] - low[at] > 1]
    found = np.full(len(short), -1, np.int64)
    inside = np.flatnonzero(first <= last)
    hit = inside[long[high[inside]] == short[inside]]
    found[hit] = high[hit]
    return found


def common_ends(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices into the ends `a` and `b` where both have an end, in order.

    Both hold sequences one after another, of `n_a` and `n_b` ends each, and ascend over all of
    them. Of each sequence the shorter list drives.
    """
    start_a, start_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    out_a, out_b = [], []
    for drives_a in (True, False):
        which = np.flatnonzero((n_a <= n_b) == drives_a)
        (n, start, x), (m, other, y) = ((n_a, start_a, a), (n_b, start_b, b))[:: 1 if drives_a else -1]
        driver = np.repeat(start[which], n[which]) + within(n[which])
        first = np.repeat(other[which], n[which])
        at = gallop(x[driver], y, first, first + np.repeat(m[which], n[which]) - 1)
        hit = np.flatnonzero(at >= 0)
        mine, its = driver[hit], at[hit]
        out_a.append(mine if drives_a else its)
        out_b.append(its if drives_a else mine)
    index_a, index_b = np.concatenate(out_a), np.concatenate(out_b)
    order = np.argsort(index_a, kind="stable")
    return index_a[order], index_b[order]


#: What is known of a unit: numbers of ids of A and of B, the groups in writing, each closed by a
#: semicolon, and the linked pairs as 64-bit numbers.
Unit = tuple[int, int, bytes, bytes]


class Tokens:
    """Both tokenizers, with the bytes of each id."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for name, i in self.a.get_vocab(with_added_tokens=False).items():
            self.bytes_a[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        with open(path_b, "rb") as f:
            # the same model with normalizer_spec.add_dummy_prefix = false: units bring their own spaces
            self.b = SentencePieceProcessor(model_proto=f.read() + b"\x1a\x02\x18\x00")
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(_BYTE.fullmatch(x)[1], 16)]) if self.b.is_byte(i) else x.replace(SPACE, " ").encode() for i, x in enumerate(names)
        ]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        inner = {c for x in names for c in re.findall(f"(?<=[^{WHITE}])[{WHITE}]", x.replace(SPACE, " "))}
        joined = "".join(f"\\x{ord(c):02x}" for c in sorted(inner))
        more = f"(?:[{joined}][{WHITE}]*[^{WHITE}]*)*" if joined else ""
        kind = type(self.a.pre_tokenizer).__name__
        plain = kind == "ByteLevel" and self.a.normalizer is None
        self._plain = plain
        self._units = re.compile(f"[{WHITE}]*[^{WHITE}]+{more}|[{WHITE}]+" if plain else "(?s).+").findall
        # ids in writing with what follows them: a comma, or at the end of a group a bar (A) or a semicolon (B)
        written = [f"{i}{c}" for i in range(len(self.bytes_a)) for c in ",|"] + [f"{i}{c}" for i in range(len(self.bytes_b)) for c in ",;"]
        self._written = written
        self._written_size = np.array([len(x) for x in written], np.int64)
        self._young: dict[str, Unit | None] = {}
        self._old: dict[str, Unit | None] = {}

    def most_pairs(self) -> int:
        """How many pairs of ids can be linked at all: the bytes of one end with those of the other."""
        n = 0
        for mine, theirs, from_ in ((self.bytes_a, self.bytes_b, 0), (self.bytes_b, self.bytes_a, 1)):
            known: dict[bytes, int] = {}
            for x in theirs:
                known[x] = known.get(x, 0) + 1
            n += sum(known.get(x[k:], 0) for x in mine for k in range(from_, len(x)))
        return n

    def _ids_a(self, units: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A of all units one after another, and how many each has; `sizes` are the units' bytes.

        Units that end in other than white space can be encoded one after another in one text, as they stand in documents.
        """
        closed = [self._plain and u[-1] not in WHITE for u in units]
        order = [k for k, c in enumerate(closed) if c] + [k for k, c in enumerate(closed) if not c]
        n_closed = sum(closed)
        texts = ["".join([units[k] for k in order[a : min(a + UNITS_AT_ONCE, n_closed)]]) for a in range(0, n_closed, UNITS_AT_ONCE)]
        texts += [units[k] for k in order[n_closed:]]
        ids = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))
        order = np.array(order, np.int64)
        ends, wanted = np.cumsum(self.size_a[flat]), np.cumsum(sizes[order])
        last = np.searchsorted(ends, wanted)
        if len(wanted) and not (last[-1] < len(ends) and (ends[last] == wanted).all()):
            raise ValueError("tokenizer A joins bytes over the end of a unit, or leaves some out")
        stop = last + 1
        n = np.empty(len(units), np.int64)
        n[order] = np.diff(stop, prepend=0)
        start = np.empty(len(units), np.int64)
        start[order] = stop - n[order]
        return flat[np.repeat(start, n) + within(n)], n

    def _spells(self, spelled: list[bytes], sizes: np.ndarray, table: list[bytes], ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """For each unit whether the bytes of its ids are its own."""
        whole = b"".join(map(table.__getitem__, ids.tolist()))
        lengths = np.fromiter(map(len, map(table.__getitem__, ids.tolist())), np.int64, len(ids))
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(n)]
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        right = ends - starts == sizes
        if right.all() and whole == b"".join(spelled):
            return right
        return np.fromiter((whole[x:y] == u for x, y, u in zip(starts.tolist(), ends.tolist(), spelled, strict=True)), bool, len(spelled))

    def _aligned(self, units: list[str]) -> list[Unit | None]:
        """Distinct units encoded and aligned; None where the bytes of A or B are not those of the unit."""
        if not units:
            return []
        spelled = [u.encode() for u in units]
        sizes = np.fromiter(map(len, spelled), np.int64, len(units))
        a, n_a = self._ids_a(units, sizes)
        lists = self.b.encode(units, num_threads=1)
        n_b = np.fromiter(map(len, lists), np.int64, len(units))
        b = np.fromiter(chain.from_iterable(lists), np.int64, int(n_b.sum()))
        right = self._spells(spelled, sizes, self.bytes_a, a, n_a) & self._spells(spelled, sizes, self.bytes_b, b, n_b)
        if not right.all():
            a, b = a[np.repeat(right, n_a)], b[np.repeat(right, n_b)]
            n_a, n_b = np.where(right, n_a, 0), np.where(right, n_b, 0)
        in_a, in_b = common_ends(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), n_a, n_b)
        # tokens in the order in which they are written: by group, those of A before those of B
        closes_a, closes_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        closes_a[in_a], closes_b[in_b] = 1, 1
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        which = np.concatenate([2 * a + closes_a, 2 * len(self.bytes_a) + 2 * b + closes_b])[order]
        text = "".join(map(self._written.__getitem__, which.tolist())).encode()
        ends = np.concatenate([[0], np.cumsum(self._written_size[which])])[np.cumsum(n_a + n_b)].tolist()
        pairs = (a[in_a] * PAIR + b[in_b]).tobytes()
        links = (8 * np.searchsorted(in_a, np.cumsum(n_a))).tolist()
        out: list[Unit | None] = []
        at = link = 0
        for ok, i, j, end, to in zip(right.tolist(), n_a.tolist(), n_b.tolist(), ends, links, strict=True):
            out.append((i, j, text[at:end], pairs[link:to]) if ok else None)
            at, link = end, to
        return out

    def known(self, units: list[str]) -> list[Unit | None]:
        """Distinct units, looked up or aligned now. Those not met for a while are forgotten."""
        if len(self._young) > MEMORY_UNITS:
            self._old, self._young = self._young, {}
        young, old = self._young, self._old
        new = []
        for u in units:
            if u not in young:
                if u in old:
                    young[u] = old[u]
                else:
                    new.append(u)
        young.update(zip(new, self._aligned(new), strict=True))
        return [young[u] for u in units]

    def units_of(self, text: str | None) -> list[str]:
        return self._units(" " + text) if text else []


class _Codes(dict):
    """Numbers keys in the order in which they come."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


_tokens: dict[tuple[str, str], Tokens] = {}


def tokens_of(path_a: str, path_b: str) -> Tokens:
    if (path_a, path_b) not in _tokens:
        _tokens[path_a, path_b] = Tokens(path_a, path_b)
    return _tokens[path_a, path_b]


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model")


def align(docs: DataFrame, text: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """`row` (the whole row), the ids `a` and `b`, and `groups`: how many of each a group holds, in order.

    A text that is null or empty, or whose ids of A or B do not spell it (one with U+2581 for the
    space of B, say), has no tokens: three empty arrays.
    """
    paths = _paths(path_a, path_b)
    given = packed(docs, text=F.col(f"`{text}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(*paths)
        for batch in by_batches(batches, 100):
            rows: list[tuple[list, list, list]] = []
            for t in batch.column("text").to_pylist():
                units = tokens.units_of(t)
                codes = _Codes()
                places = [codes[u] for u in units]
                found = tokens.known(list(codes))
                a, b, groups = [], [], []
                if None not in found:
                    for group in b"".join([found[p][2] for p in places]).decode().split(";")[:-1]:
                        x, y = ([int(i) for i in side.split(",")] for side in group.split("|"))
                        a += x
                        b += y
                        groups.append((len(x), len(y)))
                rows.append((a, b, groups))
            kind = pa.list_(pa.struct([("n_a", pa.int32()), ("n_b", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                    pa.array([[{"n_a": i, "n_b": j} for i, j in r[2]] for r in rows], kind),
                ],
                ["row", "a", "b", "groups"],
            )

    return given.mapInArrow(run, f"row {given.schema['row'].dataType.simpleString()}, a array<int>, b array<int>, groups array<struct<n_a: int, n_b: int>>")


LINKED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>, times array<int>"


def links(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document: numbers of tokens and groups, the SHA-256 of the groups in writing, and its linked
    pairs of ids with how often each is linked there."""
    paths = _paths(path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(*paths)
        for batch in by_batches(batches, BATCH_ROWS):
            codes, lists = _Codes(), []
            for t in batch.column(1).to_pylist():
                lists.append([codes[u] for u in tokens.units_of(t)])
            found = tokens.known(list(codes))
            bad = np.fromiter((u is None for u in found), bool, len(found))
            if bad.any():
                lists = [[] if any(found[p] is None for p in places) else places for places in lists]
                found = [u or (0, 0, b"", b"") for u in found]
            n_a, n_b = (np.fromiter((u[k] for u in found), np.int64, len(found)) for k in (0, 1))
            n_groups = np.fromiter((len(u[3]) >> 3 for u in found), np.int64, len(found))
            keys = np.frombuffer(b"".join([u[3] for u in found]), np.int64)
            written = [u[2] for u in found]
            shas = [hashlib.sha256(b"".join([written[p] for p in places])[:-1]).hexdigest() if places else "" for places in lists]
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter(chain.from_iterable(lists), np.int64, int(lengths.sum()))
            ends = np.concatenate([[0], np.cumsum(lengths)])
            sums = [np.diff(np.concatenate([[0], np.cumsum(n[flat])])[ends]) for n in (n_a, n_b, n_groups)]
            each = n_groups[flat]
            names, numbers = np.unique(keys, return_inverse=True)
            link = numbers[np.repeat((np.cumsum(n_groups) - n_groups)[flat], each) + within(each)]
            row = np.repeat(np.arange(len(lists)), sums[2])
            both, times = np.unique(row * max(1, len(names)) + link, return_counts=True)
            bounds = pa.array(np.searchsorted(both, np.arange(len(lists) + 1) * max(1, len(names))), pa.int32())
            pairs = names[both % max(1, len(names))] if len(names) else both
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *[pa.array(s) for s in sums], pa.array(shas, pa.string()), pa.ListArray.from_arrays(bounds, pa.array(pairs, pa.int64())),
                    pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
                ],
                ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"],
            )

    given = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return given.mapInArrow(run, LINKED)


def pair_counts(linked: DataFrame) -> DataFrame:
    """Per linked pair of ids: `a`, `b`, `n` (links of all documents) and `best`: no other A id is linked to this B id more often."""
    counted = linked.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy("pairs").agg(F.sum("times").alias("n"))
    b = F.pmod(F.col("pairs"), F.lit(PAIR))
    counted = counted.select(F.floor(F.col("pairs") / F.lit(PAIR)).alias("a"), b.alias("b"), "n")
    return counted.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def digest(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document, nulls and repeated ids as rows of their own: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    Every common end ends one token of A and one of B, so there are as many links as groups.
    A document without tokens has zeros and ''; an empty table gives no rows.
    """
    linked = stored(links(docs, text, doc_id, path_a, path_b), "links")
    # as many rows as the two vocabularies allow at most, see above
    table = pair_counts(linked).toArrow()
    keys = table["a"].to_numpy() * PAIR + table["b"].to_numpy()
    order = np.argsort(keys)
    counts = table["n"].to_numpy()[order]
    best = table["best"].to_numpy()[order].astype(bool)
    known = docs.sparkSession.sparkContext.broadcast((keys[order], counts, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = known.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            at = np.searchsorted(keys, pairs.flatten().to_numpy())
            n = times.flatten().to_numpy().astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])
            totals = [np.diff(np.concatenate([[0], np.cumsum(x)])[bounds]) for x in (n * best[at], n * counts[at])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")], batch.column("n_groups"), *[pa.array(t, pa.int64()) for t in totals], batch.column("groups_sha256")],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return linked.mapInArrow(
        run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    )
