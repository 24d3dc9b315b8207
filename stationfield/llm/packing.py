"""Documents as token ids, packed into sequences by best fit decreasing.

A document longer than a sequence is first cut into full windows. What is left of each goes, in
order of falling length, into the open window with the least room that still holds it; a segment
tree over the possible rooms finds it. Pieces are dealt to tasks of bounded size by a hash; each
task packs its own, and fills its windows to all but a few.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationfield.llm.common import by_batches, parts, split_words, stored, within

WINDOW = 2048
END_ID = 1
#: Pieces one task packs.
TASK_PIECES = 50_000
#: Words a worker remembers in each of two generations.
MEMORY_WORDS = 200_000
#: Runs put into one text.
RUNS_AT_ONCE = 64
#: Fixed value: how the vocabulary marks the end of a word.
WORD_END = "</w>"

_CLOSING = "!#$%&*,.:;?|"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_ALL_LETTERS = "".join(filter(re.compile(f"[{_LETTERS}]").match, map(chr, range(256))))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Token ids of words, each encoded once. White space ends a token, so words can be encoded alone."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        vocabulary = self._tokenizer.get_vocab()
        self._closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self._closes[[i for name, i in vocabulary.items() if name.endswith(WORD_END)]] = True

    def _encode_runs(self, runs: list[str]) -> list[tuple[int, ...]]:
        """Runs of letters or of punctuation, each of which is one word to the tokenizer: many in one
        text, cut after the ids that end a word."""
        if not runs:
            return []
        texts = [" ".join(runs[a : a + RUNS_AT_ONCE]) for a in range(0, len(runs), RUNS_AT_ONCE)]
        encoded = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = [i for ids in encoded for i in ids]
        ends = (np.flatnonzero(self._closes[np.array(flat, np.int64)]) + 1).tolist()
        if len(ends) != len(runs):  # a run of several words, to this tokenizer
            return self._encode(runs)
        return [tuple(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _encode(self, words: list[str]) -> list[tuple[int, ...]]:
        return [tuple(e.ids) for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _remembered(self, keys: list[str], encode: Callable[[list[str]], list[tuple[int, ...]]]) -> list[tuple[int, ...]]:
        """The ids of distinct words, encoded if neither generation knows them."""
        known, older = self._known, self._older
        new = [k for k in keys if k not in known]
        known.update((k, older[k]) for k in new if k in older)
        fresh = [k for k in new if k not in older]
        known.update(zip(fresh, encode(fresh), strict=True))
        return [known[k] for k in keys]

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after another, and how many each has.

        Letters and the punctuation after them are separate tokens: each is looked up alone.
        """
        if len(self._known) > MEMORY_WORDS:
            self._older, self._known = self._known, {}
        self._known[""] = ()
        plain = pc.match_substring_regex(words, f"^[{_LETTERS}]+[{_CLOSING}]*$")
        split = words.filter(plain)
        letters = pc.utf8_lower(pc.utf8_rtrim(split, characters=_CLOSING)).dictionary_encode()
        marks = pc.utf8_ltrim(split, characters=_ALL_LETTERS).dictionary_encode()
        found = self._remembered(strings(letters.dictionary), self._encode_runs)
        n_letters = len(found)
        found += self._remembered(strings(marks.dictionary), self._encode_runs)
        n_runs = len(found)
        found += self._remembered(strings(words.filter(pc.invert(plain))), self._encode)
        found.append(())
        # two units a word: letters and marks, or the whole word and nothing
        plain = plain.to_numpy(zero_copy_only=False)
        units = np.full((len(words), 2), len(found) - 1, np.int64)
        units[plain, 0] = letters.indices.to_numpy()
        units[plain, 1] = n_letters + marks.indices.to_numpy()
        units[~plain, 0] = np.arange(n_runs, len(found) - 1)
        of_unit = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(of_unit.sum()))
        n = of_unit[units]
        return flat[runs_at((np.cumsum(of_unit) - of_unit)[units.ravel()], n.ravel())], n.sum(axis=1)


def strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def runs_at(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each length, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(first - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


_encoders: dict[str, WordIds] = {}


def ids_of(texts: pa.Array, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each closed by `end_id`, one after another, and where each text's begin."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    encoder = _encoders[path]
    words, bounds = split_words(texts)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    flat, lengths = encoder.of(coded.dictionary)
    flat = np.append(flat, np.uint32(end_id))
    first = np.cumsum(np.append(lengths, 1)) - np.append(lengths, 1)
    codes = np.insert(coded.indices.to_numpy(), bounds[1:], len(lengths))  # the closing id as a word
    each = np.append(lengths, 1)[codes]
    ends = np.concatenate([[0], np.cumsum(each)])
    return flat[runs_at(first[codes], each)], ends[bounds + np.arange(len(bounds))]


class RoomIndex:
    """A segment tree over rooms 0 to `most`: which room, of at least a size, has an open window."""

    def __init__(self, most: int) -> None:
        self._leaves = 1 << most.bit_length()
        self._any = bytearray(2 * self._leaves)
        self._open: list[list[int]] = [[] for _ in range(most + 1)]

    def _mark(self, room: int) -> None:
        node = room + self._leaves
        self._any[node] = bool(self._open[room])
        while node > 1:
            node >>= 1
            on = self._any[2 * node] or self._any[2 * node + 1]
            if self._any[node] == on:
                return
            self._any[node] = on

    def add(self, room: int, window: int) -> None:
        self._open[room].append(window)
        if len(self._open[room]) == 1:
            self._mark(room)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Takes out a window with the least room of at least `size`."""
        node = size + self._leaves
        while not self._any[node]:
            while node & 1:  # up from right children, then to the sibling on the right
                node >>= 1
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:  # past the last leaf of this level
                return None
        while node < self._leaves:
            node = 2 * node if self._any[2 * node] else 2 * node + 1
        room = node - self._leaves
        window = self._open[room].pop()
        if not self._open[room]:
            self._mark(room)
        return room, window


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For pieces in order of falling length: the window of each, and its place there."""
    rooms, n = RoomIndex(window), 0
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        found = rooms.tightest(length)
        room, w = found if found else (window, n)
        n += found is None
        where[i], offset[i] = w, window - room
        if room > length:
            rooms.add(room - length, w)
    return where, offset


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Documents cut into full windows and a rest, with their ids on request. Null texts are empty."""
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_batches(batches, 1500):
            ids, starts = ids_of(batch.column(1), path)
            total = np.diff(starts)
            n_pieces = -(-total // window)
            row = np.repeat(np.arange(len(total)), n_pieces)
            start = within(n_pieces) * window
            length = np.minimum(window, total[row] - start)
            data, first = ids.astype("<u4"), starts[:-1][row] + start
            crc = [zlib.crc32(data[a : a + n]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            out = [batch.column(0).take(pa.array(row)), start, length, crc, total[row]]
            arrays = [a if isinstance(a, pa.Array) else pa.array(a, pa.int64()) for a in out]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                bounds = np.concatenate([first[:1], first + length]) if len(first) else np.zeros(1, np.int64)
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(data.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    given = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return given.mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece: its place in its document, `sequence_id`, `offset` there, and `padded_length` of the sequence.

    A sequence is padded to the window, unless its length is a power of two. An empty table
    gives no rows; an empty or null text gives one piece of the closing id.
    """
    found = stored(pieces(docs, text, doc_id, window, path, with_ids), "pieces")
    n = parts(found.count(), TASK_PIECES)

    def fill(p: pa.Table) -> pa.Table:
        # Arrow keeps ids whole beside null ones.
        doc_id = p["doc_id"].fill_null(np.iinfo(np.int64).min).to_numpy()
        length = p["length"].to_numpy()
        order = np.lexsort((p["ids_crc32"].to_numpy(), p["start"].to_numpy(), doc_id, -length))
        where, offset = best_fit(length[order], window)
        used = np.bincount(where, weights=length[order]).astype(np.int64)
        padded = np.where(used & (used - 1) == 0, used, window)
        part = p["part"][0].as_py() << 32
        out = p.drop_columns(["part"]).take(pa.array(order))
        for name, column in (("sequence_id", where + part), ("offset", offset), ("padded_length", padded[where])):
            out = out.append_column(name, pa.array(column, pa.int64()))
        return out

    places = found.drop("ids").withColumn("part", F.expr(f"cast(pmod(xxhash64(doc_id, start, ids_crc32), {n}) AS int)"))
    out = places.groupBy("part").applyInArrow(fill, PIECES + ", sequence_id bigint, offset bigint, padded_length bigint")
    if with_ids:
        key = ["doc_id", "start", "length", "ids_crc32"]
        ids = found.dropDuplicates(key).select(*[F.col(c).alias(f"of_{c}") for c in key], "ids")
        same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in key]
        out = out.join(ids, same).drop(*[f"of_{c}" for c in key])
    return out


def sequences(docs: DataFrame, **options) -> DataFrame:
    """The packed sequences themselves: `sequence_id`, `ids` and the documents in them."""
    piece = F.struct("offset", "doc_id", "start", "ids")
    return pack(docs, with_ids=True, **options).groupBy("sequence_id", "padded_length").agg(F.sort_array(F.collect_list(piece)).alias("pieces")).select(
        "sequence_id", "padded_length", F.flatten("pieces.ids").alias("ids"), F.expr("transform(pieces, p -> struct(p.doc_id, p.start, p.offset))").alias("documents")
    )
