"""SentencePiece encoding and decoding with numpy.

Text becomes units: a run of spaces with the letters after it. Pieces never reach over the end of a
unit, so each distinct unit is encoded once. Units of equal length advance together through a
Viterbi search: at each place, the hashes of all substrings that end there are looked up among
the sorted hashes of the pieces, and the best way to get there is kept with a back pointer.

The public model is a BPE model: its encoding is what merging the best pair again and again
gives, and not the largest sum of scores. The search therefore admits a piece after another only
if merging leaves this pair as it is. A sequence of pieces is the result of merging exactly if
all its neighbours are such pairs, so one way is left for each place, and ids agree with the
library's. Characters that no piece has become bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationfield.llm.common import ODD, by_batches, mixed, packed, within

SPACE = "▁"
#: Units a worker remembers in each of two generations: what is met again moves to the younger one.
MEMORY_UNITS = 150_000
#: Pairs of pieces it remembers, as a power of two.
PAIR_BITS = 21
#: Later than any piece is made.
NEVER = 1 << 40
#: Texts encoded or decoded together: units they share are looked up once.
AT_A_TIME = 1000
#: Substrings looked up at a time.
AT_ONCE = 2_000_000

_UNIT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of each row of code points."""
    out = np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1]):
        out = out * ODD + codes[:, k]
    return mixed(out)


def _codes(units: list[str]) -> np.ndarray:
    """Units of one length as rows of code points."""
    joined = "".join(units).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32).reshape(len(units), -1).astype(np.uint64)


class Pieces:
    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        self.scores = np.array([model.get_score(i) for i in range(n)])
        self.byte_id = np.zeros(256, np.int64)
        spelled: list[bytes] = []
        normal = []
        for i, name in enumerate(self.names):
            if model.is_byte(i):
                value = int(_BYTE.fullmatch(name)[1], 16)
                self.byte_id[value] = i
                spelled.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelled.append(b"")
            else:
                spelled.append(name.replace(SPACE, " ").encode())
                normal.append(i)
        self._spelled = pa.array(spelled, pa.large_binary())
        self.id_of = {self.names[i]: i for i in normal}
        self.longest = max(len(x) for x in self.id_of)
        # all beginnings of pieces, so that a search ends where no piece goes on; -1: not itself one
        begun = {x[:k]: -1 for x in self.id_of for k in range(1, len(x))} | self.id_of
        by_length: dict[int, list[str]] = {}
        for x in begun:
            by_length.setdefault(len(x), []).append(x)
        keys = np.concatenate([_hashes(_codes(group)) for group in by_length.values()])
        ids = np.array([begun[x] for group in by_length.values() for x in group])
        order = np.argsort(keys)
        self._keys, self._ids = keys[order], ids[order]
        self._units: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self._pair_keys = np.full(1 << PAIR_BITS, -1, np.int64)
        self._pair_stays = np.zeros(1 << PAIR_BITS, bool)
        self._lay_out_merges(normal)

    def _lay_out_merges(self, normal: list[int]) -> None:
        """When each piece is made (`_made`, by falling score; -1 for a character), of which two
        (`_left`, `_right`), and all pairs of pieces that make one."""
        n = len(self.names)
        when = np.zeros(n, np.int64)
        when[np.argsort(-self.scores, kind="stable")] = np.arange(n)
        self._made, self._left, self._right = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        pairs: dict[int, int] = {}
        for i in normal:
            name = self.names[i]
            if len(name) == 1:
                continue
            self._made[i] = when[i]
            halves = self.merged(name, but=i)
            if len(halves) == 2:
                self._left[i], self._right[i] = halves
            for k in range(1, len(name)):
                a, b = self.id_of.get(name[:k]), self.id_of.get(name[k:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = int(when[i])
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self._joint = np.append(keys[order], np.iinfo(np.int64).max)
        self._joint_made = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], NEVER)

    def merged(self, text: str, but: int = -1) -> list[int]:
        """The pieces of a short text by merging the best pair, leftmost first; -1 for none. `but` is not made."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.id_of.get(parts[k] + parts[k + 1])
                if i is not None and i != but and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if at < 0:
                return [self.id_of.get(p, -1) for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of pieces `a` and `b` ends with these two.

        Merging is followed backwards at the seam: of the two pieces beside it the one made later
        gives way to its half at the seam. The pieces beside the seam must never be a pair that makes
        a piece earlier than one of them is used up; of equal times, the left one comes first.
        """
        out = np.ones(len(a), bool)
        left, used = np.arange(len(a)), np.full(len(a), NEVER)
        while len(left):
            keys = a << 20 | b
            at = np.searchsorted(self._joint, keys)
            together = (self._joint[at] == keys) & (self._joint_made[at] < used)
            out[left[together]] = False
            made_a, made_b = self._made[a], self._made[b]
            on = ~together & ((made_a >= 0) | (made_b >= 0))
            left, a, b, made_a, made_b = left[on], a[on], b[on], made_a[on], made_b[on]
            first = made_a > made_b
            used = np.where(first, made_a, made_b + 1)
            a, b = np.where(first, self._right[a], a), np.where(first, b, self._left[b])
        return out

    def _stays(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether merging leaves piece `after` beside piece `before` (-1: nothing there to merge with).

        Answers are remembered in a table of fixed size, a pair in the slot its hash names; the
        pair that comes later takes the slot.
        """
        out = np.ones(len(before), bool)
        both = np.flatnonzero(before >= 0)
        keys = before[both] * (1 << 20) + after[both]
        slots = ((keys.view(np.uint64) * ODD) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        known = self._pair_keys[slots] == keys
        answers = self._pair_stays[slots]
        new = np.flatnonzero(~known)
        if len(new):
            fresh = self._apart(keys[new] >> 20, keys[new] & ((1 << 20) - 1))
            answers[new] = fresh
            # of several pairs for one slot the last is kept, key and answer alike
            self._pair_keys[slots[new]], self._pair_stays[slots[new]] = keys[new], fresh
        out[both] = answers
        return out

    def _search(self, units: list[str]) -> list[tuple[int, ...]]:
        """Encodes units of one length together."""
        codes = _codes(units)
        n_units, n = codes.shape
        best = np.full((n_units, n + 1), -np.inf)
        best[:, 0] = 0.0
        last = np.full((n_units, n + 1), -1, np.int64)
        back = np.zeros((n_units, n + 1), np.int64)
        for start in range(n):
            if start:
                none = np.flatnonzero(back[:, start] == 0)  # no piece ends here: the character becomes bytes
                best[none, start], last[none, start], back[none, start] = best[none, start - 1], -1, 1
            rows, hashed = np.arange(n_units), np.zeros(n_units, np.uint64)
            for size in range(1, min(self.longest, n - start) + 1):
                end = start + size
                hashed = hashed * ODD + codes[rows, end - 1]
                key = mixed(hashed)
                at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
                goes_on = self._keys[at] == key
                rows, hashed, piece = rows[goes_on], hashed[goes_on], self._ids[at[goes_on]]
                if not len(rows):
                    break
                whole = np.flatnonzero(piece >= 0)
                hit, piece = rows[whole], piece[whole]
                fits = self._stays(last[hit, start], piece)
                hit, piece = hit[fits], piece[fits]
                total = best[hit, start] + self.scores[piece]
                better = total > best[hit, end]
                hit, piece = hit[better], piece[better]
                best[hit, end], last[hit, end], back[hit, end] = total[better], piece, size
        none = np.flatnonzero(back[:, n] == 0)
        best[none, n], last[none, n], back[none, n] = best[none, n - 1], -1, 1
        # back along the pointers, all units at once
        found, u = np.zeros((n_units, n), np.int64), np.arange(n_units)
        place, count, spelled = np.full(n_units, n), np.zeros(n_units, np.int64), np.zeros(n_units, bool)
        while len(u):
            piece, size = last[u, place[u]], back[u, place[u]]
            count[u] += 1
            found[u, n - count[u]] = np.where(piece >= 0, piece, -place[u])
            spelled[u] |= piece < 0
            place[u] -= size
            u = u[place[u] > 0]
        out = [tuple(row[n - k :]) for row, k in zip(found.tolist(), count.tolist(), strict=True)]
        for u in np.flatnonzero(spelled).tolist():
            ids: list[int] = []
            for i in out[u]:
                ids += [i] if i >= 0 else [int(self.byte_id[b]) for b in units[u][-i - 1].encode("utf-8", "surrogatepass")]
            out[u] = tuple(ids)
        return out

    def of_units(self, units: list[str]) -> list[tuple[int, ...]]:
        """The ids of distinct units."""
        if len(self._units) > MEMORY_UNITS:
            self._older, self._units = self._units, {}
        known, older = self._units, self._older
        new: dict[int, list[str]] = {}
        for u in units:
            if u not in known:
                if u in older:
                    known[u] = older[u]
                else:
                    new.setdefault(len(u), []).append(u)
        for n, group in new.items():
            step = max(1, AT_ONCE // (n * min(n, self.longest)))
            for a in range(0, len(group), step):
                known.update(zip(group[a : a + step], self._search(group[a : a + step]), strict=True))
        return [known[u] for u in units]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin. Null and empty texts have none."""
        units, ends = [], [0]
        for t in texts:
            if t:
                units += _UNIT.findall(SPACE + t.replace(" ", SPACE))
            ends.append(len(units))
        coded = pa.array(units, pa.string()).dictionary_encode()
        codes = coded.indices.to_numpy()
        ids = self.of_units(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
        each = lengths[codes]
        out = flat[np.repeat((np.cumsum(lengths) - lengths)[codes], each) + within(each)]
        return out, np.concatenate([[0], np.cumsum(each)])[np.array(ends)]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """The texts whose ids lie one after another, from one of `starts` to the next: bytes that are no
        UTF-8 become U+FFFD, and the space put first is taken off. A null id is no text."""
        taken = self._spelled.take(pa.array(ids))
        places = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
        joined = taken.buffers()[2].to_pybytes() if places[-1] else b""
        bounds = places[starts].tolist()
        return [
            joined[a + 1 if joined[a:b].startswith(b" ") else a : b].decode("utf-8", "replace")
            for a, b in zip(bounds, bounds[1:], strict=False)
        ]


_models: dict[str, Pieces] = {}


def _model(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """`row` (the whole row) and `ids`; null for a null text."""
    path = path or model_path()
    given = packed(docs, text=F.col(f"`{text}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_batches(batches, AT_A_TIME):
            ids, starts = _model(path).encode(batch.column("text").to_pylist())
            null = batch.column("text").is_null()
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids), mask=null)
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists], ["row", "ids"])

    return given.mapInArrow(run, f"row {given.schema['row'].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """`row` (the whole row) and `text`, the text of the ids; null for null."""
    path = path or model_path()
    given = packed(rows, ids=F.col(f"`{ids}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_batches(batches, AT_A_TIME):
            lists = batch.column("ids")
            texts = _model(path).decode(lists.values, lists.offsets.to_numpy())
            null = lists.is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string(), mask=null)], ["row", "text"])

    return given.mapInArrow(run, f"row {given.schema['row'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, ids, n_ids, and the SHA-256 of the text decoded from them.

    Encoding and decoding share a task, so ids cross to Spark once and a worker holds one model.
    """
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in by_batches(batches, AT_A_TIME):
            ids, starts = model.encode(batch.column("text").to_pylist())
            null = batch.column("text").is_null()
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids), mask=null)
            back = pa.array(model.decode(ids, starts), pa.string(), mask=null.to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, back], ["doc_id", "ids", "back"])

    back = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>, back string")
    return back.select(
        "doc_id", "ids", F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).alias("n_ids"), F.sha2("back", 256).alias("decoded_sha256")
    )
