"""Alignment of tokenizers, whitening and exact search against brute force, on tables with nulls, ties, repeats and odd rows."""

import hashlib
import random
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationfield.llm import alignment, exact_search, whitening
from stationfield.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# -- alignment ---------------------------------------------------------------------------------

PATHS = tuple(alignment.tokenizer_path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "\t\n", "one two three", "a▁b", "  a\r\n  b;\r\n\r\n c\r", "\n  word", "<|endoftext|> <s> x", "a\x00b", "naïve 文字 🙂 é",
    "x" * 5000, "don't we'll 12 34", "one two three", "a b " * 4000, "\xa0nbsp　wide\x85next",
]


@pytest.fixture(scope="module")
def documents(spark):
    """Extra columns have names that the operator uses itself; ids are null, repeated and large."""
    pick = random.Random(3)
    letters = "ab \r\n\t;{}()é'st "
    texts = ODD + ["".join(pick.choices(letters, k=pick.randint(1, 60))) for _ in range(150)]
    rows = [(i, t, "s", i) for i, t in enumerate(texts)] + [(4, ODD[4], "s", 0), (None, "no id", "s", 0), ((1 << 60) + 1, "large id", "s", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, pairs string, row int")


@lru_cache
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PATHS[1])


def aligned(text):
    """Ids of A, ids of B and the groups, from whole texts and plain sets of ends."""
    tokens = alignment.tokens_of(*PATHS)
    a_tok, b_tok = libraries()
    if not text:
        return [], [], []
    a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
    whole = (" " + text).encode()
    if b"".join(tokens.bytes_a[i] for i in a) != whole or b"".join(tokens.bytes_b[i] for i in b) != whole:
        return [], [], []
    ends_a, ends_b = (np.cumsum([len(x[i]) for i in ids]).tolist() for x, ids in ((tokens.bytes_a, a), (tokens.bytes_b, b)))
    both = set(ends_a) & set(ends_b)
    cuts = [(i + 1, ends_b.index(e) + 1) for i, e in enumerate(ends_a) if e in both]
    groups, p, q = [], 0, 0
    for i, j in cuts:
        groups.append((a[p:i], b[q:j]))
        p, q = i, j
    return a, b, groups


def brute_alignment(rows):
    found = [(i, *aligned(t)) for i, t in rows]
    counts = Counter((x[-1], y[-1]) for *_, groups in found for x, y in groups)
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(n, top.get(y, 0))
    out = []
    for i, a, b, groups in found:
        pairs = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            i, len(a), len(b), len(groups), len(pairs), sum(counts[p] == top[p[1]] for p in pairs), sum(counts[p] for p in pairs),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


def test_alignment(documents):
    given = [(r.doc_id, r.text) for r in documents.collect()]
    got = rows_of(alignment.digest(documents))
    assert sorted(got, key=repr) == sorted(brute_alignment(given), key=repr)
    assert (5, 0, 0, 0, 0, 0, 0, "") in got  # U+2581 is not what B spells


def test_alignment_query(spark):
    from stationfield.llm.queries import QUERIES

    docs = table(spark, SF_DIR, "documents")
    got = QUERIES["op11_alignment"](spark, SF_DIR)
    assert sorted(rows_of(got)) == sorted(brute_alignment([(r.doc_id, r.text) for r in docs.collect()]))


def test_alignment_rows(documents):
    out = alignment.align(documents)
    assert out.columns == ["row", "a", "b", "groups"]
    for r in out.collect():
        a, b, groups = aligned(r.row.text)
        assert (r.a, r.b) == (a, b) and [tuple(g) for g in r.groups] == [(len(x), len(y)) for x, y in groups]


def test_alignment_empty(documents):
    none = documents.limit(0)
    assert alignment.digest(none).count() == 0 and alignment.align(none).count() == 0


def test_linked_pairs_are_bounded(documents):
    tokens = alignment.tokens_of(*PATHS)
    pairs = alignment.pair_counts(alignment.links(documents)).collect()
    assert 0 < len(pairs) <= tokens.most_pairs() < 1_000_000
    for r in pairs:
        x, y = tokens.bytes_a[r.a], tokens.bytes_b[r.b]
        assert x.endswith(y) or y.endswith(x)


def test_units_are_forgotten(documents, monkeypatch):
    """With a memory of few units the results are the same."""
    tokens = alignment.Tokens(*PATHS)
    monkeypatch.setattr(alignment, "MEMORY_UNITS", 3)
    for text in ODD + ODD:
        a, b, groups = aligned(text)
        found = tokens.known(list(dict.fromkeys(tokens.units_of(text))))
        if text and None not in found:
            by = dict(zip(dict.fromkeys(tokens.units_of(text)), found, strict=True))
            assert sum(by[u][0] for u in tokens.units_of(text)) == len(a)
            written = b"".join(by[u][2] for u in tokens.units_of(text)).decode()
            assert written == "".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) + ";" for x, y in groups)


def test_gallop():
    pick = np.random.default_rng(5)
    for n, m in ((0, 0), (0, 4), (4, 0), (1, 1), (3, 500), (500, 3), (200, 200)):
        sequences = [(np.sort(pick.choice(1000, n, False)), np.sort(pick.choice(1000, m, False))) for _ in range(4)]
        a = np.concatenate([x + 1000 * k for k, (x, _) in enumerate(sequences)]).astype(np.int64)
        b = np.concatenate([y + 1000 * k for k, (_, y) in enumerate(sequences)]).astype(np.int64)
        i, j = alignment.common_ends(a, b, np.full(4, n), np.full(4, m))
        assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()


# -- whitening ---------------------------------------------------------------------------------


def brute_whitening(rows):
    x = [[int(np.floor(64 * float(np.float64(c)))) + 1_000_000 for c in v] for v in rows]
    fit = sorted({tuple(v) for v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    exact = np.array([[float(n * c - s) for c, s in zip(v, sums, strict=True)] for v in fit]) / n
    _, sigma, axes = np.linalg.svd(exact)  # of the rows, not of their square: no digits are lost
    values = np.zeros(len(sums))
    values[: len(sigma)] = sigma**2 / n
    centred = np.array([[float(n * c - s) for c, s in zip(v, sums, strict=True)] for v in x]) / n
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    return n, [d if d < 1 << 63 else None for d in deviation], centred, values, axes.T


def check_whitening(out, rows, most=16):
    n, deviation, centred, values, axes = brute_whitening(rows)
    most = min(most, len(values))
    got = {}
    for r in out.collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(rows)
    signs = {}
    for i, by in got.items():
        assert sorted(by) == list(range(1, most + 1))
        for k, r in by.items():
            assert (r.n, r.deviation) == (n, deviation[i]) and r.identity_error < 1e-4
            if values[k - 1] <= 1e-26 * values[0]:  # rounding, in the brute-force version
                assert r.whitened is None
                continue
            assert abs(r.explained / (values[k - 1] / values.sum()) - 1) < 1e-4
            gap = min(abs(values[k - 1] - v) for j, v in enumerate(values) if j != k - 1) if len(values) > 1 else values[0]
            if gap > 1e-3 * values[k - 1]:
                want = centred[i] @ axes[:, k - 1] / np.sqrt(values[k - 1])
                if abs(want) > 1e-3:
                    signs.setdefault(k, set()).add(np.sign(want) == np.sign(r.whitened))
                assert abs(abs(r.whitened) - abs(want)) < 1e-6 * max(1, abs(want))
    assert all(len(s) == 1 for s in signs.values())


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, [float(c) for c in v], "x") for i, v in enumerate(rows)], "vec_id long, embedding array<double>, x string")


def test_whitening_query(spark):
    from stationfield.llm.queries import QUERIES

    rows = table(spark, SF_DIR, "embeddings").orderBy("vec_id").collect()
    check_whitening(QUERIES["op12_whitening"](spark, SF_DIR), [r.embedding for r in rows])


@pytest.mark.parametrize("name", ["dependent", "repeats", "few", "ill", "wide", "one"])
def test_whitening(spark, name):
    pick = np.random.default_rng(2)
    small = pick.integers(-5, 6, (120, 2))
    rows = {
        "dependent": [[a, b, a + b, 0.5] for a, b in small.tolist()],  # and a constant one
        "repeats": pick.normal(size=(20, 3)).round(1).tolist() * 3 + [[1, 2, 3]] * 100,
        "few": pick.normal(size=(3, 6)).tolist(),
        "ill": [[a * 1e5, a * 1e5 + b, c] for a, b, c in pick.normal(size=(200, 3)).tolist()],
        "wide": (pick.normal(size=(90, 20)) * np.arange(1, 21)).tolist(),
        "one": [[1.5, 2.5, 3.5]] * 4,
    }[name]
    out = whitening.whiten(vectors_of(spark, rows))
    if name == "one":
        assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in out.collect()} == {(1, 0, None, 0.0, 0.0)}
        return
    check_whitening(out, rows)


def test_whitening_leaves_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], 0), (2, [3.0, -1.0], 0), (3, None, 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [1.0, -inf], 0), (7, [0.0, 0.0], 0),
        (8, [1.0], 0), (9, [], 0), (None, [5.0, 5.0], 0), (1, [1.0, 2.0], 0), (10, [1e300, 0.0], 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int")
    got = whitening.whiten(df).collect()
    assert Counter(r.vec_id for r in got) == {1: 4, 2: 2, 7: 2, None: 2} and {r.n for r in got} == {4}
    assert whitening.whiten(df.limit(0)).count() == 0
    large = whitening.whiten(vectors_of(spark, [[1e11, 0.0], [-1e11, 1.0], [5.0, 2.0]])).collect()
    assert {r.deviation for r in large if r.vec_id == 0} == {None}  # larger than a long


# -- exact search ------------------------------------------------------------------------------


def brute_search(rows, k):
    rows = sorted({(i, tuple(int(np.floor(256 * c)) for c in v)) for i, v in rows})
    out = []
    for i, q in rows:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in rows if j != i)
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def searched(spark, rows, k=5):
    df = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    return sorted(rows_of(exact_search.nearest(df, lambda c: c % 50 == 0, k)))


@pytest.mark.parametrize("sizes", [(2048, 16_384, 256, 2048), (2, 90, 2, 40)])
def test_exact_search(spark, monkeypatch, sizes):
    for name, value in zip(("QUERY_ROWS", "CANDIDATE_ROWS", "QUERIES_AT_ONCE", "STRIP"), sizes, strict=True):
        monkeypatch.setattr(exact_search, name, value)
    pick = np.random.default_rng(4)
    scale = pick.exponential(1, 40) ** 3
    rows = list(enumerate((pick.normal(size=(400, 40)) * scale).tolist()))
    rows += [(1000 + i, rows[0][1]) for i in range(100)] + rows[:60]  # ties and repeated rows
    assert searched(spark, rows) == brute_search(rows, 5)
    assert searched(spark, rows, 1) == brute_search(rows, 1)


def test_pruning_keeps_the_best():
    pick = np.random.default_rng(6)
    for spread in (0.0, 3.0):
        scale = np.exp(-spread * np.arange(48) / 12)
        q, c = (np.floor(pick.normal(size=(n, 48)) * 500 * scale) for n in (40, 6000))
        row, score, found = exact_search.search(q, np.arange(40), c, np.arange(6000), 5)
        want = q @ c.T
        want[np.arange(40), np.arange(40)] = -np.inf
        for i in range(40):
            best = np.lexsort((np.arange(6000), -want[i]))[:5]
            assert sorted(zip(-score[row == i], found[row == i], strict=True)) == [(-want[i, j], j) for j in best]


def test_exact_search_large_numbers(spark):
    rows = [(0, [1e12, 1.0]), (1, [1e12, -3.0]), (2, [-1e12, 2.0]), (3, [4.0, 1e15]), (50, [1e15, 1e15])]
    clipped = [(i, n, j, max(min(s, (1 << 63) - 1), -(1 << 63))) for i, n, j, s in brute_search(rows, 5)]
    got = searched(spark, rows)
    assert {(i, j, s) for i, _, j, s in got} == {(i, j, s) for i, _, j, s in clipped}


def test_exact_search_leaves_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [3.0, -1.0]), (2, None), (3, [1.0, None]), (50, [nan, 1.0]), (4, [1.0, inf]), (100, [0.0, 0.0]), (5, [1.0]), (6, []),
        (None, [9.0, 9.0]), (7, [1e300, 0.0]), (1, [3.0, -1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(rows_of(exact_search.nearest(df, lambda c: c % 50 == 0)))
    assert got == brute_search([(0, [1.0, 2.0]), (1, [3.0, -1.0]), (100, [0.0, 0.0])], 5)
    assert exact_search.nearest(df.limit(0), lambda c: c % 50 == 0).count() == 0
    assert exact_search.nearest(df, lambda c: F.lit(False)).count() == 0
