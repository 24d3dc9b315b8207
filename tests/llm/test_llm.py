"""Each operator against a brute-force version on small tables with nulls, ties, repeats and odd texts."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from compare import compare, duckdb_views
from pyspark.sql import functions as F

from stationfield.llm import (
    common, exact_dedup, neighbours, ngram_join, packing, pieces, quality, secret_scan, sharding, substring_dedup, url_filter,
)
from stationfield.llm.components import components
from stationfield.llm.queries import ORACLE

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i}" for i in range(3000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
TEXTS = [
    None, "", " \t\n", "one two three", "one  two\tthree", "One two three", LONG, LONG + " end", "a b " + PASSAGE + " c",
    "x " + PASSAGE, PASSAGE + " y z", LONG, "é" * 40 + " ü", "x" * 5000, "ab " * 300,
]


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns have names that the operators use themselves."""
    rows = [(i, t, i % 2, "s", i) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 1, "s", 3), (None, "no id", 0, "s", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, row int, sha string, size int")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def words(text):
    return WORD.findall(text or "")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert compare(spark, duckdb_views(SF_DIR), name, SF_DIR)[0] == "ok"


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for out in (
        exact_dedup.copies(none), exact_dedup.drop_copies(none), ngram_join.classes(none), ngram_join.keep_first(none),
        packing.pack(none), pieces.round_trip(none), quality.digest(none, labels), secret_scan.digest(none),
        sharding.assignment(none), substring_dedup.without_repeats(none),
    ):
        assert out.count() == 0


def test_exact_dedup(docs):
    got = sorted(rows_of(exact_dedup.copies(docs)), key=repr)
    groups = {}
    given = [(r.doc_id, r.text or "") for r in docs.collect()]
    for i, t in given:
        groups.setdefault("".join(words(t)), []).append((-len(t), i is None, i))
    assert len(got) == len(given)
    for i, keep, size, kept, sha in got:
        norm = next(n for n in groups if hashlib.sha256(n.encode()).hexdigest() == sha)
        assert size == len(groups[norm]) and keep == min(groups[norm])[2]
        assert not kept or i == keep
    assert sum(r[3] for r in got) == len(groups)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_sharding(docs):
    got = rows_of(sharding.assignment(docs, 3))
    assert len(got) == docs.count()
    by = {}
    for i, size, crc, law, shard, slot, grown in got:
        by.setdefault(shard, []).append(slot)
        if i is not None:
            t = (TEXTS[i] or "").encode()
            assert (size, crc, law, grown) == (len(t) + 1, zlib.crc32(t), "bytes", None)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    shard_of = {i: s for i, _, _, _, s, _, _ in got}
    assert shard_of[6] == shard_of[11]


@pytest.mark.parametrize("n", [2, 100, 400])
def test_many_shards_come_to_an_end(spark, monkeypatch, n):
    monkeypatch.setattr(sharding, "TASK_ITEMS", 50)
    monkeypatch.setattr(sharding, "ITEMS_PER_SHARD", 2)
    groups = spark.range(3000).selectExpr("cast(id AS string) AS item", "cast(100 + id % 7 AS bigint) AS size")
    load = {}
    for r in sharding.shard_groups(groups, n).join(groups, "item").collect():
        load[r.shard] = load.get(r.shard, 0) + r["size"]
    assert len(load) == n and sum(load.values()) == 308_994
    assert max(load.values()) <= 1.5 * 3000 * 103 / n + 107


def test_write_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i % 5}", i) for i in range(20)], "doc_id long, text string, _shard int")
    sharding.write_shards(df, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == ["doc_id", "text", "_shard", "__shard"]
    assert sorted((r.doc_id, r.text, r._shard) for r in back.collect()) == [(i, f"text {i % 5}", i) for i in range(20)]


def test_best_fit():
    sizes = np.array([5, 5, 4, 3, 3, 2, 2])
    bins = sharding.best_fit_decreasing(sizes, 8)
    assert bins.max() == 2 and max(np.bincount(bins, sizes)) == 8
    assert np.ptp(np.bincount(sharding.into_shards(np.arange(1, 101), 4), np.arange(1, 101))) <= 2


@pytest.mark.parametrize("large", [[1 / 3], [0.2], [0.2, 0.15], [0.9], [0.3, 0.3, 0.3]])
def test_large_groups_leave_no_shard_empty(large):
    small = np.arange(1, 2001)
    sizes = np.concatenate([small, (np.array(large) * small.sum() / (1 - sum(large))).astype(int)])
    load = np.bincount(sharding.into_shards(sizes, 8), sizes, 8)
    others = np.sort(load)[: 8 - len(large)]
    assert sorted(load)[8 - len(large) :] == sorted(sizes[2000:])
    assert others.max() <= small.sum() / (8 - len(large)) * 1.01 and others.min() > small.sum() / (8 - len(large)) * 0.95


def test_few_groups_leave_no_shard_empty():
    assert sorted(np.bincount(sharding.into_shards(np.full(6, 5), 4), minlength=4)) == [1, 1, 2, 2]
    assert sorted(np.bincount(sharding.into_shards(np.array([9, 1, 1]), 8), minlength=8)) == [0] * 5 + [1] * 3


def test_a_large_group_in_levels(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TASK_ITEMS", 60)
    monkeypatch.setattr(sharding, "FINENESS", 4)
    size = F.when(F.col("id") == 7, 400_000).otherwise(F.col("id") % 50 + 1)
    groups = spark.range(500).select(F.col("id").cast("string").alias("item"), size.cast("long").alias("size"))
    placed = sharding.shard_groups(groups, 4).join(groups, "item").groupBy("shard").agg(F.sum("size"), F.count("*")).collect()
    assert sum(r[2] for r in placed) == 500 and len(placed) == 4
    loads = sorted(r[1] for r in placed)
    assert loads[3] == 400_000 and loads[2] - loads[0] < 1100


def test_levels_of_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TASK_ITEMS", 60)
    monkeypatch.setattr(sharding, "FINENESS", 4)
    groups = spark.range(500).select(F.col("id").cast("string").alias("item"), (F.col("id") % 50 + 1).alias("size"))
    placed = sharding.shard_groups(groups, 4).join(groups, "item").groupBy("shard").agg(F.sum("size"), F.count("*")).collect()
    assert sum(r[2] for r in placed) == 500 and len(placed) == 4
    assert max(r[1] for r in placed) - min(r[1] for r in placed) < 800


@pytest.mark.parametrize("days", [(20240101, 20240131), (1704067200, 1706659200), (0, 2_000_000_000)])
def test_open_entries_have_no_end(spark, days):
    entries = spark.createDataFrame([("d:a.org", days[0], True), ("p:b.org/x", days[0], True)], "key string, day long, listed boolean")
    captures = spark.createDataFrame(
        [(1, "http://a.org/", days[1]), (2, "http://a.org/", days[0] - 1), (3, "https://b.org/x/y", days[1]), (4, "https://b.org/z", days[1])],
        "id long, url string, day long",
    )
    listed = url_filter.intervals(entries)
    assert {r.id for r in url_filter.as_of(captures, listed).where("blocked").collect()} == {1, 3}
    assert {r.id for r in url_filter.allowed(captures, listed).collect()} == {2, 4}
    assert url_filter.as_of(captures, listed.limit(0)).where("blocked").count() == 0
    assert url_filter.as_of(captures.limit(0), listed).count() == 0


def test_url_filter(spark):
    entries = spark.createDataFrame(
        [("d:a.b", 3, True), ("d:a.b", 6, False), ("d:a.b", 6, True), ("d:a.b", 9, False), ("d:x.a.b", 1, True), (None, 1, True), ("d:q.r", None, True)],
        "key string, day int, listed boolean",
    )
    captures = spark.createDataFrame(
        [(1, "http://X.a.b/p", 2), (2, "http://x.a.b/", 3), (3, "http://a.b", 2), (4, "http://a.b", 8), (5, "http://a.b", 9), (6, None, 4), (7, "junk", 4), (8, "http://a.b", None), (4, "http://a.b", 8)],
        "id long, url string, day int",
    )
    got = sorted((r.id, r.n_rules, r.rule, r.blocked) for r in url_filter.as_of(captures, url_filter.intervals(entries)).collect())
    assert got == [
        (1, 1, "d:x.a.b", True), (2, 2, "d:x.a.b", True), (3, 0, None, False), (4, 1, "d:a.b", True), (4, 1, "d:a.b", True),
        (5, 0, None, False), (6, 0, None, False), (7, 0, None, False), (8, 0, None, False),
    ]


@pytest.mark.parametrize("long_prefix", [5000, 1])
def test_substring_dedup(docs, monkeypatch, long_prefix):
    monkeypatch.setattr(substring_dedup, "LONG_PREFIX", long_prefix)
    first = {}
    for i, t in enumerate(TEXTS):
        w = words(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    for i, n, removed, sha, _ in rows_of(substring_dedup.without_repeats(docs)):
        if i is None:
            assert removed == 0
            continue
        w = words(TEXTS[i])
        gone = {k + j for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for j in range(50)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (n, removed, sha) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()), i


@pytest.mark.parametrize("long_prefix", [5000, 1])
def test_substring_dedup_with_two_texts_of_one_id(spark, monkeypatch, long_prefix):
    monkeypatch.setattr(substring_dedup, "LONG_PREFIX", long_prefix)
    other = " ".join(f"other{i}" for i in range(120))
    rows = [(1, "a " + PASSAGE), (2, "b c " + PASSAGE + " d"), (2, other), (3, other + " e")]
    out = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out.collect())
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (rows[0][1], "b c d", other, "e")]
    assert got == [(1, 61, 0, sha[0]), (2, 63, 60, sha[1]), (2, 120, 0, sha[2]), (3, 121, 120, sha[3])]


def test_secret_scan(spark):
    body = "A1" * 15
    token = "ghp_" + body + secret_scan.checksum62(body.encode())
    texts = [
        None, "", "PassWord = 'hunter22' é token:abc api-key=1 apikey=\"abcdefgh\"", "é AKIA" + "Q" * 16 + " AKIAQQ", "ü" + "0f" * 12 + "g" + "a" * 23,
        "token token=secret=abcdef", token + " " + token[:-1] + "~", "secſret=abcdefg",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assign = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
    for i, n_assign, n_access, n_hex, sha, spans in rows_of(secret_scan.digest(df)):
        t = texts[i] or ""
        base = [("assign", m.start(), m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        base += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        base += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        base.sort(key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))
        assert sha == hashlib.sha256(secret_scan.listed(base).encode()).hexdigest(), t
        assert n_assign + n_access + n_hex == len(base)
        assert spans.count("signed") == (i == 6)
    clean = secret_scan.redact_secrets(df.withColumn("n_chars", F.length("text")))
    assert clean.columns == ["doc_id", "text", "n_chars"]
    assert {r.doc_id: r.text for r in clean.collect()}[3] == "é [SECRET] AKIAQQ"


def test_packing(docs):
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer.from_file(packing.tokenizer_path())
    got = packing.pack(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048
    for i, t in enumerate(TEXTS):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        mine = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got if r.doc_id == i)
        assert [m[0] for m in mine] == list(np.cumsum([0] + [m[1] for m in mine[:-1]]))
        assert sum(m[1] for m in mine) == len(ids)
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c and d == len(ids) for s, n, c, d in mine)
    assert packing.sequences(docs.limit(3)).count() > 0


def test_packing_keeps_ids_whole(spark):
    rows = [((1 << 60) + 1, "one"), (None, "two words"), (-(1 << 62) - 1, None), ((1 << 53) + 1, LONG)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows}


def test_pieces_forget_and_find_again(monkeypatch):
    pytest.importorskip("sentencepiece")
    own = pieces.Pieces(pieces.model_path())
    want = [own.encode([t])[0].tolist() for t in TEXTS]
    monkeypatch.setattr(pieces, "MEMORY_UNITS", 2)
    assert [own.encode([t])[0].tolist() for t in TEXTS] == want == [own.encode([t])[0].tolist() for t in TEXTS]


def test_encode_and_decode_tables(docs):
    pytest.importorskip("sentencepiece")
    coded = pieces.encode(docs)
    back = pieces.decode(coded.select("row.doc_id", "row.text", "ids"))
    rows = back.collect()
    assert len(rows) == docs.count() and all(r.text == r.row.text for r in rows)


def test_pieces_apart_as_merging_leaves_them():
    pytest.importorskip("sentencepiece")
    own = pieces.Pieces(pieces.model_path())
    rng = np.random.default_rng(5)
    some = np.array(sorted(own.id_of.values()))
    short = np.array([i for i in some if len(own.names[i]) <= 3])
    a = np.concatenate([rng.choice(some, 4000), rng.choice(short, 4000), short[:500]])
    b = np.concatenate([rng.choice(some, 4000), rng.choice(short, 4000), short[:500]])
    # and the halves of whole pieces, which never stay apart
    whole = [(n[:k], n[k:]) for n in own.id_of for k in range(1, len(n)) if n[:k] in own.id_of and n[k:] in own.id_of][::200]
    a = np.concatenate([a, [own.id_of[x] for x, _ in whole]])
    b = np.concatenate([b, [own.id_of[y] for _, y in whole]])
    want = [own.merged(own.names[i] + own.names[k]) == [i, k] for i, k in zip(a.tolist(), b.tolist(), strict=True)]
    assert own._apart(a, b).tolist() == want and 0 < sum(want) < len(want)


def test_decode_broken_bytes_and_nulls(spark):
    pytest.importorskip("sentencepiece")
    own = pieces.Pieces(pieces.model_path())
    cut = own.encode(["\U00010348"])[0].tolist()[:-1]  # bytes of a character, the last one missing
    rows = spark.createDataFrame([(1, None), (2, []), (3, cut), (4, own.encode([" a"])[0].tolist())], "k int, ids array<int>")
    got = {r.row.k: r.text for r in pieces.decode(rows).collect()}
    assert got == {1: None, 2: "", 3: "\ufffd", 4: " a"}
    assert pieces.decode(rows.where("false")).count() == 0


def test_pieces(docs):
    spm = pytest.importorskip("sentencepiece")
    model = spm.SentencePieceProcessor(model_file=pieces.model_path())
    texts = [*TEXTS, " a  b ", "x\ny\tz", "日本 😀", "aaaaaaaaaaa", "    indented\n        more"]
    own = pieces.Pieces(pieces.model_path())
    ids, starts = own.encode(texts)
    for k, t in enumerate(texts):
        mine = ids[starts[k] : starts[k + 1]].tolist()
        assert mine == model.encode(t or ""), t
    assert own.decode(ids, starts) == [t or "" for t in texts]
    for r in pieces.round_trip(docs.where("doc_id IS NOT NULL")).collect():
        t = TEXTS[r.doc_id]
        assert r.decoded_sha256 == (None if t is None else hashlib.sha256(t.encode()).hexdigest())


def brute_classes(texts, ids):
    fold = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})
    sets = []
    for t in texts:
        w = words((t or "").translate(fold))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    label = dict(zip(ids, ids, strict=True))
    for _ in range(len(ids)):
        for a in range(len(ids)):
            for b in range(a):
                common = len(sets[a] & sets[b])
                if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                    label[ids[a]] = label[ids[b]] = min(label[ids[a]], label[ids[b]])
    return {i: (len(s), label[i]) for i, s in zip(ids, sets, strict=True)}


@pytest.mark.parametrize("block", [1000, 3])
def test_ngram_join(spark, docs, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", block)
    random = np.random.default_rng(1)
    base = [f"t{k}" for k in random.integers(0, 500, 120)]
    near = []
    for k in range(24):
        w = list(base)
        for at in random.integers(0, 120, k // 4):
            w[at] = f"u{random.integers(0, 99)}"
        near.append(" ".join(w))
    texts = [*TEXTS, *near]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, same string")
    got = {i: (n, c) for i, n, c in rows_of(ngram_join.classes(df))}
    assert got == brute_classes(texts, range(len(texts)))
    kept = ngram_join.keep_first(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {c for _, c in got.values()}
    assert ngram_join.classes(docs).count() == docs.count()


@pytest.mark.parametrize("hot_part", [1, 10, 1000])
def test_components(spark, monkeypatch, hot_part):
    """A chain, and a star whose centre is not its smallest node: with all keys cold, some, and all hot."""
    monkeypatch.setattr(common, "HOT_PART", hot_part)
    chain = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(100, 160).select(F.lit(130).cast("long").alias("a"), F.col("id").alias("b"))
    got = {r.node: r.label for r in components(chain.unionByName(star)).collect()}
    assert got == {n: 0 for n in range(41)} | {n: 100 for n in range(100, 160)}


@pytest.mark.parametrize("hot_part", [1, 1000])
def test_copies_of_a_third(spark, monkeypatch, hot_part):
    """One text in a third of all rows: op2, op8 and op9 with its group hot and cold."""
    monkeypatch.setattr(common, "HOT_PART", hot_part)
    texts = [PASSAGE if k % 3 == 0 else f"{k} {LONG[: 40 * k]} {k}" for k in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shards = {r.doc_id: r.shard for r in sharding.assignment(df, 4).collect()}
    assert len(shards) == 60 and len({shards[k] for k in range(0, 60, 3)}) == 1
    keep = {i: (k, n) for i, k, n, _, _ in rows_of(exact_dedup.copies(df))}
    assert keep == {i: (0, 20) if i % 3 == 0 else (i, 1) for i in range(60)}
    got = {i: (n, c) for i, n, c in rows_of(ngram_join.classes(df))}
    assert got == brute_classes(texts, range(60))


def test_word_ids_are_the_librarys():
    tokenizers = pytest.importorskip("tokenizers")
    path = packing.tokenizer_path()
    tok = tokenizers.Tokenizer.from_file(path)
    odd = [
        None, "", "...", "a..", "..a", "A.b", "ÀÉÿ!! ß.., ...", "a’b don't DON'T x!y 12 a1.", "µm ﬁ İstanbul, × ÷ª",
        "<|endoftext|> a_b é É. e\u0301", "\xa0nbsp　wide\x85next", *TEXTS,
    ]
    for texts in (odd, odd[:1], []):
        ids, starts = packing.ids_of(packing.pa.array(texts, "string"), path)
        want = [[*tok.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == want


def test_neighbours(spark):
    random = np.random.default_rng(0)
    x = random.standard_normal((3000, 16)).astype(np.float32)
    x[100:130] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [1.0] * 3), (None, x[1].tolist()), (0, x[0].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {}
    for q, rank, v, s in sorted(rows_of(neighbours.nearest(df, lambda i: i % 100 == 0))):
        got.setdefault(q, []).append((v, s))
        assert len(got[q]) == rank
    hits = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        best = [i for i in np.lexsort((np.arange(3000), d)) if i != q][:10]
        assert len(got[q]) == 10 and all(d[v] == s for v, s in got[q])
        hits += len(set(best) & {v for v, _ in got[q]})
    assert set(got) == set(range(0, 3000, 100)) and hits >= 0.9 * 300
    assert [v for v, _ in got[0]] == list(range(100, 110))
    few = df.where("vec_id IN (100, 200, 300)")
    assert neighbours.nearest(few, lambda i: i == 100).count() == 2
    assert neighbours.nearest(df.limit(0), lambda i: i % 100 == 0).count() == 0


def test_marginals_by_enumeration():
    random = np.random.default_rng(3)
    lean, steps = random.standard_normal((1, 4)), random.standard_normal((2, 2))
    good, pairs, total = quality.marginals(lean, np.array([4]), steps)
    weight, on = 0.0, np.zeros(4)
    for k in range(16):
        y = [k >> t & 1 for t in range(4)]
        w = np.exp(sum(lean[0, t] * y[t] for t in range(4)) + sum(steps[a, b] for a, b in zip(y, y[1:])))
        weight += w
        on += w * np.array(y)
    assert np.allclose(good[0], on / weight) and np.isclose(total[0], np.log(weight)) and np.isclose(pairs.sum(), 3)


def test_quality(spark, docs):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.digest(d, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 40 and np.mean([r.predicted == r.quality for r in got]) > 0.9
    out = quality.digest(docs, labels)
    assert out.count() == docs.count() and out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_quality_learns_from_long_documents(spark):
    """Labelled documents above SAMPLE_LINES lines are learned from by a run of their lines."""
    good = "\n".join(f"The river reached town number {i} late in the evening, and people came to look." for i in range(100))
    bad = "\n".join("BUY NOW!!! | 100 % FREE | CLICK | CLICK | WIN 999 !!!" for i in range(100))
    rows = [(i, good if i % 2 else bad) for i in range(60)]
    d = spark.createDataFrame([*rows, (None, good)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    assert all(r.predicted == r.doc_id % 2 for r in quality.digest(d, labels).where("doc_id IS NOT NULL").collect())


def test_quality_with_repeated_ids_is_the_same_each_time(spark):
    rows = [(i % 7, f"line {i} of text\n" * (i % 9 + 1) + "!!! | 5 5 5" * (i % 3)) for i in range(90)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, quality int")
    first, again = quality.learn(d.repartition(3), labels, sample=5), quality.learn(d.repartition(5), labels, sample=5)
    assert np.array_equal(first.weights, again.weights) and np.array_equal(first.steps, again.steps)


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert 0 < out.select("doc_id").distinct().count() < docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
