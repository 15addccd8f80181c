"""Operators 11 to 13 against brute force, with the odd cases of their docstrings."""

import hashlib
import itertools
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellscore.llm import op11_whitening as white
from cellscore.llm import op12_parsing as parse
from cellscore.llm import op13_negatives as hard

SF = "/root/testdata/sf0.001"


# 11


class Dense:
    def __init__(self, x):
        self.matrix = np.cov(x.T, bias=True).reshape(x.shape[1], x.shape[1])

    def __matmul__(self, block):
        return self.matrix @ block


def cases():
    rng = np.random.default_rng(5)
    yield "noise", rng.integers(0, 1000, (400, 40))
    yield "few dimensions", rng.integers(0, 1000, (50, 3))
    yield "few rows", rng.integers(0, 1000, (3, 30))
    yield "decaying", (rng.normal(size=(600, 60)) * 1e4 / np.arange(1, 61) ** 2).astype(np.int64)
    yield "copies of eigenvalues", np.array(list(itertools.product([0, 7], repeat=12)))
    yield "one large", np.concatenate([rng.integers(0, 4, (500, 20)), rng.integers(0, 10**6, (500, 1))], axis=1)


@pytest.mark.parametrize("x", [x for _, x in cases()], ids=[n for n, _ in cases()])
def test_jacobi_davidson_gives_the_leading_eigenpairs(x):
    a = Dense(x)
    found = white.jacobi_davidson(a, x.shape[1])
    true = np.linalg.eigvalsh(a.matrix)[::-1][: len(found.values)]
    assert np.abs(found.values - true).max() <= 1e-13 * true[0]
    assert np.abs(a.matrix @ found.vectors - found.vectors * found.values).max() <= 1e-13 * true[0]
    assert np.abs(found.vectors.T @ found.vectors - np.eye(len(true))).max() < 1e-13


def test_minres_solves_symmetric_indefinite_systems():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    m = q @ np.diag(np.arange(-5.5, 6.5)) @ q.T
    b = rng.normal(size=(12, 3))
    assert np.abs(m @ white.minres(lambda v: m @ v, b, 40, 1e-14) - b).max() < 1e-9
    assert not white.minres(lambda v: m @ v, np.zeros((12, 2)), 5, 1e-3).any()


def vectors(spark, rows, path):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n long, x string, component int").repartition(2).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_whitened_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=6).astype(np.float32)], 1, 0, "x", 3) for i in range(60)]
    rows += [rows[3], rows[3], (None, rows[5][1], None, None, None, None), (70, None, 1, 0, "", 0), (71, [float("nan")] * 6, 1, 0, "", 0), (72, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, 0, "", 0), (73, [float("inf")] * 6, 1, 0, "", 0), (74, [], 1, 0, "", 0)]
    got = white.query(spark, vectors(spark, rows, tmp_path)).collect()
    kept = [r for r in rows if r[1] and all(v is not None and np.isfinite(v) for v in r[1])]
    x = np.floor(1024 * np.array([r[1] for r in kept], np.float32).astype(float)).astype(np.int64) + 100000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(got) == n * 6
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    assert len(by[(3, 1)]) == 3 and len(by[(None, 6)]) == 1
    w = c @ u / np.sqrt(e)
    for j in range(6):
        pairs = [(by[(r[0], j + 1)][0].whitened, w[i, j]) for i, r in enumerate(kept)]
        sign = np.sign(sum(a * b for a, b in pairs))
        assert max(abs(a - sign * b) for a, b in pairs) < 1e-9
    deviation = ((n * x - s) ** 2).sum(axis=1)
    for i, r in enumerate(kept):
        assert {g.deviation for g in by[(r[0], 1)]} == {int(deviation[i])}
    assert {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-12
    assert all(abs(r.explained - e[r.component - 1] / e.sum()) < 1e-12 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0, 0, "", 0)], [(i, [3.0, 3.0], 0, 0, "", 0) for i in range(5)]])
def test_no_component_without_spread(spark, tmp_path, rows):
    found = white.query(spark, vectors(spark, rows, tmp_path))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and found.count() == 0


def test_vectors_of_different_lengths_are_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="entries"):
        white.query(spark, vectors(spark, [(1, [1.0], 0, 0, "", 0), (2, [1.0, 2.0], 0, 0, "", 0)], tmp_path))


# 12


def brute_levels(text):
    """Names and lengths of phrases, symbol by symbol."""
    symbols, out = list(text.encode()), []
    while len(symbols) > 1 or not out:
        labels = [s & 1 if i == 0 else None for i, s in enumerate(symbols)]

        def toss(values):
            new = [values[0] & 1]
            for p, c in zip(values, values[1:]):
                place = ((p ^ c) & -(p ^ c)).bit_length() - 1 if p != c else 0
                new.append(2 * place + (c >> place & 1))
            return new

        labels = symbols
        for _ in range(3 if not out else 4):
            labels = toss(labels)
        labels = [0 if i and symbols[i] == symbols[i - 1] else v + 1 for i, v in enumerate(labels)]
        starts = [0] + [i for i in range(1, len(symbols) - 1) if labels[i - 1] < labels[i] >= labels[i + 1]]
        phrases = [tuple(symbols[a:b]) for a, b in zip(starts, [*starts[1:], len(symbols)])]
        out.append(phrases)
        symbols = yield phrases
        if symbols is None:
            return


def texts_to_parse():
    rng = random.Random(3)
    base = "".join(rng.choice("abcdef ghij") for _ in range(400))
    return ["", "a", "aa", "ab", "aba", "a" * 300, "ab" * 200, "abc" * 99 + "é", base, base[7:], "ß" + base, base[:200] + "XX" + base[200:], "日本語のテキスト" * 5, "\x00\x00\x01", "é"]


def test_phrases_are_those_of_the_plain_rules():
    texts = texts_to_parse()
    flat, offsets = parse.utf8(pa.array(texts, pa.large_string()))
    by = {i: [] for i in range(len(texts))}
    for _level, owner, names, lengths in parse.levels(flat, offsets):
        for i in set(owner.tolist()):
            by[i].append((names[owner == i].tolist(), lengths[owner == i].tolist()))
    names_of = {}
    for i, text in enumerate(texts):
        if not text:
            assert not by[i]
            continue
        run = brute_levels(text)
        phrases = next(run)
        for level, (names, lengths) in enumerate(by[i]):
            assert lengths == [len(p) for p in phrases]
            for name, p in zip(names, phrases):  # equal phrases, and no others, have equal names
                assert names_of.setdefault((level, p), name) == name
            assert all(n >= 2 for n in lengths[1:])
            if len(names) == 1:
                break
            phrases = run.send(names)
    assert len(set(names_of.values())) == len(names_of)


def test_equal_substrings_share_their_interior_at_any_offset():
    rng = random.Random(9)
    shared = "".join(rng.choice("abcdefghijklmnop ") for _ in range(3000))
    texts = ["".join(rng.choice("qrstuvwxyz") for _ in range(rng.randint(1, 200))) + shared + "zq" * rng.randint(0, 9) for _ in range(12)]
    flat, offsets = parse.utf8(pa.array(texts, pa.large_string()))
    for level, owner, names, _ in parse.levels(flat, offsets):
        if level in (1, 2, 3, 4):
            sets = [set(names[owner == i].tolist()) for i in range(len(texts))]
            common = set.intersection(*sets)
            alone = {n for lv, _, ns, _ in parse.levels(*parse.utf8(pa.array([shared], pa.large_string()))) if lv == level for n in ns.tolist()}
            assert len(common) >= len(alone) - 8


def brute_likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    union = sorted(a[1] | b[1])[: parse.SKETCH]
    return sum(x in a[1] and x in b[1] for x in union) / max(1, len(union))


def test_likeness_and_round_trip():
    roots, signatures, offsets = parse.parsed(pa.array(texts_to_parse(), pa.large_string()))
    strings = parse.written(roots, signatures, offsets)
    again = parse.read_back(strings)
    assert all((x == y).all() for x, y in zip(again, (roots, signatures, offsets)))
    sets = [(int(roots[i]), set(signatures[offsets[i] : offsets[i + 1]].tolist())) for i in range(len(roots))]
    pairs = list(itertools.product(range(len(roots)), repeat=2))
    got = parse.likeness(roots, signatures, offsets, np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    assert got.tolist() == [brute_likeness(sets[i], sets[j]) for i, j in pairs]


def expected_edits(rows):
    import xxhash

    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), xxhash.xxh64_intdigest((r[1] or "").encode(), 42) - (xxhash.xxh64_intdigest((r[1] or "").encode(), 42) >> 63 << 64)))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        out.append((doc_id, text, text[: len(text) - half] + following[:half], following))
    return out


@pytest.mark.parametrize("drawn", [64, 2])
def test_edited_texts_and_their_likeness(spark, monkeypatch, drawn):
    monkeypatch.setattr(parse, "DRAWN", drawn)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgßij") for _ in range(rng.randint(1, 8)))
    rows = [(rng.randint(-5, 400), " ".join(word() for _ in range(rng.choice([0, 1, 5, 60, 300])))) for _ in range(150)]
    rows += [(7, None), (8, ""), (None, "no id at all"), (None, None), (9, "x " * 20000), (9, "y"), (9, "y")] + [(200, "hot row, the same")] * 120
    docs = spark.createDataFrame([(*r, "t", 1, 2) for r in rows], "doc_id long, text string, part string, h int, copies int").repartition(5)
    got = parse.with_edited(docs).collect()
    want = expected_edits(rows)
    texts = [w[1] for w in want] + [w[2] for w in want] + [w[3] for w in want]
    found = parse.parsed(pa.array(texts, pa.large_string()))
    strings, n, i = parse.written(*found), len(want), np.arange(len(want))
    near_edited, near_next = parse.likeness(*found, i, n + i), parse.likeness(*found, i, 2 * n + i)
    lines = [(w[0], len(w[1]), hashlib.sha256(w[2].encode()).hexdigest(), strings[j], strings[n + j], float(near_edited[j]), float(near_next[j])) for j, w in enumerate(want)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, lines))
    alone = {(r.doc_id, r.fingerprint) for r in parse.fingerprints(docs).collect()}
    assert alone == {(r.doc_id, r.fingerprint) for r in got}


def test_edits_of_one_or_no_document(spark):
    docs = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    only = parse.with_edited(docs).first()
    assert only.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and only.near_next == 1.0
    assert parse.with_edited(docs.limit(0)).count() == 0


def test_halves_are_near_and_others_are_not(spark):
    got = parse.query(spark, "/root/testdata/sf0.01").toPandas()
    long = got[got.n_chars > 300]
    assert long.near_edited.median() > 0.25 and long.near_next.median() < 0.1
    assert (got.near_edited > got.near_next).mean() > 0.95


# 13


def brute_negatives(rows):
    kept = []
    for place, (i, e, label) in enumerate(rows):
        if label is None or e is None or any(v is None or not np.isfinite(v) for v in e):
            continue
        kept.append((i, [int(np.floor(256 * float(np.float32(v)))) for v in e], (label + 1) % 10 if i is not None and i % 7 == 0 else label, place))
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for a in kept:
        if a[0] is None or a[0] % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a[1], r[1])), r[0], r[2]) for r in kept if r is not a]
        same = sorted((s for s in scored if s[2] == a[2]), key=order)[:5]
        for p in same:
            below = sorted((s for s in scored if s[2] != a[2] and 30 * p[0] <= 100 * s[0] <= 90 * p[0]), key=order)[:10]
            out += [(a[0], p[1], n + 1, s[1], p[0], s[0]) for n, s in enumerate(below)]
    return sorted(map(repr, out))


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("small", [False, True])
def test_negatives_of_all_windows(spark, tmp_path, monkeypatch, small):
    if small:
        monkeypatch.setattr(hard, "ANCHOR_BYTES", 100)
        monkeypatch.setattr(hard, "ROW_BYTES", 4000)
    rng = np.random.default_rng(8)
    rows = [(i, [float(v) for v in rng.integers(-3, 9, 4) / 8], int(rng.integers(0, 4))) for i in range(0, 720)]
    rows += [(None, rows[7][1], 1), (1001, None, 2), (1002, [float("nan")] * 4, 1), (1003, [0.5, None, 0.5, 0.5], 1), (1100, rows[9][1], None), (1200, [float("inf")] * 4, 1)]
    rows += [(2000 + i, rows[100][1], 2) for i in range(300)]
    spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, row int, id int").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = hard.query(spark, str(tmp_path)).collect()
    assert sorted(repr(tuple(r[c] for c in COLUMNS)) for r in got) == brute_negatives(rows)


def test_negatives_by_sql(spark):
    got = sorted(tuple(r[c] for c in COLUMNS) for r in hard.query(spark, SF).collect())
    duck = duckdb.connect()
    duck.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert got == sorted(duck.sql(hard.ORACLE_SQL).fetchall()) and got


def test_negatives_of_few_rows(spark, tmp_path):
    schema = "vec_id long, embedding array<float>, label int"
    for name, rows in {"none": [], "alone": [(100, [1.0], 1)], "same": [(100, [1.0], 1), (201, [2.0], 1)], "other": [(100, [1.0], 1), (201, [2.0], 2)]}.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        assert hard.query(spark, f"{tmp_path}/{name}").count() == 0
    spark.createDataFrame([(100, [1.0], 1), (100, [1.0], 1), (2, [0.5], 2)], schema).write.parquet(f"{tmp_path}/twice/embeddings.parquet")
    got = [tuple(r[c] for c in COLUMNS) for r in hard.query(spark, f"{tmp_path}/twice").collect()]
    assert got == [(100, 100, 1, 2, 65536, 32768)] * 2


def test_scores_beyond_exact_doubles_are_an_error():
    with pytest.raises(OverflowError):
        hard.best(np.array([[3e8]]), np.array([[3e8]]), 1, 1, lambda i, j, s: np.zeros(s.shape))
