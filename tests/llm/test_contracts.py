"""The registered queries on a small folder of tables: the columns, types and laws of their contracts, and parts against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cellscore.llm import op1_language, op3_shards, op4_toxicity, op9_simhash, registry
from cellscore.llm.tokens import Encoder
from cellscore.llm.op7_pack import public_tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def held(i, mod, rest):
    return zlib.crc32(str(i).encode()) % mod == rest


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    words = {"en": "the of and river house green stone water".split(), "fr": "été forêt une maison garçon très ça petit".split()}
    made = []
    for i in range(120):
        lang = "fr" if i % 4 == 0 else "en"
        made.append((i, " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "a"]) for _ in range(rng.randint(3, 150))) + ".", lang, f"h{i % 3}"))
    made[3], made[4], made[5] = (3, None, "en", None), (4, "", None, "h1"), (5, "1 2 !!", "en", "h1")
    made[6] = (6, made[7][1], "en", "h2")
    made[8] = (8, made[8][1] + " password=hunter22 0123456789abcdef01234567", "en", "h2")
    made.append((9, made[9][1], "en", "h0"))
    return made


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = tmp_path_factory.mktemp("contracts")
    docs = spark.createDataFrame([*rows, (None, rows[10][1], "en", "h0")], "doc_id long, text string, lang string, source string")
    docs.withColumn("n_chars", F.char_length("text").cast("long")).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(rows[20][1].split()[:12])), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(0, 90)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


CONTRACT = {
    "op1_language_filters": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2_benchmark_windows": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op3_kd_shards": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op4_toxicity_pu": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_secret_layers": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op6_context_mixing": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op7_dynamic_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op8_host_quality": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op9_simhash_bktrees": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op10_hidden_markov": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
}


@pytest.fixture(scope="module")
def found(spark, folder):
    """Rows of a query, asked for once."""
    kept = {}

    def ask(name):
        if name not in kept:
            df = registry.queries()[name](spark, folder)
            kept[name] = (dict(df.dtypes), [r.asDict() for r in df.collect()])
        return kept[name]

    return ask


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(found, rows, name):
    """Types as the contract has them, and every row of documents, that without an id and repeated ones included."""
    kinds, got = found(name)
    assert {c: kinds.get(c) for c in CONTRACT[name]} == CONTRACT[name]
    if name != "op7_dynamic_packing":
        assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(map(str, [*(r[0] for r in rows), None]))


def test_flags_of_the_queries(found, rows):
    texts = {i: t or "" for i, t, _, _ in rows}
    for name, mod, rest in (("op1_language_filters", 3, 1), ("op4_toxicity_pu", 5, 0), ("op10_hidden_markov", 5, 1)):
        assert all(r["held_out"] == held(r["doc_id"], mod, rest) for r in found(name)[1] if r["doc_id"] is not None), name
    assert {r["lang_pred"] for r in found("op1_language_filters")[1] if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in found("op4_toxicity_pu")[1])
    for r in found("op2_benchmark_windows")[1]:
        assert r["contaminated"] == (r["n_hit"] > 0) and r["items_sha256"] == hashlib.sha256(b"1" if r["n_items"] else b"").hexdigest()
    assert {r["doc_id"] for r in found("op2_benchmark_windows")[1] if r["contaminated"]} == {20}
    (secret,) = (r for r in found("op5_secret_layers")[1] if r["doc_id"] == 8)
    at = texts[8].index("password")
    base = f"assign:{at}:{at + 17},hex:{at + 18}:{at + 42}"
    assert (secret["n_assign"], secret["n_access"], secret["n_hex"], secret["spans"], secret["base_sha256"]) == (1, 0, 1, base, hashlib.sha256(base.encode()).hexdigest())
    shards = found("op3_kd_shards")[1]
    assert {r["law"] for r in shards} == {"bytes"} and {r["grown_shard"] for r in shards} == {None} and {r["shard"] for r in shards} <= set(range(24))
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), texts[9]))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    fp = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert {(r["fingerprint"], r["component_id"]) for r in found("op9_simhash_bktrees")[1] if r["doc_id"] == 9} == {(f"{fp:016x}", 9)}
    assert {r["component_id"] for r in found("op9_simhash_bktrees")[1] if r["doc_id"] in (6, 7)} == {6}
    lowered = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = lambda t: [*WORD.findall(lowered(t)), None]
    counts = collections.Counter(x for i, t, _, _ in rows if i is not None and not held(i, 5, 1) for x in tokens(t))
    whole = sum(counts.values())
    for r in found("op10_hidden_markov")[1]:
        if r["doc_id"] is not None:
            mine = tokens(texts[r["doc_id"]])
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(r["doc_id"], 5, 1), len(mine), sum(x in counts for x in mine), whole)
            base = sum(math.log10((counts[x] + 0.5) / (whole + 0.5 * (len(counts) + 1))) for x in mine)
            assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isfinite(r["score"])


def test_ids_of_the_queries(found, rows):
    texts = {i: t or "" for i, t, _, _ in rows}
    for name, file, end in (("op6_context_mixing", "word_bpe_49k.json", 2), ("op7_dynamic_packing", "byte_bpe_50k.json", 0)):
        library = Encoder(public_tokenizer(file)).tokenizer
        for r in found(name)[1]:
            if r["doc_id"] is None:
                continue
            ids = [*library.encode(texts[r["doc_id"]], add_special_tokens=False).ids, end]
            part = ids if name.startswith("op6") else ids[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"] and r.get("n_tokens", r.get("doc_tokens")) == len(ids)
    for s in range(24):
        mine = [r["slot"] for r in found("op3_kd_shards")[1] if r["shard"] == s]
        assert sorted(mine) == list(range(len(mine)))


def brute_tree(rows, leaves, first, dimensions):
    """Leaf of each row, by sorting a node's rows and cutting where the left side's bytes come nearest to its share."""
    if leaves == 1 or not rows:
        return {r["row"]: first for r in rows}
    d = max(range(dimensions), key=lambda k: max(r[f"d{k}"] for r in rows) - min(r[f"d{k}"] for r in rows))
    rows = sorted(rows, key=lambda r: (r[f"d{d}"], r["tie"]))
    goal, upto = sum(r["size"] for r in rows) * (leaves // 2) / leaves, 0
    for i, r in enumerate(rows):
        upto += r["size"]
        if upto >= goal:
            cut = i + (goal - (upto - r["size"]) > r["size"] / 2)
            break
    left = leaves // 2
    return brute_tree(rows[:cut], left, first, dimensions) | brute_tree(rows[cut:], leaves - left, first + left, dimensions)


@pytest.mark.parametrize("shards", [2, 7, 24, 60])
def test_tree_against_brute_force(spark, folder, shards):
    rows = op3_shards._metadata(spark.read.parquet(f"{folder}/documents.parquet"), ["lang", "source"]).cache()
    wanted = brute_tree([r.asDict() for r in rows.collect()], shards, 0, 3)
    assert {r["row"]: r["shard"] for r in op3_shards.grow(rows, shards, 3).collect()} == wanted
    rows.unpersist()


def test_counts_of_languages_against_brute_force(spark, rows):
    """Filters of one hash over a large table: n-grams, masks and corrected counts as sets would give them."""
    texts = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for _, t, _, _ in rows[20:40]]
    keys, owner = op1_language.grams(pa.array(texts, pa.large_string()))

    def brute(text):
        shown = re.sub(rb"[^a-z\x80-\xff]+", b" ", b" " + text.encode() + b" ")
        return [bytes(shown[i : i + n]) for n in op1_language.LENGTHS for i in range(len(shown) - n + 1)]

    assert np.bincount(owner).tolist() == [len(brute(t)) for t in texts]
    assert len(set(keys.tolist())) == len({g for t in texts for g in brute(t)})
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    filters = op1_language.fit(docs, least=1, share=0.0, size=1 << 20)
    of = {lang: {g for _, t, x, _ in rows if x == lang and t for g in brute(t)} for lang in ("en", "fr")}
    counts, total = filters.counts(pa.array(texts, pa.large_string()))
    for i, t in enumerate(texts):
        for j, lang in enumerate(filters.languages):
            assert counts[i, j] == pytest.approx(sum(g in of[lang] for g in brute(t)), abs=0.02 * total[i] + 1)


def test_steps_follow_the_non_negative_risk():
    """Training against the same descent with the risk and its gradient written out row by row."""
    rng = np.random.default_rng(6)
    n, prior, positive = 60, 0.2, np.arange(60) < 20
    owner = np.repeat(np.arange(n), 4)
    ids = rng.integers(0, 12, 4 * n)
    ids[owner < 20] = rng.integers(8, 14, 80)
    values = rng.random(4 * n) + 0.5
    kept = op4_toxicity.telling(owner, ids, positive)
    dense = np.zeros((n, op4_toxicity.WIDTH), np.float32)[:, :20].astype(float)
    np.add.at(dense, (owner, ids), np.where(kept[ids], values, 0.0))
    w, b = np.zeros(20), math.log(prior / (1 - prior))
    m, v, ups = np.zeros(21), np.zeros(21), 0
    for t in range(1, 81):
        g = dense @ w + b
        sigma = 1 / (1 + np.exp(-g))
        minus = lambda rows: np.mean([math.log1p(math.exp(x)) for x in g[rows]])  # noqa: B023, E731
        d_minus = lambda rows: np.append(dense[rows].T @ sigma[rows], sigma[rows].sum()) / rows.sum()  # noqa: B023, E731
        d_plus = np.append(dense[positive].T @ (sigma[positive] - 1), (sigma[positive] - 1).sum()) / positive.sum()
        risk, slope = minus(~positive) - prior * minus(positive), d_minus(~positive) - prior * d_minus(positive)
        ups += risk < 0
        grad = (slope + prior * d_plus if risk >= 0 else -slope) + np.append(1e-4 * w, 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - np.where(kept[:20], step[:-1], 0), b - step[-1]
    got = op4_toxicity.train(owner, ids, values, positive, prior, rounds=80)
    used = np.flatnonzero(kept[:20])
    assert got[used] == pytest.approx(w[used], abs=1e-6) and got[-1] == pytest.approx(b, abs=1e-6) and len(used) > 2


def test_unlabelled_rows_have_no_label(spark):
    """Documents without a label are the unlabelled sample: what only they hold gets a weight, what only clean labelled ones hold gets none."""
    rows = [(i, f"base toxicword alpha{i % 3}" if i % 10 == 0 else f"base cleanword beta{i % 3}" if i < 200 else f"base openword gamma{i % 3}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(200)], "doc_id long, toxic int")
    weights = op4_toxicity.fit(docs, labels, models=1)
    of = lambda w: weights[zlib.crc32(w.encode()) & (op4_toxicity.WIDTH - 1)]
    assert of("openword") < 0 and of("cleanword") == 0 and of("toxicword") > 0


@pytest.mark.parametrize("blocks", [4, 5, 6])
def test_no_link_is_lost_with_longer_keys(spark, monkeypatch, blocks):
    monkeypatch.setattr(op9_simhash, "block_count", lambda n, bits, radius: blocks)
    rng = np.random.default_rng(blocks)
    centres = [int(x) for x in rng.integers(0, 1 << 62, 40)]
    values = sorted({c ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for c in centres for k in (0, 1, 2, 3, 4)})
    df = spark.createDataFrame([([v - (1 << 64) if v >> 63 else v], i) for i, v in enumerate(values)], "fp array<bigint>, id long")
    found = {r["id"]: r["label"] for r in op9_simhash.components(op9_simhash.links(df)).collect()}
    label = list(range(len(values)))
    while True:
        new = [min(label[j] for j in range(len(values)) if (values[i] ^ values[j]).bit_count() <= 3) for i in range(len(values))]
        if new == label:
            break
        label = new
    assert all(found.get(i, i) == x for i, x in enumerate(label))
    monkeypatch.undo()
    assert [op9_simhash.block_count(n, 64, 3) for n in (0, 10**7, 10**9, 10**12)] == [4, 4, 5, 6]


def test_majorities_of_long_texts(monkeypatch):
    monkeypatch.setattr(op9_simhash, "FOLDED", 8)
    rng = np.random.default_rng(3)
    lengths = [1, 3, 30, 2, 8, 9, 1]
    hashes, offsets = rng.integers(0, 1 << 63, sum(lengths)).astype(np.uint64), np.cumsum([0, *lengths])
    lists = [hashes[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert op9_simhash.majority(hashes, offsets).tolist() == op9_simhash.fold(lists).tolist()
