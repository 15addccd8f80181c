"""The pipeline's stages: what goes, what stays, and which columns come out."""

import random

import numpy as np
import pytest

import corpus_pipeline as cp

VOCABULARY = "the of and with thing over river house green little stone water road field light morning paper window story garden".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice(VOCABULARY) + rng.choice(["", "a", "er", "ing", "o"]) for _ in range(n)) + "."
    rows = [(i, text(rng.randint(30, 300)), "en", "s") for i in range(40)]
    leak = text(25)
    rows[3] = (3, rows[2][1], "en", "s")
    rows[5] = (5, None, "en", "s")
    rows[6] = (6, "12345 67890", "en", "s")
    rows[7] = (7, rows[7][1] + " " + leak, "en", "s")
    rows[8] = (8, rows[8][1] + " token = 'abcdef0123456789abcdef01'", "en", "s")
    path = tmp_path_factory.mktemp("tables")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.selectExpr("*", "cast(char_length(text) as bigint) as n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, set(range(40))
    gone = {"language": {5, 6}, "near_duplicates": {3}, "decontamination": {7}, "secrets": set()}
    assert [n for n, _ in cp.STAGES] == [*gone, "packing"]
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        kept -= gone[name]
        assert docs.columns == columns and {r["doc_id"] for r in docs.select("doc_id").collect()} == kept, name
    secret = docs.where("doc_id = 8").first()
    assert "abcdef0123456789" not in secret["text"] and secret["n_chars"] == len(secret["text"])
    pieces = cp.STAGES[-1][1](spark, docs, folder).collect()
    assert {p["doc_id"] for p in pieces} == kept and all(len(p["ids"]) == 4 * p["length"] for p in pieces)
    whole = {p["doc_id"]: p["doc_tokens"] for p in pieces}
    assert {i: int(np.sum([p["length"] for p in pieces if p["doc_id"] == i])) for i in whole} == whole


def test_run_is_the_stages_in_order(spark, folder):
    out = cp.run(spark, folder)
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == set(range(40)) - {3, 5, 6, 7}


def test_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        found = stage(spark, docs, folder)
        assert found.count() == 0, name


def test_odd_rows_go_through_all_stages(spark, folder, tmp_path):
    """Clashing names, repeated rows, null ids, ids with several texts, and a text of 20,000 words, stage by stage."""
    rng = random.Random(18)
    text = lambda n: " ".join(rng.choice(VOCABULARY) + rng.choice(["", "a", "er", "ing", "o"]) for _ in range(n)) + "."
    rows = [(i, text(60), "en" if i % 3 else None, None, None) for i in range(30)]
    rows += [rows[4], rows[4], (5, text(60), "en", "s", 1), (None, text(60), "en", "s", 1), (None, None, None, None, None), (40, text(20_000), "en", "s", 1), (41, "", "en", "s", 1), (42, rows[2][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as id", "'x' as row", "2 as label", "3L as fp", "true as secrets", "'k' as keys", "0 as _same", "4 as part")
    columns = docs.columns
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept = sorted((r["doc_id"] is None, r["doc_id"] or 0, len(r["text"])) for r in docs.select("doc_id", "text").collect())
        whole = sorted((r[0] is None, r[0] or 0, len(r[1])) for r in rows if r[1])
        if name == "language":
            assert kept == whole
        else:  # the repeats of one row, and the copy under another id, are gone
            assert kept == sorted(set(whole) - {(False, 42, len(rows[2][1]))})
    pieces = cp.STAGES[-1][1](spark, docs, folder)
    assert pieces.where("doc_id = 40").agg({"length": "sum"}).first()[0] == pieces.where("doc_id = 40").first()["doc_tokens"] > 20_000
    assert pieces.select("doc_id").distinct().count() == 32


def test_memory_of_a_worker(spark, folder, monkeypatch):
    """Two megabytes of text in one batch are worked off in steps of little memory, freed memory goes back, and no rows come from the driver."""
    import tracemalloc

    import pyarrow as pa

    from cellscore.llm import arrays

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kind, found = type(docs), {}
    mapped = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, *a, **b: (found.setdefault(getattr(f, "__wrapped__", f).__name__, f), mapped(self, f, *a, **b))[1])
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    cp.language(spark, docs, folder)
    score, tally = found["score"], found["tally"]
    cp.near_duplicates(spark, docs, folder)
    mark = found["mark"]
    found.clear()
    cp.packing(spark, docs, folder)
    rng = random.Random(9)
    texts = [" ".join(rng.choice(VOCABULARY) + rng.choice("aeiou") for _ in range(300)) for _ in range(1000)]
    n = len(texts)
    columns = {"doc_id": range(n), "text": texts, "lang": ["en"] * n, "source": ["s"] * n, "n_chars": map(len, texts), "k": pa.array([0] * n, pa.int32()), "_same": [b"x"] * n, "_size": [1] * n}
    batch = pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else list(v) for k, v in columns.items()})
    returned = []
    monkeypatch.setattr(arrays, "give_back", lambda: returned.append(1))
    peaks = {}
    for name, run in (("score", score), ("tally", tally), ("mark", mark), ("run", found["run"])):
        for _ in run(iter([batch.slice(0, 1)])):  # what a worker loads once
            pass
        tracemalloc.start()
        for _ in run(iter([batch])):
            pass
        peaks[name] = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
    assert len(returned) == 8
    assert all(peaks[k] <= most for k, most in {"score": 20, "tally": 30, "mark": 35, "run": 12}.items()), peaks
