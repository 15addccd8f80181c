"""Merged sketches, the store by term and the store of runs."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscore.operators import scores as sc
from cellscore.operators import stores as st
from cellscore import fixtures as fx

LABELS = ["A", "B", "C"]


@pytest.fixture(scope="module")
def matrix(spark):
    """Scores of 6,000 cells in two groups; T0 in all, T1 in 70 %, T2 in 30 % of them, small ones below the threshold included."""
    rng = np.random.default_rng(3)
    rows = [(i, t, j, float(round(rng.exponential() * (1 if rng.random() < 0.9 else 1e-5), 9))) for i in range(6000) for j, (t, p) in enumerate((("T0", 1), ("T1", 0.7), ("T2", 0.3))) if rng.random() < p]
    scores = spark.createDataFrame(rows, "cell_id long, term_id string, idx int, score double").cache()
    cells = spark.range(6000).selectExpr("id as cell_id", "if(id % 3 = 0, 'x', 'y') as cluster").cache()
    terms = spark.createDataFrame([(f"T{i}", i) for i in range(4)], "term_id string, idx int")
    return scores, cells, terms, rows


@pytest.mark.parametrize("by", [None, "cluster"])
def test_merged_sketches_are_within_the_rank_error(matrix, by):
    scores, cells, terms, rows = matrix
    parts = [st.sketch_scores(scores, cells.where(f"cell_id % 5 in ({some})"), by=by) for some in ("0, 1", "2", "3, 4")]
    first = st.merged_sketches(parts[0].unionByName(parts[1]))
    got = {(r["grp"], r["term_id"]): r for r in st.sketched_aggregates(st.merged_sketches(first.unionByName(parts[2])), terms).collect()}
    exact = {(r["grp"], r["term_id"]): r for r in sc.aggregate_scores(scores, cells, terms, by=by).collect()}
    assert got.keys() == exact.keys() and len(got) == 4 * (2 if by else 1)
    dense = np.zeros((6000, 4))
    for i, _, j, v in rows:
        dense[i, j] = v
    for (grp, term), r in got.items():
        for c in ("mean_all", "mean_over", "fraction"):
            assert r[c] == pytest.approx(exact[grp, term][c])
        own = dense[[i for i in range(6000) if not by or ("x" if i % 3 == 0 else "y") == grp], int(term[1])]
        for c, values in (("median_all", own), ("median_over", own[own > sc.THRESHOLD])):
            if len(values):
                low, high = (values < r[c]).mean(), (values <= r[c]).mean()
                assert low - st.RANK_ERROR <= 0.5 <= high + st.RANK_ERROR, (grp, term, c)
            else:
                assert r[c] == 0.0


def test_a_state_is_small_and_bound_by_its_size(matrix):
    scores, cells, _, _ = matrix
    state = st.sketch_scores(scores, cells).where("term_id = 'T0'")
    assert state.select(F.octet_length("sketch")).first()[0] < 6000 * 8 / 3


def test_a_term_is_read_from_its_bucket_alone(spark, matrix, tmp_path):
    scores, cells, _, _ = matrix
    path = f"{tmp_path}/terms"
    st.write_term_store(path, scores)
    one = st.term_scores(spark, path, "T1")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, scores.where("term_id = 'T1'").collect()))
    plan = one._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    assert "PartitionFilters: [isnotnull(term_bucket" in plan.toString() and leaf.metrics().apply("numPartitions").value() == 1
    buckets = {p.name for p in Path(path).iterdir() if p.name.startswith("term_bucket")}
    assert 1 < len(buckets) <= 3
    assert st.term_scores(spark, path, "nowhere").count() == 0
    a, b = (sorted(map(tuple, sc.term_score_opacity(s, cells, "T1").collect())) for s in (one, scores))
    assert a == b


def runs(spark, *rows):
    matrix = spark.createDataFrame([(m, s, k, t, p, n) for m, s, k, t, p, n, *_ in rows], "model_name string, test_sample string, k int, true_label string, pred_label string, n long")
    return matrix, matrix.select("model_name", "test_sample").distinct().withColumn("label_order", F.array(*map(F.lit, LABELS)))


def summed(spark, path):
    return {tuple(r)[:4]: r["n"] for r in st.read_groups(spark, path).collect()}


def test_runs_are_replaced_and_only_their_groups_are_summed_again(spark, tmp_path):
    path = f"{tmp_path}/store"
    st.put_runs(path, *runs(spark, ("m", "s1", 1, "A", "A", 5), ("m", "s1", 2, "A", "A", 6), ("m", "s2", 1, "A", "B", 2), ("o", "s1", 1, "B", "B", 9)))
    whole = {("m", 1, "A", "A"): 5, ("m", 2, "A", "A"): 6, ("m", 1, "A", "B"): 2, ("o", 1, "B", "B"): 9}
    assert summed(spark, path) == whole
    others = {p: p.stat().st_mtime_ns for p in Path(path).glob("*/model_name=o/**/*.parquet")}
    assert others
    st.put_runs(path, *runs(spark, ("m", "s1", 1, "A", "A", 5), ("m", "s1", 2, "A", "A", 6)))
    assert summed(spark, path) == whole  # a run that is put twice counts once
    st.put_runs(path, *runs(spark, ("m", "s1", 1, "A", "C", 7)))
    assert summed(spark, path) == {("m", 1, "A", "C"): 7, ("m", 1, "A", "B"): 2, ("o", 1, "B", "B"): 9}  # the k that it no longer has is gone
    assert {p: p.stat().st_mtime_ns for p in Path(path).glob("*/model_name=o/**/*.parquet")} == others
    matrix, manifest = st.read_runs(spark, path)
    assert matrix.count() == 3 and {(r["model_name"], r["test_sample"]): r["total"] for r in manifest.collect()} == {("m", "s1"): 7, ("m", "s2"): 2, ("o", "s1"): 9}
    assert st.read_runs(spark, path, ["o"])[0].count() == 1


def test_guards_of_the_run_store(spark, tmp_path):
    path = f"{tmp_path}/store"
    matrix, metadata = runs(spark, ("m", "s1", 1, "A", "A", 5), ("m", "s2", 1, "A", "A", 5))
    with pytest.raises(ValueError, match="label order"):
        st.put_runs(path, matrix, metadata.where("test_sample = 's1'"))
    st.put_runs(path, matrix.where("test_sample = 's1'"), metadata)
    with pytest.raises(ValueError, match="label order"):
        st.put_runs(path, matrix.where("test_sample = 's2'"), metadata.withColumn("label_order", F.array(F.lit("A"))))
    assert summed(spark, path) == {("m", 1, "A", "A"): 5}
    matrix.where("test_sample = 's1'").withColumn("n", F.lit(1).cast("long")).write.mode("append").partitionBy("model_name", "test_sample").parquet(f"{path}/matrix")
    with pytest.raises(ValueError, match="to the end"):
        st.read_runs(spark, path)


def test_states_of_no_score(spark):
    cells, terms = spark.range(3).selectExpr("id as cell_id"), fx.terms(spark)
    none = spark.createDataFrame([], "cell_id long, term_id string, idx int, score double")
    got = st.sketched_aggregates(st.sketch_scores(none, cells), terms).collect()
    assert len(got) == 16 and all(r["median_all"] == r["mean_over"] == r["fraction"] == 0.0 for r in got)
    with pytest.raises(ValueError, match="no cell"):
        st.sketch_scores(none, cells.limit(0))
