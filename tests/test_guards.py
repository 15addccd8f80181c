"""Guards that are checked in the pass that does the work: the same errors as those of a job before, and each input row is read once."""

import pytest
from pyspark.sql import functions as F

from cellscore import sources as io
from cellscore.operators import crosswalk as cw
from cellscore.operators import metrics as mt
from cellscore.operators import runs
from cellscore.plans import Guard, cut_lineage


def counting(df):
    """df, and a counter of the rows of it that tasks have read."""
    seen = df.sparkSession.sparkContext.accumulator(0)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))  # names with dots are none for a function of columns

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return plain.mapInArrow(run, plain.schema).toDF(*df.columns), seen


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [("m", f"s{i % 2}", f"T{i % 4}", f"T{i % 3}", f"T{(i + 1) % 4}") for i in range(40)]
    return spark.createDataFrame(rows, "model_name string, test_sample string, true_label string, name_1 string, name_2 string")


def universe(spark, n):
    return spark.createDataFrame([(f"T{i}", i) for i in range(n)], "label string, pos int")


def test_guard_counts_as_rows_pass(spark):
    asked = []
    guard = Guard(spark.range(10), F.col("id") > 7, lambda: asked.append(1) or "above")
    cut_lineage(guard.frame)
    with pytest.raises(ValueError, match="above"):
        guard.verify()
    fine = Guard(spark.range(10), F.col("id") > 17, lambda: asked.append(1) or "above")
    assert fine.frame.count() == 10
    fine.verify()
    empty = Guard(spark.range(0), F.col("id") > 7, lambda: asked.append(1) or "above")
    assert empty.frame.count() == 0
    empty.verify()
    assert asked == [1]


def test_confusions_are_guarded_in_one_pass(spark, pairs):
    keys = ["model_name", "test_sample"]
    counted, seen = counting(pairs)
    guard = mt.watch_confusions(counted, "name_1", 2, keys, universe(spark, 4))
    found = cut_lineage(guard.frame)
    guard.verify()
    assert seen.value == 40
    plain = mt.build_all_confusions(pairs, "name_1", 2, keys, universe(spark, 4))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect())) and found.columns == plain.columns

    closure = spark.createDataFrame([(f"T{i}", f"T{i}") for i in range(4)], "term_id string, ancestor_id string")
    counted, seen = counting(pairs)
    tables = mt.benchmark_pipeline(counted, closure, "name_1", 2, universe(spark, 4))
    for df in tables.values():
        assert df.count() > 0
    assert seen.value == 40


def test_unknown_labels_give_the_same_error(spark, pairs):
    errors = []
    for run in (
        lambda: mt.build_all_confusions(pairs, "name_1", 2, ["model_name"], universe(spark, 2)),
        lambda: mt.benchmark_pipeline(pairs, spark.createDataFrame([], "term_id string, ancestor_id string"), "name_1", 2, universe(spark, 2)),
    ):
        with pytest.raises(ValueError) as error:
            run()
        errors.append(str(error.value))
    assert errors[0] == errors[1] == "labels outside of the universe: prediction T2, truth T2, truth T3"
    # null is the label nan; a null in the universe stands for nothing
    odd = spark.createDataFrame([("m", None, "T0")], "model_name string, true_label string, name_1 string")
    some = universe(spark, 2).unionByName(spark.createDataFrame([(None, 9)], "label string, pos int"))
    guard = mt.watch_universe(odd, some, ("true_label", "name_1"))
    assert guard.frame.collect() == odd.collect()
    with pytest.raises(ValueError, match="truth nan"):
        guard.verify()
    named = mt.watch_universe(odd, some.unionByName(spark.createDataFrame([("nan", 8)], "label string, pos int")), ("true_label", "name_1"))
    assert named.frame.count() == 1
    named.verify()


def test_a_large_universe_is_guarded_before(spark, pairs, monkeypatch):
    monkeypatch.setattr(mt, "MOST_SMALL", 1)
    with pytest.raises(ValueError, match="truth T3"):
        mt.watch_universe(pairs, universe(spark, 3), ("true_label", "name_1"))
    guard = mt.watch_universe(pairs, universe(spark, 4), ("true_label", "name_1"))
    assert guard.frame.count() == 40
    guard.verify()


def test_predictions_are_aligned_in_one_pass(spark):
    cells = spark.createDataFrame([(1, 0), (2, 1)], "cell_id long, pos long")
    rows = [(1, "a", 0.5), (2, "b", 0.5), (3, "b", 0.1)]
    predictions = spark.createDataFrame(rows, "cell_id long, `predicted.l1` string, `predicted.l1.score` double")
    counted, seen = counting(predictions)
    guard = cw.watch_predictions(cells, counted)
    assert sorted(map(tuple, guard.frame.collect())) == sorted(map(tuple, cw.align_predictions(cells, predictions).collect()))
    guard.verify()
    assert seen.value == 3
    more = cells.unionByName(spark.createDataFrame([(9, 2), (None, 3)], "cell_id long, pos long"))
    errors = []
    for run in (lambda: cw.align_predictions(more, predictions), lambda: (g := cw.watch_predictions(more, predictions), g.frame.count(), g.verify())):
        with pytest.raises(ValueError) as error:
            run()
        errors.append(str(error.value))
    assert errors[0] == errors[1] and "9" in errors[0]


def test_a_run_without_a_prediction_leaves_no_file(spark, tmp_path):
    cells = spark.createDataFrame([(1, 0), (9, 1)], "cell_id long, pos long")
    predictions = spark.createDataFrame([(1, "a", 0.5)], "cell_id long, `predicted.l1` string, `predicted.l1.score` double")
    table = spark.createDataFrame([("a", "T1", "t1")], "source_label string, term_id string, term_label string")
    with pytest.raises(ValueError, match="9"):
        runs.crosswalk_run(f"{tmp_path}/run", cells, predictions, table, None, None, None, "ref")
    assert not (tmp_path / "run").exists()


def test_matrices_without_metadata(spark, tmp_path, pairs):
    matrix = mt.build_all_confusions(pairs, "name_1", 1, ["model_name", "test_sample"])
    metadata = matrix.select("model_name", "test_sample", "k").distinct().withColumn("matrix_size", F.lit(4))
    io.write_confusion(f"{tmp_path}/a", matrix, metadata)
    guard, read = io.watch_confusion(spark, f"{tmp_path}/a")
    plain, _ = io.read_confusion(spark, f"{tmp_path}/a")
    assert sorted(map(tuple, guard.frame.collect())) == sorted(map(tuple, plain.collect())) and guard.frame.columns == plain.columns and read.count() == 2
    guard.verify()
    io.write_confusion(f"{tmp_path}/b", matrix, metadata.where("test_sample = 's0'"))
    guard, _ = io.watch_confusion(spark, f"{tmp_path}/b")
    guard.frame.count()
    for run in (guard.verify, lambda: io.read_confusion(spark, f"{tmp_path}/b")):
        with pytest.raises(ValueError, match="no metadata of .*s1"):
            run()
