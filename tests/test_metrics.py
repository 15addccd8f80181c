import pytest

from cellscore import sources as io
from cellscore.operators import metrics as mt
from cellscore.operators import ontology as on

EDGES = [(on.ROOT, "1"), ("1", "2"), ("1", "3"), ("3", "4")]


def matrix(spark, truth, prediction):
    pairs = spark.createDataFrame([("m", t, p) for t, p in zip(truth, prediction)], "model_name string, true_label string, pred_label string")
    return mt.confusion_matrix(pairs, ["model_name"])


def closure(spark):
    edges = spark.createDataFrame(EDGES, "parent string, child string")
    return on.ancestor_closure(edges, spark.createDataFrame([(t,) for t in (on.ROOT, "1", "2", "3", "4")], "term_id string"))


def test_flat_golden_values(spark):
    r = mt.f_measure(matrix(spark, "223", "222"), ["model_name"]).first()
    assert (r["tp"], r["fp"], r["fn"]) == (2, 1, 1) and r["f1_micro"] == pytest.approx(2 / 3)
    r = mt.f_measure(matrix(spark, "2234", "2334"), ["model_name"]).first()
    assert r["precision_weighted"] == pytest.approx(0.875) and r["recall_weighted"] == pytest.approx(0.75) and r["f1_weighted"] == pytest.approx(0.75)
    assert r["precision_macro"] == pytest.approx(5 / 6) and r["recall_macro"] == pytest.approx(5 / 6) and r["f1_macro"] == pytest.approx(7 / 9)


@pytest.mark.parametrize("zero", [0.0, 1.0])
def test_empty_matrix_gives_zero_division(spark, zero):
    spine = spark.createDataFrame([("m",)], "model_name string")
    r = mt.f_measure(matrix(spark, "2", "2").limit(0), ["model_name"], zero, spine).first().asDict()
    assert all(r[m] == (0 if m in mt.COUNTS else zero) for m in mt.METRICS)


def test_hierarchical_golden_values(spark):
    up = closure(spark)
    r = mt.hierarchical_f_measure(matrix(spark, "223", "222"), up, ["model_name"]).first()
    assert (r["h_tp"], r["h_fp"], r["h_fn"]) == (5, 1, 1) and r["h_f1_micro"] == pytest.approx(5 / 6)
    assert r["h_f1_macro"] == pytest.approx(3 / 5) and r["h_precision_macro"] == pytest.approx(5 / 9) and r["h_recall_macro"] == pytest.approx(2 / 3)
    assert r["h_precision_weighted"] == pytest.approx(13 / 18) and r["h_recall_weighted"] == pytest.approx(5 / 6) and r["h_f1_weighted"] == pytest.approx(23 / 30)
    r = mt.hierarchical_f_measure(matrix(spark, "442", "431"), up, ["model_name"]).first()
    assert (r["h_tp"], r["h_fp"], r["h_fn"]) == (6, 0, 2) and r["h_precision_micro"] == 1 and r["h_recall_micro"] == pytest.approx(3 / 4)
    r = mt.hierarchical_f_measure(matrix(spark, "23", "32"), up, ["model_name"]).first()
    assert r["h_f1_macro"] == pytest.approx(1 / 3)


def test_top_k_and_clamping(spark):
    pairs = spark.createDataFrame([("m", "s", "2", "2", "1"), ("m", "s", "3", "2", "3"), ("m", "s", "4", "2", "4")], "model_name string, test_sample string, true_label string, name_1 string, name_2 string")
    raw = mt.build_all_confusions(pairs, "name_1", 3, ["model_name", "test_sample"])
    rows = {r["k"]: r for r in mt.f_measure(raw, ["k"]).collect()}
    assert (rows[1]["tp"], rows[1]["fp"], rows[1]["fn"]) == (1, 2, 2) and rows[1]["f1_micro"] == pytest.approx(1 / 3)
    assert rows[2]["tp"] == 3 and rows[2]["f1_micro"] == 1 and rows[3]["f1_micro"] == 1
    h = mt.benchmark_pipeline(pairs, closure(spark), "name_1", 3)["hierarchical_per_sample"].first()
    assert (h["h_tp"], h["h_fp"], h["h_fn"]) == (4, 2, 3)


def test_guards(spark):
    universe = spark.createDataFrame([("2",)], "label string")
    pairs = spark.createDataFrame([("2", "3"), (None, "2")], "true_label string, pred_label string")
    assert sorted(map(tuple, mt.labels_outside_universe(pairs, universe).collect())) == [("prediction", "3"), ("truth", "nan")]
    with pytest.raises(ValueError, match="nan"):
        mt.in_universe(pairs, universe)
    assert mt.in_universe(pairs, universe, "drop").count() == 0
    with pytest.raises(ValueError):
        mt.ranked_label_columns("label", 2)
    with pytest.raises(ValueError):
        mt.effective_ranks("x_1", 1, ["y"])


def test_f1_comes_from_precision_and_recall(spark):
    """With zero_division 1, a class of no hit: its precision is 0 or 1, its recall as well, and F1 goes by those two."""
    r = mt.f_measure(matrix(spark, "2", "3"), ["model_name"], 1.0).first()
    # class 2: precision 1 (never predicted), recall 0; class 3 the other way round; over all both are 0
    assert (r["precision_macro"], r["recall_macro"], r["f1_macro"], r["precision_micro"], r["f1_micro"]) == (0.5, 0.5, 0.0, 0.0, 1.0)


def test_matrices_guard_their_labels(spark):
    universe = spark.createDataFrame([("2", 0), ("3", 1)], "label string, idx int")
    pairs = spark.createDataFrame([("m", "a", "2", "3"), ("m", "b", "2", "9")], "model_name string, test_sample string, true_label string, pred_label string")
    keys = ["model_name", "test_sample"]
    with pytest.raises(ValueError, match="9"):
        mt.confusion_matrix(pairs, keys, universe)
    assert mt.confusion_matrix(pairs, keys, universe, "drop").count() == 1
    with pytest.raises(ValueError, match="9"):
        mt.build_all_confusions(pairs.withColumnRenamed("pred_label", "name_1"), "name_1", 1, keys, universe)
    good = mt.confusion_matrix(pairs.where("pred_label = '3'"), keys)
    facts = mt.confusion_metadata(good, universe, keys)
    other = mt.confusion_metadata(mt.confusion_matrix(pairs.where("pred_label = '9'"), keys), universe.where("idx = 0"), keys)
    assert mt.aggregate_confusion(good, ["model_name"], facts).first()["n"] == 1 and facts.first()["label_order"] == ["2", "3"]
    with pytest.raises(ValueError, match="label orders"):
        mt.aggregate_confusion(good, ["model_name"], facts.unionByName(other))
    with pytest.raises(ValueError, match="no confusion matrix"):
        mt.aggregate_confusion(good, ["model_name"], facts.limit(0))
    summed = mt.aggregate_metadata(facts.unionByName(facts.withColumn("test_sample", facts["model_name"])), ["model_name"]).first()
    assert (summed["n_samples_aggregated"], summed["sources"], summed["matrix_size"]) == (2, ["a", "m"], 2)


def test_a_store_has_both_its_parts(spark, tmp_path):
    universe = spark.createDataFrame([("2", 0), ("3", 1)], "label string, idx int")
    raw = spark.createDataFrame([("m", "a", 1, "2", "3", 4), ("m", "b", 1, "2", "2", 5)], "model_name string, test_sample string, k int, true_label string, pred_label string, n long")
    facts = mt.confusion_metadata(raw, universe, ["model_name", "test_sample", "k"])
    io.write_confusion(f"{tmp_path}/ok", raw, facts)
    back, known = io.read_confusion(spark, f"{tmp_path}/ok")
    assert sorted(map(tuple, back.select(*raw.columns).collect())) == sorted(map(tuple, raw.collect())) and known.first()["label_order"] == ["2", "3"]
    io.write_confusion(f"{tmp_path}/lone", raw, facts.where("test_sample = 'a'"))
    with pytest.raises(ValueError, match="no metadata"):
        io.read_confusion(spark, f"{tmp_path}/lone")
    raw.write.parquet(f"{tmp_path}/half/matrix")
    with pytest.raises(Exception, match="metadata"):
        io.read_confusion(spark, f"{tmp_path}/half")
