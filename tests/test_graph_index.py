"""Proximity graphs against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscore import fixtures as fx
from cellscore.operators import graph_index as gi
from cellscore.operators import neighbors as nb


def recall_and_share(q, r, **options):
    index = gi.graph_index(r).cache()
    near = gi.graph_search(q, index, **options).collect()
    exact = {(x["cell_id"], x["cas_cell_index"]) for x in nb.knn_search(q, r).collect()}
    assert len(near) == len(exact) and all(x["rank"] <= 10 for x in near)
    compared = {x["cell_id"]: x["compared"] for x in near}
    return len(exact & {(x["cell_id"], x["cas_cell_index"]) for x in near}) / len(exact), sum(compared.values()) / len(compared) / index.count()


def test_recall_and_a_share_that_falls(spark):
    """Of the unstructured vectors of the tables, a smaller share is compared in the larger table at a recall of 0.9 in both."""
    shares = []
    for folder, beam in (("sf0.01", 16), ("sf0.1", 36)):
        d = f"/root/testdata/{folder}"
        recall, share = recall_and_share(fx.query_cells(spark, d), fx.reference_cells(spark, d), beam=beam)
        assert recall >= 0.9
        shares.append(share)
    assert shares[1] < 0.5 and shares[1] < 0.75 * shares[0]


def test_few_comparisons_near_a_surface_of_few_dimensions(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(8000, 4)) @ rng.normal(size=(4, 32))
    r = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cas_cell_index long, embedding array<double>").repartition(4)
    q = spark.createDataFrame([(i, (x[i] + 0.01).tolist()) for i in range(0, 8000, 40)], "cell_id long, embedding array<double>")
    recall, share = recall_and_share(q, r, beam=16)
    assert recall >= 0.98 and share <= 0.04


def test_default_reaches_the_stated_recall(spark):
    d = "/root/testdata/sf0.1"
    q, r = fx.query_cells(spark, d), fx.reference_cells(spark, d)
    exact = {(x["cell_id"], x["cas_cell_index"]) for x in nb.knn_search(q, r).collect()}
    near = nb.knn_search_approx(q, r).collect()
    assert len(exact & {(x["cell_id"], x["cas_cell_index"]) for x in near}) / len(exact) >= 0.95 and len(near) == len(exact)


def test_shards_and_parts_give_every_cell_its_rows(spark, monkeypatch):
    """Cells far from all references, equal vectors and groups of copies get k rows, exact where the beam holds a shard."""
    rng = np.random.default_rng(3)
    refs = [(i, [float(v) for v in rng.normal(size=8) * 0.1]) for i in range(60)] + [(100 + i, [0.5] * 8) for i in range(50)] + [(200, None)]
    cells = [(0, refs[0][1]), (1, [30.0] * 8), (2, [-1.0, 1.0] * 4), (3, [0.5] * 8), (4, None)]
    q, r = spark.createDataFrame(cells, "cell_id long, embedding array<double>"), spark.createDataFrame(refs, "cas_cell_index long, embedding array<double>")
    exact = {}
    for metric in ("l2", "cosine"):
        exact[metric] = {(x["cell_id"], x["rank"]): round(x["distance"], 9) for x in nb.knn_search(q, r, 5, metric).collect()}
    monkeypatch.setattr(gi, "QUERY_BYTES", 100)
    for metric in ("l2", "cosine"):
        index = gi.graph_index(r, metric, shard_bytes=2000)
        assert index.select("shard").distinct().count() > 2
        found = {(x["cell_id"], x["rank"]): round(x["distance"], 9) for x in gi.graph_search(q, index.cache(), 5, metric, beam=110).collect()}
        assert found == exact[metric]
    assert nb.knn_search_approx(q, r.limit(0), 5).count() == 0 and nb.knn_search_approx(q.limit(0), r, 5).count() == 0
    assert nb.knn_search_approx(q, r.where("cas_cell_index < 3"), 5).groupBy("cell_id").count().where("count = 3").count() == 4
    with pytest.raises(ValueError):
        nb.knn_search_approx(q, r, 4, "city")


def test_links_are_places_of_their_shard_and_bounded(spark):
    r = fx.reference_cells(spark, "/root/testdata/sf0.01")
    index = gi.graph_index(r, links=4).cache()
    assert index.count() == r.count() and index.where(F.size("links") > 8).isEmpty()
    ends = index.select("shard", F.explode("links").alias("place"))
    assert ends.join(index, ["shard", "place"], "left_anti").isEmpty()


def test_one_shards_bytes_are_dealt_to_several_tasks_and_distances_are_double(spark, monkeypatch):
    """References of one shard's bytes are cut into four, queries into parts; what is walked in single precision is measured in double."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[300:] = x[:100]
    r = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cas_cell_index long, embedding array<float>")
    q = spark.createDataFrame([(i, (v.astype(float) + 1e-9).tolist()) for i, v in enumerate(x[:40])], "cell_id long, embedding array<double>")
    index = gi.graph_index(r, shard_bytes=8 * 400 * 8).cache()
    assert index.select("shard").distinct().count() == 4 and index.count() == 400
    monkeypatch.setattr(gi, "PART_ROWS", 10)
    found = {(n["cell_id"], n["rank"]): (n["cas_cell_index"], n["distance"]) for n in gi.graph_search(q, index, 5, beam=110).collect()}
    exact = {(n["cell_id"], n["rank"]): (n["cas_cell_index"], n["distance"]) for n in nb.knn_search(q, r, 5).collect()}
    assert found.keys() == exact.keys() and all(v[0] == exact[key][0] and v[1] == pytest.approx(exact[key][1], rel=1e-12) for key, v in found.items())


def test_single_precision_only_where_it_loses_nothing():
    assert gi.compact(np.array([[0.5, 3.0]])).dtype == np.float32
    for wide in ([[0.1, 3.0]], [[1e30, 1.0]]):
        assert gi.compact(np.array(wide)).dtype == np.float64
