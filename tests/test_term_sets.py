"""Sets as pages of bits against plain sets."""

import random

from cellscore.operators import term_sets as ts


def test_pages_of_large_sets_and_back(spark):
    """A root over 70,000 terms is three rows of 4,096 bytes; small sets are one; members come back."""
    n = 70_000
    terms = spark.range(n).selectExpr("concat('t', lpad(id, 6, '0')) as term_id")
    closure = terms.selectExpr("'t000000' as term_id", "term_id as descendant_id").unionByName(terms.where("term_id like 't00001%'").selectExpr("'t000010' as term_id", "term_id as descendant_id"))
    places = ts.term_places(terms).cache()
    asked = spark.createDataFrame([("t000000",), ("t000010",), ("t000010",), ("nowhere",)], "term_id string")
    paged = ts.asked_pages(asked, closure, places, "descendant_id").cache()
    rows = {(r["term_id"], r["page"]): len(r["bits"]) for r in paged.collect()}
    assert rows == {("t000000", 1): 4096, ("t000000", 2): 4096, ("t000000", 3): 4096, ("t000010", 1): 4096}
    assert {r["term_id"]: r["n"] for r in ts.set_sizes(paged).collect()} == {"t000000": n, "t000010": 10}
    assert {r["member"] for r in ts.listed(paged.where("term_id = 't000010'"), places).collect()} == {f"t{i:06}" for i in range(10, 20)}
    assert ts.listed(paged.where("page = 3"), places).count() == n - 2 * ts.PAGE_BITS


def test_overlaps_of_random_sets(spark):
    rng = random.Random(2)
    members = {f"s{i}": {f"m{rng.randrange(90)}" for _ in range(rng.randint(1, 60))} for i in range(12)}
    rows = spark.createDataFrame([(k, m) for k, ms in members.items() for m in ms] + [("s0", "no place")], "term_id string, ancestor_id string")
    places = ts.term_places(spark.createDataFrame([(f"m{i}",) for i in range(90)] * 2, "term_id string"))
    paged = ts.pages(rows, places, "term_id", "ancestor_id")
    pairs = spark.createDataFrame([(a, b) for a in members for b in members] * 2 + [("s1", "none"), ("none", "none")], "a string, b string")
    found = {(r["a"], r["b"]): (r["n_both"], r["n_only_a"], r["n_only_b"]) for r in ts.pair_overlaps(pairs, paged).collect()}
    members["none"] = set()
    wanted = [(a, b) for a in members for b in members if "none" not in (a, b)] + [("s1", "none"), ("none", "none")]
    assert found == {(a, b): (len(members[a] & members[b]), len(members[a] - members[b]), len(members[b] - members[a])) for a, b in wanted}


def test_pages_of_no_set(spark):
    none = spark.createDataFrame([], "term_id string, ancestor_id string")
    assert ts.asked_pages(none.select("term_id"), none, ts.term_places(none)).count() == 0
