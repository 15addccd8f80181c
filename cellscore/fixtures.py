"""The driver's tables in the shapes that the operators take (see FIXTURES.md)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscore.operators import neighbors as nb
from cellscore.operators import ontology as onto

#: The small ontology over the ten labels of embeddings. Term: parents.
TERMS = ["CL:0000000", "M0", "M1", "M2", "K0", "K1", *(f"T{i}" for i in range(10))]
CHILDREN = {"CL:0000000": ["M0", "M1", "M2", "K0"], "M0": ["K1", "T0", "T3", "T6", "T9"], "M1": ["T1", "T4", "T7"], "M2": ["T2", "T5", "T8"], "K0": ["T0", "T2", "T4", "T6", "T8"], "K1": ["T1", "T3", "T5", "T7", "T9"]}
#: Shortest and longest depth of each term, in the order of TERMS.
SHORT = [0, 1, 1, 1, 1, 2, *([2] * 10)]
LONG = [0, 1, 1, 1, 1, 2, *([2, 3] * 5)]
#: A colour for each of the ten labels.
COLORS = ["#1f77b4", "#ff7f0e", "#2ca02c", "#d62728", "#9467bd", "#8c564b", "#e377c2", "#7f7f7f", "#bcbd22", "#17becf"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def terms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, i, t.lower(), s, n) for i, (t, s, n) in enumerate(zip(TERMS, SHORT, LONG))], "term_id string, idx int, label string, depth_short int, depth_long int")


def edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p, c, i) for p, cs in CHILDREN.items() for i, c in enumerate(cs)], "parent string, child string, child_ord int")


#: The pairs of the small ontology by session, so that its few rows are worked out once.
_PAIRS: dict[str, list[tuple[str, str]]] = {}


def closure(spark: SparkSession) -> DataFrame:
    """The closure of the small ontology: some 60 pairs."""
    session = spark.sparkContext.applicationId
    if session not in _PAIRS:
        _PAIRS[session] = sorted(tuple(r) for r in onto.ancestor_closure(edges(spark), terms(spark)).collect())
    return spark.createDataFrame(_PAIRS[session], "term_id string, ancestor_id string")


def market_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ontology that grows with the tables: regions over nations, and nations and market segments over customers."""
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    root = F.lit(onto.ROOT)
    parts = [
        table(spark, sf_dir, "region").select(root.alias("parent"), name("R", "r_regionkey").alias("child")),
        nation.select(name("R", "n_regionkey").alias("parent"), name("N", "n_nationkey").alias("child")),
        customer.select(root.alias("parent"), name("G", "c_mktsegment").alias("child")).distinct(),
        customer.select(name("N", "c_nationkey").alias("parent"), name("C", "c_custkey").alias("child")),
        customer.select(name("G", "c_mktsegment").alias("parent"), name("C", "c_custkey").alias("child")),
    ]
    return reduce(DataFrame.unionByName, parts)


def market_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = market_edges(spark, sf_dir)
    nodes = links.select(F.col("child").alias("term_id")).union(links.select("parent")).distinct()
    return onto.ancestor_closure(links, nodes)


def query_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").where("vec_id % 5 = 0")
    return e.select(F.col("vec_id").alias("cell_id"), F.col("vec_id").alias("pos"), "embedding", F.concat(F.lit("c"), (F.col("vec_id") % 7).cast("string")).alias("cluster"), F.concat(F.lit("T"), F.col("label").cast("string")).alias("truth"))


def reference_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").where("vec_id % 5 <> 0")
    return e.select(F.col("vec_id").alias("cas_cell_index"), "embedding", F.concat(F.lit("T"), F.col("label").cast("string")).alias("cell_type"), F.concat(F.lit("ds"), (F.col("vec_id") % 4).cast("string")).alias("dataset_id"))


def neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest reference cells of every query cell, with their type and dataset."""
    refs = reference_cells(spark, sf_dir)
    return nb.knn_search(query_cells(spark, sf_dir), refs).join(refs.drop("embedding"), "cas_cell_index")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ontology-aware scores; T9 is left out of the ontology, so its cells are unrecognised."""
    return nb.ontology_aware_scores(neighbors(spark, sf_dir), terms(spark).where("term_id <> 'T9'"), closure(spark))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbour statistics as a list by cell, in the order of cell types, with the place in it."""
    from pyspark.sql import Window

    stats = nb.neighbor_summary_stats(neighbors(spark, sf_dir))
    return stats.withColumn("pos", F.row_number().over(Window.partitionBy("cell_id").orderBy("cell_type")) - 1)


def knn_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = query_cells(spark, sf_dir)
    near = nb.knn_search(cells, cells.select(F.col("cell_id").alias("cas_cell_index"), "embedding"), exclude_self=True)
    return near.select(F.col("cell_id").alias("i"), F.col("cas_cell_index").alias("j"), (1 / (1 + F.col("distance"))).alias("connectivity"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layers: raw.X holds summed quantities, X a tenth of them."""
    summed = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("feature_id")).agg(F.sum("l_quantity").alias("v"))
    return summed.select("cell_id", "feature_id", F.inline(F.array(F.struct(F.lit("X").alias("layer"), (F.col("v") / 10).alias("value")), F.struct(F.lit("raw.X").alias("layer"), F.col("v").alias("value")))))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("cell_id"), F.col("o_orderkey").alias("pos"), F.col("o_orderpriority").alias("cluster"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("feature_id"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("feature_name"))


def feature_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts up to size 40, then ids that the data lacks; the position is the id itself."""
    part = table(spark, sf_dir, "part")
    known = part.where("p_size <= 40").select(F.col("p_partkey").alias("feature_id"))
    absent = part.where("p_size <= 3").select((F.col("p_partkey") + 1_000_000).alias("feature_id"))
    return known.union(absent).select("feature_id", F.col("feature_id").alias("pos"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth and three ranked labels, a row of lineitem each."""
    t = lambda letter, c, n: F.concat(F.lit(letter), (F.col(c) % n).cast("string"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("model_name"), F.col("l_linestatus").alias("test_sample"), t("T", "l_partkey", 10).alias("true_label"), t("T", "l_suppkey", 10).alias("name_1"), t("T", "l_linenumber", 10).alias("name_2"), t("M", "l_partkey", 3).alias("name_3"))


def universe(spark: SparkSession) -> DataFrame:
    """The labels that a confusion matrix may hold, in order."""
    return terms(spark).select(F.col("term_id").alias("label"), "idx")


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellscore.operators import metrics as mt

    return mt.build_all_confusions(predictions(spark, sf_dir), "name_1", 3, ["model_name", "test_sample"])


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("cell_id"), F.concat(F.lit("T"), (F.col("o_custkey") % 10).cast("string")).alias("true_label"))


def ranked_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("cell_id"), F.col("o_orderstatus").alias("model_name"), F.col("o_orderpriority").alias("test_sample"), F.concat(F.lit("T"), (F.col("o_orderkey") % 10).cast("string")).alias("name_1"), F.concat(F.lit("M"), (F.col("o_custkey") % 3).cast("string")).alias("name_2"))


def azimuth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third-party predictions: a customer's region and nation, with scores from the balance."""
    score = (F.col("c_acctbal") + 1000) / 11000
    c = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.select(F.col("c_custkey").alias("cell_id"), F.col("r_name").alias("predicted.l1"), score.alias("predicted.l1.score"), F.when(F.col("c_custkey") % 50 != 0, F.col("n_name")).alias("predicted.l2"), (1 - score).alias("predicted.l2.score"))


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions to M, nations to T terms; nations from 23 on are unknown."""
    t = lambda letter, c, n: F.concat(F.lit(letter), (F.col(c) % n).cast("string"))
    r = table(spark, sf_dir, "region").select(F.col("r_name").alias("source_label"), t("M", "r_regionkey", 3).alias("term_id"))
    n = table(spark, sf_dir, "nation").where("n_nationkey < 23").select(F.col("n_name").alias("source_label"), t("T", "n_nationkey", 10).alias("term_id"))
    return r.union(n).withColumn("term_label", F.lower("term_id"))


def cell_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cas_cell_index"), F.col("c_mktsegment").alias("tissue"), F.col("c_name").alias("donor_id"), F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("d"), F.col("c_nationkey").cast("string"))).alias("disease"), F.floor(F.col("c_acctbal")).alias("total_mrna_umis"))


def colors(spark: SparkSession) -> DataFrame:
    """Nine of the ten colours: T9 has none."""
    return spark.createDataFrame([(f"T{i}", c) for i, c in enumerate(COLORS[:9])], "cell_type string, hex string")
