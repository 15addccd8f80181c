"""Sharding by a k-d tree over document metadata, in DataFrame functions only.

The corpus is split recursively along the metadata dimension in which a node's
rows spread the widest, at the weighted quantile that gives each side its share
of the leaves (the median where both get as many), with the text's bytes as
weight, until a node holds the target bytes. Cuts are exact: a cut is found by
refining a histogram of byte sums, a few bits of the sorting key at a time, so
that each pass is one aggregation with few groups. Ties of the dimension go by a
hash of the row, so one value may be cut anywhere.

A level of the tree is a small table of cuts, which is broadcast to the narrow rows of
metadata; each row carries its node, and the rows are written once a level. So the plan
has the same size for any number of shards, and the driver holds one line a node.

Defined results: null text has no bytes, and the checksum of the empty text;
null metadata is a value of its own; equal and repeated rows are told apart by
their place in the input; a null doc_id is a row like any other; an empty table gives no row; shards beyond the rows
stay empty; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellscore.plans import cut_lineage

#: Bits of a dimension's value, of the hash that breaks ties, and of each refinement.
VALUE_BITS, TIE_BITS, STEP_BITS = 20, 40, 15
#: Nodes whose table is broadcast (some 50 bytes each); more are joined by a shuffle.
MOST_NODES = 1_000_000


@dataclass
class Node:
    """A node with its number, its number of leaves and its first leaf."""

    number: int
    leaves: int
    first: int
    dimension: int = 0
    #: What is known of the key of the cut: its first bits, the bytes still to go left, and the bytes at these bits.
    prefix: int = 0
    goal: float = 0.0
    there: int = 0


def _metadata(docs: DataFrame, categories: list[str]) -> DataFrame:
    """doc_id, size, text_crc32, row (unique), tie and dimensions d0, d1, ... from 0 to 2^20 - 1: the categories by hash, and the logarithm of the size."""
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long")
    scale = float((1 << VALUE_BITS) - 1)
    dims = [F.pmod(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit("\0"))), F.lit(1 << VALUE_BITS)) for c in categories]
    dims.append(F.floor(F.least(F.log2(size.cast("double")) / 40, F.lit(1.0)) * scale))
    rows = docs.select("doc_id", size.alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), *(d.cast("long").alias(f"d{i}") for i, d in enumerate(dims)), F.monotonically_increasing_id().alias("row"))
    return rows.withColumn("tie", F.pmod(F.xxhash64("row"), F.lit(1 << TIE_BITS)))


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of numbers, broadcast, by functions alone."""
    names = [c.split()[0] for c in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    fields = ", ".join(c.replace(" ", ": ") for c in schema.split(", "))
    df = spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{fields}>>")))
    return F.broadcast(df) if len(rows) <= MOST_NODES else df


def _key(dimensions: int) -> Column:
    """The sorting key of a row in the dimension of its node."""
    return F.element_at(F.array(*(F.col(f"d{i}") for i in range(dimensions))), F.col("dimension") + 1) * (1 << TIE_BITS) + F.col("tie")


def _cuts(rows: DataFrame, active: list[Node], dimensions: int) -> None:
    """Set each active node's dimension, and as prefix the first key that goes right; some 5 small jobs."""
    spark = rows.sparkSession
    at = rows.join(_table(spark, [(n.number,) for n in active], "node bigint"), "node")
    spread = (f(f"d{i}").alias(f"{s}{i}") for i in range(dimensions) for f, s in ((F.min, "lo"), (F.max, "hi")))
    stats = {r["node"]: r for r in at.groupBy("node").agg(F.sum("size").alias("bytes"), *spread).collect()}
    by_number = {n.number: n for n in active if n.number in stats}
    for i, n in by_number.items():
        n.dimension = max(range(dimensions), key=lambda k: stats[i][f"hi{k}"] - stats[i][f"lo{k}"])
        n.goal = stats[i]["bytes"] * (n.leaves // 2) / n.leaves
    shift = VALUE_BITS + TIE_BITS
    while shift and by_number:
        shift -= STEP_BITS
        wanted = [(i, n.dimension, n.prefix, n.goal) for i, n in by_number.items()]
        at = rows.join(_table(spark, wanted, "node bigint, dimension int, prefix bigint, goal double"), "node").withColumn("key", _key(dimensions))
        ours = at.where(F.shiftright("key", shift + STEP_BITS) == F.col("prefix"))
        tally = ours.groupBy("node", "goal", F.shiftright("key", shift).alias("head")).agg(F.sum("size").alias("bytes"))
        upto = tally.withColumn("upto", F.sum("bytes").over(Window.partitionBy("node").orderBy("head")))  # at most 2^15 heads of a node
        first = upto.where(F.col("upto") >= F.col("goal")).groupBy("node").agg(F.min_by(F.struct("head", "bytes", "upto"), "head").alias("x"))
        for r in first.collect():
            n, x = by_number[r["node"]], r["x"]
            n.prefix, n.goal, n.there = x["head"], n.goal - (x["upto"] - x["bytes"]), x["bytes"]
    for n in by_number.values():
        n.prefix += n.goal > n.there / 2  # the nearer side of the row at the cut


def grow(rows: DataFrame, leaves: int, dimensions: int) -> DataFrame:
    """rows (as of _metadata) with shard, the leaf of the tree with so many leaves that each falls into."""
    spark = rows.sparkSession
    rows = rows.withColumn("node", F.lit(0).cast("long"))
    active, made, first = [Node(0, leaves, 0)], 1, {0: 0}
    while active := [n for n in active if n.leaves > 1]:
        _cuts(rows, active, dimensions)
        following, cuts = [], []
        for n in active:
            left = n.leaves // 2
            cuts.append((n.number, n.dimension, n.prefix, made, made + 1))
            following += [Node(made, left, n.first), Node(made + 1, n.leaves - left, n.first + left)]
            del first[n.number]
            first |= {made: n.first, made + 1: n.first + left}
            made += 2
        table = _table(spark, cuts, "node bigint, dimension int, cut bigint, below bigint, above bigint")
        side = F.when(F.col("cut").isNull(), F.col("node")).when(_key(dimensions) < F.col("cut"), F.col("below")).otherwise(F.col("above"))
        rows = cut_lineage(rows.join(table, "node", "left").withColumn("node", side).drop("dimension", "cut", "below", "above"))
        active = following
    return rows.join(_table(spark, list(first.items()), "node bigint, shard int"), "node").drop("node")


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, categories: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard), a row for each of docs.

    Give the number of shards, or the bytes of one; sizes come out equal to within a document for each level of the tree.
    """
    rows = cut_lineage(_metadata(docs, list(categories)))
    if shards is None:
        total = rows.agg(F.sum("size").alias("n")).first()["n"] or 0
        shards = max(1, -(-total // (target_bytes or 1 << 30)))
    placed = grow(rows, shards, len(categories) + 1)
    dealt = placed.select("doc_id", "size", "text_crc32", "row", "shard", F.shiftright("row", 33).alias("part"))
    # slots: rows of a shard before this part of the input, and then the row's number in its part
    counts = dealt.groupBy("part", "shard").agg(F.count("*").alias("n"))
    offsets = counts.select("part", "shard", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("part", "shard").orderBy("row")) - 1
    return dealt.withColumn("number", number).join(offsets, ["part", "shard"]).select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("number")).alias("slot"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: 24 shards of documents of nearly equal bytes."""
    dealt = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=24)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
