"""Benchmark decontamination with a broadcast set of test n-grams, in DataFrame functions only.

The distinct windows of the benchmark (ten consecutive words, or a shorter
item's whole) are hashed and broadcast. The hash of every window of every text
is looked up while the text's words are at hand, a hit is verified word by
word, and only hits, and one row for each text, are shuffled.

What is broadcast names no items, so its size does not grow with the number of items that
share a passage: windows of the same items carry the same key of a group, and a group's items are joined
to the texts with hits at the end (by a broadcast only if they are small in bytes).

A benchmark whose windows have more than MOST_WINDOW_BYTES is taken in so many parts, by the
hash, each with a pass of its own over the texts: what is broadcast stays bounded,
and no window of a text is ever shuffled.

Defined results: null text, or one without a word, has no words and no hit; an
item without a word is no window; a null item id counts as the empty string;
items with the same text each count, repeated item rows once; an empty benchmark
contaminates nothing; repeated rows of docs get a row each; other columns are
kept, or ignored, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscore.plans import cut_lineage, small_enough

#: What separates words once A-Z is in lower case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of windows that are broadcast at once: a line and each word of it count with what Spark keeps beside them.
MOST_WINDOW_BYTES, LINE_BYTES, WORD_BYTES = 96 << 20, 120, 12
#: Bytes of the item ids of all groups that are broadcast; more are shuffled.
MOST_ITEM_BYTES = 32 << 20
#: Contaminated documents that are broadcast for an anti-join; beyond that they are shuffled.
MOST_DROPPED = 1_000_000
#: Looked up once for every text, at place 0, so that texts without a hit keep a row.
MARK = -7046029254386353131


def words(text: Column) -> Column:
    """Words of text, A-Z in lower case; an ASCII text goes a faster way to the same result."""
    whole = F.coalesce(text, F.lit(""))
    folded = F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(F.translate(whole, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(folded, GAP), "")


def _slice(at: Column, length) -> Column:
    return F.slice("words", at, length)


def _keys(length: int) -> Column:
    """Hashes of all windows of so many words, in order."""
    n = F.size("words")
    hashes = F.transform(F.sequence(F.lit(1), n - (length - 1)), lambda i: F.xxhash64(_slice(i, F.lit(length))))
    return F.when(n >= length, hashes).otherwise(F.array().cast("array<bigint>"))


def windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Distinct pairs of a window (its words) and an item (id as a string)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("words")).where(F.size("words") > 0)
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (size - 1))), lambda i: _slice(i, F.lit(size)))
    return items.select("item", F.explode(each).alias("window")).distinct()


def grouped_windows(pairs: DataFrame) -> DataFrame:
    """key (hash), window and group of each distinct window; windows of just the same items have the same group (by number and 128 bits)."""
    group = F.concat_ws("-", F.count("*").cast("string"), *(F.bit_xor(F.xxhash64("item", F.lit(i))).cast("string") for i in range(2)))
    return pairs.groupBy("window").agg(group.alias("group")).select(F.xxhash64("window").alias("key"), "window", "group")


def scan(docs: DataFrame, found: DataFrame) -> DataFrame:
    """row, doc_id, text_key (hash of the text), n_words, spans (first word, word after the last; merged) and groups, a row for each of docs."""
    spark = docs.sparkSession
    heavy = F.aggregate("window", F.lit(LINE_BYTES).cast("long"), lambda total, w: total + WORD_BYTES + F.octet_length(w))
    facts = {r["length"]: r["heavy"] for r in found.groupBy(F.size("window").alias("length")).agg(F.sum(heavy).alias("heavy")).collect()}
    lengths = sorted(facts)
    parts = max(1, -(-sum(facts.values()) // MOST_WINDOW_BYTES))
    mark = spark.range(1).select(F.lit(MARK).alias("key"), F.lit(None).cast("array<string>").alias("window"), F.lit(None).cast("string").alias("group"))

    base = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("words")).withColumn("row", F.monotonically_increasing_id())
    n = F.size("words")
    base = base.withColumn("keys", F.concat(F.array(F.lit(MARK)), *map(_keys, lengths)))
    # the outer form, which loses no row either, as Catalyst guards the other by a filter that works out all keys once more
    exploded = base.select("row", "doc_id", "text_key", "words", F.posexplode_outer("keys").alias("place", "key"))

    hits = None
    for part in range(parts):
        table = found.where(F.pmod("key", F.lit(parts)) == part) if parts > 1 else found
        table = F.broadcast(table.unionByName(mark) if part == 0 else table)
        once = exploded.join(table, "key")
        hits = once if hits is None else hits.unionByName(once)

    # place 0 is the mark; then come the windows of the first length, of the second, ...
    at, length, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(1)
    for x in lengths:
        inside = (F.col("place") >= before) & (F.col("place") < before + F.greatest(n - (x - 1), F.lit(0)))
        at, length = F.when(inside, F.col("place") - before).otherwise(at), F.when(inside, F.lit(x)).otherwise(length)
        before = before + F.greatest(n - (x - 1), F.lit(0))
    hits = hits.select("row", "doc_id", "text_key", n.alias("n_words"), "place", "words", "window", "group", at.alias("at"), length.alias("length"))
    is_mark = (F.col("place") == 0) & F.col("window").isNull()
    is_hit = F.col("window").isNotNull() & (_slice(F.col("at") + 1, F.col("length")) == F.col("window"))
    hits = hits.where(is_mark | is_hit).select("row", "doc_id", "text_key", "n_words", "group", F.when(F.col("place") > 0, F.struct("at", (F.col("at") + F.col("length")).alias("end"))).alias("span"))
    grouped = hits.groupBy("row", "doc_id", "text_key", "n_words").agg(F.collect_set("span").alias("spans"), F.collect_set("group").alias("groups"))

    merged = F.aggregate(
        F.array_sort("spans"), F.array().cast("array<struct<at:int,end:int>>"),
        lambda out, x: F.when((F.size(out) > 0) & (F.element_at(out, -1)["end"] >= x["at"]), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(F.element_at(out, -1)["at"].alias("at"), F.greatest(F.element_at(out, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(out, F.array(x))),
    )
    return grouped.select("row", "doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"), F.when(F.size("spans") == 0, F.array().cast("array<struct<at:int,end:int>>")).otherwise(merged).alias("spans"), "groups")


def match(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, text_key (hash of the text), n_words, spans (first word, word after the last; merged) and items, a row for each of docs."""
    pairs = cut_lineage(windows(benchmark, size))
    found = grouped_windows(pairs)
    # the items of a group are those of any of its windows
    members = found.groupBy("group").agg(F.min("window").alias("window")).join(pairs, "window").select("group", "item")
    lists = cut_lineage(members.groupBy("group").agg(F.collect_set("item").alias("items")))
    heavy = lists.agg(F.sum(F.aggregate("items", F.lit(0).cast("long"), lambda total, x: total + 24 + F.octet_length(x)))).first()[0] or 0
    # a text without a hit has a key of its own, so that such texts do not meet in one task of a shuffled join
    each = scan(docs, found).withColumn("group", F.explode_outer("groups")).withColumn("group", F.coalesce("group", F.concat(F.lit("none-"), F.col("row").cast("string"))))
    joined = each.join(F.broadcast(lists) if heavy <= MOST_ITEM_BYTES else lists, "group", "left")
    whole = joined.groupBy("row", "doc_id", "text_key", "n_words").agg(F.any_value("spans").alias("spans"), F.collect_set("items").alias("items"))
    return whole.select("doc_id", "text_key", "n_words", "spans", F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """docs without those that hold a benchmark window."""
    found = scan(docs, grouped_windows(cut_lineage(windows(benchmark, size)))).where(F.size("spans") > 0)
    dirty = cut_lineage(found.select(F.col("doc_id").alias("dirty_id"), F.col("text_key").alias("dirty_key")).distinct())  # else its count would match all texts once more
    same = F.col("doc_id").eqNullSafe(F.col("dirty_id")) & (F.xxhash64("text") == F.col("dirty_key"))
    return docs.join(small_enough(dirty, MOST_DROPPED), same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: words of documents inside windows of benchmark items."""
    found = match(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + (x["end"] - x["at"]))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


ORACLE_SQL = r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents
), b as (
  select cast(item_id as varchar) as item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark
), bw as (
  select distinct item, w[i : i + 9] as win from (select item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from b where len(w) > 0)
), lens as (select distinct len(win) as k from bw),
dw as (
  select doc_id, i, k, w[i : i + k - 1] as win from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, lens where len(w) >= k)
), hit as (select doc_id, i, k, item from dw join bw using (win)),
pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from (select distinct doc_id, i, k from hit)) group by 1),
it as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct doc_id, item from hit) group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join pos using (doc_id) left join it using (doc_id)
"""
