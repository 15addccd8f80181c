"""Sets of terms as pages of bits: of any size, in rows of bounded size.

A term's place (from 1) is a bit of one page; a page has 32,768 of them in 4,096 bytes. A set is a row for each page that it has a term of, so no row
holds a whole ontology, and unions, sizes and overlaps are aggregations of pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscore.plans import numbered_within, small_enough

#: Fixed value: bits of a page.
PAGE_BITS = 32_768


def term_places(terms: DataFrame) -> DataFrame:
    """term_id and place: the number, from 1, of each distinct term by name."""
    distinct = terms.select("term_id").distinct().withColumn("all", F.lit(0))
    return numbered_within(distinct, "all", "term_id", "place").select("term_id", (F.col("place") + 1).cast("long").alias("place"))


def pages(members: DataFrame, places: DataFrame, key: str, member: str) -> DataFrame:
    """key, page and bits of the sets of members (key, member). A member without a place is in no set."""
    placed = members.select(key, F.col(member).alias("_member")).join(small_enough(places.select(F.col("term_id").alias("_member"), "place")), "_member")
    return placed.groupBy(key, F.bitmap_bucket_number("place").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))


def asked_pages(asked: DataFrame, closure: DataFrame, places: DataFrame, other: str = "ancestor_id") -> DataFrame:
    """term_id, page and bits: the ancestors of each asked term, or, by the descendant closure and descendant_id, its descendants. An unknown term has no page."""
    return pages(closure.join(asked.select("term_id").distinct(), "term_id", "left_semi"), places, "term_id", other)


def set_sizes(paged: DataFrame, key: str = "term_id") -> DataFrame:
    """key and n: the number of members of each set."""
    return paged.groupBy(key).agg(F.sum(F.bitmap_count("bits")).alias("n"))


def listed(paged: DataFrame, places: DataFrame, key: str = "term_id") -> DataFrame:
    """key and member, a row for each member of the sets: pages turned back into terms."""
    byte = F.conv(F.hex(F.substring("bits", F.col("_byte") + 1, F.lit(1))), 16, 10).cast("int")
    bytes_ = paged.select(key, "page", "bits", F.explode(F.sequence(F.lit(0), F.lit(PAGE_BITS // 8 - 1))).alias("_byte")).select(key, "page", "_byte", byte.alias("_bits")).where("_bits > 0")
    bits = bytes_.select(key, "page", "_byte", "_bits", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_bit")).where("(_bits >> _bit) & 1 = 1")
    place = (F.col("page") - 1) * PAGE_BITS + F.col("_byte") * 8 + F.col("_bit") + 1
    return bits.select(key, place.cast("long").alias("place")).join(places.select("place", F.col("term_id").alias("member")), "place").select(key, "member")


def pair_overlaps(pairs: DataFrame, paged: DataFrame) -> DataFrame:
    """a, b (distinct pairs of terms), n_both, n_only_a and n_only_b: the members that their sets share and those of one alone.

    By the size of the union: the pages of both terms of a pair are put together page by page.
    """
    pairs = pairs.select("a", "b").distinct()
    sizes = set_sizes(paged)
    each = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("term_id")).join(paged, "term_id")
    union = each.groupBy("a", "b", "page").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")).groupBy("a", "b").agg(F.sum("n").alias("n_union"))
    size = lambda c: sizes.select(F.col("term_id").alias(c), F.col("n").alias(f"n_{c}"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    found = pairs.join(union, ["a", "b"], "left").join(size("a"), "a", "left").join(size("b"), "b", "left")
    n_a, n_b, n_union = zero("n_a"), zero("n_b"), zero("n_union")
    return found.select("a", "b", (n_a + n_b - n_union).alias("n_both"), (n_union - n_b).alias("n_only_a"), (n_union - n_a).alias("n_only_b"))
