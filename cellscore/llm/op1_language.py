"""Language ID by language-bitmask n-gram filters.

Every language has a Bloom filter of the character n-grams that are typical of
it. The filters are bit-sliced: position p of one array holds bit p of the
filters of all languages side by side, so that one look-up of an n-gram returns
the mask of all languages that contain it. Each language's popcount over the
n-grams of a text is corrected for that filter's false positives; the largest
corrected count decides.

Defined results: null text and text without a letter give `und` with score 0; a
text whose n-grams are in no filter gives the commonest language with score 0;
ties go to the language that comes first by name; repeated rows are scored
alike; an empty training table gives `und` for all rows; other columns of docs
are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscore.llm.arrays import bounded, plain, steps, sums, tidy, utf8

UND = "und"
#: Lengths in UTF-8 bytes of the n-grams; lower case, runs of ASCII non-letters as one space.
LENGTHS = (3, 5)
#: Bytes of text at a time: an n-gram takes some hundred bytes on its way, and there are two for each byte.
GRAM_STEP = 1 << 17


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Exact 64-bit keys of the n-grams of all texts, and the index of each one's text."""
    empty, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    padded = pc.binary_join_element_wise(empty, pc.utf8_lower(texts), empty, space)
    data, offsets = utf8(padded)
    letter = np.zeros(256, dtype=bool)
    letter[ord("a") : ord("z") + 1] = True
    letter[128:] = True
    shown = np.where(letter[data], data, 32).astype(np.uint64)
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    first = np.zeros(len(shown), dtype=bool)
    first[offsets[:-1]] = True
    kept = (shown != 32) | first
    kept[1:] |= (shown[1:] == 32) & (shown[:-1] != 32)
    shown, text = shown[kept], text[kept]
    keys, owners = [], []
    for n in LENGTHS:
        if len(shown) < n:
            continue
        key = np.full(len(shown) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            key = (key << np.uint64(8)) | shown[i : len(shown) - n + 1 + i]
        whole = text[: len(key)] == text[n - 1 :]
        keys.append(key[whole])
        owners.append(text[: len(key)][whole])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def positions(keys: np.ndarray, size: int, hashes: int) -> list[np.ndarray]:
    """Places of each key in a filter of size (a power of two), one array per hash."""
    shift = np.uint64(64 - int(size).bit_length() + 1)
    factors = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
    mixed = keys ^ (keys >> np.uint64(29))
    return [((mixed * np.uint64(f)) >> shift).astype(np.int64) for f in factors[:hashes]]


@dataclass(frozen=True)
class Filters:
    """Bit-sliced filters: bit i of table[p] is bit p of the filter of languages[i]."""

    languages: list[str]
    prior: np.ndarray
    table: np.ndarray
    hashes: int

    @cached_property
    def false_rates(self) -> np.ndarray:
        """Chance that an n-gram that a language lacks is found in its filter."""
        fill = np.array([np.count_nonzero(self.table >> self.table.dtype.type(i) & self.table.dtype.type(1)) for i in range(len(self.languages))])
        return (fill / len(self.table)) ** self.hashes

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Corrected count by text and language, and the number of n-grams of each text."""
        keys, owner = grams(texts)
        masks = np.full(len(keys), ~self.table.dtype.type(0), dtype=self.table.dtype)
        for place in positions(keys, len(self.table), self.hashes):
            masks &= self.table[place]
        total = np.bincount(owner, minlength=len(texts))
        out = np.zeros((len(texts), len(self.languages)))
        for i, rate in enumerate(self.false_rates):
            hits = np.bincount(owner, weights=(masks >> masks.dtype.type(i)) & masks.dtype.type(1), minlength=len(texts))
            out[:, i] = np.maximum(0, (hits - rate * total) / max(1e-9, 1 - rate))
        return out, total


def fit(labelled: DataFrame, per_language: int = 3000, least: int = 3, share: float = 0.2, size: int = 1 << 20, hashes: int = 2) -> Filters:
    """Learn the filters from rows (doc_id, text, lang); rows with null text or lang are left out.

    The sample is bounded: of a language with more than per_language rows, a
    share by a hash of doc_id is taken so that about per_language remain. An n-gram
    belongs to a language if it occurs least times there, and at share or more
    of its rate in the language where it is commonest. At most 63 languages;
    what comes to the driver is one row per filled place, size at most.
    """
    labelled = labelled.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = sorted((r[0], r[1]) for r in labelled.groupBy("lang").count().limit(64).collect())
    if len(rows) > 63:
        raise ValueError("more than 63 languages; raise the width of the masks")
    names, counts = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=float)
    width = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(names) <= 8 * t().itemsize)
    table = np.zeros(size, dtype=width)
    if not names:
        return Filters([], counts, table, hashes)
    # looked up in literals: rows sent from the driver would start a second set of Python workers
    number, part = (F.create_map(*[F.lit(x) for pair in zip(names, values) for x in pair])[F.col("lang")] for values in (range(len(names)), np.minimum(1.0, per_language / counts).tolist()))
    even = (F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20)))
    sample = labelled.where(even < part).select(number.alias("k"), "text")

    def tally(batches):
        for batch in steps(batches, size=GRAM_STEP):
            keys, owner = grams(plain(batch.column("text")))
            language = batch.column("k").to_numpy().astype(np.uint64)[owner]
            both, n = np.unique(keys | (language << np.uint64(48)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((both >> np.uint64(48)).astype(np.int32)), pa.array((both & np.uint64((1 << 48) - 1)).astype(np.int64)), pa.array(n.astype(np.int64))], names=["k", "gram", "n"])

    found = bounded(sample).mapInArrow(tidy(tally), "k int, gram long, n long").groupBy("k", "gram").agg(F.sum("n").alias("n"))
    found = found.groupBy("gram").agg(F.collect_list(F.struct("k", "n")).alias("by"))
    totals = {r["k"]: r["n"] for r in sample.mapInArrow(_lengths, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()}
    rate = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, float(max(n, 1)))]) if totals else F.create_map(F.lit(0), F.lit(1.0))
    typical = (
        found.select("gram", F.explode("by").alias("x"), F.array_max(F.transform("by", lambda x: x["n"] / rate[x["k"]])).alias("top"))
        .where((F.col("x.n") >= least) & (F.col("x.n") / rate[F.col("x.k")] >= share * F.col("top")))
        .groupBy("gram").agg(F.bit_or(F.expr("shiftleft(1L, x.k)")).alias("mask"))
    )

    def places(batches):
        for batch in batches:
            keys, mask = batch.column("gram").to_numpy().astype(np.uint64), batch.column("mask").to_numpy()
            for place in positions(keys, size, hashes):
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(mask)], names=["place", "mask"])

    filled = typical.mapInArrow(tidy(places), "place long, mask long").groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    table[filled.column("place").to_numpy()] = filled.column("mask").to_numpy().astype(width)
    return Filters(names, counts / counts.sum(), table, hashes)


def _lengths(batches):
    for batch in steps(batches):
        n = pc.add(pc.fill_null(pc.binary_length(batch.column("text")), 0), 1).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("k"), n], names=["k", "n"])


def identify(docs: DataFrame, filters: Filters, keep: list[str] | None = None) -> DataFrame:
    """Add lang_pred, score (share of the corrected counts) and coverage (of the n-grams).

    docs has a column text; keep names the columns of docs to return (all by default).
    """
    keep = [c for c in (keep or docs.columns) if c not in ("lang_pred", "score", "coverage")]
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("coverage", "double")

    def score(batches):
        model = shared.value
        names = pa.array([*model.languages, UND])
        for batch in steps(batches, size=GRAM_STEP):
            texts = plain(batch.column("text"))
            n = len(texts)
            if model.languages:
                counts, total = model.counts(texts)
                best = np.where(counts.max(axis=1) > 0, counts.argmax(axis=1), int(model.prior.argmax()))
                top = counts[np.arange(n), best]
                value = np.divide(top, counts.sum(axis=1), out=np.zeros(n), where=counts.sum(axis=1) > 0)
                covered = np.divide(top, total, out=np.zeros(n), where=total > 0)
            else:
                best, value, covered = np.zeros(n, dtype=int), np.zeros(n), np.zeros(n)
            letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False) & bool(model.languages)
            best = np.where(letters, best, len(model.languages))
            columns = [batch.column(c) for c in keep]
            columns += [names.take(pa.array(best)), pa.array(np.where(letters, value, 0.0)), pa.array(np.where(letters, covered, 0.0))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score", "coverage"])

    columns = keep if "text" in keep else [*keep, "text"]
    return bounded(docs).select(*columns).mapInArrow(tidy(score), schema)


def held_out(mod: int, rest: int):
    """Whether crc32 of doc_id as text leaves rest when divided by mod."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == rest


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: the language of every whole text of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    filters = fit(docs.where(~held_out(3, 1)))
    out = identify(docs.select("doc_id", "text"), filters, keep=["doc_id"])
    return out.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score", "coverage")
