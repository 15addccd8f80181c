"""Fingerprints of texts by locally consistent parsing.

A text's UTF-8 bytes are cut into phrases, the phrases' names into phrases again, and so on until one name is
left. Where to cut is decided by deterministic coin tossing: the label of a symbol is the lowest bit in which it
differs from the one before it, with that bit's value; tossing again turns any alphabet into six labels within
a few rounds, and cuts stand at local maxima of these. So a cut depends on some five symbols around it, phrases have
two symbols or more, and equal substrings of any two texts are parsed alike but for a few phrases at their ends, at any offset.
Runs of one symbol hold no cut. Names are 64-bit hashes of a phrase's symbols, so that tasks need no common dictionary.

The fingerprint is the name of the whole text, then the SKETCH smallest of the text's signatures, which are 40-bit hashes of
the names of the second level (six bytes on average) and above. Likeness is the share of common signatures among the smallest of two
texts' union, the estimate of their sets' Jaccard similarity: exact for sets of up to SKETCH, else with a standard
error of 0.06 at most.

Defined results: null and empty texts have the name 0 and no signature, are at 1 to each other and at 0 to any other text; texts
of one byte, runs and repeated patterns are parsed like any other; equal texts have equal fingerprints; each repeated row has its own
result; an empty table gives no row; other columns are ignored, whatever their names; a null doc_id is the last in descending
order; rows of one doc_id stand in the order of a 64-bit hash of their text; the next document of a single one is itself.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscore.llm.arrays import bounded, plain, steps, utf8

#: Signatures of a fingerprint, and the bits of each.
SKETCH, BITS = 64, 40
#: The level from which on names are signatures.
LEAST_LEVEL = 2
#: Symbols of a phrase that are hashed in step with other phrases; a longer one is hashed by itself.
IN_STEP = 32
#: Keys drawn for each part into which documents are dealt.
DRAWN = 64


def _tosses(bits: int) -> np.ndarray:
    """By previous and present label, each of so many bits: twice the place of the lowest bit in which they differ, plus that bit."""
    one = np.arange(1 << bits)
    differ = one[:, None] ^ one[None, :]
    place = np.bitwise_count((differ & -differ) - 1)
    place[differ == 0] = 0
    return (2 * place + (one[None, :] >> place & 1)).astype(np.uint8).ravel()


#: Tosses of bytes, of labels of names, and of what those leave.
OF_BYTES, OF_7, OF_4, OF_3 = (_tosses(b) for b in (8, 7, 4, 3))
#: Masks that keep the first 0 to 8 bytes of a little-endian word.
FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def mixed(x: np.ndarray) -> np.ndarray:
    """x hashed, value by value."""
    x = (x ^ (x >> np.uint64(32))) * _B
    x = (x ^ (x >> np.uint64(29))) * _C
    return x ^ (x >> np.uint64(32))


def _cuts(labels: np.ndarray, same: np.ndarray, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places at which a phrase starts: that of each text, and the local maxima of its labels; same: equal to the symbol before."""
    labels = labels + np.uint8(1)
    labels[same] = 0
    start = np.zeros(len(labels), bool)
    start[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] >= labels[2:])
    start[ends - 1] = False
    start[first] = True
    return np.flatnonzero(start)


def _toss(labels: np.ndarray, table: np.ndarray, bits: int, first: np.ndarray) -> np.ndarray:
    """labels tossed once more; a text's first symbol has none before it and keeps its lowest bit."""
    out = np.empty(len(labels), np.uint8)
    wide = labels if 2 * bits <= 8 else labels.astype(np.uint16)
    out[1:] = table[(wide[:-1] << bits) | wide[1:]]
    out[first] = labels[first] & 1
    return out


def _byte_phrases(flat: np.ndarray, first: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and names of the phrases of bytes."""
    same = np.zeros(len(flat), bool)
    same[1:] = flat[1:] == flat[:-1]
    same[first] = False
    labels = _toss(flat, OF_BYTES, 8, first)
    labels = _toss(_toss(labels, OF_4, 4, first), OF_3, 3, first)
    starts = _cuts(labels, same, first, ends)
    lengths = np.diff(starts, append=len(flat))
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    words = np.ndarray(len(flat) + 1, "<u8", padded, strides=(1,))
    names = mixed(words[starts] & FIRST_BYTES[np.minimum(lengths, 8)] ^ lengths.astype(np.uint64) * _A)
    more = np.flatnonzero(lengths > 8)
    for j in range(8, IN_STEP, 8):
        more = more[lengths[more] > j]
        if len(more):
            names[more] = mixed(names[more] ^ (words[starts[more] + j] & FIRST_BYTES[np.minimum(lengths[more] - j, 8)]))
    for i in more[lengths[more] > IN_STEP]:
        names[i] = xxhash.xxh64_intdigest(flat[starts[i] : starts[i] + lengths[i]].tobytes())
    return starts, names


def _name_phrases(a: np.ndarray, first: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and names of the phrases of names."""
    one = np.uint64(1)
    differ = a[1:] ^ a[:-1]
    place = np.bitwise_count((differ - one) & ~differ) & 63
    labels = np.empty(len(a), np.uint8)
    labels[1:] = 2 * place + (a[1:] >> place.astype(np.uint64) & one).astype(np.uint8)
    labels[first] = (a[first] & one).astype(np.uint8)
    same = np.zeros(len(a), bool)
    same[1:] = differ == 0
    same[first] = False
    for table, bits in ((OF_7, 7), (OF_4, 4), (OF_3, 3)):
        labels = _toss(labels, table, bits, first)
    starts = _cuts(labels, same, first, ends)
    lengths = np.diff(starts, append=len(a))
    names = mixed(a[starts] ^ lengths.astype(np.uint64) * _A)
    more = np.arange(len(starts))
    for j in range(1, IN_STEP):
        more = more[lengths[more] > j]
        if not len(more):
            break
        names[more] = mixed(names[more] * _A ^ a[starts[more] + j])
    for i in more[lengths[more] > IN_STEP]:
        names[i] = xxhash.xxh64_intdigest(a[starts[i] : starts[i] + lengths[i]].tobytes())
    return starts, names


def levels(flat: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Level, owner (a text's number), name and length in symbols of the level below, of all phrases, level by level.

    A text is in the levels up to the one that has a single name of it; an empty text is in none.
    """
    owners = np.flatnonzero(np.diff(offsets))
    first, ends = offsets[:-1][owners], offsets[1:][owners]
    symbols, level = flat, 0
    while len(owners):
        level += 1
        starts, names = (_name_phrases if level > 1 else _byte_phrases)(symbols, first, ends)
        lengths = np.diff(starts, append=len(symbols))
        first = np.searchsorted(starts, first)
        counts = np.diff(first, append=len(starts))
        yield level, np.repeat(owners, counts), names, lengths
        open_ = counts > 1
        symbols = names[np.repeat(open_, counts)]
        owners, counts = owners[open_], counts[open_]
        ends = np.cumsum(counts)
        first = ends - counts


def parsed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By text its name; and the sorted signatures of all texts in a row, with offsets by text."""
    flat, offsets = utf8(texts)
    n = len(offsets) - 1
    roots, keys = np.zeros(n, np.uint64), []
    shift = np.uint64(64 - BITS)
    for level, owner, names, _ in levels(flat, offsets):
        alone = np.ones(len(owner), bool)
        alone[1:] &= owner[1:] != owner[:-1]
        alone[:-1] &= owner[1:] != owner[:-1]
        roots[owner[alone]] = names[alone]
        if level < LEAST_LEVEL:
            owner, names = owner[alone], names[alone]
        keys.append((owner.astype(np.uint64) << np.uint64(BITS)) | (mixed(names ^ _C) >> shift))
    found = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    found = found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found
    owner = (found >> np.uint64(BITS)).astype(np.int64)
    begin = np.searchsorted(owner, np.arange(n))
    kept = np.arange(len(found)) - begin[owner] < SKETCH
    found, owner = found[kept], owner[kept]
    return roots, found & np.uint64((1 << BITS) - 1), np.searchsorted(owner, np.arange(n + 1))


def written(roots: np.ndarray, signatures: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Fingerprints as text: 16 hexadecimal digits of the name, and 10 of each signature."""
    data = signatures.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :].tobytes().hex()
    w = BITS // 4
    return [f"{root:016x}{data[w * i : w * j]}" for root, i, j in zip(roots.tolist(), offsets[:-1].tolist(), offsets[1:].tolist())]


def read_back(fingerprints: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What written was given."""
    w = BITS // 4
    sizes = [(len(x) - 16) // w for x in fingerprints]
    signatures = [int(x[16 + w * i : 16 + w * (i + 1)], 16) for x, n in zip(fingerprints, sizes) for i in range(n)]
    return np.array([int(x[:16], 16) for x in fingerprints], np.uint64), np.array(signatures, np.uint64), np.cumsum([0, *sizes])


def likeness(roots: np.ndarray, signatures: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness, 0 to 1, of the texts a[i] and b[i]."""

    def of(which: np.ndarray) -> np.ndarray:
        sizes = np.diff(offsets)[which]
        pair = np.repeat(np.arange(len(which)), sizes)
        inside = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return (pair.astype(np.uint64) << np.uint64(BITS)) | signatures[offsets[which][pair] + inside]

    both = np.sort(np.concatenate([of(a), of(b)]))
    again = np.zeros(len(both), bool)
    again[1:] = both[1:] == both[:-1]
    pair = (both >> np.uint64(BITS)).astype(np.int64)
    distinct = np.cumsum(~again)
    begin = np.searchsorted(pair, np.arange(len(a) + 1))
    before = np.concatenate([[0], distinct])[begin]
    among = distinct - before[:-1][pair] <= SKETCH
    shared = np.bincount(pair[again & among], minlength=len(a))
    union = np.minimum(np.diff(before), SKETCH)
    return np.where(roots[a] == roots[b], 1.0, shared / np.maximum(union, 1))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every whole text, without a shuffle."""

    def run(batches):
        for batch in steps(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(written(*parsed(plain(batch.column("text")))), pa.string())], names=["doc_id", "fingerprint"])

    return bounded(docs).select("doc_id", "text").mapInArrow(run, docs.select("doc_id").schema.add("fingerprint", "string"))


def edit(text: str, following: str) -> str:
    """text with its last floor(n / 2) code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _drawn(rows: DataFrame, parts: int) -> tuple[list, list]:
    """Keys (null last, descending id, hash) of the rows with which parts start, the first of all included; and those drawn so often that they fill a part."""
    key = F.struct(F.col("doc_id").isNull().alias("a"), (-F.coalesce("doc_id", F.lit(0))).alias("b"), F.col("h").alias("c"))
    n, least = rows.agg(F.count("*"), F.min(key)).first()
    if not n:
        return [], []
    parts = max(1, min(parts, n // 8))
    share = DRAWN * parts / n
    drawn = sorted(tuple(r[0]) for r in rows.where(F.rand(12) < share).select(key).toLocalIterator()) if parts > 1 else []
    cut = drawn[DRAWN::DRAWN]
    return sorted({tuple(least), *cut}), sorted({k for k, after in zip(cut, cut[1:]) if k == after})


def with_edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, as the module says.

    Whole texts are shuffled once, in order of their ids: to parts that start with keys drawn from the rows (64 for
    each of as many parts as spark.sql.shuffle.partitions says), so each part's first row is known and is sent to the end of the
    part before as well. A row that repeats so often as to fill a part travels once, with its count.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    heads, hot = _drawn(rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n_parts = max(1, len(heads))

    @F.arrow_udf("int")
    def part(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        keys = ((i is None, -(i or 0), h) for i, h in zip(ids.to_pylist(), hashes.to_pylist()))
        return pa.array([bisect.bisect_right(heads, k) - 1 for k in keys], pa.int32())

    listed = lambda keys: spark.createDataFrame([(None if a else -b, c, i) for i, (a, b, c) in enumerate(keys)], "head_id long, head_h long, head int")
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h"))
    # as many lines as parts, so they are broadcast
    sent = rows.join(F.broadcast(listed(heads)), is_head).dropDuplicates(["head"]).select(F.pmod(F.col("head") - 1, F.lit(n_parts)).alias("part"), F.lit(True).alias("last"), "doc_id", "h", "text", F.lit(1).cast("long").alias("copies"))
    if hot:
        found = F.broadcast(listed(hot))
        counted = rows.join(found, is_head, "left_semi").groupBy("doc_id", "h", "text").agg(F.count("*").alias("copies"))
        rows = rows.join(found, is_head, "left_anti").withColumn("copies", F.lit(1).cast("long")).unionByName(counted)
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    rows = rows.select(part("doc_id", "h").alias("part"), F.lit(False).alias("last"), "doc_id", "h", "text", "copies")
    ordered = rows.unionByName(sent).repartitionById(n_parts, F.col("part")).sortWithinPartitions("part", "last", F.col("doc_id").desc_nulls_last(), "h")

    def walk(batches):
        held: list[tuple] = []
        for batch in steps(batches):
            there = held + list(zip(batch.column("part").to_pylist(), batch.column("last").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("copies").to_pylist(), batch.column("text").to_pylist()))
            held = there[-1:]
            pairs = [i for i in range(len(there) - 1) if there[i][0] == there[i + 1][0] and not there[i][1]]
            texts, of, after = [r[4] for r in there], [], []
            for i in pairs:
                of.append(i)
                after.append(i + 1)
                if there[i][3] > 1:
                    of.append(i)
                    after.append(i)
            if not of:
                continue
            edited = [edit(texts[i], texts[j]) for i, j in zip(of, after)]
            found = parsed(pa.array(texts + edited, pa.large_string()))
            strings = written(*found)
            a, b, c = np.array(of), np.array(after), len(texts) + np.arange(len(edited))
            times = np.array([1 if i != j else there[i][3] - 1 for i, j in zip(of, after)])
            near_edited, near_next = likeness(*found, a, c), likeness(*found, a, b)
            out = pa.RecordBatch.from_arrays([
                pa.array([there[i][2] for i in of], pa.int64()), pa.array([len(texts[i]) for i in of], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()), pa.array([strings[i] for i in of], pa.string()), pa.array(strings[len(texts) :], pa.string()),
                pa.array(near_edited), pa.array(near_next),
            ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            if times.max() == 1:
                yield out
            else:
                for line in np.flatnonzero(times):
                    for done in range(0, int(times[line]), 1000):
                        yield out.take(pa.array(np.full(min(1000, int(times[line]) - done), line)))

    return bounded(ordered).mapInArrow(walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: fingerprints of every whole text of documents and of its edited text."""
    return with_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
