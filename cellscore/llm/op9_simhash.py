"""SimHash near-duplicates with BK-trees.

Every text gets a 64-bit SimHash of its word shingles. Distinct fingerprints
are dealt to shards so that two that differ in at most `radius` bits meet in one
at least: the bits are cut into blocks, all but `radius` of which must then be
equal, so each choice of those is a shard key. More blocks make longer keys, and there are
as many as keep the shards small for the number of fingerprints. In a shard, a BK-tree (children keyed by their Hamming distance to the
parent) holds the fingerprints; a search follows only the edges whose distance
is within the radius of the query's. Trees of a task are built and searched
level by level in numpy. A shard of more than MOST_IN_TREE fingerprints is cut
into several trees, and each tree is sent to the task of every part of its
shard's queries, so no task holds more and no link is lost.

A search reports just a spanning forest of its shard, never all pairs; components
then spread over shards by minimum labels with pointer jumping.

`groups` links fingerprints of shingles at a few bits, which is exact. Texts of a
given similarity may differ in many more bits (a trimmed or extended copy at 0.8 in some
38 of 256), out of reach of an exact shard key. So `deduplicate`, which goes by the
similarity of shingle sets, takes the links of the trees and, beside them, the texts that share
a MinHash band of their shingles as candidates, and then compares the sets themselves.

Defined results: null, empty or blank text has fingerprint zero, and is linked
like any other; repeated rows share a fingerprint; the component is the least
doc_id, null ids left out (a component of null ids has a null id); an empty table
gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscore.llm.arrays import LOWER, bounded, plain, recoded, steps, tidy, words
from cellscore.plans import cut_lineage, small_enough

SEED = 42
#: Fingerprints of one tree.
MOST_IN_TREE = 4096
#: Bands of MinHash values and values of a band: two texts at 0.8 share no band once in 300,000 times, unrelated ones hardly any.
BANDS, ROWS = 32, 5
#: Pairs of texts compared at once.
CHECKED = 20_000
#: Bytes of text whose shingle sets one part of a group holds.
MOST_BYTES = 1 << 24
#: Multipliers of the MinHash functions, and of mixing.
MULTIPLIERS = np.random.default_rng(SEED).integers(1 << 31, size=BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Lines of texts, or of removed documents, that are broadcast (an id and 20 bytes, some 100 with Spark's overhead); more are shuffled.
MOST_GONE = 500_000
#: Pairs of query and node that one search step looks at.
FRONTIER = 1 << 20
#: Bytes of text whose MinHash values are made at once: each shingle has BANDS * ROWS values.
MARKED = 1 << 18
#: Hashes whose bits are counted at once.
FOLDED = 1 << 16


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of the shingles (in order, repeats included) of text, A-Z in lower case."""
    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= size:
        return [digest(join(words), SEED)] if words else []
    return [digest(join(s), SEED) for s in zip(*(words[i:] for i in range(size)))]


def fold(hashes: list[list[int]]) -> np.ndarray:
    """Fingerprint of each list: a bit is 1 if over half of the hashes have it."""
    n = np.array([len(h) for h in hashes])
    out = np.zeros(len(hashes), dtype=np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        flat = np.array([x for h in hashes for x in h], dtype="<u8")
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate([[0], np.cumsum(n[full])[:-1]])
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > n[full][:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every text."""

    def run(batches):
        for batch in steps(batches):
            texts = plain(batch.column("text"))
            found = fold([shingle_hashes(t.encode(), shingle) for t in texts.to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return bounded(docs).select("doc_id", "text").mapInArrow(run, docs.select("doc_id").schema.add("fp", "long"))


def mixed(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    """64-bit hashes of state with value taken in."""
    state = (state ^ value) * MIX
    state ^= state >> np.uint64(32)
    state *= MIX
    return state ^ (state >> np.uint64(29))


def shingle_rows(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts in a row (repeats included, A-Z in lower case), and offsets by text.

    A text of fewer than size words is one shingle; so is one of no word, which is like others of no word.
    """
    flat, by = words(recoded(texts, LOWER))
    coded = pc.dictionary_encode(flat)
    names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    table = np.array([xxhash.xxh64_intdigest(w.encode(), SEED) for w in names], dtype=np.uint64)
    hashes = np.concatenate([table[coded.indices.to_numpy()], np.zeros(size, np.uint64)])
    count = np.maximum(np.diff(by) - size + 1, 1)
    offsets = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(offsets[-1]) + np.repeat(by[:-1] - offsets[:-1], count)
    end = np.repeat(by[1:], count)
    out = np.zeros(len(at), dtype=np.uint64)
    for i in range(size):
        out = mixed(out, np.where(at + i < end, hashes[at + i], np.uint64(0)))
    return out, offsets


def majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The SimHash of each text: a bit is 1 if over half of the text's hashes have it. Texts are worked off some at a time."""
    n = np.diff(offsets)
    out = np.zeros(len(n), np.uint64)
    start = 0
    while start < len(n):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + FOLDED, side="right")) - 1)
        first = int(offsets[start])
        ones = np.zeros((stop - start, 64), np.int64)
        for a in range(first, int(offsets[stop]), FOLDED):  # a long text goes in parts
            b = min(a + FOLDED, int(offsets[stop]))
            bits = np.unpackbits(hashes[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += np.add.reduceat(bits, np.maximum(offsets[start:stop] - a, 0), axis=0, dtype=np.int64) if stop - start > 1 else bits.sum(axis=0, dtype=np.int64)[None, :]
        out[start:stop] = np.packbits(2 * ones > n[start:stop, None], axis=1, bitorder="little").view("<u8")[:, 0]
        start = stop
    return out


def minhashes(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of BANDS * ROWS MinHash values for each text."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out, product = np.empty((len(offsets) - 1, len(MULTIPLIERS)), dtype=np.uint32), np.empty_like(x)
    for i, a in enumerate(MULTIPLIERS):
        np.multiply(x, a, out=product)
        out[:, i] = np.minimum.reduceat(product, offsets[:-1])
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """A key for each band of each row of MinHash values."""
    parts = values.reshape(len(values), BANDS, ROWS).astype(np.uint64)
    key = np.tile(np.arange(BANDS, dtype=np.uint64), (len(values), 1))
    for i in range(ROWS):
        key = mixed(key, parts[:, :, i])
    return key.view(np.int64)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, row by row."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


class Forest:
    """BK-trees, one for each shard, over distinct fingerprints (a row of 64-bit words each)."""

    def __init__(self, values: np.ndarray, shards: np.ndarray):
        self.values, self.step = values, 64 * values.shape[1] + 1
        order = np.argsort(shards, kind="stable")
        self.shards, first = np.unique(shards[order], return_index=True)
        self.roots = order[first]
        node = self.roots[np.searchsorted(self.shards, shards)]
        rest = np.setdiff1d(np.arange(len(values)), self.roots)
        keys, children = [], []
        while len(rest):
            key = node[rest] * self.step + distance(values[rest], values[node[rest]])
            slots, first, which = np.unique(key, return_index=True, return_inverse=True)
            child = rest[first]
            keys.append(slots)
            children.append(child)
            node[rest] = child[which]
            rest = rest[node[rest] != rest]
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.children = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.children = self.keys[order], self.children[order]

    def search(self, queries: np.ndarray, shards: np.ndarray, radius: int):
        """Pairs (query index, node index) within radius, in arrays of bounded size."""
        place = np.searchsorted(self.shards, shards)
        known = place < len(self.shards)
        known[known] = self.shards[place[known]] == shards[known]
        start = np.flatnonzero(known)
        stack = [(start[i : i + FRONTIER], self.roots[place[start[i : i + FRONTIER]]]) for i in range(0, len(start), FRONTIER)]
        while stack:
            q, node = stack.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                stack += [(q[:half], node[:half]), (q[half:], node[half:])]
                continue
            d = distance(queries[q], self.values[node])
            near = d <= radius
            if near.any():
                yield q[near], node[near]
            low = np.searchsorted(self.keys, node * self.step + np.maximum(d - radius, 0), side="left")
            n = np.searchsorted(self.keys, node * self.step + np.minimum(d + radius, self.step - 1), side="right") - low
            total = int(n.sum())
            if total:
                offset = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
                stack.append((np.repeat(q, n), self.children[np.repeat(low, n) + offset]))


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Root labels after joining a[i] with b[i]; a root is the least index of its set."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped


def deal(rows: DataFrame) -> DataFrame:
    """rows (id, shard, weight) dealt to tasks: shard, tree, part, id, in_tree and asks.

    Shards of one row have no link and go. Those over MOST_IN_TREE rows, or MOST_BYTES of weight, are cut
    into parts, with a task for each pair (i, j), i <= j, of parts: tree i, asked by part j.
    """
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).where("n > 1")
    parts = F.greatest(F.ceil(F.col("n") / MOST_IN_TREE), F.ceil(F.col("weight") / MOST_BYTES)).cast("long")
    sized = rows.drop("weight").join(sizes.select("shard", parts.alias("parts")), "shard")
    own = F.pmod(F.xxhash64("id"), F.col("parts"))
    other = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    sized = sized.withColumn("own", own).withColumn("other", F.explode(other))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return sized.withColumns({"tree": low, "part": high, "in_tree": F.col("own") == low, "asks": F.col("own") == high}).drop("own", "other", "parts")


class Task:
    """Rows of dealt shards in one task, with labels that start at each id's own."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("id").to_numpy()
        cells = np.stack([table.column(c).to_numpy() for c in ("shard", "tree", "part")])
        self.cell = np.ravel(np.unique(cells, axis=1, return_inverse=True)[1])
        self.t, self.q = (np.flatnonzero(table.column(c).to_numpy(zero_copy_only=False).astype(bool)) for c in ("in_tree", "asks"))
        self.order = np.argsort(self.ids, kind="stable")
        self.rank = np.empty(len(self.ids), dtype=np.int64)
        # labels are the first ranks of ids, so that a root is the least id and an id has one label in all shards
        self.rank[self.order] = np.searchsorted(self.ids[self.order], self.ids[self.order], side="left")
        self.label = np.arange(len(self.ids))

    def apart(self, x, y) -> np.ndarray:
        return self.label[self.rank[x]] != self.label[self.rank[y]]

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        self.label = merge(self.label, self.rank[x], self.rank[y])

    def edges(self) -> dict[str, np.ndarray]:
        moved = np.flatnonzero(self.label != np.arange(len(self.ids)))
        return {"a": self.ids[self.order[moved]], "b": self.ids[self.order[self.label[moved]]]}


def tabled(batches) -> pa.Table | None:
    """All batches of a task as a table in one piece, if there is a row."""
    batches = list(batches)
    table = pa.Table.from_batches(batches).combine_chunks() if batches else None
    return table if table is not None and table.num_rows else None


def block_count(n: int, bits: int, radius: int) -> int:
    """Blocks to cut fingerprints into: the fewest for which a shard of n random ones holds some MOST_IN_TREE / 4 at most.

    A fingerprint goes to comb(blocks, radius) shards by keys of bits * (blocks - radius) / blocks bits.
    """
    blocks = radius + 1
    while n * 4 > MOST_IN_TREE * 2 ** (bits * (blocks - radius) / blocks) and comb(blocks + 1, radius) <= 200:
        blocks += 1
    return blocks


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """Edges a, b (ids, a > b) of spanning forests of all shards, from fp (an array of words) and id.

    fingerprints meet in a shard if all but radius of their blocks of bits are the same, so that none
    within the radius is missed.
    """
    n = distinct.count()
    size = len(distinct.select("fp").first()["fp"]) if n else 1
    blocks = block_count(n, 64 * size, radius)
    edges = [round(64 * size * i / blocks) for i in range(blocks + 1)]
    # a block may lie over two words, so it is cut there; the parts go into the key alike
    cuts = [[(a, min(edges[i + 1], (a // 64 + 1) * 64)) for a in range(edges[i], edges[i + 1]) if a == edges[i] or a % 64 == 0] for i in range(blocks)]
    run_of = lambda a, b: F.shiftrightunsigned(F.col("fp")[a // 64], a % 64).bitwiseAND(F.lit((1 << (b - a)) - 1)) if b - a < 64 else F.col("fp")[a // 64]
    keys = [F.xxhash64(F.lit(i), *(run_of(a, b) for block in chosen for a, b in cuts[block])) for i, chosen in enumerate(combinations(range(blocks), blocks - radius))]
    dealt = distinct.select("fp", "id", F.lit(0).alias("weight"), F.explode(F.array(*keys)).alias("shard"))
    together = deal(dealt).repartition("shard", "tree", "part")

    def run(batches):
        table = tabled(batches)
        if table is None:
            return
        task = Task(table)
        fp = table.column("fp").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(table.num_rows, -1)
        t, q = task.t, task.q
        for a, b in Forest(fp[t], task.cell[t]).search(fp[q], task.cell[q], radius):
            a, b = q[a], t[b]
            for i in range(0, len(a), CHECKED):
                x, y = a[i : i + CHECKED], b[i : i + CHECKED]
                apart = task.apart(x, y)
                task.join(x[apart], y[apart])
        yield pa.RecordBatch.from_pydict(task.edges())

    return bounded(together).mapInArrow(tidy(run), "a long, b long").distinct()


def paired(cell: np.ndarray, a: np.ndarray, b: np.ndarray):
    """All pairs of rows of a and b that are in the same cell, in arrays of bounded size."""
    b = b[np.argsort(cell[b], kind="stable")]
    low = np.searchsorted(cell[b], cell[a], side="left")
    n = np.searchsorted(cell[b], cell[a], side="right") - low
    before = np.concatenate([[0], np.cumsum(n)])
    start = 0
    while start < len(a):
        stop = max(start + 1, int(np.searchsorted(before, before[start] + CHECKED, side="right")) - 1)
        x = np.repeat(a[start:stop], n[start:stop])
        yield x, b[np.arange(len(x)) + np.repeat(low[start:stop] - before[start:stop] + before[start], n[start:stop])]
        start = stop


#: Rows of a cell that all others are compared with first.
CENTRES = 4


def stars(task: Task, alike) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Join the rows of each cell that are alike one of its centres: its first tree row, then the first that stays apart from it, and so on.

    alike(x, y) says which rows of x are alike the centres y. Gives the rows that ask and those of trees, and which of them are not
    in their cell's largest group. Within that group nothing is left to find, so in a mass of copies only the pairs of
    the few others are looked at.
    """
    q, t = task.q, task.t
    left = t
    for _ in range(CENTRES):
        if not len(left):
            break
        cells, first = np.unique(task.cell[left], return_index=True)
        centres = left[first]
        for rows in (t, q):
            place = np.minimum(np.searchsorted(cells, task.cell[rows]), len(cells) - 1)
            here = cells[place] == task.cell[rows]
            x, y = rows[here], centres[place[here]]
            for start in range(0, len(x), CHECKED):
                a, b = x[start : start + CHECKED], y[start : start + CHECKED]
                apart = task.apart(a, b)
                a, b = a[apart], b[apart]
                if len(a):
                    near = alike(a, b)
                    task.join(a[near], b[near])
        left = left[task.apart(left, centres[np.searchsorted(cells, task.cell[left])])]
    every = np.unique(np.concatenate([q, t]))
    groups, count = np.unique(np.stack([task.cell[every], task.label[task.rank[every]]]), axis=1, return_counts=True)
    groups = groups[:, np.lexsort((-count, groups[0]))]
    cells, first = np.unique(groups[0], return_index=True)
    largest = groups[1][first]
    lone = lambda rows: largest[np.searchsorted(cells, task.cell[rows])] != task.label[task.rank[rows]]
    return q, t, lone(q), lone(t)


def likely_links(together: DataFrame, least: float) -> DataFrame:
    """Edges a, b of spanning forests of all shards, of pairs whose MinHash values (a byte of each in marks) agree in a share of least."""

    def run(batches):
        table = tabled(batches)
        if table is None:
            return
        task = Task(table)
        marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(table.num_rows, -1)
        agreeing = lambda x, y: (marks[x] == marks[y]).mean(axis=1) >= least
        q, t, lone_q, lone_t = stars(task, agreeing)
        for a, b in ((q[lone_q], t), (q[~lone_q], t[lone_t])):
            for x, y in paired(task.cell, a, b):
                apart = task.apart(x, y)
                x, y = x[apart], y[apart]
                agree = agreeing(x, y)
                task.join(x[agree], y[agree])
        yield pa.RecordBatch.from_pydict(task.edges())

    return bounded(together).mapInArrow(tidy(run), "a long, b long").distinct()


def exact_links(table: pa.Table, similarity: float, least: float) -> dict[str, np.ndarray]:
    """Edges a, b of a spanning forest of the rows of one task of one shard whose sets (64-bit hashes in grams) have the similarity.

    All pairs count, save those joined before and those that the sizes of their sets or their marks rule out.
    """
    task = Task(table)
    marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(table.num_rows, -1)
    grams = table.column("grams").to_pylist()
    n = np.array([len(g) // 8 for g in grams])
    first = np.cumsum(n) - n
    known, code = np.unique(np.frombuffer(b"".join(grams), np.uint64), return_inverse=True)
    held = np.zeros(len(known), dtype=bool)

    def alike(x: np.ndarray, y: int) -> np.ndarray:
        """Which of x have sets with the similarity to that of y."""
        out = np.minimum(n[x], n[y]) >= similarity * np.maximum(n[x], n[y]) - 1e-6
        out[out] = (marks[x[out]] == marks[y]).mean(axis=1) >= least
        x = x[out]
        if len(x):
            own = code[first[y] : first[y] + n[y]]
            held[own] = True
            begin = np.cumsum(n[x]) - n[x]
            both = np.add.reduceat(held[code[np.arange(n[x].sum()) + np.repeat(first[x] - begin, n[x])]], begin, dtype=np.int64)
            held[own] = False
            out[out] = both / (n[x] + n[y] - both) >= similarity
        return out

    q, t, lone_q, lone_t = stars(task, lambda x, y: alike(x, y[0]))  # one cell, so all centres are the same row
    others = t[lone_t]
    for y, lone in zip(q, lone_q):
        x = t if lone else others
        x = x[task.apart(x, y)]
        if len(x):
            x = x[alike(x, y)]
            task.join(x, np.full(len(x), y))
    return task.edges()


def components(edges: DataFrame) -> DataFrame:
    """id and label (the least id of its component) of every id in edges (a, b), a > b.

    First each id's edges are turned to its least neighbour, which joins the same ids: an id has an
    edge for each shard it was linked in, and most of those lead to a few roots.
    """
    least = F.array_min("bs")
    turned = F.transform(F.array_append(F.array_remove("bs", least), F.col("a")), lambda x: F.struct(x.alias("a"), least.alias("b")))
    edges = cut_lineage(edges.groupBy("a").agg(F.collect_set("b").alias("bs")).select(F.inline(turned)).distinct())
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = cut_lineage(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), F.col("label").alias("theirs")), "b").groupBy(F.col("a").alias("id")).agg(F.min("theirs").alias("theirs"))
        lower = labels.join(seen, "id").select("id", F.least("label", "theirs").alias("new"), F.col("label").alias("old"))
        jump = labels.select(F.col("id").alias("new"), F.col("label").alias("further"))
        stepped = cut_lineage(lower.join(jump, "new", "left").select("id", F.least("new", F.coalesce("further", "new")).alias("label"), "old"))
        changed = not stepped.where("label <> old").isEmpty()
        labels = stepped.select("id", "label")
        if not changed:
            return labels


def groups(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fp and component_id of every row of docs (doc_id, text)."""
    marked = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("id")))
    found = components(links(distinct.where(F.col("id").isNotNull()).select(F.array("fp").alias("fp"), "id"), radius))
    of = distinct.join(found, "id", "left").select("fp", F.coalesce("label", "id").alias("component_id"))
    return marked.join(of, "fp").select("doc_id", "fp", "component_id")


def identified(docs: DataFrame) -> DataFrame:
    """docs with _same and _size, which only equal texts share: 128 bits of a hash, and the length in bytes (-1: null)."""
    return docs.withColumns({"_same": F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))), "_size": F.coalesce(F.octet_length("text"), F.lit(-1))})


def similar_groups(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, margin: float = 0.15, radius: int = 3) -> DataFrame:
    """doc_id and component_id of rows of docs (doc_id, text), linked where shingle sets have the similarity (Jaccard); with them _same and _size, and
    those of the group's first text as first_same and first_size.

    Equal texts (by length and a hash of 128 bits) are one from the start, whatever their ids, and have a number of their own. Texts whose SimHash of the
    shingles is linked by the trees, and texts that share a band of MinHash values, are candidates. The linked ones, and those whose MinHash values
    agree in a share of similarity less margin (over four standard deviations), form likely groups, and
    in each of these the sets of shingles themselves decide.

    A null, empty or blank text is alike others of no word; texts of fewer words than a shingle are alike if all words are. component_id is the least
    doc_id of the group, and null only where all are; of several texts with it the one with the least hash is the first. doc_id may be of any type
    that has an order; rows that share it but not their text are apart; an empty table gives no row.
    """

    def mark(batches):
        for batch in steps(batches, size=MARKED):
            hashes, offsets = shingle_rows(plain(batch.column("text")), shingle)
            found = band_keys(minhashes(hashes, offsets))
            keys = pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * len(found) + 1, BANDS, dtype=np.int32)), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "_same", "_size")), pa.array(majority(hashes, offsets).view(np.int64)), keys], names=["doc_id", "_same", "_size", "fp", "keys"])

    keyed = identified(docs.select("doc_id", "text"))
    marked = cut_lineage(bounded(keyed).mapInArrow(tidy(mark), keyed.select("doc_id", "_same", "_size").schema.add("fp", "long").add("keys", T.ArrayType(T.LongType()))))
    texts = cut_lineage(marked.groupBy("_same", "_size").agg(F.min("doc_id").alias("doc"), F.first("fp").alias("fp"), F.first("keys").alias("keys")).withColumn("id", F.monotonically_increasing_id()))
    prints = cut_lineage(texts.groupBy("fp").agg(F.min("id").alias("id")))
    equal = texts.select("id", "fp").join(prints.select("fp", F.col("id").alias("b")), "fp").where("id <> b").select(F.col("id").alias("a"), "b")
    by_trees = cut_lineage(links(prints.select(F.array("fp").alias("fp"), "id"), radius).unionByName(equal))
    shared = cut_lineage(deal(texts.select("id", F.explode("keys").alias("shard"), F.lit(0).alias("weight"))))
    candidates = shared.select("id").union(by_trees.select(F.explode(F.array("a", "b")).alias("id"))).distinct()
    members = cut_lineage(texts.select("id", "doc", "_same", "_size").join(candidates, "id", "left_semi"))

    def outline(batches):
        for batch in steps(batches, size=MARKED):
            hashes, offsets = shingle_rows(plain(batch.column("text")), shingle)
            marks = minhashes(hashes, offsets).astype(np.uint8)
            grams = [np.unique(hashes[a:b]).tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([m.tobytes() for m in marks], pa.binary()), pa.array(grams, pa.binary())], names=["id", "marks", "grams"])

    some = small_enough(members.select("id", "doc", F.col("_same").alias("s"), F.col("_size").alias("z")), MOST_GONE)
    here = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("_same") == F.col("s")) & (F.col("_size") == F.col("z"))
    chosen = keyed.join(some, here).select("id", "text")
    outlined = cut_lineage(bounded(chosen).mapInArrow(tidy(outline), "id long, marks binary, grams binary").dropDuplicates(["id"]))
    likely = components(likely_links(shared.join(outlined.select("id", "marks"), "id").repartition("shard", "tree", "part"), similarity - margin).unionByName(by_trees))
    weighed = likely.join(outlined.select("id", F.octet_length("grams").alias("weight")), "id").select("id", F.col("label").alias("shard"), "weight")
    cells = deal(weighed).join(outlined, "id").groupBy("shard", "tree", "part")
    decide = lambda table: pa.Table.from_pydict(exact_links(table, similarity, similarity - margin))
    found = components(cells.applyInArrow(decide, "a long, b long").distinct())
    labelled = texts.select("id", "doc", "_same", "_size").join(found, "id", "left").withColumn("label", F.coalesce("label", "id"))
    order = F.struct(F.col("doc").isNull().alias("a"), F.col("doc").alias("b"), F.col("_same").alias("c"), F.col("_size").alias("d"))
    heads = labelled.groupBy("label").agg(F.min(order).alias("head"))
    of = labelled.join(heads, "label").select("_same", "_size", F.col("head.b").alias("component_id"), F.col("head.c").alias("first_same"), F.col("head.d").alias("first_size"))
    return marked.select("doc_id", "_same", "_size").join(of, ["_same", "_size"])


def deduplicate(docs: DataFrame, similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """docs with one document of each group of similar texts: the one with the least doc_id; rows with null ids stay.

    Documents are told apart by id and text, so texts that share an id but are not alike all stay. Of rows that repeat with id and text one stays.
    """
    found = cut_lineage(similar_groups(docs, similarity, shingle).where(F.col("doc_id").isNotNull()))
    first = (F.col("doc_id") == F.col("component_id")) & (F.col("_same") == F.col("first_same")) & (F.col("_size") == F.col("first_size"))
    gone = found.where(~first).select(F.col("doc_id").alias("gone_id"), F.col("_same").alias("gone_same"), F.col("_size").alias("gone_size")).distinct()
    # the columns of docs travel in one, so that none of theirs is taken for one of ours
    told = identified(docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))).drop("text")
    kept = told.join(small_enough(gone, MOST_GONE), (F.col("doc_id") == F.col("gone_id")) & (F.col("_same") == F.col("gone_same")) & (F.col("_size") == F.col("gone_size")), "left_anti")
    if not found.groupBy("doc_id", "_same", "_size").count().where("count > 1").isEmpty():
        kept = kept.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "_same", "_size"]).unionByName(kept.where(F.col("doc_id").isNull()))
    return kept.select("doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: fingerprint and component of every document."""
    found = groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
