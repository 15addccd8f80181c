"""Token ids in binary files, compressed by adaptive context mixing.

A file holds some four million ids of documents in ascending order of doc_id, as
words: runs of ids that a tokenizer gave for the same part of a text (or single ids). Its words are in blocks of 512
(2,048 of single ids), which are coded without regard to one another, each with a checksum of its words' numbers. It is a
header (magic, version, words of a block, number of ids, of words, of blocks and of documents, bytes and checksum of the tables,
checksum of the list of blocks), then the bytes and the checksum of each block, then the index (the doc_id and the number of ids
of each document), then the tables (the distinct words, and counts of words, of pairs of them and of what follows these, from
which each block starts), then the blocks. So a file
can be read by document by itself, and a block decoded by itself, given its file's tables. Files lie in the rows
(part, number, size, content) of a Parquet table, so Spark's writer commits them. Reading
checks every checksum.

Defined results: null text is empty and is just its end id; rows of the same
doc_id follow each other in no fixed order; a null doc_id comes first; an empty
table gives no file and no row; an id of 65,536 or more is an error when it is written; other columns
are ignored, whatever their names. The query's files stay in the checkpoint folder, whose owner clears it.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellscore.llm import mixing
from cellscore.llm.arrays import bounded, cut_binary, give_back, plain, steps
from cellscore.llm.op7_pack import public_tokenizer
from cellscore.llm.tokens import Encoder, encoder
from cellscore.plans import small_enough
from cellscore.plans.lineage import checkpoint_folder

MAGIC, VERSION = b"IDCM", 4
HEAD = struct.Struct("<4sBxHQQIIIII")
#: Stands for a null doc_id in a file.
NULL_ID = -(1 << 63)
#: Words of a block: where each id is a word, and where words are parts of texts (fewer, so that more blocks go in step).
BLOCK, PARTS_BLOCK = 2048, 512
#: Times that a pair of parts must occur to be in the tables, and ids by which words are put in order.
PARTS_LEAST, HEADS = 6, 4
#: Ids after which a file is closed at the end of a document.
FILE_IDS = 1 << 22
#: Parts of texts whose ids a Python worker keeps (some 250 bytes each).
MOST_PARTS = 1_200_000
#: Parts whose offsets are broadcast; more are joined by a shuffle.
MOST_FILES = 500_000


class Words:
    """The distinct words of a file: runs of ids, numbered in the order in which they came."""

    def __init__(self):
        self.ids, self.lengths, self.n = [], [], 0
        self._numbers, self._renewed = np.zeros(0, np.int32), -1

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of further words."""
        if len(ids) and int(ids.max()) > 0xFFFF:
            raise ValueError(f"id {int(ids.max())} does not fit the format")
        self.ids.append(ids.astype("<u2"))
        self.lengths.append(lengths.astype("<u4"))
        self.n += len(lengths)
        return np.arange(self.n - len(lengths), self.n, dtype=np.int32)

    def of(self, coder: Encoder, code: np.ndarray) -> np.ndarray:
        """Numbers of parts of an encoder; after it has numbered its parts anew, one may come as a further word."""
        if self._renewed != coder.renewed:
            self._numbers, self._renewed = np.full(len(coder.codes), -1, np.int32), coder.renewed
        self._numbers = np.append(self._numbers, np.full(len(coder.codes) - len(self._numbers), -1, np.int32))
        numbers = self._numbers[code]
        new = np.unique(code[numbers < 0])
        if len(new):
            self._numbers[new] = self.add(*coder.ids_of(new))
            numbers = self._numbers[code]
        return numbers

    def dump(self) -> tuple[bytes, np.ndarray]:
        """The words as bytes, in the order of their first ids, and each word's place there."""
        lengths, flat = np.concatenate([np.zeros(0, "<u4"), *self.lengths]).astype(np.int64), np.concatenate([np.zeros(0, "<u2"), *self.ids])
        starts = np.cumsum(lengths) - lengths
        columns = [np.where(lengths > k, np.append(flat, 0)[np.minimum(starts + k, len(flat))], 0).astype(np.uint64) for k in range(HEADS)]
        order = np.argsort(sum(c << np.uint64(16 * (HEADS - 1 - k)) for k, c in enumerate(columns)), kind="stable")
        places = np.empty(len(order), np.int32)
        places[order] = np.arange(len(order))
        lengths, starts = lengths[order], starts[order]
        parts, turn = [lengths.astype("<u4")], np.arange(len(order)) == 0
        for column in columns:
            column = column[order].astype(np.int64)
            parts.append(np.where(turn, column, np.diff(column, prepend=0)).astype("<u2"))
            turn = turn | (parts[-1] != 0)
        more = np.maximum(lengths - HEADS, 0)
        parts.append(flat[np.repeat(starts + HEADS - (np.cumsum(more) - more), more) + np.arange(int(more.sum()))])
        raw = b"".join(p.view(np.uint8).reshape(-1, p.itemsize).T.tobytes() for p in parts)
        return struct.pack("<II", self.n, int(more.sum())) + zlib.compress(raw, 1), places

    @staticmethod
    def load(data: bytes) -> pa.LargeBinaryArray:
        """The ids of each word, of four bytes."""
        n, more = struct.unpack_from("<II", data)
        raw, at, parts = zlib.decompress(data[8:]), 0, []
        for size, t in ((n, "<u4"), *[(n, "<u2")] * HEADS, (more, "<u2")):
            wide = np.dtype(t).itemsize
            parts.append(np.frombuffer(raw, np.uint8, size * wide, at).reshape(wide, size).T.copy().view(t).ravel())
            at += size * wide
        lengths, turn = parts[0].astype(np.int64), np.arange(n) == 0
        offsets = np.append(0, np.cumsum(lengths))
        flat, rest = np.zeros(int(offsets[-1]), "<u4"), np.ones(int(offsets[-1]), bool)
        for k, gaps in enumerate(parts[1:-1]):
            ends = np.cumsum(gaps, dtype=np.int64)
            column = ends - (ends - gaps)[np.maximum.accumulate(np.where(turn, np.arange(n), 0))]
            turn = turn | (gaps != 0)
            here = lengths > k
            to = offsets[:-1][here] + k
            flat[to], rest[to] = column[here], False
        flat[rest] = parts[-1]
        return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(4 * offsets), pa.py_buffer(flat)])


def pack_words(symbols: np.ndarray, words: Words, n: int, names: np.ndarray, lengths: np.ndarray, block: int, least: int = mixing.LEAST_PAIR) -> bytes:
    """A file of n ids, given as numbers of words, of documents with the given doc_ids and numbers of ids."""
    listed, places = words.dump()
    symbols = places[symbols]
    learnt, pairs = mixing.Tables.learn_pairs(symbols, least)
    tables = struct.pack("<I", len(listed)) + listed + learnt.dump()
    payload, sizes = mixing.encode(symbols, learnt, block, pairs)
    little = memoryview(symbols.astype("<u4").tobytes())
    sums = [zlib.crc32(little[4 * i : 4 * (i + block)]) for i in range(0, len(symbols), block)]
    table = np.array([sizes, sums], dtype="<u4").T.tobytes()
    head = HEAD.pack(MAGIC, VERSION, block, n, len(symbols), len(sizes), len(names), len(tables), zlib.crc32(tables), zlib.crc32(table))
    return b"".join([head, table, names.astype("<i8").tobytes(), lengths.astype("<i8").tobytes(), tables, payload])


def pack_file(ids: np.ndarray, names: np.ndarray | None = None, lengths: np.ndarray | None = None) -> bytes:
    """A file of ids below 65,536, each a word, of documents with the given doc_ids and numbers of ids."""
    distinct, symbols = np.unique(ids, return_inverse=True)
    words = Words()
    words.add(distinct, np.ones(len(distinct), np.int64))
    names, lengths = (np.zeros(0, "<i8") if x is None else x for x in (names, lengths))
    return pack_words(symbols.astype(np.int32), words, len(ids), names, lengths, BLOCK)


class _File:
    """The parts of a file."""

    def __init__(self, content: bytes):
        magic, version, self.block, self.n, self.symbols, blocks, self.documents, size, self._total, total = HEAD.unpack_from(content)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a file of ids")
        self.content = content
        self.index_at = HEAD.size + 8 * blocks
        if zlib.crc32(content[HEAD.size : self.index_at]) != total:
            raise ValueError("the list of blocks is damaged")
        sized = np.frombuffer(content, "<u4", 2 * blocks, HEAD.size).reshape(blocks, 2)
        self.sizes, self.sums = sized[:, 0].astype(np.int64), sized[:, 1]
        self.tables_at = self.index_at + 16 * self.documents
        self.blocks_at = self.tables_at + size

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of some blocks, if the checksums of the tables and of each block hold."""
        data = self.content[self.tables_at : self.blocks_at]
        if zlib.crc32(data) != self._total:
            raise ValueError("the tables are damaged")
        (size,) = struct.unpack_from("<I", data)
        tables = mixing.Tables.load(data[4 + size :])
        sizes, at = self.sizes[first:last], self.blocks_at + int(self.sizes[:first].sum())
        n = min(self.symbols, last * self.block) - first * self.block if last > first else 0
        symbols = mixing.decode(self.content[at : at + int(sizes.sum())], sizes.tolist(), n, tables, self.block)
        little = memoryview(symbols.astype("<u4").tobytes())
        for i in range(first, last):
            if zlib.crc32(little[4 * (i - first) * self.block : 4 * (i - first + 1) * self.block]) != self.sums[i]:
                raise ValueError(f"block {i} is damaged")
        found = Words.load(data[4 : 4 + size]).take(pa.array(symbols))
        return np.frombuffer(found.buffers()[2] or b"", "<u4")


def index(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The doc_id (NULL_ID for null) and the number of ids of each document of a file."""
    file = _File(content)
    both = np.frombuffer(content, "<i8", 2 * file.documents, file.index_at)
    return both[: file.documents], both[file.documents :]


def unpack_file(content: bytes) -> np.ndarray:
    """The ids of a file; a broken header or checksum is an error."""
    file = _File(content)
    return file.ids(0, len(file.sizes))


def unpack_block(content: bytes, i: int) -> np.ndarray:
    """The ids of one block of a file; a broken checksum is an error."""
    return _File(content).ids(i, i + 1)


def write_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, file_ids: int = FILE_IDS) -> None:
    """Write the ids of docs (doc_id, text) as files below path, in ascending order of doc_id over parts and files."""
    source = tokenizer or public_tokenizer("word_bpe_49k.json")
    schema = "part long, number long, size long, content binary"

    def run(batches):
        coder = encoder(source, MOST_PARTS)
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        names, lengths, held, words, size, number = [], [], [], Words(), 0, 0
        end = words.add(np.array([end_id]), np.array([1]))

        def close() -> pa.RecordBatch:
            content = pack_words(np.concatenate(held), words, size, np.concatenate(names), np.concatenate(lengths), PARTS_BLOCK, PARTS_LEAST)
            row = [pa.array([v], k) for v, k in ((part, pa.int64()), (number, pa.int64()), (size, pa.int64()), (content, pa.binary()))]
            return pa.RecordBatch.from_arrays(row, names=["part", "number", "size", "content"])

        for batch in steps(batches, size=4 << 20):
            code, counts = coder.parts(plain(batch.column("text")))
            ends = np.cumsum(counts)
            held.append(np.insert(words.of(coder, code), ends, end))
            names.append(pc.fill_null(batch.column("doc_id").cast(pa.int64()), NULL_ID).to_numpy())
            upto = np.append(0, np.cumsum(coder.lengths[code]))[ends]
            lengths.append(np.diff(upto, prepend=0) + 1)
            size += int(upto[-1]) + len(counts)
            if size >= file_ids:
                yield close()
                names, lengths, held, words, size, number = [], [], [], Words(), 0, number + 1
                end = words.add(np.array([end_id]), np.array([1]))
        if held:
            yield close()
        give_back()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    bounded(ordered).mapInArrow(run, schema).write.option("compression", "none").parquet(path)


def read_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids (uint32, little-endian) from files below path."""
    files = spark.read.parquet(path)
    columns_of = ["part", "number", "doc_id", "within", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                part, number, content = (batch.column(c)[i] for c in ("part", "number", "content"))
                data = content.as_py()
                raw = unpack_file(data).data.cast("B")
                names, n = index(data)
                ends = np.cumsum(n)
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - n).tolist(), ends.tolist())]
                columns = [pa.repeat(part, len(n)), pa.repeat(number, len(n)), pa.array(names, mask=names == NULL_ID), pa.array(ends - n), pa.array(n), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *[cut_binary(raw, 4 * ends)] * with_ids], names=columns_of)

    docs = files.select("part", "number", "content").mapInArrow(run, "part long, number long, doc_id long, within long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    # ids before a file: those of earlier parts, and of earlier files of its part
    sizes = files.select("part", "number", "size")
    parts = sizes.groupBy("part").agg(F.sum("size").alias("whole"))
    before = parts.select("part", (F.sum("whole").over(Window.orderBy("part")) - F.col("whole")).alias("earlier"))  # a row a part
    inside = (F.sum("size").over(Window.partitionBy("part").orderBy("number")) - F.col("size")).alias("inside")
    offsets = sizes.select("part", "number", inside).join(before, "part").select("part", "number", (F.col("earlier") + F.col("inside")).alias("offset"))
    joined = docs.join(small_enough(offsets, MOST_FILES), ["part", "number"])
    return joined.select("doc_id", (F.col("offset") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: documents' ids written to files and read back."""
    checkpoint_folder(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/ids-{uuid.uuid4().hex}"
    write_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_files(spark, path)
