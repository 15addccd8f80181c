"""The three text files of a sparse count matrix as a data source: spark.read.format("mex") and df.write.format("mex").

Option part is matrix (columns row, column and value; both from 1), barcodes (value) or features (feature_id, feature_name, feature_type); the
path is a file, or a folder of files that belong together in the order of their names. barcodes and features also have split and at, a
line's part of the files and its place in it, from 0; numbered turns them into the line's number.

Plain files are read in byte ranges of option splitBytes: a range has the lines that start in it. Gzipped files can't be split, and are a
range each. The matrix's comment and line of sizes are read when the ranges are planned; sizes tells what they say. Numbers are parsed a block of
lines at a time, into Arrow batches.

The writer takes matrix (row, column, value; options rows and columns for the line of sizes), barcodes (value) or features (feature_id, feature_name)
in the order of partitions, plain or with option compression = gzip. Tasks write to names that readers pass over; only when all have
succeeded do the files get their names, and the matrix its first file with the number of entries, which the tasks
have counted. What a failed write has left is removed; mode overwrite removes the old files after the new ones are there.
"""

from __future__ import annotations

import gzip
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Bytes of a range of a plain file, and of lines that are parsed at once.
SPLIT_BYTES, BLOCK_BYTES = 1 << 26, 1 << 22
#: Fixed values of the file format.
BANNER = "%%MatrixMarket matrix coordinate real general"
FEATURE_TYPE = "Gene Expression"
SCHEMAS = {
    "matrix": "row long, column long, value double",
    "barcodes": "split int, at long, value string",
    "features": "split int, at long, feature_id string, feature_name string, feature_type string",
}


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    path = path.replace("s3a://", "s3://", 1)
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def files_of(store: pafs.FileSystem, path: str) -> list[pafs.FileInfo]:
    """The file, or the files of the folder by name, without hidden ones."""
    info = store.get_file_info(path)
    if info.type == pafs.FileType.File:
        return [info]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    return sorted((f for f in store.get_file_info(pafs.FileSelector(path)) if f.type == pafs.FileType.File and f.base_name[0] not in "._"), key=lambda f: f.base_name)


def _opened(store: pafs.FileSystem, path: str, start: int = 0):
    """A stream of bytes from start; a gzipped file's from its beginning."""
    if path.endswith(".gz"):
        return gzip.GzipFile(fileobj=store.open_input_file(path))
    stream = store.open_input_file(path)
    stream.seek(start)
    return stream


def _head(store: pafs.FileSystem, path: str) -> tuple[tuple[int, int, int], int]:
    """Rows, columns and entries that a matrix states, and where its first entry starts."""
    with _opened(store, path) as stream:
        text = b""
        while True:
            block = stream.read(1 << 16)
            text += block
            at = 0
            while (end := text.find(b"\n", at)) >= 0 or not block:
                line = text[at : end if end >= 0 else len(text)].strip()
                if at == 0 and not line.startswith(b"%%MatrixMarket matrix coordinate"):
                    raise ValueError(f"{path} is no coordinate matrix")
                if line and not line.startswith(b"%"):
                    rows, columns, entries = map(int, line.split())
                    return (rows, columns, entries), end + 1 if end >= 0 else len(text)
                if end < 0:
                    raise ValueError(f"{path} has no line of sizes")
                at = end + 1


def sizes(path: str) -> tuple[int, int, int]:
    """Rows, columns and entries that the matrix in path states."""
    store, place = located(path)
    return _head(store, files_of(store, place)[0].path)[0]


@dataclass
class Range(InputPartition):
    """The lines of a file that start from start on and before stop (0: to its end); skip: bytes of a gzipped file to pass over."""

    path: str
    split: int
    start: int
    stop: int
    skip: int = 0


def blocks(store: pafs.FileSystem, part: Range) -> Iterator[bytes]:
    """Whole lines of a range, some at a time, each ended."""
    begin = max(0, part.start - 1)  # a line that starts at start follows the end of another
    with _opened(store, part.path, begin) as stream:
        at, rest = begin, b""
        if part.skip:
            stream.read(part.skip)
        if part.start:
            while True:
                block = stream.read(BLOCK_BYTES)
                end = block.find(b"\n")
                at += len(block) if end < 0 else end + 1
                if end >= 0 or not block:
                    rest = block[end + 1 :]
                    break
            if end < 0:
                return
        while not part.stop or at < part.stop:
            block = stream.read(BLOCK_BYTES)
            text = rest + block
            if part.stop and at + len(text) >= part.stop:  # the last line that starts in the range may end behind it
                end = text.find(b"\n", max(0, part.stop - 1 - at))
                if end >= 0:
                    yield text[: end + 1]
                    return
            elif block:
                end = text.rfind(b"\n")
                if end >= 0:
                    yield text[: end + 1]
                    at += end + 1
                    rest = text[end + 1 :]
                    continue
            if not block:
                if text:
                    yield text + b"\n" * (not text.endswith(b"\n"))
                return
            rest = text


class MexReader(DataSourceReader):
    def __init__(self, path: str, part: str, split_bytes: int):
        self.path, self.part, self.split_bytes = path, part, split_bytes

    def partitions(self) -> list[Range]:
        store, place = located(self.path)
        out: list[Range] = []
        for i, f in enumerate(files_of(store, place)):
            first = _head(store, f.path)[1] if self.part == "matrix" and not i else 0
            if f.path.endswith(".gz"):
                out.append(Range(f.path, len(out), 0, 0, first))
            else:
                out += [Range(f.path, len(out) + n, at, min(at + self.split_bytes, f.size)) for n, at in enumerate(range(first, f.size, self.split_bytes))]
        return out

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no file at all
            return
        store, _ = located(self.path)
        at = 0
        for text in blocks(store, part):
            if self.part == "matrix":
                yield self._entries(text)
                continue
            lines = text.decode().replace("\r\n", "\n").split("\n")[:-1]
            place = [pa.array(np.full(len(lines), part.split, np.int32)), pa.array(np.arange(at, at + len(lines)))]
            at += len(lines)
            if self.part == "barcodes":
                yield pa.RecordBatch.from_arrays([*place, pa.array(lines, pa.string())], names=["split", "at", "value"])
            else:
                fields = [(x.split("\t") + [None, None])[:3] for x in lines]
                yield pa.RecordBatch.from_arrays([*place, *(pa.array([x[i] for x in fields], pa.string()) for i in range(3))], names=["split", "at", "feature_id", "feature_name", "feature_type"])

    def _entries(self, text: bytes) -> pa.RecordBatch:
        import warnings

        with warnings.catch_warnings():
            warnings.simplefilter("error")
            try:
                numbers = np.fromstring(text.decode(), sep=" ").reshape(-1, 3)
            except (DeprecationWarning, ValueError) as wrong:
                raise ValueError(f"{self.path} has lines that are no entries of a matrix") from wrong
        if len(numbers) != sum(1 for line in io.BytesIO(text) if line.strip()):
            raise ValueError(f"{self.path} has lines that are no entries of a matrix")
        place = numbers[:, :2].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(place[:, 0]), pa.array(place[:, 1]), pa.array(numbers[:, 2].copy())], names=["row", "column", "value"])


@dataclass
class Written(WriterCommitMessage):
    path: str
    lines: int


class MexWriter(DataSourceArrowWriter):
    def __init__(self, path: str, part: str, options: dict[str, str], overwrite: bool):
        self.path, self.part, self.options, self.overwrite = path, part, options, overwrite
        self.end, self.attempt = ".gz" if options.get("compression") == "gzip" else "", uuid.uuid4().hex
        store, place = located(path)
        found = store.get_file_info(place)
        self.old = [] if found.type == pafs.FileType.NotFound else [f.path for f in files_of(store, place)]
        if found.type == pafs.FileType.File or self.old and not overwrite:
            raise FileExistsError(f"{path} is there already")

    def _text(self, batch: pa.RecordBatch) -> bytes:
        columns = {n: batch.column(n) for n in batch.schema.names}
        if self.part == "matrix":
            values = columns["value"].to_pylist()
            lines = (f"{r} {c} {v!r}" for r, c, v in zip(columns["row"].to_pylist(), columns["column"].to_pylist(), values))
        elif self.part == "barcodes":
            lines = columns["value"].to_pylist()
        else:
            lines = (f"{i}\t{n}\t{FEATURE_TYPE}" for i, n in zip(columns["feature_id"].to_pylist(), columns["feature_name"].to_pylist()))
        return "".join(f"{x}\n" for x in lines).encode()

    def _put(self, store: pafs.FileSystem, name: str, texts) -> None:
        with store.open_output_stream(name, compression=None) as raw:
            if self.end:
                with gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=3, filename="", mtime=0) as packed:
                    for text in texts:
                        packed.write(text)
            else:
                for text in texts:
                    raw.write(text)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, place = located(self.path)
        store.create_dir(place, recursive=True)
        name = f"{place}/_{self.attempt}-{context.partitionId():06d}-{context.taskAttemptId()}{self.end}"
        lines = 0

        def texts():
            nonlocal lines
            for batch in batches:
                lines += batch.num_rows
                yield self._text(batch)

        self._put(store, name, texts())
        return Written(f"{name}|{context.partitionId():06d}", lines)

    def commit(self, messages: list[Written | None]) -> None:
        store, place = located(self.path)
        store.create_dir(place, recursive=True)
        done = [m for m in messages if m is not None]
        if self.part == "matrix":
            head = f"{BANNER}\n{self.options['rows']} {self.options['columns']} {sum(m.lines for m in done)}\n"
            self._put(store, f"{place}/part-{self.attempt}-000000-head.mtx{self.end}", [head.encode()])
        for m in done:
            name, _, number = m.path.partition("|")
            if m.lines:
                store.move(name, f"{place}/part-{self.attempt}-{number}-lines.{'mtx' if self.part == 'matrix' else 'tsv'}{self.end}")
            else:
                store.delete_file(name)
        if self.overwrite:
            for f in self.old:
                store.delete_file(f)
        self._sweep(store, place)

    def _sweep(self, store: pafs.FileSystem, place: str) -> None:
        """Remove what attempts of this write have left that no task reported."""
        if store.get_file_info(place).type == pafs.FileType.Directory:
            for f in store.get_file_info(pafs.FileSelector(place)):
                if f.base_name.startswith(f"_{self.attempt}-"):
                    store.delete_file(f.path)

    def abort(self, messages: list[Written | None]) -> None:
        self._sweep(*located(self.path))


class MexSource(DataSource):
    """See the module."""

    @classmethod
    def name(cls) -> str:
        return "mex"

    def _part(self) -> str:
        part = self.options.get("part", "matrix")
        if part not in SCHEMAS:
            raise ValueError(f"part {part} is none of {', '.join(SCHEMAS)}")
        return part

    def schema(self) -> str:
        return SCHEMAS[self._part()]

    def reader(self, schema) -> MexReader:
        return MexReader(self.options["path"], self._part(), int(self.options.get("splitBytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> MexWriter:
        part, names = self._part(), set(schema.fieldNames())
        wanted = {"matrix": {"row", "column", "value"}, "barcodes": {"value"}, "features": {"feature_id", "feature_name"}}[part]
        if names != wanted:
            raise ValueError(f"part {part} has columns {', '.join(sorted(wanted))}, not {', '.join(sorted(names))}")
        if part == "matrix" and not {"rows", "columns"} <= {k.lower() for k in self.options}:
            raise ValueError("options rows and columns must state the size of the matrix")
        return MexWriter(self.options["path"], part, {k: self.options[k] for k in ("rows", "columns", "compression") if k in self.options}, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(MexSource)


def numbered(lines: DataFrame) -> DataFrame:
    """lines, of barcodes or features, with pos (from 0) in place of split and at. A count a range is gathered in one task."""
    counts = lines.groupBy("split").agg(F.count("*").alias("n"))
    before = counts.select("split", (F.sum("n").over(Window.orderBy("split")) - F.col("n")).alias("before"))  # a row a range of bytes
    return lines.join(F.broadcast(before), "split").withColumn("pos", F.col("before") + F.col("at")).drop("split", "at", "before")
