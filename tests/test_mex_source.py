"""The mex format against plain text files."""

import gzip
import random
from pathlib import Path

import pytest

from cellscore import sources as io
from cellscore.sources import mex

ENTRIES = [(r, c, random.Random(r * 31 + c).choice([1.0, 2.5, 1e-7, 123456789.0])) for r in range(1, 41) for c in range(1, 26) if (r * c) % 7]
HEAD = "%%MatrixMarket matrix coordinate real general\n% a comment\n%\n40 25 {n}\n"


def text():
    return HEAD.format(n=len(ENTRIES)) + "".join(f"{r} {c} {v!r}\n" for r, c, v in ENTRIES)


def read(spark, path, **options):
    mex.register(spark)
    return spark.read.format("mex").options(**{k: str(v) for k, v in options.items()}).load(str(path))


@pytest.mark.parametrize("end", ["\n", ""])
@pytest.mark.parametrize("split", [1, 7, 64, 1000, 1 << 20])
def test_ranges_have_each_line_once(monkeypatch, tmp_path, split, end):
    monkeypatch.setattr(mex, "BLOCK_BYTES", 50)
    path = tmp_path / "matrix.mtx"
    path.write_text(text()[:-1] + end)
    reader = mex.MexReader(str(path), "matrix", split)
    parts = reader.partitions()
    assert len(parts) == max(1, -(-(len(text()) - 1 + len(end) - len(HEAD.format(n=len(ENTRIES)))) // split))
    found = [tuple(x) for p in parts for b in reader.read(p) for x in zip(*(c.to_pylist() for c in b.columns))]
    assert found == ENTRIES and mex.sizes(str(path)) == (40, 25, len(ENTRIES))


def test_plain_matrix_in_several_tasks(spark, tmp_path):
    (tmp_path / "matrix.mtx").write_text(text().replace(" 2.5", "\t 2.5").replace("\n", "\r\n"))
    df = read(spark, tmp_path / "matrix.mtx", splitBytes=900)
    assert df.rdd.getNumPartitions() > 10 and sorted(map(tuple, df.collect())) == ENTRIES
    with gzip.open(tmp_path / "other.mtx.gz", "wt") as f:
        f.write(text())
    packed = read(spark, tmp_path / "other.mtx.gz", splitBytes=900)
    assert packed.rdd.getNumPartitions() == 1 and sorted(map(tuple, packed.collect())) == ENTRIES


def test_lines_are_numbered_over_ranges_and_files(spark, tmp_path):
    folder = tmp_path / "barcodes.tsv"
    folder.mkdir()
    names = [f"cell-{'x' * (i % 13)}{i}" for i in range(500)]
    (folder / "part-0").write_text("".join(f"{n}\n" for n in names[:200]))
    (folder / "part-1").write_text("")
    with gzip.open(folder / "part-2.gz", "wt") as f:
        f.write("".join(f"{n}\n" for n in names[200:300]))
    (folder / "part-3").write_text("\n".join(names[300:]))
    (folder / "_hidden").write_text("no cell\n")
    rows = mex.numbered(read(spark, folder, part="barcodes", splitBytes=100)).collect()
    assert sorted((r["pos"], r["value"]) for r in rows) == list(enumerate(names))


@pytest.mark.parametrize("wrong", ["1 2\n", "1 2 3 4\n", "1 x 3\n", "1 2 3 1 2 3\n"])
def test_lines_that_are_no_entries_are_an_error(spark, tmp_path, wrong):
    (tmp_path / "m.mtx").write_text(text() + wrong)
    with pytest.raises(Exception, match="no entries"):
        read(spark, tmp_path / "m.mtx").collect()


def test_files_that_are_no_matrix(spark, tmp_path):
    (tmp_path / "a.mtx").write_text("1 2 3\n")
    (tmp_path / "b.mtx").write_text("%%MatrixMarket matrix coordinate real general\n% nothing more")
    for name, why in (("a", "no coordinate matrix"), ("b", "no line of sizes"), ("c", "c.mtx")):
        with pytest.raises(Exception, match=why):
            read(spark, tmp_path / f"{name}.mtx").collect()
    with pytest.raises(Exception, match="none of"):
        read(spark, tmp_path / "a.mtx", part="genes").collect()


def write(df, path, mode="append", **options):
    mex.register(df.sparkSession)
    df.write.format("mex").options(**options).mode(mode).save(str(path))


def test_written_files_are_committed_replaced_and_aborted(spark, tmp_path):
    df = spark.createDataFrame(ENTRIES, "row long, column long, value double").repartition(5)
    path = tmp_path / "matrix.mtx"
    write(df, path, rows="40", columns="25")
    assert sorted(map(tuple, read(spark, path).collect())) == ENTRIES and mex.sizes(str(path)) == (40, 25, len(ENTRIES))
    with pytest.raises(Exception, match="there already"):
        write(df, path, rows="40", columns="25")
    write(df.where("row < 3"), path, "overwrite", rows="40", columns="25")
    kept = sorted(map(tuple, read(spark, path).collect()))
    assert kept == [e for e in ENTRIES if e[0] < 3] and mex.sizes(str(path))[2] == len(kept)
    before = sorted(p.name for p in Path(path).iterdir())
    failing = df.selectExpr("row", "column", "if(row = 40, raise_error('late'), value) as value")
    with pytest.raises(Exception, match="late"):
        write(failing, path, "overwrite", rows="40", columns="25")
    assert sorted(p.name for p in Path(path).iterdir()) == before and sorted(map(tuple, read(spark, path).collect())) == kept
    with pytest.raises(Exception, match="must state"):
        write(df, tmp_path / "other")
    with pytest.raises(Exception, match="has columns"):
        write(df.drop("row"), tmp_path / "other", rows="1", columns="1")


def test_order_is_that_of_partitions_and_empty_tables(spark, tmp_path):
    cells = spark.range(1000).selectExpr("cast(999 - id as string) as value", "id").repartition(7).orderBy("id").select("value")
    write(cells, tmp_path / "b.tsv", part="barcodes", compression="gzip")
    rows = mex.numbered(read(spark, tmp_path / "b.tsv", part="barcodes")).collect()
    assert sorted((r["pos"], r["value"]) for r in rows) == [(i, str(999 - i)) for i in range(1000)]
    assert all(p.name.endswith(".gz") for p in Path(tmp_path / "b.tsv").iterdir())
    write(cells.limit(0), tmp_path / "none.tsv", part="barcodes")
    assert read(spark, tmp_path / "none.tsv", part="barcodes").count() == 0


def test_folder_of_older_plain_files(spark, tmp_path):
    (tmp_path / "matrix.mtx").write_text(text())
    (tmp_path / "barcodes.tsv").write_text("".join(f"c{i}\n" for i in range(25)))
    (tmp_path / "genes.tsv").write_text("".join(f"g{i}\tname {i}\n" for i in range(40)))
    counts, cells, features = io.read_10x_mex(spark, str(tmp_path), split_bytes=300)
    assert sorted(map(tuple, counts.collect())) == sorted((f"c{c - 1}", f"g{r - 1}", v) for r, c, v in ENTRIES)
    assert cells.count() == 25 and features.orderBy("pos").first()["feature_name"] == "name 0"
