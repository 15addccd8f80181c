"""Sources and sinks. A run is a folder; tables of many runs carry run_id."""

from __future__ import annotations

from functools import reduce

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscore.functions import first_column, nullable_text
from cellscore.plans import Guard, cut_lineage, numbered_within, small_enough
from cellscore.sources import mex

ONTOLOGY_RESOURCE = "cl_names array<string>, cell_ontology_term_id_to_cell_type map<string,string>, children_dictionary map<string,array<string>>, shortest_path_lengths_from_cell_root map<string,int>, longest_path_lengths_from_cell_root map<string,int>"
ONTOLOGY_RESPONSE = "query_cell_id string, matches array<struct<score double, cell_type_ontology_term_id string, cell_type string>>, total_weight double, total_neighbors int, total_neighbors_unrecognized int"
REQUIRED = ("query_cell_id", "matches", "total_weight", "total_neighbors", "total_neighbors_unrecognized")
RUN_METADATA = "input_path string, model_name string, n_cells long, ontology_resource_name string"


def write_10x_mex(folder: str, counts: DataFrame, cells: DataFrame, features: DataFrame, overwrite: bool = False) -> None:
    """matrix, barcodes and features as gzipped text folders (see mex); rows of the matrix are features, columns are cells.

    The id of a feature is its gene_id, feature_id or gene_ids, its name feature_name, gene_symbol or gene_symbols;
    what stands for null is empty, and an empty id becomes the name. pos gives the order of cells and features.
    """
    mex.register(counts.sparkSession)

    def write(df: DataFrame, name: str, **options: str) -> None:
        df.write.format("mex").options(compression="gzip", **options).mode("overwrite" if overwrite else "append").save(f"{folder}/{name}.gz")

    ids, names = (first_column(features.columns, c) for c in (("gene_id", "feature_id", "gene_ids"), ("feature_name", "gene_symbol", "gene_symbols")))
    gene = F.coalesce(nullable_text(F.col(ids)) if ids else F.lit(None), F.lit(""))
    symbol = F.coalesce(nullable_text(F.col(names)) if names else F.lit(None), F.lit(""))
    rows = features.select("pos", F.when(gene == "", symbol).otherwise(gene).alias("gene"), symbol.alias("symbol"))
    write(rows.orderBy("pos").select(F.col("gene").alias("feature_id"), F.col("symbol").alias("feature_name")), "features.tsv", part="features")
    write(cells.orderBy("pos").select(F.col("cell_id").cast("string").alias("value")), "barcodes.tsv", part="barcodes")
    order = lambda df, key, name: df.select(key, F.col("pos").alias(name))
    placed = counts.join(order(features, "feature_id", "f"), "feature_id").join(order(cells, "cell_id", "c"), "cell_id")
    entries = placed.select((F.col("f") + 1).cast("long").alias("row"), (F.col("c") + 1).cast("long").alias("column"), F.col("value").cast("double").alias("value"))
    write(entries, "matrix.mtx", part="matrix", rows=str(features.count()), columns=str(cells.count()))


def _genome_folder(spark: SparkSession, folder: str, genome: str | None) -> str:
    """The folder of the three files: folder itself, or below it that of a genome, as older files have it.

    More than one genome and none asked for, or one that is not there, is an error. Newer files hold all genomes together, and genome
    does not restrict them.
    """
    below = sorted(r["run_id"] for r in run_files(spark, folder).select("run_id").distinct().collect())  # three files, or a few genomes
    if any(n.startswith("matrix.mtx") for n in below):
        return folder
    if genome is None and len(below) == 1:
        return f"{folder}/{below[0]}"
    if genome not in below:
        raise ValueError((f"no genome {genome}" if genome else "a genome must be chosen") + f"; there are {', '.join(below)}")
    return f"{folder}/{genome}"


def read_10x_mex(spark: SparkSession, folder: str, genome: str | None = None, split_bytes: int = mex.SPLIT_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """counts (cell_id, feature_id, value), cells (cell_id, pos) and features (feature_id, feature_name, pos). Positions are from 0.

    The files, or folders of files, are plain or gzipped; plain ones are read in ranges of split_bytes. genes.tsv stands for features.tsv in older folders.
    """
    folder = _genome_folder(spark, folder, genome)
    mex.register(spark)
    store, place = mex.located(folder)

    def read(part: str, *names: str) -> DataFrame:
        for name in (f"{n}{end}" for n in names for end in ("", ".gz")):
            if store.get_file_info(f"{place}/{name}").type != pafs.FileType.NotFound:
                return spark.read.format("mex").options(part=part, splitBytes=str(split_bytes)).load(f"{folder}/{name}")
        raise FileNotFoundError(f"{folder} has no {names[0]}")

    cells = mex.numbered(read("barcodes", "barcodes.tsv")).select(F.col("value").alias("cell_id"), "pos")
    features = mex.numbered(read("features", "features.tsv", "genes.tsv")).select("feature_id", "feature_name", "pos")
    entries = read("matrix", "matrix.mtx")
    counts = entries.join(features.select("feature_id", (F.col("pos") + 1).alias("row")), "row").join(cells.select("cell_id", (F.col("pos") + 1).alias("column")), "column")
    return counts.select("cell_id", "feature_id", "value"), cells, features


def write_counts(folder: str, counts: DataFrame, cells: DataFrame, features: DataFrame, overwrite: bool = False) -> None:
    """An annotated matrix as three Parquet tables."""
    for name, df in (("counts", counts), ("cells", cells), ("features", features)):
        df.write.mode(_mode(overwrite)).parquet(f"{folder}/{name}.parquet")


def read_counts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{folder}/{name}.parquet") for name in ("counts", "cells", "features"))


def read_matrix(spark: SparkSession, folder: str, kind: str | None = None, genome: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """read_10x_mex or read_counts, by kind or by the end of the path: .mex or .parquet."""
    kind = kind or folder.rstrip("/").rpartition(".")[2]
    readers = {"mex": lambda spark, folder: read_10x_mex(spark, folder, genome), "parquet": read_counts}
    if kind not in readers:
        raise ValueError(f"{folder} is of no known kind: {', '.join(readers)}")
    return readers[kind](spark, folder)


def number_children(links: DataFrame) -> DataFrame:
    """parent, child and child_ord, the place (from 0) of a child among its parent's by name; a parent may have any number."""
    return numbered_within(links.select("parent", "child"), "parent", "child", "child_ord").select("parent", "child", F.col("child_ord").cast("int").alias("child_ord"))


#: Terms and edges of an ontology that is one JSON record, which is one row of one task; a larger one is written as lines.
MOST_RECORD = 200_000


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "error"


def write_ontology_resource(path: str, terms: DataFrame, edges: DataFrame, form: str | None = None, overwrite: bool = False) -> None:
    """The ontology as form says: record, the one JSON record that other tools exchange (ordered names, labels, children and depths), or
    lines, a folder of JSON lines by term and one by parent and child, for any number of them. By default it is a record up to MOST_RECORD terms and edges.

    terms has term_id, idx (its place), label, depth_short and depth_long; edges parent, child and child_ord.
    """
    small = form != "lines" and max(df.limit(MOST_RECORD + 1).count() for df in (terms, edges)) <= MOST_RECORD
    if form == "record" and not small:
        raise ValueError(f"more than {MOST_RECORD} terms or edges are no record; lines hold any number")
    if not small:
        terms.select("term_id", "idx", "label", "depth_short", "depth_long").write.mode(_mode(overwrite)).json(f"{path}/terms")
        edges.select("parent", "child", "child_ord").write.mode(_mode(overwrite)).json(f"{path}/children")
        return
    pairs = lambda key, value: F.map_from_entries(F.collect_list(F.struct(key, value)))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("idx", "term_id"))), lambda x: x["term_id"])
    record = terms.agg(
        ordered.alias("cl_names"), pairs("term_id", "label").alias("cell_ontology_term_id_to_cell_type"),
        pairs("term_id", "depth_short").alias("shortest_path_lengths_from_cell_root"), pairs("term_id", "depth_long").alias("longest_path_lengths_from_cell_root"),
    )
    lists = edges.groupBy("parent").agg(F.transform(F.array_sort(F.collect_list(F.struct("child_ord", "child"))), lambda x: x["child"]).alias("children"))
    record.crossJoin(lists.agg(pairs("parent", "children").alias("children_dictionary"))).write.mode(_mode(overwrite)).json(path)  # a row each


def read_ontology_resource(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """terms (term_id, idx, label, depth_short, depth_long) and edges (parent, child, child_ord) of either form; one without a term is an error."""
    if _below(spark, path).where(F.col("below")[0] == "terms").isEmpty():
        record = cut_lineage(spark.read.schema(ONTOLOGY_RESOURCE).option("multiLine", True).json(path))
        of = lambda c, name: record.select(F.explode(c).alias("term_id", name))
        terms = record.select(F.posexplode("cl_names").alias("idx", "term_id")).select("term_id", F.col("idx").cast("long").alias("idx"))
        for c, name in (("cell_ontology_term_id_to_cell_type", "label"), ("shortest_path_lengths_from_cell_root", "depth_short"), ("longest_path_lengths_from_cell_root", "depth_long")):
            terms = terms.join(of(c, name), "term_id", "left")
        edges = record.select(F.explode("children_dictionary").alias("parent", "children")).select("parent", F.posexplode("children").alias("child_ord", "child")).select("parent", "child", "child_ord")
    else:
        terms = spark.read.schema("term_id string, idx long, label string, depth_short int, depth_long int").json(f"{path}/terms")
        edges = spark.read.schema("parent string, child string, child_ord int").json(f"{path}/children")
    if terms.isEmpty():
        raise ValueError(f"{path} holds no ontology")
    return terms, edges


def write_ontology_response(path: str, response: DataFrame, overwrite: bool = False) -> None:
    response.write.mode(_mode(overwrite)).json(path, ignoreNullFields=False)


def read_ontology_response(spark: SparkSession, path: str) -> DataFrame:
    """The nested response; a record that does not parse, or lacks a required field, is an error."""
    read = spark.read.schema(ONTOLOGY_RESPONSE).option("mode", "FAILFAST").json(path)
    kinds = {f.name: f.dataType for f in read.schema}
    return read.select(*(F.when(F.col(c).isNotNull(), F.col(c)).otherwise(F.raise_error(F.lit(f"missing {c}")).cast(kinds[c])).alias(c) for c in REQUIRED))


def write_inferred_labels(path: str, labels: DataFrame, overwrite: bool = False) -> None:
    labels.write.mode(_mode(overwrite)).option("header", True).csv(path)


def read_inferred_labels(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Labels from CSV, scores as doubles and the rest as text; an absent column is an error that lists those there are."""
    read = spark.read.option("header", True).csv(path)
    absent = [c for c in columns or [] if c not in read.columns]
    if absent:
        raise ValueError(f"no column {', '.join(absent)}; there are {', '.join(read.columns)}")
    chosen = columns or read.columns
    return read.select(*(F.col(c).cast("double") if "_score_" in c else F.col(c) for c in chosen))


def write_run_metadata(path: str, metadata: DataFrame, overwrite: bool = False) -> None:
    metadata.write.mode(_mode(overwrite)).json(path)


def read_run_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_METADATA).json(path)


def run_files(spark: SparkSession, source: str) -> DataFrame:
    """run_id and name of every file or table right below the runs of a folder, or of the folders that a .txt file lists, a line each.

    The id of a run is its folder's name, or, from a list, its path as the line has it.
    """
    if source.endswith(".txt"):
        listed = [r["value"].strip().rstrip("/") for r in spark.read.text(source).collect() if r["value"].strip()]  # a short list, as people write it
        if not listed:
            raise ValueError(f"{source} lists no run")
        found = [_below(spark, path).select(F.lit(path).alias("run_id"), F.col("below")[0].alias("name")) for path in dict.fromkeys(listed)]
        return reduce(DataFrame.unionByName, found).distinct()
    return _below(spark, source).select(F.col("below")[0].alias("run_id"), F.coalesce(F.try_element_at("below", F.lit(2)), F.lit("")).alias("name")).distinct()


def _below(spark: SparkSession, folder: str) -> DataFrame:
    """below: the parts of the path, under folder, of each file."""
    name = folder.rstrip("/").rpartition("/")[2]
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    return listed.select(F.split(F.substring_index("path", f"/{name}/", -1), "/").alias("below"))


def collect_runs(files: DataFrame, required: list[str]) -> DataFrame:
    """run_id of every run, sorted. No run at all, or one that lacks a required file, is an error. Runs two small jobs."""
    runs = files.select("run_id").distinct()
    wanted = runs.crossJoin(F.broadcast(files.sparkSession.createDataFrame([(n,) for n in required], "name string")))  # runs times the few names
    absent = wanted.join(files, ["run_id", "name"], "left_anti").orderBy("run_id", "name").limit(5).collect()
    if absent:
        raise ValueError("missing: " + ", ".join(f"{r['run_id']}/{r['name']}" for r in absent))
    if runs.isEmpty():
        raise ValueError("no run is there")
    return runs.orderBy("run_id")


def write_confusion(path: str, confusion: DataFrame, metadata: DataFrame) -> None:
    """Confusion matrices, partitioned by k and model, and their metadata (label_order, matrix_size and what else is known of a run)."""
    confusion.write.partitionBy("k", "model_name").parquet(f"{path}/matrix")
    metadata.write.json(f"{path}/metadata")


def read_confusion(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Confusion matrices and their metadata. Without either of the two, or with a matrix that has no metadata, it is an error (one small job)."""
    matrix = spark.read.parquet(f"{path}/matrix").withColumn("model_name", F.col("model_name").cast("string"))
    metadata = spark.read.json(f"{path}/metadata")
    keys = [c for c in matrix.columns if c in metadata.columns]
    lone = matrix.select(*keys).distinct().join(metadata.select(*(F.col(c).cast(matrix.schema[c].dataType) for c in keys)), keys, "left_anti").limit(5).collect()
    if lone:
        raise ValueError(f"no metadata of {', '.join(str(tuple(r)) for r in lone)}")
    return matrix, metadata


def watch_confusion(spark: SparkSession, path: str) -> tuple[Guard, DataFrame]:
    """read_confusion with its guard in the same pass: the matrices are the guard's frame, and verify, after an action, gives its error."""
    matrix = spark.read.parquet(f"{path}/matrix").withColumn("model_name", F.col("model_name").cast("string"))
    metadata = spark.read.json(f"{path}/metadata")
    keys = [c for c in matrix.columns if c in metadata.columns]
    runs = metadata.select(*(F.col(c).cast(matrix.schema[c].dataType) for c in keys)).distinct().withColumn("_there", F.lit(True))

    def explain() -> str:
        lone = matrix.select(*keys).distinct().join(runs, keys, "left_anti").limit(5).collect()
        return f"no metadata of {', '.join(str(tuple(r)) for r in lone)}"

    guard = Guard(matrix.join(small_enough(runs), keys, "left"), F.col("_there").isNull(), explain)
    guard.frame = guard.frame.select(*matrix.columns)
    return guard, metadata


def write_metrics(folder: str, tables: dict[str, DataFrame], overwrite: bool = False) -> None:
    """Each table as a CSV folder."""
    for name, df in tables.items():
        df.write.mode(_mode(overwrite)).option("header", True).csv(f"{folder}/{name}.csv")


def read_predictions_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A prediction or crosswalk table with a header; the first column of predictions is the barcode."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)
