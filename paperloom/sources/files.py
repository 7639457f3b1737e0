"""Reading plans, parser output, texts and listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = "file string, kind string, start int, end int, pages int, src_rel_dir string, out_dir string, size_mb double, complex int, reason string"
PLAN = f"pending_normal array<struct<{BLOCK.replace(' ', ':').replace(',:', ',')}>>, pending_complex array<struct<{BLOCK.replace(' ', ':').replace(',:', ',')}>>"
ELEMENT = "type string, text string, bbox array<double>, page_idx int"
DOCUMENT_NAMES = r"(?i)\.(pdf|docx?|pptx?)$"
HTML_NAMES = r"(?i)\.html?$"


def plan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Complex and normal blocks of a plan file with their place; broken rows are nulls, a missing list is empty."""
    read = spark.read.schema(PLAN).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    one = lambda c: read.select(F.posexplode(c).alias("pos", "b")).select("pos", "b.*")
    return one("pending_complex"), one("pending_normal")


def elements(spark: SparkSession, path: str) -> DataFrame:
    """Elements of parser output files (JSON arrays), with their file."""
    return spark.read.schema(ELEMENT).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*content_list.json").json(path).withColumn("path", F.input_file_name())


def texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "full.md").text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` with size and time; their content is never read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def documents_in(files: DataFrame, names: str = DOCUMENT_NAMES) -> DataFrame:
    """Source documents of a listing: known types outside output folders, each once, in path order."""
    return files.where(F.col("path").rlike(names) & ~F.col("path").rlike(r"_mineru(/|$)")).select("path", "bytes").distinct().orderBy("path")


QUEUE = "count long, queue array<struct<file:string,start:int,end:int,verdict:string,problems:array<string>>>"
RESULTS = "count long, results array<struct<block:struct<basename:string,file:string,start:int,end:int,out_dir:string,priority:string>,verdict:string,pages_reviewed:int,reasons:array<array<string>>>>"
PROGRESS = "converted long, last_block_idx long, issues array<string>"


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` of a table, dealt out to all cores if it lies in fewer files and pieces than there are cores.

    A row group is read by one task, so all that follows on a table of one row group would run in one. A table of many pieces is
    left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if len(rows.inputFiles()) < cores and rows.rdd.getNumPartitions() <= cores:
        return rows.repartition(cores)
    return rows


def queue(texts_: DataFrame) -> DataFrame:
    """Rows of review queues from their files' whole texts (value), with their place; broken files and rows give none."""
    parsed = texts_.select(F.from_json("value", QUEUE).alias("f"))
    return parsed.select(F.posexplode("f.queue").alias("pos", "q")).where("q is not null").select("pos", "q.*")


def results(texts_: DataFrame) -> DataFrame:
    """Results of the third level from their files' whole texts (value)."""
    parsed = texts_.select(F.from_json("value", RESULTS).alias("f"))
    return parsed.select(F.posexplode("f.results").alias("pos", "r")).where("r is not null").select("pos", "r.block.*", "r.verdict", "r.pages_reviewed", "r.reasons")


def progress(text: Column) -> Column:
    """Progress of a run from its file's text; the start of a run where it is missing, broken or no object."""
    read = F.from_json(text, PROGRESS)
    zero = F.lit(0).cast("long")
    return F.struct(F.coalesce(read["converted"], zero).alias("converted"), F.coalesce(read["last_block_idx"], zero).alias("last_block_idx"), F.coalesce(read["issues"], F.array().cast("array<string>")).alias("issues"))
