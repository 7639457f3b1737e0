"""Where operators cut their lineage: a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only for a local master without the setting."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="paperloom-")
    spark.sparkContext.setCheckpointDir(path)
    return shared_dir(spark)


#: With this setting Spark deletes a query's shuffle files when the query ends; what it wrote is in the shared folder by then.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later reads neither recompute it nor depend on an executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
        jvm = spark.sparkContext._jvm
        for folder in folders:
            if "/table-" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of two or three numbers up to which a side is broadcast (about 16 bytes each, so 8 MB); beyond it, joins shuffle.
BROADCAST_ROWS = 500_000


def small_or_shuffled(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` allow it; the planner shuffles it otherwise."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("merge")


#: Names of two hashes of a text, which with the doc_id tell rows apart where ids are null or repeat.
TEXT_KEYS = ("__t1", "__t2")


def with_text_keys(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"__t1": F.xxhash64("text"), "__t2": F.hash("text")})


def without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id (null: like any other) and text are not those of one of ``rows`` (doc_id, text keys)."""
    gone = stored(rows.select(F.col("doc_id").alias("__doc_id"), *[F.col(c).alias(f"_{c}") for c in TEXT_KEYS]).distinct())
    same = [F.col("doc_id").eqNullSafe(F.col("__doc_id")), *[F.col(c) == F.col(f"_{c}") for c in TEXT_KEYS]]
    return with_text_keys(docs).join(small_or_shuffled(gone, gone.count()), same, "left_anti").drop(*TEXT_KEYS)
