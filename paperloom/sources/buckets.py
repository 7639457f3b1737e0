"""Results of many runs, kept in buckets of their key, so that a new run meets them without moving them.

Each merge writes one generation: a folder of files bucketed and sorted by the text of the key. Merging reads of the earlier
generations only that text, bucket by bucket; the new rows alone are exchanged, and nothing that is there is written again.
Reading takes the rule's generation of each key, also without an exchange. ``compact`` makes one generation of all; call it
every ten or twenty merges, as each merge meets the keys of all generations.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a new store; a store keeps the number it began with.
BUCKETS = 64
TEXT = "__key"
_NAME = re.compile(r"g(\d{6})-b(\d{5})-([cn])$")


def key_text(key: list[str]) -> Column:
    """The key as one text: equal for equal keys only, nulls (left out of the object) like any other value."""
    return F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)]))


def generations(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """(number, buckets, folder) of the finished generations since the last compacted one, in order."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    found = []
    for status in system.listStatus(folder):
        name = _NAME.match(status.getPath().getName())
        if name and system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append((int(name[1]), int(name[2]), name[3], status.getPath().toString()))
    found.sort()
    first = max([i for i, g in enumerate(found) if g[2] == "c"], default=0)
    return [(number, buckets, place) for number, buckets, _, place in found[first:]]


def _table(folder: str) -> str:
    return "generation_" + hashlib.md5(folder.encode(), usedforsecurity=False).hexdigest()


def _generation(spark: SparkSession, folder: str, buckets: int) -> DataFrame:
    """A generation with its buckets; the folder is all that lasts, its table is declared again by each session.

    The columns are those of an empty table beside the generations, since one without rows has no files.
    """
    name = _table(folder)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder.rsplit("/", 1)[0] + "/columns").schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({TEXT}) SORTED BY ({TEXT}) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return spark.table(name)


def _write(rows: DataFrame, path: str, number: int, buckets: int, kind: str) -> str:
    """A generation of ``rows``, which lie by bucket; what a broken run of the same number left is replaced."""
    folder = f"{path}/g{number:06d}-b{buckets:05d}-{kind}"
    if number == 1:
        rows.sparkSession.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{path}/columns")
    rows.sparkSession.sql(f"DROP TABLE IF EXISTS {_table(folder)}")
    rows.write.mode("overwrite").option("path", folder).bucketBy(buckets, TEXT).sortBy(TEXT).saveAsTable(_table(folder))
    return folder


def unknown(rows: DataFrame, path: str, key: list[str], order: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Of ``rows`` the first by ``order`` of each key that the store does not have, with the text of the key."""
    spark = rows.sparkSession
    known = generations(spark, path)
    buckets = known[0][1] if known else buckets
    fresh = _first(rows, key, order, buckets)
    for _, n, folder in known:
        fresh = fresh.join(_generation(spark, folder, n).select(TEXT), TEXT, "left_anti")
    return fresh


def _first(rows: DataFrame, key: list[str], order: list[str], buckets: int) -> DataFrame:
    dealt = rows.withColumn(TEXT, key_text(key)).repartition(buckets, TEXT)
    return dealt.groupBy(TEXT).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("__row")).select(TEXT, "__row.*")


def merge(rows: DataFrame, path: str, key: list[str], order: list[str], latest: bool = False, buckets: int = BUCKETS) -> str:
    """Add ``rows`` as a generation and return its folder.

    Of equal keys within ``rows`` the first by ``order`` counts. A key that the store has stays as it is; with ``latest`` the new
    row takes its place, which ``read`` must be told too. Keys may hold nulls. One merge runs at a time; one that broke off is not seen.
    """
    known = generations(rows.sparkSession, path)
    number = known[-1][0] + 1 if known else 1
    if known:
        buckets = known[0][1]
        rows = rows.select(*[c for c in _generation(rows.sparkSession, known[0][2], buckets).columns if c != TEXT])
    fresh = _first(rows, key, order, buckets) if latest else unknown(rows, path, key, order, buckets)
    return _write(fresh, path, number, buckets, "n")


def read(spark: SparkSession, path: str, latest: bool = False) -> DataFrame:
    """The rows of the store. Without ``latest`` generations share no key and nothing is compared."""
    return _read(spark, path, latest).drop(TEXT)


def _read(spark: SparkSession, path: str, latest: bool) -> DataFrame:
    known = generations(spark, path)
    if not known:
        raise ValueError(f"no results at {path}")
    parts = [_generation(spark, folder, n) for _, n, folder in known]
    rows = parts[-1]
    for i in range(len(parts) - 2, -1, -1):
        left = parts[i]
        # What a newer generation has is left out of the older one, bucket by bucket.
        for newer in parts[i + 1 :] if latest else []:
            left = left.join(newer.select(TEXT), TEXT, "left_anti")
        rows = rows.unionByName(left)
    return rows


def compact(spark: SparkSession, path: str, latest: bool = False) -> str:
    """All generations as one, after which the earlier ones are no longer read; they are left for who still reads them."""
    known = generations(spark, path)
    number, buckets = known[-1][0] + 1, known[0][1]
    return _write(_read(spark, path, latest).repartition(buckets, TEXT), path, number, buckets, "c")
