"""Blocks (page ranges of files): scans, identity, kinds, output folders, status and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.functions import text as T
from paperloom.operators.packing import DAY_BUDGET, day_plan, page_budget  # noqa: F401
from paperloom.sources.tables import stored

KEY = ("file", "start", "end")
DOCUMENT_KINDS = {".pdf": "PDF", ".doc": "DOC", ".docx": "DOC", ".ppt": "PPT", ".pptx": "PPT", ".html": "HTML", ".htm": "HTML"}
MAX_PAGES, COMPLEX, BATCH = 200, 3, 50


def first_wins(rows: DataFrame, key: tuple[str, ...], *order: Column | str) -> DataFrame:
    """Of rows with equal ``key`` the first by ``order``: an aggregate with partial results, not a window."""
    place = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*place)).alias("__row"))
    return best.select(*key, *[F.col(f"__row.{c}").alias(c) for c in rest])


def load(complex_blocks: DataFrame, normal_blocks: DataFrame, scope: str = "all", some: bool = False) -> DataFrame:
    """Blocks of a plan by scope; complex ones come first and win over equal normal ones. Rows carry ``pos``.

    ``some``: a plan without any block of the scope is an error; this looks at one row.
    """
    parts = {"complex": [(0, complex_blocks)], "normal": [(1, normal_blocks)], "all": [(0, complex_blocks), (1, normal_blocks)]}[scope]
    ranked = [df.withColumn("list_rank", F.lit(rank)) for rank, df in parts]
    every = ranked[0] if len(ranked) == 1 else ranked[0].unionByName(ranked[1])
    if some and every.isEmpty():
        raise ValueError(f"no blocks of scope {scope}")
    return first_wins(every, KEY, "list_rank", "pos")


def kind(path: Column) -> Column:
    known = F.lit(None).cast("string")
    for ext, name in DOCUMENT_KINDS.items():
        known = F.when(T.extension(path) == ext, name).otherwise(known)
    return known


def parser_version(path: Column) -> Column:
    return F.when(T.extension(path).isin(".html", ".htm"), "MinerU-HTML").otherwise("vlm")


def with_block_count(blocks: DataFrame) -> DataFrame:
    """Adds the number of blocks of each file; a file with very many blocks is counted before the shuffle."""
    counts = blocks.where("file is not null").groupBy("file").agg(F.count("*").alias("n_blocks"))
    return blocks.join(counts, "file", "left")


def out_dir(file: Column, start: Column, end: Column, n_blocks: Column, root: Column, relative: Column) -> Column:
    """Beside the source or under a mirror root; a folder for each block of a file with several."""
    parent = F.when(F.coalesce(root, F.lit("")) == "", F.regexp_replace(file, r"/?[^/]*$", "")).otherwise(F.concat_ws("/", root, F.when(F.coalesce(relative, F.lit("")) != "", relative)))
    book = F.concat(T.safe_name(T.stem(file)), F.lit("_mineru"))
    part = F.when(n_blocks > 1, F.format_string("p%d-%d", start, end))
    return F.concat_ws("/", F.when(parent != "", parent), book, part)


def output_done(artifacts: DataFrame) -> DataFrame:
    """(out_dir, done): a folder is done if it has a full.md or any JSON directly inside."""
    direct = ~F.contains("rel_path", F.lit("/"))
    return artifacts.groupBy("out_dir").agg(F.bool_or(direct & ((F.col("rel_path") == "full.md") | F.col("rel_path").endswith(".json"))).alias("done"))


def status_counts(blocks: DataFrame, done: DataFrame) -> DataFrame:
    """Blocks by done, missing and invalid (without file, start or end); the computed folder comes before the stored one."""
    flags = done.where("done").select(F.col("out_dir").alias("__dir"), F.lit(True).alias("found"))
    own = blocks.join(flags, F.col("out_dir") == F.col("__dir"), "left").drop("__dir").withColumnRenamed("found", "own")
    both = own.join(flags, F.col("stored_dir") == F.col("__dir"), "left").drop("__dir")
    invalid = F.col("file").isNull() | F.col("start").isNull() | F.col("end").isNull()
    status = F.when(invalid, "invalid").when(F.coalesce("own", "found", F.lit(False)), "done").otherwise("missing")
    return both.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def route(blocks: DataFrame) -> DataFrame:
    """Where a block goes: too many pages for the service, complex ones to it, others stay local."""
    return blocks.withColumn("route", F.when(F.col("pages") > MAX_PAGES, "too_long").when(F.coalesce("complex", F.lit(0)) >= COMPLEX, "cloud").otherwise("local"))


def only(blocks: DataFrame, keyword: str) -> DataFrame:
    return blocks.where(F.contains(F.lower(T.basename(F.col("file"))), F.lit(keyword.lower())))


def numbered(rows: DataFrame, prefix: str, *order: str) -> DataFrame:
    """Adds place and data_id ('<prefix><place>') in one order over all rows, as single jobs without days are named ('cx', 'html').

    Ranges of the order are counted in their tasks and start where the ones before them end: one small row a range meets in a task.
    Rows that ``order`` does not tell apart are numbered in any order.
    """
    ranged = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__no", F.monotonically_increasing_id()))
    ranged = ranged.withColumns({"__range": F.shiftright("__no", 33).cast("int"), "__no": F.col("__no").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("n"))
    starts = sizes.select("__range", (F.sum("n").over(Window.orderBy("__range")) - F.col("n")).alias("__start"))
    made = ranged.join(F.broadcast(starts), "__range").withColumn("place", F.col("__start") + F.col("__no"))
    return made.drop("__range", "__start", "__no").withColumn("data_id", F.concat(F.lit(prefix), F.col("place").cast("string")))


def batches(blocks: DataFrame, group: str, *order: str, size: int = BATCH) -> DataFrame:
    """Adds place, batch and data_id ('d<group>b<place>') in the order of a group."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1
    made = blocks.withColumn("place", place)
    return made.withColumns({"batch": F.floor(F.col("place") / size).cast("long"), "data_id": F.concat(F.lit("d"), F.col(group).cast("string"), F.lit("b"), F.col("place").cast("string"))})


def zipped(left: DataFrame, right: DataFrame, group: str, order_left: list[str], order_right: list[str]) -> DataFrame:
    """Rows of both lists of a group, paired by their place; what is left over of the longer one goes.

    Tasks and the addresses a service answers with agree by place alone. The column ``place`` counts from 0.
    """
    place = lambda order: (F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1).cast("long")
    first, second = left.withColumn("place", place(order_left)), right.withColumn("place", place(order_right))
    return first.join(second, [group, "place"])


def slice_name(index: Column, name: Column, start: Column, end: Column) -> Column:
    return F.format_string("d%03d_%s_p%d-%d.pdf", index, name, start, end)


def member_is_safe(path: Column) -> Column:
    """An archive member that stays inside: not absolute, without drive and without a part '..'."""
    return ~(path.startswith("/") | path.startswith("\\") | path.rlike(r"^[A-Za-z]:") | F.array_contains(F.split(path, r"[/\\]"), ".."))
