"""Folders and files: completeness, what can be cleaned up, and routing of reviewers' questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.operators.gates import first_of

CATEGORIES = ("images", "notes", "json", "pdf", "slices")
IMAGE_TYPES = ("png", "jpg", "jpeg", "gif", "bmp", "webp")


def category(path: Column) -> Column:
    """What a file of an output folder is, as far as cleaning up goes; null keeps it."""
    return (
        F.when(path.rlike(r"(^|/)images_notes/"), "notes")
        .when(path.rlike(r"(^|/)images/"), "images")
        .when(path.endswith(".json"), "json")
        .when(path.rlike(r"(^|/)_slices/"), "slices")
        .when(path.endswith(".pdf"), "pdf")
    )


def inventory(files: DataFrame) -> DataFrame:
    """Files and bytes of (path, bytes) by category, and the bytes as text."""
    sums = files.withColumn("category", category(F.col("path"))).where("category is not null").groupBy("category").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    return sums.withColumn("shown", byte_text(F.col("bytes")))


def byte_text(n: Column) -> Column:
    return F.when(n < 1024 * 1024, F.format_string("%.1f KB", n / 1024.0)).otherwise(F.format_string("%.1f MB", n / (1024.0 * 1024.0)))


def deletions(files: DataFrame, scope: str = "all") -> DataFrame:
    """The manifest of what a clean-up would delete; folders with notes but without their text are left alone."""
    named = files.withColumn("category", category(F.col("path")))
    guard = named.groupBy("out_dir").agg(F.bool_or(F.col("category") == "notes").alias("notes"), F.bool_or((F.col("path") == "full.md") & (F.col("bytes") > 0)).alias("text"))
    safe = guard.where(~F.coalesce("notes", F.lit(False)) | F.coalesce("text", F.lit(False))).select("out_dir")
    chosen = named.where("category is not null") if scope == "all" else named.where(F.col("category").isin("images", "notes"))
    return chosen.join(safe, "out_dir", "left_semi")


def ready_folders(docs: DataFrame, show: int = 5) -> DataFrame:
    """(folder, n_docs, n_missing, first_missing, ready) of documents (folder, name, done); names are cut to the first few before
    they are gathered."""
    few = first_of(docs.where(~F.col("done") & F.col("name").isNotNull()), "folder", show, "name", ties=True)
    named = few.groupBy("folder").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("first_missing")).withColumnRenamed("folder", "__folder")
    counts = docs.groupBy("folder").agg(F.count("*").alias("n_docs"), F.count_if(~F.col("done")).alias("n_missing"), F.bool_and("done").alias("ready"))
    joined = counts.join(named, F.col("folder").eqNullSafe(F.col("__folder")), "left")
    return joined.select("folder", "n_docs", "n_missing", F.coalesce("first_missing", F.lit("")).alias("first_missing"), "ready")


def image_files(paths: DataFrame) -> DataFrame:
    """Files under an images folder, without notes, of a known type."""
    ext = F.regexp_replace(T.extension(F.col("path")), r"^\.", "")
    return paths.where(F.col("path").rlike(r"(^|/)images/") & ~F.contains("path", F.lit("images_notes")) & ext.isin(*IMAGE_TYPES))


def task_of(prompt: Column) -> Column:
    """What a reviewer is asked to do, by the first of these phrases."""
    p = F.lower(F.coalesce(prompt, F.lit("")))
    has = lambda *words: F.greatest(*[F.contains(p, F.lit(w)) for w in (*words, words[0])])
    return (
        F.when(p == "", "default").when(has("layout detection", "box_start"), "layout").when(has("table recognition", "<fcel>"), "table")
        .when(has("formula recognition", "equation"), "equation").when(has("image analysis"), "image").when(has("text recognition", "ocr"), "text").otherwise("default")
    )


def mime(ext: Column) -> Column:
    return F.concat(F.lit("image/"), F.when(F.lower(ext) == "jpg", "jpeg").otherwise(F.lower(ext)))


def deepest(dirs: DataFrame) -> DataFrame:
    """The most deeply nested folder of each output (out_dir, dir)."""
    depth = F.size(F.split("dir", "/"))
    return dirs.groupBy("out_dir").agg(F.max_by("dir", F.struct(depth, "dir")).alias("dir"))


def low_confidence(tables: DataFrame, least: float = 80.0, most: int = 50) -> DataFrame:
    """Tables (doc_id, table_no, accuracy) below ``least``, of the first ``most`` of a document."""
    first = tables.where(F.col("table_no") <= most).where(F.col("accuracy") < least)
    listed = F.array_sort(F.collect_list(F.struct("table_no", "accuracy")))
    return first.groupBy("doc_id").agg(F.count("*").alias("n_low"), F.array_join(F.transform(listed, lambda t: F.format_string("%d(%.1f)", t["table_no"], t["accuracy"])), ",").alias("hint"))


def find_artifact(files: DataFrame, patterns: tuple[str, ...], exclude: str | None = None) -> DataFrame:
    """For each folder the file (out_dir, path) that matches the earliest pattern, the first by name."""
    place = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(patterns))):
        place = F.when(F.col("path").rlike(p), i).otherwise(place)
    ranked = files.withColumn("place", place).where("place is not null")
    if exclude:
        ranked = ranked.where(~F.col("path").rlike(exclude))
    return ranked.groupBy("out_dir").agg(F.min_by("path", F.struct("place", "path")).alias("path"))


CONTENT_LIST = (r"_content_list\.json$", r"\.content_list\.json$", r"^content_list\.json$")
ORIGIN_PDF = (r"_origin\.pdf$", r"^origin\.pdf$")


def origin_pdfs(files: DataFrame) -> DataFrame:
    """(out_dir, content_list, origin): for each content list (out_dir, path) the original PDF of its own batch, told by the name
    without its ending; else the first by name of those in its folder; else null."""
    named = files.where(~F.contains("path", F.lit("/")))
    lists = named.where(F.col("path").rlike(CONTENT_LIST[0])).select("out_dir", F.col("path").alias("content_list"), F.regexp_replace("path", CONTENT_LIST[0], "").alias("batch"))
    pdfs = named.where(F.col("path").rlike(ORIGIN_PDF[0])).select("out_dir", "path", F.regexp_replace("path", ORIGIN_PDF[0], "").alias("batch"))
    own = pdfs.select("out_dir", "batch", F.col("path").alias("own")).distinct()
    any_ = pdfs.groupBy("out_dir").agg(F.min("path").alias("any"))
    return lists.join(own, ["out_dir", "batch"], "left").join(any_, "out_dir", "left").select("out_dir", "content_list", F.coalesce("own", "any").alias("origin"))
