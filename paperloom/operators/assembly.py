"""Putting texts together: merging slices, embedding image notes, reading order, notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.functions import text as T
from paperloom.operators.packing import chunks

HEADING = "插图笔记"


def merge_slices(slices: DataFrame) -> DataFrame:
    """(book, text, n_merged) of slices (book, dir, start, text): page-range folders with a text, in page order."""
    valid = slices.where(F.col("dir").rlike(r"^p\d+-\d+$") & F.col("text").isNotNull())
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "dir", "text"))), lambda x: x["text"]), "\n\n")
    return valid.groupBy("book").agg(joined.alias("text"), F.count("*").alias("n_merged"))


def merge_offsets(slices: DataFrame) -> DataFrame:
    """(book, start, dir, text, at): where in its book's merged text each slice of ``slices`` begins, in code points.

    Prefix sums in two steps: within ranges of the order, then over the ranges' totals, so a book of any size is spread over
    ranges and no row or task holds it.
    """
    valid = slices.where(F.col("dir").rlike(r"^p\d+-\d+$") & F.col("text").isNotNull()).select("book", "start", "dir", "text")
    cut = chunks(valid, "book", ["start", "dir", "text"]).withColumn("__size", F.length("text") + 2)
    order = [F.col(c).asc_nulls_last() for c in ("start", "dir", "text")]
    inside = Window.partitionBy("book", "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("__inside", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
    totals = cut.groupBy("book", "__chunk").agg(F.sum("__size").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("book").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = totals.select(F.col("book").alias("__book"), F.col("__chunk").alias("__c"), before.alias("__before"))
    met = placed.join(shifts, F.col("book").eqNullSafe(F.col("__book")) & (F.col("__chunk") == F.col("__c")))
    return met.select("book", "start", "dir", "text", (F.col("__inside") + F.col("__before")).cast("long").alias("at"))


def write_merged(slices: DataFrame, path: str) -> None:
    """The merged texts below ``path``/book=...: the files of a book, in order of their names, hold its text piece by piece."""
    rows = merge_offsets(slices).select("book", "at", F.concat(F.when(F.col("at") > 0, "\n\n").otherwise(""), "text").alias("value"))
    ranged = rows.repartitionByRange("book", "at").sortWithinPartitions("book", "at")
    ranged.select("book", "value").write.partitionBy("book").option("lineSep", "\0").text(path)


def note_block(body: Column) -> Column:
    """A note as it is embedded: without its title line."""
    rest = T.strip(F.regexp_replace(body, r"\A# [^\n]*\n?", ""))
    return F.concat(F.lit(f"\n\n## {HEADING}\n\n"), rest, F.lit("\n"))


def nearest_notes(refs: DataFrame, notes: DataFrame, up: int = 5) -> DataFrame:
    """For each reference (dir, stem) the note (dir, stem, body) of its folder, of the nearest of ``up`` folders above, or
    of any folder below: joined on the candidate folders, not by prefix."""
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.least(F.lit(up), F.size(parts) - 1)), lambda i: F.struct(i.alias("distance"), F.array_join(F.slice(parts, 1, F.size(parts) - i), "/").alias("at")))
    asked = refs.select("dir", "stem").distinct().withColumn("c", F.explode(above)).select("dir", "stem", "c.*")
    held = notes.select(F.col("dir").alias("note_dir"), F.col("stem").alias("note_stem"), "body")
    direct = asked.join(held, (F.col("at") == F.col("note_dir")) & (F.col("stem") == F.col("note_stem"))).select("dir", "stem", "distance", "note_dir", "body")
    folders = F.split("note_dir", "/")
    over = F.transform(F.sequence(F.lit(1), F.size(folders)), lambda i: F.array_join(F.slice(folders, 1, i), "/"))
    below = held.withColumn("top", F.explode(over)).where("top != note_dir")
    deep = refs.select("dir", "stem").distinct().join(below, (F.col("dir") == F.col("top")) & (F.col("stem") == F.col("note_stem"))).select("dir", "stem", F.lit(up + 1).alias("distance"), "note_dir", "body")
    best = F.min(F.struct("distance", "note_dir", "body"))
    return direct.unionByName(deep).groupBy("dir", "stem").agg(best.alias("n")).select("dir", "stem", "n.*")


#: A document is told by its id, folder and two hashes of its text, so rows that repeat an id keep apart.
_DOC = ("doc_id", "dir", "__h1", "__h2")


def embed(docs: DataFrame, notes: DataFrame) -> DataFrame:
    """Documents (doc_id, dir, text) with the notes (dir, stem, body) of their image references put in their place, and counts.

    Each reference gets the one note of ``nearest_notes``: its folder's, the nearest above, or one below; without it the reference
    stays. Without a column ``dir`` all lie in one folder. Texts are exchanged once, references meet notes by folder and stem.
    """
    in_folder = lambda df: df if "dir" in df.columns else df.withColumn("dir", F.lit(""))
    docs, notes = in_folder(docs), in_folder(notes)
    text = F.coalesce("text", F.lit(""))
    whole = r"!\[[^\]]*\]\(images/[^)\s]+\)"
    keyed = docs.select("doc_id", "dir", F.xxhash64("text").alias("__h1"), F.hash("text").alias("__h2"), text.alias("text"))
    refs = keyed.select(*_DOC, F.posexplode(F.regexp_extract_all("text", F.lit(f"({whole})"), 1)).alias("pos", "ref"))
    refs = refs.withColumn("stem", T.stem(F.regexp_extract("ref", T.EMBED_REF, 1)))
    near = nearest_notes(refs, notes).select("dir", "stem", note_block(F.col("body")).alias("note"))
    put = refs.join(near, ["dir", "stem"], "left").groupBy(*_DOC).agg(F.array_sort(F.collect_set(F.struct("pos", F.coalesce("note", "ref").alias("shown"), F.col("note").isNotNull().alias("found")))).alias("shown"))
    put = put.select(*[F.col(c).alias(f"__of_{c}") for c in _DOC], "shown")
    joined = keyed.join(put, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in _DOC], "left").select("doc_id", "text", F.coalesce("shown", F.array().cast(put.schema["shown"].dataType)).alias("shown"))
    woven = F.array_join(F.zip_with(F.split("text", whole), "shown", lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b["shown"], F.lit("")))), "")
    found = F.size(F.filter("shown", lambda x: x["found"])).cast("long")
    return joined.select("doc_id", woven.alias("text"), found.alias("embedded"), (F.size("shown") - found).cast("long").alias("missing"))


def reading_order(boxes: DataFrame) -> DataFrame:
    """The text of each image's boxes (image, x, y, text), from top to bottom and left to right."""
    order = F.array_sort(F.collect_list(F.struct("y", "x", "text")))
    return boxes.groupBy("image").agg(F.array_join(F.transform(order, lambda b: b["text"]), "\n").alias("text"))


def enrich_status(has_note: Column, ocr: Column, vision: Column) -> Column:
    return F.when(has_note, "skipped").when((F.coalesce(ocr, F.lit("")) == "") & (F.coalesce(vision, F.lit("")) == ""), "empty").otherwise("done")


def note_body(stem: Column, ocr: Column, vision: Column) -> Column:
    return F.concat(F.lit("# "), stem, F.lit("\n\n## OCR\n\n"), F.coalesce(ocr, F.lit("")), F.when(F.coalesce(vision, F.lit("")) != "", F.concat(F.lit("\n\n## Vision\n\n"), vision)).otherwise(""), F.lit("\n"))
