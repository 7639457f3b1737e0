"""Cutting long documents at chapters, and picking pages for review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PAGES, LARGE_MB, LARGE_PAGES = 200, 200, 190
HEADING_MIN_SPANS, HEADING_SIZE, HEADING_RATIO = 3, 20, 1.5
SAMPLE, NO_TEXT_SHARE, IMAGES_PER_PAGE, FORMULA_PAGES = 40, 0.4, 3, 2


def hard_cuts(total: Column, most: int) -> Column:
    """Ranges of ``most`` pages."""
    return F.transform(F.sequence(F.lit(1), total, F.lit(most)), lambda a: F.struct(a.alias("start"), F.least(a + most - 1, total).alias("end")))


def chapter_cuts(total: Column, candidates: Column, most: int) -> Column:
    """Ranges of at most ``most`` pages that begin at the farthest candidate in reach; without one in reach a cut comes one
    page before the reach ends; null if no candidate lies inside the document."""
    if most < 2:
        raise ValueError("a range needs two pages at least")
    valid = F.array_sort(F.array_distinct(F.filter(candidates, lambda c: (c > 1) & (c <= total))))
    # From ``at`` on, ``best`` is the farthest candidate in reach so far; a candidate beyond the reach cuts there, and then hard
    # until it is in reach itself. So each candidate is looked at once and only cuts are visited, however many pages there are.
    ints = "array<int>"
    start = F.struct(F.lit(1).alias("at"), F.lit(None).cast("int").alias("best"), F.array(F.lit(1)).cast(ints).alias("cuts"))

    def hard(at: Column, to: Column) -> Column:
        """How many cuts of the full reach come before ``to`` is in reach of one."""
        return F.greatest(F.ceil((to - at - (most - 1)) / (most - 1)), F.lit(0)).cast("int")

    def moved(a: Column, to: Column, kept: Column) -> Column:
        at = F.coalesce(a["best"], a["at"])
        n = hard(at, to)
        chapter = F.when(a["best"].isNotNull(), F.array(a["best"])).otherwise(F.array().cast(ints))
        steps = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda k: (at + k * (most - 1)).cast("int"))).otherwise(F.array().cast(ints))
        return F.struct((at + n * (most - 1)).cast("int").alias("at"), kept.cast("int").alias("best"), F.concat(a["cuts"], chapter, steps).alias("cuts"))

    def put(a: Column, c: Column) -> Column:
        near = F.struct(a["at"].alias("at"), c.cast("int").alias("best"), a["cuts"].alias("cuts"))
        return F.when(c <= a["at"] + most - 1, near).otherwise(moved(a, c, c))

    def ranges(a: Column) -> Column:
        cuts = F.when(a["at"] + most - 1 < total, moved(a, total, F.lit(None))["cuts"]).otherwise(a["cuts"])
        end = lambda i: F.coalesce(F.get(cuts, i + 1) - 1, total).cast("int")
        return F.transform(cuts, lambda s, i: F.struct(s.alias("start"), end(i).alias("end")))

    return F.when(F.size(valid) > 0, F.aggregate(valid, start, put, ranges))


def routed_cuts(total: Column, toc1: Column, toc2: Column, headings: Column, most: int = MAX_PAGES) -> Column:
    """One range for a short document; else by chapters (two at least, or with the second level), by headings, or hard."""
    toc = F.when(F.size(F.array_distinct(toc1)) >= 2, toc1).otherwise(F.concat(toc1, toc2))
    whole = F.array(F.struct(F.lit(1).alias("start"), total.cast("int").alias("end")))
    return F.when(total <= most, whole).otherwise(F.coalesce(chapter_cuts(total, toc, most), chapter_cuts(total, headings, most), hard_cuts(total, most)))


def large_cuts(total: Column, size_mb: Column) -> Column:
    """Ranges for a file that is too large to send whole; null for others."""
    return F.when(size_mb > LARGE_MB, hard_cuts(total, LARGE_PAGES))


def heading_pages(spans: DataFrame) -> DataFrame:
    """Pages of (file, page, size) with a span far above their upper median size."""
    sizes = spans.groupBy("file", "page").agg(F.array_sort(F.collect_list("size")).alias("sizes"))
    median = F.element_at("sizes", (F.floor(F.size("sizes") / 2) + 1).cast("int"))
    most = F.array_max("sizes")
    return sizes.select("file", "page", median.alias("median"), most.alias("largest"), ((F.size("sizes") >= HEADING_MIN_SPANS) & (most > HEADING_SIZE) & (most > HEADING_RATIO * median)).alias("heading"))


def complexity(pages: DataFrame) -> DataFrame:
    """Reasons why a file needs the strong parser, on every k-th page of (file, total, page, has_text, n_images, formula)."""
    stride = F.greatest(F.lit(1), F.floor(F.col("total") / SAMPLE))
    seen = pages.where(F.col("page") % stride == 0).groupBy("file").agg(
        F.max("total").alias("total"), F.count_if(~F.col("has_text")).alias("no_text"), F.sum("n_images").alias("n_images"), F.count_if("formula").alias("formula_pages")
    )
    n = F.floor((F.col("total") - 1) / F.greatest(F.lit(1), F.floor(F.col("total") / SAMPLE))) + 1
    reasons = F.concat_ws(";", F.when(F.col("no_text") > NO_TEXT_SHARE * n, "no_text"), F.when(F.col("n_images") / n > IMAGES_PER_PAGE, "images"), F.when(F.col("formula_pages") >= FORMULA_PAGES, "formulas"))
    return seen.select("file", n.cast("long").alias("n_sampled"), "no_text", "n_images", "formula_pages", reasons.alias("reasons"))


def pick(pages: Column, n: int) -> Column:
    """First, last and evenly spread pages between, rounding halves to even; all if there are no more than ``n``."""
    if n <= 1:
        return F.slice(pages, 1, 1)
    last = F.size(pages) - 1
    spread = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get(pages, F.bround(last * i / (n - 1), 0).cast("int"))))
    return F.when(F.size(pages) <= n, pages).otherwise(spread)
