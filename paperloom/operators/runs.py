"""The composed runs: planning a collection, converting by plan, and the second and third level of review.

What an engine answers comes in as rows (one for each call); the runs decide what is asked, skipped, retried and counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.functions import text as T

from . import blocks as B
from . import review, slicing

CHECK_EVERY, RETRIES = 10, 3
REGION_ZOOM, PAGE_ZOOM = 3.0, 1.5
BLOCK = ("basename", "start", "end")

# Texts of a run's own findings.
ENGINE_FAILED, REVIEW_FAILED = "table_recheck 异常: ", "视觉重试{}轮仍失败: "


def not_negative(name: str, value: float | None) -> float | None:
    """``value`` if it is no negative number; None stands for the default."""
    if value is not None and value < 0:
        raise ValueError(f"{name} must not be negative: {value}")
    return value


def required(rows: DataFrame, message: str) -> DataFrame:
    """``rows``, or an error if there are none; looks at one row."""
    if rows.isEmpty():
        raise ValueError(message)
    return rows


def relative_dir(path: Column, root: Column) -> Column:
    """Folder of ``path`` below ``root``; empty for a file of the root itself or of another root."""
    folder = F.regexp_replace(path, r"/?[^/]*$", "")
    inside = F.startswith(folder, F.concat(root, F.lit("/")))
    return F.when(inside, F.substr(folder, F.length(root) + 2)).otherwise("")


def numbered(rows: DataFrame, group: str, *order: str, name: str = "number") -> DataFrame:
    """Adds the place of each row in the order of ``group``, then ``order``, from 1.

    Groups are numbered apart and shifted by the rows before them, so that only the groups' counts meet in one place.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select(F.col(group).alias("__group"), before.alias("__before"))
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("__place", place).join(shifts, F.col(group).eqNullSafe(F.col("__group"))).withColumn(name, (F.col("__place") + F.col("__before")).cast("long")).drop("__place", "__group", "__before")


# ---- planning


def plan_blocks(docs: DataFrame, most: int = slicing.MAX_PAGES) -> DataFrame:
    """Blocks of documents (path, root, total, toc1, toc2, headings): office files whole, PDFs cut where they are too long.

    PDFs that cannot be read (no number of pages, or none) are left out.
    """
    pdf = T.extension(F.col("path")) == ".pdf"
    total = F.when(pdf, F.col("total")).otherwise(1).cast("int")
    readable = docs.withColumn("total", total).where(F.col("total") > 0)
    cuts = slicing.routed_cuts(F.col("total"), F.col("toc1"), F.col("toc2"), F.col("headings"), most)
    made = readable.select("*", F.inline(cuts))
    rest = [c for c in docs.columns if c not in ("path", "root", "total", "toc1", "toc2", "headings")]
    return made.select(*rest, F.col("path").alias("file"), B.kind(F.col("path")).alias("kind"), "start", "end", (F.col("end") - F.col("start") + 1).alias("pages"), relative_dir(F.col("path"), F.col("root")).alias("src_rel_dir"))


def plan_days(blocks: DataFrame, queue: str, budget: int = B.DAY_BUDGET) -> DataFrame:
    """The plan: blocks in the order of files and pages, filled into days of ``budget`` pages, for each queue."""
    not_negative("budget", budget)
    return B.day_plan(blocks, queue, "file", "start", budget=budget)


# ---- converting


def convert_steps(blocks: DataFrame, sources: DataFrame, done: DataFrame, found: DataFrame, outcomes: DataFrame, most: int = 0, check_every: int = CHECK_EVERY) -> DataFrame:
    """What a run does with each block of a plan (file, start, end, day, out_dir, complex), and the number of its conversion.

    The first that holds: no_source (``sources``: file), done (``done``: out_dir, done), complex by the plan or as ``found``
    (file, reasons), failed or issues by ``outcomes`` (file, start, end, ok, message), else ok. ``issues`` and ``ok`` are
    conversions and are numbered in the plan's order; after each ``check_every`` of them the run stops for a check. With
    ``most`` the run ends with that conversion: later blocks are not_reached.
    """
    not_negative("most", most)
    have = sources.select("file").distinct().withColumn("has_source", F.lit(True))
    finished = done.where("done").select("out_dir").distinct().withColumn("is_done", F.lit(True))
    reasons = found.where("reasons <> ''").groupBy("file").agg(F.min("reasons").alias("reasons"))
    results = B.first_wins(outcomes, B.KEY, "ok", "message")
    joined = blocks.join(have, "file", "left").join(finished, "out_dir", "left").join(reasons, "file", "left").join(results, list(B.KEY), "left")
    status = (
        F.when(F.col("has_source").isNull(), "no_source").when(F.col("is_done"), "done").when(F.coalesce("complex", F.lit(0)) >= B.COMPLEX, "complex")
        .when(F.col("reasons").isNotNull(), "complex_found").when(~F.coalesce("ok", F.lit(False)), "failed").when(F.coalesce("message", F.lit("")) != "", "issues").otherwise("ok")
    )
    converted = F.col("status").isin("ok", "issues")
    stepped = numbered(joined.withColumn("status", status), "day", "file", "start", "end", name="step")
    order = Window.partitionBy("day").orderBy("file", "start", "end")
    counts = stepped.groupBy("day").agg(F.count_if(converted).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = counts.select(F.col("day").alias("__day"), before.alias("__before"))
    running = F.count_if(converted).over(order) + F.col("__before")
    counted = stepped.join(shifts, F.col("day").eqNullSafe(F.col("__day"))).withColumn("number", running.cast("long"))
    if most:
        ended = (F.col("number") > most) | ((F.col("number") == most) & ~converted)
        counted = counted.withColumns({"status": F.when(ended, "not_reached").otherwise(F.col("status")), "number": F.least("number", F.lit(most))})
    reached = F.col("status").isin("ok", "issues")
    return counted.select(*B.KEY, "day", "step", "status", "number", F.coalesce("message", F.lit("")).alias("message"), (reached & (F.col("number") % check_every == 0)).alias("check"))


def progress(steps: DataFrame, pause: bool = False) -> DataFrame:
    """One row: conversions, the last step reached, issues, and the first place where the run pauses for a check."""
    reached = F.col("status") != "not_reached"
    issue = F.col("status").isin("failed", "issues")
    first = F.min(F.when(F.col("check"), F.struct("number", F.format_string("Day%s-%s", F.col("day"), F.col("step")).alias("at"))))
    found = steps.agg(F.count_if(F.col("status").isin("ok", "issues")).alias("converted"), F.max(F.when(reached, F.col("step"))).alias("last_step"), F.count_if(issue).alias("issues"), first.alias("first"))
    at = F.col("first.at") if pause else F.lit(None).cast("string")
    return found.select("converted", F.coalesce("last_step", F.lit(0)).cast("long").alias("last_step"), "issues", at.alias("checkpoint_at"))


def complex_entries(blocks: DataFrame, log: DataFrame) -> DataFrame:
    """Lines for the list of complex blocks (file, start, end, pages, reason) that ``log`` (basename, start) does not hold.

    A block is known by its file's name and first page, and not by their occurrence somewhere in the list's text.
    """
    named = blocks.withColumn("basename", T.basename(F.col("file")))
    new = named.join(log.select("basename", "start").distinct(), ["basename", "start"], "left_anti")
    line = F.format_string("- 🔴 %s → 页 %d-%d（%d页）— %s", "basename", "start", "end", "pages", F.coalesce("reason", F.lit("复杂")))
    return B.first_wins(new.select("basename", "start", line.alias("line")), ("basename", "start"), "line")


# ---- review


def head(rows: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The first ``n`` in ``order``; all for None or 0. A bounded top-k."""
    not_negative("n", n)
    return rows.orderBy(*order).limit(n) if n else rows


def table_issues(tables: DataFrame, texts: DataFrame, least: float = 80.0) -> DataFrame:
    """Issues of targets' tables: ``tables`` (doc_id, n_found, n_low, error), ``texts`` (doc_id, n_tables).

    No table found though the text has some is an issue; so are tables of low confidence, and what the engine raised.
    """
    joined = tables.join(texts, "doc_id", "left")
    lost = (F.col("n_found") == 0) & (F.coalesce("n_tables", F.lit(0)) > 0)
    issues = F.array_compact(F.array(
        F.when(F.col("error").isNotNull(), F.concat(F.lit(ENGINE_FAILED), "error")),
        F.when(F.col("error").isNull() & lost, F.format_string("tables not found: %d", F.col("n_tables"))),
        F.when(F.col("error").isNull() & (F.col("n_low") > 0), F.format_string("tables below %d: %d", F.lit(int(least)), F.col("n_low"))),
    ))
    return joined.select("doc_id", issues.alias("issues"))


def second_level(targets: DataFrame, checked: DataFrame) -> DataFrame:
    """Targets (doc_id, has_pdf) with the issues of ``checked`` (doc_id, issues) and their status."""
    status = F.when(~F.coalesce("has_pdf", F.lit(False)), "skipped").when(F.size(F.coalesce("issues", F.array().cast("array<string>"))) > 0, "flagged").otherwise("passed")
    joined = targets.join(checked, "doc_id", "left").withColumn("status", status)
    return joined.select("doc_id", "status", F.when(F.col("status") == "flagged", F.array_join("issues", "; ")).otherwise("").alias("issues"))


def second_level_counts(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(F.col("status") != "skipped").alias("checked"), F.count_if(F.col("status") == "flagged").alias("flagged"), F.count_if(F.col("status") == "skipped").alias("skipped"))


def page_verdicts(attempts: DataFrame, retries: int = RETRIES) -> DataFrame:
    """A verdict for each page: of the first of ``retries`` attempts without an error, else fail with the last error.

    ``attempts``: (basename, start, end, page, attempt, error, verdict, reasons).
    """
    tried = attempts.where(F.col("attempt") <= retries)
    good = F.min_by(F.struct("verdict", "reasons"), F.when(F.col("error").isNull(), F.col("attempt")))
    last = F.max_by("error", F.when(F.col("error").isNotNull(), F.col("attempt")))
    each = tried.groupBy(*BLOCK, "page").agg(F.count_if(F.col("error").isNull()).alias("__good"), good.alias("__row"), last.alias("__error"))
    failed = F.array(F.concat(F.lit(REVIEW_FAILED.format(retries)), "__error"))
    return each.select(*BLOCK, "page", F.when(F.col("__good") > 0, F.col("__row.verdict")).otherwise("fail").alias("verdict"), F.when(F.col("__good") > 0, F.col("__row.reasons")).otherwise(failed).alias("reasons"))


def third_level(plan: DataFrame, done: DataFrame, attempts: DataFrame, limit: int | None = None, retries: int = RETRIES, resume: bool = True) -> DataFrame:
    """Verdicts of the plan's blocks (basename, start, end, pos, pages): the first ``limit`` are taken *before* those that
    were reviewed already go, and blocks without pages are left out."""
    asked = head(plan, limit, "pos").where(F.size("pages") > 0)
    left = review.pending(asked, done) if resume else asked
    pages = left.select(*BLOCK, F.explode("pages").alias("page"))
    judged = page_verdicts(attempts, retries)
    none = F.array().cast("array<string>")
    both = pages.join(judged, [*BLOCK, "page"], "left").select(*BLOCK, "page", F.coalesce("verdict", F.lit("fail")).alias("verdict"), F.coalesce("reasons", none).alias("reasons"))
    told = both.groupBy(*BLOCK).agg(F.count_if(F.size("reasons") > 0).alias("pages_with_reasons"))
    return review.block_verdicts(both).join(told, list(BLOCK))


def review_calls(elements: DataFrame, pages: DataFrame, most: int = review.REGIONS) -> DataFrame:
    """The calls for each page (doc_id, page_idx): its first regions, enlarged, then the whole page; in order."""
    regions = review.page_regions(elements, most).select("doc_id", "page_idx", F.col("place").alias("call"), "type", F.lit(REGION_ZOOM).alias("zoom"))
    whole = pages.select("doc_id", "page_idx", F.lit(most + 1).alias("call"), F.lit("page").alias("type"), F.lit(PAGE_ZOOM).alias("zoom"))
    return regions.unionByName(whole)


def text_layer(latex: DataFrame, consistency: DataFrame) -> DataFrame:
    """Hard and soft findings of a text: formula marks and lost content together."""
    both = latex.select("doc_id", "hard", "soft").join(consistency, "doc_id")
    flag = lambda column, name: F.when(column, name)
    hard = F.concat_ws(";", flag(F.col("hard"), "formula_open"), flag(F.col("formula_lost"), "formula_lost"), flag(F.col("image_lost"), "image_lost"))
    return both.select("doc_id", hard.alias("hard"), F.when(F.col("soft"), "dollar_odd").otherwise("").alias("soft"))


# ---- facts that meet by joins


def element_counts(elements: DataFrame, kinds: tuple[str, ...] = ("equation", "image", "table", "chart")) -> DataFrame:
    """Elements of each document by type, and images with charts."""
    each = [F.count_if(F.col("type") == k).alias(f"n_{k}") for k in kinds]
    return elements.groupBy("doc_id").agg(*each, F.count_if(F.col("type").isin("image", "chart")).alias("n_figures"))


def on_pages(elements: DataFrame, heights: DataFrame) -> DataFrame:
    """Elements with the height of their page (doc_id, page_idx, height), on a scale of 1000; pages without one go."""
    known = heights.where("height <> 0").select("doc_id", "page_idx", F.col("height").alias("__height"))
    scaled = elements.drop("height").join(known, ["doc_id", "page_idx"])
    return scaled.withColumns({"y0": F.col("y0") * 1000.0 / F.col("__height"), "y1": F.col("y1") * 1000.0 / F.col("__height")}).drop("__height")


def folder_outputs(docs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Documents (folder, name) with whether ``outputs`` (folder, name) has them."""
    have = outputs.select("folder", "name").distinct().withColumn("done", F.lit(True))
    return docs.join(have, ["folder", "name"], "left").withColumn("done", F.coalesce("done", F.lit(False)))


def output_dirs(files: DataFrame, any_text: bool = False) -> DataFrame:
    """Output folders of a listing (path): those named so, or with ``any_text`` any that holds a full.md, each once."""
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    if any_text:
        return files.where(F.col("path").rlike(r"(^|/)full\.md$")).select(folder.alias("dir")).distinct()
    return files.select(F.regexp_extract("path", r"^(.*?_mineru)/", 1).alias("dir")).where("dir <> ''").distinct()


def rename_plan(dirs: DataFrame, wanted: Column) -> DataFrame:
    """(out_dir, dir, to) for folders (out_dir, dir) whose last part is not ``wanted`` yet."""
    to = F.concat_ws("/", F.when(F.contains("dir", F.lit("/")), F.regexp_replace("dir", r"/[^/]*$", "")), wanted)
    return dirs.withColumn("to", to).where(F.col("to") != F.col("dir"))


def answer(given: Column, options: tuple[str, ...], default: str, n_items: Column) -> Column:
    """A chosen option: the given one, null if it must be asked again; the default for none, and nothing without items."""
    said = F.upper(F.trim(F.coalesce(given, F.lit(""))))
    return F.when(n_items <= 0, "none").when(said == "", default).when(said.isin(*options), said)
