"""Checks of Markdown text: size, bad characters, tables, fences, formulas and images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.functions import text as T

MIN_SIZE, MAX_BAD = 100, 5
BAD_CHARACTER = "�"
REF_WINDOW, BAD_WINDOW = 20_000, 2_000


def cells(line: Column) -> Column:
    """Cells of a table row: without one outer bar on each side, split at bars."""
    inner = F.regexp_replace(T.strip(line), r"^\||\|$", "")
    return F.size(F.split(inner, r"\|"))


def table_count(lines: Column) -> Column:
    """Well-formed pipe tables outside fences: a header, an alignment row, then rows until a line without a bar, all with
    the same number of cells. ``lines`` is an array; the fold's state is a few numbers, so long texts are no burden."""
    align = lambda s: s.rlike(r"^[-:| ]+$") & F.contains(s, F.lit("-")) & F.contains(s, F.lit("|"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(False).alias("fenced"), F.lit(0).alias("state"), F.lit(0).alias("width"))

    def step(a: Column, x: Column) -> Column:
        # state 0: outside; 1: a possible header; 2: in a valid table; 3: in a broken one
        s = T.strip(x)
        fence, bar, width = T.is_fence(s), F.contains(s, F.lit("|")), cells(s)
        closed = F.when(a["state"] == 2, a["n"] + 1).otherwise(a["n"])
        row = F.when((a["state"] == 1) & align(s) & (width == a["width"]), 2).when(a["state"] == 1, 1).when((a["state"] == 2) & (width != a["width"]), 3).when(a["state"] == 0, 1).otherwise(a["state"])
        inside = bar & ~a["fenced"] & ~fence
        return F.struct(
            F.when(inside, a["n"]).otherwise(closed).alias("n"),
            F.when(fence, ~a["fenced"]).otherwise(a["fenced"]).alias("fenced"),
            F.when(inside, row).otherwise(0).alias("state"),
            F.when(inside & (a["state"] <= 1), F.when((a["state"] == 1) & align(s), a["width"]).otherwise(width)).otherwise(a["width"]).alias("width"),
        )

    return F.aggregate(lines, zero, step, lambda a: a["n"] + F.when(a["state"] == 2, 1).otherwise(0))


def lint(docs: DataFrame, with_tables: bool = True) -> DataFrame:
    """doc_id, n_pipe, n_fence, n_tables, n_bad, n_sep and issues (codes joined by ';') for each row of ``docs``.

    Issues in order: empty (then nothing else), small, bad_characters, table_unparsed, fence_odd. Without tables (no table
    grammar at hand) any line with a bar counts as unparsed.
    """
    made = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("lines", T.lines(F.col("text")))
    counted = made.select(
        "doc_id",
        "text",
        F.size(F.filter("lines", lambda x: F.contains(x, F.lit("|")))).alias("n_pipe"),
        F.size(F.filter("lines", lambda x: T.is_fence(x))).alias("n_fence"),
        table_count(F.col("lines")).alias("n_tables") if with_tables else F.lit(0).alias("n_tables"),
        T.count_of(F.col("text"), BAD_CHARACTER).alias("n_bad"),
        F.size(F.filter("lines", lambda x: T.strip(x).startswith("|") & F.contains(x, F.lit("--")))).alias("n_sep"),
    )
    issues = F.array_join(
        F.array_compact(
            F.array(
                F.when(F.length("text") < MIN_SIZE, "small"),
                F.when(F.col("n_bad") > MAX_BAD, "bad_characters"),
                F.when((F.col("n_pipe") > 0) & (F.col("n_tables") == 0), "table_unparsed"),
                F.when(F.col("n_fence") % 2 == 1, "fence_odd"),
            )
        ),
        ";",
    )
    return counted.withColumn("issues", F.when(T.strip(F.col("text")) == "", "empty").otherwise(issues)).drop("text")


def latex(docs: DataFrame) -> DataFrame:
    """Dollar signs of (doc_id, text, n_equations): hard if pairs are odd in number, soft if single ones are and there
    are formulas."""
    text = F.coalesce("text", F.lit(""))
    counted = docs.select("doc_id", "n_equations", T.count_of(text, "$$").alias("n_double"), T.single_dollars(text).alias("n_single"), T.dollar_runs(text).alias("n_runs"))
    return counted.select(
        "*",
        (F.floor(F.col("n_double") / 2) * 2 + F.col("n_runs")).cast("long").alias("n_markers"),
        (F.col("n_double") % 2 == 1).alias("hard"),
        ((F.col("n_single") % 2 == 1) & ((F.col("n_equations") > 0) | (F.col("n_double") > 0))).alias("soft"),
    )


def consistency(docs: DataFrame) -> DataFrame:
    """(doc_id, n_equations, n_images, text): formulas without marked ones, images without references."""
    text = F.coalesce("text", F.lit(""))
    no_formula = (F.col("n_equations") > 0) & (T.count_of(text, "$$") < 2)
    no_image = (F.col("n_images") > 0) & ~F.contains(text, F.lit("!["))
    return docs.select("doc_id", no_formula.alias("formula_lost"), no_image.alias("image_lost"))


def missing_images(docs: DataFrame, files: DataFrame, most: int = 10) -> DataFrame:
    """(doc_id, pos, ref) of references in ``docs`` to files that are not in ``files`` (doc_id, ref), the first ``most``."""
    refs = docs.select("doc_id", F.posexplode(T.image_refs(F.col("text"))).alias("pos", "ref")).where(~F.col("ref").startswith("http"))
    lost = refs.join(files.select("doc_id", "ref").distinct(), ["doc_id", "ref"], "left_anti")
    return first_of(lost, "doc_id", most, "pos", "ref").select("doc_id", "pos", "ref")


def first_of(rows: DataFrame, group: str, most: int, *order: str, ties: bool = False) -> DataFrame:
    """The first ``most`` rows of each group, or with ``ties`` the rows of its first so many different places.

    A rank under a constant bound: each task drops what is beyond it before the exchange, so a hot group sends ``most`` rows a task.
    """
    rank = F.dense_rank() if ties else F.row_number()
    return rows.withColumn("__place", rank.over(Window.partitionBy(group).orderBy(*order))).where(F.col("__place") <= most).drop("__place")


def content_pages(elements: DataFrame) -> DataFrame:
    """(doc_id, content_pages): pages up to the last one with an element; an element without a page lies on the first."""
    return elements.groupBy("doc_id").agg((F.max(F.coalesce("page_idx", F.lit(0))) + 1).cast("int").alias("content_pages"))


def page_count(blocks: DataFrame) -> DataFrame:
    """Hard and soft notes on (kind, start, end, slice_pages, content_pages) against the expected number of pages."""
    expected = F.col("end") - F.col("start") + 1
    known = F.coalesce("slice_pages", expected)
    pdf = F.col("kind") == "PDF"
    unreadable = F.col("slice_pages").isNull() & F.col("content_pages").isNull()
    hard = F.coalesce(pdf & (F.col("slice_pages") != expected), F.lit(False)) | unreadable
    soft = F.coalesce(pdf & (F.col("content_pages") < known - 1), F.lit(False))
    note = F.concat_ws("; ", F.when(unreadable, "unreadable"), F.when(~unreadable & hard, "slice_pages"), F.when(soft, "content_pages"))
    return blocks.withColumns({"pages_hard": hard, "pages_soft": soft, "pages_note": note})


def verify_output(docs: DataFrame) -> DataFrame:
    """Checks right after a conversion on (doc_id, text, n_images, n_json), joined to the lint issues."""
    text = F.coalesce("text", F.lit(""))
    head = F.substring(text, 1, BAD_WINDOW)
    own = docs.select(
        "doc_id",
        F.concat_ws(
            ";",
            F.when(F.octet_length(text) < MIN_SIZE, "small_bytes"),
            F.when(F.contains(F.substring(text, 1, REF_WINDOW), F.lit("images/")) & (F.col("n_images") == 0), "images_missing"),
            F.when(F.col("n_json") < 2, "json_missing"),
            F.when((T.strip(head) == "") | (T.count_of(head, BAD_CHARACTER) > MAX_BAD), "head_unreadable"),
        ).alias("own"),
    )
    return own.join(lint(docs).select("doc_id", "issues"), "doc_id").select("doc_id", F.concat_ws(";", *[F.when(F.col(c) != "", F.col(c)) for c in ("own", "issues")]).alias("issues"))
