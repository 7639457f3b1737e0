"""The concepts of the library as views over the driver's tables, for Spark and as SQL of equal meaning.

The tables have no fences, images, pipe tables, formulas or bad characters, so views add some by doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.sources.files import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


#: A document's Markdown; the expression means the same in both dialects.
MARKDOWN = (
    "coalesce(text, '')"
    " || CASE WHEN doc_id % 7 = 0 THEN '\n```\ncode' ELSE '' END || CASE WHEN doc_id % 14 = 0 THEN '\n```' ELSE '' END"
    " || CASE WHEN doc_id % 5 = 0 THEN '\n![fig](images/' || CAST(doc_id % 60 AS STRING) || '.png) and ![web](http://x.example/y.png)' ELSE '' END"
    " || CASE WHEN doc_id % 11 = 0 THEN '\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n' WHEN doc_id % 11 = 1 THEN '\n\n| a | b |\n|---|---|\n| 1 | 2 | 3 |\n\n' ELSE '' END"
    " || CASE WHEN doc_id % 97 = 0 THEN repeat('�', 6) ELSE '' END"
    " || CASE WHEN doc_id % 13 = 0 THEN '\n$$x$$ and $y$' WHEN doc_id % 13 = 1 THEN '\n$$x' WHEN doc_id % 13 = 2 THEN '\na $x b ' || chr(92) || '$5' ELSE '' END"
)
EQUATIONS = "CASE WHEN doc_id % 13 IN (0, 2, 3) THEN doc_id % 40 ELSE 0 END"
IMAGES = "CASE WHEN doc_id % 10 IN (0, 1) THEN 2 ELSE 0 END"


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, n_equations, n_images, n_json)"""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.expr(MARKDOWN).alias("text"), F.expr(EQUATIONS).alias("n_equations"), F.expr(IMAGES).alias("n_images"), F.expr("doc_id % 4").alias("n_json"))


MARKDOWN_SQL = f"md AS (SELECT doc_id, {MARKDOWN} AS text, {EQUATIONS} AS n_equations, {IMAGES} AS n_images, doc_id % 4 AS n_json FROM documents)"

#: Line ends and white space are spelled out where the dialects' classes differ.
LINES = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
SPACES = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_lines(text: str) -> str:
    parts = f"string_split_regex({text}, '{LINES}')"
    return f"CASE WHEN list_extract({parts}, -1) = '' THEN list_slice({parts}, 1, len({parts}) - 1) ELSE {parts} END"


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACES}+|{SPACES}+$', '', 'g')"


def sql_norm(text: str) -> str:
    marks = "".join("\\" + c if c in r".()[]-+*?!" else c for c in T.PUNCTUATION).replace("'", "''")
    return f"lower(regexp_replace(regexp_replace({text}, '[\u3000\ufeff]', '', 'g'), '(?:{SPACES}|[{marks}])', '', 'g'))"


def sql_count(text: str, part: str) -> str:
    return f"CAST((length({text}) - length(replace({text}, {part}, ''))) / length({part}) AS BIGINT)"


def book_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of books, 25 in a row to a book: (doc_id, book_id, page_idx, text) with fences on some."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.expr("CAST(floor(doc_id / 25.0) AS BIGINT)").alias("book_id"), F.expr("doc_id % 25").alias("page_idx"), F.expr(FENCED).alias("text"))


FENCED = "coalesce(text, '') || CASE WHEN doc_id % 7 = 0 THEN '\n```\n```\n```\ncode' WHEN doc_id % 7 = 1 THEN '\n```\n```' ELSE '' END"
PAGES_SQL = f"pages_ AS (SELECT doc_id, CAST(floor(doc_id / 25.0) AS BIGINT) AS book_id, doc_id % 25 AS page_idx, {FENCED} AS text FROM documents)"


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of pages as elements: the first a header, the last a footer, some aside; boxes by place on the page."""
    made = book_pages(spark, sf_dir).withColumn("lines", T.lines(F.col("text")))
    # The number of lines goes along with each line, or the optimizer would keep the whole array beside it to count.
    numbered = F.transform("lines", lambda x, i: F.struct(i.alias("pos"), x.alias("text"), F.size("lines").alias("n")))
    each = made.select("doc_id", "book_id", "page_idx", F.explode(numbered).alias("l")).select("doc_id", "book_id", "page_idx", "l.n", "l.pos", "l.text")
    kind = F.when(F.col("pos") == 0, "header").when(F.col("pos") == F.col("n") - 1, "footer").when((F.col("pos") % 5 == 2) & (F.length("text") <= 60), "aside_text").otherwise("text")
    return each.select("doc_id", "book_id", "page_idx", F.col("pos").alias("elem_no"), "text", kind.alias("type"), (1000.0 * F.col("pos") / F.col("n")).alias("y0"), (1000.0 * (F.col("pos") + 1) / F.col("n")).alias("y1"), F.lit(1000.0).alias("height"))


ELEMENTS_SQL = f"""{PAGES_SQL},
split_ AS (SELECT doc_id, book_id, page_idx, {sql_lines('text')} AS ls FROM pages_),
each_ AS (SELECT doc_id, book_id, page_idx, len(ls) AS n, unnest(ls) AS text, generate_subscripts(ls, 1) - 1 AS pos FROM split_),
elements AS (SELECT doc_id, book_id, page_idx, pos AS elem_no, text,
  CASE WHEN pos = 0 THEN 'header' WHEN pos = n - 1 THEN 'footer' WHEN pos % 5 = 2 AND length(text) <= 60 THEN 'aside_text' ELSE 'text' END AS type,
  1000.0::DOUBLE * pos / n AS y0, 1000.0::DOUBLE * (pos + 1) / n AS y1, 1000.0::DOUBLE AS height FROM each_)"""
KEYS_SQL = f"""keyed AS (SELECT book_id, type, y0, y1, {sql_norm('text')} AS key FROM elements),
counted AS (SELECT book_id, key, count(*) FILTER (WHERE type IN ('header','footer','page_footnote','page_number')) AS n_noise,
  count(*) FILTER (WHERE type = 'aside_text' AND length(key) >= 3) AS n_aside,
  count(*) FILTER (WHERE type = 'text' AND y0 < 80 AND y1 - y0 < 100 AND y1 <= 1050) AS n_top
  FROM keyed WHERE length(key) >= 3 GROUP BY ALL),
keys AS (SELECT * FROM counted WHERE length(key) >= 4 AND (n_noise >= 3 OR (n_noise >= 5 AND length(key) <= 6) OR n_aside >= 4 OR n_top >= 3))"""

#: Documents as blocks of files.
BLOCK_COLUMNS = {
    "file": "source || '/' || CAST(doc_id AS STRING) || CASE doc_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.docx' WHEN 2 THEN '.pptx' ELSE '.html' END",
    "kind": "CASE doc_id % 4 WHEN 0 THEN 'PDF' WHEN 1 THEN 'DOC' WHEN 2 THEN 'PPT' ELSE 'HTML' END",
    "start": "1",
    "end": "CAST(ceil(greatest(n_chars, 1) / 200.0) AS INT)",
    "pages": "CAST(ceil(greatest(n_chars, 1) / 200.0) AS INT)",
    "complex": "CAST(doc_id % 5 AS INT)",
    "slice_pages": "CASE doc_id % 6 WHEN 0 THEN CAST(ceil(greatest(n_chars, 1) / 200.0) AS INT) - 1 WHEN 1 THEN NULL ELSE CAST(ceil(greatest(n_chars, 1) / 200.0) AS INT) END",
    "content_pages": "CASE doc_id % 9 WHEN 0 THEN NULL WHEN 1 THEN CAST(ceil(greatest(n_chars, 1) / 200.0) AS INT) - 3 ELSE CAST(ceil(greatest(n_chars, 1) / 200.0) AS INT) END",
    "done": "doc_id % 9 <> 0",
    "pos": "doc_id",
}


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "source", *[F.expr(e).alias(c) for c, e in BLOCK_COLUMNS.items()])


BLOCKS_SQL = "blocks AS (SELECT doc_id, source, " + ", ".join(f'{e} AS "{c}"' for c, e in BLOCK_COLUMNS.items()) + " FROM documents)"


def line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as blocks: file the order, start the line number, pages the quantity; some are repeated."""
    items = table(spark, sf_dir, "lineitem")
    return items.select(F.col("l_orderkey").cast("string").alias("file"), F.col("l_linenumber").alias("start"), (F.col("l_linenumber") + F.col("l_quantity").cast("int") - 1).alias("end"), F.col("l_quantity").cast("int").alias("pages"), F.col("l_returnflag").alias("flag"), (F.col("l_partkey") * 100_000 + F.col("l_suppkey")).alias("pos"))


LINE_BLOCKS_SQL = 'line_blocks AS (SELECT CAST(l_orderkey AS VARCHAR) AS file, l_linenumber AS start, l_linenumber + CAST(l_quantity AS INT) - 1 AS "end", CAST(l_quantity AS INT) AS pages, l_returnflag AS flag, l_partkey * 100000 + l_suppkey AS pos FROM lineitem)'
