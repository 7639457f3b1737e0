"""Queries on the composed runs: plan, convert, the second and third level, and what they read and write."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import blocks, gates, review, runs
from paperloom.plans import views as V
from paperloom.plans.registry import query
from paperloom.sources import buckets, content_lists, files, sinks, tables

MOST, BUDGET = 20, 100

# ---- planning

_EXT = "CASE doc_id % 5 WHEN 0 THEN '.docx' WHEN 1 THEN '.ppt' WHEN 2 THEN '.PDF' ELSE '.pdf' END"
_PATH = f"'in/' || source || '/' || CAST(doc_id % 3 AS STRING) || '/' || CAST(doc_id AS STRING) || {_EXT}"
_ROOT = "CASE WHEN doc_id % 2 = 0 THEN 'in' ELSE 'in/' || source || '/' || CAST(doc_id % 3 AS STRING) END"
_TOTAL = "CASE doc_id % 10 WHEN 3 THEN NULL WHEN 4 THEN 0 ELSE CAST(ceil(greatest(n_chars, 1) / 100.0) AS INT) END"
_STRIDE = "CAST(7 + doc_id % 11 AS INT)"
PLAN_SQL = f"""facts AS (SELECT doc_id, source, {_PATH} AS file, {_ROOT} AS root, doc_id % 5 IN (0, 1) AS office, {_TOTAL} AS n FROM documents),
read AS (SELECT *, CAST(CASE WHEN office THEN 1 ELSE n END AS INT) AS total FROM facts WHERE source IS NOT NULL AND (office OR n > 0)),
d AS (SELECT doc_id, total, list_filter(range(1, total + 1), lambda p: doc_id % 6 <> 0 AND p > 1 AND p % {_STRIDE} = 1) AS cand FROM read WHERE total > {MOST}),
cut AS (SELECT doc_id, start, "end" FROM (WITH RECURSIVE r(doc_id, total, cand, here, start, "end") AS (
  SELECT doc_id, total, cand, 1, NULL::INT, NULL::INT FROM d WHERE len(cand) > 0
  UNION ALL
  SELECT doc_id, total, cand, CAST(nxt AS INT), here, CAST(nxt - 1 AS INT) FROM (
    SELECT doc_id, total, cand, here, CASE WHEN here + {MOST} - 1 >= total THEN total + 1 ELSE coalesce(list_max(list_filter(cand, lambda c: c > here AND c <= here + {MOST} - 1)), here + {MOST} - 1) END AS nxt FROM r WHERE here <= total))
  SELECT doc_id, start, "end" FROM r WHERE start IS NOT NULL)
 UNION ALL SELECT doc_id, CAST(a AS INT), CAST(least(a + {MOST} - 1, total) AS INT) FROM (SELECT doc_id, total, unnest(range(1, total + 1, {MOST})) AS a FROM d WHERE len(cand) = 0)
 UNION ALL SELECT doc_id, 1, total FROM read WHERE total <= {MOST}),
planned AS (SELECT doc_id, source, file, CASE WHEN lower(file) LIKE '%.pdf' THEN 'PDF' WHEN file LIKE '%.docx' THEN 'DOC' ELSE 'PPT' END AS kind, start, "end", "end" - start + 1 AS pages,
  CASE WHEN doc_id % 2 = 0 THEN source || '/' || CAST(doc_id % 3 AS VARCHAR) ELSE '' END AS src_rel_dir FROM cut JOIN read USING (doc_id))"""


def _planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.table(spark, sf_dir, "documents").where("source is not null")
    none = F.array().cast("array<int>")
    total = F.expr(_TOTAL)
    found = docs.select("doc_id", "source", F.expr(_PATH).alias("path"), F.expr(_ROOT).alias("root"), total.alias("total"))
    cand = F.filter(F.sequence(F.lit(1), F.greatest("total", F.lit(1))), lambda p: (F.col("doc_id") % 6 != 0) & (p > 1) & (p % F.expr(_STRIDE) == 1))
    even = F.col("doc_id") % 2 == 0
    return runs.plan_blocks(found.withColumns({"toc1": F.when(even, cand).otherwise(none), "toc2": none, "headings": F.when(~even, cand).otherwise(none)}), MOST)


@query("plan_blocks", f"WITH {PLAN_SQL} SELECT file, kind, start, \"end\", pages, src_rel_dir FROM planned")
def plan_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _planned(spark, sf_dir).drop("doc_id", "source")


@query("plan_run", f"""WITH RECURSIVE {PLAN_SQL},
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY file, start) AS r FROM planned),
days(source, r, file, start, pages, day, used) AS (
  SELECT source, r, file, start, pages, 1, CAST(pages AS BIGINT) FROM placed WHERE r = 1
  UNION ALL
  SELECT p.source, p.r, p.file, p.start, p.pages, CASE WHEN d.used + p.pages > {BUDGET} AND d.used > 0 THEN d.day + 1 ELSE d.day END, CASE WHEN d.used + p.pages > {BUDGET} AND d.used > 0 THEN CAST(p.pages AS BIGINT) ELSE d.used + p.pages END FROM days d JOIN placed p ON p.source = d.source AND p.r = d.r + 1)
SELECT source, file, start, pages, day FROM days""")
def plan_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.plan_days(_planned(spark, sf_dir), "source", BUDGET).select("source", "file", "start", "pages", "day")


# ---- converting

_LINE = 'CAST(l_orderkey % 700 AS STRING) || \'.pdf\''
CONVERT_SQL = """lines_ AS (SELECT DISTINCT CAST(l_orderkey % 700 AS VARCHAR) || '.pdf' AS file, l_linenumber + CAST(floor(l_orderkey / 700) AS BIGINT) * 10 AS start, l_orderkey % 23 AS day, l_orderkey % 7 AS c FROM lineitem),
plan_ AS (SELECT file, start, start AS "end", min(day) AS day, max(c) AS complex FROM lines_ GROUP BY file, start),
judged AS (SELECT *, CAST(split_part(file, '.', 1) AS BIGINT) AS k FROM plan_),
status_ AS (SELECT *, CASE WHEN k % 13 = 0 THEN 'no_source' WHEN (k + start) % 11 = 0 THEN 'done' WHEN complex >= 6 THEN 'complex' WHEN k % 17 = 0 THEN 'complex_found' WHEN (k + start) % 19 = 0 THEN 'failed' WHEN (k + start) % 5 = 0 THEN 'issues' ELSE 'ok' END AS status FROM judged),
steps AS (SELECT *, row_number() OVER (ORDER BY day, file, start) AS step, count(*) FILTER (WHERE status IN ('ok', 'issues')) OVER (ORDER BY day, file, start) AS number FROM status_)"""


def _convert(spark: SparkSession, sf_dir: str, most: int = 0) -> DataFrame:
    order = F.col("l_orderkey")
    items = V.table(spark, sf_dir, "lineitem").select(F.expr(_LINE).alias("file"), (F.col("l_linenumber") + F.floor(order / 700).cast("long") * 10).alias("start"), (order % 23).alias("day"), (order % 7).alias("c"))
    plan = items.groupBy("file", "start").agg(F.min("day").alias("day"), F.max("c").alias("c")).withColumn("end", F.col("start"))
    k = F.regexp_replace("file", r"\..*$", "").cast("long")
    out_dir = F.concat_ws("/", "file", "start")
    blocks = plan.select("file", "start", "end", "day", out_dir.alias("out_dir"), F.when(F.col("c") >= 6, 3).otherwise(0).alias("complex"))
    names = blocks.select("file").distinct()
    sources = names.where(k % 13 != 0)
    done = blocks.select("out_dir", ((k + F.col("start")) % 11 == 0).alias("done"))
    found = names.select("file", F.when(k % 17 == 0, "images").otherwise("").alias("reasons"))
    outcomes = blocks.select("file", "start", "end", ((k + F.col("start")) % 19 != 0).alias("ok"), F.when((k + F.col("start")) % 5 == 0, "small").alias("message"))
    return runs.convert_steps(blocks, sources, done, found, outcomes, most)


@query("convert_run", f"WITH {CONVERT_SQL} SELECT file, start, day, step, status, number, status IN ('ok', 'issues') AND number % 10 = 0 AS \"check\" FROM steps")
def convert_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _convert(spark, sf_dir).select("file", "start", "day", "step", "status", "number", "check")


@query("convert_limit", f"WITH {CONVERT_SQL} SELECT CASE WHEN number > 50 OR (number = 50 AND status NOT IN ('ok', 'issues')) THEN 'not_reached' ELSE status END AS status, count(*) AS n FROM steps GROUP BY 1")
def convert_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _convert(spark, sf_dir, 50).groupBy("status").agg(F.count("*").alias("n"))


@query("convert_progress", f"""WITH {CONVERT_SQL} SELECT count(*) FILTER (WHERE status IN ('ok', 'issues')) AS converted, max(step) AS last_step, count(*) FILTER (WHERE status IN ('failed', 'issues')) AS issues,
(SELECT 'Day' || day || '-' || step FROM steps WHERE status IN ('ok', 'issues') AND number = 10) AS checkpoint_at FROM steps""")
def convert_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.progress(_convert(spark, sf_dir), pause=True)


@query("complex_entries", """WITH b AS (SELECT DISTINCT o_custkey AS c, o_orderkey % 5 AS start FROM orders),
l AS (SELECT DISTINCT o_custkey AS c, o_orderkey % 5 AS start FROM orders WHERE o_orderpriority LIKE '1%')
SELECT c || '.pdf' AS basename, start, '- 🔴 ' || c || '.pdf → 页 ' || start || '-' || (start + 9) || '（10页）— ' || CASE WHEN c % 2 = 0 THEN 'images' ELSE '复杂' END AS line FROM b ANTI JOIN l USING (c, start)""")
def complex_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = V.table(spark, sf_dir, "orders")
    name = F.concat(F.col("o_custkey").cast("string"), F.lit(".pdf"))
    start = F.col("o_orderkey") % 5
    blocks = orders.select(F.concat(F.lit("a/b/"), name).alias("file"), start.alias("start"), (start + 9).alias("end"), F.lit(10).alias("pages"), F.when(F.col("o_custkey") % 2 == 0, "images").alias("reason"))
    return runs.complex_entries(blocks, orders.where("o_orderpriority LIKE '1%'").select(name.alias("basename"), start.alias("start")))


# ---- the second and third level

_SECOND = """t AS (SELECT doc_id, doc_id % 9 <> 0 AS has_pdf, CASE WHEN doc_id % 10 = 3 THEN 'bad file' END AS error, doc_id % 3 AS n_found, CASE WHEN doc_id % 3 = 2 THEN doc_id % 4 ELSE 0 END AS n_low, CASE WHEN doc_id % 11 IN (0, 1) THEN 1 ELSE 0 END AS n_tables FROM documents),
i AS (SELECT doc_id, has_pdf, CASE WHEN error IS NOT NULL THEN 'table_recheck 异常: ' || error ELSE concat_ws('; ', CASE WHEN n_found = 0 AND n_tables > 0 THEN 'tables not found: ' || n_tables END, CASE WHEN n_low > 0 THEN 'tables below 80: ' || n_low END) END AS found FROM t),
second AS (SELECT doc_id, CASE WHEN NOT has_pdf THEN 'skipped' WHEN found <> '' THEN 'flagged' ELSE 'passed' END AS status, CASE WHEN has_pdf THEN found ELSE '' END AS issues FROM i)"""


def _second(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.table(spark, sf_dir, "documents").select("doc_id")
    d = F.col("doc_id")
    tables = docs.select("doc_id", (d % 3).alias("n_found"), F.when(d % 3 == 2, d % 4).otherwise(0).alias("n_low"), F.when(d % 10 == 3, "bad file").alias("error"))
    texts = docs.where("doc_id % 11 IN (0, 1)").select("doc_id", F.lit(1).alias("n_tables"))
    return runs.second_level(docs.select("doc_id", (d % 9 != 0).alias("has_pdf")), runs.table_issues(tables, texts))


@query("l2_run", f"WITH {_SECOND} SELECT * FROM second")
def l2_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second(spark, sf_dir)


@query("l2_summary", f"WITH {_SECOND} SELECT count(*) FILTER (WHERE status <> 'skipped') AS checked, count(*) FILTER (WHERE status = 'flagged') AS flagged, count(*) FILTER (WHERE status = 'skipped') AS skipped FROM second")
def l2_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.second_level_counts(_second(spark, sf_dir))


# Pages 1 to 3 of each block; attempts fail by block, page and attempt.
_THIRD = """plan_ AS (SELECT doc_id, CAST(doc_id % 4 AS INT) AS n FROM documents ORDER BY doc_id LIMIT 150),
asked AS (SELECT doc_id, unnest(range(1, n + 1)) AS page FROM plan_ WHERE n > 0 AND doc_id % 8 <> 1),
tries AS (SELECT doc_id, page, a AS attempt, (doc_id + page * 3 + a) % 4 <> 0 AND (doc_id + page) % 5 = 0 AS failed, CASE (doc_id + page + a) % 7 WHEN 0 THEN 'fail' WHEN 1 THEN 'suspicious' ELSE 'pass' END AS verdict FROM asked, range(1, 6) r(a)),
good AS (SELECT doc_id, page, min(attempt) AS attempt FROM tries WHERE NOT failed AND attempt <= 3 GROUP BY ALL),
pages_ AS (SELECT s.doc_id, s.page, CASE WHEN g.attempt IS NULL THEN 'fail' ELSE t.verdict END AS verdict FROM asked s LEFT JOIN good g USING (doc_id, page) LEFT JOIN tries t ON t.doc_id = g.doc_id AND t.page = g.page AND t.attempt = g.attempt),
third AS (SELECT doc_id, CASE max(CASE verdict WHEN 'fail' THEN 2 WHEN 'suspicious' THEN 1 ELSE 0 END) WHEN 2 THEN 'fail' WHEN 1 THEN 'suspicious' ELSE 'pass' END AS verdict, count(*) AS pages_reviewed, count(*) FILTER (WHERE verdict <> 'pass') AS pages_with_reasons FROM pages_ GROUP BY doc_id)"""


def _third(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("basename"), F.lit(1).alias("start"), F.lit(9).alias("end"))
    pages = F.expr("CASE WHEN doc_id % 4 = 0 THEN CAST(array() AS array<int>) ELSE sequence(1, CAST(doc_id % 4 AS INT)) END")
    plan = docs.select(*runs.BLOCK, F.col("doc_id").alias("pos"), pages.alias("pages"))
    done = docs.where("doc_id % 8 = 1").select(*runs.BLOCK)
    tried = docs.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(3)))).withColumn("attempt", F.explode(F.sequence(F.lit(1), F.lit(5))))
    failed = F.expr("(doc_id + page * 3 + attempt) % 4 <> 0 AND (doc_id + page) % 5 = 0")
    verdict = F.expr("CASE (doc_id + page + attempt) % 7 WHEN 0 THEN 'fail' WHEN 1 THEN 'suspicious' ELSE 'pass' END")
    none = F.array().cast("array<string>")
    attempts = tried.select(*runs.BLOCK, "page", "attempt", F.when(failed, "timed out").alias("error"), verdict.alias("verdict"), F.when(verdict == "pass", none).otherwise(F.array(verdict)).alias("reasons"))
    return runs.third_level(plan, done, attempts, limit=150)


@query("l3_run", f"WITH {_THIRD} SELECT CAST(doc_id AS VARCHAR) AS basename, 1 AS start, 9 AS \"end\", verdict, pages_reviewed, pages_with_reasons FROM third")
def l3_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _third(spark, sf_dir)


@query("l3_summary", f"WITH {_THIRD} SELECT verdict, count(*) AS blocks FROM third GROUP BY verdict")
def l3_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _third(spark, sf_dir).groupBy("verdict").agg(F.count("*").alias("blocks"))


_KIND = "CASE (doc_id + elem_no) % 5 WHEN 0 THEN 'equation' WHEN 1 THEN 'image' WHEN 2 THEN 'table' WHEN 3 THEN 'text' ELSE 'chart' END"


@query("review_calls", f"""WITH {V.ELEMENTS_SQL}, t AS (SELECT doc_id, page_idx, elem_no, {_KIND} AS type FROM elements),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY elem_no) AS place FROM t WHERE type <> 'text')
SELECT doc_id, page_idx, CAST(place AS INT) AS call, type, 3.0::DOUBLE AS zoom FROM r WHERE place <= 5 UNION ALL SELECT doc_id, page_idx, 6, 'page', 1.5::DOUBLE FROM pages_""")
def review_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    elements = V.elements(spark, sf_dir).withColumn("type", F.expr(_KIND))
    return runs.review_calls(elements, V.book_pages(spark, sf_dir))


_DOUBLE = V.sql_count("text", "'$$'")


@query("text_layer", f"""WITH {V.MARKDOWN_SQL}, c AS (SELECT *, {_DOUBLE} AS n_double, replace(text, '$$', '') AS rest FROM md),
s AS (SELECT *, {V.sql_count('rest', "'$'")} - {V.sql_count('rest', "chr(92) || '$'")} AS n_single FROM c)
SELECT doc_id, concat_ws(';', CASE WHEN n_double % 2 = 1 THEN 'formula_open' END, CASE WHEN n_equations > 0 AND n_double < 2 THEN 'formula_lost' END, CASE WHEN n_images > 0 AND NOT contains(text, '![') THEN 'image_lost' END) AS hard,
CASE WHEN n_single % 2 = 1 AND (n_equations > 0 OR n_double > 0) THEN 'dollar_odd' ELSE '' END AS soft FROM s""")
def text_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.markdown(spark, sf_dir)
    return runs.text_layer(gates.latex(docs), gates.consistency(docs))


# ---- facts that meet by joins


@query("element_counts", f"""WITH {V.ELEMENTS_SQL}, t AS (SELECT doc_id, {_KIND} AS type FROM elements)
SELECT doc_id, count(*) FILTER (WHERE type = 'equation') AS n_equation, count(*) FILTER (WHERE type = 'image') AS n_image, count(*) FILTER (WHERE type = 'table') AS n_table, count(*) FILTER (WHERE type = 'chart') AS n_chart, count(*) FILTER (WHERE type IN ('image', 'chart')) AS n_figures FROM t GROUP BY doc_id""")
def element_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.element_counts(V.elements(spark, sf_dir).select("doc_id", F.expr(_KIND).alias("type")))


@query("page_heights", f"""WITH {V.ELEMENTS_SQL}, h AS (SELECT item_id % 40 AS book_, max(length(text)) % 7 * 100 AS height FROM benchmark GROUP BY 1)
SELECT doc_id, elem_no, y0 * 1000.0::DOUBLE / h.height < 80 AS top FROM elements JOIN h ON h.book_ = doc_id % 40 WHERE h.height <> 0 AND type = 'text'""")
def page_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_book = V.table(spark, sf_dir, "benchmark").groupBy((F.col("item_id") % 40).alias("book_")).agg((F.max(F.length("text")) % 7 * 100).cast("double").alias("height"))
    heights = V.book_pages(spark, sf_dir).withColumn("book_", F.col("doc_id") % 40).join(by_book, "book_").select("doc_id", "page_idx", "height")
    placed = runs.on_pages(V.elements(spark, sf_dir).where("type = 'text'"), heights)
    return placed.select("doc_id", "elem_no", (F.col("y0") < 80).alias("top"))


@query("folder_outputs", "SELECT s_nationkey AS folder, s_name AS name, EXISTS (SELECT 1 FROM customer c WHERE c.c_nationkey = s.s_nationkey AND c.c_custkey % 50 = s.s_suppkey % 50) AS done FROM supplier s")
def folder_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("folder"), (F.col("s_suppkey") % 50).alias("name"), F.col("s_name"))
    outputs = V.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("folder"), (F.col("c_custkey") % 50).alias("name"))
    return runs.folder_outputs(docs, outputs).select("folder", F.col("s_name").alias("name"), "done")


_LISTED = "CASE p_partkey % 4 WHEN 0 THEN 'a/b' || (p_partkey % 90) || '_mineru/p1-9/full.md' WHEN 1 THEN 'a/b' || (p_partkey % 90) || '_mineru/x.json' WHEN 2 THEN 'c/' || (p_partkey % 90) || '/full.md' ELSE 'c/' || p_partkey || '/notes.md' END"


@query("output_dirs", f"""WITH f AS (SELECT {_LISTED} AS path FROM part)
SELECT DISTINCT 'named' AS how, regexp_extract(path, '^(.*?_mineru)/', 1) AS dir FROM f WHERE contains(path, '_mineru/') UNION ALL SELECT DISTINCT 'text', regexp_replace(path, '/full\\.md$', '') FROM f WHERE path LIKE '%/full.md'""")
def output_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = V.table(spark, sf_dir, "part").select(F.expr(_LISTED).alias("path"))
    how = lambda name, df: df.select(F.lit(name).alias("how"), "dir")
    return how("named", runs.output_dirs(listed)).unionByName(how("text", runs.output_dirs(listed, any_text=True)))


@query("rename_plan", """WITH d AS (SELECT p_partkey AS out_dir, 'a/' || (p_partkey % 5) AS dir, CAST(p_size % 5 AS VARCHAR) AS name FROM part) SELECT out_dir, dir, 'a/' || name AS "to" FROM d WHERE dir <> 'a/' || name""")
def rename_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirs = V.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("out_dir"), F.expr("'a/' || (p_partkey % 5)").alias("dir"), (F.col("p_size") % 5).cast("string").alias("name"))
    return runs.rename_plan(dirs, F.col("name")).select("out_dir", "dir", "to")


@query("enrich_choice", "SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'none' ELSE CASE event_id % 5 WHEN 0 THEN 'B' WHEN 1 THEN 'A' WHEN 2 THEN 'A' WHEN 3 THEN 'C' END END AS choice FROM events")
def enrich_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.expr("CASE event_id % 5 WHEN 0 THEN ' b ' WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN 'C' ELSE 'x' END")
    return V.table(spark, sf_dir, "events").select("event_id", runs.answer(given, ("A", "B", "C"), "A", F.col("event_id") % 6).alias("choice"))


# ---- files of earlier runs

@query("queue_round_trip", f"""WITH {V.BLOCKS_SQL} SELECT file, start, "end", CASE WHEN done THEN 'low' ELSE 'high' END AS verdict, CASE WHEN done THEN 0 ELSE 2 END AS n_problems FROM blocks""")
def queue_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir).select("file", "start", "end", F.when(F.col("done"), "low").otherwise("high").alias("verdict"), F.expr("CASE WHEN done THEN array() ELSE array('full.md', '缺输出') END").alias("problems"))
    return files.queue(sinks.json_envelope(rows, "queue")).select("file", "start", "end", "verdict", F.size("problems").alias("n_problems"))


_FOUND = "CASE kind WHEN 'PDF' THEN 'fail' WHEN 'DOC' THEN 'pass' ELSE 'suspicious' END"


@query("results_round_trip", f"""WITH {V.BLOCKS_SQL} SELECT regexp_extract(file, '[^/]+$') AS basename, file, start, "end", CASE WHEN complex > 2 THEN 'high' ELSE 'formula' END AS priority, {_FOUND} AS verdict, pages AS pages_reviewed, CASE WHEN kind = 'PDF' THEN '页 ' || pages || '|' || source ELSE '' END AS reasons FROM blocks""")
def results_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third-level results written as files of their form and read as those of an earlier run."""
    block = F.struct(F.expr("regexp_extract(file, '[^/]+$', 0)").alias("basename"), "file", "start", "end", F.lit("").alias("out_dir"), F.expr("IF(complex > 2, 'high', 'formula')").alias("priority"))
    reasons = F.expr("CASE WHEN kind = 'PDF' THEN array(array('页 ' || pages, source)) ELSE array() END")
    rows = V.blocks(spark, sf_dir).select(block.alias("block"), F.expr(_FOUND).alias("verdict"), F.col("pages").alias("pages_reviewed"), reasons.alias("reasons"))
    back = files.results(sinks.json_envelope(rows, "results"))
    return back.select("basename", "file", "start", "end", "priority", "verdict", "pages_reviewed", F.array_join(F.flatten("reasons"), "|").alias("reasons"))


@query("content_elements", f"""WITH {V.ELEMENTS_SQL} SELECT doc_id, page_idx, elem_no, type, text, y0 FROM elements""")
def content_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of all documents written as content lists and read element by element."""
    path = f"{tables.shared_dir(spark)}/lists-{uuid.uuid4().hex}"
    box = F.array(F.lit(0.0), "y0", "height", "y1")
    content_lists.write(V.elements(spark, sf_dir).select("doc_id", "page_idx", F.col("elem_no").alias("no"), "type", "text", box.alias("bbox")), path)
    back = content_lists.read(spark, path, "doc_id long, page_idx int, no int, type string, text string, bbox array<double>", ".txt")
    return back.select("doc_id", "page_idx", F.col("no").alias("elem_no"), "type", "text", F.get("bbox", F.lit(1)).alias("y0"))


_STORED = """WITH r AS (SELECT l_orderkey, l_suppkey % 7 AS run, l_linenumber AS pos, l_returnflag AS flag, l_partkey FROM lineitem),
f AS (SELECT l_orderkey, run, pos, flag, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {0}, pos, l_partkey, flag) AS place FROM (SELECT *, CASE WHEN run < 4 THEN 0 WHEN run < 6 THEN 1 ELSE 2 END AS generation FROM r))
SELECT l_orderkey, pos, flag, l_partkey FROM f WHERE place = 1"""


def _stored(spark: SparkSession, sf_dir: str, latest: bool) -> DataFrame:
    """Three runs over the order lines, told by the supplier, with the order as the key."""
    path = f"{tables.shared_dir(spark)}/store-{uuid.uuid4().hex}"
    lines = V.table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("pos"), F.col("l_returnflag").alias("flag"), "l_partkey", (F.col("l_suppkey") % 7).alias("run"))
    for part in ("run < 4", "run IN (4, 5)", "run = 6"):
        buckets.merge(lines.where(part).drop("run"), path, ["l_orderkey"], ["pos", "l_partkey", "flag"], latest, 8)
    return buckets.read(spark, path, latest)


@query("store_merge", _STORED.format("generation"))
def store_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, False)


@query("store_merge_latest", _STORED.format("generation DESC"))
def store_merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, True)


_ASKED = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in review.PROMPTS.items() if k)


@query("review_prompts", f"""WITH {V.ELEMENTS_SQL}, t AS (SELECT doc_id, page_idx, elem_no, {_KIND} AS type FROM elements),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY elem_no) AS place FROM t WHERE type <> 'text'),
c AS (SELECT doc_id, page_idx, CAST(place AS INT) AS call, type FROM r WHERE place <= 5 UNION ALL SELECT doc_id, page_idx, 6, 'page' FROM pages_)
SELECT doc_id, page_idx, call, CASE type {_ASKED} ELSE '{review.PROMPTS[None]}' END AS question FROM c""")
def review_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    elements = V.elements(spark, sf_dir).withColumn("type", F.expr(_KIND))
    return runs.review_calls(elements, V.book_pages(spark, sf_dir)).select("doc_id", "page_idx", "call", review.question(F.col("type")).alias("question"))


@query("job_ids", """SELECT doc_id, 'html' || (row_number() OVER (ORDER BY source NULLS FIRST, doc_id) - 1) AS data_id FROM documents WHERE doc_id % 4 = 3
UNION ALL SELECT doc_id, 'cx' || (row_number() OVER (ORDER BY source NULLS FIRST, doc_id) - 1) FROM documents WHERE doc_id % 4 <> 3 AND doc_id % 5 >= 3""")
def job_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and complex blocks as single jobs, numbered over all of them."""
    rows = V.blocks(spark, sf_dir).select("source", "doc_id", "kind", "complex")
    one = lambda prefix, where: blocks.numbered(rows.where(where), prefix, "source", "doc_id").select("doc_id", "data_id")
    return one("html", "kind = 'HTML'").unionByName(one("cx", f"kind <> 'HTML' AND complex >= {blocks.COMPLEX}"))


_RAW = """CASE event_id % 5 WHEN 0 THEN '{"converted": ' || event_id || ', "last_block_idx": 3, "issues": ["a"]}' WHEN 1 THEN '{"converted": ' WHEN 2 THEN '[1, 2]' WHEN 3 THEN '{}' END"""


@query("progress_load", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN event_id ELSE 0 END AS converted, CASE WHEN event_id % 5 = 0 THEN 3 ELSE 0 END AS last_block_idx, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS n_issues FROM events")
def progress_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = files.progress(F.expr(_RAW))
    return V.table(spark, sf_dir, "events").select("event_id", p.alias("p")).select("event_id", "p.converted", "p.last_block_idx", F.size("p.issues").alias("n_issues"))


def falsy(value: Column, default: object) -> Column:
    """``default`` also for 0, as where an option that is not given is tested by its truth."""
    return F.when(value.isNull() | (value == 0), F.lit(default)).otherwise(value)


@query("option_defaults", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 5000 ELSE coalesce(nullif(doc_id % 5, 0), 5000) END AS budget FROM documents")
def option_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "documents").select("doc_id", falsy(F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 5), 5000).alias("budget"))


@query("review_pending", f"WITH {V.BLOCKS_SQL} SELECT doc_id FROM blocks WHERE doc_id % 4 <> 2")
def review_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = V.blocks(spark, sf_dir).select("doc_id", F.col("file").alias("basename"), "start", "end")
    return review.pending(plan, plan.where("doc_id % 4 = 2")).select("doc_id")
