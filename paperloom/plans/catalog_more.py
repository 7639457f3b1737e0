"""Queries on slicing, packing, assembling, inventories, routing and streams in batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.operators import assembly, blocks, inventory, plugins, slicing
from paperloom.plans import views as V
from paperloom.plans.registry import query
from paperloom.streaming import state, timed

MOST = 20

# ---- slicing

#: Candidates of a document's chapters: every 7th to 17th page, none for some.
_STRIDE = "CAST(7 + doc_id % 11 AS INT)"
CUTS_SQL = f"""{V.BLOCKS_SQL}, d AS (SELECT doc_id, pages AS total, list_filter(range(1, pages + 1), lambda p: doc_id % 6 <> 0 AND p > 1 AND p % {_STRIDE} = 1) AS cand FROM blocks),
cut AS (WITH RECURSIVE r(doc_id, total, cand, here, start, "end") AS (
  SELECT doc_id, total, cand, 1, NULL::INT, NULL::INT FROM d WHERE len(cand) > 0
  UNION ALL
  SELECT doc_id, total, cand, CAST(nxt AS INT), here, CAST(nxt - 1 AS INT) FROM (
    SELECT doc_id, total, cand, here, CASE WHEN here + {MOST} - 1 >= total THEN total + 1 ELSE coalesce(list_max(list_filter(cand, lambda c: c > here AND c <= here + {MOST} - 1)), here + {MOST} - 1) END AS nxt FROM r WHERE here <= total))
  SELECT doc_id, start, "end" FROM r WHERE start IS NOT NULL)"""


def _with_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir)
    pages = F.filter(F.sequence(F.lit(1), F.col("pages")), lambda p: (F.col("doc_id") % 6 != 0) & (p > 1) & (p % F.expr(_STRIDE) == 1))
    return rows.withColumn("cand", pages)


@query("smart_slice_candidates", f"WITH {CUTS_SQL} SELECT * FROM cut")
def smart_slice_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = slicing.chapter_cuts(F.col("pages"), F.col("cand"), MOST)
    return _with_candidates(spark, sf_dir).select("doc_id", F.inline(cuts))


HARD_SQL = f'SELECT doc_id, CAST(a AS INT) AS start, CAST(least(a + {MOST} - 1, pages) AS INT) AS "end" FROM (SELECT doc_id, pages, unnest(range(1, pages + 1, {MOST})) AS a FROM blocks)'


@query("hard_slice", f"WITH {V.BLOCKS_SQL} {HARD_SQL}")
def hard_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.blocks(spark, sf_dir).select("doc_id", F.inline(slicing.hard_cuts(F.col("pages"), MOST)))


@query("slice_router", f"""WITH {CUTS_SQL}, hard AS ({HARD_SQL})
SELECT doc_id, 1 AS start, pages AS "end" FROM blocks WHERE pages <= {MOST}
UNION ALL SELECT c.* FROM cut c JOIN blocks b USING (doc_id) WHERE b.pages > {MOST}
UNION ALL SELECT h.* FROM hard h JOIN blocks b USING (doc_id) WHERE b.pages > {MOST} AND h.doc_id NOT IN (SELECT doc_id FROM cut)""")
def slice_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_candidates(spark, sf_dir)
    none = F.array().cast("array<int>")
    toc = F.when(F.col("doc_id") % 2 == 0, F.col("cand")).otherwise(none)
    heads = F.when(F.col("doc_id") % 2 == 1, F.col("cand")).otherwise(none)
    return rows.select("doc_id", F.inline(slicing.routed_cuts(F.col("pages"), toc, none, heads, MOST)))


@query("large_file_slice", f"""WITH {V.BLOCKS_SQL}, l AS (SELECT doc_id, pages * 10 AS total FROM blocks WHERE pages * 10 > 200)
SELECT doc_id, CAST(a AS INT) AS start, CAST(least(a + 189, total) AS INT) AS "end" FROM (SELECT doc_id, total, unnest(range(1, total + 1, 190)) AS a FROM l)""")
def large_file_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir).withColumn("total", F.col("pages") * 10)
    return rows.select("doc_id", F.inline(slicing.large_cuts(F.col("total"), F.col("total"))))


@query("heading_pages", """WITH s AS (SELECT l_orderkey AS file, l_suppkey % 3 AS page, l_quantity AS size FROM lineitem),
p AS (SELECT file, page, list_sort(list(size)) AS sizes FROM s GROUP BY ALL)
SELECT file, page, sizes[CAST(floor(len(sizes) / 2) AS INT) + 1] AS median, list_max(sizes) AS largest, len(sizes) >= 3 AND list_max(sizes) > 20 AND list_max(sizes) > 1.5::DOUBLE * sizes[CAST(floor(len(sizes) / 2) AS INT) + 1] AS heading FROM p""")
def heading_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = V.table(spark, sf_dir, "lineitem")
    return slicing.heading_pages(items.select(F.col("l_orderkey").alias("file"), (F.col("l_suppkey") % 3).alias("page"), F.col("l_quantity").alias("size")))


@query("complexity_detect", """WITH p AS (SELECT CAST(o_custkey AS VARCHAR) AS file, o_orderkey % 90 AS page, 90 AS total, o_orderstatus <> 'F' AS has_text, CAST(floor(o_totalprice) AS BIGINT) % 9 AS n_images, o_orderpriority LIKE '1%' AS formula FROM orders),
s AS (SELECT file, count(*) FILTER (WHERE NOT has_text) AS no_text, CAST(sum(n_images) AS BIGINT) AS n_images, count(*) FILTER (WHERE formula) AS formula_pages FROM p WHERE page % 2 = 0 GROUP BY file)
SELECT file, CAST(45 AS BIGINT) AS n_sampled, no_text, n_images, formula_pages, concat_ws(';', CASE WHEN no_text > 0.4 * 45 THEN 'no_text' END, CASE WHEN n_images / 45.0 > 3 THEN 'images' END, CASE WHEN formula_pages >= 2 THEN 'formulas' END) AS reasons FROM s""")
def complexity_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = V.table(spark, sf_dir, "orders")
    pages = orders.select(F.col("o_custkey").cast("string").alias("file"), (F.col("o_orderkey") % 90).alias("page"), F.lit(90).alias("total"), (F.col("o_orderstatus") != "F").alias("has_text"), (F.floor("o_totalprice").cast("long") % 9).alias("n_images"), F.col("o_orderpriority").startswith("1").alias("formula"))
    return slicing.complexity(pages)


# ---- packing

_QUEUE = """line_queue AS (SELECT CAST(l_orderkey % 500 AS BIGINT) AS queue, CAST(l_orderkey AS VARCHAR) AS file, l_linenumber AS start, CAST(l_quantity AS INT) AS pages, l_returnflag = 'A' AS done, l_extendedprice AS price, l_partkey * 100000 + l_suppkey AS pos FROM lineitem WHERE l_linenumber <= 7),
placed AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY pos, price, file, start, pages) AS r FROM line_queue)"""


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = V.table(spark, sf_dir, "lineitem")
    return items.select((F.col("l_orderkey") % 500).alias("queue"), F.col("l_orderkey").cast("string").alias("file"), F.col("l_linenumber").alias("start"), F.col("l_linenumber").alias("end"), F.col("l_quantity").cast("int").alias("pages"), (F.col("l_returnflag") == "A").alias("done"), F.col("l_extendedprice").alias("price"), (F.col("l_partkey") * 100_000 + F.col("l_suppkey")).alias("pos"))


@query("day_pack", f"""WITH RECURSIVE {_QUEUE},
days(queue, r, file, pages, day, used) AS (
  SELECT queue, r, file, pages, 1, CAST(pages AS BIGINT) FROM placed WHERE r = 1
  UNION ALL
  SELECT p.queue, p.r, p.file, p.pages, CASE WHEN d.used + p.pages > 100 AND d.used > 0 THEN d.day + 1 ELSE d.day END, CASE WHEN d.used + p.pages > 100 AND d.used > 0 THEN CAST(p.pages AS BIGINT) ELSE d.used + p.pages END FROM days d JOIN placed p ON p.queue = d.queue AND p.r = d.r + 1)
SELECT queue, file, pages, day FROM days""")
def day_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.day_plan(_queue(spark, sf_dir), "queue", "pos", "price", budget=100).select("queue", "file", "pages", "day")


@query("plan_totals", f"""WITH RECURSIVE {_QUEUE},
days(queue, r, pages, day, used) AS (
  SELECT queue, r, pages, 1, CAST(pages AS BIGINT) FROM placed WHERE r = 1
  UNION ALL
  SELECT p.queue, p.r, p.pages, CASE WHEN d.used + p.pages > 100 AND d.used > 0 THEN d.day + 1 ELSE d.day END, CASE WHEN d.used + p.pages > 100 AND d.used > 0 THEN CAST(p.pages AS BIGINT) ELSE d.used + p.pages END FROM days d JOIN placed p ON p.queue = d.queue AND p.r = d.r + 1)
SELECT queue, max(day) AS days, count(*) AS blocks, CAST(sum(pages) AS BIGINT) AS pages FROM days GROUP BY queue""")
def plan_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.day_plan(_queue(spark, sf_dir), "queue", "pos", "price", budget=100).groupBy("queue").agg(F.max("day").alias("days"), F.count("*").alias("blocks"), F.sum("pages").alias("pages"))


def _budget_sql(where: str) -> str:
    return f"""WITH RECURSIVE {_QUEUE}, asked AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY r) AS k FROM placed WHERE {where}),
taken(queue, k, file, pages, used, hit) AS (
  SELECT queue, k, file, pages, CAST(CASE WHEN pages <= 300 THEN pages ELSE 0 END AS BIGINT), pages <= 300 FROM asked WHERE k = 1
  UNION ALL
  SELECT a.queue, a.k, a.file, a.pages, t.used + CASE WHEN t.used + a.pages <= 300 THEN a.pages ELSE 0 END, t.used + a.pages <= 300 FROM taken t JOIN asked a ON a.queue = t.queue AND a.k = t.k + 1)
SELECT queue, file, pages FROM taken WHERE hit"""


@query("budget_pack", _budget_sql("true"))
def budget_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.page_budget(_queue(spark, sf_dir), "queue", "pos", "price", budget=300).select("queue", "file", "pages")


@query("budget_pack_pending", _budget_sql("NOT done"))
def budget_pack_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.page_budget(_queue(spark, sf_dir), "queue", "pos", "price", budget=300, skip_done=True).select("queue", "file", "pages")


_WHOLE = """placed AS (SELECT l_orderkey AS pos, l_extendedprice AS price, CAST(l_partkey AS VARCHAR) AS file, CAST(l_suppkey AS INT) AS start, l_linenumber AS "end", CAST(l_quantity AS INT) AS pages,
  row_number() OVER (ORDER BY l_orderkey, l_extendedprice, CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS INT), l_linenumber, CAST(l_quantity AS INT)) AS i FROM lineitem)"""


def _whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines as one queue."""
    items = V.table(spark, sf_dir, "lineitem")
    return items.select(F.lit(1).alias("queue"), F.col("l_orderkey").alias("pos"), F.col("l_extendedprice").alias("price"), F.col("l_partkey").cast("string").alias("file"), F.col("l_suppkey").cast("int").alias("start"), F.col("l_linenumber").alias("end"), F.col("l_quantity").cast("int").alias("pages"))


@query("day_pack_whole", f"""WITH RECURSIVE {_WHOLE},
summed AS (SELECT *, sum(pages) OVER (ORDER BY i) AS through FROM placed),
jumps AS (SELECT *, count(*) OVER (ORDER BY through - pages RANGE BETWEEN UNBOUNDED PRECEDING AND 5000 FOLLOWING) AS next FROM summed),
walk(day, i) AS (SELECT 1, CAST(1 AS BIGINT) UNION ALL SELECT w.day + 1, j.next FROM walk w JOIN jumps j ON j.i = w.i JOIN summed n ON n.i = j.next AND n.through > j.through - j.pages + 5000)
SELECT p.pos, p.file, p.start, p."end", p.pages, CAST(max(w.day) OVER (ORDER BY p.i) AS INT) AS day FROM placed p LEFT JOIN walk w USING (i)""")
def day_pack_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.day_plan(_whole(spark, sf_dir), "queue", "pos", "price").select("pos", "file", "start", "end", "pages", "day")


@query("budget_pack_whole", f"""WITH RECURSIVE {_WHOLE},
walk(i, used) AS (SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT) UNION ALL
  SELECT p.i, w.used + p.pages FROM walk w, LATERAL (SELECT i, pages FROM placed p WHERE p.i > w.i AND p.pages <= 5000 - w.used ORDER BY i LIMIT 1) p)
SELECT p.pos, p.file, p.start, p."end", p.pages, (SELECT max(used) FROM walk) AS used FROM placed p JOIN walk w USING (i)""")
def budget_pack_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.page_budget(_whole(spark, sf_dir), "queue", "pos", "price").select("pos", "file", "start", "end", "pages", "used")


@query("upload_batches", """WITH t AS (SELECT l_orderkey % 100 AS day, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey % 100 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS place FROM lineitem)
SELECT day, place, CAST(floor(place / 50) AS BIGINT) AS batch, 'd' || day || 'b' || place AS data_id, printf('d%03d_%s_p%d-%d.pdf', day, CAST(l_orderkey AS VARCHAR), l_linenumber, l_linenumber + 9) AS slice FROM t""")
def upload_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = V.table(spark, sf_dir, "lineitem").withColumn("day", F.col("l_orderkey") % 100)
    made = blocks.batches(items, "day", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return made.select("day", F.col("place").cast("long").alias("place"), "batch", "data_id", blocks.slice_name(F.col("day"), F.col("l_orderkey").cast("string"), F.col("l_linenumber"), F.col("l_linenumber") + 9).alias("slice"))


@query("upload_urls", """WITH t AS (SELECT user_id, list(event_id ORDER BY event_id) AS tasks, list('u' || event_id ORDER BY event_id) AS urls FROM events GROUP BY user_id)
SELECT user_id, unnest(tasks) AS task, unnest(urls) AS url FROM t""")
def upload_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = V.table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list("event_id")).alias("task"))
    urls = lists.withColumn("url", F.transform("task", lambda t: F.concat(F.lit("u"), t.cast("string"))))
    return urls.select("user_id", F.inline(F.arrays_zip("task", "url")))


@query("upload_pairs", """WITH t AS (SELECT l_suppkey % 40 AS batch, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey % 40 ORDER BY l_orderkey, l_linenumber, l_partkey) - 1 AS place FROM lineitem),
u AS (SELECT o_custkey % 40 AS batch, o_orderkey, row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY o_orderkey) - 1 AS place FROM orders)
SELECT batch, place, l_orderkey, l_linenumber, 'u' || o_orderkey AS url FROM t JOIN u USING (batch, place)""")
def upload_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as tasks and orders as the addresses for them: two tables that agree by place alone."""
    tasks = V.table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 40).alias("batch"), "l_orderkey", "l_linenumber", "l_partkey")
    urls = V.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("batch"), "o_orderkey")
    pairs = blocks.zipped(tasks, urls, "batch", ["l_orderkey", "l_linenumber", "l_partkey"], ["o_orderkey"])
    return pairs.select("batch", "place", "l_orderkey", "l_linenumber", F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("url"))


# ---- assembling


@query("merge_slices", """WITH s AS (SELECT conv_id AS book, CASE WHEN turn % 5 = 4 THEN 'images' ELSE 'p' || (turn + 1) || '-' || (turn + 3) END AS dir, turn, CASE WHEN turn % 7 = 6 THEN NULL ELSE text END AS text FROM conversations)
SELECT book, string_agg(text, chr(10) || chr(10) ORDER BY turn, dir, text) AS text, count(*) AS n_merged FROM s WHERE regexp_matches(dir, '^p\\d+-\\d+$') AND text IS NOT NULL GROUP BY book""")
def merge_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = V.table(spark, sf_dir, "conversations")
    folder = F.when(F.col("turn") % 5 == 4, "images").otherwise(F.format_string("p%d-%d", F.col("turn") + 1, F.col("turn") + 3))
    return assembly.merge_slices(turns.select(F.col("conv_id").alias("book"), folder.alias("dir"), F.col("turn").alias("start"), F.when(F.col("turn") % 7 != 6, F.col("text")).alias("text")))


_NOTES = "notes AS (SELECT CAST(item_id AS VARCHAR) AS stem, '# ' || item_id || chr(10) || text AS body FROM benchmark WHERE item_id % 2 = 0)"
_EMBEDDED = rf"""{V.MARKDOWN_SQL}, {_NOTES}, shown AS (SELECT stem, chr(10) || chr(10) || '## 插图笔记' || chr(10) || chr(10) || {V.sql_strip("regexp_replace(body, '^# [^' || chr(10) || ']*' || chr(10) || '?', '')")} || chr(10) AS note FROM notes),
e AS (SELECT m.doc_id, CASE WHEN m.doc_id % 5 = 0 THEN coalesce(replace(m.text, '![fig](images/' || (m.doc_id % 60) || '.png)', s.note), m.text) ELSE m.text END AS text, CAST(m.doc_id % 5 = 0 AND s.note IS NOT NULL AS BIGINT) AS embedded, CAST(m.doc_id % 5 = 0 AND s.note IS NULL AS BIGINT) AS missing FROM md m LEFT JOIN shown s ON s.stem = CAST(m.doc_id % 60 AS VARCHAR))"""


def _embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = V.table(spark, sf_dir, "benchmark").where("item_id % 2 = 0")
    notes = items.select(F.col("item_id").cast("string").alias("stem"), F.concat(F.lit("# "), F.col("item_id").cast("string"), F.lit("\n"), "text").alias("body"))
    return assembly.embed(V.markdown(spark, sf_dir), notes)


@query("embed_notes", f"WITH {_EMBEDDED} SELECT * FROM e")
def embed_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embedded(spark, sf_dir)


_DOC_DIR = "'b' || (doc_id % 9) || CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '/p1-9' ELSE '/p1-9/x' END"
_NOTE_DIR = "'b' || (item_id % 9) || CASE item_id % 4 WHEN 0 THEN '' WHEN 1 THEN '/p1-9' WHEN 2 THEN '/p1-9/x' ELSE '/p1-9/x/y' END"


@query("embed_notes_folders", rf"""WITH {V.MARKDOWN_SQL},
refs AS (SELECT doc_id, text, {_DOC_DIR} AS dir, CASE WHEN doc_id % 5 = 0 THEN '![fig](images/' || (doc_id % 60) || '.png)' END AS ref, CAST(doc_id % 60 % 4 AS VARCHAR) AS stem FROM (SELECT doc_id, replace(text, '![fig](images/' || (doc_id % 60) || '.png)', '![fig](images/' || (doc_id % 60 % 4) || '.png)') AS text FROM md)),
notes AS (SELECT {_NOTE_DIR} AS at, CAST(item_id % 4 AS VARCHAR) AS stem, min('# ' || (item_id % 4) || chr(10) || text) AS body FROM benchmark GROUP BY ALL),
c AS (SELECT r.doc_id, chr(10) || chr(10) || '## 插图笔记' || chr(10) || chr(10) || {V.sql_strip("regexp_replace(n.body, '^# [^' || chr(10) || ']*' || chr(10) || '?', '')")} || chr(10) AS note,
  row_number() OVER (PARTITION BY r.doc_id ORDER BY CASE WHEN n.at = r.dir THEN 0 WHEN starts_with(r.dir, n.at || '/') THEN len(string_split(r.dir, '/')) - len(string_split(n.at, '/')) ELSE 6 END, n.at) AS k
  FROM refs r JOIN notes n USING (stem) WHERE r.ref IS NOT NULL AND (n.at = r.dir OR starts_with(r.dir, n.at || '/') OR starts_with(n.at, r.dir || '/')))
SELECT r.doc_id, CASE WHEN c.note IS NULL THEN r.text ELSE replace(r.text, '![fig](images/' || r.stem || '.png)', c.note) END AS text, CAST(r.ref IS NOT NULL AND c.note IS NOT NULL AS BIGINT) AS embedded, CAST(r.ref IS NOT NULL AND c.note IS NULL AS BIGINT) AS missing
FROM refs r LEFT JOIN c ON c.doc_id = r.doc_id AND c.k = 1""")
def embed_notes_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few stems in many folders, so that only the folder tells which note is meant."""
    short = F.replace("text", F.expr("'![fig](images/' || (doc_id % 60) || '.png)'"), F.expr("'![fig](images/' || (doc_id % 60 % 4) || '.png)'"))
    docs = V.markdown(spark, sf_dir).select("doc_id", F.expr(_DOC_DIR).alias("dir"), short.alias("text"))
    bodies = V.table(spark, sf_dir, "benchmark").select(F.expr(_NOTE_DIR).alias("dir"), (F.col("item_id") % 4).cast("string").alias("stem"), F.expr("'# ' || (item_id % 4) || '\n' || text").alias("body"))
    return assembly.embed(docs, bodies)


@query("merge_offsets", """WITH s AS (SELECT conv_id % 3 AS book, conv_id * 10 + turn AS start, CASE WHEN turn % 5 = 4 THEN 'images' ELSE 'p' || (turn + 1) || '-' || (turn + 3) END AS dir, CASE WHEN turn % 7 = 6 THEN NULL ELSE text END AS text FROM conversations)
SELECT book, start, length(text) AS n, CAST(coalesce(sum(length(text) + 2) OVER (PARTITION BY book ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at FROM s WHERE regexp_matches(dir, '^p\\d+-\\d+$') AND text IS NOT NULL""")
def merge_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = V.table(spark, sf_dir, "conversations")
    folder = F.when(F.col("turn") % 5 == 4, "images").otherwise(F.format_string("p%d-%d", F.col("turn") + 1, F.col("turn") + 3))
    slices = turns.select((F.col("conv_id") % 3).alias("book"), folder.alias("dir"), (F.col("conv_id") * 10 + F.col("turn")).alias("start"), F.when(F.col("turn") % 7 != 6, F.col("text")).alias("text"))
    return assembly.merge_offsets(slices).select("book", "start", F.length("text").cast("long").alias("n"), "at")


@query("embed_stats", f"WITH {_EMBEDDED} SELECT count(*) FILTER (WHERE embedded + missing > 0) AS files, CAST(sum(embedded) AS BIGINT) AS embedded, CAST(sum(missing) AS BIGINT) AS missing FROM e")
def embed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embedded(spark, sf_dir).agg(F.count_if(F.col("embedded") + F.col("missing") > 0).alias("files"), F.sum("embedded").alias("embedded"), F.sum("missing").alias("missing"))


@query("nearest_notes", """WITH refs AS (SELECT DISTINCT 'b/' || (doc_id % 8) || '/' || (doc_id % 3) AS dir, CAST(doc_id % 12 AS VARCHAR) AS stem FROM documents),
notes AS (SELECT CASE item_id % 4 WHEN 0 THEN 'b' WHEN 1 THEN 'b/' || (item_id % 8) WHEN 2 THEN 'b/' || (item_id % 8) || '/' || (item_id % 3) ELSE 'b/' || (item_id % 8) || '/' || (item_id % 3) || '/x' END AS note_dir, CAST(item_id % 12 AS VARCHAR) AS stem, item_id FROM benchmark),
one AS (SELECT note_dir, stem, min(item_id) AS item_id FROM notes GROUP BY ALL),
c AS (SELECT r.dir, r.stem, n.note_dir, n.item_id, CASE WHEN n.note_dir = r.dir THEN 0 WHEN starts_with(r.dir, n.note_dir || '/') THEN len(string_split(r.dir, '/')) - len(string_split(n.note_dir, '/')) ELSE 6 END AS distance FROM refs r JOIN one n USING (stem) WHERE n.note_dir = r.dir OR starts_with(r.dir, n.note_dir || '/') OR starts_with(n.note_dir, r.dir || '/')),
k AS (SELECT *, row_number() OVER (PARTITION BY dir, stem ORDER BY distance, note_dir) AS r FROM c)
SELECT dir, stem, distance, note_dir, item_id FROM k WHERE r = 1""")
def nearest_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = V.table(spark, sf_dir, "documents").select(F.expr("'b/' || (doc_id % 8) || '/' || (doc_id % 3)").alias("dir"), (F.col("doc_id") % 12).cast("string").alias("stem"))
    folder = F.expr("CASE item_id % 4 WHEN 0 THEN 'b' WHEN 1 THEN 'b/' || (item_id % 8) WHEN 2 THEN 'b/' || (item_id % 8) || '/' || (item_id % 3) ELSE 'b/' || (item_id % 8) || '/' || (item_id % 3) || '/x' END")
    notes = V.table(spark, sf_dir, "benchmark").select(folder.alias("dir"), (F.col("item_id") % 12).cast("string").alias("stem"), "item_id").groupBy("dir", "stem").agg(F.min("item_id").alias("body"))
    return assembly.nearest_notes(refs, notes).select("dir", "stem", "distance", "note_dir", F.col("body").alias("item_id"))


@query("enrich_status", """SELECT CASE WHEN item_id % 5 = 0 THEN 'skipped' WHEN item_id % 7 = 0 THEN 'empty' ELSE 'done' END AS status, count(*) AS n FROM benchmark GROUP BY 1""")
def enrich_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("item_id")
    status = assembly.enrich_status(i % 5 == 0, F.when(i % 7 != 0, F.col("text")), F.lit(""))
    return V.table(spark, sf_dir, "benchmark").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query("note_bodies", "SELECT item_id, '# ' || item_id || chr(10) || chr(10) || '## OCR' || chr(10) || chr(10) || text || CASE WHEN item_id % 2 = 0 THEN chr(10) || chr(10) || '## Vision' || chr(10) || chr(10) || 'seen' ELSE '' END || chr(10) AS body FROM benchmark")
def note_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("item_id")
    return V.table(spark, sf_dir, "benchmark").select("item_id", assembly.note_body(i.cast("string"), F.col("text"), F.when(i % 2 == 0, "seen")).alias("body"))


@query("ocr_reading_order", "SELECT user_id AS image, string_agg(CAST(event_id AS VARCHAR), chr(10) ORDER BY CAST(floor(value) AS BIGINT) % 7, event_id % 11, CAST(event_id AS VARCHAR)) AS text FROM events WHERE value < 30 GROUP BY user_id")
def ocr_reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = V.table(spark, sf_dir, "events").where("value < 30")
    return assembly.reading_order(events.select(F.col("user_id").alias("image"), (F.floor("value").cast("long") % 7).alias("y"), (F.col("event_id") % 11).alias("x"), F.col("event_id").cast("string").alias("text")))


# ---- inventories and routing

_PATH = "CASE p_partkey % 7 WHEN 0 THEN 'images/' || p_partkey || '.png' WHEN 1 THEN 'images_notes/' || p_partkey || '.md' WHEN 2 THEN p_partkey || '.json' WHEN 3 THEN '_slices/' || p_partkey || '.pdf' WHEN 4 THEN p_partkey || '_origin.pdf' WHEN 5 THEN 'full.md' ELSE 'images/' || p_partkey || '.txt' END"
_CATEGORY = "CASE p_partkey % 7 WHEN 0 THEN 'images' WHEN 1 THEN 'notes' WHEN 2 THEN 'json' WHEN 3 THEN 'slices' WHEN 4 THEN 'pdf' WHEN 6 THEN 'images' END"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "part").select(F.concat(F.lit("o"), (F.col("p_partkey") % 300).cast("string")).alias("out_dir"), F.expr(_PATH).alias("path"), (F.col("p_size") * 1000).cast("long").alias("bytes"), "p_partkey")


@query("cleanup_inventory", f"""WITH f AS (SELECT {_CATEGORY} AS category, CAST(p_size * 1000 AS BIGINT) AS bytes FROM part), s AS (SELECT category, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM f WHERE category IS NOT NULL GROUP BY category)
SELECT *, CASE WHEN bytes < 1048576 THEN printf('%.1f KB', bytes / 1024.0) ELSE printf('%.1f MB', bytes / 1048576.0) END AS shown FROM s""")
def cleanup_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventory(_files(spark, sf_dir))


@query("cleanup_manifest", f"""WITH f AS (SELECT 'o' || (p_partkey % 300) AS out_dir, p_partkey, {_CATEGORY} AS category, p_partkey % 7 = 5 AND p_size > 0 AS text FROM part),
g AS (SELECT out_dir FROM f GROUP BY out_dir HAVING NOT coalesce(bool_or(category = 'notes'), false) OR bool_or(text))
SELECT p_partkey, category FROM f WHERE category IN ('images', 'notes') AND out_dir IN (SELECT out_dir FROM g)""")
def cleanup_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.deletions(_files(spark, sf_dir), "images").select("p_partkey", "category")


@query("image_scan", "SELECT count(*) AS n FROM part WHERE p_partkey % 7 = 0")
def image_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.image_files(_files(spark, sf_dir)).agg(F.count("*").alias("n"))


@query("deepest_dir", """WITH d AS (SELECT 'o' || (p_partkey % 300) AS out_dir, 'a' || repeat('/' || (p_size % 9), CAST(p_partkey % 4 AS INT)) AS dir FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY out_dir ORDER BY len(string_split(dir, '/')) DESC, dir DESC) AS k FROM d) SELECT out_dir, dir FROM r WHERE k = 1""")
def deepest_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirs = V.table(spark, sf_dir, "part").select(F.expr("'o' || (p_partkey % 300)").alias("out_dir"), F.expr("'a' || repeat('/' || (p_size % 9), CAST(p_partkey % 4 AS INT))").alias("dir"))
    return inventory.deepest(dirs)


@query("folder_ready", """WITH d AS (SELECT s_nationkey AS folder, s_name AS name, s_acctbal > 500 AS done FROM supplier),
m AS (SELECT folder, name, row_number() OVER (PARTITION BY folder ORDER BY name) AS r FROM (SELECT DISTINCT folder, name FROM d WHERE NOT done)),
l AS (SELECT folder, string_agg(name, ',' ORDER BY name) AS first_missing FROM m WHERE r <= 5 GROUP BY folder)
SELECT folder, count(*) AS n_docs, count(*) FILTER (WHERE NOT done) AS n_missing, coalesce(max(first_missing), '') AS first_missing, bool_and(done) AS ready FROM d LEFT JOIN l USING (folder) GROUP BY folder""")
def folder_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("folder"), F.col("s_name").alias("name"), (F.col("s_acctbal") > 500).alias("done"))
    return inventory.ready_folders(docs)


_BATCH = "CASE p_partkey % 5 WHEN 0 THEN 'u' || (p_partkey % 7) || '_content_list.json' WHEN 1 THEN 'u' || (p_partkey % 7) || '_origin.pdf' WHEN 2 THEN 'u' || (p_partkey % 3) || '_origin.pdf' WHEN 3 THEN 'images/u_origin.pdf' ELSE 'full.md' END"


@query("origin_pdfs", f"""WITH f AS (SELECT p_size AS out_dir, {_BATCH} AS path FROM part),
l AS (SELECT out_dir, path AS content_list, replace(path, '_content_list.json', '') AS batch FROM f WHERE path LIKE '%_content_list.json'),
o AS (SELECT DISTINCT out_dir, path, replace(path, '_origin.pdf', '') AS batch FROM f WHERE path LIKE '%_origin.pdf' AND NOT contains(path, '/'))
SELECT l.out_dir, l.content_list, coalesce(o.path, (SELECT min(path) FROM o x WHERE x.out_dir = l.out_dir)) AS origin FROM l LEFT JOIN o ON o.out_dir = l.out_dir AND o.batch = l.batch""")
def origin_pdfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.origin_pdfs(V.table(spark, sf_dir, "part").select(F.col("p_size").alias("out_dir"), F.expr(_BATCH).alias("path")))


@query("zip_member_safety", r"""WITH m AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '/etc/x' WHEN 1 THEN 'a/../b' WHEN 2 THEN 'C:\x' WHEN 3 THEN 'a/b.md' WHEN 4 THEN '\x' ELSE 'a..b/c' END AS path FROM events)
SELECT event_id, NOT (path LIKE '/%' OR starts_with(path, chr(92)) OR regexp_matches(path, '^[A-Za-z]:') OR list_contains(string_split_regex(path, '[/\\]'), '..')) AS safe FROM m""")
def zip_member_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.element_at(F.array(*[F.lit(x) for x in ("/etc/x", "a/../b", "C:\\x", "a/b.md", "\\x", "a..b/c")]), (F.col("event_id") % 6 + 1).cast("int"))
    return V.table(spark, sf_dir, "events").select("event_id", blocks.member_is_safe(path).alias("safe"))


_PROMPT = "CASE event_id % 8 WHEN 0 THEN 'Layout Detection: list boxes' WHEN 1 THEN 'Table Recognition' WHEN 2 THEN 'parse <fcel>' WHEN 3 THEN 'Formula Recognition' WHEN 4 THEN 'Image Analysis' WHEN 5 THEN 'run OCR' WHEN 6 THEN '' ELSE 'hello' END"


@query("task_route", "SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'layout' WHEN 1 THEN 'table' WHEN 2 THEN 'table' WHEN 3 THEN 'equation' WHEN 4 THEN 'image' WHEN 5 THEN 'text' ELSE 'default' END AS task, 'image/' || CASE WHEN event_id % 2 = 0 THEN 'jpeg' ELSE 'png' END AS mime FROM events")
def task_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "events").select("event_id", inventory.task_of(F.expr(_PROMPT)).alias("task"), inventory.mime(F.when(F.col("event_id") % 2 == 0, "JPG").otherwise("png")).alias("mime"))


# ---- streams in batch form

_STATES = "ev AS (SELECT event_id, CAST(user_id AS VARCHAR) || '-' || (event_id % 7) AS data_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'done' ELSE 'running' END AS state, ts FROM events)"


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "done").otherwise("running")
    return V.table(spark, sf_dir, "events").select("event_id", F.concat(F.col("user_id").cast("string"), F.lit("-"), (F.col("event_id") % 7).cast("string")).alias("data_id"), kind.alias("state"), "ts")


@query("poll_first_terminal", f"WITH {_STATES}, r AS (SELECT *, row_number() OVER (PARTITION BY data_id ORDER BY ts, event_id) AS k FROM ev WHERE state IN ('done', 'failed')) SELECT data_id, state FROM r WHERE k = 1")
def poll_first_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.first_terminal_batch(_states(spark, sf_dir)).select("data_id", "state")


@query("heartbeat_window", """WITH w AS (SELECT CAST(floor(epoch(ts) / 300) AS BIGINT) * 300 AS slot FROM events), x AS (SELECT slot - k * 300 AS started FROM w, (VALUES (0), (1)) v(k))
SELECT started, count(*) AS fresh FROM x GROUP BY started""")
def heartbeat_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    beats = state.heartbeat(V.table(spark, sf_dir, "events"), "10 minutes", "5 minutes")
    return beats.select(F.unix_timestamp("window_start").alias("started"), "fresh")


@query("stall_sessions", """WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > ts - INTERVAL 15 MINUTE THEN 0 ELSE 1 END AS opens FROM events),
s AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM g)
SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS started, count(*) AS events FROM s GROUP BY user_id, n""")
def stall_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = state.sessions(V.table(spark, sf_dir, "events"))
    return runs.select("user_id", F.unix_timestamp("started").alias("started"), "events")


@query("poll_give_up", """WITH t AS (SELECT user_id, date_trunc('millisecond', min(ts)) AS submitted FROM events GROUP BY user_id),
a AS (SELECT user_id, date_trunc('millisecond', ts) AS ts, CASE event_type WHEN 'error' THEN 'failed' ELSE 'done' END AS state FROM events WHERE event_type IN ('error', 'purchase')),
m AS (SELECT t.user_id, t.submitted, min(struct_pack(ts := a.ts, state := a.state)) AS b FROM t LEFT JOIN a ON t.user_id = a.user_id AND a.ts >= t.submitted AND a.ts <= t.submitted + INTERVAL 7200 SECOND GROUP BY ALL)
SELECT CAST(user_id AS VARCHAR) AS data_id, coalesce(b.state, 'gave_up') AS state, epoch_ms(coalesce(b.ts, submitted + INTERVAL 7200 SECOND)) AS at FROM m""")
def poll_give_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = V.table(spark, sf_dir, "events").withColumn("data_id", F.col("user_id").cast("string"))
    state_ = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "done").otherwise("running")
    told = timed.poll_batch(events.select("data_id", "ts"), events.select("data_id", state_.alias("state"), "ts"))
    return told.select("data_id", "state", F.unix_millis("ts").alias("at"))


@query("stalls", """WITH t AS (SELECT DISTINCT user_id, date_trunc('millisecond', ts) AS ts FROM events),
n AS (SELECT user_id, ts, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), (SELECT max(ts) FROM t)) AS next FROM t)
SELECT user_id, epoch_ms(ts) AS quiet_since FROM n WHERE next >= ts + INTERVAL 900 SECOND""")
def stalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed.stalls_batch(V.table(spark, sf_dir, "events")).select("user_id", F.unix_millis("quiet_since").alias("quiet_since"))


# ---- outside engines: stand-ins


@query("parse_stub", f"""WITH {V.MARKDOWN_SQL}, x AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM md)
SELECT doc_id, CAST(i AS INTEGER) AS elem_no, 'text' AS type, l[i + 1] AS text, CAST(i // 40 AS INTEGER) AS page_idx FROM (SELECT doc_id, l, unnest(range(len(l))) AS i FROM x)""")
def parse_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plugins.call("parse", V.markdown(spark, sf_dir).select("doc_id", "text"))


@query("vision_stub", f"WITH {V.MARKDOWN_SQL} SELECT doc_id, true AS ok, CASE WHEN regexp_matches(text, '\\S') THEN '清晰' ELSE '空白' END AS answer FROM md")
def vision_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plugins.call("vision", V.markdown(spark, sf_dir).select("doc_id", "text"))


_FORMAT = "CASE doc_id % 6 WHEN 0 THEN 'docx' WHEN 1 THEN 'html' WHEN 2 THEN 'epub' WHEN 3 THEN 'pptx' WHEN 4 THEN 'pdf' ELSE 'rtf' END"


@query("export_stub", f"""WITH {V.MARKDOWN_SQL} SELECT doc_id, {_FORMAT} AS format, doc_id % 6 <> 5 AS ok,
CASE WHEN doc_id % 6 <> 5 THEN CAST(strlen(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;')) + 11 AS BIGINT) END AS n_bytes FROM md""")
def export_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plugins.call("export", V.markdown(spark, sf_dir).select("doc_id", "text", F.expr(_FORMAT).alias("format")))


_STATE = "CASE doc_id % 6 WHEN 0 THEN 'fine' WHEN 1 THEN 'empty_password' WHEN 2 THEN 'password' WHEN 3 THEN 'damaged' WHEN 4 THEN 'broken' END"


@query("repair_stub", "SELECT doc_id, doc_id % 6 IN (0, 1, 3) AS ok, CASE doc_id % 6 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 2 THEN 'human' WHEN 3 THEN 'recovered' WHEN 4 THEN 'unrepairable' ELSE 'missing' END AS message FROM documents")
def repair_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plugins.call("repair", V.markdown(spark, sf_dir).select("doc_id", F.expr(_STATE).alias("state")))


@query("clean_stub", f"""WITH {V.MARKDOWN_SQL}, c AS (SELECT doc_id, text, array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT contains(x, '{plugins.MARK}')), chr(10)) AS kept FROM md)
SELECT doc_id, regexp_matches(kept, '\\S') AS ok, CASE WHEN regexp_matches(kept, '\\S') THEN kept ELSE text END AS text FROM c""")
def clean_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plugins.call("clean", V.markdown(spark, sf_dir).select("doc_id", "text"))
