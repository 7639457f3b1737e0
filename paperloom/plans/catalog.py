"""Queries over the driver's tables, one or more for each operator, with the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.operators import blocks, cleaning, gates, inventory, review, slicing
from paperloom.plans import views as V
from paperloom.plans.registry import query
from paperloom.sources import sinks

# ---- scans and blocks


@query("blocks_union_dedup", f"""WITH {V.LINE_BLOCKS_SQL},
ranked AS (SELECT file, start, "end", pages, flag, row_number() OVER (PARTITION BY file, start, "end" ORDER BY CASE WHEN flag = 'R' THEN 0 ELSE 1 END, pos) AS r FROM line_blocks)
SELECT file, start, "end", pages, flag FROM ranked WHERE r = 1""")
def blocks_union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.line_blocks(spark, sf_dir)
    return blocks.load(rows.where("flag = 'R'"), rows.where("flag <> 'R'")).select("file", "start", "end", "pages", "flag")


@query("doc_kind_route", f"""WITH {V.BLOCKS_SQL}
SELECT doc_id, kind, CASE WHEN kind = 'HTML' THEN 'MinerU-HTML' ELSE 'vlm' END AS version, CASE WHEN pages > 200 THEN 'too_long' WHEN complex >= 3 THEN 'cloud' ELSE 'local' END AS route,
  regexp_extract(file, '[^/]+$') AS name, regexp_replace(regexp_extract(file, '[^/]+$'), '\\.[^.]*$', '') AS stem FROM blocks""")
def doc_kind_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = F.col("file")
    return blocks.route(V.blocks(spark, sf_dir)).select("doc_id", blocks.kind(file).alias("kind"), blocks.parser_version(file).alias("version"), "route", T.basename(file).alias("name"), T.stem(file).alias("stem"))


@query("safe_names_out_dir", f"""WITH {V.LINE_BLOCKS_SQL}, named AS (SELECT *, 'a/b/' || file || CASE WHEN start % 2 = 0 THEN ':x?.pdf' ELSE '.pdf' END AS path FROM line_blocks),
counted AS (SELECT *, count(*) OVER (PARTITION BY path) AS n FROM named)
SELECT path, start, "end", n AS n_blocks,
  CASE WHEN start % 3 = 0 THEN 'root/rel' ELSE 'a/b' END || '/' || regexp_replace(regexp_replace(regexp_extract(path, '[^/]+$'), '\\.[^.]*$', ''), '[<>:"/\\\\|?*]', '_', 'g') || '_mineru' || CASE WHEN n > 1 THEN '/p' || start || '-' || "end" ELSE '' END AS out_dir FROM counted""")
def safe_names_out_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.line_blocks(spark, sf_dir).withColumn("file", F.concat(F.lit("a/b/"), "file", F.when(F.col("start") % 2 == 0, ":x?.pdf").otherwise(".pdf")))
    root = F.when(F.col("start") % 3 == 0, "root")
    made = blocks.with_block_count(rows)
    return made.select(F.col("file").alias("path"), "start", "end", "n_blocks", blocks.out_dir(F.col("file"), F.col("start"), F.col("end"), F.col("n_blocks"), root, F.lit("rel")).alias("out_dir"))


@query("text_norm", f"WITH {V.PAGES_SQL} SELECT doc_id, {V.sql_norm('text')} AS key FROM pages_")
def text_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.book_pages(spark, sf_dir).select("doc_id", T.norm(F.col("text")).alias("key"))


@query("block_status_counts", f"""WITH {V.BLOCKS_SQL}
SELECT CASE WHEN doc_id % 50 = 3 THEN 'invalid' WHEN done AND doc_id % 3 <> 2 THEN 'done' ELSE 'missing' END AS status, count(*) AS n FROM blocks GROUP BY 1""")
def block_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir)
    folder = F.concat(F.lit("out/"), F.col("doc_id").cast("string"))
    files = rows.where("done and doc_id % 3 <> 2").select(folder.alias("out_dir"), F.when(F.col("doc_id") % 2 == 0, "full.md").otherwise("a.json").alias("rel_path"))
    others = rows.select(folder.alias("out_dir"), F.lit("images/x.json").alias("rel_path"))
    asked = rows.select(F.when(F.col("doc_id") % 50 != 3, F.col("file")).alias("file"), "start", "end", F.when(F.col("doc_id") % 2 == 0, folder).alias("out_dir"), folder.alias("stored_dir"))
    return blocks.status_counts(asked, blocks.output_done(files.unionByName(others)))


@query("page_limit_filter", f"WITH {V.BLOCKS_SQL} SELECT doc_id, pages, pages > 100 AS dropped FROM blocks WHERE contains(lower(regexp_extract(file, '[^/]+$')), '7')")
def page_limit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.only(V.blocks(spark, sf_dir), "7").select("doc_id", "pages", (F.col("pages") > 100).alias("dropped"))


@query("pending_blocks", f"WITH {V.BLOCKS_SQL} SELECT doc_id, pages FROM blocks WHERE NOT done")
def pending_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir)
    done = rows.where("done").select("file", "start", "end")
    return rows.join(done, list(blocks.KEY), "left_anti").select("doc_id", "pages")


@query("html_scan", "SELECT DISTINCT url, regexp_replace(regexp_replace(lower(url), '^[a-z]+://', ''), '[/?#].*$', '') AS host FROM pages WHERE regexp_matches(lower(url), '\\.html?([?#]|$)')")
def html_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = V.table(spark, sf_dir, "pages").select("url").where(F.lower("url").rlike(r"\.html?([?#]|$)")).distinct()
    return found.select("url", F.regexp_replace(F.regexp_replace(F.lower("url"), "^[a-z]+://", ""), "[/?#].*$", "").alias("host"))


@query("artifact_lookup", f"""WITH files AS (SELECT 'o' || CAST(floor(doc_id / 4.0) AS INT) AS out_dir, CASE doc_id % 4 WHEN 0 THEN 'a.content_list.json' WHEN 1 THEN 'b_content_list.json' WHEN 2 THEN 'c_v2_content_list.json' ELSE 'content_list.json' END AS path FROM documents WHERE doc_id % 5 <> 1),
ranked AS (SELECT out_dir, path, row_number() OVER (PARTITION BY out_dir ORDER BY CASE WHEN path LIKE '%\\_content\\_list.json' ESCAPE '\\' THEN 0 WHEN path LIKE '%.content\\_list.json' ESCAPE '\\' THEN 1 ELSE 2 END, path) AS r FROM files WHERE path NOT LIKE '%\\_v2%' ESCAPE '\\')
SELECT out_dir, path FROM ranked WHERE r = 1""")
def artifact_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = V.table(spark, sf_dir, "documents").where("doc_id % 5 <> 1").select(
        F.expr("'o' || CAST(floor(doc_id / 4.0) AS INT)").alias("out_dir"),
        F.expr("CASE doc_id % 4 WHEN 0 THEN 'a.content_list.json' WHEN 1 THEN 'b_content_list.json' WHEN 2 THEN 'c_v2_content_list.json' ELSE 'content_list.json' END").alias("path"),
    )
    return inventory.find_artifact(files, inventory.CONTENT_LIST, exclude="_v2")


# ---- cleaning


@query("noise_keys", f"WITH {V.ELEMENTS_SQL}, {V.KEYS_SQL} SELECT * FROM keys")
def noise_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.noise_keys(V.elements(spark, sf_dir))


_NOISE = "(list_contains(ks, k) OR len(list_filter(ks, lambda y: length(y) >= 6 AND length(k) <= length(y) + 8 AND contains(k, y))) > 0)"
CLEAN_SQL = f"""{V.ELEMENTS_SQL}, {V.KEYS_SQL}, per AS (SELECT book_id, list(key) AS ks FROM keys GROUP BY book_id),
marked AS (SELECT e.doc_id, e.elem_no, e.text, {V.sql_strip('e.text')} AS s, {V.sql_norm('e.text')} AS k, coalesce(p.ks, []) AS ks FROM elements e LEFT JOIN per p USING (book_id)),
held AS (SELECT doc_id, elem_no, text, s = '```' AS bare FROM marked WHERE s = '' OR s LIKE '```%' OR NOT {_NOISE}),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY elem_no) AS r FROM held),
runs AS (SELECT *, r - row_number() OVER (PARTITION BY doc_id, bare ORDER BY r) AS run FROM placed),
sized AS (SELECT *, count(*) OVER (PARTITION BY doc_id, bare, run) AS n, row_number() OVER (PARTITION BY doc_id, bare, run ORDER BY r DESC) AS back FROM runs),
kept AS (SELECT * FROM sized WHERE NOT bare OR (n % 2 = 1 AND back = 1)),
texts AS (SELECT doc_id, string_agg(text, chr(10) ORDER BY r) AS clean_text, count(*) AS n_clean FROM kept GROUP BY doc_id),
cleaned AS (SELECT s.doc_id, s.book_id, coalesce(t.clean_text, '') AS clean_text, len(s.ls) AS n_lines, coalesce(t.n_clean, 0) AS n_clean, len(s.ls) - coalesce(t.n_clean, 0) AS n_removed FROM split_ s LEFT JOIN texts t USING (doc_id))"""


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(V.book_pages(spark, sf_dir), cleaning.noise_keys(V.elements(spark, sf_dir)))


@query("clean_lines", f"WITH {CLEAN_SQL} SELECT doc_id, clean_text FROM cleaned")
def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).select("doc_id", "clean_text")


@query("clean_stats", f"WITH {CLEAN_SQL} SELECT doc_id, n_lines, n_clean, n_removed FROM cleaned")
def clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).select("doc_id", "n_lines", "n_clean", "n_removed")


@query("clean_totals", f"""WITH {CLEAN_SQL} SELECT CASE WHEN doc_id % 8 = 0 THEN 'skipped' WHEN doc_id % 31 = 1 THEN 'failed' ELSE 'cleaned' END AS status, count(*) AS docs, CAST(sum(n_removed) AS BIGINT) AS removed FROM cleaned GROUP BY 1""")
def clean_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = cleaning.cleaning_status(F.col("doc_id") % 8 != 0, F.lit(True), F.when(F.col("doc_id") % 31 == 1, "broken"))
    return _cleaned(spark, sf_dir).groupBy(status.alias("status")).agg(F.count("*").alias("docs"), F.sum("n_removed").cast("long").alias("removed"))


# ---- gates

_CELLS = f"len(string_split(regexp_replace({V.sql_strip('l')}, '^\\||\\|$', '', 'g'), '|'))"
LINT_SQL = f"""{V.MARKDOWN_SQL}, md_lines AS (SELECT doc_id, text, {V.sql_lines('text')} AS ls FROM md),
ml AS (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM md_lines),
roles AS (SELECT doc_id, i, l, contains(l, '|') AS bar, ltrim(l) LIKE '```%' AS fence, {_CELLS} AS width, regexp_matches({V.sql_strip('l')}, '^[-:| ]+$') AND contains(l, '-') AND contains(l, '|') AS align FROM ml),
inside AS (SELECT *, sum(CASE WHEN fence THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) % 2 AS fenced FROM roles),
rows_ AS (SELECT * FROM inside WHERE bar AND NOT fence AND fenced = 0),
groups_ AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM rows_),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS r, lag(width) OVER (PARTITION BY doc_id, g ORDER BY i) AS before FROM groups_),
heads AS (SELECT doc_id, g, min(r) AS at, min_by(width, r) AS w FROM numbered WHERE r > 1 AND align AND width = before GROUP BY doc_id, g),
tables_ AS (SELECT n.doc_id, n.g, count(*) FILTER (WHERE n.r >= h.at AND n.width <> h.w) AS bad FROM numbered n JOIN heads h USING (doc_id, g) GROUP BY ALL),
per_doc AS (SELECT doc_id, count(*) FILTER (WHERE bad = 0) AS n_tables FROM tables_ GROUP BY doc_id),
line_counts AS (SELECT doc_id, count(*) FILTER (WHERE bar) AS n_pipe, count(*) FILTER (WHERE fence) AS n_fence, count(*) FILTER (WHERE {V.sql_strip('l')} LIKE '|%' AND contains(l, '--')) AS n_sep FROM roles GROUP BY doc_id),
linted AS (SELECT m.doc_id, coalesce(c.n_pipe, 0) AS n_pipe, coalesce(c.n_fence, 0) AS n_fence, coalesce(p.n_tables, 0) AS n_tables, {V.sql_count('m.text', "'�'")} AS n_bad, coalesce(c.n_sep, 0) AS n_sep, m.text FROM md m LEFT JOIN line_counts c USING (doc_id) LEFT JOIN per_doc p USING (doc_id)),
issues_ AS (SELECT *, CASE WHEN {V.sql_strip('text')} = '' THEN 'empty' ELSE array_to_string(list_filter([CASE WHEN length(text) < 100 THEN 'small' END, CASE WHEN n_bad > 5 THEN 'bad_characters' END, CASE WHEN n_pipe > 0 AND n_tables = 0 THEN 'table_unparsed' END, CASE WHEN n_fence % 2 = 1 THEN 'fence_odd' END], lambda x: x IS NOT NULL), ';') END AS issues FROM linted)"""


@query("md_lint_issues", f"WITH {LINT_SQL} SELECT doc_id, n_pipe, n_fence, n_tables, n_bad, n_sep, issues FROM issues_")
def md_lint_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.lint(V.markdown(spark, sf_dir))


@query("md_lint_fallback", f"""WITH {LINT_SQL} SELECT doc_id, CASE WHEN {V.sql_strip('text')} = '' THEN 'empty' ELSE array_to_string(list_filter([CASE WHEN length(text) < 100 THEN 'small' END, CASE WHEN n_bad > 5 THEN 'bad_characters' END, CASE WHEN n_pipe > 0 THEN 'table_unparsed' END, CASE WHEN n_fence % 2 = 1 THEN 'fence_odd' END], lambda x: x IS NOT NULL), ';') END AS issues FROM linted""")
def md_lint_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.lint(V.markdown(spark, sf_dir), with_tables=False).select("doc_id", "issues")


@query("table_separator_count", f"WITH {LINT_SQL} SELECT doc_id, n_sep FROM linted WHERE n_sep > 0")
def table_separator_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.lint(V.markdown(spark, sf_dir)).where("n_sep > 0").select("doc_id", "n_sep")


_DOUBLE = V.sql_count("text", "'$$'")
_REST = "replace(text, '$$', '')"
_SINGLE = f"({V.sql_count(_REST, chr(39) + '$' + chr(39))} - {V.sql_count(_REST, 'chr(92) || ' + chr(39) + '$' + chr(39))})"
_RUNS = r"len(list_filter(regexp_extract_all(text, '\\?\$+'), lambda x: x <> chr(92) || '$'))"


@query("latex_balance", f"""WITH {V.MARKDOWN_SQL}, c AS (SELECT doc_id, n_equations, {_DOUBLE} AS n_double, {_SINGLE} AS n_single, {_RUNS} AS n_runs FROM md)
SELECT *, CAST(floor(n_double / 2) * 2 + n_runs AS BIGINT) AS n_markers, n_double % 2 = 1 AS hard, n_single % 2 = 1 AND (n_equations > 0 OR n_double > 0) AS soft FROM c""")
def latex_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.latex(V.markdown(spark, sf_dir))


@query("content_consistency", f"WITH {V.MARKDOWN_SQL} SELECT doc_id, n_equations > 0 AND {_DOUBLE} < 2 AS formula_lost, n_images > 0 AND NOT contains(text, '![') AS image_lost FROM md")
def content_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.consistency(V.markdown(spark, sf_dir))


@query("image_ref_missing", rf"""WITH {V.MARKDOWN_SQL}, r AS (SELECT doc_id, regexp_extract_all(text, '!\[[^\]]*\]\(([^)]+)\)', 1) AS refs FROM md),
e AS (SELECT doc_id, unnest(refs) AS ref, generate_subscripts(refs, 1) - 1 AS pos FROM r)
SELECT doc_id, pos, ref FROM e WHERE ref NOT LIKE 'http%' AND NOT EXISTS (SELECT 1 FROM benchmark b WHERE 'images/' || b.item_id || '.png' = e.ref)""")
def image_ref_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.markdown(spark, sf_dir)
    stored = V.table(spark, sf_dir, "benchmark").select(F.concat(F.lit("images/"), F.col("item_id").cast("string"), F.lit(".png")).alias("ref"))
    owned = docs.where("doc_id % 5 = 0").select("doc_id", F.concat(F.lit("images/"), (F.col("doc_id") % 60).cast("string"), F.lit(".png")).alias("ref")).join(stored, "ref")
    return gates.missing_images(docs, owned)


@query("page_count_check", f"""WITH {V.BLOCKS_SQL}, c AS (SELECT *, slice_pages IS NULL AND content_pages IS NULL AS unreadable FROM blocks),
d AS (SELECT *, coalesce(kind = 'PDF' AND slice_pages <> "end" - start + 1, false) OR unreadable AS hard, coalesce(kind = 'PDF' AND content_pages < coalesce(slice_pages, "end" - start + 1) - 1, false) AS soft FROM c)
SELECT doc_id, hard AS pages_hard, soft AS pages_soft, concat_ws('; ', CASE WHEN unreadable THEN 'unreadable' END, CASE WHEN NOT unreadable AND hard THEN 'slice_pages' END, CASE WHEN soft THEN 'content_pages' END) AS pages_note FROM d""")
def page_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.page_count(V.blocks(spark, sf_dir)).select("doc_id", "pages_hard", "pages_soft", "pages_note")


@query("verify_output", f"""WITH {LINT_SQL}, own AS (SELECT m.doc_id, list_filter([CASE WHEN strlen(m.text) < 100 THEN 'small_bytes' END, CASE WHEN contains(substring(m.text, 1, 20000), 'images/') AND n_images = 0 THEN 'images_missing' END, CASE WHEN n_json < 2 THEN 'json_missing' END,
  CASE WHEN {V.sql_strip('substring(m.text, 1, 2000)')} = '' OR {V.sql_count('substring(m.text, 1, 2000)', "'�'")} > 5 THEN 'head_unreadable' END, CASE WHEN i.issues <> '' THEN i.issues END], lambda x: x IS NOT NULL) AS found FROM md m JOIN issues_ i USING (doc_id))
SELECT doc_id, array_to_string(found, ';') AS issues FROM own""")
def verify_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.verify_output(V.markdown(spark, sf_dir))


# ---- levels

L1_SQL = f"""{LINT_SQL}, {V.BLOCKS_SQL}, notes AS (SELECT b.doc_id, b.file, b.start, b."end", b.done, b.pos, i.issues, i.n_pipe,
  CASE WHEN NOT done THEN 1 ELSE 0 END + CASE WHEN i.issues LIKE '%fence_odd%' OR i.issues LIKE '%small%' OR i.issues LIKE '%bad_char%' OR i.issues = 'empty' THEN 1 ELSE 0 END + CASE WHEN (slice_pages IS NULL AND content_pages IS NULL) OR coalesce(kind = 'PDF' AND slice_pages <> "end" - start + 1, false) THEN 1 ELSE 0 END AS n_high,
  CASE WHEN i.issues LIKE '%table_unparsed%' THEN 1 ELSE 0 END + CASE WHEN coalesce(kind = 'PDF' AND content_pages < coalesce(slice_pages, "end" - start + 1) - 1, false) THEN 1 ELSE 0 END AS n_low FROM blocks b JOIN issues_ i USING (doc_id)),
queue AS (SELECT *, CASE WHEN n_high > 0 THEN 'high' ELSE 'low' END AS verdict FROM notes WHERE n_high + n_low > 0)"""


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first level: each block with its high and low problems."""
    linted = gates.lint(V.markdown(spark, sf_dir)).select("doc_id", "issues", "n_pipe")
    rows = gates.page_count(V.blocks(spark, sf_dir)).join(linted, "doc_id")
    bad = F.col("issues").rlike("fence_odd|small|bad_char|^empty$")
    problems = F.array_compact(F.array(F.when(~F.col("done"), "output"), F.when(bad, "md_lint"), F.when(F.col("pages_hard"), "pages")))
    low = F.array_compact(F.array(F.when(F.contains("issues", F.lit("table_unparsed")), F.format_string("发现 %d 行表格样式", "n_pipe")), F.when(F.col("pages_soft"), "pages")))
    rows = rows.withColumns({"problems": problems, "low_problems": low}).where((F.size("problems") > 0) | (F.size("low_problems") > 0))
    return rows.withColumn("verdict", review.verdict(F.col("problems")))


@query("l1_queue", f"WITH {L1_SQL} SELECT doc_id, verdict, n_high, n_low FROM queue")
def l1_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queue(spark, sf_dir).select("doc_id", "verdict", F.size("problems").alias("n_high"), F.size("low_problems").alias("n_low"))


@query("l1_summary", f"WITH {L1_SQL} SELECT count(*) AS blocks, count(*) FILTER (WHERE done) AS done, count(*) FILTER (WHERE NOT done) AS missing, count(*) FILTER (WHERE n_high > 0) AS flagged_high, count(*) FILTER (WHERE n_high = 0 AND n_low > 0) AS flagged_low FROM notes")
def l1_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = V.blocks(spark, sf_dir).agg(F.count("*").alias("blocks"), F.count_if("done").alias("done"), F.count_if(~F.col("done")).alias("missing"))
    flagged = _queue(spark, sf_dir).agg(F.count_if(F.col("verdict") == "high").alias("flagged_high"), F.count_if(F.col("verdict") == "low").alias("flagged_low"))
    return every.withColumn("one", F.lit(1)).join(F.broadcast(flagged.withColumn("one", F.lit(1))), "one").drop("one")  # one row each


@query("l2_targets", f"WITH {L1_SQL} SELECT doc_id, CAST(n_pipe AS INT) AS table_like FROM queue WHERE issues LIKE '%table_unparsed%' AND n_pipe >= 3")
def l2_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _queue(spark, sf_dir).withColumn("table_like", review.table_like(F.col("low_problems")))
    return review.dense_targets(rows, 3).select("doc_id", "table_like")


@query("table_low_conf", """WITH t AS (SELECT doc_id, 1 AS table_no, CAST(50 + doc_id % 50 AS DOUBLE) AS accuracy FROM documents UNION ALL SELECT doc_id, 2, CAST(60 + doc_id % 37 AS DOUBLE) FROM documents)
SELECT doc_id, count(*) AS n_low, string_agg(table_no || '(' || printf('%.1f', accuracy) || ')', ',' ORDER BY table_no) AS hint FROM t WHERE accuracy < 80 GROUP BY doc_id""")
def table_low_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.table(spark, sf_dir, "documents")
    tables = docs.select("doc_id", F.lit(1).alias("table_no"), F.expr("CAST(50 + doc_id % 50 AS DOUBLE)").alias("accuracy")).unionByName(docs.select("doc_id", F.lit(2).alias("table_no"), F.expr("CAST(60 + doc_id % 37 AS DOUBLE)").alias("accuracy")))
    return inventory.low_confidence(tables)


@query("formula_dense", f"WITH {V.MARKDOWN_SQL} SELECT doc_id, n_equations FROM md WHERE n_equations >= 20 ORDER BY n_equations DESC, doc_id LIMIT 10")
def formula_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.top_formula(V.markdown(spark, sf_dir).withColumn("pos", F.col("doc_id"))).select("doc_id", "n_equations")


@query("l3_targets", f"""WITH {L1_SQL}, top AS (SELECT doc_id FROM md WHERE n_equations >= 20 ORDER BY n_equations DESC, doc_id LIMIT 10)
SELECT b.file, CASE WHEN q.verdict = 'high' THEN 'high' ELSE 'formula' END AS priority FROM blocks b LEFT JOIN queue q USING (doc_id) WHERE q.verdict = 'high' OR b.doc_id IN (SELECT doc_id FROM top)""")
def l3_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir).join(V.markdown(spark, sf_dir).select("doc_id", "n_equations"), "doc_id")
    return review.review_targets(_queue(spark, sf_dir), rows).select("file", "priority")


@query("pick_pages", f"""WITH {V.BLOCKS_SQL}, p AS (SELECT doc_id, pages, CASE WHEN pages <= 3 THEN range(1, pages + 1) ELSE list_distinct([1, CAST(round_even((pages - 1) * 1 / 2.0, 0) AS BIGINT) + 1, pages]) END AS l FROM blocks)
SELECT doc_id, array_to_string(list_sort(l), ',') AS picked FROM p""")
def pick_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir).withColumn("all", F.sequence(F.lit(1), F.col("pages")))
    return rows.select("doc_id", F.array_join(slicing.pick(F.col("all"), 3), ",").alias("picked"))


@query("l3_plan_cost", f"WITH {V.BLOCKS_SQL} SELECT count(*) AS targets, CAST(sum(least(pages, 3)) AS BIGINT) AS pages, CAST(sum(least(pages, 3)) * 7 AS BIGINT) AS calls, CAST(sum(least(pages, 3)) * 6 AS BIGINT) AS max_calls FROM blocks WHERE NOT done")
def l3_plan_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir).where("not done").select(slicing.pick(F.sequence(F.lit(1), F.col("pages")), 3).alias("pages"))
    return review.plan_cost(rows)


@query("page_elements_top5", f"""WITH {V.ELEMENTS_SQL}, t AS (SELECT doc_id, page_idx, elem_no, CASE (doc_id + elem_no) % 5 WHEN 0 THEN 'equation' WHEN 1 THEN 'image' WHEN 2 THEN 'table' WHEN 3 THEN 'text' ELSE 'chart' END AS type FROM elements),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY elem_no) AS place FROM t WHERE type <> 'text')
SELECT doc_id, elem_no, type, place, CASE type WHEN 'equation' THEN 'formula' WHEN 'table' THEN 'table' ELSE 'figure' END AS prompt FROM r WHERE place <= 5""")
def page_elements_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.expr("CASE (doc_id + elem_no) % 5 WHEN 0 THEN 'equation' WHEN 1 THEN 'image' WHEN 2 THEN 'table' WHEN 3 THEN 'text' ELSE 'chart' END")
    return review.page_regions(V.elements(spark, sf_dir).withColumn("type", kind)).select("doc_id", "elem_no", "type", "place", "prompt")


_ANSWER = "CASE event_type WHEN 'error' THEN '有乱码，模糊' WHEN 'click' THEN '没有乱码' WHEN 'view' THEN '内容完整清晰' WHEN 'signup' THEN '不完整，截断' ELSE '空白页' END"
_HITS = lambda words: " + ".join(f"CAST(contains({_ANSWER}, '{w}') AS INT)" for w in words)


@query("sentiment", f"SELECT event_id, ({_HITS(review.NEGATIVE)}) > ({_HITS(review.POSITIVE)}) AS anomalous FROM events")
def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "events").select("event_id", review.anomalous(F.expr(_ANSWER)).alias("anomalous"))


_JUDGED = f"""CASE WHEN event_id % 101 = 0 OR event_id % 17 = 0 THEN 'fail' WHEN event_id % 13 = 0 OR event_id % 19 = 0 OR ({_HITS(review.NEGATIVE)}) > ({_HITS(review.POSITIVE)}) THEN 'suspicious' ELSE 'pass' END"""


def _page_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = V.table(spark, sf_dir, "events")
    error = F.when(F.col("event_id") % 101 == 0, "render")
    flag = lambda n: (F.col("event_id") % n == 0).cast("int")
    return events.select("event_id", "user_id", review.judge(error, flag(17), flag(13), flag(19), review.anomalous(F.expr(_ANSWER)).cast("int")).alias("verdict"))


@query("judge_page", f"SELECT event_id, {_JUDGED} AS verdict FROM events")
def judge_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_verdicts(spark, sf_dir).select("event_id", "verdict")


@query("block_verdict", f"""WITH p AS (SELECT user_id, CASE {_JUDGED} WHEN 'fail' THEN 2 WHEN 'suspicious' THEN 1 ELSE 0 END AS s FROM events)
SELECT CAST(user_id AS VARCHAR) AS basename, count(*) AS pages_reviewed, CASE max(s) WHEN 2 THEN 'fail' WHEN 1 THEN 'suspicious' ELSE 'pass' END AS verdict FROM p GROUP BY user_id""")
def block_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _page_verdicts(spark, sf_dir).select(F.col("user_id").cast("string").alias("basename"), F.lit(1).alias("start"), F.lit(9).alias("end"), "verdict")
    return review.block_verdicts(pages).select("basename", "pages_reviewed", "verdict")


_L3 = "CASE WHEN toxic = 1 THEN 'fail' WHEN quality = 0 THEN 'suspicious' ELSE 'pass' END"


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = V.table(spark, sf_dir, "labels").select("doc_id", F.expr(_L3).alias("verdict"))
    return V.blocks(spark, sf_dir).join(labels, "doc_id").select("file", "start", "end", "pos", T.basename(F.col("file")).alias("basename"), "verdict", F.array(F.array(F.lit("页数")), F.array(F.col("verdict"))).alias("reasons"))


@query("l3_resume_merge", f"""WITH {V.BLOCKS_SQL}, o AS (SELECT regexp_extract(b.file, '[^/]+$') AS basename, {_L3} AS verdict FROM blocks b JOIN labels l USING (doc_id) WHERE b.doc_id % 2 = 0),
n AS (SELECT regexp_extract(b.file, '[^/]+$') AS basename, 'pass' AS verdict FROM blocks b JOIN labels l USING (doc_id) WHERE b.doc_id % 3 = 0)
SELECT * FROM o UNION ALL SELECT * FROM n WHERE basename NOT IN (SELECT basename FROM o)""")
def l3_resume_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _results(spark, sf_dir)
    old, plan = rows.where("pos % 2 = 0"), rows.where("pos % 3 = 0")
    new = review.pending(plan, old).withColumn("verdict", F.lit("pass"))
    return review.merged_results(old.select(*new.columns), new.unionByName(plan.withColumn("verdict", F.lit("pass")).select(*new.columns))).select("basename", "verdict")


@query("rework_list", f"""WITH {L1_SQL}, f AS (SELECT b.file FROM blocks b JOIN labels l USING (doc_id) WHERE {_L3} = 'fail'),
h AS (SELECT file, concat_ws('; ', CASE WHEN NOT done THEN 'output' END, CASE WHEN issues LIKE '%fence_odd%' OR issues LIKE '%small%' OR issues LIKE '%bad_char%' OR issues = 'empty' THEN 'md_lint' END, CASE WHEN n_high - CASE WHEN NOT done THEN 1 ELSE 0 END - CASE WHEN issues LIKE '%fence_odd%' OR issues LIKE '%small%' OR issues LIKE '%bad_char%' OR issues = 'empty' THEN 1 ELSE 0 END > 0 THEN 'pages' END) AS reason FROM queue WHERE verdict = 'high')
SELECT file, reason FROM h UNION ALL SELECT file, '页数; fail' FROM f WHERE file NOT IN (SELECT file FROM h)""")
def rework_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.rework(_queue(spark, sf_dir), _results(spark, sf_dir)).select("file", "reason")


@query("rework_commands", f"WITH {V.BLOCKS_SQL} SELECT DISTINCT 'convert --mode cloud --complex --only \"' || regexp_replace(regexp_extract(file, '[^/]+$'), '\\.[^.]*$', '') || '\" --budget 999999' AS command FROM blocks WHERE NOT done")
def rework_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    stems = V.blocks(spark, sf_dir).where("not done").select(T.stem(F.col("file")).alias("stem")).distinct()
    return stems.select(F.format_string('convert --mode cloud --complex --only "%s" --budget 999999', "stem").alias("command"))


_PROBLEM = "CASE event_id % 8 WHEN 0 THEN 'md_lint: 大量乱码字符(9)' WHEN 1 THEN 'md_lint: 代码围栏数量为奇数(3)' WHEN 2 THEN 'full.md 缺失' WHEN 3 THEN '缺输出(full.md/json 均无)' WHEN 4 THEN 'camelot 低置信' WHEN 5 THEN '公式 $$ 不成对' WHEN 6 THEN '切片页数 3' ELSE 'other' END"
_CLASS = "CASE " + " ".join("WHEN " + " OR ".join(f"contains({_PROBLEM}, '{w}')" for w in words) + f" THEN '{name}'" for name, words in review.SPEC) + f" ELSE '{review.OTHER}' END"


@query("problem_class", f"SELECT user_id, string_agg(DISTINCT {_CLASS}, ',' ORDER BY {_CLASS}) AS items FROM events GROUP BY user_id")
def problem_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    problems = V.table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set(F.expr(_PROBLEM)).alias("problems"))
    return problems.select("user_id", F.array_join(review.spec_items(F.col("problems")), ",").alias("items"))


REPORT_SQL = f"""{L1_SQL}, reported AS (SELECT b.file, b.kind, q.verdict AS l1_verdict, coalesce(q.n_high, 0) AS n_problems, CASE WHEN b.doc_id % 6 = 0 THEN 2 ELSE 0 END AS n_l2_issues, CASE WHEN l.doc_id IS NOT NULL THEN {_L3} END AS l3_verdict FROM blocks b LEFT JOIN queue q USING (doc_id) LEFT JOIN labels l ON l.doc_id = b.doc_id),
coloured AS (SELECT *, CASE WHEN l3_verdict = 'fail' THEN 'fail' WHEN l3_verdict = 'pass' THEN 'pass' WHEN l3_verdict = 'suspicious' THEN 'review' WHEN l1_verdict = 'high' THEN 'fail' WHEN l1_verdict = 'low' THEN 'review' ELSE 'pass' END AS colour FROM reported)"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    l1 = _queue(spark, sf_dir).select(*blocks.KEY, "pos", "verdict", F.size("problems").alias("n_problems"))
    rows = V.blocks(spark, sf_dir)
    l2 = rows.where("doc_id % 6 = 0").select(*blocks.KEY, "pos", F.lit(2).alias("n_issues"))
    return review.report(rows.select(*blocks.KEY, "kind"), l1, l2, _results(spark, sf_dir))


@query("tri_color_report", f"WITH {REPORT_SQL} SELECT file, l1_verdict, n_problems, n_l2_issues, l3_verdict, l1_verdict IS NOT NULL AS l1_scanned, colour FROM coloured")
def tri_color_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select("file", "l1_verdict", "n_problems", "n_l2_issues", "l3_verdict", "l1_scanned", "colour")


@query("report_summary", f"WITH {REPORT_SQL} SELECT kind, colour, count(*) AS n FROM coloured GROUP BY ROLLUP (kind, colour)")
def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).rollup("kind", "colour").agg(F.count("*").alias("n"))


@query("content_pages", f"WITH {V.ELEMENTS_SQL} SELECT book_id AS doc_id, CAST(max(page_idx) + 1 AS INT) AS content_pages FROM elements GROUP BY book_id")
def content_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.content_pages(V.elements(spark, sf_dir).select(F.col("book_id").alias("doc_id"), "page_idx"))


@query("report_lines", f"""WITH {REPORT_SQL}, r AS (SELECT c.*, regexp_extract(file, '[^/]+$') AS basename, b.start, b."end", b.doc_id, q.issues FROM coloured c JOIN blocks b USING (file) LEFT JOIN issues_ q ON q.doc_id = b.doc_id),
f AS (SELECT *, ['- **' || basename || '** p' || start || '-' || "end" || ' [' || kind || ']']
  || CASE WHEN coalesce(issues, '') <> '' THEN list_transform(string_split(issues, ';'), lambda p: '  - ' || p) ELSE [] END
  || CASE WHEN n_l2_issues > 0 THEN ['  - L2: a; b'] ELSE [] END
  || CASE WHEN l3_verdict IS NOT NULL THEN ['  - L3: ' || l3_verdict || ' - ' || CASE WHEN doc_id % 2 = 0 THEN 'r1; r2; r3; r4; r5' ELSE '' END] ELSE [] END AS lines FROM r WHERE colour = 'fail'),
n AS (SELECT count(*) FILTER (WHERE colour = 'pass') AS p, count(*) FILTER (WHERE colour = 'fail') AS x, count(*) FILTER (WHERE colour = 'review') AS v FROM r),
h AS (SELECT ['{sinks.REPORT_TITLE}', '', '## 总览（三色）', '', '| 分类 | 数量 | 含义 |', '|---|---|---|', replace('{sinks.REPORT_HEADS["pass"]}', '{{}}', CAST(p AS VARCHAR)), replace('{sinks.REPORT_HEADS["fail"]}', '{{}}', CAST(x AS VARCHAR)), replace('{sinks.REPORT_HEADS["review"]}', '{{}}', CAST(v AS VARCHAR)), ''] || CASE WHEN x > 0 THEN ['{sinks.REPORT_FAIL}', ''] ELSE [] END AS top, CASE WHEN v > 0 THEN ['{sinks.REPORT_REVIEW}', '', '共 ' || v || ' 块', ''] ELSE [] END AS low FROM n)
SELECT 0 AS section, NULL AS basename, NULL AS start, NULL AS "end", CAST(generate_subscripts(top, 1) - 1 AS INT) AS no, unnest(top) AS line FROM h
UNION ALL SELECT 1, basename, start, "end", CAST(generate_subscripts(lines, 1) - 1 AS INT), unnest(lines) FROM f
UNION ALL SELECT 2, NULL, NULL, NULL, CAST(generate_subscripts(low, 1) - 1 AS INT), unnest(low) FROM h""")
def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir).select(*blocks.KEY, "doc_id")
    issues = gates.lint(V.markdown(spark, sf_dir)).select("doc_id", "issues")
    none = F.array().cast("array<string>")
    report = _report(spark, sf_dir).join(rows, list(blocks.KEY)).join(issues, "doc_id")
    made = report.select(
        *[T.basename(F.col("file")).alias("basename"), "start", "end", "kind", "colour", "l3_verdict"],
        F.when(F.col("issues") != "", F.split("issues", ";")).otherwise(none).alias("problems"),
        F.when(F.col("doc_id") % 6 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(none).alias("l2_issues"),
        F.when(F.col("doc_id") % 2 == 0, F.array(*[F.lit(f"r{i}") for i in range(1, 8)])).otherwise(none).alias("l3_reasons"),
        none.alias("spec_items"),
    )
    return sinks.report_markdown(made)
