"""The levels of review: queue, targets, page verdicts, roll-ups, rework and the report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .blocks import KEY, first_wins

# Words of a reviewer's answer, and the words that name a kind of problem, in this order.
NEGATIVE = ("异常", "乱码", "截断", "错位", "丢失", "不是表格", "失真", "模糊", "缺失", "损坏", "空白", "不完整", "无法辨认")
POSITIVE = ("正常", "清晰", "完整", "可读", "结构正常", "无", "没有", "清晰可读")
SPEC = (
    ("OCR 错别字", ("乱码", "错别字")),
    ("表格结构", ("表格", "camelot", "低置信", "列数")),
    ("公式 LaTeX", ("公式", "LaTeX", "$ ", "$$")),
    ("标题层级", ("md_lint",)),
    ("图片引用", ("图片引用", "缺失")),
    ("每页内容", ("页数", "切片", "内容覆盖", "缺输出", "空白")),
)
OTHER = "其他"
CALLS_PER_PAGE, REGIONS = 7, 5
# What a reviewer is asked about a region of a type (None: any other), and about a whole page.
PROMPTS = {
    "equation": "这是PDF中一个公式区域。请识别该公式的数学表达式，判断：1)公式是否完整无截断 2)是否有乱码 3)能否辨认清楚。",
    "table": "这是PDF中一个表格区域。请判断：1)表格结构是否完整对齐 2)行列是否清晰 3)是否有明显错位或乱码。",
    "image": "这是PDF中一张图片/图表。请描述内容，判断：1)图片是否清晰完整 2)是否有明显失真或截断。",
    "chart": "这是PDF中一张图片/图表。请描述内容，判断：1)图片是否清晰完整 2)是否有明显失真或截断。",
    "page": "这是PDF完整一页。请判断：1)整体布局是否正常(无大面积空白/错乱) 2)是否有明显的内容丢失或乱码 3)标题/正文/图表是否结构正常。",
    None: "请描述该区域内容并判断是否清晰可读。",
}
REGION_TYPES = ("equation", "image", "table", "chart")
SEVERITY = ("pass", "suspicious", "fail")


def verdict(problems: Column) -> Column:
    return F.when(F.size(problems) > 0, "high").otherwise("low")


def table_like(low_problems: Column) -> Column:
    """Rows that look like tables, as the messages say; a message without a number counts as one."""
    said = F.filter(low_problems, lambda x: F.contains(x, F.lit("表格样式")))
    return F.aggregate(F.transform(said, lambda x: F.coalesce(F.regexp_extract(x, r"发现 *(\d+) *行", 1).try_cast("int"), F.lit(1))), F.lit(0), lambda a, x: a + x)


def dense_targets(queue: DataFrame, least: int = 10) -> DataFrame:
    """Blocks with many table rows, the most first."""
    return queue.where(F.col("table_like") >= least).orderBy(F.desc("table_like"), "pos")


def top_formula(blocks: DataFrame, most: int = 10, least: int = 20) -> DataFrame:
    """The blocks with most formulas, at least ``least`` each; ``most`` 0 means all. A bounded top-k, not a full sort."""
    dense = blocks.where(F.col("n_equations") >= least).orderBy(F.desc("n_equations"), "pos")
    return dense.limit(most) if most else dense


def review_targets(queue: DataFrame, blocks: DataFrame, most: int = 10, least: int = 20) -> DataFrame:
    """High blocks, then the formula-dense ones that are not among them."""
    high = queue.where("verdict = 'high'").select(*KEY, "pos", F.lit(0).alias("rank"), F.lit("high").alias("priority"))
    dense = top_formula(blocks, most, least).select(*KEY, "pos", F.lit(1).alias("rank"), F.lit("formula").alias("priority"))
    return first_wins(high.unionByName(dense), KEY, "rank", "pos").drop("rank")


def plan_cost(plan: DataFrame) -> DataFrame:
    return plan.agg(F.count("*").alias("targets"), F.coalesce(F.sum(F.size("pages")), F.lit(0)).cast("long").alias("pages")).withColumn("calls", F.col("pages") * CALLS_PER_PAGE).withColumn("max_calls", F.col("pages") * (REGIONS + 1))


def page_regions(elements: DataFrame, most: int = REGIONS) -> DataFrame:
    """The first regions of each page (doc_id, page_idx, elem_no, type, y0) that a reviewer sees, with their question."""
    place = F.row_number().over(Window.partitionBy("doc_id", "page_idx").orderBy("elem_no"))
    found = elements.where(F.col("type").isin(*REGION_TYPES) & F.col("y0").isNotNull()).withColumn("place", place).where(F.col("place") <= most)
    prompt = F.when(F.col("type") == "equation", "formula").when(F.col("type").isin("table"), "table").otherwise("figure")
    return found.withColumn("prompt", prompt)


def question(kind: Column) -> Column:
    """The text of the question about a region of this type, or about the page."""
    texts = F.create_map(*[F.lit(x) for k, v in PROMPTS.items() if k for x in (k, v)])
    return F.coalesce(texts[kind], F.lit(PROMPTS[None]))


def anomalous(answer: Column) -> Column:
    """More negative than positive words occur in the answer, each counted once."""
    hits = lambda words: reduce(lambda a, b: a + b, [F.contains(answer, F.lit(w)).cast("int") for w in words])
    return hits(NEGATIVE) > hits(POSITIVE)


def judge(error: Column, n_hard: Column, n_soft: Column, n_failed: Column, n_anomalous: Column) -> Column:
    """A page fails on an error or a hard finding and is suspicious on anything else."""
    return F.when(error.isNotNull() | (n_hard > 0), "fail").when((n_soft > 0) | (n_failed > 0) | (n_anomalous > 0), "suspicious").otherwise("pass")


def severity(column: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), column) - 1


def block_verdicts(pages: DataFrame) -> DataFrame:
    """The worst verdict of each block's pages (basename, start, end, verdict)."""
    worst = pages.groupBy("basename", "start", "end").agg(F.max(severity(F.col("verdict"))).alias("worst"), F.count("*").alias("pages_reviewed"))
    return worst.select("basename", "start", "end", F.get(F.array(*[F.lit(s) for s in SEVERITY]), F.col("worst").cast("int")).alias("verdict"), "pages_reviewed")


def pending(plan: DataFrame, results: DataFrame) -> DataFrame:
    return plan.join(results.select("basename", "start", "end").distinct(), ["basename", "start", "end"], "left_anti")


def merged_results(old: DataFrame, new: DataFrame, latest: bool = False) -> DataFrame:
    """Old and new results; the old one of a block stays, or with ``latest`` the new one does."""
    ranked = old.withColumn("generation", F.lit(1 if latest else 0)).unionByName(new.withColumn("generation", F.lit(0 if latest else 1)))
    return first_wins(ranked, ("basename", "start", "end"), "generation", "pos").drop("generation")


def problem_class(problem: Column) -> Column:
    """The first kind, in order, one of whose words occurs."""
    found = F.lit(OTHER)
    for name, words in reversed(SPEC):
        found = F.when(reduce(lambda a, b: a | b, [F.contains(problem, F.lit(w)) for w in words]), name).otherwise(found)
    return found


def spec_items(problems: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(problems, problem_class)))


# The reasons of blocks that tell none.
NO_PROBLEM, NO_REASON = "L1 高优先", "L3 fail"


def rework(queue: DataFrame, results: DataFrame) -> DataFrame:
    """Blocks to convert again: high ones of the queue, then failed ones of the review, each once with its reason."""
    high = queue.where("verdict = 'high'").select(*KEY, F.lit(0).alias("rank"), "pos", F.coalesce(F.nullif(F.array_join("problems", "; "), F.lit("")), F.lit(NO_PROBLEM)).alias("reason"))
    fail = results.where("verdict = 'fail'").select(*KEY, F.lit(1).alias("rank"), "pos", F.coalesce(F.nullif(F.array_join(F.flatten("reasons"), "; "), F.lit("")), F.lit(NO_REASON)).alias("reason"))
    return first_wins(high.unionByName(fail), KEY, "rank", "pos").drop("rank")


def colour(l3: Column, l1: Column) -> Column:
    return F.when(l3 == "fail", "fail").when(l3 == "pass", "pass").when(l3 == "suspicious", "review").when(l1 == "high", "fail").when(l1 == "low", "review").otherwise("pass")


def report(blocks: DataFrame, l1: DataFrame, l2: DataFrame, l3: DataFrame) -> DataFrame:
    """Each block with the last entry of each level and its colour; the right sides are reduced before they are joined."""
    last = lambda df, name, *cols: df.groupBy(*KEY).agg(F.max_by(F.struct(*cols), "pos").alias(name))
    joined = blocks.join(last(l1, "l1", "verdict", "n_problems"), list(KEY), "left").join(last(l2, "l2", "n_issues"), list(KEY), "left").join(last(l3, "l3", "verdict"), list(KEY), "left")
    return joined.select(
        *blocks.columns,
        F.col("l1.verdict").alias("l1_verdict"),
        F.coalesce("l1.n_problems", F.lit(0)).alias("n_problems"),
        F.coalesce("l2.n_issues", F.lit(0)).alias("n_l2_issues"),
        F.col("l3.verdict").alias("l3_verdict"),
        F.col("l1").isNotNull().alias("l1_scanned"),
        colour(F.col("l3.verdict"), F.col("l1.verdict")).alias("colour"),
    )
