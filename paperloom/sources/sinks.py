"""Writing results: a new version each time, never over what is being read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_version(rows: DataFrame, path: str, version: int) -> str:
    """Parquet under ``path``/v<version>; earlier versions are the backup."""
    out = f"{path}/v{version:06d}"
    rows.write.mode("errorifexists").parquet(out)
    return out


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def append_new(rows: DataFrame, known: DataFrame, path: str, key: list[str]) -> None:
    """Append the rows whose key is not known yet."""
    rows.join(known.select(*key).distinct(), key, "left_anti").write.mode("append").json(path)


# The report's headings and the meaning of its colours.
REPORT_TITLE = "# document-to-markdown 转写质检报告"
REPORT_HEADS = {"pass": "| ✅ 放心 | {} | L1 干净 |", "fail": "| 🔧 返工 | {} | L1高优先/L3 fail，需重转 |", "review": "| ⚠️ 误报/候选 | {} | L1低优先/L3存疑，需复审 |"}
REPORT_FAIL, REPORT_REVIEW = "## 🔧 返工清单（需重转）", "## ⚠️ 误报/候选清单（需复审，多为表格启发式）"
REPORT_REASONS = 5


def report_markdown(report: DataFrame) -> DataFrame:
    """The report as lines of Markdown (section, basename, start, end, no, line), to be read in this order.

    ``report`` has basename, start, end, kind, colour and the lists problems, l2_issues, l3_reasons, spec_items, and l3_verdict.
    Section 0 is the summary, 1 the blocks to convert again, one after the other with what speaks against them, 2 how many are to
    be looked at. Blocks make their lines in their row; only the three counts meet.
    """
    counts = report.groupBy("colour").agg(F.count("*").alias("n"))
    one = counts.agg(*[F.coalesce(F.max(F.when(F.col("colour") == c, F.col("n"))), F.lit(0)).alias(c) for c in REPORT_HEADS])
    table = [F.concat(F.lit(h.split("{}")[0]), F.col(c).cast("string"), F.lit(h.split("{}")[1])) for c, h in REPORT_HEADS.items()]
    head = [F.lit(x) for x in (REPORT_TITLE, "", "## 总览（三色）", "", "| 分类 | 数量 | 含义 |", "|---|---|---|")]
    later = F.when(F.col("review") > 0, F.array(F.lit(REPORT_REVIEW), F.lit(""), F.format_string("共 %d 块", F.col("review")), F.lit(""))).otherwise(F.array().cast("array<string>"))
    first = F.when(F.col("fail") > 0, F.array(F.lit(REPORT_FAIL), F.lit(""))).otherwise(F.array().cast("array<string>"))
    place = [F.lit(None).cast(report.schema[c].dataType).alias(c) for c in ("basename", "start", "end")]
    frame = lambda section, lines: one.select(F.lit(section).alias("section"), *place, F.posexplode(lines).alias("no", "line"))
    item = F.format_string("- **%s** p%d-%d [%s]", "basename", "start", "end", "kind")
    listed = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    third = F.format_string("  - L3: %s - %s", "l3_verdict", F.array_join(F.slice(listed("l3_reasons"), 1, REPORT_REASONS), "; "))
    lines = F.concat(
        F.array(item),
        F.transform(listed("problems"), lambda p: F.concat(F.lit("  - "), p)),
        F.when(F.size(listed("l2_issues")) > 0, F.array(F.concat(F.lit("  - L2: "), F.array_join(listed("l2_issues"), "; ")))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("l3_verdict").isNotNull(), F.array(third)).otherwise(F.array().cast("array<string>")),
        F.when(F.size(listed("spec_items")) > 0, F.array(F.concat(F.lit("  - 对应检查项: "), F.array_join(listed("spec_items"), ", ")))).otherwise(F.array().cast("array<string>")),
    )
    failed = report.where("colour = 'fail'").select(F.lit(1).alias("section"), "basename", "start", "end", F.posexplode(lines).alias("no", "line"))
    return frame(0, F.concat(F.array(*head, *table, F.lit("")), first)).unionByName(failed).unionByName(frame(2, later))


def write_report(report: DataFrame, path: str) -> None:
    """``report_markdown`` as text below ``path``: its files, in order of their names, are the report."""
    order = ["section", "basename", "start", "end", "no"]
    report_markdown(report).repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.text(path)


def write_cleaned(cleaned: DataFrame, path: str, version: int, dry_run: bool = False) -> DataFrame:
    """Cleaned texts (doc_id, clean_text, n_removed) as a new version, and what was removed: one row (docs, removed).

    A dry run writes nothing and reports the same; the report of a real run is taken from what was written.
    """
    rows = cleaned if dry_run else cleaned.sparkSession.read.parquet(write_version(cleaned, path, version))
    return rows.agg(F.count_if(F.col("n_removed") > 0).alias("docs"), F.coalesce(F.sum("n_removed"), F.lit(0)).alias("removed"))


#: Rows that one text of ``json_envelope`` holds at most.
ENVELOPE_ROWS = 10_000


def json_envelope(rows: DataFrame, name: str, most: int = ENVELOPE_ROWS) -> DataFrame:
    """Texts (an object with ``count`` and the rows under ``name``) of ``most`` rows each: parts of a queue or of results, so that no
    task and no row holds all of them. Rows of a part lie together already, so little is exchanged but the parts."""
    # The upper bits of the number are the partition, the lower ones count within it.
    number = F.monotonically_increasing_id()
    whole = F.struct(F.count("*").alias("count"), F.collect_list(F.struct(*rows.columns)).alias(name))
    parts = rows.withColumn("__part", F.struct(F.shiftright(number, 33).alias("p"), F.floor(number.bitwiseAND(F.lit((1 << 33) - 1)) / most).alias("n")))
    return parts.groupBy("__part").agg(F.to_json(whole).alias("value")).select("value")
