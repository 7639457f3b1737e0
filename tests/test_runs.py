"""The composed runs on small inputs with known results."""

import pytest
from pyspark.sql import functions as F

from paperloom.operators import plugins, runs
from paperloom.sources import files, sinks


def test_plan_leaves_out_what_cannot_be_read(spark):
    none = F.array().cast("array<int>")
    docs = spark.createDataFrame([("in/a.pdf", 45), ("in/b.pdf", None), ("in/c.pdf", 0), ("in/x/d.docx", None)], "path string, total int")
    docs = docs.withColumns({"root": F.lit("in"), "toc1": F.array(F.lit(11), F.lit(31)), "toc2": none, "headings": none})
    got = [tuple(r) for r in runs.plan_blocks(docs, 20).orderBy("file", "start").collect()]
    assert got == [("in/a.pdf", "PDF", 1, 10, 10, ""), ("in/a.pdf", "PDF", 11, 29, 19, ""), ("in/a.pdf", "PDF", 30, 45, 16, ""), ("in/x/d.docx", "DOC", 1, 1, 1, "x")]
    with pytest.raises(ValueError, match="nothing"):
        runs.required(runs.plan_blocks(docs.where("path like 'in/b%'"), 20), "nothing to plan")


def test_guards():
    assert runs.not_negative("limit", None) is None
    with pytest.raises(ValueError, match="limit"):
        runs.not_negative("limit", -1)


def test_limit_comes_before_resume(spark):
    plan = spark.createDataFrame([("a", 1, 2, 0, [1]), ("b", 1, 2, 1, [1, 2]), ("c", 1, 2, 2, [1])], "basename string, start int, end int, pos int, pages array<int>")
    done = plan.where("basename = 'a'").select("basename", "start", "end")
    tries = [("b", 1, 2, 1, 1, "x", None, None), ("b", 1, 2, 1, 2, None, "pass", []), ("b", 1, 2, 2, 1, "x", None, None), ("b", 1, 2, 2, 2, "y", None, None), ("b", 1, 2, 2, 3, "z", None, None), ("b", 1, 2, 2, 4, None, "pass", [])]
    attempts = spark.createDataFrame(tries, "basename string, start int, end int, page int, attempt int, error string, verdict string, reasons array<string>")
    pages = {r["page"]: (r["verdict"], list(r["reasons"])) for r in runs.page_verdicts(attempts).collect()}
    assert pages == {1: ("pass", []), 2: ("fail", ["视觉重试3轮仍失败: z"])}
    got = runs.third_level(plan, done, attempts, limit=2).collect()
    assert [(r["basename"], r["verdict"], r["pages_reviewed"]) for r in got] == [("b", "fail", 2)]


def test_conversions_stop(spark):
    blocks = spark.createDataFrame([(f"f{i}", 1, 1, 1 + i // 3, f"o{i}", 0) for i in range(6)], "file string, start int, end int, day int, out_dir string, complex int")
    some = lambda schema: spark.createDataFrame([], schema)
    outcomes = blocks.select("file", "start", "end", (F.col("file") != "f1").alias("ok"), F.lit("").alias("message"))
    steps = runs.convert_steps(blocks, blocks.select("file"), some("out_dir string, done boolean"), some("file string, reasons string"), outcomes, most=3, check_every=2)
    assert [r["status"] for r in steps.orderBy("step").collect()] == ["ok", "failed", "ok", "ok", "not_reached", "not_reached"]
    assert tuple(runs.progress(steps, pause=True).first()) == (3, 4, 1, "Day1-3")
    assert tuple(runs.progress(steps.limit(0)).first()) == (0, 0, 0, None)


def test_retries():
    waits, calls = [], []

    def late():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError
        return "ok"

    assert plugins.with_retries(late, sleep=waits.append) == "ok" and waits == [3.0, 6.0]
    with pytest.raises(TimeoutError):
        plugins.with_retries(lambda: (_ for _ in ()).throw(TimeoutError()), sleep=waits.append)
    with pytest.raises(ValueError):
        plugins.with_retries(lambda: (_ for _ in ()).throw(ValueError()), sleep=lambda _: pytest.fail("waited"))


def test_dry_run_tells_what_a_run_does(spark, tmp_path):
    cleaned = spark.createDataFrame([(1, "a", 2), (2, "b", 0), (3, "", 1)], "doc_id long, clean_text string, n_removed int")
    dry = tuple(sinks.write_cleaned(cleaned, str(tmp_path / "out"), 1, dry_run=True).first())
    assert not (tmp_path / "out").exists()
    assert dry == tuple(sinks.write_cleaned(cleaned, str(tmp_path / "out"), 1).first()) == (2, 3)


def test_envelopes(spark):
    rows = spark.createDataFrame([("a.pdf", 1, 2, "high", ["x"])], "file string, start int, end int, verdict string, problems array<string>")
    back = files.queue(sinks.json_envelope(rows, "queue").unionByName(spark.createDataFrame([("{",), ("[]",)], "value string")))
    assert [tuple(r)[1:] for r in back.collect()] == [("a.pdf", 1, 2, "high", ["x"])]


def test_engines_get_bounded_frames(spark, monkeypatch):
    """One partition's rows reach an engine in frames of bounded rows and bytes, each row once and in turn; nulls stay."""

    def sizes(rows):
        return rows.assign(n=len(rows), chars=int(rows["text"].str.len().sum()))[["doc_id", "n", "chars"]]

    monkeypatch.setitem(plugins.REGISTRY, "sizes", (sizes, "doc_id long, n int, chars long"))
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "CASE WHEN id % 7 <> 0 THEN repeat('x', IF(id > 2900, 100000, 10)) END AS text")
    got = plugins.call("sizes", docs).collect()
    assert [r["doc_id"] for r in got] == list(range(3000))
    assert max(r["n"] for r in got) <= plugins.ROWS and max(r["chars"] for r in got) <= plugins.BYTES
    few = spark.createDataFrame([(None, "a\nlorem b"), (5, None), (6, "lorem"), (7, "")], "doc_id long, text string").coalesce(1)
    assert [tuple(r) for r in plugins.call("clean", few).collect()] == [(None, True, "a"), (5, False, None), (6, False, "lorem"), (7, False, "")]
