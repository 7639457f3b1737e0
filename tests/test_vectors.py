"""Small inputs with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.operators import assembly, blocks, cleaning, gates, inventory, review, slicing
from paperloom.sources import files, sinks
from paperloom.streaming import state


def one(spark, expr, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return frame.select(expr.alias("x")).first()[0]


def element_rows(n, kind, text, y0, y1):
    return [(1, kind, text, float(y0), float(y1), 1000.0)] * n


@pytest.mark.parametrize(
    ("rows", "key"),
    [
        (element_rows(5, "text", "some running head", 20, 40), "somerunninghead"),
        (element_rows(5, "text", "some running head", 500, 520), None),
        (element_rows(5, "text", "some running head", 940, 960), None),
        (element_rows(5, "footer", "page footer", 0, 0), "pagefooter"),
        (element_rows(5, "footer", "对", 0, 0), None),
        (element_rows(5, "text", "some running head", 1390, 1420), None),
        (element_rows(3, "text", "some running head", 500, 520) + element_rows(1, "text", "some running head", 20, 40), None),
        (element_rows(3, "header", "only three", 0, 0), "onlythree"),
        (element_rows(3, "aside_text", "beside it", 0, 0), None),
        (element_rows(4, "aside_text", "beside it", 0, 0), "besideit"),
        (element_rows(5, "header", "欢迎加入QQ群123456免费领500本书", 0, 0), "欢迎加入qq群123456免费领500本书"),
    ],
)
def test_noise_keys(spark, rows, key):
    elements = spark.createDataFrame(rows, "book_id int, type string, text string, y0 double, y1 double, height double")
    assert [r["key"] for r in cleaning.noise_keys(elements).collect()] == ([key] if key else [])


def cleaned(spark, text, keys=("watermarkline",)):
    pages = spark.createDataFrame([(1, 1, text)], "doc_id int, book_id int, text string")
    return cleaning.clean(pages, spark.createDataFrame([(1, k) for k in keys], "book_id int, key string")).first()


def test_clean(spark):
    got = cleaned(spark, "\n".join(["Watermark line"] * 5 + ["body"]))
    assert (got["clean_text"], got["n_lines"], got["n_removed"]) == ("body", 6, 5)
    assert cleaned(spark, got["clean_text"])["n_removed"] == 0
    assert cleaned(spark, "```\nwatermark line\n```\n正文内容")["clean_text"] == "正文内容"
    assert cleaned(spark, "")["n_removed"] == 0 and cleaned(spark, None)["n_lines"] == 0
    for k in range(1, 6):
        assert cleaned(spark, "a\n" + "```\n" * k + "b")["clean_text"].count("```") == k % 2
    assert cleaned(spark, "my abcde line", keys=("abcde",))["n_removed"] == 0
    assert cleaned(spark, "my abcdef line", keys=("abcdef",))["n_removed"] == 1
    assert cleaned(spark, "my abcdef and much more", keys=("abcdef",))["n_removed"] == 0


def test_lines(spark):
    assert one(spark, T.lines(F.lit("a\r\nb\rc\x0bd\u2028e\n"))) == ["a", "b", "c", "d", "e"]
    assert one(spark, T.lines(F.lit(""))) == [] and one(spark, T.lines(F.lit("\n"))) == [""]


def cuts(spark, total, candidates, most=200):
    got = one(spark, slicing.chapter_cuts(F.lit(total), F.lit(candidates).cast("array<int>") if candidates else F.array().cast("array<int>"), most))
    return got and [(r["start"], r["end"]) for r in got]


@pytest.mark.parametrize(
    ("total", "candidates", "want"),
    [
        (300, [], None),
        (300, [1, 1], None),
        (100, [500, 600], None),
        (400, [50, 150, 190, 250], [(1, 189), (190, 249), (250, 400)]),
        (400, [150], [(1, 149), (150, 348), (349, 400)]),
        (500, [30, 180, 350], [(1, 179), (180, 349), (350, 500)]),
        (600, [10, 20, 399, 401], [(1, 19), (20, 218), (219, 400), (401, 600)]),
    ],
)
def test_chapter_cuts(spark, total, candidates, want):
    got = cuts(spark, total, candidates)
    assert got == want
    if got:
        assert sum(b - a + 1 for a, b in got) == total and all(b - a < 200 for a, b in got)
        assert all(got[i][1] + 1 == got[i + 1][0] for i in range(len(got) - 1))


def test_hard_and_routed_cuts(spark):
    hard = lambda n: [(r["start"], r["end"]) for r in one(spark, slicing.hard_cuts(F.lit(n), 200))]
    assert hard(400) == [(1, 200), (201, 400)] and hard(450)[-1] == (401, 450) and hard(1) == [(1, 1)]
    arr = lambda *x: F.array(*[F.lit(i) for i in x]).cast("array<int>")
    routed = lambda n, a, b, c: [(r["start"], r["end"]) for r in one(spark, slicing.routed_cuts(F.lit(n), a, b, c))]
    assert routed(150, arr(), arr(), arr()) == [(1, 150)] == routed(150, arr(1, 50), arr(), arr())
    assert routed(300, arr(1, 150, 260), arr(), arr())[:2] == [(1, 149), (150, 300)]
    assert routed(300, arr(1), arr(120, 240), arr())[0] == (1, 119)
    assert routed(300, arr(), arr(), arr(141))[0] == (1, 140)
    assert routed(300, arr(), arr(), arr()) == [(1, 200), (201, 300)]
    with pytest.raises(ValueError, match="two pages"):
        slicing.chapter_cuts(F.lit(3), arr(2), 1)


def test_heading_median(spark):
    spans = spark.createDataFrame([("f", 1, float(s)) for s in (10, 10, 16, 24)], "file string, page int, size double")
    got = slicing.heading_pages(spans).first()
    assert (got["median"], got["heading"]) == (16.0, False)


def test_pick(spark):
    pick = lambda n, k: one(spark, slicing.pick(F.sequence(F.lit(0), F.lit(n - 1)), k))
    assert [pick(n, 3) for n in (4, 6, 8, 11)] == [[0, 2, 3], [0, 2, 5], [0, 4, 7], [0, 5, 10]]
    assert pick(9, 1) == [0] and pick(2, 3) == [0, 1]


def test_packing(spark):
    rows = [("q", i, str(i), 1, 1, p, False) for i, p in enumerate([4, 5, 3, 12, 1])]
    queue = spark.createDataFrame(rows, "queue string, pos int, file string, start int, end int, pages int, done boolean")
    assert [r["day"] for r in blocks.day_plan(queue, "queue", "pos", budget=10).orderBy("pos").collect()] == [1, 1, 2, 3, 4]
    assert sorted(r["pages"] for r in blocks.page_budget(queue, "queue", "pos", budget=10).collect()) == [1, 4, 5]


LINT = {
    "| a | b |\n|---|---|\n| 1 | 2 |\n```\ncode\n```\n" + "text " * 30: "",
    "| a | b |\n|---|---|\n| 1 | 2 | 3 |\n" + "text " * 30: "table_unparsed",
    "```\ncode\n" + "text " * 30: "fence_odd",
    "": "empty",
    "plain text " * 50: "",
    "short": "small",
}


@pytest.mark.parametrize("text", list(LINT))
def test_lint(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    assert gates.lint(docs).first()["issues"] == LINT[text]


@pytest.mark.parametrize(
    ("text", "n", "want"),
    [("$$x", 0, (True, False)), ("a $x b", 0, (False, False)), ("a $x b", 1, (False, True)), ("\\$5 and $6", 1, (False, True)), ("$$x$$", 0, (False, False))],
)
def test_latex(spark, text, n, want):
    got = gates.latex(spark.createDataFrame([(1, text, n)], "doc_id int, text string, n_equations int")).first()
    assert (got["hard"], got["soft"]) == want
    if text == "$$x$$":
        assert got["n_markers"] == 4


def test_consistency(spark):
    rows = spark.createDataFrame([(1, "plain", 2, 1)], "doc_id int, text string, n_equations int, n_images int")
    got = gates.consistency(rows).first()
    assert got["formula_lost"] and got["image_lost"]


def test_page_count(spark):
    rows = [("PDF", 1, 100, 99, None), ("PDF", 1, 100, None, 98), ("PDF", 1, 100, 100, 99), ("PDF", 1, 100, None, None)]
    got = gates.page_count(spark.createDataFrame(rows, "kind string, start int, end int, slice_pages int, content_pages int")).collect()
    assert [(r["pages_hard"], r["pages_soft"]) for r in got] == [(True, False), (False, True), (False, False), (True, False)]
    assert got[3]["pages_note"] == "unreadable"


def test_verdicts(spark):
    assert [one(spark, review.anomalous(F.lit(a))) for a in ("没有乱码", "有乱码", "不完整")] == [False, True, False]
    j = lambda e, h, s: one(spark, review.judge(F.lit(e).cast("string"), F.lit(h), F.lit(s), F.lit(0), F.lit(0)))
    assert [j("x", 0, 0), j(None, 1, 0), j(None, 0, 1), j(None, 0, 0)] == ["fail", "fail", "suspicious", "pass"]
    pages = spark.createDataFrame([("a", 1, 9, "pass"), ("a", 1, 9, "suspicious"), ("b", 1, 9, "pass"), ("b", 1, 9, "fail")], "basename string, start int, end int, verdict string")
    assert {r["basename"]: r["verdict"] for r in review.block_verdicts(pages).collect()} == {"a": "suspicious", "b": "fail"}
    said = ["md_lint: 大量乱码字符(9)", "md_lint: 代码围栏数量为奇数(3)，疑似未闭合", "full.md 缺失", "缺输出(full.md/json 均无)"]
    assert [one(spark, review.problem_class(F.lit(s))) for s in said] == ["OCR 错别字", "标题层级", "图片引用", "每页内容"]
    pairs = [("pass", "high"), ("fail", "pass"), ("suspicious", "high"), (None, "high"), (None, "low"), (None, None)]
    assert [one(spark, review.colour(F.lit(a).cast("string"), F.lit(b).cast("string"))) for a, b in pairs] == ["pass", "fail", "review", "fail", "review", "pass"]
    assert one(spark, review.table_like(F.array(F.lit("发现 12 行表格样式"), F.lit("表格样式"), F.lit("other")))) == 13


def test_merge_and_embed(spark):
    slices = spark.createDataFrame([("b", "p201-376", 201, "two"), ("b", "p1-200", 1, "one"), ("b", "images", 0, "x"), ("b", "p377-380", 377, None)], "book string, dir string, start int, text string")
    assert tuple(assembly.merge_slices(slices).first()) == ("b", "one\n\ntwo", 2)
    docs = spark.createDataFrame([(1, "a ![x](images/p.png) b ![y](images/q.jpg) c ![z](images/r.png)")], "doc_id int, text string")
    notes = spark.createDataFrame([("p", "# p.png\nhello"), ("q", "world")], "stem string, body string")
    got = assembly.embed(docs, notes).first()
    assert (got["embedded"], got["missing"]) == (2, 1)
    assert got["text"] == "a \n\n## 插图笔记\n\nhello\n b \n\n## 插图笔记\n\nworld\n c ![z](images/r.png)"
    refs = spark.createDataFrame([("b/p1-2", "x")], "dir string, stem string")
    held = spark.createDataFrame([("b", "x", "up"), ("b/p1-2/deep", "x", "down")], "dir string, stem string, body string")
    assert assembly.nearest_notes(refs, held).first()["body"] == "up"


def test_routing_and_folders(spark):
    version = lambda p: one(spark, blocks.parser_version(F.lit(p)))
    assert [version(p) for p in ("a.html", "a.htm", "a.HTML")] == ["MinerU-HTML"] * 3
    assert [version(p) for p in ("a.pdf", "a.docx", "a.png", "a")] == ["vlm"] * 4
    where = lambda n, root, rel: one(spark, blocks.out_dir(F.lit("d/x.pdf"), F.lit(1), F.lit(9), F.lit(n), F.lit(root).cast("string"), F.lit(rel).cast("string")))
    assert [where(1, None, None), where(1, "r", "s"), where(2, "r", "")] == ["d/x_mineru", "r/s/x_mineru", "r/x_mineru/p1-9"]
    rows = [("a", "full.md"), ("b", "x.json"), ("c", "images/x.json")]
    done = {r["out_dir"]: r["done"] for r in blocks.output_done(spark.createDataFrame(rows, "out_dir string, rel_path string")).collect()}
    assert done == {"a": True, "b": True, "c": False}


def test_cleanup_guard(spark):
    rows = [("a", "images/1.png", 5), ("a", "images_notes/1.md", 5), ("b", "images/1.png", 5), ("b", "images_notes/1.md", 5), ("b", "full.md", 5), ("b", "x.json", 5)]
    listed = spark.createDataFrame(rows, "out_dir string, path string, bytes long")
    assert {(r["out_dir"], r["path"]) for r in inventory.deletions(listed, "images").collect()} == {("b", "images/1.png"), ("b", "images_notes/1.md")}
    assert ("b", "x.json") in {(r["out_dir"], r["path"]) for r in inventory.deletions(listed).collect()}


def test_sources_and_sinks(spark, tmp_path):
    import json

    plan = {"pending_normal": [{"file": "a.pdf", "kind": "PDF", "start": 1, "end": 2, "pages": 2}], "pending_complex": [{"file": "a.pdf", "kind": "PDF", "start": 1, "end": 2, "pages": 2, "complex": 4}]}
    (tmp_path / "plan.json").write_text(json.dumps(plan))
    got = blocks.load(*files.plan(spark, str(tmp_path / "plan.json")))
    assert [(r["file"], r["complex"]) for r in got.collect()] == [("a.pdf", 4)]
    book = tmp_path / "in" / "a_mineru"
    book.mkdir(parents=True)
    (book / "x_content_list.json").write_text(json.dumps([{"type": "text", "text": "t", "page_idx": 0}]))
    (book / "full.md").write_text("a\nb")
    (tmp_path / "in" / "b.PDF").write_text("x")
    assert files.elements(spark, str(tmp_path / "in")).count() == 1
    assert files.texts(spark, str(tmp_path / "in")).first()["text"] == "a\nb"
    assert [r["path"].endswith("b.PDF") for r in files.documents_in(files.listing(spark, str(tmp_path / "in"))).collect()] == [True]
    out = sinks.write_version(spark.range(3).toDF("id"), str(tmp_path / "out"), 1)
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        sinks.write_version(spark.range(3).toDF("id"), str(tmp_path / "out"), 1)


def test_streams(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(1, "a", "running", 0), (2, "a", "done", 1), (3, "a", "failed", 2), (4, "b", "failed", 3)]
    events = spark.createDataFrame([(i, d, s, base + dt.timedelta(minutes=m)) for i, d, s, m in rows], "event_id long, data_id string, state string, ts timestamp")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    for _ in range(2):  # a restart adds nothing
        state.resumable_sink(state.first_terminal(stream), str(tmp_path / "out"), str(tmp_path / "check"), ["data_id"]).awaitTermination()
    assert sorted(r["data_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    assert state.first_terminal_batch(events).where("data_id = 'a'").first()["state"] == "done"
    beats = state.heartbeat(stream, late="1 hour").writeStream.format("memory").queryName("beats").outputMode("complete").trigger(availableNow=True).start()
    beats.awaitTermination()
    assert spark.table("beats").agg(F.sum("fresh")).first()[0] == 80
