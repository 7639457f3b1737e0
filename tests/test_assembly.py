"""Notes by folder, merged texts in pieces, bounded lists, original PDFs, reports and plans without blocks."""

import pytest
from pyspark.sql import functions as F

from paperloom.operators import assembly, blocks, gates, inventory, packing
from paperloom.sources import sinks


def test_two_notes_of_one_stem(spark):
    notes = spark.createDataFrame([("a", "1", "# 1\nfirst"), ("b", "1", "other book"), ("b/p1-2", "2", "deep"), ("a", "3", "# only a title"), ("c/x/y", "1", "below"), ("b", "1", "second row")], "dir string, stem string, body string")
    block = lambda t: f"\n\n## {assembly.HEADING}\n\n{t}\n"
    text = "a ![](images/1.png) b ![x](images/2.jpg) c"
    docs = [(1, "a", text), (1, "b/p1-2", text), (1, "b/p1-2", text), (2, "c", "![](images/1.png)![](images/1.png)"), (3, "a", None), (4, None, text), (5, "a", "![](images/3.png)"), (6, "z", "no reference")]
    got = sorted(map(tuple, assembly.embed(spark.createDataFrame(docs, "doc_id long, dir string, text string"), notes).collect()))
    assert got == sorted([
        (1, f"a {block('first')} b ![x](images/2.jpg) c", 1, 1),
        *[(1, f"a {block('other book')} b {block('deep')} c", 2, 0)] * 2,
        (2, block("below") * 2, 2, 0), (3, "", 0, 0), (4, text, 0, 2), (5, block(""), 1, 0), (6, "no reference", 0, 0),
    ])


def test_merged_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 7)
    rows = [(f"b{i % 2}", 10 * i, f"p{i}-{i + 1}", f"text {i} é" * (i % 5)) for i in range(60)] + [("b0", 5, "images", "no"), ("b1", 7, "p1-2", None), ("b2", 1, "p1-1", "one"), ("b0", 10, "p1-2", "text 1 é")]
    slices = spark.createDataFrame(rows, "book string, start int, dir string, text string")
    whole = {x["book"]: x["text"] for x in assembly.merge_slices(slices).collect()}
    placed = assembly.merge_offsets(slices).collect()
    assert all(whole[x["book"]][x["at"] : x["at"] + len(x["text"])] == x["text"] for x in placed) and len(placed) == 62
    assembly.write_merged(slices, str(tmp_path / "out"))
    for book, text in whole.items():
        parts = sorted((tmp_path / "out" / f"book={book}").glob("part-*"))
        assert "".join(p.read_text(newline="").replace("\0", "") for p in parts) == text


def test_bounded_lists(spark):
    """Lists of the first few are cut in each task before they are exchanged."""
    docs = spark.createDataFrame([(i % 3, f"n{i:03d}" if i % 7 else None, i % 2 == 0) for i in range(200)] + [(None, "x", False), (9, "y", True)] + [(0, "n003", False)] * 50, "folder int, name string, done boolean")
    got = {x["folder"]: tuple(x)[1:] for x in inventory.ready_folders(docs).collect()}
    rows = docs.collect()
    for folder in (0, 1, 2, None, 9):
        of = [x for x in rows if x["folder"] == folder]
        lost = sorted({x["name"] for x in of if not x["done"] and x["name"] is not None})[:5]
        assert got[folder] == (len(of), sum(not x["done"] for x in of), ",".join(lost), all(x["done"] for x in of))
    plan = inventory.ready_folders(docs)._jdf.queryExecution().executedPlan().toString()
    texts = spark.createDataFrame([(1, "".join(f"![](images/{i}.png)" for i in range(30))), (2, "![](http://x/y.png)")], "doc_id long, text string")
    files = spark.createDataFrame([(1, "images/0.png"), (1, "images/3.png")], "doc_id long, ref string")
    lost = gates.missing_images(texts, files)
    assert [x["pos"] for x in lost.orderBy("pos").collect()] == [1, 2, 4, 5, 6, 7, 8, 9, 10, 11]
    for p in (plan, lost._jdf.queryExecution().executedPlan().toString()):
        assert "WindowGroupLimit" in p and "Partial" in p


def test_origin_of_the_same_batch(spark):
    files = [("a", "u1_content_list.json"), ("a", "u1_origin.pdf"), ("a", "u0_origin.pdf"), ("b", "u2_content_list.json"), ("b", "z_origin.pdf"), ("b", "y_origin.pdf"), ("c", "u3_content_list.json"), ("c", "sub/u3_origin.pdf"), ("d", "x_origin.pdf")]
    got = {(x["out_dir"], x["content_list"], x["origin"]) for x in inventory.origin_pdfs(spark.createDataFrame(files, "out_dir string, path string")).collect()}
    assert got == {("a", "u1_content_list.json", "u1_origin.pdf"), ("b", "u2_content_list.json", "y_origin.pdf"), ("c", "u3_content_list.json", None)}


def test_content_pages(spark):
    rows = spark.createDataFrame([(1, 0), (1, 4), (1, None), (2, None)], "doc_id int, page_idx int")
    assert {x["doc_id"]: x["content_pages"] for x in gates.content_pages(rows).collect()} == {1: 5, 2: 1}


def test_report_as_markdown(spark, tmp_path):
    schema = "basename string, start int, end int, kind string, colour string, l3_verdict string, problems array<string>, l2_issues array<string>, l3_reasons array<string>, spec_items array<string>"
    rows = [("b", 1, 9, "PDF", "fail", "fail", ["p1", "p2"], ["i", "j"], [str(i) for i in range(9)], ["s", "t"]), ("a", 1, 2, "DOC", "fail", None, None, [], None, []), ("c", 1, 2, "DOC", "review", None, ["x"], [], [], []), ("d", 1, 2, "DOC", "pass", None, [], [], [], [])]
    sinks.write_report(spark.createDataFrame(rows, schema), str(tmp_path / "r"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "r").glob("part-*")))
    heads = [h.format(n) for h, n in zip(sinks.REPORT_HEADS.values(), (1, 2, 1), strict=True)]
    want = [sinks.REPORT_TITLE, "", "## 总览（三色）", "", "| 分类 | 数量 | 含义 |", "|---|---|---|", *heads, "", sinks.REPORT_FAIL, "", "- **a** p1-2 [DOC]", "- **b** p1-9 [PDF]", "  - p1", "  - p2", "  - L2: i; j", "  - L3: fail - 0; 1; 2; 3; 4", "  - 对应检查项: s, t", sinks.REPORT_REVIEW, "", "共 1 块", ""]
    assert text.splitlines() == want
    none = sinks.report_markdown(spark.createDataFrame([], schema)).collect()
    assert len(none) == 10 and sinks.REPORT_HEADS["pass"].format(0) in {x["line"] for x in none}


def test_plan_without_blocks(spark):
    schema = "file string, start int, end int, pages int, pos int"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([("a", 1, 2, 2, 0)], schema)
    with pytest.raises(ValueError, match="complex"):
        blocks.load(none, one, "complex", some=True)
    assert blocks.load(none, one, some=True).count() == 1 and blocks.load(none, none).count() == 0


def test_zipped(spark):
    left = spark.createDataFrame([(1, x) for x in "cab"] + [(2, "z")], "g int, a string")
    right = spark.createDataFrame([(1, 5), (1, 3), (3, 1)], "g int, b int")
    assert sorted((x["g"], x["place"], x["a"], x["b"]) for x in blocks.zipped(left, right, "g", ["a"], ["b"]).collect()) == [(1, 0, "a", 3), (1, 1, "b", 5)]
    assert blocks.zipped(left, right, "g", ["a"], ["b"]).where(F.col("g") > 1).count() == 0
