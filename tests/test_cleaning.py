"""Cleaning by the fragment index against trying every key on every line."""

import random

import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.operators import cleaning as C
from paperloom.sources.files import spread

GONE = set(T.PUNCTUATION) | set("﻿") | {chr(c) for c in [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]}


def norm(line):
    return "".join(c for c in line if c not in GONE).lower()


def noisy(line, keys):
    k = norm(line)
    return k in keys or any(len(y) >= 6 and len(k) <= len(y) + 8 and y in k for y in keys)


def cleaned(text, keys):
    lines = [x for x in text.split("\n") if not x.strip() or x.strip().startswith("```") or not noisy(x, keys)]
    return "\n".join(lines)


def test_norm(spark):
    r = random.Random(1)
    every = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000] + list(T.PUNCTUATION) + ["﻿", "é", "漢", "😀", "İ"[:0]]
    texts = ["".join(r.choice(every) for _ in range(200)) for _ in range(200)]
    odd = {"İ"}  # its lower case differs by language
    texts = ["".join(c for c in t if c not in odd) for t in texts]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.norm(F.col("t")).alias("k")).collect()
    from_spark = {x["t"]: x["k"] for x in got}
    lower = spark.createDataFrame([("".join(c for c in t if c not in GONE), t) for t in texts], "s string, t string").select("t", F.lower("s").alias("k")).collect()
    assert from_spark == {x["t"]: x["k"] for x in lower}


@pytest.fixture(scope="module")
def shelf():
    """(pages, keys): a book of 10,000 keys that begin alike, one of few, one of none, and repeated and null rows."""
    r = random.Random(7)
    many = [f"running header number {i}" for i in range(9_990)] + ["page", "part5", "runnin", "漢字漢字漢字", "the very long line " * 20, "aaaaaa", "aaaaaaa", "abcabcabc", "Ab-c_d!e", "xyz9"]
    keys = {1: {norm(k) for k in many}, 2: {"runnin", "page", "abcdef"}}
    pages = []
    for book in (1, 2, 3, None):
        for _ in range(40):
            lines = []
            for _ in range(r.randint(0, 30)):
                base = r.choice([*r.sample(many, 3), "body text of the page that is long enough", "", "```", "  ```x", "abcdef", "ab", "page"])
                pad = "".join(r.choice("ab cd9漢") for _ in range(r.choice([0, 0, 1, 3, 7, 8, 9, 12])))
                lines.append(r.choice([base, base + pad, pad + base, pad[: len(pad) // 2] + base + pad[len(pad) // 2 :], base.upper(), base[1:]]))
            pages.append((book, "\n".join(lines), len(pages)))
    return [*pages, pages[0], pages[50], (1, None, -1), (2, "", -2)], keys


def test_index_against_every_key(spark, shelf):
    pages, keys = shelf
    frame = spark.createDataFrame(pages, "book_id long, text string, at long")
    listed = spark.createDataFrame([(b, k) for b, ks in keys.items() for k in ks], "book_id long, key string")
    marked = C.clean(frame, listed)
    assert marked.columns == ["book_id", "text", "at", "clean_text", "n_lines", "n_clean", "n_removed"]
    rows = marked.collect()
    assert len(rows) == len(pages)
    removed = 0
    for x in rows:
        text, ks = x["text"] or "", keys.get(x["book_id"], set())
        lines = text.split("\n") if text else []
        lines = lines[:-1] if lines and lines[-1] == "" else lines
        kept = [y for y in lines if not y.strip() or y.strip().startswith("```") or not noisy(y, ks)]
        assert x["n_lines"] == len(lines)
        if not any(a.strip() == "```" == b.strip() for a, b in zip(kept, kept[1:], strict=False)):
            assert x["clean_text"] == "\n".join(kept), x
        removed += x["n_removed"]
    assert removed > 200


def test_no_row_of_all_keys(spark, shelf):
    """Keys meet lines by hash: no plan step gathers the keys of a book, and a line makes 45 fragments at most."""
    pages, keys = shelf
    listed = spark.createDataFrame([(b, k) for b, ks in keys.items() for k in ks], "book_id long, key string")
    frame = spark.createDataFrame(pages, "book_id long, text string, at long")
    plan = C.clean(frame, listed)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set(key" not in plan and "collect_list(key" not in plan and "Join Cross" not in plan
    sizes = spark.createDataFrame([("x" * n,) for n in range(80)], "k string").select(F.size(C.fragments(F.col("k"), F.lit(4), F.lit(60))).alias("n"), F.length("k").alias("l"))
    got = {x["l"]: x["n"] for x in sizes.collect()}
    assert max(got.values()) == 45 and got[3] == 0 and got[4] == got[5] == got[6] == 1 and got[69] == 0 and got[68] == 9


def test_pieces(spark, tmp_path):
    rows = spark.range(100)
    rows.repartition(1).write.parquet(str(tmp_path / "one"))
    rows.repartition(9).write.parquet(str(tmp_path / "many"))
    cores = spark.sparkContext.defaultParallelism
    one, many = spread(spark.read.parquet(str(tmp_path / "one"))), spread(spark.read.parquet(str(tmp_path / "many")))
    assert one.rdd.getNumPartitions() == cores and one.count() == 100
    assert "repartition" not in many._jdf.queryExecution().logical().toString().lower()
