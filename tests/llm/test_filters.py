"""Rows with null, repeated and textual ids through the filters, and how the licence scan reads the corpus."""

import pytest
from pyspark.sql import functions as F

from paperloom.llm import op01_importance, op03_decontamination, op07_near_dedup, op09_quality_rules, op10_licenses

from .conftest import SCHEMA, prose

JUNK = "$$ ## %% && || << >> ** " * 20


def rows_of(spark, rows, kind="long"):
    wide = [(i, t, "en", "s", None, 7, None, "w", 1, n) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(wide, SCHEMA.replace("doc_id long", f"doc_id {kind}"))


def left(df):
    return sorted((x["place"] for x in df.collect()))


@pytest.mark.parametrize("kind", ["long", "string", "int"])
def test_ids_that_tell_nothing(spark, kind):
    as_id = lambda i: i if i is None or kind != "string" else f"d{i}"
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(None, JUNK), (None, a), (2, b), (2, JUNK), (2, b), (None, a), (None, b), (None, c), (None, c.upper()), (None, ""), (None, None)]
    docs = rows_of(spark, [(as_id(i), t) for i, t in rows], kind)
    assert left(op09_quality_rules.filter_quality(docs)) == [1, 2, 4, 5, 6, 7, 8]
    got = left(op07_near_dedup.deduplicated(docs, 80))
    # Of copies one row stays, with its id where one has it; rows without words are linked with nothing.
    assert [len(set(got) & x) for x in ({1, 5}, {2, 4}, {6}, {7, 8}, {0, 3}, {9, 10})] == [1, 1, 0, 1, 1, 2]
    assert op07_near_dedup.deduplicated(docs, 80).columns == docs.columns
    item = rows_of(spark, [(as_id(1), a)], kind).select(F.col("doc_id").alias("item_id"), "text")
    assert left(op03_decontamination.decontaminated(docs, item)) == [0, 2, 3, 4, 6, 7, 8, 9, 10]
    hit = op03_decontamination.contamination(docs, item).where("contaminated").first()
    assert hit["items"] == [as_id(1)]


def test_draws_of_null_ids(spark):
    """Rows with a null doc_id share their Gumbel number, not their verdict."""
    good, bad = [prose(i, 80) for i in range(60)], [JUNK + prose(100 + i, 3) for i in range(60)]
    rows = [(i, t) for i, t in enumerate([*good, *bad])] + [(None, JUNK + prose(900, 3)), (None, " ".join(good[:2]))]
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    docs = rows_of(spark, rows)
    verdicts = op01_importance.importance(docs.withColumn("mark", F.length("text")), labels, ("mark",)).where("doc_id is null")
    kept = {x["mark"]: x["kept"] for x in verdicts.collect()}
    assert kept == {len(rows[120][1]): False, len(rows[121][1]): True}
    got = left(op01_importance.resampled(docs, labels))
    assert 121 in got and 120 not in got


def test_licence_scan_reads_in_all_tasks(spark, monkeypatch):
    """No single task reads the documents to find lines to learn from."""
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(op10_licenses, "stored", seen)
    docs = rows_of(spark, [(i, prose(i, 30) + "\n" + prose(i + 1, 9)) for i in range(40)]).repartition(9)
    lines = op10_licenses.training_lines(spark, docs)
    assert "Coalesce" not in plans[0] and lines.where("family = 'unknown'").count() > 20
    assert [tuple(x) for x in lines.collect()] == [tuple(x) for x in op10_licenses.training_lines(spark, docs.repartition(3)).collect()]
