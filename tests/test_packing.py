"""Packing by chunks and cutting by candidates against going through everything in turn."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.operators import packing, slicing


def next_fit(pages, budget):
    day, used, out = 1, 0, []
    for p in pages:
        if used and used + p > budget:
            day, used = day + 1, 0
        used += p
        out.append(day)
    return out


def queues(seed, n=4000):
    r = random.Random(seed)
    rows = []
    for q, size in [(1, n), (2, 300), (3, 1), (None, 200)]:
        zeros = r.random() * 0.5
        for i in range(size):
            pages = None if r.random() < 0.02 else 0 if r.random() < zeros else r.choice([1, 2, 3, 10, r.randint(1, 60), 150, 99])
            rows.append((q, i // 3, f"f{i:05d}", 1, 2, pages, i % 3 == 0))
    r.shuffle(rows)
    return rows + rows[:5]


SCHEMA = "queue int, pos int, file string, start int, end int, pages int, done boolean"


def by_queue(rows):
    found = {}
    for q, *rest in rows:
        found.setdefault(q, []).append(rest)
    return {q: sorted(v, key=lambda x: (x[0], x[1], x[2], x[3], x[4] is None, x[4] or 0)) for q, v in found.items()}


@pytest.mark.parametrize("size,budget", [(37, 100), (500, 7), (10**6, 100)])
def test_days_by_chunks(spark, monkeypatch, size, budget):
    monkeypatch.setattr(packing, "CHUNK", size)
    rows = queues(size)
    made = packing.day_plan(spark.createDataFrame(rows, SCHEMA), "queue", "pos", budget=budget).collect()
    got = {q: [x[-1] for x in v] for q, v in by_queue([(x["queue"], x["pos"], x["file"], x["start"], x["end"], x["pages"], x["day"]) for x in made]).items()}
    assert got == {q: next_fit([x[4] or 0 for x in v], budget) for q, v in by_queue(rows).items()}


def test_maps_of_chunks():
    """The map of a chunk, for every number of used pages, is what going through the chunk gives."""
    r = random.Random(5)
    for _ in range(300):
        budget = r.randint(1, 12)
        pages = [r.choice([0, 0, 1, 2, 3, 5, 13]) for _ in range(r.randint(1, 12))]
        days = packing.Days(np.array(pages), budget)
        zero, edges, added, left = days.table()
        assert len(edges) <= budget + 2
        for used in range(budget + 20):
            day, now = 1, used
            for p in pages:
                if now and now + p > budget:
                    day, now = day + 1, 0
                now += p
            state = list(packing.entered(iter([("q", 0, used, len(edges), [], [], []), ("q", 1, sum(pages), zero, edges, added, left), ("q", 2, 0, 0, [], [], [])]), budget))
            assert state[1][2:] == (1, used) and state[2][2:] == (day, now), (pages, budget, used)
            assert days.days(1, used).tolist()[-1:] == [day]


@pytest.mark.parametrize("skip_done", [False, True])
def test_budget(spark, skip_done):
    rows = queues(3)
    for budget in (5, 100, 1000):
        made = packing.page_budget(spark.createDataFrame(rows, SCHEMA), "queue", "pos", budget=budget, skip_done=skip_done).collect()
        got = sorted(((x["queue"], x["pos"], x["file"], x["pages"], x["used"]) for x in made), key=str)
        want = []
        for q, v in by_queue([x for x in rows if not (skip_done and x[-1])]).items():
            used, taken = 0, []
            for pos, file, _, _, pages, _ in v:
                if used + (pages or 0) <= budget:
                    used += pages or 0
                    taken.append((q, pos, file, pages))
            want += [(*t, used) for t in taken]
        assert got == sorted(want, key=str)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert packing.day_plan(none, "queue", "pos").count() == 0 and packing.page_budget(none, "queue", "pos").count() == 0


def plain_cuts(total, candidates, most):
    valid = sorted({c for c in candidates if 1 < c <= total})
    if not valid:
        return None
    at, out = 1, []
    while at <= total:
        reach = at + most - 1
        if reach >= total:
            out.append((at, total))
            break
        to = max([c for c in valid if at < c <= reach], default=reach)
        out.append((at, to - 1))
        at = to
    return out


def test_cuts_of_many_documents(spark):
    r = random.Random(9)
    docs = []
    for _ in range(400):
        total = r.choice([1, 2, 50, 199, 200, 201, 400, 1000])
        docs.append((total, [r.randint(-3, total + 5) for _ in range(r.choice([0, 1, 3, 20, 200]))]))
    frame = spark.createDataFrame(docs, "total int, c array<int>")
    for most in (2, 3, 50, 200):
        got = frame.select("total", "c", slicing.chapter_cuts(F.col("total"), F.col("c"), most).alias("r")).collect()
        for x in got:
            assert (None if x["r"] is None else [tuple(y) for y in x["r"]]) == plain_cuts(x["total"], x["c"], most), (x["total"], sorted(x["c"]), most)


def test_cuts_of_a_very_long_document(spark):
    r = random.Random(2)
    total, chapters = 100_000, sorted(r.sample(range(2, 100_000), 3000))
    frame = spark.createDataFrame([(total, chapters)], "total int, c array<int>")
    began = time.perf_counter()
    got = frame.select(slicing.chapter_cuts(F.col("total"), F.col("c"), 200).alias("r")).first()["r"]
    assert [tuple(y) for y in got] == plain_cuts(total, chapters, 200) and time.perf_counter() - began < 10
