"""Streams with timers against their batch forms, and a sink that is broken off."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from paperloom.streaming import state, timed

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture()
def rocks(spark):
    old = {k: spark.conf.get(k, None) for k in timed.STATE_STORE}
    for k, v in timed.STATE_STORE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def fed(spark, path, batches, schema):
    """A stream that reads one file a micro-batch, in this order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)


def drained(stream, path, check):
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(path)


def mixed_up(rows, r, late, parts):
    """Rows by time, each up to ``late`` seconds after its turn, in so many batches."""
    rows = sorted(rows, key=lambda x: x[-1] + dt.timedelta(seconds=r.uniform(0, late)))
    size = -(-len(rows) // parts)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def test_poll(rocks, tmp_path):
    r = random.Random(1)
    rows = []
    for i in range(60):
        start = r.randint(0, 20_000)
        rows += [(f"t{i}", timed.TASK, at(start))] * r.choice([1, 1, 2])
        for _ in range(r.choice([0, 1, 1, 3])):
            rows.append((f"t{i}", r.choice(["done", "failed", "running"]), at(start + r.choice([r.randint(-200, 7000), 7200, 7201, 9000]))))
        rows.append((f"none{i}", "done", at(start)))
    schema = "data_id string, state string, ts timestamp"
    stream = fed(rocks, str(tmp_path / "in"), [*mixed_up(rows, r, 500, 5), *[[("end", "done", at(t)), ("end", timed.TASK, at(t + 1))] for t in (200_000, 200_100)]], schema)
    told = timed.poll(stream.where("state = 'task'").select("data_id", "ts"), stream.where("state <> 'task'"), "10 minutes")
    got = drained(told, str(tmp_path / "out"), str(tmp_path / "check"))
    table = rocks.createDataFrame(rows, schema)
    want = timed.poll_batch(table.where("state = 'task'").select("data_id", "ts"), table.where("state <> 'task'"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 60 and {x["state"] for x in got.collect()} == {"done", "failed", timed.GAVE_UP}


def test_stalls_are_told_while_they_last(rocks, tmp_path):
    r = random.Random(2)
    rows = [(u, at(t)) for u in range(6) for t in r.sample(range(0, 30_000), r.randint(1, 60))]
    rows += rows[:9]
    schema = "user_id long, ts timestamp"
    stream = fed(rocks, str(tmp_path / "in"), [*mixed_up(rows, r, 50, 4), [(99, at(40_000))], [(99, at(40_001))]], schema)
    got = drained(timed.stalls(stream), str(tmp_path / "out"), str(tmp_path / "check"))
    want = timed.stalls_batch(rocks.createDataFrame([*rows, (99, at(40_000)), (99, at(40_001))], schema))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # Users 0 to 5 are quiet at the end, with no event that would tell so: only the clock does.
    last = {u: max(t for v, t in rows if v == u) for u in range(6)}
    assert {(u, t) for u, t in last.items()} <= {tuple(x) for x in got.collect()}


def test_sink_writes_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    batch = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    state.append_once(batch(0, 100), 0, path, ["k"])
    state.append_once(batch(50, 150), 1, path, ["k"])
    rows = lambda: sorted(x["k"] for x in spark.read.parquet(path).collect())
    assert rows() == list(range(150))
    # Broken off between the rows and their keys, then played again.
    monkeypatch.setattr(state, "_written", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        state.append_once(batch(140, 200), 2, path, ["k"])
    monkeypatch.undo()
    state.append_once(batch(140, 200), 2, path, ["k"])
    assert rows() == list(range(200))
    # Played again as a whole, and followed by repeated rows and null keys.
    state.append_once(batch(140, 200), 2, path, ["k"])
    more = batch(190, 201).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 'x' AS v")).unionByName(batch(200, 201))
    state.append_once(more, 3, path, ["k"])
    state.append_once(more, 4, path, ["k"])
    assert sorted(x["k"] for x in spark.read.parquet(path).where("k is not null").collect()) == list(range(201)) and spark.read.parquet(path).where("k is null").count() == 1


def test_sink_reads_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "out")
    state.append_once(spark.range(1000).select(F.col("id").alias("k")), 0, path, ["k"])
    touched = [x["b"] for x in spark.range(5).select(F.pmod(F.xxhash64("id"), F.lit(state.BUCKETS)).alias("b")).distinct().collect()]
    plan = state.known_keys(spark.range(5).select(F.col("id").alias("k")), 1, path, ["k"])
    assert {f.split("_bucket=")[1].split("/")[0] for f in plan.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]} <= {str(b) for b in touched}
