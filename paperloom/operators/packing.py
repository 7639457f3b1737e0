"""Packing queues of blocks into days and budgets, also where one queue holds all blocks.

Next fit looks sequential: where a day ends depends on all days before. But a run of the queue matters to what follows only by how it
maps the pages already used on a day to the days it adds and the pages used after it. So a queue is cut in chunks by range, each
chunk gives that map from prefix sums of its pages and doubled jump pointers from day to day, maps are applied one after the other
(a row for each chunk), and each chunk is then replayed from the state it is entered with. First fit with skips needs less: a
block that is taken was preceded by taken blocks of its size, so of each size only the first ``budget // size`` can be.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from paperloom.sources.tables import stored

DAY_BUDGET = 5000
#: Blocks of a chunk: what one task holds, a few numbers each.
CHUNK = 1_000_000


class Days:
    """Next fit over the pages of one chunk. ``before[i]`` are the pages before block i."""

    def __init__(self, pages: np.ndarray, budget: int) -> None:
        self.budget = budget
        self.n = len(pages)
        self.before = np.concatenate([[0], np.cumsum(pages, dtype=np.int64)])
        self.through = self.before[1:]

    def next_of(self, at: np.ndarray) -> np.ndarray:
        """The block that opens the day after one that block ``at`` opens; n if none does. A block that would open a day still
        without pages is put on it, however large."""
        base = self.before[at]
        found = np.searchsorted(self.through, base + self.budget, "right")
        return np.where(self.before[found] == base, np.minimum(found + 1, self.n), found)

    def first(self, used: int) -> int:
        """The block that opens the first day of the chunk if ``used`` pages are on the running one; n if none does."""
        if used:
            return int(np.searchsorted(self.through, self.budget - used, "right"))
        return int(self.next_of(np.zeros(1, np.int64))[0])

    def table(self) -> tuple[int, list[int], list[int], list[int]]:
        """Of the blocks that may open the first day: which one does if nothing is used yet, and for each the pages through it, the
        days from then on and the pages used after the chunk.

        At most ``budget`` + 2 blocks, those that the first pages of the chunk may end with.
        """
        starts = np.searchsorted(self.through, np.arange(-1, self.budget), "right")
        starts = np.unique(np.append(starts, self.first(0)))
        starts = starts[starts < self.n]
        zero = int(np.searchsorted(starts, self.first(0)))
        jump = self.next_of(np.arange(self.n))
        last = jump == self.n
        jump[last] = np.flatnonzero(last)
        days = (~last).astype(np.int64)
        # Each round doubles the number of days a pointer passes.
        while days.any() and not (jump[jump] == jump).all():
            days, jump = days + days[jump], jump[jump]
        return zero, self.through[starts].tolist(), (days[starts] + 1).tolist(), (self.before[self.n] - self.before[jump[starts]]).tolist()

    def days(self, day: int, used: int) -> np.ndarray:
        """The day of each block."""
        opens = np.zeros(self.n + 1, np.int64)
        at = self.first(used)
        while at < self.n:
            opens[at] = 1
            at = int(self.next_of(np.array([at]))[0])
        return day + np.cumsum(opens[: self.n])


def entered(rows: Iterator[tuple], budget: int) -> Iterator[tuple]:
    """(group, chunk, day, used) with which each chunk is entered; of (group, chunk, total, zero, edges, days, used) in order."""
    group, day, used, begun = None, 1, 0, False
    for name, chunk, total, zero, edges, days, left in rows:
        if not begun or name != group:
            group, day, used, begun = name, 1, 0, True
        yield name, chunk, day, used
        at = zero if used == 0 else int(np.searchsorted(np.array(edges, np.int64), budget - used, "right"))
        if at < len(edges):
            day, used = day + days[at], left[at]
        else:
            used += total


def ordered(rows: pa.Table, names: list[str]) -> pa.Table:
    return rows.sort_by([(n, "ascending") for n in names])


def pages_of(rows: pa.Table) -> np.ndarray:
    return pc.fill_null(rows.column("pages").cast(pa.int64()), 0).to_numpy()


def chunks(rows: DataFrame, group: str, names: list[str]) -> DataFrame:
    """``rows`` with the number of their chunk: ranges in the order of queue and ``names``, nulls last, of about ``CHUNK`` rows."""
    kept = stored(rows)
    parts = max(1, math.ceil(kept.count() / CHUNK))
    places = [F.col(c).asc_nulls_last() for c in (group, *(n for n in names if n != group))]
    return stored(kept.repartitionByRange(parts, *places).withColumn("__chunk", F.spark_partition_id().cast("long")))


def day_plan(blocks: DataFrame, group: str, *order: str, budget: int = DAY_BUDGET) -> DataFrame:
    """Next fit: a block that does not fit opens a new day; a block over the budget gets a day of its own.

    Returns ``group``, the order, file, start, end, pages and day (from 1 in each group). A page number that is null is 0.
    """
    names = [*dict.fromkeys([*order, "file", "start", "end", "pages"])]
    rows = blocks.select(*dict.fromkeys([group, *names]))
    cut = chunks(rows, group, names)
    key, held = rows.schema[group], "total long, zero long, edges array<long>, days array<long>, used array<long>"

    def mapped(part: pa.Table) -> pa.Table:
        days = Days(pages_of(ordered(part, names)), budget)
        one = [part.column(group)[0].as_py(), part.column("__chunk")[0].as_py(), int(days.before[-1]), *days.table()]
        fields = [part.schema.field(group), pa.field("__chunk", pa.int64()), pa.field("total", pa.int64()), pa.field("zero", pa.int64()), *[pa.field(n, pa.list_(pa.int64())) for n in ("edges", "days", "used")]]
        return pa.table([pa.array([x], f.type) for x, f in zip(one, fields, strict=True)], schema=pa.schema(fields))

    maps = cut.groupBy(group, "__chunk").applyInArrow(mapped, StructType([key, StructField("__chunk", LongType()), *StructType.fromDDL(held)]))

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def each() -> Iterator[tuple]:
            nonlocal schema
            for batch in batches:
                schema = pa.schema([batch.schema.field(0), *[pa.field(n, pa.int64()) for n in ("__chunk", "day", "used")]])
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        held = []
        for row in entered(each(), budget):
            held.append(row)
            if len(held) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    states = maps.repartition(group).sortWithinPartitions(group, "__chunk").mapInArrow(enter, StructType([key, *StructType.fromDDL("__chunk long, day long, used long")]))

    def replay(part: pa.Table, state: pa.Table) -> pa.Table:
        part = ordered(part, names).drop_columns("__chunk")
        found = Days(pages_of(part), budget).days(state.column("day")[0].as_py(), state.column("used")[0].as_py())
        return part.append_column("day", pa.array(found.astype(np.int32)))

    out = StructType([*rows.schema.fields, *StructType.fromDDL("day int")])
    return cut.groupBy(group, "__chunk").cogroup(states.groupBy(group, "__chunk")).applyInArrow(replay, out)


def page_budget(blocks: DataFrame, group: str, *order: str, budget: int = DAY_BUDGET, skip_done: bool = False) -> DataFrame:
    """First fit with skips: in order, a block is taken if the pages taken so far leave room for it; ``used`` are the pages
    taken of its group.

    ``skip_done``: done blocks are left out beforehand; else they use up budget like others. If a block of some size is taken, all
    earlier ones of its size are, for there was no less room; so no more than ``budget // pages`` of each size are candidates, at
    most budget * (1 + ln budget) a queue, and only these are gone through in order. Blocks without pages are always taken.
    """
    rows = blocks.where(~F.col("done")) if skip_done else blocks
    names = [*dict.fromkeys([*order, "file", "start", "end", "pages"])]
    rows = rows.select(*dict.fromkeys([group, *names])).withColumn("__p", F.greatest(F.coalesce("pages", F.lit(0)), F.lit(0)).cast("long"))
    place = F.row_number().over(Window.partitionBy(group, "__p").orderBy(*[F.col(n).asc_nulls_last() for n in names]))
    # The constant bound lets each task drop what it can before the exchange.
    first = rows.where((F.col("__p") > 0) & (F.col("__p") <= budget)).withColumn("__place", place).where(F.col("__place") <= budget)
    few = first.where(F.col("__place") * F.col("__p") <= budget).drop("__place")

    def take(part: pa.Table) -> pa.Table:
        part = ordered(part, names)
        used, kept = 0, []
        for pages in part.column("__p").to_pylist():
            fits = used + pages <= budget
            used += pages * fits
            kept.append(fits)
        part = part.append_column("__used", pa.array(np.full(len(kept), used), pa.int64()))
        return part.filter(pa.array(kept))

    taken = few.groupBy(group).applyInArrow(take, StructType([*few.schema.fields, StructField("__used", LongType())]))
    free = rows.where("__p = 0").withColumn("__used", F.lit(None).cast("long"))
    both = taken.unionByName(free)
    totals = taken.groupBy(group).agg(F.max("__used").alias("used")).withColumnRenamed(group, "__group")
    joined = both.join(totals, F.col(group).eqNullSafe(F.col("__group")), "left")
    return joined.select(group, F.coalesce("used", F.lit(0).cast("long")).alias("used"), *[n for n in names if n != group])
