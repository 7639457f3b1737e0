"""Near-duplicate documents by a MinHash LSH forest.

A document is the set of its distinct 5-word shingles (one shingle if it has fewer words; no words: the empty set, linked
with nothing). Equal sets are one class first, so copies never meet in pairs. Each class gets, for each of ``TREES``
trees, a label of ``DEPTH`` MinHash values; a tree orders the classes by label, and classes with a long common prefix are
neighbours. The prefix that makes a region adapts: regions of more than ``CROWDED`` classes at one depth are divided by
the next value.

Candidates come in three rounds: each class with the least one of its region, at every depth down to its own region;
then, in regions that still hold several components, classes with their neighbours in label order (all others of the
region where it has at most ``CROWDED`` classes); then, in crowded shallow regions that still hold several components,
the classes outside the largest component with all others, block by block. Pairs within a component never come up again,
so a group of copies costs as many pairs as it has members. Every link is confirmed on the full sets. Links join into
components over the shared storage; nothing is collected.

Two sets with a similarity of 0.85 share the first three values in some tree with probability 1 - (1 - 0.85**3)**12,
that is 0.99999; with one of 0.8, 0.9998.

Defined cases: null and empty texts have n_shingles 0 and are components of their own; rows that repeat a doc_id are one
document; a null doc_id gets the component of its copies, or null, and is kept in the latter case; an empty table gives an
empty result; further columns are ignored by ``near_duplicates`` and kept by ``deduplicated``, which tells rows apart by doc_id and
text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from .graph import components
from .storage import TEXT_KEYS, small_or_shuffled, stored, with_text_keys, without
from .tokens import mix, shingle_sets, string_column, words

TREES, DEPTH, SHALLOW = 12, 5, 3
#: Classes in a region from which on it is divided by the next value.
CROWDED = 16
#: Neighbours on one side that a class is compared with in regions that stay crowded at full depth.
REACH = 4
#: Classes of such a region that are put in order by one task.
CHUNK = 4096
THRESHOLD = 85

_RANDOM = np.random.Generator(np.random.PCG64(7)).integers(0, 2**32, (2, TREES * DEPTH), dtype=np.uint32) | np.uint32(1)
SIGNATURE_SCHEMA = "doc_id {}, n_shingles long, key_a long, key_b long, labels array<long>"


def doc_id_of(docs: DataFrame) -> tuple[Column, str]:
    """The column doc_id of ``docs`` and its type: numbers as long, anything else as text."""
    kind = "long" if isinstance(docs.schema["doc_id"].dataType, IntegralType) else "string"
    return F.col("doc_id").cast(kind).alias("doc_id"), kind


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row its set's size, 128-bit key and, tree by tree, hashes of the label's prefixes of 3, 4 and 5 values; further
    columns are kept behind them."""
    per_tree = DEPTH - SHALLOW + 1
    for batch in batches:
        ids, at = string_column(batch, "doc_id"), 0
        more = [c for c in batch.schema.names if c not in ("doc_id", "text")]
        for w in words(string_column(batch, "text")):
            h, first = shingle_sets(w)
            n = np.diff(first)
            full = n > 0
            begin = first[:-1][full]
            keys = np.zeros((2, len(n)), np.uint64)
            labels = np.zeros((len(n), TREES * per_tree), np.uint64)
            if len(begin):
                for i, salt in enumerate((0x1234567, 0x7654321)):
                    keys[i, full] = np.add.reduceat(mix(h ^ np.uint64(salt << 20)), begin)
                low, high = h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32) * np.uint32(0x85EBCA6B)
                for t in range(TREES):
                    prefix = np.full(len(begin), t, np.uint64)
                    for d in range(DEPTH):
                        i = t * DEPTH + d
                        least = np.minimum.reduceat((low * _RANDOM[0, i]) ^ (high * _RANDOM[1, i]), begin)
                        prefix = mix(prefix * np.uint64(0x9E3779B97F4A7C15) + least)
                        if d + 1 >= SHALLOW:
                            labels[full, t * per_tree + d + 1 - SHALLOW] = prefix
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * (TREES * per_tree)), pa.array(labels.ravel().view(np.int64)))
            columns = [ids.slice(at, len(n)), pa.array(n.astype(np.int64)), *(pa.array(k.view(np.int64)) for k in keys), lists, *(batch.column(c).slice(at, len(n)) for c in more)]
            at += len(n)
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "key_a", "key_b", "labels", *more])


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, at = string_column(batch, "doc_id"), 0
        for w in words(string_column(batch, "text")):
            h, first = shingle_sets(w)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([ids.slice(at, w.n_rows), lists], ["node", "shingles"])
            at += w.n_rows


def regions(classes: DataFrame) -> DataFrame:
    """(node, n_shingles, region, crowd, least_3, least_4, least_5, label_4, label_5): classes of shared regions, tree by tree."""
    per_tree = DEPTH - SHALLOW + 1
    trees = F.explode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(*[F.get("labels", t * per_tree + i).alias(f"p{SHALLOW + i}") for i in range(per_tree)])))
    found = classes.select("node", "n_shingles", trees.alias("t")).select("node", "n_shingles", "t.*")
    for depth in range(SHALLOW, DEPTH + 1):
        crowds = found if depth == SHALLOW else found.where(F.col(f"n{depth - 1}") > CROWDED)
        crowds = stored(crowds.groupBy(f"p{depth}").agg(F.count("*").alias(f"n{depth}"), F.min("node").alias(f"least_{depth}")).where(F.col(f"n{depth}") > 1))
        found = found.join(small_or_shuffled(crowds, crowds.count()), f"p{depth}", "inner" if depth == SHALLOW else "left")
    region, crowd, own = F.col(f"p{SHALLOW}"), F.col(f"n{SHALLOW}"), F.lit(SHALLOW)
    for depth in range(SHALLOW + 1, DEPTH + 1):
        deeper = F.col(f"n{depth - 1}") > CROWDED
        region = F.when(deeper, F.col(f"p{depth}")).otherwise(region)
        crowd = F.when(deeper, F.coalesce(F.col(f"n{depth}"), F.lit(1))).otherwise(crowd)
        own = F.when(deeper, F.lit(depth)).otherwise(own)
    return stored(found.withColumns({"region": region, "crowd": crowd, "depth": own}))


def star_pairs(found: DataFrame) -> DataFrame:
    least = F.array(*[F.col(f"least_{d}") for d in range(SHALLOW, DEPTH + 1)])
    return found.select("node", F.explode(F.array_distinct(least)).alias("least")).where("least != node").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()


def neighbour_pairs(found: DataFrame, component: DataFrame, rows: int) -> DataFrame:
    """Pairs of different components that are neighbours in a region, for regions that hold several components."""
    joined = found.where("crowd > 1").join(small_or_shuffled(component, rows), "node", "left").withColumn("component", F.coalesce("component", "node"))
    joined = stored(joined)
    mixed = joined.groupBy("region").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("region")
    salt = F.when(F.col("crowd") > CHUNK, F.pmod(F.xxhash64("node"), F.ceil(F.col("crowd") / CHUNK))).otherwise(F.lit(0))
    open_ = joined.join(mixed, "region", "left_semi").withColumn("salt", salt)
    order = Window.partitionBy("region", "salt").orderBy(f"p{DEPTH - 1}", f"p{DEPTH}", "node")
    before = F.collect_list(F.struct("node", "component")).over(order.rowsBetween(1 - CROWDED, -1))
    open_ = open_.withColumn("before", before)
    near = F.when(F.col("crowd") <= CROWDED, F.col("before")).otherwise(F.slice("before", -F.least(F.lit(REACH), F.size("before")), F.lit(REACH)))
    near = F.when(F.size("before") > 0, near)
    pairs = open_.select("node", "component", F.explode(near).alias("o")).where("o.component != component")
    return pairs.select(F.least("node", "o.node").alias("a"), F.greatest("node", "o.node").alias("b")).distinct()


def crowded_links(found: DataFrame, component: DataFrame, rows: int, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b) between different components within shallow regions of more than ``CROWDED`` classes.

    In each region the classes outside its largest component are held against all of it, in blocks of ``CHUNK`` by
    ``CHUNK`` classes, so no task gets more than a block, and within a block only classes that share a shingle meet.
    """
    shallow, size = f"p{SHALLOW}", f"n{SHALLOW}"
    joined = found.where(F.col(size) > CROWDED).select("node", shallow, size).join(small_or_shuffled(component, rows), "node", "left")
    joined = stored(joined.withColumn("component", F.coalesce("component", "node")))
    counts = joined.groupBy(shallow, "component").agg(F.count("*").alias("n"))
    mixed = counts.groupBy(shallow).agg(F.count("*").alias("parts"), F.max_by("component", F.struct("n", "component")).alias("main")).where("parts > 1").drop("parts")
    open_ = stored(joined.join(mixed, shallow).withColumn("blocks", F.ceil(F.col(size) / CHUNK)))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    each = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    asked = open_.where("component != main").select("node", "component", shallow, F.lit(True).alias("asks"), own.alias("query_block"), F.explode(each).alias("block"))
    held = open_.select("node", "component", shallow, F.lit(False).alias("asks"), F.explode(each).alias("query_block"), own.alias("block"))
    placed = asked.unionByName(held).join(sets, "node")
    return placed.groupBy(shallow, "query_block", "block").applyInArrow(lambda rows: block_links(rows, threshold), "a {0}, b {0}".format(placed.schema["node"].dataType.simpleString())).distinct()


def block_links(rows: pa.Table, threshold: int) -> pa.Table:
    """For each class that asks and each other component here, one link if there is any."""
    asks = rows.column("asks").to_numpy(zero_copy_only=False)
    node, component = (np.array(rows.column(c).to_pylist()) for c in ("node", "component"))
    lists = rows.column("shingles").combine_chunks()
    offs, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    sizes = np.diff(offs)
    held = np.flatnonzero(~asks)
    values = np.concatenate([np.zeros(0, np.int64), *[flat[offs[i] : offs[i + 1]] for i in held]])
    owner = np.repeat(np.arange(len(held)), sizes[held])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    found = []
    for q in np.flatnonzero(asks):
        mine = flat[offs[q] : offs[q + 1]]
        begin, end = np.searchsorted(values, mine, "left"), np.searchsorted(values, mine, "right")
        hits = [owner[x:y] for x, y in zip(begin, end, strict=True) if y > x]
        if not hits:
            continue
        both = np.bincount(np.concatenate(hits), minlength=len(held))
        linked = (100 * both >= threshold * (sizes[held] + sizes[q] - both)) & (component[held] != component[q])
        if linked.any():
            at = held[linked]
            for i in at[np.unique(component[at], return_index=True)[1]]:
                found.append((min(node[q], node[i]), max(node[q], node[i])))
    kind = rows.schema.field("node").type
    return pa.table({"a": pa.array([x for x, _ in found], kind), "b": pa.array([y for _, y in found], kind)})


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The ``pairs`` (a, b) with 100 * intersection >= threshold * union."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    joined = pairs.join(left, "a").where(F.size("of_a") > 0).join(right, "b")
    # Sets of too different sizes cannot reach the threshold.
    near = F.least(F.size("of_a"), F.size("of_b")) * 100 >= threshold * F.greatest(F.size("of_a"), F.size("of_b"))
    return joined.where(near).select("a", "b", F.size("of_a").alias("na"), F.size("of_b").alias("nb"), shared.alias("both")).where(F.col("both") * 100 >= threshold * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b").distinct()


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The full sets of ``nodes``, from the texts."""
    nodes = stored(nodes.distinct())
    doc_id, kind = doc_id_of(docs)
    chosen = docs.select(doc_id, "text").join(small_or_shuffled(nodes.withColumnRenamed("node", "doc_id"), nodes.count()), "doc_id", "left_semi")
    return stored(chosen.mapInArrow(full_sets, f"node {kind}, shingles array<long>"))


def joined_with(links: DataFrame, component: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links and components with ``more`` links."""
    more = stored(more)
    if not more.head(1):
        return links, component
    links = links.unionByName(more)
    return links, stored(components(links))


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs``; with ``keep`` also these columns and the set's key."""
    doc_id, kind = doc_id_of(docs)
    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    signed = stored(docs.select(doc_id, "text", *keep).mapInArrow(signatures, SIGNATURE_SCHEMA.format(kind) + kinds))
    grouped = signed.where("n_shingles > 0").groupBy("key_a", "key_b", "n_shingles")
    classes = stored(grouped.agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("labels").alias("labels")))
    found = regions(classes.where("node is not null"))
    tested = stored(star_pairs(found))
    sets = sets_of(docs, tested.select(F.explode(F.array("a", "b")).alias("node")))
    links = stored(confirmed(tested, sets, threshold))
    component = stored(components(links))
    more = stored(neighbour_pairs(found, component, component.count()).join(tested, ["a", "b"], "left_anti"))
    links, component = joined_with(links, component, confirmed(more, sets, threshold))
    links, component = joined_with(links, component, crowded_links(found, component, component.count(), sets, threshold))
    # Classes of one document without links are left out: their document is its own component.
    linked = classes.join(small_or_shuffled(component, component.count()), "node", "left").where("copies > 1 or component is not null or node is null")
    linked = stored(linked.select("key_a", "key_b", "n_shingles", F.coalesce("component", "node").alias("component_id"), F.lit(True).alias("linked")))
    joined = signed.drop("labels").join(small_or_shuffled(linked, linked.count()), ["key_a", "key_b", "n_shingles"], "left")
    component_id = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id"))
    more = (*keep, "key_a", "key_b") if keep else ()
    return joined.select("doc_id", "n_shingles", component_id.alias("component_id"), *more).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def deduplicated(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each component: of its first document.

    Rows are told apart by doc_id and text. Where neither tells, as with copies without a doc_id, one row of each set of shingles
    stays; rows without words and doc_id are linked with nothing and all stay.
    """
    found = stored(near_duplicates(with_text_keys(docs), threshold, TEXT_KEYS))
    text = F.struct(*TEXT_KEYS)
    alike = found.where("kept and n_shingles > 0").groupBy("doc_id", "key_a", "key_b").agg(F.min(text).alias("first"), F.max(text).alias("last")).where("first != last")
    alike = stored(alike.select(F.col("doc_id").alias("__id"), F.col("key_a").alias("__a"), F.col("key_b").alias("__b"), "first"))
    others = found.where("kept").join(small_or_shuffled(alike, alike.count()), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key_a") == F.col("__a")) & (F.col("key_b") == F.col("__b")) & (text != F.col("first")))
    gone = found.where("not kept").select("doc_id", *TEXT_KEYS).unionByName(others.select("doc_id", *TEXT_KEYS))
    kind = docs.schema["doc_id"].dataType
    rest = with_text_keys(without(docs, gone.withColumn("doc_id", F.col("doc_id").cast(kind))))
    repeated = found.where("kept and (doc_id is not null or n_shingles > 0)").groupBy("doc_id", *TEXT_KEYS).count().where("count > 1")
    repeated = stored(repeated.select(F.col("doc_id").cast(kind).alias("__doc_id"), *[F.col(c).alias(f"_{c}") for c in TEXT_KEYS]))
    rows = repeated.count()
    if not rows:
        return rest.drop(*TEXT_KEYS)
    same = [F.col("doc_id").eqNullSafe(F.col("__doc_id")), *[F.col(c) == F.col(f"_{c}") for c in TEXT_KEYS]]
    once = rest.join(small_or_shuffled(repeated, rows), same, "left_semi").dropDuplicates(["doc_id", *TEXT_KEYS])
    return rest.join(small_or_shuffled(repeated, rows), same, "left_anti").unionByName(once).drop(*TEXT_KEYS)
