"""Repeated page noise: find its keys per book and take its lines out of the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text as T

# Element types that are noise by themselves.
NOISE_TYPES = ("header", "footer", "page_footnote", "page_number")
MIN_PAGES, SHORT_PAGES, SHORT_LENGTH, ASIDE_PAGES, ASIDE_LENGTH = 3, 5, 6, 4, 3
KEY_LENGTH, CONTAINED_LENGTH, CONTAINED_SLACK = 4, 6, 8
TOP, BAND, OVERHANG = 0.08, 0.10, 1.05


def at_top(y0: Column, y1: Column, height: Column) -> Column:
    """A plausible box near the top of its page, and not a tall one; false where something is unknown."""
    plausible = (y0 >= 0) & (y1 >= 0) & (y0 <= OVERHANG * height) & (y1 <= OVERHANG * height) & (height > 0)
    return F.coalesce(plausible & (y0 < TOP * height) & (y1 - y0 < BAND * height), F.lit(False))


def noise_keys(elements: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(book_id, key, n_noise, n_aside, n_top) of elements (book_id, type, text, y0, y1, height); counts occurrences.

    One aggregation with partial sums: a key on every page costs a row for each task.
    """
    is_noise_type, is_aside = F.col("type").isin(*NOISE_TYPES), F.col("type") == "aside_text"
    on_top = (F.col("type") == "text") & at_top(F.col("y0"), F.col("y1"), F.col("height"))
    # Most elements are none of these, so what is normalised and exchanged is little.
    flagged = elements.select("book_id", "text", is_noise_type.alias("noise"), is_aside.alias("aside"), on_top.alias("top"))
    keyed = flagged.where("noise or aside or top").withColumn("key", T.norm(F.col("text")))
    size = F.length("key")
    counts = keyed.where(size >= F.least(F.lit(ASIDE_LENGTH), F.lit(KEY_LENGTH))).groupBy("book_id", "key").agg(
        F.count_if("noise").alias("n_noise"),
        F.count_if(F.col("aside") & (size >= ASIDE_LENGTH)).alias("n_aside"),
        F.count_if("top").alias("n_top"),
    )
    often = (F.col("n_noise") >= min_pages) | ((F.col("n_noise") >= SHORT_PAGES) & (size <= SHORT_LENGTH)) | (F.col("n_aside") >= ASIDE_PAGES) | (F.col("n_top") >= min_pages)
    return counts.where(often & (size >= KEY_LENGTH))


def holds(line_key: Column, key: Column) -> Column:
    """The line's key is ``key``, or has it inside with little else if it is long enough."""
    inside = (F.length(key) >= CONTAINED_LENGTH) & (F.length(line_key) <= F.length(key) + CONTAINED_SLACK) & F.contains(line_key, key)
    return (line_key == key) | inside


def fragments(line_key: Column, shortest: Column, longest: Column) -> Column:
    """Hashes of the parts of a line's key that may be a key of ``shortest`` to ``longest`` characters: the whole, and what is
    left when up to ``CONTAINED_SLACK`` characters are taken off its ends. That is 45 at most, however long the line is or
    many keys there are, and each key that the line holds is one of them."""
    trims = [(a, b) for a in range(CONTAINED_SLACK + 1) for b in range(CONTAINED_SLACK + 1 - a)]
    ends = F.array(*[F.struct(F.lit(a).alias("before"), F.lit(a + b).alias("off")) for a, b in trims])
    size = F.length(line_key)
    fits = lambda t: (size - t["off"] >= F.when(t["off"] == 0, KEY_LENGTH).otherwise(F.greatest(shortest, F.lit(CONTAINED_LENGTH)))) & (size - t["off"] <= longest)
    some = F.transform(F.filter(ends, fits), lambda t: F.xxhash64(F.substring(line_key, t["before"] + 1, size - t["off"])))
    return F.when((size >= KEY_LENGTH) & (size <= longest + CONTAINED_SLACK), some).otherwise(F.array().cast("array<bigint>"))


def drop_fence_pairs(text: Column) -> Column:
    """Bare fences on neighbouring lines go in pairs, from the first on; of an odd run the last stays."""
    pair = r"(?m)^[ \t]*```[ \t]*\n[ \t]*```[ \t]*\n"
    return F.regexp_replace(F.regexp_replace(F.concat(text, F.lit("\n")), pair, ""), r"\n\z", "")


#: A page is told by its book and two hashes of its text: pages that agree in them lose the same lines.
_PAGE = ("__h1", "__h2")


def noisy_lines(pages: DataFrame, keys: DataFrame) -> DataFrame:
    """(book_id, __h1, __h2, __at, __noise): for each page of ``pages`` (book_id, text, hashes) with candidates the places (from 0) of
    lines that hold a fragment which is a key of its book, and what was found there (place, key).

    Keys are an index by book and hash, and fragments meet it in an equality join, so a line costs the same in a book of ten
    keys and of a million. The bounds of the lengths of a book's keys rule out most lines beforehand.
    """
    bounds = keys.groupBy("book_id").agg(F.min(F.length("key")).alias("shortest"), F.max(F.length("key")).alias("longest"))
    lined = pages.join(bounds, "book_id").withColumn("keys", F.transform(T.lines(F.col("text")), T.norm))
    at = lambda k, i: F.transform(fragments(k, F.col("shortest"), F.col("longest")), lambda h: F.struct(i.alias("place"), h.alias("hash")))
    each = lined.select("book_id", *_PAGE, F.explode(F.flatten(F.transform("keys", at))).alias("f")).select("book_id", *_PAGE, "f.place", "f.hash")
    index = keys.select("book_id", F.xxhash64("key").alias("hash"), "key")
    found = each.join(index, ["book_id", "hash"]).groupBy("book_id", *_PAGE).agg(F.collect_set(F.struct("place", "key")).alias("__noise"))
    return found.withColumn("__at", F.array_distinct(F.transform("__noise", lambda n: n["place"])))


def clean(pages: DataFrame, keys: DataFrame) -> DataFrame:
    """``pages`` (book_id, text, ...) with clean_text, n_lines, n_clean and n_removed.

    Texts stay in their row: candidates are found by hash (``noisy_lines``), and only the lines at their places are looked at again.
    """
    hashed = pages.withColumns({"__h1": F.xxhash64("text"), "__h2": F.hash("text")})
    found = noisy_lines(hashed.select("book_id", "text", *_PAGE), keys)
    joined = hashed.join(found, ["book_id", *_PAGE], "left").withColumn("__lines", T.lines(F.col("text")))
    is_noise = lambda x, i: F.array_contains("__at", i) & F.exists("__noise", lambda n: (n["place"] == i) & holds(T.norm(x), n["key"]))
    keep = lambda x, i: ~F.coalesce(is_noise(x, i), F.lit(False)) | (T.strip(x) == "") | T.is_fence(T.strip(x))
    joined = joined.withColumn("__kept", F.filter("__lines", keep))
    joined = joined.withColumn("clean_text", F.when(F.size("__kept") > 0, drop_fence_pairs(F.array_join("__kept", "\n"))).otherwise(""))
    n_clean = F.when((F.col("clean_text") == "") & (F.size("__kept") == 0), 0).otherwise(F.size(F.split("clean_text", "\n")))
    n_lines = F.size("__lines")
    counted = joined.withColumns({"n_lines": n_lines, "n_clean": n_clean, "n_removed": n_lines - n_clean})
    return counted.select(*pages.columns, "clean_text", "n_lines", "n_clean", "n_removed")


def cleaning_status(has_content: Column, has_text: Column, error: Column) -> Column:
    """What becomes of a directory: skipped without its parts, failed on an error, else cleaned."""
    return F.when(~has_content | ~has_text, "skipped").when(error.isNotNull(), "failed").otherwise("cleaned")
