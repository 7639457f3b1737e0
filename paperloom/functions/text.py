"""Column expressions on text: normal form, lines, markers and references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the normal form of a line leaves out besides white space.
PUNCTUATION = ".,，。！!？?、；;：:()（）[]【】\"'“”‘’·…-—_=+*★☆●○■□"
LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
FENCE = "```"
IMAGE_REF = r"!\[[^\]]*\]\(([^)]+)\)"
EMBED_REF = r"!\[[^\]]*\]\(images/([^)\s]+)\)"
UNSAFE = r'[<>:"/\\|?*]'


#: White space, as ranges of a pattern's class.
SPACES = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def norm(text: Column) -> Column:
    """The key of a line: lower case, without white space and punctuation.

    Letters and digits are passed over by a first look, so the long class is tried on what is likely in it.
    """
    escaped = "".join("\\" + c if c in r".()[]-+*?!" else c for c in PUNCTUATION)
    return F.lower(F.regexp_replace(text, f"(?![a-zA-Z0-9\xc0-\u024f\u4e00-\u9fff])[{SPACES}\ufeff{escaped}]", ""))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def lines(text: Column) -> Column:
    """Lines without their ends; a trailing end makes no further line, and an empty text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), LINE_ENDS)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def count_of(text: Column, part: str) -> Column:
    """How often ``part`` occurs, without overlaps."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def single_dollars(text: Column) -> Column:
    """Unescaped dollar signs that are left when pairs of dollar signs are taken out."""
    rest = F.replace(text, F.lit("$$"), F.lit(""))
    return count_of(rest, "$") - count_of(rest, "\\$")


def dollar_runs(text: Column) -> Column:
    """Runs of dollar signs, without single ones that are escaped."""
    runs = F.regexp_extract_all(text, F.lit(r"\\?\$+"), 0)
    return F.size(F.filter(runs, lambda x: x != "\\$"))


def image_refs(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(IMAGE_REF), 1)


def embed_refs(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(EMBED_REF), 1)


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, UNSAFE, "_")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def extension(path: Column) -> Column:
    """With its dot, in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(basename(path), r".(\.[^.]*)$", 1))


def is_fence(line: Column) -> Column:
    return F.ltrim(line).startswith(FENCE)
