"""Fill-in-the-middle: texts cut in three, with the middle put last.

A text is worked on as bytes. ``bytes.translate`` maps each byte to its class, and the classes become one big integer with a bit
for each byte. Shifted boolean operations on such masks mark the bytes with which a unit (a code point, a word or a line)
begins, ``int.bit_count`` gives their number, and the byte of a given unit is found by halving: the bits of one half are
counted, and the search goes on in the half that holds the wanted one. All of it is linear in the text and holds a few bits
for each of its bytes; no list of units or offsets is made.

Where to cut, and the form, come from a hash of the seed and the doc_id, so reruns and retries agree. Rows never meet: there is
no shuffle, and any partitioning gives the same.

Defined cases: a null text is empty; an empty text, or one that holds a sentinel, stays plain, so all output can be read back;
equal rows give equal rows; a null doc_id hashes as the text "null"; doc_id may be of any type, hashed as Spark casts it to text;
an empty table gives an empty result; a text that is no valid UTF-8 is cut before bytes that can begin a code point; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .streams import streamed, typed

SEED = 1
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts so many are cut, and of 100 cut ones so many get their suffix first.
CUT, SUFFIX_FIRST = 90, 20

ZERO, ONE = b"01"
SPACE = {0x20, *range(0x09, 0x0E)}
#: The digit of each byte: whether it begins a code point, belongs to a word, ends a line.
BEGINS = bytes(ZERO if 0x80 <= b < 0xC0 else ONE for b in range(256))
SOLID = bytes(ZERO if b in SPACE else ONE for b in range(256))
ENDS = bytes(ONE if b == 0x0A else ZERO for b in range(256))


def mask(data: bytes, classes: bytes) -> int:
    """Bit i is that of byte i."""
    return int(data.translate(classes)[::-1], 2) if data else 0


def marks(data: bytes, unit: str) -> int:
    """The bytes with which a unit begins; the first byte always does."""
    if not data:
        return 0
    if unit == "character":
        return mask(data, BEGINS) | 1
    if unit == "word":
        solid = mask(data, SOLID)
        return solid & ~(solid << 1) | 1
    if unit == "line":
        return (mask(data, ENDS) << 1 | 1) & ((1 << len(data)) - 1)
    raise ValueError(f"no unit: {unit}")


def place(bits: int, k: int, width: int) -> int:
    """Where bit number ``k`` (from 0) of those set among ``width`` is; ``width`` if fewer are set."""
    if k >= bits.bit_count():
        return width
    at = 0
    while width > 1:
        half = width // 2
        low = bits & ((1 << half) - 1)
        n = low.bit_count()
        if k < n:
            bits, width = low, half
        else:
            bits, width, k, at = bits >> half, width - half, k - n, at + half
    return at


def cut(data: bytes, unit: str, first: int, second: int) -> tuple[int, int, int]:
    """The number of units and the bytes after which prefix and middle end."""
    begins = marks(data, unit)
    n = begins.bit_count()
    a, b = sorted((first % (n + 1), second % (n + 1)))
    return n, place(begins, a, len(data)), place(begins, b, len(data))


def characters(data: bytes) -> int:
    return mask(data, BEGINS).bit_count()


def formed(rows: Iterator[tuple], unit: str, rate: int, suffix_first: int) -> Iterator[tuple]:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of (doc_id, text, four hashes)."""
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    for doc_id, data, h1, h2, h3, h4 in rows:
        n, a, b = cut(data, unit, h1, h2)
        if not data or p in data or s in data or m in data or h3 % 100 >= rate:
            yield doc_id, n, "plain", None, None, data
            continue
        head, middle, tail = data[:a], data[a:b], data[b:]
        spm = h4 % 100 < suffix_first
        output = b"".join((s, tail, p, head, m, middle) if spm else (p, head, s, tail, m, middle))
        yield doc_id, n, "spm" if spm else "psm", characters(head), characters(middle), output


def hashes(seed: int) -> list[Column]:
    """Four numbers of 32 bits for each doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, unit: str = "character", seed: int = SEED, rate: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars (null: plain) and output, a row for each of ``docs``.

    ``unit`` is what is never cut apart: character, word (each begins one, with the white space behind it) or line.
    """
    marks(b"x", unit)
    asked = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), *hashes(seed))
    made = streamed(asked, lambda rows: formed(rows, unit, rate, suffix_first), typed(docs, "doc_id", "n long, form string, prefix_chars long, middle_chars long, output binary"))
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text behind an output: its parts lie between sentinels, which no cut text holds."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
