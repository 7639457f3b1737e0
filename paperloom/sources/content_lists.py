"""Content lists (files that hold one JSON array each) as a stream of their elements.

``register(spark)`` adds the format ``content_list``. A file is read by one task, piece by piece, and never held whole: the memory
of a task is that of a piece, of the largest element and of a batch of rows, whatever the size of the file. The schema names the
members that are wanted, nothing else is built. Files are dealt out by size.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

PIECE = 1 << 20
ROWS = 2048
#: Bytes of small files that one task reads.
TASK_BYTES = 64 << 20
NAMES = "_content_list.json"
#: Characters of the longest escape or word of JSON, and a few more.
CUT = 16
_SPACE = " \t\r\n"


class Broken(ValueError):
    """The file holds no array, or its text breaks off."""


def elements(source, piece: int = PIECE) -> Iterator[object]:
    """The elements of the JSON array that the binary stream ``source`` holds, one after the other."""
    decode, parse = codecs.getincrementaldecoder("utf-8-sig")().decode, json.JSONDecoder().raw_decode
    text, at, ended = "", 0, False

    def more() -> bool:
        """Drops what was read and adds at least as much as is left, so that a long element costs its length, not its square."""
        nonlocal text, at, ended
        data = b"" if ended else source.read(max(piece, len(text) - at))
        ended = ended or not data
        text, at = text[at:] + decode(data, ended), 0
        return not ended

    def mark() -> str:
        nonlocal at
        while True:
            while at < len(text) and text[at] in _SPACE:
                at += 1
            if at < len(text):
                return text[at]
            if not more() and at >= len(text):
                return ""

    try:
        if mark() != "[":
            raise Broken("no array")
        at += 1
        if mark() == "]":
            at += 1
        else:
            while True:
                mark()
                while True:
                    try:
                        value, end = parse(text, at)
                        # A number near the end of what was read may go on, at most by a sign and a digit after its "." or "e".
                        if ended or len(text) - end > 2 or (end < len(text) and text[end] not in ".eE"):
                            break
                    except json.JSONDecodeError as e:
                        # Only what is cut off by the end of what was read is worth reading on for.
                        if ended or (len(text) - e.pos > CUT and not e.msg.startswith("Unterminated")):
                            raise
                    more()
                at = end
                yield value
                sign = mark()
                at += 1
                if sign == "]":
                    break
                if sign != ",":
                    raise Broken("no comma")
        if mark():
            raise Broken("text after the array")
    except (UnicodeDecodeError, json.JSONDecodeError, RecursionError) as e:
        raise Broken(str(e)) from e


def intact(source, piece: int = PIECE) -> bool:
    try:
        for _ in elements(source, piece):
            pass
        return True
    except Broken:
        return False


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def dealt(files: list[tuple[str, int]], most: int = TASK_BYTES) -> list[list[str]]:
    """Neighbours by name together up to ``most`` bytes; a larger file has a task of its own."""
    parts, room = [], 0
    for path, size in sorted(files):
        if not parts or size + 4096 > room:
            parts.append([])
            room = most
        parts[-1].append(path)
        room -= size + 4096
    return parts


class ContentLists(DataSource):
    @classmethod
    def name(cls) -> str:
        return "content_list"

    def schema(self) -> str:
        return "path string, elem_no long, type string, text string, bbox array<double>, page_idx int"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ContentListReader(schema, dict(self.options))


class ContentListReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.path, self.names = schema, options["path"], options.get("names", NAMES)
        self.piece = int(options.get("piece", PIECE))

    def _system(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.path if "://" in self.path else "file://" + self.path.removeprefix("file:"))

    def partitions(self) -> list[Files]:
        system, root = self._system()
        found = system.get_file_info(pafs.FileSelector(root, recursive=True))
        return [Files(p) for p in dealt([(f.path, f.size) for f in found if f.is_file and f.path.endswith(self.names)])] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = self._system()
        arrow = to_arrow_schema(self.schema)
        convert = [_converter(f.type) for f in arrow]
        for path in partition.paths:
            with system.open_input_stream(path) as source:
                if not intact(source, self.piece):
                    continue
            rows: list[tuple] = []
            with system.open_input_stream(path) as source:
                for no, value in enumerate(elements(source, self.piece)):
                    own = {"path": path, "elem_no": no}
                    value = value if isinstance(value, dict) else {}
                    rows.append(tuple(own[f.name] if f.name in own else to(value.get(f.name)) for f, to in zip(arrow, convert, strict=True)))
                    if len(rows) == ROWS:
                        yield _batch(rows, arrow)
                        rows = []
            if rows:
                yield _batch(rows, arrow)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _converter(kind: pa.DataType):
    """A member's value as ``kind``; null where it is of another kind."""
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        one = _converter(kind.value_type)
        return lambda v: [one(x) for x in v] if isinstance(v, list) else None
    if pa.types.is_boolean(kind):
        return lambda v: v if isinstance(v, bool) else None
    if pa.types.is_integer(kind):
        bound = 1 << (kind.bit_width - 1)
        return lambda v: v if isinstance(v, int) and not isinstance(v, bool) and -bound <= v < bound else None
    if pa.types.is_floating(kind):
        return lambda v: float(v) if isinstance(v, int | float) and not isinstance(v, bool) and abs(v) < 1e308 else None
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return lambda v: _text(v) if isinstance(v, str) else None if v is None else json.dumps(v, ensure_ascii=False)
    raise TypeError(f"content lists have no {kind}")


def _text(v: str) -> str:
    """Halves of surrogate pairs that stand alone cannot be stored; each becomes the replacement character."""
    return v if v.isascii() else v.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ContentLists)


def read(spark: SparkSession, path: str, columns: str | None = None, names: str = NAMES) -> DataFrame:
    """Elements of all files below ``path`` whose names end in ``names``.

    ``columns`` are members of the elements, with ``path`` and ``elem_no`` (from 0) for their place. A file that is no whole array
    gives no rows, an element that is no object gives a row of nulls, and so does a member of another type its null.
    """
    register(spark)
    reader = spark.read.format("content_list").option("names", names)
    return (reader.schema(columns) if columns else reader).load(path)


def write(rows: DataFrame, path: str) -> None:
    """Rows as content lists below ``path``, one for each partition, written line by line; names end in ``.txt``."""
    text = rows.selectExpr("to_json(struct(*)) AS value")
    text.mapInArrow(_as_array, "value string").write.mode("overwrite").text(path)


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lead = "["
    for batch in batches:
        lines = []
        for value in batch.column(0).to_pylist():
            lines.append(lead + value)
            lead = ","
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if lead == "[" else "]"], pa.string())], ["value"])
