"""Calls of outside engines as ``mapInArrow`` stages with stand-ins that always answer alike.

A parser, a reviewer or an exporter is a function from a pandas frame to a pandas frame; what is around it stays in
Spark. ``slots`` bounds how many run at once. A frame is a piece of Spark's batch, bounded in rows and bytes, so that a task
holds the batch once, as Arrow, and no more than a piece of it as Python objects.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import TypeVar

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: What the cleaner's stand-in takes for a watermark.
MARK = "lorem"

#: Rows and bytes of a frame at most; a single row may have more bytes.
ROWS, BYTES = 500, 1 << 20

T = TypeVar("T")

REGISTRY: dict[str, tuple[Callable[[pd.DataFrame], pd.DataFrame], str]] = {}


def engine(name: str, schema: str):
    def add(f: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[pd.DataFrame], pd.DataFrame]:
        REGISTRY[name] = (f, schema)
        return f

    return add


def with_retries(f: Callable[[], T], tries: int = 3, wait: float = 3.0, transient: tuple[type[Exception], ...] = (ConnectionError, TimeoutError), sleep: Callable[[float], None] = time.sleep) -> T:
    """``f()``, again after ``wait``, twice ``wait`` and so on while it fails by what may pass; other errors end it at once."""
    for attempt in range(1, tries):
        try:
            return f()
        except transient:
            sleep(wait * attempt)
    return f()


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in turn, in halves until they are few and small."""
    if batch.num_rows <= 1 or (batch.num_rows <= ROWS and batch.nbytes <= BYTES):
        yield batch
    else:
        half = batch.num_rows // 2
        yield from pieces(batch.slice(0, half))
        yield from pieces(batch.slice(half))


def call(name: str, rows: DataFrame, slots: int | None = None) -> DataFrame:
    f, schema = REGISTRY[name]
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield pa.RecordBatch.from_pandas(f(piece.to_pandas()), arrow, preserve_index=False)

    return (rows.repartition(slots) if slots else rows).mapInArrow(run, schema)


@engine("parse", "doc_id long, elem_no int, type string, text string, page_idx int")
def parse_stub(rows: pd.DataFrame) -> pd.DataFrame:
    """Lines as text elements, forty to a page."""
    out = [(d, i, "text", line, i // 40) for d, t in zip(rows["doc_id"], rows["text"], strict=True) for i, line in enumerate((t or "").split("\n"))]
    return pd.DataFrame(out, columns=["doc_id", "elem_no", "type", "text", "page_idx"])


@engine("vision", "doc_id long, ok boolean, answer string")
def vision_stub(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": rows["doc_id"], "ok": True, "answer": ["空白" if not (t or "").strip() else "清晰" for t in rows["text"]]})


# Formats of export.
FORMATS = ("docx", "html", "epub", "pptx", "pdf")


@engine("export", "doc_id long, format string, ok boolean, n_bytes long")
def export_stub(rows: pd.DataFrame) -> pd.DataFrame:
    """The text as preformatted markup, whatever the format; formats that are not known fail."""
    import html

    ok = rows["format"].isin(FORMATS)
    n = [len(f"<pre>{html.escape(t or '')}</pre>".encode()) if good else None for t, good in zip(rows["text"], ok, strict=True)]
    return pd.DataFrame({"doc_id": rows["doc_id"], "format": rows["format"], "ok": ok, "n_bytes": pd.array(n, "Int64")})


# States of a file and what repairing it comes to.
REPAIRS = {"fine": (True, "ok"), "empty_password": (True, "ok"), "password": (False, "human"), "damaged": (True, "recovered"), "broken": (False, "unrepairable")}


@engine("repair", "doc_id long, ok boolean, message string")
def repair_stub(rows: pd.DataFrame) -> pd.DataFrame:
    """Outcomes by (doc_id, state); a file that is not there (no state) fails as missing."""
    found = [REPAIRS.get(s, (False, "missing")) for s in rows["state"]]
    return pd.DataFrame({"doc_id": rows["doc_id"], "ok": [ok for ok, _ in found], "message": [m for _, m in found]})


@engine("clean", "doc_id long, ok boolean, text string")
def clean_stub(rows: pd.DataFrame) -> pd.DataFrame:
    """An outside cleaner that drops lines of its mark; an empty result is a failure and leaves the text as it was."""
    out = []
    for d, t in zip(rows["doc_id"], rows["text"], strict=True):
        kept = "\n".join(x for x in (t or "").split("\n") if MARK not in x)
        out.append((d, True, kept) if kept.strip() else (d, False, t))
    return pd.DataFrame(out, columns=["doc_id", "ok", "text"])
