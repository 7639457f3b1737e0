"""Content lists as streams: any cut of the text, broken files, types, and memory that does not grow with the file."""

import io
import json
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.sources import content_lists as C

leaf = st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text()
value = st.recursive(leaf, lambda c: st.lists(c, max_size=4) | st.dictionaries(st.text(), c, max_size=4), max_leaves=8)


@settings(max_examples=150, deadline=None)
@given(st.lists(value, max_size=6), st.integers(1, 40), st.sampled_from([None, 2]), st.booleans())
def test_any_cut_gives_the_elements(rows, piece, indent, ascii_):
    text = json.dumps(rows, indent=indent, ensure_ascii=ascii_).encode("utf-8", "surrogatepass")
    try:
        text.decode()
    except UnicodeDecodeError:
        return
    assert list(C.elements(io.BytesIO(text), piece)) == rows


@pytest.mark.parametrize("text", [b"", b"{}", b"[", b"[1", b"[1,", b"[1,]", b"[1 2]", b'[{"a": 1}', b"[1] x", b'["\xff"]', b"nothing", b"[" * 100_000])
@pytest.mark.parametrize("piece", [1, 3, 1000])
def test_broken(text, piece):
    assert not C.intact(io.BytesIO(text), piece)


def test_memory_is_that_of_an_element():
    class Endless(io.RawIOBase):
        """A list of 40 MB that is made while it is read."""

        left, first = 400, True

        def read(self, n=-1):
            if not self.left:
                return b""
            self.left -= 1
            lead, self.first = (b"[" if self.first else b","), False
            return lead + b",".join([b'{"type": "text", "text": "' + b"x" * 960 + b'"}'] * 100) + (b"" if self.left else b"]")

    tracemalloc.start()
    assert sum(1 for _ in C.elements(Endless(), 1 << 16)) == 40_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2_000_000


def test_fault_is_told_where_it_is():
    class Long(io.RawIOBase):
        reads = 0

        def read(self, n=-1):
            self.reads += 1
            return b'[{"a": b}' if self.reads == 1 else b" " * 1000

    source = Long()
    assert not C.intact(source, 100)
    assert source.reads < 4


def test_dealt():
    assert C.dealt([("b", 10), ("a", 10), ("c", 99_000), ("d", 5)], 20_000) == [["a", "b"], ["c"], ["d"]]
    assert C.dealt([]) == []


def test_read(spark, tmp_path):
    (tmp_path / "x").mkdir()
    put = lambda name, text: (tmp_path / name).write_text(text, encoding="utf-8")
    put("x/b_content_list.json", '[{"type": "text", "text": "é", "bbox": [1, 2.5, null, "x"], "page_idx": 3, "more": {"a": 1}}, 7, {"text": {"a": [1]}, "page_idx": 2.0, "bbox": 1}]')
    put("x/a_content_list.json", "[]")
    put("x/broken_content_list.json", '[{"type": "text"}, ')
    put("x/other.json", '[{"type": "text"}]')
    put("lone_content_list.json", '[{"text": "\\ud83d", "page_idx": 99999999999}]')
    got = {(r["path"].rsplit("/", 1)[1][0], r["elem_no"]): tuple(r)[2:] for r in C.read(spark, str(tmp_path)).collect()}
    assert got == {("b", 0): ("text", "é", [1.0, 2.5, None, None], 3), ("b", 1): (None, None, None, None), ("b", 2): (None, '{"a": [1]}', None, None), ("l", 0): (None, "�", None, None)}
    few = C.read(spark, "file://" + str(tmp_path), "page_idx int, type string")
    assert few.columns == ["page_idx", "type"] and few.where("type = 'text'").count() == 1
    assert C.read(spark, str(tmp_path), names=".nothing").count() == 0


def test_round_trip(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, repeat('ä\"\\n', int(id % 5))) AS text").repartition(3)
    C.write(rows, str(tmp_path / "out"))
    back = C.read(spark, str(tmp_path / "out"), "id long, text string", ".txt")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in rows.collect())
