"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its block elements (the path of tags with their class and id) and all its text blocks. For each host the
occurrence vector of a token, how often each page has it, is folded into sums that any order of pages gives alike: pages,
occurrences and a sum of hashes of (page, occurrences). Tokens with equal vectors are an equivalence class. A class is
valid if it has several tokens on at least ``SUPPORT`` of the host's pages; valid classes nest by their tokens' paths into
the host's template. Text blocks that nearly all pages of a host share are the template's constants; what varies between
template elements are slots. The main slot is the innermost element that occurs once a page, in a valid class, and holds
``MAIN_SHARE`` of the host's varying text outside links and ``LEAST_SHARE`` of a page's whole text outside links; no list of
names has a say in it.

The text of a page is that of its host's main slot, whatever the elements around the slot are called. Only within the slot
tags and names tell menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments that are left
out, and nothing else of it is, however many pages share it. A page that lacks the slot gives its article or else its body,
but for constants of the template, without what tags and names mark. A form that holds most of a page's text is the page's
frame and no form to leave out.

Vectors are added up before the shuffle, so a host with a third of all pages is no burden; each host contributes one row
to the join with the pages.

Defined cases: null or empty html gives an empty text; a null url is the host ''; hosts of one page show
no template, so tags and names tell their text; broken markup is read as far as it goes; very long pages are read whole; equal shares fall to
articles, then to the inner element, then to the later path; repeated rows give the same text; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import small_or_shuffled, stored
from .tokens import string_column

SUPPORT = 0.5
#: Shares that the main slot holds at least: of the host's varying text, and of a page's text, averaged over pages.
MAIN_SHARE, LEAST_SHARE = 0.7, 0.5
#: A text block is a constant of the template if such a share of the host's pages has it.
CONSTANT_SHARE = 0.95

# HTML elements that don't begin a block, and those without content.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements and words in class or id that mark what is not main text.
ASIDE_TAGS = frozenset("aside audio button canvas dialog footer form head iframe menu nav noscript object script select style svg template textarea title video".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus foot footer login masthead menu modal nav navbar navigation newsletter"
    " notice notices pager pagination popup promo related respond search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: These are part of the main text inside an article.
HEAD_WORDS = frozenset({"header", "masthead", "banner"})
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<!(?:[^>]*)>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORD = re.compile(r"[a-z]+")


#: Elements that hold text; a name marks them only if it is a word of the list as a whole.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th".split())


class Block:
    """A text block: its path, how deep the innermost element is that marks it as aside (0: none), its form (0: none)."""

    __slots__ = ("path", "depth", "form", "text", "linked")

    def __init__(self, path: tuple[str, ...], depth: int, form: int, text: str, linked: int):
        self.path, self.depth, self.form, self.text, self.linked = path, depth, form, text, linked

    def aside(self, within: int = 0) -> bool:
        """Whether it is left out of an element at this depth."""
        return self.depth > within


def is_aside(tag: str, names: str, inside: bool) -> bool:
    """Whether tag or names mark an element as not main text."""
    if tag in ("html", "body", "article", "main"):
        return False
    if tag in ASIDE_TAGS or tag == "header" and not inside:
        return True
    marks = ASIDE_WORDS - HEAD_WORDS if inside else ASIDE_WORDS | {"header"}
    return bool(marks.intersection(names.split() if tag in TEXT_TAGS else _WORD.findall(names)))


def read_blocks(page: str) -> tuple[list[Block], Counter]:
    """The text blocks of a page in order, and how often each element path occurs."""
    blocks: list[Block] = []
    elements: Counter = Counter()
    stack: list[tuple[str, str, bool, int]] = []  # tag, name with class and id, whether it is aside, form
    held: list[str] = []
    links = linked = forms = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                depth = max((i + 1 for i, x in enumerate(stack) if x[2]), default=0)
                blocks.append(Block(tuple(x[1] for x in stack), depth, next((x[3] for x in stack if x[3]), 0), text, linked))
            held.clear()
        linked = 0

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
            linked += (m.start() - at) * (links > 0)
        at = m.end()
        if not m.group(3):
            continue
        tag, closing = m.group(3).lower(), bool(m.group(2))
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            elif tag in ("br", "img", "wbr", "input"):
                held.append(" ")
            continue
        flush()
        if closing:
            if any(x[0] == tag for x in stack):
                while stack.pop()[0] != tag:
                    pass
            links = 0
            continue
        if tag in CLOSES_P and stack and stack[-1][0] == "p" or tag in ("li", "option", "tr", "td", "th", "dt", "dd") and stack and stack[-1][0] == tag:
            stack.pop()
        if tag in VOID:
            continue
        names = " ".join(v for x in _NAMES.finditer(m.group(4)) for v in x.groups()[1:] if v).lower()
        inside = any(x[0] in ("article", "main") for x in stack)
        forms += tag == "form"
        name = tag + ("." + re.sub(r"[0-9]+", "0", "-".join(names.split())) if names else "")
        stack.append((tag, name, is_aside(tag, names, inside), forms if tag == "form" else 0))
        elements[tuple(x[1] for x in stack)] += 1
    held.append(page[at:])
    if page.rfind("<") >= at and "<" in page[at:]:  # markup that breaks off
        held[-1] = page[at:].split("<", 1)[0] if re.match(r"<[a-zA-Z/!]", page[page.index("<", at) :]) else page[at:]
    flush()
    return unframed(blocks), elements


def unframed(blocks: list[Block]) -> list[Block]:
    """The blocks, whose form does not mark them if it holds more than half of the page's text."""
    size: Counter = Counter()
    for b in blocks:
        size[b.form] += len(b.text)
    frame = next((form for form, n in size.items() if form and 2 * n > size.total()), 0)
    for b in blocks:
        if frame and b.form == frame and b.path[b.depth - 1].split(".")[0] == "form":
            b.depth = 0
    return blocks


def host_of(url: str | None) -> str:
    return re.sub(r"^[a-z][a-z0-9+.-]*://|[/?#].*$", "", re.sub(r"^[\x00-\x20]+|[\x00-\x20]+$", "", url or "").lower(), flags=re.S)


def host_column(url: Column) -> Column:
    """What ``host_of`` gives."""
    trimmed = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[\x00-\x20]+|[\x00-\x20]+$", ""))
    return F.regexp_replace(trimmed, r"(?s)^[a-z][a-z0-9+.-]*://|[/?#].*$", "")


def page_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page its elements ('e') with their share of the text outside links, and its text blocks ('t') with its size."""
    for batch in batches:
        out: list[tuple] = []
        for key, host, page in zip(string_column(batch, "page_id").to_pylist(), string_column(batch, "host").to_pylist(), string_column(batch, "html").to_pylist(), strict=True):
            blocks, elements = read_blocks(page or "")
            chars: Counter = Counter()
            texts: Counter = Counter()
            for b in blocks:
                plain = max(0, len(b.text) - b.linked) * (b.path[-1:] not in (("script",), ("style",)))
                texts["/".join(b.path), b.text, plain] += 1
                for d in range(len(b.path) + 1):
                    chars[b.path[:d]] += plain
            elements[()] = 1
            whole = max(1, chars[()])
            for path, n in elements.items():
                main = bool(path) and path[-1].split(".")[0] in ("article", "main")
                out.append((host, "e", "/".join(path), "", len(path), n, vector(key, n), chars[path] / whole, main))
            for (path, text, plain), n in texts.items():
                out.append((host, "t", text_token(path, text), path, 0, n, vector(key, n), float(plain * n), False))
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _TOKENS, strict=True)], schema=_TOKENS)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _TOKENS, strict=True)], schema=_TOKENS)


_TOKENS = pa.schema([("host", pa.string()), ("kind", pa.string()), ("token", pa.string()), ("path", pa.string()), ("depth", pa.int32()), ("times", pa.int64()), ("vector", pa.int64()), ("chars", pa.float64()), ("main", pa.bool_())])


def vector(page: int | None, times: int) -> int:
    """A page's part of an occurrence vector's sum; 40 bits, so that sums over many pages fit."""
    return int.from_bytes(hashlib.blake2b(f"{page}:{times}".encode(), digest_size=5).digest(), "big")


def text_token(path: str, text: str) -> str:
    return hashlib.blake2b(f"{path}\n{text}".encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def templates(pages: DataFrame) -> DataFrame:
    """(host, main, constants) of each host: the path of the main slot, null if none, and text tokens of the template."""
    read = pages.select("page_id", host_column(F.col("url")).alias("host"), "html")
    made = read.mapInArrow(page_tokens, "host string, kind string, token string, path string, depth int, times long, vector long, chars double, main boolean")
    sums = made.groupBy("host", "kind", "token").agg(
        F.count("*").alias("pages"), F.sum("times").alias("times"), F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"), F.max("depth").alias("depth"),
        F.sum("chars").alias("chars"), F.max("main").alias("main"), F.max("path").alias("path"),
    )
    sums = stored(sums)
    sizes = sums.where("kind = 'e' and token = ''").select("host", F.col("pages").alias("host_pages"))
    sized = sums.join(small_or_shuffled(sizes, sizes.count()), "host")
    constant = (F.col("kind") == "t") & (F.col("host_pages") > 1) & (F.col("pages") >= CONSTANT_SHARE * F.col("host_pages"))
    # The varying text of each path, and so of each element on it.
    varying = sized.where((F.col("kind") == "t") & ~constant).groupBy("host", "path").agg(F.sum("chars").alias("chars"))
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    varying = varying.select("host", F.explode(F.array_distinct(above)).alias("token"), "chars").groupBy("host", "token").agg(F.sum("chars").alias("varying"))
    varying = stored(varying)
    whole = varying.where("token = ''").select("host", F.col("varying").alias("whole"))
    frequent = stored(sized.where(F.col("pages") >= SUPPORT * F.col("host_pages")))
    classes = frequent.groupBy("host", "pages", "times", "vector").agg(F.count("*").alias("tokens"))
    valid = frequent.join(classes.where("tokens >= 2"), ["host", "pages", "times", "vector"])
    valid = valid.join(varying, ["host", "token"], "left").join(small_or_shuffled(whole, whole.count()), "host", "left")
    share = F.col("chars") / F.col("pages")
    most = F.when(F.col("whole") > 0, F.coalesce("varying", F.lit(0.0)) / F.col("whole")).otherwise(share)
    tag = F.regexp_extract("token", r"([^/.]+)[^/]*$", 1)
    slot = (F.col("kind") == "e") & (F.col("depth") > 0) & (F.col("host_pages") > 1) & ~tag.isin(sorted(TEXT_TAGS)) & (F.col("times") == F.col("pages")) & (share >= LEAST_SHARE) & (most >= MAIN_SHARE)
    return valid.groupBy("host").agg(
        F.max_by(F.when(slot, F.col("token")), F.when(slot, F.struct("main", "depth", "token"))).alias("main"),
        F.collect_set(F.when(constant, F.col("token"))).alias("constants"),
    )


def main_text(page: str | None, main: str | None, constants: list[str]) -> str:
    blocks, _ = read_blocks(page or "")
    path = tuple(main.split("/")) if main else ()
    inside = [b for b in blocks if b.path[: len(path)] == path and not b.aside(len(path))] if path else []
    if not inside:
        body = [b for b in blocks if not b.aside()]
        inside = [b for b in body if any(n.split(".")[0] in ("article", "main") for n in b.path)]
        inside = inside or [b for b in body if text_token("/".join(b.path), b.text) not in constants] or body
    return "\n\n".join(b.text for b in inside)


def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(string_column(batch, c).to_pylist() for c in ("html", "main", "constants")), strict=True)
        texts = pa.array([main_text(page, main, constants or []) for page, main, constants in rows], pa.string())
        yield pa.RecordBatch.from_arrays([string_column(batch, "page_id"), string_column(batch, "url"), texts], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for each row of ``pages``."""
    found = stored(templates(pages))
    joined = pages.select("page_id", "url", "html", host_column(F.col("url")).alias("host")).join(small_or_shuffled(found, found.count()), "host", "left")
    key = pages.schema["page_id"].dataType.simpleString()
    texts = joined.select("page_id", "url", "html", "main", "constants").mapInArrow(extracted, f"page_id {key}, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
