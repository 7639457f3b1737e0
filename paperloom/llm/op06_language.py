"""Language of web pages by Bayesian fusion of text, declared language, address and host.

Four kinds of evidence are added as log likelihoods: the visible words under hashed models of three-letter groups per
language, trained on about ``MOST_EXAMPLES`` labelled documents; the language that the markup declares and the one that
the address names, each trusted as far as it agreed with the text over all pages; and a prior of the page's host, smoothed
towards that of its registered domain, which is smoothed towards the shares over all pages. Shares and trust are grouped
sums over all pages of the posteriors from the text alone.

The address names a language by its first path part or its subdomain, which are compared with the languages' codes, or by its
country. A registered domain is told by a rule (``registered``), not by a list of all suffixes.

Defined cases: null or empty html leaves declaration, address and host; a null url is the host ''; a declared or named
language that no labelled document has is no evidence; without labelled documents every language is null; repeated rows
agree; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import hashed_share
from .op08_templates import host_of
from .storage import small_or_shuffled, stored
from .tokens import LOWER, mix, pieces, string_column

BITS = 16
MOST_EXAMPLES = 4000
SMOOTHING = 0.5
#: Groups of letters in a row are not independent; their evidence counts by this factor.
TEMPER = 0.3
#: Pages that the prior of the level above counts as.
HOST_WEIGHT, DOMAIN_WEIGHT = 10.0, 10.0
#: Pages that a trust of one half counts as.
TRUST_WEIGHT = 4.0

# Kinds of organisation below which countries register names, and countries' suffixes by the language that most of
# their people write. Countries of several languages (be, ca, ch, in, sg, za ...) and suffixes used as words (io, me, tv) are not here.
ORGANISATIONS = frozenset("ac co com edu gob gouv gov go mil ne net nom or org sch".split())
COUNTRIES = {
    suffix: lang
    for lang, suffixes in {
        "ar": "ae bh dz eg iq jo kw lb ly ma om qa sa sd sy tn ye", "bg": "bg", "cs": "cz", "da": "dk", "de": "at de li", "el": "gr",
        "en": "au gb ie nz uk us", "es": "ar bo cl cr cu do ec es gt hn mx ni pa pe pr py sv uy ve", "et": "ee", "fa": "ir", "fi": "fi",
        "fr": "fr mc sn", "he": "il", "hr": "hr", "hu": "hu", "id": "id", "is": "is", "it": "it sm va", "ja": "jp", "ko": "kp kr",
        "lt": "lt", "lv": "lv", "nl": "nl sr", "no": "no", "pl": "pl", "pt": "ao br mz pt", "ro": "md ro", "ru": "ru su", "sk": "sk",
        "sl": "si", "sq": "al", "sr": "rs", "sv": "se", "th": "th", "tr": "tr", "uk": "ua", "vi": "vn", "zh": "cn hk mo tw",
    }.items()
    for suffix in suffixes.split()
}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|title)\b.*?(?:</\1\s*>|\Z)|<[^>]*>", re.S | re.I)
_MAIN = re.compile(r"<(?:article|main)\b(?:.*</(?:article|main)\s*>|.*\Z)", re.S | re.I)
_LANG = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([a-zA-Z]{2,3})""", re.I)


def letter_groups(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of all runs of three bytes within a row, in lower case."""
    low = LOWER[data].astype(np.uint64)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = row[:-2] == row[2:]
    h = mix(low[:-2] | low[1:-1] << np.uint64(8) | low[2:] << np.uint64(16))
    return row[2:][same], (h >> np.uint64(64 - BITS)).astype(np.int64)[same]


def count_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, at = string_column(batch, "lang").to_pylist(), 0
        for rows, data, offs in pieces(string_column(batch, "text")):
            row, bucket = letter_groups(data, offs)
            mine = np.array(langs[rows])
            for lang in set(langs[rows]):
                seen[lang] = seen.get(lang, 0) + np.bincount(bucket[mine[row] == lang], minlength=1 << BITS)
            at += len(offs) - 1
    for lang, n in seen.items():
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(n[used].astype(np.int64))], ["lang", "bucket", "n"])


def text_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and, by language, log probabilities of the buckets."""
    labelled = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    sample = labelled.where(hashed_share(F.col("doc_id"), 6) < min(1.0, MOST_EXAMPLES / max(1, docs.count()))).select("lang", "text")
    got = sample.mapInArrow(count_groups, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(got["lang"].to_pylist()))
    counts = np.full((len(langs), 1 << BITS), SMOOTHING)
    if langs:
        counts[np.searchsorted(langs, got["lang"].to_numpy(zero_copy_only=False).astype(str)), got["bucket"].to_numpy()] += got["n"].to_numpy()
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True))


def evidence(langs: list[str], model: np.ndarray):
    """For mapInArrow: host, domain, declared and named language, and the text's log likelihoods of each page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, pages = string_column(batch, "url").to_pylist(), string_column(batch, "html").to_pylist()
            hosts = [host_of(u) for u in urls]
            declared = [m.group(1).lower() if p and (m := _LANG.search(p)) else None for p in pages]
            named = [named_language(u, h, langs) for u, h in zip(urls, hosts, strict=True)]
            seen = [visible(p) for p in pages]
            scores = np.zeros((len(urls), len(langs)))
            for rows, data, offs in pieces(pa.array(seen, pa.string())):
                row, bucket = letter_groups(data, offs)
                for i in range(len(langs)):
                    scores[rows, i] = TEMPER * np.bincount(row, model[i][bucket], minlength=len(offs) - 1)
            scores -= scores.max(axis=1, keepdims=True) if len(langs) else 0
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(urls) + 1, dtype=np.int32) * len(langs)), pa.array(scores.ravel()))
            known = [[x if x in langs else None for x in column] for column in (declared, named)]
            columns = [string_column(batch, "page_id"), string_column(batch, "url"), pa.array(hosts, pa.string()), pa.array([registered(h) for h in hosts], pa.string()), *(pa.array(k, pa.string()) for k in known), lists]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "host", "domain", "declared", "named", "text_scores"])

    return read


def visible(page: str | None) -> str:
    """The text from the first article or main element to the last one's end, or of the whole page if there is none."""
    page = page or ""
    main = _MAIN.search(page)
    text = _MARKUP.sub(" ", main.group(0)) if main else ""
    return text if text.strip() else _MARKUP.sub(" ", page)


def named_language(url: str | None, host: str, langs: list[str]) -> str | None:
    """The language of the first path part or the subdomain, else that of the country that the address ends in."""
    path = re.split(r"[?#]", re.sub(r"^[a-z][a-z0-9+.-]*://[^/]*", "", (url or "").lower()))[0]
    labels = bare(host).split(".")
    parts = [x for x in path.split("/") if x][:1] + (labels[:1] if len(labels) > 2 else [])
    return next((x for x in [*parts, COUNTRIES.get(labels[-1]) if len(labels) > 1 else None] if x in langs), None)


def bare(host: str) -> str:
    """Without user and port."""
    return re.sub(r":\d*$", "", host.rsplit("@", 1)[-1]) if "]" not in host else host


def registered(host: str) -> str:
    """The domain of a host that one owner registers: the last two labels, or three below a kind of organisation of a country
    (``co.uk``); an address of numbers is its own."""
    labels = bare(host).split(".")
    if labels[-1].isdigit() or "]" in host:
        return host
    three = len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in ORGANISATIONS
    return ".".join(labels[-3:] if three else labels[-2:])


def softmax(scores: Column) -> Column:
    powers = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, y: a + y))


def languages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, url, host, declared, named, lang and probability for each row of ``pages``."""
    langs, model = text_model(docs)
    key = pages.schema["page_id"].dataType.simpleString()
    read = pages.select("page_id", "url", "html").mapInArrow(evidence(langs, model), f"page_id {key}, url string, host string, domain string, declared string, named string, text_scores array<double>")
    if not langs:
        return read.select("page_id", "url", "host", "declared", "named", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"))
    found = stored(read.withColumn("by_text", softmax(F.col("text_scores"))))
    size = range(len(langs))
    sums = [F.sum(F.get("by_text", F.lit(i))).alias(f"n{i}") for i in size]
    index = lambda column: F.array_position(F.array(*[F.lit(x) for x in langs]), F.col(column)) - 1
    agrees = lambda column: F.sum(F.get("by_text", index(column).cast("int")))
    total = found.agg(*sums, F.count("declared").alias("declared"), agrees("declared").alias("declared_right"), F.count("named").alias("named"), agrees("named").alias("named_right")).first()
    all_pages = sum(total[f"n{i}"] or 0.0 for i in size)
    shares = [((total[f"n{i}"] or 0.0) + 1) / (all_pages + len(langs)) for i in size]
    trust = {c: ((total[f"{c}_right"] or 0.0) + TRUST_WEIGHT / 2) / (total[c] + TRUST_WEIGHT) for c in ("declared", "named")}

    domains = stored(found.groupBy("domain").agg(*sums))
    hosts = stored(found.groupBy("domain", "host").agg(*sums))
    domain_share = F.array(*[(F.col(f"n{i}") + DOMAIN_WEIGHT * shares[i]) / (sum(F.col(f"n{j}") for j in size) + DOMAIN_WEIGHT) for i in size])
    above = domains.select("domain", domain_share.alias("above"))
    prior = F.array(*[F.log((F.col(f"n{i}") + HOST_WEIGHT * F.get("above", F.lit(i))) / (sum(F.col(f"n{j}") for j in size) + HOST_WEIGHT)) for i in size])
    priors = stored(hosts.join(small_or_shuffled(above, domains.count()), "domain").select("host", prior.alias("prior")))
    joined = found.join(small_or_shuffled(priors, priors.count()), "host")

    def told(column: str, i: int) -> Column:
        right, wrong = float(np.log(trust[column])), float(np.log((1 - trust[column]) / max(1, len(langs) - 1)))
        return F.when(F.col(column).isNull(), 0.0).when(F.col(column) == langs[i], right).otherwise(wrong)

    fused = F.array(*[F.get("text_scores", F.lit(i)) + F.get("prior", F.lit(i)) + told("declared", i) + told("named", i) for i in size])
    scored = joined.withColumn("posterior", softmax(fused))
    best = F.array_max("posterior")
    lang = F.get(F.array(*[F.lit(x) for x in langs]), (F.array_position("posterior", best) - 1).cast("int"))
    return scored.select("page_id", "url", "host", "declared", "named", lang.alias("lang"), best.alias("probability"))
