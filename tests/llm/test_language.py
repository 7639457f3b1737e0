"""Languages: addresses, and the whole fusion against the same sums in plain Python."""

import math
from collections import defaultdict

import numpy as np
import pytest

from paperloom.llm import op06_language as L
from paperloom.llm.op08_templates import host_of
from paperloom.llm.tokens import mix


@pytest.mark.parametrize(
    "host, domain",
    [("a.b.example.com", "example.com"), ("www.shop.co.uk", "shop.co.uk"), ("co.uk", "co.uk"), ("shop.uk", "shop.uk"), ("x.shop.com.br", "shop.com.br"), ("com.com", "com.com"), ("a.co.com", "co.com"), ("10.0.0.7", "10.0.0.7"), ("u@www.a.se:8080", "a.se"), ("[::1]", "[::1]"), ("localhost", "localhost"), ("", "")],
)
def test_registered(host, domain):
    assert L.registered(host) == domain


@pytest.mark.parametrize(
    "url, lang",
    [
        ("https://example.com/de/x", "de"), ("https://fr.example.com/x", "fr"), ("https://example.at/x", "de"), ("https://example.se/", "sv"), ("https://example.com.sv/", "es"), ("https://x.example.ca/", None),
        ("https://example.at/fr/x", "fr"), ("https://example.jp/", None), ("https://example.se:80/", "sv"), ("https://de.com/", None), ("https://example.com/?q=/de/", None), (None, None), ("", None),
    ],
)
def test_named(url, lang):
    assert L.named_language(url, host_of(url), ["ca", "de", "en", "es", "fr", "sv"]) == lang


def groups(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    codes = np.array([low[i] | low[i + 1] << 8 | low[i + 2] << 16 for i in range(len(low) - 2)], np.uint64)
    return (mix(codes) >> np.uint64(64 - L.BITS)).astype(int).tolist() if len(codes) else []


def softmax(x):
    top = [math.exp(v - max(x)) for v in x]
    return [v / sum(top) for v in top]


def test_fusion_is_that_of_plain_python(spark):
    said = {"de": "der die das und ist nicht ein eine Straße Wetter morgen", "en": "the and is not a house weather tomorrow with of", "fr": "le la les et est pas une maison demain avec été"}
    docs = [(i, " ".join(said[lang].split()[i % 5 :]), lang) for i, lang in enumerate(["de", "en", "fr"] * 8)] + [(90, None, "de"), (91, "der die", None)]
    pages = []
    for i in range(60):
        lang = ["de", "en", "fr"][(i // 7) % 3]
        words = said[lang if i % 5 else "en"].split()
        declared = ["", f' lang="{lang}"', ' lang="EN"', ' lang="xx"'][i % 4]
        url = [f"https://{lang}.site{i % 4}.co.uk/p{i}", f"https://h{i % 3}.site{i % 4}.co.uk/p{i}", f"https://one.example.at/{i}", f"http://x{i % 2}.example.com/{lang}/{i}", None][i % 5]
        pages.append((i, url, f"<html{declared}><body>menu <article>{' '.join(words[i % 6 : i % 6 + 3])}</article></body></html>" if i % 11 else None))
    got = {r["page_id"]: r for r in L.languages(spark.createDataFrame(pages, "page_id long, url string, html string"), spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}

    langs = sorted(said)
    counts = {lang: defaultdict(lambda: L.SMOOTHING) for lang in langs}
    for _, text, lang in docs:
        for g in groups(text) if text and lang else []:
            counts[lang][g] += 1
    whole = {lang: sum(c.values()) + L.SMOOTHING * ((1 << L.BITS) - len(c)) for lang, c in counts.items()}
    facts = []
    for no, url, html in pages:
        host = host_of(url)
        tag = L._LANG.search(html or "")
        declared = tag.group(1).lower() if tag and tag.group(1).lower() in langs else None
        scores = [L.TEMPER * sum(math.log(counts[lang].get(g, L.SMOOTHING) / whole[lang]) for g in groups(L.visible(html))) for lang in langs]
        facts.append((no, host, L.registered(host), declared, L.named_language(url, host, langs), scores, softmax(scores)))
    assert len({f[2] for f in facts}) == 7 and len({f[1] for f in facts}) > 8
    sums = lambda of: [sum(f[6][i] for f in facts if of(f)) for i in range(3)]
    total = sums(lambda f: True)
    shares = [(n + 1) / (sum(total) + 3) for n in total]
    trust = {}
    for column in (3, 4):
        told = [f for f in facts if f[column]]
        trust[column] = (sum(f[6][langs.index(f[column])] for f in told) + L.TRUST_WEIGHT / 2) / (len(told) + L.TRUST_WEIGHT)
    for no, host, domain, declared, named, scores, _ in facts:
        of_domain, of_host = sums(lambda f: f[2] == domain), sums(lambda f: f[1] == host)
        above = [(of_domain[i] + L.DOMAIN_WEIGHT * shares[i]) / (sum(of_domain) + L.DOMAIN_WEIGHT) for i in range(3)]
        prior = [math.log((of_host[i] + L.HOST_WEIGHT * above[i]) / (sum(of_host) + L.HOST_WEIGHT)) for i in range(3)]
        told = lambda column, x, i: 0.0 if x is None else math.log(trust[column] if x == langs[i] else (1 - trust[column]) / 2)
        want = softmax([scores[i] + prior[i] + told(3, declared, i) + told(4, named, i) for i in range(3)])
        r = got[no]
        assert (r["host"], r["declared"], r["named"]) == (host, declared, named)
        assert r["lang"] == langs[want.index(max(want))] and r["probability"] == pytest.approx(max(want), abs=1e-9)
