"""The operators against brute force, held-out labels and odd inputs."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from paperloom.llm import op01_importance, op02_mixing_lm, op03_decontamination, op04_mixing, op05_toxicity, op06_language, op07_near_dedup, op08_templates, op09_quality_rules, op10_licenses
from paperloom.llm.graph import components
from paperloom.llm.queries import ORACLES, QUERIES

from ..helpers import canonical, connect
from .conftest import SCHEMA, prose

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def frame(spark, texts, start=0):
    rows = [(i + start, t, "en", "s", None, None, None, None, None, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# ---- all of them on odd and empty tables


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(0, prose(2, 30_000)[400:700]), (1, None), (None, ""), (2, "one")], "item_id long, text string")


def operators(labels, items):
    return {
        "importance": lambda d: op01_importance.importance(d, labels),
        "lm": op02_mixing_lm.scores,
        "contamination": lambda d: op03_decontamination.contamination(d, items),
        "mix": op04_mixing.mix_plan,
        "toxicity": lambda d: op05_toxicity.toxicity(d, labels),
        "near": op07_near_dedup.near_duplicates,
        "quality": op09_quality_rules.quality,
        "licences": op10_licenses.licences,
    }


@pytest.mark.parametrize("name", ["importance", "lm", "contamination", "mix", "toxicity", "near", "quality", "licences"])
def test_odd_and_empty(odd_docs, no_docs, odd_labels, items, name):
    op = operators(odd_labels, items)[name]
    got = op(odd_docs)
    assert sorted(str(r["doc_id"]) for r in got.select("doc_id").collect()) == sorted(str(r["doc_id"]) for r in odd_docs.select("doc_id").collect())
    empty = op(no_docs)
    assert empty.count() == 0 and empty.columns == got.columns


def test_text_ids(spark):
    """doc_id may be text, which gives what numbers give."""
    texts = [prose(1, 60), prose(1, 60), "one two", prose(2, 60) + " end", prose(2, 60)] + [prose(40 + i, 30) for i in range(6)]
    docs = frame(spark, texts, 10)
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    labels = spark.createDataFrame([(10 + i, i % 2, i % 2) for i in range(11)], "doc_id long, quality int, toxic int")
    of_named = labels.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    near = {r["doc_id"]: r["component_id"] for r in op07_near_dedup.near_duplicates(docs).collect()}
    assert {r["doc_id"]: r["component_id"] for r in op07_near_dedup.near_duplicates(named).collect()} == {f"d{k}": f"d{v}" for k, v in near.items()}
    assert near[11] == 10 and near[14] == 13 and near[12] == 12
    for got in (op01_importance.importance(named, of_named), op05_toxicity.toxicity(named, of_named)):
        assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(f"d{i}" for i in near)


def test_ties_at_the_edge(spark):
    """However many sums are equal at the k-th place, just k are drawn, and null ids get a verdict."""
    docs = frame(spark, ["same words in all of them"] * 6000 + ["junk %% junk"] * 3).unionByName(frame(spark, [None]).withColumn("doc_id", F.lit(None).cast("long")))
    found = docs.select("doc_id", F.lit(1.0).alias("key"))
    edge, ties = op01_importance.kth_greatest(found, 5000)
    by_hash = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(op01_importance.SEED + 1)), 11).cast("double")
    last, _ = op01_importance.kth_greatest(found.select(by_hash.alias("key")), ties)
    assert edge == 1.0 and ties == 5000 and found.where(by_hash >= last).count() == 5000
    labels = spark.createDataFrame([(i, 1) for i in range(50)] + [(6000 + i, 0) for i in range(3)], "doc_id long, quality int")
    assert op01_importance.importance(docs, labels).where("kept is null").count() == 0


def test_visible_text():
    """All articles of a page, nested ones too, are evidence of its language, and the whole page if they are empty."""
    page = "<body><p>menu</p><article><h2>one</h2></article><article>two <article>three</article> four</article><footer>foot</footer></body>"
    assert op06_language.visible(page).split() == ["one", "two", "three", "four"]
    assert op06_language.visible("<body>all <article> </article></body>").split() == ["all"] and op06_language.visible(None) == ""


def test_filters_keep_columns(odd_docs, no_docs, odd_labels, items):
    for stage in (
        lambda d: op01_importance.resampled(d, odd_labels),
        op09_quality_rules.filter_quality,
        op07_near_dedup.deduplicated,
        lambda d: op03_decontamination.decontaminated(d, items),
    ):
        assert stage(odd_docs).columns == odd_docs.columns
        assert stage(no_docs).count() == 0


# ---- 1


def test_importance(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = op01_importance.importance(docs, labels).collect()
    got = {r["doc_id"]: r["kept"] for r in rows}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    good = [got[i] for i, q in truth.items() if q == 1]
    bad = [got[i] for i, q in truth.items() if q == 0]
    unlabelled = [got[i] for i in got if i not in truth]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.5 * len(bad) and sum(unlabelled) >= 0.85 * len(unlabelled)
    # The kept ones are those with the greatest sums.
    assert min(r["key"] for r in rows if r["kept"]) >= max(r["key"] for r in rows if not r["kept"])


def test_kth_greatest(spark):
    values = [float(x) for x in [5, 1, 9, 9, 9, 3, -2, 7, 7, 0.5]]
    sums = spark.createDataFrame([(x,) for x in values], "key double")
    for k in range(1, len(values) + 1):
        edge, ties = op01_importance.kth_greatest(sums, k)
        ranked = sorted(values, reverse=True)
        assert edge == ranked[k - 1] and ties == k - sum(x > edge for x in values)


# ---- 2


def test_lm_scores(spark):
    docs = documents(spark)
    counts = Counter()
    for i, t in docs:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*words(t.translate(LOWER)), "\n"])
    n, v = sum(counts.values()), len(counts)
    got = op02_mixing_lm.scores(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    text = dict(docs)
    for r in got:
        tokens = [*words(text[r["doc_id"]].translate(LOWER)), "\n"]
        assert r["n_tokens"] == len(tokens) and r["train_tokens"] == n
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), rel_tol=1e-9)
        assert r["score"] < 0
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_huffman_codes_are_complete():
    import numpy as np

    counts = np.array([5.0, 1, 1, 7, 3])
    tree = op02_mixing_lm.paths(*op02_mixing_lm.huffman(counts), counts)
    assert math.isclose(sum(2.0**-n for n in tree.size), 1.0)
    codes = [f"{int(c):032b}"[:n] for c, n in zip(tree.code, tree.size, strict=True)]
    assert all(i == j or not a.startswith(b) for i, a in enumerate(codes) for j, b in enumerate(codes))


def brute_scores(rows):
    """The model's score from dictionaries of contexts, a bit at a time."""
    import numpy as np

    m = op02_mixing_lm
    tokens = {i: words((t or "").translate(LOWER)) for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    known = {w for w, n in counts.items() if n > 1}  # fewer than VOCABULARY
    from paperloom.llm.tokens import words as arrow_words
    import pyarrow as pa

    every = sorted({w for ws in tokens.values() for w in ws})
    hashed = dict(zip(every, next(arrow_words(pa.array([" ".join(every)]))).hash.tolist(), strict=True))
    order = sorted(known, key=lambda w: (-counts[w], hashed[w]))
    docs = sum(not h for h in held.values())
    buckets = np.zeros(1 << m.TRIE)
    for w, n in counts.items():
        if w not in known:
            buckets[hashed[w] >> (64 - m.TRIE)] += n
    total = sum(counts.values()) + docs
    model = m.built(*m.packed(np.sort([np.uint64(hashed[w]) for w in order]), np.zeros(len(order), int), np.array([float(counts[w]) for w in order]), buckets, docs, total, np.ones(257))["parts"])
    place = {w: i for i, w in enumerate(order)}

    def path(w):
        symbol = len(order) if w is None else place.get(w, len(order) + 1 + (hashed[w] >> (64 - m.TRIE)) if w not in place else 0)
        return symbol, f"{int(model.tree.code[symbol]):032b}"[: int(model.tree.size[symbol])]

    seen = Counter()
    for i, ws in tokens.items():
        for at, w in enumerate([*ws, None]):
            before = [None, None, *ws][at : at + 2]
            for context in ((before[1],), tuple(before)):
                code = path(w)[1]
                seen.update((context, code[:d]) for d in range(len(code) + 1)) if not held[i] else None
    once = sum(n == 1 for n in counts.values())
    unseen = once / (buckets.sum() + once)
    out = {}
    for i, ws in tokens.items():
        weights, nats, gradient, cells = m.first_weights().astype(float), 0.0, np.zeros((m.GATES, m.INPUTS)), Counter()
        for at, w in enumerate([*ws, None]):
            if at and at % m.BLOCK == 0:
                for g, n in cells.items():
                    weights[g] += m.RATE / math.sqrt(n) * gradient[g]
                gradient, cells = np.zeros((m.GATES, m.INPUTS)), Counter()
            symbol, code = path(w)
            new = w is not None and not counts[w]
            before = [None, None, *ws][at : at + 2]
            for d in range(model.stem if new else len(code)):
                states = [int(m.state(np.array([seen[c, code[:d]]], np.float32), np.array([seen[c, code[: d + 1]]], np.float32))[0]) for c in ((before[1],), tuple(before))]
                gate = states[0] // 64 * 4 + states[1] // 64
                x = np.array([model.tree.own[symbol, d], *(m._STRETCH_OF[s] for s in states)], float)
                e = math.exp(-float(weights[gate] @ x))
                nats += math.log1p(e)
                gradient[gate] += e / (1 + e) * x
                cells[gate] += 1
            if new:
                nats -= math.log(unseen)
            elif w is not None and w not in known:
                nats -= math.log((1 - unseen) * counts[w] / buckets[hashed[w] >> (64 - m.TRIE)])
        out[i] = -nats / math.log(10)
    return out


def test_lm_against_brute_force(spark, monkeypatch):
    """Chunks, parts, hashed contexts and split contexts of hot words give what dictionaries give."""
    monkeypatch.setattr(op02_mixing_lm, "PART_ROWS", 4000)
    r = random.Random(11)
    vocabulary = prose(70, 60).split()
    texts = [" ".join(r.choice(vocabulary[: r.randint(3, 60)]) for _ in range(r.randint(0, 200))) + " " + prose(300 + i, r.randint(0, 8)) for i in range(60)]
    texts += [texts[3], texts[4], None, "", " ".join(vocabulary * 12)]
    want = brute_scores(list(enumerate(texts)))
    got = op02_mixing_lm.scores(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    for x in got:
        assert math.isclose(x["score"], want[x["doc_id"]], rel_tol=2e-3, abs_tol=0.05), x
        assert x["spelled_score"] <= x["score"] and x["bits_per_byte"] >= 0


def test_lm_places_and_pairs_are_numbered_cheaply():
    """What replaces binary searches and the numbering of pairs gives the same, and a place costs a part of a search."""
    import time

    import numpy as np

    m = op02_mixing_lm
    r = np.random.default_rng(5)
    known, h = np.sort(r.integers(0, 2**64, 200_000, np.uint64)), r.integers(0, 2**64, 600_000, np.uint64)
    h[:200_000], h[-2:] = known, [0, 2**64 - 1]
    heads, cost = m.head_places(known), []
    for find in (lambda: np.searchsorted(known, h), lambda: m.position(known, heads, h)):
        start = time.process_time()
        found = [find() for _ in range(3)][0]
        cost.append((time.process_time() - start, found))
    assert (cost[0][1] == cost[1][1]).all() and cost[1][0] < 0.7 * cost[0][0]
    for few in (known[:0], known[:1], np.array([2**64 - 1], np.uint64)):
        assert (m.position(few, m.head_places(few), h) == np.searchsorted(few, h)).all()
    for n in (0, 1, 5000):
        whole = r.integers(0, 900, n).astype(np.uint64)
        split = np.flatnonzero(r.random(n) < 0.4)
        tops = r.integers(0, 900, len(split)).astype(np.uint64)
        found, at = np.unique(np.concatenate([whole, tops]), return_inverse=True)
        number, top = m.pair_numbers(whole, split, tops)
        pairs, times = m.pair_times(whole, split, tops)
        assert (pairs == found).all() and (number == at[:n]).all() and (top[split] == at[n:]).all()
        assert (np.delete(top, split) == np.delete(number, split)).all()
        assert (times == np.bincount(number, minlength=len(found)) + np.bincount(top[top != number], minlength=len(found))).all()


def test_lm_spells_some_rows_at_a_time(monkeypatch):
    """The bits of one call are those of so many rows, not of a whole chunk, and rows cost what they cost alone."""
    import numpy as np

    m = op02_mixing_lm
    model = m.built(*m.packed(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0), np.ones(1 << m.TRIE), 1, 10, np.ones(257))["parts"])
    rows, texts = 300, [prose(i, 5) for i in range(300)]
    n = [len(t.split()) for t in texts]
    row, place = m.expand(np.array(n))
    table, most, of = np.random.default_rng(3).integers(0, 256, m.BYTE_PLACES).astype(np.uint8), [], m.refined
    monkeypatch.setattr(m, "refined", lambda own, cell, gate, inputs, rows: (most.append(rows), of(own, cell, gate, inputs, rows))[1])
    data = " ".join(texts).encode() + b" "
    got = m.spelled(model, table, data, row, place, np.ones(len(row), bool), rows)
    assert max(most) <= m.ROWS_AT_ONCE and len(got) == rows
    for i in (0, 127, 128, 299):
        alone = m.spelled(model, table, texts[i].encode() + b" ", np.zeros(n[i], int), np.arange(n[i]), np.ones(n[i], bool), 1)
        assert math.isclose(alone[0], got[i], rel_tol=1e-9)
    assert not m.spelled(model, table, data, row, place, np.zeros(len(row), bool), rows).any()


# ---- 3


def test_contamination(spark):
    r = random.Random(5)
    items = [prose(100 + i, n) for i, n in enumerate([4, 6, 15, 22, 31, 40, 58, 90])]
    texts = []
    for i, item in enumerate(items):
        w = item.split()
        texts.append(prose(500 + i, 80) + " " + item + " " + prose(600 + i, 50))
        texts.append(prose(700 + i, r.randint(0, 20)) + "\n" + item.upper() + "!!")
        texts.append(prose(800 + i, 33) + " " + " ".join(w[: len(w) // 3]) + " " + prose(900 + i, 40))
    got = op03_decontamination.contamination(frame(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    found = {r["doc_id"]: list(r["items"]) for r in got}
    for i in range(len(items)):
        assert found[3 * i] == [i] and found[3 * i + 1] == [i] and found[3 * i + 2] == []


def test_contamination_of_edited_copies(spark):
    """Every copy that reaches 0.8 in some item-sized window is found, whatever its edits."""
    r = random.Random(8)
    items = [prose(2000 + i, r.randint(15, 90)) for i in range(60)]
    texts, want = [], []
    for n in range(1500):
        i = n % len(items)
        w = items[i].split()
        for _ in range(r.randint(1, 1 + len(w) // 20)):
            at, kind = r.randrange(len(w)), r.randrange(3)
            w[at : at + (kind != 0)] = [f"edit{r.randrange(10**6)}"] * (kind != 1)
        text = [*prose(9000 + n, r.randint(0, 60)).split(), *w, *prose(5000 + n, r.randint(0, 60)).split()]
        size, sets = len(items[i].split()), shingles(items[i])
        best = max(len(sets & shingles(" ".join(text[s : s + size]))) for s in range(max(1, len(text) - size + 1)))
        texts.append(" ".join(text))
        want.append([i] if 5 * best >= 4 * len(sets) else [])
    got = op03_decontamination.contamination(frame(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert 300 < sum(map(bool, want)) < 1500
    assert [list(x["items"]) for x in sorted(got, key=lambda x: x["doc_id"])] == want


# ---- 4


def test_mixing_agrees_with_sql(spark):
    got = QUERIES["op4_mixing"](spark, SF).toPandas()
    assert canonical(got) == canonical(connect(SF).sql(ORACLES["op4_mixing"]).df())


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, None: 90}
    rows, n = op04_mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    got = {r["source"]: r["target"] for r in rows.collect()}
    assert n == 4 and math.isclose(sum(got.values()), 1.5 * sum(sizes.values()))
    # weights 3, 1, 2, 3: a and the null source stop at twice their size, and b and c share the rest 1 to 2 until c stops
    assert got["a"] == 20 and got[None] == 180 and got["c"] == 1000 and math.isclose(got["b"], 1200)


def test_mixed_copies(odd_docs):
    plan = {(r["doc_id"], r["source"]): r["copies"] for r in op04_mixing.mix_plan(odd_docs).collect()}
    made = Counter((r["doc_id"], r["source"]) for r in op04_mixing.mixed(odd_docs).collect())
    rows = Counter((r["doc_id"], r["source"]) for r in odd_docs.collect())
    assert {k: v for k, v in made.items()} == {k: plan[k] * n for k, n in rows.items() if plan[k]}


# ---- 5


def test_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {r["doc_id"]: r for r in op05_toxicity.toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[i]["score"], y) for i, y in truth.items() if got[i]["held_out"]]
    pairs = [(a > b) + 0.5 * (a == b) for a, y in held if y for b, z in held if not z]
    assert sum(pairs) / len(pairs) > 0.75


# ---- 6


def test_languages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, "", ""), (-3, "http://x.de/", "<html lang=xx>"), (-1, None, None)], "page_id long, url string, html string")
    got = op06_language.languages(pages.unionByName(odd), spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert len(got) == pages.count() + 4
    named = [r for r in got if r["named"] and r["page_id"] >= 0]
    assert sum(r["named"] == r["lang"] for r in named) >= 0.98 * len(named)
    assert op06_language.languages(pages.limit(0), spark.read.parquet(f"{SF}/documents.parquet")).count() == 0
    assert {r["lang"] for r in op06_language.languages(pages, spark.read.parquet(f"{SF}/documents.parquet").limit(0)).collect()} == {None}


# ---- 7


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_near_duplicates(spark):
    r = random.Random(1)
    texts = [t for _, t in documents(spark)]
    base = prose(9, 200).split()
    for _ in range(60):  # a crowded group whose links are close to the threshold
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = "edit" + str(r.randrange(10**6))
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    want, sizes = brute_components(rows)
    got = op07_near_dedup.near_duplicates(frame(spark, texts)).collect()
    assert {x["doc_id"]: x["component_id"] for x in got} == want
    assert {x["doc_id"]: x["n_shingles"] for x in got} == sizes
    assert all(x["kept"] == (x["doc_id"] == x["component_id"]) for x in got)
    kept = op07_near_dedup.deduplicated(frame(spark, texts))
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(set(want.values()))


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100 + r.randrange(30), 100 + r.randrange(30)) for _ in range(40)] + [(7, 7), (200, 300), (200, 300)]
    group = defaultdict(set)
    for a, b in edges:
        merged = {a, b} | group[a] | group[b]
        for x in merged:
            group[x] = merged
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: min(g) for x, g in group.items() if len(g) > 1}


# ---- 8

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var x="</p>";</script></head><body><header><p>Site head</p></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><div class="content"><h1>Title &amp; more {0}</h1><p>First   part<br>goes {1} on &eacute;.<p>Second <b>bold</b> text {2}.</p>
<aside>Beside</aside><form><p>Mail</p></form></div><div id="comments"><p>Nice page!</p></div><footer>&copy; foot</footer><!-- gone --></body></html>"""


def test_pages(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(prose(i, 3), prose(i + 50, 30), prose(i + 90, 20))) for i in range(25)]
    rows += [(100, None, None), (101, "http://x.example", ""), (102, "http://y.example/a", "<p>Alone &lt;here"), (102, "http://y.example/a", "<p>Alone &lt;here")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in op08_templates.extract(pages).collect()}
    for i in range(25):
        assert got[i]["text"] == f"Title & more {prose(i, 3)}\n\nFirst part goes {prose(i + 50, 30)} on é.\n\nSecond bold text {prose(i + 90, 20)}."
        assert got[i]["n_chars"] == len(got[i]["text"])
    assert got[100]["text"] == "" == got[101]["text"] and got[102]["text"] == "Alone <here"
    assert op08_templates.extract(pages).count() == len(rows) and op08_templates.extract(pages.limit(0)).count() == 0


def test_pages_alike(spark):
    """Blocks of an article stay, though all pages of the host share them, on a host of any size."""
    page = "<html><body><div>Site name</div><article><h1>Shared heading</h1><p>" + prose(1, 40) + "</p><p>{}</p><p>" + prose(2, 40) + "</p></article></body></html>"
    rows = [(1000 * n + i, f"http://h{n}.example/{i}", page.format(prose(10 + i, 30))) for n in (2, 19, 30) for i in range(n)]
    rows += [(-1, "http://h30.example/x", "<html><body><div>Site name</div><section><p>Other layout</p></section></body></html>")]
    got = {r["page_id"]: r["text"] for r in op08_templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in (2, 19, 30):
        for i in range(n):
            assert got[1000 * n + i] == "\n\n".join(["Shared heading", prose(1, 40), prose(10 + i, 30), prose(2, 40)])
    assert got[-1] == "Other layout"


def test_template_decides(spark):
    """On a host whose names tell nothing, or mislead, its template finds the article; without the other pages it could not."""
    page = """<html><body><div class=a><div class=b>Top line</div><div class=b>Second line</div></div><div class="{0}"><h2>{1}</h2><p>{2}</p><p>Same on all pages.</p></div>
<div class=d><div class=e>Answer by {3}</div></div><div class=f>Last line</div></body></html>"""
    rows, want = [], {}
    for n, name in enumerate(("c", "widget")):
        for i in range(8):
            key = 100 * n + i
            rows.append((key, f"http://h{n}.example/{i}", page.format(name, prose(key + 1, 4), prose(key + 300, 60), prose(key + 500, 5))))
            want[key] = "\n\n".join([prose(key + 1, 4), prose(key + 300, 60), "Same on all pages."])
    got = {r["page_id"]: r["text"] for r in op08_templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want
    assert all(op08_templates.main_text(html, None, []) != want[key] for key, _, html in rows)


def test_frames_and_names(spark):
    """A form around the page is no form to leave out, one within is; a name's word marks no paragraph."""
    rows = [
        (1, "http://a.example/", f"<html><body><form><div><h1>Head</h1><p>{prose(1, 30)}</p><form><p>Your mail</p></form></div></form></body></html>"),
        (2, "http://b.example/", f'<html><body><article><p class="share-price">{prose(2, 9)}</p><p class="share">Tell friends</p><p>{prose(3, 30)}</p><div class="share-bar">Send</div></article></body></html>'),
        (3, " \u00a0http://c.example/x ", f"<html><body><article><p>{prose(4, 30)}</p><form><p>Your mail</p></form></article></body></html>"),
    ]
    got = {r["page_id"]: r["text"] for r in op08_templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].startswith("Head\n\n" + prose(1, 30)) and got[2] == prose(2, 9) + "\n\n" + prose(3, 30) and got[3] == prose(4, 30)
    urls = [" HTTP://A.de/x", "https://b.de?q#f", None, "", "c.de", "\thttp://d.de/\n", "http://e.de\u3000/x"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in frame.select(op08_templates.host_column(F.col("url"))).collect()] == [op08_templates.host_of(u) for u in urls]


# ---- 9


def brute_quality(text):
    w = words(text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality(spark, odd_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.where("doc_id is not null").select(F.col("doc_id") + 10_000, "text").toDF("doc_id", "text"))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = op09_quality_rules.quality(docs).collect()
    for r in got:
        want = brute_quality(text[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r["base_failed"] and r["kept"])
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r["kept"] for r in got if truth.get(r["doc_id"]) == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in got if truth.get(r["doc_id"]) == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_accuracies_are_recovered():
    """From votes on good documents and kinds of junk with known accuracies, without any label."""
    import numpy as np

    draw = np.random.default_rng(4)
    rules = len(op09_quality_rules.RULES)
    kind = draw.choice(rules + 1, 40_000, p=[0.79, *[0.21 / rules] * rules])
    chances = np.tile([0.01, 0.09, 0.9], (rules + 1, rules, 1))
    chances[0, 2] = 0.01, 0.29, 0.7  # a rule that often doubts good documents
    for k in range(rules):
        chances[k + 1, k] = 0.85, 0.1, 0.05
        chances[k + 1, (k + 1) % rules] = 0.5, 0.3, 0.2
    dice = draw.random((len(kind), rules, 1))
    votes = (dice > np.cumsum(chances[kind], axis=2)[:, :, :2]).sum(axis=2)
    votes[draw.random(votes.shape) < 0.1] = -1
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    got, shares = op09_quality_rules.maximised(patterns, n.astype(float))
    assert abs(shares[0] - 0.79) < 0.05
    assert abs(got[0] - chances[0]).max() < 0.03
    assert all(abs(got[k + 1, k, 0] - 0.85) < 0.12 for k in range(rules))
    # A rule's doubt alone does not drop a document; a bad vote with its companion's doubt does.
    alone, both = np.full((1, rules), 2), np.full((1, rules), 2)
    alone[0, 2], both[0, 4], both[0, 5] = 1, 0, 1
    assert op09_quality_rules.expected(alone, got, shares)[0, 0] > 0.9 > 0.1 > op09_quality_rules.expected(both, got, shares)[0, 0]


def test_estimates_decide(spark):
    """The verdict is not that all rules must pass, in either direction, and rounds change it."""
    stats = op09_quality_rules.statistics(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).cache()
    rules = list(op09_quality_rules.RULES)
    voted = stats.withColumns(op09_quality_rules.votes()).where(~op09_quality_rules.base_failed())
    p = {n: op09_quality_rules.posterior(*op09_quality_rules.estimate(stats, n)) for n in (0, op09_quality_rules.ROUNDS)}
    passes = ~F.greatest(*[F.coalesce((F.col(r) == 0).cast("int"), F.lit(0)) for r in rules]).cast("boolean")
    got = voted.select(passes.alias("passes"), *[(x >= 0.5).alias(f"p{n}") for n, x in p.items()]).collect()
    assert sum(r["passes"] != r[f"p{op09_quality_rules.ROUNDS}"] for r in got) >= 20
    assert sum(r["p0"] != r[f"p{op09_quality_rules.ROUNDS}"] for r in got) >= 20


# ---- 10


def test_licences(spark):
    texts = ["Body\nLicensed under the Apache License, Version 2.0.\nmore", "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "He lost his driving license in public", None, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."]
    got = {r["doc_id"]: (list(r["families"]), r["n_lines"]) for r in op10_licenses.licences(frame(spark, texts)).collect()}
    assert got == {0: (["Apache"], 1), 1: (["MIT"], 1), 2: (["GPL"], 1), 3: (["CC-BY-NC"], 1), 4: ([], 0), 5: ([], 0), 6: (["CC-BY-NC", "MIT"], 2)}


def test_licence_paragraphs(spark):
    """Whole paragraphs, wrapped ones and notices within longer lines."""
    grant = op10_licenses.PARAGRAPHS["MIT"][0]
    gpl = op10_licenses.PARAGRAPHS["GPL"][0]
    texts = [
        grant,
        gpl,
        op10_licenses.PARAGRAPHS["Apache"][0],
        op10_licenses.PARAGRAPHS["MPL"][0],
        "Released under the MIT License. The river ran past the old mill and the children went there every summer.",
        prose(1, 60) + "\n\n" + "\n".join(" ".join(gpl.split()[i : i + 9]) for i in range(0, len(gpl.split()), 9)) + "\n\n" + prose(2, 60),
        "The river ran past the old mill. The public was free to use the source and a copy of the map was sent.",
    ]
    got = {r["doc_id"]: list(r["families"]) for r in op10_licenses.licences(frame(spark, texts)).collect()}
    assert got == {0: ["MIT"], 1: ["GPL"], 2: ["Apache"], 3: ["MPL"], 4: ["MIT"], 5: ["GPL"], 6: []}


# ---- the pipeline


def test_pipeline(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    final = pipeline.run(spark, SF)
    assert final.columns == [*docs.columns, "copy"]
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in final.collect()}
    assert len(ids) > 100 and sum(quality.get(i) == 0 for i in ids) <= 5  # weights below the sources' sizes drop some
    rows = [(r["doc_id"], r["text"]) for r in final.dropDuplicates(["doc_id"]).collect()]
    assert all(i == c for i, c in brute_components(rows)[0].items())
    assert all(r["copy"] <= 2 for r in final.collect())


def test_pipeline_near_dedup(spark):
    """The stage links from a similarity of 0.8 on."""
    pipeline = pytest.importorskip("corpus_pipeline")
    r = random.Random(4)
    texts = []
    for i in range(40):
        base = prose(7000 + i, 120).split()
        texts.append(" ".join(base))
        for edits in (1, 2, 3, r.randint(4, 6)):
            w = list(base)
            for at in r.sample(range(len(w)), edits):
                w[at] = f"edit{r.randrange(10**6)}"
            texts.append(" ".join(w))
    sets = [shingles(t) for t in texts]
    first = list(range(len(texts)))
    between = 0
    for j in range(len(texts)):
        for i in range(j):
            share = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            between += 0.8 <= share < 0.85
            if share >= 0.8:
                a, b = sorted((first[i], first[j]))
                first = [a if x == b else x for x in first]
    got = pipeline.near_dedup(spark, frame(spark, texts), SF)
    assert between > 20 and sorted(x["doc_id"] for x in got.collect()) == sorted(set(first))


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert all(any(x.startswith(f"op{n}_") for x in names) for n in range(1, 11)) and "pipeline" in names
