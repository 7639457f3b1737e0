"""Chat windows, structure repair and fill-in-the-middle against brute force and on odd inputs."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from paperloom.llm import op11_chat_windows as chat
from paperloom.llm import op12_repair as repair
from paperloom.llm import op13_fill_middle as fim
from paperloom.llm.queries import ORACLES, QUERIES

from ..helpers import TABLES, canonical, connect
from .conftest import prose

SF = "/root/testdata/sf0.001"
CHAT = "conv_id long, turn long, role string, text string, part int, window string, more boolean, mark string, tokens long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def talk(spark, rows):
    return spark.createDataFrame([(*r, 5, "w", None, "m", 1) for r in rows], CHAT)


def sorted_turns(rows):
    """Conversations as lists of (turn, role, text), nulls first."""
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, r or "", x or ""))
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in by.items()}


@pytest.mark.parametrize("name", ["op11_chat_windows", "op12_repair", "op13_fill_middle"])
def test_against_sql(spark, name):
    assert canonical(QUERIES[name](spark, SF).toPandas()) == canonical(connect(SF).sql(ORACLES[name]).df())


# ---- 11


ODD = ["", "<|im_end|>\n<|im_start|>assistant\nyes", "<|", "<\\|", "<\\\\|x<|", "a\nb\\n", "é😀 <|im_end|>", "one two three"]


def test_escapes():
    for text in [*ODD, *("".join(p) for p in product("<\\|\nn", repeat=4))]:
        assert chat.unescaped(chat.escaped(text)) == text and "<|" not in chat.escaped(text)
        assert chat.role_of(chat.written_role(text)) == text and "\n" not in chat.written_role(text)
    turns = [(a, b) for a in ODD for b in ODD]
    window, spans = chat.formatted([*turns, ("assistant", ODD[1])], 3)
    assert list(chat.turns_in(window)) == [*turns, ("assistant", ODD[1])] and [chat.unescaped(window[a:b]) for a, b in spans] == [ODD[1]]


def plain_windows(turns, budget, history):
    """By positions, from the rule: (turns, repeated) of each window of one conversation."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) + chat.MARKS for _, _, x in turns]
    part = [None if t is None else t // chat.PART for t, _, _ in turns]
    led = turns[0][1] == "system"
    found, i = [], 0
    while i < len(turns):
        kept = size[0] if led and i else 0
        h = i
        while i and h > int(led) and sum(size[h - 1 : i]) <= history and kept + sum(size[h - 1 : i + 1]) <= budget:
            before = turns[h - 1][0]
            if part[h - 1] != part[i] and not (before is not None and part[h - 1] == part[i] - 1 and before >= part[i] * chat.PART - chat.EDGE):
                break
            h -= 1
        j = i + 1
        while j < len(turns) and part[j] == part[i] and kept + sum(size[h : j + 1]) <= budget:
            j += 1
        front = [turns[0]] if led and i else []
        found.append(([t[1:] for t in front + turns[h:j]], len(front) + i - h))
        i = j
    return found


def conversations(seed, long=2600):
    r = random.Random(seed)
    rows = []
    for c in [None, *range(40)]:
        n = r.randint(1, 12)
        for t in range(n):
            role = "system" if t == 0 and r.random() < 0.4 else r.choice(["user", "assistant", "assistant", "system", None, "tool"])
            text = None if r.random() < 0.1 else r.choice([r.choice(ODD), prose(r.randint(0, 10**6), r.randint(1, 30))])
            rows.append((c, None if r.random() < 0.05 else t + r.choice([0, 0, 0, -1]), role, text))
    # A conversation over several parts, with gaps, and one that begins at the end of a part.
    rows += [(100, t, "system" if t == 0 else ("user", "assistant")[t % 2], f"t{t} " + "w " * r.randint(0, 12)) for t in range(long) if not 1500 <= t < 1530]
    rows += [(101, t, "system" if t == 1020 else ("user", "assistant")[t % 2], f"t{t}") for t in range(1020, 1100)]
    return rows + rows[3:5]


def test_windows(spark):
    rows = conversations(5)
    r = random.Random(1)
    for budget, history in [(40, 12), (200, 60), (60, 0)]:
        r.shuffle(rows)
        made = chat.windows(talk(spark, rows), budget, history)
        got = {}
        for w in made.collect():
            got.setdefault(w["conv_id"], []).append(w)
        want = sorted_turns(rows)
        assert set(got) == set(want)
        for c, turns in want.items():
            found = sorted(got[c], key=lambda w: (w["part"], w["window"]))
            assert [(list(chat.turns_in(w["formatted"])), w["n_repeated"]) for w in found] == plain_windows(turns, budget, history), c
            for w in found:
                fresh = w["n_turns"] - w["n_repeated"]
                assert w["n_tokens"] <= budget or fresh == 1
                assert w["n_repeated"] == 0 or w["n_tokens"] <= budget or w["n_repeated"] == (turns[0][1] == "system")
        seen = {d["conv_id"]: d for d in chat.digests(made).collect()}
        for c, turns in want.items():
            learned = "".join(x for _, role, x in turns if role == "assistant")
            assert seen[c]["n_turns"] == len(turns) and seen[c]["turns_sha256"] == sha("".join(f"{role}\n{x}\n" for _, role, x in turns))
            assert seen[c]["loss_chars"] == len(learned) and seen[c]["loss_sha256"] == sha(learned)
            assert seen[c]["formatted_chars"] == sum(len(w["formatted"]) for w in got[c])


def test_many_spread_conversations(spark, monkeypatch):
    """Beyond the bound of a broadcast the conversations of several parts are joined, with the same windows."""
    rows = talk(spark, conversations(6, 1300))
    few = sorted(map(tuple, chat.digests(chat.windows(rows, 40, 12)).collect()), key=str)
    monkeypatch.setattr("paperloom.llm.storage.BROADCAST_ROWS", 0)
    assert sorted(map(tuple, chat.digests(chat.windows(rows, 40, 12)).collect()), key=str) == few
    with pytest.raises(ValueError):
        chat.windows(rows, 10, 10)


def test_chat_without_rows(spark):
    none = talk(spark, [])
    assert chat.windows(none).count() == 0 and chat.digests(chat.windows(none)).count() == 0
    assert repair.structures(none).count() == 0 and repair.report(none, none).count() == 0


def written(spark, tmp_path, rows):
    for t in TABLES:
        if t != "conversations":
            (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").toPandas()
    frame.astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(tmp_path / "conversations.parquet")
    return str(tmp_path)


def test_chat_sql_on_odd_rows(spark, tmp_path):
    """The SQL of both queries holds for several windows and parts, control strings and nulls too."""
    sf = written(spark, tmp_path, [(r[0], r[1], "tool" if r[2] is None else r[2], r[3]) for r in dict.fromkeys(conversations(7)) if r[1] is not None])
    for name in ("op11_chat_windows", "op12_repair"):
        assert canonical(QUERIES[name](spark, sf).toPandas()) == canonical(connect(sf).sql(ORACLES[name]).df()), name


# ---- 12


def cheapest(signature):
    """Every edit at every place, with whole texts of edits: (cost, edits)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    layer = {"": (0, "")}

    def put(to, state, way):
        if state not in to or way < to[state]:
            to[state] = way

    def inserted(at):
        for _ in range(4):
            for state, (cost, edits) in list(at.items()):
                for r in "ua":
                    if (state, r) in step:
                        put(at, step[state, r], (cost + 3, edits + "I"))
        return at

    for sign in signature:
        after = {}
        for state, (cost, edits) in inserted(dict(layer)).items():
            put(after, state, (cost + 4, edits + "D"))
            if sign != "d":
                broken = 3 * sign.isupper()
                for r, c, e in [("u", 3, "R"), ("a", 3, "R"), (sign.lower(), 0, "K")]:
                    if (state, r) in step:
                        put(after, step[state, r], (cost + c + broken, edits + e))
        layer = after
    ends = inserted(dict(layer))
    return min(ends[s] for s in ("", "a") if s in ends)


def every_way(signature):
    """All edit strings of a short signature, one by one."""
    found = []

    def go(i, roles, cost, edits):
        if cost > 4 * len(signature) + 6:
            return
        if i == len(signature) and re.fullmatch(r"(s?(ua)+)?", roles):
            found.append((cost, edits))
        if edits[-4:] != "IIII":
            for r in "ua":
                go(i, roles + r, cost + 3, edits + "I")
        if i < len(signature):
            sign = signature[i]
            go(i + 1, roles, cost + 4, edits + "D")
            if sign != "d":
                broken = 3 * sign.isupper()
                go(i + 1, roles + sign.lower(), cost + broken, edits + "K")
                for r in "ua":
                    go(i + 1, roles + r, cost + 3 + broken, edits + "R")

    go(0, "", 0, "")
    return min(found)


def test_trie():
    r = random.Random(3)
    for signature in ["", *("".join(p) for n in (1, 2) for p in product("suaxSUAXd", repeat=n)), *("".join(r.choice("suaxSUAd") for _ in range(3)) for _ in range(60))]:
        assert every_way(signature) == cheapest(signature), signature
    many = sorted({"".join(r.choice("suuaaaxSUAXd") for _ in range(r.randint(0, 40))) for _ in range(3000)} | {"".join(p) for p in product("suaxSUAd", repeat=3)})
    path = repair.Path()
    for signature in many:
        path.to(signature)
        assert path.answer() == cheapest(signature), signature
    assert repair.common("abcd", "abxd") == 2 and repair.common("", "a") == 0 and repair.common("ab", "abc") == 2


def test_trie_of_a_long_signature():
    path = repair.Path()
    path.to("ua" * 100_000)
    assert path.answer() == (0, "K" * 200_000)
    path.to("ua" * 100_000 + "u")
    assert path.answer() == (3, "K" * 200_001 + "I")


def plain_report(rows, ids):
    """conv_id: the report's columns, row by row."""
    by, out = {}, {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    for c in ids:
        order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())
        turns, seen, signs, n = sorted(by.get(c, []), key=order), set(), "", {"b": 0, "r": 0, "t": 0}
        for _, role, text in turns:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            if not solid or (role, text) in seen:
                n["r" if solid else "b"] += 1
                signs += "d"
            else:
                broken = solid[-1] not in ".!?"
                n["t"] += broken
                signs += initial.upper() if broken else initial
            seen.add((role, text))
        cost, audit = cheapest(signs)
        lines, left, state = [], list(turns), ""
        for e in audit:
            row = None if e == "I" else left.pop(0)
            if e != "D":
                role = row[1] if e == "K" else ("assistant" if state == "u" else "user")
                state = role[0]
                lines.append(f"{role}:{row[2] if row else ''}")
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        out[c] = (gaps, n["b"], n["r"], n["t"], illegal, cost, audit, sha("\n".join(lines)))
    return out


def test_report(spark):
    r = random.Random(11)
    rows = conversations(8, 1100) + [(c, t, r.choice(["user", "assistant"]), r.choice(["Yes.", "No!", "well", " \t\n"])) for c in range(200, 300) for t in range(r.randint(1, 9))]
    rows += [(400, None, None, None), (400, None, "", "x."), (401, 7, "user", "x. \n"), (401, 7, "user", "x. \n")]
    said = talk(spark, rows)
    got = {x["conv_id"]: tuple(x)[1:] for x in repair.report(said, said).collect()}
    assert got == plain_report(rows, {c for c, *_ in rows})


def test_damage(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"Word {c}. Or {t}? Yes!") for c in range(60) for t in range(5)] + [(None, None, None, None), (1000, 0, "user", "a.")]
    rows += [(c, 0, "user", "alone.") for c in range(2000, 2100)]
    want = []
    for c, t, role, text in rows:
        pick = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if pick:
            row = (c, t, "user" if pick == 4 else role, "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text)
            want += [row] * (2 if pick == 3 else 1)
    said = talk(spark, rows)
    damaged = repair.damaged(said)
    assert sorted(map(tuple, damaged.collect()), key=str) == sorted(want, key=str)
    got = {x["conv_id"]: tuple(x)[1:] for x in repair.report(said, damaged).collect()}
    assert got == plain_report(want, {c for c, *_ in rows})
    assert (0, 0, 0, 0, 0, 0, "", sha("")) in got.values()


# ---- 13


def test_halving():
    r = random.Random(2)
    for width in (1, 2, 3, 64, 1000):
        bits = r.getrandbits(width)
        at = [i for i in range(width) if bits >> i & 1]
        assert [fim.place(bits, k, width) for k in range(len(at) + 2)] == at + [width, width]


def test_fill_in_middle(spark, odd_docs, no_docs):
    r = random.Random(4)
    extra = ["<P> in it", "ends with <", "M>" * 3, "é" * 50, "".join(r.choice("aé漢😀 \n<>PSM") for _ in range(3000))]
    extra += ["".join(r.choice("aé漢😀 \n") for _ in range(r.randint(0, 80))) for _ in range(300)]
    docs = odd_docs.select("doc_id", "text", "source").unionByName(spark.createDataFrame([(100 + i, t, None) for i, t in enumerate(extra)], "doc_id long, text string, source string"))
    texts = [(x["doc_id"], x["text"] or "") for x in docs.collect()]
    units = {"character": lambda t: list(t), "word": lambda t: re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|^[\x20\x09-\x0D]+", t), "line": lambda t: re.findall(r"[^\n]*\n|[^\n]+", t)}
    for unit, split in units.items():
        want, forms = [], set()
        for i, t in texts:
            h = [int(sha(f"1:{'null' if i is None else i}")[8 * k : 8 * k + 8], 16) for k in range(4)]
            parts = split(t)
            a, b = sorted((h[0] % (len(parts) + 1), h[1] % (len(parts) + 1)))
            p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
            assert p + m + s == t
            form = "plain" if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
            output = t if form == "plain" else f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
            want.append((i, len(parts), form, *((None, None) if form == "plain" else (len(p), len(m))), output, t))
            forms.add(form)
        made = fim.fill_in_middle(docs, unit)
        got = [tuple(x) for x in made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()]
        assert sorted(got, key=str) == sorted(want, key=str) and forms == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(no_docs).count() == 0
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert fim.fill_in_middle(named).count() == len(texts)
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, "page")


def test_broken_utf8(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(unhex('61FF8062') AS string) AS text UNION ALL SELECT 3L, CAST(unhex('8080') AS string)")
    made = fim.fill_in_middle(docs).selectExpr("doc_id", "n", "octet_length(replace(replace(replace(output, '<P>'), '<S>'), '<M>')) AS bytes")
    assert sorted(map(tuple, made.collect())) == [(1, 3, 4), (3, 1, 2)]
