"""Repair of a conversation's structure by the cheapest edits.

Rows are looked at in order: a blank one, one that repeats role and text of an earlier one, or one that breaks off is at fault.
What decides on the repair of a conversation is its signature, a sign for each row: the initial of its role and its fault.
Signatures are few where conversations are many. The distinct ones are sorted, so that those with a common beginning come after
one another, and go into a prefix trie: the layer of a node (for each state of the wanted pattern the least cost and the
ASCII-least edits that reach it) is computed once for all signatures below it, and a node where a signature ends gives its
answer. Each task goes through its range of the sorted signatures depth first, so it holds the layers of one path only: some
forty bytes for each row of the longest conversation.

Edits at one node never begin one another: each has as many letters that use up a row, and ends in one. So their order is
settled by the order at the node before and then by the letters added, and layers need no texts of edits, just ranks.

The pattern is ``(s?(ua)+)?`` over role initials: nothing, or pairs of user and assistant behind at most one system row.

Scale: counting, telling duplicates and signatures work on hashes, not on texts; duplicates are told by role and text, so a large
conversation is spread there. Its signature is one string and its repaired text is one sequence, so these are gone through as a
stream in order, without texts being held. Texts are shuffled once.

Defined cases: a null role or text is one space; null turns come first; rows of one turn are in order of role and the MD5 of the text;
a null conv_id is a conversation of its own; roles with other initials have to be changed or deleted; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import small_or_shuffled, stored
from .streams import streamed, typed

SPACE = r"\x20\x09-\x0D"
#: Costs of edits, and of keeping a row that breaks off.
REROLE, DELETE, INSERT, BROKEN = 3, 4, 3, 3
#: States of the pattern: nothing yet, behind the system row, behind a user's, behind an assistant's. The first and the last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
FINAL = (START, ASSISTANT)
#: The role that comes next where one is put in or changed.
NEXT = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: Signs: an initial (x: another) of a sound row, in upper case if it breaks off; a row that has to go.
GONE = "d"
UNREACHED = 1 << 60


def ways(sign: str) -> list[list[tuple[int, int, str]]]:
    """For each state after a row with this sign, what leads there: (state before, cost, letters), the best for each state before."""
    best: list[dict[int, tuple[int, str]]] = [{} for _ in range(4)]
    for before in range(4):
        state, cost, letters = before, 0, ""
        for _ in range(3):
            after = [(state, DELETE, "D")]
            if sign != GONE:
                broken = BROKEN if sign.isupper() else 0
                after.append((STEP[state][NEXT[state][0]], REROLE + broken, "R"))
                if sign.lower() in STEP[state]:
                    after.append((STEP[state][sign.lower()], broken, "K"))
            for to, more, letter in after:
                way = (cost + more, letters + letter)
                if before not in best[to] or way < best[to][before]:
                    best[to][before] = way
            state, cost, letters = STEP[state][NEXT[state][0]], cost + INSERT, letters + "I"
    return [[(before, *way) for before, way in b.items()] for b in best]


WAYS = {sign: ways(sign) for sign in "suaxSUAX" + GONE}
#: The letters a row may add, numbered; a way is kept as 4 times the number of its letters plus the state before.
LETTERS = sorted({way[2] for sign in WAYS.values() for state in sign for way in state})
NUMBER = {letters: i for i, letters in enumerate(LETTERS)}


class Path:
    """The layers of one path of the trie: for each depth the cost, the rank and the way of each state."""

    def __init__(self) -> None:
        self.signs = ""
        self.costs = array("q", [0, UNREACHED, UNREACHED, UNREACHED])
        self.ranks = bytearray(4)
        self.ways = bytearray(4)

    def to(self, signature: str) -> None:
        """Go to the node of ``signature``: up to what it shares with the last one, then down, a layer for each node on the way."""
        shared = common(self.signs, signature)
        del self.costs[4 * shared + 4 :], self.ranks[4 * shared + 4 :], self.ways[4 * shared + 4 :]
        for sign in signature[shared:]:
            costs, ranks = self.costs[-4:], self.ranks[-4:]
            reached = []
            for state in range(4):
                found = [(costs[b] + c, ranks[b], letters, b) for b, c, letters in WAYS[sign][state] if costs[b] < UNREACHED]
                if found:
                    reached.append((*min(found), state))
            layer, rank, way = [UNREACHED] * 4, [0] * 4, [0] * 4
            for place, (cost, _, letters, before, state) in enumerate(sorted(reached, key=lambda r: r[1:3])):
                layer[state], rank[state], way[state] = cost, place, 4 * NUMBER[letters] + before
            self.costs.extend(layer)
            self.ranks.extend(rank)
            self.ways.extend(way)
        self.signs = signature

    def answer(self) -> tuple[int, str]:
        """The least cost of the signature the path ends with, and its edits."""
        ends = []
        for state in range(4):
            if self.costs[state - 4] < UNREACHED:
                now, letters = state, ""
                while now not in FINAL:
                    now, letters = STEP[now][NEXT[now][0]], letters + "I"
                ends.append((self.costs[state - 4] + INSERT * len(letters), self.ranks[state - 4], letters, state))
        cost, _, letters, state = min(ends)
        parts = [letters]
        for depth in range(len(self.signs), 0, -1):
            number, state = divmod(self.ways[4 * depth + state], 4)
            parts.append(LETTERS[number])
        return cost, "".join(reversed(parts))


def common(a: str, b: str) -> int:
    """How many signs two signatures begin with alike, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def answers(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of distinct signatures."""

    def go(rows: Iterator[tuple]) -> Iterator[tuple]:
        path = Path()
        for (signature,) in rows:
            path.to(signature)
            yield signature, *path.answer()

    ranged = signatures.select("signature").distinct().repartitionByRange("signature").sortWithinPartitions("signature")
    return streamed(ranged, go, typed(signatures, "signature", "cost long, audit string"))


def rows_of_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, mark) with nulls replaced; ``mark`` orders the rows of a turn and tells texts apart."""
    blank = F.lit(" ")
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    return rows.withColumn("mark", F.unhex(F.md5("text")))


def sign(role: Column, gone: Column, broken: Column) -> Column:
    initial = F.substring(role, 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return F.when(gone, GONE).when(broken, F.upper(known)).otherwise(known)


def structures(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, signature, cost and audit, a row for each conversation.

    ``gaps`` are turn numbers missing between the first and the last; ``illegal`` counts neighbours whose initials are not su, ua or au.
    """
    rows = rows_of_conversations(conversations)
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    broken = ~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    light = rows.select("conv_id", "turn", "role", "mark", blank.alias("blank"), broken.alias("broken"))
    same = Window.partitionBy("conv_id", "role", "mark").orderBy("turn")
    repeated = light.withColumn("repeated", ~F.col("blank") & (F.row_number().over(same) > 1))
    broken_only = F.col("broken") & ~F.col("blank") & ~F.col("repeated")
    signed = repeated.withColumn("sign", sign(F.col("role"), F.col("blank") | F.col("repeated"), broken_only))
    # The copies of a row are alike but for the first; that one comes first.
    ordered = signed.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "mark", "repeated")

    def go(stream: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, group in groupby(stream, key=lambda r: r[0]):
            n = dict.fromkeys(("blank", "repeated", "broken", "illegal", "turns"), 0)
            low = high = last = None
            signs = []
            for _, turn, initial, is_blank, is_repeated, s in group:
                n["illegal"] += last is not None and last + initial not in ("su", "ua", "au")
                last = initial
                n["blank"] += is_blank
                n["repeated"] += is_repeated
                n["broken"] += s.isupper()
                if turn is not None:
                    low = turn if low is None else low
                    n["turns"] += turn != high
                    high = turn
                signs.append(s)
            gaps = high - low + 1 - n["turns"] if n["turns"] else 0
            yield conv_id, gaps, n["blank"], n["repeated"], n["broken"], n["illegal"], "".join(signs)

    few = ordered.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "repeated", "sign")
    found = stored(streamed(few, go, typed(conversations, "conv_id", "gaps long, blank long, duplicate long, truncated long, illegal long, signature string")))
    best = stored(answers(found))
    # A long signature would make a wide row of the side that is sent to all tasks.
    size = best.agg(F.coalesce(F.sum(F.length("signature") + F.length("audit") + 32), F.lit(0))).first()[0]
    return found.join(small_or_shuffled(best, size // 16), "signature").select(*found.columns, "cost", "audit")


def repaired(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the conversations after the edits of ``found`` (conv_id, audit), from ``structures``.

    A conversation's rows come from one task in order; its edits come as a row before them, so no join repeats them.
    """
    rows = rows_of_conversations(conversations).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "mark")
    nothing = {"kind": F.lit(0), "turn": F.lit(None).cast("long"), "role": F.lit(None).cast("string"), "text": F.col("audit"), "mark": F.lit(None).cast("binary")}
    heads = found.select("conv_id", *[c.alias(name) for name, c in nothing.items()])
    ordered = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "mark")

    def go(stream: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, group in groupby(stream, key=lambda r: r[0]):
            _, kind, _, audit = next(group)
            state, place = START, 0
            if kind != 0:
                raise ValueError("a conversation without its edits")
            for edit in audit:
                row = None if edit == "I" else next(group)
                if edit == "D":
                    continue
                role = row[2] if edit == "K" else NEXT[state]
                yield conv_id, place, role, row[3] if row else ""
                state, place = STEP[state][role[0]], place + 1

    few = ordered.select("conv_id", "kind", "role", "text")
    return streamed(few, go, typed(conversations, "conv_id", "place long, role string, text string"))


def hashed(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired`` rows, as they come: role and text with a colon between, lines joined."""

    def go(stream: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, group in groupby(stream, key=lambda r: r[0]):
            whole = hashlib.sha256()
            for i, (_, role, text) in enumerate(group):
                whole.update(f"{chr(10) if i else ''}{role}:{text}".encode())
            yield conv_id, whole.hexdigest()

    return streamed(rows.select("conv_id", "role", "text"), go, typed(rows, "conv_id", "repaired_sha256 string"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the damage that the checksum of ``conv_id:turn`` (null: one space) picks: a twentieth each is dropped, emptied,
    robbed of its ends of sentences, repeated, or given to the user."""
    rows = rows_of_conversations(conversations).drop("mark")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("pick", F.crc32(key.cast("binary")) % 20).where("pick != 0")
    text = F.when(F.col("pick") == 1, "").when(F.col("pick") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("pick") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("pick") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Structure and digest of the repaired ``rows`` for every conversation of ``conversations``, also those without rows."""
    found = structures(rows)
    digests = hashed(repaired(rows, found))
    ids = conversations.select("conv_id").distinct()
    of = lambda df, name: df.withColumnRenamed("conv_id", name)
    both = ids.join(of(found, "f_id"), F.col("conv_id").eqNullSafe(F.col("f_id")), "left").join(of(digests, "d_id"), F.col("conv_id").eqNullSafe(F.col("d_id")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return both.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
