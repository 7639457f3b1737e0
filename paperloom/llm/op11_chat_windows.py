"""Conversations as training windows of a bounded number of tokens.

A conversation's turns, in order, are cut into spans: prefix sums of the turns' tokens tell how many fresh turns fit a window.
Each later window begins with the conversation's system turn and with as many of the turns before it as the history allows,
both repeated and masked; only the texts of fresh assistant turns are under the loss mask, so each is learned once. Turns are
never cut: one that is over the budget by itself gets a window of its own, together with the system turn.

Turns are marked ``<|im_start|>``, role, line end, text, ``<|im_end|>``, line end. Where a text has ``<`` and ``|`` with nothing but
backslashes between them, one backslash more is put in; in roles, line ends and backslashes are written as letters too. Both are
undone by ``unescaped`` and ``role_of``: no text can forge a mark, and every text comes back as it was.

Scale: rows meet by conversation and part of it (``PART`` turn numbers each), sorted by Spark, and are gone through as a stream
that holds one window. A new part begins a new window; the system turn and the last ``EDGE`` turn numbers are sent to the next part
too, so a conversation that holds a third of all rows is spread over its parts. Only rows that share one turn number stay
together. Texts are shuffled once.

Defined cases: a null text or role is empty; null turns come first; rows of one turn are in order of role and text, so repeated rows
stay, in any order; a null conv_id is a conversation of its own; a system turn counts as such where it opens the conversation; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import small_or_shuffled, stored
from .streams import streamed, typed

#: Tokens of a window and of the history in it, and what the marks of a turn count.
BUDGET, HISTORY, MARKS = 512, 128, 4
#: Turn numbers of a part, and how many before it its history may reach back to.
PART, EDGE = 1024, 16
START, END = "<|im_start|>", "<|im_end|>"
ROLE_LEARNED, ROLE_KEPT = "assistant", "system"
#: Rows of a part: what comes from elsewhere of the system turn, from the part before, and its own.
OPENING, BEFORE, OWN = 0, 1, 2
NO_TURN = -(1 << 63)

_ESCAPED = re.compile(r"<(\\*)\|")
_UNESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def escaped(text: str) -> str:
    return _ESCAPED.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _UNESCAPED.sub(r"<\1|", text)


def written_role(role: str) -> str:
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def role_of(written: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(written))


def formatted(turns: list[tuple[str, str]], n_repeated: int) -> tuple[str, list[tuple[int, int]]]:
    """The window of (role, text), and the spans of its loss mask in code points."""
    parts, spans, at = [], [], 0
    for i, (role, text) in enumerate(turns):
        head, body = f"{START}{written_role(role)}\n", escaped(text)
        if i >= n_repeated and role == ROLE_LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def turns_in(window: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a window."""
    for m in _TURN.finditer(window):
        yield role_of(m[1]), unescaped(m[2])


def cut(rows: Iterator[tuple], budget: int, history: int) -> Iterator[tuple[list[tuple[str, str]], int, int]]:
    """Windows (turns, how many of them are repeated, tokens) of one part's rows (kind, role, text, tokens).

    ``sums[i]`` are the tokens before held turn i; turns up to ``fresh`` were in earlier windows. What no window needs any
    more is let go, so a window and its history are all that is held.
    """
    system, first, opening = None, True, False
    held, sums, fresh = [], [0], 0

    def window() -> tuple[list[tuple[str, str]], int, int]:
        front = [system[:2]] if system and not opening else []
        return front + [t[:2] for t in held], len(front) + fresh, sums[-1] - sums[0] + (system[2] if front else 0)

    for kind, role, text, tokens in rows:
        if kind == OPENING:
            system, first = (role, text, tokens) if role is not None else None, False
            continue
        if kind == BEFORE:
            if held or not system or (role, text) != system[:2]:
                held.append((role, text, tokens))
                sums.append(sums[-1] + tokens)
                drop = bisect_left(sums, sums[-1] - history)
                held, sums = held[drop:], sums[drop:]
                fresh = len(held)
            continue
        if first and role == ROLE_KEPT:
            system, opening = (role, text, tokens), True
        first = False
        kept = system[2] if system and not opening else 0
        if fresh == len(held) or kept + sums[-1] + tokens - sums[0] > budget:
            skip = 0
            if fresh < len(held):
                yield window()
                # The turn that opens the conversation is at hand as the system turn from now on, not as history.
                skip, opening = int(opening), False
                kept = system[2] if system else 0
            low = max(sums[-1] - history, sums[-1] + kept + tokens - budget)
            begin = max(skip, min(bisect_left(sums, low), len(held)))
            held, sums = held[begin:], sums[begin:]
            fresh = len(held)
        held.append((role, text, tokens))
        sums.append(sums[-1] + tokens)
    if fresh < len(held):
        yield window()


def word_tokens() -> Column:
    """Words of the text and the marks of its turn: a tokenizer's count may be used instead."""
    return F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) + MARKS


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None) -> DataFrame:
    """conv_id, part, window (from 0 in its part), formatted, n_turns, n_repeated (turns at its front that are not fresh), n_tokens,
    loss (spans of code points), more (the conversation has several parts).

    ``tokens`` counts those of a row (role, text); without it words are counted. Windows of a part come from one task in order.
    """
    if not 0 <= history < budget:
        raise ValueError("the history has to be smaller than the budget")
    empty = F.lit("")
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    part = F.coalesce(F.floor(F.col("turn") / PART), F.lit(NO_TURN)).cast("long")
    rows = rows.withColumns({"tokens": (word_tokens() if tokens is None else tokens).cast("long"), "part": part})
    spread = stored(rows.groupBy("conv_id").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("high > low").select("conv_id", "low"))
    n_spread = spread.count()
    known = small_or_shuffled(spread.select(F.col("conv_id").alias("__id"), "low"), n_spread)
    joined = rows.join(known, F.col("conv_id").eqNullSafe(F.col("__id")), "left").drop("__id") if n_spread else rows.withColumn("low", F.lit(None).cast("long"))
    here = F.struct("part", F.lit(OWN).alias("kind"))
    later = F.struct((F.col("part") + 1).alias("part"), F.lit(BEFORE).alias("kind"))
    is_edge = F.col("low").isNotNull() & (F.pmod("turn", F.lit(PART)) >= PART - EDGE) & F.col("turn").isNotNull()
    more = F.col("low").isNotNull().alias("more")
    moved = joined.withColumn("at", F.explode(F.when(is_edge, F.array(here, later)).otherwise(F.array(here))))
    placed = moved.select("conv_id", "at.part", "at.kind", more, "turn", "role", "text", "tokens")
    if n_spread:
        of_spread = joined.where("low is not null")
        # The opening row of each conversation; in order of turn, role and text, as everywhere.
        opening = of_spread.where("part = low").groupBy("conv_id").agg(F.min_by(F.struct("role", "text", "tokens"), F.struct("turn", "role", "text")).alias("o"))
        opening = opening.select(F.col("conv_id").alias("__id"), F.when(F.col("o.role") == ROLE_KEPT, F.col("o")).alias("o"))
        parts = of_spread.where("part > low").select("conv_id", "part").distinct().join(opening, F.col("conv_id").eqNullSafe(F.col("__id")), "left")
        placed = placed.unionByName(parts.select("conv_id", "part", F.lit(OPENING).alias("kind"), F.lit(True).alias("more"), F.lit(None).cast("long").alias("turn"), "o.role", "o.text", "o.tokens"))
    ordered = placed.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "kind", "turn", "role", "text")

    def go(stream: Iterator[tuple]) -> Iterator[tuple]:
        for (conv_id, at, is_more), group in groupby(stream, key=lambda r: (r[0], r[1], r[3])):
            for i, (turns, repeated, size) in enumerate(cut(((r[2], *r[5:8]) for r in group), budget, history)):
                text, spans = formatted(turns, repeated)
                yield conv_id, at, i, text, len(turns), repeated, size, [{"start": a, "end": b} for a, b in spans], is_more

    return streamed(ordered, go, typed(conversations, "conv_id", "part long, window int, formatted string, n_turns int, n_repeated int, n_tokens long, loss array<struct<start:int,end:int>>, more boolean"))


def digest(group: Iterator[tuple[str, int, list[dict]]]) -> tuple[int, str, int, str, int]:
    """Of one conversation's windows (formatted, n_repeated, loss) in order: n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, all read from the windows."""
    turns, learned, n_turns, n_learned, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
    for text, repeated, loss in group:
        chars += len(text)
        for i, (role, said) in enumerate(turns_in(text)):
            if i >= repeated:
                n_turns += 1
                turns.update(f"{role}\n{said}\n".encode())
        for span in loss:
            part = unescaped(text[span["start"] : span["end"]])
            n_learned += len(part)
            learned.update(part.encode())
    return n_turns, turns.hexdigest(), n_learned, learned.hexdigest(), chars


def digests(made: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of ``windows``.

    A conversation of one part is read where it was made; of the others the windows meet in order, as a hash is taken in turn.
    """
    sums = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    held = "part long, window int, formatted string, n_repeated int, loss array<struct<start:int,end:int>>"

    def here(stream: Iterator[tuple]) -> Iterator[tuple]:
        for (conv_id, more), group in groupby(stream, key=lambda r: (r[0], r[6])):
            if more:
                yield from ((conv_id, *r[1:6], None, None, None, None, None) for r in group)
            else:
                yield conv_id, None, None, None, None, None, *digest(r[3:6] for r in group)

    def together(stream: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, group in groupby(stream, key=lambda r: r[0]):
            yield conv_id, *digest(r[3:6] for r in group)

    read = made.select("conv_id", "part", "window", "formatted", "n_repeated", "loss", "more")
    both = stored(streamed(read, here, typed(made, "conv_id", f"{held}, {sums}")))
    names = [c.split()[0] for c in sums.split(", ")]
    open_ = both.where("formatted is not null").select("conv_id", "part", "window", "formatted", "n_repeated", "loss")
    rest = open_.repartition("conv_id").sortWithinPartitions("conv_id", "part", "window")
    return both.where("formatted is null").select("conv_id", *names).unionByName(streamed(rest, together, typed(made, "conv_id", sums)))
